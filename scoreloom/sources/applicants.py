"""Applicant tables: schema, scans, the audit copy, and the view over the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.functions.columns import nan_to_null

APPLICANT_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.LongType(), False),
        T.StructField("bureau_score", T.DoubleType()),
        T.StructField("monthly_income", T.DoubleType()),
        T.StructField("dti", T.DoubleType()),
        T.StructField("utilization_rate", T.DoubleType()),
        T.StructField("missed_payments_3m", T.IntegerType()),
        T.StructField("overdrawn_days_3m", T.IntegerType()),
        T.StructField("max_dpd_12m", T.IntegerType()),
        T.StructField("number_of_credit_inquiries_6m", T.IntegerType()),
        T.StructField("salary_domiciliation", T.IntegerType()),
        T.StructField("employment_status", T.StringType()),
        T.StructField("default_12m", T.IntegerType()),
    ]
)

# Applicant columns as arithmetic on an order, one applicant per order.
_UNIT_INTERVAL = {
    "ur": "CAST((o_orderkey * 7919 + 11) % 10007 AS DOUBLE) / 10007e0",
    "u1": "CAST((o_orderkey * 6101 + 23) % 9973 AS DOUBLE) / 9973e0",
    "u2": "CAST((o_orderkey * 5557 + 37) % 9967 AS DOUBLE) / 9967e0",
    "u3": "CAST((o_orderkey * 4513 + 41) % 9949 AS DOUBLE) / 9949e0",
    "u4": "CAST((o_orderkey * 3889 + 53) % 9941 AS DOUBLE) / 9941e0",
    "u5": "CAST((o_orderkey * 3313 + 67) % 9931 AS DOUBLE) / 9931e0",
    "u6": "CAST((o_orderkey * 2971 + 71) % 9929 AS DOUBLE) / 9929e0",
    "u7": "CAST((o_orderkey * 2459 + 83) % 9923 AS DOUBLE) / 9923e0",
    "u8": "CAST((o_orderkey * 1987 + 97) % 9907 AS DOUBLE) / 9907e0",
    "u9": "CAST((o_orderkey * 1493 + 101) % 9901 AS DOUBLE) / 9901e0",
}
_APPLICANT = {
    "customer_id": "k",
    "bureau_score": "CASE WHEN k % 41 = 7 THEN NULL ELSE CAST(FLOOR(850e0 - 550e0 * (0.6e0 * ur + 0.4e0 * u1)) AS DOUBLE) END",
    "monthly_income": "CASE WHEN k % 29 = 3 THEN NULL ELSE CAST(FLOOR(600e0 + 1200e0 * (1e0 - ur) + 2600e0 * u2 * u2 + CASE WHEN k % 97 = 0 THEN 9000e0 ELSE 0e0 END) AS DOUBLE) END",
    "dti": "FLOOR(1000e0 * (0.1e0 + 0.45e0 * ur + 0.45e0 * u3)) / 1000e0",
    "utilization_rate": "FLOOR(1000e0 * (0.7e0 * ur + 0.4e0 * u4)) / 1000e0",
    "missed_payments_3m": "CAST(FLOOR(CASE WHEN u5 < 0.55e0 THEN 0e0 ELSE 1e0 + 3e0 * ur * u5 END) AS INT)",
    "overdrawn_days_3m": "CAST(FLOOR(CASE WHEN u6 < 0.5e0 THEN 0e0 ELSE 1e0 + 40e0 * ur * u6 * u6 END) AS INT)",
    "max_dpd_12m": "CAST(FLOOR(CASE WHEN u7 < 0.6e0 THEN 0e0 ELSE 1e0 + 89e0 * ur * u7 * u7 END) AS INT)",
    "number_of_credit_inquiries_6m": "CAST(FLOOR(8e0 * (0.4e0 * ur + 0.6e0 * u8)) AS INT)",
    "salary_domiciliation": "CASE WHEN (0.4e0 * ur + 0.6e0 * u2) < 0.55e0 THEN 1 ELSE 0 END",
    "employment_status": "CASE c_mktsegment WHEN 'BUILDING' THEN 'Permanent' WHEN 'AUTOMOBILE' THEN 'Self_Employed' WHEN 'FURNITURE' THEN 'Student' WHEN 'HOUSEHOLD' THEN 'Temporary' ELSE 'Unemployed' END",
    "default_12m": "CASE WHEN 0.7e0 * ur + 0.3e0 * u9 > 0.763e0 THEN 1 ELSE 0 END",
}


def derive_applicants(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """One applicant per order; batch or streaming ``orders``, static ``customer``."""
    joined = orders.select("o_orderkey", "o_custkey").join(
        customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey")
    )
    return joined.select(
        F.col("o_orderkey").alias("k"),
        "c_mktsegment",
        *[F.expr(e).alias(n) for n, e in _UNIT_INTERVAL.items()],
    ).select(*[F.expr(e).alias(n) for n, e in _APPLICANT.items()])


def spread(df: DataFrame) -> DataFrame:
    """Deal an input of fewer splits than the session has cores to all of them.

    Only small files have so few splits; a larger input is left where it is. The
    splits are known from planning, no job is run.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def applicants_from_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Applicant view over the ``orders`` and ``customer`` tables of ``folder``."""
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_custkey")
    return derive_applicants(spread(orders), spark.read.parquet(f"{folder}/customer.parquet"))


def applicant_table(spark: SparkSession, folder: str) -> DataFrame:
    """The applicant view of ``folder`` for the operators; nothing is written or kept."""
    return nan_to_null(applicants_from_orders(spark, folder))


def applicants_sql() -> str:
    """The same view as SQL text over ``orders`` and ``customer``."""
    units = ",\n    ".join(f"{e} AS {n}" for n, e in _UNIT_INTERVAL.items())
    columns = ",\n  ".join(f"{e} AS {n}" for n, e in _APPLICANT.items())
    return (
        f"SELECT\n  {columns}\nFROM (\n  SELECT o_orderkey AS k, c_mktsegment,\n    {units}\n"
        "  FROM orders JOIN customer ON o_custkey = c_custkey\n) b"
    )


def read_applicants(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | None = APPLICANT_SCHEMA,
    **options: str,
) -> DataFrame:
    """Scan an applicant table (parquet, orc, csv or json) with an explicit schema."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        options = {"header": "true", **options}
    if schema is not None:
        reader = reader.schema(schema)
    return nan_to_null(reader.options(**options).load(path))


def write_snapshot(df: DataFrame, path: str) -> DataFrame:
    """Write an untouched audit copy and return it as a table of its own."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_shape(df: DataFrame) -> DataFrame:
    """``(position, column, type, n_rows)`` of every column, from one count."""
    fields = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
        )
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return (
        df.agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.explode(F.array(*fields)).alias("f"), "n_rows")
        .select("f.position", "f.column", "f.type", "n_rows")
    )


def preview(df: DataFrame, n: int, order_by: str) -> DataFrame:
    """First ``n`` rows in an explicit order (a top-k, not a full sort)."""
    return df.orderBy(order_by).limit(n)
