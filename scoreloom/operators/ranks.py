"""Exact positions in hash order, without ranking the table, for any number of strata.

Splits and folds need to know which rows are among the first k of their class in
the order of ``md5(id:seed)``. The hash that closes the first k is found by
counting hash prefixes (a fixed number of groups per class and pass), so membership
is a comparison with one value per class: the rows themselves are never sorted.
Sizes, buckets and closing hashes are tables; the driver reads one number per pass.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.functions.columns import name, when_class
from scoreloom.storage import written

PREFIX_DIGITS = 3  # 4096 counted groups per class and pass
HASH_DIGITS = 32
SMALL_BUCKET_ROWS = 1_000_000
FEW_CLASSES = 100


def row_hash(id_column: str, seed: int) -> Column:
    """Order-defining hash of a row: 32 hex digits."""
    return F.md5(F.concat(F.col(id_column).cast("string"), F.lit(f":{seed}")))


def stratum_sizes(df: DataFrame, stratum: str) -> DataFrame:
    """``(stratum, n)`` of every class; rows without a class belong to none."""
    sizes = df.where(F.col(stratum).isNotNull()).groupBy(F.col(stratum).alias("stratum"))
    return written(sizes.agg(F.count(F.lit(1)).alias("n")), "stratum-sizes")


def cut_table(
    df: DataFrame,
    id_column: str,
    stratum: str,
    positions: DataFrame,
    seed: int,
    small_bucket_rows: int = SMALL_BUCKET_ROWS,
) -> DataFrame:
    """``(stratum, position, last)``: the hash of the row at each wanted 1-based position.

    ``positions`` is a table ``(stratum, position)``. A position of 0 has the empty
    string, which no hash is below. The id must be unique; copies of an id share a
    hash and stay together.
    """
    hashed = df.where(F.col(stratum).isNotNull()).select(
        F.col(stratum).alias("stratum"), row_hash(id_column, seed).alias("h")
    )
    positions = positions.select("stratum", F.col("position").cast("long").alias("position"))
    cuts = positions.where("position > 0").selectExpr("stratum", "position", "'' AS prefix", "0L AS below")
    done = 0
    while True:
        digits = min(done + PREFIX_DIGITS, HASH_DIGITS)
        cuts = written(_descended(hashed, cuts, done, digits), "cuts")
        done, most = digits, cuts.agg(F.max("rows")).first()[0]
        if most is None or most <= small_bucket_rows or done == HASH_DIGITS:
            break
    closed = _descended(hashed, cuts, done, HASH_DIGITS)
    none = positions.where("position <= 0").select("stratum", "position", F.lit("").alias("last"))
    return closed.select("stratum", "position", F.col("prefix").alias("last")).unionByName(none)


def _descended(hashed: DataFrame, cuts: DataFrame, done: int, digits: int) -> DataFrame:
    """Each cut ``(stratum, position, prefix, below)`` in the bucket of more digits that holds its position."""
    rows = hashed.withColumn("prefix", F.substring("h", 1, done))
    if done:
        rows = rows.join(cuts.select("stratum", "prefix").distinct(), ["stratum", "prefix"], "left_semi")
    counted = rows.groupBy("stratum", "prefix", F.substring("h", 1, digits).alias("next")).agg(F.count(F.lit(1)).alias("rows"))
    # At most 4096 counted rows per bucket, or as many as a small bucket has.
    through = F.sum("rows").over(W.partitionBy("stratum", "prefix").orderBy("next"))
    return (
        cuts.select("stratum", "position", "prefix", "below")
        .join(counted.withColumn("through", through), ["stratum", "prefix"])
        .where("below + through >= position AND below + through - rows < position")
        .selectExpr("stratum", "position", "next AS prefix", "below + through - rows AS below", "rows")
    )


def passed_cuts(df: DataFrame, id_column: str, stratum: str, cuts: DataFrame, seed: int, column: str) -> DataFrame:
    """Add ``column``: how many cuts of its class a row's hash is beyond; null without a class.

    The cuts of a few classes are written into the expression, so that the rows stay
    where they are; those of many classes are joined, one row per class.
    """
    listed = cuts.groupBy("stratum").agg(F.sort_array(F.collect_list("last")).alias("ends"))
    few = listed.limit(FEW_CLASSES + 1).collect()
    hashed = df.withColumn("row_hash", row_hash(id_column, seed))
    if len(few) <= FEW_CLASSES:
        most = max((len(r["ends"]) for r in few), default=0)
        ends = ", ".join(when_class(stratum, {r["stratum"]: r["ends"][i] for r in few if i < len(r["ends"])}) for i in range(most))
        beyond = F.expr(f"size(filter(array({ends}), last -> last < row_hash))") if most else F.lit(0)
        return hashed.withColumn(column, F.when(F.col(stratum).isNotNull(), beyond)).drop("row_hash")
    listed = written(listed, "class-ends").withColumnRenamed("stratum", "cut_stratum")
    matched = hashed.join(listed, F.col(stratum) == F.col("cut_stratum"), "left")
    beyond = F.expr(f"CASE WHEN {name(stratum)} IS NOT NULL THEN size(filter(ends, last -> last < row_hash)) END")
    return matched.withColumn(column, beyond).drop("row_hash", "cut_stratum", "ends")


def hash_cuts(
    df: DataFrame,
    id_column: str,
    stratum: str,
    positions: Callable[[Mapping[object, int]], Mapping[object, Sequence[int]]],
    seed: int,
    small_bucket_rows: int = SMALL_BUCKET_ROWS,
) -> dict[object, list[str]]:
    """``cut_table`` for a few classes, read to the driver; ``positions`` gets their sizes."""
    wanted = positions({r["stratum"]: r["n"] for r in stratum_sizes(df, stratum).collect()})
    table = df.sparkSession.createDataFrame(
        [(s, p) for s, ps in wanted.items() for p in ps], f"stratum {dict(df.dtypes)[stratum]}, position long"
    )
    rows = cut_table(df, id_column, stratum, table, seed, small_bucket_rows).collect()
    found = {(r["stratum"], r["position"]): r["last"] for r in rows}
    return {s: [found[s, p] for p in ps] for s, ps in wanted.items()}
