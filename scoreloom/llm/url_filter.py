"""URL filters: host and path rules, and trust and distrust propagated over host links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.scratch import scratch_table
from scoreloom.storage import new_path

ALLOW, BLOCK = "allow", "block"
# More rules than these are joined as a table.
FEW_RULES = 1_000
# Parts of a hot host in joins with rules.
SALTS = 32
LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s<>]+)"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_after_scheme(url), r"\A[^/?#]*", 0)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """``struct<rule, verdict>`` of the longest fitting rule ``(verdict, host, path)``, else null.

    A rule fits its host and all subdomains if the path starts with the rule's.
    Of equally long ones a blocking rule wins, then the one of the longest host.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == BLOCK, len(r[1]))):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def rules_joined(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``(host, path, __rule)`` of each distinct ``(host, path)`` that a rule of the table fits, see ``rule_of``.

    ``rules`` are ``(verdict, host, path)``, any number of them; those with a null
    fit nothing. The ends of a host, at most as many labels as a rule has, meet the
    lengths of the paths in rules of that host, and the path's beginnings of these
    lengths meet the rules. Both joins are on equality, and hosts of many urls are salted.
    """
    rules = scratch_table(rules.select("verdict", "host", "path").dropna().distinct(), "urls-rules")
    labels = F.size(F.split("host", r"\."))
    deepest = rules.agg(F.max(labels)).first()[0] or 0
    salted = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    lengths = rules.groupBy("host").agg(F.collect_set(F.length("path")).alias("lengths"))
    lengths = lengths.select(F.col("host").alias("end"), "lengths", salted)
    known = rules.select(F.col("host").alias("end"), F.col("path").alias("begin"), "verdict", salted)
    ends = f"""transform(
      sequence(1, least(size(split(host, r'\\.')), {deepest})),
      n -> substring_index(host, '.', -n))"""
    urls = urls.select("host", "path").distinct().withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int"))
    ended = urls.where(F.lit(deepest) > 0).withColumn("end", F.explode(F.expr(ends))).join(lengths, ["end", "salt"])
    begun = ended.withColumn("length", F.explode("lengths")).where("length <= length(path)")
    begun = begun.withColumn("begin", F.expr("substring(path, 1, length)"))
    fits = begun.join(known, ["end", "begin", "salt"]).groupBy("host", "path").agg(
        F.max(
            F.struct(
                (F.length("end") + F.length("begin")).alias("n"), (F.col("verdict") == BLOCK).alias("blocks"), F.length("end").alias("m"),
                F.concat("end", "begin").alias("rule"), "verdict",
            )
        ).alias("best")
    )
    return fits.select("host", "path", F.struct(F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict")).alias("__rule"))


def host_edges(pages: DataFrame, host: str, html: str) -> DataFrame:
    """``(source, target, weight)``: how many links pages of one host have to another."""
    links = F.array_distinct(F.regexp_extract_all(F.col(html), F.lit(LINK), 1))
    target = host_of(F.concat(F.lit("x:"), F.regexp_replace("link", r"\A[^/]*", "")))
    return (
        pages.select(F.col(host).alias("source"), F.explode(links).alias("link"))
        .select("source", target.alias("target"))
        .where("source <> target and source <> '' and target <> ''")
        .groupBy("source", "target")
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )


def passed_on(parts: DataFrame, brought: DataFrame, damping: float) -> DataFrame:
    """``(host, score)`` that one round passes along ``(source, target, part)`` from what the last one brought.

    Hosts meet by a shuffle: a broadcast would bring the scores of every round to the driver.
    """
    passed = parts.hint("merge").join(brought.hint("merge"), parts["source"] == brought["host"]).select(
        F.col("target").alias("host"), (F.col("score") * F.col("part") * damping).alias("score")
    )
    return passed.groupBy("host").agg(F.sum("score").alias("score"))


def personal_rank(edges: DataFrame, seeds: DataFrame, damping: float, tolerance: float) -> DataFrame:
    """``(host, score)``: personalised PageRank from ``(host, seed)`` along ``(source, target, weight)``.

    A host keeps ``1 - damping`` of its seed and gets ``damping`` of what its
    linking hosts pass on, each in proportion to its links. What a host without
    links would pass on is lost.

    Each round passes on what the last one brought. All that is still to come is at
    most ``damping / (1 - damping)`` of that, over all hosts together; the rounds
    end when this is ``tolerance`` or less, so no score lacks more. Every round
    has at most ``damping`` of the last one's sum, which bounds their number.
    """
    if not 0 <= damping < 1 or tolerance <= 0:
        raise ValueError("damping must be below 1, tolerance above 0")
    out = edges.groupBy("source").agg(F.sum("weight").alias("all"))
    parts = scratch_table(
        edges.hint("merge").join(out.hint("merge"), "source").select("source", "target", (F.col("weight") / F.col("all")).alias("part")), "rank-parts"
    )
    kept = seeds.select("host", (F.col("seed") * (1 - damping)).alias("score"))
    if parts.isEmpty():
        return kept
    spark, folder, rounds = edges.sparkSession, new_path(edges.sparkSession, "rank-brought"), []
    brought = kept
    while True:
        rounds.append(f"{folder}/{len(rounds)}")
        brought.write.parquet(rounds[-1])
        brought = spark.read.schema(kept.schema).parquet(rounds[-1])
        if (brought.agg(F.sum("score")).first()[0] or 0.0) * damping / (1 - damping) <= tolerance:
            break
        brought = passed_on(parts, brought, damping)
    return spark.read.schema(kept.schema).parquet(*rounds).groupBy("host").agg(F.sum("score").alias("score"))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] | DataFrame,
    threshold: float = 0.02,
    majority: float = 0.5,
    damping: float = 0.85,
    tolerance: float = 1e-6,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """``(<id>, host, path, rule, verdict, trust, distrust)`` of every row of ``pages``.

    ``rules`` are a list or, for any number, a table of ``(verdict, host, path)``.
    A url that a rule fits has the verdict of the longest one. Hosts with more
    than ``majority`` of their pages allowed by rules are trusted seeds, with as
    many blocked they are blocked seeds, of a weight of that part. Trust flows
    along the links between hosts, distrust against them, from a host to those that
    link to it, until no score lacks more than ``tolerance``. Where no rule fits, a
    url is blocked if the distrust of its host is at least ``threshold`` and above
    its trust, else allowed.

    Null urls and urls without ``://`` have an empty host and path, fit no rule
    and are allowed; null html has no links. Repeated rows count each.
    """
    read = pages.select(
        F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"),
        F.col(html_col).cast("string").alias("__html"),
    )
    if not isinstance(rules, DataFrame) and len(rules) > FEW_RULES:
        rules = pages.sparkSession.createDataFrame(list(rules), "verdict string, host string, path string")
    if isinstance(rules, DataFrame):
        read = read.join(rules_joined(read, rules), ["host", "path"], "left")
    else:
        read = read.withColumn("__rule", rule_of(F.col("host"), F.col("path"), rules))
    judged = scratch_table(
        read.select(id_col, "host", "path", F.col("__rule.rule").alias("rule"), F.col("__rule.verdict").alias("verdict")),
        "urls-judged",
    )
    edges = scratch_table(host_edges(read, "host", "__html"), "urls-edges")
    shares = judged.where("host <> ''").groupBy("host").agg(
        *[F.avg(F.when(F.col("verdict") == v, 1.0).otherwise(0.0)).alias(v) for v in (ALLOW, BLOCK)]
    )
    shares = scratch_table(shares, "urls-shares")
    seeds = {v: shares.where(F.col(v) > majority).select("host", F.col(v).alias("seed")) for v in (ALLOW, BLOCK)}
    back = edges.select(F.col("target").alias("source"), F.col("source").alias("target"), "weight")
    trust = personal_rank(edges, seeds[ALLOW], damping, tolerance).withColumnRenamed("score", "trust")
    distrust = personal_rank(back, seeds[BLOCK], damping, tolerance).withColumnRenamed("score", "distrust")
    scores = trust.join(distrust, "host", "full")
    scored = judged.join(scores, "host", "left").na.fill(0.0, ["trust", "distrust"])
    spread = (F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust"))
    return scored.select(
        id_col, "host", "path", "rule",
        F.coalesce("verdict", F.when(spread, BLOCK).otherwise(ALLOW)).alias("verdict"),
        "trust", "distrust",
    )
