"""Mixing sources to target weights: Sainte-Laguë quotas of equal-token blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.llm.scratch import scratch_table

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 32
SHARD_WORDS = 100_000


def _with_groups(rows: DataFrame, of: DataFrame, group: Sequence[str]) -> DataFrame:
    """``rows`` with the columns of ``of``, one row per group; null is a group like others."""
    of = of.withColumnsRenamed({c: f"__of_{c}" for c in group})
    same = F.lit(True)
    for c in group:
        same = same & rows[c].eqNullSafe(of[f"__of_{c}"])
    return rows.join(of, same, "left").drop(*[f"__of_{c}" for c in group])


def _ranked(rows: DataFrame, group: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """``rows``, written, with ``name``: the place of each one in its group by ``order``, from 1.

    Rows are dealt by ranges of group and order. A task ranks one range, and starts
    from the rows of the ranges before it, so a group may have any number of rows.
    """
    ranges = rows.repartitionByRange(*[F.col(c).asc_nulls_first() for c in group], *order)
    ranges = scratch_table(ranges.withColumn("__range", F.spark_partition_id()), "mixing-ranges")
    before = W.partitionBy(*group).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    counts = ranges.groupBy(*group, "__range").agg(F.count(F.lit(1)).alias("__here"))
    counts = counts.select(*group, "__range", F.coalesce(F.sum("__here").over(before), F.lit(0)).alias("__before"))
    here = F.row_number().over(W.partitionBy(*group, "__range").orderBy(*order))
    placed = _with_groups(ranges.withColumn("__place", here), counts, [*group, "__range"])
    return placed.withColumn(name, F.col("__place") + F.col("__before")).drop("__range", "__place", "__before")


def apportion(parties: DataFrame, group: Sequence[str], votes: str, seats: str, order: Sequence[Column]) -> DataFrame:
    """Add ``quota``: seats of each party by highest quotients votes / 1, votes / 3, votes / 5 …

    ``seats`` is the number to give away in a group. Most seats follow from a
    quotient that surely wins; the rest, at most one or two per party, are ranked
    with ties in ``order``. A party without votes gets none.
    """
    names = list(parties.columns)
    # Written, the one group of all is a column like others.
    parties = scratch_table(parties if group else parties.withColumn("__mix", F.lit(0)), "mixing-parties")
    group = list(group) or ["__mix"]
    totals = parties.groupBy(*group).agg(F.sum(votes).cast("double").alias("__total"), F.count(F.lit(1)).alias("__n"))
    sure = F.greatest(F.col(seats) - F.col("__n") / 2.0, F.lit(0.0))
    most = F.col(seats) + F.col("__n") / 2.0 + 1
    share = F.coalesce(F.col(votes).cast("double") / F.when(F.col("__total") > 0, F.col("__total")), F.lit(0.0))
    sized = _with_groups(parties, totals, group).withColumns(
        {
            "__sure": F.when(sure > 0, F.floor(share * sure + 0.5)).otherwise(0).cast("long"),
            "__most": F.when(share > 0, F.floor(share * most + 0.5) + 1).otherwise(0).cast("long"),
        }
    ).drop("__total", "__n")
    rests = sized.groupBy(*group).agg((F.max(seats) - F.sum("__sure")).alias("__rest"))
    offered = sized.withColumn(
        "__k", F.explode_outer(F.when(F.col("__most") > F.col("__sure"), F.sequence("__sure", F.col("__most") - 1)))
    ).withColumn("__quotient", F.col(votes) / (2 * F.col("__k") + 1))
    ranked = _ranked(offered, group, [F.col("__quotient").desc_nulls_last(), *order, F.col("__k").asc()], "__rank")
    won = ((F.col("__rank") <= F.col("__rest")) & F.col("__k").isNotNull()).cast("long")
    won = _with_groups(ranked, rests, group).groupBy(*names, "__sure").agg(F.sum(won).alias("__won"))
    return won.select(*names, (F.col("__sure") + F.col("__won")).alias("quota"))


def source_targets(sizes: DataFrame, source: str, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """``(<source>, source_size, weight, target)`` from the size of each source.

    Sources in code-point order, null last, take the weights in turn. ``share`` of
    all words is dealt by weight; a target stops at ``most`` times the size of its
    source, and what is over goes to the others by weight until none is above.
    """
    alone = W.partitionBy(F.lit(0))
    order = alone.orderBy(F.col(source).asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    known = sizes.withColumn(
        "weight", F.element_at(cycle, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    ).withColumn("__limit", F.col("source_size") * float(most))
    # In the order of limit / weight the first sources are full and the others share the rest.
    full_first = alone.orderBy(F.col("__limit") / F.col("weight"), F.col(source).asc_nulls_last())
    before = full_first.rowsBetween(W.unboundedPreceding, -1)
    known = known.withColumns(
        {
            "__words": F.sum("source_size").over(alone) * float(share),
            "__given": F.coalesce(F.sum("__limit").over(before), F.lit(0.0)),
            "__weights": F.sum("weight").over(alone) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        }
    ).withColumn("__level", (F.col("__words") - F.col("__given")) / F.col("__weights"))
    fits = F.col("__level") * F.col("weight") <= F.col("__limit")
    level = F.first(F.when(fits, F.col("__level")), ignorenulls=True).over(
        full_first.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    )
    return known.withColumn("__final", level).select(
        source,
        "source_size",
        "weight",
        F.least("__limit", F.coalesce(F.col("__final") * F.col("weight"), F.col("__limit"))).alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    seed: int = 7,
    block: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``(<id>, size, source_size, target, taken)`` of every row of ``docs``.

    ``size`` counts the words (runs of other than white space) of the whole text,
    0 for null; ``taken`` is how many of them the mix takes, repeats counted, at
    most ``most`` times the size. Sources: see ``source_targets``; null is a
    source of its own, and one without words gets nothing.

    The words of a source are dealt to shards by a seeded hash of the row and cut
    into blocks of ``block`` words. Blocks are given to sources by highest
    quotients of the targets, and those of a source to its shards by highest
    quotients of their sizes. A shard takes all its blocks as often as its quota
    allows, and once more those of the least seeded hashes. Equal
    input gives equal output. Rows equal in id, source and size are numbered, so
    that they are dealt to different shards and may be taken differently.
    """
    base = docs.select(
        F.col(id_col).alias("__id"),
        F.col(source_col).cast("string").alias("__source"),
        F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    base = base.groupBy("__id", "__source", "size").agg(F.count(F.lit(1)).alias("__copies"))
    base = scratch_table(
        base.select("__id", "__source", "size", F.explode(F.sequence(F.lit(1).cast("long"), "__copies")).alias("__copy")), "mixing-sizes"
    )
    sizes = base.groupBy("__source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, "__source", weights, share, most)
    blocks = F.round(F.sum("target").over(W.partitionBy(F.lit(0))) / block).cast("long")
    by_source = [F.col("__source").asc_nulls_last()]
    sources = apportion(targets.withColumn("__blocks", blocks), [], "target", "__blocks", by_source)
    sources = scratch_table(
        sources.select(
            "__source", "source_size", "target", F.col("quota").alias("source_quota"),
            F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1)).cast("long").alias("n_shards"),
        ),
        "mixing-sources",
    )
    dealt = base.withColumn("__h", F.xxhash64(F.lit(seed), "__id", "size", "__copy")).join(
        sources, base["__source"].eqNullSafe(sources["__source"])
    ).select(
        "__id", base["__source"].alias("__source"), "size", "source_size", "target", "source_quota", "__h", "__copy",
        F.pmod("__h", "n_shards").alias("shard"),
    )
    axis = W.partitionBy("__source", "shard").orderBy("__h", "__id", "size", "__copy").rowsBetween(W.unboundedPreceding, -1)
    placed = scratch_table(dealt.withColumn("start", F.coalesce(F.sum("size").over(axis), F.lit(0))), "mixing-placed")
    shards = placed.groupBy("__source", "shard", "source_quota").agg(F.sum("size").alias("shard_size"))
    quotas = apportion(shards, ["__source"], "shard_size", "source_quota", [F.col("shard")])
    n = F.greatest(F.ceil(F.col("shard_size") / block), F.lit(1)).cast("long")
    quotas = quotas.withColumn("n", n).select(
        F.col("__source").alias("__s"), F.col("shard").alias("__shard"), "n", F.least("quota", F.col("n") * most).alias("quota"),
    )
    # The blocks taken once more are those up to the last one that the quota reaches.
    hashed = f"struct(xxhash64({int(seed)}, __s, __shard, b) as h, b as b)"
    last = F.expr(f"get(array_sort(transform(sequence(0L, n - 1), b -> {hashed})), cast(quota % n as int) - 1)")
    quotas = scratch_table(quotas.withColumn("__last", last), "mixing-quotas")
    joined = placed.join(quotas, placed["__source"].eqNullSafe(quotas["__s"]) & (placed["shard"] == quotas["__shard"]))
    taken = F.expr(
        f"""aggregate(
          if(size > 0, sequence(start div {block}, (start + size - 1) div {block}), array()), 0L,
          (sum, b) -> sum + (least(start + size, (b + 1) * {block}) - greatest(start, b * {block}))
            * (quota div n + if(coalesce({hashed} <= __last, false), 1L, 0L)))"""
    )
    return joined.select(F.col("__id").alias(id_col), "size", "source_size", "target", taken.alias("taken"))
