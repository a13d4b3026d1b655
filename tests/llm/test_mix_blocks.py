"""The mix against plain Python: shards, quotas, block order and taken words."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from scoreloom.llm.mixing import apportion, mix_sources

WEIGHTS, SEED = (3, 1, 2), 7


def highest_quotients(votes: list[float], seats: int) -> list[int]:
    won = [0] * len(votes)
    for _ in range(seats if any(votes) else 0):
        won[max(range(len(votes)), key=lambda i: (votes[i] / (2 * won[i] + 1), -i))] += 1
    return won


def plain_targets(sizes: list[int]) -> list[float]:
    weights = [WEIGHTS[i % 3] for i in range(len(sizes))]
    full, words = set(), 1.5 * sum(sizes)
    while True:
        left = words - sum(2 * sizes[i] for i in full)
        open_ = [i for i in range(len(sizes)) if i not in full]
        level = left / sum(weights[i] for i in open_) if open_ else 0
        over = {i for i in open_ if level * weights[i] > 2 * sizes[i]}
        if not over:
            return [2.0 * sizes[i] if i in full else level * weights[i] for i in range(len(sizes))]
        full |= over


def plain_mix(spark, rows, block, shard_words):
    """``rows`` are ``(id, source, size)``; hashes are Spark's, all else is done here."""
    numbered, seen = [], Counter()
    for row in rows:
        seen[row] += 1
        numbered.append((*row, seen[row]))
    table = spark.createDataFrame(numbered, "id long, source string, size long, copy long")
    hashed = [tuple(r) for r in table.select("*", F.xxhash64(F.lit(SEED), "id", "size", "copy")).collect()]
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is None, s or ""))
    sizes = [sum(r[2] for r in rows if r[1] == s) for s in sources]
    targets = plain_targets(sizes)
    quotas = highest_quotients(targets, int(sum(targets) / block + 0.5))
    out = []
    for source, source_size, target, quota in zip(sources, sizes, targets, quotas):
        n_shards = max(1, -(-source_size // shard_words))
        shards = defaultdict(list)
        for id_, s, size, copy, h in hashed:
            if s == source:
                shards[h % n_shards].append((h, (id_ is not None, id_ or 0), size, copy, id_))
        names = sorted(shards)
        shard_sizes = [sum(r[2] for r in shards[i]) for i in names]
        for name, shard_size, blocks in zip(names, shard_sizes, highest_quotients(shard_sizes, quota)):
            n = max(1, -(-shard_size // block))
            blocks = min(blocks, 2 * n)
            order = spark.range(n).select(F.xxhash64(F.lit(SEED), F.lit(source), F.lit(name).cast("long"), "id"), "id").collect()
            extra = {b for _, b in sorted(map(tuple, order))[: blocks % n]}
            at = 0
            for _, _, size, _, id_ in sorted(shards[name], key=lambda r: r[:4]):
                taken = sum(blocks // n + ((at + i) // block in extra) for i in range(size))
                out.append((id_, size, source_size, round(target, 6), taken))
                at += size
    return out


def test_mix_equals_plain_python(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "b", "b", "c", None]), rng.randrange(0, 60)) for i in range(300)]
    rows += [(None, "b", 12)] * 40 + [(7, "a", 9)] * 5 + [(900, "c", 3_000), (901, "d", 0)]
    docs = spark.createDataFrame([(i, s, " ".join(["w"] * n)) for i, s, n in rows], "doc_id long, source string, text string")
    got = mix_sources(docs, block=8, shard_words=700)
    got = [(r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in got.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, plain_mix(spark, rows, 8, 700)))


def test_rows_without_id_are_spread(spark):
    docs = spark.createDataFrame([(None, "a", "w " * 10)] * 2_000, "doc_id long, source string, text string")
    got = mix_sources(docs, block=8, shard_words=500, share=1.5)
    assert got.count() == 2_000
    assert abs(got.agg(F.sum("taken")).first()[0] - 30_000) <= 8 * 40


def test_quotas_of_many_parties(spark):
    votes = [(i % 3, i, (i * 7919) % 97 + 1) for i in range(3_000)]
    parties = spark.createDataFrame(votes, "g long, i long, v long").withColumn("seats", F.lit(5_003).cast("long"))
    got = apportion(parties.repartition(5), ["g"], "v", "seats", [F.col("i")])
    quotas = {r.i: r.quota for r in got.collect()}
    for g in range(3):
        ids = [i for x, i, _ in votes if x == g]
        won = highest_quotients([v for x, _, v in votes if x == g], 5_003)
        assert [quotas[i] for i in ids] == won


def test_no_window_over_all_shards(spark):
    parties = spark.range(10).selectExpr("id % 2 as g", "id as i", "id as v", "3L as seats")
    plan = apportion(parties, ["g"], "v", "seats", [F.col("i")])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("__range" in line for line in windows)
