"""Operator 13: features against plain counts, and held-out accuracy."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scoreloom.llm import quality as Q
from scoreloom.llm.queries import held_out

DOCS = "doc_id long, text string, id string, score string, good string, features string, at string"
TEXTS = [None, "", "a", "A b", "two  words\n\nlines here\nlines here\r\n", "über 12 naïve!!", "x" * 5000, "\n", "|||| a| b%%% c&&&", "a.b,c;(d)"]


def plain_features(text):
    data = (text or "").encode()
    of = {b: k for k, chars in enumerate(Q._CLASSES) for b in chars.encode()}
    kinds = [Q._OTHER + 1 if b >= 0x80 else of.get(b, Q._OTHER) for b in data]
    pairs = Counter(zip(kinds, kinds[1:]))
    out = [math.sqrt(pairs[i, j] / max(len(kinds) - 1, 1)) for i in range(Q._N) for j in range(Q._N)]
    words = [w for w in "".join(c if c not in " \t\n\r\x0b\x0c" else " " for c in text or "").split(" ") if w]
    sizes = [len(w.encode()) for w in words]
    lines = [x for x in (text or "").replace("\r", "\n").split("\n") if x]
    n = max(len(words), 1)
    return out + [
        math.log1p(len(words)) / 5, min(sum(sizes) / n / 5, 3), sum(s <= 3 for s in sizes) / n, sum(s >= 12 for s in sizes) / n,
        len(set(words)) / n, len(lines) / n, len(set(lines)) / max(len(lines), 1),
    ]


def test_features_equal_plain_counts():
    got = np.concatenate(list(Q.text_features(pa.array(TEXTS))))
    assert got.shape == (len(TEXTS), Q.N_FEATURES)
    assert np.allclose(got, [plain_features(t) for t in TEXTS])
    assert list(Q.text_features(pa.array([], pa.string()))) == []


def test_best_quantile_parts_the_labels():
    strengths, good = np.array([1.0, 2.0, 3.0, 10.0, 11.0, 12.0, 13.0]), np.array([0, 0, 0, 1, 1, 1, 1])
    assert 3 < Q.best_quantile(strengths, good) <= 10
    noisy = np.array([0, 1, 0, 1, 1, 0, 1])
    cut = Q.best_quantile(strengths, noisy)
    score = ((strengths >= cut) & (noisy == 1)).sum() / 4 + ((strengths < cut) & (noisy == 0)).sum() / 3
    every = [((strengths >= c) & (noisy == 1)).sum() / 4 + ((strengths < c) & (noisy == 0)).sum() / 3 for c in np.linspace(0, 14, 200)]
    assert score == pytest.approx(max(every))


def corpus(n=400):
    rng = random.Random(1)
    words = ["ther", "heanes", "ndha", "erretion", "an", "ing", "edble", "of", "the"]
    rows = []
    for i in range(n):
        good = rng.random() < 0.7
        chosen = [rng.choice(words) for _ in range(rng.randrange(20, 200))]
        rows.append((i, " ".join(chosen) + "." if good else rng.choice([" | ", "%%% ", "!! "]).join(chosen), int(good)))
    return rows


def test_held_out_documents(spark):
    rows = corpus()
    odd = [(900, None), (901, ""), (None, "the ther"), (902, " \n "), (3, "one | two"), (3, "one | two"), (903, "the of " * 60_000)]
    docs = spark.createDataFrame([(i, t, "i", "s", "g", "f", "a") for i, t in [(i, t) for i, t, _ in rows] + odd], DOCS)
    labels = spark.createDataFrame([(i, q, 7) for i, _, q in rows] + [(None, 1, 7), (5, None, 7), (6, 9, 7), (900, 0, 7)], "doc_id long, quality int, text int")
    held = held_out(parts=4, part=2)
    model = Q.train_quality(docs, labels.where(~held))
    got = Q.quality_scores(docs, model).withColumn("held", held).collect()
    assert len(got) == len(rows) + len(odd)
    truth = {i: q for i, _, q in rows}
    unseen = [r for r in got if r.held and r.doc_id in truth]
    assert len(unseen) > 60 and sum(r.predicted == truth[r.doc_id] for r in unseen) >= 0.97 * len(unseen)
    assert all(0 <= r.score <= 1 and (r.score >= 0.7) == (r.predicted == 1) for r in got)
    alike = {r.score for r in got if r.doc_id in (900, 901)}
    assert len(alike) == 1
    again = Q.quality_scores(docs, Q.train_quality(docs, labels.where(~held))).select("doc_id", F.round("score", 9)).collect()
    assert sorted(map(repr, map(tuple, again))) == sorted(repr((r.doc_id, round(r.score, 9))) for r in got)


def test_without_two_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    for some in (labels, labels.limit(0)):
        rows = Q.quality_scores(docs, Q.train_quality(docs, some)).collect()
        assert {(r.strength, r.predicted) for r in rows} == {(0.0, 1)}
    assert Q.quality_scores(docs.limit(0), Q.train_quality(docs.limit(0), labels)).count() == 0


@pytest.mark.parametrize("small", [1_000_000, 100])
def test_every_labelled_text_is_learned_from(spark, monkeypatch, small):
    """30,000 texts, of which the first 12,000 by hash of their id say the opposite of the others."""
    monkeypatch.setattr(Q, "SMALL_GROUP_ROWS", small)
    docs = spark.range(30_000).selectExpr("id AS doc_id", "concat(if(id % 2 = 0, 'aa aa aa', '11 11 11'), repeat(' b', cast(id % 5 AS int))) AS text")
    order = docs.selectExpr("doc_id", "row_number() OVER (ORDER BY xxhash64(doc_id), doc_id) AS at")
    # Among the first even ids are bad, among the others good.
    labels = order.selectExpr("doc_id", "cast(if(at <= 12000, doc_id % 2, 1 - doc_id % 2) AS int) AS quality")
    scores = Q.quality_scores(docs, Q.train_quality(docs, labels)).groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.avg("predicted").alias("p")).collect()
    assert {r.odd: r.p for r in scores} == {0: 1.0, 1: 0.0}


@pytest.mark.parametrize("few", [1, 3, 700])
def test_all_texts_take_part(spark, few):
    """Also where one side is rare: every text of the commoner one in two pairs, each of the other in some."""
    n = 5_000
    row = [0.0] * Q.N_FEATURES
    data = [(int(i < few), i, (np.array([i, *row[1:]], np.float32)).tobytes()) for i in range(n + few)]
    found = spark.createDataFrame(data, "good int, key long, features binary").withColumn("key", F.xxhash64("key"))
    # The first feature of a pair is the number of the better text minus that of the worse.
    pairs = [(r.wins, r.d) for r in Q.preferences(found, {0: n, 1: few}).selectExpr("wins", "difference[0] AS d").collect()]
    assert len(pairs) == 2 * n and {w for w, _ in pairs} == {0, 1}
    assert all((d < 0) == (w == 1) for w, d in pairs)
    if few == 1:
        assert sorted(abs(d) for _, d in pairs) == [float(i) for i in range(1, n + 1) for _ in (0, 1)]


def test_the_cut_equals_the_plain_one():
    rng = np.random.default_rng(3)
    good = rng.integers(0, 2, 5_000)
    strengths = rng.normal(size=5_000) + good
    cut = Q.best_quantile(strengths, good)
    every = [((strengths >= c) & (good == 1)).sum() / good.sum() + ((strengths < c) & (good == 0)).sum() / (1 - good).sum() for c in np.quantile(strengths, np.arange(1, 1000) / 1000)]
    told = ((strengths >= cut) & (good == 1)).sum() / good.sum() + ((strengths < cut) & (good == 0)).sum() / (1 - good).sum()
    assert told == pytest.approx(max(every))
