from __future__ import annotations

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scoreloom.llm import words as W
from scoreloom.llm.jaccard_join import packed, prefix_length, shingle_sets, signature, unpacked
from scoreloom.llm.repeats import anchor_places
from scoreloom.llm.scratch import bitmap, has_bit, scratch_table

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbé \n\t-9", max_size=30)), max_size=12)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.sampled_from([1, 7, 1 << 20]))
def test_words_are_those_of_each_text(texts, limit):
    column = pa.array(["x", *texts], pa.string()).slice(1)
    seen, names = {}, {}
    for first, data, offsets in W.text_slices(column, limit):
        inside, starts, ends, of = W.word_spans(data, offsets, W.NOT_SPACE)
        hashes = W.word_hashes(data, inside, starts, ends, W.LOWER)
        for i in range(len(offsets) - 1):
            seen[first + i] = hashes[of == i]
    assert sorted(seen) == list(range(len(texts)))
    for i, text in enumerate(texts):
        words = brute.SPACE_WORD.findall((text or "").translate(brute.LOWER))
        assert len(words) == len(seen[i])
        for word, h in zip(words, seen[i].tolist()):
            assert names.setdefault(word, h) == h
    assert len(set(names.values())) == len(names)


@settings(max_examples=40, deadline=None)
@given(TEXTS)
def test_shingle_sets_have_the_sizes_of_real_sets(texts):
    sets = list(shingle_sets(pa.array(texts, pa.string()), 3))
    assert [len(s) for s in sets] == [len(brute.shingles(t, 3)) for t in texts]
    assert all((np.diff(s.astype(object)) > 0).all() for s in sets)


def test_signature_bounds_the_overlap_and_sets_survive_packing():
    rng = np.random.default_rng(2)
    pool = np.unique(W.mix(np.arange(3000, dtype=np.uint64)))
    for _ in range(50):
        x, y = (np.sort(rng.choice(pool, rng.integers(1, 900), replace=False)) for _ in range(2))
        a, b = (np.frombuffer(signature(s), np.uint8).astype(int) for s in (x, y))
        assert np.minimum(a, b).sum() >= len(np.intersect1d(x, y))
        assert (unpacked(packed(x)) == x >> np.uint64(16)).all()
    assert signature(np.arange(0, 256 * 128, 128, dtype=np.uint64)) is None


@pytest.mark.parametrize("percent", [50, 80, 85, 100])
def test_prefixes_of_similar_sets_meet(percent):
    for n in range(1, 200):
        need = -(-percent * n // 100)
        assert prefix_length(n, percent) == n - need + 1 >= 1


def test_anchors_of_a_passage_are_the_same_anywhere():
    rng = np.random.default_rng(3)
    passage = rng.integers(0, 50, 60).astype(np.uint64)
    found = set()
    for n in (0, 1, 13, 40):
        grams = np.concatenate((rng.integers(0, 50, n).astype(np.uint64), passage, rng.integers(0, 50, n).astype(np.uint64)))
        places = anchor_places(grams, np.zeros(len(grams) + 3, np.int64), 10) - n
        found.add(tuple(p for p in places.tolist() if 9 <= p < 51))
        assert (np.diff(places) <= 10).all()
    assert len(found) == 1


def test_bitmap_never_forgets(spark):
    df = spark.range(5000).select(F.xxhash64("id").alias("k"))
    bits = bitmap(df, F.col("k"), 1 << 20)
    assert len(bits) == 1 << 17
    keys = np.array([r.k for r in df.collect()], np.int64).view(np.uint64)
    assert has_bit(bits, keys).all()
    others = W.mix(np.arange(100_000, dtype=np.uint64))
    assert has_bit(bits, others).mean() < 0.01
    assert not bitmap(df.limit(0), F.col("k"), 1 << 16).any()


def test_scratch_tables_keep_rows_and_schema(spark):
    df = spark.createDataFrame([(1, None, [1.0]), (None, "x", None)], "a long, b string, c array<double>")
    again = scratch_table(df, "test")
    assert again.schema == df.schema and sorted(map(repr, again.collect())) == sorted(map(repr, df.collect()))
