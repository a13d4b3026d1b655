import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from scoreloom.llm.repeats import repeated_passages, repeated_spans


def plain(rows, size):
    """Words inside repeated passages, and inside those that are not at their first place, by row key."""
    places = defaultdict(list)
    texts = {key: text.split() for key, text in rows if text}
    for key, found in texts.items():
        for at in range(len(found) - size + 1):
            places[tuple(found[at : at + size])].append((key, at))
    out = {}
    for where in places.values():
        if len(where) > 1:
            first = min(where)
            for key, at in where:
                both = out.setdefault(key, (set(), set()))
                both[0].update(range(at, at + size))
                if (key, at) != first:
                    both[1].update(range(at, at + size))
    return {key: (len(all_), len(later)) for key, (all_, later) in out.items()}


def texts(seed, size):
    """Passages below, at and above the size, in part twice in a text, at its ends, and with one word changed."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["the"] * 20
    said = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    shared = [said(n) for n in (size - 1, size, size + 1, 2 * size - 1, 3 * size)]
    out = [None, "", " \t", "one", " ".join(["in"] * (2 * size + 3)), " ".join(["in", "on"] * size)]
    for _ in range(150):
        parts = [said(rng.randrange(size)) if rng.random() < 0.7 else []]
        for _ in range(rng.randrange(1, 4)):
            passage = list(rng.choice(shared))
            if rng.random() < 0.3:
                passage[rng.randrange(len(passage))] = "other"
            cut = rng.randrange(len(passage) // 2) if rng.random() < 0.3 else 0
            parts += [passage[cut:], said(rng.randrange(size)) if rng.random() < 0.7 else []]
        out.append(" ".join(w for p in parts for w in p))
    return list(enumerate(out + [out[9], out[9]]))


@pytest.mark.parametrize("size, block_rows", [(20, 2_000), (50, 2_000), (20, 3), (50, 0)])
def test_equal_to_plain_windows(spark, size, block_rows):
    docs = spark.createDataFrame(texts(size, size), "doc_id long, text string").repartition(5)
    keyed = [(r.k, r.text) for r in docs.select(F.xxhash64("doc_id", "text").alias("k"), "text").collect()]
    spans = repeated_spans(docs, size, block_rows=block_rows).collect()
    covered = defaultdict(lambda: (set(), set()))
    for r in spans:
        covered[r.row_key][0].update(range(r.start, r.end))
        if not r.first:
            covered[r.row_key][1].update(range(r.start, r.end))
    assert {k: (len(a), len(b)) for k, (a, b) in covered.items()} == plain(keyed, size)


def test_report_counts_the_same_words(spark):
    docs = spark.createDataFrame(texts(3, 50), "doc_id long, text string")
    keyed = [(r.k, r.text) for r in docs.select(F.xxhash64("doc_id", "text").alias("k"), "text").collect()]
    ids = {r.k: r.doc_id for r in docs.select(F.xxhash64("doc_id", "text").alias("k"), "doc_id").collect()}
    got = {r.doc_id: (r.n_repeated, r.n_later) for r in repeated_passages(docs).collect()}
    assert got == {ids[k]: n for k, n in plain(keyed, 50).items()}


def test_colliding_suffix_keys_do_not_count(spark, monkeypatch):
    """Neither the filters' keys nor places decide: with all keys equal the result is the same."""
    import numpy as np

    import scoreloom.llm.repeats as module
    from scoreloom.llm.repeats import _Passages

    import pyarrow as pa

    sizes = _Passages(20)
    rows = texts(5, 20)
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([t for _, t in rows])], ["row_key", "text"])
    monkeypatch.setattr(module, "has_bit", lambda bits, keys: np.full(len(keys), bits.any()))
    every, none = np.full(8, 255, np.uint8), np.zeros(8, np.uint8)
    entries = pa.Table.from_batches(list(sizes.entries(every, none, every)([batch])))
    low, high = (pa.array([n] * len(entries)) for n in (0, sizes.window - 1))
    entries = entries.append_column("low", low).append_column("high", high).rename_columns({"suffix": "range"})
    entries = entries.sort_by([("range", "ascending"), ("right", "ascending")])
    covered = defaultdict(lambda: (set(), set()))
    for part in sizes.neighbours(iter(entries.to_batches(max_chunksize=37))):
        for r in part.to_pylist():
            covered[r["row_key"]][0].update(range(r["start"], r["end"]))
            if not r["first"]:
                covered[r["row_key"]][1].update(range(r["start"], r["end"]))
    assert {k: (len(a), len(b)) for k, (a, b) in covered.items()} == plain(rows, 20)
