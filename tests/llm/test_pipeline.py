"""The pipeline over a small corpus, stage by stage against plain Python."""

from __future__ import annotations

import random
from collections import defaultdict

import brute
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string"
INSULTS = ("moron", "scumbag", "vileness")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    vocabulary = [a + b + c for a in "bdfgklmnprst" for b in "aeiou" for c in ("na", "ro", "til", "ves")]

    def prose(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    items = [" ".join(prose(30)) for _ in range(6)]
    rows, labels = [], []
    for i in range(300):
        text = prose(rng.randrange(30, 90))
        kind = i % 10
        if kind == 0:
            for word in INSULTS:
                text.insert(rng.randrange(len(text)), word)
        elif kind == 1 and i > 20:
            text = rows[i - 20][1].split()[:-1] + ["end"]
        elif kind == 2:
            text[5:5] = items[i % 6].split()[4:18]
        elif kind == 3:
            text.insert(3, f"password={rng.getrandbits(64):016x}")
        rows.append((i, " ".join(text), "en", rng.choice(["a", "b", None]), 0, "x"))
        if i % 3:
            labels.append((i, 1, int(kind == 0)))
    rows += [(400, None, "en", "a", None, "x"), (401, "", "en", "a", 0, "x"), rows[14], (None, "some text", "en", "b", 9, "x")]
    path = tmp_path_factory.mktemp("corpus")
    tables = {
        "documents": (rows, SCHEMA),
        "labels": (labels, "doc_id long, quality int, toxic int"),
        "benchmark": (list(enumerate(items)), "item_id long, text string"),
    }
    for name, (data, schema) in tables.items():
        df = spark.createDataFrame(data, schema)
        if name == "documents":
            df = df.withColumn("n_chars", F.coalesce(F.length("text"), "n_chars").cast("long"))
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path), items


def test_stages(spark, folder):
    path, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    given = docs.collect()
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["toxicity", "near_duplicates", "decontamination", "secrets", "mixing"]

    def step(name, rows):
        df = spark.createDataFrame(rows, docs.schema)
        out = stage[name](spark, df, path)
        assert out.columns == df.columns and out.dtypes == df.dtypes
        return out.collect()

    kept = step("toxicity", given)
    toxic = {r for r in given if r.text and any(w in r.text.split() for w in INSULTS)}
    assert sorted(map(repr, kept)) == sorted(repr(r) for r in given if r not in toxic)

    found = brute.jaccard([(r.doc_id, r.text) for r in kept], 5, 80)
    expected = [r for r, (i, n, c) in zip(kept, found) if not n]
    expected += dict.fromkeys(r for r, (i, n, c) in zip(kept, found) if n and (i is None or i == c))  # repeated rows once
    assert len(expected) < len(kept)
    unique = step("near_duplicates", kept)
    assert sorted(map(repr, unique)) == sorted(map(repr, expected))

    hits = brute.contaminated([(r.doc_id, r.text) for r in unique], list(enumerate(items)), 10)
    clean = step("decontamination", unique)
    assert sorted(map(repr, clean)) == sorted(repr(r) for r, h in zip(unique, hits) if not h[5]) and len(clean) < len(unique)

    safe = {r.doc_id: r for r in step("secrets", clean)}
    for r in clean:
        spans = brute.base_spans(r.text)
        if spans:
            _, start, end = spans.split(",")[0].split(":")
            text = r.text[: int(start)] + "[SECRET]" + r.text[int(end) :]
            assert (safe[r.doc_id].text, safe[r.doc_id].n_chars) == (text, len(text))
        else:
            assert safe[r.doc_id] == r

    mixed = stage["mixing"](spark, spark.createDataFrame(list(safe.values()), docs.schema), path).collect()
    sizes = defaultdict(int)
    for r in safe.values():
        sizes[r.source] += len((r.text or "").split())
    wanted = brute.targets(sizes, (3, 1, 2), 1.5, 2)
    taken = defaultdict(int)
    for r in mixed:
        taken[safe[r.doc_id].source] += r.taken
    assert all(taken[s] == pytest.approx(t, rel=0.05, abs=64) for s, t in wanted.items())


def test_run_and_empty_tables(spark, folder, tmp_path):
    path, _ = folder
    result = corpus_pipeline.run(spark, path)
    assert result.columns == ["doc_id", "size", "source_size", "target", "taken"] and 100 < result.count() < 300
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
