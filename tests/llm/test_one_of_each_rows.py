"""Near duplicates go row by row, also where rows repeat an id."""

from __future__ import annotations

import random

import brute
import pytest

from scoreloom.llm.decontaminate import clean_documents
from scoreloom.llm.jaccard_join import one_of_each

TEXT = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
OTHER = "this text has nothing in common with any of the other ones here"


def kept(spark, rows):
    docs = spark.createDataFrame([("x", i, t) for i, t in rows], "source string, doc_id long, text string")
    out = one_of_each(docs)
    assert out.columns == docs.columns
    return sorted((repr((r.doc_id, r.text)) for r in out.collect()))


def test_a_text_goes_not_its_id(spark):
    rows = [(5, OTHER), (5, TEXT + " end"), (3, TEXT), (None, "alone"), (None, TEXT), (7, None), (7, TEXT)]
    assert kept(spark, rows) == sorted(map(repr, [(5, OTHER), (3, TEXT), (None, "alone"), (7, None)]))


def test_near_copies_under_one_id_are_one_document(spark):
    rows = [(3, TEXT + f" end{i}") for i in range(40)] + [(9, OTHER)] * 3
    found = kept(spark, rows)
    assert len([r for r in found if r.startswith("(3,")]) == 1
    assert [r for r in found if r.startswith("(9,")] == [repr((9, OTHER))]


def test_a_thousand_equal_rows_leave_one(spark):
    rows = [(4, TEXT)] * 1000 + [(None, OTHER)] * 1000 + [(None, "")] * 3 + [(8, None)] * 2
    assert kept(spark, rows) == sorted([repr((4, TEXT)), repr((None, OTHER))] + [repr((None, ""))] * 3 + [repr((8, None))] * 2)


def test_the_least_of_equal_rows_stays_whole(spark):
    docs = spark.createDataFrame([(c, 1, TEXT, k) for c, k in (("b", 1), ("a", 2), ("a", 1), ("c", 0))], "`so.urce` string, doc_id long, text string, stays int")
    assert [tuple(r) for r in one_of_each(docs).collect()] == [("a", 1, TEXT, 1)]
    again = docs.unionAll(docs).repartition(5)
    assert [tuple(r) for r in one_of_each(again).collect()] == [("a", 1, TEXT, 1)]


def test_equal_to_the_row_by_row_version(spark):
    """One row of each component: the least id, nulls last; all rows without shingles."""
    rng = random.Random(4)
    bases = [" ".join(f"w{rng.randrange(500)}" for _ in range(40)) for _ in range(30)]
    rows = [(rng.randrange(60), rng.choice(bases)) for _ in range(150)] + [(None, bases[0]), (None, ""), (None, bases[0] + " x"), (None, "only")]
    found = brute.jaccard([(i, t) for i, (_, t) in enumerate(rows)], 5, 80)
    parts = {}
    for r, (_, n, c) in zip(rows, found):
        if n:
            parts.setdefault(c, []).append(r)
    expected = [r for r, (_, n, _) in zip(rows, found) if not n]
    for members in parts.values():
        least = min((i is None, i or 0) for i, _ in members)
        assert len({t for i, t in members if (i is None, i or 0) == least}) == 1
        expected.append(next(r for r in members if (r[0] is None, r[0] or 0) == least))
    assert kept(spark, rows) == sorted(map(repr, expected))


@pytest.mark.parametrize("stage", ["near_duplicates", "decontamination"])
def test_rows_that_stay_are_not_moved(spark, stage):
    """Only rows that perhaps go are dealt by keys, also where no table is small enough to be broadcast."""
    copies = [(1000 + i, TEXT) for i in range(20)]
    ids = [i * 7 % 300 for i in range(300)]
    docs = spark.createDataFrame([(i, f"text {i} " + " ".join(f"w{i}x{j}" for j in range(9))) for i in ids] + copies, "doc_id long, text string")
    benchmark = spark.createDataFrame([("b", TEXT)], "item_id string, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = one_of_each(docs) if stage == "near_duplicates" else clean_documents(docs, benchmark)
        found = [r.doc_id for r in out.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == ids + [1000] * (stage == "near_duplicates")
