"""Every term that passes the tests of weight and evidence is in the lexicon."""

from __future__ import annotations

from itertools import islice, product

from scoreloom.llm.toxicity import train_toxicity


def test_a_large_lexicon_is_whole(spark):
    def vocabulary(first):
        return ["".join(w) for w in islice(product(first, "abcdefgh", "abcdefghijkmnop", "abcdefghijkmnop"), 6_000)]

    insults, plain = vocabulary("abcd"), vocabulary("efgh")
    rows = [(i, " ".join(insults if i % 2 else plain)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = train_toxicity(docs, spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int"))
    assert model.weights.keys() == {f" {w} " for w in insults}
