"""Captures that are a fraction of a second apart."""

from __future__ import annotations

import random

import pytest

from scoreloom.llm.warc import latest_before, resolve_revisits


@pytest.mark.parametrize("bucket_seconds", [1, 7, 3600])
def test_latest_before_within_a_second(spark, bucket_seconds):
    rng = random.Random(6)
    rows = [(rng.randrange(3), rng.randrange(200) / 8, i, rng.random() < 0.3) for i in range(300)]
    got = latest_before(spark.createDataFrame(rows, "k long, at double, id long, full boolean"), ["k"], bucket_seconds).collect()
    for r in got:
        earlier = [(at, i) for k, at, i, full in rows if full and k == r.k and at < r.at]
        assert r.found == (max(earlier)[1] if earlier else None)
    assert len(got) == sum(not r[3] for r in rows)


def test_a_revisit_meets_the_response_of_the_same_second(spark):
    rows = [
        (1, "response", "http://a.com/", 3.0, 200, 'ETag: "old"', "d1"),
        (2, "response", "http://a.com/", 10.2, 200, 'ETag: "new"', "d2"),
        (3, "revisit", "http://a.com/", 10.9, 304, 'ETag: "new"', None),
        (4, "revisit", "http://a.com/", 10.2, 304, 'ETag: "old"', None),
    ]
    records = spark.createDataFrame(rows, "record_id long, kind string, url string, at double, http_status int, headers string, digest string")
    got = {r.record_id: (r.response_id, r.status, r.digest) for r in resolve_revisits(records).collect()}
    assert got == {3: (2, "resolved", "d2"), 4: (1, "resolved", "d1")}
