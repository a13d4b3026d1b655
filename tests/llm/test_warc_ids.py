"""Revisits against a plain resolver, over records whose ids repeat."""

from __future__ import annotations

import random

import pytest

from scoreloom.llm.warc import resolve_revisits

RECORDS = "record_id long, kind string, url string, at double, http_status int, headers string, digest string"


def plain(rows):
    """``(id, url, response, status, digest)`` of every revisit, by looking at every response."""
    out = []
    for i, kind, url, at, status, headers, _ in rows:
        if kind != "revisit" or status not in (304, None):
            continue
        tag = headers.removeprefix("ETag: ") if headers.startswith("ETag") else None
        earlier = [r for r in rows if r[1] == "response" and r[4] == 200 and url is not None and at is not None and r[2] == url and r[3] is not None and r[3] < at]
        if not earlier:
            out.append((i, url, None, "no_response", None))
            continue
        latest = max((r[3], r[0]) for r in earlier)
        same = min((r for r in earlier if (r[3], r[0]) == latest), key=lambda r: (r[6] is None, r[6] or ""))
        agrees = tag is None or tag.removeprefix("W/") == same[5].removeprefix("ETag: ")
        out.append((i, url, same[0] if agrees else None, "resolved" if agrees else "validator_mismatch", same[6] if agrees else None))
    return out


@pytest.mark.parametrize("seed, bucket_seconds", [(1, 3600), (2, 5)])
def test_against_every_response(spark, seed, bucket_seconds):
    rng = random.Random(seed)
    urls = ["http://a.com/x", "http://a.com/y", "http://b.org/", None]
    rows = []
    for _ in range(400):
        response = rng.random() < 0.5
        tag = rng.choice(["ETag: \"1\"", "ETag: \"2\""])
        headers = tag if response else rng.choice([tag, tag.replace(": ", ": W/"), "X-Other: 1"])
        at = rng.choice([None, *([rng.randrange(120) / 4] * 20)])
        rows.append((rng.randrange(30), "response" if response else "revisit", rng.choice(urls), at, 200 if response else 304, headers, rng.choice([None, "d1", "d2"]) if response else None))
    rows += rows[:40]
    # Rows that agree in url, time and id must not differ in their tag only.
    seen = {}
    rows = [r for r in rows if r[1] == "revisit" or seen.setdefault((r[2], r[3], r[0], r[6]), r[5]) == r[5]]
    records = spark.createDataFrame(rows, RECORDS).repartition(5)
    got = [(r.record_id, r.canonical, r.response_id, r.status, r.digest) for r in resolve_revisits(records, bucket_seconds).collect()]
    expected = [(i, url and url.removeprefix("http://"), *rest) for i, url, *rest in plain(rows)]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))
    assert len({r[3] for r in got}) == 3


def test_one_row_per_revisit_where_ids_repeat_over_urls(spark):
    rows = [
        (7, "response", "http://a.com/x", 1.0, 200, "ETag: \"1\"", "dx"),
        (7, "response", "http://b.com/y", 2.0, 200, "ETag: \"2\"", "dy"),
        (7, "revisit", "http://a.com/x", 5.0, 304, "ETag: \"1\"", None),
        (7, "revisit", "http://b.com/y", 5.0, 304, "ETag: \"1\"", None),
    ]
    got = sorted((r.canonical, r.response_id, r.status, r.digest) for r in resolve_revisits(spark.createDataFrame(rows, RECORDS)).collect())
    assert [g[1:] for g in got] == [(7, "resolved", "dx"), (None, "validator_mismatch", None)]
