"""Rules as a table, and propagation over a web derived from pages, against SQL."""

from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from scoreloom.llm.oracles import linked_urls_sql
from scoreloom.llm.queries import LINK_DAMPING, LINK_TOLERANCE, URL_RULES, url_trust_over_links
from scoreloom.llm.url_filter import judge_urls, rule_of, rules_joined


def random_urls(rng, n):
    hosts = ["", "com", "a.com", "b.a.com", "xa.com", "a.com.", "..", "net", "deep.b.a.com", "é.net"]
    paths = ["", "/", "/en", "/en/", "/en/a", "/é/x", "//", "/en/a/b"]
    return [(rng.choice(hosts), rng.choice(paths)) for _ in range(n)]


def test_rules_as_a_table_equal_the_ladder(spark):
    rng = random.Random(9)
    rules = [(rng.choice(["allow", "block"]), h, p) for h, p in random_urls(rng, 60)]
    urls = spark.createDataFrame(random_urls(rng, 400), "host string, path string")
    table = spark.createDataFrame([*rules, rules[0], ("block", None, "/"), (None, "com", "/")], "verdict string, host string, path string")
    expected = urls.distinct().select("host", "path", rule_of(F.col("host"), F.col("path"), rules).alias("r")).where("r is not null")
    got = rules_joined(urls.union(urls), table)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    assert rules_joined(urls, table.limit(0)).count() == rules_joined(urls.limit(0), table).count() == 0


def test_a_hundred_thousand_rules(spark):
    rules = spark.range(100_000).selectExpr(
        "if(id % 2 = 0, 'block', 'allow') as verdict", "concat('h', id, '.org') as host", "concat('/', id % 10, '/') as path"
    )
    pages = spark.range(0, 110_000, 1000).selectExpr(
        "id as page_id", "concat('http://www.h', id + (id div 1000) % 2, '.org/', id % 10 + (id div 1000) % 2, '/x') as url", "cast(null as string) as html"
    )
    got = {r.page_id: (r.rule, r.verdict) for r in judge_urls(pages, rules).collect()}
    for i in range(0, 110_000, 1000):
        n = i + i // 1000 % 2
        fits = n < 100_000
        assert got[i] == ((f"h{n}.org/{n % 10}/", "allow" if n % 2 else "block") if fits else (None, "allow"))
    # A long list is joined as well.
    many = [("block", f"h{i}.org", "/") for i in range(1_500)]
    blocked = judge_urls(pages, many).where("verdict = 'block'").count()
    assert blocked == 2


@pytest.mark.parametrize("null_rows", [False, True])
def test_web_of_pages_equals_sql(spark, tmp_path, null_rows):
    rng = random.Random(1)
    rows = [(i, f"http://s{rng.randrange(9)}.example.{rng.choice(['com', 'net', 'org'])}/{rng.choice(['en', 'es', 'fr'])}/{i}") for i in range(60)]
    rows += [(60, None), (61, "no scheme")] if null_rows else []
    spark.createDataFrame(rows, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    expected = con.sql(linked_urls_sql(URL_RULES, LINK_DAMPING, LINK_TOLERANCE)).fetchall()
    got = [tuple(r) for r in url_trust_over_links(spark, str(tmp_path)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))
    assert len({r[4] for r in got if r[3] is None}) == 2
