"""Trust and distrust of the url filter against their converged values."""

from __future__ import annotations

import random

import pytest

from scoreloom.llm.url_filter import judge_urls, passed_on, personal_rank

RULES = (("block", "seed.net", "/"),)
LINK = '<a href="http://%s/p">x</a>'


def solved(edges: dict, seeds: dict, damping: float) -> dict:
    """Plain power iteration, far beyond any tolerance of the tests."""
    kept = {h: (1 - damping) * s for h, s in seeds.items()}
    all_of = {}
    for (a, _), n in edges.items():
        all_of[a] = all_of.get(a, 0) + n
    scores = dict(kept)
    for _ in range(400):
        new = dict(kept)
        for (a, b), n in edges.items():
            new[b] = new.get(b, 0.0) + damping * scores.get(a, 0.0) * n / all_of[a]
        scores = new
    return scores


def test_a_chain_is_judged_by_converged_distrust(spark):
    """The host at distance ``i`` links to that at ``i - 1``; its distrust is 0.15 * 0.85^i."""
    hosts = ["seed.net"] + [f"h{i}.org" for i in range(1, 16)]
    rows = [(i, f"http://{h}/", LINK % hosts[i - 1] if i else None) for i, h in enumerate(hosts)]
    got = {r.page_id: r for r in judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string"), RULES).collect()}
    for i in range(16):
        assert got[i].distrust == pytest.approx(0.15 * 0.85**i, abs=1e-6)
    # 0.15 * 0.85^12 = 0.0213 and 0.15 * 0.85^13 = 0.0181: the threshold of 0.02 lies between.
    assert [i for i in range(16) if got[i].verdict == "block"] == list(range(13))


def test_a_cycle_is_followed_to_the_tolerance(spark):
    """``near.org`` links to the seed and ``far.org``, which links back to it."""
    edges = {("seed.net", "near.org"): 1, ("near.org", "far.org"): 1, ("far.org", "near.org"): 1}
    wanted = solved(edges, {"seed.net": 1.0}, 0.85)
    table = spark.createDataFrame([(a, b, float(n)) for (a, b), n in edges.items()], "source string, target string, weight double")
    seeds = spark.createDataFrame([("seed.net", 1.0)], "host string, seed double")
    got = {r.host: r.score for r in personal_rank(table, seeds, 0.85, 1e-3).collect()}
    assert got.keys() == wanted.keys() and wanted["near.org"] == pytest.approx(0.4595, abs=1e-4)
    assert all(0 <= wanted[h] - got[h] <= 1e-3 for h in wanted)
    with pytest.raises(ValueError):
        personal_rank(table, seeds, 1.0, 1e-3)


def test_a_random_graph_with_cycles_and_chains(spark):
    """200 hosts with random links, a ring and a chain that ends nowhere."""
    rng = random.Random(9)
    hosts = [f"h{i}.org" for i in range(200)]
    edges = {(rng.choice(hosts), rng.choice(hosts)): rng.randrange(1, 5) for _ in range(500)}
    edges |= {(f"r{i}", f"r{(i + 1) % 7}"): 1 for i in range(7)} | {(f"c{i}", f"c{i + 1}"): 2 for i in range(30)}
    edges |= {("h0.org", "r0"): 1, ("r3", "c0"): 3}
    edges = {(a, b): n for (a, b), n in edges.items() if a != b}
    seeds = {h: rng.random() for h in rng.sample(hosts, 20) + ["r1", "c0"]}
    wanted = solved(edges, seeds, 0.85)
    table = spark.createDataFrame([(a, b, float(n)) for (a, b), n in edges.items()], "source string, target string, weight double")
    got = {r.host: r.score for r in personal_rank(table, spark.createDataFrame(list(seeds.items()), "host string, seed double"), 0.85, 1e-3).collect()}
    assert all(-1e-12 <= wanted[h] - got.get(h, 0.0) <= 1e-3 for h in wanted)
    assert got.keys() <= wanted.keys()


def test_no_round_sends_its_scores_to_the_driver(spark):
    parts = spark.createDataFrame([("a", "b", 0.5), ("a", "c", 0.5), ("b", "a", 1.0)], "source string, target string, part double")
    round_ = passed_on(parts, spark.createDataFrame([("a", 1.0), ("d", 2.0)], "host string, score double"), 0.8)
    assert sorted(map(tuple, round_.collect())) == [("b", 0.4), ("c", 0.4)]
    assert "Broadcast" not in round_._jdf.queryExecution().executedPlan().toString()
