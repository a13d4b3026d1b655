"""Operator 11 against all pairs of words, and its automata one by one."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from scoreloom.llm import spelling as S
from scoreloom.llm.oracles import spelling_sql

DOCS = "doc_id long, text string, word string, n string, size string, id string, near string, lo string"


def is_near(x, y):
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    short, long = sorted((x, y), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_words(rows, least=6, count=5, every=199):
    found = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            found[run[: h % len(run)] + run[h % len(run) + 1 :] if h % every == 0 else run] += 1
    return {w: n for w, n in found.items() if len(w) >= least and n >= count}


def plain_forms(count, times=5):
    out, form = [], {}
    near = {w: [v for v in count if is_near(w, v)] for w in count}
    for w in count:
        best = min(near[w], key=lambda v: (-count[v], v), default=None)
        if best and count[best] >= times * count[w]:
            form[w] = best
    for w in count:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, count[w], len(near[w]), count[form[w]] if w in form else None))
    return out


def same(got, expected):
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))


@pytest.mark.parametrize("seed", range(5))
def test_composition_finds_each_pair_once(seed):
    rng = random.Random(seed)
    full = sorted({"".join(rng.choice("aab") for _ in range(5)) for _ in range(14)})
    short = sorted({"".join(rng.choice("aab") for _ in range(4)) for _ in range(9)})
    acceptor = S.Acceptor()
    found = list(acceptor.one_edit(acceptor.add(full), acceptor.add(short)))
    assert len(found) == len(set(found))
    expected = {(x, y, False) for x in full for y in full if x < y and is_near(x, y)}
    assert set(found) == expected | {(x, y, True) for x in full for y in short if is_near(x, y)}


def test_acceptor_is_minimal_and_shared():
    acceptor = S.Acceptor()
    first = acceptor.add(["ab", "bb", "cb"])
    second = acceptor.add(["xcb", "ycb"])
    assert len(set(acceptor.arcs[first].values())) == 1
    assert len(set(acceptor.arcs[second].values())) == 1
    (to,) = set(acceptor.arcs[second].values())
    assert acceptor.arcs[to]["c"] in acceptor.arcs[first].values()
    assert acceptor.arcs[acceptor.add([])] == {}


@pytest.mark.parametrize("group", [1, 4, 2000])
def test_forms_equal_all_pairs(spark, group):
    """Also when partitions are halved down to one place of the word."""
    rng = random.Random(group)
    base = ["".join(rng.choice("abcé") for _ in range(rng.randrange(6, 10))) for _ in range(40)]
    count = {}
    for w in base:
        for _ in range(rng.randrange(1, 12)):
            i, c = rng.randrange(len(w)), rng.choice(["", "a", "ü", "bb"])
            v = w[:i] + c + w[i + 1 :]
            count.setdefault(v, rng.choice([5, 6, 25, 30, 125, 700, 3500]))
        count[w] = rng.choice([5, 25, 125, 3500])
    count |= {"a" * k: 5**k for k in range(6, 12)} | {"longlong" * 300: 9, "longlong" * 299 + "longlon": 50, "onglong" + "longlong" * 299: 10}
    words = spark.createDataFrame(list(count.items()), "word string, n long")
    same(S.spelling_forms(words, group_words=group).collect(), plain_forms(count))


def test_words_of_documents(spark):
    rng = random.Random(2)
    names = ["Therhean", "therhean", "thErhean", "ÀÉÎõüÿ", "àéîõüÿ", "naïvete", "short", "abcdef", "abcde1fgh", "mid×dle÷way", "w" * 4000]
    rows = [(i, " ".join(rng.choice(names) + rng.choice(["", ".", "-", "Ā", "1"]) for _ in range(60))) for i in range(400)]
    rows += [(None, "orphan " * 9), (None, None), (5, ""), (6, None), *rows[:30]]
    docs = spark.createDataFrame([(i, t, "x", "y", "z", "a", "b", "c") for i, t in rows], DOCS)
    expected = plain_words(rows)
    assert any(len(w) == 3999 for w in expected) or len(expected) > 6
    same(S.vocabulary(docs.repartition(6)).collect(), expected.items())
    same(S.spelling_forms(S.vocabulary(docs)).collect(), plain_forms(expected))
    assert S.spelling_forms(S.vocabulary(docs.limit(0))).count() == 0
    assert S.spelling_forms(S.vocabulary(docs.where("text = ''"))).count() == 0


def test_words_are_flushed_in_bounded_parts(spark, monkeypatch):
    monkeypatch.setattr(S, "HELD_WORDS", 3)
    rows = [(i, f"abcdefg hijklmn opqrstu vwxyzab word{'x' * (i % 7)}y") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    same(S.vocabulary(docs).collect(), plain_words(rows).items())


def test_sql_finds_the_same(spark):
    duckdb = pytest.importorskip("duckdb")
    rng = random.Random(4)
    base = ["therhean", "esndhaéé", "erretion", "aninged", "bleinging"]
    rows = [(i, " ".join(w[:k] + w[k + 1 :] if rng.random() < 0.2 else w for w in rng.choices(base, k=50) for k in [rng.randrange(len(w))])) for i in range(150)]
    documents = spark.createDataFrame(rows, "doc_id long, text string").toPandas()
    con = duckdb.connect()
    con.register("documents", documents)
    same(con.sql(spelling_sql()).fetchall(), plain_forms(plain_words(rows)))


def test_a_hot_prefix_ends_in_small_partitions(spark):
    """A third of the vocabulary behind one prefix: no partition keeps more than its share."""
    count = {f"prefix{a}{b}{c}": 5 for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"} | {"another": 30}
    words = spark.createDataFrame(list(count.items()), "word string, n long")
    near = S.near_words(words, group_words=20)
    assert near.groupBy("word").count().agg(F.min("count"), F.max("count")).first()[:] == (21, 21)
