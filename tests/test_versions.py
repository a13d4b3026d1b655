"""Versions of parameters and the run log, also after writes that broke off."""

from __future__ import annotations

import pytest

from catalog import frozen
from scoreloom.sources import params
from scoreloom.sources.versions import VersionStore
from scoreloom.storage import new_path


def values(df):
    return sorted(r.x for r in df.collect())


def test_reads_as_of_a_version(spark):
    store = VersionStore(spark, new_path(spark, "store"))
    assert store.versions() == []
    with pytest.raises(LookupError):
        store.read("a")
    one, two = (spark.createDataFrame([(k,)], "x int") for k in (1, 2))
    assert store.commit({"a": one, "b": two}) == 1
    assert store.commit({"a": two}) == 2
    assert store.versions() == [1, 2]
    assert values(store.read("a")) == [2] and values(store.read("a", 1)) == [1]
    assert values(store.read("b")) == [2]
    with pytest.raises(LookupError):
        store.read("b", 2)


def test_a_broken_write_is_never_read(spark, monkeypatch):
    """The second table of a commit fails, then its manifest: the version before stays."""
    store = VersionStore(spark, new_path(spark, "store"))
    good = spark.createDataFrame([(1,)], "x int")
    store.commit({"a": good, "b": good})
    broken = good.selectExpr("x", "raise_error('broken') AS y")
    with pytest.raises(Exception, match="broken"):
        store.commit({"a": spark.createDataFrame([(9,)], "x int"), "b": broken})
    assert store.versions() == [1] and values(store.read("a")) == [1]
    with monkeypatch.context() as patched:
        patched.setattr(spark, "createDataFrame", lambda *_: broken.selectExpr("x AS version", "y"))
        with pytest.raises(Exception, match="broken"):
            store.commit({"a": good})
    assert store.versions() == [1]
    assert store.commit({"a": spark.createDataFrame([(3,)], "x int")}) == 2
    assert values(store.read("a")) == [3] and values(store.read("b")) == [1]


def test_scorecards_and_stats_by_version(spark):
    path = new_path(spark, "card")
    first, second = (frozen.scorecard({"bureau_score": m}, {}) for m in (500.0, 600.0))
    assert (first.save(spark, path), second.save(spark, path)) == (1, 2)
    assert params.Scorecard.load(spark, path).medians == {"bureau_score": 600.0}
    assert params.Scorecard.load(spark, path, 1).medians == {"bureau_score": 500.0}
    path = new_path(spark, "stats")
    for value in (1.0, 2.0):
        params.write_stats(params.stats_table(spark, {"median": {"dti": value}}), path)
    assert params.read_stats(spark, path) == {"median": {"dti": 2.0}}
    assert params.read_stats(spark, path, 1) == {"median": {"dti": 1.0}}


def test_a_repeated_run_changes_nothing(spark):
    path = new_path(spark, "runs")
    for name in ("fit", "again"):
        params.log_run(spark, path, "run/1 =x", name, {"C": 1}, {"auc": 0.5})
    params.log_run(spark, path, "run 2", "fit", {"C": 2}, {"auc": None})
    rows = sorted(map(tuple, params.read_run_log(spark, path).drop("logged_at").collect()), key=repr)
    assert rows == sorted(
        [("run/1 =x", "fit", "param", "C", "1"), ("run/1 =x", "fit", "metric", "auc", "0.5"),
         ("run 2", "fit", "param", "C", "2"), ("run 2", "fit", "metric", "auc", None)], key=repr,
    )
    assert params.read_run_log(spark, new_path(spark, "none")).count() == 0
