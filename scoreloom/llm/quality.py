"""Quality: Bradley-Terry scores from pairs of a better and a worse text, cut at a quantile of the scores."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.scratch import scratch_table
from scoreloom.llm.words import AS_IS, NOT_SPACE, text_slices, word_hashes, word_spans
from scoreloom.operators.quantiles import SMALL_GROUP_ROWS

# Preferences of each text of the commoner side.
TURNS = 2
CELL_FEW = 64
CELL_MANY = 1_024
QUANTILES = 1_000
ACCURACY = 20_000

# Classes of bytes; bytes from 0x80 on belong to letters of other scripts.
_CLASSES = (
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "0123456789",
    " \t",
    "\n\r\x0b\x0c",
    ".",
    ",;:",
    "!?",
    "'\"`",
    "()[]{}<>",
    "-_/\\",
    "|",
    "#$%&",
    "*+=@^~",
)
_OTHER = len(_CLASSES)
_N = _OTHER + 2
_CLASS = np.full(256, _OTHER, np.int64)
for _i, _chars in enumerate(_CLASSES):
    _CLASS[list(_chars.encode())] = _i
_CLASS[0x80:] = _OTHER + 1
NOT_LINE_END = np.ones(256, bool)
NOT_LINE_END[[0x0A, 0x0D]] = False

WORD_MEASURES = ("words", "mean length", "short words", "long words", "distinct words", "lines", "distinct lines")
N_FEATURES = _N * _N + len(WORD_MEASURES)


def _distinct(of: np.ndarray, hashes: np.ndarray, rows: int) -> np.ndarray:
    """Number of different hashes in each row."""
    keys = np.unique(np.stack([of.astype(np.uint64), hashes], axis=1), axis=0) if len(of) else np.zeros((0, 2), np.uint64)
    return np.bincount(keys[:, 0].astype(np.int64), minlength=rows)


def text_features(column: pa.Array) -> Iterator[np.ndarray]:
    """One row of features per text, slice by slice; all are between 0 and about 3.

    Roots of the shares of all pairs of neighbouring byte classes, then measures
    of words and lines. Null and empty texts have zeros.
    """
    for _, data, offsets in text_slices(column):
        rows = len(offsets) - 1
        out = np.zeros((rows, N_FEATURES), np.float32)
        kind = _CLASS[data]
        row = np.repeat(np.arange(rows), np.diff(offsets))
        if len(kind) > 1:
            inner = row[:-1] == row[1:]
            pairs = np.bincount((row[:-1] * _N * _N + kind[:-1] * _N + kind[1:])[inner], minlength=rows * _N * _N)
            out[:, : _N * _N] = np.sqrt(pairs.reshape(rows, -1) / np.maximum(np.diff(offsets) - 1, 1)[:, None])
        inside, starts, ends, of = word_spans(data, offsets, NOT_SPACE)
        n = np.bincount(of, minlength=rows)
        some = np.maximum(n, 1)
        lengths = ends - starts
        line_inside, line_starts, line_ends, line_of = word_spans(data, offsets, NOT_LINE_END)
        lines = np.bincount(line_of, minlength=rows)
        out[:, _N * _N :] = np.stack(
            [
                np.log1p(n) / 5,
                np.minimum(np.bincount(of, lengths, minlength=rows) / some / 5, 3),
                np.bincount(of, lengths <= 3, minlength=rows) / some,
                np.bincount(of, lengths >= 12, minlength=rows) / some,
                _distinct(of, word_hashes(data, inside, starts, ends, AS_IS), rows) / some,
                lines / some,
                _distinct(line_of, word_hashes(data, line_inside, line_starts, line_ends, AS_IS), rows) / np.maximum(lines, 1),
            ],
            axis=1,
        )
        yield out


@dataclass(frozen=True)
class QualityModel:
    """Strength of each feature, and the strength from which a text counts as good."""

    weights: tuple[float, ...] = field(default_factory=lambda: (0.0,) * N_FEATURES)
    cut: float = 0.0


def strengths_of(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """To 9 decimals, so that equal texts have equal ones in training and scoring."""
    return np.round(features.astype(np.float64) @ weights, 9)


def _packed(rows: np.ndarray) -> pa.Array:
    """Each row of features as the bytes of 32-bit numbers."""
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _unpacked(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, N_FEATURES).astype(np.float64)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [_packed(block) for block in text_features(batch.column("text"))]
        packed = pa.concat_arrays(rows) if rows else pa.array([], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), packed], ["id", "key", "features"])


def _differences(turns: int):
    """Preferences of one cell: the many texts of one side against the few of the other, in turn."""

    def run(many: pa.Table, few: pa.Table) -> pa.Table:
        l, s = len(many), len(few)
        n = max(turns * l, s) if l and s else 0
        at = np.arange(n)
        wins = at % 2
        if n:
            x, y = (_unpacked(side.sort_by([("key", "ascending"), ("features", "ascending")])["features"]) for side in (many, few))
            # The better text minus the worse; every second pair is turned round, so that both outcomes occur.
            sign = np.where(wins == many["good"][0].as_py(), 1.0, -1.0)
            flat = ((x[at // turns % l] - y[at % s]) * sign[:, None]).ravel()
        else:
            flat = np.zeros(0)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * N_FEATURES), pa.array(flat))
        return pa.table({"wins": pa.array(wins.astype(np.int32)), "difference": lists})

    return run


def preferences(found: DataFrame, sizes: dict[int, int], turns: int = TURNS) -> DataFrame:
    """``(wins, difference)`` of pairs of texts from ``(good, key, features)``, ``sizes`` counting both sides.

    Texts are dealt by their keys into cells of some ``CELL_FEW`` texts of the
    rarer side and some ``CELL_MANY`` or fewer of the other; where the rarer side
    is too small for that, its texts are in several cells. In a cell every text of
    the commoner side is in ``turns`` pairs, and all of the other take part in turn.
    """
    rarer = min(sizes, key=lambda g: (sizes[g], g))
    cells = max(1, sizes[rarer] // CELL_FEW)
    parts = max(1, -(-sizes[1 - rarer] // (cells * CELL_MANY)))
    found = found.withColumn("cell", F.pmod("key", F.lit(cells)))
    many = found.where(f"good = {1 - rarer}").withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int"))
    few = found.where(f"good = {rarer}").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    many, few = (side.select(*[F.col(c).alias(c) for c in ("cell", "part", "good", "key", "features")]).groupBy("cell", "part") for side in (many, few))
    return many.cogroup(few).applyInArrow(_differences(turns), "wins int, difference array<double>")


def _strengths(weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("good"), pa.array(strengths_of(_unpacked(batch.column("features")), weights))], ["good", "strength"])

    return run


def _passed(cuts: np.ndarray):
    """How many texts of each label reach how many of the cuts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, len(cuts) + 1), np.int64)
        for batch in batches:
            good, strengths = (batch.column(c).to_numpy() for c in ("good", "strength"))
            np.add.at(counts, (good, np.searchsorted(cuts, strengths, "right")), 1)
        good, reached = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(good.astype(np.int32)), pa.array(reached.astype(np.int32)), pa.array(counts[good, reached])], ["good", "reached", "n"]
        )

    return run


def train_quality(
    docs: DataFrame,
    labels: DataFrame,
    turns: int = TURNS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> QualityModel:
    """Learn from all labelled documents (1 better than 0).

    Each preference puts one good text above one bad one; every text of the
    commoner side is in ``turns`` of them, and all of the other take part in turn,
    see ``preferences``. Logistic loss on the differences of their features,
    without an intercept, gives the strengths of a Bradley-Terry model. The cut is
    the quantile of all strengths that parts the labels best, by the mean of both
    shares told apart; among equals the one in the middle. Quantiles of more than
    ``SMALL_GROUP_ROWS`` texts are within one in ``ACCURACY`` of them; the shares
    are counted over all.

    Null labels and ids are left out; an id with several labels has the largest,
    and each of its rows is a text. Without two labels every strength is 0 and
    every text counts as good.
    """
    known = (
        labels.where(f"{label_col} in (0, 1) and {id_col} is not null")
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max(label_col).cast("int").alias("good"))
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    texts = texts.select("id", F.xxhash64("id", "text").alias("key"), "text")
    id_type = texts.schema["id"].dataType.simpleString()
    # Labels meet features, which are shorter than texts.
    features = texts.mapInArrow(_features, f"id {id_type}, key long, features binary")
    found = scratch_table(features.join(known.hint("merge"), "id").select("good", "key", "features"), "quality-features")
    sizes = {r["good"]: r["count"] for r in found.groupBy("good").count().collect()}
    if len(sizes) < 2:
        return QualityModel()
    differences = preferences(found, sizes, turns).select("wins", array_to_vector("difference").alias("features"))
    fit = LogisticRegression(labelCol="wins", fitIntercept=False, regParam=1e-4).fit(differences)
    weights = np.array(fit.coefficients.toArray())

    strengths = scratch_table(found.select("good", "features").mapInArrow(_strengths(weights), "good int, strength double"), "quality-strengths")
    shares = F.array(*[F.lit(i / QUANTILES) for i in range(1, QUANTILES)])
    few = sum(sizes.values()) <= SMALL_GROUP_ROWS
    cuts = F.percentile("strength", shares) if few else F.percentile_approx("strength", shares, F.lit(ACCURACY))
    cuts = np.array(strengths.agg(cuts).first()[0])
    passed = strengths.mapInArrow(_passed(cuts), "good int, reached int, n long").groupBy("good", "reached").agg(F.sum("n").alias("n"))
    counts = np.zeros((2, len(cuts) + 1), np.int64)
    for r in passed.collect():
        counts[r["good"], r["reached"]] = r["n"]
    return QualityModel(tuple(weights.tolist()), best_cut(cuts, counts))


def best_cut(cuts: np.ndarray, counts: np.ndarray) -> float:
    """The cut that parts good (from it on) from bad (below it) best, from how many of each label reach how many cuts."""
    bad, good = np.cumsum(counts[:, :-1], axis=1) / counts.sum(axis=1, keepdims=True)
    told = 1 - good + bad
    best = np.flatnonzero(np.isclose(told, told.max(), rtol=0, atol=1e-9))
    return float(cuts[best[len(best) // 2]])


def best_quantile(strengths: np.ndarray, good: np.ndarray, quantiles: int = QUANTILES) -> float:
    """``best_cut`` of the quantiles of ``strengths``, for those that fit one process."""
    cuts = np.quantile(strengths, np.arange(1, quantiles) / quantiles)
    counts = np.zeros((2, len(cuts) + 1), np.int64)
    np.add.at(counts, (good, np.searchsorted(cuts, strengths, "right")), 1)
    return best_cut(cuts, counts)


def quality_scores(
    docs: DataFrame, model: QualityModel, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(<id>, strength, score, predicted)`` of every row.

    ``score`` is the chance of a text of this strength against one at the cut,
    moved so that the cut has ``threshold``; ``predicted`` is 1 from it on. Null
    and empty texts have strength 0. Repeated rows are scored each; whole texts
    are read, other columns are not. An empty table gives an empty result.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    weights, at_cut = np.array(model.weights), float(np.log(threshold / (1 - threshold)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = [strengths_of(block, weights) for block in text_features(batch.column("text"))]
            strength = np.concatenate(blocks) if blocks else np.zeros(0)
            above = strength >= model.cut
            score = 1 / (1 + np.exp(np.clip(model.cut - strength - at_cut, -700, 700)))
            score = np.where(above, np.maximum(score, threshold), np.minimum(score, np.nextafter(threshold, 0)))
            columns = [batch.column("id"), pa.array(strength), pa.array(score), pa.array(above.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "strength", "score", "predicted"])

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, f"id {id_type}, strength double, score double, predicted int").withColumnRenamed("id", id_col)
