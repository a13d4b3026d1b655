"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text, normalised by length."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.scratch import scratch_table

TOXIC_TEXTS = 4_000
OTHER_TEXTS = 8_000
STEMS = range(4, 9)
_COUNTS = "term string, toxic int, fit boolean, n long"

# Letters that look like Latin ones, in pairs: other letter, Latin letter.
_CYRILLIC = "аaвbеeкkмmнhоoрpсcтtуyхxіiјjѕsһhԁdԛqԝwѵvӏi"
_GREEK = "αaβbεeηnιiκkνvοoρpτtυuχxωw"
_DIGITS = "0o1i3e4a5s7t8b9g@a$s"


def _fold_table() -> dict[int, str]:
    """Characters to their folded form; small l joins i, as 1 stands for either."""
    pairs = _CYRILLIC + _GREEK + _DIGITS
    table = {ord(a): b for a, b in zip(pairs[::2], pairs[1::2])}
    for code in range(0xFF21, 0xFF5B):  # full-width forms
        table[code] = unicodedata.normalize("NFKC", chr(code)).lower()
    table |= {code: "" for code in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)}  # invisible
    return {code: "i" if to == "l" else to for code, to in table.items()} | {ord("l"): "i"}


_FOLD = _fold_table()
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def folded(text: str | None) -> str:
    """Words of the folded text, each between single spaces; empty without words."""
    words = _NOT_LETTERS.sub(" ", (text or "").lower().translate(_FOLD)).strip()
    return f" {words} " if words else ""


def terms_of(text: str) -> Counter:
    """Distinct words of a folded text, and how many of them start with each stem."""
    words = set(text.split())
    terms = Counter(f" {w[:k]}" for w in words for k in STEMS if k < len(w))
    terms.update(f" {w} " for w in words)
    return terms


@dataclass(frozen=True)
class ToxicityModel:
    """Terms with weights, phrases that excuse a term inside, and the logistic curve."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    slope: float = 0.0
    intercept: float = -30.0

    def score(self, strength: float) -> float:
        """Probability of a strength on the curve."""
        x = self.intercept + self.slope * strength
        return 1.0 / (1.0 + math.exp(-x)) if x > -700 else 0.0

    def automaton(self) -> ahocorasick.Automaton | None:
        found = ahocorasick.Automaton()
        for phrase in self.exceptions:
            found.add_word(phrase, (phrase, None))
        excused = set(self.exceptions)
        for term, weight in self.weights.items():
            if term not in excused:
                found.add_word(term, (term, weight))
        if not len(found):
            return None
        found.make_automaton()
        return found


def matches(automaton: ahocorasick.Automaton | None, text: str) -> list[tuple[int, float]]:
    """``(place, weight)`` of each word with a term, its strongest, outside of exception phrases."""
    best: dict[int, float] = {}
    excused: list[tuple[int, int]] = []
    if automaton is not None and text:
        for end, (term, weight) in automaton.iter(text):
            start = end - len(term) + 1
            if weight is None:
                excused.append((start, end))
            elif weight > best.get(start, 0.0):
                best[start] = weight
    if excused:
        # Both in order of start: a word is excused if an earlier start reaches beyond it.
        excused.sort()
        kept, reach, i = [], -1, 0
        for start, weight in sorted(best.items()):
            while i < len(excused) and excused[i][0] <= start:
                reach, i = max(reach, excused[i][1]), i + 1
            if start >= reach:
                kept.append((start, weight))
        return kept
    return sorted(best.items())


def strength(automaton: ahocorasick.Automaton | None, text: str) -> float:
    """Weights of the distinct words with a term over the root of the number of distinct words."""
    weights = {text[s : text.index(" ", s + 1)]: w for s, w in matches(automaton, text)}
    return sum(weights.values()) / math.sqrt(len(set(text.split()))) if weights else 0.0


def _counted(counts: dict[tuple[int, bool], Counter]) -> Iterator[pa.RecordBatch]:
    for (label, fit), of_terms in counts.items():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(of_terms), pa.string()),
                pa.array([label] * len(of_terms), pa.int32()),
                pa.array([fit] * len(of_terms), pa.bool_()),
                pa.array(list(of_terms.values()), pa.int64()),
            ],
            ["term", "toxic", "fit", "n"],
        )


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[tuple[int, bool], Counter] = defaultdict(Counter)
        for text, label, fit in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "fit"))):
            counts[label, fit].update(terms_of(folded(text)))
        yield from _counted(counts)


def _phrase_counts(model: ToxicityModel):
    """Words with a term, alone and with a neighbour, as phrases per text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in batches:
            counts: dict[tuple[int, bool], Counter] = defaultdict(Counter)
            for text, label, fit in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "fit"))):
                text = folded(text)
                phrases = set()
                for start, _ in matches(automaton, text):
                    stop = text.index(" ", start + 1)
                    before = text.rfind(" ", 0, start) if start else 0
                    after = text.find(" ", stop + 1)
                    phrases |= {text[start : stop + 1], text[before : stop + 1], text[start : after + 1] if after > 0 else text[start : stop + 1]}
                counts[label, fit].update(phrases)
            yield from _counted(counts)

    return run


def _by_label(counts: DataFrame) -> DataFrame:
    """Counts of each term, in toxic and other texts, of all rows and of those that learn only."""

    def n(label: int, rows: Column) -> Column:
        return F.sum(F.when((F.col("toxic") == label) & rows, F.col("n")).otherwise(0))

    everything, learning = F.lit(True), ~F.col("fit")
    return counts.groupBy("term").agg(
        n(0, everything).alias("all_0"), n(1, everything).alias("all_1"), n(0, learning).alias("learn_0"), n(1, learning).alias("learn_1")
    )


def _chosen(rows: list) -> dict[str, float]:
    """Weights by term: stems that several words share, and words that no stem covers."""
    weight = {r["term"]: r["weight"] for r in rows}
    count = {r["term"]: r["n1"] for r in rows}
    most: dict[str, int] = {}
    for term, n in count.items():
        if term.endswith(" "):
            for k in STEMS:
                most[term[: k + 1]] = max(n, most.get(term[: k + 1], 0))
    kept: dict[str, float] = {}
    for term in sorted(weight, key=lambda t: (len(t), t)):
        stem = not term.endswith(" ")
        if stem and count[term] <= 1.2 * most.get(term, 0):
            continue
        if any(kept.get(term[:k], -1.0) >= weight[term] - 1.0 for k in range(2, len(term))):
            continue
        kept[term] = weight[term]
    return dict(sorted(kept.items(), key=lambda e: (-e[1] * count[e[0]], e[0])))


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    toxic_texts: int = TOXIC_TEXTS,
    other_texts: int = OTHER_TEXTS,
    least_weight: float = 3.0,
    least_evidence: float = 20.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> ToxicityModel:
    """Lexicon, exceptions and curve from labelled documents (0 or 1).

    At most ``toxic_texts`` and ``other_texts`` documents are learned from, the
    first by hash of their id. A term's weight is the log ratio of its rates among
    the distinct words of toxic and of other texts, and it needs a likelihood
    ratio of ``least_evidence`` against equal rates; all terms that have both are
    in the lexicon, and all exception phrases, as the sample bounds them. The curve is fitted on a third of them
    with a lexicon of the others; the final lexicon is of all. Null labels and ids are left out; an id with several labels has the
    largest. Without toxic texts the lexicon is empty and every score near 0.
    """
    known = labels.where(f"{label_col} in (0, 1) and {id_col} is not null").groupBy(F.col(id_col).alias("id")).agg(
        F.max(label_col).cast("int").alias("toxic")
    ).withColumn("h", F.xxhash64("id"))
    picked = [known.where(F.col("toxic") == label).orderBy("h", "id").limit(n) for label, n in ((1, toxic_texts), (0, other_texts))]
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sample = texts.join(F.broadcast(picked[0].union(picked[1])), "id")
    fit = (F.pmod(F.shiftright("h", 20), F.lit(3)) == 0).alias("fit")
    sample = scratch_table(sample.select("text", "toxic", fit), "toxicity-sample")
    sizes = {(r["toxic"], r["fit"]): r["count"] for r in sample.groupBy("toxic", "fit").count().collect()}
    if not sizes.keys() >= {(0, False), (1, False)}:
        return ToxicityModel()
    terms = scratch_table(_by_label(sample.mapInArrow(_term_counts, _COUNTS)), "toxicity-terms")
    sums = terms.where("term like '% '").groupBy().sum().first()

    def learned(name: str, parts: tuple[bool, ...]) -> ToxicityModel:
        n0, n1 = (float(sums[f"sum({name}_{label})"] or 1) for label in (0, 1))
        found = [F.col(f"{name}_{label}").cast("double").alias(f"n{label}") for label in (0, 1)]
        weight = (F.log((F.col("n1") + 0.5) / n1) - F.log((F.col("n0") + 0.5) / n0)).alias("weight")
        part = (F.col("n0") + F.col("n1")) / (n0 + n1)
        evidence = 2 * (
            F.col("n1") * F.log(F.col("n1") / (part * n1))
            + F.when(F.col("n0") > 0, F.col("n0") * F.log(F.col("n0") / (part * n0))).otherwise(0)
        )
        held = terms.select("term", *found).where("n1 > 0").select("*", weight, evidence.alias("evidence"))
        held = held.where(f"weight >= {least_weight} and evidence >= {least_evidence}")
        model = ToxicityModel(_chosen(held.collect()))
        phrases = _by_label(sample.mapInArrow(_phrase_counts(model), _COUNTS)).select("term", *found).select("*", weight)
        excused = phrases.where("n0 >= 3 and weight < 0").select("term").collect()
        return ToxicityModel(model.weights, tuple(sorted(r["term"] for r in excused)))

    trial = learned("learn", (False,))
    measured = strengths(sample.where("fit"), trial, "toxic", "text")
    measured = scratch_table(measured, "toxicity-curve")
    model = learned("all", (False, True))
    if not sizes.keys() >= {(0, True), (1, True)}:
        measured = scratch_table(strengths(sample, model, "toxic", "text"), "toxicity-curve")
    curve = LogisticRegression(labelCol="toxic", regParam=1e-4).fit(
        measured.select("toxic", array_to_vector(F.array("strength")).alias("features"))
    )
    return ToxicityModel(model.weights, model.exceptions, max(0.0, float(curve.coefficients[0])), float(curve.intercept))


def strengths(docs: DataFrame, model: ToxicityModel, id_col: str, text_col: str) -> DataFrame:
    """``(<id>, strength)`` of every row: lexicon weight by length, 0 for null and empty texts."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in batches:
            values = (strength(automaton, folded(t.as_py())) for t in batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(values, pa.float64())], ["id", "strength"])

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, f"id {id_type}, strength double").withColumnRenamed("id", id_col)


def toxicity_scores(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(<id>, score, predicted)`` of every row: score in 0 to 1, predicted 1 from ``threshold`` on.

    Null, empty and wordless texts have the score of a text without any term.
    Repeated rows are scored each; whole texts are read, other columns are not.
    """
    curve = 1.0 / (1.0 + F.exp(-(F.lit(model.intercept) + F.lit(model.slope) * F.col("strength"))))
    return strengths(docs, model, id_col, text_col).select(id_col, curve.alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all columns, unchanged and where they are."""
    column = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in batches:
            values = [model.score(strength(automaton, folded(t.as_py()))) < threshold for t in batch.column(column)]
            yield batch.filter(pa.array(values, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
