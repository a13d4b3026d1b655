"""Secrets in texts: fixed patterns, and character Markov models of random strings and identifiers."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds in order, each with its pattern, the group that is measured and its least length.
ASSIGN = (
    r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"""
    r"""[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
KINDS = (("assign", ASSIGN, 2, 6), ("access", r"AKIA[A-Z0-9]{16,}", 0, 20), ("hex", r"[0-9a-f]{24,}", 0, 24))
RANDOM = "random"

# Characters of the models; the last one stands for every other.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
LONG = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
IDENTIFIER = r"[A-Za-z][A-Za-z0-9_-]{3,}"
SAMPLE_TEXTS = 2_000
NATS_PER_CHAR = 0.5
BACK_OFF = 20.0

# Long texts and strings are read in parts of so many code points.
CHUNK = 1_024

_FOUND = "struct<start:bigint,end:bigint,rank:int,kind:string,string:string,measured:string>"


def _let(value: str, name: str, body: str) -> str:
    """SQL of ``body`` with ``name`` for ``value``, which is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _before(values: str, join: Callable[[str, str], str]) -> str:
    """SQL array: what ``join`` makes of 0 and all values before each one of an array of longs.

    ``join`` is associative. A list is extended by copying it, so the values are
    taken in blocks of about the root of their number: no list grows with the text.
    """

    def steps(block: str, first: str) -> str:
        return f"""aggregate({block}, struct({first} as at, cast(array() as array<bigint>) as out),
          (acc, one) -> struct({join("acc.at", "one")} as at, concat(acc.out, array(acc.at)) as out), acc -> acc.out)"""

    width = "cast(ceil(sqrt(size(longs))) as int)"
    blocks = f"""if(size(longs) = 0, cast(array() as array<array<bigint>>),
      transform(sequence(0, cast((size(longs) - 1) div {width} as int)), nth -> slice(longs, nth * {width} + 1, {width})))"""
    totals = f"transform(blocks, block -> aggregate(block, 0L, (sum, one) -> {join('sum', 'one')}))"
    each = f"flatten(zip_with(blocks, {steps(totals, '0L')}, (block, first) -> {steps('block', 'first')}))"
    return _let(values, "longs", _let(blocks, "blocks", each))


def _ends_before(spans: str) -> str:
    """SQL array: the last end of the spans before each one."""
    return _before(f"transform({spans}, s -> s.end)", lambda x, y: f"greatest({x}, {y})")


def _chunks(text: str) -> str:
    """SQL: a text in parts of ``CHUNK`` code points."""
    return f"regexp_extract_all({text}, r'(?s).{{1,{CHUNK}}}', 0)"


def _cut(chunks: str, start: str, end: str) -> str:
    """SQL: the text from ``start`` to before ``end``, read from no more than the chunks it lies in."""
    return f"""if({end} <= {start}, '', array_join(transform(
      sequence({start} div {CHUNK}, ({end} - 1) div {CHUNK}),
      nth -> substring(get({chunks}, cast(nth as int)),
        cast(greatest({start} - nth * {CHUNK}, 0L) + 1 as int),
        cast({end} - greatest({start}, nth * {CHUNK}) as int))), ''))"""


def _replaced(text: str, spans: str, apart: str, mark: str) -> str:
    """SQL: a text with a mark for each span, or what of it no earlier one covers, if ``apart`` holds.

    ``spans`` are sorted by start. ``at`` is where the earlier ones end, ``i`` the number of the span.
    """
    pieces = f"""transform(ends, (at, i) -> {_let(f"get({spans}, i)", "s", f"if({apart}, concat({_cut('chunks', 'at', 's.start')}, {mark}), '')")})"""
    last = f"aggregate({spans}, 0L, (at, s) -> greatest(at, s.end))"
    rest = _let(last, "at", _cut("chunks", "at", f"cast(length({text}) as bigint)"))
    return _let(_chunks(text), "chunks", _let(_ends_before(spans), "ends", f"concat(array_join({pieces}, ''), {rest})"))


def _matches(text: str, pattern: str, group: int, least: int, rank: int, kind: str) -> str:
    """SQL: spans of the leftmost matches of ``pattern`` whose ``group`` has ``least`` characters.

    Each has its string too.
    """
    quoted = "r'" + pattern.replace("'", r"\x27") + "'"
    spans = f"""filter(
      transform(befores, (at, i) -> struct(
        at + length(get(gaps, i)) as start, at + length(get(gaps, i)) + length(get(found, i)) as end,
        {rank} as rank, '{kind}' as kind, get(found, i) as string, get(measured, i) as measured)),
      m -> length(m.measured) >= {least})"""
    befores = _before("transform(found, (m, i) -> cast(length(get(gaps, i)) + length(m) as bigint))", lambda x, y: f"{x} + {y}")
    spans = _let(
        f"split({text}, {quoted})", "gaps",
        _let(
            f"regexp_extract_all({text}, {quoted}, 0)", "found",
            _let(f"regexp_extract_all({text}, {quoted}, {group})", "measured", _let(befores, "befores", spans)),
        ),
    )
    return f"if(coalesce({text} rlike {quoted}, false), {spans}, cast(array() as array<{_FOUND}>))"


def _plain(found: str) -> str:
    """SQL: spans without their strings."""
    return f"transform({found}, m -> struct(m.start as start, m.end as end, m.rank as rank, m.kind as kind))"


def with_base_spans(docs: DataFrame, text: str = "text", name: str = "base") -> DataFrame:
    """Add the pattern spans: ``array<struct<start, end, rank, kind>>`` by start, then kind.

    Places are in code points, ``end`` exclusive. Null and empty texts have none.
    """
    parts = [F.expr(_plain(_matches(text, p, g, n, i, kind))) for i, (kind, p, g, n) in enumerate(KINDS)]
    return docs.withColumn(name, F.array_sort(F.concat(*parts)))


def markov_samples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: int = SAMPLE_TEXTS) -> DataFrame:
    """Labelled strings ``(string, random)``: 1 for random ones, 0 for ordinary identifiers.

    Identifiers are the distinct words of ``texts`` documents, the first by hash of
    their id, outside of pattern spans and shorter than what is scanned. Random strings are digests of their ids in
    base 64, hex and base 32 style upper case: keys of the usual alphabets.
    """
    sample = docs.select(F.xxhash64(id_col).alias("h"), F.col(id_col).alias("id")).distinct().orderBy("h").limit(texts)
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(
        F.broadcast(sample.select("id")), "id"
    )
    plain = F.col("text")
    for _, pattern, _, _ in KINDS:
        plain = F.regexp_replace(plain, pattern, " ")
    words = chosen.select(F.explode(F.regexp_extract_all(plain, F.lit(f"({IDENTIFIER})"))).alias("string"), F.lit(0).alias("random"))
    words = words.where(F.length("string") < LONG).distinct()
    digest = F.sha2(F.col("id").cast("string"), 256)
    random = sample.select(
        F.explode(
            F.array(
                F.regexp_replace(F.base64(F.unhex(digest)), "=+$", ""),
                F.substring(digest, 1, 40),
                F.upper(F.regexp_replace(F.base64(F.unhex(digest)), "[+/=]", "7")),
            )
        ).alias("string"),
        F.lit(1).alias("random"),
    )
    return words.union(random)


def train_markov(samples: DataFrame) -> list[float]:
    """Log-likelihood ratios of character pairs, random over ordinary, from ``(string, random)``.

    A flat square over the alphabet. The chance of a character after another backs
    off to its chance anywhere. The driver gets at most two numbers per pair.
    """
    size = len(ALPHABET)
    chars = F.split(F.col("string"), "")
    pairs = samples.where("length(string) > 1").select(
        "random",
        F.explode(F.arrays_zip(F.slice(chars, F.lit(1), F.size(chars) - 1).alias("x"), F.slice(chars, F.lit(2), F.size(chars) - 1).alias("y"))).alias("p"),
    )
    counts = (
        pairs.groupBy("random", F.col("p.x").alias("x"), F.col("p.y").alias("y")).count()
        .where(F.instr(F.lit(ALPHABET), F.col("x")) > 0)
        .where(F.instr(F.lit(ALPHABET), F.col("y")) > 0)
        .collect()
    )
    seen = [[[0] * size for _ in range(size)] for _ in range(2)]
    for r in counts:
        seen[r["random"]][ALPHABET.index(r["x"])][ALPHABET.index(r["y"])] = r["count"]
    logs = []
    for label in range(2):
        ends = [1 + sum(row[y] for row in seen[label]) for y in range(size)]
        single = [n / sum(ends) for n in ends]
        logs.append(
            [
                math.log((row[y] + BACK_OFF * single[y]) / (sum(row) + BACK_OFF))
                for row in seen[label]
                for y in range(size)
            ]
        )
    return [x - y for x, y in zip(logs[1], logs[0])]


def log_ratio(string: str, model: list[float]) -> str:
    """SQL of the log-likelihood ratio of a string, random over ordinary; unknown characters count 0."""
    size = len(ALPHABET)
    table = ",".join(f"{v:.6f}" for v in model)
    # Each part is scored with the first character of the next one.
    part = "split(concat(part, coalesce(substring(get(parts, i + 1), 1, 1), '')), '')"
    pairs = _let(
        part, "chars",
        f"""aggregate(
          zip_with(
            slice(chars, 1, size(chars) - 1), slice(chars, 2, size(chars) - 1),
            (x, y) -> if(instr('{ALPHABET}', x) > 0 and instr('{ALPHABET}', y) > 0,
              element_at(cast(split('{table}', ',') as array<double>),
                (instr('{ALPHABET}', x) - 1) * {size} + instr('{ALPHABET}', y)), 0D)),
          0D, (s, v) -> s + v)""",
    )
    return _let(_chunks(string), "parts", f"aggregate(transform(parts, (part, i) -> {pairs}), 0D, (s, v) -> s + v)")


def secret_spans(docs: DataFrame, model: list[float], nats_per_char: float = NATS_PER_CHAR, text_col: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``spans``: pattern spans, and these with the random strings.

    Pattern spans are blanked out of the text. A run of 20 or more key characters
    in the rest is random if its log-likelihood ratio is at least
    ``nats_per_char`` for each of its pairs.
    Spans are ``struct<start, end, rank, kind>`` in code points, by start, then
    kind. Null and empty texts have none. Whole texts are scanned, in a time that
    hardly grows faster than their length.
    """
    text = "__text"
    found = with_base_spans(docs.withColumn(text, F.coalesce(F.col(text_col).cast("string"), F.lit(""))), text, "base")
    blank = "repeat(' ', cast(s.end - greatest(s.start, at) as int))"
    rest = f"if(size(base) = 0, {text}, {_replaced(text, 'base', 's.end > at', blank)})"
    score = _let("m.string", "string", f"{log_ratio('string', model)} >= {float(nats_per_char)}D * (m.end - m.start - 1)")
    random = _plain(f"filter({_matches('rest', CANDIDATE, 0, LONG, len(KINDS), RANDOM)}, m -> {score})")
    return found.withColumn("spans", F.array_sort(F.concat("base", F.expr(_let(rest, "rest", random))))).drop(text)


def listed(spans: str) -> Column:
    """Spans as text: ``kind:start:end``, comma-joined."""
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")


def redacted(text: str, spans: str, mark: str = "[SECRET]") -> Column:
    """Text with each run of overlapping or touching spans replaced by ``mark``; null stays null.

    ``spans`` are sorted by start.
    """
    return F.expr(f"if(size({spans}) = 0, {text}, {_replaced(text, spans, 'i = 0 or s.start > at', f"'{mark}'")})")
