"""Repeated passages: a sorted array of sparse suffixes at minimiser positions.

Suffixes start where a word gram is the smallest of its window, so equal passages
have them at equal places. They are dealt by ranges and sorted; neighbours with
equal first words are extended to the right in this order, and to the left in the
order of the words before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.llm.scratch import bitmap, has_bit, scratch_table
from scoreloom.llm.words import AS_IS, NOT_SPACE, mix, shingle_hashes, text_slices, word_hashes, word_spans

GRAM = 4
ANCHOR_BITS = 1 << 26
PLACE_BITS = 1 << 26
BLOCK_ROWS = 2_000
ENTRY = "row_key long, at long, suffix binary, right binary, left binary, n_right long, n_left long"


def _slide(values: np.ndarray, size: int, best: np.ufunc) -> np.ndarray:
    """Minimum or maximum of every run of ``size`` values, by doubling."""
    width, out = 1, values
    while 2 * width <= size:
        out = best(out[:-width], out[width:])
        width *= 2
    rest = size - width
    return best(out[:-rest], out[rest:]) if rest else out


def anchor_places(grams: np.ndarray, of: np.ndarray, window: int) -> np.ndarray:
    """Places whose gram is the smallest of some run of ``window`` grams of one text.

    Equal passages have equal grams, so a passage of ``window`` grams holds an
    anchor at the same place wherever it occurs. ``of`` is the text of each word.
    """
    if len(grams) < window:
        return np.zeros(0, np.int64)
    least = _slide(grams, window, np.minimum)
    last = len(of) - len(least)
    least[of[: len(least)] != of[last:]] = 0
    edge = np.zeros(window - 1, np.uint64)
    highest = _slide(np.concatenate((edge, least, edge)), window, np.maximum)
    return np.flatnonzero(highest == grams)


def run_hashes(words: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Two independent hashes of the ``k`` words from each place on."""
    out = np.zeros((2, len(at)), np.uint64)
    factors = mix(np.arange(1, 2 * k + 1, dtype=np.uint64)).reshape(2, k) | np.uint64(1)
    for j in range(k):
        word = words[at + j]
        out[0] += word * factors[0, j]
        out[1] += mix(word) * factors[1, j]
    return mix(out)


def place_key(row_keys: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of a row and a place in it."""
    return mix(row_keys ^ mix(at.astype(np.uint64)))


class _Passages:
    """Sizes that follow from the length of a passage."""

    def __init__(self, words: int):
        if words < 2 * GRAM:
            raise ValueError(f"passages of at least {2 * GRAM} words")
        self.words = words
        self.window = max(1, (words - GRAM + 1) // 2)
        self.suffix = words - self.window + 1  # the first anchor of a passage has so many words after it

    def slices(self, batch: pa.RecordBatch) -> Iterator[tuple]:
        """Per slice: first row, bounds of the rows, row of each word, word hashes, and anchors with a suffix."""
        for first, data, offsets in text_slices(batch.column("text")):
            inside, starts, ends, of = word_spans(data, offsets, NOT_SPACE)
            hashes = word_hashes(data, inside, starts, ends, AS_IS)
            bounds = np.searchsorted(starts, offsets)
            anchors = anchor_places(shingle_hashes(hashes, GRAM), of, self.window)
            anchors = anchors[anchors + self.suffix <= bounds[of[anchors] + 1]] if len(anchors) else anchors
            yield first, bounds, of, hashes, anchors, run_hashes(hashes, anchors, self.suffix)[0]

    def suffixes(self):
        """Key and number of the sparse suffixes of each slice."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for *_, keys in self.slices(batch):
                    found, n = np.unique(keys, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"])

        return run

    def extended(self, shared: np.ndarray):
        """Suffixes with a twin, extended both ways by what any passage over them can reach.

        ``whole`` and ``check`` are 128 bits of the extended match, null where the text ends first.
        """

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                row_keys = batch.column("row_key").to_numpy().view(np.uint64)
                for first, bounds, of, hashes, anchors, keys in self.slices(batch):
                    stay = has_bit(shared, keys)
                    anchors, keys = anchors[stay], keys[stay]
                    rows = of[anchors]
                    left, right = anchors - self.window + 1, anchors + self.words
                    fits = (left >= bounds[rows]) & (right <= bounds[rows + 1])
                    both = np.zeros((2, len(anchors)), np.uint64)
                    both[:, fits] = run_hashes(hashes, left[fits], self.words + self.window - 1)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("row_key").take(pa.array(first + rows)),
                            pa.array(anchors - bounds[rows]),
                            pa.array(keys.view(np.int64)),
                            *(pa.array(h.view(np.int64), mask=~fits) for h in both),
                            pa.array(place_key(row_keys[first + rows], anchors - bounds[rows]).view(np.int64)),
                        ],
                        ["row_key", "at", "key", "whole", "check", "place"],
                    )

        return run

    def _open(self, batch: pa.RecordBatch, keys_wanted: np.ndarray, places_wanted: np.ndarray) -> Iterator[tuple]:
        """Slices with those anchors whose key and place are in the bitmaps."""
        row_keys = batch.column("row_key").to_numpy().view(np.uint64)
        for first, bounds, of, hashes, anchors, keys in self.slices(batch):
            rows = of[anchors]
            stay = has_bit(keys_wanted, keys) & has_bit(places_wanted, place_key(row_keys[first + rows], anchors - bounds[rows]))
            anchors, rows = anchors[stay], rows[stay]
            yield first + rows, bounds[rows], bounds[rows + 1], hashes, anchors, keys[stay]

    def entries(self, keys_wanted: np.ndarray, hot: np.ndarray, places_wanted: np.ndarray):
        """Entries of the suffix array: the first words of the suffix in blocks, and the words around them.

        ``suffix`` orders by words (their hashes, in blocks of ``GRAM``), ``right`` goes on
        word by word, ``left`` goes back from the anchor. Beyond the text there are zeros.
        """
        blocks = [*range(0, self.suffix - GRAM, GRAM), self.suffix - GRAM]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows, low, high, hashes, anchors, keys in self._open(batch, keys_wanted, places_wanted):
                    grams = shingle_hashes(hashes, GRAM)
                    last = len(hashes) - 1
                    n_left = np.minimum(anchors - low, self.window - 1)
                    n_right = np.minimum(high - anchors - self.suffix, self.window - 1)
                    left, right = (np.zeros((len(anchors), self.window - 1), np.uint64) for _ in range(2))
                    for j in range(self.window - 1):
                        left[:, j] = np.where(j < n_left, hashes[np.maximum(anchors - 1 - j, 0)], 0)
                        right[:, j] = np.where(j < n_right, hashes[np.minimum(anchors + self.suffix + j, last)], 0)
                    suffix = grams[anchors[:, None] + np.array(blocks)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("row_key").take(pa.array(rows)),
                            pa.array(anchors - low),
                            *(_binary(m) for m in (suffix, right, left)),
                            pa.array(n_right),
                            pa.array(n_left),
                            pa.array(has_bit(hot, keys)),
                        ],
                        ["row_key", "at", "suffix", "right", "left", "n_right", "n_left", "hot"],
                    )

        return run

    def neighbours(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Spans of repeated passages from entries in order; a range is whole in one partition."""
        kept = None
        for batch in batches:
            kept = pa.Table.from_batches([batch] if kept is None else [*kept.to_batches(), batch])
            ranges = kept.column("range")
            at = pc.index(ranges, ranges[len(kept) - 1]).as_py()  # the last range may go on in the next batch
            if at:
                yield self._matched(kept.slice(0, at))
                kept = kept.slice(at)
        if kept is not None and len(kept):
            yield self._matched(kept)

    def _matched(self, table: pa.Table) -> pa.RecordBatch:
        """Passages that two entries of one range share, with their extensions to the left and right.

        Equal to the right by k words more are runs of the suffix order in which each
        entry agrees with its neighbour so far; equal to the left by d words, runs of
        the order by the words before. Entries in the same run of both share a passage.
        """
        part, right, left = (_matrix(table.column(c)) for c in ("range", "right", "left"))
        row_key, at, n_right, n_left, low, high = (
            table.column(c).to_numpy() for c in ("row_key", "at", "n_right", "n_left", "low", "high")
        )
        most, m = self.window - 1, len(table)
        block = np.cumsum(np.concatenate(([True], (part[1:] != part[:-1]).any(axis=1))))
        order = np.lexsort((*right.T[::-1], block))
        back = np.lexsort((*left.T[::-1], block))
        to_right, to_left = _common(right[order], block[order]), _common(left[back], block[back])
        place = np.lexsort((at, row_key))
        state = np.zeros((m, most + 2), np.int8)
        run_right, run_left = np.zeros(m, np.int64), np.zeros(m, np.int64)
        for d in range(most + 1):
            run_right[order] = np.cumsum(to_right < most - d)
            run_left[back] = np.cumsum(to_left < d)
            here = place[((n_left >= d) & (n_right >= most - d) & (low <= d) & (d <= high))[place]]
            _, lead, of, n = np.unique(
                run_left[here] * (m + 1) + run_right[here], return_index=True, return_inverse=True, return_counts=True
            )
            state[here, d] = np.where(n[of] > 1, np.where(lead[of] == np.arange(len(here)), 1, 2), 0)
        # Passages that start at consecutive words are one span.
        flat = state.ravel()
        cut = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
        stop = np.concatenate((cut[1:], [len(flat)])) - 1
        stay = flat[cut] > 0
        cut, stop = cut[stay], stop[stay]
        entry = cut // (most + 2)
        start, end = at[entry] - stop % (most + 2), at[entry] - cut % (most + 2) + self.words
        return pa.RecordBatch.from_arrays(
            [pa.array(row_key[entry]), pa.array(start), pa.array(end), pa.array(flat[cut] == 1)],
            ["row_key", "start", "end", "first"],
        )

    def halves(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Entries of a hot range, for the nearer and the farther half of the starts that they stand for.

        The passages of a half, which start ``low`` to ``high`` words before the anchor, have
        more words in common: the new ``range``. ``whole`` and ``check`` are all words that any
        of them reaches, null where the text ends first.
        """
        for batch in batches:
            suffix, right, left = (_matrix(batch.column(c)) for c in ("suffix", "right", "left"))
            n_right, n_left, lows, highs = (batch.column(c).to_numpy() for c in ("n_right", "n_left", "low", "high"))
            for low, high in np.unique(np.stack((lows, highs)), axis=1).T.tolist():
                middle = (low + high) // 2
                for a, b in ((low, middle), (middle + 1, high)):
                    here = np.flatnonzero(
                        (lows == low) & (highs == high) & (n_left >= a) & (n_right >= self.window - 1 - b)
                    )
                    fits = (n_left[here] >= b) & (n_right[here] >= self.window - 1 - a)
                    inner, outer = (
                        _row_hashes(np.hstack((suffix[here], left[here, :x], right[here, : self.window - 1 - y])))
                        for x, y in ((a, b), (b, a))
                    )
                    part = np.stack((np.full(len(here), a, np.uint64), *inner), axis=1)
                    kept = batch.take(pa.array(here))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(kept.column(c) for c in ("row_key", "at", "suffix", "right", "left", "n_right", "n_left")),
                            pa.array(np.full(len(here), a)),
                            pa.array(np.full(len(here), b)),
                            _binary(part),
                            *(pa.array(h.view(np.int64), mask=~fits) for h in outer),
                        ],
                        ["row_key", "at", "suffix", "right", "left", "n_right", "n_left", "low", "high", "range", "whole", "check"],
                    )


def _row_hashes(matrix: np.ndarray) -> np.ndarray:
    """Two independent hashes of the numbers of each row."""
    return run_hashes(matrix.ravel(), np.arange(len(matrix)) * matrix.shape[1], matrix.shape[1])


def _binary(matrix: np.ndarray) -> pa.Array:
    """One value per row: its numbers, so that bytes order as numbers do."""
    width = 8 * matrix.shape[1]
    return pa.Array.from_buffers(pa.binary(width), len(matrix), [None, pa.py_buffer(matrix.astype(">u8").tobytes())]).cast(pa.binary())


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">u8").reshape(len(column), -1).astype(np.uint64)


def _common(words: np.ndarray, block: np.ndarray) -> np.ndarray:
    """How many first words each row shares with the row before; -1 where a block starts."""
    same = np.zeros((len(words), words.shape[1] + 1), bool)
    same[1:, :-1] = words[1:] == words[:-1]
    starts = np.concatenate(([True], block[1:] != block[:-1]))
    return np.where(starts, -1, np.argmin(same, axis=1))


def repeated_spans(
    docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``(row_key, start, end, first)``: where passages of ``min_words`` words occur twice or more.

    Spans are in words (runs of other than white space), ``end`` exclusive, and may
    overlap; ``first`` marks passages at the first place of their words, by row key
    and place. ``row_key`` is ``xxhash64(<id>, <text>)``; of rows equal in both, one
    is looked at. Words are compared one by one as 64-bit hashes of a word; what is
    equal as far as any passage reaches, by 128 bits of all its words.

    A range of the order that more than ``block_rows`` entries share is split by
    deeper words, in halves of the starts that its entries stand for.
    """
    sizes = _Passages(min_words)
    rows = docs.select(F.xxhash64(id_col, text_col).alias("row_key"), F.col(text_col).cast("string").alias("text"))
    if not rows.groupBy("row_key").count().where("count > 1").isEmpty():
        rows = scratch_table(rows.dropDuplicates(["row_key"]), "repeats-rows")

    # Suffixes that stand alone by their first words cannot have an equal neighbour.
    shared = rows.select("text").mapInArrow(sizes.suffixes(), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    shared = bitmap(shared.where("n > 1"), F.col("key"), ANCHOR_BITS)

    # Of suffixes equal as far as any passage reaches, the first one goes on for all.
    found = scratch_table(
        rows.mapInArrow(sizes.extended(shared), "row_key long, at long, key long, whole long, check long, place long"),
        "repeats-suffixes",
    )
    fits = found.where("whole is not null")
    wholes = fits.groupBy("whole", "check").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row_key", "at")).alias("lead"))
    wholes = scratch_table(wholes.where("n > 1").select("whole", "check", "lead"), "repeats-whole")
    settled = fits.join(wholes, ["whole", "check"], "left").withColumn("first", F.col("lead") == F.struct("row_key", "at"))
    settled = scratch_table(settled.select("row_key", "at", "key", "place", "first"), "repeats-settled")
    long_spans = settled.where("first is not null").select(
        "row_key", (F.col("at") - sizes.window + 1).alias("start"), (F.col("at") + sizes.words).alias("end"), "first"
    )
    entries = settled.where("first is null or first").select("key", "place").union(found.where("whole is null").select("key", "place"))
    keys = scratch_table(entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeats-keys")
    open_keys, open_places = bitmap(keys, F.col("key"), ANCHOR_BITS), bitmap(entries, F.col("place"), PLACE_BITS)
    hot = bitmap(keys.where(F.col("n") > block_rows), F.col("key"), ANCHOR_BITS)

    # The sorted array of the sparse suffixes: ranges, order, neighbours, extensions.
    array = scratch_table(rows.mapInArrow(sizes.entries(open_keys, hot, open_places), f"{ENTRY}, hot boolean"), "repeats-array")
    array = array.withColumns({"low": F.lit(0).cast("long"), "high": F.lit(sizes.window - 1).cast("long"), "range": F.col("suffix")})
    spans = long_spans.union(_shared_spans(array.where("not hot"), sizes))
    parts = array.where("hot")
    while not parts.isEmpty():
        more, parts = _narrowed(parts, sizes, block_rows)
        spans = spans.union(more)
    return spans


def _shared_spans(entries: DataFrame, sizes: _Passages) -> DataFrame:
    """Spans that entries of one range share: ranges are dealt and sorted, neighbours compared."""
    columns = ("row_key", "at", "range", "right", "left", "n_right", "n_left", "low", "high")
    ordered = entries.select(*columns).repartitionByRange("range").sortWithinPartitions("range", "right")
    return ordered.mapInArrow(sizes.neighbours, "row_key long, start long, end long, first boolean")


def _narrowed(parts: DataFrame, sizes: _Passages, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """Spans of hot ranges by halves of their starts, and what of it is hot still.

    A half has deeper words. Entries that agree in all words of a half are repeated in
    the whole of it, so the first one goes on for all; a half of one start ends there.
    """
    halves = scratch_table(
        parts.mapInArrow(sizes.halves, f"{ENTRY}, low long, high long, range binary, whole long, check long"), "repeats-halves"
    )
    fits = halves.where("whole is not null")
    wholes = fits.groupBy("low", "whole", "check").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row_key", "at")).alias("lead"))
    wholes = scratch_table(wholes.where("n > 1").drop("n"), "repeats-half-wholes")
    settled = fits.join(wholes, ["low", "whole", "check"], "left").withColumn("first", F.col("lead") == F.struct("row_key", "at"))
    columns = [c for c in halves.columns if c not in ("whole", "check")]
    settled = scratch_table(settled.select(*columns, "first"), "repeats-half-settled")
    spans = settled.where("first is not null").select(
        "row_key", (F.col("at") - F.col("high")).alias("start"), (F.col("at") - F.col("low") + sizes.words).alias("end"), "first"
    )
    left = settled.where("first is null or first").select(*columns).union(halves.where("whole is null").select(*columns))
    counts = scratch_table(left.groupBy("range").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeats-half-ranges")
    left = scratch_table(left.join(counts, "range"), "repeats-half-left")
    within = (F.col("n") <= block_rows) & (F.col("low") < F.col("high"))
    return spans.union(_shared_spans(left.where(within), sizes)), left.where(~within & (F.col("low") < F.col("high")))


def _covered(spans: DataFrame, name: str) -> DataFrame:
    """Words of each row inside any span, and the merged spans as ``[start, end)`` pairs.

    There is one span for each start.
    """
    order = W.partitionBy("row_key").orderBy("start", "end")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    marked = spans.withColumn("reach", F.coalesce(F.max("end").over(before), F.lit(-1)))
    marked = marked.withColumn("part", F.sum((F.col("start") > F.col("reach")).cast("int")).over(order))
    merged = marked.groupBy("row_key", "part").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return merged.groupBy("row_key").agg(
        F.sum(F.col("end") - F.col("start")).alias(f"n_{name}"),
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias(f"{name}_spans"),
    )


def repeated_passages(docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document that holds a repeated passage of ``min_words`` words or more.

    ``(<id>, n_repeated, repeated_spans, n_later, later_spans)``: words inside such
    passages and their merged spans ``[start, end)`` in words; ``later`` leaves out
    passages at the first place of their words (by row key, then place).

    Null, empty and shorter texts hold none. A passage may occur twice in one
    text. Rows equal in id and text count once; a null id is an id like others.
    """
    # Dealt by row once; both coverages read the same exchange, as both use both ends.
    spans = repeated_spans(docs, min_words, id_col, text_col).repartition("row_key").groupBy("row_key", "start").agg(
        F.max("end").alias("end"), F.max(F.when(~F.col("first"), F.col("end"))).alias("later_end")
    )
    repeated = _covered(spans.select("row_key", "start", F.greatest("end", "later_end").alias("end")), "repeated")
    later = spans.where("later_end is not null and later_end <= end")
    later = _covered(later.select("row_key", "start", F.col("later_end").alias("end")), "later")
    ids = docs.select(F.col(id_col), F.xxhash64(id_col, text_col).alias("row_key"))
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return ids.join(repeated, "row_key").join(later, "row_key", "left").select(
        id_col,
        F.col("n_repeated").cast("long").alias("n_repeated"),
        "repeated_spans",
        F.coalesce("n_later", F.lit(0)).cast("long").alias("n_later"),
        F.coalesce("later_spans", empty).alias("later_spans"),
    )
