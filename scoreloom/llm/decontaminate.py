"""Benchmark passages in documents: prefix-filtered join of rare shingles, verified over item windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.llm.scratch import bitmap, has_bit, perhaps_in, scratch_table
from scoreloom.llm.words import LETTER_OR_DIGIT, LOWER, shingle_hashes, text_slices, word_hashes, word_spans

SHINGLE = 3
TOKEN_BITS = 1 << 23
ROW_BITS = 1 << 25


def _item_windows(window: int):
    """``(item, window, length, tokens)`` per run of ``window`` words; a shorter item is one run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_slices(batch.column("text")):
                inside, starts, ends, of = word_spans(data, offsets, LETTER_OR_DIGIT)
                hashes = word_hashes(data, inside, starts, ends, LOWER)
                folded = LOWER[data].tobytes()
                words = [folded[a:b].decode() for a, b in zip(starts, ends)]
                at = np.searchsorted(starts, offsets)
                items, texts, lengths, tokens = [], [], [], []
                for i in range(len(offsets) - 1):
                    a, b = int(at[i]), int(at[i + 1])
                    size = min(window, b - a)
                    if size == 0:
                        continue
                    of_item = shingle_hashes(hashes[a:b], min(SHINGLE, size)).view(np.int64).tolist()
                    for s in range(b - a - size + 1):
                        items.append(first + i)
                        texts.append(" ".join(words[a + s : a + s + size]))
                        lengths.append(size)
                        tokens.append(of_item[s : s + size - min(SHINGLE, size) + 1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item").take(pa.array(items, pa.int64())), pa.array(texts, pa.string()), pa.array(lengths, pa.int32()), pa.array(tokens, pa.list_(pa.int64()))],
                    ["item", "window", "length", "tokens"],
                )

    return run


def _counts(sizes: list[int], tokens: np.ndarray):
    """How often shingles of the bitmap occur in the documents, summed per slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in text_slices(batch.column("text")):
                inside, starts, ends, of = word_spans(data, offsets, LETTER_OR_DIGIT)
                hashes = word_hashes(data, inside, starts, ends, LOWER)
                for q in sizes:
                    if len(hashes) < q:
                        continue
                    s = shingle_hashes(hashes, q)
                    s = s[has_bit(tokens, s) & (of[: len(s)] == of[q - 1 :])]
                    found, n = np.unique(s, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], ["token", "n"])

    return run


def _candidates(sizes: list[int], tokens: np.ndarray, reach: int):
    """Per document the number of words, and each place of a prefix token with the words around it."""
    place = pa.struct([("at", pa.int64()), ("token", pa.int64()), ("lead", pa.int32()), ("around", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, found = [], []
            for _, data, offsets in text_slices(batch.column("text")):
                inside, starts, ends, of = word_spans(data, offsets, LETTER_OR_DIGIT)
                hashes = word_hashes(data, inside, starts, ends, LOWER)
                bounds = np.searchsorted(starts, offsets)
                n_words.append(np.diff(bounds))
                places: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
                for q in sizes:
                    if len(hashes) < q:
                        continue
                    s = shingle_hashes(hashes, q)
                    for p in np.flatnonzero(has_bit(tokens, s) & (of[: len(s)] == of[q - 1 :])).tolist():
                        i = int(of[p])
                        a, b = max(int(bounds[i]), p - reach), min(int(bounds[i + 1]), p + reach + 1)
                        words = b" ".join(LOWER[data[x:y]].tobytes() for x, y in zip(starts[a:b], ends[a:b]))
                        places[i].append({"at": p - int(bounds[i]), "token": int(s[p : p + 1].view(np.int64)[0]), "lead": p - a, "around": words.decode()})
                found += places
            counts = np.concatenate(n_words) if n_words else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("row_key"), pa.array(counts.astype(np.int64)), pa.array(found, pa.list_(place))],
                ["doc", "row_key", "n_words", "places"],
            )

    return run


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
) -> tuple[DataFrame, DataFrame]:
    """``(documents, occurrences)`` of benchmark windows in ``docs``.

    Words are runs of ASCII letters, digits and other than ASCII characters, A-Z
    lower-cased. A window is ``window`` consecutive words of an item; a shorter
    item is one window. ``documents`` has ``(<id>, row_key, n_words)`` for every
    row; ``occurrences`` has ``(row_key, start, length, window, items)``, one
    row per place of a window and ``items`` the items that hold it as a table
    ``(window, item)`` joined by the caller, see ``contamination``.

    A window occurs only where its rarest shingle (over all documents) occurs:
    that prefix token is joined, the place and the document's length must leave
    room for the window, and then all its words are compared.

    Null and empty texts have no words; a null item id has windows too.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    item_type = benchmark.schema[item_col].dataType.simpleString()
    texts = docs.select(
        F.col(id_col).alias("doc"), F.xxhash64(id_col, text_col).alias("row_key"), F.col(text_col).cast("string").alias("text")
    )
    items = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("text"))
    windows = scratch_table(
        items.mapInArrow(_item_windows(window), f"item {item_type}, window string, length int, tokens array<long>"),
        "benchmark-windows",
    )
    shingles = windows.select("window", "length", F.posexplode("tokens").alias("offset", "token")).distinct()
    sizes = [r[0] for r in windows.select(F.least("length", F.lit(SHINGLE))).distinct().collect()]  # 1 to SHINGLE

    counted = texts.select("text").mapInArrow(_counts(sizes, bitmap(shingles, F.col("token"), TOKEN_BITS)), "token long, n long")
    counted = counted.groupBy("token").agg(F.sum("n").alias("n"))
    rarest = shingles.join(counted, "token", "left").groupBy("window", "length").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "offset")).alias("rarest")
    )
    # A window with a shingle that no document holds occurs nowhere.
    prefix = scratch_table(
        rarest.where("rarest.n > 0").select("window", "length", "rarest.token", "rarest.offset"), "benchmark-prefix"
    )
    places = scratch_table(
        texts.mapInArrow(
            _candidates(sizes, bitmap(prefix, F.col("token"), TOKEN_BITS), window - 1),
            f"doc {id_type}, row_key long, n_words long, "
            "places array<struct<at: long, token: long, lead: int, around: string>>",
        ),
        "benchmark-places",
    )
    candidates = places.select("row_key", "n_words", F.explode("places").alias("p")).select("row_key", "n_words", "p.*").distinct()
    around = F.split("around", " ")
    occurrences = (
        candidates.join(prefix, "token")
        .where("at >= offset and at - offset + length <= n_words")
        .where(F.array_join(F.slice(around, F.col("lead") - F.col("offset") + 1, F.col("length")), " ") == F.col("window"))
        .select("row_key", (F.col("at") - F.col("offset")).alias("start"), "length", "window")
    )
    occurrences = scratch_table(occurrences, "benchmark-occurrences")
    owners = windows.select("window", "item").where("item is not null").distinct()
    return places.select(F.col("doc").alias(id_col), "row_key", "n_words"), occurrences.join(
        owners.groupBy("window").agg(F.collect_set(F.col("item").cast("string")).alias("items")), "window", "left"
    )


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """``(<id>, n_words, n_hit, items, contaminated)`` of every row of ``docs``.

    ``n_hit`` counts the words inside any occurrence of a window, each once;
    ``items`` are the ids of the items with occurring windows as sorted strings.
    Repeated rows have equal results. An empty benchmark hits nothing.
    """
    documents, found = benchmark_hits(docs, benchmark, window, id_col, text_col, item_col)
    order = W.partitionBy("row_key").orderBy("start", "length").rowsBetween(W.unboundedPreceding, -1)
    spans = found.groupBy("row_key", "start").agg(F.max("length").alias("length"))
    fresh = F.col("start") + F.col("length") - F.greatest(
        F.col("start"), F.coalesce(F.max(F.col("start") + F.col("length")).over(order), F.lit(0))
    )
    hit = spans.select("row_key", F.greatest(fresh, F.lit(0)).alias("fresh")).groupBy("row_key").agg(F.sum("fresh").alias("n_hit"))
    names = found.select("row_key", F.explode("items").alias("item")).distinct()
    names = names.groupBy("row_key").agg(F.array_sort(F.collect_list("item")).alias("items"))
    return (
        documents.join(hit.join(names, "row_key", "left"), "row_key", "left")
        .select(
            id_col,
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        )
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark window, unchanged.

    Rows that surely hold none, by a bitmap of fixed size, stay where they are;
    only the others are joined.
    """
    _, found = benchmark_hits(docs, benchmark, window, id_col, text_col, item_col)
    marked = docs.withColumn("__row_key", F.xxhash64(id_col, text_col))
    hit = scratch_table(found.select(F.col("row_key").alias("__row_key")).distinct(), "benchmark-rows")
    perhaps = perhaps_in(bitmap(hit, F.col("__row_key"), ROW_BITS), F.col("__row_key"))
    return marked.where(~perhaps).union(marked.where(perhaps).join(hit, "__row_key", "left_anti").select(marked.columns)).drop("__row_key")
