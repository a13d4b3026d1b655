"""Alignment of two tokenizers: groups of tokens over the same bytes, and how common their links are."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.scratch import scratch_table
from scoreloom.llm.token_counts import _bytes_of_characters

SLICE_CHARS = 1 << 18
CACHED_PARTS = 1 << 17
HELD_PAIRS = 1 << 19
COMMON_PAIRS = 1 << 19
_A_SHIFT, _B_MASK = 16, 0xFFFF
_SAME = 1 << 33

# Characters that no version of either library takes for a space, and the places between two parts.
_SAFE = {chr(c) for c in (*range(0x21, 0x7F), *range(0xC0, 0x250))}
_CUT = re.compile("(?<=[!-~À-ɏ]) (?=[!-~À-ɏ])")

_KEPT = ("id", "row_key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")

Encode = Callable[[list[str]], list[list[int]]]
_ALIGNED = (
    "n_a long, n_b long, n_groups long, n_links long, groups string, groups_sha256 string, "
    "same array<int>, n_same array<int>, other array<int>, n_other array<int>"
)


class Tokenizers:
    """Both libraries, made once per task from the contents of their files."""

    def __init__(self, file_a: str, model_b: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        a = Tokenizer.from_str(file_a)
        a.encode_special_tokens = True
        b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        byte_of = _bytes_of_characters()
        self.bytes_a = [bytes(byte_of.get(c, 0) for c in a.id_to_token(i) or "") for i in range(a.get_vocab_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(b.id_to_piece(i) for i in range(b.get_piece_size()))
        ]
        whole = {p: i for i, p in enumerate(self.bytes_b) if not (b.is_byte(i) or b.is_control(i) or b.is_unknown(i))}
        single = {p: i for i, p in enumerate(self.bytes_b) if b.is_byte(i)}
        if max(len(self.bytes_a), len(self.bytes_b)) > _B_MASK + 1:
            raise ValueError("vocabularies of more than 65,536 ids")
        # Identity map: the B id with the same bytes as each A id, or -1.
        self.same = np.array([whole.get(p, single.get(p, -1)) for p in self.bytes_a], np.int64)
        # Whether single spaces always part tokens, on both sides.
        split = json.loads(file_a)["pre_tokenizer"] or {}
        self.cuts = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not any(b" " in p.lstrip(b" ") for p in self.bytes_b)
        self.encode_a: Encode = lambda texts: [e.ids for e in a.encode_batch_fast(texts, add_special_tokens=False)]
        self.encode_b: Encode = lambda texts: b.encode(texts, num_threads=1)


class Aligner:
    """Aligns texts part by part; parts are kept, as most come again.

    A part ends before a single space between two characters that are surely no
    spaces. No token of either side reaches over such a place: A splits there
    before it merges, and no piece of B has a space after another character
    (checked; else texts are one part each). So the parts of a text are
    tokenized and grouped as in the whole.
    """

    def __init__(self, tokenizers: Tokenizers):
        self.t = tokenizers
        self.sizes_a = np.array([len(p) for p in tokenizers.bytes_a])
        self.sizes_b = np.array([len(p) for p in tokenizers.bytes_b])
        # Each id as text with what may follow it: more of its side, or the other side or group.
        n = max(len(self.sizes_a), len(self.sizes_b))
        self.more, self.to_b, self.to_next = (np.array([f"{i}{end}" for i in range(n)], object) for end in ",|;")
        self._forget()

    def _forget(self) -> None:
        """Start anew without any part."""
        self.known: dict[str, int] = {}
        self.groups: list[str] = []
        self.counts = np.zeros((0, 4), np.int64)  # n_a, n_b, n_groups, n_links
        self.given_back = np.zeros(0, bool)
        self.link_keys, self.link_stops = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _one_by_one(self, parts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        a, b = self.t.encode_a([" " + p for p in parts]), self.t.encode_b(parts)
        for i, part in enumerate(parts):
            data = b" " + part.encode()
            if b"".join(map(self.t.bytes_a.__getitem__, a[i])) != data or b"".join(map(self.t.bytes_b.__getitem__, b[i])) != data:
                a[i] = b[i] = []
        return a, b

    def _together(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """``(ids, tokens per part)`` of both sides, from one text of all parts that safely ends each."""
        text = " ".join(parts)
        a, b = self.t.encode_a([" " + text])[0], self.t.encode_b([text])[0]
        data = b" " + text.encode()
        if b"".join(map(self.t.bytes_a.__getitem__, a)) != data or b"".join(map(self.t.bytes_b.__getitem__, b)) != data:
            return None
        stops = np.cumsum([1 + (len(p) if p.isascii() else len(p.encode())) for p in parts])
        out = []
        for ids, sizes in ((np.array(a, np.int64), self.sizes_a), (np.array(b, np.int64), self.sizes_b)):
            ends = np.cumsum(sizes[ids])
            at = np.searchsorted(ends, stops)
            if not np.array_equal(ends[at], stops):
                return None
            out += [ids, np.diff(at + 1, prepend=0)]
        return tuple(out)

    def _learn(self, parts: list[str]) -> None:
        safe = [p for p in parts if p[0] in _SAFE and p[-1] in _SAFE] if self.t.cuts else []
        found = self._together(safe) if safe else None
        rest = parts
        if found:
            self._add(safe, *found, np.ones(len(safe), bool))
            rest = [p for p in parts if p not in self.known]
        if rest:
            a, b = self._one_by_one(rest)
            n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in (a, b))
            flat_a, flat_b = (np.array([i for ids in side for i in ids], np.int64) for side in (a, b))
            self._add(rest, flat_a, n_a, flat_b, n_b, n_a > 0)

    def _add(self, parts: list[str], ids_a: np.ndarray, n_a: np.ndarray, ids_b: np.ndarray, n_b: np.ndarray, given_back: np.ndarray) -> None:
        """Groups and links of consecutive parts, with arrays over all their tokens."""
        ends_a, ends_b = np.cumsum(self.sizes_a[ids_a]), np.cumsum(self.sizes_b[ids_b])
        # Parts end in both, so groups and links never reach over two parts.
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        cuts = np.union1d(ends_a, ends_b)  # each piece between cuts is the overlap of one pair
        place_a, place_b = np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts)
        link_a, link_b = ids_a[place_a], ids_b[place_b]
        part_of_a = np.repeat(np.arange(len(parts)), n_a)
        last_a = np.append(group_a[1:] != group_a[:-1], True)[: len(ids_a)]
        last_b = np.append(group_b[1:] != group_b[:-1], True)[: len(ids_b)]
        written = np.concatenate(
            [np.where(last_a, self.to_b[ids_a], self.more[ids_a]), np.where(last_b, self.to_next[ids_b], self.more[ids_b])]
        )[np.argsort(np.concatenate([group_a * 2, group_b * 2 + 1]), kind="stable")].tolist()
        stops = np.cumsum(n_a + n_b).tolist()
        self.groups += ["".join(written[i:j])[:-1] for i, j in zip([0, *stops], stops)]
        n_groups, n_links = (np.bincount(part_of_a[x], minlength=len(parts)) for x in (last_a, place_a))
        # Pairs of the identity map are keyed by A id, the others by both ids.
        keys = np.where(self.t.same[link_a] == link_b, _SAME | link_a, (link_a << _A_SHIFT) | link_b)
        first = len(self.link_keys)
        self.known.update(zip(parts, range(len(self.known), len(self.known) + len(parts))))
        self.counts = np.concatenate([self.counts, np.stack([n_a, n_b, n_groups, n_links], axis=1)])
        self.given_back = np.concatenate([self.given_back, given_back])
        self.link_keys = np.concatenate([self.link_keys, keys])
        self.link_stops = np.concatenate([self.link_stops, first + np.cumsum(n_links)])

    def align(self, texts: list[str | None], with_groups: bool) -> Iterator[tuple]:
        """Per text the columns of ``_ALIGNED``; nothing where a part is not given back byte by byte."""
        cut = _CUT.split if self.t.cuts else lambda text: [text]
        parts = [cut(text) if text else [] for text in texts]
        needed = set().union(*parts)
        if len(self.known) + len(needed) > CACHED_PARTS:
            self._forget()
        self._learn([p for p in needed if p not in self.known])
        of_text = [[self.known[p] for p in of] for of in parts]
        of_text = [of if self.given_back[of].all() else [] for of in of_text]
        ids = np.array([i for of in of_text for i in of], np.int64)
        row = np.repeat(np.arange(len(texts)), [len(of) for of in of_text])
        counts = [np.bincount(row, self.counts[ids, k], minlength=len(texts)).astype(np.int64).tolist() for k in range(4)]
        # Distinct parts of each text, then the distinct pairs of their links.
        held, times = np.unique((row << 32) | ids, return_counts=True)
        row, ids = held >> 32, held & 0xFFFFFFFF
        n = self.counts[ids, 3]
        stop = np.cumsum(n)
        links = np.arange(int(n.sum())) + np.repeat(self.link_stops[ids] - stop, n)
        pairs, at = np.unique((np.repeat(row, n) << 34) | self.link_keys[links], return_inverse=True)
        total = np.bincount(at, np.repeat(times, n), minlength=len(pairs)).astype(np.int32)
        keys, row = pairs & ((1 << 34) - 1), pairs >> 34
        lists = []
        for rows in ((keys & _SAME) > 0, (keys & _SAME) == 0):
            lists.append(((keys[rows] & 0xFFFFFFFF).astype(np.uint32).view(np.int32), total[rows], np.searchsorted(row[rows], np.arange(len(texts) + 1))))
        for i, of in enumerate(of_text):
            groups = ";".join([self.groups[k] for k in of])
            digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
            found = [x[bounds[i] : bounds[i + 1]] for keys, n, bounds in lists for x in (keys, n)]
            yield (*(c[i] for c in counts), groups if with_groups else "", digest, *found)


def _slices(texts: list[str | None], limit: int = SLICE_CHARS) -> Iterator[list[str | None]]:
    """Consecutive texts of about ``limit`` characters together; a longer one is alone."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text or "") > limit:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text or "")
    if part:
        yield part


def align_tokens(
    docs: DataFrame, file_a: str, model_b: bytes, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = True
) -> DataFrame:
    """Aligned tokens of every row of ``docs``, in its order.

    ``file_a`` is the text of a byte-level BPE file, encoded over a space and the
    text with special strings as plain text; ``model_b`` the contents of a
    sentencepiece model that adds the space itself. Returns ``(<id>, n_a, n_b,
    n_groups, n_links, groups, groups_sha256, same, n_same, other, n_other)``:
    ``groups`` as ``a1,a2|b1;a3|b2`` (empty unless ``with_groups``), ``same`` the distinct A ids linked to the B
    id of the same bytes and ``other`` the distinct other pairs, as 65536 * A + B (as
    a signed int), each with its number of links.

    Null and empty texts, and texts that a tokenizer does not give back byte by
    byte, have no tokens: zeros, empty strings and lists. Texts are never cut;
    repeated rows are aligned each; other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = pa.schema(
        [(n, t) for n, t in zip(("n_a", "n_b", "n_groups", "n_links"), [pa.int64()] * 4)]
        + [("groups", pa.string()), ("groups_sha256", pa.string())]
        + [(n, pa.list_(pa.int32())) for n in ("same", "n_same", "other", "n_other")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(Tokenizers(file_a, model_b))
        for batch in batches:
            start = 0
            for part in _slices(batch.column("text").to_pylist()):
                columns = list(zip(*aligner.align(part, with_groups)))
                arrays = [pa.array(c, f.type) for c, f in zip(columns, schema)]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(start, len(part)), *arrays], ["id", *schema.names])
                start += len(part)

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, f"id {id_type}, {_ALIGNED}").withColumnRenamed("id", id_col)


def _document_counts(n_a: int):
    """How many documents hold each pair: a vector over the A ids, and sorted arrays of other pairs."""

    def rows(keys: np.ndarray, n: np.ndarray, same: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(np.full(len(keys), same))], ["pair", "n", "same"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(n_a, np.int64)
        keys, counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        for batch in batches:
            vector += np.bincount(batch.column("same").flatten().to_numpy(), minlength=n_a)
            found, n = np.unique(batch.column("other").flatten().to_numpy().view(np.uint32), return_counts=True)
            every, at = np.unique(np.concatenate([keys, found]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, n]), minlength=len(every)).astype(np.int64)
            keys = every
            if len(keys) > HELD_PAIRS:
                yield rows(keys, counts, False)
                keys, counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        yield rows(np.flatnonzero(vector), vector[vector > 0], True)
        yield rows(keys, counts, False)

    return run


def _common_pairs(counts: DataFrame, most: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """``(least, pairs, n, best)``: pairs of at least ``least`` documents, not more than ``most`` of them.

    ``least`` is a power of two chosen from a histogram of at most 64 rows.
    """
    level = F.floor(F.log2("n")).cast("int")
    sizes = {r["level"]: r["count"] for r in counts.groupBy(level.alias("level")).count().collect()}
    level, total = max(sizes, default=0) + 1, 0
    while level > 0 and total + sizes.get(level - 1, 0) <= most:
        level -= 1
        total += sizes.get(level, 0)
    found = counts.where(F.col("n") >= 2**level).select("pair", "n", "best").toPandas().sort_values("pair")
    return 2**level, found["pair"].to_numpy(np.int64), found["n"].to_numpy(np.int64), found["best"].to_numpy(bool)


def _scored(n_by_id: np.ndarray, best_by_id: np.ndarray, pairs: np.ndarray, n_by_pair: np.ndarray, best_by_pair: np.ndarray):
    """Sums over the links of each row whose counts are at hand, and the pairs that are left."""
    # A last entry that matches nothing, so that a search always lands on one.
    pairs = np.append(pairs, np.int64(1) << 40)
    n_by_pair, best_by_pair = np.append(n_by_pair, 0), np.append(best_by_pair, False)

    def sums(column: pa.Array, values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return np.diff(total[column.offsets.to_numpy() - column.offsets[0].as_py()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same, other = batch.column("same"), batch.column("other")
            ids, n = same.flatten().to_numpy(), batch.column("n_same").flatten().to_numpy().astype(np.int64)
            keys = other.flatten().to_numpy().view(np.uint32).astype(np.int64)
            m = batch.column("n_other").flatten().to_numpy().astype(np.int64)
            at = np.searchsorted(pairs, keys)
            known = pairs[at] == keys
            known_m = np.where(known, m, 0)
            count_sum = sums(same, n * n_by_id[ids]) + sums(other, known_m * n_by_pair[at])
            n_best = sums(same, n * best_by_id[ids]) + sums(other, known_m * best_by_pair[at])
            left = np.concatenate([[0], np.cumsum(sums(other, (~known).astype(np.int64)))]).astype(np.int32)
            rest = [pa.ListArray.from_arrays(pa.array(left), pa.array(x[~known])) for x in (keys, m)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in _KEPT], pa.array(n_best), pa.array(count_sum), *rest],
                [*_KEPT, "n_best", "count_sum", "pairs", "times"],
            )

    return run


def token_alignment(
    docs: DataFrame,
    file_a: str,
    model_b: bytes,
    common_pairs: int = COMMON_PAIRS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(<id>, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of every row.

    A pair's count is the number of rows that hold it linked. ``count_sum`` adds
    the counts of all links of a row, ``n_best`` counts the links whose count is
    the highest of their A id.

    Both tokenizers run once; what they find is kept as distinct pairs per row.
    Pairs of the identity map (same bytes) are counted in vectors over the A ids,
    only the others go through a shuffle. Their counts come back in two ways: a bounded
    number of the commonest pairs as arrays, all rarer ones by a join. Edge cases
    are those of ``align_tokens``; an empty table gives an empty result.
    """
    vocabulary = len(Tokenizers(file_a, model_b).bytes_a)
    aligned = align_tokens(docs, file_a, model_b, id_col, text_col, with_groups=False).drop("groups")
    aligned = scratch_table(aligned.withColumn("row_key", F.monotonically_increasing_id()).withColumnRenamed(id_col, "id"), "aligned")
    counted = aligned.select("same", "other").mapInArrow(_document_counts(vocabulary), "pair long, n long, same boolean")
    counted = counted.groupBy("same", "pair").agg(F.sum("n").alias("n"))
    counted = scratch_table(counted.withColumn("a", F.when(F.col("same"), F.col("pair")).otherwise(F.shiftright("pair", _A_SHIFT))), "pair-counts")
    # One row per A id, so both tables fit the vocabulary.
    same_n = F.coalesce(F.max(F.when(F.col("same"), F.col("n"))), F.lit(0))
    highest = counted.groupBy("a").agg(F.max("n").alias("highest"), same_n.alias("same_n"))
    n_by_id, best_by_id = np.zeros(vocabulary, np.int64), np.zeros(vocabulary, np.int64)
    for r in highest.collect():
        n_by_id[r["a"]], best_by_id[r["a"]] = r["same_n"], r["same_n"] == r["highest"]
    others = counted.where(~F.col("same")).join(F.broadcast(highest.select("a", "highest")), "a")
    others = scratch_table(others.select("pair", "n", (F.col("n") == F.col("highest")).alias("best")), "other-pairs")
    least, pairs, n_by_pair, best_by_pair = _common_pairs(others, common_pairs)
    types = {f.name: f.dataType.simpleString() for f in aligned.schema.fields}
    schema = ", ".join(f"{c} {types[c]}" for c in _KEPT) + ", n_best long, count_sum long, pairs array<long>, times array<long>"
    score = _scored(n_by_id, best_by_id, pairs, n_by_pair, best_by_pair)
    scored = scratch_table(aligned.mapInArrow(score, schema), "scored-links")
    # A rarer pair is in less than ``least`` rows, so no key of this join is hot.
    rare = (
        scored.select("row_key", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
        .select("row_key", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
        .join(others.where(F.col("n") < least), "pair")
        .groupBy("row_key")
        .agg(F.sum(F.col("times") * F.col("n")).alias("more_sum"), F.sum(F.col("times") * F.col("best").cast("long")).alias("more_best"))
    )
    return scored.join(rare, "row_key", "left").select(
        F.col("id").alias(id_col),
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
