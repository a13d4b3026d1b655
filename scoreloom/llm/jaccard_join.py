"""Near duplicates by word-shingle Jaccard similarity: grouped prefix join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.components import connected_components
from scoreloom.llm.scratch import bitmap, has_bit, perhaps_in, scratch_table
from scoreloom.llm.words import LOWER, NOT_SPACE, mix, shingle_hashes, texts_of_words

HEAVY = 32
BUCKETS = 128
SET_BYTES = 6
FEW = 64
TILE = 512
COLUMNS = 1 << 14
HEAVY_BITS = 1 << 25
REPEATED_BITS = 1 << 26
WANTED_BITS = 1 << 23
JUDGED_BITS = 1 << 25


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Per text its distinct shingles as sorted hashes; fewer than ``k`` words are one shingle."""
    for _, rows, words, bounds in texts_of_words(column, NOT_SPACE, LOWER):
        shingles = shingle_hashes(words, k)
        for i in range(rows):
            a, b = bounds[i], bounds[i + 1]
            if b - a >= k:
                s = np.sort(shingles[a : b - k + 1])
                yield s[np.concatenate(([True], s[1:] != s[:-1]))]
            elif b > a:
                yield shingle_hashes(words[a:b], int(b - a)) ^ np.uint64(b - a)
            else:
                yield np.zeros(0, np.uint64)


def identity(s: np.ndarray) -> int:
    """64-bit key of a whole set."""
    with np.errstate(over="ignore"):
        total = np.bitwise_xor.reduce(mix(s)) + np.add.reduce(s) * np.uint64(3) + np.uint64(len(s))
        return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def prefix_length(n: int, percent: int) -> int:
    """Two sets at ``percent`` or more share a token among this many first ones of either."""
    return n - (percent * n + 99) // 100 + 1


def counted_length(n: int, percent: int) -> int:
    """This many lowest hashes of a set are counted to find the frequent ones."""
    return prefix_length(n, percent) * 3 // 2 + 8


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def signature(s: np.ndarray) -> bytes | None:
    """How many tokens fall into each bucket; None if a count does not fit a byte.

    The smaller counts of two sets add up to at least their overlap.
    """
    counts = np.bincount((s & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else None


def packed(s: np.ndarray) -> bytes:
    """A set as 48-bit hashes, in order."""
    return np.ascontiguousarray((s >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :SET_BYTES]).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // SET_BYTES, 8), np.uint8)
    out[:, :SET_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, SET_BYTES)
    return out.view(np.uint64).ravel()


def _fingerprints(k: int, percent: int):
    """Set size, set key, and the lowest hashes, half as many again as the prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, low = [], [], []
            for s in shingle_sets(batch.column("text"), k):
                sizes.append(len(s))
                keys.append(identity(s))
                low.append(s[: counted_length(len(s), percent)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), _lists(low)],
                ["row_id", "n", "class", "low"],
            )

    return run


def _prefixes(k: int, percent: int, heavy: np.ndarray):
    """The prefix of each set in the global order: rare tokens first, then by hash.

    ``deep`` are its tokens beyond the counted ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, whole, tokens, deep, buckets = [], [], [], [], [], []
            for s in shingle_sets(batch.column("text"), k):
                n = len(s)
                common = has_bit(heavy, s)
                prefix = np.concatenate((s[~common], s[common]))[: prefix_length(n, percent)] if n else s
                counted = s[: counted_length(n, percent)]
                sizes.append(n)
                keys.append(identity(s))
                whole.append(identity(prefix) if n else 0)
                tokens.append(prefix)
                deep.append(prefix[prefix > counted[-1]] if n else s)
                buckets.append(signature(s))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(whole, pa.int64()), _lists(tokens), _lists(deep), pa.array(buckets, pa.binary())],
                ["class", "n", "prefix", "tokens", "deep", "buckets"],
            )

    return run


def _joinable(repeated: np.ndarray, deep: np.ndarray):
    """Leave out prefix tokens that no other prefix holds; ``at`` has the places of the others.

    A token of two prefixes was counted twice, or is deep in one of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("tokens")
            ends = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            ends = ends - ends[0]
            stays = has_bit(repeated, flat) | has_bit(deep, flat)
            tokens, places = [], []
            for a, b in zip(ends[:-1], ends[1:]):
                tokens.append(flat[a:b][stays[a:b]])
                places.append(np.flatnonzero(stays[a:b]).astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("group", "class", "n")), _lists(tokens), _lists(places)],
                ["group", "class", "n", "tokens", "at"],
            )

    return run


def _wanted_sets(k: int, wanted: np.ndarray):
    """Whole sets of the rows whose hashed id is in the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = has_bit(wanted, batch.column("id_hash").to_numpy(zero_copy_only=False).view(np.uint64))
            batch = batch.filter(pa.array(hit))
            keys, sets = [], []
            for s in shingle_sets(batch.column("text"), k):
                keys.append(identity(s))
                sets.append(packed(s))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.binary())], ["class", "set"])

    return run


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shared = [
            len(np.intersect1d(unpacked(x), unpacked(y), assume_unique=True))
            for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist())
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("a", "b", "n_a", "n_b")] + [pa.array(shared, pa.int64())],
            ["a", "b", "n_a", "n_b", "shared"],
        )


def _bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Upper bound of the overlap from the bucket counts; without counts the smaller size."""
    for batch in batches:
        n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
        most = np.minimum(n_a, n_b)
        x, y = batch.column("buckets_a"), batch.column("buckets_b")
        known = pc.and_(x.is_valid(), y.is_valid())
        at = np.flatnonzero(known.to_numpy(zero_copy_only=False))
        if len(at):
            x, y = (np.frombuffer(b"".join(c.take(pa.array(at)).to_pylist()), np.uint8).reshape(-1, BUCKETS) for c in (x, y))
            most[at] = np.minimum(x, y).sum(axis=1, dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("a", "b", "n_a", "n_b")] + [pa.array(most)], ["a", "b", "n_a", "n_b", "shared"]
        )


def _tile_links(percent: int):
    """Links between two tiles of a token's rows: edges that join what is joined, one per row.

    Sizes and places are looked at first; the overlaps of the rows that are left
    are counted exactly, as a product of their token matrices.
    """

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"a": [], "b": []}).astype("int64")
        if not len(left) or not len(right):
            return none
        x, y = ({c: side[c].to_numpy(np.int64) for c in ("class", "component", "n", "at")} for side in (left, right))
        n_a, n_b = x["n"][:, None], y["n"][None, :]
        fits = (100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)) & (x["component"][:, None] != y["component"][None, :])
        reach = np.minimum(n_a - x["at"][:, None], n_b - y["at"][None, :])
        fits &= (100 + percent) * reach >= percent * (n_a + n_b)
        rows, columns = np.flatnonzero(fits.any(axis=1)), np.flatnonzero(fits.any(axis=0))
        if not len(rows):
            return none
        shared = _shared([unpacked(left["set"].iat[i]) for i in rows], [unpacked(right["set"].iat[i]) for i in columns])
        linked = fits[np.ix_(rows, columns)] & (100 * shared >= percent * (x["n"][rows][:, None] + y["n"][columns][None, :] - shared))
        i, j = np.nonzero(linked)
        return _spanned(x["class"][rows[i]], y["class"][columns[j]])

    return run


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many tokens each left set shares with each right one."""
    sizes = [np.array([len(s) for s in side]) for side in (left, right)]
    tokens = [np.concatenate(side) for side in (left, right)]
    of = [np.repeat(np.arange(len(n)), n) for n in sizes]
    known = np.intersect1d(np.unique(tokens[0]), np.unique(tokens[1]), assume_unique=True)
    out = np.zeros((len(left), len(right)), np.int64)
    if not len(known):
        return out
    at = [np.searchsorted(known, t) for t in tokens]
    kept = [known[np.minimum(a, len(known) - 1)] == t for a, t in zip(at, tokens)]
    for first in range(0, len(known), COLUMNS):
        parts = []
        for side in (0, 1):
            here = kept[side] & (at[side] >= first) & (at[side] < first + COLUMNS)
            matrix = np.zeros((len(sizes[side]), min(COLUMNS, len(known) - first)), np.float32)
            matrix[of[side][here], at[side][here] - first] = 1
            parts.append(matrix)
        out += np.rint(parts[0] @ parts[1].T).astype(np.int64)
    return out


def _spanned(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """Edges from each node to the smallest one it reaches over the given links."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = label.copy()
        np.minimum.at(least, x, label[y])
        np.minimum.at(least, y, label[x])
        least = least[least]
        if (least == label).all():
            break
        label = least
    other = nodes[label] != nodes
    return pd.DataFrame({"a": nodes[label][other], "b": nodes[other]})


class _Join:
    """One run over a table of ``(row_id, id_hash, text)``."""

    def __init__(self, rows: DataFrame, k: int, percent: int, heavy: int):
        self.rows, self.k, self.percent, self.heavy = rows, k, percent, heavy
        id_type = rows.schema["row_id"].dataType.simpleString()
        self.documents = scratch_table(
            rows.select("row_id", "text").mapInArrow(
                _fingerprints(k, percent), f"row_id {id_type}, n long, class long, low array<long>"
            ),
            "jaccard-sets",
        )

    def classes(self) -> DataFrame:
        """One row per distinct set; its smallest row represents it, in ``rows`` copies."""
        same = self.documents.where("n > 0").groupBy("class", "row_id").agg(F.count(F.lit(1)).alias("rows"))
        first = F.min(F.struct("row_id", "rows")).alias("first")
        return scratch_table(
            same.groupBy("class").agg(first).select("class", F.col("first.row_id").alias("first_id"), "first.rows"),
            "jaccard-classes",
        )

    def long_enough(self, n_a: str, n_b: str) -> Column:
        """Sizes alone allow the similarity."""
        return F.expr(f"100 * least({n_a}, {n_b}) >= {self.percent} * greatest({n_a}, {n_b})")

    def first_match_allows(self, n_a: str, at_a: str, n_b: str, at_b: str) -> Column:
        """If this is the first common token, what follows can still give the needed overlap.

        The first common token of a pair that links passes, so a pair is lost by
        no later token that fails.
        """
        p = self.percent
        return F.expr(f"{100 + p} * least({n_a} - {at_a}, {n_b} - {at_b}) >= {p} * ({n_a} + {n_b})")

    def groups(self) -> DataFrame:
        """``(group, class, n, tokens, at)``: classes of equal size and prefix share a group."""
        low = self.documents.where("n > 0").groupBy("class").agg(F.first("low").alias("low"))
        counts = low.select(F.explode("low").alias("token")).groupBy("token").count().where("count > 1")
        counts = scratch_table(counts, "jaccard-tokens")
        heavy = bitmap(counts.where(f"count > {self.heavy}"), F.col("token"), HEAVY_BITS)
        repeated = bitmap(counts, F.col("token"), REPEATED_BITS)
        prefixes = self.rows.select("text").mapInArrow(
            _prefixes(self.k, self.percent, heavy),
            "class long, n long, prefix long, tokens array<long>, deep array<long>, buckets binary",
        ).where("n > 0")
        first = [F.first(c).alias(c) for c in ("n", "prefix", "tokens", "deep", "buckets")]
        self.prefixes = members = scratch_table(prefixes.groupBy("class").agg(*first), "jaccard-prefixes")
        deep = bitmap(members.select(F.explode("deep").alias("token")), F.col("token"), HEAVY_BITS)
        keys = members.groupBy("n", "prefix").agg(F.min("class").alias("group"))
        grouped = members.join(keys, ["n", "prefix"]).select("group", "class", "n", "tokens")
        return scratch_table(
            grouped.mapInArrow(
                _joinable(repeated, deep), "group long, class long, n long, tokens array<long>, at array<long>"
            ),
            "jaccard-groups",
        )

    def similar(self, found: DataFrame) -> DataFrame:
        return found.where(f"100 * shared >= {self.percent} * (n_a + n_b - shared)").select("a", "b")

    def beside(self, pairs: DataFrame, sides: DataFrame, *columns: str) -> DataFrame:
        """Pairs with the columns of both classes, named ``_a`` and ``_b``."""
        for side in ("a", "b"):
            named = [F.col(c).alias(f"{c}_{side}") for c in columns]
            pairs = pairs.join(sides.select(F.col("class").alias(side), *named), side)
        return pairs.select("a", "b", *[f"{c}_{side}" for c in columns for side in ("a", "b")])

    def possible(self, pairs: DataFrame, name: str) -> DataFrame:
        """Pairs whose bucket counts allow the similarity."""
        both = self.beside(pairs, self.prefixes.select("class", "n", "buckets"), "n", "buckets")
        found = both.mapInArrow(_bounds, "a long, b long, n_a long, n_b long, shared long")
        return scratch_table(self.similar(found), name)

    def sets_of(self, ids: DataFrame, classes: DataFrame) -> DataFrame:
        """``(class, set, n)`` of the classes in ``ids``, and perhaps of a few more."""
        needed = scratch_table(classes.join(ids, "class"), "jaccard-needed")
        wanted = bitmap(needed, F.xxhash64("first_id"), WANTED_BITS)
        sets = self.rows.select("id_hash", "text").mapInArrow(_wanted_sets(self.k, wanted), "class long, set binary")
        if not needed.where("rows > 1").isEmpty():
            sets = sets.groupBy("class").agg(F.first("set").alias("set"))
        return scratch_table(sets.withColumn("n", (F.length("set") / SET_BYTES).cast("long")), "jaccard-whole")

    def verified(self, pairs: DataFrame, classes: DataFrame) -> DataFrame:
        """The pairs ``(a, b)`` of classes whose whole sets are similar enough."""
        sets = self.sets_of(pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct(), classes)
        found = self.beside(pairs, sets, "n", "set").mapInArrow(_overlaps, "a long, b long, n_a long, n_b long, shared long")
        return self.similar(found)

    def few(self, spread: DataFrame, members: DataFrame) -> DataFrame:
        """Pairs of classes of different components by tokens that few of them hold: groups meet, then members."""
        sizes = members.select("group", "n").distinct()
        spread = spread.join(sizes, "group")
        x, y = (spread.select("token", *[F.col(c).alias(f"{c}_{side}") for c in ("group", "n", "at", "component")]) for side in ("a", "b"))
        near = (
            x.join(y, "token")
            .where("component_a < component_b")
            .where(self.long_enough("n_a", "n_b"))
            .where(self.first_match_allows("n_a", "at_a", "n_b", "at_b"))
            .select("group_a", "component_a", "group_b", "component_b")
            .distinct()
        )
        for side in ("a", "b"):
            of_side = members.select(F.col("group").alias(f"group_{side}"), F.col("component").alias(f"component_{side}"), F.col("class").alias(side))
            near = near.join(of_side, [f"group_{side}", f"component_{side}"])
        return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    def many(self, spread: DataFrame, members: DataFrame, classes: DataFrame) -> DataFrame:
        """Links of different components by tokens that many hold: tiles of members meet with their whole sets."""
        rows = scratch_table(spread.join(members, ["group", "component"]), "jaccard-many")
        sets = self.sets_of(rows.select("class").distinct(), classes)
        rows = rows.join(sets.select("class", "set"), "class").withColumn("tiles", F.ceil(F.col("all") / TILE)).withColumn(
            "tile", F.pmod(F.xxhash64("class"), F.col("tiles"))
        )
        columns = ("token", "tile_a", "tile_b", "class", "component", "n", "at", "set")
        left = rows.withColumn("tile_a", F.col("tile")).withColumn("tile_b", F.explode(F.expr("sequence(tile, tiles - 1)")))
        right = rows.withColumn("tile_b", F.col("tile")).withColumn("tile_a", F.explode(F.expr("sequence(0, tile)")))
        keys = ["token", "tile_a", "tile_b"]
        left, right = (side.select(*[F.col(c).alias(c) for c in columns]).groupBy(*keys) for side in (left, right))
        return left.cogroup(right).applyInPandas(_tile_links(self.percent), "a long, b long")

    def components(self) -> DataFrame:
        """``(class, component)`` of every class that links with another."""
        classes = self.classes()
        groups = self.groups()
        postings = groups.where("class = group").select(
            "group", "n", F.explode(F.arrays_zip("tokens", "at")).alias("t")
        ).select("group", "n", F.col("t.tokens").alias("token"), F.col("t.at").alias("at"))

        # First every group meets the first group of each of its tokens, and every
        # member the first of its group. Large families of copies end here.
        centres = (
            postings.groupBy("token")
            .agg(F.min(F.struct("group", "n", "at")).alias("c"), F.max("group").alias("last"))
            .where("c.group < last")
        )
        stars = (
            postings.join(centres, "token")
            .where(F.col("group") != F.col("c.group"))
            .where(self.long_enough("n", "c.n"))
            .where(self.first_match_allows("n", "at", "c.n", "c.at"))
            .select(F.col("c.group").alias("a"), F.col("group").alias("b"))
            .union(groups.where("class <> group").select(F.col("group").alias("a"), F.col("class").alias("b")))
            .distinct()
        )
        stars = self.possible(stars, "jaccard-stars")
        links = scratch_table(self.verified(stars, classes), "jaccard-links")
        found = connected_components(links).withColumnRenamed("node", "class")

        # Then only groups of different components are left to compare.
        members = scratch_table(
            groups.select("group", "class", "n").join(found, "class", "left").select(
                "group", "class", "n", F.coalesce("component", "class").alias("component")
            ),
            "jaccard-members",
        )
        parts = members.groupBy("group", "component").agg(F.count(F.lit(1)).alias("rows"))
        # Members of one group meet as if the group were a token of theirs.
        mates = parts.select("group", "component", "rows", F.xxhash64("group", F.lit("group")).alias("token"), F.lit(0).cast("long").alias("at"))
        spread = postings.join(parts, "group").select("group", "component", "rows", "token", "at").union(mates)
        mixed = spread.groupBy("token").agg(
            F.min("component").alias("x"), F.max("component").alias("y"), F.sum("rows").alias("all")
        ).where("x < y").select("token", "all")
        spread = scratch_table(spread.join(mixed, "token").drop("rows"), "jaccard-spread")
        wide = scratch_table(self.many(spread.where(f"all > {FEW}"), members, classes), "jaccard-wide")
        pairs = self.few(spread.where(f"all <= {FEW}"), members)
        rest = pairs.distinct().join(
            stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"
        )
        rest = scratch_table(rest, "jaccard-pairs")
        more = self.verified(self.possible(rest, "jaccard-possible"), classes)
        return connected_components(links.union(more).union(wide)).withColumnRenamed("node", "class")


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 80,
    heavy: int = HEAVY,
) -> DataFrame:
    """``(<id>, n_shingles, component_id)`` of every row of ``docs``.

    Words are runs of other than white space, A-Z lower-cased. Two texts link if
    the Jaccard similarity of their sets of ``words``-word shingles is
    ``percent`` / 100 or more; a text of fewer words is one shingle. Sets are
    compared as 64-bit hashes of whole texts. ``component_id`` is the smallest id
    reachable over links.

    Null, empty and blank texts have no shingles and link with nothing; their
    component is their own id. Rows that repeat an id are separate texts; a null
    id stays null unless its component holds another id. Other columns are not read.

    Equal sets are one class, classes of equal size and prefix one group. The
    prefix order puts tokens of more than ``heavy`` classes last; which ones is
    kept in a bitmap of fixed size, whose errors change the order alike for all
    sets and so cost time only. Bucket counts bound the overlap of a pair before
    whole sets are compared; the rows of a token with more than ``FEW`` classes
    are compared in tiles, so they never meet pair by pair in a join. Pairs are compared until they are known to be
    connected, not beyond.
    """
    rows = docs.select(
        F.col(id_col).alias("row_id"), F.xxhash64(id_col).alias("id_hash"), F.col(text_col).cast("string").alias("text")
    )
    join = _Join(rows, words, percent, heavy)
    found = join.components()
    members = join.documents.select("row_id", "n", "class").join(found, "class", "left")
    members = members.withColumn("key", F.coalesce("component", "class"))
    names = members.where("n > 0").groupBy("key").agg(F.min("row_id").alias("least"))
    return members.join(names, "key", "left").select(
        F.col("row_id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("row_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without near duplicates: one row of each component stays, all its columns unchanged.

    It is the row of the smallest id, rows without id last, and of equal ids the one
    of the smaller hash of its text. Rows equal in both are reduced to one as well:
    to the least by all columns in order. Rows without shingles (null, empty and
    blank texts) are no duplicates of anything and all stay. An empty table gives
    an empty result.

    Rows whose text is surely not judged, by a bitmap of fixed size, stay where
    they are; only the others are joined.
    """
    key, text_hash = "__row", F.xxhash64(F.col(text_col).cast("string"))
    # Null ids last, so that a component is named by a known id if it has one.
    rows = docs.withColumn(key, F.struct(F.col(id_col).isNull().alias("unknown"), F.col(id_col).alias("id"), text_hash.alias("text")))
    found = jaccard_components(rows.select(key, text_col), key, text_col, words, percent).where("n_shingles > 0")
    judged = found.groupBy(key).agg(F.count(F.lit(1)).alias("copies"), F.first("component_id").alias("component_id"))
    judged = judged.withColumn("stays", F.col(key).eqNullSafe(F.col("component_id"))).where("copies > 1 or not stays")
    judged = scratch_table(judged.select(F.col(f"{key}.id").alias("__id"), F.col(f"{key}.text").alias("__text"), "stays"), "judged-rows")

    def same(row: DataFrame) -> Column:
        return docs[id_col].eqNullSafe(row["__id"]) & (text_hash == row["__text"])

    perhaps = perhaps_in(bitmap(judged, F.col("__text"), JUDGED_BITS), text_hash)
    doubtful = docs.where(perhaps)
    single = docs.where(~perhaps).union(doubtful.join(judged, same(judged), "left_anti"))
    repeated = judged.where("stays")
    # Copies meet after each task has reduced its own.
    every = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    least = doubtful.join(repeated, same(repeated), "left_semi").groupBy(F.col(id_col).alias("__id"), text_hash.alias("__text")).agg(F.min(every).alias("__kept"))
    return single.union(least.select(*[F.col("__kept").getField(c).alias(c) for c in docs.columns]))
