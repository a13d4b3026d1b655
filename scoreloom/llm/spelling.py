"""Spelling variants: a vocabulary acceptor composed with a one-edit transducer and the acceptor again."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.scratch import scratch_table

HELD_WORDS = 300_000
GROUP_WORDS = 2_000
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_KEY = ("size", "lo", "hi", "head", "tail")


def misspelt(word: str, h: int, every: int) -> str:
    """The word, without one code point if ``every`` divides its hash."""
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def _word_counts(least: int, every: int):
    """Words of at least ``least`` code points with their number in the partition, held up to a bound."""
    runs = re.compile(f"[A-Za-zÀ-ÿ]{{{least},}}")

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for doc, text in zip(batch.column("id"), batch.column("text")):
                seed = zlib.crc32(f"{doc.as_py() or ''}:".encode())
                for found, n in Counter(runs.findall(text.as_py() or "")).items():
                    word = found.translate(_LOWER)
                    word = misspelt(word, zlib.crc32(word.encode(), seed), every)
                    if len(word) >= least:
                        held[word] += n
                if len(held) > HELD_WORDS:
                    yield rows(held)
                    held = Counter()
        yield rows(held)

    return run


def vocabulary(
    docs: DataFrame, least_length: int = 6, least_count: int = 5, every: int = 199, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(word, n)``: words of Latin letters in all texts, lower-cased A-Z, that occur ``least_count`` times.

    A word whose CRC-32 of ``<id>:<word>`` is divisible by ``every`` lacks one code
    point, the one at the hash modulo its length. Null texts have no words; a
    null id hashes as an empty one; each repeated row counts.
    """
    texts = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    counted = texts.mapInArrow(_word_counts(least_length, every), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class Acceptor:
    """Minimised acyclic automata that share equal states: one state per set of endings."""

    def __init__(self):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self._known: dict[tuple, int] = {}

    def _new(self) -> int:
        self.arcs.append({})
        self.final.append(False)
        return len(self.arcs) - 1

    def add(self, words: list[str]) -> int:
        """First state of the automaton of sorted, distinct words."""
        path, last = [self._new()], ""

        def freeze(depth: int) -> None:
            while len(path) - 1 > depth:
                state = path.pop()
                kept = self._known.setdefault((self.final[state], tuple(self.arcs[state].items())), state)
                self.arcs[path[-1]][last[len(path) - 1]] = kept

        for word in words:
            shared = 0
            for a, b in zip(last, word):
                if a != b:
                    break
                shared += 1
            freeze(shared)
            for char in word[shared:]:
                path.append(self._new())
                self.arcs[path[-2]][char] = path[-1]
            self.final[path[-1]] = True
            last = word
        freeze(0)
        return path[0]

    def common(self, p: int, q: int, but: str = "") -> Iterator[str]:
        """Endings that both states accept and that do not start with ``but``."""
        if self.final[p] and self.final[q]:
            yield ""
        stack = [(p, q, "")]
        while stack:
            p, q, read = stack.pop()
            other = self.arcs[q]
            for char, to in self.arcs[p].items():
                if char in other and (read or char != but):
                    ending = read + char
                    if self.final[to] and self.final[other[char]]:
                        yield ending
                    stack.append((to, other[char], ending))

    def one_edit(self, full: int, short: int, after: str = "") -> Iterator[tuple[str, str, bool]]:
        """Pairs that the composition with the one-edit transducer accepts, each once.

        States of the composition are a state of each side and whether the edit is
        made. Before it both sides read the same characters; the edit is the first
        place where they differ: another character (a pair of ``full`` words, the
        smaller first), or one that the ``short`` word lacks (True). After it both
        sides have the same ending. ``after`` is the character that follows all
        words, if any: they may still agree there.
        """
        stack: list[tuple[int, int | None, str]] = [(full, short, "")]
        while stack:
            x, y, read = stack.pop()
            arcs = list(self.arcs[x].items())
            for i, (a, to_a) in enumerate(arcs):
                for b, to_b in arcs[i + 1 :]:
                    for ending in self.common(to_a, to_b):
                        yield read + a + ending, read + b + ending, False
                if y is not None:
                    for ending in self.common(to_a, y, but=a):
                        if ending or a != after:
                            yield read + a + ending, read + ending, True
                stack.append((to_a, None if y is None else self.arcs[y].get(a), read + a))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple[str, int]]]]:
    """Consecutive rows of equal keys: the key and the words with their counts."""
    key, members = None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (*_KEY, "word", "n")]
        for *found, word, n in zip(*columns):
            if found != key:
                if len(members) > 1:
                    yield key, members
                key, members = found, []
            members.append((word, n))
    if len(members) > 1:
        yield key, members


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both directions of each near pair of a group, from its composed automaton."""
    rows: list[tuple[str, str, int]] = []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()))], ["word", "near", "near_n"])

    for (size, lo, hi, head, tail), members in _groups(batches):
        count = dict(members)
        middles: tuple[list[str], list[str]] = ([], [])
        for word in count:
            missing = size - len(word)
            middles[missing].append(word[lo : hi - missing])
        if not middles[0]:
            continue
        acceptor = Acceptor()
        full, short = (acceptor.add(sorted(m)) for m in middles)
        for x, y, _ in acceptor.one_edit(full, short, tail[:1]):
            x, y = head + x + tail, head + y + tail
            rows += [(x, y, count[y]), (y, x, count[x])]
        if len(rows) > 50_000:
            yield batch()
            rows = []
    yield batch()


def _windowed(words: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Words of a size class with an edit window: what is outside of it must agree."""
    held = words.select("word", "n", "size", lo.alias("lo"), hi.alias("hi"))
    tail = F.expr("substring(word, hi - (size - length(word)) + 1, length(word))")
    return held.select("word", "n", "size", "lo", "hi", F.expr("left(word, lo)").alias("head"), tail.alias("tail"))


def _halved(words: DataFrame, lo: Column, hi: Column) -> DataFrame:
    middle = F.floor((lo + hi) / 2).cast("int")
    return _windowed(words, lo, middle).union(_windowed(words, middle, hi))


def near_words(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """``(word, near, near_n)``: both directions of all pairs of ``(word, n)`` one edit apart.

    A pair belongs to the size of its longer word and to the place of its edit,
    the first one where both differ. Words that agree before and after a window
    of places form a partition, which starts in one state of the composed
    automaton: half of the word first; partitions of more than ``group_words``
    words go on with half of their window, down to one place, where there are no
    more words than letters. Hence no partition is unbounded, whatever the words.
    """
    sized = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("size"))
    todo = scratch_table(_halved(sized, F.lit(0), F.col("size")), "edit-windows")
    ready = []
    while True:
        sizes = todo.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("members"))
        sizes = scratch_table(sizes.where(F.col("members") > 1), "edit-groups")
        large = (F.col("members") > group_words) & (F.col("hi") - F.col("lo") > 1)
        ready.append(todo.join(sizes.where(~large).select(*_KEY), list(_KEY), "left_semi"))
        if sizes.where(large).isEmpty():
            break
        todo = todo.join(sizes.where(large).select(*_KEY), list(_KEY), "left_semi")
        todo = scratch_table(_halved(todo, F.col("lo"), F.col("hi")), "edit-windows")
    found = ready[0]
    for more in ready[1:]:
        found = found.unionByName(more)
    grouped = found.select(*_KEY, "word", "n").repartition(*_KEY).sortWithinPartitions(*_KEY)
    return grouped.mapInArrow(_near, "word string, near string, near_n long")


def spelling_forms(words: DataFrame, times: int = 5, group_words: int = GROUP_WORDS) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of a table of distinct ``(word, n)``.

    ``form`` is the near word of the largest ``n`` (ties: the smallest by code
    points) if that is at least ``times`` the word's own, else null. ``root``
    follows forms to the last one; counts grow by ``times`` at each step, so there
    are few. An empty table gives an empty result.
    """
    words = scratch_table(words, "spelling-words")
    near = near_words(words, group_words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near").alias("near"))).alias("best")
    )
    much = -F.col("best.order") >= times * F.col("n")
    found = words.join(near, "word", "left").select(
        "word",
        F.when(much, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(much, -F.col("best.order")).alias("form_n"),
    )
    found = scratch_table(found, "spelling-forms")
    forms = found.where("form IS NOT NULL").select(F.col("word").alias("at"), F.col("form").alias("next"))
    # Words without a form are roots; the others walk on until they meet one.
    walk = found.where("form IS NOT NULL").select("word", F.col("form").alias("at"))
    roots = found.where("form IS NULL").select("word", F.col("word").alias("root"))
    while True:
        step = scratch_table(walk.join(forms, "at", "left"), "spelling-walk")
        roots = roots.union(step.where("next IS NULL").select("word", F.col("at").alias("root")))
        walk = step.where("next IS NOT NULL").select("word", F.col("next").alias("at"))
        if walk.isEmpty():
            break
    return found.join(roots, "word").select("word", "form", "root", "n", "n_near", "form_n")
