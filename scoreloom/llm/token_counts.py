"""Token counts of whole texts with a whole-token shortcut."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

CACHED_WORDS = 1 << 19
ROWS = 256

# What the shortcut relies on: fixed values of the word-level BPE files.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
PRE_TOKEN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

# Characters that composition leaves alone and whose classes never changed:
# Latin letters with and without accents, their digits, marks and spaces.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ſ"
_NUMBERS = "0-9²³¹¼-¾"
_SPACES = "\t-\r \u0085 "
OTHER = re.compile("[İƀ-‏ -₫₭-\U0010ffff]")
WORD = re.compile(
    f"[{_LETTERS}]+|[{_NUMBERS}]|'(?:s|t|re|ve|m|ll|d)|[^{_SPACES}{_LETTERS}{_NUMBERS}]+"
)


def check_kind(file: str) -> list[str]:
    """Special strings of a tokenizer file of the known kind; other kinds are refused."""
    spec = json.loads(file)
    normalizers = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    split = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
    if normalizers != NORMALIZERS or split.get("pattern", {}).get("Regex") != PRE_TOKEN:
        raise ValueError("not a word-level BPE file of the known kind")
    return [t["content"] for t in spec["added_tokens"]]


def whole_tokens(file: str) -> list[str]:
    """Strings of the vocabulary that, encoded alone, are one token: tried one by one."""
    spec = json.loads(file)
    tokenizer = Tokenizer.from_str(file)
    end = spec["model"]["end_of_word_suffix"]
    special = {t["content"] for t in spec["added_tokens"]}
    byte_of = _bytes_of_characters()
    strings = []
    for token in spec["model"]["vocab"]:
        if not token.endswith(end) or token in special:
            continue
        try:
            strings.append(bytes(byte_of[c] for c in token.removesuffix(end)).decode())
        except (KeyError, UnicodeDecodeError):
            continue
    alone = tokenizer.encode_batch(strings, add_special_tokens=False)
    return [s for s, e in zip(strings, alone) if len(e.ids) == 1 and WORD.fullmatch(s) and s == s.lower()]


def _bytes_of_characters() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, others for 256 and up."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(other)}


class Counter:
    """Counts tokens of texts as the library does, without begin and end tokens."""

    def __init__(self, file: str, whole: list[str]):
        self.tokenizer = Tokenizer.from_str(file)
        self.whole = dict.fromkeys(whole, 1)
        self.costs = dict(self.whole)
        self.byte_level = {b: c for c, b in _bytes_of_characters().items()}
        special = check_kind(file)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def encoded(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def merge(self, words: list[str]) -> None:
        """Costs of pre-tokens that are no whole token: the library's merges of each."""
        tokenize, level = self.tokenizer.model.tokenize, self.byte_level
        for word in words:
            plain = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(level)
            self.costs[word] = len(tokenize(plain))

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        parts = [self.special.split(t) if self.special and "<" in t else [t] for t in texts]
        out = [len(p) - 1 for p in parts]
        words: list[tuple[int, list[str]]] = []
        for i, of_text in enumerate(parts):
            for part in of_text:
                if OTHER.search(part):
                    out[i] += self.encoded(part)
                else:
                    words.append((i, WORD.findall(part.lower())))
        found = set().union(*(w for _, w in words))
        fresh = [w for w in found if w not in self.costs]
        if len(self.costs) + len(fresh) > CACHED_WORDS:
            self.costs = dict(self.whole)
            fresh = [w for w in found if w not in self.whole]
        self.merge(fresh)
        cost = self.costs.__getitem__
        for i, w in words:
            out[i] += sum(map(cost, w))
        return out


def token_counts(docs: DataFrame, file: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(<id>, n_bytes, n_tokens, over_limit)`` of every row of ``docs``.

    ``file`` is the text of a tokenizer file. Vocabulary strings that encode
    alone as one token are found once; pre-tokens that equal one of them count
    as one, and only the others are merged. A text with characters beyond the
    Latin ones goes to the library whole, because composition and character
    classes are its own there. Special strings in a text are one token each.

    Null counts as the empty text: 0 bytes, 0 tokens. Repeated rows are counted
    each; other columns are not read. Texts are never cut.
    """
    check_kind(file)
    whole = whole_tokens(file)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(file, whole)
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            counts = pa.array(
                [n for i in range(0, len(texts), ROWS) for n in counter.counts(texts[i : i + ROWS].to_pylist())],
                pa.int64(),
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pc.binary_length(texts).cast(pa.int64()), counts, pc.greater(counts, limit)],
                ["id", "n_bytes", "n_tokens", "over_limit"],
            )

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, f"id {id_type}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("id", id_col)
