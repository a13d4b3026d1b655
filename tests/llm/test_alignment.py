"""Operator 12 against token lists aligned one by one."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from scoreloom.llm import alignment as A

DOCS = "doc_id long, text string, id string, row_key long, n_a string, pair string, same string"


@pytest.fixture(scope="module")
def files():
    tokenizers = pytest.importorskip("public_tokenizers")
    with open(tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as a, open(tokenizers.path("piece_bpe_32k.model"), "rb") as b:
        return a.read(), b.read()


def spans(ids, of_id):
    out, at = [], 0
    for i in ids:
        out.append((i, at, at + len(of_id(i))))
        at += len(of_id(i))
    return out


def plain(texts, files):
    """Rows of the contract by comparing every token with every other."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_str(files[0]), sentencepiece.SentencePieceProcessor(model_proto=files[1])
    a.encode_special_tokens = True
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(x): x for x in printable} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in printable)}

    def bytes_a(i):
        return bytes(byte[c] for c in a.id_to_token(i))

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    found = []
    for text in texts:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        data = (" " + (text or "")).encode()
        if not text or b"".join(map(bytes_a, ids_a)) != data or b"".join(map(bytes_b, ids_b)) != data:
            found.append(([], [], [], ""))
            continue
        of_a, of_b = spans(ids_a, bytes_a), spans(ids_b, bytes_b)
        links = [(x, y) for x, s, e in of_a for y, t, f in of_b if s < f and t < e]
        ends = sorted({e for *_, e in of_a} & {f for *_, f in of_b})
        groups = [
            ",".join(str(x) for x, s, e in of_a if lo <= s < hi) + "|" + ",".join(str(y) for y, t, f in of_b if lo <= t < hi)
            for lo, hi in zip([0, *ends], ends)
        ]
        found.append((ids_a, ids_b, links, ";".join(groups)))
    count = Counter(p for *_, links, _ in found for p in set(links))
    best = {}
    for (x, _), n in count.items():
        best[x] = max(n, best.get(x, 0))
    return [
        (
            len(x), len(y), groups.count("|"), len(links), sum(count[p] == best[p[0]] for p in links),
            sum(count[p] for p in links), hashlib.sha256(groups.encode()).hexdigest() if groups else "",
        )
        for x, y, links, groups in found
    ]


def texts():
    rng = random.Random(8)
    pool = ["the ", "attion", " ", "\n", "  ", "é", "中文", "😀", "a", "aa", "aaa", "ing", "<|endoftext|>", "<s>", "▁", "\x00", "ß", "1234", "٣", "�", "'s", "\t", "İ"]
    out = [None, "", " ", "▁", "a", "the cat", "aaaaaaaaaaaaaaaa", " lead", "trail ", "x" * 3000, "<0x41>", "<unk>"]
    out += ["".join(rng.choice(pool) for _ in range(rng.randrange(1, 30))) for _ in range(150)]
    words = ["therhean", "esndha", "Erretion", "aninged", "blein", "stärke", "naïve", "ononst"]
    out += [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 40))) for _ in range(60)]
    return out + out[:40]


@pytest.mark.parametrize("common, held", [(1 << 19, 1 << 19), (5, 7), (0, 1)])
def test_alignment_equals_the_plain_one(spark, files, monkeypatch, common, held):
    """Also with nearly no pair held in memory, when all counts come from the join."""
    monkeypatch.setattr(A, "HELD_PAIRS", held)
    monkeypatch.setattr(A, "SLICE_CHARS", 200)
    monkeypatch.setattr(A, "CACHED_PARTS", held)
    rows = texts()
    docs = spark.createDataFrame([(i if i != 7 else None, t, "x", 1, "y", "z", "s") for i, t in enumerate(rows)], DOCS)
    got = A.token_alignment(docs.repartition(5), *files, common_pairs=common).collect()
    assert got[0].__fields__ == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    expected = [(i if i != 7 else None, *r) for i, r in enumerate(plain(rows, files))]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    assert any(r.n_best < r.n_links for r in got) and any(r.n_groups and r.n_groups < r.n_links for r in got)


def test_groups_give_the_text_back(spark, files):
    """The real output: groups of ids whose bytes are equal on both sides and join to the text."""
    rows = [t for t in texts() if t]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    t = A.Tokenizers(*files)
    for r in A.align_tokens(docs, *files).collect():
        parts = [tuple(side.split(",") for side in g.split("|")) for g in r.groups.split(";")] if r.groups else []
        joined = b""
        for a, b in parts:
            left, right = (b"".join(of[int(i)] for i in ids) for ids, of in ((a, t.bytes_a), (b, t.bytes_b)))
            assert left == right
            joined += left
        assert joined in (b"", b" " + rows[r.doc_id].encode())
        assert len(parts) == r.n_groups and sum(r.n_same) + sum(r.n_other) == r.n_links


def test_empty_table_and_long_text(spark, files):
    docs = spark.createDataFrame([(1, "thereon " * 40_000)], "doc_id long, text string")
    assert A.token_alignment(docs.limit(0), *files).count() == 0
    row = A.token_alignment(docs, *files).first()
    assert row.n_a >= 40_000 and row.n_links >= row.n_groups > 30_000 and row.count_sum == row.n_links
