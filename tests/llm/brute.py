"""Plain Python versions of the corpus operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from itertools import combinations

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Links:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.to = list(range(n))

    def find(self, x: int) -> int:
        while self.to[x] != x:
            self.to[x] = self.to[self.to[x]]
            x = self.to[x]
        return x

    def join(self, a: int, b: int) -> None:
        self.to[self.find(a)] = self.find(b)

    def least(self, ids: list) -> list:
        """Smallest known id of each position's component."""
        best: dict[int, int] = {}
        for i, x in enumerate(ids):
            if x is not None:
                best[self.find(i)] = min(best.get(self.find(i), x), x)
        return [best.get(self.find(i)) for i in range(len(ids))]


def shingles(text: str | None, k: int) -> set:
    words = SPACE_WORD.findall((text or "").translate(LOWER))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return set(zip(*[words[j:] for j in range(k)]))


def jaccard(rows: list[tuple], k: int, percent: int) -> list[tuple]:
    sets = [shingles(t, k) for _, t in rows]
    links = Links(len(rows))
    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            links.join(i, j)
    return [(r[0], len(s), c) for r, s, c in zip(rows, sets, links.least([r[0] for r in rows]))]


def contaminated(docs: list[tuple], items: list[tuple], window: int) -> list[tuple]:
    windows = defaultdict(set)
    for item, text in items:
        words = ITEM_WORD.findall((text or "").translate(LOWER))
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            windows[tuple(words[i : i + size])].add(item)
    out = []
    for doc, text in docs:
        words = ITEM_WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for w, owners in windows.items():
            for i in range(len(words) - len(w) + 1):
                if tuple(words[i : i + len(w)]) == w:
                    hit.update(range(i, i + len(w)))
                    found |= owners
        names = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(words), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return out


def repeated(rows: list[tuple], size: int) -> dict:
    """Words inside passages that occur twice, by id; rows equal in both columns count once."""
    texts = {r: SPACE_WORD.findall(r[1] or "") for r in rows}
    seen = Counter(tuple(w[i : i + size]) for w in texts.values() for i in range(len(w) - size + 1))
    out = {}
    for (doc, _), words in texts.items():
        covered = set()
        for i in range(len(words) - size + 1):
            if seen[tuple(words[i : i + size])] > 1:
                covered.update(range(i, i + size))
        if covered:
            out[doc] = len(covered)
    return out


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def base_spans(text: str | None) -> str:
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found))


def targets(sizes: dict, weights: tuple, share: float, most: float) -> dict:
    """Targets by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, free, words = {}, set(names), share * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if words * weight[s] / total > most * sizes[s]}
        if not over:
            return out | {s: words * weight[s] / total for s in free}
        out |= {s: most * sizes[s] for s in over}
        words -= sum(most * sizes[s] for s in over)
        free -= over
    return out


def highest_quotients(votes: dict, seats: int) -> dict:
    got = dict.fromkeys(votes, 0)
    for _ in range(seats):
        best = max(sorted(votes), key=lambda p: votes[p] / (2 * got[p] + 1))
        got[best] += 1
    return got
