"""Brute-force versions that share nothing with the operators but the definitions."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def lower(text: str | None) -> str:
    return (text or "").translate(_LOWER)


def words(text: str | None) -> list[str]:
    return WORD.findall(lower(text))


def shingles(text: str | None, size: int = 5) -> Counter:
    w = words(text)
    if not w:
        return Counter()
    size = min(size, len(w))
    return Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def weighted_similarity(a: Counter, b: Counter, held: Counter, n: int) -> float:
    weigh = lambda s: 1 + math.log10((1 + n) / (1 + held[s]))
    low = sum(min(a[s], b[s]) * weigh(s) for s in a.keys() | b.keys())
    high = sum(max(a[s], b[s]) * weigh(s) for s in a.keys() | b.keys())
    return low / high if high else 0.0


def classes(docs: list[tuple], least: float = 0.8) -> dict[int, int]:
    """doc_id -> smallest doc_id of its component, by comparing all pairs."""
    sets = {i: shingles(t) for i, t in docs}
    keys = {i: tuple(words(t)) or ("", t or "") for i, t in docs}
    held = Counter(s for x in sets.values() for s in x)
    root = {i: i for i, _ in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    names = sorted(root)
    for x, a in enumerate(names):
        for b in names[x + 1 :]:
            alike = keys[a] == keys[b] or weighted_similarity(sets[a], sets[b], held, len(docs)) >= least
            if alike and find(a) != find(b):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: find(i) for i in root}


def unigram(docs: list[tuple]) -> dict[int, tuple]:
    """doc_id -> (held out, tokens, known tokens, training tokens, base score)."""
    tokens = {i: [*TOKEN.findall(lower(t)), None] for i, t in docs}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs}
    counts = Counter(t for i, ts in tokens.items() if not out[i] for t in ts)
    total, distinct = counts.total(), len(counts)
    return {
        i: (
            out[i], len(ts), sum(counts[t] > 0 for t in ts), total,
            sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in ts),
        )
        for i, ts in tokens.items()
    }


class PlainTree:
    """Context-tree weighting node by node, in the open."""

    def __init__(self, texts: list[bytes], depth: int):
        self.depth, self.counts = depth, {}
        for text in texts:
            for context, path, bit in self.steps(text):
                for d in range(depth + 1):
                    node = self.counts.setdefault((context[:d], path), [0, 0])
                    node[bit] += 1
        self.weighted: dict[tuple, float] = {}
        below: dict[tuple, float] = Counter()
        for (context, path), (a, b) in sorted(self.counts.items(), key=lambda x: -len(x[0][0])):
            kt = (
                math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
            )
            whole, share = kt, 1.0
            if len(context) < depth:
                other = below[context, path]
                top = max(kt, other)
                whole = top + math.log(math.exp(kt - top) + math.exp(other - top)) - math.log(2)
                share = math.exp(kt - math.log(2) - whole)
            self.weighted[context, path] = share
            if context:
                below[context[:-1], path] += whole

    def steps(self, text: bytes):
        past = [0xFE] * self.depth
        for byte in [*text, 0xFF]:
            path = 1
            for j in range(7, -1, -1):
                bit = byte >> j & 1
                yield tuple(past), path, bit
                path = path * 2 + bit
            past = [byte, *past[:-1]]

    def log10(self, text: bytes) -> float:
        total = 0.0
        for context, path, bit in self.steps(text):
            seen = [d for d in range(self.depth + 1) if (context[:d], path) in self.counts]
            chance = 0.5
            for d in reversed(seen):
                a, b = self.counts[context[:d], path]
                own = ((a, b)[bit] + 0.5) / (a + b + 1)
                share = 1.0 if d == seen[-1] else self.weighted[context[:d], path]
                chance = share * own + (1 - share) * chance
            total += math.log10(chance)
        return total


def differencing(sizes: list[int], parts: int) -> list[int]:
    """Sorted sums of Karmarkar-Karp differencing, with a plain list for a heap."""
    left = [(s, *[0] * (parts - 1)) for s in sizes]
    while len(left) > 1:
        left.sort(key=lambda x: x[0] - x[-1])
        a, b = left.pop(), left.pop()
        left.append(tuple(sorted((x + y for x, y in zip(a, reversed(b))), reverse=True)))
    return list(left[0])


def _spread(x: int) -> int:
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) % 2**64
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) % 2**64
    return x ^ (x >> 31)


def _logistic(x, y, hold):
    """The weights of least penalised loss, by reweighted least squares with halved steps."""
    def loss(w):
        m = x @ w
        return np.sum(np.logaddexp(0, m) - y * m) + 0.5 * np.sum(hold * w * w)

    w = np.zeros(x.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-(x @ w)))
        v = p * (1 - p) + 1e-9
        aim = np.linalg.solve((x.T * v) @ x + np.diag(hold), x.T @ (v * (x @ w) + y - p))
        step = 1.0
        while loss(w + step * (aim - w)) > loss(w) + 1e-12 and step > 1e-9:
            step /= 2
        w = w + step * (aim - w)
    return w


def _plain_link(sets, y, chained):
    n, rate = len(sets), sum(y) / len(sets)
    telling = []
    for word in sorted(set().union(*sets)):
        held = [i for i in range(n) if word in sets[i]]
        deviation = (len(held) * rate * (1 - rate) * (1 - len(held) / n)) ** 0.5
        far = abs(sum(y[i] for i in held) - len(held) * rate) / max(deviation, 0.5)
        if len(held) >= 3 and far >= 4.5:
            telling.append(word)
    assert len(telling) <= 256
    x = np.array([[*(float(w in s) for w in telling), *c, 1.0] for s, c in zip(sets, chained)])
    weights = _logistic(x, np.array(y, float), np.array([0.1] * (x.shape[1] - 1) + [1e-3]))

    def predict(own, before):
        row = np.array([*(float(w in own) for w in telling), *before, 1.0])
        return float(1 / (1 + np.exp(-(row @ weights))))

    return predict


def plain_chain(rows, labels):
    """Probabilities of the chain's categories for every text of ``rows``, fitted on the
    labelled ones: {doc_id: (quality, toxic)}."""
    train, seen = [], set()
    for name, text in sorted((r for r in rows if r[0] in labels), key=lambda r: r[0]):
        own = frozenset(words(text))
        if own not in seen:
            seen.add(own)
            quality, toxic = labels[name]
            train.append((name, own, (1 - quality, toxic, max(1 - quality, toxic))))
    fold = [_spread(name) % 3 for name, _, _ in train]
    sets = [own for _, own, _ in train]
    chained = [[] for _ in train]
    links = []
    for category in range(3):
        y = [target[category] for _, _, target in train]
        links.append(_plain_link(sets, y, chained))
        unseen = [0.0] * len(train)
        for f in range(3):
            out = [i for i in range(len(train)) if fold[i] != f]
            link = _plain_link([sets[i] for i in out], [y[i] for i in out], [chained[i] for i in out])
            for i in range(len(train)):
                if fold[i] == f:
                    unseen[i] = link(sets[i], chained[i])
        chained = [[*c, u] for c, u in zip(chained, unseen)]
    found = []
    for _, text in rows:
        own, before = set(words(text)), []
        for link in links:
            before.append(link(own, before))
        found.append(tuple(before))
    return found
