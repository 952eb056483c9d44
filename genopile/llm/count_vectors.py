"""Sets of word n-grams as hashed tokens, group signatures, and an R-tree of count vectors."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

U = np.uint64
_MIX1, _MIX2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection that spreads every input bit."""
    x = (x ^ (x >> U(30))) * _MIX1
    x = (x ^ (x >> U(27))) * _MIX2
    return x ^ (x >> U(31))


def token_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-grams of word hashes; fewer words are one gram."""
    if not len(words):
        return np.empty(0, np.uint64)
    size = min(n, len(words))
    grams = np.full(len(words) - size + 1, U(size), np.uint64)
    for i in range(size):
        grams = mix(grams + words[i : i + len(grams)])
    return np.unique(grams)


@dataclass(frozen=True)
class Jaccard:
    """A similarity threshold of ``num / den`` and what follows from it for set sizes."""

    num: int = 85
    den: int = 100

    def links(self, a: int, b: int, both: int) -> bool:
        return self.den * both >= self.num * (a + b - both)

    def overlap(self, total):
        """The least overlap of two linked sets of ``total`` tokens together."""
        return -(-self.num * total // (self.num + self.den))

    def apart(self, total: int) -> int:
        """The most tokens that two linked sets of ``total`` tokens do not share."""
        return (self.den - self.num) * total // (self.den + self.num)


@dataclass
class Bands:
    """Ranges of set sizes and the number of token groups used in each.

    Linked sets fall in one band, or the smaller one also signs in the band above.  They differ
    in at most ``apart`` tokens, each of which spoils one group, so with ``spare`` groups more
    than that at least ``1 + spare`` groups agree.
    """

    rule: Jaccard
    growth: float = 1.6
    uppers: list[int] = field(default_factory=list)

    def __post_init__(self) -> None:
        low = 1
        while low < 1 << 40:
            self.uppers.append(max(low, int(low * self.growth)))
            low = self.uppers[-1] + 1
        self._uppers = np.array(self.uppers)

    def of(self, size: int) -> list[int]:
        """Bands in which a set of this size signs; none where linked sets would be equal."""
        own = int(np.searchsorted(self._uppers, size))
        found = [own]
        if self.rule.den * size >= self.rule.num * (self.uppers[own] + 1):
            found.append(own + 1)
        return [b for b in found if self.groups(b)[0] > 1]

    def groups(self, band: int) -> tuple[int, int]:
        """Groups and spare groups of a band."""
        apart = self.rule.apart(2 * self.uppers[band])
        if not apart:
            return 1, 0
        spare = 1 + apart // 8
        return apart + 1 + spare, spare

    def signatures(self, tokens: np.ndarray) -> np.ndarray:
        return self.signed(tokens)[0]

    def signed(self, tokens: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """A hash of the content of every token group, by band, and how many may be dropped.

        Tokens are dealt to groups by their high bits, so a sorted set falls apart in order.
        Empty groups say nothing and are left out, unless a set has more of them than there are
        spare groups: two such sets may agree in empty groups only.  The last bit of a hash is
        that of its band, and of the hashes of either bit so many may be dropped as given: linked
        sets agree in more than the spare groups, less the empty ones.
        """
        out: list[np.ndarray] = []
        drops = [0, 0]
        if not len(tokens):
            return np.empty(0, np.uint64), drops
        marks = mix(tokens ^ U(0x9E3779B97F4A7C15))
        for band in self.of(len(tokens)):
            m, spare = self.groups(band)
            group = ((tokens >> U(33)) * U(m)) >> U(31)
            first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            name = group[first] + U(band << 40)
            hashes = mix(np.add.reduceat(marks, first) + mix(name))
            drops[band & 1] = spare - (m - len(first))
            if m - len(first) > spare:
                empty = np.setdiff1d(np.arange(m).astype(np.uint64), group[first])
                hashes = np.concatenate([hashes, mix(mix(empty + U(band << 40)) + U(1))])
                drops[band & 1] = spare
            out.append(hashes & ~U(1) | U(band & 1))
        return (np.concatenate(out) if out else np.empty(0, np.uint64)), drops


COORDINATES = 1024


def count_vector(tokens: np.ndarray) -> bytes:
    """Tokens per group of the low bits; one byte a group where that holds the counts."""
    counts = np.bincount((tokens & U(COORDINATES - 1)).astype(np.int64), minlength=COORDINATES)
    return counts.astype(np.uint8 if counts.max(initial=0) < 256 else np.uint32).tobytes()


def points(vectors: list[bytes]) -> np.ndarray:
    """Count vectors as rows of one array."""
    kinds = [np.uint8 if len(v) == COORDINATES else np.uint32 for v in vectors]
    out = np.empty((len(vectors), COORDINATES), np.int32)
    for i, (v, kind) in enumerate(zip(vectors, kinds)):
        out[i] = np.frombuffer(v, kind)
    return out


class RTree:
    """An R-tree over count vectors, loaded at once by halving the widest coordinate.

    A node keeps the upper corner of its rectangle, its smallest set size, and its component
    where all of its points share one (else -1).  The overlap of a query with any point below a
    node is at most the summed minima of the query and that corner.  Many queries go down the
    tree together, level by level.
    """

    def __init__(self, at: np.ndarray, sizes: np.ndarray, comps: np.ndarray, leaf: int = 16):
        self.at, self.sizes = at.astype(np.int32, copy=False), sizes
        # Components by small numbers, so that -1 is free.
        self.names, self.comps = np.unique(comps, return_inverse=True)
        self.leaf = leaf
        self.tops: list[np.ndarray] = []
        self.least: list[int] = []
        self.one: list[int] = []
        self.below: list[tuple[int, int]] = []
        self.rows: list[np.ndarray] = []
        self._load(np.arange(len(at)))
        self.top, self.low = np.array(self.tops), np.array(self.least)
        self.single, self.pair = np.array(self.one), np.array(self.below)

    def _load(self, rows: np.ndarray) -> int:
        me, comps, part = len(self.tops), self.comps[rows], self.at[rows]
        self.tops.append(part.max(0))
        self.least.append(int(self.sizes[rows].min()))
        self.one.append(int(comps[0]) if (comps == comps[0]).all() else -1)
        self.below.append((-1, -1))
        self.rows.append(rows)
        if len(rows) > self.leaf:
            widest = int((self.tops[me] - part.min(0)).argmax())
            order = rows[np.argsort(part[:, widest], kind="stable")]
            half = len(order) // 2
            self.below[me] = (self._load(order[:half]), self._load(order[half:]))
        return me

    @staticmethod
    def _overlaps(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray) -> np.ndarray:
        step = 2048
        parts = [
            np.minimum(a[i[k : k + step]], b[j[k : k + step]]).sum(1) for k in range(0, len(i), step)
        ]
        return np.concatenate(parts) if parts else np.empty(0, np.int64)

    def search(self, asked: np.ndarray, sizes: np.ndarray, comps: np.ndarray, rule: Jaccard):
        """Query, row and bound of every pair of different components that may be linked."""
        asked = asked.astype(np.int32, copy=False)
        place = np.searchsorted(self.names, comps).clip(max=len(self.names) - 1)
        own = np.where(self.names[place] == comps, place, -2)
        query, node = np.arange(len(asked)), np.zeros(len(asked), np.int64)
        found = [], [], []
        while len(query):
            other = self.single[node] != own[query]
            query, node = query[other], node[other]
            bound = self._overlaps(asked, query, self.top, node)
            good = bound >= rule.overlap(sizes[query] + self.low[node])
            query, node = query[good], node[good]
            ends = self.pair[node, 0] < 0
            held = [self.rows[n] for n in node[ends]]
            q = np.repeat(query[ends], [len(h) for h in held])
            r = np.concatenate(held) if held else np.empty(0, np.int64)
            other = self.comps[r] != own[q]
            q, r = q[other], r[other]
            bound = self._overlaps(asked, q, self.at, r)
            good = bound >= rule.overlap(sizes[q] + self.sizes[r])
            for out, part in zip(found, (q[good], r[good], bound[good])):
                out.append(part)
            inner = self.pair[node[~ends]]
            query = np.repeat(query[~ends], 2)
            node = inner.reshape(-1)
        empty = np.empty(0, np.int64)
        return tuple(np.concatenate(out) if out else empty for out in found)
