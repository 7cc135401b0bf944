"""Linear-chain conditional random fields in numpy: training, forward-backward and Viterbi over batches of sequences.

The items of a sequence (words, or their shapes) are described by hashed character n-grams of the item between two marks:
those that touch a mark are its affixes.  Known frequent items have a weight of their own (the lexicon).  An item's scores
are sums of table rows, so they are computed once per distinct item and kept in a bounded table of each Python worker.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np

HASH_BITS = 16
SIZES = (2, 3, 4)
MARKS = "\x02\x03"
LENGTH = 64  # items of a sequence of the fit at most; a longer text is several sequences
STEP, EDGE = 192, 32  # a longer text is decoded in pieces, each with so many items more on both sides for their context
KNOWN = 300_000  # items whose scores a worker keeps


def features(items: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of all items, one after the other, and where each item's begin."""
    joined = "".join(f"{MARKS[0]}{w}{MARKS[1]}" for w in items)
    c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, items), np.int64, len(items)) + 2
    begin = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(items)), size)
    place = np.arange(len(c)) - begin[owner]
    found, owners = [], []
    for n in SIZES:
        at = np.flatnonzero(place + n <= size[owner])
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = (h * np.uint64(0x9E3779B97F4A7C15)) ^ (c[at + k] * np.uint64(0xC2B2AE3D27D4EB4F))
            h ^= h >> np.uint64(29)
        found.append((h >> np.uint64(64 - HASH_BITS - 7)) & np.uint64((1 << HASH_BITS) - 1))
        owners.append(owner[at])
    hashes, owners = np.concatenate(found).astype(np.int64), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return hashes[order], np.searchsorted(owners[order], np.arange(len(items)))


@dataclass
class Model:
    """Scores: a row of ``weights`` for each hash, with one column per (offset of the neighbour, label)."""

    labels: list[str]
    offsets: tuple[int, ...]
    weights: np.ndarray
    lexicon: dict[str, np.ndarray]
    start: np.ndarray
    move: np.ndarray
    key: int = 0
    seen: dict[str, int] = field(default_factory=dict, repr=False)
    rows: np.ndarray | None = field(default=None, repr=False)

    def _score(self, items: list[str]) -> np.ndarray:
        h, begin = features(items)
        out = np.add.reduceat(self.weights[h], begin, axis=0)
        for i, w in enumerate(items):
            own = self.lexicon.get(w)
            if own is not None:
                out[i] += own
        return out

    def positions(self, items: list[list[str]]) -> list[np.ndarray]:
        """For each list the rows of its items in the worker's table, which is filled as needed."""
        new = [w for w in set().union(*items) if w not in self.seen]
        if self.rows is None or len(self.seen) + len(new) > KNOWN:
            self.seen, new = {}, list(set().union(*items))
            self.rows = np.zeros((max(KNOWN, len(new)), self.weights.shape[1]), np.float32)
        for k in range(0, len(new), 20_000):
            part = new[k : k + 20_000]
            self.rows[len(self.seen) : len(self.seen) + len(part)] = self._score(part)
            self.seen.update(zip(part, range(len(self.seen), len(self.seen) + len(part))))
        get = self.seen.__getitem__
        return [np.fromiter(map(get, w), np.int64, len(w)) for w in items]

    def emissions(self, rows: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """(items, labels): neighbours beyond the ends (``first``, ``last`` flag them) count nothing."""
        n = len(self.labels)
        table = self.rows
        out = np.zeros((len(rows), n), np.float32)
        for k, d in enumerate(self.offsets):
            part = table[:, k * n : (k + 1) * n]
            if d == 0:
                out += part[rows]
            elif d < 0:
                out[1:] += np.where(first[1:, None], 0, part[rows[:-1]])
            else:
                out[:-1] += np.where(last[:-1, None], 0, part[rows[1:]])
        return out


def cut(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the sequences of texts with so many items, longest sequences first."""
    pieces = -(-sizes // LENGTH)
    owner = np.repeat(np.arange(len(sizes)), pieces)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = (np.cumsum(sizes) - sizes)[owner] + k * LENGTH
    length = np.minimum(sizes[owner] - k * LENGTH, LENGTH)
    order = np.argsort(-length, kind="stable")
    return begin[order], length[order]


def overlap(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces for decoding texts with so many items: the items of all pieces, start and length of each piece in them, longest
    first, and where the items stand whose labels count, each once and in the order of the texts.
    """
    pieces = -(-sizes // STEP)
    owner = np.repeat(np.arange(len(sizes)), pieces)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    low = np.maximum(0, k * STEP - EDGE)
    length = np.minimum(sizes[owner], (k + 1) * STEP + EDGE) - low
    begin = np.cumsum(length) - length
    place = np.arange(int(length.sum())) - np.repeat(begin - low, length)  # in the text
    items = place + np.repeat((np.cumsum(sizes) - sizes)[owner], length)
    own = np.flatnonzero(place // STEP == np.repeat(k, length))
    order = np.argsort(-length, kind="stable")
    return items, begin[order], length[order], own


def marginals(model: Model, emit: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Label probabilities of every item by forward-backward; sequences are sorted by falling length."""
    gamma, _ = _forward_backward(model.start, model.move, emit, begin, length)
    return gamma


def _forward_backward(start, move, emit, begin, length, pairs: bool = False):
    n = emit.shape[1]
    e = np.exp(emit - emit.max(axis=1, keepdims=True)).astype(np.float64)
    a = np.exp(move)
    active = [int(np.searchsorted(-length, -t, side="left")) for t in range(int(length[0]) if len(length) else 0)]
    alpha, total = np.zeros_like(e), np.zeros((n, n))
    for t, m in enumerate(active):
        at = begin[:m] + t
        f = e[at] * (np.exp(start) if t == 0 else alpha[at - 1] @ a)
        alpha[at] = f / f.sum(axis=1, keepdims=True)
    gamma = alpha.copy()
    beta = np.ones((len(begin), n))
    for t in range(len(active) - 1, 0, -1):
        m = active[t]
        at = begin[:m] + t
        right = e[at] * beta[:m]
        if pairs:
            joint = alpha[at - 1][:, :, None] * a[None] * right[:, None, :]
            total += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        b = right @ a.T
        beta[:m] = b / b.sum(axis=1, keepdims=True)
        g = alpha[at - 1] * beta[:m]
        gamma[at - 1] = g / g.sum(axis=1, keepdims=True)
    return gamma, total


def viterbi(model: Model, emit: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The best label number of every item; sequences are sorted by falling length."""
    steps = int(length[0]) if len(length) else 0
    active = [int(np.searchsorted(-length, -t, side="left")) for t in range(steps)]
    n = emit.shape[1]
    move = model.move.astype(np.float32)
    best = np.zeros((len(begin), n), np.float32)
    back = np.zeros(emit.shape, np.int8)
    for t, m in enumerate(active):
        at = begin[:m] + t
        if t == 0:
            best[:m] = model.start + emit[at]
        else:
            value = best[:m, :1] + move[0]
            source = np.zeros((m, n), np.int8)
            for k in range(1, n):
                other = best[:m, k : k + 1] + move[k]
                better = other > value
                value = np.where(better, other, value)
                source[better] = k
            back[at], best[:m] = source, value + emit[at]
    out = np.zeros(len(emit), np.int8)
    now = best.argmax(axis=1).astype(np.int8)
    for t in range(steps - 1, -1, -1):
        m = active[t]
        at = begin[:m] + t
        if t + 1 < steps:
            k = active[t + 1]
            now[:k] = back[begin[:k] + t + 1, now[:k]]
        out[at] = now[:m]
    return out


def train(
    texts: list[list[str]], tags: list[list[int]], labels: list[str], offsets: tuple[int, ...] = (0,), rounds: int = 30,
    rate: float = 0.3, lexicon: int = 5000, decay: float = 1e-5,
) -> Model:
    """Maximum likelihood by full-batch gradient steps with a step size per weight (Adagrad)."""
    n, wide = len(labels), len(labels) * len(offsets)
    flat = [w for t in texts for w in t]
    kinds, rows = np.unique(np.array(flat, dtype=object).astype(str), return_inverse=True) if flat else (np.array([], str), np.array([], int))
    kinds = kinds.tolist()
    gold = np.array([g for t in tags for g in t], np.int64)
    sizes = np.array([len(t) for t in texts], np.int64)
    begin, length = cut(sizes)
    first = np.zeros(len(flat), bool)
    first[begin] = True
    last = np.zeros(len(flat), bool)
    last[begin + length - 1] = True
    h, at = features(kinds)
    counts = np.diff(np.append(at, len(h)))
    known = np.argsort(-np.bincount(rows, minlength=len(kinds)), kind="stable")[:lexicon]
    model = Model(labels, offsets, np.zeros((1 << HASH_BITS, wide), np.float32), {}, np.zeros(n), np.zeros((n, n)))
    own = np.zeros((len(kinds), wide), np.float32)
    may = np.zeros(len(kinds), bool)
    may[known] = True
    squares = [np.full(x.shape, 1e-6) for x in (model.weights, own, model.start, model.move)]
    pair_gold = np.zeros((n, n))
    inner = np.flatnonzero(~first)
    np.add.at(pair_gold, (gold[inner - 1], gold[inner]), 1)
    one = np.eye(n)[gold]
    for _ in range(rounds):
        model.rows = (np.add.reduceat(model.weights[h], at, axis=0) + own).astype(np.float32)
        emit = model.emissions(rows, first, last)
        gamma, pairs = _forward_backward(model.start, model.move, emit, begin, length, pairs=True)
        miss = one - gamma
        by_kind = np.zeros((len(kinds), wide))
        for k, d in enumerate(offsets):
            if d == 0:
                sel, who = slice(None), rows
            elif d < 0:
                sel = np.flatnonzero(~first)
                who = rows[sel - 1]
            else:
                sel = np.flatnonzero(~last)
                who = rows[sel + 1]
            for j in range(n):
                by_kind[:, k * n + j] = np.bincount(who, weights=miss[sel, j], minlength=len(kinds))
        grad = np.stack([np.bincount(h, weights=np.repeat(by_kind[:, j], counts), minlength=1 << HASH_BITS) for j in range(wide)], axis=1)
        grads = [grad, by_kind * may[:, None], miss[begin].sum(axis=0), pair_gold - pairs]
        for x, g, s in zip((model.weights, own, model.start, model.move), grads, squares):
            g = g / max(1, len(flat)) - decay * x
            s += g * g
            x += (rate * g / np.sqrt(s)).astype(x.dtype)
    model.lexicon = {kinds[i]: own[i].copy() for i in known}
    model.rows = None
    return model
