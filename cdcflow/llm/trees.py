"""Small histogram trees: gradient boosting and random forests in numpy.

Fitted on bounded labelled samples, or on counted rows of any number
(``boost_counted``); a model is a few thousand numbers that travel with the scoring
function.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32
VALUES = 256     # counted rows hold whole numbers below this
UNIT = 1 << 20   # sums of counted rows are in such parts of one, so that they do not depend on their order


@dataclass
class Tree:
    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    value: np.ndarray
    depth: int

    def leaf(self, binned: np.ndarray) -> np.ndarray:
        at = np.zeros(len(binned), np.int64)
        for _ in range(self.depth):
            inner = self.left[at] > 0
            right = binned[np.arange(len(at)), self.feature[at]] > self.split[at]
            at = np.where(inner, self.left[at] + right, at)
        return at

    def predict(self, binned: np.ndarray) -> np.ndarray:
        return self.value[self.leaf(binned)]


def _grow(binned, g, h, depth, least, lam, rng, share) -> Tree:
    feature, split, left, value = [0], [0], [0], [0.0]
    todo = [(0, np.arange(len(g)), 0)]
    while todo:
        node, rows, level = todo.pop()
        gs, hs = g[rows].sum(), h[rows].sum()
        value[node] = -gs / (hs + lam) if hs + lam > 0 else 0.0
        if level == depth or hs < 2 * least:
            continue
        best = (1e-9, None, None)
        for f in rng.permutation(binned.shape[1])[: max(1, int(round(share * binned.shape[1])))]:
            b = binned[rows, f]
            gl = np.cumsum(np.bincount(b, g[rows], BINS))[:-1]
            hl = np.cumsum(np.bincount(b, h[rows], BINS))[:-1]
            ok = (hl >= least) & (hs - hl >= least)
            if ok.any():
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(ok, gl**2 / (hl + lam) + (gs - gl) ** 2 / (hs - hl + lam) - gs**2 / (hs + lam), -1)
                s = int(gain.argmax())
                if gain[s] > best[0]:
                    best = (gain[s], f, s)
        if best[1] is None:
            continue
        feature[node], split[node], left[node] = int(best[1]), best[2], len(value)
        feature += [0, 0]
        split += [0, 0]
        left += [0, 0]
        value += [0.0, 0.0]
        goes = binned[rows, best[1]] > best[2]
        todo += [(left[node], rows[~goes], level + 1), (left[node] + 1, rows[goes], level + 1)]
    return Tree(np.array(feature), np.array(split), np.array(left), np.array(value), depth)


@dataclass
class Model:
    edges: list[np.ndarray]
    trees: list[Tree]
    base: float
    boosted: bool

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of the positive class per row."""
        if not len(x):
            return np.zeros(0)
        binned = _bin(x, self.edges)
        total = sum(t.predict(binned) for t in self.trees)
        if self.boosted:
            return 1 / (1 + np.exp(-(self.base + total)))
        return np.clip(total / len(self.trees), 0, 1)


def _bin(x, edges):
    return np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], 1).astype(np.int64)


def _edges(x):
    return [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1]))[: BINS - 1] for f in range(x.shape[1])]


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3, seed: int = 7) -> Model:
    """Gradient-boosted trees for logistic loss."""
    rng = np.random.default_rng(seed)
    edges = _edges(x)
    binned = _bin(x, edges)
    p = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    base = float(np.log(p / (1 - p)))
    f, trees = np.full(len(y), base), []
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-f))
        t = _grow(binned, q - y, np.maximum(q * (1 - q), 1e-6), depth, 1e-3, 1.0, rng, 1.0)
        t.value *= rate
        f += t.predict(binned)
        trees.append(t)
    return Model(edges, trees, base, True)


class Counted:
    """Rows ``x`` (bytes), ``n`` times each, ``good`` of those positive."""

    def __init__(self, x: np.ndarray, n: np.ndarray, good: np.ndarray):
        self.x, self.n, self.good = x, n, good
        self.f, self.trees = np.zeros(len(x)), 0

    def sums(self, model: Model, tree: Tree) -> np.ndarray:
        """``[gradient or hessian, node, feature, value]`` over the rows in every node of a tree to come after the model's."""
        for t in model.trees[self.trees :]:
            self.f += t.predict(self.x)
        self.trees = len(model.trees)
        q = 1 / (1 + np.exp(-(model.base + self.f)))
        both = np.rint((self.n * q - self.good) * UNIT), np.rint(self.n * np.maximum(q * (1 - q), 1e-6) * UNIT)
        at, nodes = tree.leaf(self.x) * VALUES, len(tree.value)
        return np.stack([np.stack([np.bincount(at + column, w, nodes * VALUES).reshape(nodes, VALUES) for column in self.x.T], 1) for w in both]).astype(np.int64)


def boost_counted(total, features: int, share: float, rounds: int = 40, depth: int = 3, rate: float = 0.3, least: float = 1e-3, lam: float = 1.0) -> Model:
    """Gradient-boosted trees for logistic loss over counted rows, ``share`` of them positive;
    ``total(model, tree)`` adds up the ``sums`` of all."""
    p = np.clip(share, 1e-6, 1 - 1e-6)
    model = Model([np.arange(VALUES - 1)] * features, [], float(np.log(p / (1 - p))), True)
    for _ in range(rounds):
        tree = Tree(np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1), 0)
        for level in range(depth):
            g, h = total(model, tree) / UNIT
            gl, hl = np.cumsum(g, 2), np.cumsum(h, 2)
            gs, hs = gl[:, 0, -1, None, None], hl[:, 0, -1, None, None]
            if level == 0:
                tree.value[0] = -gs[0, 0, 0] / (hs[0, 0, 0] + lam)
            ok = (hl >= least) & (hs - hl >= least)
            gain = np.where(ok, gl**2 / (hl + lam) + (gs - gl) ** 2 / (hs - hl + lam) - gs**2 / (hs + lam), -1)
            for node in np.flatnonzero(gain.max((1, 2)) > 1e-9):
                f, v = np.unravel_index(gain[node].argmax(), gain[node].shape)
                a, b = gl[node, f, v], hl[node, f, v]
                tree.feature[node], tree.split[node], tree.left[node] = f, v, len(tree.value)
                tree.feature, tree.split, tree.left = (np.append(e, [0, 0]) for e in (tree.feature, tree.split, tree.left))
                tree.value = np.append(tree.value, [-a / (b + lam), -(gs[node, 0, 0] - a) / (hs[node, 0, 0] - b + lam)])
            tree.depth += 1
        tree.value *= rate
        model.trees.append(tree)
    return model


def forest(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 8, seed: int = 7) -> Model:
    """Random forest of variance-splitting trees on bootstrap rows."""
    rng = np.random.default_rng(seed)
    edges = _edges(x)
    binned = _bin(x, edges)
    share = max(1, round(x.shape[1] ** 0.5)) / x.shape[1]
    made = []
    for _ in range(trees):
        w = np.bincount(rng.integers(0, len(y), len(y)), minlength=len(y)).astype(float)
        made.append(_grow(binned, -w * y, w, depth, 2.0, 0.0, rng, share))
    return Model(edges, made, 0.0, False)
