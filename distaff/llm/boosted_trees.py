"""Histogram gradient-boosted trees for two classes.

Features are binned once by their quantiles; a tree grows leaf by leaf on
histograms of gradients, a child's being its parent's minus its sibling's.
Fitted trees lie in flat arrays that numpy walks for all rows of a batch at
once, one level a step.
"""

from typing import NamedTuple

import numpy as np

BINS = 64


class Trees(NamedTuple):
    """All trees end to end; a leaf is its own child, so walking on stays there."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    low: np.ndarray
    high: np.ndarray
    value: np.ndarray
    depth: int
    bias: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row; nan goes to the low side."""
        total = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                up = x[rows, self.feature[node]] > self.threshold[node]
                node = np.where(up, self.high[node], self.low[node])
            total += self.value[node]
        return total

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -40, 40)))


def _best_split(hist: np.ndarray, least: float, ridge: float) -> tuple[float, int, int]:
    """Gain, feature and bin of the best cut of a (features, bins, 2) histogram."""
    left = hist.cumsum(axis=1)[:, :-1]
    total = hist.sum(axis=1)[:, None]
    right = total - left
    gain = left[..., 0] ** 2 / (left[..., 1] + ridge) + right[..., 0] ** 2 / (right[..., 1] + ridge) - total[..., 0] ** 2 / (total[..., 1] + ridge)
    gain[(left[..., 1] < least) | (right[..., 1] < least)] = -np.inf
    f, b = np.unravel_index(np.argmax(gain), gain.shape)
    return float(gain[f, b]), int(f), int(b)


def fit(
    x: np.ndarray, y: np.ndarray, rounds: int = 80, leaves: int = 8, rate: float = 0.15, least: float = 2.0, ridge: float = 1.0
) -> Trees:
    """Fit to the 0/1 labels ``y``. Without rows, or with one class only, the trees are empty."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    bias = float(np.log(share / (1 - share)))
    empty = np.zeros(1, dtype=np.int64)
    if not len(y) or y.min() == y.max():
        return Trees(np.empty(0, np.int64), empty, np.zeros(1), empty, empty, np.zeros(1), 0, bias)
    n_features = x.shape[1]
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(n_features)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    offsets = binned + np.arange(n_features) * BINS
    margin = np.full(len(y), bias)
    out: dict[str, list] = {"feature": [], "threshold": [], "low": [], "high": [], "value": []}
    roots, deepest = [], 0

    def histogram(rows: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        at = offsets[rows].ravel()
        sums = [np.bincount(at, weights=np.repeat(v[rows], n_features), minlength=n_features * BINS) for v in (g, h)]
        return np.stack(sums, axis=-1).reshape(n_features, BINS, 2)

    def new_node(value: float) -> int:
        node = len(out["value"])
        for name, v in (("feature", 0), ("threshold", 0.0), ("low", node), ("high", node), ("value", value)):
            out[name].append(v)
        return node

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)

        def leaf(rows: np.ndarray, hist: np.ndarray, depth: int, g=g, h=h) -> tuple:
            node = new_node(rate * float(g[rows].sum() / (h[rows].sum() + ridge)))
            return node, rows, hist, depth, _best_split(hist, least, ridge)

        everything = np.arange(len(y))
        open_ = [leaf(everything, histogram(everything, g, h), 0)]
        roots.append(open_[0][0])
        while len(open_) < leaves:
            node, rows, hist, depth, (gain, f, b) = open_[pick := max(range(len(open_)), key=lambda i: open_[i][4][0])]
            if not gain > 1e-6:
                break
            up = binned[rows, f] > b
            low, high = rows[~up], rows[up]
            small, large = (low, high) if len(low) < len(high) else (high, low)
            part = histogram(small, g, h)
            hists = {id(small): part, id(large): hist - part}
            children = [leaf(r, hists[id(r)], depth + 1) for r in (low, high)]
            deepest = max(deepest, depth + 1)
            out["feature"][node], out["threshold"][node] = f, float(edges[f][b]) if b < len(edges[f]) else np.inf
            out["low"][node], out["high"][node] = children[0][0], children[1][0]
            open_[pick : pick + 1] = children
        for node, rows, *_ in open_:
            margin[rows] += out["value"][node]
    whole = {"feature": np.int64, "threshold": np.float64, "low": np.int64, "high": np.int64, "value": np.float64}
    flat = {k: np.array(v, dtype=whole[k]) for k, v in out.items()}
    return Trees(np.array(roots, dtype=np.int64), depth=deepest, bias=bias, **flat)
