"""Gradient-boosted trees and isotonic calibration on a bounded sample, by numpy."""

from __future__ import annotations

import numpy as np

ROUNDS, DEPTH, RATE, BINS, PENALTY, LEAST = 60, 3, 0.2, 32, 1.0, 3.0


def bin_edges(x: np.ndarray) -> list[np.ndarray]:
    """Cut points of each feature: distinct quantiles, and one above the most common value."""
    out = []
    for column in x.T:
        values = np.unique(column)
        if len(values) > BINS:
            values = np.unique(np.quantile(column[column > column.min()], np.linspace(0, 1, BINS)))
            values = np.concatenate([[column.min()], values])
        out.append((values[1:] + values[:-1]) / 2 if len(values) > 1 else np.zeros(0))
    return out


def fit_trees(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, list[tuple]]:
    """Logistic boosting: (start, trees); a tree is (feature, cut, leaf value) arrays in heap order."""
    share = np.clip(np.average(y, weights=weight), 1e-6, 1 - 1e-6)
    start = float(np.log(share / (1 - share)))
    edges = bin_edges(x)
    binned = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T, strict=True)], axis=1)
    score, trees = np.full(len(y), start), []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-score))
        g, h = weight * (p - y), weight * p * (1 - p)
        nodes = 2 ** (DEPTH + 1) - 1
        feature, cut, value = np.full(nodes, -1), np.zeros(nodes), np.zeros(nodes)
        rows = {0: np.arange(len(y))}
        for node in range(nodes):
            own = rows.pop(node, None)
            if own is None:
                continue
            value[node] = -RATE * g[own].sum() / (h[own].sum() + PENALTY)
            best = best_split(binned, edges, g, h, own) if node < 2 ** DEPTH - 1 else None
            if best is None:
                score[own] += value[node]
                continue
            feature[node], cut[node] = best[0], edges[best[0]][best[1]]
            left = binned[own, best[0]] <= best[1]
            rows[2 * node + 1], rows[2 * node + 2] = own[left], own[~left]
        trees.append((feature, cut, value))
    return start, trees


def best_split(binned, edges, g, h, own) -> tuple[int, int] | None:
    """(feature, bin) with the largest gain, or none."""
    best, found = 1e-6, None
    all_g, all_h = g[own].sum(), h[own].sum()
    base = all_g ** 2 / (all_h + PENALTY)
    for f in range(binned.shape[1]):
        if not len(edges[f]):
            continue
        size = len(edges[f]) + 1
        lg = np.cumsum(np.bincount(binned[own, f], g[own], size))[:-1]
        lh = np.cumsum(np.bincount(binned[own, f], h[own], size))[:-1]
        ln = np.cumsum(np.bincount(binned[own, f], minlength=size))[:-1]
        gain = lg ** 2 / (lh + PENALTY) + (all_g - lg) ** 2 / (all_h - lh + PENALTY) - base
        gain[(ln < LEAST) | (len(own) - ln < LEAST)] = 0
        k = int(np.argmax(gain))
        if gain[k] > best:
            best, found = gain[k], (f, k)
    return found


def score_trees(x: np.ndarray, start: float, trees: list[tuple]) -> np.ndarray:
    out = np.full(len(x), start)
    for feature, cut, value in trees:
        node = np.zeros(len(x), int)
        for _ in range(DEPTH):
            f = feature[node]
            inner = f >= 0
            right = x[np.arange(len(x)), np.maximum(f, 0)] > cut[node]
            node = np.where(inner, 2 * node + 1 + right, node)
        out += value[node]
    return out


def fit_isotonic(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (scores, probabilities), both ascending; each end is drawn in by half a row."""
    order = np.argsort(score, kind="stable")
    pools: list[list[float]] = []
    for s, t, w in zip(score[order], y[order], weight[order], strict=True):
        pools.append([s, s, t * w, w])
        while len(pools) > 1 and (pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]
                                  or pools[-2][1] == pools[-1][0]):
            low, high, hit, mass = pools.pop()
            pools[-1] = [pools[-1][0], high, pools[-1][2] + hit, pools[-1][3] + mass]
    at = [v for p in pools for v in p[:2]]
    probability = [(p[2] + 0.5 * p[2] / max(p[3], 1e-9)) / (p[3] + 0.5) for p in pools for _ in (0, 1)]
    return np.array(at), np.array(probability)


def calibrated(score: np.ndarray, at: np.ndarray, probability: np.ndarray) -> np.ndarray:
    return np.clip(np.interp(score, at, probability), 0, 1) if len(at) else np.zeros(len(score))
