"""Linkage of a bounded set of weighted centres, and cluster validity indices (numpy)."""

from __future__ import annotations

import numpy as np


def merge(centres: np.ndarray, weights: np.ndarray, method: str) -> list[tuple[int, int, float]]:
    """Successive merges ``(kept, absorbed, height)`` on squared Euclidean distances."""
    size = weights.astype(float).copy()
    square = ((centres[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)
    if method == "ward":
        square *= 2 * np.outer(size, size) / np.add.outer(size, size)
    np.fill_diagonal(square, np.inf)
    alive = np.ones(len(size), bool)
    steps = []
    for _ in range(len(size) - 1):
        i, j = sorted(np.unravel_index(square.argmin(), square.shape))
        d_ij = square[i, j]
        a, b = size[i], size[j]
        if method == "ward":
            new = ((a + size) * square[i] + (b + size) * square[j] - size * d_ij) / (a + b + size)
        elif method == "centroid":
            new = (a * square[i] + b * square[j]) / (a + b) - a * b * d_ij / (a + b) ** 2
        else:
            raise ValueError(f"unknown linkage {method!r}")
        alive[j] = False
        new[~alive] = np.inf
        new[i] = np.inf
        square[i], square[:, i] = new, new
        square[j], square[:, j] = np.inf, np.inf
        size[i] += b
        steps.append((int(i), int(j), float(np.sqrt(max(d_ij, 0.0)))))
    return steps


def cut(steps: list[tuple[int, int, float]], n: int, k: int) -> list[int]:
    """Labels from 1, in order of first appearance, after leaving ``k`` groups."""
    owner = list(range(n))
    for kept, absorbed, _ in steps[: max(n - k, 0)]:
        owner = [kept if o == absorbed else o for o in owner]
    order = {o: i + 1 for i, o in enumerate(dict.fromkeys(owner))}
    return [order[o] for o in owner]


def _by_k(moments: list[dict], z: list[str]) -> dict[int, dict]:
    """Sizes, means, within and total scatter matrices per k."""
    out = {}
    p = len(z)
    for k in sorted({m["k"] for m in moments}):
        group = [m for m in moments if m["k"] == k]
        n = np.array([m["n"] for m in group], float)
        sums = np.array([[m[f"s_{c}"] for c in z] for m in group])
        cross = np.zeros((len(group), p, p))
        for g, m in enumerate(group):
            for i in range(p):
                for j in range(i, p):
                    cross[g, i, j] = cross[g, j, i] = m[f"p{i}_{j}"]
        means = sums / n[:, None]
        within = cross - n[:, None, None] * np.einsum("gi,gj->gij", means, means)
        total = cross.sum(axis=0) - np.outer(sums.sum(axis=0), sums.sum(axis=0)) / n.sum()
        out[k] = {"n": n, "means": means, "each": within, "W": within.sum(axis=0), "T": total}
    return out


def validity_indices(
    moments: list[dict], z: list[str], candidates: list[int], silhouette: dict[int, float]
) -> dict[str, list[tuple[int, float, bool]]]:
    """``{index: [(k, value, chosen)]}`` for the indices computable from scatter matrices."""
    by_k = _by_k(moments, z)
    p = len(z)
    n = by_k[candidates[0]]["n"].sum()
    trace = {k: np.trace(m["W"]) for k, m in by_k.items()}
    ridge = 1e-9 * np.eye(p)
    det_w = {k: np.linalg.det(m["W"] + ridge) for k, m in by_k.items()}
    det_t = np.linalg.det(by_k[candidates[0]]["T"] + ridge)
    marriot = {k: k * k * det_w[k] for k in by_k}
    friedman = {
        k: np.trace(np.linalg.solve(m["W"] + ridge, m["T"] - m["W"])) for k, m in by_k.items()
    }
    rubin = {k: det_t / det_w[k] for k in by_k}
    scott = {k: n * np.log(det_t / det_w[k]) for k in by_k}
    trcov = {k: np.trace(np.cov(m["W"])) for k, m in by_k.items()}

    def ch(k):
        return (np.trace(by_k[k]["T"]) - trace[k]) / (k - 1) / (trace[k] / (n - k))

    def hartigan(k):
        return (trace[k] / trace[k + 1] - 1) * (n - k - 1)

    def diff(k):
        return (k - 1) ** (2 / p) * trace[k - 1] - k ** (2 / p) * trace[k]

    def davies_bouldin(k):
        m = by_k[k]
        scatter = np.sqrt(np.trace(m["each"], axis1=1, axis2=2) / m["n"])
        apart = np.sqrt(((m["means"][:, None] - m["means"][None]) ** 2).sum(axis=2))
        np.fill_diagonal(apart, np.inf)
        return ((scatter[:, None] + scatter[None]) / apart).max(axis=1).mean()

    def ratkowsky(k):
        total = np.diag(by_k[k]["T"])
        between = total - np.diag(by_k[k]["W"])
        ratio = np.divide(between, total, out=np.zeros(p), where=total > 0)
        return np.sqrt(ratio).mean() / np.sqrt(k)

    def step(series, k):
        """How much the curve bends at k."""
        return (series[k + 1] - series[k]) - (series[k] - series[k - 1])

    largest = {
        "calinski_harabasz": {k: ch(k) for k in candidates},
        "krzanowski_lai": {
            k: abs(diff(k) / diff(k + 1)) if diff(k + 1) else 0.0 for k in candidates
        },
        "ratkowsky_lance": {k: ratkowsky(k) for k in candidates},
        "silhouette": {k: silhouette[k] for k in candidates},
        # the indices below vote where their curve changes most
        "hartigan": {k: hartigan(k - 1) - hartigan(k) for k in candidates},
        "ball": {k: trace[k - 1] / (k - 1) - trace[k] / k for k in candidates},
        "scott": {k: scott[k] - scott[k - 1] for k in candidates},
        "marriot": {k: step(marriot, k) for k in candidates},
        "trcovw": {k: trcov[k - 1] - trcov[k] for k in candidates},
        "tracew": {k: step(trace, k) for k in candidates},
        "friedman": {k: friedman[k] - friedman[k - 1] for k in candidates},
    }
    smallest = {
        "davies_bouldin": {k: davies_bouldin(k) for k in candidates},
        "rubin": {k: step(rubin, k) for k in candidates},
    }
    out = {}
    for best, group in ((max, largest), (min, smallest)):
        for name, values in group.items():
            winner = best(values, key=values.get)
            out[name] = [(k, float(v), k == winner) for k, v in values.items()]
    return out
