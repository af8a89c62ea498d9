"""Centroids of balanced posting lists and the graph that finds the lists of a vector.

Everything here is numpy on a bounded number of centroids (``MAX_LISTS``) and of sampled vectors.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: nearest others that a centroid of the graph has links to, as many lead back, and centroids that a search keeps in hand at least
DEGREE = 16
BEAM = 24
#: fewest centroids that a search starts from
ENTRIES = 16
#: vectors of one search batch
BATCH = 512


class Graph(NamedTuple):
    """Centroids, their squared norms, the numbers of each one's neighbours, and entry points."""

    centroids: np.ndarray
    squares: np.ndarray
    links: np.ndarray
    entries: np.ndarray


def _halves(points: np.ndarray, share: float, rng) -> tuple[np.ndarray, np.ndarray]:
    """Two parts of the wanted shares, cut across the line between two means."""
    a, b = points[rng.choice(len(points), 2, replace=len(points) < 2)]
    cut = round(share * len(points))
    for _ in range(4):
        order = np.argsort(points @ (a - b), kind="stable")
        a, b = points[order[cut:]].mean(0), points[order[:cut]].mean(0)
    return order[:cut], order[cut:]


def balanced_centroids(sample: np.ndarray, n_lists: int, seed: int = 7) -> np.ndarray:
    """Centroids of ``n_lists`` lists; ``sample`` has at least as many rows.

    The sample is halved until there are as many parts, all of almost equal size.  k-means rounds
    follow, in which a list with too many rows adds a charge to its squared distances, so that its
    centroid gives up its border, and one with too few takes it back.
    """
    rng = np.random.default_rng(seed)
    todo, parts = [(np.arange(len(sample)), n_lists)], []
    while todo:
        rows, k = todo.pop()
        if k == 1:
            parts.append(rows)
            continue
        low = k // 2
        left, right = _halves(sample[rows], low / k, rng)
        todo += [(rows[left], low), (rows[right], k - low)]
    centroids, charges = np.array([sample[rows].mean(0) for rows in parts]), np.zeros(n_lists)
    for _ in range(6 if n_lists > 1 else 0):
        own, gaps = [], []
        for at in range(0, len(sample), 8 * BATCH):
            cost = (centroids**2).sum(1) + charges - 2 * sample[at : at + 8 * BATCH] @ centroids.T
            near = np.partition(cost, 1, axis=1)
            gaps.append(near[:, 1] - near[:, 0])
            own.append(cost.argmin(1))
        own = np.concatenate(own)
        counts = np.bincount(own, minlength=n_lists)
        charges += np.median(np.concatenate(gaps)) * np.clip(counts / counts.mean() - 1, -2, 2)
        full = counts > 0
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, sample)
        centroids[full] = sums[full] / counts[full, None]
    return centroids


def _two_way(near: np.ndarray) -> np.ndarray:
    """Links in both directions, each node's nearest takers first, padded with the node itself."""
    n, degree = near.shape
    into, place = near.ravel(), np.tile(np.arange(degree), n)
    order = np.lexsort((place, into))
    counts = np.bincount(into, minlength=n)
    turn = np.arange(n * degree) - np.repeat(np.cumsum(counts) - counts, counts)
    few = order[turn < degree]
    back = np.repeat(np.arange(n)[:, None], degree, axis=1)
    back[into[few], turn[turn < degree]] = few // degree
    return np.hstack([near, back]).astype(np.int32)


def _reached(links: np.ndarray, entries: np.ndarray) -> np.ndarray:
    seen, edge = np.zeros(len(links), bool), entries
    while len(edge):
        seen[edge] = True
        edge = np.unique(links[edge])
        edge = edge[~seen[edge]]
    return seen


def build_graph(centroids: np.ndarray, seed: int = 7) -> Graph:
    """Each centroid linked, in both directions, to its nearest others; links are made in blocks of rows.

    The entry points are drawn; one is added in each part of the graph that they do not reach.
    """
    n, squares = len(centroids), (centroids**2).sum(1)
    degree = min(DEGREE, n)
    near = np.zeros((n, degree), np.int64)
    for at in range(0, n, BATCH):
        distance = squares - 2 * centroids[at : at + BATCH] @ centroids.T
        near[at : at + BATCH] = np.argsort(distance, axis=1, kind="stable")[:, :degree]
    links = _two_way(near)
    entries = np.random.default_rng(seed).permutation(n)[: max(ENTRIES, int(n**0.5))]
    while not (seen := _reached(links, entries)).all():
        entries = np.append(entries, np.flatnonzero(~seen)[0])
    return Graph(centroids, squares, links, np.sort(entries).astype(np.int32))


def _search(graph: Graph, points: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    n, every = len(points), np.arange(len(points))[:, None]
    beam = min(max(BEAM, wanted + wanted // 2), len(graph.centroids))
    own = (points**2).sum(1)[:, None]
    distance = own + graph.squares[graph.entries] - 2 * points @ graph.centroids[graph.entries].T
    keep = np.argsort(distance, axis=1, kind="stable")[:, :beam]
    nodes, distance = graph.entries[keep], distance[every, keep]
    if (short := beam - nodes.shape[1]) > 0:
        nodes = np.pad(nodes, ((0, 0), (0, short)), constant_values=-1)
        distance = np.pad(distance, ((0, 0), (0, short)), constant_values=np.inf)
    done = nodes < 0
    seen = np.zeros((n, len(graph.centroids)), bool)
    seen[every, graph.entries[None]] = True
    at_once = 4
    while not done.all():
        rank = np.argsort(np.where(done, np.inf, distance), axis=1, kind="stable")[:, :at_once]
        open_ = ~done[every, rank]
        done[every, rank] = True
        near = graph.links[nodes[every, rank]]
        new = (~seen[every[:, :, None], near] & open_[:, :, None]).reshape(n, -1)
        near = near.reshape(n, -1)
        row, column = np.nonzero(new)
        node = near[row, column]
        fresh = ~seen[row, node]
        seen[row, node] = True
        key = np.unique(row[fresh].astype(np.int64) * len(graph.centroids) + node[fresh])
        row, node = key // len(graph.centroids), key % len(graph.centroids)
        if not len(row):
            continue
        found = own[row, 0] + graph.squares[node] - 2 * np.einsum(
            "ij,ij->i", points[row], graph.centroids[node]
        )
        per_row = np.bincount(row, minlength=n)
        place = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
        width = per_row.max()
        more = np.full((n, width), -1, np.int32)
        more_distance = np.full((n, width), np.inf)
        more[row, place], more_distance[row, place] = node, found
        nodes, distance = np.hstack([nodes, more]), np.hstack([distance, more_distance])
        done = np.hstack([done, more < 0])
        keep = np.argsort(distance, axis=1, kind="stable")[:, :beam]
        nodes, distance, done = nodes[every, keep], distance[every, keep], done[every, keep]
    return nodes[:, :wanted], np.sqrt(np.maximum(distance[:, :wanted], 0))


def nearest_lists(graph: Graph, points: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and distances of the ``wanted`` nearest centroids that a best-first search finds.

    From the entry points on, the links of the nearest unvisited centroids in hand are followed until all
    in hand are visited.  Where the graph gives fewer, the rest is -1 at infinite distance.
    """
    wanted = min(wanted, len(graph.centroids))
    parts = [_search(graph, points[i : i + BATCH], wanted) for i in range(0, len(points), BATCH)]
    if not parts:
        return np.zeros((0, wanted), np.int32), np.zeros((0, wanted))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def chosen_lists(graph: Graph, points: np.ndarray, copies: int, ratio: float) -> np.ndarray:
    """Lists that each vector is put into, ``copies`` columns, -1 where there is none.

    The nearest list, and those after it that are at most ``ratio`` times as far: a vector near a border
    stands on both sides of it.
    """
    nodes, distance = nearest_lists(graph, points, copies)
    return np.where(distance <= ratio * distance[:, :1], nodes, -1)


def probed_lists(
    graph: Graph, points: np.ndarray, ratio: float, sizes: np.ndarray, least: int
) -> list[np.ndarray]:
    """Lists to search for each vector: those at most ``ratio`` times as far as the nearest.

    More are added, by distance, until the lists are the first ones of ``least`` rows (``sizes``).
    The search widens for the vectors whose last list found is still among them.
    """
    found: list[np.ndarray] = [np.zeros(0, np.int32)] * len(points)
    left, wanted, n = np.arange(len(points)), 32, len(graph.centroids)
    while len(left):
        nodes, distance = nearest_lists(graph, points[left], wanted)
        rows = np.where(nodes >= 0, sizes[nodes], 0)
        here = nodes >= 0
        inside = here & (
            (distance <= ratio * distance[:, :1]) | (np.cumsum(rows, axis=1) - rows < least)
        )
        ends = ~inside[:, -1] if wanted < n else np.ones(len(left), bool)
        for k in np.flatnonzero(ends):
            found[left[k]] = nodes[k][inside[k]]
        left, wanted = left[~ends], 2 * wanted
    return found
