"""Clustering invariants and a brute-force linkage."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from supplycast.functions import linkage
from supplycast.operators import cluster, tables

XY = ["x", "y"]


def blobs(spark, centres, each=30, seed=0, spread=0.4):
    rng = np.random.default_rng(seed)
    rows = []
    for label, centre in enumerate(centres):
        for point in rng.normal(centre, spread, (each + 5 * label, 2)):
            rows.append((len(rows), label, *map(float, point)))
    return spark.createDataFrame(rows, "seller_id int, truth int, x double, y double")


CENTRES = [(0, 0), (8, 0), (0, 9)]


@pytest.fixture(scope="module")
def features(spark):
    return cluster.with_vector(blobs(spark, CENTRES), XY)


def test_zscore_of_a_constant_column_is_zero(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0), (5.0, 2.0)], "x double, y double")
    rows = cluster.zscore(df, XY).collect()
    assert sorted(r["z_x"] for r in rows) == pytest.approx([-1, 0, 1])
    assert {r["z_y"] for r in rows} == {0.0}


def test_kmeans_finds_blobs_with_stable_names(features):
    out = cluster.kmeans_labels(features, 3, order_by="z_x")
    sizes = {r["cluster"]: r["n"] for r in out.groupBy("cluster").agg(F.count("*").alias("n")).collect()}
    assert sizes == {"1": 30, "2": 35, "3": 40}
    rand = tables.adjusted_rand(out, "cluster", "truth").first()
    assert rand["n"] == 105 and rand["adjusted_rand"] == pytest.approx(1)


def test_more_starts_never_cost_more(features):
    cost = [
        cluster.fit_kmeans(features, 4, seeds).summary.trainingCost
        for seeds in (range(1), range(5))
    ]
    assert cost[1] <= cost[0] + 1e-9


def test_labels_are_nearest_centres(spark):
    df = blobs(spark, CENTRES)
    out = cluster.nearest_centre(df, XY, [list(map(float, c)) for c in CENTRES])
    assert out.where(F.col("cluster").cast("int") != F.col("truth") + 1).count() == 0


def test_choice_of_k(features):
    indices = cluster.choose_k(features, range(2, 6), XY, range(2))
    names = {r["index_name"] for r in indices.select("index_name").distinct().collect()}
    assert len(names) == 13
    votes = {r["k"]: r["votes"] for r in cluster.votes(indices).collect()}
    assert max(votes, key=votes.get) == 3 and sum(votes.values()) == 13


@pytest.mark.parametrize("micro", [500, 40])
def test_hierarchical_labels_find_blobs(features, micro):
    cuts = {"ward": ("ward", 3), "centroid": ("centroid", 3)}
    out = cluster.hierarchical_labels(features, cuts, XY, micro=micro)
    assert out.count() == 105
    for column in cuts:
        assert tables.adjusted_rand(out, column, "truth").first()["adjusted_rand"] == pytest.approx(1)


def brute_ward(points, k):
    groups = [[i] for i in range(len(points))]

    def sse(g):
        return ((points[g] - points[g].mean(axis=0)) ** 2).sum()

    while len(groups) > k:
        pairs = [(i, j) for i in range(len(groups)) for j in range(i)]
        i, j = min(pairs, key=lambda p: sse(groups[p[0]] + groups[p[1]]) - sse(groups[p[0]]) - sse(groups[p[1]]))
        groups[j] += groups.pop(i)
    return {frozenset(g) for g in groups}


def test_ward_matches_brute_force_and_heights_rise():
    points = np.random.default_rng(1).normal(size=(25, 3))
    steps = linkage.merge(points, np.ones(25), "ward")
    heights = [h for _, _, h in steps]
    assert all(b >= a - 1e-9 for a, b in zip(heights, heights[1:]))
    labels = linkage.cut(steps, 25, 4)
    found = {frozenset(i for i, v in enumerate(labels) if v == lab) for lab in set(labels)}
    assert found == brute_ward(points, 4)
    assert labels[0] == 1


def test_weights_stand_for_repeated_points():
    points = np.array([[0.0], [1.0], [5.0], [6.5], [20.0]])
    weights = np.array([3, 1, 2, 2, 1])
    many = np.repeat(points, weights, axis=0)
    few_labels = linkage.cut(linkage.merge(points, weights, "ward"), 5, 3)
    many_labels = linkage.cut(linkage.merge(many, np.ones(len(many)), "ward"), len(many), 3)
    assert np.repeat(few_labels, weights).tolist() == many_labels


def test_contingency_row_shares(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 2)], "r string, c int")
    rows = {(r["r"], r["c"]): r for r in tables.contingency(df, "r", "c").collect()}
    assert rows["a", 1]["n"] == 2 and rows["a", 1]["row_share"] == pytest.approx(2 / 3)
    assert rows["b", 2]["row_share"] == 1


def test_correlation_with_gaps_and_constants(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, None, 5.0), (4.0, 7.9, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    found = {(r["x"], r["y"]): r["r"] for r in tables.correlation(df, ["a", "b", "c"]).collect()}
    assert found["a", "b"] == pytest.approx(np.corrcoef([1, 2, 4], [2, 4.1, 7.9])[0, 1])
    assert found["a", "c"] is None and found["a", "a"] == pytest.approx(1)
