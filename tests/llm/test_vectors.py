"""Neighbours and hard negatives against brute force over all rows."""

from __future__ import annotations

import math

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

from supplycast.llm import hard_negatives as hn
from supplycast.llm import nearest_neighbours as nn
from supplycast.llm import posting_lists
from supplycast.llm.frames import table
from supplycast.llm.oracles import ORACLES
from supplycast.llm.queries import QUERIES
from supplycast.llm.residue_products import Residues, n_primes, products
from supplycast.llm.vectors import ranked_dots

VECTORS = "vec_id long, embedding array<float>, label int, rank int, score string"
BROKEN = [
    (None, [1.0, 2.0], 1, 1, "x"),
    (20, None, 1, 1, "x"),
    (40, [1.0, None], 1, 1, "x"),
    (60, [float("nan"), 1.0], 1, 1, "x"),
    (80, [float("inf"), 1.0], 1, 1, "x"),
    (100, [0.0, 0.0], 1, 1, "x"),
    (120, [], 1, 1, "x"),
]


def neighbours(vectors: dict[int, list[float]], query: int, top: int):
    """``(score, id)`` of the best others, from plain sums in order."""
    pairs = []
    for other, vector in vectors.items():
        if other != query:
            total = 0.0
            for x, y in zip(vectors[query], vector, strict=False):
                total += float(np.float32(x)) * float(np.float32(y))
            pairs.append((-total, other))
    return [(-s, i) for s, i in sorted(pairs)[:top]]


def by_query(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(found[r.query_id])
    return found


def test_search_walks_to_every_list():
    rng = np.random.default_rng(2)
    far = rng.normal(size=(300, 12))
    tight = rng.normal(size=(1, 12)) * 3 + rng.normal(size=(40, 12)) * 1e-3
    graph = posting_lists.build_graph(np.vstack([far, tight]))
    points = np.vstack([rng.normal(size=(200, 12)), tight[:20] + 1e-4])
    nodes, distance = posting_lists.nearest_lists(graph, points, 5)
    true = np.linalg.norm(points[:, None] - graph.centroids[None], axis=2)
    right = np.sort(true, axis=1)[:, :5]
    assert np.mean(np.abs(distance - right) < 1e-9) > 0.97
    assert np.mean(distance[-20:, 0] < 0.1) == 1


def test_lists_are_balanced_and_probes_hold_enough_rows():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(4000, 16))
    graph = posting_lists.build_graph(posting_lists.balanced_centroids(rows, 40))
    own = posting_lists.chosen_lists(graph, rows, 2, 1.02)
    sizes = np.bincount(own[:, 0], minlength=40)
    assert sizes.max() < 3 * sizes.mean()
    assert (own[:, 1] >= 0).any() and (own[:, 0] >= 0).all()
    for lists in posting_lists.probed_lists(graph, rows[:50], 1.0, sizes, 500):
        assert sizes[lists].sum() >= 500 and len(set(lists)) == len(lists)


def test_few_rows_are_all_found_with_ties(spark):
    rng = np.random.default_rng(4)
    vectors = {i: rng.integers(-2, 3, 3).tolist() for i in range(0, 60, 5)}
    vectors = {i: v if any(v) else [1, 0, 0] for i, v in vectors.items()}
    vectors[200], vectors[220] = [1.0], [2.0, 1.0]
    rows = [(i, [float(x) for x in v], 1, 1, "x") for i, v in vectors.items()]
    df = spark.createDataFrame([*BROKEN, *rows], VECTORS)
    found = by_query(nn.nearest_neighbours(df, F.col("vec_id") % 20 == 0))
    padded = {i: [*v, 0, 0][:3] for i, v in vectors.items()}
    assert found == {q: neighbours(padded, q, 20) for q in vectors if q % 20 == 0}
    assert all(len(v) == len(vectors) - 1 for v in found.values())


def test_repeated_rows_are_candidates_each_time(spark):
    rows = [(1, [1.0, 0.0], 1, 1, "x")] * 3 + [(2, [0.5, 0.5], 1, 1, "x"), (20, [1.0, 0.1], 1, 1, "x")] * 2
    df = spark.createDataFrame(rows, VECTORS)
    found = by_query(nn.nearest_neighbours(df, F.col("vec_id") == 20, top=4))
    assert [i for _, i in found[20]] == [1, 1, 1, 2]


def test_empty_tables(spark):
    for rows in ([], BROKEN):
        df = spark.createDataFrame(rows, VECTORS)
        found = nn.nearest_neighbours(df, F.col("vec_id") % 20 == 0)
        assert found.columns == ["query_id", "rank", "vec_id", "score"] and found.collect() == []
    one = spark.createDataFrame([(20, [1.0], 1, 1, "x")], VECTORS)
    assert nn.nearest_neighbours(one, F.col("vec_id") % 20 == 0).collect() == []
    none = spark.createDataFrame([(3, [1.0], 1, 1, "x"), (4, [1.0], 1, 1, "x")], VECTORS)
    assert nn.nearest_neighbours(none, F.col("vec_id") % 20 == 0).collect() == []


def test_recall_with_a_hot_group_long_vectors_and_small_blocks(spark, monkeypatch):
    """A third of the rows nearly alike, lengths from 0.1 to 10, lists dealt into parts."""
    monkeypatch.setattr(nn, "BLOCK_ROWS", 64)
    monkeypatch.setattr(nn, "BLOCK_QUERIES", 16)
    rng = np.random.default_rng(6)
    rows = rng.normal(size=(3000, 16)) * rng.uniform(0.1, 10, size=(3000, 1))
    rows[:1000] = rng.normal(size=16) * 2 + rng.normal(size=(1000, 16)) * 1e-2
    rows = rows.astype(np.float32).astype(float)
    df = spark.createDataFrame(
        [(i, [float(x) for x in v], 1, 1, "x") for i, v in enumerate(rows)], VECTORS
    )
    found = by_query(nn.nearest_neighbours(df, F.col("vec_id") % 20 == 0))
    assert sorted(found) == list(range(0, 3000, 20))
    hits = 0
    for q, got in found.items():
        scores = rows @ rows[q]
        scores[q] = -np.inf
        want = set(np.lexsort((np.arange(3000), -scores))[:20].tolist())
        ids = [i for _, i in got]
        assert len(set(ids)) == 20 and q not in ids
        exact = ranked_dots(rows[ids], np.repeat(rows[q][None], 20, 0))
        assert [s for s, _ in got] == exact.tolist()
        assert got == sorted(got, key=lambda x: (-x[0], x[1]))
        hits += len(want & set(ids))
    assert hits / 20 / len(found) >= 0.9


def test_recall_of_the_query(spark):
    folder = "/root/testdata/sf0.01"
    found = by_query(QUERIES["op12_nearest_neighbours"](spark, folder))
    stored = table(spark, folder, "embeddings").select("vec_id", "embedding").collect()
    vectors = {r.vec_id: r.embedding for r in stored}
    queries = [i for i in vectors if i % 20 == 0]
    assert sorted(found) == sorted(queries)
    hits = sum(len({x for _, x in found[q]} & {x for _, x in neighbours(vectors, q, 20)}) for q in queries)
    assert hits / 20 / len(queries) >= 0.9


@pytest.mark.parametrize(
    ("high", "width"), [(1, 0), (5, 700), (40, 3), (256, 64), (2**20, 64), (2**27, 70), (2**30, 3)]
)
def test_residue_products_are_exact(high, width):
    rng = np.random.default_rng(width)
    left, right = (rng.integers(-high, high + 1, (n, width)) for n in (17, 23))
    bound = max(1, *(sum(int(x) ** 2 for x in r) for r in [*left, *right]))
    primes = n_primes(bound)
    got = products(Residues.of(left, primes), Residues.of(right, primes))
    assert got.tolist() == [[sum(int(x) * int(y) for x, y in zip(a, b)) for b in right] for a in left]


def test_residue_products_at_the_bound():
    for value in (2**30, -(2**30), 508, 254, 255, -254, -255):
        bound = 2**60 if abs(value) > 1000 else value * value
        one = np.array([[value]])
        side = Residues.of(one, n_primes(bound))
        assert products(side, side).tolist() == [[value * value]]
        assert products(side, Residues.of(-one, len(side.parts))).tolist() == [[-value * value]]
    with pytest.raises(ValueError):
        n_primes(2**63)


def brute_negatives(rows, anchor):
    """``rows`` are ``(id, vector, label)`` with distinct ids."""
    scale = {i: [math.floor(256 * float(np.float32(x))) for x in v] for i, v, _ in rows}
    label, found = {i: k for i, _, k in rows}, []
    for a in filter(anchor, scale):
        score = {
            i: sum(x * y for x, y in zip(scale[a], v, strict=False)) for i, v in scale.items() if i != a
        }
        ranked = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in ranked if label[i] == label[a]][:5]:
            near = [
                i
                for i in ranked
                if label[i] != label[a] and 80 * score[p] <= 100 * score[i] <= 100 * score[p]
            ]
            found += [(a, p, k, i, score[p], score[i]) for k, i in enumerate(near[:5], 1)]
    return sorted(found)


def test_hard_negatives_of_awkward_rows(spark, monkeypatch):
    """Ties, negative scores, short vectors, several blocks of rows and anchors, clashing columns."""
    monkeypatch.setattr(hn, "BLOCK_BYTES", 4 * 3 * 20)
    monkeypatch.setattr(hn, "ANCHOR_BYTES", 4 * 3 * 7)
    rng = np.random.default_rng(8)
    rows = [
        (int(i), [float(x) for x in rng.integers(-2, 3, rng.integers(0, 4)) / 4], int(rng.integers(3)))
        for i in rng.permutation(300)
    ]
    made = [(i, v, k, 1, "x") for i, v, k in rows]
    made += [(1000, [1.0, 0.5], None, 1, "x"), *[(i, v, 1, 1, "x") for i, v, *_ in BROKEN[:5]]]
    df = spark.createDataFrame(made, VECTORS).repartition(5)
    got = hn.hard_negatives(df, F.col("vec_id") % 10 == 0).collect()
    want = brute_negatives(rows, lambda i: i % 10 == 0)
    assert sorted(tuple(r) for r in got) == want and len(want) > 100


def test_hard_negatives_of_repeated_rows_and_large_numbers(spark):
    rows = [(0, [3e6, 1.0], 1), (1, [2e6, 0.0], 1), (2, [1.9e6, 7.0], 2), (3, [-1e6, 0.0], 2)]
    df = spark.createDataFrame([(*r, 1, "x") for r in [*rows, rows[0], rows[2]]], VECTORS)
    got = [tuple(r) for r in hn.hard_negatives(df, F.col("vec_id") == 0).collect()]
    once = brute_negatives(rows, lambda i: i == 0)
    assert sorted(got) == [once[0], (*once[0][:2], 2, *once[0][3:])]
    with pytest.raises(ValueError, match="62 bits"):
        hn.hard_negatives(spark.createDataFrame([(0, [1e30], 1, 1, "x")], VECTORS), F.lit(True))


def test_hard_negatives_of_empty_tables(spark):
    for rows in ([], BROKEN[:5]):
        df = spark.createDataFrame(rows, VECTORS)
        found = hn.hard_negatives(df, F.col("vec_id") % 10 == 0)
        assert found.collect() == [] and found.columns[0] == "anchor_id"
    only = spark.createDataFrame([(7, [1.0], 1, 1, "x")], VECTORS)
    assert hn.hard_negatives(only, F.col("vec_id") % 10 == 0).collect() == []


def test_hard_negatives_equal_their_sql(spark, small):
    found = QUERIES["op13_hard_negatives"](spark, small)
    assert compare.differences(found, compare.connect(small), ORACLES["op13_hard_negatives"]) == []


def test_hard_negatives_send_no_rows_through_the_driver(spark, monkeypatch):
    """No step broadcasts, however small its files are; blocks that are repeated grow beyond them."""
    plans, keep = [], hn.materialize
    plan = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(hn, "materialize", lambda df, name: plan(df) or keep(df, name))
    rows = [(i, [float(i % 7), 1.0], i % 3, 1, "x") for i in range(50)]
    plan(hn.hard_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 10 == 0))
    assert len(plans) == 6 and not any("Broadcast" in p for p in plans)


@pytest.mark.parametrize(("piece", "lane"), [(1, 1), (4, 3), (100, 100)])
def test_blocks_of_rows_meet_blocks_of_anchors_once(spark, monkeypatch, piece, lane):
    """Also of tasks with many and with few blocks; anchors come first, and cells are about even."""
    monkeypatch.setattr(hn, "TASKS", 1)
    monkeypatch.setattr(hn, "PIECE_BYTES", piece * hn.BLOCK_BYTES)
    monkeypatch.setattr(hn, "LANE_BYTES", lane * hn.ANCHOR_BYTES)
    row_blocks = [(t << 33) + k for t, n in ((0, 20), (3, 1), (5, 9)) for k in range(n)]
    anchor_blocks = [(t << 33) + k for t in range(4) for k in range(2)]
    row = "block long, vec_id binary, label binary, vectors binary"
    rows = spark.createDataFrame([(b, b"", b"", b"") for b in row_blocks], row)
    asked = [(b, b"", b"", b"", b"", b"") for b in anchor_blocks]
    anchors = spark.createDataFrame(asked, f"{row}, anchor binary, wanted binary")
    dealt = hn._meetings(rows, anchors).withColumn("task", F.spark_partition_id()).collect()
    cells = {}
    for r in dealt:
        own = cells.setdefault(r.cell, ([], [], {r.task}))
        own[2].add(r.task)
        own[r.anchor is None].append(r.block)
        assert r.anchor is None or not own[1]
    met = sorted((a, b) for asks, found, _ in cells.values() for a in asks for b in found)
    assert met == sorted((a, b) for a in anchor_blocks for b in row_blocks)
    assert all(len(tasks) == 1 for *_, tasks in cells.values())
    sizes = [len(found) for _, found, _ in cells.values()]
    assert max(sizes) <= min(sizes) + 3 and max(sizes) <= max(piece + 2, 4)


@pytest.mark.parametrize("few", [0, 10**6])
def test_rows_in_range_hold_the_first_of_each_question(monkeypatch, few):
    """Ties, questions without rows and more in range than are kept, by either way."""
    monkeypatch.setattr(hn, "FEW", few)
    rng = np.random.default_rng(few)
    scores, fits = rng.integers(-3, 4, (9, 40)), rng.random((9, 40)) < 0.7
    low = rng.integers(-4, 3, (9, 3))
    high = low + rng.integers(-1, 4, (9, 3))
    question, place = hn._inside(scores, fits, low, high, 5)
    assert len(set(zip(question, place, strict=True))) == len(question)
    for row in range(9):
        for q in range(3):
            own = place[question == 3 * row + q]
            inside = fits[row] & (scores[row] >= low[row, q]) & (scores[row] <= high[row, q])
            assert inside[own].all()
            first = sorted(np.flatnonzero(inside), key=lambda i: (-scores[row, i], i))[:5]  # noqa: B023
            assert set(first) <= set(own)
            assert len(own) == (len(first) if few == 0 else inside.sum())


def test_hard_negatives_of_equal_vectors_and_negative_scores(spark, monkeypatch):
    """All rows tie in several pieces and lanes; anchors with positives below zero have no negatives."""
    for name, size in (("BLOCK", 20), ("ANCHOR", 2), ("PIECE", 60), ("LANE", 4)):
        monkeypatch.setattr(hn, f"{name}_BYTES", 4 * 3 * size)
    rows = [(i, [0.5, -0.25, 0.0], i % 3) for i in range(400)]
    rows += [(1000 + i, [(-1.0) ** i, 0.0, 5.0 * (i - 1)], 7 + i % 2) for i in range(3)]
    df = spark.createDataFrame([(*r, 1, "x") for r in reversed(rows)], VECTORS).repartition(7)
    got = hn.hard_negatives(df, F.col("vec_id") % 50 == 0).collect()
    want = brute_negatives(rows, lambda i: i % 50 == 0)
    assert sorted(tuple(r) for r in got) == want and len(want) == 8 * 25
