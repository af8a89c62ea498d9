"""Approximate nearest neighbours by largest inner product over balanced posting lists.

A bounded sample gives the centroids of the lists; every row is put into the list of its nearest centroid
and, near a border, into the next one too.  A query searches the lists whose centroids are at most a
certain ratio farther than its nearest, and its inner products with their rows are computed in double
precision.  Both rows and queries find their lists by walking a graph over the centroids in memory.

The ratio is measured, not guessed: for some queries the true neighbours are found by comparing them
with all rows, and the ratio is the one that would have reached ``RECALL`` of them.  So the recall does
not depend on how many rows there are or how they lie; the work does.  Without any structure to use
(independent random directions) most lists are searched.

Inner products become distances by one more component, which gives all rows the length of the longest
and is zero for queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplycast.llm.posting_lists import (
    Graph,
    balanced_centroids,
    build_graph,
    chosen_lists,
    nearest_lists,
    probed_lists,
)
from supplycast.llm.vectors import is_finite, matrix, places, ranked_dots
from supplycast.sources.scratch import materialize

#: neighbours of a query
TOP = 20
#: rows of a list that the number of lists aims at, and most lists (beyond, lists grow)
LIST_ROWS = 128
MAX_LISTS = 4096
#: most sampled rows for the centroids
SAMPLE = 32_768
#: most lists of a row, and how much farther than the first the others may be
COPIES = 2
COPY_RATIO = 1.02
#: queries that are compared with all rows, and the share of their neighbours to be found
TRIALS = 96
RECALL = 0.95
#: rows and queries of one block; longer lists are cut into several
BLOCK_ROWS = 4096
BLOCK_QUERIES = 512

_FOUND = "array<struct<loss: double, vec_id: long, row: long>>"
_FOUND_TYPE = pa.list_(
    pa.struct([("loss", pa.float64()), ("vec_id", pa.int64()), ("row", pa.int64())])
)


def usable(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, vector)`` of the rows that take part: named, finite, not zero."""
    longest = F.array_max(F.transform(vector, lambda x: F.abs(x)))
    return df.where(F.col(vec_id).isNotNull() & is_finite(vector)).where(longest > 0).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.transform(vector, lambda x: x.cast("double")).alias("vector"),
    )


def _measures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, longest vector and most components of each batch."""
    for batch in batches:
        if batch.num_rows:
            column = batch.column("vector")
            width = max(column.value_lengths().to_pylist())
            vectors = matrix(column, width)
            largest = np.abs(vectors).max(1)
            norms = largest * np.sqrt(((vectors / largest[:, None]) ** 2).sum(1))
            yield pa.RecordBatch.from_pydict(
                {"n": [batch.num_rows], "longest": [norms.max()], "width": [width]}
            )


class Space:
    """Row and query vectors as points whose distance order is that of the inner product."""

    def __init__(self, width: int, longest: float) -> None:
        self.width, self.longest = width, longest

    def rows(self, vectors: np.ndarray) -> np.ndarray:
        scaled = vectors / self.longest
        return np.hstack([scaled, np.sqrt(np.maximum(1 - (scaled**2).sum(1), 0))[:, None]])

    def queries(self, vectors: np.ndarray) -> np.ndarray:
        scaled = vectors / self.longest
        length = np.sqrt((scaled**2).sum(1))
        unit = scaled / np.where(length > 0, length, 1)[:, None]
        return np.hstack([unit, np.zeros((len(unit), 1))])


def _best(left: np.ndarray, left_ids, right: np.ndarray, right_ids: np.ndarray, top: int):
    """For each left row its ``top`` right rows of another id: ``(places, scores)``, best first."""
    scores = left @ right.T
    slack = 1e-9 * np.maximum(np.abs(scores).max(1, initial=0), 1e-300)
    scores[left_ids[:, None] == right_ids[None]] = -np.inf
    if right_ids.size > top:
        limit = np.partition(scores, -top, axis=1)[:, -top]
    else:
        limit = np.full(len(left), -np.inf)
    near = (scores > -np.inf) & (scores >= (limit - slack)[:, None])
    one, other = np.nonzero(near)
    exact = ranked_dots(left[one], right[other])
    order = np.lexsort((right_ids[other], -exact, one))
    counts = near.sum(1)
    keep = order[places(counts) < top]
    ends = np.r_[0, np.cumsum(np.minimum(counts, top))]
    return [(other[keep[a:b]], exact[keep[a:b]]) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _found(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.Array:
    ends = np.r_[0, np.cumsum([len(p[0]) for p in parts])].astype(np.int32)
    fields = [np.concatenate([[], *x]) for x in zip(*parts, strict=True)] or [np.zeros(0)] * 3
    kinds = (np.float64, np.int64, np.int64)
    values = pa.StructArray.from_arrays(
        [pa.array(f.astype(k)) for f, k in zip(fields, kinds, strict=True)],
        names=["loss", "vec_id", "row"],
    )
    return pa.ListArray.from_arrays(pa.array(ends), values)


def _compare_all(trials: np.ndarray, ids: np.ndarray, space: Space, graph: Graph):
    """Best rows of a task for each trial; as ``row``, the ratio at which the trial meets it, in 1e-9."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_ids = np.zeros(0, np.int64)
        kept = np.zeros((0, space.width))
        best = []
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                row_ids = np.r_[kept_ids, part.column("vec_id").to_numpy()]
                rows = np.vstack([kept, matrix(part.column("vector"), space.width)])
                best = _best(trials, ids, rows, row_ids, TOP)
                used = np.unique(np.concatenate([b[0] for b in best]))
                best = [(np.searchsorted(used, at), score) for at, score in best]
                kept_ids, kept = row_ids[used], rows[used]
        if not best:
            return
        centres, queries = graph.centroids, space.queries(trials)
        distance = np.sqrt(
            np.maximum((queries**2).sum(1)[:, None] + graph.squares - 2 * queries @ centres.T, 0)
        )
        lists = chosen_lists(graph, space.rows(kept), COPIES, COPY_RATIO)
        nearest = np.maximum(distance.min(1), 1e-12)
        parts = []
        for k, (rows, scores) in enumerate(best):
            far = np.where(lists[rows] >= 0, distance[k][lists[rows]], np.inf).min(1, initial=np.inf)
            ratio = np.minimum(far / nearest[k], 1e9)
            parts.append((-scores, kept_ids[rows], np.ceil(ratio * 1e9)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(parts))), _found(parts)], names=["trial", "found"]
        )

    return run


def merged(found: DataFrame, keys: list[str], top: int) -> DataFrame:
    """The ``top`` best different rows of each key, best first, as array ``found``.

    No row is found more than ``COPIES`` times.
    """
    first = F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, top * COPIES)
    return found.groupBy(*keys).agg(F.slice(F.array_distinct(first), 1, top).alias("found"))


def _probe(graph: Graph, space: Space, ratio: float, sizes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = TaskContext.get().partitionId() << 33
        for batch in batches:
            vectors = matrix(batch.column("vector"), space.width)
            lists = probed_lists(graph, space.queries(vectors), ratio, sizes, TOP + 1)
            yield from _spread(lists, batch, vectors, count)
            count += batch.num_rows

    return run


def _assign(graph: Graph, space: Space):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = TaskContext.get().partitionId() << 33
        for batch in batches:
            vectors = matrix(batch.column("vector"), space.width)
            chosen = chosen_lists(graph, space.rows(vectors), COPIES, COPY_RATIO)
            yield from _spread([c[c >= 0] for c in chosen], batch, vectors, count)
            count += batch.num_rows

    return run


_SPREAD = "list int, nth int, row long, vec_id long, vector binary"
#: rows of one batch that leaves a task
_OUT_ROWS = 8192


def _spread(lists, batch, vectors, count) -> Iterator[pa.RecordBatch]:
    """A row for each vector and list; ``nth`` is 0 for the first list of a vector."""
    sizes = np.array([len(x) for x in lists], np.int64)
    own, nth = np.repeat(np.arange(len(lists)), sizes), places(sizes)
    chosen, ids = np.concatenate([[], *lists]).astype(np.int32), batch.column("vec_id").to_numpy()
    for at in range(0, len(own), _OUT_ROWS):
        here = own[at : at + _OUT_ROWS]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(chosen[at : at + _OUT_ROWS]),
                pa.array(nth[at : at + _OUT_ROWS].astype(np.int32)),
                pa.array(here + count),
                pa.array(ids[here]),
                pa.array([v.tobytes() for v in vectors[here]], pa.binary()),
            ],
            names=["list", "nth", "row", "vec_id", "vector"],
        )


def _packed(limit: int, prefix: str):
    """Consecutive rows of a list and part as one block of at most ``limit``."""
    names = ["list", f"{prefix}rows", f"{prefix}ids", f"{prefix}vectors"]

    def block(key, rows, ids, vectors):
        values = [key[0], np.concatenate(rows).tobytes(), np.concatenate(ids).tobytes(), b"".join(vectors)]
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, rows, ids, vectors = None, 0, [], [], []
        for batch in batches:
            list_, part = (batch.column(c).to_numpy() for c in ("list", "part"))
            row, vec_id = (batch.column(c).to_numpy() for c in ("row", "vec_id"))
            cuts = np.flatnonzero((np.diff(list_) != 0) | (np.diff(part) != 0)) + 1
            for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(list_)], strict=True):
                while a < b:
                    if held and (key != (list_[a], part[a]) or held == limit):
                        yield block(key, rows, ids, vectors)
                        held, rows, ids, vectors = 0, [], [], []
                    key, n = (list_[a], part[a]), min(b - a, limit - held)
                    rows.append(row[a : a + n])
                    ids.append(vec_id[a : a + n])
                    vectors += batch.column("vector").slice(a, n).to_pylist()
                    held, a = held + n, a + n
        if held:
            yield block(key, rows, ids, vectors)

    return run, ", ".join(f"{n} {'int' if n == 'list' else 'binary'}" for n in names)


def _blocks(spread: DataFrame, limit: int, prefix: str) -> DataFrame:
    """Blocks of the rows of each list; lists of more than ``limit`` rows are dealt into parts."""
    parts = spread.groupBy("list").agg(F.ceil(F.count("*") / limit).alias("parts"))
    dealt = spread.join(parts, "list").withColumn("part", F.pmod(F.xxhash64("row"), "parts"))
    run, schema = _packed(limit, prefix)
    placed = dealt.repartition("list", "part").sortWithinPartitions("list", "part", "row")
    return placed.select("list", "part", "row", "vec_id", "vector").mapInArrow(run, schema)


def _score(width: int, top: int):
    """Each query of a block with its best rows of the other block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                get = lambda c, kind: np.frombuffer(batch.column(c)[k].as_py(), kind)  # noqa: B023, E731
                query, query_ids = get("q_rows", np.int64), get("q_ids", np.int64)
                row, row_ids = get("rows", np.int64), get("ids", np.int64)
                best = _best(
                    get("q_vectors", np.float64).reshape(-1, width),
                    query_ids,
                    get("vectors", np.float64).reshape(-1, width),
                    row_ids,
                    top,
                )
                found = _found([(-scores, row_ids[at], row[at]) for at, scores in best])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query), pa.array(query_ids), found], names=["query", "query_id", "found"]
                )

    return run


def _index(rows: DataFrame, width: int, longest: float, n: int) -> tuple[Space, Graph]:
    space = Space(width, longest)
    drawn = rows.sample(min(1.0, SAMPLE / n), seed=11) if n > SAMPLE else rows
    sample = space.rows(matrix(drawn.select("vector").toArrow().column(0).combine_chunks(), width))
    lists = max(1, min(-(-n // LIST_ROWS), MAX_LISTS, len(sample)))
    return space, build_graph(balanced_centroids(sample, lists))


def _measured_ratio(rows: DataFrame, queries: DataFrame, space: Space, graph: Graph) -> float:
    drawn = queries.orderBy(F.xxhash64("vec_id"), "vector").limit(TRIALS).toArrow()
    if not drawn.num_rows:
        return 1.0
    trials = matrix(drawn.column("vector").combine_chunks(), space.width)
    ids = drawn.column("vec_id").to_numpy()
    found = rows.mapInArrow(
        _compare_all(trials, ids, space, graph), f"trial long, found {_FOUND}"
    )
    best = merged(found, ["trial"], TOP).select("found.row").collect()
    ratios = np.sort(np.concatenate([[], *(r[0] for r in best)]))
    if not len(ratios):
        return 1.0
    return float(ratios[min(int(np.ceil(RECALL * len(ratios))), len(ratios)) - 1] / 1e9)


def nearest_neighbours(
    df: DataFrame, query: Column, vec_id: str = "vec_id", vector: str = "embedding", top: int = TOP
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``top`` rows found nearest to each row that ``query`` selects.

    Nearest is the largest inner product in double precision, ties by smaller id; a row with the query's
    own id is no candidate.  Rows without id and null, empty and zero vectors and those with a null or
    non-finite component take no part.  Vectors shorter than the longest end with zeros.  A repeated row
    is a candidate each time and one query; an empty table gives no rows; other columns do not matter.
    Every row is in a list, and a query searches at least the nearest lists of ``top + 1`` rows.
    """
    spark = df.sparkSession
    rows = usable(df, vec_id, vector)
    asking = usable(df.where(query), vec_id, vector).dropDuplicates(["vec_id", "vector"])
    measures = rows.select("vector").mapInArrow(_measures, "n long, longest double, width long")
    n, longest, width = measures.agg(F.sum("n"), F.max("longest"), F.max("width")).first()
    result = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], result)
    space, graph = _index(rows, width, min(longest, 1.7e308), n)
    ratio = _measured_ratio(rows, asking, space, graph)
    spread = materialize(rows.mapInArrow(_assign(graph, space), _SPREAD), "posting-rows")
    sizes = np.zeros(len(graph.centroids), np.int64)
    for list_, count in spread.where("nth = 0").groupBy("list").count().collect():
        sizes[list_] = count
    probes = materialize(
        asking.mapInArrow(_probe(graph, space, ratio, sizes), _SPREAD), "probed-lists"
    )
    pairs = _blocks(spread, BLOCK_ROWS, "").join(_blocks(probes, BLOCK_QUERIES, "q_"), "list")
    found = pairs.mapInArrow(_score(width, top), f"query long, query_id long, found {_FOUND}")
    best = merged(found, ["query", "query_id"], top)
    return best.select("query_id", F.posexplode("found").alias("at", "f")).select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        "f.vec_id",
        (-F.col("f.loss")).alias("score"),
    )
