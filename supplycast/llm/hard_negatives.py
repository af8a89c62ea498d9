"""Hard negatives: rows of another label that score almost as high as an anchor's positives.

Rows and anchors are packed into blocks of integers, every block of anchors meets every block of rows
once for the positives and once for the negatives, and exact scores come from ``residue_products``.
Each task keeps only the few best rows of each anchor and limit, so what leaves it does not depend on how
many rows score well; windows over these pick the result.  Nothing that grows with the table passes the
driver: blocks meet in a shuffle, and no join is left to broadcasts.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplycast.llm.residue_products import Residues, n_primes, products
from supplycast.llm.vectors import is_finite, matrix, places
from supplycast.sources.scratch import materialize

#: a component is rounded down to this many parts of one
SCALE = 256
#: positives of an anchor and negatives of an anchor and positive
POSITIVES = 5
NEGATIVES = 5
#: bytes of a residue of a block of rows and of a block of anchors, and anchors scored at a time
BLOCK_BYTES = 1 << 21
ANCHOR_BYTES = 1 << 18
TILE = 64
#: the same bytes of the blocks of rows and the blocks of anchors that meet in one task, and tasks a core
PIECE_BYTES = 1 << 26
LANE_BYTES = 1 << 25
TASKS = 4
#: rows in range of an anchor beyond which each limit picks its own from the matrix of scores
FEW = 32
#: less than any score
NONE = -np.iinfo(np.int64).max


def usable(
    df: DataFrame, label: Column, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``(vec_id, label, vector)`` of the rows that take part, components as whole doubles."""
    return df.where(F.col(vec_id).isNotNull() & label.isNotNull() & is_finite(vector)).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.transform(vector, _floor).alias("vector"),
    )


def _floor(x: Column) -> Column:
    """``floor(SCALE * x)`` as double, also beyond 64 bits."""
    scaled = F.lit(float(SCALE)) * x.cast("double")
    return F.when(F.abs(scaled) < 2.0**52, F.floor(scaled).cast("double")).otherwise(scaled)


def _blocks(rows: DataFrame, width: int, limit: int, kind: type, longs: tuple[str, ...]) -> DataFrame:
    """Rows of a task as blocks by id: ``longs`` and the vectors, as integers of ``kind``, in arrays of bytes."""
    size = max(1, limit // (4 * width))
    names = ["block", *longs, "vectors"]

    def whole(column: pa.Array) -> np.ndarray:
        return (column.flatten() if pa.types.is_list(column.type) else column).to_numpy().astype(np.int64)

    def block(number: int, batch: pa.RecordBatch) -> pa.RecordBatch:
        batch = batch.take(pa.array(np.argsort(batch.column("vec_id").to_numpy(), kind="stable")))
        values = [whole(batch.column(c)).tobytes() for c in longs]
        values.append(matrix(batch.column("vector"), width).astype(kind).tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), *[pa.array([v], pa.binary()) for v in values]], names=names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, n = TaskContext.get().partitionId() << 33, [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, size - n)
                batch = batch.slice(part.num_rows)
                held.append(part)
                n += part.num_rows
                if n == size:
                    yield block(number, pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                    number, held, n = number + 1, [], 0
        if n:
            yield block(number, pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    kinds = ["long", *["binary"] * (len(longs) + 1)]
    return rows.mapInArrow(run, ", ".join(f"{c} {k}" for c, k in zip(names, kinds, strict=True)))


def _dealt(blocks: DataFrame, most: int, least: int) -> tuple[Column, int]:
    """Group of each block and number of groups: ``least`` or so many that a group has some ``most`` blocks.

    The blocks of a task go round the groups and those of the next task start one group later.
    """
    n, last = blocks.agg(F.count("*"), F.max("block")).first()
    groups = max(1, min(n, max(-(-n // max(1, most)), least)))
    step = next(s for s in itertools.count(((last or 0) >> 33) + 1) if math.gcd(s, groups) == 1)
    place = F.shiftright("block", 33) + F.col("block").bitwiseAND(2**33 - 1) * F.lit(step)
    return F.pmod(place, F.lit(groups)).cast("int"), groups


def _meetings(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """Every block of rows in one ``cell`` with every block of anchors, once; anchors come first.

    Blocks of rows are dealt to pieces and blocks of anchors to lanes; a cell is one piece and one lane,
    in one task.  This is no join, because Spark would judge a side by its size before it is repeated for
    every piece, and send the repeated blocks through the driver.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    lane, lanes = _dealt(anchors, LANE_BYTES // ANCHOR_BYTES, 1)
    piece, pieces = _dealt(rows, PIECE_BYTES // BLOCK_BYTES, -(-TASKS * cores // lanes))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = rows.withColumn("piece", piece).withColumn("lane", every(lanes))
    asked = anchors.withColumn("lane", lane).withColumn("piece", every(pieces))
    cells = dealt.unionByName(asked, allowMissingColumns=True)
    cells = cells.withColumn("cell", F.col("lane") * F.lit(pieces) + F.col("piece")).drop("piece", "lane")
    cells = cells.repartitionById(lanes * pieces, F.col("cell"))
    return cells.sortWithinPartitions("cell", F.col("anchor").isNull())


def _first(scores: np.ndarray, part: np.ndarray, n: int) -> np.ndarray:
    """``part`` with the ``n`` highest scores of each row of the matrix only, ties by place."""
    if scores.shape[1] <= n:
        return part
    limit = np.partition(np.where(part, scores, NONE), -n, axis=1)[:, -n, None]
    above, tie = part & (scores > limit), part & (scores == limit)
    return above | (tie & (np.cumsum(tie, axis=1) <= n - above.sum(1, keepdims=True)))


def _inside(scores: np.ndarray, fits: np.ndarray, low: np.ndarray, high: np.ndarray, n: int):
    """``(question, place)`` of the fitting scores from ``low`` to ``high``, all that may be among the first ``n``.

    ``low`` and ``high`` have a row for each row of ``scores`` and a column for each of its questions.
    """
    near = fits & (scores >= low.min(1)[:, None]) & (scores <= high.max(1)[:, None])
    if np.count_nonzero(near) <= FEW * len(scores):
        row, place = np.nonzero(near)
        found = scores[row, place][:, None]
        at, q = np.nonzero((found >= low[row]) & (found <= high[row]))
        return row[at] * low.shape[1] + q, place[at]
    parts = []
    for q in range(low.shape[1]):
        part = near & (scores >= low[:, q, None]) & (scores <= high[:, q, None])
        row, place = np.nonzero(_first(scores, part, n))
        parts.append((row * low.shape[1] + q, place))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


class _Cell:
    """Anchors of a cell, with the rows that are kept for each of their questions."""

    def __init__(self, primes: int, fits: Callable, limits: Callable, n: int):
        self.primes, self.fits, self.limits, self.n = primes, fits, limits, n
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.scores = None

    def ask(self, anchor, vec_id, label, wanted, vectors) -> None:
        self.parts.append((anchor, vec_id, label, wanted.reshape(len(anchor), -1), vectors))

    def begin(self) -> None:
        self.anchor, self.vec_id, self.label, self.wanted, self.vectors = (
            np.concatenate(x) for x in zip(*self.parts, strict=True)
        )
        self.parts.clear()
        self.low, self.high = self.limits(self.wanted)
        self.scores = np.full((*self.wanted.shape, self.n), NONE)
        self.ids = np.zeros(self.scores.shape, np.int64)

    def meet(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        if self.parts:
            self.begin()
        if self.scores is None:
            return
        right = Residues.of(vectors.astype(np.int64), self.primes)
        for at in range(0, len(self.anchor), TILE):
            tile = slice(at, at + TILE)
            left = Residues.of(self.vectors[tile].astype(np.int64), self.primes)
            scores = products(left, right)
            fits = self.fits(self.vec_id[tile, None], self.label[tile, None], ids, labels)
            low = np.maximum(self.low[tile], self.scores[tile, :, -1])
            question, place = _inside(scores, fits, low, self.high[tile], self.n)
            if len(question):
                self.keep(tile, question, scores[question // low.shape[1], place], ids[place])

    def keep(self, tile: slice, question: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Rows of the tile's questions beside those kept so far, by score and id."""
        shape = self.scores[tile].shape
        n = shape[0] * shape[1]
        question = np.concatenate([np.repeat(np.arange(n), self.n), question])
        scores = np.concatenate([self.scores[tile].ravel(), scores])
        ids = np.concatenate([self.ids[tile].ravel(), ids])
        order = np.lexsort((ids, -scores, question))
        first = order[places(np.bincount(question, minlength=n)) < self.n]
        self.scores[tile], self.ids[tile] = scores[first].reshape(shape), ids[first].reshape(shape)

    def found(self, names: list[str]) -> Iterator[pa.RecordBatch]:
        for at in range(0, 0 if self.scores is None else len(self.scores), 64 * TILE):
            row, q, k = np.nonzero(self.scores[at : at + 64 * TILE] > NONE)
            row += at
            columns = {
                "anchor": self.anchor[row],
                "limit": self.wanted[row, q],
                "vec_id": self.ids[row, q, k],
                "score": self.scores[row, q, k],
            }
            yield pa.RecordBatch.from_arrays([pa.array(columns[c]) for c in names], names=names)


def _scored(new: Callable[[], _Cell], width: int, kind: type, names: list[str]):
    """The rows that cells keep; ``new`` gives an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, cell = None, new()
        for batch in batches:
            for k in range(batch.num_rows):
                get = lambda c, t=np.int64: np.frombuffer(batch.column(c)[k].as_py(), t)  # noqa: B023, E731
                if last != (number := batch.column("cell")[k].as_py()):
                    yield from cell.found(names)
                    last, cell = number, new()
                vectors = get("vectors", kind).reshape(-1, width)
                if batch.column("anchor")[k].is_valid:
                    cell.ask(*[get(c) for c in ("anchor", "vec_id", "label", "wanted")], vectors)
                else:
                    cell.meet(get("vec_id"), get("label"), vectors)
        yield from cell.found(names)

    return run


def _positives(primes: int) -> _Cell:
    """Rows of the same label and another id."""

    def fits(vec_id, label, ids, labels):
        return (labels == label) & (ids != vec_id)

    def limits(wanted):
        return np.full_like(wanted, NONE + 1), np.full_like(wanted, -NONE)

    return _Cell(primes, fits, limits, POSITIVES)


def _negatives(primes: int) -> _Cell:
    """Rows of other labels from four fifths of a positive's score up to it."""

    def fits(vec_id, label, ids, labels):
        return labels != label

    def limits(wanted):
        some = wanted >= 0
        return np.where(some, wanted - wanted // 5, -NONE), np.where(some, wanted, NONE)

    return _Cell(primes, fits, limits, NEGATIVES)


def _ranked(found: DataFrame, keys: list[str], n: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def hard_negatives(
    df: DataFrame,
    anchor: Column,
    label: str | Column = "label",
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Scores are inner products of the components ``floor(256 * x)``, exact as long; higher come first, ties
    by smaller id.  An anchor's positives are its first 5 rows of the same label and another id.  For each, the
    first 5 rows of other labels with a score from 80 to 100 percent of the positive's are returned; a
    positive with a negative score has none.  Rows without id or label and null vectors or those with
    a null or non-finite component take no part; vectors shorter than the longest end with zeros.  A
    repeated row is a candidate each time and one anchor.  An empty table gives no rows, other columns do
    not matter.  Raises ``ValueError`` where inner products could exceed 62 bits.
    """
    label = F.col(label) if isinstance(label, str) else label
    rows = usable(df, label, vec_id, vector)
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    longest, width = rows.agg(F.max(square), F.max(F.size("vector"))).first()
    if longest is None:
        return df.sparkSession.createDataFrame(
            [],
            "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
            "negative_score long",
        )
    if longest >= 2.0**62:
        raise ValueError(f"inner products up to {longest:.3g} do not fit 62 bits")
    primes, width = n_primes(int(longest * (1 + 1e-9)) + 1), max(width, 1)
    kind = np.int16 if longest < 2.0**29 else np.int32
    blocks = materialize(_blocks(rows, width, BLOCK_BYTES, kind, ("vec_id", "label")), "vector-blocks")
    asking = usable(df.where(anchor), label, vec_id, vector).distinct()
    asking = materialize(asking.withColumn("anchor", F.monotonically_increasing_id()), "anchors")

    def met(anchors: DataFrame, cell: Callable, names: list[str], name: str) -> DataFrame:
        few = anchors.repartition(max(1, -(-anchors.count() * 4 * width // ANCHOR_BYTES)))
        side = _blocks(few, width, ANCHOR_BYTES, kind, ("anchor", "vec_id", "label", "wanted"))
        cells = _meetings(blocks, materialize(side, f"{name}-anchors"))
        schema = ", ".join(f"{c} long" for c in names)
        return cells.mapInArrow(_scored(lambda: cell(primes), width, kind, names), schema)

    none = asking.withColumn("wanted", F.array(F.lit(-1).cast("long")))
    best = _ranked(
        met(none, _positives, ["anchor", "vec_id", "score"], "positive"), ["anchor"], POSITIVES
    )
    ids = asking.select("anchor", F.col("vec_id").alias("anchor_id"))
    positives = materialize(
        best.join(ids.hint("merge"), "anchor").select(
            "anchor", "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("limit")
        ),
        "positives",
    )
    padding = F.array_repeat(F.lit(-1).cast("long"), POSITIVES)
    limits = (
        positives.where("limit >= 0")
        .groupBy("anchor")
        .agg(F.slice(F.concat(F.collect_set("limit"), padding), 1, POSITIVES).alias("wanted"))
    )
    found = met(
        asking.join(limits.hint("merge"), "anchor"),
        _negatives,
        ["anchor", "limit", "vec_id", "score"],
        "negative",
    )
    return (
        _ranked(found, ["anchor", "limit"], NEGATIVES)
        .join(positives.hint("merge"), ["anchor", "limit"])
        .select(
            "anchor_id",
            "positive_id",
            F.col("rank").cast("int").alias("rank"),
            F.col("vec_id").alias("negative_id"),
            F.col("limit").alias("positive_score"),
            F.col("score").alias("negative_score"),
        )
    )
