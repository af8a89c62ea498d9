"""Hashed text features for the linear models: words, marks and word n-grams.

Letters and digits make words, other visible characters make marks; a mark repeated is one token.  A
word equal to the one before it also yields the token "again", and a word all in capitals the token
"capitals", so that such texts share features although their words differ.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplycast.llm import text as tx

_U = np.uint64
_AGAIN, _CAPITALS = _U(0x1B873593CC9E2D51), _U(0x27D4EB2F165667C5)


class Rows(NamedTuple):
    """Sparse rows: indices and values of row ``r`` lie between ``bounds[r]`` and ``bounds[r+1]``."""

    indices: np.ndarray
    values: np.ndarray
    bounds: np.ndarray


def _tokens(data: np.ndarray, at: np.ndarray):
    """Starts, ends and kind (mark or word) of the tokens of a slice."""
    blank, other = tx.BLANKS[data], tx.NOT_ALNUM[tx.FOLD[data]] & (data > 0x20)
    n = len(data)
    starts = np.ones(n, dtype=bool)
    # a token ends where the kind changes; inside a run of marks, where the mark changes
    same = (other[1:] == other[:-1]) & ~(blank[1:] | blank[:-1])
    same &= ~other[1:] | (data[1:] == data[:-1])
    starts[1:] = ~same
    starts[at[:-1][at[:-1] < n]] = True
    cut = np.flatnonzero(starts)
    ends = np.append(cut[1:], n)
    visible = ~blank[cut] & (data[cut] > 0x1F)
    return cut[visible], ends[visible], other[cut[visible]]


def hashed(column: pa.Array, orders: tuple[int, ...], bits: int, fold: bool) -> Rows:
    """Distinct features of each text with the logarithm of one plus their count.

    Index 0 is the constant; an empty or null text has only that.
    """
    mask = _U((1 << bits) - 1)
    indices, values, lengths = [], [], []
    upper = tx.byte_set(range(0x41, 0x5B))
    for _, data, at in tx.slices(column):
        starts, ends, mark = _tokens(data, at)
        # a run of marks counts as one token whatever its length
        stop = np.where(mark, np.minimum(starts + 1, ends), ends)
        token = tx.Hasher(data, tx.FOLD if fold else tx.SAME).ranges(starts, stop)
        bounds = np.searchsorted(starts, at)
        docs = tx.owners(bounds)
        parts, where = [], []
        for order in orders:
            hashes, owner, _ = tx.shingles(token, bounds, order)
            parts.append(hashes)
            where.append(owner)
        again = np.flatnonzero((token[1:] == token[:-1]) & (docs[1:] == docs[:-1]) & ~mark[1:]) + 1
        capitals = np.zeros(len(data) + 1, np.int64)
        np.cumsum(upper[data], out=capitals[1:])
        lower = (ends - starts) - (capitals[ends] - capitals[starts])
        loud = np.flatnonzero(~mark & (lower == 0) & (ends - starts > 1))
        for special, found in ((_AGAIN, again), (_CAPITALS, loud)):
            parts.append(np.full(len(found), special))
            where.append(docs[found])
        docs_n = len(at) - 1
        slot = np.maximum(np.concatenate(parts) & mask, _U(1))
        owner = np.concatenate(where).astype(np.uint64)
        both, counts = np.unique((owner << _U(32)) | slot, return_counts=True)
        row = (both >> _U(32)).astype(np.int64)
        # the constant in front of every row
        per = np.bincount(row, minlength=docs_n) + 1
        begin = np.concatenate([[0], np.cumsum(per)])
        index = np.zeros(begin[-1], np.int32)
        value = np.ones(begin[-1], np.float32)
        place = np.arange(len(both)) + row + 1
        index[place] = (both & _U(0xFFFFFFFF)).astype(np.int32)
        value[place] = np.log1p(counts)
        indices.append(index)
        values.append(value)
        lengths.append(per)
    none = np.zeros(0)
    return Rows(
        np.concatenate(indices or [none.astype(np.int32)]),
        np.concatenate(values or [none.astype(np.float32)]),
        np.concatenate([[0], np.cumsum(np.concatenate(lengths or [none]))]).astype(np.int64),
    )


def dot(rows: Rows, weights: np.ndarray) -> np.ndarray:
    """Sparse dot product of every row with one weight vector."""
    total = np.zeros(len(rows.indices) + 1)
    np.cumsum(weights[rows.indices] * rows.values, out=total[1:])
    return total[rows.bounds[1:]] - total[rows.bounds[:-1]]


def as_lists(rows: Rows) -> pa.Array:
    bounds = pa.array(rows.bounds.astype(np.int32))
    return pa.StructArray.from_arrays(
        [
            pa.ListArray.from_arrays(bounds, pa.array(rows.indices)),
            pa.ListArray.from_arrays(bounds, pa.array(rows.values)),
        ],
        names=["indices", "values"],
    )


_TYPE = T.StructType(
    [
        T.StructField("indices", T.ArrayType(T.IntegerType())),
        T.StructField("values", T.ArrayType(T.FloatType())),
    ]
)


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str,
    text: str,
    label: str,
    per_class: int,
    held_out: int,
    seed: int,
    orders: tuple[int, ...],
    bits: int,
    fold: bool,
) -> tuple[Rows, np.ndarray]:
    """Features and labels of at most ``per_class`` training rows of each of the labels 0 and 1.

    Rows whose crc32 of the id as text is divisible by ``held_out`` never train; neither do null ids,
    null labels or other values.  The rows taken are those with the smallest hash of their id, so reruns
    agree.  Only this bounded sample reaches the driver, as hashed features.
    """
    train = labels.where(F.crc32(F.col(doc_id).cast("string")) % held_out != 0)
    parts = [
        train.where(F.col(label) == value)
        .select(F.col(doc_id).alias("sample_id"), F.lit(value).alias("sample_label"))
        .distinct()
        .orderBy(F.xxhash64("sample_id", F.lit(seed)), "sample_id")
        .limit(per_class)
        for value in (0, 1)
    ]
    chosen = parts[0].unionAll(parts[1])

    def run(column: pa.Array) -> pa.Array:
        return as_lists(hashed(column, orders, bits, fold))

    rows = (
        docs.select(F.col(doc_id).alias("sample_id"), F.col(text).alias("sample_text"))
        .join(chosen, "sample_id")
        .select("sample_id", "sample_label", F.arrow_udf(run, _TYPE)("sample_text").alias("f"))
        .toArrow()
        .sort_by("sample_id")
        .combine_chunks()
    )
    if rows.num_rows == 0:
        return Rows(np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(1, np.int64)), np.zeros(
            0, np.int64
        )
    both = rows.column("f").combine_chunks()
    index, value = both.field("indices"), both.field("values")
    lengths = np.diff(np.asarray(index.offsets))
    found = Rows(
        np.asarray(index.flatten()),
        np.asarray(value.flatten()),
        np.concatenate([[0], np.cumsum(lengths)]),
    )
    return found, np.asarray(rows.column("sample_label"))
