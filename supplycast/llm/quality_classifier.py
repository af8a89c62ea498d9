"""Quality classifier: hashed word n-grams, logistic regression trained by FTRL-proximal updates.

Training visits a bounded, deterministic sample of labelled rows; scoring is a sparse dot product per
text and runs over all rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplycast.llm import features as fx

#: training rows taken of each label at most
PER_CLASS = 3000
HELD_OUT = 5
ORDERS = (1, 2)
BITS = 20
ALPHA, BETA, L1, L2, PASSES = 1.0, 1.0, 0.1, 0.1, 4
SEED = 7


def train_ftrl(
    rows: fx.Rows,
    labels: np.ndarray,
    size: int,
    *,
    alpha: float = ALPHA,
    beta: float = BETA,
    l1: float = L1,
    l2: float = L2,
    passes: int = PASSES,
    seed: int = SEED,
) -> np.ndarray:
    """Weights after ``passes`` visits of every row in a random order.

    Per coordinate, ``z`` holds the regularised leader's linear term and ``n`` the sum of squared
    gradients; a weight is zero while ``|z|`` is below ``l1``.  Rows are scaled to unit length.
    """
    z, n = np.zeros(size), np.zeros(size)
    order = np.random.default_rng(seed)
    for _ in range(passes):
        for r in order.permutation(len(labels)):
            part = slice(rows.bounds[r], rows.bounds[r + 1])
            i, x = rows.indices[part], rows.values[part].astype(np.float64)
            x = x / np.sqrt((x * x).sum())
            zi, ni = z[i], n[i]
            w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2)
            w[np.abs(zi) <= l1] = 0.0
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -35.0, 35.0)))
            g = (p - labels[r]) * x
            n[i] = ni + g * g
            z[i] = zi + g - (np.sqrt(n[i]) - np.sqrt(ni)) / alpha * w
    weights = -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2)
    weights[np.abs(z) <= l1] = 0.0
    return weights


def scores(rows: fx.Rows, weights: np.ndarray) -> np.ndarray:
    squares = np.zeros(len(rows.values) + 1)
    np.cumsum(rows.values.astype(np.float64) ** 2, out=squares[1:])
    length = np.sqrt(squares[rows.bounds[1:]] - squares[rows.bounds[:-1]])
    return 1.0 / (1.0 + np.exp(-np.clip(fx.dot(rows, weights) / length, -35.0, 35.0)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    per_class: int = PER_CLASS,
    held_out: int = HELD_OUT,
    orders: tuple[int, ...] = ORDERS,
    bits: int = BITS,
) -> np.ndarray:
    """Weights learnt from the training part of the labels; all zero (score 0.5) without any."""
    rows, y = fx.labelled_sample(
        docs,
        labels,
        doc_id=doc_id,
        text=text,
        label=label,
        per_class=per_class,
        held_out=held_out,
        seed=SEED,
        orders=orders,
        bits=bits,
        fold=False,
    )
    return train_ftrl(rows, y, 1 << bits)


def score_of(
    weights: np.ndarray, text: str = "text", orders: tuple[int, ...] = ORDERS
) -> Column:
    """Score between 0 and 1 of every row; null and empty texts get that of the constant alone."""
    bits = int(len(weights)).bit_length() - 1
    kept = np.flatnonzero(weights).astype(np.int32)
    values = weights[kept]

    def run(column: pa.Array) -> pa.Array:
        full = _full(bits, kept, values)
        return pa.array(scores(fx.hashed(column, orders, bits, False), full), pa.float64())

    return F.arrow_udf(run, "double")(F.col(text))


_expanded: dict = {}


def _full(bits: int, kept: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Dense weights, kept for the batches of one worker."""
    key = (bits, len(kept), float(values.sum()), float(np.abs(values).sum()))
    if key not in _expanded:
        _expanded.clear()
        full = np.zeros(1 << bits)
        full[kept] = values
        _expanded[key] = full
    return _expanded[key]
