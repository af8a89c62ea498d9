"""Toxicity grades by cumulative-link ordinal regression over sparse word features.

With thresholds ``t1 <= t2 <= ...`` and one weight vector shared by all of them, a text has a grade of at
least ``k`` with probability ``sigmoid(w.x - tk)``.  The expected severity is the sum of these
probabilities.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplycast.llm import features as fx

#: training rows taken of each label at most
PER_CLASS = 3000
HELD_OUT = 5
ORDERS = (1,)
BITS = 18
L1, L2, STEPS, RATE = 7e-4, 1e-6, 200, 0.5
#: a text counts as toxic from this chance on
TOXIC_AT = 0.4
SEED = 5


class Model(NamedTuple):
    weights: np.ndarray
    thresholds: np.ndarray


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def binary_rows(rows: fx.Rows) -> fx.Rows:
    """Presence of a word instead of its count, so that a long text is not louder than a short one."""
    return rows._replace(values=np.ones(len(rows.values), np.float32))


def train_ordinal(
    rows: fx.Rows,
    grades: np.ndarray,
    size: int,
    n_grades: int,
    *,
    l1: float = L1,
    l2: float = L2,
    steps: int = STEPS,
    rate: float = RATE,
) -> Model:
    """Maximum likelihood of the grades 0 to ``n_grades - 1`` by proximal AdaGrad steps.

    The first threshold is free and the gaps to the next ones are exponentials, which keeps them
    ordered.  Words get an l1 penalty; the constant (index 0) has no weight, the thresholds replace it.
    Without rows all weights are zero and the first grade is likeliest.
    """
    w, free = np.zeros(size), np.zeros(n_grades - 1)
    free[0] = 1.0
    n = len(grades)
    if n == 0:
        return Model(w, _ordered(free))
    owner = np.repeat(np.arange(n), np.diff(rows.bounds))
    values = np.where(rows.indices == 0, 0.0, rows.values).astype(np.float64)
    used, local = np.unique(rows.indices, return_inverse=True)
    w_used, seen = np.zeros(len(used)), np.full(len(used), 1e-8)
    seen_free = np.full(len(free), 1e-8)
    for _ in range(steps):
        t = _ordered(free)
        s = np.bincount(owner, w_used[local] * values, minlength=n)
        # survival at the grade's lower and upper threshold
        reach = np.column_stack([np.ones(n), _sigmoid(s[:, None] - t), np.zeros(n)])
        row = np.arange(n)
        low, high = reach[row, grades], reach[row, grades + 1]
        chance = np.maximum(low - high, 1e-12)
        d_low, d_high = low * (1 - low) / chance / n, high * (1 - high) / chance / n
        d_s = -(d_low - d_high)
        d_t = np.zeros(n_grades + 1)
        np.add.at(d_t, grades, d_low)
        np.add.at(d_t, grades + 1, -d_high)
        d_t = d_t[1:-1]
        tail = np.cumsum(d_t[::-1])[::-1]
        d_free = tail.copy()
        d_free[1:] *= np.exp(free[1:])
        gradient = np.bincount(local, d_s[owner] * values, minlength=len(used)) + l2 * w_used
        seen += gradient * gradient
        pace = rate / np.sqrt(seen)
        w_used = w_used - pace * gradient
        w_used = np.sign(w_used) * np.maximum(np.abs(w_used) - pace * l1, 0.0)
        seen_free += d_free * d_free
        free = free - rate / np.sqrt(seen_free) * d_free
    w[used] = w_used
    w[0] = 0.0
    return Model(w, _ordered(free))


def _ordered(free: np.ndarray) -> np.ndarray:
    return np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))])


def grade_by_words(rows: fx.Rows, toxic: np.ndarray, size: int, n_grades: int) -> np.ndarray:
    """Grades for rows that are only labelled toxic or not.

    Clean rows have grade 0.  Toxic rows are ranked by the number of their distinct words that stand
    mostly in toxic rows, and cut into ``n_grades - 1`` steps of about equal size; equal numbers get equal
    grades.
    """
    grades = toxic.astype(np.int64)
    if not toxic.any() or toxic.all():
        return grades
    owner = np.repeat(np.arange(len(toxic)), np.diff(rows.bounds))
    marked = toxic[owner] == 1
    bad = np.bincount(rows.indices[marked], minlength=size)
    good = np.bincount(rows.indices[~marked], minlength=size)
    strong = (bad >= max(3, 0.01 * toxic.sum())) & (bad > 5 * good * toxic.sum() / (1 - toxic).sum())
    hits = np.bincount(owner, strong[rows.indices], minlength=len(toxic))[toxic == 1]
    cuts = np.quantile(hits, np.arange(1, n_grades - 1) / (n_grades - 1), method="lower")
    grades[toxic == 1] = 1 + (hits[:, None] > cuts).sum(axis=1)
    return grades


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    n_grades: int = 4,
    per_class: int = PER_CLASS,
    held_out: int = HELD_OUT,
    bits: int = BITS,
) -> Model:
    """Model learnt from a bounded sample of the training labels."""
    rows, toxic = fx.labelled_sample(
        docs,
        labels,
        doc_id=doc_id,
        text=text,
        label=label,
        per_class=per_class,
        held_out=held_out,
        seed=SEED,
        orders=ORDERS,
        bits=bits,
        fold=True,
    )
    rows = binary_rows(rows)
    grades = grade_by_words(rows, toxic, 1 << bits, n_grades)
    return train_ordinal(rows, grades, 1 << bits, n_grades)


def severities(rows: fx.Rows, model: Model) -> np.ndarray:
    """Probability of at least grade 1, 2, ... for every row."""
    return _sigmoid(fx.dot(binary_rows(rows), model.weights)[:, None] - model.thresholds)


_TYPE = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField("expected_severity", T.DoubleType()),
        T.StructField("grade", T.IntegerType()),
    ]
)


def severity_of(model: Model, text: str = "text") -> Column:
    """Struct of the chance of any toxicity, the expected severity and the median grade.

    Null and empty texts have no words and get what the thresholds alone say.
    """
    bits = int(len(model.weights)).bit_length() - 1
    kept = np.flatnonzero(model.weights).astype(np.int32)
    values, thresholds = model.weights[kept], model.thresholds

    def run(column: pa.Array) -> pa.Array:
        full = np.zeros(1 << bits)
        full[kept] = values
        reach = severities(fx.hashed(column, ORDERS, bits, True), Model(full, thresholds))
        return pa.StructArray.from_arrays(
            [
                pa.array(reach[:, 0], pa.float64()),
                pa.array(reach.sum(axis=1), pa.float64()),
                pa.array((reach >= 0.5).sum(axis=1), pa.int32()),
            ],
            names=["score", "expected_severity", "grade"],
        )

    return F.arrow_udf(run, _TYPE)(F.col(text))
