"""Quality rules with risk-controlled cutoffs.

Each rule compares one ratio of a text with a cutoff and rejects above it.  Cutoffs are not chosen by
hand: rows labelled good are held out, and per stratum a set of cutoffs, one for each rule, counts as safe
when the exact binomial (Clopper-Pearson) upper bound of the rate at which all rules together reject
good texts stays within the risk.

The sets are tested in a fixed sequence from loose to strict that ends at the first unsafe one, so the
level is divided by the number of strata only, not by rules or cutoffs.  The sequence is laid out on other
rows: a fifth of the good ones (``PILOT``), chosen by a hash of their ids, and the rows labelled bad.

A stratum with too few good rows even for none rejected is calibrated on the pool of all such strata, and
if these are too few together, on the pool of all strata.  The bound then holds for the texts of the pool as
a whole, not for each language in it.  Without good labels a stratum rejects nothing by these rules.
"""

from __future__ import annotations

import functools
import math
import operator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplycast.llm import text as tx
from supplycast.llm.frames import fresh

WORD_WINDOW = 3
SYMBOLS = b"#*$%&|<>"

_COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_upper",
    "n_marks",
)


class Rule(NamedTuple):
    """Rejects texts whose ``top / bottom`` exceeds a cutoff, one of ``grid``."""

    name: str
    top: str
    bottom: str
    grid: tuple[float, ...]


#: fixed candidates, tried from the largest down
RULES = (
    Rule("symbols", "n_symbols", "n_words", (0.05, 0.1, 0.2, 0.4, 0.8, 1.5)),
    Rule("marks", "n_marks", "n_words", (0.2, 0.4, 0.8, 1.5)),
    Rule("upper", "n_upper", "word_chars", (0.15, 0.3, 0.5, 0.7)),
    Rule("dup_lines", "n_dup_lines", "n_lines", (0.2, 0.35, 0.5, 0.7)),
    Rule("repeats", "n_repeat_words", "n_words", (0.1, 0.2, 0.3, 0.4)),
    Rule("long_words", "word_chars", "n_words", (10.0, 12.0, 15.0, 20.0, 40.0)),
)
RISK = 0.02
CONFIDENCE = 0.95
#: one of so many good rows lays out the sequence and is not counted in the bound
PILOT = 5


def count_texts(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts that the rules use, one value per text."""
    n = len(column)
    out = {c: np.zeros(n, np.int64) for c in _COUNTS}
    symbol, upper = tx.byte_set(SYMBOLS), tx.byte_set(range(0x41, 0x5B))
    mark = tx.byte_set(b"!?")
    follows = tx.byte_set(range(0x80, 0xC0))
    for first, data, at in tx.slices(column):
        here = slice(first, first + len(at) - 1)
        hasher, words = tx.Hasher(data), tx.find_words(data, at)
        out["n_words"][here] = np.diff(words.bounds)
        out["word_chars"][here] = tx.per_document(~tx.BLANKS[data] & ~follows[data], at)
        out["n_symbols"][here] = tx.per_document(symbol[data], at)
        out["n_upper"][here] = tx.per_document(upper[data], at)
        out["n_marks"][here] = tx.per_document(mark[data], at)
        _lines(out, here, data, at, hasher, words)
        _repeats(out, here, hasher, words)
    return out


def _lines(out, here, data, at, hasher, words) -> None:
    """Lines with a word, and those equal to an earlier one of the same text."""
    border = np.zeros(len(data) + 1, dtype=bool)
    border[at] = True
    border[np.flatnonzero(data == 0x0A) + 1] = True
    starts = np.flatnonzero(border[:-1])
    ends = np.append(starts[1:], len(data))
    if not len(starts):
        return
    ends = np.where(data[ends - 1] == 0x0A, ends - 1, ends)
    full = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[full], ends[full]
    bounds = np.searchsorted(starts, at)
    keys = tx.keyed(hasher.ranges(starts, ends), tx.owners(bounds))
    _, seen = np.unique(keys, return_index=True)
    again = np.ones(len(keys), dtype=bool)
    again[seen] = False
    out["n_lines"][here] = np.diff(bounds)
    out["n_dup_lines"][here] = tx.per_document(again, bounds)


def _repeats(out, here, hasher, words) -> None:
    """Words inside a window that stands twice or more in the same text."""
    hashes = hasher.ranges(words.starts, words.ends)
    windows, docs, at = tx.shingles(hashes, words.bounds, WORD_WINDOW)
    _, group, counts = np.unique(tx.keyed(windows, docs), return_inverse=True, return_counts=True)
    covered = np.zeros(len(hashes), dtype=bool)
    for k in range(WORD_WINDOW):
        covered[at[counts[group] > 1] + k] = True
    out["n_repeat_words"][here] = tx.per_document(covered, words.bounds)


_TYPE = T.StructType([T.StructField(c, T.LongType()) for c in _COUNTS])


def counts_of(text: str) -> Column:
    def run(column: pa.Array) -> pa.Array:
        found = count_texts(column)
        return pa.StructArray.from_arrays([pa.array(found[c]) for c in _COUNTS], names=_COUNTS)

    return F.arrow_udf(run, _TYPE)(F.col(text))


def _metric(rule: Rule, counts: str) -> Column:
    top, bottom = (F.col(f"`{counts}`.{c}") for c in (rule.top, rule.bottom))
    return F.when(bottom > 0, top.cast("double") / bottom).otherwise(0.0)


def binomial_cdf(k: int, n: int, p: float) -> float:
    """Exact P(X <= k), summed outward from the largest term in logs."""
    if k >= n:
        return 1.0
    i = np.arange(k + 1, dtype=np.float64)
    lg = np.vectorize(math.lgamma, otypes=[float])
    logs = (
        math.lgamma(n + 1) - lg(i + 1) - lg(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
    )
    top = logs.max()
    return float(min(1.0, math.exp(top) * np.exp(logs - top).sum()))


def is_safe(rejected: int, n: int, risk: float, level: float) -> bool:
    """Whether the exact upper bound of the rejection rate at ``level`` stays within ``risk``."""
    if n == 0 or rejected >= n * risk:
        return False
    return binomial_cdf(rejected, n, risk) <= level


def _level(rule: Rule, counts: str) -> Column:
    """How many cutoffs of the rule's grid a text exceeds."""
    over = [(_metric(rule, counts) > cut).cast("int") for cut in rule.grid]
    return functools.reduce(operator.add, over)


def _rejected(cells: np.ndarray, depth: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Cells that any rule rejects when the ``depth`` loosest cutoffs of each rule are in use."""
    return (cells + depth > sizes).any(axis=1)


def sequence(
    cells: np.ndarray, n_pilot: np.ndarray, n_bad: np.ndarray, sizes: np.ndarray
) -> list[np.ndarray]:
    """Sets of cutoffs from loose to strict, each tightening one rule of the set before by one cutoff.

    ``cells`` holds distinct rows of levels, ``n_pilot`` and ``n_bad`` the rows of each.  Next comes what rejects
    the fewest pilot rows for the sake of further bad ones, of these what rejects most of the bad ones;
    cutoffs that reject no further bad row come last.
    """
    depth, out = np.zeros(len(sizes), np.int64), []
    while (depth < sizes).any():
        gone = _rejected(cells, depth, sizes)
        moves = []
        for rule in np.flatnonzero(depth < sizes):
            for to in range(depth[rule] + 1, sizes[rule] + 1):
                then = depth.copy()
                then[rule] = to
                new = _rejected(cells, then, sizes) & ~gone
                caught = int(n_bad[new].sum())
                moves.append((not caught, int(n_pilot[new].sum()), -caught, to, int(rule)))
        *_, to, rule = min(moves)
        while depth[rule] < to:
            depth[rule] += 1
            out.append(depth.copy())
    return out


def safe_cuts(
    cells: list[dict], rules: tuple[Rule, ...], risk: float, level: float
) -> list[float | None]:
    """The cutoffs of the last set before the first unsafe one, null for rules not in use."""
    grids = [sorted(r.grid) for r in rules]
    sizes = np.array([len(g) for g in grids])
    levels = np.array([c["levels"] for c in cells], np.int64).reshape(-1, len(rules))
    n_pilot, n_test, n_bad = (
        np.array([c[k] for c in cells], np.int64) for k in ("n_pilot", "n_test", "n_bad")
    )
    best = np.zeros(len(rules), np.int64)
    for depth in sequence(levels, n_pilot, n_bad, sizes):
        rejected = int(n_test[_rejected(levels, depth, sizes)].sum())
        if not is_safe(rejected, int(n_test.sum()), risk, level):
            break
        best = depth
    return [g[len(g) - k] if k else None for g, k in zip(grids, best, strict=True)]


def calibrate(
    counted: DataFrame,
    labels: DataFrame,
    stratum: str,
    *,
    counts: str = "counts",
    doc_id: str = "doc_id",
    label: str = "quality",
    rules: tuple[Rule, ...] = RULES,
    risk: float = RISK,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """Safe cutoffs of all rules, one row ``(stratum, n_good, pooled, cuts)`` per stratum with good labels.

    ``counted`` has the text counts as struct column ``counts``.  Rows labelled 1 are the good ones, rows
    with other labels only the bad ones; labels of unknown documents and null ids or labels are left
    out, repeated labels count once, repeated documents as often as they stand there.  ``cuts`` holds null
    where nothing is safe.  At most the share ``risk`` of a stratum's good texts (of the pool's where
    ``pooled``) is wrongly rejected by all rules together, with the given confidence over all strata.

    Rows are counted by the cutoffs they exceed before anything is gathered, so a stratum has at most as
    many rows as there are combinations of cutoffs.
    """
    known = (
        labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(doc_id).alias("label_id"))
        .agg(F.max((F.col(label) == 1).cast("int")).alias("good"))
    )
    pilot = F.pmod(F.xxhash64(F.lit("pilot"), "label_id"), F.lit(PILOT)) == 0
    rows = counted.select(
        F.col(doc_id).alias("id"),
        F.col(stratum).alias("stratum"),
        fixed_failed(counts).alias("failed"),
        F.array(*[_level(r, counts) for r in rules]).alias("levels"),
    ).join(known, F.col("id") == F.col("label_id"))
    good = F.col("good") == 1
    cells = rows.groupBy("stratum", "levels").agg(
        F.sum((good & pilot).cast("long")).alias("n_pilot"),
        F.sum((good & ~pilot).cast("long")).alias("n_test"),
        F.sum((~good & ~F.col("failed")).cast("long")).alias("n_bad"),
    )
    every = Window.partitionBy(F.lit(1))  # over a row per stratum
    level = F.lit(1 - confidence) / F.count(F.lit(1)).over(every)
    sizes = (
        cells.groupBy("stratum")
        .agg(F.sum("n_test").alias("tests"), F.sum(F.col("n_pilot") + F.col("n_test")).alias("n_good"))
        .where("n_good > 0")
        .withColumn("level", level)
        .withColumn("pooled", F.pow(F.lit(1 - risk), "tests") > F.col("level"))
        .withColumn("pool", F.sum(F.when(F.col("pooled"), F.col("tests"))).over(every))
        .withColumn("wide", F.pow(F.lit(1 - risk), "pool") > F.col("level"))
    )
    key = F.struct("pooled", F.when(~F.col("pooled"), F.col("stratum")).alias("own"))
    pool = F.struct(F.lit(True).alias("pooled"), F.when(F.lit(False), F.col("stratum")).alias("own"))
    into = F.when(~F.col("pooled") & F.coalesce("wide", F.lit(False)), F.array(key, pool))
    size = sizes.withColumn("into", into.otherwise(F.array(key))).withColumnRenamed("stratum", "of")
    groups = (
        cells.join(size, F.col("stratum").eqNullSafe(F.col("of")))
        .withColumn("key", F.explode("into"))
        .groupBy("key", "level", "levels")
        .agg(*[F.sum(c).alias(c) for c in ("n_pilot", "n_test", "n_bad")])
        .groupBy("key", "level")
        .agg(F.collect_list(F.struct("levels", "n_pilot", "n_test", "n_bad")).alias("cells"))
    )

    def choose(batches):
        for batch in batches:
            cuts = [
                safe_cuts(found, rules, risk, at)
                for found, at in zip(
                    *(batch.column(c).to_pylist() for c in ("cells", "level")), strict=True
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("cut_pooled"),
                    batch.column("cut_stratum"),
                    pa.array(cuts, pa.list_(pa.float64())),
                ],
                names=["cut_pooled", "cut_stratum", "cuts"],
            )

    kind = counted.schema[stratum].dataType.simpleString()
    chosen = groups.select(
        F.col("key.pooled").alias("cut_pooled"), F.col("key.own").alias("cut_stratum"), "level", "cells"
    ).mapInArrow(choose, f"cut_pooled boolean, cut_stratum {kind}, cuts array<double>")
    own = F.when(~F.col("pooled"), F.col("stratum"))
    same = (F.col("pooled") == F.col("cut_pooled")) & own.eqNullSafe(F.col("cut_stratum"))
    return sizes.join(chosen, same).select("stratum", "n_good", "pooled", "cuts")


def fixed_failed(counts: str) -> Column:
    """The fixed rule: under 50 words, or more than half of them in repeated windows."""
    words, repeated = (F.col(f"`{counts}`.{c}") for c in ("n_words", "n_repeat_words"))
    return (words < 50) | (100 * repeated > 50 * words)


def verdicts(
    counted: DataFrame,
    cutoffs: DataFrame,
    stratum: str,
    *,
    counts: str = "counts",
    rules: tuple[Rule, ...] = RULES,
    failed: str = "base_failed",
    kept: str = "kept",
    broken: str = "broken_rules",
) -> DataFrame:
    """All columns of ``counted`` plus the verdict of the fixed rule and of the calibrated ones.

    The fixed rule fails texts under 50 words (null and empty ones too) and those with more than half
    of their words in repeated windows.  A stratum that was not calibrated, null included, keeps all
    that passes the fixed rule.
    """
    key, cuts = fresh("stratum_of_cut", counted), fresh("cuts", counted)
    chosen = cutoffs.select(F.col("stratum").alias(key), F.col("cuts").alias(cuts))
    joined = counted.join(chosen, F.col(stratum).eqNullSafe(F.col(key)), "left")
    fixed = fixed_failed(counts)
    names = [
        F.when(_metric(rule, counts) > F.col(cuts)[i], F.lit(rule.name))
        for i, rule in enumerate(rules)
    ]
    list_of = F.array_compact(F.array(*names))
    return joined.select(
        *[F.col(f"`{c}`") for c in counted.columns],
        fixed.alias(failed),
        list_of.alias(broken),
        (~fixed & (F.size(list_of) == 0)).alias(kept),
    )


def count(docs: DataFrame, text: str = "text", counts: str = "counts") -> DataFrame:
    return docs.withColumn(counts, counts_of(text))
