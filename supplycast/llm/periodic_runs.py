"""Periodic runs of words: stretches that repeat one block of words four times or more.

A sparse diagonal recurrence over (word, lag): where a word equals the word ``lag`` places earlier, the
match length of that lag grows by one, and a diagonal that ends with enough matches is a run.  Feeding it
every earlier occurrence of every word is quadratic in frequent words, so each position is matched by
grams and feeds only one lag, that to the *nearest* earlier occurrence of its gram:

* lags ``q0 .. 3 * q0 / 2`` are matched by grams of ``3 * q0`` words, at least twice and at most three
  times the lag.  Inside a run of smallest period ``q`` no gram of ``2 * q`` words comes back before
  ``q`` words, since two periods in one stretch would leave a smaller one; so the nearest occurrence is
  the right lag, at every position of the run, and multiples of the period never show.
* a run of four periods holds such a gram and its earlier occurrence, so none is missed.
* a gram can only repeat where its parts repeat, so each length looks at the positions left by the
  shorter one.  Prose leaves almost none after the first; a text of one repeated word costs
  ``n log n`` for each of its ``log n`` lengths.

Grams get dense names by joining the names of two shorter grams, so only the words themselves are
compared by (64-bit) hashes.  The recurrence is evaluated for a slice of documents at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplycast.llm.text import Hasher, find_words, keyed, owners, slices

#: fewest words of a run, and fewest periods
MIN_WORDS = 6
MIN_PERIODS = 4

_RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])
_RESULT = T.StructType(
    [T.StructField("runs", T.ArrayType(_RUN, False)), T.StructField("collapsed", T.StringType())]
)


def _repeats(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions whose key occurs twice or more, their names and the lag to the last occurrence (0: none)."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    names, lags = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    names[order[1:]] = np.cumsum(~same)
    lags[order[1:][same]] = np.diff(at[order])[same]
    left = np.zeros(len(at), bool)
    left[order[1:][same]] = left[order[:-1][same]] = True
    return at[left], names[left], lags[left]


def _longer(at, names, ends, size: int, step: int):
    """``_repeats`` of the grams of ``size + step`` words among those of ``size``, ``step <= size``."""
    fits = np.flatnonzero(at + size + step <= ends[at])
    second = np.searchsorted(at, at[fits] + step)
    second[second == len(at)] = 0
    both = at[second] == at[fits] + step
    first, second = fits[both], second[both]
    width = names.max() + 1 if len(names) else 1
    return _repeats(names[first] * width + names[second], at[first])


def runs_of_words(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, lengths, periods)`` of the maximal runs, by start and period.

    ``words`` are 64-bit values, word k of document d has ``bounds[d] <= k < bounds[d + 1]``, and no run
    crosses a document border.
    """
    ends = np.repeat(bounds[1:], np.diff(bounds))
    at, names, _ = _repeats(keyed(words, owners(bounds)), np.arange(len(words)))
    at, names, _ = _longer(at, names, ends, 1, 1)
    size, shortest, found = 2, 1, []
    while len(at):
        while size < 3 * shortest and len(at):
            step = min(size, 3 * shortest - size)
            at, names, lags = _longer(at, names, ends, size, step)
            size += step
        longest = 3 * shortest // 2
        on = (lags >= shortest) & (lags <= longest)
        here, lag = at[on], lags[on]
        if len(here):
            breaks = np.flatnonzero((np.diff(here) != 1) | (np.diff(lag) != 0)) + 1
            first, last = np.r_[0, breaks], np.r_[breaks, len(here)] - 1
            start, period = here[first] - lag[first], lag[first]
            found.append((start, here[last] + size - start, period))
        shortest = longest + 1
    if not found:
        return (np.zeros(0, np.int64),) * 3
    starts, lengths, periods = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((periods, starts))
    order = order[lengths[order] >= np.maximum(MIN_WORDS, MIN_PERIODS * periods[order])]
    return starts[order], lengths[order], periods[order]


def _covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:-1]) > 0


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray):
    """Bytes and lengths of the documents that these words, joined by one blank, make."""
    sizes = ends - starts + 1
    total = np.r_[0, np.cumsum(sizes)]
    out = np.full(total[-1], 0x20, np.uint8)
    out_at = np.arange(total[-1]) - np.repeat(total[:-1], sizes)
    inside = out_at < np.repeat(sizes - 1, sizes)
    out[inside] = data[(np.repeat(starts, sizes) + out_at)[inside]]
    last = total[bounds[1:]][np.diff(bounds) > 0] - 1
    keep = np.ones(len(out), bool)
    keep[last] = False
    lengths = total[bounds[1:]] - total[bounds[:-1]]
    return out[keep], np.maximum(lengths - 1, 0)


def _run(column: pa.Array) -> pa.Array:
    counts, runs, lengths, texts = [], [], [], []
    for _, data, offsets in slices(column):
        words = find_words(data, offsets)
        starts, sizes, periods = runs_of_words(
            Hasher(data).ranges(words.starts, words.ends), words.bounds
        )
        doc = np.searchsorted(words.bounds, starts, side="right") - 1
        counts.append(np.bincount(doc, minlength=len(offsets) - 1))
        runs.append((starts - words.bounds[doc], sizes, periods))
        kept = ~_covered(starts + periods, starts + sizes, len(words.starts))
        left = np.r_[0, np.cumsum(kept)][words.bounds]
        text, n_bytes = _joined(data, words.starts[kept], words.ends[kept], left)
        texts.append(text)
        lengths.append(n_bytes)
    ends = lambda parts: pa.array(np.r_[0, np.cumsum(np.concatenate([[], *parts]))].astype(np.int32))
    fields = [pa.array(np.concatenate([[], *x]).astype(np.int64)) for x in zip(*runs, strict=True)]
    fields = fields or [pa.array([], pa.int64())] * 3
    spans = pa.StructArray.from_arrays(
        fields, fields=[pa.field(f.name, pa.int64(), False) for f in _RUN.fields]
    )
    at = ends(lengths)
    text = np.concatenate([np.zeros(0, np.uint8), *texts])
    collapsed = pa.StringArray.from_buffers(
        len(column), pa.py_buffer(at.to_numpy().tobytes()), pa.py_buffer(text.tobytes())
    )
    kind = pa.list_(pa.field("element", spans.type, False))
    listed = pa.ListArray.from_arrays(ends(counts), spans, type=kind)
    return pa.StructArray.from_arrays([listed, collapsed], names=["runs", "collapsed"])


def periodic_runs(text: str | Column = "text") -> Column:
    """Struct ``(runs, collapsed)`` of a text's words ``[^\\x20\\x09-\\x0D]+``, numbered from 0.

    ``runs`` are ``(start, length, period)`` by start and period: stretches of ``length >= max(6, 4 *
    period)`` words with smallest period ``period`` that no neighbouring word extends.  ``collapsed``
    is the text without the words that some run contains after its first ``period`` words, the others
    joined by one blank.  Null, empty and blank texts have no runs and collapse to the empty text.
    Each row is judged alone, so repeated rows get the same result and other columns do not matter;
    no text is cut, and a long one takes memory in proportion to its bytes.
    """
    return F.arrow_udf(_run, _RESULT)(F.col(text) if isinstance(text, str) else text)
