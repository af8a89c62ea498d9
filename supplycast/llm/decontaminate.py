"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over consecutive words: positions marked 0 are ignored, so a substituted word
there does not hide the passage.  The seed hashes of the test items are looked up for every word
position of every training text; around each hit the two texts are laid side by side, and all maximal
stretches with a large enough share of equal words are overlaps.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplycast.llm import text as tx

#: six words each, spread over seven to ten
MASKS = ("1101011", "11010011", "110010101", "1011000111", "111111")
#: an overlap counts from so many words on, or from the whole item if that is shorter
MIN_WORDS = 13
#: items below this many words are too common to search for
LEAST_WORDS = 4
#: share of equal words in an overlap, as a fraction
EQUAL = (4, 5)
#: words of test items searched for in one pass over the texts
BLOCK_WORDS = 1_000_000
_U = np.uint64
_FILTER_BITS = 22


class Index(NamedTuple):
    """Seed hashes of one block of items, in ascending order, and the items' words."""

    masks: tuple[tuple[int, ...], ...]  # offsets of the words that count
    keys: np.ndarray
    places: np.ndarray  # word of the block at which the seed lies
    words: np.ndarray
    bounds: np.ndarray
    ids: pa.Array


def _hash_words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = tx.FOLD[data]
    words = tx.find_words(data, at, tx.NOT_ALNUM)
    return tx.Hasher(data).ranges(words.starts, words.ends), words.bounds


def _seed(words: np.ndarray, offsets: tuple[int, ...], number: int) -> np.ndarray:
    """Hash of one mask at each position where it fits into ``words``."""
    n = max(0, len(words) - offsets[-1])
    total = np.full(n, number + 1, np.uint64)
    step = 1
    for k in offsets:
        step = step * tx._BASE % (1 << 64)
        total += words[k : k + n] * _U(step)
    return total ^ (total >> _U(29))


def build_index(texts: pa.Array, ids: pa.Array, masks: tuple[str, ...] = MASKS) -> Index:
    """Seeds of all items; an item shorter than the longest mask is a seed as a whole, too."""
    hashes, counts = [], []
    for _, data, at in tx.slices(texts):
        found, bounds = _hash_words(data, at)
        hashes.append(found)
        counts.append(np.diff(bounds))
    words = np.concatenate(hashes or [np.zeros(0, np.uint64)])
    lengths = np.concatenate(counts or [np.zeros(0, np.int64)])
    bounds = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    offsets = [tuple(k for k, c in enumerate(m) if c == "1") for m in masks]
    longest = max(len(m) for m in masks)
    short = sorted({int(n) for n in lengths if LEAST_WORDS <= n < longest})
    offsets += [tuple(range(n)) for n in short]
    ends = np.repeat(bounds[1:], lengths)
    keys, places = [], []
    for number, offset in enumerate(offsets):
        seeds = _seed(words, offset, number)
        at = np.arange(len(seeds))
        inside = at + offset[-1] < ends[: len(seeds)]
        if number >= len(masks):
            whole = np.repeat(lengths, lengths) == len(offset)
            first = np.isin(at, bounds[:-1])
            inside &= whole[: len(seeds)] & first
        keys.append(seeds[inside])
        places.append(at[inside])
    key, place = np.concatenate(keys), np.concatenate(places)
    order = np.argsort(key, kind="stable")
    return Index(tuple(offsets), key[order], place[order], words, bounds, ids)


def _hits(index: Index, seen: np.ndarray, words: np.ndarray, bounds: np.ndarray):
    """Distinct (document, item, shift) with a common seed; shift = text word minus item word."""
    ends = np.repeat(bounds[1:], np.diff(bounds))
    docs = tx.owners(bounds)
    at_doc, at_item = [], []
    for number, offset in enumerate(index.masks):
        seeds = _seed(words, offset, number)
        maybe = np.flatnonzero(seen[(seeds & _U((1 << _FILTER_BITS) - 1)).astype(np.int64)])
        maybe = maybe[maybe + offset[-1] < ends[maybe]]
        low = np.searchsorted(index.keys, seeds[maybe], side="left")
        n = np.searchsorted(index.keys, seeds[maybe], side="right") - low
        at_doc.append(np.repeat(maybe, n))
        first = np.repeat(low, n)
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at_item.append(index.places[first + nth])
    at_doc, at_item = np.concatenate(at_doc), np.concatenate(at_item)
    item = np.searchsorted(index.bounds, at_item, side="right") - 1
    rows = np.column_stack([docs[at_doc], item, at_doc - at_item])
    return np.unique(rows, axis=0)


def maximal_overlaps(
    equal: np.ndarray, share: tuple[int, int] = EQUAL
) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends ``[start, end)``, both ascending, of all maximal stretches that hold the share.

    A stretch begins and ends with an equal word and lies in no other one.  With ``top`` of ``bottom``
    words equal, it holds the share when the sum of ``bottom * equal - top`` over it is not negative.
    """
    top, bottom = share
    sums = np.concatenate([[0], np.cumsum(bottom * equal.astype(np.int64) - top)])
    starts = np.flatnonzero(equal)
    if not len(starts):
        return starts, starts
    # only places after an equal word are ends
    at_end = np.where(np.concatenate([[False], equal]), sums, np.iinfo(np.int64).min + 1)
    # the latest end whose sum reaches that of the start
    best_after = np.maximum.accumulate(at_end[::-1])[::-1]
    ends = np.searchsorted(-best_after, -sums[starts], side="right") - 1
    new = ends > np.concatenate([[0], np.maximum.accumulate(ends)[:-1]])
    return starts[new], ends[new]


def longest_overlap(equal: np.ndarray, share: tuple[int, int] = EQUAL) -> tuple[int, int]:
    """Longest of the maximal overlaps, of equally long ones the first."""
    starts, ends = maximal_overlaps(equal, share)
    if not len(starts):
        return 0, 0
    k = int(np.argmax(ends - starts))
    return int(starts[k]), int(ends[k])


def _verify(index: Index, words, bounds, doc: int, item: int, shift: int, min_words, share):
    """Long enough overlaps ``(item, doc_word, item_word, n_words, n_equal)`` of one alignment."""
    low, high = index.bounds[item], index.bounds[item + 1]
    start = max(low, bounds[doc] - shift)
    stop = min(high, bounds[doc + 1] - shift)
    equal = index.words[start:stop] == words[start + shift : stop + shift]
    return [
        (
            int(item),
            int(start + a + shift - bounds[doc]),
            int(start + a - low),
            int(b - a),
            int(equal[a:b].sum()),
        )
        for a, b in zip(*maximal_overlaps(equal, share), strict=True)
        if b - a >= min(min_words, high - low)
    ]


def _outermost(found: list[tuple]) -> list[tuple]:
    """Overlaps of one item whose words of the text lie in no other one's, in the order of the text.

    Of several with the same words that with the most equal ones stays, of these the first in the item.
    """
    out, end = [], -1
    for one in sorted(found, key=lambda o: (o[1], -o[3], -o[4], o[2])):
        if one[1] + one[3] > end:
            out.append(one)
            end = one[1] + one[3]
    return out


def overlaps(
    texts: pa.Array, index: Index, min_words: int = MIN_WORDS, share: tuple[int, int] = EQUAL
) -> list[list[tuple]]:
    """For every text its maximal overlaps ``(item, doc_word, item_word, n_words, n_equal)`` with each item."""
    seen = np.zeros(1 << _FILTER_BITS, dtype=bool)
    seen[(index.keys & _U((1 << _FILTER_BITS) - 1)).astype(np.int64)] = True
    out: list[list[tuple]] = [[] for _ in range(len(texts))]
    for first, data, at in tx.slices(texts):
        words, bounds = _hash_words(data, at)
        found: dict[tuple[int, int], list[tuple]] = {}
        for doc, item, shift in _hits(index, seen, words, bounds):
            here = _verify(index, words, bounds, doc, item, shift, min_words, share)
            if here:
                found.setdefault((doc, item), []).extend(here)
        for doc, item in sorted(found):
            out[first + doc].extend(_outermost(found[doc, item]))
    return out


def overlaps_of(
    index: Index,
    item_type: T.DataType,
    text: str = "text",
    min_words: int = MIN_WORDS,
    share: tuple[int, int] = EQUAL,
) -> Column:
    """Array of overlaps of each row's text with the items of one block.

    Null and empty texts have none; repeated rows are searched each for itself.
    """
    kind = T.ArrayType(
        T.StructType(
            [
                T.StructField("item_id", item_type),
                *[
                    T.StructField(n, T.LongType())
                    for n in ("doc_word", "item_word", "n_words", "n_equal")
                ],
            ]
        )
    )

    def run(column: pa.Array) -> pa.Array:
        found = overlaps(column, index, min_words, share)
        flat = np.array([x for row in found for x in row], dtype=np.int64).reshape(-1, 5)
        ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
        fields = [index.ids.take(pa.array(flat[:, 0])), *(pa.array(flat[:, k]) for k in range(1, 5))]
        names = ["item_id", "doc_word", "item_word", "n_words", "n_equal"]
        return pa.ListArray.from_arrays(
            pa.array(ends), pa.StructArray.from_arrays(fields, names=names)
        )

    return F.arrow_udf(run, kind)(F.col(text))


def blocks(
    items: DataFrame,
    *,
    item_id: str = "item_id",
    item_text: str = "text",
    masks: tuple[str, ...] = MASKS,
    block_words: int = BLOCK_WORDS,
) -> list[Index]:
    """Indexes of the test items, each of about ``block_words`` words.

    Null and empty items and those of fewer than LEAST_WORDS words match nothing.  Ids may be null or
    repeat; each row is an item.  The number of blocks follows the size of the test set, so what one
    pass broadcasts is bounded.
    """
    rows = items.select(F.col(item_id).alias("id"), F.col(item_text).alias("text")).where(
        F.col("text").isNotNull()
    )
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / 6 / block_words))  # about six bytes to a word
    indexes = []
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("text", "id"), F.lit(n)) == k).orderBy("id", "text")
        found = part.toArrow()
        texts, ids = (found.column(c).combine_chunks() for c in ("text", "id"))
        if isinstance(texts, pa.ChunkedArray):
            texts, ids = (pa.concat_arrays(c.chunks) for c in (texts, ids))
        indexes.append(build_index(texts, ids, masks))
    return indexes


def find_overlaps(
    docs: DataFrame,
    items: DataFrame,
    column: str,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    min_words: int = MIN_WORDS,
    share: tuple[int, int] = EQUAL,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """All rows and columns of ``docs`` plus the array of their overlaps with the test items."""
    kind = items.schema[item_id].dataType
    parts = [
        overlaps_of(index, kind, text, min_words, share)
        for index in blocks(items, item_id=item_id, item_text=item_text, block_words=block_words)
    ]
    return docs.withColumn(column, F.concat(*parts) if len(parts) > 1 else parts[0])
