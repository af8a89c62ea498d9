"""Exact removal of repeated byte strings by hashed bucket names at window minima.

A bucket is the set of suffixes that start with the same bytes, and its identifier is a name that every
task computes alike: the q-gram's hash at first, then, for twice the depth, the name of the pair of
identifiers at the position and at the later offset.  Refining thus reuses the identifiers of the depth
before, down to the full length of 400 bytes.

A repeated string of 400 bytes contains repeated grams of half that length, and the smallest of its gram
names lies at the same place in every copy.  So only those suffixes ("anchors", about one in a hundred)
enter the first grouping, and each stands for the run of starts whose smallest gram it is.  Suffixes
alone in their bucket leave.  The others are refined by the name of all bytes their starts cover: where
that is shared, every start of the run repeats.  What still differs, at the ends of repeated passages,
is refined to the full length start by start.

This takes the place of bucket-pointer refinement proper, which sorts every suffix's bucket by the
identifiers of later offsets: that needs a row for every byte of the corpus in every round.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplycast.llm import text as tx
from supplycast.sources.scratch import materialize

LENGTH = 400
#: depth of the first buckets; LENGTH is this times a power of two
GRAM = 25
_U = np.uint64


def _deeper(names: np.ndarray, depth: int) -> np.ndarray:
    """Bucket identifiers at twice the depth."""
    if len(names) <= depth:
        return np.zeros(0, np.uint64)
    return tx.mix(names[:-depth] * _U(0x9FB21C651E98DF25) + names[depth:])


def bucket_names(hasher: tx.Hasher, length: int, gram: int = GRAM) -> np.ndarray:
    """Identifiers of the buckets of all strings of ``length`` bytes, by position."""
    names, depth = hasher.windows(gram), gram
    while depth < length:
        names, depth = _deeper(names, depth), 2 * depth
    return names


def _sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least key of each run of ``width`` positions."""
    n = len(keys)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def anchors(data: np.ndarray, at: np.ndarray, length: int = LENGTH):
    """``(document, anchor, first start, last start, bucket, context)`` of each anchor of a slice."""
    none = np.zeros(0, np.int64)
    if len(data) < length or not (np.diff(at) >= length).any():
        return none, none, none, none, none.view(np.uint64), none.view(np.uint64)
    hasher, half = tx.Hasher(data), length // 2
    names = bucket_names(hasher, half)
    # name and position in one number; the position tells equal names apart, leftmost first
    low = _U((1 << int(len(data)).bit_length()) - 1)
    keys = (names & ~low) | np.arange(len(names), dtype=np.uint64)
    owner = (_sliding_least(keys, half + 1) & low).astype(np.int64)
    starts = np.arange(len(owner))
    ends = np.repeat(at[1:], np.diff(at))
    inside = starts + length <= ends[: len(owner)]
    starts, owner = starts[inside], owner[inside]
    doc = np.searchsorted(at, starts, side="right") - 1
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    lo, hi, anchor = starts[first], starts[last], owner[first]
    shape = (anchor - lo).astype(np.uint64) * _U(1 << 20) + (hi - lo).astype(np.uint64)
    context = tx.mix(hasher.ranges(lo, hi + length) + tx.mix(shape + _U(9)))
    base = at[doc[first]]
    return doc[first], anchor - base, lo - base, hi - base, names[anchor], context


#: a text is known by its document id and a short hash, so repeated ids with other texts stay apart
_KEY = ["doc_key", "text_key"]
_KEYS = "doc_key long, text_key int"
_ANCHORS = f"{_KEYS}, anchor long, lo long, hi long, bucket long, context long"
_PIECES = f"{_KEYS}, anchor long, lo long, hi long, single boolean, core long, hull long"
#: starts that are refined together before they are refined one by one
WIDTHS = (32, 1)


def _anchors_of(length: int):
    def run(batches):
        for batch in batches:
            keys = [batch.column(c) for c in _KEY]
            for first, data, at in tx.slices(batch.column("text")):
                doc, *found, bucket, context = anchors(data, at, length)
                where = pa.array(doc + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(k.take(where) for k in keys),
                        *(pa.array(x) for x in found),
                        pa.array(tx.signed(bucket)),
                        pa.array(tx.signed(context)),
                    ],
                    names=[*_KEY, "anchor", "lo", "hi", "bucket", "context"],
                )

    return run


def _pieces_of(width: int, length: int):
    """Cuts the runs of starts of each text at multiples of ``width`` before their anchor.

    All starts of a piece share its core; the hull is all that they cover, null where the run does not
    fill the piece.
    """

    def run(batches):
        for batch in batches:
            runs = batch.column("runs")
            keys = [batch.column(c) for c in _KEY]
            for first, data, at in tx.slices(batch.column("text")):
                here = runs.slice(first, len(at) - 1)
                flat = here.flatten()
                doc = np.repeat(np.arange(len(at) - 1), np.diff(np.asarray(here.offsets)))
                anchor, lo, hi = (np.asarray(flat.field(c)) for c in ("anchor", "lo", "hi"))
                single = np.asarray(flat.field("single").cast(pa.int8()))
                near, far = (anchor - hi) // width, (anchor - lo) // width
                n = far - near + 1
                run_of = np.repeat(np.arange(len(n)), n)
                block = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + near[run_of]
                doc, anchor, single = doc[run_of], anchor[run_of], single[run_of]
                lo, hi = lo[run_of], hi[run_of]
                begin, end = anchor - (block + 1) * width + 1, anchor - block * width
                base = at[doc]
                hasher = tx.Hasher(data)
                core = hasher.ranges(base + end, base + begin + length)
                whole = (begin >= lo) & (end <= hi)
                first_in, last_in = np.maximum(begin, lo), np.minimum(end, hi)
                hull = hasher.ranges(base + first_in, base + last_in + length)
                where = pa.array(doc + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(k.take(where) for k in keys),
                        pa.array(anchor),
                        pa.array(first_in),
                        pa.array(last_in),
                        pa.array(single == 1),
                        pa.array(tx.signed(core)),
                        pa.array(tx.signed(hull), mask=~whole),
                    ],
                    names=[*_KEY, "anchor", "lo", "hi", "single", "core", "hull"],
                )

    return run


def _merge(spans) -> list[tuple[int, int]]:
    """Union of byte ranges, in order."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _shared(rows: DataFrame, name: str) -> DataFrame:
    """Values of a column that stand in more than one row; summed before the shuffle."""
    return rows.groupBy(name).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(name)


def repeated_starts(texts: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """Runs ``(key, lo, hi)`` of starts of repeated strings, and the texts that may have some.

    ``texts`` has the key and ``text``.
    """
    found = materialize(texts.mapInArrow(_anchors_of(length), _ANCHORS), "anchors")
    shared = found.join(_shared(found, "bucket"), "bucket")
    shared = materialize(shared, "shared-anchors")
    affected = materialize(texts.join(shared.select(*_KEY).distinct(), _KEY, "left_semi"), "texts")
    one = F.struct(*_KEY, "anchor", "lo", "hi")
    classes = materialize(
        shared.groupBy("bucket", "context").agg(
            F.count(F.lit(1)).alias("n"), F.min(one).alias("one")
        ),
        "classes",
    )
    several = (
        classes.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("classes"), F.min("n").alias("least"))
        .where("classes > 1 AND least = 1")
        .select("bucket")
    )
    common = classes.where("n > 1").select("bucket", "context")
    done = shared.join(common, ["bucket", "context"], "left_semi").select(*_KEY, "lo", "hi")
    runs = classes.join(several, "bucket", "left_semi").select(
        "one.*", (F.col("n") == 1).alias("single")
    )
    for width in WIDTHS:
        lists = runs.groupBy(*_KEY).agg(
            F.collect_list(F.struct("anchor", "lo", "hi", "single")).alias("runs")
        )
        pieces = materialize(
            affected.join(lists, _KEY)
            .select(*_KEY, "text", "runs")
            .mapInArrow(_pieces_of(width, length), _PIECES),
            "pieces",
        )
        cores = (
            pieces.groupBy("core")
            .agg(F.count(F.lit(1)).alias("n"), F.max("single").alias("open"))
            .where("n > 1 AND open")
            .select("core")
        )
        alive = pieces.join(cores, "core")
        hulls = _shared(pieces.where("hull IS NOT NULL"), "hull").withColumn("full", F.lit(True))
        judged = materialize(alive.join(hulls, "hull", "left"), "judged")
        resolved = F.col("single") & F.coalesce("full", F.lit(False))
        done = done.unionAll(judged.where(resolved).select(*_KEY, "lo", "hi"))
        # what is settled may still be the copy of a piece that is not
        unsettled = judged.withColumn("single", F.col("single") & ~resolved)
        cores = unsettled.where("single").select("core").distinct()
        runs = unsettled.join(cores, "core", "left_semi").select(
            *_KEY, "anchor", "lo", "hi", "single"
        )
    return done, affected


_RESULT = f"{_KEYS}, n_removed long, spans array<struct<start:long,end:long>>, kept binary"


def _remove(length: int):
    def run(batches):
        for batch in batches:
            out = []
            for doc, key, text, starts in zip(
                *(batch.column(c).to_pylist() for c in (*_KEY, "text", "starts")), strict=True
            ):
                data = text.encode()
                spans = _merge(((s["lo"], s["hi"] + length) for s in starts))
                kept, at = [], 0
                for low, high in spans:
                    kept.append(data[at:low])
                    at = high
                kept.append(data[at:])
                removed = sum(high - low for low, high in spans)
                out.append(
                    (doc, key, removed, [{"start": a, "end": b} for a, b in spans], b"".join(kept))
                )
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.list_(span), pa.binary()]
            columns = zip(*out, strict=True) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=[*_KEY, "n_removed", "spans", "kept"],
            )

    return run


def keyed_texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-1)).alias("doc_key"),
        F.hash(F.coalesce(F.col(text), F.lit(""))).alias("text_key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )


def remove_repeats(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH
) -> DataFrame:
    """``(doc_key, text_key, n_removed, spans, kept)`` of each text that loses bytes.

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in the same
    text or another one; all strings are judged on the input.  Texts shorter than ``length`` (null and
    empty ones too) lose nothing, rows with equal texts lose all of them, first row included.  A row's
    id (-1 for null) and text decide alone, so repeated rows get one result.  ``kept`` holds the
    remaining bytes, which need not be valid UTF-8.
    """
    if length % GRAM or (length // GRAM) & (length // GRAM - 1):
        raise ValueError(f"length must be {GRAM} times a power of two")
    texts = keyed_texts(docs, doc_id, text)
    starts, affected = repeated_starts(texts, length)
    lists = starts.groupBy(*_KEY).agg(F.collect_list(F.struct("lo", "hi")).alias("starts"))
    return affected.join(lists, _KEY).mapInArrow(_remove(length), _RESULT)


def summary(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of every row.

    Texts travel only where they share something; the digests of the others are computed in place.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    light = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-1)).alias("doc_key"),
        F.hash(body).alias("text_key"),
        F.octet_length(body).cast("long").alias("n_bytes"),
        F.sha2(body.cast("binary"), 256).alias("sha256"),
    )
    changed = (
        remove_repeats(docs, doc_id=doc_id, text=text)
        .select(
            *_KEY,
            "n_removed",
            F.size("spans").cast("long").alias("n_spans"),
            F.sha2("kept", 256).alias("kept_sha256"),
        )
        .dropDuplicates(_KEY)
    )
    zero = F.lit(0).cast("long")
    return light.join(changed, _KEY, "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"),
    )
