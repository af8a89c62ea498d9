"""Near-duplicate join on word n-grams by parity sketches.

Each distinct shingle flips one bit of a long bit sketch, so the Hamming distance of two sketches is at
most the size of the symmetric difference of the sets.  At a Jaccard similarity of at least 4/5 that
difference is at most a ninth of the two sizes together, call it D.  The sketch is cut into blocks, and
at most D blocks differ.  Taking the non-empty blocks in a fixed order (fullest first), two similar sets
therefore share one among the first D + 1 of each: these blocks are the join keys.  Sizes are banded by
powers of two, with the number of blocks fixed per band; a set close to the upper end of its band also
enters the next one, as a partner of larger sets.

Equal keys only make candidates.  They are compared first by a folded sketch (distance above D means
not similar) and then by the sets themselves.  Inside a group of equal keys each set is compared with
one pivot; what is joined by verified links needs no further comparison, and only sets of one group that
are still unconnected are compared with each other.

In a crowded group the sets near a pivot P, common to many groups, are compared by their differences from
it: X for P ^ x.  As x ^ y equals X ^ Y, similar x and y have (|X| + |Y| - D) / 2 items of X and Y in
common.  Where this asks for none, both are similar to P and linked with it; else X and Y share one of
their rarest items, so many near copies of one text, each with changes of its own, make few pairs.  Sets
far from P cannot be similar to those close to it and are compared pair by pair; where a group is still
crowded then, its sets are joined on their rarest shingles, of which two similar sets share one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplycast.llm import text as tx
from supplycast.llm.components import components
from supplycast.sources.scratch import materialize

SHINGLE = 5
#: similar from this share on: intersection / union >= TOP / BOTTOM
TOP, BOTTOM = 4, 5
#: blocks of a band for each shingle of its largest set, and at least so many
BLOCKS_PER_SHINGLE, LEAST_BLOCKS = 0.36, 32
#: rounds that compare with one pivot of each group before the rest is compared pair by pair
STAR_ROUNDS = 1
#: in larger groups the sets near a pivot are compared by their differences from it, not pair by pair
CROWD = 256
#: most that a set near a pivot differs from it, as a share of the pivot's size
NEAR = 1.0
#: classes of differences by size, for each size of a pivot
CLASSES = 32
#: words of a sketch that are not folded away; shorter ones let too many pairs of small sets pass
LEAST_WORDS = 4
#: smallest keys by which two sets are known to meet in several groups, for each set
FIRST_GROUPS = 8
#: so many ids are broadcast to the texts, which are not moved for them
SMALL_ROWS = 1_000_000
_U = np.uint64


def _most_different(n, m):
    """Largest symmetric difference of similar sets of sizes ``n`` and ``m``."""
    return (n + m) * (BOTTOM - TOP) // (BOTTOM + TOP)


def _band(n: np.ndarray) -> np.ndarray:
    """Smallest exponent with ``n <= 2 ** exponent``."""
    return np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64)


def n_blocks(band: np.ndarray) -> np.ndarray:
    return np.maximum(np.ceil(2.0**band * BLOCKS_PER_SHINGLE), LEAST_BLOCKS).astype(np.int64)


class Sets:
    """Distinct shingles of the documents of one slice, ascending per document."""

    def __init__(self, data: np.ndarray, at: np.ndarray, size: int = SHINGLE) -> None:
        words = tx.find_words(data, at)
        hashes = tx.Hasher(data, tx.FOLD).ranges(words.starts, words.ends)
        shingles, docs, _ = tx.shingles(hashes, words.bounds, size, whole=True)
        order = np.argsort(docs, kind="stable")  # in order but for the short documents
        shingles, docs = shingles[order], docs[order]
        ends = np.searchsorted(docs, np.arange(len(at)))
        for low, high in zip(ends[:-1], ends[1:], strict=True):
            shingles[low:high].sort()
        new = np.ones(len(docs), dtype=bool)
        new[1:] = (shingles[1:] != shingles[:-1]) | (docs[1:] != docs[:-1])
        self.values, self.docs = shingles[new], docs[new]
        self.n = np.bincount(self.docs, minlength=len(at) - 1)
        self.bounds = np.concatenate([[0], np.cumsum(self.n)])

    def identity(self) -> np.ndarray:
        """One hash for each set."""
        total = np.zeros(len(self.values) + 1, np.uint64)
        np.cumsum(tx.mix(self.values + _U(77)), out=total[1:])
        sums = total[self.bounds[1:]] - total[self.bounds[:-1]]
        return tx.mix(sums + self.n.astype(np.uint64))

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Block keys and their documents."""
        band = _band(self.n)
        most = self.n * BOTTOM // TOP  # size of the largest similar set
        top = 2**band
        own = _most_different(self.n, np.minimum(most, top))
        later = np.where(most > top, _most_different(self.n, most), -1)
        parts = [self._blocks(band, own), self._blocks(band + 1, later)]
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True))

    def _blocks(self, band: np.ndarray, differ: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first ``differ + 1`` blocks of each document; none where ``differ`` is negative."""
        take = differ[self.docs] >= 0
        values, docs = self.values[take], self.docs[take]
        if not len(values):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        blocks = n_blocks(band)
        # values ascend per document, so do their blocks
        block = ((values >> _U(32)) * blocks[docs].astype(np.uint64)) >> _U(32)
        first = np.ones(len(values), dtype=bool)
        first[1:] = (block[1:] != block[:-1]) | (docs[1:] != docs[:-1])
        at = np.flatnonzero(first)
        bits = np.bitwise_xor.reduceat(tx.mix(values + _U(5)), at)
        filled = np.diff(np.append(at, len(values)))
        owner, number = docs[at], block[at]
        # by document, fullest block, number
        fullness = _U(4095) - np.minimum(filled, 4095).astype(np.uint64)
        order = np.argsort((owner.astype(np.uint64) << _U(44)) | (fullness << _U(32)) | number)
        owner, number, bits = owner[order], number[order], bits[order]
        begin = np.searchsorted(owner, np.arange(len(self.n)))
        rank = np.arange(len(owner)) - begin[owner]
        has = np.bincount(owner, minlength=len(self.n))
        kept = rank <= differ[owner]
        scheme = tx.mix(band.astype(np.uint64) + _U(1))
        keys = tx.mix(bits[kept] + tx.mix(number[kept] + scheme[owner[kept]]))
        # sets with too few non-empty blocks to be sure of a common one meet under one key
        rest = np.flatnonzero((differ >= 0) & (has <= differ) & (self.n > 0))
        return np.concatenate([keys, scheme[rest]]), np.concatenate([owner[kept], rest])

    def sketch(self, doc: int) -> np.ndarray:
        """Parity bits of one set, two for each shingle of the band's largest set, as 64-bit words."""
        bits = int(max(64, 2 * 2 ** int(_band(self.n[doc : doc + 1])[0])))
        where = self.values[self.bounds[doc] : self.bounds[doc + 1]] & _U(bits - 1)
        odd = np.bincount(where.astype(np.int64), minlength=bits) & 1
        return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


_SKETCHED = "doc_id long, set_id long, n_shingles long, sketch array<long>, keys array<long>"


def _sketched(batches):
    for batch in batches:
        ids, column = batch.column(0), batch.column(1)
        for first, data, at in tx.slices(column):
            sets = Sets(data, at)
            keys, owner = sets.keys()
            order = np.argsort(owner, kind="stable")
            per = np.bincount(owner, minlength=len(sets.n))
            sketches = [sets.sketch(d) if sets.n[d] else np.zeros(0, np.int64) for d in range(len(sets.n))]
            lengths = [len(s) for s in sketches]
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(first, len(sets.n)),
                    pa.array(tx.signed(sets.identity())),
                    pa.array(sets.n.astype(np.int64)),
                    _lists(np.concatenate([*sketches, np.zeros(0, np.int64)]), lengths),
                    _lists(tx.signed(keys[order]), per),
                ],
                names=["doc_id", "set_id", "n_shingles", "sketch", "keys"],
            )


def _lists(values: np.ndarray, lengths) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(np.asarray(lengths, np.int64))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int64)))


_GROUPS = (
    "key long, head long, more struct<hash_xor:long,hash_sum:long,n:long,members:array<long>>"
)


def _local_groups(batches):
    """One row for each key of a batch with the distinct sets that have it.

    Most keys have one set, which says all, so they have no ``more``.
    """
    for batch in batches:
        lists = batch.column("keys")
        keys = np.asarray(lists.flatten())
        lengths = np.diff(np.asarray(lists.offsets))
        sets = np.repeat(np.asarray(batch.column("set_id")), lengths)
        order = np.lexsort((sets, keys))
        keys, sets = keys[order], sets[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (sets[1:] != sets[:-1])
        keys, sets = keys[new], sets[new]
        first = np.ones(len(keys), dtype=bool)
        first[1:] = keys[1:] != keys[:-1]
        at = np.flatnonzero(first)
        if not len(at):
            continue
        counts = np.diff(np.append(at, len(keys)))
        # ids of sets are hashes themselves
        more = {
            "hash_xor": pa.array(np.bitwise_xor.reduceat(sets, at)),
            "hash_sum": pa.array(np.add.reduceat(sets & 0xFFFFFFFF, at)),
            "n": pa.array(counts.astype(np.int64)),
            "members": _lists(sets[~first], counts - 1),
        }
        more = pa.StructArray.from_arrays(
            list(more.values()), names=list(more), mask=pa.array(counts == 1)
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[at]), pa.array(sets[at]), more], names=["key", "head", "more"]
        )


def shared_groups(sketched: DataFrame) -> DataFrame:
    """``(group_key, set_id)``: sets that share a key with another one.

    Sets of one batch are grouped before the shuffle, so a key of most sets arrives as one row per
    batch.  Keys with the same sets say the same, so one of them is kept.
    """
    local = sketched.select("set_id", "keys").mapInArrow(_local_groups, _GROUPS)
    by_key = Window.partitionBy("key")
    low = F.col("head").bitwiseAND(F.lit(0xFFFFFFFF))
    grouped = local.select(
        "key",
        "head",
        F.col("more.members").alias("members"),
        F.min("head").over(by_key).alias("least"),
        F.max("head").over(by_key).alias("most"),
        F.bit_xor(F.coalesce("more.hash_xor", "head")).over(by_key).alias("hash_xor"),
        F.sum(F.coalesce("more.hash_sum", low)).over(by_key).alias("hash_sum"),
        F.sum(F.coalesce("more.n", F.lit(1))).over(by_key).alias("n"),
    ).where("least != most OR members IS NOT NULL")
    grouped = materialize(grouped, "groups")
    signature = ["least", "hash_xor", "hash_sum", "n"]
    one = grouped.groupBy(*signature).agg(F.min("key").alias("key"))
    members = F.explode(
        F.concat(F.array("head"), F.coalesce("members", F.array().cast("array<long>")))
    )
    return (
        grouped.select("key", "head", "members")
        .join(one.select("key"), "key", "left_semi")
        .select(F.col("key").alias("group_key"), members.alias("set_id"))
        .distinct()
    )


def _folded(a: Column) -> Column:
    """A sketch at half its length; distances of folded sketches are no larger."""
    half = F.try_divide(F.size(a), F.lit(2)).cast("int")
    return F.zip_with(F.slice(a, 1, half), F.slice(a, half + 1, half), lambda p, q: p.bitwiseXOR(q))


def _short(sizes: DataFrame, least: int = 1) -> DataFrame:
    """Sets with their sketches folded twice, to a quarter of their length, ``least`` words at least."""
    for _ in range(2):
        sketch = F.col("s.sketch")
        half = F.when(F.size(sketch) > least, _folded(sketch)).otherwise(sketch)
        sizes = sizes.select("set_id", F.struct(F.col("s.n").alias("n"), half.alias("sketch")).alias("s"))
    return sizes


def _distance(x: Column, y: Column) -> Column:
    """Hamming distance of two sketches, the longer one folded to the length of the shorter."""

    def fold(a: Column, b: Column) -> Column:
        return F.when(F.size(a) > F.size(b), _folded(a)).otherwise(a)

    bits = F.zip_with(fold(x, y), fold(y, x), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.aggregate(bits, F.lit(0), lambda acc, b: acc + b)


def _size_fits(n: str, m: str) -> Column:
    n, m = F.col(n), F.col(m)
    return (n * BOTTOM >= m * TOP) & (m * BOTTOM >= n * TOP)


def _may_link(x: str, y: str) -> Column:
    """Sizes and sketches do not rule the pair out."""
    differ = F.floor((F.col(f"{x}.n") + F.col(f"{y}.n")) * (BOTTOM - TOP) / (BOTTOM + TOP))
    near = _distance(F.col(f"{x}.sketch"), F.col(f"{y}.sketch")) <= differ
    return _size_fits(f"{x}.n", f"{y}.n") & near


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of set ids whose sets are similar; ``sets`` has ``(set_id, shingles)``."""
    left = sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    joined = pairs.join(left, "a").join(right, "b")
    return (
        joined.select("a", "b", common.alias("common"), (F.size("x") + F.size("y")).alias("both"))
        .where(BOTTOM * F.col("common") >= TOP * (F.col("both") - F.col("common")))
        .select("a", "b")
    )


def _sets_of(batches):
    for batch in batches:
        for _, data, at in tx.slices(batch.column(0)):
            sets = Sets(data, at)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(tx.signed(sets.identity())),
                    _lists(tx.signed(sets.values), sets.n),
                ],
                names=["set_id", "shingles"],
            )


def _shingle_sets(docs: DataFrame, ids: DataFrame, wanted: DataFrame) -> DataFrame:
    """Shingles of the wanted sets, from the texts of one document of each."""
    which = ids.join(wanted, "set_id", "left_semi").groupBy("set_id").agg(F.min("doc_id").alias("doc_id"))
    which = materialize(which, "first-documents")
    few = which.select("doc_id").distinct()
    if which.count() <= SMALL_ROWS:
        few = F.broadcast(few)
    found = (
        docs.join(few, "doc_id", "left_semi")
        .select("text")
        .mapInArrow(_sets_of, "set_id long, shingles array<long>")
    )
    return found.join(which, "set_id", "left_semi").dropDuplicates(["set_id"])


def _link(pairs: DataFrame, docs: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """Pairs of similar sets, verified by the sets themselves."""
    pairs = materialize(pairs, f"{name}-candidates")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
    sets = materialize(_shingle_sets(docs, ids, wanted), f"{name}-sets")
    return materialize(verified(pairs, sets), f"{name}-links")


def similar_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row.

    ``component_id`` is the smallest id reachable over links; a document without words (null, empty or
    blank text) links to nothing.  Rows with a null id are compared with nothing and have a null
    component.  Rows that repeat an id are one document: they share a component even if their texts
    differ.  Sets are compared by the 64-bit hashes of their shingles.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketched = materialize(docs.mapInArrow(_sketched, _SKETCHED), "sketches")
    known = sketched.where("doc_id IS NOT NULL AND n_shingles > 0")
    ids = known.select("doc_id", "set_id")
    size = materialize(
        known.select("set_id", F.struct(F.col("n_shingles").alias("n"), "sketch").alias("s")).dropDuplicates(
            ["set_id"]
        ),
        "set-sizes",
    )
    # sketches stay out of the groups, where a set of many groups would repeat its own in each
    lengths = size.select("set_id", F.col("s.n").alias("n"))
    rows = materialize(shared_groups(known).join(lengths, "set_id"), "shared")
    crowds = rows.groupBy("group_key").agg(F.count(F.lit(1)).alias("members"))
    crowds = materialize(crowds.where(F.col("members") > CROWD).select("group_key"), "crowds")
    links = None
    if not crowds.isEmpty():
        spokes = materialize(_spokes(rows.join(crowds, "group_key", "left_semi")), "spokes")
        near, sets = _differences(spokes, docs, ids, size)
        to_pivot = near.where("linked").select(F.col("set_id").alias("a"), F.col("pivot").alias("b"))
        pairs = materialize(_near(_near(_difference_pairs(near), _short(size, LEAST_WORDS)), size), "crowds-candidates")
        links = to_pivot.unionAll(materialize(verified(pairs, sets), "crowds-links"))
        rows = rows.join(crowds, "group_key", "left_anti").select("group_key", "set_id", "n")
        rows = materialize(rows.unionAll(_far(spokes, near)), "shared")
    rows = rows.withColumn("label", F.col("set_id"))
    for number in range(STAR_ROUNDS + 1):
        pairs = _star_pairs(rows, size, number) if number < STAR_ROUNDS else _rest_pairs(rows, size, docs, ids)
        found = _link(pairs, docs, ids, f"round-{number}")
        links = found if links is None else links.unionAll(found)
        if number < STAR_ROUNDS:
            rows = _unconnected(rows, components(links))
    same_id = (
        ids.distinct()
        .join(ids.groupBy("doc_id").agg(F.min("set_id").alias("b")), "doc_id")
        .where("set_id != b")
        .select(F.col("set_id").alias("a"), "b")
    )
    labels = components(links.unionAll(same_id))
    placed = (
        ids.distinct()
        .join(labels.withColumnRenamed("node", "set_id"), "set_id", "left")
        .select("doc_id", F.coalesce("label", "set_id").alias("label"))
        .distinct()
    )
    smallest = placed.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of_document = (
        placed.join(smallest, "label").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    )
    return (
        sketched.select("doc_id", "n_shingles")
        .join(of_document, "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    )


def _unconnected(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the groups whose sets are not all connected by verified links yet."""
    labelled = materialize(
        rows.drop("label")
        .join(labels.withColumnRenamed("node", "set_id"), "set_id", "left")
        .withColumn("label", F.coalesce("label", "set_id")),
        "labelled",
    )
    several = (
        labelled.groupBy("group_key")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low != high")
        .select("group_key")
    )
    return materialize(labelled.join(several, "group_key", "left_semi"), "unconnected")


def _spokes(rows: DataFrame) -> DataFrame:
    """Rows with a pivot, the set of their group that is in most of the groups."""
    spread = rows.groupBy("set_id").agg(F.count(F.lit(1)).alias("groups"))
    pivots = (
        rows.join(spread, "set_id")
        .groupBy("group_key")
        .agg(F.max_by(F.struct("set_id", "n"), F.struct("groups", "set_id")).alias("p"))
    )
    return rows.join(pivots, "group_key").select(
        "group_key", "set_id", "n", F.col("p.set_id").alias("pivot"), F.col("p.n").alias("p_n")
    )


def _differences(
    spokes: DataFrame, docs: DataFrame, ids: DataFrame, size: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Sets near their pivot, with the ``items`` that stand in one of both only; the sets themselves."""
    pairs = spokes.where("set_id != pivot").drop("group_key").distinct()
    left = size.select("set_id", F.col("s.sketch").alias("u"))
    right = size.select(F.col("set_id").alias("pivot"), F.col("s.sketch").alias("v"))
    most = F.floor(F.col("p_n") * NEAR)
    pairs = pairs.join(left, "set_id").join(right, "pivot").where(_distance(F.col("u"), F.col("v")) <= most)
    pairs = materialize(pairs.drop("u", "v"), "near-pivots")
    wanted = pairs.select(F.explode(F.array("set_id", "pivot")).alias("set_id")).distinct()
    sets = materialize(_shingle_sets(docs, ids, wanted), "crowd-sets")
    left = sets.select("set_id", F.col("shingles").alias("x"))
    right = sets.select(F.col("set_id").alias("pivot"), F.col("shingles").alias("y"))
    items = F.concat(F.array_except("x", "y"), F.array_except("y", "x"))
    found = pairs.join(left, "set_id").join(right, "pivot").withColumn("items", items).drop("x", "y")
    linked = F.size("items") * (TOP + BOTTOM) <= (F.col("n") + F.col("p_n")) * (BOTTOM - TOP)
    near = found.where(F.size("items") <= most).withColumn("linked", linked)
    return materialize(near, "differences"), sets


def _differ(n: str) -> Column:
    """Largest symmetric difference of a set of size ``n`` and a similar one of any size."""
    largest = F.floor(F.col(n) * BOTTOM / TOP)
    return F.floor((F.col(n) + largest) * (BOTTOM - TOP) / (BOTTOM + TOP))


def _far(spokes: DataFrame, near: DataFrame) -> DataFrame:
    """Rows whose set may be similar to one that is not near the pivot."""
    inner = near.where(F.size("items") + _differ("n") <= F.floor(F.col("p_n") * NEAR))
    outer = spokes.where("set_id != pivot").join(inner, ["set_id", "pivot"], "left_anti")
    return outer.select("group_key", "set_id", "n")


def _difference_pairs(near: DataFrame) -> DataFrame:
    """Pairs of one pivot that may be similar though not connected through it.

    Of two sets whose differences X and Y share so many items, the first |X| - common + 1 of X and the
    like of Y share one, in any order for both; here the rarest come first, and those of one set only
    are counted but not moved.  Sets linked with the pivot need no link with each other.  Differences are classed by size, since a prefix depends on both sizes.
    """
    items = near.select("pivot", "set_id", F.explode("items").alias("item"))
    shared = items.groupBy("pivot", "item").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    ordered = (
        items.join(shared, ["pivot", "item"])
        .groupBy("pivot", "set_id")
        .agg(F.array_sort(F.collect_list(F.struct("f", "item")))["item"].alias("common"))
    )
    width = F.greatest(F.floor(F.col("p_n") / CLASSES), F.lit(1))
    sized = (
        near.select(
            "pivot",
            "set_id",
            F.when(F.col("linked"), F.col("pivot")).otherwise(F.col("set_id")).alias("label"),
            F.size("items").alias("size"),
            width.alias("width"),
            _differ("n").alias("differ"),
        )
        .join(ordered, ["pivot", "set_id"])
        .withColumn("class", F.floor(F.col("size") / F.col("width")))
    )
    least = F.floor(F.greatest(F.col("size") - F.col("differ"), F.lit(0)) / F.col("width"))
    most = F.floor((F.col("size") + F.col("differ")) / F.col("width"))
    # items before the common ones are in no other difference
    first = F.floor((F.col("size") - F.col("other") * F.col("width") + F.col("differ")) / 2) + 1
    moved = first - (F.col("size") - F.size("common"))
    rows = (
        sized.withColumn("other", F.explode(F.sequence(least, most)))
        .withColumn("moved", F.least(moved, F.size("common")).cast("int"))
        .where("moved > 0")
        .select(
            "pivot", "set_id", "label", "class", "other", F.explode(F.slice("common", 1, F.col("moved"))).alias("item")
        )
    )
    columns = ("set_id", "label")
    keys = ["pivot", "item", "low", "high"]
    left = rows.where("class <= other").select(
        "pivot", "item", F.col("class").alias("low"), F.col("other").alias("high"),
        *[F.col(c).alias(f"{c}_a") for c in columns],
    )
    right = rows.where("class >= other").select(
        "pivot", "item", F.col("other").alias("low"), F.col("class").alias("high"),
        *[F.col(c).alias(f"{c}_b") for c in columns],
    )
    return (
        left.join(right, keys)
        .where("label_a != label_b AND (low < high OR set_id_a < set_id_b)")
        .select(F.least("set_id_a", "set_id_b").alias("a"), F.greatest("set_id_a", "set_id_b").alias("b"))
        .distinct()
    )


def _star_pairs(rows: DataFrame, size: DataFrame, number: int) -> DataFrame:
    """Each set of a group with the group's pivot, if they are unconnected and may be similar.

    The pivot is drawn by a hash of the set, the same in all groups, so the groups of one text and its
    near copies have few pivots among them and a set meets each of these once.
    """
    drawn = F.struct(
        F.xxhash64("set_id", F.lit(number)).alias("hash"),
        F.struct("set_id", "label", "n").alias("pivot"),
    )
    pivots = rows.groupBy("group_key").agg(F.min_by(drawn["pivot"], drawn["hash"]).alias("p"))
    pairs = (
        rows.join(pivots, "group_key")
        .where((F.col("label") != F.col("p.label")) & _size_fits("n", "p.n"))
        .select(F.least("set_id", "p.set_id").alias("a"), F.greatest("set_id", "p.set_id").alias("b"))
        .distinct()
    )
    # most pairs fail already by the short sketches, and only the others carry a whole one
    return _near(_near(pairs, _short(size, LEAST_WORDS)), size)


def _near(pairs: DataFrame, size: DataFrame) -> DataFrame:
    """Pairs that sizes and sketches do not rule out."""
    left = size.select(F.col("set_id").alias("a"), F.col("s").alias("x"))
    right = size.select(F.col("set_id").alias("b"), F.col("s").alias("y"))
    return pairs.join(left, "a").join(right, "b").where(_may_link("x", "y")).select("a", "b")


def _rest_pairs(rows: DataFrame, size: DataFrame, docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Pairs that the star rounds left: of crowded groups by rare shingles, of the others pair by pair."""
    crowds = rows.groupBy("group_key").agg(F.count(F.lit(1)).alias("members"))
    crowds = materialize(crowds.where(F.col("members") > CROWD).select("group_key"), "crowds-left")
    if crowds.isEmpty():
        return _all_pairs(rows, size)
    crowded = rows.join(crowds, "group_key", "left_semi").select("set_id", "label", "n").distinct()
    crowded = materialize(crowded, "crowded")
    sets = materialize(_shingle_sets(docs, ids, crowded.select("set_id")), "crowded-sets")
    rare = _near(_near(_rare_pairs(crowded.join(sets, "set_id")), _short(size, LEAST_WORDS)), size)
    others = rows.join(crowds, "group_key", "left_anti")
    return rare.unionAll(_all_pairs(others, size)).distinct()


def _rare_pairs(sets: DataFrame) -> DataFrame:
    """Pairs of different labels that may be similar, from ``(set_id, label, n, shingles)``.

    A similar set lacks at most a fifth of the shingles of a set, so both share one among the first fifth
    and one more, in any order for both.  Here those of one label only come first, which are counted but
    not moved, and then the rarest.
    """
    items = sets.select("set_id", "label", "n", F.explode("shingles").alias("item"))
    shared = (
        items.groupBy("item")
        .agg(F.count(F.lit(1)).alias("f"), F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low != high")
        .select("item", "f")
    )
    most = F.floor(F.col("n") * (BOTTOM - TOP) / BOTTOM)
    rows = (
        items.join(shared, "item")
        .groupBy("set_id", "label", "n")
        .agg(F.array_sort(F.collect_list(F.struct("f", "item")))["item"].alias("common"))
        .withColumn("moved", (most + 1 - F.col("n") + F.size("common")).cast("int"))
        .where("moved > 0")
        .select("set_id", "label", "n", F.explode(F.slice("common", 1, F.col("moved"))).alias("item"))
    )
    columns = ("set_id", "label", "n")
    left = rows.select("item", *[F.col(c).alias(f"{c}_a") for c in columns])
    right = rows.select("item", *[F.col(c).alias(f"{c}_b") for c in columns])
    return (
        left.join(right, "item")
        .where("set_id_a < set_id_b AND label_a != label_b")
        .where(_size_fits("n_a", "n_b"))
        .select(F.col("set_id_a").alias("a"), F.col("set_id_b").alias("b"))
        .distinct()
    )


def _pair_rows(rows: DataFrame, size: DataFrame) -> DataFrame:
    """Rows of the groups with short sketches and the ``FIRST_GROUPS`` smallest groups of their sets."""
    first = F.slice(F.array_sort(F.collect_list("group_key")), 1, FIRST_GROUPS)
    groups = rows.groupBy("set_id").agg(first.alias("groups"))
    return rows.select("group_key", "set_id", "label").join(groups.join(_short(size, LEAST_WORDS), "set_id"), "set_id")


def _all_pairs(rows: DataFrame, size: DataFrame) -> DataFrame:
    """Pairs of one group that are still unconnected and may be similar.

    A pair of several groups is compared in the first that both sets list; pairs without such a group
    may come out of each of theirs.
    """
    rows = _pair_rows(rows, size)
    columns = ("set_id", "label", "s", "groups")
    left = rows.select("group_key", *[F.col(c).alias(f"{c}_a") for c in columns])
    right = rows.select("group_key", *[F.col(c).alias(f"{c}_b") for c in columns])
    first = F.array_min(F.array_intersect("groups_a", "groups_b"))
    pairs = (
        # the rows are far larger here than the file whose size Spark goes by
        left.join(right.hint("merge"), "group_key")
        .where("set_id_a < set_id_b AND label_a != label_b")
        .where((F.coalesce(first, "group_key") == F.col("group_key")) & _may_link("s_a", "s_b"))
        .select(F.col("set_id_a").alias("a"), F.col("set_id_b").alias("b"))
        .distinct()
    )
    return _near(pairs, size)
