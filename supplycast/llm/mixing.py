"""Mix sources to target weights by systematic sampling.

Every document of a source expects the same number of copies, the source's target divided by its size.
The running sum of these expectations, in order of document size, crosses an integer once per copy;
one random offset per source decides where.  A document gets the expectation rounded down or up, and
because neighbours in the order have about the same size, the words taken stay close to the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplycast.llm.frames import fresh

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
SEED = 20
#: documents of one size class are numbered in 16 to the power of this many parts
PART_DIGITS = 2


def n_words(text: str) -> Column:
    return F.coalesce(
        F.size(F.regexp_extract_all(F.col(text), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))), F.lit(0)
    ).cast("long")


def targets(
    sizes: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """``(source, source_size, target)`` from one row ``(source, source_size)`` per source.

    Weights go round over the sources in the order of their names' code points, null last.  Targets
    share the total by weight; what would exceed ``most`` times a source's size is shared again among
    the others until none exceeds.  The sources that reach their limit are those with the smallest
    size per weight, so one pass over the sources in that order finds the final level.
    """
    everything = Window.partitionBy(F.lit(1))  # one row per source
    by_name = everything.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    weight = F.array(*[F.lit(w) for w in weights])[(F.row_number().over(by_name) - 1) % len(weights)]
    tight = everything.orderBy(
        F.col("source_size").cast("double") / F.col("weight"), F.col("place")
    )
    before = tight.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    ranked = (
        sizes.withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", weight.cast("long"))
        .select(
            "*",
            F.coalesce(F.sum(F.col("source_size") * most).over(before), zero).alias("capped"),
            F.sum("source_size").over(everything).alias("total"),
            (
                F.sum("weight").over(everything)
                - F.coalesce(F.sum("weight").over(before), zero)
            ).alias("left_weight"),
        )
        .withColumn("left_size", F.greatest(zero, F.col("total") - F.col("capped")))
    )
    fits = F.col("left_size") * F.col("weight") <= most * F.col("source_size") * F.col("left_weight")
    first = F.min(F.when(fits, F.struct(F.col("capped"), "left_size", "left_weight")))
    level = first.over(everything)
    share = (level["left_size"] * F.col("weight")).cast("double") / level["left_weight"]
    limit = (most * F.col("source_size")).cast("double")
    return ranked.select(
        "source", "source_size", F.coalesce(F.least(share, limit), limit).alias("target")
    )


def offset(source: Column, seed: int) -> Column:
    """Uniform number in [0, 1) that depends on the name and the seed only."""
    name = F.md5(F.encode(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("\0null"))), "UTF-8"))
    return F.conv(F.substring(name, 1, 8), 16, 10).cast("double") / 4294967296.0


def added_names(docs: DataFrame) -> tuple[str, str, str]:
    """Names of the added columns: copies, source size, target."""
    return fresh("copies", docs), fresh("source_size", docs), fresh("target", docs)


def copies(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    source: str = "source",
    size: str = "size",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` plus ``source_size``, ``target`` and ``copies``, how often the mix takes the row.

    Where ``docs`` has such a column already, the added one gets the name that ``added_names`` tells.
    ``size`` is a word count.  Rows of size 0 count zero words whatever their copies; a source of size
    0 takes nothing.  Rows with a null id or repeated rows are documents like any other (ties among
    equal rows decide which of them gets the extra copy, not how many do).

    Numbering is spread over size classes and hash parts, so a source that holds most rows is not
    sorted by one task: rows are numbered within their part, and the counts of the parts before it are
    added.
    """
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    want = targets(sizes, weights=weights, most=most)
    names = {
        n: fresh(n, docs)
        for n in ("source_key", "size_class", "part", "n_before", "rank_in")
    }
    # never null, so the numbering and the join share one partitioning
    spelled = F.when(F.col(source).isNull(), "null").otherwise(F.concat(F.lit("="), F.col(source)))
    # eight classes to each doubling
    scale = F.floor(F.log(F.col(size) + 1.0) * 12).cast("int")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    part = F.substring(F.md5(F.encode(name, "UTF-8")), 1, PART_DIGITS)
    key = [names["source_key"], names["size_class"], names["part"]]
    spread = docs.select("*", *[e.alias(n) for e, n in zip((spelled, scale, part), key, strict=True)])
    counts = spread.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    in_order = (
        Window.partitionBy(key[0])  # classes and parts of a source, not its rows
        .orderBy(*key[1:])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    n_copies, total, goal = added_names(docs)
    goals = want.select(
        F.when(F.col("source").isNull(), "null")
        .otherwise(F.concat(F.lit("="), F.col("source")))
        .alias(key[0]),
        F.col("source_size").alias(total),
        F.col("target").alias(goal),
    )
    starts = counts.select(
        *key, F.coalesce(F.sum("n").over(in_order), F.lit(0)).alias(names["n_before"])
    ).join(goals, key[0])
    within = Window.partitionBy(*key).orderBy(size, doc_id)
    ranked = spread.withColumn(names["rank_in"], F.row_number().over(within))
    joined = ranked.join(starts, key)
    each = F.when(F.col(total) > 0, F.col(goal) / F.col(total)).otherwise(0.0)
    rank = F.col(names["n_before"]) + F.col(names["rank_in"])
    start = offset(F.col(source), seed)
    crossed = F.floor(start + rank * each) - F.floor(start + (rank - 1) * each)
    return joined.select(
        *[F.col(f"`{c}`") for c in docs.columns], total, goal, crossed.cast("long").alias(n_copies)
    )
