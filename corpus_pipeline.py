"""A corpus pipeline of five operators: rules, lines, near duplicates, benchmark passages, mix.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor kept.  All columns
of the input, whatever they are called, reach the end; the mix adds ``copy``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplycast.llm import decontaminate, line_dedup, mixing, ngram_join, quality_rules
from supplycast.llm.frames import fresh, table
from supplycast.sources.scratch import materialize


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed rule and the cutoffs that are safe for their language."""
    counts, kept = fresh("counts", docs), fresh("kept", docs)
    failed, broken = fresh("base_failed", docs), fresh("broken_rules", docs)
    numbers = materialize(
        quality_rules.count(docs.select("doc_id", "lang", "text")).drop("text"), "text-counts"
    )
    cutoffs = quality_rules.calibrate(numbers, table(spark, sf_dir, "labels"), "lang")
    judged = quality_rules.verdicts(
        quality_rules.count(docs, counts=counts),
        materialize(cutoffs, "cutoffs"),
        "lang",
        counts=counts,
        failed=failed,
        kept=kept,
        broken=broken,
    )
    return judged.where(F.col(kept)).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that too many pages of their source share.

    Copies of a text count as one page here, and near copies do not make a line a template, since the
    next stage leaves one of them.
    """
    cleaned, dropped = fresh("cleaned", docs), fresh("n_dropped", docs)
    lines = materialize(line_dedup.template_lines(docs), "boilerplate")
    found = line_dedup.drop_lines(docs, lines, cleaned=cleaned, dropped=dropped)
    new = {"text": F.col(cleaned), "n_chars": F.length(cleaned).cast("long")}
    return found.select(
        *[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns]
    )


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates.

    Groups are formed of texts, so unrelated texts under one id all stay.  Of rows that repeat id and text
    one stays, rows without id stay as they are.
    """
    key, here = fresh("row_key", docs), fresh("kept_key", docs)
    keyed = docs.withColumn(key, F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text")))
    groups = materialize(ngram_join.similar_documents(keyed, doc_id=key), "near-duplicates")
    stays = (
        groups.distinct()
        .join(keyed.select(F.col(key).alias("doc_id"), F.col("doc_id").alias("id")).distinct(), "doc_id")
        .groupBy("component_id")
        .agg(F.min(F.struct("id", F.col("doc_id").alias("key"))).alias("first"))
        .select(F.col("first.key").alias(here))
    )
    kept = keyed.join(stays, F.col(key) == F.col(here)).dropDuplicates([key])
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return kept.select(*columns).unionAll(docs.where(F.col("doc_id").isNull()))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    found = fresh("overlaps", docs)
    marked = decontaminate.find_overlaps(docs, table(spark, sf_dir, "benchmark"), found)
    return marked.where(F.size(found) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix itself: each document as often as it is taken, numbered by ``copy`` from 1."""
    size, number = fresh("size", docs), fresh("copy", docs)
    sized = docs.withColumn(size, mixing.n_words("text"))
    taken, _, _ = mixing.added_names(sized)
    mixed = mixing.copies(sized, size=size).where(F.col(taken) > 0)
    return mixed.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.explode(F.sequence(F.lit(1), F.col(taken).cast("int"))).alias(number),
    )


STAGES = [
    ("quality_rules", apply_quality_rules),
    ("line_dedup", drop_boilerplate),
    ("ngram_join", one_of_each_group),
    ("decontaminate", drop_contaminated),
    ("mixing", mix),
]

#: the calibrated cutoffs, components and seed search have no SQL form; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through all stages, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
