"""Registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from supplycast.llm import (
    decontaminate,
    hard_negatives,
    licenses,
    line_dedup,
    mixing,
    nearest_neighbours,
    ngram_join,
    periodic_runs,
    quality_classifier,
    quality_rules,
    suffix_dedup,
    toxicity,
    warc,
)
from supplycast.llm.frames import table
from supplycast.sources.scratch import materialize, scratch_path

WORD = r"[^\x20\x09-\x0D]+"


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    counted = materialize(quality_rules.count(docs).drop("text"), "text-counts")
    cutoffs = quality_rules.calibrate(counted, table(spark, folder, "labels"), "lang")
    judged = quality_rules.verdicts(counted, cutoffs, "lang")
    return judged.select(
        "doc_id",
        "counts.n_words",
        "counts.word_chars",
        "counts.n_symbols",
        "counts.n_dup_lines",
        "counts.n_repeat_words",
        "base_failed",
        "kept",
        F.array_join("broken_rules", ",").alias("broken_rules"),
    )


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    index = warc.write_archives(pages, scratch_path(spark, "warc"))
    index = materialize(index, "warc-index")
    kind = pages.schema["page_id"].dataType
    return warc.read_archives(index, with_payload=False).select(
        F.col("page").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op3_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, folder, "documents"))


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.summary(table(spark, folder, "documents"))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    return docs.select("doc_id", toxicity.severity_of(model).alias("s")).select(
        "doc_id",
        "s.score",
        "s.expected_severity",
        "s.grade",
        (F.col("s.score") >= toxicity.TOXIC_AT).cast("int").alias("predicted"),
    )


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    lines = materialize(line_dedup.template_lines(docs), "boilerplate")
    return line_dedup.drop_lines(docs, lines).select(
        "doc_id", "source", "n_dropped", F.col("cleaned").alias("text")
    )


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    weights = quality_classifier.fit(docs, table(spark, folder, "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % quality_classifier.HELD_OUT == 0
    return docs.select(
        "doc_id", held_out.alias("held_out"), quality_classifier.score_of(weights).alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_overlaps(docs, table(spark, folder, "benchmark"), "overlaps")
    return found.select("doc_id", F.explode("overlaps").alias("o")).select("doc_id", "o.*")


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(
        "doc_id", "source", mixing.n_words("text").alias("size")
    )
    return mixing.copies(materialize(docs, "sizes")).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
    )


def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return docs.select("doc_id", licenses.licenses_of().alias("l")).select("doc_id", "l.*")


def looped(doc: str = "doc_id", text: str = "text") -> Column:
    """The text, but for each tenth document (by checksum) from some word on a repeated block of words.

    Rows without id stay as they are.
    """
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    checksum = F.crc32(F.col(doc).cast("string"))
    g, n = F.floor(checksum / 10), F.when(F.size(words) > 0, F.size(words))
    a = g % n
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    block = F.slice(words, (a + 1).cast("int"), p)
    copies = F.flatten(F.array_repeat(block, F.ceil((n - a) / p).cast("int")))
    made = F.concat(
        F.slice(words, F.lit(1), a.cast("int")), F.slice(copies, F.lit(1), (n - a).cast("int"))
    )
    chosen = (checksum % 10 == 0) & n.isNotNull()
    return F.when(chosen, F.array_join(made, " ")).otherwise(F.col(text))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", looped().alias("text"))
    found = docs.select("doc_id", periodic_runs.periodic_runs().alias("r")).select("doc_id", "r.*")
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r.alias("run")))
    )["run"]
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return nearest_neighbours.nearest_neighbours(vectors, F.col("vec_id") % 20 == 0)


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0, label)


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_warc,
        op3_ngram_join,
        op4_suffix_dedup,
        op5_toxicity,
        op6_line_dedup,
        op7_quality_classifier,
        op8_decontaminate,
        op9_mixing,
        op10_licenses,
        op11_periodic_runs,
        op12_nearest_neighbours,
        op13_hard_negatives,
    )
}
