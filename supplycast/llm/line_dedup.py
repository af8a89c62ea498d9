"""Boilerplate lines by site-relative frequency.

A line is boilerplate on a host when more than ``ratio`` of the host's pages contain it (and at least
``min_pages`` of them, since on a host of one page every line is on all pages).  Only such lines,
never whole pages, are dropped.  `template_lines` finds them at a low share without taking near copies of a
text for a template.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplycast.llm.frames import fresh
from supplycast.sources.scratch import materialize

RATIO = 0.1
MIN_PAGES = 5
#: share of a site's distinct pages from which on `template_lines` takes a line as a template
SHARE = 0.01
#: characters of a blank line
BLANKS = " \t\n\x0b\x0c\r"
#: pages with a larger share of frequent lines (in bytes) count as copies of each other
COPIED = 0.5


def _lines(text: str) -> Column:
    return F.split(_whole(text), "\n", -1)


def _identity(line: Column) -> Column:
    """Lines compare by this hash and their length in bytes."""
    return F.struct(F.xxhash64(line).alias("hash"), F.octet_length(line).alias("bytes"))


def boilerplate(
    pages: DataFrame,
    *,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    distinct: bool = False,
) -> DataFrame:
    """``(host, lines)``: identities of the boilerplate lines of each host that has any.

    With ``distinct`` rows of one host with the same text count as one page, in the pages that have
    the line and in the host's total.  Counts are summed before the shuffle, so a host with most pages or
    a line on most pages costs one row per task, or one per text.  A host has at most its lines per page
    divided by ``ratio`` such lines.
    """
    return _frequent(pages, _totals(pages, host, text, distinct), host, text, ratio, min_pages, distinct)


def template_lines(
    pages: DataFrame,
    *,
    host: str = "source",
    text: str = "text",
    ratio: float = SHARE,
    min_pages: int = MIN_PAGES,
    copied: float = COPIED,
) -> DataFrame:
    """``(host, lines)`` as in `boilerplate`, with a low share that near copies of a text do not reach.

    Distinct texts count as pages.  The lines of a group of near copies are as frequent as those of a
    template, but a template stands on pages that otherwise differ.  So the frequent lines are counted
    again, without the pages that consist of frequent lines for more than ``copied`` of their bytes,
    against the same total.  Lines of a group of copies are thus kept, and a template that
    makes up more than that share of each of its pages is kept, too.
    """
    totals = materialize(_totals(pages, host, text, True), "site-pages")
    first = materialize(_frequent(pages, totals, host, text, ratio, min_pages, True), "frequent-lines")
    key, often = fresh("host_of_lines", pages), fresh("frequent_lines", pages)
    found = first.select(F.col("host").alias(key), F.col("lines").alias(often))
    known = F.filter(_lines(text), lambda x: F.array_contains(F.col(often), _identity(x)))
    own = (
        pages.select(host, text)
        .join(found, F.col(host).eqNullSafe(F.col(key)))
        .where(_bytes(known) <= F.lit(copied) * _bytes(_lines(text)))
        .select(host, text)
    )
    return _frequent(own, totals, host, text, ratio, min_pages, True)


def _bytes(lines: Column) -> Column:
    return F.aggregate(lines, F.lit(0), lambda n, x: n + F.octet_length(x))


def _totals(pages: DataFrame, host: str, text: str, distinct: bool) -> DataFrame:
    """Pages of each host."""
    named = pages.select(F.col(host).alias("total_host"), _identity(_whole(text)).alias("page"))
    return (named.distinct() if distinct else named).groupBy("total_host").agg(
        F.count(F.lit(1)).alias("pages")
    )


def _frequent(
    pages: DataFrame,
    totals: DataFrame,
    host: str,
    text: str,
    ratio: float,
    min_pages: int,
    distinct: bool,
) -> DataFrame:
    line = F.explode(
        F.array_distinct(F.filter(_lines(text), lambda x: F.trim(x, F.lit(BLANKS)) != ""))
    )
    rows = pages.select(
        F.col(host).alias("host"),
        *([_identity(_whole(text)).alias("page")] if distinct else []),
        line.alias("line"),
    ).withColumn("line", _identity(F.col("line")))
    having = (
        (rows.distinct() if distinct else rows)
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("having"))
        .where(F.col("having") >= min_pages)
    )
    return (
        having.join(totals, F.col("host").eqNullSafe(F.col("total_host")))
        .where(F.col("having") > F.lit(ratio) * F.col("pages"))
        .groupBy("host")
        .agg(F.collect_set("line").alias("lines"))
    )


def _whole(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def drop_lines(
    pages: DataFrame,
    lines: DataFrame,
    *,
    host: str = "source",
    text: str = "text",
    cleaned: str = "cleaned",
    dropped: str = "n_dropped",
) -> DataFrame:
    """All columns and rows of ``pages`` plus the cleaned text and the number of dropped lines.

    Every occurrence of a boilerplate line goes; the other lines keep their order and line breaks.
    Blank lines, those of files with carriage returns included, are never boilerplate.  Null texts stay null; pages without host form a site of their
    own; repeated rows count as pages and are all kept.
    """
    key, bad = fresh("host_of_lines", pages), fresh("boilerplate_lines", pages)
    found = lines.select(F.col("host").alias(key), F.col("lines").alias(bad))
    joined = pages.join(found, F.col(host).eqNullSafe(F.col(key)), "left")
    kept = F.filter(_lines(text), lambda x: ~F.array_contains(F.col(bad), _identity(x)))
    changed = F.col(bad).isNotNull() & F.col(text).isNotNull()
    return joined.select(
        *[F.col(f"`{c}`") for c in pages.columns],
        F.when(changed, F.array_join(kept, "\n")).otherwise(F.col(text)).alias(cleaned),
        F.when(changed, F.size(_lines(text)) - F.size(kept))
        .otherwise(0)
        .cast("long")
        .alias(dropped),
    )
