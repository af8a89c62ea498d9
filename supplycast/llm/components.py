"""Connected components of a link table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplycast.sources.scratch import materialize


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``(node, label)`` for every node of a link; nodes reachable from each other share the label.

    In each round every node joins the neighbour (or itself) with the smallest hash, links between
    joined nodes vanish, and the rest is deduplicated.  The order changes from round to round, so long
    chains shrink by a constant share as well, and all minima are summed before the shuffle, so a node
    with most links is no bottleneck.  Each round is written, which cuts the lineage.
    """
    edges = materialize(
        links.select(F.col(left).alias("u"), F.col(right).alias("v"))
        .where("u IS NOT NULL AND v IS NOT NULL AND u != v")
        .distinct(),
        "links",
    )
    nodes = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    labels = nodes.select("node", F.col("node").alias("label"))
    number = 0
    while not edges.isEmpty():
        number += 1
        both = edges.select("u", "v").unionAll(edges.select(F.col("v"), F.col("u")))
        near = F.struct(F.xxhash64("v", F.lit(number)).alias("hash"), F.col("v").alias("into"))
        own = F.struct(F.xxhash64("u", F.lit(number)).alias("hash"), F.col("u").alias("into"))
        step = materialize(
            both.groupBy("u")
            .agg(F.min(near).alias("near"))
            .select(F.col("u").alias("node"), F.least("near", own)["into"].alias("into")),
            "contraction",
        )
        labels = materialize(
            labels.join(step.withColumnRenamed("node", "label"), "label", "left").select(
                "node", F.coalesce("into", "label").alias("label")
            ),
            "labels",
        )
        at_u = step.select(F.col("node").alias("u"), F.col("into").alias("new_u"))
        at_v = step.select(F.col("node").alias("v"), F.col("into").alias("new_v"))
        edges = materialize(
            edges.join(at_u, "u")
            .join(at_v, "v")
            .where("new_u != new_v")
            .select(
                F.least("new_u", "new_v").alias("u"), F.greatest("new_u", "new_v").alias("v")
            )
            .distinct(),
            "links",
        )
    return labels
