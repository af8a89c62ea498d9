"""Supplier profiles: scaling, k-means, linkage on micro-clusters, choice of k."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplycast.functions import linkage
from supplycast.sources.scratch import materialize

FEATURES = [
    "n_products",
    "n_categories",
    "avg_price",
    "price_range",
    "avg_shipping",
    "avg_score",
    "avg_distance",
]


def zscore(df: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    """Centred by the mean, divided by the sample deviation; a constant column gives 0."""
    stats = df.agg(
        F.struct(
            *[F.avg(c).alias(f"m_{c}") for c in columns],
            *[F.stddev_samp(c).alias(f"s_{c}") for c in columns],
        )
    ).scalar()
    scaled = {
        c: F.coalesce(F.try_divide(F.col(c) - stats[f"m_{c}"], stats[f"s_{c}"]), F.lit(0.0))
        for c in columns
    }
    return df.withColumns({f"z_{c}": expr for c, expr in scaled.items()})


def with_vector(
    kpis: DataFrame, columns: list[str] = FEATURES, order_by: str = "seller_id"
) -> DataFrame:
    """Scaled features as one vector column.

    KPIs and features are written once: the scaling reads the KPIs twice and
    the iterative fits read the features many times, and neither may start
    over from the items.  The rows are ordered, because random starts depend
    on where a row lies.
    """
    scaled = zscore(materialize(kpis, "kpis"), columns)
    vector = array_to_vector(F.array(*[f"z_{c}" for c in columns]))
    return materialize(scaled.orderBy(order_by), "features").withColumn("features", vector)


def nearest_centre(df: DataFrame, columns: list[str], centres: list[list[float]]) -> DataFrame:
    """Label of the nearest given centre, counted from 1; ties go to the first."""

    def squared(centre):
        return reduce(
            lambda a, b: a + b, [F.pow(F.col(c) - F.lit(v), 2) for c, v in zip(columns, centre)]
        )

    choices = F.array(
        *[
            F.struct(squared(centre).alias("d"), F.lit(i + 1).alias("label"))
            for i, centre in enumerate(centres)
        ]
    )
    return df.withColumn("cluster", F.array_min(choices)["label"].cast("string"))


def fit_kmeans(df: DataFrame, k: int, seeds: range = range(10)) -> KMeansModel:
    """Best of several random starts by within-cluster cost."""
    return fit_all(df, [(k, seed) for seed in seeds], init="random")[k]


def fit_all(
    df: DataFrame,
    starts: list[tuple[int, int]],
    init: str = "k-means||",
    max_iter: int = 50,
    threads: int = 8,
) -> dict[int, KMeansModel]:
    """Best model per k over ``(k, seed)`` starts, fitted side by side.

    The fits are many short jobs; submitting several at once keeps the
    executors busy between their iterations.  They share one copy of the vectors.
    """
    vectors = df.select("features").persist()

    def fit(start: tuple[int, int]) -> KMeansModel:
        return KMeans(k=start[0], seed=start[1], maxIter=max_iter, initMode=init).fit(vectors)

    try:
        with ThreadPoolExecutor(threads) as pool:
            models = list(pool.map(inheritable_thread_target(df.sparkSession)(fit), starts))
    finally:
        vectors.unpersist()
    best: dict[int, KMeansModel] = {}
    for (k, _), model in zip(starts, models):
        if k not in best or model.summary.trainingCost < best[k].summary.trainingCost:
            best[k] = model
    return best


def stable_labels(df: DataFrame, prediction: str, order_by: str) -> DataFrame:
    """Clusters renumbered from 1 by size, then by the mean of ``order_by``."""
    sizes = df.groupBy(prediction).agg(
        F.count("*").alias("n"), F.avg(order_by).alias("m"), F.lit(0).alias("_all")
    )
    # one row per cluster: the list is as short as k
    ranked = sizes.groupBy("_all").agg(
        F.array_sort(F.collect_list(F.struct("n", "m", F.col(prediction).alias("p")))).alias("_o")
    )
    names = ranked.select(F.posexplode("_o").alias("_i", "_s")).select(
        F.col("_s.p").alias(prediction), (F.col("_i") + 1).cast("string").alias("cluster")
    )
    return df.join(names, prediction).drop(prediction)


def kmeans_labels(
    features: DataFrame, k: int = 3, seeds: range = range(10), order_by: str = "z_avg_price"
) -> DataFrame:
    model = fit_kmeans(features, k, seeds)
    return stable_labels(model.transform(features), "prediction", order_by).drop("features")


def hierarchical_labels(
    features: DataFrame,
    cuts: dict[str, tuple[str, int]],
    columns: list[str] = FEATURES,
    micro: int = 400,
    seed: int = 7,
) -> DataFrame:
    """Ward or centroid linkage, cut at given sizes: ``{column: (method, k)}``.

    Rows are condensed to at most ``micro`` k-means cells that start from drawn
    rows; the linkage runs on the weighted cell centres.  With no more distinct
    rows than cells the same steps make each its own cell, so the linkage is exact.
    """
    z = [f"z_{c}" for c in columns]
    model = KMeans(k=micro, seed=seed, maxIter=20, initMode="random").fit(features)
    cell_of = model.transform(features).withColumnRenamed("prediction", "_cell")
    means = cell_of.groupBy("_cell").agg(
        F.count("*").alias("n"), *[F.avg(c).alias(c) for c in z]
    )
    cells = means.orderBy("_cell").collect()
    weights = np.array([r["n"] for r in cells], float)
    centres = np.array([[r[c] for c in z] for r in cells], float)
    labels = {
        column: linkage.cut(linkage.merge(centres, weights, method), len(cells), k)
        for column, (method, k) in cuts.items()
    }
    rows = [
        (r["_cell"], *(str(labels[column][i]) for column in cuts)) for i, r in enumerate(cells)
    ]
    schema = "_cell int, " + ", ".join(f"{column} string" for column in cuts)
    table = features.sparkSession.createDataFrame(rows, schema)
    return cell_of.join(table, "_cell").drop("_cell", "features")


# -- choice of k ----------------------------------------------------------------------------


def _scatter_terms(z: list[str]) -> list:
    return [
        F.sum(F.col(a) * F.col(b)).alias(f"p{i}_{j}")
        for i, a in enumerate(z)
        for j, b in enumerate(z)
        if i <= j
    ]


def cluster_moments(labelled: DataFrame, columns: list[str]) -> DataFrame:
    """Size, sums and cross-products per (k, cluster): all the indices need."""
    z = [f"z_{c}" for c in columns]
    return labelled.groupBy("k", "prediction").agg(
        F.count("*").alias("n"), *[F.sum(c).alias(f"s_{c}") for c in z], *_scatter_terms(z)
    )


def choose_k(
    features: DataFrame,
    candidates: range = range(3, 7),
    columns: list[str] = FEATURES,
    seeds: range = range(10),
) -> DataFrame:
    """Validity indices per k and the number of votes each k receives.

    One k-means per k (one more on either side, for the indices that compare
    neighbours); a single aggregation yields the cross-products, at most
    sum(k) rows, from which the indices follow.
    """
    spark = features.sparkSession
    z = [f"z_{c}" for c in columns]
    wide = range(max(1, candidates.start - 1), candidates.stop + 1)
    parts, silhouette = [], {}
    evaluator = ClusteringEvaluator()
    models = fit_all(features, [(k, seed) for k in wide if k > 1 for seed in seeds])
    for k in wide:
        if k == 1:
            parts.append(features.select(*z, F.lit(0).alias("prediction"), F.lit(1).alias("k")))
            continue
        labelled = models[k].transform(features)
        if k in candidates:
            silhouette[k] = evaluator.evaluate(labelled)
        parts.append(labelled.select(*z, "prediction", F.lit(k).alias("k")))
    moments = cluster_moments(reduce(DataFrame.unionByName, parts), columns).collect()
    indices = linkage.validity_indices(
        [r.asDict() for r in moments], z, list(candidates), silhouette
    )
    rows = [
        (k, name, float(value) if math.isfinite(value) else None, bool(best))
        for name, values in indices.items()
        for k, value, best in values
    ]
    return spark.createDataFrame(rows, "k int, index_name string, value double, chosen boolean")


def votes(indices: DataFrame) -> DataFrame:
    return indices.groupBy("k").agg(F.sum(F.col("chosen").cast("int")).alias("votes"))


def profile(df: DataFrame, label: str, columns: list[str]) -> DataFrame:
    """Size, share and mean KPIs per cluster."""
    sizes = df.groupBy(label).agg(
        F.count("*").alias("n"), *[F.avg(c).alias(f"mean_{c}") for c in columns]
    )
    total = sizes.agg(F.sum("n")).scalar()
    return sizes.withColumn("share", F.col("n") / total)
