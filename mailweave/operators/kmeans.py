"""Standardised K-Means over numeric columns.

Points stay distributed. The driver sees one row of column statistics, the K
starting points and, per iteration, K rows of sums.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailweave.session import shared_folder

# A column with no more variance than this is constant: its std counts as 1.
MIN_VARIANCE = 1e-9

Centroids = list[list[float]]


class KMeansResult(NamedTuple):
    assignments: DataFrame  # id, cluster
    centroids: Centroids  # standardised units
    means: list[float]
    stds: list[float]
    history: list[float]  # centre movement per iteration


def column_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``feature, mean, std`` of each column: population std, 1 if constant."""
    stats = df.agg(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.avg(F.col(c).cast("double")).alias("mean"),
                _std(F.var_pop(F.col(c).cast("double"))).alias("std"),
            ).alias(f"s{i}")
            for i, c in enumerate(cols)
        ]
    )
    return stats.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(cols))])))


def _std(variance: Column) -> Column:
    return F.when(variance > MIN_VARIANCE, F.sqrt(variance)).otherwise(F.lit(1.0))


def collect_stats(df: DataFrame, cols: Sequence[str]) -> tuple[list[float], list[float]]:
    """Means and stds on the driver, one pair per column."""
    found = {row.feature: row for row in column_stats(df, cols).collect()}
    return [found[c].mean for c in cols], [found[c].std for c in cols]


def standardize(
    df: DataFrame, cols: Sequence[str], means: Sequence[float], stds: Sequence[float]
) -> DataFrame:
    """Replace each column by its z-score."""
    scores = {
        c: (F.col(c).cast("double") - F.lit(mean)) / F.lit(std)
        for c, mean, std in zip(cols, means, stds, strict=True)
    }
    return df.withColumns(scores)


def init_centroids(df: DataFrame, k: int, seed: int = 42, id_col: str = "email") -> DataFrame:
    """K points in the order of the md5 of seed and id.

    The choice depends on the data alone, not on partitions or task order.
    """
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))
    return df.orderBy(key, id_col).limit(k)


def collect_centroids(points: DataFrame, cols: Sequence[str]) -> Centroids:
    """The K starting points on the driver, in their order."""
    return [[row[c] for c in cols] for row in points.collect()]


def nearest(cols: Sequence[str], centroids: Centroids) -> Column:
    """Number of the centre at least squared distance, the lowest on a tie.

    The centres are one typed constant and the point is one array, so the expression has
    the same size whatever K and the number of columns are.
    """
    point = F.array(*[F.col(c) for c in cols])
    centres = F.from_json(F.lit(json.dumps(centroids)), "array<array<double>>")

    def distance(centre: Column) -> Column:
        moves = F.zip_with(point, centre, lambda a, b: (a - b) * (a - b))
        return F.aggregate(moves, F.lit(0.0), lambda total, move: total + move)

    numbered = F.transform(
        centres, lambda centre, i: F.struct(distance(centre).alias("distance"), i.alias("cluster"))
    )
    return F.array_min(numbered)["cluster"]


def complete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The rows in which every column is a finite number."""
    for c in cols:
        value = F.abs(F.col(c).cast("double"))
        df = df.where(value < F.lit(float("inf")))  # neither NULL, NaN nor infinite
    return df


def assign(df: DataFrame, cols: Sequence[str], centroids: Centroids) -> DataFrame:
    return df.withColumn("cluster", nearest(cols, centroids))


def update_centroids(df: DataFrame, cols: Sequence[str], centroids: Centroids) -> Centroids:
    """Mean of the members of each centre; a centre without members stays."""
    means = (
        assign(df, cols, centroids)
        .groupBy("cluster")
        .agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)])
        .collect()
    )
    updated = [list(centre) for centre in centroids]
    for row in means:
        updated[row.cluster] = [row[f"m{i}"] for i in range(len(cols))]
    return updated


def kmeans(
    df: DataFrame,
    cols: Sequence[str],
    k: int = 3,
    iterations: int = 20,
    tol: float = 1e-6,
    seed: int = 42,
    id_col: str = "email",
) -> KMeansResult:
    """Lloyd's algorithm on z-scores, until the centres move less than ``tol``
    (sum of squared moves) or for at most ``iterations``.

    Rows with a NULL, NaN or infinite value have no place among the points: they do not
    enter the fit and get no cluster.
    """
    return kmeans_many(df, cols, [k], iterations, tol, seed, id_col)[k]


def kmeans_many(
    df: DataFrame,
    cols: Sequence[str],
    ks: Sequence[int],
    iterations: int = 20,
    tol: float = 1e-6,
    seed: int = 42,
    id_col: str = "email",
) -> dict[int, KMeansResult]:
    """`kmeans` for several k, on points that are checkpointed, scaled and cached once."""
    shared_folder(df.sparkSession)
    points = complete(df.select(id_col, *[F.col(c).cast("double").alias(c) for c in cols]), cols)
    points = points.checkpoint()
    means, stds = collect_stats(points, cols)
    scaled = standardize(points, cols, means, stds).persist(StorageLevel.MEMORY_AND_DISK)
    fits = {}
    for k in ks:
        centroids, history = _fit(scaled, cols, k, iterations, tol, seed, id_col)
        final = assign(standardize(points, cols, means, stds), cols, centroids)
        fits[k] = KMeansResult(final.select(id_col, "cluster"), centroids, means, stds, history)
    scaled.unpersist()
    return fits


def _fit(scaled, cols, k, iterations, tol, seed, id_col) -> tuple[Centroids, list[float]]:
    centroids = collect_centroids(init_centroids(scaled, k, seed, id_col), cols)
    if len(centroids) < k:
        raise ValueError(f"k={k} but there are only {len(centroids)} points")
    history: list[float] = []
    for _ in range(iterations):
        updated = update_centroids(scaled, cols, centroids)
        history.append(
            sum(
                (a - b) ** 2
                for old, new in zip(centroids, updated, strict=True)
                for a, b in zip(old, new, strict=True)
            )
        )
        centroids = updated
        if history[-1] < tol:
            break
    return centroids, history


def cluster_sizes(assignments: DataFrame) -> DataFrame:
    return assignments.groupBy("cluster").agg(F.count("*").alias("people"))


def cluster_centers_raw(result: KMeansResult, cols: Sequence[str]) -> DataFrame:
    """Centres in the units of the data: ``cluster`` and one column per feature."""
    spark = result.assignments.sparkSession
    units = list(zip(result.stds, result.means, strict=True))
    rows = [
        (number, *[z * std + mean for z, (std, mean) in zip(centre, units, strict=True)])
        for number, centre in enumerate(result.centroids)
    ]
    schema = ", ".join(["cluster int", *[f"`{c}` double" for c in cols]])
    return spark.createDataFrame(rows, schema)


def cluster_profile(
    assignments: DataFrame,
    features: DataFrame,
    cols: Sequence[str],
    k: int,
    labels: dict[int, str] | None = None,
    id_col: str = "email",
) -> DataFrame:
    """``k, cluster, label, people`` and the mean of each feature per cluster."""
    label = F.lit(None).cast("string")
    for number, name in (labels or {}).items():
        label = F.when(F.col("cluster") == number, F.lit(name)).otherwise(label)
    profile = (
        assignments.join(features, id_col)
        .groupBy("cluster")
        .agg(F.count("*").alias("people"), *[F.avg(c).alias(c) for c in cols])
    )
    return profile.select(F.lit(k).alias("k"), "cluster", label.alias("label"), "people", *cols)


def cluster_crosstab(left: DataFrame, right: DataFrame, id_col: str = "email") -> DataFrame:
    """People per pair of clusters of two clusterings."""
    return (
        left.withColumnRenamed("cluster", "left_cluster")
        .join(right.withColumnRenamed("cluster", "right_cluster"), id_col)
        .groupBy("left_cluster", "right_cluster")
        .agg(F.count("*").alias("people"))
    )
