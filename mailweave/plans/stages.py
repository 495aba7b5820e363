"""The jobs a user runs, each reading and writing tables under one folder.

    ingest        messages           -> parsed, edges, persons, metrics
    rank_people   edges              -> ranks/<mode>, top/<mode>
    rank_quarters edges, top/basic   -> ranks/quarterly, top/quarterly, tracked
    cluster_people parsed            -> features, clusters/k=<k>, profiles/k=<k>

The ranking jobs also take any edge list, and the clustering job any feature table, by
its path and format (parquet or tsv). The message text is read once, by ``ingest``; the other jobs read only the
parquet columns they need and can be repeated or run side by side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from mailweave import operators as op
from mailweave.operators.features import FEATURES
from mailweave.sources import (
    read_edges,
    read_features,
    read_ranking,
    write_edges,
    write_features,
    write_persons,
    write_result,
)


def ingest(spark: SparkSession, messages: DataFrame, folder: str, **parse_options) -> DataFrame:
    """Parse the mails, write the stage tables and return the quality report."""
    parsed_path = f"{folder}/parsed"
    op.parse_messages(messages, **parse_options).write.mode("overwrite").parquet(parsed_path)
    parsed = spark.read.parquet(parsed_path)
    write_edges(op.build_edges(parsed), f"{folder}/edges")
    write_persons(op.persons(parsed), f"{folder}/persons")
    metrics_path = f"{folder}/metrics"
    op.ingest_metrics(parsed).write.mode("overwrite").parquet(metrics_path)
    return spark.read.parquet(metrics_path)


def rank_people(
    spark: SparkSession,
    folder: str,
    mode: str = "basic",
    iterations: int = 10,
    k: int = 20,
    edges: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """PageRank of the whole graph; ``mode`` is basic, freq or log. Returns the top k.

    ``edges`` is the path of an edge list in ``fmt``; the default is the ingested one.
    """
    path = edges or f"{folder}/edges"
    if mode == "basic":
        graph = op.simple_graph(read_edges(spark, path, fmt, fields=2))
        ranks = op.pagerank(graph, iterations=iterations)
    else:
        graph = op.edge_weights(read_edges(spark, path, fmt, fields=3), mode)
        ranks = op.pagerank(graph, weight="w", iterations=iterations)
    op.check_mass(ranks)
    ranks.write.mode("overwrite").parquet(f"{folder}/ranks/{mode}")
    top = op.top_k(ranks, k)
    write_result(top, f"{folder}/top/{mode}", header=False, single=True)
    return top


def rank_quarters(
    spark: SparkSession,
    folder: str,
    iterations: int = 10,
    k: int = 20,
    seeds: int = 5,
    edges: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """PageRank of every quarter in one job; the series of the basic job's first
    ``seeds`` places is written and returned."""
    emails = op.seed_emails(read_ranking(spark, f"{folder}/top/basic", seeds), seeds)
    dated = op.with_quarter(read_edges(spark, edges or f"{folder}/edges", fmt))
    ranks = op.pagerank(
        op.simple_graph(dated, by=["quarter"]), by=["quarter"], iterations=iterations
    )
    op.check_mass(ranks, ["quarter"])
    ranks.write.mode("overwrite").parquet(f"{folder}/ranks/quarterly")
    top = op.top_k(ranks, k, ["quarter"]).orderBy("quarter", "rank")
    write_result(top, f"{folder}/top/quarterly", single=True)
    series = op.track(ranks, emails)
    write_result(series.orderBy("quarter"), f"{folder}/tracked", single=True)
    return series


def cluster_people(
    spark: SparkSession,
    folder: str,
    ks: Sequence[int] = (3, 4),
    iterations: int = 20,
    labels: dict[int, dict[int, str]] | None = None,
    features_path: str | None = None,
    fmt: str = "parquet",
) -> dict[int, op.KMeansResult]:
    """Features and one K-Means per k, with assignments and profiles written.

    ``features_path`` is the path of a feature table in ``fmt``; the default is to derive it
    from the parsed mails.
    """
    if features_path is None:
        features_path, fmt = f"{folder}/features", "parquet"
        write_features(op.person_features(spark.read.parquet(f"{folder}/parsed")), features_path)
    features = read_features(spark, features_path, fmt)
    fits = op.kmeans_many(features, FEATURES, ks, iterations)
    for k in ks:
        members = fits[k].assignments
        write_result(members, f"{folder}/clusters/k={k}")
        names = (labels or {}).get(k)
        profile = op.cluster_profile(members, features, FEATURES, k, names)
        write_result(profile.orderBy("cluster"), f"{folder}/profiles/k={k}", single=True)
    return fits
