"""Graphs derived from the edge multiset.

Edges stay long: one row per pair, never one row per person with a list, so a
mailbox with millions of correspondents is many small rows and not a giant one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailweave.functions import quarter_of


def simple_graph(edges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct ``(by…, src, dst)`` without self-loops."""
    return edges.where(F.col("src") != F.col("dst")).select(*by, "src", "dst").distinct()


def with_quarter(edges: DataFrame) -> DataFrame:
    """Edges of a known month, with their ``quarter``."""
    return edges.withColumn("quarter", quarter_of(F.col("ym"))).where(
        F.col("quarter").isNotNull()
    )


def edge_weights(
    edges: DataFrame, mode: str = "freq", cc_weight: float = 0.5, by: Sequence[str] = ()
) -> DataFrame:
    """Weight ``w`` per pair: To counts 1, Cc counts ``cc_weight``.

    ``freq`` keeps the sum, ``log`` damps it to ``1 + ln(1 + sum)``.
    """
    if mode not in ("freq", "log"):
        raise ValueError(f"mode must be 'freq' or 'log', not {mode!r}")
    copy = F.when(F.col("type") == "cc", F.lit(float(cc_weight))).otherwise(F.lit(1.0))
    pairs = (
        edges.where(F.col("src") != F.col("dst"))
        .groupBy(*by, "src", "dst")
        .agg(F.sum(copy).alias("w"))
    )
    return pairs if mode == "freq" else pairs.withColumn("w", 1.0 + F.log1p("w"))


def _ends(graph: DataFrame, by: Sequence[str], weights: Mapping[str, str | None]) -> DataFrame:
    """One row per end of an edge, the source end carrying degree and weights."""
    own = {name: F.col(w).cast("double") if w else F.lit(1.0) for name, w in weights.items()}

    def end(node: str, degree: int, strength: Mapping[str, Column]) -> Column:
        return F.struct(
            F.col(node).alias("id"),
            F.lit(degree).cast("bigint").alias("out_degree"),
            *(value.alias(name) for name, value in strength.items()),
        )

    none = dict.fromkeys(weights, F.lit(0.0))
    return graph.select(*by, F.inline(F.array(end("src", 1, own), end("dst", 0, none))))


def node_strengths(
    graph: DataFrame, by: Sequence[str], weights: Mapping[str, str | None]
) -> DataFrame:
    """Every node with ``out_degree`` and, by the names given, the sums of weight columns that it
    sends (0 where it never sends); a weight of None is 1 for every edge.

    One pass, one shuffle on the node; sums are combined before it, so a hub
    costs each task one row.
    """
    sums = [F.sum(name).alias(name) for name in ("out_degree", *weights)]
    return _ends(graph, by, weights).groupBy(*by, "id").agg(*sums)


def node_strength(
    graph: DataFrame, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Every node with ``out_degree`` and ``out_weight`` (0 where it never sends)."""
    return node_strengths(graph, by, {"out_weight": weight})


def nodes(graph: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct ``id`` of sources and targets."""
    return graph.select(*by, F.explode(F.array("src", "dst")).alias("id")).distinct()


def out_strength(
    graph: DataFrame, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """``out_degree`` and ``out_weight`` of every source."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    return graph.groupBy(*by, F.col("src").alias("id")).agg(
        F.count("*").alias("out_degree"), F.sum(w).alias("out_weight")
    )


def dangling_nodes(graph: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Nodes that only receive."""
    return node_strength(graph, by).where(F.col("out_degree") == 0).select(*by, "id")


def quarter_sizes(edges: DataFrame) -> DataFrame:
    """Quarters with their number of distinct edges."""
    return (
        simple_graph(with_quarter(edges), by=["quarter"])
        .groupBy("quarter")
        .agg(F.count("*").alias("edges"))
    )
