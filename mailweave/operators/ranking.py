"""Rankings and time series read off rank vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Up to this k, Spark limits a ranking per group in the tasks before the shuffle.
GROUP_LIMIT_SETTING = "spark.sql.optimizer.windowGroupLimitThreshold"

# Parts of a slice where k is larger.
SLICE_PARTS = 64

# Scores equal to this many digits tie; ties go to the smaller address.
TIE_DIGITS = 12


def _best_first():
    return [F.round("rank", TIE_DIGITS).desc(), F.col("id").asc()]


def _first(ranks: DataFrame, k: int, by: Sequence[str]) -> DataFrame:
    """The k best of each group, numbered in ``place``."""
    window = Window.partitionBy(*by).orderBy(*_best_first())
    return ranks.withColumn("place", F.row_number().over(window)).where(F.col("place") <= k)


def top_k(ranks: DataFrame, k: int = 20, by: Sequence[str] = ()) -> DataFrame:
    """The k best per slice as ``(by…, rank, email, pagerank)``, numbered from 1.

    Without slices each task keeps its own k best and only those are merged.
    With slices, Spark limits each task to its k best per slice before the
    shuffle, so a large slice arrives as k rows per task. It does so up to a
    certain k; beyond, the slice is first cut into parts, each with its k best.
    """
    if by:
        limit = ranks.sparkSession.conf.get(GROUP_LIMIT_SETTING, "1000")
        if k > int(limit):
            part = F.pmod(F.xxhash64("id"), F.lit(SLICE_PARTS))
            ranks = _first(ranks.withColumn("_part", part), k, [*by, "_part"])
        numbered = _first(ranks, k, by)
    else:
        best = ranks.orderBy(*_best_first()).limit(k)
        numbered = best.withColumn("place", F.row_number().over(Window.orderBy(*_best_first())))
    return numbered.select(
        *by,
        F.col("place").alias("rank"),
        F.col("id").alias("email"),
        F.col("rank").alias("pagerank"),
    )


def seed_emails(ranking: DataFrame, n: int = 5) -> list[str]:
    """Addresses of the first n places of a ranking, best first."""
    rows = ranking.where(F.col("rank") <= n).orderBy("rank").select("email").collect()
    if not rows:
        raise ValueError("the ranking has no places to track")
    return [row.email for row in rows]


def track(ranks: DataFrame, seeds: Sequence[str], by: str = "quarter") -> DataFrame:
    """Score of each seed in every slice, 0.0 where absent: ``(by, email, pagerank)``.

    One aggregation by slice with one column per seed, turned to rows at the end.
    """
    scores = [
        F.coalesce(F.sum(F.when(F.col("id") == seed, F.col("rank"))), F.lit(0.0)) for seed in seeds
    ]
    wide = ranks.groupBy(by).agg(F.array(*scores).alias("scores"))
    points = [
        F.struct(F.lit(seed).alias("email"), F.col("scores")[i].alias("pagerank"))
        for i, seed in enumerate(seeds)
    ]
    return wide.select(by, F.inline(F.array(*points)))


def short_names(emails: Sequence[str]) -> list[str]:
    """Part before the "@", the full address where that is not unique."""
    local = [email.split("@", 1)[0] for email in emails]
    return [
        name if local.count(name) == 1 else email
        for name, email in zip(local, emails, strict=True)
    ]


def series_wide(
    series: DataFrame,
    seeds: Sequence[str],
    cap: float | None = None,
    names: Sequence[str] | None = None,
    by: str = "quarter",
) -> DataFrame:
    """Chart table: one row per slice, one column per seed, zero-filled.

    Columns are the short names unless ``names`` are given; ``cap`` cuts the
    scores for a zoomed chart.
    """
    wide = series.groupBy(by).pivot("email", list(seeds)).agg(F.first("pagerank"))
    columns = []
    for seed, name in zip(seeds, names or short_names(seeds), strict=True):
        score = F.coalesce(F.col(f"`{seed}`"), F.lit(0.0))
        if cap is not None:
            score = F.least(score, F.lit(float(cap)))
        columns.append(score.alias(name))
    return wide.select(by, *columns)


def rank_compare(basic: DataFrame, log: DataFrame, freq: DataFrame) -> DataFrame:
    """Places of each person in three top-k rankings and the moves against the first.

    A positive move is a climb. A person who is not in a ranking has NULL there
    and the status says whether they dropped out of or came into it.
    """

    def places(ranking: DataFrame, name: str) -> DataFrame:
        return ranking.select("email", F.col("rank").alias(name))

    joined = (
        places(basic, "basic_rank")
        .join(places(log, "log_rank"), "email", "full_outer")
        .join(places(freq, "freq_rank"), "email", "full_outer")
    )

    def status(column: str):
        here, there = F.col("basic_rank"), F.col(column)
        return (
            F.when(here.isNull() & there.isNull(), "absent")
            .when(there.isNull(), "dropped")
            .when(here.isNull(), "new")
            .when(there < here, "up")
            .when(there > here, "down")
            .otherwise("same")
        )

    return joined.select(
        "email",
        "basic_rank",
        "log_rank",
        "freq_rank",
        (F.col("basic_rank") - F.col("log_rank")).alias("log_move"),
        (F.col("basic_rank") - F.col("freq_rank")).alias("freq_move"),
        status("log_rank").alias("log_status"),
        status("freq_rank").alias("freq_status"),
    )


def quarter_winner(ranks: DataFrame, by: str = "quarter") -> DataFrame:
    """The first place of every slice."""
    return top_k(ranks, 1, [by]).select(by, "email", "pagerank")


def peak_quarter(series: DataFrame, by: str = "quarter") -> DataFrame:
    """Slice in which each tracked person scores highest, the earliest on a tie."""
    best_first = F.struct((-F.round("pagerank", TIE_DIGITS)).alias("score"), F.col(by))
    peak = F.min_by(F.struct(by, "pagerank"), best_first)
    return series.groupBy("email").agg(peak.alias("peak")).select("email", "peak.*")


def global_vs_quarterly(top: DataFrame, quarterly_top: DataFrame) -> DataFrame:
    """Global place of each person next to their places in the quarterly rankings."""
    quarterly = quarterly_top.groupBy("email").agg(
        F.count("*").alias("quarters_in_top"),
        F.min("rank").alias("best_rank"),
        F.median("rank").alias("median_rank"),
    )
    joined = top.join(quarterly, "email", "left")
    return joined.select(
        F.col("rank").alias("global_rank"),
        "email",
        F.coalesce("quarters_in_top", F.lit(0)).alias("quarters_in_top"),
        "best_rank",
        "median_rank",
    )
