"""Rankings, series and comparisons on small rank vectors."""

import pytest

from mailweave.operators import (
    global_vs_quarterly,
    peak_quarter,
    quarter_winner,
    rank_compare,
    seed_emails,
    series_wide,
    top_k,
    track,
)


@pytest.fixture(scope="module")
def quarterly(spark):
    rows = [
        ("1998-Q1", "a@x.y", 0.5), ("1998-Q1", "b@x.y", 0.3), ("1998-Q1", "c@x.y", 0.2),
        ("1998-Q2", "b@x.y", 0.5), ("1998-Q2", "c@x.y", 0.5),
    ]
    return spark.createDataFrame(rows, "quarter string, id string, rank double")


def test_ties_go_to_the_smaller_address(spark):
    rows = [("b", 0.3), ("a", 0.3 + 1e-15), ("c", 0.4)]
    ranks = spark.createDataFrame(rows, "id string, rank double")
    assert [(r["rank"], r.email) for r in top_k(ranks, 2).collect()] == [(1, "c"), (2, "a")]
    assert top_k(ranks, 20).count() == 3


def test_large_slice_is_limited_before_the_shuffle(quarterly):
    plan = top_k(quarterly, 2, ["quarter"])._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 2, Partial" in plan


def test_large_k_is_taken_in_parts(spark):
    ranks = spark.range(6000).selectExpr(
        "concat('1998-Q', id % 1) quarter", "concat('p', id) id", "(id * 7919 % 6000) / 1e7 rank"
    )
    top = top_k(ranks, 1500, ["quarter"])
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(quarter" in plan and "_part" in plan
    rows = sorted(top.collect(), key=lambda row: row["rank"])
    assert [row["rank"] for row in rows] == list(range(1, 1501))
    assert [row.pagerank for row in rows] == [(5999 - i) / 1e7 for i in range(1500)]


def test_track_is_zero_filled(quarterly):
    series = track(quarterly, ["a@x.y", "nobody@x.y"])
    assert sorted(map(tuple, series.collect())) == [
        ("1998-Q1", "a@x.y", 0.5),
        ("1998-Q1", "nobody@x.y", 0.0),
        ("1998-Q2", "a@x.y", 0.0),
        ("1998-Q2", "nobody@x.y", 0.0),
    ]


def test_wide_series(quarterly):
    seeds = ["a@x.y", "b@x.y"]
    series = track(quarterly, seeds)
    wide = series_wide(series, seeds, cap=0.4).orderBy("quarter")
    assert wide.columns == ["quarter", "a", "b"]
    assert [tuple(row) for row in wide.collect()] == [("1998-Q1", 0.4, 0.3), ("1998-Q2", 0.0, 0.4)]
    same_name = series_wide(series, ["a@x.y", "a@z.y"])
    assert same_name.columns == ["quarter", "a@x.y", "a@z.y"]


def test_winner_and_peak(quarterly):
    winners = {row.quarter: row.email for row in quarter_winner(quarterly).collect()}
    assert winners == {"1998-Q1": "a@x.y", "1998-Q2": "b@x.y"}
    peaks = peak_quarter(track(quarterly, ["b@x.y", "nobody@x.y"])).collect()
    assert sorted(map(tuple, peaks)) == [
        ("b@x.y", "1998-Q2", 0.5),
        ("nobody@x.y", "1998-Q1", 0.0),
    ]


def test_seeds(spark):
    ranking = spark.createDataFrame([(2, "b"), (1, "a"), (3, "c")], "rank int, email string")
    assert seed_emails(ranking, 2) == ["a", "b"]
    with pytest.raises(ValueError):
        seed_emails(ranking.where("rank > 9"))


def test_compare(spark):
    def ranking(*emails):
        rows = list(enumerate(emails, 1))
        return spark.createDataFrame(rows, "rank int, email string")

    rows = rank_compare(ranking("a", "b", "c"), ranking("a", "c", "d"), ranking("e", "b", "a"))
    found = {row.email: tuple(row)[1:] for row in rows.collect()}
    assert found == {
        "a": (1, 1, 3, 0, -2, "same", "down"),
        "b": (2, None, 2, None, 0, "dropped", "same"),
        "c": (3, 2, None, 1, None, "up", "dropped"),
        "d": (None, 3, None, None, None, "new", "absent"),
        "e": (None, None, 1, None, None, "absent", "new"),
    }


def test_global_and_quarterly(spark, quarterly):
    top = spark.createDataFrame([(1, "c@x.y"), (2, "z@x.y")], "rank int, email string")
    found = global_vs_quarterly(top, top_k(quarterly, 20, ["quarter"])).orderBy("global_rank")
    assert [tuple(row) for row in found.collect()] == [
        (1, "c@x.y", 2, 2, 2.5),
        (2, "z@x.y", 0, None, None),
    ]
