"""Features on hand-written mails and their totals on the corpus."""

from pyspark.sql import functions as F

from mailweave.operators import (
    FEATURES,
    build_edges,
    ingest_metrics,
    parse_messages,
    person_counts,
    person_features,
    simple_graph,
)

MAILS = [
    "From: a@x.y\nTo: b@x.y, c@x.y\nCc: b@x.y\nDate: Mon, 14 May 2001 02:00:00 +0000",
    "From: a@x.y\nTo: b@x.y\nDate: Tue, 15 May 2001 12:00:00 +0000",
    "From: a@x.y\nTo: nobody\nDate: Fri, 15 Jun 2001 12:00:00 +0000",
    "From: b@x.y\nTo: a@x.y\nDate: Mon, 14 May 0001 03:00:00 +0000",
    "From: d@x.y\nTo: nobody\nDate: junk",
    "From: system\nTo: a@x.y\nDate: Mon, 14 May 2001 02:00:00 +0000",
]


def features_of(spark, **options):
    rows = [(str(i), text) for i, text in enumerate(MAILS)]
    parsed = parse_messages(spark.createDataFrame(rows, "file string, message string"))
    return {row.email: tuple(row)[1:] for row in person_features(parsed, **options).collect()}


def test_features(spark):
    found = features_of(spark)
    # recvCount outDegree inDegree nightRatio sendRecvRatio activeMonths avgSentPerMonth
    assert found == {
        "a@x.y": (1, 2, 1, 0.75, 0.8, 2, 2.0),
        "b@x.y": (3, 1, 1, 1.0, 0.25, 0, 0.0),
        "c@x.y": (1, 0, 1, 0.0, 0.0, 0, 0.0),
        "d@x.y": (0, 0, 0, 0.0, 0.0, 0, 0.0),
    }


def test_night_is_a_parameter(spark):
    assert features_of(spark, night=(12, 13))["a@x.y"][3] == 0.25


def test_totals_agree(spark, parsed):
    metrics = {row.metric: row.value for row in ingest_metrics(parsed).collect()}
    assert metrics["mails"] == metrics["valid"] + metrics["skipped"] == 1500
    assert metrics["valid"] == 1380
    assert metrics["na_dates"] == 635
    totals = person_counts(parsed).agg(
        F.count("*").alias("people"),
        *[F.sum(c).alias(c) for c in ("sent", "recv", "out_degree", "in_degree", "night")],
    )
    row = totals.first()
    assert row.people == metrics["persons"] == 199
    assert row.sent == row.recv == metrics["edges"] == 5648
    assert row.out_degree == row.in_degree == simple_graph(build_edges(parsed)).count() == 5086
    assert row.night == 1406


def test_columns(spark, parsed):
    assert person_features(parsed).columns == ["email", *FEATURES]


def test_one_scan_of_the_mails(parsed):
    """Counts of pairs and of months come from the same pass."""
    plan = person_features(parsed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
