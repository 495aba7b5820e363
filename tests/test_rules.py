"""Rules that the derived corpus does not show: wide numbers and zones in dates, empty fields
of edge lists, orders of many lines, incomplete points, stray quotes."""

import datetime

import pytest
from pyspark.sql import functions as F

from mailweave import operators as op
from mailweave import sources
from mailweave.functions import quarter_of, sent_at, sent_hour, sent_month
from mailweave.operators import features
from mailweave.sources import orders_mail


@pytest.mark.parametrize(
    ("date", "month", "hour"),
    [
        ("Mon, 1 Jan 20001 05:00:00 +0000", "NA", 5),
        ("Mon, 1 Jan 2001 00012:00:00 -0800", "2001-01", 20),
        ("Mon, 00001 Jan 2001 000005:00:00 CET", "2001-01", 4),
        ("Mon, 1 Jan 2001 00:30:00 CEST", "2000-12", 22),
        ("Mon, 1 Jan 2001 05:00:00 IST", "2000-12", 23),
        ("Mon, 1 Jan 2001 05:00:00 JST (Tokyo)", "2000-12", 20),
        ("Mon, 1 Jan 2001 05:00:00 est", "2001-01", 10),
        ("Mon, 1 Jan 2001 05:00:00 XYZ", "NA", None),
        ("Mon, 1 Jan 999999999999 05:00:00 +0000", "NA", None),
        ("Mon, 99999999999999999999 Jan 2001 05:00:00 +0000", "NA", None),
        ("Mon, 1 Jan 2001 00:00:10000000 +0000", "2001-04", 17),
        ("Mon, 1 Jan 2001 00:525600:00 +0000", "2002-01", 0),
        ("Mon, 1 Jan 2001 00:00:31536000 +0000", "2002-01", 0),
        ("Mon, 1 Jan 1970 00:00:1000000000 +0000", "2001-09", 1),
        ("Mon, 1 Jan 1970 00:16666667:00 -0500", "2001-09", 6),
        ("Mon, 1 Jan 1970 277778:00:00 +0000", "2001-09", 2),
        ("Mon, 10000000 Jan 1970 00:00:00 +0000", "NA", 0),
        ("Mon, 1 Jan 1970 00:00:9200000000001 +0000", "NA", None),
        ("Mon, 1 Jan 290001 00:00:00 +0000", "NA", None),
        ("Mon, 1 Jan 2001 05:00:00 PKT", "2001-01", 0),
        ("Mon, 1 Jan 2001 05:00:00 Pacific Standard Time", "2001-01", 13),
        ("Mon, 1 Jul 2001 05:00:00 pacific daylight time (PDT)", "2001-07", 12),
        ("Mon, 1 Jan 2001 05:00:00 Central European Summer Time", "2001-01", 3),
        ("Mon, 1 Jan 2001 05:00:00 Europe/Paris", "NA", None),
    ],
)
def test_dates(spark, date, month, hour):
    at = sent_at(F.col("date"))
    row = spark.createDataFrame([(date,)], "date string").select(
        sent_month(at).alias("ym"), sent_hour(at).alias("hour")
    ).head()
    assert (row.ym, row.hour) == (month, hour)


def test_month_in_another_zone(spark):
    at = sent_at(F.lit("Tue, 1 May 2001 02:00:00 +0000"))
    row = spark.range(1).select(
        sent_month(at, "America/Chicago").alias("ym"), sent_hour(at, "America/Chicago").alias("hour")
    ).head()
    assert (row.ym, row.hour) == ("2001-04", 21)


def test_empty_fields_of_edge_lists(spark, tmp_path):
    lines = ["a\tc\t\t2001-05", "a\tc\tcc\t2001-05", "a\tb", "a\tb\t", "", "x\ty\tto\tNA\tmore", '"q\tz\tto\t']
    (tmp_path / "edges").write_text("\n".join(lines) + "\r\n")
    path = str(tmp_path / "edges")
    count = lambda fields: sources.read_edges(spark, path, "tsv", fields).count()
    assert [count(n) for n in (2, 3, 4)] == [6, 5, 4]
    short = [sources.count_short_lines(spark, path, "tsv", n).head()[0] for n in (2, 3, 4)]
    assert short == [0, 1, 2]
    three = sources.read_edges(spark, path, "tsv", 3)
    weights = {(r.src, r.dst): r.w for r in op.edge_weights(three, "freq").collect()}
    assert weights["a", "c"] == 1.5 and weights["a", "b"] == 1.0 and weights['"q', "z"] == 1.0
    four = sources.read_edges(spark, path, "tsv", 4).select(quarter_of(F.col("ym")).alias("q"))
    assert sorted(str(r.q) for r in four.collect()) == ["2001-Q2", "2001-Q2", "None", "None"]


@pytest.fixture(scope="module")
def long_order(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("orders")
    lines = [(7, n, 1000 + n * 7, "R" if n > 55 else "N") for n in range(1, 61)]
    schema = "l_orderkey long, l_linenumber int, l_partkey long, l_returnflag string"
    spark.createDataFrame(lines, schema).write.parquet(f"{folder}/lineitem.parquet")
    day = datetime.datetime(1998, 3, 4)
    orders = [(7, 5, day), (8, 6, day)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp").write.parquet(
        f"{folder}/orders.parquet"
    )
    return str(folder)


def test_an_order_of_many_lines_is_one_mail(spark, long_order):
    messages = orders_mail.messages(spark, long_order)
    assert messages.count() == 2
    parsed = op.build_edges(op.parse_messages(messages))
    derived = orders_mail.edges(spark, long_order)
    assert sorted(map(tuple, parsed.collect())) == sorted(map(tuple, derived.collect()))
    assert {r.type for r in derived.collect()} == {"to", "cc"}


def test_lines_move_once(spark, long_order):
    plan = orders_mail.edges(spark, long_order)._jdf.queryExecution().executedPlan().toString()
    # one exchange carries lines, one orders, one the orders that have a To
    assert plan.count("Exchange hashpartitioning") == 3
    plan = orders_mail.messages(spark, long_order)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2


@pytest.mark.parametrize("measure", [features.sent_recv, features.night_ratio])
def test_copies_take_one_shuffle_on_the_person(spark, measure):
    messages = spark.createDataFrame([("1", "From: a@b.c\nTo: d@e.f")], "file string, message string")
    plan = measure(op.parse_messages(messages))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(email" in plan


def test_active_months_have_no_pair_key(spark):
    messages = spark.createDataFrame([("1", "From: a@b.c\nTo: d@e.f")], "file string, message string")
    plan = op.active_months(op.parse_messages(messages))._jdf.queryExecution().executedPlan().toString()
    assert "dst" not in plan.split("Exchange")[0] and plan.count("Exchange hashpartitioning") <= 2


def test_incomplete_points_get_no_cluster(spark):
    rows = [(f"p{i}", float(i % 5), float(i % 3)) for i in range(30)]
    bad = [("a", None, 1.0), ("b", float("nan"), 1.0), ("c", 1.0, float("inf"))]
    df = spark.createDataFrame(rows + bad, "email string, x double, y double")
    clean = spark.createDataFrame(rows, "email string, x double, y double")
    fit, expected = (op.kmeans(d, ["x", "y"], k=3) for d in (df, clean))
    assert fit.centroids == expected.centroids
    assert sorted(fit.assignments.collect()) == sorted(expected.assignments.collect())


def test_a_stray_quote_is_an_error(spark, tmp_path):
    (tmp_path / "dump.csv").write_text('"file","message"\n"1","a"b"\n"2","c"\n')
    with pytest.raises(Exception, match="odd number of quotes"):
        sources.read_large_dump(spark, str(tmp_path)).collect()


def test_jobs_on_a_given_edge_list_and_feature_table(spark, tmp_path):
    from mailweave.plans import cluster_people, rank_people, rank_quarters

    lines = [f"p{i % 9}\tp{i * 5 % 11}\t{'cc' if i % 3 else 'to'}\t2001-{1 + i % 12:02}" for i in range(200)]
    (tmp_path / "edges.tsv").write_text("\n".join(lines) + "\n")
    edges, folder = str(tmp_path / "edges.tsv"), str(tmp_path / "out")
    top = rank_people(spark, folder, edges=edges, fmt="tsv", k=5).collect()
    assert [r["rank"] for r in top] == [1, 2, 3, 4, 5]
    assert rank_people(spark, folder, "log", edges=edges, fmt="tsv", k=5).count() == 5
    series = rank_quarters(spark, folder, edges=edges, fmt="tsv", seeds=2)
    assert {r.quarter for r in series.collect()} == {f"2001-Q{q}" for q in (1, 2, 3, 4)}
    names = ["email", *features.FEATURES]
    rows = ["\t".join(names)] + [f"p{i}\t{i}\t{i % 4}\t1\t0.5\t0.{i % 9}\t{i % 3}\t1.5" for i in range(40)]
    (tmp_path / "features.tsv").write_text("\n".join(rows) + "\n")
    fits = cluster_people(spark, folder, [2, 3], features_path=str(tmp_path / "features.tsv"), fmt="tsv")
    assert {k: fit.assignments.count() for k, fit in fits.items()} == {2: 40, 3: 40}
