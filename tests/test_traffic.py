"""Subtotals, differences of edge multisets, semi-structured mails, tables by bucket, SQL names."""

import json
import random
from collections import Counter, defaultdict
from itertools import product

import pytest
from pyspark.sql import functions as F

from mailweave import operators as op
from mailweave import sources
from mailweave.functions import clean_address, header_map, is_valid_address, message_json, parsed_json, quarter_of
from mailweave.sql import register

EDGES = "src string, dst string, type string, ym string"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _edges(spark, n, seed=1):
    rng = random.Random(seed)
    months = ["1998-01", "1998-03", "1998-04", "1998-12", "1999-02", "1999-08", "NA"]
    people = [f"p{i}@{d}" for i in range(5) for d in ("a.org", "B.net")]
    rows = [
        # one pair holds most copies
        ("hot@a.org", "p1@B.net", "to", rng.choice(months)) if rng.random() < 0.6
        else (rng.choice(people), rng.choice(people), rng.choice(["to", "cc"]), rng.choice(months))
        for _ in range(n)
    ]
    return rows, spark.createDataFrame(rows, EDGES).repartition(5)


def _quarter(ym):
    return None if ym == "NA" else f"{ym[:4]}-Q{(int(ym[5:]) + 2) // 3}"


# ---- subtotals --------------------------------------------------------------


def test_traffic_cube(spark):
    rows, edges = _edges(spark, 700)
    expected = defaultdict(lambda: [0, set()])
    for src, dst, kind, ym in rows:
        cell = (kind, _quarter(ym), dst.split("@")[1].lower())
        for summed in product([0, 1], repeat=3):
            level = summed[0] * 4 + summed[1] * 2 + summed[2]
            key = level, *(None if s else c for s, c in zip(summed, cell))
            expected[key][0] += 1
            expected[key][1].add(src)
    found = op.traffic_cube(edges)
    assert found.columns == ["level", "type", "quarter", "domain", "copies", "senders"]
    assert {tuple(r)[:4]: tuple(r)[4:] for r in found.collect()} == {k: (n, len(s)) for k, (n, s) in expected.items()}
    plan = _plan(found)
    # copies are summed in the tasks before rows are multiplied
    assert plan.index("Expand") < plan.rindex("partial_count(1)")


def test_calendar_rollup(spark):
    rows, edges = _edges(spark, 300)
    expected = defaultdict(lambda: [0, set()])
    for src, _, _, ym in rows:
        if ym != "NA":
            cell = (ym[:4], _quarter(ym), ym)
            for kept, level in ((3, 0), (2, 1), (1, 3), (0, 7)):
                key = level, *cell[:kept], *[None] * (3 - kept)
                expected[key][0] += 1
                expected[key][1].add(src)
    found = {tuple(r)[:4]: tuple(r)[4:] for r in op.calendar_rollup(edges).collect()}
    assert found == {k: (n, len(s)) for k, (n, s) in expected.items()}


@pytest.mark.parametrize("operator", [op.traffic_cube, op.calendar_rollup, op.edge_churn])
def test_nothing_gives_no_rows(spark, operator):
    assert operator(spark.createDataFrame([], EDGES)).collect() == []


# ---- differences ------------------------------------------------------------


def test_edge_changes_counts_copies(spark):
    rows, _ = _edges(spark, 400, 2)
    before, after = Counter(r[:3] for r in rows[:180]), Counter(r[:3] for r in rows[180:])
    frames = [spark.createDataFrame(part, EDGES) for part in (rows[:180], rows[180:])]
    found = Counter(tuple(r) for r in op.edge_changes(*frames).collect())
    expected = Counter()
    for change, left in (("lost", before - after), ("gained", after - before), ("kept", before & after)):
        expected.update({(*k, change): n for k, n in left.items()})
    assert found == expected and len({k[3] for k in found}) == 3


def test_edge_churn(spark):
    rows, edges = _edges(spark, 500, 3)
    by = defaultdict(Counter)
    for src, dst, _, ym in rows:
        if ym != "NA":
            by[_quarter(ym)][src, dst] += 1
    expected = {}
    for quarter, now in by.items():
        year, n = int(quarter[:4]), int(quarter[6])
        past = by.get(f"{year}-Q{n - 1}" if n > 1 else f"{year - 1}-Q4", Counter())
        sizes = [sum(c.values()) for c in (now, now - past, past - now, now & past)]
        expected[quarter] = tuple(sizes)
    assert {r.quarter: tuple(r)[1:] for r in op.edge_churn(edges).collect()} == expected
    assert any(row[3] for row in expected.values()) and any(row[3] == 0 for row in expected.values())


# ---- semi-structured mails --------------------------------------------------

MAILS = {
    "From: a@b.c\nTo: x,\n\ty\nReceived: one\nReceived: two\nno name\n X: folded\nEmpty:\n\nbody\nTo: z": (
        {"From": ["a@b.c"], "To": ["x, y"], "Received": ["one", "two"], "Empty": [""]}, "body\nTo: z"),
    "A:b\r\nC : d:e\r\n\r\nbody\r\n": ({"A": ["b"], "C": ["d:e"]}, "body\r\n"),
    "\n \nFrom: after blanks": ({"From": ["after blanks"]}, ""),
    "": ({}, ""),
    None: ({}, ""),
    "X-Ümlaut: no name\nOk!: yes\n:none": ({"Ok!": ["yes"]}, ""),
}


def test_header_map_and_json(spark):
    df = spark.createDataFrame([(str(i), m) for i, m in enumerate(MAILS)], "file string, message string")
    rows = df.select(
        "file", header_map(F.col("message")).alias("m"), message_json(F.col("file"), F.col("message")).alias("j")
    ).collect()
    for row, (headers, body) in zip(sorted(rows), MAILS.values(), strict=True):
        assert row.m == headers
        assert json.loads(row.j) == {"file": row.file, "headers": headers, "body": body}


def test_json_round_trip(spark, tmp_path):
    path = str(tmp_path / "mails")
    df = spark.createDataFrame([(str(i), m) for i, m in enumerate(MAILS)], "file string, message string")
    sources.write_messages_json(df, path)
    read = sources.read_messages_json(spark, path).orderBy("file").collect()
    assert [(r.headers, r.body, r.rest, r.corrupt) for r in read] == [(h, b, {}, None) for h, b in MAILS.values()]
    fields = op.mapped_fields(sources.read_messages_json(spark, path)).orderBy("file").collect()
    assert (fields[0].from_text, fields[0].to_text, fields[0].cc_text) == ("a@b.c", "x, y", "")


LINES = {
    '{"file":"1","headers":{"A":["b"]},"body":"x","size":12,"tags":["a",{"b":1}]}':
        ("1", {"A": ["b"]}, "x", {"size": "12", "tags": '["a",{"b":1}]'}, False),
    '{"file":"a","n":null}': ("a", None, None, {"n": "null"}, False),
    "{}": (None, None, None, {}, False),
    "not json": None, "[1,2]": None, "null": None, "7": None, '{"file":"1"': None, '{"file":"1","headers":"x"}': None,
    '{"file":"1"} text after it': ("1", None, None, {}, False),
}


def test_lines_that_are_no_mail_are_kept_whole(spark, tmp_path):
    df = spark.createDataFrame([(line,) for line in LINES], "line string")
    rows = df.select("line", parsed_json(F.col("line")).alias("p")).collect()
    for row in rows:
        expected = LINES[row.line] or (None, None, None, None, True)
        assert (row.p.file, row.p.headers, row.p.body, row.p.rest, row.p.corrupt is not None) == expected, row.line
        assert row.p.corrupt in (None, row.line)


# ---- tables -----------------------------------------------------------------


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_joins_by_sender_on_a_bucketed_table_do_not_shuffle(spark, tmp_path, no_broadcast):
    rows, edges = _edges(spark, 300)
    table = sources.edges_table(edges, "edges_by_sender", str(tmp_path / "t"), 4)
    pairs = table.groupBy("src", "dst").agg(F.count("*").alias("n"))
    joined = pairs.join(table.groupBy("src").agg(F.count("*").alias("sent")), "src")
    assert "Exchange" not in _plan(joined) and "SortMergeJoin" in _plan(joined)
    assert "Exchange" in _plan(edges.groupBy("src", "dst").count().join(edges.groupBy("src").count(), "src"))
    sent = Counter(r[0] for r in rows)
    found = {(r.src, r.dst): (r.n, r.sent) for r in joined.collect()}
    assert found == {k: (n, sent[k[0]]) for k, n in Counter(r[:2] for r in rows).items()}
    spark.sql("DROP TABLE edges_by_sender")


@pytest.mark.parametrize("fmt", ["orc", "json", "parquet", "tsv"])
def test_edges_in_every_format(spark, tmp_path, fmt):
    rows, edges = _edges(spark, 60)
    rows += [("", 'q"uote', "to", "NA")]
    edges = edges.union(spark.createDataFrame(rows[-1:], EDGES))
    sources.write_edges(edges, str(tmp_path / "e"), fmt)
    read = sources.read_edges(spark, str(tmp_path / "e"), fmt)
    assert Counter(tuple(r) for r in read.collect()) == Counter(rows)
    assert read.columns == ["src", "dst", "type", "ym"]


# ---- SQL --------------------------------------------------------------------


def test_sql_functions_equal_their_expressions(spark, parsed):
    register(spark, parsed)
    texts = ["a@b.c", " A <x@y.z> \t", "<>", "x> <y", "<a@b", "a b@c.d", "a@b", "'q\\u0041'@b.c", "\x00\x1fz@a.b ", "", None]
    rows = [(t,) for t in texts]
    clean = spark.createDataFrame(rows, "t string").select(
        F.expr("mail_clean_address(t)").alias("a"), clean_address(F.col("t")).alias("b"),
        F.expr("mail_valid_address(t)").alias("c"), is_valid_address(F.col("t")).alias("d"),
    )
    assert all(r.a == r.b and r.c == r.d for r in clean.collect())
    months = [(m,) for m in ("1998-01", "1998-03", "2001-12", "2001-4", "NA", "", "2001-xx", None)]
    quarters = spark.createDataFrame(months, "ym string").select(
        "ym", F.expr("mail_quarter(ym)").alias("a"), quarter_of(F.col("ym")).alias("b")
    )
    assert all(r.a == r.b for r in quarters.collect())


def test_sql_query_equals_its_dataframe_form(spark, parsed):
    register(spark, parsed)
    by_sql = spark.sql("SELECT src, dst, sum(mail_weight(type)) AS w FROM mail_edges GROUP BY src, dst")
    by_frame = op.edge_weights(op.build_edges(parsed))
    assert by_sql.exceptAll(by_frame).count() == by_frame.exceptAll(by_sql).count() == 0
    assert "Python" not in _plan(by_sql)
    people = spark.sql("SELECT count(*) AS n FROM mail_persons").first().n
    assert people == op.persons(parsed).count()
    one = spark.sql("SELECT sum(sent) AS s, sum(received) AS r FROM mail_correspondents('p7@en.example.com')").first()
    edges = op.build_edges(parsed)
    assert one.s == edges.where("src = 'p7@en.example.com'").count()
    assert one.r == edges.where("dst = 'p7@en.example.com'").count()
