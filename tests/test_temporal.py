"""Joins and windows over time against brute force, with keys that hold most of the rows."""

import datetime
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from mailweave import operators as op
from mailweave.operators import temporal

START = datetime.datetime(1999, 12, 20)


def _time(rng, seconds):
    return START + datetime.timedelta(seconds=rng.randrange(seconds))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- as-of join -------------------------------------------------------------

LEFT, RIGHT = "id int, k string, at timestamp_ntz, match_of string", "rank int, k string, at timestamp_ntz, id int"


def _asof(left, right, strict, within):
    out = {}
    for i, k, at, _ in left:
        found = [
            (r[2], r) for r in right
            if k is not None and at is not None and r[1] == k and r[2] is not None
            and (r[2] < at if strict else r[2] <= at)
        ]
        best = max((t for t, _ in found), default=None)
        pick = min((r for t, r in found if t == best), default=None)
        if pick and within is not None and (at - best).total_seconds() > within:
            pick = None
        out[i] = pick and (pick[0], pick[2], pick[3])
    return out


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("within", [None, 5000])
def test_asof_join(spark, strict, within):
    rng = random.Random(7)
    # one key holds most rows, over many stretches, with many equal instants
    key = lambda: rng.choice(["hot"] * 8 + ["a", "b", None])
    span = 40 * 86400
    time = lambda: rng.choice([_time(rng, span), START + datetime.timedelta(hours=rng.randrange(900)), None])
    left = [(i, key(), time(), "x") for i in range(700)]
    right = [(rng.randrange(5), key(), time(), i) for i in range(400)]
    l, r = spark.createDataFrame(left, LEFT).repartition(5), spark.createDataFrame(right, RIGHT).repartition(3)
    found = op.asof_join(l, r, ["k"], "at", strict, within)
    assert found.columns == [*l.columns, "match"]
    rows = {x.id: x.match and tuple(x.match) for x in found.collect()}
    assert len(rows) == 700 and any(rows.values())
    assert rows == _asof(left, right, strict, within)


def test_asof_join_keeps_repeated_rows_and_empty_sides(spark):
    left = spark.createDataFrame([(1, "a", START, "x")] * 3, LEFT)
    right = spark.createDataFrame([(2, "a", START, 1), (1, "a", START, 9), (1, "a", START, 9)], RIGHT)
    assert [tuple(x.match) for x in op.asof_join(left, right, ["k"], "at").collect()] == [(1, START, 9)] * 3
    assert [x.match for x in op.asof_join(left, right.limit(0), ["k"], "at").collect()] == [None] * 3
    assert op.asof_join(left.limit(0), right, ["k"], "at").collect() == []


def test_asof_join_deals_a_hot_key_by_time(spark):
    """Rows are never windowed by the key alone: only one row per stretch is."""
    left = spark.createDataFrame([(1, "a", START, "x")], LEFT)
    right = spark.createDataFrame([(2, "a", START, 1)], RIGHT)
    plan = _plan(op.asof_join(left, right, ["k"], "at"))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    windows = [line for line in plan.splitlines() if "Window [last(_match" in line]
    assert windows and all("_stretch" in line.split("]", 1)[1].split("[", 1)[1] for line in windows)


def test_reply_latency(spark):
    schema = "msg_id string, src string, to array<string>, cc array<string>, sent_at timestamp_ntz, ym string"
    t = lambda s: START + datetime.timedelta(seconds=s)
    mails = [
        ("m1", "a", ["b", "b"], ["c"], t(0), "1999-12"),
        ("m2", "b", ["a"], [], t(90), "1999-12"),
        ("m0", "a", ["b"], [], t(90), "1999-12"),  # same second as m2: neither answers the other
        ("m3", "b", ["a", "c"], [], t(90 + 86400 * 40), "2000-01"),
        ("m4", "b", ["a"], [], t(5), "NA"),
        ("m5", "c", [], ["a", "b"], t(-5), "1999-12"),
    ]
    found = op.reply_latency(spark.createDataFrame(mails, schema))
    assert {(r.msg_id, r.dst): (r.reply_to, r.latency) for r in found.collect()} == {
        ("m1", "b"): (None, None), ("m1", "c"): ("m5", 5), ("m2", "a"): ("m1", 90), ("m0", "b"): (None, None),
        ("m3", "a"): ("m0", 86400 * 40), ("m3", "c"): ("m5", 95 + 86400 * 40),
        ("m5", "a"): (None, None), ("m5", "b"): (None, None),
    }
    assert found.count() == 8


# ---- interval join ----------------------------------------------------------


def _periods(rng, n):
    rows = []
    for i in range(n):
        start = _time(rng, 10**7)
        length = rng.choice([0, 1, 59, 3599, 3600, 3601, 7200, 86400, 10**6, 10**8, -5])
        rows.append((i, rng.choice(["hot", "hot", "a", None]), start, start + datetime.timedelta(seconds=length)))
    return [*rows, (n, "a", None, START), (n + 1, "a", START, None)]


@pytest.mark.parametrize("by", [[], ["k"]])
def test_interval_join(spark, by):
    rng = random.Random(3)
    periods = _periods(rng, 120)
    edges = [p[2] for p in periods if p[2]] + [p[3] for p in periods if p[3]]
    points = [(i, rng.choice(["hot", "hot", "a", None]), rng.choice([_time(rng, 2 * 10**7), rng.choice(edges), None])) for i in range(400)]
    p = spark.createDataFrame(points, "i int, k string, at timestamp_ntz").repartition(4)
    s = spark.createDataFrame(periods, "j int, k string, start timestamp_ntz, end timestamp_ntz")
    found = op.interval_join(p, s, "at", "start", "end", by)
    expected = sorted(
        (i, j) for i, k, at in points for j, key, start, end in periods
        if at and start and end and start <= at < end and (not by or (k is not None and k == key))
    )
    assert len(expected) > 500
    assert sorted((r.point.i, r.interval.j) for r in found.collect()) == expected
    plan = _plan(found)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_interval_join_is_linear_in_long_intervals(spark):
    """A hundred years are two buckets and not a million hours."""
    rows = [(1, datetime.datetime(1950, 1, 1), datetime.datetime(2050, 1, 1)), (2, START, START + datetime.timedelta(hours=1))]
    s = spark.createDataFrame(rows, "j int, start timestamp_ntz, end timestamp_ntz")
    p = spark.createDataFrame([(START,), (datetime.datetime(1950, 1, 1),), (datetime.datetime(2050, 1, 1),)], "at timestamp_ntz")
    found = op.interval_join(p, s, "at", "start", "end")
    assert sorted(r.interval.j for r in found.collect()) == [1, 1, 2]
    assert op.interval_join(p, s.limit(0), "at", "start", "end").collect() == []
    assert op.interval_join(p.limit(0), s, "at", "start", "end").collect() == []


# ---- sessions ---------------------------------------------------------------


def _bursts(rows, gap):
    by, out = defaultdict(list), []
    for k, at, n in rows:
        if k is not None and at is not None:
            by[k].append((at, n))
    for k, times in by.items():
        runs = []
        for at, n in sorted(times):
            if runs and (at - runs[-1][-1][0]).total_seconds() <= gap:
                runs[-1].append((at, n))
            else:
                runs.append([(at, n)])
        out += [(k, r[0][0], r[-1][0], len(r), sum(n for _, n in r)) for r in runs]
    return sorted(out)


@pytest.mark.parametrize("gap", [0, 60, 3600, 86400, 8 * 86400, 40 * 86400])
def test_sessions(spark, gap):
    """Within stretches, across many of them, and around their edges."""
    rng = random.Random(gap)
    rows = [(rng.choice(["hot"] * 9 + ["a", "b", None]), _time(rng, 120 * 86400), rng.randrange(9)) for _ in range(1500)]
    rows += [("a", None, 1), ("edge", datetime.datetime(1970, 1, 7, 23, 59, 59), 1), ("edge", datetime.datetime(1970, 1, 8), 2)]
    rows += [("old", datetime.datetime(1, 1, 1), 5), ("rare", START, 1), ("rare", START, 1)]
    df = spark.createDataFrame(rows, "k string, at timestamp_ntz, n int").repartition(6)
    found = op.sessions(df, ["k"], "at", gap, ["n"]).collect()
    assert sorted(tuple(r) for r in found) == _bursts(rows, gap)


def test_conversation_sessions(spark):
    schema = "msg_id string, src string, to array<string>, cc array<string>, sent_at timestamp_ntz, ym string"
    t = lambda s: START + datetime.timedelta(seconds=s)
    mails = [
        ("1", "b", ["a", "a"], ["a"], t(0), "1999-12"), ("2", "a", ["b"], [], t(60), "1999-12"),
        ("3", "a", ["b", "c"], [], t(121), "1999-12"), ("4", "a", ["b"], [], t(70), "NA"),
    ]
    found = op.conversation_sessions(spark.createDataFrame(mails, schema), 60)
    assert sorted(tuple(r) for r in found.collect()) == [
        ("a", "b", t(0), t(60), 2, 1), ("a", "b", t(121), t(121), 1, 1), ("a", "c", t(121), t(121), 1, 1),
    ]


# ---- sliding windows and streaks --------------------------------------------

PARSED = "src string, to array<string>, cc array<string>, sent_at timestamp_ntz, ym string, skip_reason string"


def _mails(rng, n):
    rows = []
    for _ in range(n):
        at = datetime.datetime(1998, 1, 1) + datetime.timedelta(seconds=rng.randrange(5 * 365 * 86400))
        rows.append((rng.choice(["hot"] * 9 + ["a", "b"]), ["x"] * rng.randrange(3), ["y"] * rng.randrange(2), at, f"{at:%Y-%m}", None))
    return [*rows, ("a", ["x"], [], START, "NA", None), ("a", [], [], START, "1999-12", "no_recipient_field")]


def test_rolling_activity(spark):
    mails = _mails(random.Random(1), 600)
    expected = defaultdict(lambda: [0, 0])
    for src, to, cc, at, ym, skipped in mails:
        if ym == "NA" or skipped:
            continue
        day = (at.date() - datetime.date(1970, 1, 1)).days
        for start in range(day // 10 * 10 - 20, day + 1, 10):
            key = src, datetime.date(1970, 1, 1) + datetime.timedelta(days=start)
            expected[key][0] += 1
            expected[key][1] += len(to) + len(cc)
    df = op.rolling_activity(spark.createDataFrame(mails, PARSED), 30, 10)
    assert {(r.email, r.window_start): [r.mails, r.copies] for r in df.collect()} == dict(expected)
    with pytest.raises(ValueError, match="multiple"):
        op.rolling_activity(df, 28, 5)


def test_mails_are_summed_before_they_are_dealt_to_windows(spark):
    plan = _plan(op.rolling_activity(spark.createDataFrame(_mails(random.Random(1), 5), PARSED)))
    assert plan.index("Generate explode") < plan.rindex("partial_count")


def test_active_streaks(spark):
    mails = _mails(random.Random(5), 90) + [("solo", [], [], START, "1999-12", None)]
    found = {r.email: tuple(r)[1:] for r in op.active_streaks(spark.createDataFrame(mails, PARSED)).collect()}
    months = defaultdict(set)
    for src, _, _, _, ym, skipped in mails:
        if ym != "NA" and not skipped:
            months[src].add(ym)
    assert set(found) == set(months)
    for src, own in months.items():
        numbers = sorted(int(m[:4]) * 12 + int(m[5:]) for m in own)
        runs, silence = [1], 0
        for a, b in zip(numbers, numbers[1:]):
            runs = [*runs[:-1], runs[-1] + 1] if b == a + 1 else [*runs, 1]
            silence = max(silence, b - a - 1)
        assert found[src] == (len(own), max(runs), silence, min(own), max(own))


@pytest.mark.parametrize("operator", [op.rolling_activity, op.active_streaks])
def test_no_mails(spark, operator):
    assert operator(spark.createDataFrame([], PARSED)).collect() == []
    nothing = spark.createDataFrame([], "msg_id string, " + PARSED)
    for other in (op.reply_latency, lambda df: op.conversation_sessions(df, 60)):
        assert other(nothing).where(F.lit(True)).collect() == []


@pytest.mark.parametrize("block_mails", [7, 250_000])
def test_mails_in_intervals_are_counted_without_pairs(spark, monkeypatch, block_mails):
    """Against every mail with every interval, in one block and in many."""
    monkeypatch.setattr(temporal, "BLOCK_MAILS", block_mails)
    monkeypatch.setattr(temporal, "interval_join", None)
    draw = random.Random(5)
    day = datetime.datetime(2000, 1, 1)
    at = lambda: day + datetime.timedelta(hours=draw.randrange(300), microseconds=draw.choice([0, 0, 1, 999_999]))
    mails = [(f"s{draw.randrange(9)}", at()) for _ in range(300)] + [("s1", day)] * 5
    spans = [(n, *sorted((at(), at()))) for n in range(120)] + [(200, day, day), (201, day + datetime.timedelta(days=90), day), (202, day, day + datetime.timedelta(days=400)), (203, None, day)]
    parsed = spark.createDataFrame(
        [(*m, "2000-01", None) for m in mails] + [("s1", day, "NA", None), ("s1", day, "2000-01", "no_sender"), ("s1", None, "2000-01", None)],
        "src string, sent_at timestamp_ntz, ym string, skip_reason string",
    )
    intervals = spark.createDataFrame(spans, "id long, start timestamp_ntz, end timestamp_ntz")
    expected = set()
    for number, start, end in spans:
        inside = [m for m in mails if start and start <= m[1] < end]
        if inside:
            expected.add((number, len(inside), len({m[0] for m in inside}), min(m[1] for m in inside)))
    assert {tuple(r) for r in op.mails_in_intervals(parsed, intervals).collect()} == expected


def test_intervals_that_share_an_id_are_one(spark):
    day = datetime.datetime(2000, 1, 1)
    parsed = spark.createDataFrame(
        [("a", day, "2000-01", None), ("b", day, "2000-01", None)], "src string, sent_at timestamp_ntz, ym string, skip_reason string"
    )
    spans = [(i, day, day + datetime.timedelta(days=1)) for i in (1, 1, 2, None, None)]
    found = op.mails_in_intervals(parsed, spark.createDataFrame(spans, "id long, start timestamp_ntz, end timestamp_ntz"))
    assert {tuple(r) for r in found.collect()} == {(1, 4, 2, day), (2, 2, 2, day), (None, 4, 2, day)}
