"""The weekly stream against the batch, over arrivals, restarts and late mails."""

import datetime
from collections import defaultdict

import pytest

from mailweave import sources
from mailweave.streaming import closed_weeks, count_new_files, late_copies

EPOCH = datetime.datetime(1970, 1, 1)


def _mail(n, src, people, at):
    date = at.strftime("%a, ") + f"{at.day} " + at.strftime("%b %Y %H:%M:%S +0000")
    return f"m{n}", f"From: {src}\nTo: {', '.join(people)}\nDate: {date}\n\ntext"


def _address(n):
    return f"p{n}@x.org"


def _week(at):
    return (EPOCH + datetime.timedelta(days=(at - EPOCH).days // 7 * 7)).date()


@pytest.fixture
def arrive(spark, tmp_path):
    """Let mails arrive as one file each time."""
    numbers = iter(range(1000))

    def put(mails):
        rows = [_mail(*m) for m in mails]
        df = spark.createDataFrame(rows, sources.tables.MESSAGE_SCHEMA).coalesce(1)
        sources.write_messages(df, str(tmp_path / f"dump/{next(numbers)}"), "csv")
        return str(tmp_path / "dump/*"), str(tmp_path / "out")

    return put


def _weeks(spark, folder):
    rows = closed_weeks(spark, folder).collect()
    assert len({r.week_start for r in rows}) == len(rows)
    return {r.week_start: r.edges for r in rows}


def _batch(mails, delay):
    weeks, latest = defaultdict(set), max(at for *_, at in mails)
    for _, src, people, at in mails:
        weeks[_week(at)] |= {(src, p) for p in people if p != src}
    ends = lambda week: datetime.datetime.combine(week, datetime.time()) + datetime.timedelta(days=7)
    return {w: len(pairs) for w, pairs in weeks.items() if ends(w) <= latest - delay}


@pytest.mark.parametrize("store", ["rocksdb", "memory"])
def test_stream_equals_batch_over_restarts(spark, arrive, store):
    """Five runs, each one after the other went away; mails are out of order within the delay."""
    mails = [
        (i, _address(i % 3), [_address(i % 7), _address(5), _address(5)], datetime.datetime(2000, 1, 1) + datetime.timedelta(hours=17 * i + i % 5 * 40))
        for i in range(300)
    ]
    for run in range(5):
        part = mails[60 * run : 60 * run + 60]
        source, folder = arrive(part)
        count_new_files(spark, source, folder, "10 days", state_store=store)
    expected = _batch(mails, datetime.timedelta(days=10))
    assert len(expected) > 25 and _weeks(spark, folder) == expected
    runs = late_copies(spark, folder).orderBy("first_batch").collect()
    assert [r.mails for r in runs] == [60] * 5 and sum(r.late_copies for r in runs) == 0
    assert all(a.last_batch < b.first_batch for a, b in zip(runs, runs[1:]))


def test_a_run_without_new_files_changes_nothing(spark, arrive):
    first = datetime.datetime(2000, 1, 3)
    source, folder = arrive([(1, _address(1), [_address(2)], first), (2, _address(1), [_address(2)], first + datetime.timedelta(days=40))])
    count_new_files(spark, source, folder, "1 day")
    before = _weeks(spark, folder)
    assert before == {datetime.date(1999, 12, 30): 1}
    count_new_files(spark, source, folder, "1 day")
    assert _weeks(spark, folder) == before


def test_late_copies_are_dropped_and_counted(spark, arrive):
    day = lambda n: datetime.datetime(2000, 3, 2) + datetime.timedelta(days=n)
    source, folder = arrive([(1, _address(1), [_address(2)], day(0)), (2, _address(1), [_address(2)], day(30))])
    count_new_files(spark, source, folder, "5 days")
    # weeks before day 25 are closed: four copies late; day 26 is still open, and the pair known
    late = [(3, _address(1), [_address(3), _address(4), _address(4)], day(1)), (4, _address(9), [_address(1)], day(15))]
    open_ = [(5, _address(1), [_address(2)], day(29)), (6, _address(1), [_address(7)], day(26)), (7, _address(1), [_address(2)], day(90))]
    arrive(late + open_)
    count_new_files(spark, source, folder, "5 days")
    assert _week(day(26)) < _week(day(29)) == _week(day(30))
    assert _weeks(spark, folder) == {_week(day(0)): 1, _week(day(26)): 1, _week(day(30)): 1}
    assert [r.late_copies for r in late_copies(spark, folder).orderBy("first_batch").collect()] == [0, 4]


def test_the_month_of_weekly_edges_parses_no_date_again(spark):
    from mailweave.operators import parse_messages
    from mailweave.streaming.weekly import weekly_edges

    mails = spark.createDataFrame([("1", "From: a@b.c\nTo: d@e.f")], "file string, message string")
    plan = weekly_edges(parse_messages(mails.repartition(2)), "1 day")._jdf.queryExecution().optimizedPlan().toString()
    # eight with a filter on the month
    assert plan.count("Date:(") <= 5
