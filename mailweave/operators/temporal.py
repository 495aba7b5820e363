"""Joins and windows over time: as-of join, interval join, sessions, sliding windows, streaks.

A key may hold any share of the rows, so no window of these operators spans a whole key. Rows
of a key are first reduced to one per instant, in the tasks that read them, then dealt by key
and stretch of time. What has to pass from one stretch to the next is a row or two per stretch,
so the last step of a key is bounded by the calendar and not by its rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailweave.functions.dates import NO_MONTH
from mailweave.session import stage_path

#: Days of one stretch of time.
STRETCH = 7

#: Mails of a block of time in which intervals are counted, and how many blocks there are at most.
BLOCK_MAILS, BLOCKS = 250_000, 256


def _day(time: str) -> Column:
    return F.unix_date(F.col(time).cast("date"))


def _stretch(time: str) -> Column:
    return F.floor(_day(time) / STRETCH)


def _seconds(time: str) -> Column:
    """Whole seconds since 1970 on the wall clock, for dealing rows; times are compared exactly."""
    at = F.col(time)
    clock = F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)
    return _day(time).cast("long") * 86400 + clock


def _whole_seconds(interval: Column) -> Column:
    part = lambda unit: F.extract(F.lit(unit), interval)
    clock = part("HOUR") * 3600 + part("MINUTE") * 60 + F.floor(part("SECOND"))
    return part("DAY").cast("long") * 86400 + clock


def _known(columns: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])


# ---- as-of join -------------------------------------------------------------


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    time: str,
    strict: bool = False,
    within: int | None = None,
    name: str = "match",
) -> DataFrame:
    """Every row of ``left`` with the latest row of ``right`` of the same ``by`` at or before it.

    ``strict`` leaves out rows of the same instant, ``within`` those more than so many seconds
    before. Of several right rows of one instant the smallest counts, its columns compared in
    the order in which ``right`` has them. The match is a struct ``name`` of the right columns
    other than ``by``, null where there is none; a row with a null key or time has none. Rows of
    ``left`` are kept as they are, repeated ones too.

    Shuffles: instants of both sides by key and time, then by key and stretch; a row per key and
    stretch; and the left rows with the answers, where adaptive execution splits an instant that
    most rows share.
    """
    by, keys = list(by), [f"_by{i}" for i in range(len(by))]
    match = F.struct(*(c for c in right.columns if c not in by))

    def instants_of(rows: DataFrame, asked: bool, match: Column) -> DataFrame:
        named = [F.col(c).alias(k) for c, k in zip(by, keys, strict=True)]
        known = rows.where(_known([*by, time]))
        return known.select(*named, F.col(time).alias("_t"), F.lit(asked).alias("_asked"), match.alias("_match"))

    nothing = F.lit(None).cast(right.select(match.alias("m")).schema["m"].dataType)
    instants = (
        instants_of(left, True, nothing)
        .union(instants_of(right, False, match))
        .groupBy(*keys, _stretch("_t").alias("_stretch"), "_t")
        .agg(F.max("_asked").alias("_asked"), F.min("_match").alias("_match"))
    )
    past = Window.partitionBy(*keys, "_stretch").orderBy("_t")
    past = past.rowsBetween(Window.unboundedPreceding, -1 if strict else Window.currentRow)
    own = instants.withColumn("_own", F.last("_match", ignorenulls=True).over(past))
    # the last match of each stretch, and for every stretch that of the ones before
    latest = F.max_by("_match", F.when(F.col("_match").isNotNull(), F.col("_t")))
    stretches = instants.groupBy(*keys, "_stretch").agg(latest.alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = stretches.select(
        *keys, "_stretch", F.last("_last", ignorenulls=True).over(earlier).alias("_carried")
    )
    answers = (
        own.where("_asked")
        .join(carried, [*keys, "_stretch"])
        .select(*keys, "_t", F.coalesce("_own", "_carried").alias(name))
        .where(F.col(name).isNotNull())
    )
    if within is not None:
        since = F.col("_t") - F.make_dt_interval(secs=F.lit(within))
        answers = answers.where(F.col(f"{name}.{time}") >= since)
    pairs = zip([*by, time], [*keys, "_t"], strict=True)
    same = [F.col(f"l.{c}") == F.col(f"a.{k}") for c, k in pairs]
    return left.alias("l").join(answers.alias("a"), same, "left").select("l.*", f"a.{name}")


def reply_latency(parsed: DataFrame) -> DataFrame:
    """``msg_id, src, dst, sent_at, reply_to, latency`` of every copy of a mail of a known month.

    The mail replied to is the latest one that the recipient sent to the sender strictly before;
    among mails of the same second the one of smallest id. ``latency`` is in whole seconds. Both
    are null where the recipient had sent nothing before. A recipient listed twice is one copy.
    """
    people = F.array_distinct(F.concat("to", "cc"))
    copies = parsed.where(F.col("ym") != NO_MONTH).select(
        "msg_id", "src", F.explode(people).alias("dst"), "sent_at"
    )
    asked = copies.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "msg_id", "sent_at")
    found = asof_join(copies, asked, ["src", "dst"], "sent_at", strict=True)
    return found.select(
        "msg_id",
        "src",
        "dst",
        "sent_at",
        F.col("match.msg_id").alias("reply_to"),
        _whole_seconds(F.col("sent_at") - F.col("match.sent_at")).alias("latency"),
    )


# ---- interval join ----------------------------------------------------------


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    at: str,
    start: str,
    end: str,
    by: Sequence[str] = (),
    unit: int = 3600,
) -> DataFrame:
    """``point, interval``: every row of ``points`` with every interval that it lies in.

    An interval holds its start and not its end; intervals may overlap, and need not share a key
    (``by``). Each one is put in the buckets of time that it meets at the level where buckets,
    ``unit`` seconds doubled once per level, are as long as it is: two of them at most, however
    long it is. A point is in one bucket of every level there is, so the pairs come from an
    equi-join by level and bucket, and are then compared exactly. A crowded bucket is an ordinary
    skewed join. Rows with a null time or key, and intervals without length, have no pairs.
    """
    by = list(by)
    spans = intervals.where(_known([start, end, *by]) & (F.col(start) < F.col(end)))
    length = _seconds(end) - _seconds(start) + 1
    level = F.greatest(F.lit(0), F.ceil(F.log2(length / unit))).cast("int")
    spans = spans.select(F.struct("*").alias("interval"), level.alias("_level"), _seconds(start).alias("_s"),
                         _seconds(end).alias("_e"))
    # one row for each doubling of the unit up to the longest interval
    levels = sorted(row[0] for row in spans.select("_level").distinct().collect()) or [0]

    def bucket(seconds: Column, width: Column) -> Column:
        return seconds - F.pmod(seconds, width)

    width = (unit * F.pow(F.lit(2), F.col("_level"))).cast("long")
    met = F.sequence(bucket(F.col("_s"), width), bucket(F.col("_e"), width), width)
    spans = spans.select(
        "interval", "_level", F.explode(met).alias("_bucket"), *(F.col("interval")[c].alias(f"_by{i}") for i, c in enumerate(by))
    )
    own = F.array(
        *(
            F.struct(F.lit(n).alias("_level"), bucket(_seconds(at), F.lit(unit << n).cast("long")).alias("_bucket"))
            for n in levels
        )
    )
    placed = points.where(_known([at, *by])).select(
        F.struct("*").alias("point"), F.inline(own), *(F.col(c).alias(f"_by{i}") for i, c in enumerate(by))
    )
    keys = ["_level", "_bucket", *(f"_by{i}" for i in range(len(by)))]
    inside = (F.col("interval")[start] <= F.col("point")[at]) & (F.col("point")[at] < F.col("interval")[end])
    return placed.join(spans, keys).where(inside).select("point", "interval")


def _micros(time: Column, kind: T.DataType) -> Column:
    """Microseconds since 1970, of a time without zone on the wall clock."""
    if not isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(time)
    clock = F.unix_date(time.cast("date")).cast("long") * 86400 + F.hour(time) * 3600 + F.minute(time) * 60
    return clock * 1_000_000 + (F.extract(F.lit("SECOND"), time) * 1_000_000).cast("long")


def _of_micros(micros: Column, kind: T.DataType) -> Column:
    if not isinstance(kind, T.TimestampNTZType):
        return F.timestamp_micros(micros)
    day = F.floor(micros / 86_400_000_000)
    rest = ((micros - day * 86_400_000_000).cast("decimal(18,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(day.cast("int"), F.lit(0), F.lit(0), rest)


def _counts_in_blocks(answer: T.StructType):
    """Per query (a, b) of a block: the weights of its points with p >= a and q < b, and the first
    mail of the block in [a, b). All queries of a block go through the bits of q together."""
    names = answer.names

    def run(table):
        import numpy as np
        import pyarrow as pa

        asked = np.asarray(table["asked"])
        points, queries = table.filter(pa.array(~asked)), table.filter(pa.array(asked))
        p, q, a, b = (np.asarray(t[c]) for t in (points, queries) for c in ("p", "q"))
        order = np.argsort(p, kind="stable")
        p, q = p[order], q[order]
        weights = [np.asarray(points[c])[order] for c in ("mails", "again")]
        times = p[weights[0] > 0]
        at = np.searchsorted(times, a)
        first = np.append(times, np.iinfo(np.int64).max)[at]
        kinds, rank = np.unique(q, return_inverse=True)
        below = np.searchsorted(kinds, b)
        low, high = np.searchsorted(p, a), np.full(len(a), len(p))
        sums = [np.zeros(len(a), np.int64) for _ in weights]
        for bit in reversed(range(len(kinds).bit_length())):
            one = (rank >> bit & 1).astype(bool)
            zeros = np.append(0, np.cumsum(~one))
            up = (below >> bit & 1).astype(bool)
            for i, w in enumerate(weights):
                total = np.append(0, np.cumsum(np.where(one, 0, w)))
                sums[i] += np.where(up, total[high] - total[low], 0)
            low, high = (np.where(up, zeros[-1] + x - zeros[x], zeros[x]) for x in (low, high))
            order = np.concatenate((np.flatnonzero(~one), np.flatnonzero(one)))
            rank, weights = rank[order], [w[order] for w in weights]
        found = pa.array(first, pa.int64(), mask=first >= b)
        return pa.table([queries["id"], *(pa.array(x, pa.int64()) for x in sums), found], names=names)

    return run


def _block_of(bounds: Sequence[int]):
    @F.arrow_udf("int")
    def block(times):
        import numpy as np
        import pyarrow as pa

        return pa.array(np.searchsorted(np.array(bounds, np.int64), np.asarray(times), "right"), pa.int32())

    return block


def _kept(df: DataFrame, label: str) -> DataFrame:
    path = stage_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mails_in_intervals(parsed: DataFrame, intervals: DataFrame) -> DataFrame:
    """``id, mails, senders, first_at`` of every interval ``id, start, end`` with a mail in it.

    Mails are the valid ones of a known month, each once. Mails are counted and not paired: those
    of an interval whose sender has an earlier one in it are the pairs (p, q) of instants, each a
    sender's mail and its next one, that lie in the interval whole. Time is cut into blocks of as
    many mails. A pair is in the block of p and in that of q; an interval asks the block of its start
    for what starts there, that of its end for what ends there and starts in a later block than its
    start's, and the table of blocks (at most `BLOCKS` squared, on the driver) for the rest. So both sides grow with
    their rows alone. Intervals that share an id are one, and go through `interval_join`.
    """
    valid = parsed.where(F.col("skip_reason").isNull() & (F.col("ym") != NO_MONTH))
    mails = valid.where(F.col("sent_at").isNotNull()).select("src", "sent_at")
    kind = mails.schema["sent_at"].dataType
    instants = mails.groupBy("src", _stretch("sent_at").alias("stretch"), _micros(F.col("sent_at"), kind).alias("t"))
    instants = _kept(instants.agg(F.count("*").alias("mails")), "instants")
    known = intervals.where(_known(["start", "end"]) & (F.col("start") < F.col("end")))
    known = known.select("id", "start", "end", F.count("*").over(Window.partitionBy("id")).alias("times"))
    shared = known.where("times > 1").drop("times")
    found = _counted_in_intervals(instants, known.where("times = 1"), kind)
    if not shared.limit(1).count():
        return found
    pairs = interval_join(mails, shared, "sent_at", "start", "end")
    by_sender = pairs.groupBy(F.col("interval.id").alias("id"), "point.src").agg(
        F.count("*").alias("mails"), F.min("point.sent_at").alias("first_at")
    )
    return found.union(
        by_sender.groupBy("id").agg(
            F.sum("mails").alias("mails"), F.count("*").alias("senders"), F.min("first_at").alias("first_at")
        )
    )


def _counted_in_intervals(instants: DataFrame, intervals: DataFrame, kind: T.DataType) -> DataFrame:
    """`mails_in_intervals` of intervals that have an id each, from the senders' instants ``t``."""
    spark = instants.sparkSession
    total = instants.agg(F.coalesce(F.sum("mails"), F.lit(0))).first()[0]
    blocks = min(BLOCKS, 1 + total // BLOCK_MAILS)
    shares = [i / blocks for i in range(1, blocks)]
    bounds = sorted(set(instants.agg(F.percentile_approx("t", shares)).first()[0])) if shares and total else []
    block = _block_of(bounds)

    # a sender's mails in a row: of one instant, of one stretch, and of two stretches
    here = instants.select(F.col("t").alias("p"), F.col("t").alias("q"), "mails", (F.col("mails") - 1).alias("again"))
    inside, across = Window.partitionBy("src", "stretch").orderBy("t"), Window.partitionBy("src").orderBy("stretch")
    ends = instants.groupBy("src", "stretch").agg(F.min("t").alias("q"), F.max("t").alias("last"))
    once = (F.lit(0).cast("long").alias("mails"), F.lit(1).cast("long").alias("again"))
    nexts = instants.select(F.lag("t").over(inside).alias("p"), F.col("t").alias("q"), *once)
    nexts = nexts.union(ends.select(F.lag("last").over(across).alias("p"), "q", *once)).where("p IS NOT NULL")
    points = here.union(nexts).groupBy("p", "q").agg(F.sum("mails").alias("mails"), F.sum("again").alias("again"))
    points = _kept(points.select("*", block("p").alias("bp"), block("q").alias("bq")), "points")

    start, end = (_micros(F.col(c).cast(kind), kind) for c in ("start", "end"))
    asked = intervals.select("id", start.alias("p"), end.alias("q"))
    asked = _kept(asked.select("*", block("p").alias("bp"), block("q").alias("bq")), "asked")

    def rows(table: DataFrame, side: int, where: str, asked: bool, p: Column) -> DataFrame:
        counts = (F.lit(0).cast("long").alias(c) if asked else F.col(c) for c in ("mails", "again"))
        name = F.col("id") if asked else F.lit(None).cast(intervals.schema["id"].dataType).alias("id")
        return table.select(F.lit(side).alias("side"), F.col(where).alias("block"), F.lit(asked).alias("asked"),
                            name, p.alias("p"), "q", *counts)

    longer = asked.where("bq > bp")
    later = F.get(F.lit(bounds).cast("array<long>"), F.col("bp"))
    placed = rows(points, 0, "bp", False, F.col("p")).union(rows(points, 1, "bq", False, F.col("p")))
    placed = placed.union(rows(asked, 0, "bp", True, F.col("p"))).union(rows(longer, 1, "bq", True, later))
    answer = T.StructType([T.StructField("id", intervals.schema["id"].dataType)])
    answer = answer.add("mails", "long").add("again", "long").add("first", "long")
    parts = placed.groupBy("side", "block").applyInArrow(_counts_in_blocks(answer), answer)
    if len(bounds) > 1:
        between = _between_blocks(points, len(bounds) + 1)
        rows_between = spark.createDataFrame(between, "bp int, bq int, mails long, again long, first long")
        whole = longer.join(F.broadcast(rows_between), ["bp", "bq"])
        parts = parts.union(whole.select("id", "mails", "again", "first"))
    sums = parts.groupBy("id").agg(F.sum("mails").alias("mails"), F.sum("again").alias("again"), F.min("first").alias("first"))
    return sums.where("mails > 0").select(
        "id", "mails", (F.col("mails") - F.col("again")).alias("senders"), _of_micros(F.col("first"), kind).alias("first_at")
    )


def _between_blocks(points: DataFrame, blocks: int) -> list[tuple]:
    """(bp, bq, mails, again, first) of all that lies in the blocks between any two."""
    cells = points.groupBy("bp", "bq").agg(
        F.sum("mails"), F.sum("again"), F.min(F.when(F.col("mails") > 0, F.col("p")))
    )
    sums = [[[0] * (blocks + 1) for _ in range(blocks + 2)] for _ in range(2)]
    firsts: dict[int, int] = {}
    for bp, bq, *counts, first in cells.collect():
        for table, n in zip(sums, counts):
            table[bp][bq] = n
        if first is not None:
            firsts[bp] = first
    # from here on a cell holds all that starts in its block or later and ends in its block or earlier
    for table in sums:
        for i in reversed(range(blocks)):
            for j in range(blocks):
                left = table[i][j - 1] - table[i + 1][j - 1] if j else 0
                table[i][j] += table[i + 1][j] + left
    rows = []
    for i in range(blocks):
        least = None
        for j in range(i + 2, blocks):
            if j - 1 in firsts:
                least = firsts[j - 1] if least is None else min(least, firsts[j - 1])
            rows.append((i, j, sums[0][i + 1][j - 1], sums[1][i + 1][j - 1], least))
    return rows


# ---- sessions ---------------------------------------------------------------


def sessions(
    events: DataFrame, by: Sequence[str], time: str, gap: int, sums: Sequence[str] = ()
) -> DataFrame:
    """``by…, started, ended, events, sums…``: runs of a key's events without a longer pause
    than ``gap`` seconds. Events with a null key or time are in none.

    Sessions are formed within each stretch of time first. Only the first and the last one of a
    stretch can go on in another, so those alone are merged by key; the others are done.
    """
    by, pause = list(by), F.make_dt_interval(secs=F.lit(gap))
    totals = ["events", *sums]

    def runs(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Rows ``keys…, started, ended, totals…`` merged where the pause is no longer."""
        order = Window.partitionBy(*keys).orderBy("started")
        fresh = F.col("started") - F.lag("ended").over(order) > pause
        numbered = rows.withColumn("_fresh", F.coalesce(fresh, F.lit(False)).cast("int"))
        numbered = numbered.withColumn("_run", F.sum("_fresh").over(order))
        return numbered.groupBy(*keys, "_run").agg(
            F.min("started").alias("started"), F.max("ended").alias("ended"), *(F.sum(c).alias(c) for c in totals)
        )

    instants = (
        events.where(_known([*by, time]))
        .groupBy(*by, _stretch(time).alias("_stretch"), F.col(time).alias("started"))
        .agg(F.count("*").alias("events"), *(F.sum(c).alias(c) for c in sums))
        .withColumn("ended", F.col("started"))
    )
    parts = runs(instants, [*by, "_stretch"])
    whole = Window.partitionBy(*by, "_stretch")
    parts = parts.withColumn("_edge", (F.col("_run") == 0) | (F.col("_run") == F.max("_run").over(whole)))
    edge = parts.where("_edge").select(*by, "started", "ended", *totals)
    result = [*by, "started", "ended", *totals]
    return runs(edge, by).select(*result).union(parts.where(~F.col("_edge")).select(*result))


def conversation_sessions(parsed: DataFrame, gap: int) -> DataFrame:
    """``a, b, started, ended, mails, from_a`` of each burst of mails between two people.

    ``a`` is the smaller address; mails in both directions count, one for a recipient listed
    twice. A pause of more than ``gap`` seconds ends a burst.
    """
    people = F.array_distinct(F.concat("to", "cc"))
    copies = parsed.where(F.col("ym") != NO_MONTH).select("src", F.explode(people).alias("dst"), "sent_at")
    pairs = copies.select(
        F.least("src", "dst").alias("a"),
        F.greatest("src", "dst").alias("b"),
        "sent_at",
        (F.col("src") < F.col("dst")).cast("long").alias("from_a"),
    )
    return sessions(pairs, ["a", "b"], "sent_at", gap, ["from_a"]).withColumnRenamed("events", "mails")


# ---- sliding windows and streaks --------------------------------------------


def rolling_activity(parsed: DataFrame, days: int = 28, step: int = 7) -> DataFrame:
    """``email, window_start, mails, copies`` of every sender and window of ``days`` days, one
    beginning every ``step`` days since 1970, in which the sender wrote.

    Mails are summed per sender and step before they are dealt to the ``days / step`` windows
    that a step belongs to, so a mail is never copied.
    """
    if days % step:
        raise ValueError("days must be a multiple of step")
    mails = parsed.where(F.col("skip_reason").isNull() & (F.col("ym") != NO_MONTH))
    steps = mails.groupBy(F.col("src").alias("email"), F.floor(_day("sent_at") / step).cast("int").alias("n")).agg(
        F.count("*").alias("mails"), F.sum(F.size("to") + F.size("cc")).alias("copies")
    )
    windows = F.transform(
        F.sequence(F.col("n") - (days // step - 1), F.col("n")), lambda n: F.date_from_unix_date(n * step)
    )
    return (
        steps.select("email", F.explode(windows).alias("window_start"), "mails", "copies")
        .groupBy("email", "window_start")
        .agg(F.sum("mails").alias("mails"), F.sum("copies").alias("copies"))
    )


def active_streaks(parsed: DataFrame) -> DataFrame:
    """``email, months, longest_streak, longest_silence, first_month, last_month`` per sender.

    A streak is a run of months with a valid mail, a silence one of months without between two
    months with. Months are made distinct first: a person has at most those of the year gate.
    """
    mails = parsed.where(F.col("skip_reason").isNull() & (F.col("ym") != NO_MONTH))
    months = mails.select(F.col("src").alias("email"), "ym").distinct()
    number = F.substring("ym", 1, 4).cast("int") * 12 + F.substring("ym", 6, 2).cast("int")
    order = Window.partitionBy("email").orderBy("n")
    islands = months.withColumn("n", number).select(
        "email",
        "ym",
        (F.col("n") - F.row_number().over(order)).alias("island"),
        (F.col("n") - F.lag("n").over(order) - 1).alias("silence"),
    )
    runs = islands.groupBy("email", "island").agg(
        F.count("*").alias("months"),
        F.max("silence").alias("silence"),
        F.min("ym").alias("first_month"),
        F.max("ym").alias("last_month"),
    )
    return runs.groupBy("email").agg(
        F.sum("months").alias("months"),
        F.max("months").alias("longest_streak"),
        F.coalesce(F.max("silence"), F.lit(0)).alias("longest_silence"),
        F.min("first_month").alias("first_month"),
        F.max("last_month").alias("last_month"),
    )
