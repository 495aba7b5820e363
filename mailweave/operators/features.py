"""Behavioural features per person, from the parsed mails.

One pass over the mails counts copies per (sender, recipient) and mails per
(sender, month); those counts are then summed to the persons at either end. No
distinct count runs over the raw copies and no person's rows are gathered in
one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailweave.functions import ratio
from mailweave.functions.dates import NO_MONTH

FEATURES = [
    "recvCount",
    "outDegree",
    "inDegree",
    "nightRatio",
    "sendRecvRatio",
    "activeMonths",
    "avgSentPerMonth",
]

COUNTS = ["sent", "recv", "out_degree", "in_degree", "night", "active_months"]


def mail_facts(parsed: DataFrame, night: tuple[int, int] = (0, 6)) -> DataFrame:
    """``src, dst, ym, copies, night``: what each mail adds, counted per key.

    A pair has ``dst`` and no ``ym``; a month in which a person sent a mail has
    ``ym`` and no ``dst``, and is there for mails without valid recipients too.
    """
    hour = F.col("hour")
    at_night = F.when((hour >= night[0]) & (hour < night[1]), 1).otherwise(0)

    def fact(dst, ym, copies, night_copies):
        return F.struct(
            dst.cast("string").alias("dst"),
            ym.cast("string").alias("ym"),
            copies.cast("bigint").alias("copies"),
            night_copies.cast("bigint").alias("night"),
        )

    none, zero = F.lit(None), F.lit(0)
    copies = F.transform(
        F.concat("to", "cc"), lambda dst: fact(dst, none, F.lit(1), at_night)
    )
    facts = F.concat(copies, F.array(fact(none, F.col("ym"), zero, zero)))
    kept = F.when(F.col("skip_reason").isNull(), facts)
    return (
        parsed.select("src", F.inline(kept))
        .groupBy("src", "dst", "ym")
        .agg(F.sum("copies").alias("copies"), F.sum("night").alias("night"))
    )


def _row(email, **counts):
    """One person's share of the counts, the others being 0."""
    values = [counts.get(name, F.lit(0)).cast("bigint").alias(name) for name in COUNTS]
    return F.struct(email.alias("email"), *values)


def person_counts(parsed: DataFrame, night: tuple[int, int] = (0, 6)) -> DataFrame:
    """Everyone who sent or received, with the six counts the features need.

    ``sent``, ``recv`` and ``night`` count copies; a sender whose mails had no
    valid recipient is kept with zeros.
    """
    src, dst, one = F.col("src"), F.col("dst"), F.lit(1)
    sender = _row(src, sent=F.col("copies"), night=F.col("night"), out_degree=one)
    recipient = _row(dst, recv=F.col("copies"), in_degree=one)
    month = _row(src, active_months=F.when(F.col("ym") != NO_MONTH, 1).otherwise(0))
    rows = F.when(dst.isNull(), F.array(month)).otherwise(F.array(sender, recipient))
    return (
        mail_facts(parsed, night)
        .select(F.inline(rows))
        .groupBy("email")
        .agg(*[F.sum(name).alias(name) for name in COUNTS])
    )


def _copies(parsed: DataFrame, night: tuple[int, int] = (0, 6)) -> DataFrame:
    """Copies sent, received and sent at night per person; one shuffle, on the person."""
    hour, zero, one = F.col("hour"), F.lit(0), F.lit(1)
    sent = F.size("to") + F.size("cc")
    at_night = F.when((hour >= night[0]) & (hour < night[1]), sent).otherwise(0)

    def share(email, sent, recv, night_copies):
        return F.struct(
            email.alias("email"),
            sent.cast("bigint").alias("sent"),
            recv.cast("bigint").alias("recv"),
            night_copies.cast("bigint").alias("night"),
        )

    recipients = F.transform(F.concat("to", "cc"), lambda dst: share(dst, zero, one, zero))
    shares = F.concat(F.array(share(F.col("src"), sent, zero, at_night)), recipients)
    return (
        parsed.where(F.col("skip_reason").isNull())
        .select(F.inline(shares))
        .groupBy("email")
        .agg(*[F.sum(name).alias(name) for name in ("sent", "recv", "night")])
    )


def sent_recv(parsed: DataFrame) -> DataFrame:
    """Copies sent and received per person."""
    return _copies(parsed).select("email", "sent", "recv")


def degrees(parsed: DataFrame) -> DataFrame:
    """Distinct recipients and distinct senders per person."""
    return person_counts(parsed).select("email", "out_degree", "in_degree")


def night_ratio(parsed: DataFrame, night: tuple[int, int] = (0, 6)) -> DataFrame:
    """Copies sent at night, and their share of the copies sent."""
    return _copies(parsed, night).select(
        "email", "night", ratio(F.col("night"), F.col("sent")).alias("nightRatio")
    )


def active_months(parsed: DataFrame) -> DataFrame:
    """Number of known months in which a person sent a mail."""
    kept = F.col("skip_reason").isNull()
    months = F.filter(F.array("ym"), lambda month: month != NO_MONTH)
    people = F.concat(
        F.array(F.struct(F.col("src").alias("email"), F.get(months, F.lit(0)).alias("ym"))),
        F.transform(
            F.concat("to", "cc"),
            lambda dst: F.struct(dst.alias("email"), F.lit(None).cast("string").alias("ym")),
        ),
    )
    # (person, month) once per task, then once; a month of NULL keeps the person
    each = parsed.where(kept).select(F.inline(people)).distinct()
    return each.groupBy("email").agg(F.count("ym").alias("activeMonths"))


def person_features(parsed: DataFrame, night: tuple[int, int] = (0, 6)) -> DataFrame:
    """The seven features of everyone: ``email`` and the columns of ``FEATURES``."""
    sent, recv = F.col("sent"), F.col("recv")
    return person_counts(parsed, night).select(
        "email",
        recv.alias("recvCount"),
        F.col("out_degree").alias("outDegree"),
        F.col("in_degree").alias("inDegree"),
        ratio(F.col("night"), sent).alias("nightRatio"),
        ratio(sent, sent + recv).alias("sendRecvRatio"),
        F.col("active_months").alias("activeMonths"),
        ratio(sent, F.col("active_months")).alias("avgSentPerMonth"),
    )
