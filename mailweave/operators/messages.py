"""From raw messages to the edge multiset, the directory and the quality report.

Everything up to the edge table is narrow: one pass over the messages, no
shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailweave.functions import (
    clean_address,
    header,
    is_valid_address,
    sent_at,
    sent_hour,
    sent_month,
    valid_recipients,
)
from mailweave.functions.dates import NO_MONTH
from mailweave.functions.text import BLANKS

EDGE_COLUMNS = ["src", "dst", "type", "ym"]


def header_fields(messages: DataFrame, headers_only: bool = False) -> DataFrame:
    """``file, is_blank, from_text, to_text, cc_text, date_text`` of every message."""
    text = F.ltrim(F.coalesce(F.col("message"), F.lit("")), F.lit(BLANKS))
    if headers_only:
        # cut once and not for every field
        searched = F.split(F.concat(F.lit("\n"), text), r"\n\r?\n", 2)[0]
        messages = messages.select("file", (text == "").alias("is_blank"), searched.alias("searched"))
    else:
        messages = messages.select("file", (text == "").alias("is_blank"), text.alias("searched"))
    message = F.col("searched")
    return messages.select(
        "file",
        "is_blank",
        header(message, "From").alias("from_text"),
        header(message, "To").alias("to_text"),
        header(message, "Cc").alias("cc_text"),
        header(message, "Date").alias("date_text"),
    )


def mapped_fields(mails: DataFrame) -> DataFrame:
    """`header_fields` of mails whose headers are a map (``file, headers``).

    The first value of a name counts. A mail without a map is blank, one with an empty map is not.
    """

    def first(name: str):
        values = F.col("headers")[name]
        return F.coalesce(F.get(values, F.lit(0)), F.lit(""))

    return mails.select(
        "file",
        F.col("headers").isNull().alias("is_blank"),
        first("From").alias("from_text"),
        first("To").alias("to_text"),
        first("Cc").alias("cc_text"),
        first("Date").alias("date_text"),
    )


def gate_messages(fields: DataFrame) -> DataFrame:
    """Add the sender ``src`` and why the mail is skipped (NULL if it is not)."""
    reason = (
        F.when(F.col("is_blank"), "blank_message")
        .when(F.col("src") == "", "no_sender")
        .when(F.col("to_text") == "", "no_recipient_field")
        .when(~is_valid_address(F.col("src")), "invalid_sender")
    )
    return fields.withColumn("src", F.lower(clean_address(F.col("from_text")))).withColumn(
        "skip_reason", reason
    )


def parse_messages(
    messages: DataFrame,
    tz: str = "UTC",
    years: tuple[int, int] = (1998, 2002),
    headers_only: bool = False,
) -> DataFrame:
    """One row per message: ``msg_id, src, to, cc, sent_at, ym, hour, skip_reason``.

    Month and hour are those of the zone ``tz``. Recipients of a skipped mail
    are empty. Nothing but this table is needed for edges and features, so the
    message bodies are read once.
    """
    return parse_fields(header_fields(messages, headers_only), tz, years)


def parse_fields(
    fields: DataFrame, tz: str = "UTC", years: tuple[int, int] = (1998, 2002)
) -> DataFrame:
    """`parse_messages` of fields that are cut out already, by `header_fields` or from a map."""
    gated = gate_messages(fields)
    nobody = F.array().cast("array<string>")

    def recipients(field: str):
        kept = valid_recipients(F.col(field), F.col("src"))
        return F.when(F.col("skip_reason").isNull(), kept).otherwise(nobody)

    return gated.select(
        F.col("file").alias("msg_id"),
        "src",
        recipients("to_text").alias("to"),
        recipients("cc_text").alias("cc"),
        sent_at(F.col("date_text")).alias("sent_at"),
        "skip_reason",
    ).select(
        "msg_id",
        "src",
        "to",
        "cc",
        "sent_at",
        sent_month(F.col("sent_at"), tz, *years).alias("ym"),
        sent_hour(F.col("sent_at"), tz).alias("hour"),
        "skip_reason",
    )


def explode_recipients(parsed: DataFrame) -> DataFrame:
    """One row per copy: ``msg_id, src, dst, type, sent_at, ym, hour``.

    Skipped mails have no recipients, so they need no filter here.
    """
    copies = F.concat(
        F.transform("to", lambda dst: F.struct(dst.alias("dst"), F.lit("to").alias("type"))),
        F.transform("cc", lambda dst: F.struct(dst.alias("dst"), F.lit("cc").alias("type"))),
    )
    return parsed.select("msg_id", "src", F.inline(copies), "sent_at", "ym", "hour")


def build_edges(parsed: DataFrame) -> DataFrame:
    """The edge multiset ``src, dst, type, ym``."""
    return explode_recipients(parsed).select(*EDGE_COLUMNS)


def persons(parsed: DataFrame) -> DataFrame:
    """Directory: every sender of a valid mail and every valid recipient."""
    everyone = F.when(F.col("skip_reason").isNull(), F.concat(F.array("src"), "to", "cc"))
    return parsed.select(F.explode(everyone).alias("email")).distinct()


def skip_reasons(parsed: DataFrame) -> DataFrame:
    """Mails per skip reason; ``valid`` for those kept."""
    reason = F.coalesce("skip_reason", F.lit("valid")).alias("skip_reason")
    return parsed.groupBy(reason).agg(F.count("*").alias("mails"))


def ingest_metrics(parsed: DataFrame) -> DataFrame:
    """``metric, value``: mails, valid, skipped, edges, persons, NA dates.

    One pass over the parsed mails. Each mail gives one row with its counters
    and no address, and one row per address without counters, so a single
    aggregation by address carries the sums and the distinct persons.
    """
    valid = F.col("skip_reason").isNull()
    counters = {
        "mails": F.lit(1),
        "valid": F.when(valid, 1).otherwise(0),
        "skipped": F.when(valid, 0).otherwise(1),
        "edges": F.when(valid, F.size("to") + F.size("cc")).otherwise(0),
        "na_dates": F.when(valid & (F.col("ym") == NO_MONTH), 1).otherwise(0),
    }

    def row(email, values):
        named = [value.cast("bigint").alias(name) for name, value in values.items()]
        return F.struct(email.cast("string").alias("email"), *named)

    zeros = dict.fromkeys(counters, F.lit(0))
    everyone = F.when(valid, F.concat(F.array("src"), "to", "cc"))
    people = F.coalesce(everyone, F.array().cast("array<string>"))
    rows = F.concat(
        F.array(row(F.lit(None), counters)),
        F.transform(F.array_distinct(people), lambda email: row(email, zeros)),
    )
    by_email = (
        parsed.select(F.inline(rows))
        .groupBy("email")
        .agg(*[F.sum(name).alias(name) for name in counters])
    )
    totals = by_email.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counters],
        F.count("email").alias("persons"),
    )
    return totals.unpivot([], [*counters, "persons"], "metric", "value")
