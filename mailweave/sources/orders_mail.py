"""A mail corpus derived from the ``orders`` and ``lineitem`` tables.

Every order is a mail from its customer to the parts of its lines; customers
and parts share one id space. ``edges`` derives the edge multiset straight from
the tables, ``messages`` renders the same mails as raw text to be parsed back.

An order is one mail, whatever its number of lines. Both tables grow with the
data, so they are merged and neither is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailweave.functions.dates import NO_MONTH

# Zones that the Date headers of the mails use by turns, with their offset in minutes.
ZONES = [
    ("+0000 (UTC)", 0), ("-0700 (PDT)", -420), ("+0530", 330), ("CET", 60),
    ("GMT-05:00", -300), ("EST", -300), ("+0200 (CEST)", 120),
]


def address(number: Column) -> Column:
    return F.concat(F.lit("p"), number.cast("string"), F.lit("@en.example.com"))


def _clock(instant: str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a timestamp without zone, whatever the session's zone."""
    return F.col(instant).cast("string")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``k, line, person, cc`` of every line."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_orderkey").alias("k"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("person"),
        (F.col("l_returnflag") == "R").alias("cc"),
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``k, sender, sent`` of every order; the hour is the key modulo 24."""
    key = F.col("o_orderkey")
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        key.alias("k"),
        F.col("o_custkey").alias("sender"),
        (
            F.col("o_orderdate").cast("timestamp_ntz")
            + F.make_dt_interval(hours=(key % 24).cast("int"))
        ).alias("sent"),
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``src, dst, type, ym`` by the rules of the mails, without any text.

    Lines move once, to their order; before that only one row per order and task
    tells whether the order has a To.
    """
    lines = _lines(spark, sf_dir)
    has_to = lines.where(~F.col("cc")).select("k").distinct()
    mails = _orders(spark, sf_dir).where(F.col("k") % 101 != 0).join(
        has_to.hint("merge"), "k", "left_semi"
    )
    known = (F.col("k") % 97 != 0) & F.year("sent").between(1998, 2002)
    return (
        lines.where(F.col("person") % 50 != 0)
        .join(mails.hint("merge"), "k")
        .where(F.col("person") != F.col("sender"))
        .select(
            address(F.col("sender")).alias("src"),
            address(F.col("person")).alias("dst"),
            F.when(F.col("cc"), "cc").otherwise("to").alias("type"),
            F.when(known, F.substring(_clock("sent"), 1, 7)).otherwise(NO_MONTH).alias("ym"),
        )
    )


def _token(line: Column, person: Column) -> Column:
    """A recipient as it stands in a header: plain, upper case or named."""
    plain = address(person)
    named = F.concat(F.lit("Person "), person.cast("string"), F.lit(" <"), plain, F.lit(">"))
    department = F.concat(F.lit("department: part "), person.cast("string"))
    return (
        F.when(person % 50 == 0, department)
        .when(line % 3 == 1, F.upper(plain))
        .when(line % 3 == 2, named)
        .otherwise(plain)
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw message table ``file, message``."""
    def recipient(line: Column) -> Column:
        return F.struct(line["line"], line["cc"], _token(line["line"], line["person"]).alias("token"))

    # numbers move to their order, and become text there
    lines = F.collect_list(F.struct("line", "cc", "person"))
    mails = _lines(spark, sf_dir).groupBy("k").agg(lines.alias("lines"))
    mails = mails.select("k", F.sort_array(F.transform("lines", recipient)).alias("all"))

    def field(name: str, cc: bool) -> Column:
        kept = F.filter("all", lambda line: line["cc"] == F.lit(cc))
        mark = F.when(F.col("k") % 5 == 2, ";\n\t").otherwise(",\n\t")
        tokens = F.array_join(F.transform(kept, lambda line: line["token"]), "\x01")
        tokens = F.replace(tokens, F.lit("\x01"), mark)
        value = F.concat(F.lit(f"{name}: "), tokens, F.lit("\n"))
        return F.when(F.size(kept) > 0, value).otherwise("")

    turn = (F.col("k") % len(ZONES)).cast("int")
    zone = F.array(*(F.lit(name) for name, _ in ZONES))[turn]
    offset = F.array(*(F.lit(minutes) for _, minutes in ZONES))[turn]
    local = F.col("sent") + F.make_dt_interval(mins=offset)
    clock = local.cast("string")
    day = F.date_format(local.cast("date"), "EEE, d MMM ")
    year = F.when(F.col("k") % 97 == 0, "0001").otherwise(F.substring(clock, 1, 4))
    time = F.substring(clock, 11, 9)
    sender = F.when(F.col("k") % 101 == 0, "system").otherwise(address(F.col("sender")))
    key = F.col("k").cast("string")
    text = F.concat(
        F.lit("Message-ID: <"), key, F.lit("@en.example.com>\nDate: "),
        day, year, time, F.lit(" "), zone, F.lit("\nFrom: "), sender, F.lit("\n"),
        F.coalesce(field("To", False), F.lit("")),
        F.lit("Subject: order "), key, F.lit("\n"),
        F.coalesce(field("Cc", True), F.lit("")),
        F.lit('X-From: "Sales"\n\nOrder '), key,
        F.lit(' is "on its way".\n\n  To: whom it may concern, no header\nRegards\n'),
    )
    orders = _orders(spark, sf_dir).hint("merge").join(mails.hint("merge"), "k", "left")
    return orders.select(
        F.concat(F.lit("mail/"), key, F.lit(".")).alias("file"), text.alias("message")
    )


def odd_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second corpus ``file, message``, one mail per order, of what the first one never shows.

    By the order's key modulo 12: blank mails, none at all, no From, no Date, CRLF line ends, a To
    that stands in the body alone, a sender that is no address, no To, a time of millions of
    seconds, zones by name, a header in lower case, and a list with an empty entry, the sender
    and an address without a dot.
    """
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        key.alias("k"),
        address(cust).alias("s"),
        address(cust + 1).alias("a"),
        address(cust + 2).alias("b"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("sent"),
    )
    day = F.date_format(F.col("sent").cast("date"), "EEE, d MMM ")
    date = F.concat(F.lit("Date: "), day, F.substring(_clock("sent"), 1, 4), F.lit(" 09:30:15 "))
    zone = F.element_at(
        F.array(*(F.lit(z) for z in ("PKT", "Pacific Standard Time", "Europe/Paris"))),
        (F.floor(F.col("k") / 12) % 3 + 1).cast("int"),
    )
    forms = [
        ["  \n\t \n"],
        [F.lit(None).cast("string")],
        [date, "+0000\nTo: ", F.col("a"), "\nSubject: none\n\nbody\n"],
        ["From: ", F.col("s"), "\nTo: ", F.col("a"), ", ", F.col("b"), "\n\nno date\n"],
        ["From: ", F.col("s"), "\r\nTo: ", F.col("a"), ",\r\n\t", F.col("b"), "\r\n", date, "+0000\r\n\r\nbody\r\n"],
        ["From: ", F.col("s"), "\n", date, "+0000\nCc: ", F.col("b"), "\n\nForwarded:\nTo: ", F.col("a"), "\nbye\n"],
        ["From: mailer daemon\nTo: ", F.col("a"), "\n", date, "+0000\n\nbody\n"],
        ["From: ", F.col("s"), "\nCc: ", F.col("a"), "\n", date, "+0000\n\nbody\n"],
        ["From: ", F.col("s"), "\nTo: ", F.col("a"), "\nDate: Mon, 1 Jan 2001 00:00:",
         (F.col("k") + 10_000_000).cast("string"), " +0000\n\nbody\n"],
        ["From: ", F.col("s"), "\nTo: ", F.col("a"), "\n", date, zone, "\n\nbody\n"],
        ["from: ", F.col("s"), "\nTo: ", F.col("a"), "\n", date, "+0000\n\nbody\n"],
        ["From: Some One <", F.col("s"), ">\nTo: Other <", F.col("a"), ">; ", F.col("a"), " ;, bad@host, ", F.col("s"),
         "\n", date, "-0930 (somewhere)\n\nbody\n"],
    ]
    message = F.lit(None).cast("string")
    for number, form in enumerate(forms):
        text = F.concat(*(F.lit(x) if isinstance(x, str) else x for x in form))
        message = F.when(F.col("k") % len(forms) == number, text).otherwise(message)
    return orders.select(
        F.concat(F.lit("odd/"), F.col("k").cast("string"), F.lit(".")).alias("file"), message.alias("message")
    )
