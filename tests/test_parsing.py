"""Header, address and date rules on hand-written cases."""

import datetime

import pytest
from pyspark.sql import functions as F

from mailweave.functions import (
    clean_address,
    header,
    is_valid_address,
    quarter_of,
    sent_at,
    sent_hour,
    sent_month,
    trim_blanks,
)
from mailweave.operators import build_edges, ingest_metrics, parse_messages, persons, skip_reasons


def evaluate(spark, values, *expressions):
    """Rows of the expressions over one string column ``v``, in input order."""
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    columns = [e(F.col("v")).alias(f"c{n}") for n, e in enumerate(expressions)]
    rows = df.select("i", *columns).orderBy("i").collect()
    return [row[1] if len(columns) == 1 else tuple(row[1:]) for row in rows]


def mails(spark, *texts):
    rows = [(f"m{i}", text) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "file string, message string")


def edges_of(spark, *texts, **options):
    rows = build_edges(parse_messages(mails(spark, *texts), **options)).collect()
    return sorted((row.src, row.dst, row.type) for row in rows)


TO_CASES = {
    "From: x@y.z\nTo: a@b.com": "a@b.com",
    "To: a@b.com,\n\tc@d.com\nCc: e@f.g": "a@b.com, c@d.com",
    "To: a@b.com,\r\n c@d.com\r\nCc: e@f.g\r\n": "a@b.com, c@d.com",
    "To:\n a@b.com": "a@b.com",
    "To: a\n \t \n b": "a  b",
    "X-To: no@no.no\nTO: no@no.no\nto: no@no.no": "",
    " \n\tTo: first@line.com": "first@line.com",
    "From: a@b.c\n\nforwarded\nTo: body@x.com\n": "body@x.com",
    "Subject: x\n To: folded@x.com\nTo: real@x.com": "real@x.com",
    "To: one@x.com\nTo: two@x.com": "one@x.com",
    "To: \nCc: x@y.z\n\nTo: body@x.com": "",
    "": "",
    None: "",
    "To: end@x.com": "end@x.com",
    "To: a\rb@x.com\r\n": "a\rb@x.com",
}


def test_header(spark):
    found = evaluate(spark, TO_CASES, lambda v: header(v, "To"))
    assert found == list(TO_CASES.values())


def test_header_stops_at_the_empty_line_if_asked(spark):
    texts = [
        "From: a@b.c\n\nTo: body@x.com",
        "From: a@b.c\r\n\r\nTo: body@x.com",
        "From: a@b.c\nTo: head@x.com\n\n folded body",
    ]
    found = evaluate(spark, texts, lambda v: header(v, "To", headers_only=True))
    assert found == ["", "", "head@x.com"]


def test_header_folded_over_very_many_lines(spark):
    text = "To: a0@x.com" + "".join(f",\n\ta{i}@x.com" for i in range(1, 50_000)) + "\n\nbody"
    df = mails(spark, "From: s@x.com\n" + text)
    assert build_edges(parse_messages(df)).count() == 50_000


def test_long_body_of_blanks_and_dots(spark):
    body = "\n" + " " * 200_000 + "x\n" + "." * 200_000
    assert edges_of(spark, "From: s@x.com\nTo: a@" + "." * 100_000 + " x, b@c.d\n" + body) == [
        ("s@x.com", "b@c.d", "to")
    ]


CLEAN = {
    "Legal Team <foo@bar.com>": "foo@bar.com",
    "  foo@bar.com\t": "foo@bar.com",
    "Name <>": "",
    "x> <y@z.com": "x> <y@z.com",
    "<a> <b>": "a",
    "< a@b.c >": "a@b.c",
    "<a@b.c": "<a@b.c",
    "a>": "a>",
    "": "",
}


def test_clean_address(spark):
    assert evaluate(spark, CLEAN, clean_address) == list(CLEAN.values())


VALID = ["a@b.c", "a@b.", "a@.", "'q'@x.com", '"joe"@x.com', "a.b@c.d.e", "a\tb@c.d", "é@ü.x"]
INVALID = [
    "", "a", "a@b@c.com", "@y.com", "a@", "x@y", "a.b@c", "a b@c.com", "a@b c.d", "a:b@c.d",
    "a@b.c>", "<a@b.c", "a@@b.c", "department: ena legal",
]


def test_address_validity(spark):
    assert evaluate(spark, VALID + INVALID, is_valid_address) == [True] * len(VALID) + [
        False
    ] * len(INVALID)


def test_trim_takes_all_control_characters(spark):
    assert evaluate(spark, ["\x00\t a b \x1f\r\n", "\x7f"], trim_blanks) == [
        "a b",
        "\x7f",
    ]


def utc(*fields):
    return datetime.datetime(*fields)


DATES = {
    "Mon, 14 May 2001 16:39:00 -0700 (PDT)": utc(2001, 5, 14, 23, 39),
    "Mon, 14 May 2001 16:39:00 -0700": utc(2001, 5, 14, 23, 39),
    "mon, 4 MAY 2001 6:39:00 +0530 trailing text": utc(2001, 5, 4, 1, 9),
    "Monday,  14  September  2001  16:39:00  GMT": utc(2001, 9, 14, 16, 39),
    "Mon, 14 May 2001 16:39:00 PDT": utc(2001, 5, 14, 23, 39),
    "Mon, 14 May 2001 16:39:00 GMT+2:00": utc(2001, 5, 14, 14, 39),
    "Wed, 31 Feb 2001 00:00:00 +0000": utc(2001, 3, 3),
    "Mon, 14 May 2001 25:61:61 +0000": utc(2001, 5, 15, 2, 2, 1),
    "Mon, 14 May 0001 16:39:00 -0700": utc(1, 5, 14, 23, 39),
    "Mon, 14 May 1 16:39:00 -0700": utc(1, 5, 14, 23, 39),
    "": None,
    "junk": None,
    "14 May 2001 16:39:00 -0700": None,
    "Mon,14 May 2001 16:39:00 -0700": None,
    "Mon, 14 May 2001 16:39:00": None,
    "Mon, 14 May 2001 16:39 -0700": None,
    "Mon, 14 Mai 2001 16:39:00 -0700": None,
    "Mon, 14 May 2001 16:39:00 -07:00": None,
    "1 May 2001 16 39 00 +0000": None,
    None: None,
}


def test_sent_at(spark):
    assert evaluate(spark, DATES, sent_at) == list(DATES.values())


MONTH_HOUR = {
    ("Mon, 14 May 2001 16:39:00 -0700 (PDT)", "UTC"): ("2001-05", 23),
    ("Mon, 14 May 2001 16:39:00 -0700 (PDT)", "America/Chicago"): ("2001-05", 18),
    ("Mon, 14 May 0001 16:39:00 -0700", "UTC"): ("NA", 23),
    ("Thu, 31 Dec 1998 20:00:00 -0800", "UTC"): ("1999-01", 4),
    ("Thu, 31 Dec 1998 20:00:00 -0800", "America/Los_Angeles"): ("1998-12", 20),
    ("Fri, 31 Dec 1997 23:00:00 +0000", "UTC"): ("NA", 23),
    ("Tue, 31 Dec 2002 23:59:59 +0000", "UTC"): ("2002-12", 23),
    ("Wed, 1 Jan 2003 00:00:00 +0000", "UTC"): ("NA", 0),
    ("junk", "UTC"): ("NA", None),
}


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_month_and_hour_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for (text, tz), expected in MONTH_HOUR.items():
            found = evaluate(
                spark,
                [text],
                lambda v, tz=tz: sent_month(sent_at(v), tz),
                lambda v, tz=tz: sent_hour(sent_at(v), tz),
            )
            assert found == [expected], (text, tz)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_quarter(spark):
    cases = {"2001-05": "2001-Q2", "2001-12": "2001-Q4", "1998-01": "1998-Q1", "NA": None, "": None}
    assert evaluate(spark, cases, quarter_of) == list(cases.values())


def test_recipients(spark):
    assert edges_of(spark, "From: A.B@X.com\nTo: a@b.com;C@D.com") == [
        ("a.b@x.com", "a@b.com", "to"),
        ("a.b@x.com", "c@d.com", "to"),
    ]
    assert edges_of(spark, 'From: s@x.com\nTo: "Lay, K" <k@e.com>') == [
        ("s@x.com", "k@e.com", "to")
    ]
    assert edges_of(spark, "From: s@x.com\nTo: S@X.COM, Name <>, department: ena legal") == []
    assert edges_of(spark, "From: s@x.com\nTo: a@b.c, a@b.c\nCc: a@b.c") == [
        ("s@x.com", "a@b.c", "cc"),
        ("s@x.com", "a@b.c", "to"),
        ("s@x.com", "a@b.c", "to"),
    ]
    assert edges_of(spark, "From: s@x.com\nCc: a@b.c") == []
    body = "From: s@x.com\n\nTo: body@x.com"
    assert edges_of(spark, body) == [("s@x.com", "body@x.com", "to")]
    assert edges_of(spark, body, headers_only=True) == []


def test_gate_and_directory(spark):
    parsed = parse_messages(
        mails(
            spark,
            "From: s@x.com\nTo: department: ena legal",
            "From: s@x.com\nTo: A@b.c, A@b.c\nDate: Mon, 14 May 2001 16:39:00 -0700",
            " \r\n\t",
            None,
            "To: a@b.c",
            "From: Name <>\nTo: a@b.c",
            "From: system\nTo: a@b.c",
            "From: s@x.com\nTo: \nCc: a@b.c",
        )
    )
    reasons = {row.skip_reason: row.mails for row in skip_reasons(parsed).collect()}
    assert reasons == {
        "valid": 2,
        "blank_message": 2,
        "no_sender": 2,
        "invalid_sender": 1,
        "no_recipient_field": 1,
    }
    assert sorted(row.email for row in persons(parsed).collect()) == ["a@b.c", "s@x.com"]
    metrics = {row.metric: row.value for row in ingest_metrics(parsed).collect()}
    assert metrics == {
        "mails": 8, "valid": 2, "skipped": 6, "edges": 2, "na_dates": 1, "persons": 2,
    }
