"""Scale of a corpus in one row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailweave.functions import quarter_of


def scale_summary(parsed: DataFrame) -> DataFrame:
    """``mails, nodes, edges, first_month, last_month, quarters`` of the valid mails.

    One pass: each mail adds to its month and names its persons, and both are
    counted in the same aggregation.
    """
    mail = F.struct(
        F.col("ym").alias("month"),
        F.lit(None).cast("string").alias("email"),
        F.lit(1).cast("bigint").alias("mails"),
        (F.size("to") + F.size("cc")).cast("bigint").alias("edges"),
    )
    zero = F.lit(0).cast("bigint")
    people = F.transform(
        F.array_distinct(F.concat(F.array("src"), "to", "cc")),
        lambda email: F.struct(
            F.lit(None).cast("string").alias("month"),
            email.alias("email"),
            zero.alias("mails"),
            zero.alias("edges"),
        ),
    )
    rows = F.when(F.col("skip_reason").isNull(), F.concat(F.array(mail), people))
    counted = (
        parsed.select(F.inline(rows))
        .groupBy("month", "email")
        .agg(F.sum("mails").alias("mails"), F.sum("edges").alias("edges"))
        .withColumn("quarter", F.when(F.col("edges") > 0, quarter_of(F.col("month"))))
    )
    dated = F.when(F.col("quarter").isNotNull(), F.col("month"))
    return counted.agg(
        F.sum("mails").alias("mails"),
        F.count("email").alias("nodes"),
        F.sum("edges").alias("edges"),
        F.min(dated).alias("first_month"),
        F.max(dated).alias("last_month"),
        # One entry per calendar quarter: at most four for each year of the gate.
        F.size(F.collect_set("quarter")).cast("bigint").alias("quarters"),
    )
