"""Traffic with subtotals, and how the edges of one period differ from those of another.

Copies are counted per finest cell before anything is expanded to subtotals or compared, so the
rows that are multiplied are distinct cells and not copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailweave.functions import quarter_of

DIMENSIONS = ["type", "quarter", "domain"]


def traffic_cells(edges: DataFrame) -> DataFrame:
    """``type, quarter, domain, src, copies``: copies per sender, with the recipient's domain.

    ``quarter`` is NULL for an unknown month, ``domain`` what follows the first "@" in lower case.
    """
    at = F.instr("dst", "@")
    domain = F.when(at > 0, F.lower(F.substring("dst", at + 1, F.length("dst"))))
    return edges.groupBy(
        "type", quarter_of(F.col("ym")).alias("quarter"), domain.alias("domain"), "src"
    ).agg(F.count("*").alias("copies"))


def _with_senders(cells: DataFrame, grouped, dims: Sequence[str]) -> DataFrame:
    """Copies and distinct senders of every group that ``grouped`` makes of some columns."""
    by_sender = grouped(cells, [*dims, "src"]).agg(
        F.grouping_id().alias("id"), F.grouping("src").alias("all_senders"), F.sum("copies").alias("copies")
    )
    # the last bit of the id is that of the sender, who is never summed away here
    kept = by_sender.where("all_senders = 0").withColumn("level", (F.col("id") / 2).cast("int"))
    return kept.groupBy("level", *dims).agg(
        F.sum("copies").alias("copies"), F.count("*").alias("senders")
    )


def traffic_cube(edges: DataFrame, dims: Sequence[str] = DIMENSIONS) -> DataFrame:
    """``level, type, quarter, domain, copies, senders`` for every combination of the dimensions.

    ``level`` has a bit for each dimension, the first one the highest, that is summed over; its
    column is NULL then, as it is where its value is unknown.
    """
    dims = list(dims)
    sets = [[d for i, d in enumerate(dims) if not mask >> (len(dims) - 1 - i) & 1] for mask in range(1 << len(dims))]
    return _with_senders(traffic_cells(edges), _over(sets), dims)


def _over(sets: Sequence[Sequence[str]]):
    """Grouping sets, each with the sender."""

    def grouped(cells: DataFrame, columns: Sequence[str]):
        return cells.groupingSets([[F.col(c) for c in (*s, "src")] for s in sets], *columns)

    return grouped


def calendar_rollup(edges: DataFrame) -> DataFrame:
    """``level, year, quarter, month, copies, senders`` of known months, with subtotals of quarters
    (level 1), years (3) and everything (7)."""
    quarter = quarter_of(F.col("ym"))
    cells = (
        edges.where(quarter.isNotNull())
        .groupBy(F.substring("ym", 1, 4).alias("year"), quarter.alias("quarter"), F.col("ym").alias("month"), "src")
        .agg(F.count("*").alias("copies"))
    )
    dims = ["year", "quarter", "month"]
    return _with_senders(cells, _over([dims[:n] for n in range(len(dims), -1, -1)]), dims)


def edge_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """``src, dst, type, change``: the copies of ``before`` that are lost, those of ``after`` that
    are gained, and those in both, each as often as it stands there."""
    columns = ["src", "dst", "type"]
    before, after = before.select(*columns), after.select(*columns)
    changes = {
        "lost": before.exceptAll(after),
        "gained": after.exceptAll(before),
        "kept": before.intersectAll(after),
    }
    rows = [df.withColumn("change", F.lit(name)) for name, df in changes.items()]
    return rows[0].union(rows[1]).union(rows[2])


def edge_churn(edges: DataFrame) -> DataFrame:
    """``quarter, copies, gained, lost, kept`` of every quarter with mails, against the calendar
    quarter before. A pair counts as often as it has copies: of three copies now and two before,
    two are kept and one is gained."""
    dated = edges.withColumn("quarter", quarter_of(F.col("ym"))).where(F.col("quarter").isNotNull())
    pairs = dated.groupBy("quarter", "src", "dst").agg(F.count("*").alias("n"))
    number = F.substring("quarter", 1, 4).cast("int") * 4 + F.substring("quarter", 7, 1).cast("int") - 1
    zero = F.lit(0).cast("bigint")
    # a pair of one quarter is also what the next one is compared with
    sides = F.array(
        F.struct(number.alias("q"), F.col("n").alias("now"), zero.alias("before")),
        F.struct((number + 1).alias("q"), zero.alias("now"), F.col("n").alias("before")),
    )
    both = (
        pairs.select("src", "dst", F.inline(sides))
        .groupBy("q", "src", "dst")
        .agg(F.sum("now").alias("now"), F.sum("before").alias("before"))
    )
    kept = F.least("now", "before")
    name = F.concat(F.floor(F.col("q") / 4).cast("string"), F.lit("-Q"), (F.col("q") % 4 + 1).cast("string"))
    return (
        both.groupBy("q")
        .agg(
            F.sum("now").alias("copies"),
            F.sum(F.col("now") - kept).alias("gained"),
            F.sum(F.col("before") - kept).alias("lost"),
            F.sum(kept).alias("kept"),
        )
        .where("copies > 0")
        .select(name.alias("quarter"), "copies", "gained", "lost", "kept")
    )
