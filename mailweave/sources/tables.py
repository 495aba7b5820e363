"""Raw mail dumps, edge lists, feature tables, rankings and results.

Stage tables are parquet unless a text format is asked for: a text edge list
cannot be pruned or split as well.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailweave.functions import message_json, parsed_json, trim_blanks
from mailweave.operators.features import FEATURES
from mailweave.operators.messages import EDGE_COLUMNS

MESSAGE_SCHEMA = "file string, message string"
EDGE_SCHEMA = "src string, dst string, type string, ym string"
RANKING_SCHEMA = "rank int, email string, pagerank double"
FEATURE_SCHEMA = (
    "email string, recvCount bigint, outDegree bigint, inDegree bigint, nightRatio double, "
    "sendRecvRatio double, activeMonths bigint, avgSentPerMonth double"
)

# A dump cell holds a whole mail: quoted, with line ends and doubled quotes inside.
QUOTED = {"quote": '"', "escape": '"', "encoding": "UTF-8"}

# Addresses may hold quotes, so tab-separated tables are read and written without quoting. An
# empty field is written as nothing, and not as the two quotes that Spark would put there.
UNQUOTED = {"sep": "\t", "quote": "", "escape": "", "emptyValue": ""}

# Spark drops blanks at the ends of written values unless told not to.
KEEP_BLANKS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_messages_json(messages: DataFrame, path: str) -> None:
    """Mails as lines of JSON, ``file, headers, body``: one object a line, so files can be split."""
    lines = messages.select(message_json(F.col("file"), F.col("message")).alias("value"))
    lines.write.mode("overwrite").text(path)


def read_messages_json(spark: SparkSession, path: str) -> DataFrame:
    """``file, headers, body, rest, corrupt`` of every line that is not blank, by `parsed_json`."""
    lines = spark.read.text(path).where(trim_blanks(F.col("value")) != "")
    return lines.select(parsed_json(F.col("value")).alias("mail")).select("mail.*")


def read_messages(
    spark: SparkSession, path: str | Sequence[str], fmt: str = "csv", partitions: int | None = None
) -> DataFrame:
    """The raw message table ``file, message``.

    A CSV with line ends inside its cells cannot be split: one file is one
    task. Deliver a large dump as many files, spread a few large ones with
    ``partitions``, and keep the result as parquet (``write_messages``).
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.schema(MESSAGE_SCHEMA)
    if fmt == "csv":
        messages = reader.options(header=True, multiLine=True, **QUOTED).csv(paths)
    else:
        messages = reader.format(fmt).load(paths)
    return messages.repartition(partitions) if partitions else messages


def write_messages(messages: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = messages.select("file", "message").write.mode("overwrite")
    if fmt == "csv":
        writer.options(header=True, quoteAll=True, **QUOTED, **KEEP_BLANKS).csv(path)
    else:
        writer.format(fmt).save(path)


def write_edges(
    edges: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Write ``src, dst, type, ym``, duplicates kept; ``fmt`` parquet or tsv."""
    writer = edges.select(*EDGE_COLUMNS).write.mode("overwrite")
    if fmt == "tsv":
        writer.options(**UNQUOTED, **KEEP_BLANKS).csv(path)
    else:
        writer.partitionBy(*partition_by).format(fmt).save(path)


#: Edges of a bucket: what one task sums, sorts and joins.
BUCKET_EDGES = 500_000


def bucket_count(edges: DataFrame, least: int = 8) -> int:
    """Buckets for a table of these edges: as many as keep each to `BUCKET_EDGES` on average."""
    return max(least, -(-edges.count() // BUCKET_EDGES))


def edges_table(edges: DataFrame, name: str, path: str, buckets: int) -> DataFrame:
    """Write the edges to the table ``name`` at ``path``, dealt to ``buckets`` by source and sorted
    within them, and return that table.

    Joins and aggregations by source then start without a shuffle, each time the table is read.
    The edges are dealt before they are written, so a bucket is one file.
    """
    writer = edges.select(*EDGE_COLUMNS).repartition(buckets, "src").write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, "src").sortBy("src").saveAsTable(name)
    return edges.sparkSession.table(name)


def _edge_lines(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    if fmt != "tsv":
        return spark.read.schema(EDGE_SCHEMA).format(fmt).load(path)
    # Split here and not by the CSV reader, which takes an empty field for a missing one.
    parts = F.split("value", "\t")
    fields = [F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(EDGE_COLUMNS)]
    return spark.read.text(path).where(trim_blanks(F.col("value")) != "").select(*fields)


def _long_enough(fields: int) -> Column:
    kept = [F.col(name).isNotNull() for name in EDGE_COLUMNS[:fields]]
    return reduce(Column.__and__, kept)


def read_edges(
    spark: SparkSession, path: str, fmt: str = "parquet", fields: int = 4
) -> DataFrame:
    """An edge list; lines with fewer than ``fields`` (2 to 4) are left out.

    Two fields are enough for the simple graph, three for weights, four for
    quarters. A field may be empty; blank lines are no lines. Text is trimmed; parquet is read as it was written, so filters
    reach the scan.
    """
    kept = _edge_lines(spark, path, fmt).where(_long_enough(fields))
    if fmt != "tsv":
        return kept
    return kept.select(*[trim_blanks(F.col(name)).alias(name) for name in EDGE_COLUMNS])


def count_short_lines(
    spark: SparkSession, path: str, fmt: str = "parquet", fields: int = 4
) -> DataFrame:
    """How many lines ``read_edges`` leaves out, as one row ``short_lines``."""
    return _edge_lines(spark, path, fmt).agg(
        F.count_if(~_long_enough(fields)).alias("short_lines")
    )


def write_persons(persons: DataFrame, path: str, fmt: str = "parquet") -> None:
    """The directory; ``fmt`` text writes one address per line."""
    persons.select("email").write.mode("overwrite").format(fmt).save(path)


def write_features(features: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = features.select("email", *FEATURES).write.mode("overwrite")
    if fmt == "tsv":
        writer.options(header=True, **UNQUOTED, **KEEP_BLANKS).csv(path)
    else:
        writer.format(fmt).save(path)


def read_features(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.schema(FEATURE_SCHEMA)
    if fmt == "tsv":
        return reader.options(header=True, **UNQUOTED).csv(path)
    return reader.format(fmt).load(path)


def read_ranking(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """The first ``n`` places of a ranking written without header by ``write_result``."""
    ranking = spark.read.schema(RANKING_SCHEMA).options(**UNQUOTED).csv(path)
    return ranking.where((F.col("rank") <= n) & (trim_blanks(F.col("email")) != ""))


def write_result(df: DataFrame, path: str, header: bool = True, single: bool = False) -> None:
    """Write a result as tab-separated text.

    ``single`` gives one file and one task; it is for rankings and series of
    known small size. Assignments and rank vectors stay in many files.
    """
    out = df.coalesce(1) if single else df
    out.write.mode("overwrite").options(header=header, **UNQUOTED, **KEEP_BLANKS).csv(path)
