"""Distinct edges per week over dump files that arrive over time, with bounded state.

The stream keeps the pairs of every week that can still change, and drops a week once the
watermark has passed its end. Its results are final: a week is written once, when it is closed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailweave.functions.dates import NO_MONTH
from mailweave.operators.messages import parse_messages
from mailweave.sources.tables import MESSAGE_SCHEMA, QUOTED

WEEK = "7 days"
LATE_SCHEMA = "run string, first_batch long, last_batch long, mails long, late_copies long, watermark string"

# Pairs of open weeks may be many more than fit in the heap of an executor.
STATE_STORES = {
    "rocksdb": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "memory": "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
}
_STORE = "spark.sql.streaming.stateStore.providerClass"
_PROGRESS = "spark.sql.streaming.numRecentProgressUpdates"


def weekly_edges(parsed: DataFrame, delay: str) -> DataFrame:
    """``week_start, edges``: the distinct pairs of every closed week of a stream of parsed mails.

    Weeks are seven days each from 1970-01-01 on, in UTC. A copy is late if its week had ended
    ``delay`` before the latest mail of the batches before; late copies are dropped and counted.
    """
    clock = F.unix_date(F.col("sent_at").cast("date")).cast("long") * 86400
    clock += F.hour("sent_at") * 3600 + F.minute("sent_at") * 60 + F.second("sent_at")
    # a filter on the month would be pushed below the parser, which then parses once more for it
    people = F.transform(F.concat("to", "cc"), lambda dst: F.struct(dst.alias("dst")))
    copies = parsed.select("src", F.inline(F.when(F.col("ym") != NO_MONTH, people)), "sent_at")
    timed = copies.select("src", "dst", F.timestamp_seconds(clock).alias("at")).withWatermark("at", delay)
    # one row of state for each pair of an open week, dealt by the pair; then one for each week
    pairs = timed.select("src", "dst", F.window("at", WEEK).alias("week")).dropDuplicates(["week", "src", "dst"])
    day = F.floor(F.unix_seconds("week.start") / 86400).cast("int")
    return (
        pairs.groupBy("week")
        .agg(F.count("*").alias("edges"))
        .select(F.date_from_unix_date(day).alias("week_start"), "edges")
    )


def count_new_files(
    spark: SparkSession,
    source: str,
    folder: str,
    delay: str = "28 days",
    files_per_batch: int = 1000,
    state_store: str = "rocksdb",
    **parse_options,
) -> None:
    """Take the CSV files of ``source`` that have arrived since the last run into account.

    Weeks that are closed by them are appended to ``folder/weeks``, and one line about the run to
    ``folder/late``: mails read, copies dropped as late, and the watermark at its end. State,
    watermark and files taken are kept in ``folder/progress``, so a run that is stopped goes on
    where it was; the lines of a run that fails are those of its batches up to then.
    """
    settings = {_STORE: STATE_STORES[state_store], _PROGRESS: "100000"}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        messages = (
            spark.readStream.schema(MESSAGE_SCHEMA)
            .options(header=True, multiLine=True, maxFilesPerTrigger=files_per_batch, **QUOTED)
            .csv(source)
        )
        query = (
            weekly_edges(parse_messages(messages, **parse_options), delay)
            .writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", f"{folder}/progress")
            .trigger(availableNow=True)
            .start(f"{folder}/weeks")
        )
        try:
            query.awaitTermination()
        finally:
            _report(spark, query, f"{folder}/late")
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _report(spark: SparkSession, query, path: str) -> None:
    batches = [b for b in query.recentProgress if b["stateOperators"]]
    if not batches:
        return
    # the first of the two operators, which sees every copy
    first = [o for b in batches for o in b["stateOperators"] if o["operatorName"] == "dedupe"]
    row = (
        str(query.runId),
        batches[0]["batchId"],
        batches[-1]["batchId"],
        sum(b["numInputRows"] for b in batches),
        sum(o["numRowsDroppedByWatermark"] for o in first),
        batches[-1]["eventTime"].get("watermark"),
    )
    spark.createDataFrame([row], LATE_SCHEMA).write.mode("append").json(path)


def closed_weeks(spark: SparkSession, folder: str) -> DataFrame:
    """``week_start, edges`` of all weeks closed so far."""
    return spark.read.schema("week_start date, edges long").parquet(f"{folder}/weeks")


def late_copies(spark: SparkSession, folder: str) -> DataFrame:
    """The lines about all runs."""
    return spark.read.schema(LATE_SCHEMA).json(f"{folder}/late")
