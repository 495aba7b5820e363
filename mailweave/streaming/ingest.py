"""Parse the dump files that have arrived since the last run."""

from __future__ import annotations

from pyspark.sql import SparkSession

from mailweave.operators import parse_messages
from mailweave.sources.tables import MESSAGE_SCHEMA, QUOTED


def parse_new_files(
    spark: SparkSession,
    source: str,
    folder: str,
    files_per_batch: int = 1000,
    **parse_options,
) -> None:
    """Append the parsed mails of new CSV files in ``source`` to ``folder/parsed``.

    Each file is taken once; a run that is stopped goes on where it was. The
    parsing is that of the batch ingest and keeps no state between mails.
    """
    messages = (
        spark.readStream.schema(MESSAGE_SCHEMA)
        .options(header=True, multiLine=True, maxFilesPerTrigger=files_per_batch, **QUOTED)
        .csv(source)
    )
    query = (
        parse_messages(messages, **parse_options)
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/parsed_progress")
        .trigger(availableNow=True)
        .start(f"{folder}/parsed")
    )
    query.awaitTermination()
