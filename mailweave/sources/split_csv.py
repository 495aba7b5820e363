"""Read one very large message dump with many tasks: a one-off converter to parquet.

Spark cannot split a CSV whose cells hold line ends: it does not know, in the
middle of the file, whether a line end is inside quotes. Here the file is read
as lines, in splits, and the number of quotes before a line tells whether it
starts a record: an even number before it in the file means that no cell is
open. Quotes are counted per split, then summed over the splits of a file; the
tasks that read a split then put its records together themselves, and only what
a split's first and last records leave open is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mailweave.sources.tables import MESSAGE_SCHEMA, QUOTED

SPLIT = ["dump", "split"]
#: What a piece of text is: a record, the end of one that began in an earlier split, or the
#: last one of its split, which may go on in the next.
WHOLE, HEAD, TAIL = 0, 1, 2


def read_large_dump(spark: SparkSession, path: str) -> DataFrame:
    """``file, message`` of a CSV dump, as ``read_messages`` but splittable.

    Cells that hold a quote must be quoted themselves, as CSV writers do; a file with an
    odd number of quotes is an error. The text is read three times and stays where it is read:
    two pieces of each split are shuffled.
    """
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"')))
    lines = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("dump"),
            F.col("_metadata.file_block_start").alias("split"),
            "value",
        )
    )
    odd = lines.groupBy(*SPLIT).agg((F.sum(quotes % 2) % 2).alias("odd"))
    lines = lines.join(F.broadcast(_split_offsets(odd)), SPLIT).select(*SPLIT, "offset", "value")

    schema = "dump string, split long, part int, is_header boolean, text string"
    records = lines.mapInArrow(_pieces(whole=True), schema).where(~F.col("is_header")).select("text")
    open_ends = lines.mapInArrow(_pieces(whole=False), schema)
    in_file = Window.partitionBy("dump").orderBy("split", "part")
    in_file = in_file.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = F.sort_array(F.collect_list(F.struct("split", "part", "text")))
    joined = (
        open_ends.withColumn("record", F.count_if(F.col("part") == TAIL).over(in_file))
        .groupBy("dump", "record")
        .agg(F.array_join(F.transform(pieces, _text), "\n").alias("text"), F.bool_or("is_header").alias("is_header"))
    )
    records = records.union(joined.where(~F.col("is_header")).select("text"))
    options = {**QUOTED, "multiLine": "true"}
    # Splitting at line feeds leaves the carriage return of a CRLF dump at the
    # end of a record; inside a cell it belongs to the mail.
    cells = F.from_csv(F.regexp_replace("text", r"\r\z", ""), MESSAGE_SCHEMA, options)
    return records.where(F.col("text") != "").select(cells.alias("c")).select("c.*")


def _text(piece):
    return piece["text"]


def _pieces(whole: bool):
    """The records that lie within a split, or else what is open at either end of it."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        names = ["dump", "split", "part", "is_header", "text"]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]

        def rows(key, part, headers, texts):
            n = len(texts)
            columns = ([key[0]] * n, [key[1]] * n, [part] * n, headers, texts)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        # the split, its records begun so far, lines of the last of them, and whether a cell is open
        key, number, pending, odd = None, 0, [], 0

        def last():
            part = TAIL_PART if number else HEAD_PART
            return rows(key, part, [key[1] == 0 and number == 1], ["\n".join(pending)])

        for batch in batches:
            dumps, splits = batch.column(0), batch.column(1)
            at = 0
            while at < batch.num_rows:
                here = (dumps[at].as_py(), splits[at].as_py())
                same = pc.and_(pc.equal(dumps, here[0]), pc.equal(splits, here[1])).slice(at)
                other = pc.index(same, False).as_py()
                stop = batch.num_rows if other < 0 else at + other
                if here != key:
                    if pending and not whole:
                        yield last()
                    key, number, pending, odd = here, 0, [], batch.column(2)[at].as_py()
                values = batch.column(3).slice(at, stop - at)
                at = stop
                quotes = pc.count_substring(values, '"').to_numpy(zero_copy_only=False) % 2
                total = odd + np.cumsum(quotes)
                starts = np.flatnonzero((total - quotes) % 2 == 0)
                odd = int(total[-1] % 2)
                before = int(starts[0]) if len(starts) else len(values)
                # lines are kept as text only where they are used
                if before and (whole or number == 0 or not len(starts)):
                    pending.append("\n".join(values.slice(0, before).to_pylist()))
                if not len(starts):
                    continue
                if pending and (number > 0) == whole:
                    if whole:
                        yield rows(key, WHOLE_PART, [key[1] == 0 and number == 1], ["\n".join(pending)])
                    else:
                        yield last()
                if whole and len(starts) > 1:
                    inner = values.slice(before, int(starts[-1]) - before)
                    offsets = pa.array(starts - before, pa.int32())
                    texts = pc.binary_join(pa.ListArray.from_arrays(offsets, inner), "\n")
                    headers = [key[1] == 0 and number + i == 0 for i in range(len(texts))]
                    yield rows(key, WHOLE_PART, headers, texts)
                number += len(starts)
                pending = ["\n".join(values.slice(int(starts[-1])).to_pylist())]
        if pending and not whole:
            yield last()

    # constants by value: executors need not have this module
    WHOLE_PART, HEAD_PART, TAIL_PART = WHOLE, HEAD, TAIL
    return run


def _split_offsets(counted: DataFrame) -> DataFrame:
    """Per split: whether it begins inside a cell. A file has one row per split, so the window
    over a file is small."""
    in_file = Window.partitionBy("dump")
    earlier = in_file.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2
    stray = F.raise_error(F.concat(F.lit("odd number of quotes in "), F.col("dump")))
    quotes = F.sum("odd").over(in_file) % 2
    return counted.select(*SPLIT, F.when(quotes == 0, offset).otherwise(stray.cast("bigint")).alias("offset"))
