"""Token counts of documents in flat token files without an index.

A flat file holds the ids of many documents one after the other as unsigned
little-endian integers of fixed width, each document ended by a separator id.
Nothing says where a document begins, so the file is searched for the separator:

* The files are read as splits of any size. A split is a run of bytes whose place in
  the file, and so its alignment to ids, is not known yet. Each task searches its
  bytes for the separator's bytes, vectorised, block by block of `BLOCK_BYTES`, and
  notes every hit at any alignment.
* A prefix scan over the blocks of a file, one row per block, gives each block's place.
  It keeps the aligned hits, adds separators that lie across a block's edge, and
  hands each block the end of the last document before it and the number of them.

Files may have any size: bytes are read as lines (the byte 0x0A occurs in ids by
chance) and glued again, so a split starts and ends at such a byte. Only a file without
that byte is one split. A UTF-8 byte-order mark, which line readers drop, is noticed by
the file's size and accounted for.

Defined cases: an empty file has no documents; a document without ids counts 0;
ids after the last separator form a document with ``complete`` false; a file whose
size is no multiple of the width is an error.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailweave.llm import pieces as cuts
from mailweave.llm.common import slices

BLOCK_BYTES = 1 << 22
_BOM = b"\xef\xbb\xbf"


def _separator(end_id: int, width: int) -> bytes:
    return int(end_id).to_bytes(width, "little")


def write_flat(
    df: DataFrame, path: str, end_id: int, width: int = 2, ids_col: str = "ids_bytes"
) -> None:
    """Write flat files, one per partition, from the id bytes (binary) of each document.

    The text writer puts the raw bytes of a string between separators; as the
    separator it gets the end id.
    """
    text = F.col(ids_col).cast("string").alias("value")
    writer = df.select(text).write.option("encoding", "ISO-8859-1").option("maxRecordsPerFile", 0)
    writer.option("lineSep", _separator(end_id, width).decode("latin-1")).text(path)


def document_ids(
    df: DataFrame,
    tokenizer: str,
    pattern: str,
    width: int = 2,
    text_col: str = "text",
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """The ``keep`` columns and the ids of each text as bytes; a null text has none."""
    content = cuts.file_content(tokenizer)
    n = len(keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = cuts.encoder(content, pattern)
        for part in slices(batches, n):
            rows = own.encode([text or "" for text in part.column(n).to_pylist()])
            rows = [np.frombuffer(row, "<u4").astype(f"<u{width}").tobytes() for row in rows]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:n], pa.array(rows, pa.binary())], names=schema.names
            )

    schema = T.StructType([df.schema[c] for c in keep]).add("ids_bytes", T.BinaryType())
    return df.select(*keep, F.col(text_col).cast("string").alias("__text")).mapInArrow(run, schema)


_BLOCKS = (
    "file long, split_start long, block long, file_size long, n_bytes long, "
    "first binary, last binary, hits array<long>, heads array<binary>"
)


def _scan(separator: bytes, head: int):
    """Task: the lines of its splits -> blocks with all hits of the separator."""
    width = len(separator)
    edge = width - 1 + head  # a document may begin within the separator of the block before
    wanted = np.frombuffer(separator, np.uint8)

    def block(key, number, size, data: bytes, context: bytes):
        """``context``: the bytes before the block that are of the same split."""
        joined = np.frombuffer(context + data, np.uint8)
        places = max(0, len(joined) - width + 1)
        found = np.ones(places, bool)
        for i, byte in enumerate(wanted):
            found &= joined[i : i + places] == byte
        hits = np.flatnonzero(found) - len(context)
        hits = hits[hits + width > 0].tolist()
        heads = [data[h + width : h + width + head] for h in hits]
        return (*key, number, size, len(data), data[:edge], data[len(data) - min(edge, len(data)) :], hits, heads)

    def batch(rows):
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, layout)], schema=layout
        )

    layout = pa.schema(
        [(n, pa.int64()) for n in ("file", "split_start", "block", "file_size", "n_bytes")]
        + [("first", pa.binary()), ("last", pa.binary())]
        + [("hits", pa.list_(pa.int64())), ("heads", pa.list_(pa.binary()))]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, size, number, parts, held, context = None, 0, 0, [], 0, b""
        for part in slices(batches, 3):
            files, starts, sizes = (part.column(i).to_numpy() for i in range(3))
            changed = np.flatnonzero((np.diff(files) != 0) | (np.diff(starts) != 0)) + 1
            lines = part.column(3)
            for a, b in zip([0, *changed], [*changed, part.num_rows]):
                now = int(files[a]), int(starts[a])
                if now != key:
                    if held:
                        yield batch([block(key, number, size, b"".join(parts), context)])
                    key, size, number, parts, held, context = now, int(sizes[a]), 0, [], 0, b""
                data = b"\n".join([*lines.slice(a, b - a).to_pylist(), b""])
                parts.append(data)
                held += len(data)
                # what remains is joined to the next block, so that none is tiny
                while held >= 2 * BLOCK_BYTES:
                    data = b"".join(parts)
                    done, rest = data[:BLOCK_BYTES], data[BLOCK_BYTES:]
                    yield batch([block(key, number, size, done, context)])
                    number, parts, held = number + 1, [rest], len(rest)
                    context = done[len(done) - (width - 1) :]
        if held:
            yield batch([block(key, number, size, b"".join(parts), context)])

    return run


def count_tokens(
    spark: SparkSession, path: str, end_id: int, width: int = 2, head: int = 0
) -> DataFrame:
    """One row per document of the flat files under ``path``: file (name), document (from
    0 within its file), start (ids before it), n_tokens, head (its first ``head`` ids
    as bytes, fewer in a shorter document) and complete."""
    separator, head_bytes = _separator(end_id, width), head * width
    lines = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.xxhash64("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split_start"),
            F.col("_metadata.file_size").alias("file_size"),
            F.col("value").cast("binary").alias("value"),
        )
    )
    blocks = lines.mapInArrow(_scan(separator, head_bytes), _BLOCKS)
    return _stitched(blocks, separator, width, head_bytes)


def _stitched(blocks: DataFrame, separator: bytes, width: int, head: int) -> DataFrame:
    empty = F.lit(b"")
    file = Window.partitionBy("file")
    order = file.orderBy("split_start", "block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    near = lambda f, c, n: F.coalesce(f(c, n).over(order), empty)
    end = F.lit(separator)

    # the bytes around the edges, and the place of each block
    placed = blocks.select(
        "*",
        F.coalesce(F.sum("n_bytes").over(before), F.lit(0)).alias("begin"),
        F.sum("n_bytes").over(file).alias("read"),
        F.concat(*(near(F.lag, "last", n) for n in range(max(1, width - 1), 0, -1))).alias("left"),
        F.concat("first", near(F.lead, "first", 1), near(F.lead, "first", 2)).alias("right"),
        near(F.lead, "first", 1).alias("next1"),
        near(F.lead, "first", 2).alias("next2"),
    )
    # a line reader adds a line end after the last line, and drops a byte-order mark
    mark = F.when(F.col("file_size") - F.col("read") >= 2, F.lit(3)).otherwise(F.lit(0))
    placed = placed.withColumn("mark", mark).withColumn("begin", F.col("begin") + F.col("mark"))
    context = F.expr(f"substring(left, greatest(1, length(left) - {width - 2}), {width - 1})")
    placed = placed.withColumn("left", context if width > 1 else empty)
    placed = placed.withColumn(
        "joined", F.expr(f"concat(left, substring(first, 1, {max(0, width - 1)}))")
    )
    # hits across an edge of two splits; within a split a task has found them itself
    across = F.filter(
        F.sequence(F.lit(1), F.lit(max(1, width - 1))),
        lambda j: (F.col("block") == 0)
        & (F.length("left") >= j)
        & (F.substring("joined", j, F.lit(width)) == end),
    )
    hit = lambda at, head: F.struct(at.alias("at"), head.alias("head"))
    inside = F.transform(
        F.arrays_zip("hits", "heads"),
        lambda x: hit(
            F.col("begin") + x["hits"],
            F.substring(F.concat(x["heads"], F.when(
                x["hits"] + width + head > F.col("n_bytes"), F.concat("next1", "next2")
            ).otherwise(empty)), 1, F.lit(head)),
        ),
    )
    edge = F.transform(
        across,
        lambda j: hit(
            F.col("begin") - F.length("left") + j - 1,
            F.substring("right", F.lit(width) - (F.length("left") - j + 1) + 1, F.lit(head)),
        ),
    )
    aligned = F.filter(F.concat(edge, inside), lambda h: h["at"] % width == 0)
    hits = placed.withColumn("found", F.array_sort(aligned)).withColumn(
        "last_hit", F.try_element_at("found", F.lit(-1))
    )
    # the documents that ended before each block; a file starts with a hit before its first id
    mark_bytes = F.when(F.col("mark") > 0, F.lit(_BOM)).otherwise(empty)
    opening = hit(
        F.lit(-width).cast("long"),
        F.substring(F.concat(mark_bytes, F.first("right").over(order)), 1, F.lit(head)),
    )
    scanned = hits.select(
        "file",
        "file_size",
        F.coalesce(F.last("last_hit", True).over(before), opening).alias("previous"),
        F.coalesce(F.sum(F.size("found")).over(before), F.lit(0)).alias("ended"),
        "found",
        (F.lead("file").over(order).isNull()).alias("is_last"),
    )
    # the end of a file ends a document that has no separator
    rest = hit(F.col("file_size"), empty)
    last_end = F.coalesce(F.try_element_at("found", F.lit(-1))["at"], F.col("previous")["at"])
    open_ = F.col("is_last") & (last_end + width < F.col("file_size"))
    ends = F.when(open_, F.concat("found", F.array(rest))).otherwise(F.col("found"))
    rows = scanned.select(
        "file", "file_size", "ended", "previous", "found", F.posexplode(ends).alias("k", "end")
    )
    begin = F.when(F.col("k") == 0, F.col("previous")).otherwise(
        F.try_element_at("found", F.greatest(F.col("k"), F.lit(1)))
    )
    size = F.when(
        F.col("file_size") % width != 0,
        F.raise_error(F.lit(f"a file's size is no multiple of {width} bytes")),
    ).otherwise(F.col("end")["at"] - F.col("begin")["at"] - width)
    return (
        rows.withColumn("begin", begin)
        .withColumn("n_bytes", size.cast("long"))
        .select(
            "file",
            (F.col("ended") + F.col("k")).alias("document"),
            F.expr(f"(begin.at + {width}) div {width}").alias("start"),
            F.expr(f"n_bytes div {width}").alias("n_tokens"),
            F.expr(f"substring(begin.head, 1, least({head}, n_bytes))").alias("head"),
            (F.col("end")["at"] < F.col("file_size")).alias("complete"),
        )
    )
