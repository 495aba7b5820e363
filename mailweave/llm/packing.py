"""Pack token documents into as few sequences as possible, by linear grouping.

A document longer than a sequence is cut into full pieces, its first piece being
the shorter one. Only the number of pieces of each length, at most ``capacity``
numbers whatever the input, goes to the driver:

1. Full pieces are sequences by themselves.
2. Large pieces, in order of length, form `GROUPS` groups of equal cardinality, and
   every length of a group is rounded up to its largest. For these few sizes,
   configurations are chosen: the largest size left together with the subset of
   sizes that fills the rest best, used as often as the groups allow.
3. Actual pieces take the places of the rounded sizes; what rounding had added is
   free again.
4. Small pieces, in order of length, go where they fit best.

The result is a list of rules "the pieces of this length with ranks from a to b
lie from sequence s on, q to a sequence, at this offset"; it has some thousands of
entries whatever the input. The ranks of pieces of equal length come from counts
by bucket, so no group is ever in one task.

Defined cases: a null or empty text is the end token alone; the text of a token that
the tokenizer's file adds is that token; repeated rows are packed each by itself; null ids are kept; an empty table gives an empty table.
Only the id and text columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailweave.llm import pieces as cuts
from mailweave.llm.common import shuffle_partitions, slices, written


#: Groups of equal cardinality, and so sizes at most.
GROUPS = 128
#: Fractions of the capacity up to which a piece may count as small.
SMALL_PARTS = (2, 3, 4, 6, 8, 12, 16, 32)


class Rule(NamedTuple):
    """Pieces of one length, by rank from ``rank`` on: ``each`` per sequence, from
    ``sequence`` on, the first at ``offset``."""

    length: int
    rank: int
    sequence: int
    each: int
    offset: int


def _groups(lengths: list[int], counts: dict[int, int], groups: int):
    """Linear grouping: (rounded size, first item, end) over the items by falling length."""
    total = sum(counts[x] for x in lengths)
    edges = sorted({-(-total * g // groups) for g in range(groups + 1)})
    starts, at = [], 0
    for x in lengths:
        starts.append(at)
        at += counts[x]
    out, i = [], 0
    for first, end in zip(edges, edges[1:]):
        while i + 1 < len(starts) and starts[i + 1] <= first:
            i += 1
        if out and out[-1][0] == lengths[i]:
            out[-1][2] = end  # groups of one size are one size to the configurations
        else:
            out.append([lengths[i], first, end])
    return out


def _best_fill(sizes: list[int], left: list[int], room: int) -> list[int]:
    """Indices of the sizes (falling) whose sum is the largest that is at most ``room``."""
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for i, size in enumerate(sizes):
        if size > room:
            continue
        for _ in range(min(left[i], room // size)):
            grown = reach | (reach << size) & mask
            if grown == reach:
                break
            steps.append((i, reach))
            reach = grown
    best, out = reach.bit_length() - 1, []
    for i, before in reversed(steps):
        if not before >> best & 1:
            out.append(i)
            best -= sizes[i]
    return out


def plan(histogram: dict[int, int], capacity: int, groups: int = GROUPS):
    """Rules for all pieces of a histogram {length: number}, and the number of sequences.

    What counts as small is tried at several fractions of the capacity; the plan of
    fewest sequences is taken. Up to a half, no two large pieces share a sequence, and
    what rounding adds is all left to the small ones; below, configurations hold several.
    """
    plans = (_plan(histogram, capacity, groups, capacity // part) for part in SMALL_PARTS)
    return min(plans, key=lambda found: found[1])


def _plan(histogram: dict[int, int], capacity: int, groups: int, small: int):
    counts = {int(x): int(n) for x, n in histogram.items() if n}
    rules: list[Rule] = []
    used = counts.get(capacity, 0)
    if used:
        rules.append(Rule(capacity, 0, 0, 1, 0))
    large = sorted((x for x in counts if small < x < capacity), reverse=True)
    starts, at = {}, 0
    for x in large:
        starts[x] = at
        at += counts[x]
    ends = [starts[x] + counts[x] for x in large]
    free: dict[int, list[tuple[int, int]]] = {}

    grouped = _groups(large, counts, groups) if large else []
    sizes = [g[0] for g in grouped]
    left = [g[2] - g[1] for g in grouped]
    place = [g[1] for g in grouped]
    for top in range(len(sizes)):
        while left[top]:
            left[top] -= 1
            chosen = [top, *_best_fill(sizes, left, capacity - sizes[top])]
            left[top] += 1
            times = {i: chosen.count(i) for i in chosen}
            repeat = min(left[i] // n for i, n in times.items())
            begins = []
            for i in chosen:
                begins.append(place[i])
                place[i] += repeat
                left[i] -= repeat
            # sequences whose places hold equal lengths lie side by side
            j = 0
            while j < repeat:
                which = [int(np.searchsorted(ends, b + j, "right")) for b in begins]
                step = min([repeat - j, *(ends[w] - b - j for w, b in zip(which, begins))])
                offset = 0
                for w, b in zip(which, begins):
                    length = large[w]
                    rules.append(Rule(length, b + j - starts[length], used + j, 1, offset))
                    offset += length
                free.setdefault(capacity - offset, []).append((used + j, step))
                j += step
            used += repeat

    for length in sorted((x for x in counts if x <= small), reverse=True):
        n, rank, rooms = counts[length], 0, iter(sorted(r for r in free if r >= length))
        while n:
            room = next(rooms, None)
            if room is None:
                room = capacity
                need = -(-n // (capacity // length))
                blocks, used = [(used, need)], used + need
            else:
                blocks = free.pop(room)
            each = room // length
            while blocks and n:
                sequence, many = blocks.pop()
                whole = min(many, n // each)
                rest = n - whole * each if whole < many else 0
                for first, number, per in (
                    (sequence, whole, each),
                    (sequence + whole, 1 if rest else 0, min(rest, each)),
                ):
                    if number:
                        rules.append(Rule(length, rank, first, per, capacity - room))
                        rank += number * per
                        n -= number * per
                        free.setdefault(room - per * length, []).append((first, number))
                kept = whole + (1 if rest else 0)
                if kept < many:
                    blocks.append((sequence + kept, many - kept))
            if blocks:
                free.setdefault(room, []).extend(blocks)
    return rules, used


def cut_documents(
    df: DataFrame,
    tokenizer: str,
    pattern: str,
    end_id: int,
    capacity: int,
    buckets: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 and a bucket.

    Buckets are dealt in turn, so that pieces of one length, of one id or of equal
    rows are spread evenly.
    """
    content = cuts.file_content(tokenizer)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = cuts.encoder(content, pattern, added=True)
        turn = TaskContext.get().partitionId() * 7919
        for part in slices(batches):
            texts = [text or "" for text in part.column(1).to_pylist()]
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(own.encode(texts)):
                data = memoryview(ids + end)
                total = len(data) // 4
                cut = [0, *range((total - 1) % capacity + 1, total + 1, capacity)]
                for k, (a, b) in enumerate(zip(cut, cut[1:])):
                    row.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(data[4 * a : 4 * b]))
            bucket = (np.arange(len(row)) + turn) % buckets
            turn += len(row)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                    pa.array(bucket.astype(np.int32)),
                ],
                names=names,
            )

    schema = (
        T.StructType([T.StructField("id", df.schema[id_col].dataType)])
        .add("piece", "integer")
        .add("start", "long")
        .add("length", "long")
        .add("ids_crc32", "long")
        .add("bucket", "integer")
    )
    names = schema.names
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, schema)


def pack(
    df: DataFrame,
    tokenizer: str,
    pattern: str,
    end_id: int,
    capacity: int = 1024,
    groups: int = GROUPS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: the id column, piece, start, length, ids_crc32, sequence_id, offset."""
    buckets = 4 * shuffle_partitions(df.sparkSession)
    found = written(
        cut_documents(df, tokenizer, pattern, end_id, capacity, buckets, id_col, text_col),
        "pieces",
    )
    counts = written(found.groupBy("bucket", "length").agg(F.count("*").alias("n")), "counts")
    histogram = {x.length: x.n for x in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rules, _ = plan(histogram, capacity, groups)

    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        "bucket", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    own = Window.partitionBy("bucket", "length").orderBy("id", "piece", "ids_crc32")
    ranked = (
        found.withColumn("place", F.row_number().over(own) - 1)
        .join(bases, ["bucket", "length"])
        .withColumn("rank", F.col("base") + F.col("place"))
    )
    return _placed(ranked, rules).withColumnRenamed("id", id_col)


def _placed(ranked: DataFrame, rules: list[Rule]) -> DataFrame:
    ordered = np.array(sorted(rules), np.int64).reshape(-1, 5)
    keys = (ordered[:, 0] << 48) | ordered[:, 1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if not part.num_rows:
                continue
            length = part.column(3).to_numpy()
            rank = part.column(5).to_numpy()
            rule = ordered[np.searchsorted(keys, (length << 48) | rank, "right") - 1]
            step = rank - rule[:, 1]
            sequence = rule[:, 2] + step // rule[:, 3]
            offset = rule[:, 4] + step % rule[:, 3] * length
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:5], pa.array(sequence), pa.array(offset)], names=schema.names
            )

    chosen = ranked.select("id", "piece", "start", "length", "ids_crc32", "rank")
    schema = T.StructType(chosen.schema.fields[:5]).add("sequence_id", "long").add("offset", "long")
    return chosen.mapInArrow(run, schema)
