"""SimHash fingerprints, and a search for all fingerprints within a Hamming radius.

The terms of a text are its windows of three words (of fewer, if it has fewer). Each
occurrence votes with its weight, the number of characters in it up to 32, for or against
each bit of the 128 by the sign of that bit in its hash. Votes are counted per byte value
and turned into bits by one matrix product.

Two fingerprints within ``radius`` bits differ in at most ``radius // blocks`` bits of at
least one of ``blocks`` blocks. The search keys every distinct fingerprint by each of its
blocks, which is the same as one table per permutation that brings a block to the front, asks
for each block of a query and, if one bit may differ, for the block with each bit flipped,
verifies the distance and counts each pair at the first such block only. Equal fingerprints are
one row of these tables, so a large group of copies costs nothing.

Defined cases: a null or empty text, or one without words, has no terms and the fingerprint
of zeros; equal texts have equal fingerprints whatever else their rows hold. The next
document is the next row by (id, text), null ids first, the first row after the last. Texts
are read whole. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailweave.llm.common import claim, shuffle_partitions, slices, written

BITS = 128
#: Words a worker remembers the hash of, about 130 bytes each.
REMEMBERED = 400_000

_words = re.compile(r"[^ \t-\r]+").findall
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_SIGNS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float32) * 2 - 1
_hash_of: dict[str, int] = {}


def _hashes(words: list[str]) -> np.ndarray:
    claim("simhash", _hash_of.clear)
    unknown = set(words).difference(_hash_of)
    if unknown:
        if len(_hash_of) + len(unknown) > REMEMBERED:
            _hash_of.clear()
            unknown = set(words)
        _hash_of.update((w, xxhash.xxh3_64_intdigest(w)) for w in unknown)
    return np.fromiter(map(_hash_of.__getitem__, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(texts: list[str]) -> np.ndarray:
    """A row of 16 bytes for each text."""
    rows = [_words(text) for text in texts]
    counts = np.array([len(row) for row in rows], np.int64)
    words = [w for row in rows for w in row]
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(rows)), counts)
    hashes = _hashes(words)
    size = np.fromiter(map(len, words), np.float64, len(words))
    place = np.arange(len(words)) - (ends - counts)[owner]
    left = counts[owner] - place  # words from here to the end of the text
    term, weight = hashes * _ODD[0], size
    for step in (1, 2):
        inside = left > step
        at = np.minimum(np.arange(len(words)) + step, max(0, len(words) - 1))
        term = term + np.where(inside, hashes[at] * _ODD[step], np.uint64(0))
        weight = weight + np.where(inside, size[at], 0)
    # windows of three, or the whole text if it has fewer words
    whole = (left >= 3) | (place == 0)
    term, weight, owner = term[whole], np.minimum(weight[whole], 32), owner[whole]
    data = np.stack([_mixed(term), _mixed(term ^ _ODD[1])], axis=1).view(np.uint8)
    votes = np.empty((len(rows), BITS // 8, 8), np.float32)
    base = owner * 256
    for byte in range(BITS // 8):
        found = np.bincount(base + data[:, byte], weight, minlength=len(rows) * 256)
        votes[:, byte] = found.reshape(-1, 256).astype(np.float32) @ _SIGNS
    return np.packbits(votes.reshape(len(rows), BITS) > 0, axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cosine of the angle that the differing bits estimate, at least 0."""
    differing = np.bitwise_count(a ^ b).sum(axis=1)
    return np.maximum(0.0, np.round(np.cos(math.pi * differing / BITS), 6))


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


# ---- rows with the next row -------------------------------------------------


def _bucket(value, bounds: list):
    """How many of the sorted ``bounds`` are at most ``value``, plus 1; 0 for null."""
    if not bounds:
        return F.when(value.isNull(), 0).otherwise(1)
    step = max(1, math.isqrt(len(bounds)))
    heads = F.array(*map(F.lit, bounds[::step]))
    parts = F.array(*(F.array(*map(F.lit, bounds[i : i + step])) for i in range(0, len(bounds), step)))
    part = F.size(F.filter(heads, lambda b: b <= value))
    inside = F.size(F.filter(F.element_at(parts, F.greatest(part, F.lit(1))), lambda b: b <= value))
    found = F.when(part == 0, 1).otherwise((part - 1) * step + inside + 1)
    return F.when(value.isNull(), 0).otherwise(found)


def in_order(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (bucket, after, id, text) placed so that neighbours by (id, text) are in one task:
    each bucket is a range of ids, and its last rows (after = 1) are the first id of the next.

    The driver holds one bound and one id per bucket, some per shuffle partition.
    """
    rows = df.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    n = 8 * shuffle_partitions(df.sparkSession)
    shares = [i / n for i in range(1, n)]
    found = rows.agg(F.percentile_approx("id", shares, 20 * n).alias("bounds")).head().bounds
    bounds = sorted(set(found or []))
    bucket = _bucket(F.col("id"), bounds)
    firsts = rows.groupBy(bucket.alias("bucket")).agg(F.min("id").alias("id")).orderBy("bucket").collect()
    before = {x.id: firsts[i - 1].bucket for i, x in enumerate(firsts)}
    own = F.struct(bucket.alias("bucket"), F.lit(0).alias("after"))
    places = F.array(own)
    if before:
        previous = F.create_map(*(F.lit(x) for item in before.items() if item[0] is not None for x in item)) \
            if any(x is not None for x in before) else None
        to = F.lit(before[None]) if None in before else F.lit(None).cast("int")
        if previous is not None:
            known = [x for x in before if x is not None]
            to = F.when(F.col("id").isin(known), previous[F.col("id")]).otherwise(
                F.when(F.col("id").isNull(), to)
            )
        handed = F.struct(to.alias("bucket"), F.lit(1).alias("after"))
        places = F.when(to.isNotNull(), F.array(own, handed)).otherwise(places)
    placed = rows.select(F.explode(places).alias("p"), "id", "text")
    placed = placed.select("p.bucket", "p.after", "id", "text")
    return placed.repartition("bucket").sortWithinPartitions("bucket", "after", "id", "text")


_PAIRS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, high long, low long"
)


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None  # the last row, which waits for the next one
    for part in slices(batches, 3):
        rows = list(zip(*(column.to_pylist() for column in part.columns)))
        if held is not None:
            rows.insert(0, held)
        held = rows[-1] if rows and not rows[-1][1] else None
        texts = [row[3] for row in rows]
        pairs = [
            i
            for i, (a, b) in enumerate(zip(rows, rows[1:]))
            if not a[1] and a[0] == b[0]
        ]
        if not pairs:
            continue
        changed = [edited(texts[i], texts[i + 1]) for i in pairs]
        prints, new = fingerprints(texts), fingerprints(changed)
        own, following = prints[pairs], prints[[i + 1 for i in pairs]]
        words = own.view(">i8").astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([rows[i][2] for i in pairs], pa.int64()),
                pa.array([len(texts[i]) for i in pairs], pa.int64()),
                pa.array([hashlib.sha256(text.encode()).hexdigest() for text in changed]),
                pa.array([row.tobytes().hex() for row in own]),
                pa.array([row.tobytes().hex() for row in new]),
                pa.array(likeness(own, new)),
                pa.array(likeness(own, following)),
                pa.array(words[:, 0]),
                pa.array(words[:, 1]),
            ],
            names=[field.split()[0] for field in _PAIRS.split(", ")],
        )


def compare_in_order(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its fingerprint (and its halves ``high`` and ``low``), that of its
    edited text, and their likeness to each other and to the next document's."""
    return in_order(df, id_col, text_col).mapInArrow(_compare, _PAIRS)


# ---- search -----------------------------------------------------------------


def near_counts(prints: DataFrame, queries: DataFrame, radius: int = 3, blocks: int = 4) -> DataFrame:
    """For each distinct (high, low) of ``queries``, how many rows of ``prints`` lie within
    ``radius`` bits (rows of the same fingerprint included)."""
    errors = radius // blocks
    if not 3 <= blocks <= 16 or not 0 <= errors <= 1:
        raise ValueError("radius must be less than twice the number of blocks, of which there are 3 to 16")
    starts = [i * BITS // blocks for i in range(blocks + 1)]
    widths = [b - a for a, b in zip(starts, starts[1:])]
    digits = F.concat(F.lpad(F.bin("high"), 64, "0"), F.lpad(F.bin("low"), 64, "0"))
    keys = [F.conv(F.substring(digits, 1 + a, n), 2, 10).cast("long") for a, n in zip(starts, widths)]
    table = prints.groupBy("high", "low").agg(F.count("*").alias("n"))
    keyed = table.select("*", F.posexplode(F.array(*keys)).alias("block", "key"))
    flips = lambda n: [0] + [1 << i for i in range(n)] * errors
    probes = F.array(
        *(F.array(*(key.bitwiseXOR(F.lit(x).cast("long")) for x in flips(n))) for key, n in zip(keys, widths))
    )
    asked = queries.select(F.col("high").alias("q_high"), F.col("low").alias("q_low"), probes.alias("probes"))
    asked = asked.distinct().select("q_high", "q_low", F.posexplode("probes").alias("block", "probes"))
    asked = asked.select("q_high", "q_low", "block", F.explode("probes").alias("key"))
    pairs = written(keyed, "blocks").join(written(asked, "asked"), ["block", "key"])
    unlike = [F.col(c).bitwiseXOR(F.col(f"q_{c}")) for c in ("high", "low")]
    distance = F.bit_count(unlike[0]) + F.bit_count(unlike[1])
    masks = [((1 << n) - 1) << (BITS - a - n) for a, n in zip(starts, widths)]
    halves = [[_signed(mask >> 64), _signed(mask & (1 << 64) - 1)] for mask in masks]
    inside = [sum(F.bit_count(x.bitwiseAND(F.lit(m).cast("long"))) for x, m in zip(unlike, half)) for half in halves]
    first = F.array_position(F.array(*(x <= errors for x in inside)), F.lit(True)) == F.col("block") + 1
    return (
        pairs.where((distance <= radius) & first)
        .groupBy(F.col("q_high").alias("high"), F.col("q_low").alias("low"))
        .agg(F.sum("n").alias("n_near"))
    )


def _signed(half: int) -> int:
    return half - (1 << 64) if half >> 63 else half
