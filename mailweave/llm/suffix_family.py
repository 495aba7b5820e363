"""Exact removal of long repeated byte strings, with a logarithmic family of suffix arrays.

A byte goes if it lies in a string of ``length`` bytes that starts anywhere else as well.
Suffix arrays of all positions would be many times the text, so they are sparse:

* Anchors. Of all `GRAM`-byte strings inside a window of ``length`` bytes the one of least
  hash is the window's anchor, so equal windows have equal anchors at equal places. A run is
  a stretch of windows with the same anchor; there is about one per 75 bytes. Anchors that
  occur once cannot lie in a repeated window and are dropped by a count.
* Runs of equal bytes are one class from here on; what occurs twice repeats as a whole.
  One occurrence of each class brings its bytes.
* The index. Classes are dealt by their anchor. A task takes them in batches; each batch
  gets two suffix arrays, of what follows the anchor and (reversed) of what precedes it.
  Levels of equal size merge geometrically. When two levels merge, their neighbours'
  common prefixes are scanned: two windows at distance d before the anchor are equal if their
  classes agree in the d bytes before it and in ``length - d`` after it, which are groups of
  neighbours in both arrays. In the end all levels are merged, so any two classes meet once.

Hot anchors, with over `HOT` classes (the edge of a passage that very many documents share),
are not brought together: each of their windows is a row with a 128-bit hash, counted with
partial sums. Matches never cross rows; whole texts are read.

Defined cases: a null text is empty; texts shorter than ``length`` stay whole; equal rows
repeat each other; rows of equal ids and other texts are separate; an empty table gives
an empty table. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailweave.llm.common import by_slices, claim, release, removed, slices, written

GRAM = 50
#: Bytes hashed at once, which takes about 95 times as many; longer texts are taken in pieces that
#: share ``length - 1`` bytes.
PIECE = 1 << 18
#: Classes of a batch of the index, and classes of one anchor beyond which it is hot.
BATCH, HOT = 8192, 50_000
_PLACE = np.uint64((1 << 24) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15 | 5
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUE = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    if len(_powers.get(base, ())) < n:
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base][:n]


def _prefix(data: np.ndarray) -> np.ndarray:
    """Sums of which differences are polynomial hashes modulo 2^64."""
    claim("suffix_family", _powers.clear)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * _power(_BASE, len(data)), out=sums[1:])
    return sums


def _hash(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    return _mixed((sums[end] - sums[begin]) * _power(_INVERSE, len(sums))[begin])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` successive values."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def runs(data: np.ndarray, ends: np.ndarray, length: int):
    """Runs of the texts that lie in ``data`` one after the other, up to ``ends``.

    Returns the anchor's hash, the run's hash, the run's first and last window and the
    anchor's place, all as places in ``data``.
    """
    empty = (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 3
    if len(data) < length:
        return empty
    sums = _prefix(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = _hash(sums, at, at + GRAM)
    keys = (grams & ~_PLACE) | at.astype(np.uint64)
    anchor = (_least(keys, length - GRAM + 1) & _PLACE).astype(np.int64)
    starts = np.arange(len(anchor))
    # windows that end in the text they begin in
    first = np.searchsorted(ends, starts, "right")
    starts = starts[ends[first] >= starts + length]
    if not len(starts):
        return empty
    anchor = anchor[starts]
    new = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(starts) != 1)) + 1
    low, high = np.concatenate(([0], new)), np.concatenate((new, [len(starts)])) - 1
    s, e, a = starts[low], starts[high], anchor[low]
    whole = _hash(sums, s, e + length) ^ _mixed((a - s + 1).astype(np.uint64))
    return grams[a], whole, s, e, a


def _pieces(texts: list[bytes], length: int):
    """(numbers of texts, where each begins in its text, data, ends): all texts in pieces of
    at most about `PIECE` bytes, long ones in several that overlap by ``length - 1``."""
    numbers, offsets, parts, held = [], [], [], 0

    def flush():
        ends = np.cumsum([len(p) for p in parts])
        return numbers, offsets, np.frombuffer(b"".join(parts), np.uint8), ends

    for i, text in enumerate(texts):
        if len(text) < length:
            continue
        for begin in range(0, max(1, len(text) - length + 1), PIECE):
            part = text[begin : begin + PIECE + length - 1]
            if held and held + len(part) > PIECE + length:
                yield flush()
                numbers, offsets, parts, held = [], [], [], 0
            numbers.append(i)
            offsets.append(begin)
            parts.append(part)
            held += len(part)
    if parts:
        yield flush()


_RUNS = "anchor long, run long, id long, text_hash long, s long, e long, a long"


def _find_runs(length: int):
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2, PIECE):
            texts = [text or b"" for text in part.column(2).to_pylist()]
            ids, hashes = part.column(0).to_numpy(), part.column(1).to_numpy()
            for numbers, offsets, data, ends in _pieces(texts, length):
                gram, run, s, e, a = runs(data, ends, length)
                which = np.searchsorted(ends, s, "right")
                begin = (ends - np.diff(np.concatenate(([0], ends))))[which]
                shift = np.array(offsets, np.int64)[which] - begin
                row = np.array(numbers, np.int64)[which]
                columns = [gram.view(np.int64), run.view(np.int64), ids[row], hashes[row]]
                columns += [s + shift, e + shift, a + shift]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], names=[c.split()[0] for c in _RUNS.split(", ")]
                )
        _powers.clear()
        release()

    return find


# ---- the index --------------------------------------------------------------


class Level:
    """Classes in the order of what follows and of what precedes their anchors."""

    def __init__(self, rows: np.ndarray, after: np.ndarray, before: np.ndarray, numbers, orders=None):
        # numbers: of the classes; rows: anchor's bytes before the anchor, and least of them
        self.rows, self.after, self.before, self.numbers = rows, after, before, numbers
        self.by_after, self.by_before = orders or (_order(after), _order(before))

    def __len__(self):
        return len(self.numbers)

    def merged(self, other: Level) -> Level:
        n = len(self)
        after = np.concatenate((self.after, other.after))
        before = np.concatenate((self.before, other.before))
        orders = []
        for own, theirs, keys in (
            (self.by_after, other.by_after, after),
            (self.by_before, other.by_before, before),
        ):
            both = np.concatenate((own, theirs + n))
            # two sorted runs: a stable sort merges them in linear time
            orders.append(both[_order(keys[both])])
        rows = np.concatenate((self.rows, other.rows))
        return Level(rows, after, before, np.concatenate((self.numbers, other.numbers)), orders)

    def scan(self, repeated: np.ndarray, length: int) -> None:
        """Mark in ``repeated`` [class, distance] the windows that two classes share."""
        follows, precedes = (
            _common(keys, order) - 8
            for keys, order in ((self.after, self.by_after), (self.before, self.by_before))
        )
        if not len(follows) or follows.max() < 0:
            return
        # only classes that share their anchor with another one take part
        share = np.zeros(len(self), bool)
        near = follows >= 0
        share[self.by_after[1:][near]] = share[self.by_after[:-1][near]] = True
        least, most = self.rows[:, 1], self.rows[:, 0]
        group_after, group_before = np.zeros(len(self), np.int64), np.zeros(len(self), np.int64)
        for distance in range(int(least[share].min()), int(most[share].max()) + 1):
            at = np.flatnonzero(share & (least <= distance) & (distance <= most))
            if len(at) < 2:
                continue
            group_after[self.by_after[1:]] = np.cumsum(follows < length - distance)
            group_before[self.by_before[1:]] = np.cumsum(precedes < distance)
            cell = group_after[at] * len(self) + group_before[at]
            order = np.argsort(cell, kind="stable")
            same = cell[order][1:] == cell[order][:-1]
            hit = np.zeros(len(at), bool)
            hit[order[1:][same]] = hit[order[:-1][same]] = True
            repeated[self.numbers[at[hit]], distance] = True


def _order(keys: np.ndarray) -> np.ndarray:
    """Stable order of rows of bytes."""
    return np.argsort(np.ascontiguousarray(keys).view(f"V{keys.shape[1]}").ravel(), kind="stable")


def _common(keys: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row with the one before it in ``order``."""
    sorted_ = keys[order]
    differs = sorted_[1:] != sorted_[:-1]
    return np.where(differs.any(axis=1), differs.argmax(axis=1), keys.shape[1])


class Family:
    """Levels of batches; two of equal size become one of twice the size."""

    def __init__(self, length: int):
        self._length, self._levels, self._sizes = length, [], []
        self.repeated = np.zeros((0, length - GRAM + 1), bool)

    def add(self, anchors: np.ndarray, contexts: list[bytes], before: np.ndarray) -> None:
        """A batch of classes: anchor, bytes of the run, bytes of it before the anchor."""
        n, wide = len(contexts), self._length - GRAM
        size = np.array([len(c) for c in contexts])
        start = len(self.repeated)
        self.repeated = np.concatenate((self.repeated, np.zeros((n, wide + 1), bool)))
        head = anchors.astype(">u8").view(np.uint8).reshape(n, 8)
        after, ahead = np.zeros((n, 8 + self._length), np.uint8), np.zeros((n, 8 + wide), np.uint8)
        after[:, :8] = ahead[:, :8] = head
        for i, (context, b) in enumerate(zip(contexts, before.tolist())):
            data = np.frombuffer(context, np.uint8)
            right = data[b : b + self._length]
            after[i, 8 : 8 + len(right)] = right
            ahead[i, 8 : 8 + b] = data[:b][::-1]
        rows = np.stack((before, np.maximum(0, before - (size - self._length))), axis=1)
        level = Level(rows, after, ahead, np.arange(start, start + n))
        level.scan(self.repeated, self._length)
        self._put(level, 1)

    def _put(self, level: Level, batches: int) -> None:
        while self._sizes and self._sizes[-1] <= batches:
            level, batches = self._merge(level, batches)
        self._levels.append(level)
        self._sizes.append(batches)

    def _merge(self, level: Level, batches: int):
        level = self._levels.pop().merged(level)
        level.scan(self.repeated, self._length)
        return level, batches + self._sizes.pop()

    def close(self) -> np.ndarray:
        while len(self._levels) > 1:
            level, batches = self._levels.pop(), self._sizes.pop()
            level, batches = self._merge(level, batches)
            self._levels.append(level)
            self._sizes.append(batches)
        return self.repeated


def _intervals(repeated: np.ndarray, before: np.ndarray, length: int):
    """Per class, the byte ranges (from the run's begin) that its repeated windows cover."""
    edge = np.zeros((len(repeated), 1), np.int8)
    steps = np.diff(np.concatenate((edge, repeated.astype(np.int8), edge), axis=1), axis=1)
    row, least = np.nonzero(steps == 1)
    most = np.nonzero(steps == -1)[1] - 1
    # the window at distance d begins at before - d
    return row, before[row] - most, before[row] - least + length


_CONTEXTS = "anchor long, run long, before long, context binary"
_FOUND = "anchor long, run long, low long, high long"


def _search(length: int):
    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, kept = Family(length), []
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH):
                part = batch.slice(i, BATCH)
                anchors, before = part.column(0).to_numpy(), part.column(2).to_numpy()
                family.add(anchors.view(np.uint64), part.column(3).to_pylist(), before)
                kept.append((anchors, part.column(1).to_numpy(), before))
        if not kept:
            return
        anchors, run, before = (np.concatenate(c) for c in zip(*kept))
        row, low, high = _intervals(family.close(), before, length)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (anchors[row], run[row], low, high)],
            names=["anchor", "run", "low", "high"],
        )
        del family, kept
        release()

    return search


# ---- the job ----------------------------------------------------------------


def _contexts(length: int, windows: bool):
    """The bytes of the wanted runs of each text, or the hashes of their windows."""

    def bring(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 0, PIECE):
            out: list[list] = [[], [], [], [], []]
            for text, wanted in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                for x in wanted:
                    context = text[x["s"] : x["e"] + length]
                    if not windows:
                        row = (x["anchor"], x["run"], x["a"] - x["s"], context)
                        for column, value in zip(out, row):
                            column.append(value)
                        continue
                    sums = _prefix(np.frombuffer(context, np.uint8))
                    at = np.arange(len(context) - length + 1)
                    middle = at + length // 2
                    halves = _hash(sums, at, middle), _hash(sums, middle, at + length)
                    out[0] += [x["anchor"]] * len(at)
                    out[1] += [x["run"]] * len(at)
                    out[2] += at.tolist()
                    out[3] += halves[0].view(np.int64).tolist()
                    out[4] += halves[1].view(np.int64).tolist()
            kinds = [pa.int64()] * 3 + ([pa.int64()] * 2 if windows else [pa.binary()])
            names = ["anchor", "run", *(["at", "h1", "h2"] if windows else ["before", "context"])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(out, kinds)], names=names
            )

    return bring


def _rows(df: DataFrame, id_col: str, text_col: str, keep: Sequence[str]) -> DataFrame:
    """Rows with a key (id, text_hash) that is the same for equal ids and texts only."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    return df.select(
        own.alias("id"),
        F.xxhash64(text).alias("text_hash"),
        text.cast("binary").alias("data"),
        F.struct(*keep).alias("row"),
    )


def _wanted(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Texts with the list of the classes they bring; one of several equal rows is enough."""
    wanted = classes.groupBy("rep.id", "rep.text_hash").agg(
        F.collect_list(F.struct("anchor", "run", "rep.s", "rep.e", "rep.a")).alias("wanted")
    )
    wanted = written(wanted, "wanted")
    return rows.join(wanted, ["id", "text_hash"]).select("data", "wanted")


def repeats(rows: DataFrame, length: int) -> DataFrame:
    """Byte ranges (id, text_hash, low, high) that repeated windows cover."""
    found = written(rows.where(F.length("data") >= length).mapInArrow(_find_runs(length), _RUNS), "runs")
    anchors = found.groupBy("anchor").agg(F.count("*").alias("times")).where("times > 1")
    anchors = written(anchors, "anchors")
    shared = written(found.join(anchors.select("anchor"), "anchor"), "shared")
    removed(found, anchors)
    rep = F.min(F.struct("id", "text_hash", "s", "e", "a")).alias("rep")
    classes = written(
        shared.groupBy("anchor", "run").agg(F.count("*").alias("times"), rep), "classes"
    )
    sizes = classes.groupBy("anchor").agg(F.count("*").alias("classes")).where("classes > 1")
    sizes = written(sizes, "sizes")
    several = written(classes.join(sizes, "anchor"), "several")

    plain = several.where(F.col("classes") <= HOT)
    contexts = _wanted(rows, plain).mapInArrow(_contexts(length, False), _CONTEXTS)
    ranges = contexts.repartition("anchor").mapInArrow(_search(length), _FOUND)
    hot = several.where(F.col("classes") > HOT)
    if hot.limit(1).count():
        kind = "anchor long, run long, at long, h1 long, h2 long"
        windows = written(_wanted(rows, hot).mapInArrow(_contexts(length, True), kind), "windows")
        often = windows.groupBy("h1", "h2").agg(F.count("*").alias("times")).where("times > 1")
        again = windows.join(written(often, "often"), ["h1", "h2"])
        ranges = ranges.union(
            again.select("anchor", "run", F.col("at").alias("low"), F.col("at") + length)
        )
    # a class that occurs twice repeats as a whole
    whole = classes.where("times > 1").select(
        "anchor", "run", F.lit(0).cast("long").alias("low"), (F.expr("rep.e - rep.s") + length).alias("high")
    )
    ranges = written(ranges.union(whole), "ranges")
    at = [(F.col(c) + F.col("s")).alias(c) for c in ("low", "high")]
    return written(
        shared.join(ranges, ["anchor", "run"]).select("id", "text_hash", *at).distinct(), "cover"
    )


_KEPT = pa.struct(
    [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())]
)


def _cut(part: pa.RecordBatch) -> pa.Array:
    """What remains of each text (first column) without the ranges low to high."""
    out = []
    for text, low, high in zip(*(column.to_pylist() for column in part.columns)):
        end, kept, spans, gone = 0, [], 0, 0
        last = None
        for a, b in sorted(zip(low or (), high or ())):
            if last is None or a > last:
                kept.append(text[end:a])
                spans += 1
                gone += b - a
                end = last = b
            elif b > last:
                gone += b - last
                end = last = b
        kept.append(text[end:])
        out.append((len(text), gone, spans, b"".join(kept)))
    return pa.StructArray.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*out), _KEPT)], fields=list(_KEPT)
    )


def without_repeats(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 200,
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """(row, n_bytes, n_removed, n_spans, kept): one row per input row; row has the ``keep``
    columns, kept the bytes that remain, and n_spans counts the maximal removed runs."""
    rows = _rows(df, id_col, text_col, keep)
    cover = repeats(rows, length)
    lists = cover.groupBy("id", "text_hash").agg(
        F.collect_list("low").alias("low"), F.collect_list("high").alias("high")
    )
    lists = written(lists, "lists")
    run = by_slices(_cut, _KEPT)

    # Only the bytes and ranges go to Python, not the rows.
    @F.arrow_udf("n_bytes long, n_removed long, n_spans long, kept binary")
    def cut(data: pa.Array, low: pa.Array, high: pa.Array) -> pa.Array:
        return run(data, low, high)

    joined = rows.join(lists, ["id", "text_hash"], "left")
    found = joined.select("row", cut.asNondeterministic()("data", "low", "high").alias("found"))
    return found.select("row", "found.*")
