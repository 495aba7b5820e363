"""Byte-level BPE encoding and decoding on padded matrices.

A text is cut by a pattern; equal cuts are encoded once. Cuts of similar length
form the rows of one padded matrix. In every round each row merges its leftmost
pair of smallest rank; a pair's rank comes from a hash table in numpy arrays.
Rows without a mergeable pair leave the matrix.

Cuts over `LONG` bytes would need as many rounds as they have bytes, so they are
merged one by one with a heap, in the same order.

Defined cases: a null or empty text has no ids and decodes to no bytes; a null
list of ids decodes to null; an id outside the vocabulary is an error; rows are
independent, so repeated rows and ids are kept as they are; an empty table gives
an empty table. Only the columns in ``keep`` are read besides the text, so other
columns may have any name.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailweave.llm.common import claim, slices

LONG = 256
#: Cuts a worker remembers, about 150 bytes each.
REMEMBERED = 400_000
NO_RANK = np.int32(np.iinfo(np.int32).max)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Hash table from two ids to the id of their concatenation; linear probing."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        keys = self._key(left, right)
        bits = max(4, int(2 * max(1, len(keys)) - 1).bit_length() + 1)
        self._shift, self._mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self._keys = np.zeros(1 << bits, np.uint64)
        self._merged = np.full(1 << bits, NO_RANK, np.int32)
        at = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self._keys[at] == 0)
            slot, first = np.unique(at[free], return_index=True)
            placed = free[first]
            self._keys[slot], self._merged[slot] = keys[placed], merged[placed]
            rest = np.ones(len(keys), bool)
            rest[placed] = False
            keys, merged, at = keys[rest], merged[rest], (at[rest] + 1) & self._mask

    @staticmethod
    def _key(left, right):
        # one is added so that no key is 0, the empty slot
        return ((left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)) + np.uint64(1)

    def _slot(self, keys):
        return ((keys * _MIX) >> self._shift).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged id of each pair, which is its rank; NO_RANK if none."""
        keys = self._key(left, right)
        out = np.full(len(keys), NO_RANK, np.int32)
        at, open_ = self._slot(keys), np.arange(len(keys))
        while len(open_):
            found = self._keys[at]
            hit = found == keys
            out[open_[hit]] = self._merged[at[hit]]
            on = ~hit & (found != 0)
            open_, keys, at = open_[on], keys[on], (at[on] + 1) & self._mask
        return out


class Codec:
    """Encoder and decoder for one rank file (`token in base64, rank` per line)."""

    def __init__(self, rank_file: bytes, pattern: str):
        lines = (line.split() for line in rank_file.splitlines() if line.strip())
        self.rank = {base64.b64decode(token): int(rank) for token, rank in lines}
        self._cut = regex.compile(pattern).findall
        self._byte_id = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        pairs = [
            (self.rank[token[:i]], self.rank[token[i:]], rank)
            for token, rank in self.rank.items()
            for i in range(1, len(token))
            if token[:i] in self.rank and token[i:] in self.rank
        ]
        self._pairs = PairTable(*np.array(pairs, np.int32).reshape(-1, 3).T)
        self._known: dict[str, bytes] = {}
        size = max(self.rank.values()) + 1
        self._length = np.full(size, -1, np.int64)
        tokens = sorted(self.rank.items(), key=lambda item: item[1])
        self._length[[rank for _, rank in tokens]] = [len(token) for token, _ in tokens]
        self._start = np.cumsum(np.maximum(self._length, 0)) - np.maximum(self._length, 0)
        self._flat = np.frombuffer(b"".join(token for token, _ in tokens), np.uint8)

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        cuts = [self._cut(text) for text in texts]
        unknown = set().union(*cuts).difference(self._known)
        if unknown:
            if len(self._known) + len(unknown) > REMEMBERED:
                self._known = {}
                unknown = set().union(*cuts)
            unknown = list(unknown)
            self._known.update(zip(unknown, self._encode_cuts([c.encode() for c in unknown])))
        look = self._known.__getitem__
        return [b"".join(map(look, row)) for row in cuts]

    def _encode_cuts(self, cuts: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(cuts)
        buckets: dict[int, list[int]] = {}
        for i, cut in enumerate(cuts):
            whole = self.rank.get(cut)
            if whole is not None:
                out[i] = np.int32(whole).tobytes()
            elif len(cut) > LONG:
                out[i] = self._merge_long(cut)
            else:
                buckets.setdefault((len(cut) - 1).bit_length(), []).append(i)
        for members in buckets.values():
            for i, ids in zip(members, self._merge_rows([cuts[i] for i in members])):
                out[i] = ids
        return out

    def _merge_rows(self, cuts: list[bytes]) -> list[bytes]:
        lengths = np.array([len(cut) for cut in cuts])
        width = int(lengths.max())
        at = np.arange(width)
        padded = b"".join(cut.ljust(width, b"\0") for cut in cuts)
        ids = self._byte_id[np.frombuffer(padded, np.uint8).reshape(-1, width)]
        inside = at[None, 1:] < lengths[:, None]
        ranks = np.full(inside.shape, NO_RANK, np.int32)
        ranks[inside] = self._pairs.ranks(ids[:, :-1][inside], ids[:, 1:][inside])
        row, out = np.arange(len(cuts)), [b""] * len(cuts)
        while len(row):
            lowest = ranks.argmin(axis=1)
            every = np.arange(len(row))
            merged = ranks[every, lowest]
            done = merged == NO_RANK
            for r in np.flatnonzero(done):
                out[row[r]] = ids[r, : lengths[r]].tobytes()
            if done.any():
                ids, ranks, lengths, row = ids[~done], ranks[~done], lengths[~done], row[~done]
                lowest, merged = lowest[~done], merged[~done]
                every = np.arange(len(row))
            if not len(row):
                break
            width = int(lengths.max())
            ids, ranks = ids[:, :width], ranks[:, : width - 1]
            # close the gap behind the merged pair, one column less in each matrix
            take = np.arange(width - 1)[None, :] + (np.arange(width - 1)[None, :] > lowest[:, None])
            ids = np.take_along_axis(ids, take, axis=1)
            ids[every, lowest] = merged
            lengths = lengths - 1
            gap = np.arange(width - 2)[None, :]
            ranks = np.take_along_axis(ranks, gap + (gap >= lowest[:, None]), axis=1)
            for offset in (-1, 0):
                place = lowest + offset
                ok = np.flatnonzero((place >= 0) & (place < lengths - 1))
                ranks[ok, place[ok]] = self._pairs.ranks(
                    ids[ok, place[ok]], ids[ok, place[ok] + 1]
                )
        return out

    def _merge_long(self, cut: bytes) -> bytes:
        ids = self._byte_id[np.frombuffer(cut, np.uint8)].tolist()
        after = [*range(1, len(ids)), -1]
        before = list(range(-1, len(ids) - 1))

        def rank_of(i: int) -> int:
            j = after[i]
            pair = np.array([ids[i]]), np.array([ids[j]])
            return int(self._pairs.ranks(*pair)[0]) if j >= 0 else int(NO_RANK)

        flat = np.array(ids)
        first = self._pairs.ranks(flat[:-1], flat[1:]).tolist()
        heap = [(rank, i) for i, rank in enumerate(first) if rank != NO_RANK]
        current = dict((i, rank) for rank, i in heap)
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            if current.get(i) != rank:
                continue
            j = after[i]
            ids[i], ids[j] = rank, -1
            current.pop(j, None)
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0:
                    new = rank_of(k)
                    if new == NO_RANK:
                        current.pop(k, None)
                    else:
                        current[k] = new
                        heapq.heappush(heap, (new, k))
        return np.array([x for x in ids if x >= 0], np.int32).tobytes()

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids, and where the bytes of each row end; rows end at ``ends``."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self._length)):
            raise ValueError("an id is not in the vocabulary")
        lengths = self._length[ids]
        if (lengths < 0).any():
            raise ValueError("an id is not in the vocabulary")
        total = np.concatenate(([0], np.cumsum(lengths)))
        source = np.repeat(self._start[ids] - total[:-1], lengths) + np.arange(total[-1])
        return self._flat[source], total[ends]


_codecs: dict[int, Codec] = {}


def codec(rank_file: bytes, pattern: str) -> Codec:
    """The codec of this worker; it is built once."""
    claim("bpe_matrix", _codecs.clear)
    key = hash((rank_file, pattern))
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(rank_file, pattern)
    return _codecs[key]


def _rank_file(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(
    df: DataFrame,
    ranks: str,
    pattern: str,
    text_col: str = "text",
    keep: Sequence[str] = ("doc_id",),
    out_col: str = "ids",
) -> DataFrame:
    """The ``keep`` columns and the ids (array of int) of each text.

    ``ranks`` is the path of the rank file on the driver; its contents, a
    vocabulary of fixed size, travel with the tasks.
    """
    content = _rank_file(ranks)
    n = len(keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(content, pattern)
        for part in slices(batches, n):
            rows = own.encode([text or "" for text in part.column(n).to_pylist()])
            ends = np.cumsum([0, *(len(row) // 4 for row in rows)]).astype(np.int32)
            flat = np.frombuffer(b"".join(rows), np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:n], ids], names=[*part.schema.names[:n], out_col]
            )

    schema = T.StructType([df.schema[c] for c in keep])
    schema = schema.add(out_col, T.ArrayType(T.IntegerType()))
    return df.select(*keep, F.col(text_col).cast("string").alias("__text")).mapInArrow(run, schema)


def decode(
    df: DataFrame,
    ranks: str,
    pattern: str,
    ids_col: str = "ids",
    keep: Sequence[str] = ("doc_id",),
    out_col: str = "decoded",
) -> DataFrame:
    """The ``keep`` columns and the bytes (binary) that each list of ids stands for."""
    content = _rank_file(ranks)
    n = len(keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(content, pattern)
        for part in slices(batches, n):
            lists = part.column(n)
            lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.concatenate(([0], np.cumsum(lengths)))
            data, at = own.decode(lists.flatten().to_numpy(zero_copy_only=False), ends)
            missing = np.asarray(lists.is_null().to_numpy(zero_copy_only=False))
            valid = pa.py_buffer(np.packbits(~missing, bitorder="little"))
            out = pa.Array.from_buffers(
                pa.binary(),
                len(lists),
                [valid, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data.tobytes())],
            )
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:n], out], names=[*part.schema.names[:n], out_col]
            )

    schema = T.StructType([df.schema[c] for c in keep]).add(out_col, T.BinaryType())
    return df.select(*keep, F.col(ids_col).alias("__ids")).mapInArrow(run, schema)
