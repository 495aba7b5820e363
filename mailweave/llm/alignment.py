"""Alignment of two tokenizers on the same texts: which tokens overlap, and where both end.

Texts are taken in blocks of whole documents, about `BLOCK_BYTES` each. A block's tokens of
either side are a table of document and place, and ``pandas.merge_asof`` by document finds for
each start of a token the other side's token that covers it. Two tokens overlap exactly if one
covers the other's start, so both directions together are all overlaps; a pair with the same
start is found by both and kept once. Places where both sides start cut the document into its
groups, since between them no end is common.

How many documents hold a pair of ids linked is a property of the whole corpus. A block is
written as one row with its documents' distinct pairs, their multiplicities, and the number of
its documents per pair, so the shuffles move one row per block and pair and not one per link.
The counts are summed over blocks, joined back to the blocks' pairs, and each block's links are
then valued with the counts of its own pairs.

Side A is a byte-level file of the ``tokenizers`` library and gets a space before the text, side
B a model of ``sentencepiece``, which adds it. Special tokens in texts are ordinary text. Where
no piece of B goes on over the start of a word, a text's pieces are those of its words, and a
worker remembers the pieces of the words it has met; else texts are encoded whole.

Defined cases: null and empty texts have no tokens, nor have texts whose joined token bytes on
either side differ from the text with its space; all their numbers are 0 and the groups are
empty. A null key is kept, repeated rows are documents of their own, an empty table gives no
rows, other columns are left alone. A text longer than a block is a block of its own.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailweave.llm.common import claim, slices, written
from mailweave.llm.pieces import CutIds, _byte_letters, file_content

#: Bytes of text of a block; one step of a task works on a block.
BLOCK_BYTES = 2 << 20

#: Words a worker remembers, the first ones met, and none over `LONGEST` characters.
REMEMBERED = 200_000
LONGEST = 64

_BLOCKS = (
    "block long, keys array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
    "n_links array<long>, groups array<string>, codes array<long>, docs array<long>, "
    "ends array<int>, gaps array<int>, times array<int>"
)
_RESULT = (
    "key long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
)


@dataclass(frozen=True)
class Sources:
    """Contents of the two tokenizer files and the pattern of side A."""

    a: str
    pattern: str
    b: bytes

    @classmethod
    def of(cls, a_path: str, pattern: str, b_path: str) -> Sources:
        with open(b_path, "rb") as file:
            return cls(file_content(a_path), pattern, file.read())


def _names(values: Sequence[int], *ends: str) -> np.ndarray:
    """Decimal ids with what follows them: one column per kind of end."""
    return np.array([[f"{v}{end}" for end in ends] for v in values], dtype=object)


class _Words(dict):
    """Spaces and a word -> the word's piece ids as bytes; None if their bytes are not the word's.

    The model adds the first space itself, but not to an empty text: a lone space at the end of
    a text gets what it gets after another word.
    """

    def __init__(self, model, pieces: list[bytes]):
        super().__init__()
        self._model, self._pieces = model, pieces

    def __missing__(self, word: str) -> bytes | None:
        ids = self._model.encode(word[1:]) or self._model.encode("a" + word)[len(self._model.encode("a")) :]
        same = b"".join(map(self._pieces.__getitem__, ids)) == word.encode()
        found = np.array(ids, "<u4").tobytes() if same else None
        if len(self) < REMEMBERED and len(word) <= LONGEST:
            self[word] = found
        return found


class Tokenizers:
    """Both sides in one worker: ids of texts, and the bytes of every id."""

    def __init__(self, sources: Sources):
        from sentencepiece import SentencePieceProcessor

        self._a = CutIds(sources.a, sources.pattern)
        b = SentencePieceProcessor(model_proto=sources.b)
        letters = {letter: byte for byte, letter in _byte_letters().items()}
        content = json.loads(sources.a)
        vocabulary = content["model"]["vocab"] | {t["content"]: t["id"] for t in content["added_tokens"]}
        a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for piece, number in vocabulary.items():
            a_bytes[number] = bytes(letters[x] for x in piece)
        if not set(letters) <= set(vocabulary):
            raise ValueError("side A must have a token for every byte")
        pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
        b_bytes = [
            bytes([int(piece[1:-1], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(pieces)
        ]
        self.a_sizes = np.array([len(x) for x in a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in b_bytes], np.int64)
        self.a_names = _names(range(len(a_bytes)), ",", "|")
        self.b_names = _names(range(len(b_bytes)), ",", ";")
        self._words = _Words(b, b_bytes).__getitem__
        # by words if pieces begin words only at their start, and texts are taken as they are
        crossing = any("▁" in piece.lstrip("▁") for piece in pieces)
        probe = "  a  \t①ﬁ  "
        kept = b"".join(b_bytes[i] for i in b.encode(probe)) == f" {probe}".encode()
        self._cut = re.compile(r"(?s).+" if crossing or not kept else r" +[^ ]*").findall

    def encode(self, text: str | None) -> tuple[bytes, bytes]:
        """Ids of both sides as unsigned 32-bit integers; none if the bytes of either are not
        those of the text. A cut's ids on side A have its bytes, so none are missing if there
        are as many as in the text."""
        if not text:
            return b"", b""
        spaced = " " + text
        b = list(map(self._words, self._cut(spaced)))
        if None in b:
            return b"", b""
        a = self._a.encode([spaced])[0]
        size = self.a_sizes[np.frombuffer(a, "<u4")].sum()
        return (a, b"".join(b)) if size == len(spaced.encode()) else (b"", b"")


_loaded: dict[int, Tokenizers] = {}


def _tokenizers(sources: Sources) -> Tokenizers:
    claim("alignment", _loaded.clear)
    key = hash(sources)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Tokenizers(sources)
    return _loaded[key]


def _side(ids: list[bytes], sizes: np.ndarray, bases: np.ndarray) -> tuple[np.ndarray, pd.DataFrame]:
    """All ids of a block, and ``place, doc, number`` of every token; places grow over the block."""
    counts = np.array([len(x) // 4 for x in ids], np.int64)
    flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
    doc = np.repeat(np.arange(len(ids)), counts)
    ends = np.cumsum(sizes[flat])
    first = np.concatenate([[0], ends])[np.cumsum(counts) - counts]
    place = ends - sizes[flat] - first[doc] + bases[doc]
    return flat, pd.DataFrame({"place": place, "doc": doc, "number": np.arange(len(flat))})


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of all overlapping tokens of ``a`` and ``b``, and the numbers of ``a`` that start
    where a token of ``b`` does."""
    covering = pd.merge_asof(a, b, on="place", by="doc", suffixes=("_a", "_b"))
    covered = pd.merge_asof(b, a, on="place", by="doc", suffixes=("_b", "_a"))
    one = covering["number_b"].to_numpy()
    two = covered["number_a"].to_numpy()
    both = b["place"].to_numpy()[one] == a["place"].to_numpy()
    again = a["place"].to_numpy()[two] == b["place"].to_numpy()
    number_a = np.concatenate([a["number"].to_numpy(), two[~again]])
    number_b = np.concatenate([one, b["number"].to_numpy()[~again]])
    return number_a, number_b, np.flatnonzero(both)


def _group_texts(known: Tokenizers, a_ids, a, b_ids, b, starts, n_docs: int) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of every document."""
    a_doc, b_doc = a["doc"].to_numpy(), b["doc"].to_numpy()
    # groups are numbered over the block; b has the same starts, in the same order
    group_a = np.zeros(len(a_ids), np.int64)
    group_a[starts] = 1
    group_a = np.cumsum(group_a) - 1
    b_starts = np.flatnonzero(np.isin(b["place"].to_numpy(), a["place"].to_numpy()[starts], assume_unique=True))
    group_b = np.zeros(len(b_ids), np.int64)
    group_b[b_starts] = 1
    group_b = np.cumsum(group_b) - 1
    last_a = np.append(group_a[1:] != group_a[:-1], True).astype(int)
    last_b = np.append(group_b[1:] != group_b[:-1], True).astype(int)
    before_b = np.append(b_starts, len(b_ids))[group_a]
    after_a = np.append(starts, len(a_ids))[group_b + 1]
    merged = np.empty(len(a_ids) + len(b_ids), object)
    merged[np.arange(len(a_ids)) + before_b] = known.a_names[a_ids, last_a]
    merged[np.arange(len(b_ids)) + after_a] = known.b_names[b_ids, last_b]
    ends = np.cumsum(np.bincount(a_doc, minlength=n_docs) + np.bincount(b_doc, minlength=n_docs))
    out, start = [], 0
    for end in ends.tolist():
        out.append("".join(merged[start:end].tolist())[:-1])
        start = end
    return out


def _block(known: Tokenizers, keys: list, texts: list, number: int, digest: bool) -> dict:
    """One block as a row of `_BLOCKS`."""
    n = len(keys)
    both = [known.encode(text) for text in texts]
    sizes = np.array([len(t.encode()) + 1 if t else 0 for t in texts], np.int64)
    bases = np.cumsum(sizes) - sizes
    a_ids, a = _side([x for x, _ in both], known.a_sizes, bases)
    b_ids, b = _side([x for _, x in both], known.b_sizes, bases)
    if len(a_ids):
        left, right, starts = overlaps(a, b)
        texts = _group_texts(known, a_ids, a, b_ids, b, starts, n)
    else:
        left, right, starts, texts = (np.zeros(0, np.int64),) * 3 + ([""] * n,)
    if digest:
        texts = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in texts]
    doc = a["doc"].to_numpy()[left]
    width = len(known.b_sizes)
    codes, where = np.unique(a_ids[left] * width + b_ids[right], return_inverse=True)
    linked, times = np.unique(doc * max(1, len(codes)) + where, return_counts=True)
    linked_doc, linked_code = linked // max(1, len(codes)), linked % max(1, len(codes))
    # sorted within a document, so the gaps are small numbers
    gaps = np.diff(linked_code, prepend=0)
    gaps[np.flatnonzero(np.diff(linked_doc, prepend=-1))] = linked_code[np.flatnonzero(np.diff(linked_doc, prepend=-1))]
    count = lambda docs: np.bincount(docs, minlength=n).astype(np.int64)
    return {
        "block": number,
        "keys": keys,
        "n_a": count(a["doc"].to_numpy()),
        "n_b": count(b["doc"].to_numpy()),
        "n_groups": count(a["doc"].to_numpy()[starts]),
        "n_links": count(doc),
        "groups": texts,
        "codes": codes,
        "docs": np.bincount(linked_code, minlength=len(codes)).astype(np.int64),
        "ends": np.cumsum(count(linked_doc)).astype(np.int32),
        "gaps": gaps.astype(np.int32),
        "times": times.astype(np.int32),
    }


_ARROW = pa.schema(
    [
        ("block", pa.int64()),
        *((name, pa.list_(pa.int64())) for name in ("keys", "n_a", "n_b", "n_groups", "n_links")),
        ("groups", pa.list_(pa.string())),
        *((name, pa.list_(pa.int64())) for name in ("codes", "docs")),
        *((name, pa.list_(pa.int32())) for name in ("ends", "gaps", "times")),
    ]
)


def _blocks(sources: Sources, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for part in slices(batches, 1, BLOCK_BYTES):
            known = _tokenizers(sources)
            row = _block(known, part.column(0).to_pylist(), part.column(1).to_pylist(), number, digest)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[field.name]], field.type) for field in _ARROW], schema=_ARROW
            )
            number += 1

    return run


def _valued(links: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of one block with the corpus-wide counts of their links."""
    order = np.argsort(counts.column("code").to_numpy())
    count = counts.column("count").to_numpy()[order]
    best = counts.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
    field = lambda name: links.column(name).combine_chunks()[0].values.to_numpy()
    keys = links.column("keys").combine_chunks()[0].values
    ends, gaps, times = field("ends"), field("gaps"), field("times").astype(np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    doc = np.repeat(np.arange(len(ends)), ends - starts)
    # gaps start anew in every document
    total = np.cumsum(gaps, dtype=np.int64)
    before = np.concatenate([[0], total])[starts]
    code = total - before[doc]

    def summed(values: np.ndarray) -> np.ndarray:
        running = np.concatenate([[0], np.cumsum(values * times)])
        return running[ends] - running[starts]

    return pa.table(
        {
            "key": keys,
            **{name: field(name) for name in ("n_a", "n_b", "n_groups", "n_links")},
            "n_best": summed(best[code]),
            "count_sum": summed(count[code]),
            "groups": links.column("groups").combine_chunks()[0].values,
        }
    )


def align(documents: DataFrame, sources: Sources, key: str = "doc_id", digest: bool = False) -> DataFrame:
    """``key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups`` of every row.

    ``groups`` is ``a1,a2|b1;a3|b2,b3`` in ids; with ``digest`` its SHA-256, which saves keeping
    a text of the size of the corpus.
    """
    texts = documents.select(F.col(key).cast("long").alias("key"), F.col("text"))
    blocks = written(texts.mapInArrow(_blocks(sources, digest), _BLOCKS), "blocks")
    width = _width(sources)
    pairs = blocks.select("block", F.inline(F.arrays_zip("codes", "docs"))).toDF("block", "code", "docs")
    totals = written(pairs.groupBy("code").agg(F.sum("docs").alias("count")), "pair-counts")
    first = F.col("code").cast("long") - F.pmod(F.col("code"), F.lit(width))
    # one row for each id of A's vocabulary at most
    highest = totals.groupBy(first.alias("first")).agg(F.max("count").alias("highest"))
    totals = written(
        totals.withColumn("first", first)
        .join(F.broadcast(highest), "first")
        .select("code", "count", (F.col("count") == F.col("highest")).alias("best")),
        "pair-counts",
    )
    counts = pairs.select("block", "code").join(totals, "code")
    links = blocks.drop("codes", "docs")
    return links.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(_valued, _RESULT)


def _width(sources: Sources) -> int:
    """Ids of side B: a pair of ids is one number, ``a * width + b``."""
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_proto=sources.b).get_piece_size()
