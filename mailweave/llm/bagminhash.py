"""Near duplicates by BagMinHash: signatures of weighted sets, bands, verified overlap.

A text is the multiset of its windows of five words (all its words, if it has fewer). Its
similarity to another is the sum of the smaller counts over the sum of the larger ones.

Signatures. Every window has, for each dyadic interval of weight (0, 1], (1, 2], (2, 4], ...,
a Poisson process whose points are drawn in rising order from a hash of the window. A point
falls on one of the signature's slots and counts only up to the window's weight; each slot
keeps its first point. Two texts agree in a slot with a probability equal to their
similarity. A process ends once it is past the last slot of its text, so most windows cost
one or two points.

Candidates. Texts of equal words are one node from here on. Nodes meet in the buckets of 16
bands of 4 slots, and every node is paired with one leader of its bucket: in a large bucket the
node that has most company over all its bands and then the fewest windows, which in a family of
copies is the text they were made from or close to it. So pairs grow with the nodes and not with
their square. Copies that resemble each other more than the leader also meet in the slots in
which they differ from the leader but not from each other, since what links them without linking
either to the leader is what both have changed. What the leaders leave apart is compared in full:
of every bucket of three or more, the nodes outside its largest class with all its nodes of other
classes, by signatures and then by texts, in pairs of blocks. So every pair of a bucket is either
compared or already of one class, and the pairs grow with the nodes that are left apart and not
with the bucket's square.

Candidates whose signatures agree too little for the threshold are dropped (`SLACK` standard
deviations), the others are verified on the whole texts. Classes are the connected
components of verified links.

Defined cases: a null text, or one without a word, is a class of its own; other texts of
equal words are one class; of equal ids in a class the least is its class id; an empty
table gives an empty table. Only the id and text columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailweave.llm.common import by_slices, claim, release, removed, slices, written
from mailweave.llm.components import components

SLOTS, ROWS = 64, 4
BANDS = SLOTS // ROWS
#: Nodes of a bucket from which on the leader is chosen by its company, and differences are shared.
LARGE = 41
#: Nodes, and bytes of text, of a block of a large bucket whose classes are compared.
BLOCK, BLOCK_BYTES = 512, 1 << 19
#: Standard deviations below the threshold at which the slots' estimate drops a pair: of pairs at
#: the threshold one in 50 million.
SLACK = 6.0
REMEMBERED = 150_000
#: Bytes of text whose points are drawn at once; drawing takes about 60 times as many.
SIGNED_BYTES = 1 << 18
#: Bits of a key in the bitmap that spares most texts which are not needed the shuffle.
BITMAP = 24

_words = re.compile(r"[^ \t-\r]+").findall
_STEP = np.uint64(0x9E3779B97F4A7C15)
_hash_of: dict[str, int] = {}


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(words: list[str]) -> np.ndarray:
    claim("bagminhash", _hash_of.clear)
    unknown = set(words).difference(_hash_of)
    if unknown:
        if len(_hash_of) + len(unknown) > REMEMBERED:
            _hash_of.clear()
            unknown = set(words)
        _hash_of.update((w, xxhash.xxh3_64_intdigest(w)) for w in unknown)
    return np.fromiter(map(_hash_of.__getitem__, words), np.uint64, len(words))


def bags(rows: list[list[str]], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, window hash, count) of all texts' distinct windows, by text and hash."""
    counts = np.array([len(row) for row in rows], np.int64)
    hashes = _hashes([w for row in rows for w in row])
    owner = np.repeat(np.arange(len(rows)), counts)
    place = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
    left = counts[owner] - place
    sums = np.zeros(len(hashes), np.uint64)
    for step in range(window):
        inside = np.flatnonzero(left > step)
        sums[inside] = (sums[inside] + hashes[inside + step]) * _STEP
        sums[inside] ^= sums[inside] >> np.uint64(29)
    whole = (left >= window) | (place == 0)
    owner, sums = owner[whole], sums[whole]
    order = np.lexsort((sums, owner))
    owner, sums = owner[order], sums[order]
    new = np.ones(len(sums), bool)
    new[1:] = (sums[1:] != sums[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    return owner[first], sums[first], np.diff(np.append(first, len(sums)))


def signatures(owner: np.ndarray, hashes: np.ndarray, counts: np.ndarray, texts: int) -> np.ndarray:
    """A row of `SLOTS` 32-bit point ids for each text with a window, zeros for others."""
    top = np.ceil(np.log2(counts)).astype(np.int64)  # levels beyond the first
    element = np.repeat(np.arange(len(hashes)), top + 1)
    level = np.arange(len(element)) - np.repeat(np.cumsum(top + 1) - (top + 1), top + 1)
    low = np.where(level > 0, 2.0 ** (level - 1), 0.0)
    rate = np.where(level > 0, low, 1.0)
    seed = _mixed(hashes[element] + _STEP * (level + 1).astype(np.uint64))
    text, weight = owner[element], counts[element]
    best = np.full(texts * SLOTS, np.iinfo(np.uint64).max, np.uint64)
    at = np.zeros(len(element))
    while len(seed):
        seed = _mixed(seed + _STEP)
        draw = ((seed >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        at = at - np.log(draw) / rate
        other = _mixed(seed ^ np.uint64(0x5851F42D4C957F2D))
        slot = (other & np.uint64(SLOTS - 1)).astype(np.int64)
        height = (other >> np.uint64(32)).astype(np.float64) * 2.0**-32
        counts_here = np.ceil(low + rate * (1 - height)) <= weight
        packed = at.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)
        packed |= _mixed(other) & np.uint64(0xFFFFFFFF)
        np.minimum.at(best, (text * SLOTS + slot)[counts_here], packed[counts_here])
        last = (best.reshape(texts, SLOTS).max(axis=1) >> np.uint64(32)).astype(np.uint32)
        on = at.astype(np.float32).view(np.uint32) <= last[text]
        seed, at, text = seed[on], at[on], text[on]
        low, rate, weight = low[on], rate[on], weight[on]
    ids = (best & np.uint64(0xFFFFFFFF)).astype(np.uint32).reshape(texts, SLOTS)
    used = np.zeros(texts, bool)
    used[owner] = True
    return np.where(used[:, None], ids, np.uint32(0))


def _key(words: list[str]) -> str | None:
    """The same for texts of equal words."""
    return xxhash.xxh3_128_hexdigest(" ".join(words)) if words else None


def _signed(window: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1, SIGNED_BYTES):
            rows = [_words(text or "") for text in part.column(1).to_pylist()]
            owner, hashes, counts = bags(rows, window)
            windows = np.bincount(owner, counts, minlength=len(rows)).astype(np.int64)
            found = signatures(owner, hashes, counts, len(rows))
            signed = [sig.tobytes() if row else None for row, sig in zip(rows, found)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(map(_key, rows), pa.string()),
                    pa.array(signed, pa.binary()),
                    pa.array(windows),
                ],
                names=["id", "key", "signature", "windows"],
            )
        release()

    return run


def _key_bits(needed: DataFrame) -> bytes:
    """A bitmap of the first `BITMAP` bits of all keys; 2 MB on the driver, whatever the input."""
    place = F.conv(F.substring("key", 1, BITMAP // 4), 16, 10).cast("long") + 1
    parts = needed.groupBy(F.call_function("bitmap_bucket_number", place).alias("bucket")).agg(
        F.call_function("bitmap_construct_agg", F.call_function("bitmap_bit_position", place)).alias("bits")
    )
    size = (1 << 15) // 8
    bits = bytearray((1 << BITMAP) // 8)
    for part in parts.collect():
        first = (part.bucket - 1) * size
        bits[first : first + len(part.bits)] = part.bits
    return bytes(bits)


def _keyed_texts(bits: bytes):
    """(key, text) of texts whose key may be needed, each key once per task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for part in slices(batches, 0):
            keys, texts = [], []
            for text in part.column(0).to_pylist():
                key = _key(_words(text or ""))
                if key is None or key in seen:
                    continue
                place = int(key[: BITMAP // 4], 16)
                if bits[place >> 3] >> (place & 7) & 1:
                    seen.add(key)
                    keys.append(key)
                    texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(texts, pa.string())], names=["key", "text"]
            )

    return run


# ---- candidates -------------------------------------------------------------


def _sized(members: DataFrame) -> DataFrame:
    """Members of buckets of two nodes or more, with the bucket's size n and a leader by hash."""
    sizes = members.groupBy("value").agg(
        F.count("*").alias("n"), F.min_by("key", F.xxhash64("key")).alias("leader")
    )
    return written(members.join(written(sizes.where("n > 1"), "buckets"), "value"), "members")


def _led(members: DataFrame) -> DataFrame:
    """(a, b) of every node with its buckets' leaders, the smaller key first."""
    led = members.where("leader <> key")
    return led.select(F.least("leader", "key").alias("a"), F.greatest("leader", "key").alias("b"))


def _by_company(members: DataFrame) -> DataFrame:
    """``members`` in which the nodes with most company lead the large buckets."""
    # a node has a row for each of its bands at most
    company = F.sum("n").over(Window.partitionBy("key")).alias("company")
    large = members.select("*", company).where(F.col("n") >= LARGE)
    large = written(large.drop("leader"), "large")
    first = F.min(F.struct((-F.col("company")).alias("company"), "windows", "key"))
    leaders = large.groupBy("value").agg(first.alias("first")).select("value", F.col("first.key").alias("leader"))
    led = large.drop("company").join(written(leaders, "leaders"), "value")
    return written(members.where(F.col("n") < LARGE).unionByName(led), "members")


def _differences(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(value, key): a row for each slot in which a node differs from its leader."""
    for part in batches:
        if part.num_rows:
            lead, own = (
                np.frombuffer(b"".join(part.column(i).to_pylist()), np.uint32).reshape(-1, SLOTS)
                for i in (2, 3)
            )
            row, slot = np.nonzero(lead != own)
            names = np.array([xxhash.xxh3_64_intdigest(x) for x in part.column(0).to_pylist()], np.uint64)
            value = _mixed(names[row] + _STEP * slot.astype(np.uint64)) ^ own[row, slot].astype(np.uint64)
            keys = part.column(1).take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(_mixed(value).view(np.int64)), keys], names=["value", "key"]
            )


def candidates(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs (a < b) of keys that meet in a bucket, from nodes (key, signature, windows),
    and the members (value, key, windows, band, n, leader) of the buckets, which are paired with the
    leader alone."""
    bands = F.array(
        *(F.xxhash64(F.lit(i), F.substring("signature", 1 + 4 * ROWS * i, 4 * ROWS)) for i in range(BANDS))
    )
    members = _sized(nodes.select("key", "windows", F.posexplode(bands).alias("band", "value")))
    members = _by_company(members)
    pairs = _led(members)
    pointed = members.where((F.col("n") >= LARGE) & (F.col("leader") != F.col("key")))
    pointed = pointed.select(F.col("leader").alias("a"), F.col("key").alias("b")).distinct()
    unlike = _with_both(pointed, nodes, "signature")
    unlike = unlike.mapInArrow(_differences, "value long, key string")
    sharing = _sized(written(unlike.distinct(), "differences"))
    return pairs.union(_led(sharing)).distinct(), members


def _of_like_size(one: str, other: str, threshold: float) -> Column:
    """Whether two numbers of windows allow the threshold: the smaller bag is at most in the larger."""
    return F.least(one, other) >= threshold * F.greatest(one, other) - 1e-9


def _alike(least: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if part.num_rows:
                a, b = (
                    np.frombuffer(b"".join(part.column(i).to_pylist()), np.uint32).reshape(-1, SLOTS)
                    for i in (2, 3)
                )
                yield part.select([0, 1]).filter(pa.array((a == b).mean(axis=1) >= least))

    return run


def _bags_of(texts: Iterable[str], window: int) -> list[tuple[np.ndarray, np.ndarray]]:
    rows = [_words(text) for text in texts]
    owner, hashes, counts = bags(rows, window)
    edges = np.searchsorted(owner, np.arange(len(rows) + 1))
    return [(hashes[i:j], counts[i:j]) for i, j in zip(edges, edges[1:])]


def _near(one: tuple, other: tuple, threshold: float) -> bool:
    (h, m), (g, n) = one, other
    _, x, y = np.intersect1d(h, g, assume_unique=True, return_indices=True)
    common = int(np.minimum(m[x], n[y]).sum())
    return common >= threshold * (int(m.sum()) + int(n.sum()) - common)


def _verified(window: int, threshold: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 3, SIGNED_BYTES):
            texts = part.column(2).to_pylist() + part.column(3).to_pylist()
            place = {text: i for i, text in enumerate(dict.fromkeys(texts))}
            bag = _bags_of(place, window)
            half, good = part.num_rows, []
            for k in range(half):
                good.append(_near(bag[place[texts[k]]], bag[place[texts[half + k]]], threshold))
            yield part.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return run


def _with_both(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """Pairs with columns of both nodes; the leader side, which may be hot, comes first."""
    a = table.select(F.col("key").alias("a"), *(F.col(c).alias(f"{c}_a") for c in columns))
    b = table.select(F.col("key").alias("b"), *(F.col(c).alias(f"{c}_b") for c in columns))
    sides = [f"{c}_{side}" for c in columns for side in "ab"]
    return pairs.join(a, "a").join(b, "b").select("a", "b", *sides)


# ---- what leaders leave apart -----------------------------------------------


def _mixed_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(value, band, key, leads, label, outside) of the buckets of three or more with nodes of
    several classes; outside is false for those of the bucket's largest class."""
    large = members.where("n > 2").select("value", "band", "key", (F.col("key") == F.col("leader")).alias("leads"))
    large = written(large.join(labels, "key"), "labelled")
    classes = large.groupBy("value", "label").agg(F.count("*").alias("n"))
    mixed = classes.groupBy("value").agg(
        F.max_by("label", F.struct("n", "label")).alias("main"), F.count("*").alias("classes")
    )
    mixed = written(mixed.where("classes > 1").select("value", "main"), "mixed")
    return large.join(mixed, "value").withColumn("outside", F.col("label") != F.col("main")).drop("main")


def _block_pairs(members: DataFrame, size, limit: int) -> DataFrame:
    """(value, band, first, second): every block of a bucket's outside nodes with every block of all
    its nodes, of members that are a table. Blocks hold about ``limit`` of ``size``; each pair of
    blocks is placed by itself."""
    count = lambda of: F.greatest(F.lit(1), F.ceil(of / limit)).cast("int")
    sizes = members.groupBy("value").agg(
        count(F.sum(F.when(F.col("outside"), size))).alias("firsts"), count(F.sum(size)).alias("seconds")
    )
    sized = written(members.join(written(sizes, "sizes"), "value"), "blocked")
    rows = F.collect_list(F.struct(*(c for c in members.columns if c not in ("value", "band"))))
    place = lambda of: F.pmod(F.xxhash64("key", F.lit(2)), F.col(of)).cast("int")
    firsts = sized.where("outside").groupBy("value", "band", "seconds", place("firsts").alias("i")).agg(rows.alias("first"))
    firsts = firsts.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("seconds") - 1)))
    seconds = sized.groupBy("value", place("seconds").alias("j")).agg(rows.alias("second"))
    firsts = written(firsts.select("value", "j", "band", "first"), "firsts")
    pairs = firsts.join(written(seconds, "seconds"), ["value", "j"])
    return pairs.select("value", "band", "first", "second")


def _open_pairs(band: int, first: dict, second: dict, threshold: float, least: float) -> list[tuple[int, int]]:
    """Places of nodes of different classes that are alike enough, most alike first; pairs that
    meet in an earlier band too or with the bucket's leader, which have been compared, and the
    second of a pair's two orders, are left out."""
    a, b = (np.frombuffer(b"".join(x["signature"]), np.uint32).reshape(-1, SLOTS) for x in (first, second))
    agree = np.zeros((len(a), len(b)), np.uint8)
    earlier = np.zeros((len(a), len(b)), bool)
    here = earlier
    for i in range(BANDS):
        same = [a[:, None, k] == b[None, :, k] for k in range(ROWS * i, ROWS * (i + 1))]
        for x in same:
            agree += x
        if i < band:
            earlier |= np.logical_and.reduce(same)
        elif i == band:
            here = np.logical_and.reduce(same)
    labels, others = np.array(first["label"], object), np.array(second["label"], object)
    keys, names = np.array(first["key"], object), np.array(second["key"], object)
    found = here & ~earlier & (agree >= least * SLOTS)
    sizes, others_sizes = (np.array(x["windows"], np.float64) for x in (first, second))
    found &= np.minimum.outer(sizes, others_sizes) >= threshold * np.maximum.outer(sizes, others_sizes) - 1e-9
    found &= ~np.logical_or.outer(np.array(first["leads"], bool), np.array(second["leads"], bool))
    i, j = np.nonzero(found)
    once = ~np.array(second["outside"], bool)[j] | (keys[i] < names[j]).astype(bool)
    kept = once & (labels[i] != others[j]).astype(bool)
    i, j = i[kept], j[kept]
    order = np.argsort(-agree[i, j].astype(np.int64), kind="stable")
    return list(zip(i[order].tolist(), j[order].tolist()))


def _block_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, int, dict, dict]]:
    for part in batches:
        for k in range(part.num_rows):
            first, second = (
                dict(zip((f.name for f in column.type.value_type), (x.to_pylist() for x in column[k].values.flatten())))
                for column in (part.column(2), part.column(3))
            )
            yield part.column(0)[k].as_py(), part.column(1)[k].as_py(), first, second


def _open_keys(threshold: float, least: float):
    """(value, key) of nodes that have an open pair in their blocks of a bucket."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for value, band, first, second in _block_rows(batches):
            pairs = _open_pairs(band, first, second, threshold, least)
            keys = {first["key"][i] for i, _ in pairs} | {second["key"][j] for _, j in pairs}
            yield pa.RecordBatch.from_arrays(
                [pa.array([value] * len(keys), pa.int64()), pa.array(sorted(keys), pa.string())], names=["value", "key"]
            )

    return run


def _open_links(window: int, threshold: float, least: float):
    """Pairs (a, b) of classes that a pair of their nodes links, as many as join them all."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, band, first, second in _block_rows(batches):
            pairs = _open_pairs(band, first, second, threshold, least)
            places = ({i for i, _ in pairs}, {j for _, j in pairs})
            texts = dict.fromkeys(x["text"][i] for x, at in zip((first, second), places) for i in at)
            bag = dict(zip(texts, _bags_of(texts, window)))
            above: dict[str, str] = {}
            links = []
            for i, j in pairs:
                ends = []
                for label in (first["label"][i], second["label"][j]):
                    while label in above:
                        label = above[label]
                    ends.append(label)
                if ends[0] != ends[1] and _near(bag[first["text"][i]], bag[second["text"][j]], threshold):
                    above[ends[0]] = ends[1]
                    links.append((first["label"][i], second["label"][j]))
            a, b = zip(*links) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], names=["a", "b"])

    return run


def _rejoined(
    rows: DataFrame, nodes: DataFrame, members: DataFrame, labels: DataFrame, window: int, threshold: float, least: float
) -> DataFrame:
    """``labels`` (key, label) with those classes as one that a pair of a bucket links."""
    kept = ["value", "band", "key", "leads", "label", "outside", "signature", "windows"]
    apart = _mixed_members(members, labels)
    apart = written(apart.join(nodes.select("key", "signature", "windows"), "key").select(*kept), "apart")
    blocks = _block_pairs(apart, F.lit(1), BLOCK)
    met = written(blocks.mapInArrow(_open_keys(threshold, least), "value long, key string").distinct(), "met")
    if not met.limit(1).count():
        return labels
    # a text goes to the buckets alone in which it has an open pair
    texts = _texts(rows, met.select("key").distinct())
    apart = apart.join(met, ["value", "key"], "left_semi").join(texts, "key").select(*kept, "text")
    blocks = _block_pairs(written(apart, "apart"), F.length("text"), BLOCK_BYTES)
    links = written(blocks.mapInArrow(_open_links(window, threshold, least), "a string, b string"), "rejoining")
    joined = components(links).select(F.col("node").alias("label"), F.col("label").alias("joined"))
    labels = labels.join(joined, "label", "left")
    return written(labels.select("key", F.coalesce("joined", "label").alias("label")), "labels")


def _texts(rows: DataFrame, needed: DataFrame) -> DataFrame:
    """(key, text) of the needed keys."""
    # texts that pass the bitmap by chance are dropped by the join
    texts = rows.select("text").mapInArrow(_keyed_texts(_key_bits(needed)), "key string, text string")
    texts = texts.join(needed, "key", "left_semi").groupBy("key").agg(F.any_value("text").alias("text"))
    return written(texts, "texts")


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 5,
    threshold: float = 0.8,
) -> DataFrame:
    """(id, class_id, key, label): one row per input row; class_id is the least id of its class,
    key the same for texts of equal words, label the same within a class (both null for texts
    without a word)."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    signed_schema = T.StructType([T.StructField("id", df.schema[id_col].dataType)])
    signed_schema = signed_schema.add("key", "string").add("signature", "binary").add("windows", "long")
    signed = written(rows.mapInArrow(_signed(window), signed_schema), "signed")
    nodes = written(
        signed.where("key IS NOT NULL")
        .groupBy("key")
        .agg(
            F.min("id").alias("id"),
            F.any_value("signature").alias("signature"),
            F.any_value("windows").alias("windows"),
        ),
        "nodes",
    )
    pairs, members = candidates(nodes)
    least = threshold - SLACK * (threshold * (1 - threshold) / SLOTS) ** 0.5
    alike = _with_both(pairs, nodes, "signature", "windows").where(_of_like_size("windows_a", "windows_b", threshold))
    alike = written(alike.select("a", "b", "signature_a", "signature_b").mapInArrow(_alike(least), "a string, b string"), "alike")
    needed = written(
        alike.select(F.col("a").alias("key")).union(alike.select("b")).distinct(), "needed"
    )
    texts = _texts(rows, needed)
    both = _with_both(alike, texts, "text")
    links = written(both.mapInArrow(_verified(window, threshold), "a string, b string"), "verified")
    labels = nodes.select("key").join(components(links).withColumnRenamed("node", "key"), "key", "left")
    labels = written(labels.select("key", F.coalesce("label", "key").alias("label")), "labels")
    removed(alike, needed, texts, links)
    labels = _rejoined(rows, nodes, members, labels, window, threshold, least)
    named = written(nodes.select("key", "id").join(labels, "key"), "named")
    classes = named.groupBy("label").agg(F.min("id").alias("class_id"))
    classes = written(named.join(written(classes, "classes"), "label").select("key", "label", "class_id"), "keys")
    removed(nodes, members)
    return signed.select("id", "key").join(classes, "key", "left").select(
        "id", F.coalesce("class_id", "id").alias("class_id"), "key", "label"
    )


def _word_key():
    """The function from texts to keys; only the texts go to Python."""

    def work(part: pa.RecordBatch) -> pa.Array:
        return pa.array([_key(_words(text or "")) for text in part.column(0).to_pylist()], pa.string())

    run = by_slices(work, pa.string())

    @F.arrow_udf("string")
    def keys(texts: pa.Array) -> pa.Array:
        return run(texts)

    return keys.asNondeterministic()


def one_of_each(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 5,
    threshold: float = 0.8,
) -> DataFrame:
    """The rows of ``df`` without near duplicates: of each class the row of least id (then of
    least key) stays, and one of several with that id and those words. Rows without a word
    all stay. All columns stay."""
    found = near_duplicates(df, id_col, text_col, window, threshold).where("key IS NOT NULL")
    rows = found.groupBy("label", "id", "key").agg(F.count("*").alias("times"))
    order = F.struct(F.col("id").isNull().alias("unknown"), "id", "key", "times")
    first = rows.groupBy("label").agg(F.min(order).alias("first"))
    first = written(
        first.select(*(F.col(f"first.{c}").alias(f"first_{c}") for c in ("id", "key", "times"))), "first"
    )
    keyed = df.select(
        F.struct(*df.columns).alias("row"),
        F.col(id_col).alias("id"),
        _word_key()(F.col(text_col).cast("string")).alias("key"),
    )
    same = (F.col("key") == F.col("first_key")) & F.col("id").eqNullSafe(F.col("first_id"))
    chosen = keyed.join(first, same, "left")
    chosen = chosen.where("key IS NULL OR first_key IS NOT NULL")
    if not first.where("first_times > 1").limit(1).count():
        return chosen.select("row.*")
    # rows of the same id and words
    chosen = written(chosen, "chosen")
    once = chosen.where("first_times IS NULL OR first_times = 1").select("row")
    often = chosen.where("first_times > 1").groupBy("id", "key").agg(F.first("row").alias("row"))
    return once.union(often.select("row")).select("row.*")
