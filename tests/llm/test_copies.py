"""Near duplicates and repeated strings against brute force."""

import random
import tracemalloc
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from mailweave.llm import bagminhash, common, components, suffix_family

# ---- signatures -------------------------------------------------------------


def _bag(words):
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def _similarity(a, b):
    a, b = _bag(a), _bag(b)
    common = sum((a & b).values())
    return common / (sum(a.values()) + sum(b.values()) - common)


def test_signatures_are_unbiased():
    rng = random.Random(2)
    errors = []
    for t in range(200):
        words = [rng.choice("abcdefgh") if t % 2 else str(rng.random()) for _ in range(rng.choice([30, 100, 300]))]
        if t % 3 == 0:
            words += words[: len(words) // 2] * rng.randint(1, 6)
        other = list(words)
        for _ in range(rng.choice([1, 3, 8])):
            other[rng.randrange(len(other))] = f"zz{rng.randrange(99)}"
        if t % 5 == 0:
            other += other[: len(other) // 3]
        a, b = bagminhash.signatures(*bagminhash.bags([words, other], 5), 2)
        errors.append((a == b).mean() - _similarity(words, other))
    assert abs(np.mean(errors)) < 0.015
    assert np.std(errors) < 0.075


def test_signatures_do_not_depend_on_the_batch():
    rows = [[f"w{i}" for i in range(n)] for n in (0, 1, 4, 5, 30, 400)]
    together = bagminhash.signatures(*bagminhash.bags(rows, 5), len(rows))
    for row, signature in zip(rows, together):
        alone = bagminhash.signatures(*bagminhash.bags([row], 5), 1)[0]
        assert (alone == signature).all()
    assert not together[0].any()


# ---- classes ----------------------------------------------------------------


def _classes(rows):
    """Exact classes by all pairs: (id, text) -> least id."""
    words = [(text or "").split() for _, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if words[i] and words[j] and _similarity(words[i], words[j]) >= 0.8:
                parent[find(i)] = find(j)
    least = {}
    for i, (own, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), own), own)
    return {own: least[find(i)] for i, (own, _) in enumerate(rows)}


def _copies(rng, families, copies, changes, length=150):
    rows = []
    for f in range(families):
        base = [f"f{f}w{rng.randrange(500)}" for _ in range(length)]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randrange(changes)):
                words[rng.randrange(length)] = f"x{rng.randrange(10**6)}"
            rows.append(" ".join(words))
    return rows


def test_classes_equal_brute_force(spark):
    rng = random.Random(5)
    texts = _copies(rng, 12, 6, 6) + _copies(rng, 40, 1, 1)
    texts += [texts[0], texts[0], "a b c", "a b c", "a b d", "", " \n", None]
    rng.shuffle(texts)
    rows = list(enumerate(texts, 100))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    df = df.withColumn("key", F.lit("mine")).withColumn("label", F.lit(1))
    found = {r.id: r.class_id for r in bagminhash.near_duplicates(df).collect()}
    assert found == _classes(rows)
    kept = bagminhash.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, c in found.items() if i == c)


def test_large_family_is_one_class(spark):
    rng = random.Random(6)
    rows = list(enumerate(_copies(rng, 1, 300, 5) + _copies(rng, 30, 1, 1)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.id: r.class_id for r in bagminhash.near_duplicates(df).collect()}
    assert found == _classes(rows)


def _classes_of_many(texts):
    """Exact classes by all pairs, with one product of matrices: a window's k-th occurrence is a
    feature, and two texts have as many windows in common as features."""
    features = [{(w, k) for w, n in _bag(t.split()).items() for k in range(n)} for t in texts]
    times = Counter(f for own in features for f in own)
    place = {f: i for i, f in enumerate(f for f, n in times.items() if n > 1)}
    x = np.zeros((len(texts), len(place)), np.float32)
    for i, own in enumerate(features):
        x[i, [place[f] for f in own if f in place]] = 1
    sizes = np.array([len(own) for own in features])
    common = np.rint(x @ x.T)
    near = common >= 0.8 * (sizes[:, None] + sizes[None, :] - common) - 1e-9
    np.fill_diagonal(near, True)
    label = np.arange(len(texts))
    while True:
        least = np.where(near, label[None, :], len(texts)).min(axis=1)
        least = np.minimum(least, least[least])
        if (least == label).all():
            return dict(enumerate(label.tolist()))
        label = least


def test_classes_of_2600_copies_equal_brute_force(spark):
    """One family, many of whose members are apart from its centre and linked to each other."""
    rng = random.Random(12)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    versions = [base]
    for _ in range(40):
        words = list(rng.choice(versions))
        for _ in range(3):
            words[rng.randrange(150)] = f"v{rng.randrange(10**6)}"
        versions.append(words)
    texts = []
    for _ in range(2600):
        words = list(rng.choice(versions))
        for _ in range(rng.randrange(6)):
            words[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    exact = _classes_of_many(texts)
    assert 5 < len(set(exact.values())) < 1500
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    found = {r.id: r.class_id for r in bagminhash.near_duplicates(df).collect()}
    assert sum(found[i] != c for i, c in exact.items()) == 0


def test_large_family_whose_shared_edits_are_common_equals_brute_force(spark):
    rng = random.Random(5)
    base = [f"b{rng.randrange(10**6)}" for _ in range(150)]
    edits = [(rng.randrange(150), f"e{rng.randrange(10**6)}") for _ in range(6)]
    texts = []
    for _ in range(300):
        words = list(base)
        for place, word in rng.sample(edits, 3):
            words[place] = word
        for _ in range(2):
            words[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.id: r.class_id for r in bagminhash.near_duplicates(df).collect()}
    assert found == _classes(rows)


def test_repeated_ids_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(200))
    near = text.replace("w50 ", "zz ")
    rows = [(1, text, "a"), (1, text, "b"), (2, near, "c"), (3, "x y", "d"), (3, "x y", "e")]
    rows += [(None, None, "f"), (None, "", "g"), (None, text, "h"), (5, "q r s t u v", "i"), (5, "other words", "j")]
    df = spark.createDataFrame(rows, "doc_id long, text string, name string").repartition(4)
    kept = sorted(r.name for r in bagminhash.one_of_each(df).collect())
    assert kept in (["a", "d", "f", "g", "i", "j"], ["a", "e", "f", "g", "i", "j"], ["b", "d", "f", "g", "i", "j"], ["b", "e", "f", "g", "i", "j"])
    assert bagminhash.near_duplicates(df.limit(0)).count() == 0
    assert bagminhash.one_of_each(df.limit(0)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    links = [(f"p{i:03}", f"p{i + 1:03}") for i in range(40)] + [("s00", f"s{i:02}") for i in range(1, 30)]
    found = components.components(spark.createDataFrame(links, "a string, b string"))
    assert {r.node: r.label for r in found.collect()} == {
        **{f"p{i:03}": "p000" for i in range(41)},
        **{f"s{i:02}": "s00" for i in range(30)},
    }


# ---- repeated strings -------------------------------------------------------


def _without(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + length] for t in data for i in range(len(t) - length + 1))
    out = []
    for t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def _passages(seed):
    rng = random.Random(seed)
    some = lambda n: "".join(rng.choice("abcdé漢\x00 \n") for _ in range(n))
    shared = [some(rng.randrange(40, 200)) for _ in range(6)]
    texts = [
        "".join(some(rng.randrange(120)) + rng.choice(shared) for _ in range(rng.randrange(4)))
        for _ in range(60)
    ]
    run = "ab" * 300
    return [*texts, texts[3], texts[3], run, "z" * 500, shared[0][:70] * 3, "", None, None]


@pytest.mark.parametrize("hot", [50_000, 2])
def test_removal_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_family, "HOT", hot)
    texts = _passages(7)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    df = df.withColumn("kept", F.lit("mine")).withColumn("row", F.lit(1))
    found = suffix_family.without_repeats(df, length=80, keep=["doc_id", "kept"]).collect()
    expected = _without(texts, 80)
    assert len(found) == len(texts)
    for r in found:
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == expected[r.row.doc_id]


def test_pieces_of_long_texts_cover_all_windows(monkeypatch):
    monkeypatch.setattr(suffix_family, "PIECE", 256)
    rng = np.random.default_rng(1)
    texts = [rng.integers(97, 100, n).astype(np.uint8).tobytes() for n in (50, 100, 101, 900, 2000)]
    windows = set()
    for numbers, offsets, data, ends in suffix_family._pieces(texts, 100):
        begins = ends - np.diff(np.concatenate(([0], ends)))
        for _, _, s, e, a in zip(*suffix_family.runs(data, ends, 100)):
            which = int(np.searchsorted(ends, s, "right"))
            for p in range(s, e + 1):
                assert p <= a <= p + 100 - suffix_family.GRAM
                windows.add((numbers[which], int(p - begins[which] + offsets[which])))
    assert windows == {(i, p) for i, t in enumerate(texts) for p in range(len(t) - 99)}


def test_family_of_small_batches_equals_one_batch():
    rng = np.random.default_rng(2)
    base = [rng.integers(97, 99, 150).astype(np.uint8).tobytes() for _ in range(3)]
    contexts, before = [], []
    for _ in range(120):
        b = base[rng.integers(3)]
        left, right = rng.integers(0, 31), rng.integers(80, 100)
        contexts.append(b[50 - left : 50 + right])
        before.append(left)
    anchors, before = np.ones(120, np.uint64), np.array(before)
    results = []
    for size in (120, 7):
        family = suffix_family.Family(80)
        for i in range(0, 120, size):
            family.add(anchors[i : i + size], contexts[i : i + size], before[i : i + size])
        results.append(family.close())
    assert (results[0] == results[1]).all()
    for i, (c, b) in enumerate(zip(contexts, before)):
        for d in range(31):
            own = c[b - d : b - d + 80] if d <= b and len(c) >= b - d + 80 else None
            same = own is not None and any(
                j != i and d <= before[j] and contexts[j][before[j] - d : before[j] - d + 80] == own
                for j in range(120)
            )
            assert results[0][i, d] == same


def test_equal_rows_and_empty_table(spark):
    text = "".join(chr(97 + i % 26) + str(i) for i in range(90))
    df = spark.createDataFrame([(1, text), (1, text), (None, "x" * 50)], "doc_id long, text string")
    found = suffix_family.without_repeats(df).collect()
    assert sorted((r.row.doc_id or 0, len(r.kept)) for r in found) == [(0, 50), (1, 0), (1, 0)]
    assert suffix_family.without_repeats(df.limit(0)).count() == 0


# ---- stage tables -----------------------------------------------------------


def test_classes_take_no_stage_table_twice(spark, monkeypatch):
    """Classes that leaders leave apart are looked up once, and a text goes to those of its buckets
    in which it has an open pair."""
    labels, texts = [], []
    write = bagminhash.written

    def counted(df, label):
        table = write(df, label)
        labels.append(label)
        if label == "apart" and "text" in df.columns:
            texts.extend((r.value, r.key) for r in table.select("value", "key").collect())
        if label == "met":
            met.extend((r.value, r.key) for r in table.collect())
        return table

    met = []
    monkeypatch.setattr(bagminhash, "written", counted)
    rng = random.Random(13)
    rows = []
    for _ in range(3):
        base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
        for _ in range(80):
            words = list(base)
            for _ in range(rng.randrange(1, 9)):
                words[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.id: r.class_id for r in bagminhash.near_duplicates(df).collect()}
    assert found == _classes(rows)
    assert met and sorted(texts) == sorted(met)
    assert Counter(labels)["labelled"] == Counter(labels)["mixed"] == 1
    assert not {"company", "pointed", "candidates"} & set(labels)


def test_local_stage_tables_have_no_checksum_files(spark):
    table = common.written(spark.range(100).repartition(4), "plain")
    folder = Path(table.inputFiles()[0].removeprefix("file://")).parent
    assert [p.name for p in folder.rglob("*") if p.suffix == ".parquet"]
    assert not list(folder.rglob(".*.crc"))
    assert sorted(r.id for r in table.collect()) == list(range(100))
    common.removed(table)
    assert not folder.exists()


@pytest.mark.parametrize("signed", [False, True])
def test_tasks_take_texts_in_slices_of_little_memory(signed):
    rng = random.Random(5)
    words = [f"word{i}" for i in range(2000)]
    texts = [" ".join(rng.choices(words, k=300)) for _ in range(1500)]
    column = pa.array(texts) if signed else pa.array([text.encode() for text in texts])
    ids = pa.array(range(len(texts)))
    columns = [ids, column] if signed else [ids, ids, column]
    batch = pa.RecordBatch.from_arrays(columns, names=["id", "hash", "data"][-len(columns) :])
    assert column.nbytes > 3_000_000
    work = bagminhash._signed(5) if signed else suffix_family._find_runs(200)
    tracemalloc.start()
    try:
        assert sum(part.num_rows for part in work([batch])) >= len(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < (20_000_000 if signed else 40_000_000)


def test_pipeline_bounds_the_bytes_of_arrow_batches(spark):
    own = spark.newSession()
    corpus_pipeline.personal_data(own, own.createDataFrame([(1, "a")], "doc_id long, text string"), "")
    assert int(own.conf.get(common._BATCH)) == corpus_pipeline.BATCH_BYTES == 1 << 20
