"""The alignment of two tokenizers against a brute-force version over the libraries."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

import public_tokenizers
from mailweave.llm import alignment
from mailweave.llm.common import ship
from mailweave.llm.queries import op13_merge_asof

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NONE = (0, 0, 0, 0, 0, 0, "")


@pytest.fixture(scope="module")
def sources():
    return alignment.Sources.of(A, public_tokenizers.PATTERN, B)


def _tokens(texts):
    """(ids and byte ranges) of both sides, from the libraries alone."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in own} | {
        chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in own)
    }
    for text in texts:
        if not text:
            yield [], []
            continue
        left = [(i, bytes(letters[x] for x in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        if b"".join(x for _, x in left) != whole or b"".join(x for _, x in right) != whole:
            yield [], []
            continue
        ranges = []
        for side in (left, right):
            at, out = 0, []
            for number, piece in side:
                out.append((number, at, at + len(piece)))
                at += len(piece)
            ranges.append(out)
        yield tuple(ranges)


def brute(texts):
    docs, held, every = list(_tokens(texts)), Counter(), []
    for a, b in docs:
        links, j = [], 0
        for i, s, e in a:
            while j and b[j - 1][2] > s:
                j -= 1
            while j < len(b) and b[j][2] <= s:
                j += 1
            k = j
            while k < len(b) and b[k][1] < e:
                links.append((i, b[k][0]))
                k += 1
        every.append(links)
        held.update(set(links))
    highest = defaultdict(int)
    for (i, _), n in held.items():
        highest[i] = max(highest[i], n)
    rows = []
    for (a, b), links in zip(docs, every, strict=True):
        ends = sorted({x[2] for x in a} & {x[2] for x in b})
        groups, start = [], 0
        for end in ends:
            part = [",".join(str(i) for i, s, _ in side if start <= s < end) for side in (a, b)]
            groups.append("|".join(part))
            start = end
        rows.append((
            len(a), len(b), len(groups), len(links), sum(held[x] == highest[x[0]] for x in links),
            sum(held[x] for x in links), ";".join(groups),
        ))
    return rows


def _found(df):
    return [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in df.orderBy("key").collect()]


TEXTS = [
    None, "", " ", "a", "the the the", "The Thing, it's 12345 here.\n\n\tindented  twice   thrice ",
    "naïve façade 中文字 \U0001f600\U0001f468‍\U0001f469 é", "▁ marks a space", "a<|endoftext|>b <s> </s> <0x41> <unk>",
    "x" * 3000, " 　 wide", "\x00\x01", "the the the", "internationalization counterrevolutionaries",
]


def test_rows_equal_brute_force(spark, sources):
    ship(spark)
    rows = [(i, text, "x") for i, text in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, groups string").repartition(3)
    found = _found(alignment.align(docs, sources))
    assert found == brute(TEXTS)
    assert found[0] == found[1] == found[TEXTS.index("▁ marks a space")] == NONE
    assert found[4] == found[12]


def test_blocks_of_any_size_agree(spark, sf_dir, sources):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40)
    keys = [(r.doc_id, r.text) for r in docs.collect()]
    known = alignment.Tokenizers(sources)
    whole = alignment._block(known, [k for k, _ in keys], [t for _, t in keys], 0, False)
    alone = [alignment._block(known, [k], [t], 0, False) for k, t in keys]
    for name in ("n_a", "n_b", "n_groups", "n_links", "groups"):
        assert list(whole[name]) == [one[name][0] for one in alone]
    assert list(whole["docs"]) == [sum(c in one["codes"] for one in alone) for c in whole["codes"]]


def test_words_have_the_pieces_of_the_text(sources):
    """Pieces by words are those of the library on the whole text."""
    known, model = alignment.Tokenizers(sources), sentencepiece.SentencePieceProcessor(model_file=B)
    rng = random.Random(3)
    signs = ["the", "Thing", " ", "  ", "\n", "\t", "é", "中文", "\U0001f600", "ab", "</s>", "...", "\u00a0", "1234", "x" * 70]
    for _ in range(400):
        text = "".join(rng.choices(signs, k=rng.randrange(1, 40)))
        assert np.frombuffer(known.encode(text)[1], "<u4").tolist() == model.encode(text)
    assert known._cut(" a  b") == [" a", "  b"]


def test_one_long_text(sources):
    """A text of several blocks' size is one block."""
    text = "the quick brown föx, 99 times over\n" * 150_000
    known = alignment.Tokenizers(sources)
    row = alignment._block(known, [1], [text], 0, True)
    a, b = known.encode(text)
    assert (row["n_a"][0], row["n_b"][0]) == (len(a) // 4, len(b) // 4)
    assert row["times"].sum() == row["n_links"][0] >= max(len(a), len(b)) // 4


def test_query_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    ship(spark)
    found = op13_merge_asof(spark, sf_dir).orderBy("doc_id").collect()
    expected = brute([r.text for r in rows])
    assert [r.doc_id for r in found] == [r.doc_id for r in rows]
    for r, (*numbers, groups) in zip(found, expected, strict=True):
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        assert [r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256] == [*numbers, digest]


def test_null_keys_and_empty_tables(spark, sources):
    ship(spark)
    schema = "doc_id long, text string"
    docs = spark.createDataFrame([(None, "one text"), (None, None), (3, "one text"), (3, "one text")], schema)
    rows = sorted(alignment.align(docs, sources).collect(), key=str)
    assert len(rows) == 4 and {r.n_a for r in rows} == {0, 2}
    assert {r.count_sum for r in rows if r.n_a} == {3 * 2}
    assert alignment.align(docs.limit(0), sources).collect() == []
    assert alignment.align(docs.where("text is null"), sources).collect()[0].n_links == 0
