"""The registered queries and the pipeline on the smallest tables."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from mailweave.llm import queries as added
from tests.oracle import differences, tables

QUERIES, ORACLES = added.queries(), added.oracle_sql()


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


def test_all_operators():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("name", ORACLES)
def test_matches_oracle(name, spark, sf_dir):
    assert differences(QUERIES[name](spark, sf_dir), tables(sf_dir), ORACLES[name]) == []


#: Queries whose rows are pieces, pages or words, or that a test of their own holds row by row.
OTHER_ROWS = ("op9_", "op11_", "op13_")


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES and not n.startswith(OTHER_ROWS)])
def test_one_row_per_document(name, spark, sf_dir, documents):
    found = Counter(r.doc_id for r in QUERIES[name](spark, sf_dir).select("doc_id").collect())
    assert found == Counter(list(documents))


def test_decoded_is_the_text(spark, sf_dir, documents):
    for r in QUERIES["op6_bpe_matrix"](spark, sf_dir).collect():
        assert r.decoded_sha256 == hashlib.sha256(documents[r.doc_id].encode()).hexdigest()


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("key", F.lit("own"))
    extra = [(9001, None), (9002, ""), (9003, "123 !!"), (9004, "Mail joe@corp.example.org today, the thing of it.")]
    extra = spark.createDataFrame(extra, "doc_id long, text string").select(
        "doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit("x").alias("source"),
        F.length("text").cast("long").alias("n_chars"), F.lit("own").alias("key"),
    )
    docs = docs.union(extra)
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        docs = corpus_pipeline.written(out, name)
        sizes.append(docs.count())
    kept = {r.doc_id: r for r in docs.collect()}
    assert not {9001, 9002, 9003} & set(kept)
    assert kept[9004].text == "Mail <EMAIL> today, the thing of it."
    assert all(r.n_chars == len(r.text) and r.key == "own" for r in kept.values())
    assert kept[9004].lang == "en" and {r.lang for r in kept.values()} == {"de", "en", "es", "fr"}
    assert sizes[0] == 201 and sizes[1] == sizes[2] == sizes[3] < 201
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in last} == set(kept)


def test_pipeline_with_repeated_rows_and_a_long_text(spark, sf_dir):
    """Repeated rows and ids, a text of 400,000 characters, no column for its length."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fitted = docs.select("doc_id", "text", "lang")
    rng = random.Random(5)
    long = " ".join(rng.choice(["the", "and", "of", "in", "thing", "then", "on"]) + rng.choice(["", ",", ".", "s"]) for _ in range(90_000))
    odd = [(7001, long, None), (7001, long, None), (7002, "Same text of the thing, and the other.", None)]
    odd += [(7002, "Same text of the thing, and the other.", None), (None, "The thing of and the other, of the same.", None)]
    rows = fitted.union(spark.createDataFrame(odd, "doc_id long, text string, lang string"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, sf_dir)
        assert out.columns == rows.columns
        rows = corpus_pipeline.written(out, name)
        if name == "language_id":
            assert Counter(r.doc_id for r in rows.where("doc_id > 7000 OR doc_id IS NULL").collect()) == {7001: 2, 7002: 2, None: 1}
    kept = Counter(r.doc_id for r in rows.where("doc_id > 7000 OR doc_id IS NULL").collect())
    assert kept == {7001: 1, 7002: 1, None: 1}
    pieces = corpus_pipeline.STAGES[-1][1](spark, rows, sf_dir).where("doc_id = 7001")
    assert pieces.agg(F.sum("length")).head()[0] > 10_000


def test_pipeline_on_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, sf_dir), name)
        assert docs.count() == 0
