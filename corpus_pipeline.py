"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir), works on all documents that its predecessor kept,
and returns them with its decisions applied; the result is written as Parquet and reread as
the next one's docs. The last one returns the pieces of the packed sequences.

Defined cases of all stages: an empty table gives an empty table; columns beyond those of
`documents`, and missing `lang` or `n_chars`, are kept as they are; null and repeated ids are rows
of their own. What a stage does with null, empty and very long texts, ties and repeated rows
stands at the stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from mailweave.llm import bagminhash, langid, packing, pii, suffix_family
from mailweave.llm.common import ship, written

#: Bytes of an Arrow batch, of which an executor holds several per task, in the JVM beside the heap
#: and in Python. Workers and heap that one stage has made large are there in the next as well.
BATCH_BYTES = 1 << 20


def _columns(docs: DataFrame, text: Column, row: str | None = None) -> list[Column]:
    """The columns of ``docs`` with another text, and its length where there is a column for it."""
    return _with(docs, {"text": text, "n_chars": F.length(text).cast("long")}, row)


def _with(docs: DataFrame, own: dict[str, Column], row: str | None = None) -> list[Column]:
    return [own.get(c, F.col(row)[c] if row else F.col(c)).alias(c) for c in docs.columns]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised, with that language as their `lang`; those that the
    models reject go.

    Null and empty texts and those without a letter are rejected. A text of any length is judged
    whole; of languages that fit equally the first by name is taken; repeated rows all stay or go.
    """
    ship(spark, BATCH_BYTES)
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    found = langid.identify(rows, langid.fit(docs), keep=["row"])
    kept = found.where(~F.col("rejected"))
    return kept.select(*_with(docs, {"lang": F.col("lang_pred")}, "row"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one of least id.

    Texts without a word are no duplicates and all stay; of repeated rows one stays; of equal ids
    in a class the text of least key. Texts of any length are compared whole.
    """
    ship(spark, BATCH_BYTES)
    return bagminhash.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 200 bytes or more that occur elsewhere as well; bytes
    of a character that was cut in two go with it.

    Null texts stay null, and shorter texts stay as they are; repeated rows and ties lose what
    they share in every place. A long text is compared in pieces that overlap, so nothing is cut.
    """
    ship(spark, BATCH_BYTES)
    found = suffix_family.without_repeats(docs, length=200, keep=docs.columns)
    rest = F.regexp_replace(F.make_valid_utf8(F.col("kept").cast("string")), "\\uFFFD", "")
    kept = F.when((F.col("n_removed") > 0), rest).otherwise(F.col("row.text"))
    return found.select(*_columns(docs, kept, "row"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with emails, addresses, card and phone numbers replaced by marks.

    Null and empty texts stay as they are; spans that overlap become one mark; a text of any
    length is searched whole; repeated rows are treated alike.
    """
    ship(spark, BATCH_BYTES)
    clean = pii.redact(docs)
    return clean.select(*_columns(clean, F.col("text")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in sequences of 1024 tokens: one row per piece.

    A null or empty text is the end token alone; a long text is cut into full pieces, of which
    the first may be shorter; repeated rows and pieces of equal length are packed each by itself.
    """
    ship(spark, BATCH_BYTES)
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(docs, tokenizer, public_tokenizers.PATTERN, end_id=2, capacity=1024)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("personal_data", personal_data),
    ("packed", packed),
]

#: SQL cannot express the language models and signatures; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
