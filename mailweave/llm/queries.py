"""The registered queries of the operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from mailweave.llm import (
    alignment,
    arc_warc,
    bagminhash,
    bpe_matrix,
    langid,
    packing,
    pii,
    quality_lines,
    separator_scan,
    simhash,
    spelling,
    suffix_family,
    url_filter,
)
from mailweave.llm.common import ship, written
from mailweave.session import stage_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base spans, and those the span classifier adds."""
    candidates = pii.with_candidates(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = written(candidates.drop("text"), "candidates")
    chances = pii.classify(pii.cell_counts(found))
    of = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    every = pii.accepted(chances)
    return found.select(
        "doc_id",
        *(of(kind).alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(every).alias("spans"),
        (F.size(every) - F.size("base")).cast("long").alias("n_added"),
    )


def op2_suffix_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes that lie in a 200-byte string that occurs elsewhere."""
    found = suffix_family.without_repeats(_table(spark, sf_dir, "documents"), length=200)
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", digest)


def op3_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and the verdict of line-first cleaning for every document."""
    judged = quality_lines.clean_lines(_table(spark, sf_dir, "documents"))
    return judged.withColumn("cleaned_sha256", F.sha2("cleaned", 256)).drop("cleaned")


_WORD = "'[^\\x20\\x09-\\x0D]+'"

OP3_SQL = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), lines AS (
    SELECT r, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM d
), w AS (
    SELECT r, line, pos, regexp_extract_all(line, {_WORD}) AS words FROM lines
), judged AS (
    SELECT r, line, pos, words, len(words) AS n,
        list_sum(list_transform(words, lambda x: length(x))) AS chars,
        len(list_filter(words, lambda x: regexp_matches(x, '{quality_lines.NOISY_END}'))) AS noisy,
        len(list_filter(words, lambda x: regexp_matches(x, '{quality_lines.SEPARATOR}'))) AS seps,
        len(list_filter(words, lambda x: regexp_matches(x, '^(?i:{quality_lines.MENU})$'))) AS menu,
        regexp_matches(line, '(?i:{quality_lines.BOILERPLATE})') AS boiler,
        len(words) > 0 AND row_number() OVER (PARTITION BY r, line ORDER BY pos) > 1 AS dup
    FROM w
), failed AS (
    SELECT *, n > 0 AND (4 * noisy > n OR (seps >= 2 AND 5 * seps >= n)
        OR (n <= 4 AND menu = n) OR boiler) AS fails
    FROM judged
), by_doc AS (
    SELECT r, sum(n)::BIGINT AS n_words, coalesce(sum(chars), 0)::BIGINT AS word_chars,
        sum(dup::INT)::BIGINT AS n_dup_lines, sum(fails::INT)::BIGINT AS n_lines_removed,
        coalesce(sum(chars) FILTER (fails), 0)::BIGINT AS lost_chars,
        coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT fails), '') AS cleaned
    FROM failed GROUP BY r
), all_words AS (
    SELECT r, unnest(regexp_extract_all(text, {_WORD})) AS word,
        generate_subscripts(regexp_extract_all(text, {_WORD}), 1) AS i
    FROM d
), windows AS (
    SELECT r, i, word, lead(word) OVER o AS b, lead(word, 2) OVER o AS c
    FROM all_words WINDOW o AS (PARTITION BY r ORDER BY i)
), often AS (
    SELECT r, i, c IS NOT NULL AND count(*) OVER (PARTITION BY r, word, b, c) >= 2 AS often FROM windows
), covered AS (
    SELECT r, i, often OR coalesce(lag(often) OVER o, false) OR coalesce(lag(often, 2) OVER o, false) AS covered
    FROM often WINDOW o AS (PARTITION BY r ORDER BY i)
), repeats AS (
    SELECT r, sum(covered::INT)::BIGINT AS n_repeat_words FROM covered GROUP BY r
), counted AS (
    SELECT doc_id, n_words, word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, n_lines_removed, lost_chars,
        sha256(cleaned) AS cleaned_sha256
    FROM d JOIN by_doc USING (r) LEFT JOIN repeats USING (r)
), based AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
)
SELECT *, NOT base_failed AND NOT (100 * lost_chars > 30 * word_chars) AS kept FROM based
"""


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from labelled documents that are not held out."""
    documents = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    documents = documents.select("doc_id", "text", "lang", held_out.alias("held_out"))
    learned = documents.where(~F.col("held_out") & F.col("doc_id").isNotNull())
    return langid.identify(documents, langid.fit(learned), keep=["doc_id", "held_out"])


#: The end id of the flat files, and the ids of the 15-bit digits before each document.
END_OF_DOCUMENT = 50256
DIGITS = 5


def _with_digits(doc_id, ids):
    """``doc_id`` as five ids below 32768 (the last one 1 more by 16 for null), then the ids.

    A flat file says nothing about its documents but their order, so the query writes the
    number of each document into the document.
    """
    number = F.coalesce(doc_id, F.lit(0).cast("long"))
    digits = [F.shiftrightunsigned(number, 15 * i).bitwiseAND(F.lit(0x7FFF)) for i in range(4)]
    top = F.shiftrightunsigned(number, 60).bitwiseAND(F.lit(0xF))
    digits.append(top + F.when(doc_id.isNull(), F.lit(16)).otherwise(F.lit(0)))
    # two hexadecimal bytes of each digit, the low one first
    byte = lambda x: F.lpad(F.hex(x), 2, "0")
    text = [c for d in digits for c in (byte(d.bitwiseAND(F.lit(255))), byte(F.shiftright(d, 8)))]
    return F.concat(F.unhex(F.concat(*text)), ids)


def _number(head):
    """The ``doc_id`` in the digits at the head of a document."""
    value = lambda i: F.conv(
        F.hex(F.concat(F.substring(head, 2 * i + 2, F.lit(1)), F.substring(head, 2 * i + 1, F.lit(1)))), 16, 10
    ).cast("long")
    top = value(4)
    number = F.shiftleft(top.bitwiseAND(F.lit(0xF)), 60)
    for i in range(4):
        number = number.bitwiseOR(F.shiftleft(value(i), 15 * i))
    return F.when(top < 16, number)


def op5_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as flat token files, then count the tokens of each by scanning."""
    ids = separator_scan.document_ids(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
    )
    folder = stage_path(spark, "flat")
    numbered = ids.select(_with_digits(F.col("doc_id"), F.col("ids_bytes")).alias("ids_bytes"))
    separator_scan.write_flat(numbered, folder, END_OF_DOCUMENT)
    counted = separator_scan.count_tokens(spark, folder, END_OF_DOCUMENT, head=DIGITS)
    return counted.select(
        _number(F.col("head")).alias("doc_id"),
        (F.col("n_tokens") - DIGITS).alias("n_tokens"),
        "document",
        "start",
    )


def op6_bpe_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every text, decode the ids, and digest both."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    how = {"ranks": ranks, "pattern": public_tokenizers.PATTERN}
    encoded = bpe_matrix.encode(_table(spark, sf_dir, "documents"), **how)
    digests = encoded.select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
    )
    decoded = bpe_matrix.decode(digests, **how, keep=["doc_id", "n_tokens", "ids_sha256"])
    return decoded.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts; for every 50th id also the
    number of other documents within 9 bits, a likeness of 0.975 (null for the rest)."""
    prints = written(simhash.compare_in_order(_table(spark, sf_dir, "documents")), "prints")
    asked = F.coalesce(F.col("doc_id") % 50 == 0, F.lit(False))
    near = written(simhash.near_counts(prints, prints.where(asked), radius=9, blocks=5), "near")
    return prints.join(near, ["high", "low"], "left").select(
        *(c for c in prints.columns if c not in ("high", "low")),
        F.when(asked, F.col("n_near") - 1).alias("n_near"),
    )


def op8_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document: windows of five words, overlap of 0.8."""
    found = bagminhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id")


def op9_linear_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of 1024 tokens."""
    return packing.pack(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
        end_id=2,
        capacity=1024,
    )


def op10_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the pages as ARC archives, convert them to WARC, and read those back."""
    arc, warc = stage_path(spark, "arc"), stage_path(spark, "warc")
    arc_warc.write_arc(_table(spark, sf_dir, "pages"), arc)
    arc_warc.convert(spark, arc, warc, revisit_from=0)
    records = arc_warc.read_warc(spark, warc).where(F.col("type").isin("response", "revisit"))
    return records.select(
        arc_warc.header_number(F.col("head"), arc_warc.PAGE_HEADER).alias("page_id"),
        arc_warc.header_number(F.col("head"), "Content-Length").alias("payload_bytes"),
        F.substring_index("payload_digest", ":", -1).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("refers_to_page").cast("long").alias("refers_to"),
    )


# base32 of a SHA-1: each five hexadecimal digits are four letters
_BASE32 = """
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((('0x' || substr(hex, 1 + 5 * (i // 4)::INT, 5))::INT >> (15 - 5 * (i % 4)::INT)) & 31),
        1)), '')
"""

OP10_SQL = f"""
WITH p AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
        sha1(coalesce(html, '')) AS hex
    FROM pages
), w AS (
    SELECT *, max(page_id) OVER (PARTITION BY hex, payload_bytes) AS winner FROM p
)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
    CASE WHEN page_id = winner THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> winner THEN winner END AS refers_to
FROM w
"""


#: The rules of the URL filter.
URL_RULES = [
    url_filter.Rule("com", "/", "allow"),
    url_filter.Rule("example.com", "/en/", "block"),
    url_filter.Rule("www.example.com", "/en/", "allow"),
    url_filter.Rule("net", "/es/", "block"),
    url_filter.Rule("net", "/fr/", "block"),
]


def op11_url_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict; trees decide where no rule does."""
    judged = url_filter.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("row.page_id", "host", "path", "rule", "verdict", "score")


def op12_partenum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words, form and root."""
    return spelling.variants(_table(spark, sf_dir, "documents"))


_RUN = "'[A-Za-z\u00C0-\u00FF]+'"

OP12_SQL = f"""
WITH RECURSIVE step AS (
    SELECT range AS i, list_reduce([1, 2, 3, 4, 5, 6, 7, 8], lambda c, b:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, range) AS v
    FROM range(256)
), crc AS (SELECT list(v ORDER BY i) AS t FROM step
), runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS doc, unnest(regexp_extract_all(coalesce(text, ''), {_RUN})) AS run
    FROM documents
), lowered AS (
    SELECT doc, translate(run, '{spelling.UPPER}', '{spelling.LOWER}') AS run, count(*) AS times
    FROM runs GROUP BY ALL
), hashed AS (
    SELECT run, times, xor(4294967295, list_reduce(
        list_transform(range(1, strlen(doc || ':' || run) + 1),
            lambda i: ('0x' || substr(hex(encode(doc || ':' || run)), (2 * i - 1)::INT, 2))::BIGINT),
        lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]), 4294967295::BIGINT)) AS h
    FROM lowered, crc WHERE length(run) >= 6
), damaged AS (
    SELECT times, CASE WHEN h % 199 = 0
        THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word
    FROM hashed
), words AS MATERIALIZED (
    SELECT word, sum(times)::BIGINT AS n FROM damaged WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
), places AS (
    SELECT word, n, substr(word, 1, i::INT - 1) AS head, substr(word, i::INT + 1) AS tail
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), swaps AS (
    SELECT a.word, b.word AS other, b.n AS other_n
    FROM places a JOIN places b ON a.head = b.head AND a.tail = b.tail AND a.word <> b.word
), drops AS (
    SELECT DISTINCT p.word AS long, p.n AS long_n, w.word AS short, w.n AS short_n
    FROM places p JOIN words w ON p.head || p.tail = w.word
), near AS (
    SELECT * FROM swaps UNION ALL SELECT long, short, short_n FROM drops
    UNION ALL SELECT short, long, long_n FROM drops
), ranked AS (
    SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
        row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place
    FROM near
), forms AS MATERIALIZED (
    SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
        CASE WHEN other_n >= 5 * w.n THEN other END AS form, CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
    FROM words w LEFT JOIN (SELECT * FROM ranked WHERE place = 1) r ON r.word = w.word
), walk AS (
    SELECT word, word AS reached, 0 AS steps FROM forms
    UNION ALL
    SELECT walk.word, forms.form, steps + 1 FROM walk JOIN forms ON forms.word = walk.reached WHERE forms.form IS NOT NULL
), roots AS (SELECT word, arg_max(reached, steps) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""


def op13_merge_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps and common groups of a byte-level and a piece tokenizer for every document."""
    sources = alignment.Sources.of(
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
        public_tokenizers.path("piece_bpe_32k.model"),
    )
    found = alignment.align(_table(spark, sf_dir, "documents"), sources, digest=True)
    return found.withColumnsRenamed({"key": "doc_id", "groups": "groups_sha256"})


Query = Callable[[SparkSession, str], DataFrame]


def _with_code(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    found = {
        "op1_weak_supervision": op1_weak_supervision,
        "op2_suffix_family": op2_suffix_family,
        "op3_line_rules": op3_line_rules,
        "op4_kneser_ney": op4_kneser_ney,
        "op5_separator_scan": op5_separator_scan,
        "op6_bpe_matrix": op6_bpe_matrix,
        "op7_simhash": op7_simhash,
        "op8_bagminhash": op8_bagminhash,
        "op9_linear_grouping": op9_linear_grouping,
        "op10_arc_to_warc": op10_arc_to_warc,
        "op11_url_boosting": op11_url_boosting,
        "op12_partenum": op12_partenum,
        "op13_merge_asof": op13_merge_asof,
    }
    return {name: _with_code(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_line_rules": OP3_SQL,
        "op10_arc_to_warc": OP10_SQL,
        "op12_partenum": OP12_SQL,
    }
