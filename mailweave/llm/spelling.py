"""Spelling variants: words one edit apart, found by PartEnum signatures of their letters.

A word's letters are a multiset, and a multiset is a binary vector with one dimension per
letter and occurrence ("e1", "e2"). One replaced letter changes two bits, one inserted or
deleted letter a single bit. The letters are dealt to `PARTS` parts; if two vectors of equal
size differ in two bits, some two parts hold both, so the vectors agree once those parts are
taken out. Every vector therefore gives one signature for each pair of parts, of the letters in
the other parts, and one for each single part under the sizes that it could have with a letter
more or less. Vectors that share a signature are found by an equi-join and compared bit by bit.

What is left are pairs of multisets whose difference is known: one letter for another, or one
letter more. A word of the one side has a near word exactly where doing that edit at one of the
letter's places gives a word of the table, which a second equi-join tells. No pairs of all words
with the same letters are made, so classes of many anagrams cost their size and not its square.

Defined cases: a null text has no words, a null ``doc_id`` counts as the empty text in the hash,
repeated rows are counted as often as they stand there, an empty table gives no words, other
columns are left alone. A word of any length is whole. Among near words of equal count the
smallest in code-point order is the form.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailweave.llm.common import removed, written

#: Parts the letters are dealt to by their code: 28 signatures for two bits, 16 for one.
PARTS = 8

# Fixed values of the word rule: what a letter is, and which are lower-cased.
FIRST, LAST = "À", "ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def occurrences(documents: DataFrame, shortest: int = 6, damage: int = 199) -> DataFrame:
    """``word`` of every run of letters in whole texts, damaged by rule: if ``damage`` divides the
    hash of document and run, the letter at hash modulo length is missing.

    Runs under ``shortest`` letters cannot give a word and are not even cut out.
    """
    runs = F.regexp_extract_all(
        F.coalesce("text", F.lit("")), F.lit(f"[A-Za-z{FIRST}-{LAST}]{{{shortest},}}+"), F.lit(0)
    )
    run = F.translate("run", UPPER, LOWER)
    cut = documents.select("doc_id", F.explode(runs).alias("run")).select("doc_id", run.alias("run"))
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run")
    cut = cut.select("run", F.crc32(name.cast("binary")).alias("h"))
    place = (F.col("h") % F.length("run")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    word = F.when(F.col("h") % damage == 0, short).otherwise(F.col("run"))
    return cut.select(word.alias("word")).where(F.length("word") >= shortest)


def _letters(word: Column) -> Column:
    """The letters of a word in order, as text: equal for words of the same multiset."""
    return F.array_join(F.array_sort(F.split(word, "")), "")


def _bits(letters: Column) -> Column:
    """The dimensions that a multiset sets: each letter with the number of its occurrence."""
    runs = F.regexp_extract_all(letters, F.lit(r"(?s)(.)\1*+"), F.lit(0))
    return F.flatten(
        F.transform(
            runs,
            lambda run: F.transform(
                F.sequence(F.lit(1), F.length(run)),
                lambda i: F.concat(F.substring(run, 1, 1), i.cast("string")),
            ),
        )
    )


def _part(part: int) -> str:
    """The letters of a part."""
    every = [*LOWER, *map(chr, range(ord(FIRST), ord(LAST) + 1))]
    return "".join(letter for letter in every if ord(letter) % PARTS == part)


def _signatures(sets: DataFrame) -> DataFrame:
    """``key, role, letters``: role 0 meets 0 (a letter for another), 1 meets 2 (a letter more).

    The key is a hash; vectors that meet by chance do not survive the comparison.
    """
    size, rows = F.length("letters"), []

    def row(role: int, parts: tuple[int, ...], size: Column) -> Column:
        rest = F.translate("letters", "".join(map(_part, parts)), "")
        name = F.lit(",".join(map(str, parts)))
        return F.struct(F.xxhash64(name, size, rest).alias("key"), F.lit(role).alias("role"))

    rows += [row(0, parts, size) for parts in combinations(range(PARTS), 2)]
    rows += [row(1, (part,), size) for part in range(PARTS)]
    rows += [row(2, (part,), size - 1) for part in range(PARTS)]
    return sets.select("letters", F.inline(F.array(*rows)))


def edits(sets: DataFrame) -> DataFrame:
    """``letters, take, put``: multisets with the edit that makes them another one of ``sets``.

    ``put`` is the letter that replaces one ``take``, or empty where one ``take`` is deleted.
    One row for each pair at Hamming distance 1, or 2 with equal sizes.
    """
    keyed = written(_signatures(sets), "signatures")
    a = keyed.where("role < 2").select("key", F.col("role").alias("kind"), F.col("letters").alias("one"))
    b = keyed.where("role <> 1").select("key", "role", F.col("letters").alias("two"))
    meet = ((F.col("kind") == 0) & (F.col("role") == 0) & (F.col("one") < F.col("two"))) | (
        (F.col("kind") == 1) & (F.col("role") == 2)
    )
    pairs = a.join(b, "key").where(meet).select("one", "two")
    pairs = pairs.withColumns({"x": _bits(F.col("one")), "y": _bits(F.col("two"))}).select(
        "one", "two", F.array_except("x", "y").alias("x"), F.array_except("y", "x").alias("y")
    )
    letter = lambda bits: F.substring(F.get(bits, F.lit(0)), 1, 1)
    swap = F.size("x") == 1
    found = pairs.where((F.size("y") == 1) & (F.size("x") <= 1)).select(
        F.when(swap, F.col("one")).otherwise(F.col("two")).alias("letters"),
        F.when(swap, letter(F.col("x"))).otherwise(letter(F.col("y"))).alias("take"),
        F.when(swap, letter(F.col("y"))).otherwise(F.lit("")).alias("put"),
    )
    done = written(found.distinct(), "edits")
    removed(keyed)
    return done


def near_words(words: DataFrame) -> DataFrame:
    """``word, n, other, other_n``: both directions of every pair of ``words`` one edit apart."""
    lettered = words.withColumn("letters", _letters(F.col("word")))
    changes = edits(lettered.select("letters").distinct())
    places = F.filter(
        F.sequence(F.lit(1), F.length("word")), lambda i: F.substring(F.col("word"), i, F.lit(1)) == F.col("take")
    )
    made = F.transform(
        places,
        lambda i: F.concat(
            F.substring(F.col("word"), F.lit(1), i - 1), "put", F.substring(F.col("word"), i + 1, F.length("word"))
        ),
    )
    tried = lettered.join(changes, "letters").select(
        "word", "n", F.explode(F.array_distinct(made)).alias("other")
    )
    tried = written(tried, "tried")
    other = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = written(tried.join(other, "other").select("word", "n", "other", "other_n"), "near")
    removed(changes, tried)
    return pairs.union(pairs.select("other", "other_n", "word", "n"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of every word with a form, by jumping over the form's form.

    Counts at least quintuple along a chain, so a chain of 17 forms is the most for a
    thousand billion words, and each round halves it.
    """
    links = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        up = links.select(F.col("word").alias("root"), F.col("root").alias("upper"))
        jumped = links.join(up, "root", "left").select(
            "word", F.coalesce("upper", "root").alias("root"), F.col("upper").isNotNull().alias("moved")
        )
        jumped = written(jumped, "roots")
        removed(links)
        links = jumped
        if not links.where("moved").limit(1).count():
            return links.select("word", "root")


def variants(documents: DataFrame, least: int = 5, ratio: int = 5) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of all words that occur ``least`` times.

    The form is the near word of largest count, if that is ``ratio`` times the word's own; the
    root is reached by following forms to the last.
    """
    counted = occurrences(documents).groupBy("word").agg(F.count("*").alias("n"))
    words = written(counted.where(F.col("n") >= least), "words")
    near = near_words(words)
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word")))
    found = near.groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    large = -F.col("best.n") >= ratio * F.col("n")
    found = found.select(
        "word",
        "n_near",
        F.when(large, F.col("best.word")).alias("form"),
        F.when(large, -F.col("best.n")).alias("form_n"),
    )
    found = written(found, "forms")
    roots = _roots(found.where(F.col("form").isNotNull()))
    return (
        words.join(found, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            "form_n",
        )
    )
