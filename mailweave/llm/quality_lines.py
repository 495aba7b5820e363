"""Line-first cleaning of documents, with the counts that quality rules use.

Every line that has a word is judged by itself:

* punctuation: over a quarter of its words end in two or more marks or symbols;
* navigation: at least two words, and a fifth of all, are separators, or all of its up
  to four words are names of menu entries;
* boilerplate: it contains a phrase of cookie notices, copyright lines, licences and the like.

Lines that fail are removed. A document is rejected if more than ``max_lost`` percent of
its word characters were in them. Independently, a document fails the base rules if it
has under ``min_words`` words, or over half of its words lie in repeated windows of three.

Words are ``[^\\x20\\x09-\\x0D]+``, lines are what ``\\n`` separates. Defined cases: a null
text has no words and fails the base rules, as an empty one does; its cleaned text is
empty; repeated rows are judged alike; an empty table gives an empty table. Texts are read
whole. Only the ``keep`` columns are read besides the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailweave.llm.common import slices

# Fixed values of the rules; the SQL of the tests uses the same.
SYMBOLS = "#*$%&|<>"
NOISY_END = r"[!?#*$%&<>]{2,}$"
SEPARATOR = r"^[|>/\\~•·»›–—-]+$"
MENU = (
    "home|about|contact|login|logout|register|menu|search|sitemap|next|previous|prev|back|top|"
    "share|print|archive|categories|tags|help|faq"
)
BOILERPLATE = (
    "cookie policy|use of cookies|uses cookies|accept cookies|privacy policy|terms of use|"
    "terms of service|terms and conditions|all rights reserved|enable javascript|"
    "javascript is disabled|lorem ipsum|click here to|sign up for our newsletter|"
    "subscribe to our|powered by wordpress|is licensed under the"
)

_words = re.compile(r"[^ \t-\r]+").findall
_noisy = re.compile(NOISY_END).search
_separator = re.compile(SEPARATOR).match
_menu = re.compile(rf"(?:{MENU})\Z").match
_boilerplate = re.compile(BOILERPLATE).search
_lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
_may_fail = re.compile(r"[!?#*$%&<>]{2}|(?:^|[ \t-\r])[|>/\\~•·»›–—-]+(?:[ \t-\r]|\Z)").search


def line_fails(line: str, words: list[str]) -> bool:
    """Whether one of the rules removes a line; ``words`` are its words, at least one."""
    n = len(words)
    if _may_fail(line):
        if 4 * sum(1 for w in words if _noisy(w)) > n:
            return True
        separators = sum(1 for w in words if _separator(w))
        if separators >= 2 and 5 * separators >= n:
            return True
    lower = line.translate(_lower)
    if n <= 4 and all(_menu(w) for w in _words(lower)):
        return True
    return _boilerplate(lower) is not None


def repeated_words(words: list[str]) -> int:
    """Words that lie in a window of three words found twice or more, the first included."""
    if len(words) < 4:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
    _, window, count = np.unique(
        pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True
    )
    often = count[window] >= 2
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : len(words) - 2 + shift] |= often
    return int(covered.sum())


def judge(text: str) -> tuple[int, int, int, int, int, int, int, str]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines_removed,
    lost_chars (word characters of removed lines) and the cleaned text."""
    every: list[str] = []
    seen: set[str] = set()
    kept: list[str] = []
    word_chars = lost = duplicates = dropped = 0
    for line in text.split("\n"):
        words = _words(line)
        if not words:
            kept.append(line)
            continue
        every += words
        size = sum(map(len, words))
        word_chars += size
        if line in seen:
            duplicates += 1
        else:
            seen.add(line)
        if line_fails(line, words):
            dropped += 1
            lost += size
        else:
            kept.append(line)
    symbols = sum(map(text.count, SYMBOLS))
    repeats = repeated_words(every)
    return len(every), word_chars, symbols, duplicates, repeats, dropped, lost, "\n".join(kept)


_COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines_removed",
    "lost_chars",
)


def clean_lines(
    df: DataFrame,
    text_col: str = "text",
    keep: Sequence[str] = ("doc_id",),
    min_words: int = 50,
    max_lost: int = 30,
) -> DataFrame:
    """The ``keep`` columns, the counts, cleaned (text), base_failed and kept."""
    n = len(keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, n):
            rows = [judge(text or "") for text in part.column(n).to_pylist()]
            columns = list(zip(*rows))
            arrays = [pa.array(c, pa.int64()) for c in columns[:-1]]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:n], *arrays, pa.array(columns[-1], pa.string())],
                names=schema.names,
            )

    schema = T.StructType([df.schema[c] for c in keep])
    for name in _COUNTS:
        schema = schema.add(name, T.LongType())
    schema = schema.add("cleaned", T.StringType())
    judged = df.select(*keep, F.col(text_col).cast("string").alias("__text")).mapInArrow(run, schema)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    lost = 100 * F.col("lost_chars") > max_lost * F.col("word_chars")
    return judged.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~lost)
