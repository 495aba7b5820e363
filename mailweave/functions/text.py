"""Small helpers shared by the other expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that count as blank, U+0000 to U+0020.
BLANKS = "".join(chr(code) for code in range(0x21))


def trim_blanks(text: Column) -> Column:
    """Trim every control character and space; SQL ``trim`` removes spaces only."""
    return F.trim(text, F.lit(BLANKS))


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, 0.0 where ``whole`` is 0."""
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))
