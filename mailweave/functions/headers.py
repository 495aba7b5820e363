"""Header fields of a raw RFC-822 message."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailweave.functions.text import BLANKS, trim_blanks


def header(message: Column, name: str, headers_only: bool = False) -> Column:
    """Value of the first line that starts with ``name:``, folded lines joined.

    The name is case-sensitive. The whole message is searched, so a field that
    is missing from the headers is taken from a forwarded mail in the body;
    ``headers_only`` stops at the first empty line instead. A missing field is
    the empty string.

    Quantifiers are possessive: a field folded over many thousand lines is read
    in a loop and not by recursion. The pattern starts with a literal, which
    the regex engine finds without trying every position of a long body.
    """
    text = F.concat(F.lit("\n"), F.ltrim(F.coalesce(message, F.lit("")), F.lit(BLANKS)))
    if headers_only:
        text = F.split(text, r"\n\r?\n", 2)[0]
    folded = F.regexp_extract(text, rf"\n{name}:([^\n]*+(?:\n[ \t][^\n]*+)*+)", 1)
    return trim_blanks(F.array_join(F.transform(F.split(folded, "\n"), trim_blanks), " "))
