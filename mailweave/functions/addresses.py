"""Mail addresses: cleaning, validity and recipient lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailweave.functions.text import trim_blanks

# Fixed value: one "@" that is neither first nor last, no blank, colon or angle
# bracket, and a dot somewhere after the "@".
VALID_ADDRESS = r"^[^@ :<>]++@[^@ :<>.]*+\.[^@ :<>]*+$"

# Fixed value: what separates recipients.
SEPARATORS = "[,;]"


def clean_address(text: Column) -> Column:
    """Text inside the first pair of angle brackets, else the whole text; trimmed."""
    left, right = F.instr(text, "<"), F.instr(text, ">")
    inside = F.substring(text, left + 1, right - left - 1)
    return trim_blanks(F.when((left > 0) & (right > left), inside).otherwise(text))


def is_valid_address(address: Column) -> Column:
    return address.rlike(VALID_ADDRESS)


def valid_recipients(field: Column, sender: Column) -> Column:
    """Array of the valid lower-cased addresses in a recipient field.

    The sender is left out; an address listed twice stays twice.
    """
    tokens = F.transform(F.split(field, SEPARATORS), lambda token: F.lower(clean_address(token)))
    return F.filter(tokens, lambda address: (address != sender) & is_valid_address(address))
