"""Column expressions; none of them is a Python UDF."""

from mailweave.functions.addresses import clean_address, is_valid_address, valid_recipients
from mailweave.functions.dates import quarter_of, sent_at, sent_hour, sent_month
from mailweave.functions.headers import header
from mailweave.functions.semi import header_map, message_json, parsed_json, split_message
from mailweave.functions.text import ratio, trim_blanks

__all__ = [
    "clean_address",
    "header",
    "header_map",
    "is_valid_address",
    "message_json",
    "parsed_json",
    "quarter_of",
    "ratio",
    "sent_at",
    "sent_hour",
    "sent_month",
    "split_message",
    "trim_blanks",
    "valid_recipients",
]
