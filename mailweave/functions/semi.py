"""Semi-structured mails: all header fields as a map, and mails as JSON objects."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailweave.functions.text import BLANKS, trim_blanks

JSON_FIELDS = {"file": "string", "headers": "map<string,array<string>>", "body": "string"}


def split_message(message: Column) -> tuple[Column, Column]:
    """Header block and body of a message: the first empty line parts them."""
    text = F.ltrim(F.coalesce(message, F.lit("")), F.lit(BLANKS))
    parts = F.split(text, r"\n\r?\n", 2)
    return parts[0], F.coalesce(F.get(parts, F.lit(1)), F.lit(""))


def header_map(message: Column) -> Column:
    """``map<string, array<string>>`` of all header fields: their values in order, folded lines
    joined and trimmed. Names are kept as they are written; a line without a name is left out."""
    block, _ = split_message(message)
    lines = F.split(block, r"\n(?![ \t])")
    fields = F.filter(
        F.transform(
            lines,
            lambda line: F.struct(
                F.regexp_extract(line, r"^([!-9;-~]++)[ \t]*+:", 1).alias("name"),
                F.array_join(
                    F.transform(F.split(F.regexp_replace(line, r"^[^:]*+:", ""), "\n"), trim_blanks), " "
                ).alias("value"),
            ),
        ),
        lambda field: field["name"] != "",
    )
    # the array of one binds the fields to a name, so they are cut once and not for every name
    maps = F.transform(F.array(fields), _by_name)
    return maps[0]


def _by_name(fields: Column) -> Column:
    names = F.array_distinct(F.transform(fields, lambda field: field["name"]))
    values = F.transform(
        names,
        lambda name: F.transform(
            F.filter(fields, lambda field: field["name"] == name), lambda field: field["value"]
        ),
    )
    return F.map_from_arrays(names, values)


def message_json(file: Column, message: Column) -> Column:
    """A mail as one JSON object ``file, headers, body``."""
    _, body = split_message(message)
    return F.to_json(F.struct(file.alias("file"), header_map(message).alias("headers"), body.alias("body")))


def parsed_json(line: Column) -> Column:
    """``file, headers, body, rest, corrupt`` of a line of JSON.

    ``rest`` holds fields that are not among the three, as JSON text by name; ``corrupt`` is the
    whole line where it is no JSON object, or a field has another type, and else NULL. What
    follows the object on its line is ignored, as Spark's JSON reader does.
    """
    typed = ", ".join(f"{name} {kind}" for name, kind in JSON_FIELDS.items())
    known = F.from_json(line, f"{typed}, corrupt string", {"columnNameOfCorruptRecord": "corrupt"})
    every = F.try_variant_get(F.try_parse_json(line), "$", "map<string, variant>")
    rest = F.map_filter(every, lambda name, _: ~name.isin(*JSON_FIELDS))
    texts = F.transform_values(rest, lambda _, value: F.to_json(value))
    # a line of another kind than an object has no fields, but is no error to the parser
    corrupt = F.when(every.isNull(), line).otherwise(known["corrupt"])
    return F.struct(
        *(F.when(corrupt.isNull(), known[name]).alias(name) for name in JSON_FIELDS),
        F.when(corrupt.isNull(), texts).alias("rest"),
        corrupt.alias("corrupt"),
    )
