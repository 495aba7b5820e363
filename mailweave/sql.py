"""The mail tables and rules under SQL names, for queries written in SQL alone.

``register`` makes temporary views of the parsed mails and their edges, and temporary functions
whose bodies are SQL, so Spark inlines them into the plan like any other expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mailweave.functions.addresses import VALID_ADDRESS
from mailweave.functions.text import BLANKS
from mailweave.operators.messages import build_edges, explode_recipients, persons


def _quoted(text: str) -> str:
    """A SQL string literal: characters that SQL would read otherwise stand as their numbers."""
    plain = lambda c: c.isprintable() and c not in "'\\"
    return "'" + "".join(c if plain(c) else f"\\u{ord(c):04x}" for c in text) + "'"


#: Name: parameters, result, and the SQL that gives it.
FUNCTIONS = {
    "mail_clean_address": (
        "text STRING",
        "STRING",
        f"""TRIM(BOTH {_quoted(BLANKS)} FROM
            CASE WHEN instr(text, '<') > 0 AND instr(text, '>') > instr(text, '<')
                 THEN substring(text, instr(text, '<') + 1, instr(text, '>') - instr(text, '<') - 1)
                 ELSE text END)""",
    ),
    "mail_valid_address": ("address STRING", "BOOLEAN", f"address RLIKE {_quoted(VALID_ADDRESS)}"),
    "mail_quarter": (
        "ym STRING",
        "STRING",
        """concat(split(ym, '-')[0], '-Q',
                  CAST(CAST((try_cast(get(split(ym, '-'), 1) AS INT) - 1) / 3 AS INT) + 1 AS STRING))""",
    ),
    "mail_weight": ("type STRING", "DOUBLE", "CASE WHEN type = 'cc' THEN 0.5D ELSE 1.0D END"),
}

#: Functions that give a table.
TABLE_FUNCTIONS = {
    "mail_correspondents": (
        "person STRING",
        "email STRING, sent BIGINT, received BIGINT",
        """SELECT email, sum(sent), sum(received) FROM (
             SELECT dst AS email, 1 AS sent, 0 AS received FROM mail_edges WHERE src = person
             UNION ALL SELECT src, 0, 1 FROM mail_edges WHERE dst = person) GROUP BY email""",
    ),
}


def register(spark: SparkSession, parsed: DataFrame) -> None:
    """Views ``mail_parsed, mail_copies, mail_edges, mail_persons`` and the functions above."""
    views = {
        "mail_parsed": parsed,
        "mail_copies": explode_recipients(parsed),
        "mail_edges": build_edges(parsed),
        "mail_persons": persons(parsed),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    for name, (takes, gives, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({takes}) RETURNS {gives} RETURN {body}")
    for name, (takes, gives, body) in TABLE_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({takes}) RETURNS TABLE({gives}) RETURN {body}")
