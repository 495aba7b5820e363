"""Personal data by weak supervision, in DataFrame expressions alone.

Base spans (emails, IP addresses, card numbers, phone numbers) come from fixed patterns and
checks, and always stay. Looser patterns find further candidates of every kind: emails spelled
with "at" and "dot", addresses of version 6, numbers in the groups of a card that stand in a
longer run of digits or fail the check, and phone numbers that are national or run into what
follows them. Five labelers vote on every candidate of either sort, for (1), against (-1) or not
at all (0):

* format: a stricter pattern, for looser card numbers the check digit;
* gazetteer: top-level domains, address blocks, card issuers, country codes;
* context: words shortly before the candidate;
* edges: what stands directly before and after it;
* shape: its length, or how many different digits it has.

Candidates of equal kind, sort, votes and length class are one cell. The counts of all cells
(at most 4 * 2 * 3^5 * 4, whatever the input) go to the driver, where expectation-maximisation
estimates the labelers' reliabilities per kind, and a naive Bayes classifier over votes, sort
and length is trained on its posteriors. A further candidate becomes a span if its
probability is at least ``ACCEPT`` and it touches no base span.

Positions count code points; the matches of a pattern are leftmost and non-overlapping. They
follow from the pieces between matches, whose lengths are summed in blocks, so a text of very
many matches stays cheap. Patterns are possessive and start at the edge of a run, so long runs
are passed over once and nothing recurses.

Defined cases: a null or empty text has no spans; null and repeated ids are rows of
their own; an empty table gives an empty table. Whole texts are searched. Columns of the input
keep their names; those that the functions add replace columns of the same name.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
ACCEPT = 0.95
LABELERS = 5

# Patterns and word lists.
_LOCAL = "A-Za-z0-9._%+-"
_EDGE = r"(?:\G|(?<![{0}]))"
PATTERNS = {
    ("email", "base"): _EDGE.format(_LOCAL) + rf"[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    ("ip", "base"): _EDGE.format("0-9") + r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    ("card", "base"): r"[0-9](?:[\x20-]?[0-9])++",
    ("phone", "base"): r"\+[0-9][\x20().0-9-]+[0-9]",
    ("email", "loose"): r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{2,64}+ ?(?:\(at\)|\[at\]| at ) ?"
    r"[a-z0-9-]{2,63}+ ?(?:\(dot\)|\[dot\]| dot ) ?[a-z]{2,10}(?![a-z0-9])",
    ("ip", "loose"): r"(?<![0-9A-Za-z:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|"
    r"[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5}::[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})(?![0-9A-Za-z:])",
    ("card", "loose"): r"(?<![0-9])[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{2,7}(?![0-9])",
    ("phone", "loose"): r"(?:\+[0-9]{1,3}[ .-]?|(?<![0-9+.-]))\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9]|[.-][0-9])",
}
_NEEDS = {
    ("email", "base"): lambda t: t.contains("@"),
    ("email", "loose"): lambda t: t.contains("dot") | t.contains("DOT") | t.contains("Dot"),
    ("phone", "base"): lambda t: t.contains("+"),
    ("ip", "loose"): lambda t: t.contains(":"),
}
_CONTEXT = {
    "email": "mail|contact|write|reach|address|e-post|correo|courriel",
    "ip": r"\bip\b|host|server|address|login|adresse|direcci",
    "card": "card|visa|master|amex|credit|payment|karte|carte|tarjeta",
    "phone": "phone|tel|call|fax|mobile|cell|whatsapp|contact|ruf",
}
_AGAINST = {
    "email": "version|commit|branch",
    "ip": r"version|section|chapter|release|\bv$",
    "card": r"isbn|order|invoice|serial|\bref|issn",
    "phone": r"isbn|order|invoice|serial|\bref|issn",
}
_TOP_LEVEL = "com|org|net|edu|gov|info|io|eu|de|fr|es|uk|it|nl|at|ch|be|us|ca|mx|ar|br|in|jp|cn|au"
_COUNTRY = "1|20|27|30|31|32|33|34|36|39|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58]"


def _total(part: Column) -> Column:
    return F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)


def _bound(value: Column, body) -> Column:
    """``body`` of a name for ``value``, which is computed once: the optimiser may put the
    definition of a column in place of its name, inside a lambda too, but not that of a
    lambda's variable."""
    return F.transform(F.array(value), body)[0]


def with_running(df: DataFrame, steps: str, out: str) -> DataFrame:
    """Adds running sums of an array column, in blocks of about the root of its length."""

    def whole(own: Column, block: Column) -> Column:
        blocks = F.sequence(F.lit(0), ((F.size(own) - 1) / block).cast("int"))
        sums = F.transform(blocks, lambda k: _total(F.slice(own, k * block + 1, block)))
        return _bound(sums, lambda s: _bound(before(s), lambda b: sum_at(own, block, b)))

    def before(sums: Column) -> Column:
        return F.transform(sums, lambda _, k: _total(F.slice(sums, 1, k)))

    def sum_at(own: Column, block: Column, before: Column) -> Column:
        return F.transform(
            own,
            lambda _, i: before[(i / block).cast("int")]
            + _total(F.slice(own, i - i % block + 1, i % block + 1)),
        )

    root = lambda own: F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(own)))).cast("int")
    running = _bound(F.col(steps), lambda own: _bound(root(own), lambda block: whole(own, block)))
    return df.withColumn(out, F.when(F.size(steps) > 0, running))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _passes(kind: str, match: Column) -> Column:
    """The check of a base match."""
    if kind == "ip":
        return F.forall(
            F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", "").rlike(r"^(\d\d?|1\d\d|2[0-4]\d|25[0-5])$")
        )
    digits = _digits(match)
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _vote(*rules: tuple[Column, int]) -> Column:
    """The vote of the first rule that holds; null counts as not holding."""
    found = F.lit(0)
    for condition, value in reversed(rules):
        found = F.when(condition, F.lit(value)).otherwise(found)
    return found


def _votes(kind: str, sort: str, m: Column, before: Column, after: Column) -> list[Column]:
    loose = sort == "loose"
    plain = m
    if kind == "email" and loose:
        plain = F.regexp_replace(m, r"(?i) ?(?:\(at\)|\[at\]| at ) ?", "@")
        plain = F.regexp_replace(plain, r"(?i) ?(?:\(dot\)|\[dot\]| dot ) ?", ".")
    digits = _digits(m)
    kinds_of_digit = F.size(F.array_distinct(F.split(digits, "")))
    if kind == "email":
        strict = plain.rlike(r"^[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9])?@[^.].*\.[A-Za-z]{2,24}$")
        form = _vote((strict, 1), (F.lit(True), -1))
        listed = _vote((plain.rlike(rf"(?i)\.(?:{_TOP_LEVEL})$"), 1))
        shape = _vote((F.length(m).between(6, 64), 1), (F.lit(True), -1))
    elif kind == "ip" and loose:
        groups = F.size(F.split(m, ":"))
        form = _vote((groups > 8, -1), (m.contains("::") | (groups == 8), 1), (F.lit(True), -1))
        listed = _vote((m.rlike("^(?i:[23][0-9a-f]{3}|f[cde][0-9a-f]{2}):"), 1), (F.lit(True), -1))
        shape = _vote((m.rlike("[A-Fa-f]") & (groups >= 4), 1), (groups < 4, -1))
    elif kind == "ip":
        form = _vote((m.rlike(r"(^|\.)0[0-9]"), -1), (F.lit(True), 1))
        listed = _vote((m.rlike(r"^0*(0|2[4-9]\d)\."), -1), (m.rlike(r"^(10|127|192\.168)\."), 0), (F.lit(True), 1))
        shape = _vote((m.rlike(r"[1-9][0-9]"), 1), (F.lit(True), -1))
    elif kind == "card":
        form = _vote((m.rlike(r"^[0-9]{15,16}$|^([0-9]{4}[ -]){3}[0-9]{4}$"), 1))
        if loose:
            form = _vote((F.call_function("luhn_check", digits), 1), (F.lit(True), -1))
        listed = _vote((digits.rlike("^(4|5[1-5]|2[2-7]|3[47]|6011|65)"), 1), (F.lit(True), -1))
        shape = _vote((kinds_of_digit >= 4, 1), (F.lit(True), -1))
    else:
        form = _vote((m.rlike(r"^\+[1-9][0-9]{0,2}[ (.-]|^\("), 1))
        listed = _vote((m.rlike(rf"^\+(?:{_COUNTRY})"), 1), (m.rlike(r"^\(?[01]|^\+") | F.lit(not loose), -1))
        shape = _vote((kinds_of_digit >= 3, 1), (F.lit(True), -1))
    context = _vote(
        (before.rlike(f"(?i){_AGAINST[kind]}"), -1),
        (before.rlike(f"(?i){_CONTEXT[kind]}"), 1),
        # a loose match without a word for it speaks against itself, if it is spelled out or national
        (~m.rlike(r"^\+|^[0-9A-Fa-f:]+$") & F.lit(loose), -1),
    )
    edges = _vote((before.rlike("[A-Za-z0-9@]$") | after.rlike("^[A-Za-z0-9@]|^[.][0-9]"), -1), (F.lit(True), 1))
    return [form, listed, context, edges, shape]


def _spans(df: DataFrame, text: str, kind: str, sort: str) -> DataFrame:
    """Adds a column kind_sort: the matches that pass, as (start, order, end, kind, cell)."""
    pattern, name = F.lit(PATTERNS[kind, sort]), f"__{kind}_{sort}"
    needs = _NEEDS.get((kind, sort), lambda t: t.rlike("[0-9]"))(F.col(text))
    none = F.array().cast("array<string>")
    df = df.withColumns(
        {
            f"{name}_m": F.when(needs, F.regexp_extract_all(text, pattern, F.lit(0))).otherwise(none),
            f"{name}_p": F.when(needs, F.split(text, PATTERNS[kind, sort], -1)).otherwise(none),
        }
    )
    m, p = F.col(f"{name}_m"), F.col(f"{name}_p")
    some = F.size(m) > 0
    steps = F.transform(
        m, lambda _, i: F.length(p[i]) + F.when(i > 0, F.length(F.get(m, i - 1))).otherwise(0)
    )
    df = df.withColumn(f"{name}_d", F.when(some, steps))
    df = with_running(df, f"{name}_d", f"{name}_s")
    s = F.col(f"{name}_s")

    def span(match: Column, i: Column) -> Column:
        before, after = F.right(p[i], F.lit(32)), F.left(p[i + 1], F.lit(8))
        size = F.least(F.lit(3), (F.length(match) / 8).cast("int"))
        votes = _votes(kind, sort, match, before, after)
        cell = F.concat_ws(",", F.lit(kind), F.lit(sort), *(v.cast("string") for v in votes), size.cast("string"))
        return F.struct(
            s[i].alias("start"),
            F.lit(KINDS.index(kind)).alias("order"),
            (s[i] + F.length(match)).alias("end"),
            F.lit(kind).alias("kind"),
            F.when(_passes(kind, match) if sort == "base" else F.lit(True), cell).alias("cell"),
        )

    empty = F.array().cast("array<struct<start:bigint,order:int,end:bigint,kind:string,cell:string>>")
    passed = F.filter(F.transform(m, span), lambda x: x["cell"].isNotNull())
    df = df.withColumn(name, F.when(some, passed).otherwise(empty))
    return df.drop(*(f"{name}_{x}" for x in "mpds"))


def with_candidates(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with base (sorted spans that pass) and loose (sorted further candidates that
    touch no base span)."""
    plain = df.withColumn("__text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    for kind, sort in PATTERNS:
        plain = _spans(plain, "__text", kind, sort)
    joined = {
        sort: F.array_sort(F.concat(*(F.col(f"__{k}_{s}") for k, s in PATTERNS if s == sort)))
        for sort in ("base", "loose")
    }
    plain = plain.withColumns(joined)
    apart = F.filter(
        "loose",
        lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])),
    )
    plain = plain.withColumn("loose", F.when(F.size("loose") > 0, apart).otherwise(F.col("loose")))
    return plain.drop("__text", *(f"__{k}_{s}" for k, s in PATTERNS))


# ---- labelers' reliabilities and the classifier ------------------------------


def cell_counts(candidates: DataFrame) -> dict[str, int]:
    """How many candidates each cell has, from the result of `with_candidates`."""
    # an outer explode: the optimiser would push the filter of an inner one, and with it the
    # whole search, below every step of the search
    cells = F.transform(F.concat("base", "loose"), lambda x: x["cell"])
    counts = candidates.select(F.explode_outer(cells).alias("cell")).groupBy("cell")
    found = counts.agg(F.count("*").alias("n")).collect()
    return {x.cell: x.n for x in found if x.cell is not None}


def posteriors(votes: dict[tuple[int, ...], int], rounds: int = 100) -> dict[tuple[int, ...], float]:
    """Probability that candidates of these votes are real, by expectation-maximisation over
    a two-class model in which each labeler has its own chances of each vote.

    The start, and one pseudo-candidate per labeler and vote, hold that labelers are right
    four times of five when they vote.
    """
    prior = 0.5
    believed = {True: {1: 0.6, 0: 0.25, -1: 0.15}, False: {1: 0.15, 0: 0.25, -1: 0.6}}
    chance = [{y: dict(believed[y]) for y in believed} for _ in range(LABELERS)]
    real: dict[tuple[int, ...], float] = {}
    for _ in range(rounds):
        for pattern in votes:
            odds = math.log(prior / (1 - prior))
            odds += sum(
                math.log(c[True][v] / c[False][v]) for c, v in zip(chance, pattern)
            )
            real[pattern] = 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))
        total = sum(votes.values())
        prior = (sum(n * real[p] for p, n in votes.items()) + 1) / (total + 2)
        for i in range(LABELERS):
            for y in (True, False):
                mass = {
                    v: 10 * believed[y][v]
                    + sum(n * (real[p] if y else 1 - real[p]) for p, n in votes.items() if p[i] == v)
                    for v in (1, 0, -1)
                }
                chance[i][y] = {v: m / sum(mass.values()) for v, m in mass.items()}
    return real


def classify(counts: dict[str, int]) -> dict[str, float]:
    """Probability of each cell, by naive Bayes over votes, sort and length trained per kind on
    the posteriors of the labelers' votes."""
    out = {}
    for kind in KINDS:
        cells = {c: tuple(c.split(",")[1:]) for c in counts if c.split(",")[0] == kind}
        if not cells:
            continue
        votes: dict[tuple[int, ...], int] = defaultdict(int)
        pattern = {c: tuple(int(v) for v in f[1:-1]) for c, f in cells.items()}
        for c, p in pattern.items():
            votes[p] += counts[c]
        real = posteriors(votes)
        mass: dict = defaultdict(lambda: 1.0)  # (feature, value, class), one pseudo-candidate each
        whole = {True: 1.0, False: 1.0}
        for c, features in cells.items():
            for y in (True, False):
                share = counts[c] * (real[pattern[c]] if y else 1 - real[pattern[c]])
                whole[y] += share
                for i, value in enumerate(features):
                    mass[i, value, y] += share
        kinds_of = [len({f[i] for f in cells.values()}) for i in range(LABELERS + 2)]
        for c, features in cells.items():
            odds = math.log(whole[True] / whole[False])
            for i, value in enumerate(features):
                odds += math.log(mass[i, value, True] / (whole[True] + kinds_of[i]))
                odds -= math.log(mass[i, value, False] / (whole[False] + kinds_of[i]))
            out[c] = 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))
    return out


def accepted(chances: dict[str, float], accept: float = ACCEPT) -> Column:
    """All spans, sorted: base, and the loose ones whose cell the classifier takes."""
    good = sorted(c for c, p in chances.items() if p >= accept and ",loose," in c)
    if not good:
        return F.col("base")
    taken = F.filter("loose", lambda x: x["cell"].isin(good))
    return F.array_sort(F.concat("base", taken))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    text = F.transform(
        spans,
        lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")),
    )
    return F.concat_ws(",", text)


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind; spans that overlap become one."""
    start = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).cast("long").alias("end"))

    def step(state: Column, x: Column) -> Column:
        gap = F.substring(text, (state["end"] + 1).cast("int"), (x["start"] - state["end"]).cast("int"))
        mark = F.concat(F.lit("<"), F.upper(x["kind"]), F.lit(">"))
        added = F.when(x["start"] >= state["end"], F.concat(state["parts"], F.array(gap, mark)))
        return F.struct(
            added.otherwise(state["parts"]).alias("parts"),
            F.greatest(state["end"], x["end"]).alias("end"),
        )

    def close(state: Column) -> Column:
        rest = F.substring(text, (state["end"] + 1).cast("int"), F.length(text))
        return F.concat(F.array_join(state["parts"], ""), rest)

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, close)).otherwise(text)


def redact(df: DataFrame, text_col: str = "text", accept: float = ACCEPT) -> DataFrame:
    """``df`` with the personal data of ``text_col`` replaced by marks; other columns stay."""
    columns = df.columns
    found = with_candidates(df.select(F.struct("*").alias("row"), F.col(text_col).alias("text")))
    chances = classify(cell_counts(found))
    text = redacted(F.col("text"), accepted(chances, accept))
    return found.select(
        *(text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in columns)
    )
