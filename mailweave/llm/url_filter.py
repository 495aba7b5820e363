"""URL filter: listed rules first, gradient-boosted trees on lexical features for the rest.

Everything is DataFrame expressions. A URL's features are its lengths, depth, labels, digits,
entropy, parameters, hyphens and the share of its suffix's labelled URLs that are blocked (the
suffix is the last label of the host; how many URLs it has would only tell which suffix it is,
and teach nothing about suffixes without labels). Every feature is put in bins by rule, not by
quantiles, so labelled URLs with the same bins are one training cell with two counts, whatever
their number, and results do not depend on how the rows are dealt.

A boosting round sums gradients and second derivatives by node, feature and bin over the cells;
that histogram, at most `2 ** (DEPTH - 1) x features x bins` rows, comes to the driver, which
picks the best split of each node. Gradients are whole numbers (of `UNIT` parts), so sums are
exact in any order. The trees become one expression that the prediction applies to all rows.

Trained on all labelled URLs; nothing is sampled. Both labels weigh the same in sum, since the
rules say nothing about how many of the other URLs are to be blocked.

Defined cases: a null URL and one without "://" have an empty host and path, fit no rule and are
judged by the features of their text (null as empty); repeated rows are judged each and count
each; of rules of equal length the one with the longer host wins, then block; without labelled
URLs, or with one label alone, there are no trees: the label that there is decides, else allow; an empty table gives no rows; other columns are kept by
`judge` under ``row``. URLs of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailweave.llm.common import removed, written

# Production parameters of the model.
ROUNDS, DEPTH, RATE, REGULAR = 12, 3, 0.4, 1.0
#: Fewest second derivatives' sum on each side of a split, in rows of probability one half.
LEAST = 4
#: Parts of one, for exact sums.
UNIT = 1 << 20

# Which letters are lower-cased in a host.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

FEATURES = [
    "url_length", "host_length", "path_length", "depth", "labels", "hyphens", "digit_ratio",
    "host_digit_ratio", "entropy", "host_entropy", "parameters", "suffix_blocked",
]


@dataclass(frozen=True)
class Rule:
    """A host with all its subdomains and the start of a path."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path: up to "/", "?", "#" or the end after the first "://"; then up to "?", "#" or end."""
    pattern = "(?s)^.*?://([^/?#]*+)([^?#]*+)"
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, pattern, 1), UPPER, LOWER), F.regexp_extract(text, pattern, 2)


def matched(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct of ``rule, verdict``, else null.

    The rules are a literal of the plan: a list of bounded size, not a table.
    """
    order = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.verdict != "block"))

    def fits(rule: Rule) -> Column:
        own = (host == rule.host) | host.endswith("." + rule.host)
        return own & path.startswith(rule.path)

    none = F.lit(None).cast("struct<rule: string, verdict: string>")
    cases = [
        (fits(r), F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))) for r in order
    ]
    if not cases:
        return none
    return reduce(lambda when, case: when.when(*case), cases[1:], F.when(*cases[0])).otherwise(none)


def _entropy(text: Column) -> Column:
    """Bits per code point; runs of the sorted letters are the counts."""
    letters = F.array_join(F.array_sort(F.split(text, "")), "")
    runs = F.regexp_extract_all(letters, F.lit(r"(?s)(.)\1*+"), F.lit(0))
    total = F.length(text).cast("double")
    return F.aggregate(
        F.transform(runs, lambda run: F.length(run) / total),
        F.lit(0.0),
        lambda sum_, share: sum_ - share * F.log2(share),
    )


def _count(text: Column, letters: str) -> Column:
    """How many code points of a text are in a class."""
    return F.length(text) - F.length(F.regexp_replace(text, f"[{letters}]", ""))


def _share(part: Column, text: Column) -> Column:
    return F.when(F.length(text) > 0, part / F.length(text)).otherwise(F.lit(0.0))


def _wide(number: Column) -> Column:
    """Bin of a number without bound: four bins each time it doubles. What is added keeps exact
    powers out of the hands of rounding."""
    return F.floor(4 * F.log2(number + 1) + 1e-9).cast("int")


def _narrow(number: Column, steps: int) -> Column:
    return F.floor(steps * number + 1e-9).cast("int")


def suffix_counts(urls: DataFrame) -> DataFrame:
    """``suffix, suffix_blocked`` of every suffix of ``urls`` (url, label).

    The share of blocked ones is smoothed by one allowed and one blocked URL.
    """
    host, _ = parts(F.col("url"))
    blocked, labelled = F.count_if(F.col("label") == 1), F.count("label")
    return urls.groupBy(F.substring_index(host, ".", -1).alias("suffix")).agg(
        _narrow((blocked + 1) / (labelled + 2), 32).alias("suffix_blocked"),
    )


def binned(urls: DataFrame, suffixes: DataFrame) -> DataFrame:
    """``urls`` with ``host, path`` and the bin of every feature.

    Both sides of the join by suffix are tables, so one suffix with most URLs is split.
    """
    host, path = parts(F.col("url"))
    split = urls.select("*", host.alias("host"), path.alias("path"), F.coalesce("url", F.lit("")).alias("text"))
    host, path, text = F.col("host"), F.col("path"), F.col("text")
    query = F.regexp_extract(text, r"(?s)^[^?#]*+\?([^#]*+)", 1)
    values = {
        "url_length": _wide(F.length(text)),
        "host_length": _wide(F.length(host)),
        "path_length": _wide(F.length(path)),
        "depth": _wide(_count(path, "/")),
        "labels": _wide(_count(host, ".")),
        "hyphens": _wide(_count(host, "-")),
        "digit_ratio": _narrow(_share(_count(text, "0-9"), text), 32),
        "host_digit_ratio": _narrow(_share(_count(host, "0-9"), host), 32),
        "entropy": _narrow(F.coalesce(_entropy(text), F.lit(0.0)), 8),
        "host_entropy": _narrow(F.coalesce(_entropy(host), F.lit(0.0)), 8),
        "parameters": _wide(F.when(query == "", 0).otherwise(1 + _count(query, "&"))),
    }
    named = split.select(
        *urls.columns, "host", "path", F.substring_index(host, ".", -1).alias("suffix"),
        *(value.alias(name) for name, value in values.items()),
    )
    return named.join(suffixes, "suffix", "left").drop("suffix")


@dataclass(frozen=True)
class Split:
    """Rows with a bin up to ``bin`` go left."""

    feature: str
    bin: int
    left: Split | float
    right: Split | float


@dataclass(frozen=True)
class Model:
    """Trees, and the whole-numbered weights of allowed and blocked rows."""

    start: float
    trees: tuple[Split, ...] = ()
    allowed: int = 1
    blocked: int = 1


def _tree(node: Split | float) -> Column:
    if not isinstance(node, Split):
        return F.lit(float(node))
    return F.when(F.col(node.feature) <= node.bin, _tree(node.left)).otherwise(_tree(node.right))


def score(model: Model) -> Column:
    """Log-odds that a URL with the bins of `binned` is to be blocked."""
    return reduce(Column.__add__, map(_tree, model.trees), F.lit(model.start))


def cells(labelled: DataFrame) -> DataFrame:
    """Labelled URLs by their bins: ``n`` rows, ``n_blocked`` of them with label 1."""
    return labelled.groupBy(*FEATURES).agg(
        F.count("*").alias("n"), F.sum("label").cast("long").alias("n_blocked")
    )


Histogram = dict[int, dict[str, list[tuple[int, int, int]]]]


def _histogram(table: DataFrame, model: Model, node: Column, first: int) -> Histogram:
    """Of the nodes from ``first`` on, by feature: (bin, gradient, second derivative) in ``UNIT`` parts."""
    chance = F.round(UNIT / (1 + F.exp(-score(model)))).cast("long")
    known = table.select(*FEATURES, "n", "n_blocked", node.alias("node"), chance.alias("p"))
    spread = F.expr(f"p * ({UNIT} - p) div {UNIT}")
    known = known.where(F.col("node") >= first).select(
        "node",
        ((F.col("n") - F.col("n_blocked")) * F.col("p")).alias("g0"),
        (F.col("n_blocked") * (F.col("p") - UNIT)).alias("g1"),
        ((F.col("n") - F.col("n_blocked")) * spread).alias("h0"),
        (F.col("n_blocked") * spread).alias("h1"),
        F.inline(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).alias("bin")) for f in FEATURES))),
    )
    # nodes x features x bins: bounded by the parameters, whatever the rows
    sums = known.groupBy("node", "feature", "bin").agg(*(F.sum(c).alias(c) for c in ("g0", "g1", "h0", "h1")))
    found: Histogram = {}
    for r in sums.collect():
        both = (model.allowed * r.g0 + model.blocked * r.g1, model.allowed * r.h0 + model.blocked * r.h1)
        found.setdefault(r.node, {}).setdefault(r.feature, []).append((r.bin, *both))
    return found


def _weight(g: int, h: int) -> float:
    return -RATE * (g / UNIT) / (h / UNIT + REGULAR)


def best_split(bins: dict[str, list[tuple[int, int, int]]]) -> tuple[str, int, float, float] | None:
    """Feature and bin of largest gain, and the weights of both sides.

    Ties go to the first feature, then to the lower bin.
    """
    best, place = 0.0, None
    value = lambda g, h: (g / UNIT) ** 2 / (h / UNIT + REGULAR)
    for feature in FEATURES:
        rows = sorted(bins[feature])
        all_g, all_h = sum(g for _, g, _ in rows), sum(h for _, _, h in rows)
        g, h = 0, 0
        for bin_, more_g, more_h in rows[:-1]:
            g, h = g + more_g, h + more_h
            if min(h, all_h - h) < LEAST * UNIT // 4:
                continue
            gain = value(g, h) + value(all_g - g, all_h - h) - value(all_g, all_h)
            if gain > best + 1e-9:
                best, place = gain, (feature, bin_, _weight(g, h), _weight(all_g - g, all_h - h))
    return place


def _grown(splits: dict[int, tuple[str, int, float, float]], node: int = 1) -> Split:
    """Nodes are numbered as in a heap: the children of i are 2 i and 2 i + 1."""
    feature, bin_, *weights = splits[node]
    sides = [_grown(splits, child) if child in splits else w for child, w in zip((2 * node, 2 * node + 1), weights)]
    return Split(feature, bin_, *sides)


def _node(splits: dict[int, tuple[str, int, float, float]], node: int = 1) -> Column:
    """The node without a split that a row reaches."""
    if node not in splits:
        return F.lit(node)
    feature, bin_ = splits[node][:2]
    return F.when(F.col(feature) <= bin_, _node(splits, 2 * node)).otherwise(_node(splits, 2 * node + 1))


def boost(table: DataFrame, rounds: int = ROUNDS, depth: int = DEPTH) -> Model:
    """Fit on `cells`; one job per level of a tree."""
    every, blocked = table.agg(F.sum("n"), F.sum("n_blocked")).first()
    if not every or blocked in (0, every):
        return Model(1.0 if every and blocked else -1.0)
    # the rarer label weighs as much as the other one, up to a whole factor
    ratio = (every - blocked) / blocked
    model = Model(0.0, (), max(1, round(1 / ratio)), max(1, round(ratio)))
    for _ in range(rounds):
        splits: dict[int, tuple[str, int, float, float]] = {}
        for level in range(depth):
            open_ = _histogram(table, model, _node(splits), 2**level)
            found = {node: place for node, bins in open_.items() if (place := best_split(bins))}
            splits |= found
            if not found:
                break
        if not splits:
            break
        model = replace(model, trees=(*model.trees, _grown(splits)))
    return model


def judge(urls: DataFrame, rules: Sequence[Rule], rounds: int = ROUNDS) -> DataFrame:
    """``row, host, path, rule, score, verdict`` of every row of ``urls``, which has a ``url``.

    The URLs that a rule decides are the labelled ones of which the trees learn.
    """
    host, path = parts(F.col("url"))
    known = urls.select(F.struct(*urls.columns).alias("row"), "url").select(
        "row", "url", matched(host, path, rules).alias("decided")
    )
    label = F.when(F.col("decided").isNotNull(), (F.col("decided.verdict") == "block").cast("int"))
    known = known.withColumn("label", label)
    suffixes = written(suffix_counts(known.select("url", "label")), "suffixes")
    labelled = known.where(F.col("label").isNotNull()).select("url", "label")
    table = written(cells(binned(labelled, suffixes)), "cells")
    model = boost(table, rounds)
    removed(table)
    judged = binned(known, suffixes).withColumn("score", score(model))
    method = F.when(F.col("score") > 0, "block").otherwise("allow")
    return judged.select(
        "row", "host", "path", "decided.rule", "score", F.coalesce("decided.verdict", method).alias("verdict")
    )
