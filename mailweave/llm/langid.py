"""Language identification by interpolated Kneser-Ney character models.

Each language has a character model of order `ORDER` over lower-case words (runs of
letters) with a mark at either end; contexts do not reach over words, so a word has one
score. The models are sorted arrays of hashes with their values: discounted probabilities
per n-gram, and back-off weights per context. A text gets the language of least cross-entropy
per character. Its score is a softmax over the languages whose sharpness is calibrated, and it
is rejected where its entropy lies too far above the language's mean; for both, a fifth of the
sample is kept out of the counts. The limit lies halfway between what the held-out texts have
and what they have once their letters are shuffled, which are the language's letters and not
the language; for short texts, whose entropies vary, it is higher.

The models are fitted on a bounded sample: the ``per_language`` texts of each language that come
first by a hash (the documented bound of `fit`). Texts are counted once however many copies they
have, so copies neither crowd a sample nor enlarge it, and the driver holds the words of that
many texts at most, and one row of numbers for each held-out one. Every text is classified
whole, by all its words.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and rejected;
languages of equal cross-entropy are taken by name; null languages are not learned from;
equal texts are classified alike; without any labelled text every text is ``und``; an empty
table gives an empty table. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailweave.llm.common import by_slices, claim, removed, slices, written

ORDER = 5
UNKNOWN = "und"
#: Chance of a character that a language has never shown.
FLOOR = 2.0**-16
#: Share of held-out texts below, and of shuffled ones above, the quantiles between which the
#: rejection's limit lies; and how many times as much as they a text may vary.
HELD, ROOM = 0.995, 2.0
#: Words a worker remembers the scores of, and the longest of them.
REMEMBERED, LONGEST = 250_000, 64
_STEP = np.uint64(0x9E3779B97F4A7C15)
_START, _END = 2, 3

_general = regex.compile(r"\p{L}+").findall
_other = re.compile(r"[^\t-\r -~à-öø-ſ]").search
_latin = re.compile(r"[A-Za-zà-öø-ſ]+").findall


def words_of(text: str) -> list[str]:
    lower = text.lower()
    return _general(lower) if _other(lower) else _latin(lower)


def _codes(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words with their marks, and each one's place in its word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    joined = "".join(f"\x02{word}\x03" for word in words)
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    starts = np.cumsum(sizes) - sizes
    return codes, np.arange(len(codes)) - np.repeat(starts, sizes)


def _grams(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of the 1, 2, ... characters that end at each place."""
    hashes = np.zeros(len(codes), np.uint64)
    while True:
        before = np.concatenate((np.zeros(1, np.uint64), hashes[:-1]))
        hashes = codes + _STEP * before
        yield hashes


@dataclass
class Model:
    """One language: for each order, sorted n-grams and contexts with their values."""

    grams: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    contexts: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)

    @classmethod
    def fit(cls, counts: dict[str, int]) -> Model:
        words = sorted(counts)
        codes, place = _codes(words)
        times = np.repeat([counts[w] for w in words], [len(w) + 2 for w in words])
        orders = [h for h, _ in zip(_grams(codes), range(ORDER))]
        model = cls()
        for k in range(1, ORDER + 1):
            at = np.flatnonzero((place >= k - 1) & (place >= 1))
            gram, first, same = np.unique(orders[k - 1][at], return_index=True, return_inverse=True)
            count = np.bincount(same, times[at])
            if k < ORDER:
                # a lower order counts the characters it was seen after; at a word's start,
                # where nothing can stand before, it counts occurrences
                longer = np.flatnonzero((place >= k) & (place >= 1))
                _, one = np.unique(orders[k][longer], return_index=True)
                suffix = np.searchsorted(gram, orders[k - 1][longer[one]])
                kinds = np.bincount(suffix, minlength=len(gram))
                count = np.where(place[at[first]] == k - 1, count, kinds)
            ones, twos = (count == 1).sum(), (count == 2).sum()
            discount = ones / (ones + 2 * twos) if ones else 0.5
            discount = min(max(discount, 0.1), 0.9)
            before = at[first] - 1
            context = orders[k - 2][before] if k > 1 else np.zeros(len(gram), np.uint64)
            contexts, which = np.unique(context, return_inverse=True)
            total = np.bincount(which, count)
            kinds = np.bincount(which, count > 0)
            value = np.maximum(count - discount, 0) / total[which]
            model.grams.append((gram, value.astype(np.float32)))
            model.contexts.append((contexts, (discount * kinds / total).astype(np.float32)))
        return model

    @staticmethod
    def _find(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, missing: float):
        known, values = table
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.where(known[at] == keys, values[at], np.float32(missing))

    def bits(self, codes: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Cross-entropy of each character, 0 for the marks at the start of words."""
        chance = np.full(len(codes), FLOOR)
        shorter = np.zeros(len(codes), np.uint64)
        for k, grams in zip(range(1, ORDER + 1), _grams(codes)):
            at = np.flatnonzero((place >= k - 1) & (place >= 1))
            context = shorter[at - 1] if k > 1 else np.zeros(len(at), np.uint64)
            weight = self._find(self.contexts[k - 1], context, 1.0)
            chance[at] = self._find(self.grams[k - 1], grams[at], 0.0) + weight * chance[at]
            shorter = grams
        return np.where(place >= 1, -np.log2(chance), 0.0)


@dataclass
class Identifier:
    """Models of all languages with the figures for scores and rejection."""

    languages: list[str]
    models: list[Model]
    #: Bits per character of held-out texts: their mean, how far above it the limit lies, and the
    #: quantile of what they have above it times the root of the characters.
    mean: np.ndarray
    above: np.ndarray
    varying: np.ndarray
    sharpness: float = 0.05

    def __post_init__(self):
        self._place: dict[str, int] = {}
        self._scores = np.zeros((0, len(self.models)))

    forget = __post_init__

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("_place", "_scores")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def _of_words(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros((0, len(self.models)))
        codes, place = _codes(words)
        starts = np.flatnonzero(place == 0)
        return np.stack([np.add.reduceat(m.bits(codes, place), starts) for m in self.models], axis=1)

    def entropies(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character of each text in each language, and characters counted."""
        rows = [words_of(text) for text in texts]
        new = list(set().union(*rows).difference(self._place))
        scores = np.concatenate((self._scores, self._of_words(new)))
        kept = len(self._scores)
        self._place.update((w, kept + i) for i, w in enumerate(new))
        look = self._place.__getitem__
        counts = np.array([len(row) for row in rows])
        index = np.fromiter((look(w) for row in rows for w in row), np.int64, counts.sum())
        size = np.array([sum(map(len, row)) + len(row) for row in rows], np.int64)
        bits = np.zeros((len(rows), len(self.models)))
        full = np.flatnonzero(counts)
        if len(full):
            starts = (np.cumsum(counts) - counts)[full]
            bits[full] = np.add.reduceat(scores[index], starts, axis=0)
        # the first words met stay, as long as there is room
        stay = max(0, REMEMBERED - kept)
        for i, word in enumerate(new):
            if i >= stay or len(word) > LONGEST:
                del self._place[word]
        self._scores = scores[: kept + min(stay, len(new))]
        return bits / np.maximum(size, 1)[:, None], size

    def predict(self, texts: Sequence[str | None]) -> list[tuple[str, float, float, bool]]:
        """(language, score, bits per character, rejected) of each text."""
        given = [text or "" for text in texts]
        if not self.languages:
            return [(UNKNOWN, 0.0, 0.0, True)] * len(given)
        bits, size = self.entropies(given)
        best = bits.argmin(axis=1)
        least = bits[np.arange(len(bits)), best]
        gap = (bits - least[:, None]) * (self.sharpness * size)[:, None]
        score = 1 / np.exp2(-np.minimum(gap, 1000)).sum(axis=1)
        varying = self.varying[best] / np.sqrt(np.maximum(size, 1))
        limit = self.mean[best] + np.maximum(self.above[best], ROOM * varying)
        return [
            (self.languages[b], float(s), float(h), bool(h > m)) if n else (UNKNOWN, 0.0, 0.0, True)
            for b, s, h, m, n in zip(best, np.round(score, 6), least, limit, size)
        ]

    def calibrate(
        self, bits: np.ndarray, shuffled: np.ndarray, size: np.ndarray, truth: Sequence[str]
    ) -> None:
        """Set the rejection's figures and the sharpness from `entropies` of labelled texts that
        were not counted, as they are and shuffled."""
        index = {name: i for i, name in enumerate(self.languages)}
        pairs = [(i, index[name]) for i, name in enumerate(truth) if name in index and size[i]]
        rows, right = np.array(pairs, np.int64).reshape(-1, 2).T
        for i in range(len(self.languages)):
            own = rows[right == i]
            if len(own):
                h, n = bits[own, i], size[own]
                self.mean[i] = (h * n).sum() / n.sum()
                more = np.maximum(h - self.mean[i], 0)
                fewest = np.quantile(shuffled[own, i] - self.mean[i], 1 - HELD)
                most = np.quantile(more, HELD)
                self.above[i] = (most + max(most, fewest)) / 2
                self.varying[i] = np.quantile(more * np.sqrt(n), HELD)
        if len(rows):
            def loss(sharpness: float) -> float:
                scaled = -bits[rows] * (sharpness * size[rows])[:, None]
                top = scaled.max(axis=1)
                every = top + np.log2(np.exp2(scaled - top[:, None]).sum(axis=1))
                return float((every - scaled[np.arange(len(rows)), right]).mean())

            self.sharpness = min((2.0**-i for i in range(1, 9)), key=loss)


def sample(rows: DataFrame, per_language: int) -> DataFrame:
    """(lang, text, apart) of the ``per_language`` distinct texts of each language that come first
    by their hash; a fifth of them is apart."""
    hashed = rows.withColumn("h", F.xxhash64("text"))
    # a task keeps its own first hashes before the shuffle, so a common language is no large group
    order = Window.partitionBy("lang").orderBy(F.xxhash64("h"), "h")
    first = hashed.select("lang", "h").distinct().withColumn("place", F.row_number().over(order))
    # per_language rows for each language at most
    first = first.where(F.col("place") <= per_language).drop("place")
    chosen = hashed.join(F.broadcast(first), ["lang", "h"])
    once = chosen.groupBy("lang", "h").agg(F.any_value("text").alias("text"))
    return once.select("lang", "text", (F.pmod(F.xxhash64("h", F.lit(1)), F.lit(5)) == 0).alias("apart"))


def fit(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = 1500
) -> Identifier:
    """Fit on at most ``per_language`` distinct texts of each language that ``df`` labels.

    The driver receives the distinct words of four fifths of that sample with their
    counts, and the entropies of the other fifth.
    """
    rows = df.select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    drawn = written(sample(rows, per_language), "sample")
    counted = drawn.where(~F.col("apart")).select("lang", "text").mapInArrow(
        _count_words, "lang string, word string, n long"
    )
    words: dict[str, dict[str, int]] = {}
    totals = counted.groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow()
    for lang, word, n in zip(*(column.to_pylist() for column in totals.columns)):
        words.setdefault(lang, {})[word] = n
    languages = sorted(words)
    figures = (np.full(len(languages), value) for value in (4.0, 4.0, 0.0))
    found = Identifier(languages, [Model.fit(words[name]) for name in languages], *figures)
    if languages:
        apart = drawn.where("apart").select("text", "lang").mapInArrow(
            _entropies(df, found), "lang string, bits array<double>, shuffled array<double>, size long"
        )
        apart = apart.toArrow()
        table = lambda name: np.array(apart.column(name).to_pylist(), np.float64).reshape(-1, len(languages))
        truth = apart.column("lang").to_pylist()
        found.calibrate(table("bits"), table("shuffled"), apart.column("size").to_numpy(), truth)
    removed(drawn)
    return found


def shuffled_letters(text: str) -> str:
    """A text's words with all their letters in another order, the same for the same text."""
    words = words_of(text)
    letters = np.array(list("".join(words)), "U1")
    order = np.random.default_rng(len(letters)).permutation(len(letters))
    mixed, at = "".join(letters[order]), 0
    out = []
    for word in words:
        out.append(mixed[at : at + len(word)])
        at += len(word)
    return " ".join(out)


def _entropies(df: DataFrame, identifier: Identifier):
    shared = df.sparkSession.sparkContext.broadcast(identifier)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 0):
            claim("langid", shared.value.forget)
            texts = part.column(0).to_pylist()
            bits, size = shared.value.entropies(texts)
            shuffled, _ = shared.value.entropies(list(map(shuffled_letters, texts)))
            tables = [pa.array(x.tolist(), pa.list_(pa.float64())) for x in (bits, shuffled)]
            yield pa.RecordBatch.from_arrays(
                [part.column(1), *tables, pa.array(size)], names=["lang", "bits", "shuffled", "size"]
            )

    return run


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, 1):
        counts: dict[str, Counter] = {}
        for lang, text in zip(*(column.to_pylist() for column in part.columns)):
            counts.setdefault(lang, Counter()).update(words_of(text))
        rows = [(lang, word, n) for lang, own in counts.items() for word, n in own.items()]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*rows)], names=["lang", "word", "n"]
            )


def identify(
    df: DataFrame,
    identifier: Identifier,
    text_col: str = "text",
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """The ``keep`` columns, lang_pred, score, bits (per character) and rejected."""
    shared = df.sparkSession.sparkContext.broadcast(identifier)

    def work(part: pa.RecordBatch) -> pa.Array:
        claim("langid", shared.value.forget)
        found = zip(*shared.value.predict(part.column(0).to_pylist()))
        return pa.StructArray.from_arrays(
            [pa.array(c, f.type) for c, f in zip(found, _FOUND)], fields=list(_FOUND)
        )

    run = by_slices(work, _FOUND)

    # Only texts go to Python; a filter must not have them judged a second time.
    @F.arrow_udf("lang_pred string, score double, bits double, rejected boolean")
    def judge(texts: pa.Array) -> pa.Array:
        return run(texts)

    found = judge.asNondeterministic()(F.col(text_col).cast("string"))
    named = df.select(*keep, found.alias("__found"))
    return named.select(*keep, "__found.*")


_FOUND = pa.struct(
    [("lang_pred", pa.string()), ("score", pa.float64()), ("bits", pa.float64()), ("rejected", pa.bool_())]
)
