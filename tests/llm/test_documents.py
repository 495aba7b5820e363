"""PII, line rules, language identification and SimHash against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from mailweave.llm import langid, pii, quality_lines, simhash

# ---- personal data ----------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def test_a_long_text_full_of_numbers(spark, tmp_path):
    """Tens of thousands of matches in one text: sums up to each are computed once."""
    text = " ".join(f"the {i} and of {i * i % 7919} in" for i in range(12_000)) + " at 10.1.2.3 or +1 415 555 2671."
    spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    row = pii.with_candidates(spark.read.parquet(str(tmp_path / "t"))).head()
    assert [(x.kind, text[x.start : x.end]) for x in row.base] == [("ip", "10.1.2.3"), ("phone", "+1 415 555 2671")]


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _base(text):
    out = []
    for order, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and _luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), order, m.end(), kind))
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(out))


def _pii_texts():
    rng = random.Random(4)
    parts = (
        "a@b.co|x.y@z-1.org.uk|1.2.3.4|255.255.255.256|001.2.3.4|4111 1111 1111 1111|"
        "4111-1111-1111-1111|4026083977531332|+1 (743) 555-3824|+49 30 1234567|"
        "a@b.c@d.e|1.2.3.4.5.6.7.8|+1+2 333 444 5555|😀|é|   |a@b|5105105105105100|"
        "a@b.co_x@c.de|..|+1 4111111111111111"
    ).split("|")
    out = [
        "".join(
            rng.choice(parts) if rng.random() < 0.5 else rng.choice("aA1 9.@-+()x0é漢😀_%,\n4")
            for _ in range(rng.randint(0, 12))
        )
        for _ in range(400)
    ]
    return [*out, "a@b.co " * 500, "1 " * 2000, "+1" + " " * 2000 + "2", "1." * 2000, "a@b" + ".a" * 2000]


def test_base_spans_equal_brute_force(spark):
    texts = [*_pii_texts(), None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = pii.with_candidates(df).select("doc_id", pii.listed(F.col("base")).alias("spans"))
    for row in found.collect():
        assert row.spans == _base(texts[row.doc_id] or "")


def test_long_runs_are_linear(spark):
    texts = ["a" * 300_000, "1" * 300_000, "+" * 100_000, "1 " * 100_000, "a." * 100_000]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    assert pii.with_candidates(df).select(F.size("base")).collect() == [(0,)] * 5


def test_loose_spans_are_added_and_redacted(spark):
    rows = [(i, f"contact joe{i} at corp dot com or call (743) 555-38{i:02}, mail a{i}@b.org now") for i in range(60)]
    rows += [(100, "clean text, 3 words at home"), (101, None), (102, "order 555-123 4567 x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("base", F.lit("mine"))
    found = {r.doc_id: r for r in pii.redact(df).collect()}
    assert found[7].text == "contact <EMAIL> or call <PHONE>, mail <EMAIL> now"
    assert found[7].base == "mine"
    assert found[100].text == rows[60][1] and found[101].text is None and found[102].text == rows[62][1]
    assert pii.redact(df.limit(0)).count() == 0


def test_labelers_are_weighed_by_agreement():
    votes = {(1, 1, 1, 1, -1): 60, (-1, -1, -1, -1, 1): 40, (1, 1, 1, -1, 1): 3}
    real = pii.posteriors(votes)
    assert real[1, 1, 1, 1, -1] > 0.95 and real[-1, -1, -1, -1, 1] < 0.05


def test_overlapping_spans_become_one_mark(spark):
    df = spark.createDataFrame([("x 4111111111111111@b.co y 1.2.3.4@b.co",)], "text string")
    text = pii.redacted(F.col("text"), F.col("base"))
    assert pii.with_candidates(df).select(text.alias("t")).head().t == "x <EMAIL> y <EMAIL>"


# ---- line rules -------------------------------------------------------------


def _repeated(words):
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    return len(covered)


def test_repeated_words_equal_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        words = [rng.choice("abc") for _ in range(rng.randrange(30))]
        assert quality_lines.repeated_words(words) == _repeated(words)


@pytest.mark.parametrize(
    "line, fails",
    [
        ("A plain sentence, with a comma.", False),
        ("For&&& the*** thing### is.", True),
        ("Home | About | Contact | Help", True),
        ("home login", True),
        ("We go home to the top.", False),
        ("This site uses cookies to work.", True),
        ("Wow!! That was one long and good day.", False),
        ("A | B said that all of the others went away.", False),
    ],
)
def test_line_rules(line, fails):
    assert quality_lines.line_fails(line, line.split()) is fails


def test_line_cleaning_table(spark):
    good = "One two three four five six seven eight nine ten.\n"
    lines = "".join(f"Line {i} has the words a{i} b{i} c{i}.\n" for i in range(20))
    rows = [(1, lines, 1), (2, lines + "x!! y!! z!!\n", 2), (3, "x!! y## z$$\n" * 30 + lines, 3)]
    rows += [(4, None, 4), (5, "", 5), (6, good * 9, 6), (1, lines, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    found = sorted(quality_lines.clean_lines(df).collect(), key=lambda r: (r.doc_id, r.n_words))
    assert [r.kept for r in found] == [True, True, True, False, False, False, False]
    assert found[2].cleaned == lines and found[2].n_lines_removed == 1
    assert [r.base_failed for r in found] == [False, False, False, True, True, True, True]
    assert found[6].n_dup_lines == 8
    assert quality_lines.clean_lines(df.limit(0)).count() == 0


# ---- languages --------------------------------------------------------------


def test_probabilities_sum_to_one():
    model = langid.Model.fit(Counter("the then there other bother mother them this that".split()))
    letters = sorted(set("thenrobmisa"))
    for context in ("", "t", "th", "the", "zz"):
        total = 0.0
        for c in letters:
            codes, place = langid._codes([context + c])
            total += 2 ** -model.bits(codes, place)[len(context) + 1]
        codes, place = langid._codes([context])
        total += 2 ** -model.bits(codes, place)[len(context) + 1]
        codes, place = langid._codes([context + "q"])
        unseen = 1 / langid.FLOOR - len(letters) - 1
        total += unseen * 2 ** -model.bits(codes, place)[len(context) + 1]
        assert total == pytest.approx(1, abs=1e-5)


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    found = langid.fit(docs.where(~held), per_language=50)
    rows = langid.identify(docs.where(held), found, keep=["doc_id", "lang"]).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.95
    assert not any(r.rejected for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edge_cases(spark):
    learn = [("the cat and the dog went to the house " * 3 + str(i), "en") for i in range(20)]
    learn += [("der hund und die katze gehen in das haus " * 3 + str(i), "de") for i in range(20)]
    learn += [(None, "en"), ("no language", None)]
    table = spark.createDataFrame(learn, "text string, lang string")
    found = langid.fit(table)
    rows = [(1, None), (2, "12 34 !"), (3, "the dog"), (3, "the dog"), (4, "漢字かな" * 20), (5, "dog " * 90_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x"))
    out = sorted(langid.identify(df, found).collect(), key=lambda r: r.doc_id)
    assert [r.lang_pred for r in out][:4] == ["und", "und", "en", "en"] and out[5].lang_pred == "en"
    assert [r.rejected for r in out] == [True, True, False, False, True, False]
    assert out[0].score == 0
    none = langid.fit(table.where("lang = 'xx'"))
    assert {r.lang_pred for r in langid.identify(df, none).collect()} == {"und"}
    assert langid.identify(df.limit(0), found).count() == 0


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def test_classifier_adds_what_base_patterns_miss_and_refuses_decoys(spark):
    """Cards side by side and phones that run into an address are no base spans; with enough plain
    ones and decoys to learn from, the real ones are added and the decoys are not."""
    rng = random.Random(3)

    def card(real, first="4"):
        while True:
            digits = first + "".join(rng.choices("0123456789", k=15))
            if _luhn(digits) == real:
                return digits

    phone = lambda: f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
    ip = lambda: ".".join(str(rng.randrange(11, 220)) for _ in range(4))
    rows, real, decoys = [], {}, {}
    for i in range(400):
        form, filler = i % 8, " ".join(rng.choices(["lorem", "ipsum", "dolor", "sit"], k=6))
        if form == 0:
            text = f"{filler} {card(True)} {filler}"
        elif form == 1:
            text = f"{filler} {phone()} {filler}"
        elif form == 2:
            decoys[i] = card(False, rng.choice("178"))
            text = f"{filler} {decoys[i]} {filler}"
        elif form == 3 and i % 5 == 3:
            one, two = card(True), card(True)
            real[i], text = [one, two], f"{filler} {one} {two} {filler}"
        elif form == 4 and i % 5 == 4:
            real[i] = [phone()]
            text = f"{filler} {real[i][0]} {ip()} {filler}"
        elif form == 5:
            text = f"{filler} {ip()} {filler}"
        else:
            text = filler
        rows.append((i, text))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = pii.with_candidates(df).cache()
    spans = pii.accepted(pii.classify(pii.cell_counts(found)))
    added = F.transform(F.array_except(spans, "base"), lambda x: F.substring("text", (x["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int")))
    got = {r.doc_id: r.added for r in found.select("doc_id", added.alias("added")).collect() if r.added}
    assert len(real) >= 10 and got == real
    assert not set(got) & set(decoys)


def test_loose_candidates_of_every_kind(spark):
    texts = {
        "email": "write to joe at corp dot org", "ip": "host 2001:db8:85a3:0:0:8a2e:370:7334 or fe80::1:2ff now 12:30:45",
        "card": "1234567890123456 9999-8888-7777-6666", "phone": "call 555-123 or (415) 555-2671, 212.555.0100.",
    }
    df = spark.createDataFrame(list(texts.items()), "kind string, text string")
    rows = pii.with_candidates(df).collect()
    loose = {r.kind: [r.text[x.start : x.end] for x in r.loose if x.kind == r.kind] for r in rows}
    assert loose == {
        "email": ["joe at corp dot org"], "ip": ["2001:db8:85a3:0:0:8a2e:370:7334", "fe80::1:2ff"],
        "card": ["1234567890123456", "9999-8888-7777-6666"], "phone": ["(415) 555-2671", "212.555.0100"],
    }


def _kneser_ney(counts):
    """Bits of each character of a word, by the definition: dictionaries of strings, no hashes."""
    top, tables = langid.ORDER, []
    for k in range(1, top + 1):
        raw, before = Counter(), {}
        for word, n in counts.items():
            marked = f"\x02{word}\x03"
            for end in range(1, len(marked)):
                if end >= k - 1:
                    gram = marked[end - k + 1 : end + 1]
                    raw[gram] += n
                    if end >= k:
                        before.setdefault(gram, set()).add(marked[end - k])
        count = {g: n if k == top or g[0] == "\x02" else len(before[g]) for g, n in raw.items()}
        ones, twos = (sum(n == x for n in count.values()) for x in (1, 2))
        discount = min(max(ones / (ones + 2 * twos) if ones else 0.5, 0.1), 0.9)
        total, kinds = Counter(), Counter()
        for gram, n in count.items():
            total[gram[:-1]] += n
            kinds[gram[:-1]] += 1
        tables.append((count, discount, total, kinds))

    def chance(marked, end, k):
        if k == 0:
            return langid.FLOOR
        lower = chance(marked, end, k - 1)
        if end < k - 1:
            return lower
        count, discount, total, kinds = tables[k - 1]
        context, gram = marked[end - k + 1 : end], marked[end - k + 1 : end + 1]
        if not total[context]:
            return lower
        return (max(count.get(gram, 0) - discount, 0) + discount * kinds[context] * lower) / total[context]

    return lambda word: [-math.log2(chance(f"\x02{word}\x03", end, top)) for end in range(1, len(word) + 2)]


def test_models_equal_kneser_ney_by_definition():
    rng = random.Random(6)
    counts = Counter("".join(rng.choices("aabcdé", k=rng.randrange(1, 9))) for _ in range(400))
    counts["abcabcabc"] += 50
    model, bits = langid.Model.fit(counts), _kneser_ney(counts)
    for word in [*list(counts)[:100], "zzz", "abzab", "a", "ééééééééé", "bcabcab"]:
        codes, place = langid._codes([word])
        assert model.bits(codes, place)[1:] == pytest.approx(bits(word), rel=1e-4)


def test_the_sample_is_bounded_and_counts_copies_once(spark):
    """20,000 copies of one text are one text of it, whether its hash is drawn or not."""
    copies = [("the one text with so many copies", "en")] * 20_000
    others = [(f"text number {i} of the others", "en") for i in range(2000)] + [("ein text", "de")] * 50
    rows = spark.createDataFrame(copies + others, "text string, lang string").repartition(7)
    for asked, expected in ((1500, 1500), (5000, 2001)):
        drawn = langid.sample(rows.select("lang", "text"), asked).collect()
        texts = Counter((r.lang, r.text) for r in drawn)
        assert Counter(lang for lang, _ in texts) == {"en": expected, "de": 1}
        assert max(texts.values()) == 1
        assert 0.1 < sum(r.apart for r in drawn) / len(drawn) < 0.3
    again = {r.text for r in langid.sample(rows.select("lang", "text").repartition(2), 1500).collect()}
    assert again == {r.text for r in langid.sample(rows.select("lang", "text"), 1500).collect()}


def test_rejection_is_calibrated_on_held_out_texts(spark, sf_dir):
    """Texts of the learned languages stay; random letters, other languages and scripts go."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = langid.fit(docs)
    texts = [r.text for r in docs.select("text").collect()]
    kept = [not rejected for *_, rejected in found.predict(texts)]
    assert 0.98 <= np.mean(kept) <= 1
    rng = random.Random(2)
    alien = ["".join(rng.choices("qwxzjkvbp ", k=400)) for _ in range(20)]
    alien += ["Бұл мәтін басқа тілде жазылған, оны ешкім үйренген жоқ. " * 5, "この文は別の言語で書かれています。" * 10]
    assert all(rejected for *_, rejected in found.predict(alien))


# ---- fingerprints -----------------------------------------------------------


def test_compare_in_order_equals_brute_force(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(80))) for _ in range(200)]
    texts[5] = texts[6] = texts[7]
    rows = [(i * 3 if i % 7 else i * 3 - 1000, t) for i, t in enumerate(texts)]
    rows += [(12, "twice"), (12, "twice"), (None, "null id"), (None, None), (15, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    df = df.withColumn("bucket", F.lit("mine"))
    found = Counter(
        (r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next)
        for r in simhash.compare_in_order(df).collect()
    )
    order = sorted(((i is not None, i or 0, t or "", i) for i, t in rows))
    expected = Counter()
    for (_, _, text, i), (_, _, after, _) in zip(order, order[1:] + order[:1]):
        changed = simhash.edited(text, after)
        a, b, c = simhash.fingerprints([text, changed, after])
        like = simhash.likeness(np.array([a, a]), np.array([b, c]))
        digest = hashlib.sha256(changed.encode()).hexdigest()
        expected[(i, len(text), digest, a.tobytes().hex(), b.tobytes().hex(), *like)] += 1
    assert found == expected


def test_single_and_empty_tables(spark):
    one = spark.createDataFrame([(1, "abcd")], "doc_id long, text string")
    row = simhash.compare_in_order(one).head()
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    assert simhash.compare_in_order(one.limit(0)).count() == 0


def test_query_radius_finds_edited_texts(spark, tmp_path):
    from mailweave.llm.queries import op7_simhash

    rng = random.Random(7)
    rows, copies = [], {}
    for t in range(60):
        words = [f"w{rng.randrange(10**5)}" for _ in range(300)]
        copies[t * 50] = words
        rows.append((t * 50, " ".join(words)))
        changed = list(words)
        changed[rng.randrange(300)] = f"x{t}"
        rows.append((t * 50 + 1, " ".join(changed)))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r.n_near for r in op7_simhash(spark, str(tmp_path)).collect() if r.doc_id % 50 == 0}
    prints = [int.from_bytes(x.tobytes()) for x in simhash.fingerprints([text for _, text in rows])]
    for (i, _), own in zip(rows, prints):
        if i % 50 == 0:
            assert found[i] == sum((own ^ p).bit_count() <= 9 for p in prints) - 1
    assert sum(n == 1 for n in found.values()) >= 0.8 * len(found)


def test_near_counts_equal_brute_force(spark):
    rng = random.Random(3)
    prints = [rng.getrandbits(128) for _ in range(60)]
    for p in list(prints):
        for _ in range(4):
            flips = rng.sample(range(128), rng.randrange(6))
            prints.append(p ^ sum(1 << f for f in flips))
    prints += prints[:9]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = [(i, signed(p >> 64), signed(p & (1 << 64) - 1)) for i, p in enumerate(prints)]
    df = spark.createDataFrame(rows, "doc_id long, high long, low long")
    found = {(r.high, r.low): r.n_near for r in simhash.near_counts(df, df.where("doc_id % 5 = 0")).collect()}
    for i, high, low in rows:
        if i % 5 == 0:
            assert found[high, low] == sum((prints[i] ^ p).bit_count() <= 3 for p in prints)


