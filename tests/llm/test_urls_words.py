"""The URL filter and the spelling variants against brute force."""

import math
import random
import zlib
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from mailweave.llm import spelling, url_filter
from mailweave.llm.queries import URL_RULES, op11_url_boosting

# ---- URLs -------------------------------------------------------------------


def _parts(url):
    url = url or ""
    if "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:end], rest[end:]
    stop = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(c.lower() if c.isascii() else c for c in host), tail[:stop]


def _rule(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def _entropy(text):
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values()) if text else 0.0


def _features(url, blocked_share):
    url = url or ""
    host, path = _parts(url)
    wide = lambda n: math.floor(4 * math.log2(n + 1) + 1e-9)
    narrow = lambda x, steps: math.floor(steps * x + 1e-9)
    digits = lambda t: sum(c in "0123456789" for c in t) / len(t) if t else 0.0
    before = url.split("#", 1)[0]
    query = before.split("?", 1)[1] if "?" in before else ""
    values = [
        wide(len(url)), wide(len(host)), wide(len(path)), wide(path.count("/")), wide(host.count(".")),
        wide(host.count("-")), narrow(digits(url), 32), narrow(digits(host), 32), narrow(_entropy(url), 8),
        narrow(_entropy(host), 8), wide(1 + query.count("&") if query else 0), blocked_share,
    ]
    return dict(zip(url_filter.FEATURES, values, strict=True))


def _boost(rows, labels):
    """Trees by trying every split on the rows themselves; scores of all training rows by index."""
    n1 = sum(labels)
    n0 = len(labels) - n1
    w = [max(1, round(n1 / n0)), max(1, round(n0 / n1))]
    unit, scores, trees = url_filter.UNIT, [0.0] * len(rows), []
    weight = lambda g, h: -url_filter.RATE * (g / unit) / (h / unit + url_filter.REGULAR)

    def grow(index, depth, g, h):
        value = lambda a, b: (a / unit) ** 2 / (b / unit + url_filter.REGULAR)
        best, place = 0.0, None
        all_g, all_h = sum(g[i] for i in index), sum(h[i] for i in index)
        for f in url_filter.FEATURES if depth else []:
            for edge in sorted({rows[i][f] for i in index})[:-1]:
                left = [i for i in index if rows[i][f] <= edge]
                lg, lh = sum(g[i] for i in left), sum(h[i] for i in left)
                if min(lh, all_h - lh) < url_filter.LEAST * unit // 4:
                    continue
                gain = value(lg, lh) + value(all_g - lg, all_h - lh) - value(all_g, all_h)
                if gain > best + 1e-9:
                    best, place = gain, (f, edge)
        if place is None:
            return weight(all_g, all_h)
        f, edge = place
        sides = [i for i in index if rows[i][f] <= edge], [i for i in index if rows[i][f] > edge]
        return url_filter.Split(f, edge, *(grow(side, depth - 1, g, h) for side in sides))

    for _ in range(url_filter.ROUNDS):
        p = [math.floor(unit / (1 + math.exp(-s)) + 0.5) for s in scores]
        g = [w[y] * (q - y * unit) for q, y in zip(p, labels)]
        h = [w[y] * (q * (unit - q) // unit) for q, y in zip(p, labels)]
        tree = grow(list(range(len(rows))), url_filter.DEPTH, g, h)
        if not isinstance(tree, url_filter.Split):
            break
        trees.append(tree)
        scores = [s + _leaf(tree, row) for s, row in zip(scores, rows)]
    return trees


def _leaf(node, row):
    while isinstance(node, url_filter.Split):
        node = node.left if row[node.feature] <= node.bin else node.right
    return node


def _judged(urls):
    decided = [(_parts(u), _rule(*_parts(u))) for u in urls]
    suffix = lambda d: d[0][0].rsplit(".", 1)[-1]
    rows, blocked = Counter(), Counter()
    for d in decided:
        if d[1]:
            rows[suffix(d)] += 1
            blocked[suffix(d)] += d[1].verdict == "block"
    share = lambda d: math.floor(32 * (blocked[suffix(d)] + 1) / (rows[suffix(d)] + 2) + 1e-9)
    features = [_features(u, share(d)) for u, d in zip(urls, decided)]
    taught = [i for i, d in enumerate(decided) if d[1]]
    labels = [int(decided[i][1].verdict == "block") for i in taught]
    trees = _boost([features[i] for i in taught], labels)
    out = []
    for f, (place, rule) in zip(features, decided):
        score = sum(_leaf(t, f) for t in trees)
        out.append((*place, rule and rule.name, rule.verdict if rule else "block" if score > 0 else "allow", score))
    return out


def _same(rows, expected):
    for r, (host, path, rule, verdict, score) in zip(rows, expected, strict=True):
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)
        assert r.score == pytest.approx(score, abs=1e-9)


def test_query_equals_brute_force(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").orderBy("page_id").collect()
    found = op11_url_boosting(spark, sf_dir).orderBy("page_id").collect()
    assert [r.page_id for r in found] == [p.page_id for p in pages]
    _same(found, _judged([p.url for p in pages]))
    assert {r.verdict for r in found if r.rule is None} == {"allow", "block"}


ODD = [
    None, "", "no scheme", "http://", "HTTP://EXAMPLE.com/en/x", "http://example.com", "http://example.com?/en/",
    "http://www.example.com/en/", "http://a.WWW.example.COM/en/1?q=1&r=2#/es/", "http://notexample.com/en/",
    "http://x.net/es/1", "http://x.net/es", "http://net/fr/", "x://a://b.net/fr/", "http://b.net/fr/?a&b&c",
    "http://h\u00c4\u00d6.net/fr/\u4e2d\u6587", "http://x.net/fr/" + "9" * 200_000, "http://x.org/a#b?c=d&e", "://.net/es/", "http://x.net\n/fr/",
]


def test_odd_urls(spark):
    rng = random.Random(4)
    urls = ODD + [
        f"http://{rng.choice(['a', 'b-c', 'www.x9'])}{i}.{rng.choice(['com', 'net', 'example.com'])}"
        f"/{rng.choice(['en', 'es', 'fr'])}/{rng.randrange(10**rng.randrange(1, 9))}" for i in range(150)
    ]
    rows = [(i, u, "own") for i, u in enumerate(urls)]
    frame = spark.createDataFrame(rows, "page_id long, url string, host string").repartition(4)
    found = url_filter.judge(frame, URL_RULES).orderBy("row.page_id").collect()
    _same(found, _judged(urls))
    assert all(r.row.host == "own" for r in found)


def test_one_label_none_and_empty(spark):
    frame = spark.createDataFrame([("http://a.org/",), ("http://b.org/",), (None,)], "url string")
    assert {r.verdict for r in url_filter.judge(frame, URL_RULES).collect()} == {"allow"}
    assert {r.verdict for r in url_filter.judge(frame, []).collect()} == {"allow"}
    only = [url_filter.Rule("a.org", "/", "block")]
    assert {r.verdict for r in url_filter.judge(frame, only).collect()} == {"block"}
    assert url_filter.judge(frame.limit(0), URL_RULES).collect() == []


def test_rules_tie_and_longest(spark):
    rules = [url_filter.Rule("b.c", "/", "allow"), url_filter.Rule("c", "/x/", "block"), url_filter.Rule("c", "/", "block")]
    rows = [("b.c", "/x/"), ("a.c", "/x/"), ("b.c", "/y"), ("bb.c", "/y"), ("c", "")]
    frame = spark.createDataFrame(rows, "h string, p string")
    found = frame.select(url_filter.matched(F.col("h"), F.col("p"), rules)["rule"].alias("r")).collect()
    assert [r.r for r in found] == ["b.c/", "c/x/", "b.c/", "c/", None]


def test_trees_separate_what_features_tell(spark):
    """Held-out URLs of a class with digits and hyphens are told from plain ones."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randrange(4, 9)))
    bad = [f"http://{word()}-{rng.randrange(10**6)}.{s}/{word()}" for s in ("bad.zz", "open.zz") for _ in range(300)]
    good = [f"http://{word()}.{s}/{word()}" for s in ("good.zz", "open.zz") for _ in range(300)]
    rules = [url_filter.Rule("bad.zz", "/", "block"), url_filter.Rule("good.zz", "/", "allow")]
    frame = spark.createDataFrame([(u,) for u in bad + good], "url string")
    left = url_filter.judge(frame, rules).where("rule is null").collect()
    assert len(left) == 600
    assert sum((r.verdict == "block") == ("-" in r.host) for r in left) > 590


# ---- words ------------------------------------------------------------------


def _one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _letters_only(text):
    run = []
    for c in text + " ":
        if c.isascii() and c.isalpha() or "\u00c0" <= c <= "\u00ff":
            run.append(c.lower() if c.isascii() else c)
        elif run:
            yield "".join(run)
            run = []


def brute(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in _letters_only(text or ""):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += len(run) >= 6
    words = {w: n for w, n in counts.items() if n >= 5}
    near = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if abs(len(a) - len(b)) <= 1 and _one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None
    rows = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(rows)


def _variants(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(df).collect())


SCHEMA = "doc_id long, text string, word string"


def test_variants_equal_brute_force(spark):
    rng = random.Random(2)
    base = ["".join(rng.choices("abcde\u00e9\u00ff", k=rng.randrange(6, 10))) for _ in range(25)]
    docs = []
    for i in range(400):
        words = []
        for _ in range(60):
            w = rng.choice(base[: rng.randrange(1, 26)])
            while rng.random() < 0.3:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice("abcde\u00e9") + w[at + 1 :], w[:at] + rng.choice("abc") + w[at:]])
            words.append(w.upper() if rng.random() < 0.1 else w)
        docs.append((i, rng.choice([" ", "-", "\n", "3", "\u0100"]).join(words)))
    docs += [(None, "listen listen silent listen"), (7, None), (8, ""), (9, "9" * 50), (9, "\u00d7" * 7), (9, "\u00d7" * 7)]
    docs += [(9, "LISTEN " * 9), (10, "listens " * 5 + "silent " * 6 + "lisstens"), (11, "a" * 5000), *[(i, "b" * 5000) for i in range(6)]]
    rows = [(i, t, "own") for i, t in docs]
    expected = brute(docs)
    assert len(expected) > 300 and any(r[1] and r[2] != r[1] for r in expected)
    assert _variants(spark.createDataFrame(rows, SCHEMA).repartition(5)) == expected


def test_damage_is_the_hash_of_document_and_word(spark):
    docs = [(i, "abcdefg Abcdefg") for i in range(2000)]
    found = _variants(spark.createDataFrame([(*d, "") for d in docs], SCHEMA))
    assert found == brute(docs) and any(len(r[0]) == 6 for r in found)


def test_a_class_of_anagrams(spark):
    """All orders of six letters: no near words among them, but with one letter more."""
    from itertools import permutations

    words = ["".join(p) for p in permutations("abcdef")]
    text = " ".join(words + ["abcdefg", "abgcdef", "zabcdef"]) + " "
    docs = [(None, text * 5)]
    assert _variants(spark.createDataFrame([(*d, "") for d in docs], SCHEMA)) == brute(docs)


def test_no_words(spark):
    assert _variants(spark.createDataFrame([], SCHEMA)) == []
    assert _variants(spark.createDataFrame([(1, None, ""), (2, "short word", "")], SCHEMA)) == []
