"""Licence notices, periodic runs and ranked search against brute force, with NULLs, empty and long texts, ties and repeated rows."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from matchday.llm import lexical_search, license_scan, periodic_runs, queries

DOCS = "doc_id long, text string, hits string, runs string, n_words string, score string, item_id string"
NOTICE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def table(spark, texts, ids=None):
    """Texts with clashing columns; by default the last two ids are NULL and the one before repeats the first."""
    ids = ids or [*range(1, len(texts) - 2), 1, None, None]
    return spark.createDataFrame([(i, t, *"clash") for i, t in zip(ids, texts)], DOCS).repartition(3)


# --- periodic runs -------------------------------------------------------------

def plain_runs(words, least, times):
    """Every stretch and period by comparing words a period apart."""
    found = []
    for period in range(1, len(words)):
        at = 0
        while at + period < len(words):
            start = at
            while at + period < len(words) and words[at] == words[at + period]:
                at += 1
            length = at - start + period
            smaller = any(s == start and n == length and period % q == 0 for s, n, q in found)
            if at > start and length >= max(least, times * period) and not smaller:
                found.append((start, length, period))
            at += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def repeating_words(rnd, letters, most):
    words = []
    while len(words) < most:
        part = [rnd.choice(letters) for _ in range(rnd.randint(1, 5))]
        words += part * rnd.choice([1, 1, 2, 4, 7]) + part[:rnd.randint(0, len(part))]
    return words


@pytest.mark.parametrize("least, times", [(6, 4), (2, 2), (9, 3), (30, 4)])
def test_runs_equal_brute_force(least, times):
    rnd = random.Random(7)
    for _ in range(150):
        texts = [[w.encode() for w in repeating_words(rnd, "abcde"[:rnd.choice([1, 2, 3, 5])], rnd.randint(0, 50))]
                 for _ in range(rnd.randint(1, 5))]
        assert periodic_runs.runs_of(texts, least, times) == [plain_runs(t, least, times) for t in texts]


def test_runs_of_long_texts():
    words = [b"a"] * 60_000
    assert periodic_runs.runs_of([words]) == [[(0, 60_000, 1)]]
    passage = [b"%d" % i for i in range(5_000)]
    assert periodic_runs.runs_of([[b"x", *passage * 6, b"y"], passage]) == [[(1, 30_000, 5_000)], []]
    many = [w for i in range(5_000) for w in (b"x%d" % i, b"a", b"b", b"c", b"d", b"e")]  # one passage, many left words
    assert periodic_runs.runs_of([many]) == [[]]


def test_find_runs_and_its_query(spark, monkeypatch):
    rnd = random.Random(3)
    texts = [" ".join(repeating_words(rnd, "abc", rnd.randint(1, 200))) for _ in range(80)]
    texts += ["go " * 9 + "on\x0bon\x1con", "É é " * 5, texts[0], "", None, "one", texts[1], "a b " * 3000, "a\tb\n" * 4, ""]
    docs = table(spark, texts)
    found = collections.defaultdict(list)
    out = periodic_runs.find_runs(docs)
    assert [c for c in out.columns if c not in ("runs", "collapsed")] == [c for c in docs.columns if c != "runs"]
    for row in out.collect():
        found[row["text"]].append(row)
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = plain_runs(words, 6, 4) if len(words) < 1000 else [(0, 6000, 2)]
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        for row in found[text]:
            assert [tuple(r) for r in row["runs"]] == runs
            assert row["collapsed"] == " ".join(w for i, w in enumerate(words) if i not in gone)
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0

    monkeypatch.setattr(queries, "table", lambda *_: docs)
    digests = sorted(map(str, queries.op12_periodic_runs(spark, "").collect()))
    expected = []
    for i, text in zip([*range(1, len(texts) - 2), 1, None, None], texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(i).encode()), len(words)
        if i is not None and h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        runs = plain_runs(words, 6, 4) if n < 1000 else periodic_runs.runs_of([[w.encode() for w in words]])[0]
        gone = {k for s, m, q in runs for k in range(s + q, s + m)}
        top = sorted(runs, key=lambda r: (-r[1], r[0], r[2]))[0] if runs else None
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        row = spark_row(doc_id=i, n_runs=len(runs), start=top and top[0], length=top and top[1], period=top and top[2],
                        exponent_milli=top and 1000 * top[1] // top[2], runs_sha256=sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
                        collapsed_sha256=sha(" ".join(w for k, w in enumerate(words) if k not in gone)))
        expected.append(str(row))
    assert digests == sorted(expected)


def spark_row(**values):
    from pyspark.sql import Row
    return Row(**values)


# --- licence notices -----------------------------------------------------------

def distance(a, b):
    """Insertions, deletions and substitutions from one text to the other."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_hits(text, notice):
    """Whether any stretch of words is within the allowed edits of a notice, its short words unchanged."""
    words = NOTICE_WORD.findall(lower(text))
    short = {w for w in notice.phrase.split() if len(w) <= license_scan.SHORT}
    size = len(notice.phrase.split())
    best = None
    for start in range(len(words)):
        for end in range(start + 1, min(len(words), start + size + notice.edits) + 1):
            if short <= set(words[start:end]):
                d = distance(" ".join(words[start:end]), notice.phrase)
                best = d if best is None else min(best, d)
    return best if best is not None and best <= notice.edits else None


def notice_texts():
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("licensemtgpubra") for _ in range(rnd.randint(1, 8)))
    texts = []
    for k in range(400):
        notice = rnd.choice(license_scan.NOTICES)
        chars = list(notice.phrase)
        for _ in range(rnd.randint(0, notice.edits + 2)):
            at = rnd.randrange(len(chars))
            chars[at:at + 1] = rnd.choice([[], [rnd.choice("aeils z")], [chars[at], rnd.choice("aeils")]])
            chars = chars or ["x"]
        inner = "".join(chars)
        inner = inner.upper() if k % 3 == 0 else inner.replace(" ", rnd.choice([" ", "-", "\n * ", "\x00", "; "]))
        around = [" ".join(word() for _ in range(rnd.randint(0, 6))) for _ in range(2)]
        texts.append(f"{around[0]}{rnd.choice([' ', '(', 'x', 'é'])}{inner}{rnd.choice([' ', '.', 's', 'é'])}{around[1]}")
    return texts


def test_notices_equal_brute_force():
    texts = notice_texts()
    counts, found = license_scan.Scanner().scan([t.encode() for t in texts])
    checked = 0
    for text, n, hits in zip(texts, counts, found):
        assert n == len(NOTICE_WORD.findall(lower(text)))
        for notice in license_scan.NOTICES:
            own = [h for h in hits if h.notice == notice.phrase]
            least = plain_hits(text, notice)
            assert min((h.edits for h in own), default=None) == least
            checked += least is not None
            for h in own:
                span = text[h.first_char:h.end_char]
                words = NOTICE_WORD.findall(lower(text))[h.first_word:h.first_word + h.words]
                assert NOTICE_WORD.findall(lower(span)) == words
                assert distance(" ".join(words), notice.phrase) == h.edits
                assert h.likeness == 1 - h.edits / len(notice.phrase)
            ends = sorted((h.first_char, h.end_char) for h in own)
            assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
    assert checked > 100


def test_scan_notices_and_its_query(spark, monkeypatch):
    texts = notice_texts()[:60] + [
        "MIT License, mit-license (MIT\nLicense) mit licence", "the MIT Licensed", "submit license", "mitlicense", "Apache  LICENSE " * 700,
        "GNU Lesser General Public License", "gnu general publik licence", "Apáche License", "", None, "licensed under cc by nc",
        "mit license", "mit license", None, ""]
    docs = table(spark, texts)
    hits = {}
    for row in license_scan.scan_notices(docs).collect():
        hits[row["text"]] = row["hits"]
    assert [(h["label"], h["edits"]) for h in hits["MIT License, mit-license (MIT\nLicense) mit licence"]] == [("mit", 0)] * 3 + [("mit", 1)]
    assert [h["label"] for h in hits["GNU Lesser General Public License"]] == ["lgpl", "gpl"]
    assert hits["submit license"] == [] and hits[None] == [] and len(hits["Apache  LICENSE " * 700]) == 700
    assert [h["label"] for h in hits["gnu general publik licence"]] == ["gpl"]
    assert license_scan.scan_notices(docs.limit(0)).count() == 0

    monkeypatch.setattr(queries, "table", lambda *_: docs)
    out = queries.op11_license_scan(spark, "").collect()
    assert len(out) == len(texts)
    expected = collections.Counter()
    for i, text in zip([*range(1, len(texts) - 2), 1, None, None], texts):
        words, places, labels = NOTICE_WORD.findall(lower(text)), [], set()
        for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
            size = len(phrase.split())
            at = [k for k in range(len(words)) if words[k:k + size] == phrase.split()]
            places += at
            labels |= {label} if at else set()
        expected[i, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))] += 1
    assert expected == collections.Counter(tuple(r)[:6] for r in out)
    for r in out:
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        assert (r["score"] > 0) == (r["labels"] != "") and (r["n_base"] == 0 or r["score"] == 1)


# --- ranked search ---------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_search(docs, items, k):
    terms = [TERM.findall(lower(t)) for _, t in docs]
    counts = [collections.Counter(t) for t in terms]
    big_n, big_l = sum(map(bool, terms)), sum(map(len, terms))
    df = collections.Counter(t for c in counts for t in c)
    rows = []
    for item, text in items:
        scores = []
        for (doc, _), words, held in zip(docs, terms, counts):
            score = 0
            for term in TERM.findall(lower(text)):
                if held[term]:
                    m = 100 - 25 + 25 * len(words) * big_n // big_l
                    w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[term] + 1)))
                    score += w * (1_000_000_000 * held[term] // (1000 * held[term] + 12 * m))
            if score > 0:
                scores.append((-score, doc is None, doc))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        rows += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(scores[:k], 1)]
    return rows


def test_search_equals_brute_force(spark):
    rnd = random.Random(4)
    word = lambda: rnd.choice("ab cd Ef gh ij kl mn op qr é1 ß 日本 x9 y z".split())
    texts = [" ".join(word() for _ in range(rnd.randint(0, 30))) for _ in range(300)]
    texts += ["zz " * 50, "ab-ab_ab\x00ab", None, "", "  ", texts[5], texts[5], texts[5].upper(), texts[5], "rare " + "ab " * 2000]
    ids = [rnd.randrange(400) if rnd.random() < 0.95 else None for _ in texts]
    items = [(i, " ".join(word() for _ in range(rnd.randint(1, 12)))) for i in range(40)]
    items += [(7, "ab ab ab cd"), (7, "rare"), (None, "ef EF eF"), (50, None), (51, ""), (52, "nowhere"), (53, "ab " * 500 + "zz")]
    docs = table(spark, texts, ids)
    queried = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    expected = collections.Counter(plain_search(list(zip(ids, texts)), items, 20))
    assert collections.Counter(map(tuple, lexical_search.search(docs, queried).collect())) == expected
    # Many blocks, tiles of few items, terms and documents: the same rows.
    tiled = lexical_search.search(docs, queried, pairs=120, rows=7, columns=3, width=16)
    assert collections.Counter(map(tuple, tiled.collect())) == expected
    assert lexical_search.search(docs.limit(0), queried).count() == 0
    assert lexical_search.search(docs, queried.limit(0)).count() == 0
    assert lexical_search.search(docs.filter("text IS NULL"), queried).count() == 0


def test_tiles_bound_their_partial_sums():
    rnd = random.Random(8)
    exact = 60 * lexical_search.TOP_IMPACT + 1  # a sum of weights of 60 at most
    weighted = {i: {t: rnd.choice([1, 5, 40, 150]) for t in rnd.sample(range(50), 20)} for i in range(0, 90, 3)}
    groups = lexical_search.tiles(weighted, 8, 6, exact)
    rebuilt = collections.defaultdict(collections.Counter)
    for made in groups:
        assert len(made[0].items) <= 8
        for tile in made:
            assert len(tile.terms) <= 6 and tile.weights().sum(axis=1).max() * lexical_search.TOP_IMPACT < exact
            for row, item in enumerate(tile.items.tolist()):
                for column, term in enumerate(tile.terms.tolist()):
                    if weight := int(tile.weights()[row, column]):
                        rebuilt[item][term] += weight
    assert {i: dict(t) for i, t in rebuilt.items()} == weighted
