"""The operators against brute force on small tables with NULLs, empty and long texts, ties and repeated rows."""

from __future__ import annotations

import collections
import hashlib
import itertools
import json
import math
import os
import random
import re
import time

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from matchday.llm import (
    bpe, fingerprints, html_text, knn, line_dedup, mixing, near_dedup, ngram_lm, queries, toxicity, url_filter,
)
from matchday.llm.components import connected

DOCS = "doc_id long, text string, source string, size string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 4)))
    rows = [" ".join(word() for _ in range(rnd.randint(1, 80))) for _ in range(60)]
    long = rows[3].split() * 3
    rows += [None, "", "   ", "One", "one", "a b c", "A  B\tC", rows[7], rows[7], rows[7].upper(), "word " * 3000]
    for k in range(12):  # near copies of one text
        copy = (long + rows[9].split())[:]
        copy[rnd.randrange(len(copy))] = f"edit{k}"
        rows.append(" ".join(copy))
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i * 3 + 1, t, None if i % 7 == 0 else f"s{i % 3}", "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def by_id(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}


def test_fingerprints(docs, texts, nothing):
    found = by_id(fingerprints.fingerprints(docs.select("doc_id", "text"), min_idf=0.1, max_idf=3.5).withColumn(
        "near", fingerprints.likeness(F.col("hashes"), F.col("edited_hashes"))).withColumn(
        "next", fingerprints.likeness(F.col("hashes"), F.col("next_hashes"))))
    ids = sorted(found)
    assert ids == [i * 3 + 1 for i in range(len(texts))]
    for k, i in enumerate(ids):
        own, following = texts[k] or "", texts[(k + 1) % len(texts)] or ""
        half = len(own) // 2
        edited = own[:len(own) - half] + following[:half]
        assert found[i]["n_chars"] == len(own)
        assert found[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert found[i]["next_hashes"] == found[ids[(k + 1) % len(ids)]]["hashes"]
        assert 0 <= found[i]["near"] <= 1 and 0 <= found[i]["next"] <= 1
        if own == edited:
            assert found[i]["hashes"] == found[i]["edited_hashes"] and found[i]["near"] == 1
    same = collections.defaultdict(set)
    for k, i in enumerate(ids):
        same[texts[k] or ""].add(tuple(found[i]["hashes"]))
    assert all(len(v) == 1 for v in same.values())
    unrelated = ids[:59]  # what follows are near copies of each other
    assert sum(found[i]["near"] for i in unrelated) > sum(found[i]["next"] for i in unrelated)
    assert fingerprints.fingerprints(nothing).count() == 0


@pytest.mark.parametrize("broadcast", [True, False])
def test_fingerprints_recomputed_with_hot_ids(spark, monkeypatch, broadcast):
    """Every hash and likeness by plain Python, over xxhash64 of the words; a third of the rows with no id, a third with one id."""
    monkeypatch.setattr(fingerprints, "BUCKET", 10)
    monkeypatch.setattr(fingerprints, "MOST_TERMS", 10**6 if broadcast else 0)
    rnd = random.Random(11)
    vocabulary = [f"w{k}" for k in range(60)]
    rows = [(None if k % 3 == 0 else 50 if k % 3 == 1 else k, " ".join(rnd.choices(vocabulary, k=rnd.randint(0, 25)))) for k in range(150)]
    rows += [(50, None), (50, ""), (None, None), (50, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    buckets = fingerprints._bucketed(docs, len(rows)).collect()
    fullest = collections.Counter(r["bucket"] for r in buckets).most_common(1)[0][1]
    in_order = sorted(buckets, key=lambda r: (r["id"], r["hash"]))
    assert fullest < 30 and [r["bucket"] for r in in_order] == sorted(r["bucket"] for r in buckets)

    known = {w: h for w, h in spark.createDataFrame([(w,) for w in vocabulary], "w string").select("w", F.xxhash64("w")).collect()}
    texts = sorted(((-(1 << 63) if i is None else i, t or "") for i, t in rows), key=lambda r: r[0])
    hashed = dict(spark.createDataFrame([(t,) for _, t in texts], "t string").select("t", F.xxhash64("t")).distinct().collect())
    texts.sort(key=lambda r: (r[0], hashed[r[1]], r[1]))
    own = lambda t: {known[w] for w in re.findall(r"w\d+", t) if w in known} | set()
    df = collections.Counter(h for _, t in texts for h in own(t))
    low, high = 0.5, 2.5
    band = {h for h, n in df.items() if len(rows) * math.exp(-high) <= n <= len(rows) * math.exp(-low)}
    assert 0 < len(band)
    edits = []
    for k, (_, t) in enumerate(texts):
        half = len(t) // 2
        edits.append(t[:len(t) - half] + texts[(k + 1) % len(texts)][1][:half])
    # Words that an edit cuts get hashes too, and every list that is hashed as a whole or for a sub-lexicon.
    words = sorted({w for t in edits for w in t.split()} - known.keys())
    known |= dict(spark.createDataFrame([(w,) for w in words], "w string").select("w", F.xxhash64("w")).collect())
    levels = fingerprints._LEVELS
    chance = {(r["h"], s): r[f"s{s}"] for r in spark.createDataFrame([(h,) for h in band], "h long").select("h", *[
        F.pmod(F.xxhash64(F.lit(f"subset {s}"), "h"), F.lit(4**level)).alias(f"s{s}") for s, level in enumerate(levels)]).collect()
        for s in range(len(levels))}
    masks = {h: sum(1 << s for s in range(len(levels)) if chance[h, s] == 0) for h in band}
    masks = {h: m - (1 << 64) if m >= 1 << 63 else m for h, m in masks.items()}
    lists = []
    for t in [t for _, t in texts] + edits:
        mine = {known[w] for w in t.split()}
        kept = sorted(mine & band)
        lists.append(([[(h, masks[h]) for h in kept if masks[h] >> s & 1] for s in range(len(levels))], sorted(mine), bool(kept)))
    table = spark.createDataFrame([(k, *x) for k, x in enumerate(lists)],
                                  "k int, subs array<array<struct<term:bigint,subsets:bigint>>>, mine array<bigint>, some boolean")
    prints = {r["k"]: tuple(
        [h if subs else 0 for h, subs in zip(r["hashes"], r["subs"])] if r["some"] else [r["whole"] if r["mine"] else 0] + [0] * (len(levels) - 1))
        for r in table.select("*", F.transform("subs", lambda a: F.xxhash64(a)).alias("hashes"), F.xxhash64("mine").alias("whole")).collect()}

    def alike(a, b):
        either = sum(x != 0 or y != 0 for x, y in zip(a, b))
        return sum(x == y != 0 for x, y in zip(a, b)) / either if either else 1.0

    n = len(texts)
    expected = sorted((-(1 << 63) if i is None else i, hashlib.sha256(e.encode()).hexdigest(), prints[k], prints[n + k],
                       alike(prints[k], prints[n + k]), alike(prints[k], prints[(k + 1) % n]))
                      for k, ((i, _), e) in enumerate(zip([(None if x == -(1 << 63) else x, t) for x, t in texts], edits)))
    out = fingerprints.fingerprints(docs, min_idf=low, max_idf=high).select(
        "*", fingerprints.likeness(F.col("hashes"), F.col("edited_hashes")).alias("near"),
        fingerprints.likeness(F.col("hashes"), F.col("next_hashes")).alias("next")).collect()
    found = sorted((-(1 << 63) if r["doc_id"] is None else r["doc_id"], r["edited_sha256"], tuple(r["hashes"]), tuple(r["edited_hashes"]),
                    r["near"], r["next"]) for r in out)
    assert found == expected


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><nav><a href=/>Home page</a></nav>
<div class="ad">Buy many things here today</div><article><h1>Head &amp; line</h1><p>First   text
of the <b>page</b> &#233;.<p>Second &lt;b&gt; one<ul><li>item one<li>item two</ul></article><section class="comments"><p>nice
page said a reader</p></section><form>subscribe now</form><footer>&copy; foot</footer><script>var t="</p>";</script></body></html>"""


def test_html_text(spark):
    expected = "Head & line\nFirst text of the page é.\nSecond <b> one\nitem one\nitem two"
    rows = [(1, PAGE, 5), (2, None, 6), (3, "", 7), (4, "<p", 8), (5, PAGE, 9), (6, "<p>" + "long " * 50_000, 1)]
    pages = spark.createDataFrame(rows, "page_id long, html string, n int")
    weights = html_text.learn_weights(pages)
    assert weights["word"] > 0 > weights["<p"]
    out = {r["page_id"]: r for r in html_text.extract(pages, weights).collect()}
    assert out[1]["text"] == out[5]["text"] == expected and out[2]["text"] == out[3]["text"] == out[4]["text"] == ""
    assert out[6]["text"] == ("long " * 50_000).strip() and out[6]["n"] == 1
    assert html_text.learn_weights(pages.limit(0)) == html_text.DEFAULT_WEIGHTS


def test_html_text_keeps_all_of_the_marked_article():
    """Weights as learned where lists, links and tags are seen outside the articles only."""
    weights = {"word": 1.2, "link": -0.3, "text": -0.3} | {f"{e}{t}": -1.0 for e in ("<", "</") for t in ("ul", "li", "a", "div", "p")}
    words = lambda tag, n: "".join(f"<{tag}>w{i}</{tag}>" for i in range(n))
    links = "<p>" + " ".join(f'<a href="/{i}">link {i}</a>' for i in range(60)) + "</p>"
    items, prose = f"<ul>{words('li', 40)}</ul>", "<p>Some words of prose.</p>"
    listed, linked = [f"w{i}" for i in range(40)], [" ".join(f"link {i}" for i in range(60))]
    said = ["Some words of prose."]
    for inside, lines in ((items + prose, listed + said), (prose + items, said + listed), (links + prose, linked + said),
                          (prose + links, said + linked), (prose + items + links + prose, said + listed + linked + said),
                          (words("x-item", 3) + " < " + links, ["w0w1w2 <"] + linked), (items, listed)):
        for tag in ("article", "main"):
            page = f"<body><nav>Menu</nav><div>Out of it</div><{tag}>{inside}</{tag}>outside words<p>more of them</p></body>"
            assert html_text.main_text(page, weights).split("\n") == lines
    assert html_text.main_text("<p>Out of it</p><article></article>", weights) == ""


@pytest.mark.parametrize("inside, lines", [
    ('<p>One <svg class="icon" viewBox="0 0 1 1"/> two</p><p>Three</p>', ["One two", "Three"]),
    ("<p>One <math/> two</p><p>Three</p><svg></svg>", ["One two", "Three"]),
    ("<p>One <svg><path d=x><p>Two<p>Three<svg><title/><g/></svg> four", ["One", "Two", "Three four"]),
    ("<p>One <math><mi>x</mi><mo>=</mo><annotation>tex</annotation></math> two", ["One x= two"]),
    ("<p>One <object data=x>two</p><p>Three", ["One two", "Three"]),
    ("<svg><defs><style>a{}</style><title>no</title></defs><text>One</text></svg><p>Two", ["One", "Two"]),
    ("<svg><foreignObject><p>One</p></foreignObject></svg><p>Two", ["One", "Two"]),
    ("<p>One</p><template><article>no</article></template><canvas>no</canvas><p>Two", ["One", "Two"]),
    ('<div class="legal related-tags">One</div><div class="notice">no</div><p id="share_1">Two', ["One", "Two"]),
    ("<p>One<script>if (a</p>", ["One"]),
])
def test_html_text_elements_without_an_end_tag(inside, lines):
    page = f"<body><div>Out of it</div><article>{inside}</article><div>outside words</div></body>"
    assert html_text.main_text(page, html_text.DEFAULT_WEIGHTS).split("\n") == lines


@pytest.mark.parametrize("inside, lines", [
    ('<h2 id="search-algorithms">A</h2><p class="side-effects">b</p><h2 id="notice-periods">C</h2><div id="alert-levels">d</div>',
     ["A", "b", "C", "d"]),
    ('<p id="comments">One</p><div class="comments x">no</div><div class="ad-banner2">no</div><div class="Comment_List">no</div>Two',
     ["One", "Two"]),
    ('<div role="search">no</div><div class="content">One</div><div class="form-factor list">Two</div>', ["One", "Two"]),
])
def test_html_text_names_inside_the_article(inside, lines):
    for page in (f"<body><p>Out of it</p><article>{inside}</article>", f"<main><p>Out of it</p><article>{inside}</article>out</main>",
                 f"<article>{inside}<div class=comments><article>no</article></div></article><p>Out of it"):
        assert html_text.main_text(page, html_text.DEFAULT_WEIGHTS).split("\n") == lines
    outside = "".join(f'<div class="{c}">no</div>' for c in ("side-effects", "my-ad"))
    assert html_text.main_text(f"<p>One two</p>{outside}", html_text.DEFAULT_WEIGHTS) == "One two"


def test_html_text_marks():
    marked = lambda page: [t for kind, t, _, m, _ in html_text.tokens(page)[0] if m and kind == "word"]
    for page, one, words in (("<main>a<article>b</article>c</main>d", True, ["b"]), ("<article>a</article><article>b</article>c", False, ["a", "b"]),
                             ("<main>a<article>b</article><article>c</article></main>", False, ["a", "b", "c"]),
                             ("<nav><article>a</article></nav><main>b</main>", True, ["b"]), ("a<article/>", True, []), ("a", False, [])):
        assert (marked(page), html_text.tokens(page)[1]) == (words, one), page


def plain_nesting(page):
    """Open elements at each word of a page, by a stack that is searched from its end; links, blocks and others from it."""
    stack, out = [], []
    for end, name, text in re.findall(r"<(/?)(\w+)>|([^<]+)", page):
        if text:
            out.append(("link" if "a" in stack else "word", text, "nav" in stack, "article" in stack))
        elif end and name in stack:
            at = len(stack) - 1 - stack[::-1].index(name)
            if name in html_text.BLOCKS or not html_text.BLOCKS & set(stack[at:]):
                del stack[at:]
            else:
                del stack[at]
        elif not end:
            if name in html_text.BLOCKS:
                around = [i for i, n in enumerate(stack) if n in html_text.BLOCKS]
                if around and (stack[around[-1]] == "p" or stack[around[-1]] in html_text.CLOSES.get(name, ())):
                    del stack[around[-1]:]
            stack.append(name)
    return out


def test_html_text_nesting_equals_a_plain_stack():
    rnd = random.Random(11)
    for _ in range(3000):
        page = "".join(rnd.choice((f"<{n}>", f"</{n}>", f"<{n}>", f"w{i}")) for i in range(rnd.randint(1, 40))
                       for n in [rnd.choice("a b i p div li td tr nav".split())])
        found = [(k, t, o) for k, t, _, _, o in html_text.tokens(page)[0] if k in ("word", "link")]
        assert found == [row[:3] for row in plain_nesting(page)], page


@pytest.mark.parametrize("page", [
    "<b>" * 200_000 + "</i>" * 200_000, "<i>" * 100_000 + "<b>" * 100_000 + "</i>" * 100_000, "<b>" * 100_000 + "<div></div>" * 100_000,
    "<svg>" * 100_000 + "<g>" * 100_000, "<i>" * 100_000 + "<div>" * 100_000 + "</i>" * 100_000, "<article>" * 100_000 + "x",
    "<p>word <b>word</b></p>" * 100_000])
def test_html_text_is_linear(page):
    started = time.process_time()
    html_text.main_text(page, html_text.DEFAULT_WEIGHTS)
    assert time.process_time() - started < 20


def test_best_region_is_the_maximum():
    rnd = random.Random(1)
    for _ in range(300):
        scores = [rnd.randint(-5, 5) for _ in range(rnd.randint(0, 12))]
        low, high = html_text.best_region(scores)
        every = [sum(scores[a:b]) for a in range(len(scores) + 1) for b in range(a, len(scores) + 1)]
        assert sum(scores[low:high]) == max(every)


def test_bpe_equals_the_library(docs, texts):
    tokenizers = pytest.importorskip("tokenizers")
    definition = queries.tokenizer_definition()
    library = tokenizers.Tokenizer.from_str(definition)
    extra = ["don't we'll 12345 ½ ΑΣ İI <|endoftext|>x a\x1cb d\x85e 日本 😀😀 \u0000x", "</w> a</w>", "a" * 300, "<|endoftext|"]
    own = bpe.TrieBpe(definition, max_words=50)
    for text, ids in zip([*texts, *extra], own.encode_batch([*texts, *extra])):
        known = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == known
        assert own.decode(ids) == library.decode(known, skip_special_tokens=False)
    out = by_id(bpe.encode_documents(docs, definition, keep=["doc_id", "size"]))
    assert len(out) == len(texts) and out[1]["size"] == "clash"
    assert all(bytes(out[i * 3 + 1]["token_ids"]) == own.encode_batch([t])[0] for i, t in enumerate(texts))


def test_bpe_seam_equals_plain_merging():
    own = bpe.TrieBpe(queries.tokenizer_definition())
    rnd, tokens = random.Random(2), sorted(own.ids)
    inner = [t for t in tokens if not t.endswith("</w>") and len(t) < 4]
    for _ in range(2000):
        left, right = rnd.choice(inner), rnd.choice(tokens)
        assert own._seam(left, right) == (own._merged(own._split(left) + own._split(right)) == [left, right])


def test_bpe_encodes_words_in_use_once():
    own = bpe.TrieBpe(queries.tokenizer_definition(), max_words=40)
    encoded, encode_words = [], own.encode_words
    own.encode_words = lambda words: encode_words(encoded.extend(words) or words)
    texts = [f"Common COMMON common, {' '.join(f'{a}{b}' for b in 'abcde')}." for a in "qwertzuiop" * 2]
    ids = [own.encode_batch([text])[0] for text in texts]
    assert encoded.count("common") == 1  # in capitals or not, and however often other words fill the table
    assert len(own.words) + len(own.older) <= 40 + 2 * 10  # the pieces of one text come on top in each
    assert ids == [bpe.TrieBpe(queries.tokenizer_definition()).encode_batch([text])[0] for text in texts]


def test_bpe_forgets_seams_not_results():
    own, few = bpe.TrieBpe(queries.tokenizer_definition()), bpe.TrieBpe(queries.tokenizer_definition())
    rnd = random.Random(3)
    words = {"".join(rnd.choices("aeinrst", k=rnd.randint(1, 12))) for _ in range(300)}
    found = own.encode_words(words)
    few.known_seams = 499_990
    assert few.encode_words(words) == found and few.known_seams < 499_990
    for word, ids in found.items():
        symbols = few._merged(few._split(word + "</w>"))
        assert np.frombuffer(ids, "<u4").tolist() == [own.ids[s] for s in symbols]


def test_url_filter(spark):
    urls = ["https://A.Example.ORG/es/1?x", "http://example.org/en/12", "http://b.org/x", "ftp://x.com/de/1", "http://com/fr/2",
            "http://notcom/de/", None, "no url", "http://x.com", "http://bad.net/casino/1", "http://good.net/news/1", "http://x.com"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labelled = spark.createDataFrame(
        [(f"http://bad.net/casino/{i}", True) for i in range(20)] + [(f"http://s{i}.net/news/{i}", False) for i in range(60)]
        + [("http://x.net/", None)], "url string, bad boolean")
    out = {r["page_id"]: r for r in url_filter.judge(pages, labelled, queries.URL_RULES).collect()}
    assert (out[0]["host"], out[0]["path"], out[0]["rule"], out[0]["verdict"]) == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert [out[i]["rule"] for i in range(1, 9)] == ["example.org/en/1", "org/", "com/de/", "com/fr/", None, None, None, None]
    assert (out[6]["host"], out[6]["path"]) == ("", "") and out[7]["verdict"] == "allow"
    assert out[9]["verdict"] == "block" and out[10]["verdict"] == "allow" and out[8]["path"] == ""
    assert len(out) == len(urls)
    none = url_filter.judge(pages, labelled.limit(0), []).collect()
    assert {r["verdict"] for r in none} == {"allow"}


def test_url_rules_of_any_length_and_share(spark):
    words = ["one", "two", "three", "four"]
    urls = [(f"http://b{i}.net/{'/'.join(words)}/{i}", True) for i in range(12)]
    urls += [(f"http://g{w}{i}.net/{'/'.join(x for x in words if x != w)}", False) for w in words for i in range(12)]
    urls += [(f"http://s{i}.net/sure/five/six", True) for i in range(12)] + [(f"http://t{i}.net/five/six", False) for i in range(8)]
    labelled = spark.createDataFrame(urls, "url string, bad boolean")
    pages = spark.createDataFrame(
        [(0, "http://x.net/four/three/two/one"), (1, "http://x.net/one/two/three"), (2, "http://x.net/sure/five/six"),
         (3, "http://x.net/five/six")], "page_id long, url string")
    out = {r["page_id"]: (r["verdict"], r["mined_rules"], r["mined_confidence"]) for r in url_filter.judge(pages, labelled, []).collect()}
    assert out == {0: ("block", 1, 1.0), 1: ("allow", 0, None), 2: ("block", 3, 1.0), 3: ("block", 2, 0.6)}
    for good in (0, 5, 20):  # shares of 1, 0.86 and 0.6
        labelled = spark.createDataFrame(
            [(f"http://b{i}.net/casino/{i}", True) for i in range(30)] + [(f"http://g{i}.net/news/", False) for i in range(good)],
            "url string, bad boolean")
        pages = spark.createDataFrame([(0, "http://x.net/casino"), (1, "http://x.net/news")], "page_id long, url string")
        out = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, labelled, []).collect()}
        assert out == {0: "block", 1: "allow"}


def plain_url_rules(baskets, least, min_confidence):
    """Every combination of tokens counted over all labelled baskets of ``(tokens, bad)``, pruned as the rules are."""
    share, found = sum(bad for _, bad in baskets) / len(baskets), {}
    for tokens in {frozenset(t) for t, bad in baskets if bad}:
        for size in range(1, len(tokens) + 1):
            found |= dict.fromkeys(map(frozenset, itertools.combinations(sorted(tokens), size)))
    for part in found:
        hit = [bad for tokens, bad in baskets if part <= set(tokens)]
        sure = sum(hit) / len(hit)
        found[part] = sure if sum(hit) >= least and sure >= min_confidence and (sure > share or sure == 1) else None
    found = {part: sure for part, sure in found.items() if sure is not None}
    return {part: sure for part, sure in found.items() if not any(p < part and s >= sure for p, s in found.items())}


def test_url_rules_equal_enumeration(spark, monkeypatch):
    rnd = random.Random(8)
    for most in (url_filter.MOST_SETS, -1):
        monkeypatch.setattr(url_filter, "MOST_SETS", most)
        known = []
        for _ in range(220):
            words = sorted(rnd.sample("abcdefg", rnd.randint(1, 5)))
            words += ["h", "i"] if "a" in words else []
            known.append((words, len(words) > 3 and rnd.random() < 0.8 or "d" in words))
        known += [(["k"], True)] * 40 + [(["k"], False)] * 3
        table = lambda rows: spark.createDataFrame(
            [(i, "x://0/" + "/".join(w), b) for i, (w, b) in enumerate(rows)], "page_id long, url string, bad boolean")
        rules = plain_url_rules([(["host:0", *("path:" + w for w in ws)], bad) for ws, bad in known], 5, 0.6)
        assert max(map(len, rules)) > 1
        seen = [(list(w), None) for n in (1, 3, 7) for w in itertools.combinations("abcdefghik", n)]
        out = {r["page_id"]: (r["mined_rules"], r["mined_confidence"]) for r in url_filter.judge(table(seen), table(known), []).collect()}
        for i, (words, _) in enumerate(seen):
            has = {"host:0", *("path:" + w for w in words)}
            fit = [sure for rule, sure in rules.items() if rule <= has]
            assert out[i] == (len(fit), max(fit, default=None)), words


def test_repeated_long_urls_are_mined(spark):
    long = lambda k: "http://x.net/" + "/".join(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}{k}" for i in range(40))
    urls = [(long("p"), True)] * 10 + [(long("q"), False)] * 10 + [(long("r"), i < 16) for i in range(20)]
    urls += [(f"http://g{i}.org/a", False) for i in range(50)]
    labelled = spark.createDataFrame(urls, "url string, bad boolean")
    pages = spark.createDataFrame(list(enumerate(map(long, "pqr"))), "page_id long, url string")
    out = {r["page_id"]: (r["verdict"], r["mined_rules"], r["mined_confidence"]) for r in url_filter.judge(pages, labelled, []).collect()}
    common = 1  # host:x.net, bad in 26 of 40
    assert out == {0: ("block", 40 + common, 1.0), 1: ("block", common, 26 / 40), 2: ("block", 40 + common, 0.8)}


def test_knn_equals_brute_force(spark, monkeypatch):
    rnd = np.random.default_rng(3)
    vectors = [[float(x) for x in rnd.normal(size=8)] for _ in range(150)]
    vectors[20:90] = [vectors[20]] * 70  # a third and more in one place
    rows = [(i, v) for i, v in enumerate(vectors)] + [(500, None), (520, [None] * 8), (540, [float("nan")] * 8), (None, vectors[0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    whole = [[math.floor(64 * float(np.float32(x))) for x in v] for v in vectors]
    expected = []
    for q in range(0, 150, 20):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], w)), i) for i, w in enumerate(whole) if i != q)
        expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:20])]
    out = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in knn.top_k(table, pivots=7).collect())
    assert out == expected
    assert knn.top_k(table.limit(0)).count() == 0
    monkeypatch.setattr(knn, "SCORES", 200)  # several slices of queries in a task
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in knn.top_k(table).collect()) == expected


def test_knn_blocks_are_bounded():
    sizes = {0: 5, 1: 100, 2: 3, 3: 4, 4: 30}
    of, pieces = knn._blocks_of(list(sizes), sizes, np.array([0, 2, 1, 4, 3]), 10)
    assert of == {0: 0, 2: 0, 1: 1, 4: 2, 3: 3} and pieces == {0: 1, 1: 10, 2: 3, 3: 1}


def test_ngram_scores_equal_brute_force(docs, texts, nothing):
    counts, words, own = collections.Counter(), collections.Counter(), {}
    for i, t in enumerate(texts):
        w = ["^", *WORDS.findall(lower(t)), "$"]
        own[i * 3 + 1] = collections.Counter(zip(w, w[1:]))
        counts.update(own[i * 3 + 1])
        words.update(w[1:])
    total, context = sum(words.values()), {**words, "^": len(texts)}
    out = by_id(ngram_lm.score_documents(docs))
    assert out.keys() == own.keys()
    for i, pairs in own.items():
        score = sum(n * math.log10((counts[u, v] - n) / context[u] if counts[u, v] > n else 0.4 * words[v] / total)
                    for (u, v), n in pairs.items())
        assert out[i]["log10_score"] == pytest.approx(score)
        assert out[i]["backed_off"] == sum(n for p, n in pairs.items() if counts[p] == n)
    assert ngram_lm.score_documents(nothing).count() == 0


def _packed(step, batches):
    return [row for batch in step(iter(batches)) for row in batch.to_pylist()]


@pytest.mark.parametrize("block, piece, key", [(1_500_000, 2_000_000, 64), (40, 30, 64), (1_500_000, 2_000_000, 3)])
def test_ngram_blocks_hash_a_word_once_and_lose_none(monkeypatch, block, piece, key):
    texts = [" The cat\x0bthe\x1ccat \n", None, "", " \t ", "\u0130I \x85x\xa0y THE  the the", "the " * 30, "cat"] * 3
    ids = [5, 6, None, 7, 8, 9, 5] + [i + 10 for i in range(7)] + [-1] * 7
    for name, value in {"BLOCK": block, "SLICE": piece, "KEY": key}.items():
        monkeypatch.setattr(ngram_lm, name, value)
    hashed, digest = [], ngram_lm.xxhash.xxh64_intdigest
    monkeypatch.setattr(ngram_lm.xxhash, "xxh64_intdigest", lambda word: hashed.append(word) or digest(word))
    batches = pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "text": texts})
    batches = [batches.slice(0, 9), batches.slice(9, 0), batches.slice(9)]
    words = [(t or "").encode().lower().split() for t in texts]
    counted = collections.Counter(digest(w) for own in words for w in own)

    found = collections.Counter()
    for row in _packed(ngram_lm._counts(7), batches):
        hashes = np.cumsum(ngram_lm._values(row["w"], 8), dtype=np.uint64)
        found.update(dict(zip(hashes.tolist(), ngram_lm._values(row["n"], 4).tolist())))
    assert found == counted
    if block > 1000:  # one block: its distinct words only
        assert len(hashed) == len(counted)

    frequent = np.sort(np.array([digest(b"the")], dtype=np.uint64))
    code = {w: int(ngram_lm._coded(np.array([digest(w)], dtype=np.uint64), frequent)[0]) for own in words for w in own}
    end = int(ngram_lm._END)
    pairs, found = collections.Counter(), collections.Counter()
    for i, own in zip(ids, words):
        line = [end - 1, *(code[w] for w in own), end]
        pairs.update((u, v, ngram_lm._NO_ID if i is None else i) for u, v in zip(line, line[1:]))
    for row in _packed(ngram_lm._pairs(frequent, 300), batches):
        u, v, d, n, docs = ngram_lm._unpacked(pd.DataFrame([row]))
        assert set(ngram_lm._partition(u, v, 300).tolist()) == {row["part"]}
        for key_, many in zip(zip(u.tolist(), v.tolist(), docs[d].tolist()), n.tolist()):
            found[key_] += many
    assert found == pairs


@pytest.mark.parametrize("words", [4, 5])
def test_near_groups_equal_brute_force(docs, texts, nothing, words):
    sets = {}
    for i, t in enumerate(texts):
        w = WORDS.findall(lower(t))
        sets[i * 3 + 1] = {tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} - {()}
    group = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = {k: low if v == high else v for k, v in group.items()}
    out = by_id(near_dedup.near_groups(docs, words, 80))
    assert {i: r["component_id"] for i, r in out.items()} == group
    assert all(r["n_shingles"] == len(sets[i]) and r["kept"] == (group[i] == i) for i, r in out.items())
    left = near_dedup.drop_near_copies(docs, words, 80)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == set(group.values())
    assert near_dedup.near_groups(nothing).count() == 0


def test_likelihood_finds_the_similarity():
    rnd = np.random.default_rng(1)
    for share in (0.5, 0.8, 0.95):
        both = rnd.integers(0, 2**63, int(4000 * share), dtype=np.uint64)
        sides = [np.unique(np.concatenate([both, rnd.integers(0, 2**63, int(4000 * (1 - share)) // 2, dtype=np.uint64)]))
                 for _ in range(2)]
        a, b = near_dedup.registers_of(sides)
        found = near_dedup.likely_similarity([(a > b).sum()], [(a < b).sum()], [len(sides[0])], [len(sides[1])])[0]
        true = len(np.intersect1d(*sides)) / len(np.union1d(*sides))
        assert abs(found - true) < 0.16
        merged = near_dedup.registers_of([np.union1d(*sides)])[0]
        assert (np.maximum(a, b) == merged).all()


@pytest.mark.parametrize("in_one_task", [0, 1000])
def test_connected_components_of_a_long_path(spark, in_one_task):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 105), (105, 103), (7, 7)], "u long, v long").repartition(3)
    out = {r["node"]: r["label"] for r in connected(edges, in_one_task).collect()}
    assert out == {**{i: 0 for i in range(61)}, 100: 100, 103: 100, 105: 100}
    assert connected(edges.limit(0), in_one_task).count() == 0


def test_mixing(docs, texts, nothing):
    planned = by_id(mixing.planned_copies(docs.drop("size")))
    size = {i * 3 + 1: len(WORDS.findall(t or "")) for i, t in enumerate(texts)}
    assert {i: r["size"] for i, r in planned.items()} == size
    totals, targets = collections.Counter(), {}
    for i, r in planned.items():
        totals[r["source"]] += size[i]
        targets[r["source"]] = r["target"]
    assert sum(targets.values()) == pytest.approx(1.5 * sum(size.values()))
    assert all(t <= 2 * totals[s] + 1e-6 for s, t in targets.items())
    assert all(0 <= r["copies"] <= 2 for r in planned.values())
    assert by_id(mixing.planned_copies(docs.drop("size").repartition(7))) == planned
    mix = collections.Counter(r["doc_id"] for r in mixing.mix_sources(docs.drop("size")).collect())
    assert mix == {i: r["copies"] for i, r in planned.items() if r["copies"]}
    assert mixing.planned_copies(nothing.drop("size")).count() == 0
    counted = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("n_words"))
    assert {i: [r[c] for c in mixing.PLAN] for i, r in by_id(mixing.planned_copies(counted, size="n_words")).items()} == {
        i: [r[c] for c in mixing.PLAN] for i, r in planned.items()}


def test_mixing_takes_the_same_rows_of_repeated_ids(spark):
    rows = [(k % 3 if k % 4 else None, f"w{k} two three", "a", {"k": k}) for k in range(300)] + [(7, "b " * 100, "b", None)] * 9
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, notes map<string, int>")
    mixes = [collections.Counter((r["doc_id"], r["text"]) for r in mixing.mix_sources(docs.repartition(n, F.rand(n))).collect()) for n in (2, 7)]
    assert mixes[0] == mixes[1] and 1 < len(mixes[0]) and max(mixes[0].values()) > 1


def test_toxicity_on_held_out_rows(spark, nothing):
    rnd = random.Random(9)
    vocabulary = ["".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(300)]
    rows, labels = [], []
    for i in range(700):
        words = rnd.choices(vocabulary, k=30)
        toxic = i % 5 == 0
        if toxic:
            words[rnd.randrange(30)] = rnd.choice(["vilest", "rotten"]) + rnd.choice(["", "ly", "ness"])
        rows.append((i, " ".join(words), "s", "x"))
        if i % 2 == 0:
            labels.append((i, int(toxic)))
    rows += [(1000, None, None, None), (1001, "", None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    known = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, known)
    scored = by_id(toxicity.score_documents(docs, model))
    wrong = sum((scored[i]["score"] >= 0.5) != (i % 5 == 0) for i in range(700))
    assert wrong <= 7 and scored[1000]["score"] == scored[1001]["score"] < 0.5
    left = toxicity.drop_toxic(docs, known)
    assert left.columns == docs.columns and {1000, 1001} <= {r["doc_id"] for r in left.collect()}
    assert toxicity.train(docs, known.limit(0)) == toxicity.Model({}, 0.0)
    assert toxicity.score_documents(nothing, model).count() == 0


def test_toxicity_of_repeated_ids_does_not_change(spark):
    rows = [(i % 300, f"w{i % 11} {'vilest' if i % 5 == 0 and i < 1100 else 'plain'} v{i}", None, None) for i in range(1200)]
    rows += [(i, None, None, None) for i in range(20)]
    docs = spark.createDataFrame(rows, DOCS)
    known = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)], "doc_id long, toxic int")
    models = [toxicity.train(docs.repartition(n, F.rand(n)), known) for n in (2, 9)]
    assert models[0] == models[1] and models[0].weights


def test_risk_is_the_non_negative_one():
    """Weights learned from separable samples separate them, whatever share of the unlabelled ones is positive."""
    rnd = np.random.default_rng(6)
    positive = (rnd.random((300, 4)) < [0.9, 0.5, 0.1, 0.5]).astype(np.float32)
    negative = (rnd.random((900, 4)) < [0.1, 0.5, 0.9, 0.5]).astype(np.float32)
    for hidden in (30, 300):
        unlabelled = np.vstack([negative, positive[:hidden]])
        weights, bias = toxicity.nnpu_fit(positive, unlabelled, hidden / len(unlabelled))
        assert weights[0] > 0 > weights[2] and abs(weights[1]) + abs(weights[3]) < weights[0] - weights[2]


def test_line_dedup(spark, nothing):
    rows = [(i, f"own {i}\n  Shared\tLine \r\n\nshared\tline\nlast", "s", "x") for i in range(12)]
    rows += [(50, None, None, None), (51, "", None, None), (52, "x\n" * 2000 + "rare", None, None), (12, "LAST\n\x0b last", None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    for batches in (1, 5):
        out = by_id(line_dedup.drop_frequent_lines(docs, batches=batches))
        assert [(out[i]["text"], out[i]["n_lines"], out[i]["n_dropped"]) for i in range(12)] == [(f"own {i}\n", 5, 3) for i in range(12)]
        assert (out[12]["text"], out[12]["n_lines"], out[12]["n_dropped"]) == ("", 2, 2)
        assert (out[50]["text"], out[50]["n_lines"], out[51]["text"], out[52]["text"]) == (None, 1, "", rows[14][1])
    assert line_dedup.drop_frequent_lines(nothing).count() == 0


def test_columns_named_like_those_of_the_operators(spark, docs):
    """Extra columns of any name: operators put their own in place, whatever returns documents keeps those of the input."""
    names = ["N_lines", "n_dropped", "source_size", "target", "copies", "score", "__n"]
    more = docs.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in names])
    known = spark.createDataFrame([(1, 0), (4, 1)], "doc_id long, toxic int")
    rows = lambda df: sorted(df.drop("text").collect(), key=str)
    same = lambda a, b: a.columns == b.columns and rows(a) == rows(b)
    planned = mixing.planned_copies(more)
    assert len({c.lower() for c in planned.columns}) == len(planned.columns) == len(more.columns)
    expected = by_id(mixing.planned_copies(docs.drop("size")))
    assert {i: [r[c] for c in mixing.PLAN] for i, r in by_id(planned).items()} == {
        i: [r[c] for c in mixing.PLAN] for i, r in expected.items()}
    mix = mixing.mix_sources(more)
    assert mix.columns == more.columns
    ids = collections.Counter(r["doc_id"] for r in mix.collect())
    assert ids == {i: r["copies"] for i, r in expected.items() if r["copies"]}
    assert {(r["size"], r["copies"] == f"copies {r['doc_id']}", r["target"] == f"target {r['doc_id']}") for r in mix.collect()} == {
        ("clash", True, True)}
    lines, plain = line_dedup.drop_frequent_lines(more), line_dedup.drop_frequent_lines(docs)
    assert len(lines.columns) == len(more.columns)
    assert same(lines.select(*plain.columns), plain) and same(line_dedup.without_frequent_lines(more), more)
    scored = toxicity.score_documents(more, toxicity.Model({}, 0.0))
    assert len(scored.columns) == len(more.columns) and dict(scored.dtypes)["score"] == "double"
    assert same(toxicity.drop_toxic(more, known, threshold=2.0), more)
    pages = spark.createDataFrame([(1, "<p>words", "http://a.org/x", "mine")], "page_id long, html string, url string, Text string")
    assert [tuple(r) for r in html_text.extract(pages, html_text.DEFAULT_WEIGHTS).collect()] == [(1, "<p>words", "http://a.org/x", "words")]
    judged = url_filter.judge(pages.withColumnRenamed("Text", "path").withColumn("rule", F.lit(1)), pages.select(
        "url", F.lit(None).cast("boolean").alias("bad")), queries.URL_RULES).first()
    assert (judged["path"], judged["rule"], judged["verdict"], len(judged)) == ("/x", "org/", "allow", 9)


def test_line_runs_are_compacted_and_find_new_lines(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    for batch in range(5):
        lines = spark.createDataFrame([(1, batch), (2, 7)], "key long, hash long")
        assert runs.unseen(lines).count() == (2 if batch == 0 else 1)
        runs.add(lines)
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert {r["hash"]: r["n"] for r in runs.counts().collect()} == {0: 1, 1: 1, 2: 1, 3: 1, 4: 1, 7: 5}


def test_every_batch_of_lines_goes_through_the_runs(spark, docs):
    lines = line_dedup.line_table(docs)
    rnd = random.Random(4)
    more = spark.createDataFrame([(k, rnd.randrange(40)) for k in range(300)], "key long, hash long")
    lines = lines.unionByName(more)
    expected = collections.Counter(r["hash"] for r in lines.collect())
    runs = line_dedup.add_batches(line_dedup.LineRuns(spark, fanout=3), lines, 5)
    assert [len(level) for level in runs.levels] == [2, 1]
    rows = [r for run in runs.runs() for r in run.collect()]
    assert sorted(r["hash"] for r in rows if r["first"]) == sorted(expected)
    assert any(not r["first"] for r in rows)
    assert {r["hash"]: r["n"] for r in runs.counts().collect()} == expected
    plan = runs.unseen(line_dedup.line_table(docs))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 3 and plan.count("LeftAnti") == 3


def test_near_dedup_comparison_joins_all_that_is_similar():
    """Many small blocks and one large, against the exact similarity of every pair of a stray and a member of another component."""
    rng = np.random.default_rng(3)
    sets, keys = [], []
    for family in range(60):
        base = rng.integers(0, 2**63, 120, dtype=np.uint64)
        for copy in range(5):
            own = base.copy()
            changed = rng.integers(0, 60)
            own[:changed] = rng.integers(0, 2**63, changed, dtype=np.uint64)
            sets.append(np.unique(own))
            keys.append(family if family < 40 else 99)
    registers = near_dedup.registers_of(sets)
    n = np.array([len(s) for s in sets])
    frame = pd.DataFrame({"unit": keys, "node": np.arange(len(sets)), "label": np.arange(len(sets)) // 2, "n": n,
                          "registers": [r.tobytes() for r in registers], "shingles": [s.astype("<u8").tobytes() for s in sets]})
    strays = frame.rename(columns={"unit": "of"})
    limit = 0.8 - near_dedup.SLACK
    found = near_dedup._compared(limit, 80)(frame, strays)

    def parts(links):
        root = {i: i // 2 * 2 for i in range(len(sets))}

        def top(i):
            while root[i] != i:
                i = root[i]
            return i

        for x, y in links:
            a, b = top(x), top(y)
            root[max(a, b)] = min(a, b)
        return [top(i) for i in range(len(sets))]

    similar = lambda x, y: len(np.intersect1d(sets[x], sets[y])) >= 0.8 * len(np.union1d(sets[x], sets[y]))
    wanted = [(x, y) for x in range(len(sets)) for y in range(x) if keys[x] == keys[y] and x // 2 != y // 2 and similar(x, y)]
    links = list(zip(found["u"], found["v"]))
    assert wanted and parts(links) == parts(wanted)
    assert all(similar(x, y) for x, y in links) and len(links) < len(sets) // 2
    empty = near_dedup._compared(limit, 80)(frame[:0], strays)
    assert len(empty) == 0 and list(empty.columns) == ["u", "v"]
