"""Registered queries against their SQL, and the pipeline's stages."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import pytest

import corpus_pipeline
from matchday.llm import oracles, queries, toxicity
from matchday.llm.common import table

TABLES = ("documents", "embeddings", "pages", "labels", "benchmark")


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    own = queries.queries()[name](spark, sf_dir)
    found = con.execute(f"SELECT {', '.join(own.columns)} FROM ({oracles.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, own.collect())) == sorted(found)


def test_pipeline_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns, kept = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns and 0 < docs.count() <= kept
        kept = docs.count()
    mixed = corpus_pipeline.stored(corpus_pipeline.mix(spark, docs, sf_dir), "mixing")
    assert mixed.columns == columns
    last = corpus_pipeline.encode(spark, mixed, sf_dir)
    assert last.count() == mixed.count() == corpus_pipeline.run(spark, sf_dir).count()


def plain_lines(docs):
    """Texts without the lines that ten documents or more hold."""
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    held = collections.Counter(k for i, t, _ in docs for k in {key(x) for x in (t or "").split("\n")} - {""})
    left = lambda t: t and "\n".join(x for x in t.split("\n") if held[key(x)] < 10)
    return [(i, left(t), s) for i, t, s in docs]


def plain_near(docs):
    """The document of the smallest id of each group of near copies; a NULL id has a text of its own here."""
    sets = []
    for _, t, _ in docs:
        w = (t or "").lower().split()
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    group = list(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    least = {g: min((docs[k] for k in range(len(docs)) if group[k] == g), key=lambda d: (d[0] is None, d[0] or 0)) for g in group}
    return list(least.values())


def plain_mix(docs):
    """Documents in the order (words, remainder of the id, id) of a source, one for each integer that their intervals reach."""
    size = lambda t: len((t or "").split())
    sources = sorted({s for _, _, s in docs}, key=lambda s: (s is None, s or ""))
    words = {s: sum(size(t) for _, t, x in docs if x == s) for s in sources}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    low, high = 0.0, 1e9
    for _ in range(200):  # the level at which the targets sum up
        level = (low + high) / 2
        reached = sum(min(2 * words[s], level * weight[s]) for s in sources) >= 1.5 * sum(words.values())
        low, high = (low, level) if reached else (level, high)
    out = []
    for s in sources:
        rate = min(2 * words[s], high * weight[s]) / words[s]
        keyed = "1" if s is None else "0" + s
        offset = int(hashlib.md5(f"mix{keyed}".encode()).hexdigest()[:8], 16) / 2**32
        part = lambda d: d[0] % 4096 if d[0] is not None else zlib.crc32((d[1] or "").encode()) % 4096
        own = sorted((d for d in docs if d[2] == s), key=lambda d: (size(d[1]), part(d), d[0] or 0))
        for place, d in enumerate(own):
            out += [d] * (math.floor(offset + (place + 1) * rate) - math.floor(offset + place * rate))
    return out


def test_pipeline_equals_plain_python(spark, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    rnd = random.Random(4)
    vocabulary = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(200)]
    docs = []
    for i in range(150):
        lines = [" ".join(rnd.choices(vocabulary, k=rnd.choice((6, 6, 9, 30)))) for _ in range(2)]
        if i % 5 == 0:
            lines[1] += " vilest"
        docs.append((5 * i, "\n".join([*lines, " Shared LINE"] if i % 4 == 0 else lines), ("web", "books", None, "news")[i % 4]))
    copies = [(4000 + i, docs[3 + i % 3][1] + f" edit{i}", "web") for i in range(9)] + [(2, docs[7][1], "news")]
    docs += copies + [(None, "text of no id", "web"), (9001, None, "web"), (9002, "", None), (9003, "shared line", "books")]
    labels = [(5 * i, int(i % 5 == 0)) for i in range(150)]
    spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    model = toxicity.train(table(spark, tmp_path, "documents"), table(spark, tmp_path, "labels"))
    clean = lambda rows: [d for d in rows if model.score(d[1]) < 0.5]
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    staged, plain = table(spark, tmp_path, "documents"), docs
    for (name, stage), by_hand in zip(corpus_pipeline.STAGES, (clean, plain_lines, plain_near, plain_mix)):
        staged, before = corpus_pipeline.stored(stage(spark, staged, str(tmp_path)), name), plain
        plain = by_hand(plain)
        assert rows(staged) == sorted(plain, key=str), name
        assert plain != before
    library = tokenizers.Tokenizer.from_str(queries.tokenizer_definition())
    sha = lambda data: hashlib.sha256(data).hexdigest()
    expected = []
    for i, t, _ in plain:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected.append((i, len(ids), sha(b"".join(n.to_bytes(4, "little") for n in ids)),
                         sha(library.decode(ids, skip_special_tokens=False).encode())))
    assert rows(corpus_pipeline.run(spark, str(tmp_path))) == sorted(expected, key=str)
