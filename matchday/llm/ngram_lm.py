"""Stupid-backoff scores of documents, from n-gram counts over the whole corpus.

A document is its words (U+0020, U+0009 to U+000D split, A-Z lower-cased) and an end mark; each word is scored after the
word before it, the first one by itself. With C the counts over all rows and n the count in the document itself,

    S(v | u) = (C(u v) - n(u v)) / C(u)   if another document has u v, else  alpha * C(v) / N

so that a document is no evidence for itself. Scores are sums of log10 S.

The pair counts are tables partitioned by hash, and the documents' own pairs come to them: each task packs the distinct
(u, v, document, n) of its documents by partition, sorted, so that most of a row is the hash of a rare word. A partition
is chosen by u, or by u and v where u is one of the frequent words (more than 1 / FREQUENT of all words, so at
most FREQUENT of them, with counts sent to all tasks): no word makes a partition large. Partitions give the sums of the pairs they
know; the words of the other pairs go on to the word counts in the same way. The sums are added per document.

Rows with one doc_id are one document of several parts. A NULL text has no words and scores its end mark alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.llm.common import mixed, stored

FREQUENT = 20_000
#: Words packed together in a task, and pairs in one partition.
BLOCK, PARTITION = 1_500_000, 2_000_000
#: Bytes of text split into words at once, or one longer text; bits of a sort key.
SLICE, KEY = 2_000_000, 64
_RARE = np.uint64(1 << 63)
_END = np.uint64((1 << 63) - 1)  # code of the end mark: neither a frequent nor a rare word
_NO_ID = -(1 << 63)


def _planes(values: np.ndarray, width: int) -> bytes:
    """Integers as compressed byte planes."""
    rows = values.astype(f"<u{width}").view(np.uint8).reshape(len(values), width)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(rows.T).tobytes())


def _values(data: bytes, width: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(f"<u{width}").ravel()


def _steps(values: np.ndarray) -> np.ndarray:
    return np.diff(values.astype(np.uint64), prepend=np.uint64(0))


def _pack(u, v, d, n) -> dict[str, bytes]:
    return {"u": _planes(_steps(u), 8), "v": _planes(v, 8), "d": _planes(d, 4), "n": _planes(n, 4)}


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Positions where sorted columns change."""
    if not len(columns[0]):
        return np.zeros(0, dtype=np.int64)
    new = np.zeros(len(columns[0]), dtype=bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _by_part(part: np.ndarray) -> list[np.ndarray]:
    """The positions of each partition, in order (numpy sorts numbers of 16 bits by radix)."""
    order = np.argsort(part.astype(np.min_scalar_type(int(part.max(initial=0)))), kind="stable")
    return [own for own in np.split(order, _starts(part[order])[1:]) if len(own)]


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of texts one after another, A-Z lower-cased, and how many each text has."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words = split.flatten()
    full = np.asarray(pc.greater(pc.binary_length(words), 0))  # white space at an end leaves an empty word
    at = np.append(0, np.cumsum(full))[np.asarray(split.offsets)]
    return words.filter(pa.array(full)), np.diff(at)


def _blocks(batches: Iterator[pa.RecordBatch]):
    """Documents in blocks of about BLOCK words: ``(ids, words of each, the place of every word's hash, hashes)``."""
    def block():
        words = pa.concat_arrays(held).dictionary_encode()
        different = words.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, different), dtype=np.uint64, count=len(different))
        return np.concatenate(ids), np.concatenate(sizes), words.indices.to_numpy(), hashes

    ids, sizes, held, many = [], [], [], 0
    for batch in batches:
        texts, own = batch.column(1), batch.column(0).cast(pa.int64()).fill_null(_NO_ID).to_numpy(zero_copy_only=False)
        length = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = [*_starts(np.cumsum(length) // SLICE), len(own)]
        for start, end in zip(cuts, cuts[1:]):
            words, n = _words(texts.slice(start, end - start))
            ids.append(own[start:end])
            sizes.append(n)
            held.append(words)
            many += len(words) + len(n) + int(length[start:end].sum()) // 64  # very long words fill a block too
            if many >= BLOCK:
                yield block()
                ids, sizes, held, many = [], [], [], 0
    if ids:
        yield block()


_COUNTED = pa.schema([("part", pa.int32()), ("w", pa.binary()), ("n", pa.binary())])


def _counts(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, index, hashes in _blocks(batches):
            order = np.argsort(hashes)
            w, n = hashes[order], np.bincount(index, minlength=len(hashes))[order]
            part = (mixed(w) % np.uint64(parts)).astype(np.int32)
            yield pa.RecordBatch.from_pylist(
                [{"part": int(part[own[0]]), "w": _planes(_steps(w[own]), 8), "n": _planes(n[own], 4)} for own in _by_part(part)],
                schema=_COUNTED)

    return run


def _summed(group: pd.DataFrame) -> pd.DataFrame:
    w = np.concatenate([np.cumsum(_values(x, 8), dtype=np.uint64) for x in group["w"]])
    n = np.concatenate([_values(x, 4) for x in group["n"]]).astype(np.int64)
    order = np.argsort(w, kind="stable")
    at = _starts(w[order])
    return pd.DataFrame({"word": w[order][at].view(np.int64), "n": np.add.reduceat(n[order], at)})


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("text").cast("string").alias("text"))


def word_counts(docs: DataFrame, parts: int) -> DataFrame:
    """``(word, n)``: how often each word (by its hash) occurs in all rows."""
    packed = _texts(docs).mapInArrow(_counts(parts), "part int, w binary, n binary")
    return packed.groupBy("part").applyInPandas(_summed, "word long, n long")


def _coded(hashes: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Codes of words: the place among the frequent ones, or the hash with the highest bit set."""
    at = np.minimum(np.searchsorted(frequent, hashes), max(len(frequent) - 1, 0))
    known = frequent[at] == hashes if len(frequent) else np.zeros(len(hashes), dtype=bool)
    return np.where(known, at.astype(np.uint64), (hashes >> np.uint64(1)) | _RARE)


def _partition(u: np.ndarray, v: np.ndarray, parts: int) -> np.ndarray:
    """Of a pair: by u, or by both where u is a frequent word."""
    return (mixed(np.where(u < _RARE, mixed(u) + v, u)) % np.uint64(parts)).astype(np.int32)


def _split_rows(part, u, v, d, n, ids):
    for own in _by_part(part):
        docs, place = np.unique(d[own], return_inverse=True)
        yield {"part": int(part[own[0]]), **_pack(u[own], v[own], place, n[own]), "ids": _planes(_steps(ids[docs].view(np.uint64)), 8)}


_PACKED = "part int, u binary, v binary, d binary, n binary, ids binary"
_COLUMNS = ["part", "u", "v", "d", "n", "ids"]
_SHIPPED = pa.schema([(c, pa.int32() if c == "part" else pa.binary()) for c in _COLUMNS])


def _distinct(u: np.ndarray, v: np.ndarray, d: np.ndarray, words: int, docs: int):
    """The different (u, v, d) in order, of numbers below ``words`` and ``docs``, and how often each occurs."""
    wide, narrow = max(words - 1, 1).bit_length(), max(docs - 1, 1).bit_length()
    if 2 * wide + narrow <= KEY:  # one number holds all three
        key = np.sort((u << np.uint64(wide) | v) << np.uint64(narrow) | d)
        at = _starts(key)
        n, key = np.diff(np.append(at, len(key))), key[at]
        low, lower = np.uint64((1 << wide) - 1), np.uint64((1 << narrow) - 1)
        return key >> np.uint64(wide + narrow), key >> np.uint64(narrow) & low, key & lower, n
    order = np.lexsort((d, v, u))
    u, v, d = u[order], v[order], d[order]
    at = _starts(u, v, d)
    return u[at], v[at], d[at], np.diff(np.append(at, len(order)))


def _pairs(frequent: np.ndarray, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sizes, index, hashes in _blocks(batches):
            # The mark before the first word and the end mark come last; numbers of words are in the order of their codes.
            codes, number = np.unique(np.append(_coded(hashes, frequent), [_END - np.uint64(1), _END]), return_inverse=True)
            number = number.astype(np.uint64)
            d = np.repeat(np.arange(len(ids), dtype=np.uint64), sizes + 1)
            last = np.cumsum(sizes + 1) - 1
            v = np.full(len(d), number[-1])
            v[np.delete(np.arange(len(d)), last)] = number[index]
            u = np.roll(v, 1)
            u[last - sizes] = number[-2]
            u, v, d, n = _distinct(u, v, d, len(codes), len(ids))
            u, v = codes[u.view(np.int64)], codes[v.view(np.int64)]
            yield pa.RecordBatch.from_pylist(
                list(_split_rows(_partition(u, v, parts), u, v, d.view(np.int64), n, ids)), schema=_SHIPPED)

    return run


def _unpacked(group: pd.DataFrame):
    u, v, d, n, ids, held = [], [], [], [], [], 0
    for row in group.itertuples():
        u.append(np.cumsum(_values(row.u, 8), dtype=np.uint64))
        v.append(_values(row.v, 8))
        d.append(_values(row.d, 4).astype(np.int64) + held)
        n.append(_values(row.n, 4).astype(np.int64))
        ids.append(np.cumsum(_values(row.ids, 8), dtype=np.uint64).view(np.int64))
        held += len(ids[-1])
    return tuple(map(np.concatenate, (u, v, d, n, ids)))


def _sums(part: np.ndarray, rows: dict[str, np.ndarray]) -> list[dict]:
    return [{"part": int(part[own[0]]), **{k: x[own] for k, x in rows.items()}} for own in _by_part(part)]


_SUMS = "doc_part int, ids binary, score binary, backed_off binary, pairs binary"


def _sum_rows(ids, score, backed, pairs, parts: int) -> list[dict]:
    """Sums per document of one partition, packed by a hash of the document."""
    docs, place = np.unique(ids, return_inverse=True)
    part = (mixed(docs.view(np.uint64)) % np.uint64(parts)).astype(np.int32)
    total = [np.bincount(place, weights=x, minlength=len(docs)) for x in (score, backed, pairs)]
    return [{"doc_part": x["part"], "ids": _planes(_steps(x["docs"].view(np.uint64)), 8), "score": x["s"].tobytes(),
             "backed_off": _planes(x["b"].astype(np.int64), 4), "pairs": _planes(x["p"].astype(np.int64), 4)}
            for x in _sums(part, {"docs": docs, "s": total[0], "b": total[1], "p": total[2]})]


def _scored(counts: np.ndarray, n_words: int, n_documents: int, alpha: float, parts: int, doc_parts: int):
    """Scores of the pairs of one partition; words of unknown rare pairs are passed on."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        u, v, d, n, ids = _unpacked(group)
        number, _ = pd.factorize(u)  # of the context, then of the pair
        context = np.bincount(number, weights=n)[number]
        second, different = pd.factorize(v)
        number *= len(different)
        number += second
        del second, different  # the table of pairs is the largest thing here
        number, _ = pd.factorize(number)
        pair = np.bincount(number, weights=n)[number]
        del number
        frequent = u < np.uint64(len(counts))
        context[frequent] = counts[u[frequent].astype(np.int64)]
        context[u == _END - np.uint64(1)] = n_documents
        others = pair - n
        seen = others > 0
        score = np.zeros(len(u))
        score[seen] = n[seen] * np.log10(others[seen] / context[seen])
        single = np.full(len(u), np.nan)
        known = v < np.uint64(len(counts))
        single[known] = counts[v[known].astype(np.int64)]
        single[v == _END] = n_documents
        off = ~seen
        score[off] = n[off] * (math.log10(alpha) - math.log10(n_words))
        now = off & ~np.isnan(single)
        score[now] += n[now] * np.log10(single[now])
        rows = _sum_rows(ids[d], score, n * off, n, doc_parts)
        later = np.flatnonzero(off & np.isnan(single))
        if len(later):
            own, who, many = v[later], d[later], n[later]
            order = np.lexsort((who, own))
            own, who, many = own[order], who[order], many[order]
            at = _starts(own, who)
            many, own, who = np.add.reduceat(many, at), own[at], who[at]
            rows += list(_split_rows((mixed(own) % np.uint64(parts)).astype(np.int32), own, np.zeros_like(own), who, many, ids))
        return pd.DataFrame(rows, columns=["doc_part", "score", "backed_off", "pairs", *_COLUMNS])

    return run


def _word_scores(doc_parts: int):
    def run(postings: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(postings):
            w, _, d, n, ids = _unpacked(postings)
            code = counts["word"].to_numpy(dtype=np.int64).view(np.uint64)
            order = np.argsort(code, kind="stable")
            code, c = code[order], counts["n"].to_numpy(dtype=np.int64)[order]
            rows = _sum_rows(ids[d], n * np.log10(c[np.searchsorted(code, w)]), np.zeros(len(w)), np.zeros(len(w)), doc_parts)
        return pd.DataFrame(rows, columns=["doc_part", "ids", "score", "backed_off", "pairs"])

    return run


def _per_document(group: pd.DataFrame) -> pd.DataFrame:
    ids = np.concatenate([np.cumsum(_values(x, 8), dtype=np.uint64).view(np.int64) for x in group["ids"]])
    docs, place = np.unique(ids, return_inverse=True)
    score = np.bincount(place, weights=np.concatenate([np.frombuffer(x) for x in group["score"]]))
    backed, pairs = (np.bincount(place, weights=np.concatenate([_values(x, 4) for x in group[c]])).astype(np.int64)
                     for c in ("backed_off", "pairs"))
    return pd.DataFrame({"doc_id": pd.array([None if i == _NO_ID else int(i) for i in docs], dtype="Int64"),
                         "n_scored": pairs, "backed_off": backed, "log10_score": score})


def score_documents(docs: DataFrame, alpha: float = 0.4) -> DataFrame:
    """``(doc_id, n_scored, backed_off, log10_score)``: scored words (with the end mark), how many backed off, the sum."""
    docs = docs.select("doc_id", "text")
    n_documents = docs.count()
    schema = "doc_id long, n_scored long, backed_off long, log10_score double"
    if not n_documents:
        return docs.sparkSession.createDataFrame([], schema)
    counted = stored(word_counts(docs, max(64, n_documents // 5000)), "words")
    n_words = (counted.agg(F.sum("n")).first()[0] or 0) + n_documents  # with the end marks
    parts = int(max(64, n_words // PARTITION))
    doc_parts = int(max(64, n_documents // 20_000))
    # At most FREQUENT rows: each has more than 1 / FREQUENT of all words.
    rows = counted.filter(F.col("n") > n_words / FREQUENT).collect()
    frequent = np.array([r["word"] for r in rows], dtype=np.int64).view(np.uint64)
    order = np.argsort(frequent)
    frequent, counts = frequent[order], np.array([r["n"] for r in rows], dtype=np.float64)[order]
    pairs = _texts(docs).mapInArrow(_pairs(frequent, parts), _PACKED)
    scored = stored(pairs.groupBy("part").applyInPandas(
        _scored(counts, n_words, n_documents, alpha, parts, doc_parts),
        f"doc_part int, score binary, backed_off binary, pairs binary, {_PACKED}"), "pair-scores")

    def coded(batches):
        for batch in batches:
            code = _coded(batch["word"].to_numpy(np.int64).view(np.uint64), frequent)
            rare = code >= _RARE
            part = (mixed(code) % np.uint64(parts)).astype(np.int32)
            yield pd.DataFrame({"part": part[rare], "word": code[rare].view(np.int64), "n": batch["n"].to_numpy()[rare]})

    rare = counted.mapInPandas(coded, "part int, word long, n long")
    later = scored.filter("doc_part is null").select(*_COLUMNS).groupBy("part").cogroup(rare.groupBy("part")).applyInPandas(
        _word_scores(doc_parts), _SUMS)
    sums = scored.filter("doc_part is not null").select("doc_part", "ids", "score", "backed_off", "pairs").unionByName(later)
    return sums.groupBy("doc_part").applyInPandas(_per_document, schema)
