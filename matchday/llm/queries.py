"""The registered queries of the operators: thin digests of what each operator returns."""

from __future__ import annotations

from collections.abc import Callable

import hashlib
import os
import zlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchday.llm import (
    bpe, fingerprints, html_text, knn, lexical_search, license_scan, line_dedup, mixing, near_dedup, ngram_lm, periodic_runs,
    toxicity, url_filter,
)
from matchday.llm.common import held_out, stored, table

def tokenizer_definition(name: str = "word_bpe_49k.json", folder: str | None = os.environ.get("TOKENIZER_FOLDER")) -> str:
    """The text of a tokenizer file of ``folder``; where none is given, of the installed ``public_tokenizers``."""
    if folder is None:
        import public_tokenizers  # only needed here, on the driver
        path = public_tokenizers.path(name)
    else:
        path = os.path.join(folder, name)
    with open(path, encoding="utf-8") as file:
        return file.read()


def _token_digests(frame: pd.DataFrame) -> pd.DataFrame:
    sha = lambda data: hashlib.sha256(data).hexdigest()
    return pd.DataFrame({
        "doc_id": frame["doc_id"], "n_tokens": frame["token_ids"].map(len) // 4,
        "ids_sha256": frame["token_ids"].map(sha),
        "decoded_sha256": frame["decoded"].map(lambda t: sha(t.encode("utf-8", "surrogatepass"))),
    })


def token_digests(docs: DataFrame) -> DataFrame:
    return bpe.encode_documents(docs, tokenizer_definition(), finish=_token_digests, keep=["doc_id"],
                                schema="n_tokens long, ids_sha256 string, decoded_sha256 string")


#: The rules of the url query: verdict, host, path (fixed values of its contract).
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_chars", "edited_sha256", fingerprints.fingerprint_text(F.col("hashes")).alias("fingerprint"),
        fingerprints.fingerprint_text(F.col("edited_hashes")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
        fingerprints.likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_text.extract(pages, html_text.learn_weights(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad pages are those whose document of the same number is labelled toxic or of low quality."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("page_id")).agg(
        F.max((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad"))
    return url_filter.judge(pages, pages.join(labels, "page_id").select("url", "bad"), URL_RULES)


def op5_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


def op6_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ngram_lm.score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scored.withColumn("per_word", F.round(F.col("log10_score") / F.col("n_scored"), 6)).withColumn(
        "log10_score", F.round("log10_score", 4))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), words=4, percent=80)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("n_words"))
    planned = mixing.planned_copies(stored(docs, "sizes"), size="n_words")
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_documents(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_frequent_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


#: The phrases whose unchanged places op11 counts, all in license_scan.NOTICES too (fixed values of its contract).
BASE_NOTICES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def _notice_digest(n_words: int, hits: list[license_scan.Hit]) -> tuple:
    base = [h for h in hits if h.edits == 0 and h.notice in BASE_NOTICES]
    starts = [h.first_word for h in base]
    joined = lambda labels: ",".join(sorted(set(labels)))
    return (n_words, len(base), min(starts, default=None), max(starts, default=None), joined(h.label for h in base),
            joined(h.label for h in hits), max((h.likeness for h in hits), default=0.0))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
              "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64()}
    return license_scan.scan_notices(table(spark, sf_dir, "documents"), keep=["doc_id"], finish=_notice_digest, fields=fields)


def repeated_words(text: bytes, row: tuple) -> list[bytes]:
    """The words of op12: in every tenth document by crc32 of its id, those from place a on repeat p of them."""
    words, (doc_id,) = text.split(), row
    crc = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if crc % 10 or not words:
        return words
    g, n = crc // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def _run_digest(words: list[bytes], runs: list[periodic_runs.Run], kept: list[bytes]) -> tuple:
    start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (len(runs), start, length, period, 1000 * length // period if runs else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A NULL doc_id has no decimal form: its words stay as they are."""
    fields = dict.fromkeys(("n_runs", "start", "length", "period", "exponent_milli"), pa.int64()) | dict.fromkeys(
        ("runs_sha256", "collapsed_sha256"), pa.string())
    return periodic_runs.find_runs(table(spark, sf_dir, "documents"), least=6, times=4, keep=["doc_id"], words_of=repeated_words,
                                   finish=_run_digest, fields=fields)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_fingerprints": op1_fingerprints, "op2_html_text": op2_html_text, "op3_bpe": op3_bpe,
            "op4_url_filter": op4_url_filter, "op5_knn": op5_knn, "op6_ngram_lm": op6_ngram_lm, "op7_near_dedup": op7_near_dedup,
            "op8_mixing": op8_mixing, "op9_toxicity": op9_toxicity, "op10_line_dedup": op10_line_dedup,
            "op11_license_scan": op11_license_scan, "op12_periodic_runs": op12_periodic_runs,
            "op13_lexical_search": op13_lexical_search}
