"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier is fitted in numpy from confirmed toxic texts (positives) and texts of unknown kind. With the class
prior p (the share of toxic texts among the labelled ones) the risk is p * R+(positives) + max(0, R-(unlabelled) -
p * R-(positives)): the share of positives hidden in the unlabelled part is taken out, and the difference may not
turn negative, else the step goes back up.

Features of a text: which of the selected words and word beginnings (5 and 6 letters) it has, lower-cased. Features are selected
by how much more often positives have them. Labels come only from rows whose crc32(id) leaves a remainder by 5; id,
language, source and label are never inputs of a score.

``max_positive`` and ``max_unlabelled`` bound the rows the classifier is fitted on (the smallest hashes of their ids), and
``max_features`` its size; every text is scored whole. NULL and empty texts score by the bias alone. Without any
confirmed toxic text every score is 0. Repeated labels of one id count once, toxic if any says so; NULL ids have no label.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.llm.common import held_out, others, stored

_WORDS = re.compile(r"\w+")
_BEGINNINGS = (5, 6)


def text_features(text: str | None) -> set[str]:
    """Distinct lower-cased words, and the beginnings of longer ones (marked by ``*``)."""
    words = set(_WORDS.findall((text or "").lower()))
    out = set(words)
    for n in _BEGINNINGS:
        out.update([w[:n] + "*" for w in words if len(w) > n])
    return out


@dataclass
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        weights = self.weights
        if not weights:
            return 0.0
        total = self.bias + math.fsum(weights[f] for f in text_features(text) & weights.keys())
        return 1.0 / (1.0 + math.exp(-min(max(total, -500.0), 500.0)))


def nnpu_fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 400, rate: float = 0.05,
             decay: float = 1e-4, beta: float = 0.0) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk with the logistic loss, by full-batch Adam steps."""
    d = positive.shape[1]
    theta = np.zeros(d + 1)
    theta[d] = math.log(prior / (1 - prior))
    first, second = np.zeros(d + 1), np.zeros(d + 1)

    def sigmoid(z):
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))

    def gradient(x, by_row):
        return np.append(x.T @ by_row, by_row.sum()) / max(len(x), 1)

    for step in range(1, steps + 1):
        at_p, at_u = positive @ theta[:d] + theta[d], unlabelled @ theta[:d] + theta[d]
        negative_part = np.logaddexp(0, at_u).mean() - prior * np.logaddexp(0, at_p).mean()
        negative_grad = gradient(unlabelled, sigmoid(at_u)) - prior * gradient(positive, sigmoid(at_p))
        if negative_part >= -beta:
            grad = prior * gradient(positive, sigmoid(at_p) - 1) + negative_grad
        else:
            grad = -negative_grad
        grad[:d] += decay * theta[:d]
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:d], float(theta[d])


def _features_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"positive": batch["positive"], "features": [list(text_features(t)) for t in batch["text"]]})


def _indices_of(index: dict[str, int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [sorted(index[f] for f in text_features(t) & index.keys()) for t in batch["text"]]
            yield pd.DataFrame({"positive": batch["positive"], "found": found})

    return run


def _dense(lists: list, width: int) -> np.ndarray:
    out = np.zeros((len(lists), width), dtype=np.float32)
    for row, found in enumerate(lists):
        out[row, found] = 1.0
    return out


def train(docs: DataFrame, labels: DataFrame, max_positive: int = 2000, max_unlabelled: int = 6000,
          max_features: int = 1500, deviations: float = 6.0, min_ratio: float = 3.0) -> Model:
    """Fit the classifier from a bounded sample of ``docs`` and ``labels``."""
    known = labels.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("toxic").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # Only ids that have a document; both sides hold ids alone.
    ids = docs.select("doc_id").filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).distinct()
    known = stored(known.join(ids, "doc_id", "left_semi"), "toxic-labels")
    counts = known.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    if not counts["toxic"]:
        return Model({}, 0.0)
    prior = min(max(counts["toxic"] / counts["n"], 1e-4), 0.9)
    order = F.xxhash64(F.lit("toxicity"), F.col("doc_id"))
    chosen = known.filter("toxic = 1").select("doc_id").orderBy(order).limit(max_positive).withColumn(
        "positive", F.lit(True)).unionByName(
        ids.orderBy(order).limit(max_unlabelled).withColumn("positive", F.lit(False)))
    # At most max_positive + max_unlabelled ids are broadcast; of the texts of an id the smallest is taken, in every run.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    texts = stored(texts.groupBy("doc_id", "positive").agg(F.min("text").alias("text")), "toxic-sample")
    n = {bool(r["positive"]): r["n"] for r in texts.groupBy("positive").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_unl = n.get(True, 0), n.get(False, 0)
    # Words must be more frequent in positives than chance would have it, by so many standard deviations.
    expected = n_pos * (F.col("unl") + 1) / max(n_unl, 1)
    per_feature = texts.select("positive", "text").mapInPandas(_features_of, "positive boolean, features array<string>").select(
        "positive", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.count_if("positive").alias("pos"), F.count_if(~F.col("positive")).alias("unl"))
    ratio = (F.col("pos") / n_pos) / ((F.col("unl") + F.lit(0.5)) / max(n_unl, 1))
    best = per_feature.filter((F.col("pos") >= expected + deviations * F.sqrt(expected + 1)) & (ratio >= min_ratio)).orderBy(
        (F.col("pos") * F.log(ratio)).desc(), "feature").limit(max_features).collect()
    index = {r["feature"]: i for i, r in enumerate(sorted(best, key=lambda r: r["feature"]))}
    if not index or not n_unl:
        return Model({}, 0.0)
    # Each collected row is a list of at most max_features small integers.
    rows = texts.select("positive", "text").mapInPandas(_indices_of(index), "positive boolean, found array<int>").collect()
    lists = {True: sorted(r["found"] for r in rows if r["positive"]), False: sorted(r["found"] for r in rows if not r["positive"])}
    weights, bias = nnpu_fit(_dense(lists[True], len(index)), _dense(lists[False], len(index)), prior)
    return Model({f: float(weights[i]) for f, i in index.items()}, bias)


def score_documents(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text, in place of a ``column`` of theirs (not text)."""
    docs = docs.select(*others(docs, column))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = [model.score(t) for t in batch["text"]]
            yield batch.assign(**{column: np.array(scores, dtype=np.float64)})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInPandas(run, f"{schema}, `{column}` double")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """``docs`` without those that score ``threshold`` or more, all columns as they are."""
    model = train(docs, labels, **options)
    return score_documents(docs, model, "__score").filter(F.col("__score") < threshold).drop("__score")
