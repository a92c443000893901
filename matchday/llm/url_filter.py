"""URL filters: rules given by hand, and association rules mined from labels.

A url's host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; its path follows up to
``?``, ``#`` or the end. NULL or no ``://``: both empty. A given rule (host, path) fits its host and all subdomains if the
path starts with the rule's path; the longest host wins, then the longest path.

Mined rules: the tokens of labelled urls (host names and endings, path words) and the label are the baskets; FP-growth
finds the frequent combinations of every length, and those that foretell a bad label with enough support and confidence, and
surer than a url without any token known (if not all labelled urls are bad), are the rules. A rule is pruned if a part of it
foretells at least as surely. Rules are matched by an inverted index: each rule
is filed under its rarest item, urls look up their items, and a found rule applies if the url has all its items.

Three steps shrink the baskets first and leave the rules as they are. Tokens in too few bad urls can be in no rule. Tokens
that occur in exactly the same labelled urls are one item, as a combination of two of them is no surer than of one; a url has
an item if it has any of its tokens, and meets a rule in as many ways as it has choices of one token for each item. An item
that occurs in bad urls only is a rule by itself, and no longer one can be surer. So repeated urls of many words cost no more
than others. What stays exponential is many words that are frequent together in bad urls, each in other good ones besides:
there the rules themselves may be that many.

Urls without a rule are allowed unless a mined rule applies. Support bounds the number of frequent tokens (tokens of a url /
``min_support``), whatever the number of urls. Rows with a NULL label are left out of the mining; without
labelled urls there are no mined rules. Repeated rows are judged alike. Everything runs as DataFrame operations.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchday.llm.common import others, stored

BAD = "label:bad"
#: Token sets with mined rules that may be broadcast (24 bytes each), and the shares of the urls beyond.
MOST_SETS, SALTS = 1_000_000, 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def given_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest of the given ``(verdict, host, path)`` rules that fits; NULLs if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1]), len(r[2]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        text = F.when(fits, F.lit(rule_host + rule_path)).otherwise(text)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def url_tokens(host: Column, path: Column) -> Column:
    """Distinct tokens of a url: each ending of its host from two names on, and the words of its path without digits."""
    names = F.split(host, r"\.")
    endings = F.when(F.length(host) > 0, F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(names) - 1, F.lit(1))),
        lambda i: F.concat(F.lit("host:"), F.array_join(F.slice(names, i, F.size(names)), "."))))
    words = F.transform(
        F.filter(F.split(F.lower(path), r"[^\p{L}]+"), lambda w: F.length(w) > 0), lambda w: F.concat(F.lit("path:"), w))
    return F.array_distinct(F.concat(F.coalesce(endings, F.array().cast("array<string>")), words))


def token_items(baskets: DataFrame, least: int) -> DataFrame:
    """``(token, item, n, bad)`` of the tokens in at least ``least`` bad urls, from ``(tokens, n, bad)`` with distinct tokens.

    Tokens with equal counts and equal checksums of the token sets that hold them are one item, named by its first token.
    """
    marks = [F.bit_xor("one").alias("one"), F.bit_xor("two").alias("two"), F.count(F.lit(1)).alias("sets")]
    counted = baskets.select(
        F.explode("tokens").alias("token"), "n", "bad", F.xxhash64("tokens").alias("one"),
        F.xxhash64(F.lit("two"), "tokens").alias("two")).groupBy("token").agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad"), *marks).filter(F.col("bad") >= least)
    alike = ["n", "bad", "one", "two", "sets"]
    items = counted.groupBy(*alike).agg(F.min("token").alias("item"))
    return counted.join(items, alike).select("token", "item", "n", "bad")


def mine_rules(baskets: DataFrame, min_support: float = 0.0005, min_confidence: float = 0.6) -> tuple[DataFrame, DataFrame]:
    """``(items, support, confidence)`` of the rules from ``baskets`` of ``(tokens, bad)``, and ``(token, item, n)``."""
    spark = baskets.sparkSession
    none = spark.createDataFrame([], "items array<string>, support double, confidence double")
    n, n_bad = baskets.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0))).first()
    if n == 0:
        return none, spark.createDataFrame([], "token string, item string, n long")
    share, least = n_bad / n, max(math.ceil(min_support * n), 5)
    # Equal baskets are one row from here on.
    sets = stored(baskets.groupBy(F.array_sort("tokens").alias("tokens")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("bad")), "url-sets")
    items = stored(token_items(sets, least), "url-items")
    alone = items.filter(F.col("token") == F.col("item"))
    sure = alone.filter(F.col("n") == F.col("bad")).select(
        F.array("item").alias("items"), (F.col("bad") / n).alias("support"), F.lit(1.0).alias("confidence"))
    unsure = items.filter(F.col("n") > F.col("bad")).select("token", "item")
    left = stored(sets.select(F.xxhash64("tokens").alias("set"), "tokens", "n", "bad").select(
        "set", "n", "bad", F.explode("tokens").alias("token")).join(unsure, "token").groupBy("set", "n", "bad").agg(
        F.array_sort(F.collect_set("item")).alias("items")).groupBy("items").agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad")), "url-left")
    size = left.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rules = sure
    if size:
        growth = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / size, minConfidence=min_confidence)
        good = _repeated(left, F.col("n") - F.col("bad"), F.col("items"))
        bad = _repeated(left, F.col("bad"), F.array_append("items", F.lit(BAD)))
        # The sets without the label give the denominators. Lift above 1 (every url is bad: all items are sure).
        rules = sure.unionByName(growth.fit(good.unionByName(bad)).associationRules.filter(
            (F.size("consequent") == 1) & (F.element_at("consequent", 1) == BAD) & (F.col("confidence") > share)).select(
            F.array_sort("antecedent").alias("items"), (F.col("support") * size / n).alias("support"), "confidence"))
    rules = stored(rules, "url-rules")
    # A rule with a part that is as sure says nothing new: rules look up their parts as urls look up rules.
    parts = indexed_rules(rules, items).select("item", F.col("items").alias("part"), F.col("confidence").alias("sure"))
    useless = rules.select("items", "confidence", F.explode("items").alias("item")).join(parts, "item").filter(
        (F.size("part") < F.size("items")) & (F.col("sure") >= F.col("confidence"))
        & (F.size(F.array_except("part", "items")) == 0)).select("items").distinct()
    return rules.join(useless, "items", "left_anti"), items.select("token", "item", "n")


def _repeated(sets: DataFrame, times: Column, items: Column, step: int = 100_000) -> DataFrame:
    """``items`` of each row as often as ``times`` says, by way of stretches of ``step``."""
    stretches = sets.select(items.alias("items"), times.alias("times")).filter(F.col("times") > 0).select(
        "items", "times", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1, F.lit(step).cast("long"))).alias("at"))
    return stretches.select("items", F.explode(F.sequence(
        F.col("at"), F.least(F.col("at") + step, F.col("times")) - 1)).alias("copy")).select("items")


def indexed_rules(rules: DataFrame, items: DataFrame) -> DataFrame:
    """``(item, items, confidence)``: each rule under its rarest item."""
    counts = items.select("item", "n").distinct()
    listed = rules.select("items", "confidence", F.explode("items").alias("item")).join(counts, "item")
    return listed.groupBy("items", "confidence").agg(F.min(F.struct("n", "item")).getField("item").alias("item"))


def judge(pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str, str]], **options) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict``, ``mined_rules`` (number) and ``mined_confidence``.

    They stand in place of columns of these names in ``pages``. ``labelled`` has ``(url, bad)``.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    baskets = stored(labelled.filter(F.col("bad").isNotNull()).select(
        url_tokens(host, path).alias("tokens"), F.col("bad")).filter(F.size("tokens") > 0), "url-baskets")
    rules_of, items = mine_rules(baskets, **options)
    index = stored(indexed_rules(rules_of, items), "url-index")
    columns = others(pages, "host", "path", "rule", "verdict", "mined_rules", "mined_confidence")
    parted = pages.select(*columns, host.alias("host"), path.alias("path"))
    # Urls with the same tokens are judged once; a token that many of them have meets few rules, and Spark sends the small
    # side to all.
    tokens = url_tokens(F.col("host"), F.col("path"))
    keyed = parted.withColumn("__tokens", tokens).withColumn("__key", F.xxhash64("__tokens"))
    sets = keyed.select("__key", "__tokens").dropDuplicates(["__key"])
    has = sets.select("__key", F.explode("__tokens").alias("token")).join(items.select("token", "item"), "token").groupBy(
        "__key").agg(F.collect_list("item").alias("__items"))
    ways = F.aggregate("items", F.lit(1).cast("long"), lambda product, item: product * F.size(
        F.filter("__items", lambda x: x == item)))
    found = stored(has.select("__key", "__items", F.explode(F.array_distinct("__items")).alias("item")).join(index, "item").select(
        "__key", "confidence", ways.alias("ways")).filter(F.col("ways") > 0).groupBy("__key").agg(
        F.sum("ways").alias("mined_rules"), F.max("confidence").alias("mined_confidence")), "url-found")
    # Many urls may share one token set: the judged sets go to all, or, beyond a counted bound, to SALTS shares of the urls.
    if found.count() <= MOST_SETS:
        judged = keyed.join(F.broadcast(found), "__key", "left")
    else:
        salted = keyed.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.lit(SALTS)))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
        judged = salted.join(found.withColumn("__salt", every), ["__key", "__salt"], "left")
    rule, verdict = given_rule(F.col("host"), F.col("path"), rules)
    mined = F.when(F.col("mined_rules") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        *columns, "host", "path", rule.alias("rule"), F.coalesce(verdict, mined).alias("verdict"),
        F.coalesce("mined_rules", F.lit(0)).alias("mined_rules"), "mined_confidence")
