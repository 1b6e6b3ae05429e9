"""Candidate pairs by shared tokens. Tables: an id column, one row per id, and an array of tokens.

Frequent tokens: `most_frequent` drops tokens of more target rows than that before the join (a documented cut of
recall, off by default). Where the target's index is small (counted), it is sent to the source's rows, which are dealt
out by their id before they become pairs: all pairs of an id are made, counted and ranked in one task, and only tokens are
shuffled. Else pairs are counted by a partial aggregation before their shuffle, which also carries both sides' numbers of
tokens, so no table is read or tokenised twice; the join on tokens is left to adaptive execution to split where a token is
hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkforge.functions.text import let
from linkforge.operators.closure import cut

#: Rows of an index of tokens, up to which it is sent to the other side's rows.
FEW = 250_000


def inverted(rows: DataFrame, key: str, tokens: str, n: str = "n") -> DataFrame:
    """(key, token, n), each token once, with the number of the key's tokens: the index that all token joins share."""
    each = let(F.array_distinct(tokens), lambda d: F.transform(d, lambda t: F.struct(t.alias("token"), F.size(d).alias(n))))
    return rows.select(key, F.explode(each).alias("e")).select(key, "e.token", f"e.{n}")


def shared_counts(source: DataFrame, target: DataFrame, source_key: str, target_key: str, tokens: str = "tokens", most_frequent: int | None = None, few: int = FEW) -> DataFrame:
    """source_key, target_key, shared, ns, nt: the number of distinct tokens that both have, and of each side's. few: rows
    of the target's index up to which it is sent to the source's rows; the result is the same."""
    t = inverted(target, target_key, tokens, "nt")
    if most_frequent is not None:
        t = t.join(t.groupBy("token").count().where(F.col("count") <= most_frequent).select("token"), "token", "left_semi")
    if t.limit(few + 1).count() <= few:
        n = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few tokens make many pairs: not to be coalesced
        source, t = source.select(source_key, tokens).repartition(n, source_key), F.broadcast(t)
    s = inverted(source, source_key, tokens, "ns")
    return s.join(t, "token").groupBy(source_key, target_key).agg(F.count(F.lit(1)).alias("shared"), F.max("ns").alias("ns"), F.max("nt").alias("nt"))


def top_k(pairs: DataFrame, key: str, order: list[Column], k: int) -> DataFrame:
    """The first k rows of each key, with their rank; a limit within the key goes before the shuffle."""
    return pairs.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("rank") <= k)


def candidates(source: DataFrame, target: DataFrame, source_key: str = "qid", target_key: str = "tid", tokens: str = "tokens", k: int = 5, most_frequent: int | None = None) -> DataFrame:
    """The k best targets of each source row: by shared tokens, then by the share of the union, then by target_key."""
    pairs = shared_counts(source, target, source_key, target_key, tokens, most_frequent)
    jaccard = F.col("shared") / (F.col("ns") + F.col("nt") - F.col("shared"))
    return top_k(pairs.withColumn("jaccard", jaccard), source_key, [F.desc("shared"), F.desc("jaccard"), F.asc(target_key)], k).select(source_key, target_key, "shared", "jaccard", "rank")


def contained(inner: DataFrame, outer: DataFrame, inner_key: str, outer_key: str, tokens: str = "tokens") -> DataFrame:
    """Pairs (inner_key, outer_key) where the outer row has all tokens of the inner one.

    An inner row is joined on its token that is rarest among the outer rows alone, as every row that holds all its tokens
    holds that one; the few pairs are then verified on the whole sets. So a token that most rows have joins nothing
    unless a row has no other.
    """
    small = inner.select(F.col(inner_key).alias("ik"), F.array_distinct(tokens).alias("it")).where(F.size("it") > 0)
    large = cut(outer.select(F.col(outer_key).alias("ok"), F.array_distinct(tokens).alias("ot")))  # read thrice, tokenised once
    index = large.select("ok", F.explode("ot").alias("token"))
    asked = small.select("ik", F.explode("it").alias("token"))
    often = index.join(asked.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rare = asked.join(often, "token", "left").groupBy("ik").agg(F.min(F.coalesce("n", F.lit(0))).alias("least"), F.min_by("token", F.struct("n", "token")).alias("token")).where("least > 0")
    pairs = rare.select("ik", "token").join(index, "token").select("ik", "ok")
    both = pairs.join(small, "ik").join(large, "ok").where(F.size(F.array_except("it", "ot")) == 0)
    return both.select(F.col("ik").alias(inner_key), F.col("ok").alias(outer_key))


def supersets(source: DataFrame, target: DataFrame, source_key: str = "qid", target_key: str = "tid", tokens: str = "tokens", k: int | None = None) -> DataFrame:
    """Targets that have all tokens of a source row; k: at most so many, the smallest target_keys."""
    pairs = contained(source, target, source_key, target_key, tokens).select(source_key, target_key)
    return pairs if k is None else top_k(pairs, source_key, [F.asc(target_key)], k).drop("rank")


def subsets(source: DataFrame, target: DataFrame, source_key: str = "qid", target_key: str = "tid", tokens: str = "tokens", least: int = 2, without: DataFrame | None = None) -> DataFrame:
    """Targets of `least` tokens or more all of which a source row has; without: pairs that are left out."""
    pairs = contained(target.where(F.size(F.array_distinct(tokens)) >= least), source, target_key, source_key, tokens).select(source_key, target_key)
    return pairs if without is None else pairs.join(without.select(source_key, target_key), [source_key, target_key], "left_anti")


def exact(source: DataFrame, target: DataFrame, source_value: Column, target_value: Column, source_key: str = "qid", target_key: str = "tid") -> DataFrame:
    """Pairs with the same value, whatever its case; joined on its digest, as values may be long."""
    s, t = _digests(source, source_key, source_value), _digests(target, target_key, target_value)
    return s.join(t, "value").select(source_key, target_key)


def _digests(rows: DataFrame, key: str, value: Column) -> DataFrame:
    return rows.where(value.isNotNull()).select(key, F.sha2(F.lower(value), 256).alias("value")).distinct()


def exact_classes(rows: DataFrame, key: str, value: Column) -> DataFrame:
    """key and class: the smallest key with the same value, whatever its case. A row each, where exact() of a table with
    itself would give all pairs of equal rows."""
    each = _digests(rows, key, value)
    return each.join(each.groupBy("value").agg(F.min(key).alias("class")), "value").select(key, "class")


def search(target: DataFrame, words: list[str], target_key: str = "tid", tokens: str = "tokens", every: bool = False, k: int = 10) -> DataFrame:
    """Full-text lookup of a few words: rows with any (or every) word, best first."""
    asked = F.array(*map(F.lit, sorted(set(words))))
    shared = F.size(F.array_intersect(F.col(tokens), asked))
    rows = target.select(target_key, shared.alias("shared")).where(F.col("shared") >= (len(set(words)) if every else 1))
    return rows.orderBy(F.desc("shared"), F.asc(target_key)).limit(k)


def recall(pairs: DataFrame, known: DataFrame, source_key: str = "qid", target_key: str = "tid") -> DataFrame:
    """Share of known links that blocking proposes."""
    hit = known.select(source_key, target_key).distinct().join(pairs.select(source_key, target_key).distinct().withColumn("hit", F.lit(1)), [source_key, target_key], "left")
    return hit.agg(F.count(F.lit(1)).alias("known"), F.count("hit").alias("found")).withColumn("recall", F.try_divide("found", "known"))
