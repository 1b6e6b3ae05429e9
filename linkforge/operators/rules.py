"""Rules over predicted links, and the linkers that need no training."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkforge.functions.dates import birth_or_death_match
from linkforge.functions.urls import is_wiki, item_id
from linkforge.knowledge_base import KnowledgeBase, configured
from linkforge.operators import blocking
from linkforge.operators.analysis import name_date_key
from linkforge.schema import NAME_FIELDS


def full_names(columns: list[str]) -> Column:
    """The union of all fields that hold names."""
    parts = [F.coalesce(F.col(c).cast("array<string>"), F.array().cast("array<string>")) for c in NAME_FIELDS if c in columns]
    return F.array_distinct(F.flatten(F.array(*parts))) if parts else F.array().cast("array<string>")


def zero_when_names_differ(confidence: Column, source_names: Column, target_names: Column) -> Column:
    return F.when(F.coalesce(F.arrays_overlap(source_names, target_names), F.lit(False)), confidence).otherwise(0.0)


def linked_item(urls: Column, kb: KnowledgeBase | None = None) -> Column:
    """The item of the first URL of the knowledge base; null if there is none."""
    hits = F.filter(F.transform(F.filter(urls, lambda u: F.contains(u, F.lit((kb or configured()).mark))), item_id), lambda q: q != "")
    return F.get(hits, F.lit(0))


def url_decides(confidence: Column, qid: Column, target_urls: Column) -> Column:
    """1 where the target's own link names the item, 0 where it names another; it overrides the rule of names."""
    found = linked_item(target_urls)
    return F.when(found.isNull(), confidence).when(found == qid, 1.0).otherwise(0.0)


def apply_rules(predictions: DataFrame, source: DataFrame, target: DataFrame, name_rule: bool = True) -> DataFrame:
    """predictions (qid, tid, confidence): source with arrays name.. by qid, target with name.. and url by tid."""
    s = source.select("qid", full_names(source.columns).alias("s_names"))
    t = target.select("tid", full_names(target.columns).alias("t_names"), (F.col("url") if "url" in target.columns else F.lit(None).cast("array<string>")).alias("t_url"))
    rows = predictions.join(s, "qid").join(t, "tid")
    c = zero_when_names_differ(F.col("confidence"), F.col("s_names"), F.col("t_names")) if name_rule else F.col("confidence")
    return rows.withColumn("confidence", url_decides(c, F.col("qid"), F.col("t_url"))).select(*predictions.columns)


def above(predictions: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Distinct links at the threshold or above."""
    return predictions.where(F.col("confidence") >= threshold).dropDuplicates(["qid", "tid"])


def between(links: DataFrame, low: float, high: float) -> DataFrame:
    return links.where(F.col("confidence").between(low, high))


def best_per_target(links: DataFrame, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """The most confident link of each target within the range; of equals the smallest qid."""
    rank = F.row_number().over(Window.partitionBy("tid").orderBy(F.desc("confidence"), "qid"))
    return between(links, low, high).withColumn("r", rank).where("r = 1").select("qid", "tid", "confidence")


def first_per_target(pairs: DataFrame) -> DataFrame:
    """(qid, tid): the smallest qid of each tid."""
    return pairs.groupBy("tid").agg(F.min("qid").alias("qid"))


def existing_links(link_table: DataFrame, kb: KnowledgeBase | None = None) -> DataFrame:
    """Links that a catalogue itself has to the knowledge base: qid, tid."""
    rows = link_table.where(F.col("is_wiki") & F.array_contains("url_tokens", (kb or configured()).mark))
    return rows.select(item_id(F.col("url")).alias("qid"), F.col("catalog_id").alias("tid")).where("qid <> ''").distinct()


def with_matching_dates(pairs: DataFrame, source: DataFrame, target: DataFrame) -> DataFrame:
    """Pairs with a birth or a death date in common. source: qid, born and died as array<struct<value:date,precision:int>>."""
    rows = pairs.join(source.select("qid", F.col("born").alias("s_born"), F.col("died").alias("s_died")), "qid").join(target.select("tid", "born", "born_precision", "died", "died_precision").distinct(), "tid")
    match = birth_or_death_match(F.col("s_born"), F.col("s_died"), {c: F.col(c) for c in ("born", "born_precision", "died", "died_precision")})
    return rows.where(match).select("qid", "tid").distinct()


def rule_linkers(kind: str, source: DataFrame, target: DataFrame, target_links: DataFrame | None = None, dates: bool = False) -> DataFrame:
    """kind: perfect (equal names), links (tokens of URLs), names (tokens of names), all. Rows: qid, tid, rule.

    source: qid, name, name_tokens, url_tokens (arrays); target: tid, name, name_tokens; target_links: tid, url_tokens.
    """
    if kind not in ("perfect", "links", "names", "all"):
        raise ValueError(f"no such rule: {kind}")
    named = lambda df, rule: df.select("qid", "tid", F.lit(rule).alias("rule"))
    checked = lambda df: with_matching_dates(df, source, target) if dates else df
    out = []
    if kind in ("perfect", "all"):
        names = source.select("qid", F.explode("name").alias("name"))
        out.append(named(checked(blocking.exact(names, target, F.col("name"), F.col("name"))), "perfect"))
    pairs = [("links", "url_tokens", target_links, False), ("names", "name_tokens", target, True)]
    for rule, column, table, dated in pairs:
        if kind in (rule, "all") and table is not None:
            s = source.select("qid", F.col(column).alias("tokens")).where("tokens is not null")
            t = table.select("tid", F.col(column).alias("tokens")).where("tokens is not null")
            # rows of one target are names or links of their own: each is compared by itself
            t = t.select(F.struct("tid", F.array_join("tokens", " ").alias("of")).alias("tid"), "tokens").distinct()
            sup = blocking.supersets(s, t, k=10)
            both = sup.unionByName(blocking.subsets(s, t, without=sup)).select("qid", "tid.tid").distinct()
            out.append(named(checked(both) if dated else both, rule))
    rows = out[0]
    for r in out[1:]:
        rows = rows.unionByName(r)
    return rows


def key_linkers(source: DataFrame, target: DataFrame, wiki: Callable[[Column], Column] = is_wiki) -> DataFrame:
    """qid, tid, rule of pairs with an equal key: label (without case), link, wikilink (of those links the ones to wikis) and
    name and years of birth and death. Both: an id (qid, tid), label, url (array), born and died (dates).

    Keys are exploded to rows of their own and joined once, so no pair is looked at that doesn't share one.
    """

    def keys(rows: DataFrame, key: str) -> DataFrame:
        years = F.when(F.col("born").isNotNull() & F.col("died").isNotNull(), name_date_key(F.col("label"), F.col("born"), F.col("died")))
        one = lambda rule, value: F.struct(F.lit(rule).alias("rule"), value.alias("value"))
        links = F.coalesce(F.transform("url", lambda u: one("link", u)), F.array())
        wikis = F.coalesce(F.transform(F.filter("url", lambda u: wiki(u)), lambda u: one("wikilink", u)), F.array())
        each = F.concat(F.array(one("label", F.lower("label")), one("name and dates", years)), links, wikis)
        return rows.select(key, F.explode(each).alias("k")).select(key, "k.*").where("value is not null").distinct()

    return keys(source, "qid").join(keys(target, "tid"), ["rule", "value"]).select("qid", "tid", "rule").distinct()
