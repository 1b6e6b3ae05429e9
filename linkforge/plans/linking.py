"""From items and a catalogue's tables to links: one lazy plan per job, training apart."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkforge.functions import dates, text, urls
from linkforge.operators import blocking, closure, evaluate, features, models, rules
from linkforge.operators.closure import cut
from linkforge.schema import Target, check_goal

NAME_LISTS = ("name", "birth_name", "family_name", "given_name", "pseudonym", "real_name")


def prepare_source(items: DataFrame, goal: str = "classification") -> DataFrame:
    """Items to arrays: normalised names, tokens, URL tokens, parsed dates, occupations as sets. A closed schema: every
    column is there, null where an item has none. For training the smallest tid of each item is its known link."""
    check_goal(goal)
    c = F.col
    out = items.withColumns({
        **{n: text.normalize_values(c(n)) for n in NAME_LISTS if n in items.columns},
        "name_tokens": text.tokenize_values(c("name")), "description_tokens": text.tokenize_values(c("description")),
        "url_tokens": _url_tokens(c("url")), "born": dates.parse_list(c("born")), "died": dates.parse_list(c("died")),
        "occupations": text.split_single(c("occupations")), "genres": text.tokenize_values(c("genres")),
    })
    if goal == "training":
        out = out.withColumn("tid", F.get(F.array_sort("tid"), F.lit(0)))
    return out


def _url_tokens(values):
    out = F.array_sort(F.array_distinct(F.flatten(F.transform(F.filter(values, lambda x: x.isNotNull()), lambda u: urls.tokenize(u)))))
    return F.when(F.size(out) > 0, out)


def prepare_target(main: DataFrame, link: DataFrame | None = None, nlp: DataFrame | None = None, ids: DataFrame | None = None) -> DataFrame:
    """One row per tid with sorted arrays. Each table is reduced to arrays before the joins, so that variants of names,
    links and texts never multiply. ids (tid): only these."""
    keep = (lambda df: df if ids is None else df.join(ids.select(F.col("tid").alias("catalog_id")).distinct(), "catalog_id", "left_semi"))
    has = set(main.columns)
    sets = lambda e: F.array_sort(F.collect_set(e))
    agg = [sets(text.normalize(F.col("name"))).alias("name"), sets(F.col("name_tokens")).alias("token_lists")]
    agg += [sets(dates.of_date(F.col(d), F.col(f"{d}_precision"))).alias(d) for d in ("born", "died")]
    agg += [sets(text.normalize(F.col("real_name"))).alias("real_name")] if "real_name" in has else []
    agg += [sets(F.col(c)).alias(c) for c in ("occupations", "genres") if c in has]
    wide = keep(main).groupBy(F.col("catalog_id").alias("tid")).agg(*agg)
    flat = {c: F.array_sort(F.array_distinct(F.flatten(c))) for c in ("occupations", "genres") if c in has}
    wide = wide.withColumns({"name_tokens": F.array_sort(F.array_distinct(F.flatten("token_lists"))), **flat}).drop("token_lists")
    if link is not None:
        wide = wide.join(keep(link).groupBy(F.col("catalog_id").alias("tid")).agg(sets(F.col("url")).alias("url"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("url_tokens")))).alias("url_tokens")), "tid", "left")
    if nlp is not None:
        wide = wide.join(keep(nlp).groupBy(F.col("catalog_id").alias("tid")).agg(sets(F.col("description")).alias("description"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("description_tokens")))).alias("description_tokens")), "tid", "left")
    return wide


def samples(source: DataFrame, main: DataFrame, k: int = 5) -> DataFrame:
    """Candidate pairs (qid, tid): for each item the k targets that share most tokens of their names."""
    s = source.select("qid", F.col("name_tokens").alias("tokens")).where("tokens is not null")
    t = main.groupBy(F.col("catalog_id").alias("tid")).agg(F.array_distinct(F.flatten(F.collect_set("name_tokens"))).alias("tokens"))
    return blocking.candidates(s, t, k=k).select("qid", "tid")


def feature_table(pairs: DataFrame, source: DataFrame, target: DataFrame, expansion: DataFrame | None = None, wanted: dict | None = None) -> DataFrame:
    t = features.expand_occupations(target, expansion, "tid") if expansion is not None and "occupations" in target.columns else target.withColumn("occupations_expanded", F.col("occupations")) if "occupations" in target.columns else target
    return features.vectors(pairs, source, t, wanted)


def class_expansion(edges: DataFrame, *tables: DataFrame) -> DataFrame:
    """Sub- and superclasses of the occupations that occur in the tables."""
    used = [t.select(F.explode("occupations").alias("root")) for t in tables if "occupations" in t.columns]
    roots = reduce(DataFrame.unionByName, used).where("root is not null").distinct() if used else None
    return closure.expansion(edges, roots)


def training_set(items: DataFrame, main: DataFrame, link: DataFrame | None = None, nlp: DataFrame | None = None, expansion: DataFrame | None = None) -> DataFrame:
    """Feature vectors of candidates with label: 1 for known links. Known links that blocking doesn't propose aren't rows."""
    source = prepare_source(items, "training").where("tid is not null")
    pairs = samples(source, main)
    known = source.select("qid", "tid")
    target = prepare_target(main, link, nlp, pairs)
    return evaluate.labelled(feature_table(pairs, source.drop("tid"), target, expansion), known)


def train(kind: str, rows: DataFrame, **params) -> models.Model:
    return models.train(kind, rows, list(features.FEATURES), **params)


def link(model: models.Model, items: DataFrame, main: DataFrame, link_table: DataFrame | None = None, nlp: DataFrame | None = None, expansion: DataFrame | None = None, threshold: float = 0.5, name_rule: bool = False) -> DataFrame:
    """qid, tid, confidence of new links."""
    source = prepare_source(items, "classification").drop("tid")
    pairs = samples(source, main)
    target = prepare_target(main, link_table, nlp, pairs)
    scored = model.score(feature_table(pairs, source, target, expansion)).select("qid", "tid", "confidence")
    return rules.above(rules.apply_rules(scored, source, target, name_rule), threshold)


def baseline(kind: str, items: DataFrame, main: DataFrame, link_table: DataFrame | None = None, check_dates: bool = False) -> DataFrame:
    """qid, tid, rule by equal names, tokens of links and tokens of names."""
    source = prepare_source(items).drop("tid")
    dated = items.select("qid", *[_dated(F.col(c)).alias(c) for c in ("born", "died")])
    s = source.drop("born", "died").join(dated, "qid")
    t = main.select(F.col("catalog_id").alias("tid"), text.normalize(F.col("name")).alias("name"), "name_tokens", "born", "born_precision", "died", "died_precision")
    links = None if link_table is None else link_table.select(F.col("catalog_id").alias("tid"), "url_tokens")
    return rules.rule_linkers(kind, s, t, links, check_dates)


def _dated(pairs):
    one = lambda p: F.struct(F.try_to_date(F.regexp_replace(F.substring(F.get(p, F.lit(0)), F.lit(1), F.lit(10)), "-00", "-01"), "yyyy-MM-dd").alias("value"), F.get(p, F.lit(1)).try_cast("int").alias("precision"))
    return F.filter(F.transform(pairs, one), lambda d: d.value.isNotNull())


def evaluation(kind: str, rows: DataFrame, how: str = "average", k: int = 5, **params) -> DataFrame:
    """how: average, single or nested."""
    return evaluated(kind, rows, how, k, **params)[0]


def evaluated(kind: str, rows: DataFrame, how: str = "average", k: int = 5, **params) -> tuple[DataFrame, DataFrame]:
    """(the report, every row's out-of-fold prediction: qid, tid, label, fold, confidence)."""
    names, keys = list(features.FEATURES), ["qid", "tid"]
    if how == "nested":
        report, scored = evaluate.nested_predictions(kind, rows, names, keys, k, k)[:2]
        return report, scored.select(*keys, "label", F.col("outer_fold").alias("fold"), "confidence")
    scored = cut(evaluate.cross_validate(kind, rows, names, keys, k, **params).select(*keys, "label", "fold", "confidence"))
    if how == "average":
        return evaluate.average(evaluate.metrics(evaluate.confusion(scored, ["fold"]))), scored
    if how != "single":
        raise ValueError(f"no such evaluation: {how}")
    return evaluate.metrics(evaluate.confusion(scored)), scored


def target_tables(spark, folder: str, t: Target) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    read = lambda name: spark.read.parquet(f"{folder}/{name}")
    return read(t.main), read(t.link) if t.link else None, read(t.nlp) if t.nlp else None
