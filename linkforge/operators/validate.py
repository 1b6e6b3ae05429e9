"""Checks of existing links against a catalogue: identifiers that are gone, URLs and biographical data on either side.

Comparisons stay in long form (one row per value), so that an item with very many values is no single row; identical
values are joined, and what is left over on one side is an anti join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkforge.functions.dates import bio_value, match_values
from linkforge.functions.urls import off_blacklist, split_external_ids
from linkforge.knowledge_base import configured
from linkforge.schema import BIO_PIDS, DATE_OF_BIRTH, DATE_OF_DEATH, PLACE_OF_BIRTH, PLACE_OF_DEATH, SEX_OR_GENDER


def dead_ids(ids: DataFrame, target: DataFrame) -> DataFrame:
    """ids (qid, tid) whose tid isn't in target (tid): tid, qids."""
    gone = ids.join(target.select("tid").distinct(), "tid", "left_anti")
    return gone.groupBy("tid").agg(F.array_sort(F.collect_set("qid")).alias("qids"))


def compare_sets(ids: DataFrame, source: DataFrame, target: DataFrame, value: str = "value") -> dict[str, DataFrame]:
    """ids (qid, tid); source (qid, value); target (tid, value).

    deprecate: pairs without a shared value, though both sides have some (tid, qid); extra: what the target alone has
    (qid, tid, value); source_only: what the item alone has (qid, tid, value); shared (qid, tid, value). marked: all three
    with side (3 shared, 2 the target's, 1 the item's), to be persisted where several are wanted.
    """
    pairs = ids.select("qid", "tid").distinct()
    s = pairs.join(source.select("qid", value).where(F.col(value).isNotNull()), "qid").select("qid", "tid", value, F.lit(1).alias("side"))
    t = pairs.join(target.select("tid", value).where(F.col(value).isNotNull()), "tid").select("qid", "tid", value, F.lit(2).alias("side"))
    every = s.unionByName(t).groupBy("qid", "tid", value).agg(F.bit_or("side").alias("side"))
    compared = every.groupBy("qid", "tid").agg(F.bit_or("side").alias("both"), F.max("side").alias("top")).where("both = 3")
    marked = every.join(compared.select("qid", "tid"), ["qid", "tid"], "left_semi")
    only = lambda n: marked.where(F.col("side") == n).select("qid", "tid", value)
    return {"shared": only(3), "extra": only(2), "source_only": only(1), "deprecate": compared.where("top < 3").select("tid", "qid"), "marked": marked}


def validate_links(ids: DataFrame, source_urls: DataFrame, target_urls: DataFrame, metadata: DataFrame, blacklist: list[str] | DataFrame) -> dict[str, DataFrame]:
    """source_urls (qid, url), target_urls (tid, url). Outputs: deprecate, and of the URLs that only the target has
    (ext_ids_to_add, urls_to_add), that both have (ext_ids_to_reference, urls_to_reference), and that only the item has
    (source_only, as URL of the item)."""
    got = compare_sets(ids, source_urls, target_urls, "url")
    add_ids, add_urls = split_external_ids(got["extra"], metadata)
    ref_ids, ref_urls = split_external_ids(got["shared"], metadata)
    item = got["source_only"].select("tid", "url", F.concat(F.lit(configured().item_url), F.col("qid")).alias("item_url"))
    return {
        "deprecate": got["deprecate"], "ext_ids_to_add": add_ids, "urls_to_add": off_blacklist(add_urls, blacklist, "value"),
        "ext_ids_to_reference": ref_ids, "urls_to_reference": off_blacklist(ref_urls, blacklist, "value"), "source_only": item,
    }


def bio_rows(main: DataFrame) -> DataFrame:
    """A target's rows as (tid, pid, value), up to five each; places and genders are lower-cased names."""
    has = lambda c: F.col(c) if c in main.columns else F.lit(None)
    values = {
        DATE_OF_BIRTH: bio_value(has("born").cast("date"), has("born_precision").cast("int")), DATE_OF_DEATH: bio_value(has("died").cast("date"), has("died_precision").cast("int")),
        SEX_OR_GENDER: has("gender").cast("string"), PLACE_OF_BIRTH: has("birth_place").cast("string"), PLACE_OF_DEATH: has("death_place").cast("string"),
    }
    wide = main.select(F.col("catalog_id").alias("tid"), *[v.alias(p) for p, v in values.items()])
    return wide.unpivot(["tid"], list(BIO_PIDS), "pid", "value").where("value is not null").distinct()


def has_bio(main: DataFrame) -> DataFrame:
    return main.where("born is not null or died is not null")


def validate_bio(ids: DataFrame, source: DataFrame, target: DataFrame, require_same_pid: bool = False) -> dict[str, DataFrame]:
    """source (qid, pid, value, labels), target (tid, pid, value). Dates agree to the poorer precision; other values by the
    item's labels. require_same_pid: what the target has counts as extra only if the item has that property at all.

    Outputs: shared, extra, source_only (qid, pid, value, tid) and deprecate (tid, qid): pairs where both sides have
    values but none is shared.
    """
    dates = (DATE_OF_BIRTH, DATE_OF_DEATH)
    pairs = ids.select("qid", "tid").distinct()
    s = pairs.join(source.select("qid", "pid", "value", "labels").distinct(), "qid")
    t = pairs.join(target.select("tid", "pid", F.col("value").alias("t_value")).distinct(), "tid")
    both = s.join(t, ["qid", "tid", "pid"])
    date = F.col("pid").isin(*dates)
    names = F.transform(F.coalesce("labels", F.array().cast("array<string>")), F.lower)
    same = F.when(date, match_values(F.col("value"), F.col("t_value")) == "shared").otherwise((F.lower("value") == F.lower("t_value")) | F.array_contains(names, F.lower("t_value")))
    comparable = ~date | match_values(F.col("value"), F.col("t_value")).isNotNull()
    judged = both.where(comparable).withColumn("same", F.coalesce(same, F.lit(False)))
    shared = judged.where("same").select("qid", "pid", "value", "tid").distinct()
    matched = judged.where("same").select("qid", "tid", "pid", "t_value").distinct()
    known = judged.select("qid", "tid", "pid", "t_value").distinct()
    open_ = known if require_same_pid else t.select("qid", "tid", "pid", "t_value").join(both.where(~comparable).select("qid", "tid", "pid", "t_value"), ["qid", "tid", "pid", "t_value"], "left_anti").join(pairs.join(source.select("qid").distinct(), "qid", "left_semi"), ["qid", "tid"], "left_semi")
    extra = open_.join(matched, ["qid", "tid", "pid", "t_value"], "left_anti").select("qid", "pid", F.col("t_value").alias("value"), "tid").distinct()
    in_target = t.select("qid", "tid").distinct()
    source_only = s.join(in_target, ["qid", "tid"], "left_semi").join(shared, ["qid", "pid", "value", "tid"], "left_anti").select("qid", "pid", "value", "tid").distinct()
    deprecate = s.select("qid", "tid").distinct().join(in_target, ["qid", "tid"], "left_semi").join(shared.select("qid", "tid"), ["qid", "tid"], "left_anti").select("tid", "qid")
    return {"shared": shared, "extra": extra, "source_only": source_only, "deprecate": deprecate}


def statements(rows: DataFrame, for_catalogs: bool = False) -> DataFrame:
    """(qid, pid, value, tid) as subject, predicate, value, tid; for catalogues with full URLs of properties and items."""
    if not for_catalogs:
        return rows.select(F.col("qid").alias("subject"), F.col("pid").alias("predicate"), "value", "tid")
    value = F.when(F.col("value").rlike(r"^Q\d+$"), F.concat(F.lit(configured().item_url), F.col("value"))).otherwise(F.col("value"))
    return rows.select(F.col("tid").alias("subject"), F.concat(F.lit(configured().property_url), F.col("pid")).alias("predicate"), value.alias("value"), F.concat(F.lit(configured().item_url), F.col("qid")).alias("tid"))
