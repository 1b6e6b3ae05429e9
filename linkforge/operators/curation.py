"""Tables of the matching game: a catalogue's record and its entries, kept in step with new links.

Parquet has no MERGE: each function gives the whole new table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkforge.operators.rules import best_per_target
from linkforge.schema import CURATION_CATALOG, CURATION_ENTRY, Target


def catalog_row(spark, t: Target, name: str | None = None, url: str = "", note: str = "") -> DataFrame:
    qual = 0
    row = (None, name or f"{t.catalog} {t.entity}", url, f"Identifiers of {t.entity} in {t.catalog}", t.entity, "en", int(t.pid[1:]), qual, 1, 0, note)
    return spark.createDataFrame([row], CURATION_CATALOG)


def upsert_catalog(catalogs: DataFrame, new: DataFrame) -> DataFrame:
    """By name: a known catalogue keeps its id and takes the new fields; an unknown one gets the next id."""
    top = catalogs.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"))
    old = catalogs.select("name", F.col("id").alias("old_id"))
    fresh = new.join(old, "name", "left").join(F.broadcast(top))  # both are one row
    rows = fresh.select(*[F.coalesce("old_id", F.col("top") + 1).alias("id") if f.name == "id" else F.col(f.name) for f in CURATION_CATALOG.fields])
    return catalogs.join(new.select("name"), "name", "left_anti").select(*[f.name for f in CURATION_CATALOG.fields]).unionByName(rows)


def description(born: Column, died: Column, text: Column) -> Column:
    dates = F.concat_ws(" - ", F.date_format(born, "yyyy"), F.date_format(died, "yyyy"))
    return F.concat_ws("; ", F.when(dates != "", dates), text)


def entries(links: DataFrame, target: DataFrame, catalog_id: int, entity: str, formatter: str, user: int = 0, when: str = "20190101000000") -> DataFrame:
    """links (qid, tid, confidence) as entries: q is the number of the item. The name is the smallest of the target's."""
    names = target.groupBy("catalog_id").agg(F.min("name").alias("ext_name"), F.min("born").alias("born"), F.min("died").alias("died"))
    rows = links.join(names, links["tid"] == names["catalog_id"], "left").drop("catalog_id")
    return rows.select(
        F.lit(catalog_id).cast("int").alias("catalog"), F.col("tid").alias("ext_id"), F.replace(F.lit(formatter), F.lit("$1"), F.col("tid")).alias("ext_url"), F.coalesce("ext_name", F.lit("")).alias("ext_name"),
        description(F.col("born"), F.col("died"), F.concat(F.lit("confidence: "), F.col("confidence").cast("string"))).alias("ext_desc"),
        F.regexp_replace("qid", "^Q", "").try_cast("int").alias("q"), F.lit(user).cast("int").alias("user"), F.lit(when).alias("timestamp"),
        (F.pmod(F.xxhash64("tid"), F.lit(1_000_000)) / 1_000_000).alias("random"), F.lit(entity).alias("type"),
    )


def sync(current: DataFrame, new: DataFrame, catalog_id: int) -> DataFrame:
    """Curated entries (user not 0) of the catalogue stay; the rest is replaced by new entries that aren't curated."""
    own, others = current.where(F.col("catalog") == catalog_id), current.where(F.col("catalog") != catalog_id)
    curated = own.where("user <> 0")
    cols = [f.name for f in CURATION_ENTRY.fields]
    return others.select(cols).unionByName(curated.select(cols)).unionByName(new.join(curated.select("ext_id"), "ext_id", "left_anti").select(cols))


def sync_matches(current: DataFrame, links: DataFrame, target: DataFrame, catalog_id: int, entity: str, formatter: str, confidence: tuple[float, float] = (0.0, 1.0)) -> DataFrame:
    best = best_per_target(links, *confidence)
    return sync(current, entries(best, target, catalog_id, entity, formatter), catalog_id)
