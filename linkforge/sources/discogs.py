"""Discogs dumps: <artist> and <master> nodes by the XML source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkforge.functions import dates, text, urls
from linkforge.sources.base import CatalogReader, gzip_aware, register

ARTIST = "id string, name string, realname string, data_quality string, profile string, namevariations struct<name:array<string>>, urls struct<url:array<string>>, groups struct<name:array<string>>, members struct<name:array<string>>"
MASTER = "_id string, main_release string, title string, data_quality string, year string, genres struct<genre:array<string>>, styles struct<style:array<string>>, artists struct<artist:array<struct<id:string>>>"


def xml(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    return gzip_aware(spark.read.format("xml").option("rowTag", tag).schema(schema).load(path), path)


@register
class DiscogsReader(CatalogReader):
    catalog = "discogs"
    files = {n: f"{n}.xml.gz" for n in ("artists", "masters")}

    def read(self, spark: SparkSession, paths: dict[str, str], solo_as_musician: bool = False, resolver=None) -> dict[str, DataFrame]:
        """paths: artists, masters (either may be absent). resolver: see sources.online.resolve, off by default."""
        out = {}
        if "artists" in paths:
            out |= self.artists(xml(spark, paths["artists"], "artist", ARTIST), solo_as_musician, resolver)
        if "masters" in paths:
            out |= self.masters(xml(spark, paths["masters"], "master", MASTER))
        return out

    def artists(self, nodes: DataFrame, solo_as_musician: bool = False, resolver=None) -> dict[str, DataFrame]:
        """Nodes with groups are musicians; others with members are bands; what has neither is left out unless asked for."""
        good = nodes.where("coalesce(id, '') <> '' and coalesce(name, '') <> ''")
        kind = F.when(F.col("groups").isNotNull(), "musician").when(F.col("members").isNotNull(), "group")
        good = good.withColumn("kind", kind.otherwise(F.lit("musician")) if solo_as_musician else kind).where("kind is not null")
        none = F.lit(None)
        names = F.array_distinct(F.concat(F.array("name"), F.filter(F.coalesce("namevariations.name", F.array().cast("array<string>")), lambda x: F.coalesce(x, F.lit("")) != "")))
        main = good.select(
            "kind", F.col("id").alias("catalog_id"), F.explode(names).alias("name"), none.cast("date").alias("born"), none.cast("int").alias("born_precision"),
            none.cast("date").alias("died"), none.cast("int").alias("died_precision"), F.col("realname").alias("real_name"), F.lower("data_quality").alias("data_quality"),
        ).withColumn("name_tokens", text.tokenize(F.col("name")))
        links = link_rows(good.select("kind", F.col("id").alias("catalog_id"), F.explode("urls.url").alias("url")), resolver)
        nlp = good.where("coalesce(profile, '') <> ''").select("kind", F.col("id").alias("catalog_id"), F.col("profile").alias("description"), text.tokenize(F.col("profile")).alias("description_tokens"))
        order = ["catalog_id", "name", "name_tokens", "born", "born_precision", "died", "died_precision", "real_name", "data_quality"]
        out = {}
        for k in ("musician", "group"):
            only = lambda df, k=k: df.where(F.col("kind") == k).drop("kind")
            out |= {f"discogs_{k}": only(main).select(*order), f"discogs_{k}_link": only(links), f"discogs_{k}_nlp": only(nlp)}
        return out

    def masters(self, nodes: DataFrame) -> dict[str, DataFrame]:
        born, precision = dates.from_year(F.col("year"))
        both = F.concat(F.coalesce("genres.genre", F.array().cast("array<string>")), F.coalesce("styles.style", F.array().cast("array<string>")))
        main = nodes.where("coalesce(_id, '') <> ''").select(
            F.col("_id").alias("catalog_id"), F.col("title").alias("name"), text.tokenize(F.col("title")).alias("name_tokens"), born.alias("born"), precision.alias("born_precision"),
            F.lit(None).cast("date").alias("died"), F.lit(None).cast("int").alias("died_precision"), F.col("main_release").alias("main_release_id"),
            text.tokenize_values(both).alias("genres"), F.lower("data_quality").alias("data_quality"),
        )
        edges = nodes.select(F.col("_id").alias("from_catalog_id"), F.explode("artists.artist.id").alias("to_catalog_id")).where("from_catalog_id is not null and to_catalog_id is not null").distinct()
        return {"discogs_master": main, "discogs_master_artist_relationship": edges}


def link_rows(rows: DataFrame, resolver=None) -> DataFrame:
    """Fields with URLs to rows of valid URLs, is_wiki and url_tokens. The other columns stay."""
    out = rows.withColumn("url", F.explode(urls.living(F.col("url")))).distinct()
    if resolver is not None:
        out = resolver(out)
    return out.withColumns({"is_wiki": urls.is_wiki(F.col("url")), "url_tokens": urls.tokenize(F.col("url"))})
