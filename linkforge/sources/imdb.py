"""IMDb dumps: tab-separated files with a header, \\N for null, no quoting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkforge.functions import dates, text
from linkforge.schema import CLASS_QID, PROFESSIONS
from linkforge.sources.base import CatalogReader, gzip_aware, register

NAMES = "nconst string, primaryName string, birthYear string, deathYear string, primaryProfession string, knownForTitles string"
TITLES = "tconst string, titleType string, primaryTitle string, originalTitle string, isAdult string, startYear string, endYear string, runtimeMinutes string, genres string"
#: Table of each profession; a person with `miscellaneous` alone is in all five.
ROUTES = {"actor": ("actor", "actress"), "director": ("director",), "musician": ("sound_department", "composer", "music_department", "soundtrack"), "producer": ("producer",), "writer": ("writer",)}


def tsv(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    return gzip_aware(spark.read.schema(schema).csv(path, sep="\t", header=header, nullValue="\\N", quote="", escape="", enforceSchema=True), path)


@register
class ImdbReader(CatalogReader):
    catalog = "imdb"
    files = {n: f"{n}.tsv.gz" for n in ("names", "titles")}

    def read(self, spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
        """paths: names, titles (either may be absent)."""
        out = {}
        if "titles" in paths:
            out["imdb_title"] = self.titles(tsv(spark, paths["titles"], TITLES))
        if "names" in paths:
            out |= self.people(tsv(spark, paths["names"], NAMES))
        return out

    def titles(self, rows: DataFrame) -> DataFrame:
        """A row for the primary title and, if it differs, one for the original title."""
        names = F.array_distinct(F.filter(F.array("primaryTitle", "originalTitle"), lambda x: x.isNotNull()))
        born, born_precision = dates.from_year(F.col("startYear"))
        died, died_precision = dates.from_year(F.col("endYear"))
        return rows.where("tconst is not null").withColumn("name", F.explode(names)).select(
            F.col("tconst").alias("catalog_id"), "name", text.tokenize(F.col("name")).alias("name_tokens"), born.alias("born"), born_precision.alias("born_precision"), died.alias("died"), died_precision.alias("died_precision"),
            F.col("titleType").alias("title_type"), F.col("primaryTitle").alias("primary_title"), F.col("originalTitle").alias("original_title"), (F.col("isAdult") == "1").alias("is_adult"),
            F.col("runtimeMinutes").try_cast("int").alias("runtime_minutes"), F.when(F.col("genres").isNotNull(), F.array_sort(F.array_distinct(F.split(F.lower("genres"), ",")))).alias("genres"),
        )

    def people(self, rows: DataFrame) -> dict[str, DataFrame]:
        good = rows.where("nconst is not null and primaryName is not null and coalesce(primaryProfession, '') <> ''").withColumn("p", F.split("primaryProfession", ","))
        born, born_precision = dates.from_year(F.col("birthYear"))
        died, died_precision = dates.from_year(F.col("deathYear"))
        has = lambda *names: F.arrays_overlap("p", text.literals(names))
        gender = F.when(has("actor"), F.lit("male")).when(has("actress"), F.lit("female"))
        base = good.select(
            "p", F.col("nconst").alias("catalog_id"), F.col("primaryName").alias("name"), text.tokenize(F.col("primaryName")).alias("name_tokens"), born.alias("born"), F.coalesce(born_precision, F.lit(9)).alias("born_precision"),
            died.alias("died"), F.coalesce(died_precision, F.lit(9)).alias("died_precision"), gender.alias("gender"), professions(F.col("p")).alias("occupations"),
        )
        alone = F.size(F.array_except("p", F.array(F.lit("miscellaneous")))) == 0
        out = {}
        for entity, names in ROUTES.items():
            others = F.array_except("occupations", F.array(F.lit(CLASS_QID[entity])))
            out[f"imdb_{entity}"] = base.where(alone | has(*names)).drop("p").withColumn("occupations", others)
        out["imdb_title_name_relationship"] = good.where("knownForTitles is not null").select(F.explode(F.split("knownForTitles", ",")).alias("from_catalog_id"), F.col("nconst").alias("to_catalog_id")).where("from_catalog_id <> ''").distinct()
        return out


def professions(names) -> F.Column:
    """Names of professions to items; unknown ones are dropped."""
    table = F.create_map(*[F.lit(x) for kv in PROFESSIONS.items() for x in kv])
    return F.array_sort(F.array_distinct(F.filter(F.transform(names, lambda n: F.try_element_at(table, n)), lambda q: q.isNotNull())))
