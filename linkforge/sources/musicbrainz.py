"""MusicBrainz dump: tab-separated files without a header, \\N for null. unpack() takes them out of the archive."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkforge.functions import dates, text
from linkforge.schema import ISNI
from linkforge.sources.base import CatalogReader, register
from linkforge.sources.discogs import link_rows
from linkforge.sources.imdb import tsv

# Column order of the dump's files, as far as they are used; codes of artist types and genders.
FILES = {
    "artist": "id long, gid string, label string, sort_label string, b_year int, b_month int, b_day int, d_year int, d_month int, d_day int, type_id int, area long, gender int, nd1 string, nd2 string, nd3 string, nd4 string, b_place long, d_place long",
    "artist_alias": "id long, parent_id long, label string", "area": "id long, gid string, name string", "artist_isni": "artist long, isni string",
    "url": "id long, gid string, url string", "l_artist_url": "id long, link long, entity0 long, entity1 long", "l_release_group_url": "id long, link long, entity0 long, entity1 long",
    "link": "id long, link_type long", "l_artist_artist": "id long, link long, entity0 long, entity1 long",
    "release_group": "id long, gid string, label string, artist_credit long, type_id int", "release": "id long, gid string, name string, artist_credit long, release_group long",
    "release_country": "release long, country long, year int, month int, day int", "release_unknown_country": "release long, year int, month int, day int",
    "artist_credit_name": "artist_credit long, position int, artist long, name string",
}
PERSON_TYPES, BAND_TYPES, MEMBER_LINK_TYPE = (1, 4), (2, 5, 6), 855
GENDERS = {1: "male", 2: "female"}


def gender(code: Column) -> Column:
    return reduce(lambda c, kv: c.when(code == kv[0], F.lit(kv[1])), list(GENDERS.items())[1:], F.when(code == 1, F.lit(GENDERS[1])))


def unpack(archive: str, folder: str, names: tuple[str, ...] = tuple(FILES)) -> dict[str, str]:
    """The files of a tar.bz2 archive that are read, as bzip2 files in a folder that all machines see: Spark splits those.

    One pass over the archive on the driver, in pieces of a megabyte; returns their paths by name.
    """
    import bz2
    import os
    import tarfile

    os.makedirs(folder, exist_ok=True)
    out = {}
    with tarfile.open(archive, "r|*") as t:
        for member in t:
            name = os.path.basename(member.name)
            if member.isfile() and name in names:
                out[name] = os.path.join(folder, f"{name}.bz2")
                with t.extractfile(member) as f, bz2.open(out[name], "wb") as g:
                    while data := f.read(1 << 20):
                        g.write(data)
    return out


@register
class MusicBrainzReader(CatalogReader):
    catalog = "musicbrainz"
    files = {n: n for n in FILES}

    def read(self, spark: SparkSession, paths: dict[str, str], isni_formatters: list[str] | None = None, resolver=None, before: str | None = None) -> dict[str, DataFrame]:
        """paths: a path for each of FILES. before: release dates on or after it don't count. isni_formatters: URLs with $1."""
        t = {name: tsv(spark, paths[name], schema, header=False) for name, schema in FILES.items() if name in paths}
        people, bands = self.artists(t, PERSON_TYPES, True), self.artists(t, BAND_TYPES, False)
        links = self.artist_links(t, isni_formatters or [], resolver)
        kind = lambda types: t["artist"].where(F.col("type_id").isin(*types)).select(F.col("gid").alias("catalog_id"))
        return {
            "musicbrainz_artist": people, "musicbrainz_band": bands,
            "musicbrainz_artist_link": links.join(kind(PERSON_TYPES), "catalog_id", "left_semi"), "musicbrainz_band_link": links.join(kind(BAND_TYPES), "catalog_id", "left_semi"),
            "musicbrainz_release_group": self.release_groups(t, before), "musicbrainz_release_group_link": self.links(t, "l_release_group_url", "release_group", resolver),
            "musicbrainz_artist_band_relationship": self.members(t), "musicbrainz_release_group_artist_relationship": self.performers(t),
        }

    def artists(self, t: dict[str, DataFrame], types: tuple[int, ...], person: bool) -> DataFrame:
        """A row per name; aliases inherit dates and places. An impossible date is null and the row stays."""
        a = t["artist"].where(F.col("type_id").isin(*types))
        area = t["area"].select("id", F.lower("name").alias("name"))
        place = lambda key, name: area.select(F.col("id").alias(key), F.col("name").alias(name))
        born, born_precision = dates.from_parts(F.col("b_year"), F.col("b_month"), F.col("b_day"))
        died, died_precision = dates.from_parts(F.col("d_year"), F.col("d_month"), F.col("d_day"))
        base = a.join(place("b_place", "birth_place"), "b_place", "left").join(place("d_place", "death_place"), "d_place", "left").select(
            "id", F.col("gid").alias("catalog_id"), "label", born.alias("born"), born_precision.alias("born_precision"), died.alias("died"), died_precision.alias("died_precision"),
            *([gender(F.col("gender")).alias("gender")] if person else []), "birth_place", "death_place",
        )
        aliases = t["artist_alias"].select(F.col("parent_id").alias("id"), F.col("label").alias("alias"))
        names = base.select(*[c for c in base.columns if c != "label"], F.col("label").alias("name")).unionByName(base.join(aliases, "id").drop("label").withColumnRenamed("alias", "name"))
        rest = [c for c in base.columns if c not in ("id", "catalog_id", "label")]
        return names.where("name is not null").distinct().select("catalog_id", "name", text.tokenize(F.col("name")).alias("name_tokens"), *rest)

    def links(self, t: dict[str, DataFrame], edges: str, entity: str, resolver=None) -> DataFrame:
        e = t[edges].select(F.col("entity0").alias("id"), F.col("entity1").alias("url_id"))
        u = t["url"].select(F.col("id").alias("url_id"), "url")
        rows = e.join(u, "url_id").join(t[entity].select("id", F.col("gid").alias("catalog_id")), "id").select("catalog_id", "url")
        return link_rows(rows, resolver)

    def artist_links(self, t: dict[str, DataFrame], formatters: list[str], resolver=None) -> DataFrame:
        out = self.links(t, "l_artist_url", "artist", resolver)
        if "artist_isni" in t and formatters:
            made = F.explode(F.array(*[F.replace(F.lit(f), F.lit("$1"), F.col("isni")) for f in formatters])).alias("url")
            rows = t["artist_isni"].select(F.col("artist").alias("id"), made).join(t["artist"].select("id", F.col("gid").alias("catalog_id")), "id").select("catalog_id", "url")
            out = out.unionByName(link_rows(rows)).distinct()
        return out

    isni_pid = ISNI

    def members(self, t: dict[str, DataFrame]) -> DataFrame:
        """Artist to band. Links of the type for membership run from the band to the artist and are turned round."""
        kinds = t["link"].select(F.col("id").alias("link"), (F.col("link_type") == MEMBER_LINK_TYPE).alias("turn"))
        e = t["l_artist_artist"].join(kinds, "link", "left")
        turn = F.coalesce("turn", F.lit(False))
        pairs = e.select(F.when(turn, F.col("entity1")).otherwise(F.col("entity0")).alias("a"), F.when(turn, F.col("entity0")).otherwise(F.col("entity1")).alias("b"))
        gid = lambda key, name, types: t["artist"].where(F.col("type_id").isin(*types)).select(F.col("id").alias(key), F.col("gid").alias(name))
        return pairs.join(gid("a", "from_catalog_id", PERSON_TYPES), "a").join(gid("b", "to_catalog_id", BAND_TYPES), "b").select("from_catalog_id", "to_catalog_id").distinct()

    def performers(self, t: dict[str, DataFrame]) -> DataFrame:
        """Release group to artist, by all names of its credit."""
        credit = t["artist_credit_name"].select("artist_credit", F.col("artist").alias("id"))
        artist = t["artist"].select("id", F.col("gid").alias("to_catalog_id"))
        group = t["release_group"].select("artist_credit", F.col("gid").alias("from_catalog_id"))
        return group.join(credit, "artist_credit").join(artist, "id").select("from_catalog_id", "to_catalog_id").distinct()

    def release_groups(self, t: dict[str, DataFrame], before: str | None = None) -> DataFrame:
        first = self.release_dates(t, before)
        none = F.lit(None)
        return t["release_group"].join(first, "id", "left").select(
            F.col("gid").alias("catalog_id"), F.col("label").alias("name"), text.tokenize(F.col("label")).alias("name_tokens"), "born", "born_precision",
            none.cast("date").alias("died"), none.cast("int").alias("died_precision"),
        )

    def release_dates(self, t: dict[str, DataFrame], before: str | None = None) -> DataFrame:
        """The earliest date of each release group (id, born, born_precision), over countries and releases."""
        rows = t["release_country"].select("release", "year", "month", "day").unionByName(t["release_unknown_country"].select("release", "year", "month", "day"))
        date, precision = dates.from_parts(F.col("year"), F.col("month"), F.col("day"))
        rows = rows.select("release", date.alias("born"), precision.alias("born_precision"))
        if before is not None:
            rows = rows.where(F.col("born") < F.lit(before).cast("date"))
        releases = dates.earliest(rows, ["release"], "born", "born_precision").join(t["release"].select(F.col("id").alias("release"), F.col("release_group").alias("id")), "release")
        return dates.earliest(releases, ["id"], "born", "born_precision")
