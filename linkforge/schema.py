"""Catalogue registry, property identifiers and explicit schemas of every table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Knowledge-base items and properties.
CLASS_QUERY, OCCUPATION_QUERY = "class_query", "occupation_query"
ENTITY_QUERY = {
    "actor": OCCUPATION_QUERY, "band": CLASS_QUERY, "director": OCCUPATION_QUERY, "musician": OCCUPATION_QUERY,
    "producer": OCCUPATION_QUERY, "writer": OCCUPATION_QUERY, "musical_work": CLASS_QUERY, "audiovisual_work": CLASS_QUERY,
}
CLASS_QID = {
    "actor": "Q33999", "band": "Q215380", "director": "Q2526255", "musician": "Q639669",
    "producer": "Q3282637", "writer": "Q28389", "musical_work": "Q2188189", "audiovisual_work": "Q2431196",
}
INSTANCE_OF, SUBCLASS_OF, OCCUPATION = "P31", "P279", "P106"
EXACT_MATCH, OFFICIAL_WEBSITE, DESCRIBED_AT_URL = "P2888", "P856", "P973"
TWITTER_USERNAME, FACEBOOK_ID, ISNI = "P2002", "P2013", "P213"
BASED_ON_HEURISTIC, STATED_IN, RETRIEVED = "P887", "P248", "P813"
ARTIFICIAL_INTELLIGENCE, RECORD_LINKAGE = "Q11660", "Q1266546"
SEX_OR_GENDER, PLACE_OF_BIRTH, PLACE_OF_DEATH, DATE_OF_BIRTH, DATE_OF_DEATH = "P21", "P19", "P20", "P569", "P570"
BIO_PIDS = (SEX_OR_GENDER, PLACE_OF_BIRTH, PLACE_OF_DEATH, DATE_OF_BIRTH, DATE_OF_DEATH)
PUBLICATION_DATE, GENRE, PERFORMER, PARTICIPANT = "P577", "P136", "P175", "P710"
MOVIE_PIDS = ("P161", "P57", "P162", "P58", "P3092")
LINKER_FIELDS = {
    "P21": "sex_or_gender", "P19": "place_of_birth", "P20": "place_of_death", "P569": "born", "P570": "died", "P1477": "birth_name",
    "P734": "family_name", "P735": "given_name", "P742": "pseudonym", "P106": "occupations", "P136": "genres", "P577": "born",
}
NAME_FIELDS = ("name", "alias", "birth_name", "family_name", "given_name", "pseudonym", "real_name")
PROFESSIONS = {
    "actor": "Q33999", "actress": "Q33999", "animation_department": "Q266569", "art_department": "Q483501", "art_director": "Q706364",
    "assistant_director": "Q1757008", "camera_department": "Q1208175", "casting_department": "Q1049296", "casting_director": "Q1049296",
    "cinematographer": "Q222344", "composer": "Q36834", "costume_department": "Q59341113", "costume_designer": "Q1323191",
    "director": "Q2526255", "editor": "Q7042855", "electrical_department": "Q165029", "executive": "Q978044",
    "location_management": "Q1093536", "make_up_department": "Q935666", "manager": "Q2462658", "music_department": "Q639669",
    "producer": "Q3282637", "production_department": "Q2867219", "production_designer": "Q2962070", "production_manager": "Q21292974",
    "publicist": "Q4178004", "script_department": "Q1263187", "set_decorator": "Q6409989", "sound_department": "Q128124",
    "soundtrack": "Q639669", "special_effects": "Q21560152", "stunts": "Q465501", "talent_agent": "Q1344174",
    "transportation_department": "Q352388", "visual_effects": "Q1224742", "writer": "Q28389",
}
YEAR, MONTH, DAY, HOUR, MINUTE, SECOND = 9, 10, 11, 12, 13, 14


@dataclass(frozen=True)
class Target:
    """One (catalogue, entity): its tables and identifiers. A table that is absent is None."""

    catalog: str
    entity: str
    catalog_qid: str
    pid: str
    main: str
    link: str | None
    nlp: str | None
    relationship: str
    work: str | None

    @property
    def class_qid(self) -> str:
        return CLASS_QID[self.entity]

    @property
    def works_pid(self) -> str:
        return PARTICIPANT if self.catalog == "imdb" else PERFORMER

    @property
    def is_work(self) -> bool:
        return self.work is None

    @property
    def needs_occupations(self) -> bool:
        return self.catalog == "imdb" and not self.is_work


CATALOG_QID = {"discogs": "Q504063", "imdb": "Q37312", "musicbrainz": "Q14005", "twitter": "Q918"}
PERSON_PID = {"discogs": "P1953", "imdb": "P345", "musicbrainz": "P434", "twitter": TWITTER_USERNAME}
WORK_PID = {"discogs": "P1954", "imdb": "P345", "musicbrainz": "P436"}


def _targets() -> dict[tuple[str, str], Target]:
    out = {}

    def add(catalog, entity, main, link, nlp, relationship, work):
        pid = (WORK_PID if work is None else PERSON_PID)[catalog]
        out[catalog, entity] = Target(catalog, entity, CATALOG_QID[catalog], pid, main, f"{main}_link" if link else None, f"{main}_nlp" if nlp else None, relationship, work)

    for entity, main in (("musician", "discogs_musician"), ("band", "discogs_group")):
        add("discogs", entity, main, True, True, "discogs_master_artist_relationship", "musical_work")
    add("discogs", "musical_work", "discogs_master", False, False, "discogs_master_artist_relationship", None)
    for entity in ("actor", "director", "musician", "producer", "writer"):
        add("imdb", entity, f"imdb_{entity}", False, False, "imdb_title_name_relationship", "audiovisual_work")
    add("imdb", "audiovisual_work", "imdb_title", False, False, "imdb_title_name_relationship", None)
    for entity, main in (("musician", "musicbrainz_artist"), ("band", "musicbrainz_band")):
        add("musicbrainz", entity, main, True, False, "musicbrainz_release_group_artist_relationship", "musical_work")
    add("musicbrainz", "musical_work", "musicbrainz_release_group", True, False, "musicbrainz_release_group_artist_relationship", None)
    return out


TARGETS = _targets()


def target(catalog: str, entity: str) -> Target:
    try:
        return TARGETS[catalog, entity]
    except KeyError:
        raise ValueError(f"no such target: {catalog} {entity}; there are {sorted(TARGETS)}") from None


def catalogs() -> list[str]:
    return sorted({c for c, _ in TARGETS})


def entities(catalog: str | None = None) -> list[str]:
    return sorted({e for c, e in TARGETS if catalog in (None, c)})


def check_goal(goal: str) -> str:
    if goal not in ("training", "classification"):
        raise ValueError(f"goal must be training or classification, not {goal!r}")
    return goal


def _struct(spec: str) -> StructType:
    kinds = {"s": StringType(), "i": IntegerType(), "l": LongType(), "d": DateType(), "f": DoubleType(), "b": BooleanType(), "a": ArrayType(StringType()), "aa": ArrayType(ArrayType(StringType()))}
    return StructType([StructField(n, kinds[k]) for n, k in (x.split(":") for x in spec.split())])


ITEM = _struct(
    "qid:s tid:a name:a description:a url:a born:aa died:aa sex_or_gender:a place_of_birth:a place_of_death:a "
    "birth_name:a family_name:a given_name:a pseudonym:a occupations:a genres:a"
)
MAIN = _struct("catalog_id:s name:s name_tokens:a born:d born_precision:i died:d died_precision:i")
MAIN_EXTRAS = {
    "discogs_musician": _struct("real_name:s data_quality:s"), "discogs_group": _struct("real_name:s data_quality:s"),
    "discogs_master": _struct("main_release_id:s genres:a data_quality:s"),
    "imdb_title": _struct("title_type:s primary_title:s original_title:s is_adult:b runtime_minutes:i genres:a"),
    **{f"imdb_{e}": _struct("gender:s occupations:a") for e in ("actor", "director", "musician", "producer", "writer")},
    "musicbrainz_artist": _struct("gender:s birth_place:s death_place:s"), "musicbrainz_band": _struct("birth_place:s death_place:s"),
    "musicbrainz_release_group": StructType([]),
}
LINK = _struct("catalog_id:s url:s is_wiki:b url_tokens:a")
NLP = _struct("catalog_id:s description:s description_tokens:a")
RELATIONSHIP = _struct("from_catalog_id:s to_catalog_id:s")
LINKS = _struct("qid:s tid:s confidence:f")
STATEMENTS = _struct("subject:s predicate:s value:s tid:s")
CURATION_CATALOG = _struct("id:l name:s url:s desc:s type:s search_wp:s wd_prop:i wd_qual:i active:i owner:i note:s")
CURATION_ENTRY = _struct("catalog:i ext_id:s ext_url:s ext_name:s ext_desc:s q:i user:i timestamp:s random:f type:s")


def main_schema(table: str) -> StructType:
    return StructType(MAIN.fields + MAIN_EXTRAS[table].fields)
