import gzip
import json


from linkforge.schema import entities, main_schema, target
from linkforge.sources import interchange, knowledge
from linkforge.sources.discogs import DiscogsReader
from linkforge.sources.imdb import ImdbReader
from linkforge.sources.musicbrainz import FILES, MusicBrainzReader


def rows(df, *order):
    return sorted((tuple(r) for r in (df.select(*order) if order else df).collect()), key=str)


ARTISTS = """<artists>
<artist><id>1</id><name>The Bänd</name><realname>R</realname><profile>Old band of rock</profile><data_quality>Correct</data_quality>
 <namevariations><name>Bänd, The</name><name></name></namevariations><urls><url>http://example.com/x http://en.wikipedia.org/wiki/B</url><url>junk here</url></urls><members><name>Ann</name></members></artist>
<artist><id>2</id><name>Ann</name><groups><name>The Bänd</name></groups></artist>
<artist><id>3</id><name>Solo</name></artist>
<artist><name>no id</name><groups><name>x</name></groups></artist>
</artists>"""
MASTERS = """<masters>
<master id="10"><main_release>99</main_release><title>Album One</title><year>1999</year><data_quality>Needs Vote</data_quality><genres><genre>Rock</genre></genres><styles><style>Hard Rock</style></styles><artists><artist><id>1</id></artist><artist><id>1</id></artist><artist><id>2</id></artist></artists></master>
<master id="11"><title>Nothing</title><year>0</year></master>
</masters>"""


def test_discogs(spark, tmp_path):
    (tmp_path / "artists.xml").write_text(ARTISTS)
    with gzip.open(tmp_path / "masters.xml.gz", "wt") as f:
        f.write(MASTERS)
    paths = {"artists": str(tmp_path / "artists.xml"), "masters": str(tmp_path / "masters.xml.gz")}
    t = DiscogsReader().write(spark, paths, str(tmp_path / "out"))
    assert rows(t["discogs_group"], "catalog_id", "name", "data_quality") == [("1", "Bänd, The", "correct"), ("1", "The Bänd", "correct")]
    assert rows(t["discogs_group_link"], "url", "is_wiki") == [("http://en.wikipedia.org/wiki/B", True), ("http://example.com/x", False)]
    assert rows(t["discogs_group_nlp"], "description_tokens") == [(["band", "old", "rock"],)]
    assert rows(t["discogs_musician"], "catalog_id") == [("2",)]
    m = {r["catalog_id"]: r for r in t["discogs_master"].collect()}
    assert (str(m["10"]["born"]), m["10"]["born_precision"], m["10"]["genres"], m["10"]["main_release_id"]) == ("1999-01-01", 9, ["hard", "rock"], "99")
    assert m["11"]["born"] is None and m["11"]["born_precision"] is None
    assert rows(t["discogs_master_artist_relationship"]) == [("10", "1"), ("10", "2")]
    solo = DiscogsReader().read(spark, {"artists": paths["artists"]}, solo_as_musician=True)["discogs_musician"]
    assert rows(solo, "catalog_id") == [("2",), ("3",)]


NAMES = r"""nconst	primaryName	birthYear	deathYear	primaryProfession	knownForTitles
nm1	Ann "A" Lee	1950	\N	actress,writer	tt1,tt2
nm2	Bob	\N	\N	miscellaneous	\N
nm3	No Job	1900	1950	\N	tt1
nm4	Cy	1960	\N	composer,unknown_job	tt1
"""
TITLES = r"""tconst	titleType	primaryTitle	originalTitle	isAdult	startYear	endYear	runtimeMinutes	genres
tt1	movie	The One	Der Eine	0	1990	\N	90	Drama,Comedy
tt2	short	Same	Same	1	\N	\N	\N	\N
"""


def test_imdb(spark, tmp_path):
    (tmp_path / "n.tsv").write_text(NAMES)
    (tmp_path / "t.tsv").write_text(TITLES)
    t = ImdbReader().read(spark, {"names": str(tmp_path / "n.tsv"), "titles": str(tmp_path / "t.tsv")})
    assert rows(t["imdb_actor"], "catalog_id", "name", "gender", "occupations") == [("nm1", 'Ann "A" Lee', "female", ["Q28389"]), ("nm2", "Bob", None, [])]
    assert rows(t["imdb_musician"], "catalog_id", "occupations") == [("nm2", []), ("nm4", ["Q36834"])]
    assert rows(t["imdb_director"], "catalog_id") == [("nm2",)]
    assert rows(t["imdb_writer"], "catalog_id", "occupations") == [("nm1", ["Q33999"]), ("nm2", [])]
    assert rows(t["imdb_title"], "catalog_id", "name", "is_adult", "runtime_minutes", "genres") == [("tt1", "Der Eine", False, 90, ["comedy", "drama"]), ("tt1", "The One", False, 90, ["comedy", "drama"]), ("tt2", "Same", True, None, None)]
    assert rows(t["imdb_title_name_relationship"]) == [("tt1", "nm1"), ("tt1", "nm4"), ("tt2", "nm1")]
    for name in ("imdb_actor", "imdb_title"):
        assert {f.name for f in main_schema(name)} == set(t[name].columns)


def _mb(tmp_path):
    data = {
        "artist": [[1, "g1", "Ann", "", 1950, 2, 31, r"\N", r"\N", r"\N", 1, 5, 2, "", "", "", "", 5, r"\N"], [2, "g2", "Band", "", 1990, r"\N", r"\N", 1995, 6, r"\N", 2, 5, r"\N", "", "", "", "", r"\N", r"\N"], [3, "g3", "Char", "", *[r"\N"] * 6, 9, 5, r"\N", "", "", "", "", r"\N", r"\N"]],
        "artist_alias": [[1, 1, "Annie"]], "area": [[5, "a5", "Rome"]], "artist_isni": [[1, "0001"]], "url": [[7, "u7", "http://ann.example.com http://two.example.org"], [8, "u8", "band.example.com"]],
        "l_artist_url": [[1, 1, 1, 7], [2, 1, 2, 8]], "l_release_group_url": [[1, 1, 20, 8]], "link": [[50, 855], [51, 1]], "l_artist_artist": [[1, 50, 2, 1], [2, 51, 1, 2], [3, 51, 1, 1]],
        "release_group": [[20, "r20", "Album", 30, 1]], "release": [[40, "x", "Album", 30, 20], [41, "y", "Album", 30, 20]], "release_country": [[40, 1, 1991, 5, r"\N"], [40, 2, 1990, r"\N", r"\N"]], "release_unknown_country": [[41, 1990, 1, 1], [41, 1800, 13, 1]],
        "artist_credit_name": [[30, 0, 1, "Ann"], [30, 1, 2, "Band"]],
    }
    for name in FILES:
        (tmp_path / name).write_text("".join("\t".join(map(str, r)) + "\n" for r in data[name]))
    return {name: str(tmp_path / name) for name in FILES}


def test_musicbrainz(spark, tmp_path):
    t = MusicBrainzReader().read(spark, _mb(tmp_path), isni_formatters=["https://isni.org/isni/$1"])
    assert rows(t["musicbrainz_artist"], "catalog_id", "name", "born", "gender", "birth_place") == [("g1", "Ann", None, "female", "rome"), ("g1", "Annie", None, "female", "rome")]
    b = t["musicbrainz_band"].first()
    assert (str(b["born"]), b["born_precision"], str(b["died"]), b["died_precision"]) == ("1990-01-01", 9, "1995-06-01", 10)
    assert rows(t["musicbrainz_artist_link"], "url") == [("http://ann.example.com",), ("http://two.example.org",), ("https://isni.org/isni/0001",)]
    assert rows(t["musicbrainz_band_link"], "url") == [("https://band.example.com",)]
    assert rows(t["musicbrainz_release_group_link"], "catalog_id") == [("r20",)]
    assert rows(t["musicbrainz_artist_band_relationship"]) == [("g1", "g2")]
    assert rows(t["musicbrainz_release_group_artist_relationship"]) == [("r20", "g1"), ("r20", "g2")]
    g = t["musicbrainz_release_group"].first()
    assert (str(g["born"]), g["born_precision"]) == ("1990-01-01", 11)  # of equal dates the finer
    cut = MusicBrainzReader().read(spark, _mb(tmp_path), before="1990-01-01")["musicbrainz_release_group"].first()
    assert cut["born"] is None


def _claim(guid, kind, value, snak="value"):
    return {"id": guid, "rank": "normal", "mainsnak": {"snaktype": snak, "datavalue": {"type": kind, "value": value}}}


ENTITIES = [
    {"id": "Q1", "labels": {"en": {"value": "Ann"}, "de": {"value": "Ann"}}, "aliases": {"en": [{"value": "Annie"}]}, "descriptions": {"en": {"value": "singer"}}, "sitelinks": {"enwiki": {"title": "Ann X"}},
     "claims": {"P569": [_claim("a", "time", {"time": "+1950-03-04T00:00:00Z", "precision": 11}), _claim("b", "time", {"time": "-0044-01-01T00:00:00Z", "precision": 9})], "P21": [_claim("c", "wikibase-entityid", {"id": "Q6"})],
                "P106": [_claim("d", "wikibase-entityid", {"id": "Q11"})], "P345": [_claim("e", "string", "nm1")], "P1477": [_claim("f", "monolingualtext", {"text": "Anna", "language": "en"})], "P856": [_claim("g", "string", "http://ann.org")],
                "P570": [{"id": "h", "rank": "normal", "mainsnak": {"snaktype": "novalue"}}], "P31": [_claim("i", "wikibase-entityid", {"id": "Q5"})]}},
    {"id": "Q6", "labels": {"en": {"value": "female"}}, "claims": {}},
    {"id": "Q2", "labels": {"en": {"value": "Bob"}}, "claims": {"P106": [_claim("j", "wikibase-entityid", {"id": "Q33999"})]}},
    {"id": "Q3", "labels": {}, "claims": {"P106": [_claim("k", "wikibase-entityid", {"id": "Q33999"})]}},
]


def test_knowledge_base(spark, tmp_path):
    (tmp_path / "e.json").write_text("\n".join(json.dumps(e) for e in ENTITIES))
    e = knowledge.read_entities(spark, str(tmp_path / "e.json"))
    c = knowledge.claims(e)
    assert rows(c.where("qid = 'Q1' and kind = 'time'"), "value", "precision") == [("1950-03-04T00:00:00Z", 11)]
    props = spark.createDataFrame([("http://x/P345", "https://imdb.example/$1", None, None), ("P9", None, None, None)], "pid string, formatter_url string, id_regex string, url_regex string")
    meta = knowledge.property_metadata(props)
    edges = spark.createDataFrame([("Q11", "Q33999")], "child string, parent string")
    t = target("imdb", "actor")
    assert rows(knowledge.with_identifier(c, edges, t)) == [("Q1", "nm1")]
    assert rows(knowledge.without_identifier(c, edges, t)) == [("Q2",), ("Q3",)]
    assert rows(knowledge.with_urls(c, edges, "actor", ["P856"])) == [("Q1", "http://ann.org")]
    ids = knowledge.with_identifier(c, edges, t)
    item = knowledge.linker_items(e, meta, ["P856"], t, ids).first()
    assert item["name"] == ["Ann", "Annie"] and item["tid"] == ["nm1"] and item["sex_or_gender"] == ["female"] and item["occupations"] == ["Q11"] and item["birth_name"] == ["Anna"]
    assert item["url"] == ["http://ann.org", "https://en.wikipedia.org/wiki/Ann_X", "https://imdb.example/nm1"]
    assert item["born"] == [["1950-03-04T00:00:00Z", "11"]] and item["died"] is None
    assert knowledge.linker_items(e, meta, [], target("imdb", "actor")).count() == 2
    assert rows(knowledge.biodata(c, e), "qid", "pid", "value", "labels") == [("Q1", "P21", "Q6", ["female"]), ("Q1", "P569", "1950-03-04/11", None)]
    assert knowledge.usable_patterns(["a+", "(", None]) == ["a+", None, None]


def test_interchange(spark, tmp_path):
    p = lambda n: str(tmp_path / n)
    interchange.write_links(spark.createDataFrame([("Q1", "t", 0.666)], "qid string, tid string, confidence double"), p("links"))
    assert rows(interchange.read_links(spark, p("links"))) == [("Q1", "t", 0.666)]
    interchange.write_statements(spark.createDataFrame([("Q1", "P1", "v,w", "t")], "subject string, predicate string, value string, tid string"), p("st"))
    assert rows(interchange.read_statements(spark, p("st"))) == [("Q1", "P1", "v,w", "t")]
    (tmp_path / "ids.json").write_text('{"Q1": "a", "Q2": "b"}')
    assert rows(interchange.read_identifiers(spark, p("ids.json"))) == [("Q1", "a"), ("Q2", "b")]
    interchange.write_invalid(spark.createDataFrame([("t", "Q1"), ("t", "Q2")], "tid string, qid string"), p("bad"))
    assert rows(interchange.read_invalid(spark, p("bad"))) == [("t", "Q1"), ("t", "Q2")]
    (tmp_path / "words.txt").write_text("b\n\na\n")
    assert interchange.read_words(spark, p("words.txt")) == ["a", "b"]
    df = spark.range(3)
    assert interchange.keyed(df, p("k"), "x").count() == 3
    assert interchange.keyed(df.where("id > 5"), p("k"), "x").count() == 3


def test_registry():
    assert len(entities()) == 8 and target("discogs", "musical_work").relationship == "discogs_master_artist_relationship"
    assert target("musicbrainz", "band").pid == "P434" and target("musicbrainz", "musical_work").pid == "P436"
    assert target("imdb", "writer").needs_occupations and not target("discogs", "band").needs_occupations




def test_archive_is_unpacked(spark, tmp_path):
    import tarfile

    from linkforge.sources import musicbrainz

    (tmp_path / "mbdump").mkdir()
    (tmp_path / "mbdump" / "area").write_text("1\tg\tHere\n")
    (tmp_path / "mbdump" / "other").write_text("no")
    with tarfile.open(tmp_path / "a.tar.bz2", "w:bz2") as t:
        t.add(tmp_path / "mbdump", "mbdump")
    got = musicbrainz.unpack(str(tmp_path / "a.tar.bz2"), str(tmp_path / "out"))
    assert list(got) == ["area"] and spark.read.csv(got["area"], sep="\t").first()[2] == "Here"


def test_properties_and_labels(spark):
    from linkforge.sources import knowledge

    p = spark.createDataFrame([("http://x/entity/P12", "http://x/ontology#Url"), ("P3", "url"), ("P4", "ExternalId"), ("", "url")], "pid string, datatype string")
    assert knowledge.url_properties(p) == ["P3", "P12"]
    m = spark.createDataFrame([("P1", "https://x/$1", "[0-9]+", None), ("P2", "https://y/$1", "(?P<bad", "(")], "pid string, formatter_url string, id_regex string, url_regex string")
    assert [(r["pid"], r["id_regex"], r["url_regex"]) for r in knowledge.property_metadata(m).orderBy("ord").collect()] == [("P1", "[0-9]+", None), ("P2", None, None)]
    e = spark.createDataFrame([("Q1", {"en": ("Ann",), "de": ("Anna",)}), ("Q2", {"en": ("Bob",)})], "id string, labels map<string,struct<value:string>>")
    ids = spark.createDataFrame([("Q1",)], "id string")
    assert sorted(tuple(r) for r in knowledge.labels(e, ids).collect()) == [("Q1", "de", "Anna"), ("Q1", "en", "Ann")]
    assert [tuple(r) for r in knowledge.labels(e, ids, ("en",)).collect()] == [("Q1", "en", "Ann")]


def test_totals(spark):
    from linkforge.sources import online

    a, b = spark.createDataFrame([("u",), ("v",)], "url string"), spark.createDataFrame([("w",)], "url string")
    assert tuple(online.totals(a, b).first()) == (3, 2, 1)


def test_resolve_and_blacklist(spark, tmp_path):
    from linkforge.sources import interchange, knowledge

    e = spark.createDataFrame([("Q10", {"en": ("Ann",)}, {"en": [("Annie",)]}), ("Q9", {"en": ("ann",), "de": ("Anna",)}, None)], "id string, labels map<string,struct<value:string>>, aliases map<string,array<struct<value:string>>>")
    t = spark.createDataFrame([("ANN",), ("annie",), ("Anna",), (None,)], "term string")
    assert sorted((str(r["term"]), r["qid"]) for r in knowledge.resolve(t, e).collect()) == [("ANN", "Q9"), ("Anna", None), ("None", None), ("annie", "Q10")]
    (tmp_path / "page.html").write_text("<ul><li><b>a.example</b></li>\n<li class='x'> b.example </li></ul>")
    (tmp_path / "lines.txt").write_text("c.example\n\nd.example\n")
    assert interchange.read_blacklist(spark, str(tmp_path / "page.html")) == ["a.example", "b.example"]
    assert interchange.read_blacklist(spark, str(tmp_path / "lines.txt")) == ["c.example", "d.example"]
