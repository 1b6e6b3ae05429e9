import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from linkforge.plans import cli, linking
from linkforge.schema import ITEM, LINK, NLP, main_schema
from linkforge.sources import interchange
from linkforge.streaming import incremental

SYLLABLES = ["ka", "lo", "mi", "ne", "ru", "sa", "to", "vi"]


def name(i: int) -> str:
    return " ".join("".join(SYLLABLES[(i * p + j) % 8] for j in range(3)) + str(i % q) for p, q in ((3, 37), (5, 41)))


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    """120 items, each with a target of nearly its name; half are known links."""
    folder = tmp_path_factory.mktemp("world")
    items, main, links, texts = [], [], [], []
    for i in range(120):
        born = [[f"19{i % 90 + 10}-0{i % 9 + 1}-11T00:00:00Z", "11"]]
        items.append({"qid": f"Q{i}", **({"tid": [f"t{i}"]} if i % 2 else {}), "name": [name(i).title()], "url": [f"https://site{i}.example.com/a{i}"], "born": born, "description": [f"text of {name(i)}"]})
        row = (f"t{i}", name(i) if i % 5 else name(i) + " jr", sorted(name(i).split()), dt.date(1910 + i % 90, i % 9 + 1, 11), 11, None, None, None, None)
        main.append(row)
        url = f"https://site{i}.example.com/a{i}" if i % 3 else "https://www.itembase.example/wiki/Q%d" % i
        links.append((f"t{i}", url, "itembase" in url, ["itembase", "wiki", f"Q{i}"] if "itembase" in url else [f"site{i}", "example", f"a{i}"]))
        texts.append((f"t{i}", name(i), sorted(name(i).split())))
    (folder / "items.jsonl").write_text("\n".join(map(json.dumps, items)))
    for n, data, schema in (("discogs_group", main, main_schema("discogs_group")), ("discogs_group_link", links, LINK), ("discogs_group_nlp", texts, NLP)):
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/tables/{n}")
    return folder


def test_supervised_linking(spark, world):
    from linkforge.schema import target

    items = spark.read.schema(ITEM).json(f"{world}/items.jsonl")
    main, link, nlp = linking.target_tables(spark, f"{world}/tables", target("discogs", "band"))
    rows = linking.training_set(items.where("tid is not null"), main, link, nlp)
    n = rows.agg(F.sum("label"), F.count("label")).first()
    assert n[0] == 60 and n[1] > 100
    model = linking.train("lr", rows)
    found = linking.link(model, items.where("tid is null"), main, link, nlp)
    pairs = {(r["qid"][1:], r["tid"][1:]) for r in found.collect()}
    right = sum(a == b for a, b in pairs)
    assert right >= 54 and right / len(pairs) > 0.9
    assert linking.evaluation("nb", rows, "single", 3).first()["f1"] > 0.8
    again = {(r["qid"][1:], r["tid"][1:]) for r in linking.link(model, items.where("tid is null").repartition(7), main.repartition(3), link, nlp).collect()}
    assert again == pairs


def test_rule_linking(spark, world):
    from linkforge.schema import target

    items = spark.read.schema(ITEM).json(f"{world}/items.jsonl")
    main, link, _ = linking.target_tables(spark, f"{world}/tables", target("discogs", "band"))
    perfect = linking.baseline("perfect", items, main, check_dates=True)
    assert perfect.where("substring(qid, 2) = substring(tid, 2)").count() == perfect.count() == 96
    by_links = linking.baseline("links", items, main, link)
    assert by_links.where("substring(qid, 2) = substring(tid, 2)").count() == 80
    assert linking.baseline("all", items, main, link).select("rule").distinct().count() == 3


def test_commands(spark, world, tmp_path):
    t = f"{world}/tables"
    out = lambda n: str(tmp_path / n)
    run = lambda *a: cli.run(list(a), spark)
    run("train", "discogs", "band", "--tables", t, "--items", f"{world}/items.jsonl", "--model", out("m"), "--classifier", "nb")
    run("link", "discogs", "band", "--tables", t, "--items", f"{world}/items.jsonl", "--model", out("m"), "--out", out("links"))
    assert spark.read.csv(out("links")).count() > 50
    run("evaluate", "discogs", "band", "--tables", t, "--items", f"{world}/items.jsonl", "--out", out("report"), "--classifier", "nb", "--how", "single")
    assert spark.read.json(out("report")).first()["f1"] > 0.5
    predicted = interchange.read_predictions(spark, out("report-predictions"))
    assert predicted.count() > 100 and {r["fold"] for r in predicted.select("fold").distinct().collect()} == {0, 1, 2, 3, 4}
    run("link", "discogs", "band", "--tables", t, "--items", f"{world}/items.jsonl", "--model", out("m"), "--out", out("named"), "--name-rule")
    both = spark.read.csv(out("named"))
    assert 0 < both.count() <= spark.read.csv(out("links")).count()
    run("extract", "discogs", "band", "--tables", t, "--out", out("existing"))
    assert spark.read.csv(out("existing")).count() == 40
    run("baseline", "discogs", "band", "--tables", t, "--items", f"{world}/items.jsonl", "--out", out("base"), "--rule", "perfect")
    assert spark.read.csv(out("base")).count() == 96
    run("curate", "discogs", "band", "--tables", t, "--links", out("links"), "--out", out("game"), "--formatter", "https://x/$1")
    assert spark.read.json(out("game")).where("ext_name <> ''").count() > 50
    curated = spark.read.json(out("game")).orderBy("ext_id").limit(1).withColumns({"user": F.lit(7), "q": F.lit(424242)})
    curated.unionByName(curated.withColumns({"catalog": F.lit(99), "user": F.lit(0)})).write.json(out("entries"))
    run("curate", "discogs", "band", "--tables", t, "--links", out("links"), "--out", out("game2"), "--entries", out("entries"))
    assert spark.read.json(out("game2")).where("q = 424242").count() == 2  # the curated one, and another catalogue's
    claims = [(f"Q{i}", f"g{i}", "P1953", "string", f"t{i + 60}", None) for i in range(120)] + [(f"Q{i}", f"k{i}", "P31", "wikibase-entityid", "Q215380", None) for i in range(120)]
    claims += [(f"Q{i}", f"u{i}", "P856", "string", f"http://own{i}.example.org", None) for i in range(120)]
    spark.createDataFrame(claims, "qid string, guid string, pid string, kind string, value string, precision int").write.parquet(out("claims"))
    spark.createDataFrame([("Q1000", "Q215380")], "child string, parent string").write.parquet(out("edges"))
    spark.createDataFrame([(1, "P1", "https://x.org/$1", None, None)], "ord int, pid string, formatter_url string, id_regex string, url_regex string").write.parquet(out("meta"))
    same = ["--tables", t, "--claims", out("claims"), "--edges", out("edges"), "--metadata", out("meta")]
    run("sync-ids", "discogs", "band", *same, "--out", out("dead"))
    assert spark.read.json(out("dead")).count() == 60
    run("sync-links", "discogs", "band", *same, "--out", out("checked"))
    (tmp_path / "domains.txt").write_text("site61.example.com\nsite62.example.com\n")
    run("sync-links", "discogs", "band", *same, "--out", out("checked2"), "--blacklist", out("domains.txt"))
    added = [[r["value"] for r in spark.read.json(f"{out(x)}/urls_to_add").collect()] for x in ("checked", "checked2")]
    assert any("site61.example.com" in v for v in added[0]) and not any("site61.example.com" in v or "site62.example.com" in v for v in added[1])
    run("train", "discogs", "band", "--tables", t, "--items", f"{world}/items.jsonl", "--model", out("m2"), "--classifier", "nb", "--hierarchy", out("edges"))
    run("plan-identifiers", "discogs", "band", "--tables", t, "--claims", out("claims"), "--links", out("links"), "--out", out("plan"))
    assert {r["action"] for r in spark.read.json(out("plan")).select("action").distinct().collect()} == {"add"}
    run("plan-deprecate", "discogs", "band", "--tables", t, "--claims", out("claims"), "--links", out("dead"), "--out", out("retire"))
    assert spark.read.json(out("retire")).count() == 60


def test_streams(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([("Q1", "Ann"), ("Q2", "Bob")], "qid string, name string").write.parquet(source)
    targets = spark.createDataFrame([("t1", "ann")], "tid string, name string")
    stream = spark.readStream.schema("qid string, name string").parquet(source)
    q = incremental.link_batches(stream, lambda b: incremental.match_names(b, targets), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    assert [(r["qid"], r["tid"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("Q1", "t1")]
    events = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5), "a", 1.0), (dt.datetime(2024, 1, 1, 6), "a", 2.0)], "ts timestamp, event_type string, value double")
    assert [(r["n"], r["total"]) for r in incremental.windowed(events).collect()] == [(2, 3.0)]


def test_import_and_run(spark, tmp_path):
    import gzip

    from test_sources import ARTISTS, MASTERS

    for n, data in (("artists", ARTISTS), ("masters", MASTERS)):
        with gzip.open(tmp_path / f"{n}.xml.gz", "wt") as f:
            f.write(data)
    cli.run(["import", "discogs", "--tables", str(tmp_path / "t"), "--dumps", str(tmp_path)], spark)
    assert spark.read.parquet(str(tmp_path / "t" / "discogs_group")).count() == 2
    rel = [("Q10", "g", "P1954", "string", "10", None), ("Q1", "h", "P1953", "string", "1", None), ("Q10", "i", "P31", "wikibase-entityid", "Q2188189", None), ("Q1", "j", "P31", "wikibase-entityid", "Q215380", None)]
    spark.createDataFrame(rel, "qid string, guid string, pid string, kind string, value string, precision int").write.parquet(str(tmp_path / "claims"))
    spark.createDataFrame([("Q1000", "Q215380")], "child string, parent string").write.parquet(str(tmp_path / "edges"))
    cli.run(["works", "discogs", "band", "--tables", str(tmp_path / "t"), "--claims", str(tmp_path / "claims"), "--edges", str(tmp_path / "edges"), "--out", str(tmp_path / "w")], spark)
    assert [tuple(r) for r in spark.read.csv(str(tmp_path / "w")).collect()] == [("Q10", "P175", "Q1", "1")]


def test_run_validates_and_evaluates(spark, world, tmp_path, monkeypatch):
    """Every step of `run` is called with its options, in order."""
    seen = []
    real = cli.run

    def spy(argv, spark=None):
        seen.append(argv)

    monkeypatch.setattr(cli, "run", spy)
    a = cli.parser().parse_args(["run", "discogs", "--tables", "T", "--dumps", "D", "--items", "I", "--model", "M", "--out", "O", "--claims", "C", "--edges", "E", "--entities", "N", "--metadata", "P", "--blacklist", "B", "--hierarchy", "H", "--evaluate", "--name-rule"])
    cli._run_all(a, spark)
    band = [x for x in seen if x[2] == "band"]
    assert [x[0] for x in band] == ["extract", "sync-ids", "sync-links", "sync-bio", "train", "evaluate", "link"]
    assert "--blacklist" in band[2] and "--hierarchy" in band[4] and "--name-rule" in band[6]
    for x in seen:
        cli.parser().parse_args(x)
    assert real is not spy


def test_own_reader_and_classifier(spark):
    from pyspark.ml.classification import DecisionTreeClassifier

    from linkforge.operators import models
    from linkforge.sources import base

    class Own(base.CatalogReader):
        catalog = "own"

        def read(self, spark, paths, **options):
            return {}

    base.register(Own)
    assert base.READERS.pop("own") is Own
    rows = spark.createDataFrame([(float(i % 2), i % 2) for i in range(40)], "a double, label int")
    models.register("tree", lambda p, f, y: DecisionTreeClassifier(maxDepth=int(p["depth"]), featuresCol=f, labelCol=y), depth=2)
    try:
        got = models.train("tree", rows, ["a"], depth=1).score(rows)
        assert got.where("abs(confidence - label) > 0.01").count() == 0
        with pytest.raises(ValueError, match="no "):
            models.train("tree", rows, ["a"], width=1)
    finally:
        models.OWN.pop("tree"), models.DEFAULTS.pop("tree")
    with pytest.raises(ValueError, match="built in"):
        models.register("nb", None)


def test_perceptron_stops_early(spark):
    from linkforge.operators import models

    rows = spark.createDataFrame([(f"Q{i}", float(i % 2), float(i % 3), i % 2) for i in range(120)], "qid string, a double, b double, label int")
    m = models.train("mlp", rows, ["a", "b"], hidden=[4], max_iter=60, patience=10, step=5)
    assert m.score(rows).where("(confidence > 0.5) <> (label = 1)").count() == 0


def test_retries(monkeypatch):
    import io
    import urllib.error
    from email.message import Message

    from linkforge.sources import online

    asked, waited = [], []
    after = Message()
    after["Retry-After"] = "7"

    def answer(request, timeout):
        asked.append(request.full_url)
        if len(asked) == 1:
            raise urllib.error.HTTPError(request.full_url, 429, "slow down", after, None)
        if len(asked) == 2:
            raise urllib.error.URLError("lost")
        return io.BytesIO(b"x")

    monkeypatch.setattr(online.urllib.request, "urlopen", answer)
    monkeypatch.setattr(online.time, "sleep", waited.append)
    assert online.call("http://x").read() == b"x" and waited == [7.0, 2.0]
    asked.clear()
    with pytest.raises(urllib.error.HTTPError):
        online.call("http://x", tries=1)


def test_unknown_arguments():
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["train", "nowhere", "band"])
    with pytest.raises(ValueError, match="goal"):
        linking.prepare_source(None, "x")
