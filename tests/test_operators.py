import pytest
from pyspark.sql import functions as F

from linkforge import schema
from linkforge.operators import analysis, blocking, closure, curation, edits, enrich, evaluate, features, models, rules, validate


def rows(df, *order):
    return sorted(tuple(r) for r in (df.select(*order) if order else df).collect())


@pytest.fixture(scope="module")
def people(spark):
    s = spark.createDataFrame([("Q1", ["ana", "mueller"]), ("Q2", ["bob", "dylan", "x"]), ("Q3", [])], "qid string, tokens array<string>")
    t = spark.createDataFrame([("t1", ["ana", "mueller", "jr"]), ("t2", ["dylan", "bob"]), ("t3", ["ana"]), ("t4", [])], "tid string, tokens array<string>")
    return s, t


def test_blocking(people):
    s, t = people
    assert rows(blocking.candidates(s, t, k=1), "qid", "tid", "shared") == [("Q1", "t1", 2), ("Q2", "t2", 2)]
    assert rows(blocking.supersets(s, t)) == [("Q1", "t1")]
    assert rows(blocking.subsets(s, t)) == [("Q2", "t2")]
    assert rows(blocking.subsets(s, t, least=1, without=blocking.subsets(s, t))) == [("Q1", "t3")]
    assert rows(blocking.candidates(s, t, most_frequent=1), "qid", "tid") == [("Q1", "t1"), ("Q2", "t2")]
    assert [r["tid"] for r in blocking.search(t, ["ana", "jr"]).collect()] == ["t1", "t3"]
    assert blocking.recall(blocking.supersets(s, t), blocking.subsets(s, t)).first()["recall"] == 0.0


def test_closure(spark):
    e = spark.createDataFrame([("b", "a"), ("c", "b"), ("a", "c"), ("d", "c"), (None, "a")], "child string, parent string")
    assert rows(closure.subclasses(e, "a")) == [("a",), ("b",), ("c",), ("d",)]
    assert rows(closure.superclasses(e, "d")) == [("a",), ("b",), ("c",), ("d",)]
    chain = spark.createDataFrame([(str(i + 1), str(i)) for i in range(6)], "child string, parent string")
    with pytest.raises(RuntimeError):
        closure.closure(chain, "up", F.lit("0"), most_rounds=3)
    assert {r["node"]: r["related"] for r in closure.expansion(chain.limit(2)).collect()} == {"0": ["0", "1", "2"], "1": ["0", "1", "2"], "2": ["0", "1", "2"]}
    r = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("y", "x")], "source string, target string")
    assert rows(closure.follow(spark.createDataFrame([("a",), ("c",), ("x",), ("z",)], "q string"), r, "q")) == [("c",), ("c",), ("z",)]


def test_rules(spark):
    p = spark.createDataFrame([("Q1", "t1", 0.9), ("Q1", "t2", 0.9), ("Q2", "t3", 0.2), ("Q2", "t4", 0.9)], "qid string, tid string, confidence double")
    s = spark.createDataFrame([("Q1", ["ann"], ["a"]), ("Q2", ["bob"], None)], "qid string, name array<string>, pseudonym array<string>")
    wd = "https://www.itembase.example/wiki/Q"
    t = spark.createDataFrame([("t1", ["a"], None), ("t2", ["b"], [wd + "1"]), ("t3", ["x"], None), ("t4", ["bob"], ["http://z", wd + "9"])], "tid string, name array<string>, url array<string>")
    assert rows(rules.apply_rules(p, s, t), "tid", "confidence") == [("t1", 0.9), ("t2", 1.0), ("t3", 0.0), ("t4", 0.0)]
    links = spark.createDataFrame([("Q1", "t1", 0.4), ("Q2", "t1", 0.9), ("Q3", "t2", 0.7), ("Q2", "t2", 0.7)], "qid string, tid string, confidence double")
    assert rows(rules.best_per_target(links, 0.3, 0.8)) == [("Q1", "t1", 0.4), ("Q2", "t2", 0.7)]
    assert rows(rules.first_per_target(links), "tid", "qid") == [("t1", "Q1"), ("t2", "Q2")]


def test_validate(spark):
    ids = spark.createDataFrame([("Q1", "t1"), ("Q2", "t2"), ("Q3", "t9"), ("Q4", "t4")], "qid string, tid string")
    target = spark.createDataFrame([("t1",), ("t2",), ("t4",)], "tid string")
    assert [(r["tid"], r["qids"]) for r in validate.dead_ids(ids, target).collect()] == [("t9", ["Q3"])]
    s = spark.createDataFrame([("Q1", "a"), ("Q1", "b"), ("Q2", "a"), ("Q4", "z")], "qid string, value string")
    t = spark.createDataFrame([("t1", "b"), ("t1", "c"), ("t2", "y"), ("t2", None)], "tid string, value string")
    got = validate.compare_sets(ids, s, t)
    assert rows(got["shared"]) == [("Q1", "t1", "b")]
    assert rows(got["extra"]) == [("Q1", "t1", "c"), ("Q2", "t2", "y")]
    assert rows(got["source_only"]) == [("Q1", "t1", "a"), ("Q2", "t2", "a")]
    assert rows(got["deprecate"]) == [("t2", "Q2")]


def test_validate_bio(spark):
    ids = spark.createDataFrame([("Q1", "t1"), ("Q2", "t2"), ("Q3", "t3")], "qid string, tid string")
    s = spark.createDataFrame(
        [("Q1", "P569", "1950-03-04/11", None), ("Q1", "P19", "Q60", ["New York", "NYC"]), ("Q2", "P569", "1900-01-01/9", None), ("Q3", "P21", "Q1", ["male"])], "qid string, pid string, value string, labels array<string>"
    )
    t = spark.createDataFrame([("t1", "P569", "1950-01-01/9"), ("t1", "P19", "new york"), ("t1", "P570", "2000-01-01/9"), ("t2", "P569", "1901-01-01/9"), ("t3", "P569", "1950-01-01/7")], "tid string, pid string, value string")
    got = validate.validate_bio(ids, s, t)
    assert rows(got["shared"]) == [("Q1", "P19", "Q60", "t1"), ("Q1", "P569", "1950-03-04/11", "t1")]
    assert rows(got["extra"]) == [("Q1", "P570", "2000-01-01/9", "t1"), ("Q2", "P569", "1901-01-01/9", "t2"), ("Q3", "P569", "1950-01-01/7", "t3")]
    assert rows(got["deprecate"]) == [("t2", "Q2"), ("t3", "Q3")]
    assert rows(validate.validate_bio(ids, s, t, require_same_pid=True)["extra"]) == [("Q2", "P569", "1901-01-01/9", "t2")]


def test_enrichment(spark):
    rel = spark.createDataFrame([("w1", "p1"), ("w1", "p2"), ("w9", "p1")], "from_catalog_id string, to_catalog_id string")
    works = spark.createDataFrame([("Q11", "w1"), ("Q10", "w1")], "qid string, tid string")
    people = spark.createDataFrame([("Q1", "p1"), ("Q2", "p2")], "qid string, tid string")
    got = enrich.for_target(rel, works, people, schema.target("discogs", "band"))
    assert rows(got) == [("Q10", "P175", "Q1", "p1"), ("Q10", "P175", "Q2", "p2")]
    assert schema.target("imdb", "actor").works_pid == "P710"


def test_edit_plans(spark):
    claims = spark.createDataFrame(
        [("Q1", "g1", "P345", "nm1"), ("Q2", "g2", "P2002", "Bob"), ("Q2", "g3", "P2002", "bob"), ("Q3", "g4", "P856", "http://x.org/"), ("Q5", "g5", "P161", "Q9")], "qid string, guid string, pid string, value string"
    )
    links = spark.createDataFrame([("Q1", "nm1"), ("Q1", "nm2"), ("Q4", "nm3")], "qid string, tid string")
    assert rows(edits.add_identifiers(links, claims, "P345", "Q37312"), "action", "subject", "value") == [("add", "Q1", "nm2"), ("add", "Q4", "nm3"), ("reference", "Q1", "nm1")]
    s = spark.createDataFrame([("Q2", "P2002", "BOB", "t"), ("Q3", "P2888", "http://x.org", "t"), ("Q5", "P710", "Q9", "t")], "subject string, predicate string, value string, tid string")
    got = rows(edits.add_people_statements(s, claims, "P1953", "Q504063", "links"), "action", "subject", "predicate", "guid")
    assert got == [("add", "Q5", "P710", None), ("reference", "Q2", "P2002", "g2"), ("reference", "Q3", "P856", "g4")]
    assert rows(edits.add_works_statements(s, claims, "P345", "Q37312", film=True).where("subject = 'Q5'"), "action", "predicate") == [("reference", "P161")]
    bad = spark.createDataFrame([("nm1", "Q1"), ("nm7", "Q1")], "tid string, qid string")
    assert rows(edits.retire("delete", bad, claims, "P345"), "action", "subject", "guid") == [("delete", "Q1", "g1")]
    with pytest.raises(ValueError, match="action"):
        edits.retire("burn", bad, claims, "P345")
    v = spark.createDataFrame([("Q1",), ("1984-11-16/11",), ("x",)], "v string").select(edits.parse_value(F.col("v")).alias("p")).select("p.kind", "p.year", "p.precision").collect()
    assert [tuple(r) for r in v] == [("item", None, None), ("time", 1984, 11), ("string", None, None)]
    moved = spark.createDataFrame([("Q4", "Q1")], "source string, target string")
    assert rows(edits.plan_additions(s.limit(0).unionByName(spark.createDataFrame([("Q4", "P345", "nm1", "t")], s.schema)), claims, moved), "action", "subject") == [("reference", "Q1")]


def test_curation(spark):
    t = schema.target("discogs", "band")
    empty = spark.createDataFrame([], schema.CURATION_CATALOG)
    first = curation.upsert_catalog(empty, curation.catalog_row(spark, t, "one"))
    both = curation.upsert_catalog(first, curation.catalog_row(spark, t, "two"))
    again = curation.upsert_catalog(both, curation.catalog_row(spark, t, "one", note="new"))
    assert rows(again, "id", "name", "note") == [(1, "one", "new"), (2, "two", "")]
    assert first.first()["wd_prop"] == 1953


def test_evaluation(spark):
    data = [(i, i % 2, (i % 2) * 0.9 + 0.05 * (i % 3), float(i % 5) / 5) for i in range(120)]
    df = spark.createDataFrame(data, "k int, label int, a double, b double")
    folds = evaluate.folds(df, 5, ["k"]).groupBy("label", "fold").count().collect()
    assert {r["count"] for r in folds} == {12}
    assert evaluate.single_k_fold("lr", df, ["a", "b"], ["k"], 3).first()["f1"] == 1.0
    r = evaluate.average_k_fold("nb", df, ["a", "b"], ["k"], 3).first()
    assert r["f1_mean"] == 1.0 and r["f1_std"] == 0.0
    best, table = evaluate.grid_search("nb", df, ["a", "b"], ["k"], 2, [{"binarize": 0.99}, {"binarize": 0.2}])
    assert best == {"binarize": 0.2} and table.count() == 2
    per, found = evaluate.nested_k_fold("nb", df, ["a", "b"], ["k"], 2, 2, [{"binarize": 0.2}])
    assert per.count() == 2 and len(found) == 2
    assert len(evaluate.grid("nb")) == 45
    m = evaluate.metrics(spark.createDataFrame([(0, 0, 0, 5)], "tp int, fp int, fn int, tn int")).first()
    assert (m["precision"], m["recall"], m["f1"]) == (0.0, 0.0, 0.0)


def test_models_save_and_pad(spark, tmp_path):
    df = spark.createDataFrame([(i, i % 2, float(i % 2), float(i % 7)) for i in range(60)], "k int, label int, a double, b double")
    for kind, params in (("lr", {}), ("vc", {"members": ("nb", "lr"), "voting": "hard"}), ("gc", {"members": ("nb", "lr")})):
        m = models.train(kind, df, ["a", "b"], **params)
        m.save(str(tmp_path / kind))
        again = models.Model.load(str(tmp_path / kind))
        x = rows(m.score(df), "k", "confidence")
        assert x == rows(again.score(df), "k", "confidence")
        assert all(0 <= c <= 1 for _, c in x)
        # a missing feature counts as 0, whatever its place
        assert again.score(df.drop("b")).count() == 60
    with pytest.raises(ValueError, match="no such classifier"):
        models.train("x", df, ["a"])
    with pytest.raises(ValueError, match="has no"):
        models.train("lr", df, ["a"], depth=3)
    assert models.options(["a=1", "--b=x"]) == {"a": 1.0, "b": "x"}


def test_scores_in_bounds(spark):
    import random

    r = random.Random(7)
    words = ["", "a", "ab", "abc", "band", "ö", "x y", "x"]
    data = [(i, [r.choice([*words, None]) for _ in range(r.randrange(4))], [r.choice(words) for _ in range(r.randrange(4))]) for i in range(150)]
    df = spark.createDataFrame(data, "i int, a array<string>, b array<string>")
    a, b = F.col("a"), F.col("b")
    made = {"exact": f(a, b) for f in [features.exact_match]} | {"lev": features.levenshtein(a, b), "cos": features.token_cosine(a, b), "ker": features.string_kernel(a, b), "sh": features.shared_tokens(a, b), "plus": features.shared_tokens_plus(a, b)}
    for row in df.select(*[c.alias(n) for n, c in made.items()]).collect():
        assert all(v is not None and -1e-9 <= v <= 1 + 1e-9 for v in row)


def test_analysis(spark):
    u = spark.createDataFrame([("http://a.org/1",), ("http://a.org/2",), ("http://b.org",), ("none",)], "url string")
    assert [tuple(r) for r in analysis.domains(u).collect()] == [("a.org", 2), ("b.org", 1)]
    assert analysis.sample(spark.range(1000), "id", 0.1).count() == analysis.sample(spark.range(1000), "id", 0.1).count() < 200


def test_mixture_without_labels(spark):
    import random

    r = random.Random(1)
    data = [(i, i % 5 == 0, *[float(r.random() < (0.9 if i % 5 == 0 else 0.08)) for _ in range(5)]) for i in range(2000)]
    df = spark.createDataFrame(data, "i int, truth boolean, a double, b double, c double, d double, e double")
    scored, p = models.unsupervised(df, list("abcde"))
    wrong = scored.where("truth <> (confidence >= 0.5)").count()
    assert wrong < 40 and abs(p["prior"] - 0.2) < 0.03 and p["match"]["a"] > 0.85 > 0.15 > p["rest"]["a"]
    assert models.unsupervised(df.limit(0), ["a"])[0].count() == 0


def test_reports_and_phonetics(spark, tmp_path):
    from linkforge.functions import text
    from linkforge.sources import interchange

    for m, f1 in (("nb", 0.5), ("lr", 0.75)):
        interchange.write_report(spark.createDataFrame([(f1,)], "f1 double"), str(tmp_path / m))
    got = interchange.read_reports(spark, {m: str(tmp_path / m) for m in ("nb", "lr")})
    assert rows(analysis.means(got, ["model"], ("f1",))) == [("lr", 0.75), ("nb", 0.5)]
    assert spark.range(1).select(text.soundex(F.lit("Müller")) == text.soundex(F.lit("mueler"))).first()[0]


def test_containment_equals_brute_force(spark):
    import random

    r = random.Random(4)
    word = lambda: "the" if r.random() < 0.4 else f"w{r.randrange(12)}"
    small = [(f"q{i}", [word() for _ in range(r.randrange(0, 4))]) for i in range(60)] + [("n", None)]
    large = [(f"t{i}", [word() for _ in range(r.randrange(0, 9))]) for i in range(60)]
    s, t = spark.createDataFrame(small, "qid string, tokens array<string>"), spark.createDataFrame(large, "tid string, tokens array<string>")
    got = sorted(tuple(x) for x in blocking.supersets(s, t).collect())
    assert got == sorted((q, u) for q, a in small if a for u, b in large if {*a} <= {*b})
    swapped = blocking.subsets(t.select(F.col("tid").alias("qid"), "tokens"), s.select(F.col("qid").alias("tid"), "tokens"))
    assert sorted(tuple(x) for x in swapped.collect()) == sorted((u, q) for q, a in small if a and len({*a}) >= 2 for u, b in large if {*a} <= {*b})
    assert {x["rank"] for x in blocking.top_k(blocking.supersets(s, t), "qid", [F.asc("tid")], 2).collect()} <= {1, 2}


def test_classes_of_equal_values(spark):
    df = spark.createDataFrame([(1, "A"), (2, "a"), (3, "b"), (4, None), (5, "a")], "id long, v string")
    assert sorted(tuple(x) for x in blocking.exact_classes(df, "id", F.col("v")).collect()) == [(1, 1), (2, 1), (3, 3), (5, 1)]


def test_links_by_equal_keys(spark):
    import datetime as dt

    shape = "label string, url array<string>, born date, died date"
    a, b = dt.date(1900, 1, 2), dt.date(1950, 5, 5)
    s = spark.createDataFrame([("Q1", "Ann", ["https://en.wikipedia.org/wiki/A", "http://a.org"], a, b), ("Q2", "Bob", None, None, None)], f"qid string, {shape}")
    t = spark.createDataFrame([("t1", "ANN", ["https://en.wikipedia.org/wiki/A"], dt.date(1900, 9, 9), b), ("t2", "x", ["http://a.org"], None, b), ("t3", None, [], None, None)], f"tid string, {shape}")
    assert rows(rules.key_linkers(s, t)) == [("Q1", "t1", "label"), ("Q1", "t1", "link"), ("Q1", "t1", "name and dates"), ("Q1", "t1", "wikilink"), ("Q1", "t2", "link")]


def test_digests(spark, tmp_path):
    """Blank and null texts, keys of nulls alone, repeated values: as the SQL has them."""
    from compare import check

    from linkforge import catalog_queries as q

    texts = [("a", " B "), ("a", "b"), ("a", ""), ("a", "  "), ("a", None), ("a", "Ä"), ("n", None), (None, "z"), *[("c", f"x{i % 40}") for i in range(300)]]
    spark.createDataFrame(texts, "source string, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    check(spark, q.QUERIES["normalize_values"], q.SQL["normalize_values"], str(tmp_path))
    assert {(r["source"], r["n"]) for r in q.QUERIES["normalize_values"](spark, str(tmp_path)).collect()} == {("a", 3), ("n", 0), (None, 1), ("c", 40)}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pairs_stay_in_their_task(people):
    """With a small target only tokens are shuffled, once; the other way gives the same."""
    s, t = people
    few, many = (blocking.shared_counts(s, t, "qid", "tid", few=n) for n in (10, 0))
    assert rows(few) == rows(many) == [("Q1", "t1", 2, 2, 3), ("Q1", "t3", 1, 2, 1), ("Q2", "t2", 2, 3, 2)]
    assert _plan(blocking.candidates(s, t)).count("Exchange hashpartitioning") == 1


def test_contained_makes_tokens_once(people):
    s, t = people
    made = t.withColumn("tokens", F.transform("tokens", lambda x: F.reverse(F.reverse(x))))
    got = blocking.supersets(s, made)
    assert "reverse" not in _plan(got)
    assert rows(got) == [("Q1", "t1")]


def test_cross_validation_makes_features_once(spark):
    before = spark.range(40).select(F.col("id").alias("k"), (F.col("id") % 2).cast("int").alias("label"), F.reverse(F.col("id").cast("string")).cast("double").alias("f"))
    seen, made = [], evaluate.folds
    evaluate.folds = lambda rows, *a, **b: (seen.append(_plan(rows)), made(rows, *a, **b))[1]
    try:
        assert evaluate.cross_validate("nb", before, ["f"], ["k"], 2).count() == 40
    finally:
        evaluate.folds = made
    assert "reverse" not in seen[0]


def test_quality_features_move_no_text(spark, small):
    from linkforge import catalog_queries as q

    plan = q._vectors(spark, small)._jdf.queryExecution().optimizedPlan().toString()
    at = plan.index("Join")
    assert "length(text" in plan[at:] and "text" not in plan[:at]
