import datetime as dt

import pytest
from pyspark.sql import functions as F

from linkforge.functions import dates, text, urls
from linkforge.operators import features as f


def one(spark, column, **values):
    row = spark.range(1).select(*[_lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


def _lit(v):
    if isinstance(v, list):
        return F.array(*map(_lit, v)) if v else F.array().cast("array<string>")
    return F.lit(v)


@pytest.mark.parametrize(
    ("given", "want"),
    [(" Ana Müller ", "ana mueller"), ("Иван Жуков", "ivan zhukov"), ("Straße ÆØ", "strasse aeoe"), ("объект", "obekt"), (" x ", "x"), ("東京", "東京"), ("", ""), ("Żółć Þór", "zolc thor")],
)
def test_normalize(spark, given, want):
    assert one(spark, text.normalize(F.col("a")), a=given) == want


def test_tokenize(spark):
    assert one(spark, text.tokenize(F.col("a")), a="Schöß, A. vital_2 — Ö! the") == ["oe", "schoess", "vital_2"]
    assert one(spark, text.tokenize(F.col("a")), a="") == []
    assert one(spark, text.tokenize(F.lit(None).cast("string"))) is None
    assert one(spark, text.tokenize_values(F.col("a")), a=["a", None]) is None
    assert one(spark, text.normalize_values(F.col("a")), a=["B", "b ", "", None, "A"]) == ["a", "b"]


def test_split_single(spark):
    assert one(spark, text.split_single(F.col("a")), a=["Q2 Q1"]) == ["Q1", "Q2"]
    assert one(spark, text.split_single(F.col("a")), a=["Q2", "Q1", "Q1"]) == ["Q1", "Q2"]
    assert one(spark, text.split_single(F.lit(None).cast("array<string>"))) == []


def test_url_tokens(spark):
    u = "https://www.example.com/a/Foo_Bar%20baz?x=1&yy=22#frag"
    assert set(one(spark, urls.tokenize(F.col("a")), a=u)) == {"example", "Foo_Bar", "baz", "x", "1", "yy", "22"}
    assert one(spark, urls.tokenize(F.col("a"), domain_only=True), a=u) == ["example"]
    assert set(one(spark, urls.tokenize(F.col("a")), a="http://x.org/a+b%2Bc/%zz9")) >= {"x"}


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("https://example.com", "https://example.com"), ("example.com/x", "https://example.com/x"), ("http://192.168.0.1:8080/a", "http://192.168.0.1:8080/a"), ("localhost", "https://localhost"), ("ftp://u:p@example.org", "ftp://u:p@example.org"),
        ("http://[::1]/", "http://[::1]/"), ("no url", None), ("http://-bad.com", None), ("http://a.b-", None), ("HTTP://EXAMPLE.COM", "HTTP://EXAMPLE.COM"), ("münchen.de", "https://münchen.de"), ("", None), ("x.com\n", None),
        ("a.123", None), ("xn--mnchen-3ya.xn--p1ai", "https://xn--mnchen-3ya.xn--p1ai"), ("http://256.1.1.1/", None), ("a_b.com", None), ("http://x.com:1/", None), ("x.com.", "https://x.com."), ("http://x.com/a b", None),
    ],
)
def test_validate_url(spark, given, want):
    assert one(spark, urls.validate(F.col("a")), a=given) == want


def test_frequent_tokens(spark):
    df = spark.createDataFrame([(["a", "x%d" % i],) for i in range(60)] + [(["b", "a"],)] * 40, "url_tokens array<string>")
    assert urls.frequent_tokens(df, share=0.3) == ["a", "b"]


def test_knowledge_base_is_configured(spark, tmp_path):
    from linkforge import knowledge_base
    from linkforge.operators import rules

    (tmp_path / "kb.json").write_text('{"mark": "things", "item_url": "https://things.example/", "property_url": "https://things.example/p/", "wiki_hosts": ["things"]}')
    kb = knowledge_base.KnowledgeBase.read(tmp_path / "kb.json")
    assert one(spark, urls.is_wiki(F.col("a"), kb), a="https://things.example/Q1") is True
    assert one(spark, rules.linked_item(F.array(F.col("a")), kb), a="https://things.example/Q17") == "Q17"
    assert one(spark, rules.linked_item(F.array(F.col("a"))), a="https://things.example/Q17") is None
    assert knowledge_base.configured().mark == "itembase"


def test_clean_and_wiki(spark):
    assert one(spark, urls.clean(F.col("a")), a=" http://a.org  http://b.org ") == ["http://a.org", "http://b.org"]
    assert one(spark, urls.living(F.col("a")), a="http://a.org nothing b.org") == ["http://a.org", "https://b.org"]
    assert one(spark, urls.is_wiki(F.col("a")), a="https://en.wikipedia.org/x") is True
    assert one(spark, urls.is_wiki(F.col("a")), a="https://example.org/wikipedia") is False


@pytest.mark.parametrize(
    ("site", "title", "want"),
    [("enwiki", "Foo Bar", "https://en.wikipedia.org/wiki/Foo_Bar"), ("commonswiki", "X", "https://commons.wikimedia.org/wiki/X"), ("zh_yuewiki", "X", "https://zh-yue.wikipedia.org/wiki/X"), ("frwikisource", "X", "https://fr.wikisource.org/wiki/X")],
)
def test_sitelink(spark, site, title, want):
    assert one(spark, urls.sitelink(F.col("s"), F.col("t")), s=site, t=title) == want


def test_external_ids(spark):
    meta = spark.createDataFrame(
        [(1, "P1", "https://a.org/x/$1/end", r"\d+", None), (2, "P2", "https://a.org/$1", None, None), (3, "P3", "https://c.org/$1", None, r"http://b\.org/(\w+)"), (4, "P4", "https://d.org/$1", "Q", None), (5, "P5", "https://d.org/$1", None, None)],
        "ord int, pid string, formatter_url string, id_regex string, url_regex string",
    )
    rows = spark.createDataFrame([("http://a.org/x/12/end/",), ("https://a.org/zz/",), ("http://b.org/me/more",), ("https://d.org/no",), ("https://e.org",), (None,), ("https://a.org/x/ab/end",)], "url string")
    got = {r["url"]: (r["ext_id"], r["pid"]) for r in urls.external_ids(rows, meta).collect()}
    assert got == {"http://a.org/x/12/end/": ("12", "P1"), "https://a.org/zz/": ("zz", "P2"), "http://b.org/me/more": ("me", "P3"), "https://d.org/no": (None, None), "https://e.org": (None, None), None: (None, None), "https://a.org/x/ab/end": (None, None)}


@pytest.mark.parametrize(
    ("value", "precision", "want"),
    [("1990-11-06T00:00:00Z", 11, [1990, 11, 6]), ("1990-11-06T00:00:00Z", 10, [1990, 11]), ("1743-00-00T00:00:00Z", 9, [1743]), ("1743-00-00T00:00:00Z", 11, None), ("1990-11-06T07:08:09Z", 14, [1990, 11, 6, 7, 8, 9]), ("1990-11-06T25:00:00Z", 12, None), ("x", 9, None), ("1950-02-31T00:00:00Z", 11, None), ("1950-01-01T00:00:00Z", 7, [1950])],
)
def test_parse_date(spark, value, precision, want):
    assert one(spark, dates.parse(F.col("v"), F.col("p")), v=value, p=precision) == want


@pytest.mark.parametrize(
    ("y", "m", "d", "want"),
    [(1990, None, None, ("1990-01-01", 9)), (1990, 5, None, ("1990-05-01", 10)), (1990, 5, 6, ("1990-05-06", 11)), (None, 5, 6, (None, None)), (-10, 1, 1, (None, None)), (1990, None, 6, ("1990-01-06", 9)), (1990, 2, 31, (None, None))],
)
def test_from_parts(spark, y, m, d, want):
    c = lambda v: F.lit(v).cast("int")
    date, p = dates.from_parts(c(y), c(m), c(d))
    r = spark.range(1).select(date.cast("string").alias("d"), p.alias("p")).first()
    assert (r["d"], r["p"]) == want


def test_dates_compared(spark):
    day = lambda y, m, d: F.lit(dt.date(y, m, d))
    same = lambda p: one(spark, dates.same_to_shared_precision(day(1950, 3, 4), F.lit(11), day(1950, 1, 1), F.lit(p)))
    assert (same(9), same(11), same(8)) == (True, False, False)
    assert one(spark, dates.match_values(F.lit("1950-03-04/11"), F.lit("1950-01-01/9"))) == "shared"
    assert one(spark, dates.match_values(F.lit("1950-03-04/11"), F.lit("1951-01-01/9"))) == "extra"
    assert one(spark, dates.match_values(F.lit("1950-03-04/11"), F.lit("1950-01-01/7"))) is None
    assert one(spark, dates.bio_value(day(1950, 1, 1), F.lit(None).cast("int"))) == "1950-01-01/9"


def test_features(spark):
    a, b = F.col("a"), F.col("b")
    go = lambda c, x, y: round(one(spark, c, a=x, b=y), 6)
    assert go(f.exact_match(a, b), ["a", "b"], ["b", "c"]) == 1.0
    assert go(f.exact_match(a, b), [], ["b"]) == 0.0
    assert go(f.levenshtein(a, b), ["abc"], ["abx", "q"]) == 0.666667
    assert go(f.levenshtein(a, b, threshold=0.5), ["abc"], ["abx"]) == 1.0
    assert go(f.token_cosine(a, b), list("abcd"), list("abcefghij")) == 0.5
    assert go(f.shared_tokens(a, b), ["a", "b"], ["b c"]) == 0.333333
    assert go(f.shared_tokens(a, b), ["band", "x"], ["band x"]) == 0.55
    assert go(f.shared_tokens(a, b, ()), ["band", "x"], ["band x"]) == 1.0
    assert go(f.shared_tokens_plus(a, b), ["A", "b"], ["a", "c d"]) == 0.5
    assert go(f.shared_tokens_plus(a, b, ["a"]), ["A"], ["a"]) == 0.0
    assert go(f.string_kernel(a, b), ["anna", "ann"], ["anne"]) == 0.69282
    assert go(f.shared_occupations(a, b), ["q1"], ["q1", "q2", "q3"]) == 1.0
    assert go(f.similar_strings(a, b, "cosine", "word"), ["a bb"], ["bb cc"]) == 0.707107
    assert go(f.similar_strings(a, b, "cosine", "char"), ["ab"], ["ab"]) == 1.0
    day, other, year = [[1950, 3, 4]], [[1950, 3, 5]], [[1950]]
    assert (go(f.similar_dates(a, b), day, other), go(f.similar_dates(a, b), day, year)) == (0.666667, 1.0)
    with pytest.raises(ValueError, match="algorithm"):
        f.similar_strings(a, b, "nothing")
