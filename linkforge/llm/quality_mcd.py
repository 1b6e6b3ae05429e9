"""Operator 1: quality rules and robust outliers by minimum covariance determinant.

Base rules: see `statistics`. Then each document has a vector of transformed statistics, in whole 1/256ths: the logs of
mean word length, of the share of marks (characters that are neither letters, digits nor space) among word characters
and of the share of words of three characters or fewer, each drawn a little to a prior so that short texts don't stand
out by chance. For each (language, source) group centre and covariance are estimated by the minimum covariance
determinant: from several starts (quartiles; all rows; rows within a box about the medians) concentration steps take
the `share` of rows nearest by Mahalanobis distance and estimate anew; after two the start with the smallest determinant
goes on until it doesn't change.
Distances are made consistent by their median, the rows within the 97.5 % quantile of the chi-square distribution give
the reweighted estimate, and rows whose distance that distribution exceeds with a chance of `tail` only are rejected.
Covariances are only kept from being singular: by the variance of rounding to 1/256ths.

Vectors are whole numbers, so sums are exact and results don't depend on partitioning. "Nearest" is by distance in
steps of 1/128 of its log: rows are summed by group, start and step on the map side, and only these sums, whose number
doesn't grow with the rows, are shuffled; so groups are never gathered, however large.

Groups under `least` rows (5 for each part of the vector) are pooled by language, pools under `least` over all
languages; a last pool under `least` has no estimate and rejects nothing. Null lang or source is a group value of its
own. Null text counts as empty: no words, base_failed. Texts of any length are counted whole, as one row. Texts that
fail the base rules aren't part of the estimates. Ties: rows in one step are taken together. Repeated rows count each.
Empty tables give empty ones. Extra columns are ignored, and kept by the stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkforge.llm.common import Scratch, keep, pick, small
from linkforge.llm.native import let, words

X = ("x0", "x1", "x2")
D = len(X)
UNIT = 256.0
STEPS = 128.0
#: Of the chi-square distribution with D degrees of freedom: median, 97.5 % quantile, and where 1e-9 are left.
CHI2_MEDIAN, CHI2_975, CHI2_TAIL = 2.36597, 9.34840, 44.8418
ROUNDING = 1 / UNIT**2
PAIRS = [(i, j) for i in range(D) for j in range(i + 1)]
#: Groups whose sums one task holds when tables of a row or a few per group are written.
GROUPS = 200


def repeated_words(w: Column, k: int = 5) -> Column:
    """Words in windows of k words that stand in the text twice or more."""
    starts = lambda s: F.sort_array(F.transform(F.filter(s, lambda x, i: (x.h == F.get(s, i - 1).h) | (x.h == F.get(s, i + 1).h)), lambda x: x.p))
    covered = lambda p: F.aggregate(F.transform(p, lambda a, i: F.least(F.lit(k), F.coalesce(F.get(p, i + 1) - a, F.lit(k)))), F.lit(0).cast("long"), lambda a, x: a + x)
    h = F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))
    twice = lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), let(let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))), lambda s: F.coalesce(starts(s), F.array().cast("array<int>"))), covered)).otherwise(F.lit(0).cast("long"))
    return F.when(F.size(w) > k, let(h, twice)).otherwise(F.lit(0).cast("long"))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the base columns and the vector. docs: doc_id, text, lang, source and more."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    dup_lines = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    word_counts = let(words(text), lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("rep"), F.size(F.filter(w, lambda x: F.length(x) <= 3)).alias("short")))
    base = docs.select(
        "doc_id", "lang", "source", word_counts.alias("w"), dup_lines.cast("long").alias("n_dup_lines"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(text, r"[\p{L}\p{N}\x20\x09-\x0D]+", "")).alias("marks"),
    ).select(
        "doc_id", "lang", "source", F.col("w.n").cast("long").alias("n_words"), "word_chars", "n_symbols",
        "n_dup_lines", F.col("w.rep").alias("n_repeat_words"), F.col("w.short").alias("short"), "marks",
    )
    # priors of 60 words of 5.2 characters, of which 3.5 % are marks, and 30 % short words
    n, chars = F.col("n_words") + 60.0, F.col("word_chars") + 312.0
    vector = [F.log(chars / n), F.log((F.col("marks") + 10.92) / chars), F.log((F.col("short") + 18.0) / n)]
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return base.select("*", failed.alias("base_failed"), *[F.round(v * UNIT).cast("long").alias(x) for v, x in zip(vector, X, strict=True)])


def _distance(p: Column) -> Column:
    """Squared Mahalanobis distance by forward substitution with the Cholesky factor in p."""
    z: list[Column] = []
    total = F.lit(0.0)
    for i in range(D):
        v = F.col(X[i]) / UNIT - p[f"m{i}"]
        for j in range(i):
            v = v - p[f"l{i}{j}"] * z[j]
        z.append(v / p[f"l{i}{i}"])
        total = total + z[-1] * z[-1]
    return total


def _step(distance: Column) -> Column:
    return F.floor(F.log1p(distance) * STEPS).cast("long")


def _factor(df: DataFrame, *by: str) -> DataFrame:
    """df: centre m0.. and covariance s00.. -> by, det (log of the determinant) and p: centre and Cholesky factor."""
    for i, j in PAIRS:
        v = F.col(f"s{i}{j}") + (ROUNDING if i == j else 0.0)
        for k in range(j):
            v = v - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        df = df.withColumn(f"l{i}{j}", F.sqrt(F.greatest(v, F.lit(ROUNDING / 16))) if i == j else v / F.col(f"l{j}{j}"))
    det = sum((F.log(F.col(f"l{i}{i}")) for i in range(1, D)), F.log("l00")) * 2.0
    return df.select(*by, det.alias("det"), F.struct(*[f"m{i}" for i in range(D)], *[f"l{i}{j}" for i, j in PAIRS]).alias("p"))


def _sums() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(f"t{i}") for i, x in enumerate(X)], *[F.sum(F.col(X[i]) * F.col(X[j])).alias(f"t{i}{j}") for i, j in PAIRS]]


def _moments(sums: DataFrame, *by: str) -> DataFrame:
    """Centre and covariance of sums n, t0.., t00..; rows of one group added up first."""
    names = ["n", *[f"t{i}" for i in range(D)], *[f"t{i}{j}" for i, j in PAIRS]]
    t = sums.groupBy(*by).agg(*[F.sum(x).cast("double").alias(x) for x in names])
    mean = [F.col(f"t{i}") / F.col("n") / UNIT for i in range(D)]
    return t.select(*by, *[m.alias(f"m{i}") for i, m in enumerate(mean)], *[(F.col(f"t{i}{j}") / F.col("n") / UNIT**2 - mean[i] * mean[j]).alias(f"s{i}{j}") for i, j in PAIRS])


def _upto(counts: DataFrame, part: float, *by: str, order: str = "q") -> DataFrame:
    """Rows of counts (by, order, n and more) up to where `part` of all n of their group is reached."""
    w = Window.partitionBy(*by)
    before = F.coalesce(F.sum("n").over(w.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counts.withColumns({"before": before, "all": F.sum("n").over(w)}).where(F.col("before") < part * F.col("all")).drop("before", "all")


def _scaled(rows: DataFrame, params: DataFrame) -> DataFrame:
    """params (g, p) and scale: the median squared distance over its expected value."""
    q = rows.join(small(params), "g").groupBy("g", _step(_distance(F.col("p"))).alias("q")).agg(F.count(F.lit(1)).alias("n"))
    mid = _upto(q, 0.5, "g").groupBy("g").agg(F.max("q").alias("q"))
    return params.join(mid, "g").select("g", "p", (F.expm1((F.col("q") + 0.5) / STEPS) / CHI2_MEDIAN).alias("scale"))


def estimate(rows: DataFrame, share: float = 0.75, most: int = 30, both: int = 2) -> DataFrame:
    """Rows (g, x0..): per g the struct p of centre and factor (reweighted), and scale. most: concentration steps, of which
    all starts take the first `both`, and the one with the smallest determinant the rest."""
    with Scratch(rows.sparkSession) as t:
        values = rows.select("g", F.posexplode(F.array(*X)).alias("i", "q")).groupBy("g", "i", "q").agg(F.count(F.lit(1)).alias("n"))
        values = t.store(values)
        quart = None
        for name, part in (("a", 0.25), ("b", 0.5), ("c", 0.75)):
            got = _upto(values, part, "g", "i").groupBy("g", "i").agg(F.max("q").alias(name))
            quart = got if quart is None else quart.join(got, ["g", "i"])
        wide = quart.select("g", "i", (F.col("b") / UNIT).alias("m"), ((F.col("c") - F.col("a")) / (1.349 * UNIT)).alias("s")).groupBy("g").agg(
            *[F.max(F.when(F.col("i") == i, F.col("m"))).alias(f"m{i}") for i in range(D)], *[F.max(F.when(F.col("i") == i, F.col("s"))).alias(f"d{i}") for i in range(D)]
        )
        wide = t.store(wide)
        # tables by group are short: as many tasks as their number asks for, not a task and a file for each shuffle partition
        parts = max(1, -(-wide.count() // GROUPS))
        short = lambda df: t.store(df.coalesce(parts))
        diagonal = wide.select("g", *[f"m{i}" for i in range(D)], *[(F.col(f"d{i}") * F.col(f"d{i}") if i == j else F.lit(0.0)).alias(f"s{i}{j}") for i, j in PAIRS])
        inside = F.lit(True)
        for i in range(D):
            inside = inside & (F.abs(F.col(X[i]) / UNIT - F.col(f"m{i}")) <= 1.5 * F.col(f"d{i}") + 1 / UNIT)
        boxed = rows.join(small(wide), "g").groupBy("g", inside.alias("box")).agg(*_sums())
        boxed = short(boxed)
        starts = [diagonal, _moments(boxed, "g"), _moments(boxed.where("box"), "g")]
        params = None
        for k, df in enumerate(starts):
            one = _factor(df, "g").withColumn("start", F.lit(k))
            params = one if params is None else params.unionByName(one)
        params = short(params)
        for k in range(most):
            # as many as starts, then one
            tried = small(short(params.groupBy("g").agg(F.collect_list(F.struct("start", "p")).alias("tries"))) if k < both else params.select("g", F.array(F.struct("start", "p")).alias("tries")))
            q = rows.join(tried, "g").select("g", *X, F.explode("tries").alias("y")).groupBy("g", F.col("y.start").alias("start"), _step(_distance(F.col("y.p"))).alias("q")).agg(*_sums())
            last, params = params, short(_factor(_moments(_upto(q, share, "g", "start"), "g", "start"), "g", "start"))
            if k + 1 == both:
                params = short(params.groupBy("g").agg(F.min_by(F.struct("start", "det", "p"), F.struct("det", "start")).alias("b")).select("g", "b.*"))
            elif k + 1 > both:
                moved = params.select("g", "det").unionByName(last.select("g", "det")).groupBy("g").agg((F.max("det") - F.min("det")).alias("by")).where("by > 1e-9")
                if moved.coalesce(parts).isEmpty():
                    break
        best = short(params.groupBy("g").agg(F.min_by("p", F.struct("det", "start")).alias("p")))
        raw = short(_scaled(rows, best))
        near = rows.join(small(raw), "g").where(_distance(F.col("p")) <= CHI2_975 * F.col("scale")).groupBy("g").agg(*_sums())
        again = short(_factor(_moments(near, "g"), "g").select("g", "p"))
        return t.keep(_scaled(rows, again).coalesce(parts))


def judge(docs: DataFrame, share: float = 0.75, cutoff: float = CHI2_TAIL, least: int = 5 * D) -> DataFrame:
    """The base columns, distance (null without an estimate), base_failed and kept. cutoff: a chi-square quantile."""
    with Scratch(docs.sparkSession) as t:
        stats = keep(statistics(docs))
        name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("null"))
        good = stats.where(~F.col("base_failed")).select(name("lang").alias("a"), name("source").alias("b"), *X)
        n = t.store(good.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")))
        pools = n.where(F.col("n") < least).groupBy("a").agg(F.sum("n").alias("pool"))
        groups = n.join(pools, "a", "left").select("a", "b", "n", F.when(F.col("n") >= least, F.concat_ws("|", "a", "b")).when(F.col("pool") >= least, F.col("a")).otherwise(F.lit("*")).alias("g"))
        groups = t.store(groups)
        enough = groups.groupBy("g").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("g")
        groups = t.store(groups.join(enough, "g").select("a", "b", "g"))
        rows = t.store(good.join(small(groups), ["a", "b"]).select("g", *X))
        params = keep(groups.join(estimate(rows, share), "g").select("a", "b", "p", "scale"))
    out = stats.withColumns({"a": name("lang"), "b": name("source")}).join(small(params), ["a", "b"], "left")
    far = F.when(~F.col("base_failed"), _distance(F.col("p")) / F.col("scale"))
    return out.withColumn("distance", far).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))).alias("kept"), F.round("distance", 4).alias("distance"),
    )


def op1_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are kept. A doc_id whose rows differ in verdict keeps none of them."""
    bad = keep(judge(docs).where(~F.col("kept")).select("doc_id").distinct())
    out = pick(docs, bad, "left_anti")
    # a null doc_id joins with nothing
    return out if bad.where("doc_id is null").isEmpty() else out.where("doc_id is not null")


def quality_base_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of operator 1 SQL can say: the statistics and base rules."""
    got = statistics(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


QUERIES = {"op1_quality_mcd": op1_quality_mcd, "quality_base_rules": quality_base_rules}
SQL = {
    "quality_base_rules": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM d WHERE len(w) > 4),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, list_slice(w, i, i + 4)) AS n FROM g),
r AS (SELECT doc_id, count(DISTINCT p) AS rep FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM h WHERE n > 1) GROUP BY doc_id),
s AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep, 0) AS BIGINT) AS n_repeat_words
      FROM d LEFT JOIN r ON r.doc_id = d.doc_id)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM s"""
}
