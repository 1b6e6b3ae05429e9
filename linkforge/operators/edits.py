"""Edit plans: what would be written to the knowledge base, as rows. Nothing is sent anywhere.

A plan row: action (add, reference, delete, deprecate), subject, predicate, value, kind, guid of the claim it concerns,
and the reference node (heuristic, stated_in, tid_pid, tid, retrieved).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkforge.operators.closure import follow
from linkforge.schema import ARTIFICIAL_INTELLIGENCE, FACEBOOK_ID, MOVIE_PIDS, OFFICIAL_WEBSITE, RECORD_LINKAGE, TWITTER_USERNAME

SANDBOX = "Q4115189"
CASELESS = (FACEBOOK_ID, TWITTER_USERNAME)


def value_kind(value: Column) -> Column:
    """item, time (YYYY-MM-DD/precision) or string."""
    return F.when(value.rlike(r"^Q\d+$"), "item").when(value.rlike(r"^\d{1,4}-\d{1,2}-\d{1,2}/\d{1,2}$"), "time").otherwise("string")


def parse_value(value: Column) -> Column:
    kind = value_kind(value)
    parts = lambda i: F.regexp_extract(value, r"^(\d{1,4})-(\d{1,2})-(\d{1,2})/(\d{1,2})$", i).try_cast("int")
    return F.struct(kind.alias("kind"), value.alias("text"), *[F.when(kind == "time", parts(i)).alias(n) for i, n in enumerate(("year", "month", "day", "precision"), 1)])


def _reference(df: DataFrame, heuristic: str | None, stated_in: str | None, pid: str | None, tid: str = "tid") -> DataFrame:
    return df.withColumn("reference", F.struct(F.lit(heuristic).alias("heuristic"), F.lit(stated_in).alias("stated_in"), F.lit(pid).alias("tid_pid"), F.when(F.lit(pid).isNotNull(), F.col(tid)).alias("tid"), F.current_date().alias("retrieved")))


def plan_additions(statements: DataFrame, claims: DataFrame, redirects: DataFrame | None = None, movie_works: bool = False, sandbox: bool = False) -> DataFrame:
    """statements (subject, predicate, value, tid) against claims (qid, guid, pid, value).

    add: no claim of the property, or none with the value. reference: every claim with it (of identifiers of social
    media, compared without case, the first). A URL that equals the official website references that claim alone; of
    works of the film catalogue a claim of any crew property with the same person is referenced.
    """
    rows = statements.select("subject", "predicate", "value", "tid").distinct()
    if redirects is not None:
        rows = follow(rows, redirects, "subject")
    fold = lambda pid, v: F.when(pid.isin(*CASELESS), F.lower(v)).otherwise(v)
    # what a claim is found by: 1 the website, 2 a crew member, 3 property and value
    by = lambda subject, hit, pid, v: F.struct(F.col(subject).alias("subject"), F.lit(hit).alias("hit"), pid.alias("of"), v.alias("v"))
    none = F.lit("")
    p, v, cp, cv = F.col("predicate"), F.col("value"), F.col("pid"), F.col("value")
    bare = lambda x: F.rtrim(x, F.lit("/"))
    rows = rows.withColumn("sid", F.xxhash64("subject", "predicate", "value", "tid"))
    asked = [by("subject", 1, none, bare(v)), by("subject", 3, p, fold(p, v))] + ([by("subject", 2, none, v)] if movie_works else [])
    held = [F.when(cp == OFFICIAL_WEBSITE, by("qid", 1, none, bare(cv))), by("qid", 3, cp, fold(cp, cv))] + ([F.when(cp.isin(*MOVIE_PIDS), by("qid", 2, none, cv))] if movie_works else [])
    s = rows.select("sid", "predicate", "value", "tid", F.explode(F.array(*asked)).alias("by"))
    c = claims.where("value is not null").select(F.col("pid").alias("c_pid"), F.col("value").alias("c_value"), "guid", F.explode(F.array_compact(F.array(*held))).alias("by"))
    judged = s.select("sid", "predicate", "value", "tid", "by.*").join(c.select("c_pid", "c_value", "guid", "by.*"), ["subject", "hit", "of", "v"])
    best = judged.groupBy("sid").agg(F.min("hit").alias("best"))
    firsts = judged.groupBy("sid", "hit").agg(F.min("guid").alias("first_guid"))
    picked = judged.join(best, "sid").where("hit = best").join(firsts, ["sid", "hit"]).where((~p.isin(*CASELESS)) | (F.col("guid") == F.col("first_guid")))
    references = picked.select(F.lit("reference").alias("action"), "subject", F.when(F.col("hit") == 3, p).otherwise(F.col("c_pid")).alias("predicate"), F.col("c_value").alias("value"), "guid", "tid")
    adds = rows.join(best, "sid", "left_anti").select(F.lit("add").alias("action"), "subject", "predicate", "value", F.lit(None).cast("string").alias("guid"), "tid")
    out = adds.unionByName(references).distinct()
    out = out.withColumn("kind", value_kind(F.col("value")))
    return out.withColumn("subject", F.lit(SANDBOX)) if sandbox else out


def add_identifiers(links: DataFrame, claims: DataFrame, pid: str, catalog_qid: str, **options) -> DataFrame:
    """links (qid, tid), all pairs of a qid."""
    rows = links.select(F.col("qid").alias("subject"), F.lit(pid).alias("predicate"), F.col("tid").alias("value"), "tid")
    return _reference(plan_additions(rows, claims, **options), ARTIFICIAL_INTELLIGENCE, catalog_qid, pid)


def add_people_statements(statements: DataFrame, claims: DataFrame, pid: str, catalog_qid: str, criterion: str | None = None, **options) -> DataFrame:
    if criterion not in (None, "links", "bio"):
        raise ValueError(f"no such criterion: {criterion}")
    return _reference(plan_additions(statements, claims, **options), RECORD_LINKAGE if criterion else None, catalog_qid, pid)


def add_works_statements(statements: DataFrame, claims: DataFrame, pid: str, catalog_qid: str, film: bool = False, **options) -> DataFrame:
    return _reference(plan_additions(statements, claims, movie_works=film, **options), RECORD_LINKAGE, catalog_qid, pid)


def retire(action: str, invalid: DataFrame, claims: DataFrame, pid: str, sandbox: bool = False) -> DataFrame:
    """action: delete or deprecate. invalid (tid, qid): the item's claims of the identifier."""
    if action not in ("delete", "deprecate"):
        raise ValueError(f"no such action: {action}")
    c = claims.where(F.col("pid") == pid).select("qid", F.col("value").alias("tid"), "guid")
    rows = invalid.select("qid", "tid").distinct().join(c, ["qid", "tid"])
    return rows.select(F.lit(action).alias("action"), F.lit(SANDBOX).alias("subject") if sandbox else F.col("qid").alias("subject"), F.lit(pid).alias("predicate"), F.col("tid").alias("value"), F.lit("string").alias("kind"), "guid", "tid")


def missing_items(statements: DataFrame, entities: DataFrame) -> DataFrame:
    """Statements whose subject isn't an item that exists."""
    return statements.join(entities.select(F.col("id").alias("subject")), "subject", "left_anti")
