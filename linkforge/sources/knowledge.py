"""The knowledge base: items as JSON Lines, raw entity documents, claims, property metadata, the class hierarchy.

Live query and edit services are replaced by snapshots: a claims table (qid, pid, value, precision, kind) holds what
queries by class, occupation and identifier asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkforge.functions import urls
from linkforge.operators.closure import closure
from linkforge.schema import BIO_PIDS, INSTANCE_OF, ITEM, LINKER_FIELDS, OCCUPATION, OCCUPATION_QUERY, ENTITY_QUERY, CLASS_QID, Target

TEXTS = "map<string,struct<value:string>>"
ENTITY = (
    f"id string, labels {TEXTS}, descriptions {TEXTS}, aliases map<string,array<struct<value:string>>>, sitelinks map<string,struct<title:string>>, "
    "claims map<string,array<struct<id:string,rank:string,mainsnak:struct<snaktype:string,datavalue:struct<type:string,value:string>>>>>"
)


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Prepared items, one JSON object a line; absent fields are null."""
    return spark.read.schema(ITEM).json(path)


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    """Raw entities, one JSON object a line; values of claims stay JSON text, as their form depends on their kind."""
    return spark.read.schema(ENTITY).json(path)


def texts(values: Column) -> Column:
    """The distinct texts of a language map."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.map_values(values), lambda v: v.value), lambda x: F.coalesce(x, F.lit("")) != "")))


def aliases(values: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.flatten(F.map_values(values)), lambda v: v.value), lambda x: F.coalesce(x, F.lit("")) != "")))


def sitelinks(values: Column) -> Column:
    return F.filter(F.transform(F.map_entries(values), lambda e: urls.sitelink(e.key, e.value.title)), lambda x: x.isNotNull())


def claims(entities: DataFrame) -> DataFrame:
    """qid, guid, pid, kind, value, precision: claims with a value. Times BC are dropped, the + before others too; of
    monolingual texts the text, of items the id."""
    rows = entities.select(F.col("id").alias("qid"), F.explode_outer("claims").alias("pid", "list")).select("qid", "pid", F.explode("list").alias("c"))
    rows = rows.where("c.mainsnak.snaktype = 'value' and c.mainsnak.datavalue.value is not null")
    raw, kind = F.col("c.mainsnak.datavalue.value"), F.col("c.mainsnak.datavalue.type")
    at = lambda k: F.get_json_object(raw, f"$.{k}")
    time = F.when(~F.startswith(at("time"), F.lit("-")), F.ltrim(at("time"), F.lit("+")))
    value = F.when(kind == "time", time).when(kind == "wikibase-entityid", at("id")).when(kind == "monolingualtext", at("text")).when(kind == "string", raw)
    return rows.select("qid", F.col("c.id").alias("guid"), "pid", kind.alias("kind"), value.alias("value"), F.when(kind == "time", at("precision").cast("int")).alias("precision")).where("value is not null")


def labels_of(claim_rows: DataFrame, entities: DataFrame) -> DataFrame:
    """Claims whose value is an item, with that item's labels: qid, pid, labels."""
    names = entities.select(F.col("id").alias("value"), texts(F.col("labels")).alias("labels"))
    return claim_rows.where("kind = 'wikibase-entityid'").join(names, "value").select("qid", "pid", "labels")


def third_party_urls(claim_rows: DataFrame, url_pids: list[str]) -> DataFrame:
    return claim_rows.where(F.col("pid").isin(*url_pids)).select("qid", F.col("value").alias("url"))


def identifier_urls(claim_rows: DataFrame, metadata: DataFrame) -> DataFrame:
    """Identifier claims as URLs, by every formatter of their property."""
    forms = metadata.where("formatter_url is not null").select("pid", "formatter_url").distinct()
    return claim_rows.where("kind = 'string'").join(forms, "pid").select("qid", F.replace("formatter_url", F.lit("$1"), F.col("value")).alias("url"))


def linker_items(entities: DataFrame, metadata: DataFrame, url_pids: list[str], t: Target, ids: DataFrame | None = None) -> DataFrame:
    """Entities in the form of ITEM, restricted to the qids of ids if given. Those without claims or labels are dropped."""
    if ids is not None:
        wanted = ids.select("qid").distinct()
        own = entities.join(wanted.withColumnRenamed("qid", "id"), "id", "left_semi")
    else:
        own = entities
    own = own.where("size(coalesce(claims, map())) > 0 and size(coalesce(labels, map())) > 0")
    c = claims(own)
    needed = {pid: f for pid, f in LINKER_FIELDS.items() if (f != "occupations" or t.needs_occupations) and (f != "genres" or t.is_work) and (pid != "P577" or t.is_work)}
    fields = F.create_map(*[F.lit(x) for kv in needed.items() for x in kv])
    rows = c.where(F.col("pid").isin(*needed)).withColumn("field", F.try_element_at(fields, F.col("pid")))
    date = rows.where("kind = 'time'").groupBy("qid").pivot("field", ["born", "died"]).agg(F.array_sort(F.collect_set(F.array("value", F.col("precision").cast("string")))))
    plain = rows.where("kind <> 'time' and (kind <> 'wikibase-entityid' or field = 'occupations')").select("qid", "field", "value")
    named = labels_of(rows.where("field <> 'occupations'"), entities).select("qid", "pid", F.explode("labels").alias("value")).select("qid", F.try_element_at(fields, F.col("pid")).alias("field"), "value")
    others = sorted({f for f in needed.values()} - {"born", "died"})
    wide = plain.unionByName(named).groupBy("qid").pivot("field", others).agg(F.array_sort(F.collect_set("value")))
    links = third_party_urls(c, url_pids).unionByName(identifier_urls(c, metadata)).unionByName(own.select(F.col("id").alias("qid"), F.explode(sitelinks(F.col("sitelinks"))).alias("url")))
    url = links.groupBy("qid").agg(F.array_sort(F.collect_set("url")).alias("url"))
    names = F.array_sort(F.array_union(texts(F.col("labels")), F.coalesce(aliases(F.col("aliases")), F.array().cast("array<string>"))))
    out = own.select(F.col("id").alias("qid"), names.alias("name"), texts(F.col("descriptions")).alias("description")).join(url, "qid", "left").join(date, "qid", "left").join(wide, "qid", "left")
    if ids is not None and "tid" in ids.columns:
        out = out.join(ids.groupBy("qid").agg(F.array_sort(F.collect_set("tid")).alias("tid")), "qid", "left")
    return out.select(*[F.when(F.size(f.name) > 0, F.col(f.name)).alias(f.name) if f.name in out.columns and f.name != "qid" else F.col("qid") if f.name == "qid" else F.lit(None).cast(f.dataType).alias(f.name) for f in ITEM.fields])


def of_class(claim_rows: DataFrame, edges: DataFrame, entity: str) -> DataFrame:
    """qids of the entity's class or occupation, subclasses included."""
    classes = closure(edges, "up", F.lit(CLASS_QID[entity])).select(F.col("node").alias("value"))
    pid = OCCUPATION if ENTITY_QUERY[entity] == OCCUPATION_QUERY else INSTANCE_OF
    return claim_rows.where(F.col("pid") == pid).join(classes, "value", "left_semi").select("qid").distinct()


def with_identifier(claim_rows: DataFrame, edges: DataFrame, t: Target) -> DataFrame:
    """qid, tid: items of the class that have the catalogue's identifier."""
    ids = claim_rows.where(F.col("pid") == t.pid).select("qid", F.col("value").alias("tid")).distinct()
    return ids.join(of_class(claim_rows, edges, t.entity), "qid", "left_semi")


def without_identifier(claim_rows: DataFrame, edges: DataFrame, t: Target) -> DataFrame:
    """qid: items of the class that lack it."""
    return of_class(claim_rows, edges, t.entity).join(claim_rows.where(F.col("pid") == t.pid).select("qid"), "qid", "left_anti")


def with_urls(claim_rows: DataFrame, edges: DataFrame, entity: str, url_pids: list[str]) -> DataFrame:
    return third_party_urls(claim_rows, url_pids).join(of_class(claim_rows, edges, entity), "qid", "left_semi").distinct()


def biodata(claim_rows: DataFrame, entities: DataFrame) -> DataFrame:
    """qid, pid, value, labels: dates as YYYY-MM-DD/precision, items with their labels."""
    bio = claim_rows.where(F.col("pid").isin(*BIO_PIDS))
    names = entities.select(F.col("id").alias("value"), texts(F.col("labels")).alias("labels"))
    value = F.when(F.col("kind") == "time", F.concat(F.substring("value", 1, 10), F.lit("/"), F.col("precision").cast("string"))).otherwise(F.col("value"))
    return bio.join(names, "value", "left").select("qid", "pid", value.alias("value"), "labels")


def aggregate_ids(ids: DataFrame) -> DataFrame:
    """qid with the sorted array of its identifiers."""
    return ids.groupBy("qid").agg(F.array_sort(F.collect_set("tid")).alias("tid"))


def property_metadata(properties: DataFrame) -> DataFrame:
    """pid, formatter_url, id_regex, url_regex with a stable order (ord) and patterns that Java can't compile dropped.

    properties: the same columns without ord; pid and formatter may come as URIs and are cut.
    """
    rows = properties.select(urls.property_id(F.col("pid")).alias("pid"), "formatter_url", "id_regex", "url_regex").where("pid <> ''").distinct()
    for c in ("id_regex", "url_regex"):
        bad = _unusable(rows, c)
        if bad:
            rows = rows.withColumn(c, F.when(~F.col(c).isin(bad), F.col(c)))
    return rows.withColumn("ord", F.row_number().over(_order())).select("ord", "pid", "formatter_url", "id_regex", "url_regex")


def _order():
    from pyspark.sql import Window

    return Window.orderBy(F.substring("pid", 2, 20).cast("long"), "formatter_url", "id_regex", "url_regex")


def _unusable(rows: DataFrame, column: str, most: int = 50_000) -> list[str]:
    """Distinct patterns that Java doesn't compile; properties are few thousands, and counted."""
    found = [r[0] for r in rows.select(column).where(F.col(column).isNotNull()).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"over {most} patterns")
    return [p for p, ok in zip(found, usable_patterns(found), strict=True) if ok is None]


def url_properties(properties: DataFrame, kinds: tuple[str, ...] = ("url",)) -> list[str]:
    """Ids of the properties whose values are URLs. properties: pid (an id or a URI) and datatype (a name or a URI)."""
    kind = F.lower(F.regexp_extract("datatype", r"([A-Za-z]+)$", 1))
    rows = properties.select(urls.property_id(F.col("pid")).alias("pid"), kind.alias("kind")).where(F.col("kind").isin(*kinds) & (F.col("pid") != ""))
    return [r[0] for r in rows.select("pid").distinct().orderBy(F.substring("pid", 2, 20).cast("long")).collect()]


def labels(entities: DataFrame, ids: DataFrame, languages: tuple[str, ...] | None = None) -> DataFrame:
    """id, language, label of the entities asked for (ids: id); languages: only these."""
    wanted = entities.join(ids.select("id").distinct(), "id", "left_semi").select("id", F.explode("labels").alias("language", "l"))
    out = wanted.select("id", "language", F.col("l.value").alias("label"))
    return out if languages is None else out.where(F.col("language").isin(*languages))


def resolve(terms: DataFrame, entities: DataFrame, language: str = "en", term: str = "term") -> DataFrame:
    """terms with qid: the first entity, by number, whose label or alias in the language is the term, whatever its case;
    null where there is none. A look-up by equality, no search by likeness."""
    from pyspark.sql import Window

    named = lambda c: F.array(F.try_element_at(c, F.lit(language)).value)
    also = F.transform(F.coalesce(F.try_element_at("aliases", F.lit(language)), F.array()), lambda x: x.value) if "aliases" in entities.columns else F.array().cast("array<string>")
    names = entities.select(F.col("id").alias("qid"), F.explode(F.concat(named(F.col("labels")), also)).alias("name")).select("qid", F.lower("name").alias("key")).where("key is not null").distinct()
    order = F.row_number().over(Window.partitionBy("key").orderBy(F.regexp_extract("qid", r"(\d+)", 1).try_cast("long"), "qid"))
    first = names.withColumn("r", order).where("r = 1").select("key", "qid")
    return terms.join(first, F.lower(terms[term]) == F.col("key"), "left").drop("key")


def usable_patterns(patterns: list[str | None]) -> list[str | None]:
    """Those that Java compiles, others null; for the few thousand patterns of properties, on the driver."""
    spark = SparkSession.getActiveSession()
    compile_ = spark.sparkContext._jvm.java.util.regex.Pattern.compile
    out = []
    for p in patterns:
        try:
            out.append(p if p is None or compile_(p) is not None else None)
        except Exception:  # noqa: BLE001  PatternSyntaxException comes wrapped
            out.append(None)
    return out
