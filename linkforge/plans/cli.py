"""Command line: python -m linkforge.plans.cli JOB ... Tables are folders of Parquet; see README."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkforge.operators import edits, enrich, rules, validate
from linkforge.operators.curation import sync_matches
from linkforge.operators.models import Model, options
from linkforge.plans import linking
from linkforge.schema import Target, catalogs, entities, target
from linkforge.session import session
from linkforge.sources import interchange, knowledge, online
from linkforge.sources import discogs, imdb, musicbrainz  # noqa: F401  they register their readers
from linkforge.sources.base import READERS

log = logging.getLogger(__name__)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="linkforge")
    p.add_argument("--log-level", default="WARNING")
    jobs = p.add_subparsers(dest="job", required=True)

    def job(name: str, *extra: str, entity: bool = True):
        j = jobs.add_parser(name)
        j.add_argument("catalog", choices=catalogs())
        if entity:
            j.add_argument("entity", choices=entities())
        j.add_argument("--tables", required=True, help="folder of the catalogue's tables")
        for e in extra:  # those with a question mark may be left out
            j.add_argument(f"--{e.rstrip('?')}", required=not e.endswith("?"))
        j.add_argument("params", nargs="*", help="key=value")
        return j

    job("import", "dumps", entity=False)
    job("check-urls")
    # hierarchy: the edges of classes, by which occupations are compared with those above and below them
    job("train", "items", "model", "classifier?", "hierarchy?")
    job("evaluate", "items", "out", "classifier?", "how?", "hierarchy?")
    job("link", "items", "model", "out", "threshold?", "hierarchy?").add_argument("--name-rule", action="store_true", help="links between items and targets without a full name in common are dropped")
    job("baseline", "items", "out", "rule?").add_argument("--dates", action="store_true")
    job("extract", "out")
    job("sync-ids", "claims", "edges", "out", "entities?", "metadata?")
    job("sync-links", "claims", "edges", "metadata", "out", "entities?", "blacklist?", "properties?")
    job("sync-bio", "claims", "edges", "entities", "out", "metadata?")
    job("works", "claims", "edges", "out")
    every = job("run", "dumps", "items", "model", "out", "classifier?", "hierarchy?", "claims?", "edges?", "entities?", "metadata?", "blacklist?", entity=False)
    every.add_argument("--evaluate", action="store_true", help="with a report and predictions per entity")
    every.add_argument("--name-rule", action="store_true")
    for name in ("plan-identifiers", "plan-people", "plan-works", "plan-delete", "plan-deprecate"):
        job(name, "claims", "links", "out")
    job("curate", "links", "out", "formatter?", "catalog-id?", "entries?")
    return p


def _ids(spark: SparkSession, a, t: Target) -> DataFrame:
    return knowledge.with_identifier(spark.read.parquet(a.claims), spark.read.parquet(a.edges), t)


def _run_all(a, spark: SparkSession) -> None:
    """After an import: existing links, validation where claims are given, training, evaluation if asked for, linking."""
    given = lambda *names: [x for n in names if getattr(a, n, None) for x in (f"--{n}", getattr(a, n))]
    for e in entities(a.catalog):
        t, out, model = target(a.catalog, e), f"{a.out}/{e}", f"{a.model}/{e}"
        steps = [["extract", "--out", f"{out}/existing"]] if t.link else []
        if a.claims and a.edges:
            steps.append(["sync-ids", *given("claims", "edges"), "--out", f"{out}/dead"])
            if a.metadata and t.link:
                steps.append(["sync-links", *given("claims", "edges", "metadata", "blacklist"), "--out", f"{out}/links-checked"])
            if a.entities:
                steps.append(["sync-bio", *given("claims", "edges", "entities"), "--out", f"{out}/bio-checked"])
        learn = ["--items", a.items, "--classifier", a.classifier or "slp", *given("hierarchy")]
        steps.append(["train", *learn, "--model", model])
        if a.evaluate:
            steps.append(["evaluate", *learn, "--out", f"{out}/report"])
        steps.append(["link", "--items", a.items, "--model", model, *given("hierarchy"), *(["--name-rule"] if a.name_rule else []), "--out", f"{out}/links"])
        for name, *rest in steps:
            run([name, a.catalog, e, "--tables", a.tables, *rest], spark)


def run(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    logging.basicConfig(level=a.log_level.upper())
    spark = spark or session()
    params = options(a.params)
    t = target(a.catalog, a.entity) if hasattr(a, "entity") else None
    if a.job in ("import", "run"):
        reader = READERS[a.catalog]()
        for name, n in reader.counts(reader.write(spark, {n: f"{a.dumps}/{f}" for n, f in reader.files.items()}, a.tables)).items():
            log.info("%s: %d rows", name, n)
        if a.job == "run":
            _run_all(a, spark)
        return
    main, link_table, nlp = linking.target_tables(spark, a.tables, t)
    hierarchy = lambda items: linking.class_expansion(spark.read.parquet(a.hierarchy), linking.prepare_source(items), main) if getattr(a, "hierarchy", None) else None
    if a.job == "check-urls":
        alive, rotten = online.without_rotten(link_table)
        online.totals(alive, rotten).write.mode("overwrite").json(f"{a.tables}/{t.link}_totals")
        alive.write.mode("overwrite").parquet(f"{a.tables}/{t.link}_alive")
        rotten.select("url").write.mode("overwrite").csv(f"{a.tables}/{t.link}_rotten")
    elif a.job == "train":
        items = knowledge.read_items(spark, a.items)
        rows = linking.training_set(items, main, link_table, nlp, hierarchy(items))
        linking.train(a.classifier or "slp", rows, **params).save(a.model)
    elif a.job == "evaluate":
        items = knowledge.read_items(spark, a.items)
        report, predictions = linking.evaluated(a.classifier or "slp", linking.training_set(items, main, link_table, nlp, hierarchy(items)), a.how or "average", **params)
        interchange.write_report(report, a.out)
        interchange.write_predictions(predictions, f"{a.out.rstrip('/')}-predictions")
    elif a.job == "link":
        items = knowledge.read_items(spark, a.items)
        interchange.write_links(linking.link(Model.load(a.model), items, main, link_table, nlp, hierarchy(items), float(a.threshold or 0.5), a.name_rule), a.out)
    elif a.job == "baseline":
        interchange.write_baseline(linking.baseline(a.rule or "all", knowledge.read_items(spark, a.items), main, link_table, a.dates), a.out, t.pid)
    elif a.job == "extract":
        interchange.write_baseline(rules.existing_links(link_table), a.out, t.pid)
    elif a.job == "sync-ids":
        gone = validate.dead_ids(_ids(spark, a, t), main.select(F.col("catalog_id").alias("tid")))
        gone.write.mode("overwrite").json(a.out)
    elif a.job == "sync-links":
        c, metadata = spark.read.parquet(a.claims), spark.read.parquet(a.metadata)
        pids = knowledge.url_properties(spark.read.parquet(a.properties)) if a.properties else None
        own = c.where("kind = 'string'").where(F.col("pid").isin(pids) if pids is not None else F.col("value").like("http%"))
        source = knowledge.identifier_urls(c, metadata).unionByName(own.select("qid", F.col("value").alias("url"))).distinct()
        blacklist = interchange.read_blacklist(spark, a.blacklist) if a.blacklist else []
        for name, df in validate.validate_links(_ids(spark, a, t), source, link_table.select(F.col("catalog_id").alias("tid"), "url"), metadata, blacklist).items():
            df.write.mode("overwrite").json(f"{a.out}/{name}")
    elif a.job == "sync-bio":
        c, e = spark.read.parquet(a.claims), spark.read.parquet(a.entities)
        for name, df in validate.validate_bio(_ids(spark, a, t), knowledge.biodata(c, e), validate.bio_rows(validate.has_bio(main))).items():
            df.write.mode("overwrite").json(f"{a.out}/{name}")
    elif a.job == "works":
        work = target(a.catalog, t.work)
        rel = spark.read.parquet(f"{a.tables}/{t.relationship}")
        interchange.write_statements(enrich.for_target(rel, _ids(spark, a, work), _ids(spark, a, t), t), a.out)
    elif a.job in ("plan-delete", "plan-deprecate"):
        edits.retire(a.job[5:], interchange.read_invalid(spark, a.links), spark.read.parquet(a.claims), t.pid).write.mode("overwrite").json(a.out)
    elif a.job == "plan-identifiers":
        edits.add_identifiers(interchange.read_links(spark, a.links), spark.read.parquet(a.claims), t.pid, t.catalog_qid).write.mode("overwrite").json(a.out)
    elif a.job == "plan-people":
        edits.add_people_statements(interchange.read_statements(spark, a.links), spark.read.parquet(a.claims), t.pid, t.catalog_qid).write.mode("overwrite").json(a.out)
    elif a.job == "plan-works":
        edits.add_works_statements(interchange.read_statements(spark, a.links), spark.read.parquet(a.claims), t.pid, t.catalog_qid, a.catalog == "imdb").write.mode("overwrite").json(a.out)
    elif a.job == "curate":
        from linkforge.schema import CURATION_ENTRY

        now = interchange.read_entries(spark, a.entries) if a.entries else spark.createDataFrame([], CURATION_ENTRY)
        sync_matches(now, interchange.read_links(spark, a.links), main, int(getattr(a, "catalog_id") or 1), a.entity, a.formatter or "$1").write.mode("overwrite").json(a.out)


if __name__ == "__main__":
    run()
