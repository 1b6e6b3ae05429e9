"""New statements: works by people, from a catalogue's relationships and two sets of identified items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkforge.operators.rules import first_per_target
from linkforge.schema import Target


def works_by_people(relationship: DataFrame, works: DataFrame, people: DataFrame, predicate: str) -> DataFrame:
    """relationship (from_catalog_id: work, to_catalog_id: person); works and people (qid, tid), of a tid the smallest qid.

    Rows: subject (work), predicate, value (person), tid (the person's)."""
    w = first_per_target(works).select(F.col("tid").alias("from_catalog_id"), F.col("qid").alias("subject"))
    p = first_per_target(people).select(F.col("tid").alias("to_catalog_id"), F.col("qid").alias("value"))
    rows = relationship.select("from_catalog_id", "to_catalog_id").distinct().join(w, "from_catalog_id").join(p, "to_catalog_id")
    return rows.select("subject", F.lit(predicate).alias("predicate"), "value", F.col("to_catalog_id").alias("tid")).distinct()


def for_target(relationship: DataFrame, works: DataFrame, people: DataFrame, t: Target) -> DataFrame:
    return works_by_people(relationship, works, people, t.works_pid)
