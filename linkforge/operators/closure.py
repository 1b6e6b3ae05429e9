"""Transitive closure of child -> parent edges by a fixpoint of joins; each round starts from new pairs alone."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage in spark.checkpoint.dir. Where that is unset a local session takes a temporary folder; on a cluster
    there is none that all machines share, so there it's an error."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        at = sc.getConf().get("spark.checkpoint.dir")
        if not at and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(at or tempfile.mkdtemp(prefix="linkforge-checkpoint-"))
    return df.checkpoint(eager=True)


def closure(edges: DataFrame, direction: str = "up", start: Column | DataFrame | None = None, most_rounds: int = 64) -> DataFrame:
    """(root, node): the root and all that is reached from it. edges: child, parent; cycles do no harm.

    direction 'up': from a class to its subclasses (items below it); 'down' reversed: from a class to its superclasses.
    start: a literal, or a DataFrame (root); all nodes if None. most_rounds: depth beyond which it raises.
    """
    step = edges.select(F.col("parent").alias("node"), F.col("child").alias("next")) if direction == "up" else edges.select(F.col("child").alias("node"), F.col("parent").alias("next"))
    step = step.where("node is not null and next is not null").distinct()
    if isinstance(start, DataFrame):
        roots = start.select("root").distinct()
    elif start is not None:
        roots = edges.sparkSession.range(1).select(start.cast("string").alias("root"))
    else:
        roots = step.select(F.col("node").alias("root")).union(step.select("next")).distinct()
    fresh = cut(roots.select("root", F.col("root").alias("node")))
    parts = [fresh]
    for _ in range(most_rounds):
        seen = parts[0]
        for p in parts[1:]:
            seen = seen.unionByName(p)
        fresh = cut(fresh.join(step, "node").select("root", F.col("next").alias("node")).distinct().join(seen, ["root", "node"], "left_anti"))
        if fresh.isEmpty():
            return seen
        parts.append(fresh)
    raise RuntimeError(f"the hierarchy is deeper than {most_rounds}")


def subclasses(edges: DataFrame, qid: str) -> DataFrame:
    return closure(edges, "up", F.lit(qid)).select(F.col("node").alias("qid"))


def superclasses(edges: DataFrame, qid: str) -> DataFrame:
    return closure(edges, "down", F.lit(qid)).select(F.col("node").alias("qid"))


def expansion(edges: DataFrame, used: DataFrame | None = None) -> DataFrame:
    """node, related: every class with its sub- and superclasses, itself included, as a sorted array. used (root): only
    these classes, so that the closure starts from what occurs instead of from all."""
    up, down = closure(edges, "up", used), closure(edges, "down", used)
    return up.unionByName(down).distinct().groupBy(F.col("root").alias("node")).agg(F.array_sort(F.collect_set("node")).alias("related"))


def follow(rows: DataFrame, redirects: DataFrame, column: str, most_rounds: int = 16) -> DataFrame:
    """rows with column replaced by where its chain of redirects (source, target) ends; rows in a circle are dropped."""
    ends = closure(redirects.select(F.col("source").alias("child"), F.col("target").alias("parent")), "down", most_rounds=most_rounds)
    last = ends.join(redirects.select(F.col("source").alias("node")), "node", "left_anti").select(F.col("root").alias("was"), F.col("node").alias("now"))
    moved = redirects.select(F.col("source").alias("was")).distinct()
    known = moved.join(last, "was", "left")
    out = rows.join(known.withColumn("is_moved", F.lit(True)), rows[column] == F.col("was"), "left")
    return out.withColumn(column, F.when(F.col("is_moved"), F.col("now")).otherwise(F.col(column))).where(F.col(column).isNotNull()).drop("was", "now", "is_moved")
