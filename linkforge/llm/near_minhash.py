"""Operator 2: near duplicates by MinHash with tensored banding.

Each document's set of k-word shingles is hashed. Instead of one independent group of minhashes for each of a x b
tables there are two small collections: `a` groups of `ka` minhashes and `b` groups of `kb`. Table (i, j) is keyed by
the pair of the i-th group of the one and the j-th of the other, so a * ka + b * kb minhashes serve a * b tables of
depth ka + kb; the pairs are formed in the JVM from the a + b groups. At a similarity of exactly 0.8 the chance to
share no table is (1 - 0.8^ka)^a + (1 - 0.8^kb)^b at most, 0.075 % by default, and it falls fast above.

Documents with equal sets are one node from the start. Candidates are decided on the full sets (see linking), so no
link is drawn below the threshold. Links: share[0] / share[1] of the union or more.

Null, empty and blank texts have no shingle and link with nothing. Texts with fewer than k words have one shingle,
all their words. Rows that share a doc_id are one document: if their texts differ, each row has its own n_shingles
and they count as linked. Rows with null doc_id aren't compared; their component_id is null and they are kept.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkforge.llm.common import M1, Scratch, components, mix, pick, shingle_hashes, word_hashes
from linkforge.llm.linking import batches, verified_components

TENSOR = (11, 3, 11, 3)


def _constants(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(seed)
    return r.integers(0, 2**63, n, dtype=np.uint64), r.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def group_minhashes(flat: np.ndarray, starts: np.ndarray, groups: int, depth: int, seed: int) -> np.ndarray:
    """For each set (flat from one start to the next, none empty) its groups of minhashes, each as one hash."""
    xor, mul = _constants(groups * depth, seed)
    out = np.empty((len(starts), groups), dtype=np.uint64)
    for g in range(groups):
        acc = np.full(len(starts), g + 1, dtype=np.uint64)
        for i in range(g * depth, (g + 1) * depth):
            acc = mix(acc * M1 + np.minimum.reduceat((flat ^ xor[i]) * mul[i], starts))
        out[:, g] = acc
    return out


def sketches(docs: DataFrame, k: int = 2, tensor: tuple[int, int, int, int] = TENSOR) -> DataFrame:
    """doc_id, n_shingles, two hashes f1, f2 of the whole set, and both collections ga, gb (null: no shingle)."""
    a, ka, b, kb = tensor

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches(pdfs):
            sets = [np.unique(shingle_hashes(word_hashes(t), k)) for t in part["text"]]
            n = np.array([len(s) for s in sets], dtype="int64")
            out = pd.DataFrame({"doc_id": part["doc_id"].array, "n_shingles": n})
            full = np.flatnonzero(n)
            cols = {c: np.full(len(n), None, dtype=object) for c in ("f1", "f2", "ga", "gb")}
            if len(full):
                flat, starts = np.concatenate(sets), np.concatenate([[0], np.cumsum(n[full])[:-1]])
                signed = lambda x: x.view(np.int64)
                f1, f2 = np.add.reduceat(mix(flat), starts), np.add.reduceat(mix(flat * M1 + np.uint64(3)), starts)
                for c, v in (("f1", f1), ("f2", f2)):
                    cols[c][full] = signed(v)
                for c, g in (("ga", group_minhashes(flat, starts, a, ka, 11)), ("gb", group_minhashes(flat, starts, b, kb, 12))):
                    for i, row in zip(full.tolist(), signed(g), strict=True):
                        cols[c][i] = row
            for c in ("f1", "f2"):
                out[c] = pd.array(cols[c], dtype="Int64")
            out["ga"], out["gb"] = cols["ga"], cols["gb"]
            yield out

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, "doc_id long, n_shingles long, f1 long, f2 long, ga array<long>, gb array<long>")


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    """id (the doc_id), s: the distinct shingles' hashes."""

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches(pdfs, 256):
            yield pd.DataFrame({"id": part["doc_id"].array, "s": [np.unique(shingle_hashes(word_hashes(t), k)).view(np.int64) for t in part["text"]]})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, "id long, s array<long>")


def classes(docs: DataFrame, k: int = 2, share: tuple[int, int] = (4, 5), tensor: tuple[int, int, int, int] = TENSOR) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id, kept."""
    with Scratch(docs.sparkSession) as t:
        base = t.store(sketches(docs, k, tensor))
        some = base.where("doc_id is not null and n_shingles > 0")
        # equal sets, and rows that share a doc_id, are one node; its id is the smallest doc_id
        nodes = some.groupBy("f1", "f2").agg(F.min("doc_id").alias("id"))
        many = t.store(some.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"))
        own = t.store(some.select("doc_id", "f1", "f2", "n_shingles").join(nodes, ["f1", "f2"]))
        same = t.store(own.join(many, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("id").alias("lo"), F.collect_set("id").alias("ids")).select(F.explode("ids").alias("a"), F.col("lo").alias("b")).where("a <> b"))
        reps = some.join(own.where("doc_id = id").select("doc_id", "f1", "f2").distinct(), ["doc_id", "f1", "f2"], "left_semi").select(F.col("doc_id").alias("id"), "ga", "gb")
        cells = reps.select("id", F.posexplode("ga").alias("i", "x"), "gb").select("id", "i", "x", F.posexplode("gb").alias("j", "y"))
        keys = cells.select(F.xxhash64("i", "x", "j", "y").alias("key"), "id")
        text = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        several = many.select(F.col("doc_id").alias("id"))

        def sets_of(ids: DataFrame) -> DataFrame:
            # a doc_id with several rows stands for the union of their shingles
            got = shingle_sets(pick(text, ids.select(F.col("id").alias("doc_id"))), k)
            if not repeated:
                return got
            twice = got.join(several, "id", "left_semi").select("id", F.explode("s").alias("x")).groupBy("id").agg(F.collect_set("x").alias("s"))
            return got.join(several, "id", "left_anti").unionByName(twice)

        repeated = not several.isEmpty()
        sizes = own.where("doc_id = id").select("id", F.col("n_shingles").alias("n"))
        if repeated:
            sizes = sizes.join(several, "id", "left_anti").unionByName(sets_of(several).select("id", F.size("s").cast("long").alias("n")))
        linked = verified_components(keys, sizes, sets_of, share)
        comps = linked if same.isEmpty() else components(linked.select(F.col("id").alias("a"), F.col("comp").alias("b")).unionByName(same))
        ids = nodes.join(comps, "id", "left").select("f1", "f2", F.coalesce("comp", "id").alias("component_id"))
        out = t.keep(base.select("doc_id", "n_shingles", "f1", "f2").join(ids, ["f1", "f2"], "left"))
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op2_near_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, the one with the smallest doc_id; five-word shingles."""
    return pick(docs, classes(docs, k=5).where("not kept"), "left_anti")


QUERIES = {"op2_near_minhash": op2_near_minhash}
SQL = {
    "op2_near_minhash": r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
                                   ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM d),
g AS (SELECT s, list_sort(s) AS k, doc_id, len(s) AS n FROM s),
u AS (SELECT min(doc_id) AS id, any_value(s) AS s, any_value(n) AS n FROM g WHERE n > 0 GROUP BY k),
x AS (SELECT id, n, unnest(s) AS t FROM u),
p AS (SELECT a.id AS a, b.id AS b, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb FROM x a JOIN x b ON a.t = b.t AND a.id < b.id
      AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY a.id, b.id),
l AS (SELECT a, b FROM p WHERE 100 * c >= 80 * (na + nb - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT id AS a, id AS b FROM u UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a AS id, min(b) AS comp FROM r GROUP BY a),
o AS (SELECT g.doc_id, g.n, m.comp FROM g LEFT JOIN (SELECT k, min(doc_id) AS id FROM g WHERE n > 0 GROUP BY k) v ON g.k = v.k AND g.n > 0 LEFT JOIN m ON m.id = v.id)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, coalesce(comp, doc_id) AS component_id, doc_id = coalesce(comp, doc_id) AS kept FROM o"""
}
