"""Operator 8: near-duplicate vectors by binary codes under random rotations.

Vectors are made unit vectors in double precision and rotated at random, several times side by side until there are
`bits` x `tables` components. Their signs are the stored code; with it go the correction factor <signs, rotated vector> and
the vector in whole 127ths of its largest component with the length of what that leaves out. `bits` signs in turn are
a table's key: vectors at a cosine of 0.95 share a given key of 20 bits with a chance of 0.119, and none of 60 with
0.05 % (the index: every vector is in it; fitted on nothing).

Within a key the codes decide: the product of one vector's signs with another's rounded vector, rotated and divided by
the factor, is an unbiased estimate of their inner product, and its deviation is known from the factor alone. A pair
whose estimate plus `sure` deviations plus the rounding stays below the threshold is done with. Vectors themselves are
only fetched for members of the other pairs, in the first table that a pair shares; these pairs are computed anew in
double precision, and that value alone decides.

Equal vectors are one from the start, with their number. A key with more than `block` vectors is worked on in pairs
of blocks. A task gives the number of links of each vector and which of them belong together, never the pairs.

Null or zero vectors, and those with null or non-finite components, link with nothing, nor do vectors of different
lengths. Rows with the same vec_id count as vectors of their own, in one component. Rows with null vec_id link with
nothing and stay, with a null component_id. Very long vectors are coded alike. Empty tables give empty ones; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkforge.llm.common import Scratch, components
from linkforge.llm.linking import batches


@lru_cache(maxsize=16)
def rotations(dim: int, n: int, seed: int = 4) -> np.ndarray:
    """dim x n: blocks of random rotations side by side."""
    r = np.random.default_rng([seed, dim])
    return np.hstack([np.linalg.qr(r.standard_normal((dim, dim)))[0] for _ in range(-(-n // dim))])[:, :n]


def unit(vector) -> np.ndarray | None:
    if vector is None:
        return None
    x = np.asarray(vector, dtype=np.float64)
    if x.ndim != 1 or not len(x) or not np.isfinite(x).all():
        return None
    top = np.abs(x).max()
    if top == 0:
        return None
    x = x / top
    return x / np.sqrt(x @ x)


def code_bits(dim: int, least: int) -> int:
    """The least number of whole rotations' signs that gives so many."""
    return -(-least // dim) * dim


def encode(units: np.ndarray, least: int, seed: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """(signs as booleans, correction factors <signs, rotated vector>, both taken as unit vectors)."""
    dim = units.shape[1]
    n = code_bits(dim, least)
    y = units @ rotations(dim, n, seed)
    return y >= 0, np.abs(y).sum(1) / np.sqrt(n * (n // dim))


def rounded(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(whole 127ths of the largest component, largest component, length of the rest left out)."""
    top = np.abs(units).max(1)
    q = np.rint(units / top[:, None] * 127).astype(np.int8)
    return q, top, np.sqrt(((units - q * (top / 127)[:, None]) ** 2).sum(1))


class Codes:
    """Codes of vectors of one dimension, ready for estimates."""

    def __init__(self, dim: int, least: int, code: list[bytes], factor, q: list[bytes], top, left, seed: int = 4):
        n = code_bits(dim, least)
        raw = np.frombuffer(b"".join(code), dtype=np.uint8).reshape(len(code), -1)
        self.signs = np.unpackbits(raw, axis=1, count=n).astype(np.float32) * 2 - 1
        vectors = np.frombuffer(b"".join(q), dtype=np.int8).reshape(len(q), dim) * (np.asarray(top) / 127)[:, None]
        self.rotated = (vectors @ rotations(dim, n, seed)).astype(np.float32)
        f = np.asarray(factor)
        self.scale, self.left = f * np.sqrt(n * (n // dim)), np.asarray(left)
        self.deviation = np.sqrt(np.maximum(0.0, 1 - f**2) / (f**2 * max(1, n - n // dim)))

    def may_link(self, p: np.ndarray, q: np.ndarray, least: float, sure: float) -> np.ndarray:
        """Whether the upper bounds of the pairs of rows reach least."""
        out = np.empty(len(p), dtype=bool)
        for s in range(0, len(p), 20_000):
            x, y = p[s : s + 20_000], q[s : s + 20_000]
            estimate = np.einsum("ij,ij->i", self.signs[x], self.rotated[y]) / self.scale[x]
            out[s : s + 20_000] = estimate + sure * self.deviation[x] + self.left[y] + 1e-5 >= least
        return out

    def may_link_all(self, least: float, sure: float, rows: slice) -> np.ndarray:
        """The same for all pairs within some rows."""
        estimate = (self.signs[rows] @ self.rotated[rows].T) / self.scale[rows][:, None]
        return estimate + (sure * self.deviation[rows])[:, None] + self.left[rows][None, :] + 1e-5 >= least


def smallest(ids: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The smallest id reachable of each row over the links p - q."""
    low = ids.copy()
    while len(p):
        new = low.copy()
        np.minimum.at(new, p, low[q])
        np.minimum.at(new, q, low[p])
        if (new == low).all():
            break
        low = new
    return low


def candidates(bounds: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows within groups of at most `most` rows, by distance; bounds: starts of the groups and the end."""
    sizes = np.diff(bounds)
    end = np.repeat(bounds[1:], sizes)
    at = np.flatnonzero(np.repeat(sizes <= most, sizes))
    d = 1
    while len(at := at[at + d < end[at]]):
        yield at, at + d
        d += 1


def undecided(pdf: pd.DataFrame, least: float, sure: float, bits: int, tables: int, small: int = 24) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of whole blocks (t, key, i, j; sorted) that codes can't tell apart, in the first table they share."""
    where = pdf[["t", "key", "i", "j"]].to_numpy("int64")
    bounds = np.append(np.flatnonzero(np.r_[True, (where[1:] != where[:-1]).any(1)]), len(pdf))
    b, dims = pdf["b"].to_numpy(), pdf["dim"].to_numpy()
    columns = [pdf[c].to_list() for c in ("code", "factor", "q", "top", "left")]

    def chosen(p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # across two blocks, as pairs within one have a task of their own; and no earlier table that both share
        keep = (where[p, 2] == where[p, 3]) | (b[p] != b[q])
        p, q = p[keep], q[keep]
        first = np.ones(len(p), dtype=bool)
        for s in range(0, len(p), 20_000):
            x, y = p[s : s + 20_000], q[s : s + 20_000]
            same = (codes.signs[place[x], : tables * bits] == codes.signs[place[y], : tables * bits]).reshape(len(x), tables, bits).all(2)
            first[s : s + 20_000] = same.argmax(1) == where[x, 0]
        return p[first], q[first]

    for d in np.unique(dims):  # a key holds vectors of one length
        own = np.flatnonzero(dims == d)
        codes = Codes(int(d), bits * tables, *[[c[k] for k in own] for c in columns])
        place = np.full(len(pdf), -1, dtype=np.int64)
        place[own] = np.arange(len(own))
        for p, q in candidates(bounds, small):
            keep = dims[p] == d
            p, q = p[keep], q[keep]
            if len(p):
                may = codes.may_link(place[p], place[q], least, sure) | codes.may_link(place[q], place[p], least, sure)
                yield chosen(p[may], q[may])
        for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if end - start > small and dims[start] == d:
                may = codes.may_link_all(least, sure, slice(place[start], place[start] + end - start))
                p, q = np.nonzero(np.triu(may | may.T, 1))
                yield chosen(start + p, start + q)


CODED = "c0 long, c1 long, id long, m long, dim int, code binary, factor double, q binary, top double, left double"


def classes(vectors: DataFrame, column: str = "embedding", least: float = 0.95, bits: int = 20, tables: int = 60, sure: float = 5.0, block: int = 1024) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""

    def read(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches(pdfs, 2048):
            us = [unit(x) for x in part["v"]]
            digest = [None if u is None else np.frombuffer(hashlib.md5((u + 0.0).tobytes()).digest(), "<i8") for u in us]
            out = pd.DataFrame({"vec_id": part["vec_id"].array, "u": us})
            for k in (0, 1):
                out[f"c{k}"] = pd.array([None if d is None else int(d[k]) for d in digest], dtype="Int64")
            yield out

    def coded(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches(pdfs, 2048):
            dims = part["u"].map(len).to_numpy()
            for d in np.unique(dims):
                own = part[dims == d]
                u = np.stack(own["u"].to_list())
                signs, factor = encode(u, bits * tables)
                q, top, left = rounded(u)
                yield pd.DataFrame({"c0": own["c0"], "c1": own["c1"], "id": own["id"], "m": own["m"], "dim": int(d), "code": [x.tobytes() for x in np.packbits(signs, axis=1)], "factor": factor, "q": [x.tobytes() for x in q], "top": top, "left": left})

    def keyed(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = 1 << np.arange(bits, dtype=np.int64)
        for part in batches(pdfs, 2048):
            for d in part["dim"].unique():  # codes of one length
                own = part[part["dim"] == d]
                raw = np.frombuffer(b"".join(own["code"]), dtype=np.uint8).reshape(len(own), -1)
                keys = (np.unpackbits(raw, axis=1, count=bits * tables).reshape(len(own), tables, bits) * weights).sum(2) + (int(d) << bits)
                yield pd.DataFrame({"c0": own["c0"], "c1": own["c1"], "cells": list(keys)})

    at = ["t", "key", "i", "j"]
    with Scratch(vectors.sparkSession) as t:
        base = t.store(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v")).mapInPandas(read, "vec_id long, u array<double>, c0 long, c1 long"))
        valid = base.where("vec_id is not null and c0 is not null")
        nodes = t.store(valid.groupBy("c0", "c1").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("m")))
        firsts = valid.join(nodes, ["c0", "c1"]).where("vec_id = id").dropDuplicates(["c0", "c1"])
        full = t.store(firsts.select("c0", "c1", "id", "m", "u").mapInPandas(coded, CODED))
        keys = t.store(full.select("c0", "c1", "dim", "code").mapInPandas(keyed, "c0 long, c1 long, cells array<long>")).select("c0", "c1", F.posexplode("cells").alias("t", "key"))
        sizes = keys.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        many = t.store(sizes.select("t", "key", F.ceil(F.col("n") / block).cast("int").alias("nb"), "n"))
        rows = keys.join(many.drop("n"), ["t", "key"]).withColumn("b", F.pmod(F.xxhash64("c0"), "nb").cast("int"))
        dealt = t.store(rows.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).withColumns({"i": F.least("b", "o"), "j": F.greatest("b", "o")}).drop("o", "nb"))
        # many small keys go to a task call together, about 4 blocks' worth of rows
        parts = max(1, -(-dealt.count() // (4 * block)))
        bundle = F.pmod(F.xxhash64(*at), F.lit(parts)).alias("bundle")

        def prune(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(at, ignore_index=True)
            alive = np.zeros(len(pdf), dtype=bool)
            for p, q in undecided(pdf, least, sure, bits, tables):
                alive[p] = alive[q] = True
            return pdf.loc[alive, [*at, "b", "c0", "c1"]]

        def decide(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(at, ignore_index=True)
            us, ids, m, found = pdf["u"].to_numpy(), pdf["id"].to_numpy("int64"), pdf["m"].to_numpy("int64"), []
            for p, q in undecided(pdf, least, sure, bits, tables):
                for s in range(0, len(p), 20_000):
                    x, y = p[s : s + 20_000], q[s : s + 20_000]
                    if len(x):
                        hit = np.einsum("ij,ij->i", np.stack(us[x]), np.stack(us[y])) >= least
                        found.append((x[hit], y[hit]))
            p, q = (np.concatenate([x[k] for x in found] or [np.empty(0, dtype=np.int64)]) for k in (0, 1))
            n = np.bincount(p, m[q], len(ids)) + np.bincount(q, m[p], len(ids))
            out = pd.DataFrame({"c0": pdf["c0"], "c1": pdf["c1"], "id": ids, "n": n.astype("int64"), "low": smallest(ids, p, q)})
            return out[(out["n"] > 0) | (out["low"] != out["id"])]

        alive = t.store(dealt.join(full, ["c0", "c1"]).groupBy(bundle).applyInPandas(prune, "t int, key long, i int, j int, b int, c0 long, c1 long"))
        t.drop(dealt)
        units = firsts.select("c0", "c1", "u")
        found = t.store(alive.join(full, ["c0", "c1"]).join(units, ["c0", "c1"]).groupBy(bundle).applyInPandas(decide, "c0 long, c1 long, id long, n long, low long"))
        t.drop(alive)
        same_id = valid.join(nodes.select("c0", "c1", "id"), ["c0", "c1"]).where("vec_id <> id").select(F.col("vec_id").alias("a"), F.col("id").alias("b"))
        twins = same_id.join(full.select(F.col("id").alias("a")), "a", "left_semi")  # a vec_id with several vectors
        comps = components(found.select(F.col("id").alias("a"), F.col("low").alias("b")).unionByName(twins))
        counts = found.groupBy("c0", "c1").agg(F.sum("n").alias("n"))
        done = nodes.join(counts, ["c0", "c1"], "left").join(comps.withColumnRenamed("comp", "c"), "id", "left")
        done = done.select("c0", "c1", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("c", "id").alias("component_id"))
        ids = base.select("vec_id", "c0", "c1")
        out = t.keep(ids.where("vec_id is not null").join(done, ["c0", "c1"], "left").unionByName(ids.where("vec_id is null").withColumns({"n_links": F.lit(0).cast("long"), "component_id": F.lit(None).cast("long")})))
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def op8_embedding_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {"op8_embedding_codes": op8_embedding_codes}
SQL = {
    "op8_embedding_codes": """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
u AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM v
      WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_dot_product(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a, min(b) AS c FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, m.c AS component_id, e.vec_id = m.c AS kept
FROM embeddings e JOIN m ON m.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id"""
}
