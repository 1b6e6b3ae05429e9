"""Links between sets that share a key, verified on the whole sets, and their connected components.

No pair of a bucket's members is ever a row of its own unless one of the two is the bucket's smallest id:

1. every member of a bucket is held against the bucket's smallest id (a star): first by size alone, as sets that share
   4/5 differ in size by a quarter at most, then on the sets, of which only those still wanted are made;
2. a bucket falls into size classes (powers of 5/4); similar sets stand in one or in neighbouring classes, so a class
   and the next make up a part of the bucket. Parts whose members are all in one component need no more;
3. the rest is put into cells: touching open parts of one size class. Members outside a cell's largest component are
   held against all its members, block by block: a task counts the common elements of two bounded blocks over an
   index of one of them and gives only which components touch.

So all candidates are decided exactly, whatever the size of a bucket; a bucket that holds many copies is reduced
with map-side combination and its members are split over blocks. What grows beyond proportion are members that share
keys and sizes with many others and are similar to none: each is held against all of its cell.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkforge.llm.common import Scratch, components


def similar(common, a, b, share: tuple[int, int] = (4, 5)):
    """Whether common / union >= share, in whole numbers; for Columns and arrays."""
    return common * share[1] >= (a + b - common) * share[0]


def touching(own: list[np.ndarray], own_comp: np.ndarray, all_: list[np.ndarray], all_comp: np.ndarray, share: tuple[int, int] = (4, 5)) -> set[tuple[int, int]]:
    """Pairs of different components with a similar pair of sets, one of own and one of all_. Sets: distinct elements."""
    sizes = np.array([len(x) for x in all_], dtype=np.int64)
    flat = np.concatenate([*all_, np.empty(0, dtype=np.int64)])
    at = np.repeat(np.arange(len(all_)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, at = flat[order], at[order]
    out = set()
    for s, c in zip(own, own_comp.tolist(), strict=True):
        a, b = np.searchsorted(flat, s, "left"), np.searchsorted(flat, s, "right")
        hit = b > a
        parts = [at[i:j] for i, j in zip(a[hit].tolist(), b[hit].tolist(), strict=True)]
        if not parts:
            continue
        common = np.bincount(np.concatenate(parts), minlength=len(all_))
        for d in np.unique(all_comp[similar(common, len(s), sizes, share)]).tolist():
            if d != c:
                out.add((max(c, d), min(c, d)))
    return out


def size_class(n, share: tuple[int, int] = (4, 5)):
    """Sets whose sizes differ by less than share[1] / share[0] are in the same or in neighbouring classes."""
    return F.floor(F.log(n.cast("double")) / math.log(share[1] / share[0]) + 1e-9).cast("int")


def verified_components(keys: DataFrame, sizes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], share: tuple[int, int] = (4, 5), block: int = 1024, block_elements: int = 1_000_000) -> DataFrame:
    """keys (key long, id long): candidates share a key. sizes (id, n): elements of each set, all distinct.
    sets_of(ids): rows (id, s array<long>).

    Rows (id, comp) of ids with a link; comp: the smallest id reachable.
    """
    with Scratch(keys.sparkSession) as t:
        lows = keys.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi").select("key", "lo")
        shared = t.store(keys.join(lows, "key").select("key", "id", "lo"))
        sizes = t.store(sizes.join(shared.select("id").distinct(), "id", "left_semi").select("id", "n"))
        a, b = sizes.select(F.col("id").alias("a"), F.col("n").alias("na")), sizes.select(F.col("id").alias("b"), F.col("n").alias("nb"))
        stars = shared.where("id <> lo").select(F.col("id").alias("a"), F.col("lo").alias("b")).distinct().join(a, "a").join(b, "b")
        stars = t.store(stars.where(similar(F.least("na", "nb"), F.col("na"), F.col("nb"), share)))
        sets = t.store(sets_of(stars.select(F.explode(F.array("a", "b")).alias("id")).distinct()))
        left, right = sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), sets.select(F.col("id").alias("b"), F.col("s").alias("sb"))
        links = t.store(stars.join(left, "a").join(right, "b").where(similar(F.size(F.array_intersect("sa", "sb")), F.size("sa"), F.size("sb"), share)).select("a", "b"))
        t.drop(stars, sets)
        first = components(links)
        t.drop(links)

        labelled = t.store(shared.select("key", "id").join(first, "id", "left").select("key", "id", F.coalesce("comp", "id").alias("c")))
        t.drop(shared)
        opened = labelled.groupBy("key").agg(F.min("c").alias("m"), F.max("c").alias("x"), F.count(F.lit(1)).alias("n")).where("m <> x and n > 2").select("key")
        parts = t.store(labelled.join(opened, "key").join(sizes, "id").select("key", "id", "c", "n", size_class(F.col("n"), share).alias("z")))
        t.drop(labelled)
        # part z of a bucket: its members of the classes z and z - 1
        own = parts.groupBy("key", "z").agg(F.min("c").alias("m"), F.max("c").alias("x"))
        both = own.unionByName(own.withColumn("z", F.col("z") + 1)).groupBy("key", "z").agg(F.min("m").alias("m"), F.max("x").alias("x"))
        # by bucket, as many as there are size classes; a member looks its two parts up, and equal findings of many buckets
        # become one before they are laid out as rows
        opened = both.where("m <> x").groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("z", "m"))).alias("open"))
        found = parts.join(opened, "key").select("id", "c", "n", "z", F.try_element_at("open", F.col("z")).alias("m0"), F.try_element_at("open", F.col("z") + 1).alias("m1"))
        found = t.store(found.where("m0 is not null or m1 is not null").distinct())
        rest = found.select("id", "c", "n", "z", F.col("m0").alias("m")).unionByName(found.select("id", "c", "n", (F.col("z") + 1).alias("z"), F.col("m1").alias("m")))
        rest = t.store(rest.where("m is not null").distinct())
        t.drop(parts)
        if rest.isEmpty():
            return t.keep(first)
        clusters = components(rest.select(F.col("c").alias("a"), F.col("m").alias("b")).distinct()).select(F.col("id").alias("c"), F.col("comp").alias("cluster"))
        members = t.store(rest.select("id", "c", "n", "z").distinct().join(clusters, "c"))
        t.drop(rest)
        cell = ["cluster", "z"]
        by_comp = members.groupBy(*cell, "c").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("t"))
        stats = by_comp.groupBy(*cell).agg(F.max_by(F.struct("c", "k", "t"), F.struct("k", "t", "c")).alias("top"), F.sum("k").alias("k"), F.sum("t").alias("t"))
        blocks = lambda k, t: F.greatest(F.lit(1), F.ceil(k / F.lit(float(block))), F.ceil(t / F.lit(float(block_elements)))).cast("int")
        plan = stats.select(*cell, F.col("top.c").alias("top"), blocks(F.col("k"), F.col("t")).alias("nm"), blocks(F.col("k") - F.col("top.k"), F.col("t") - F.col("top.t")).alias("no"))
        sets = t.store(sets_of(members.select("id").distinct()))
        full = members.join(plan, cell).join(sets, "id").withColumn("x", F.xxhash64("id"))
        upto = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
        as_member = full.select(*cell, "c", "s", F.lit(False).alias("own"), F.pmod("x", "nm").cast("int").alias("bm"), upto(F.col("no")).alias("bo"))
        as_own = full.where("c <> top").select(*cell, "c", "s", F.lit(True).alias("own"), F.pmod("x", "no").cast("int").alias("bo"), upto(F.col("nm")).alias("bm"))

        def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
            own = pdf["own"].to_numpy(dtype=bool)
            s, c = pdf["s"].to_numpy(), pdf["c"].to_numpy(dtype="int64")
            return pd.DataFrame(sorted(touching(list(s[own]), c[own], list(s[~own]), c[~own], share)), columns=["a", "b"], dtype="int64")

        more = t.store(as_member.unionByName(as_own).groupBy(*cell, "bo", "bm").applyInPandas(kernel, "a long, b long"))
        t.drop(members, sets)
        second = components(more).select(F.col("id").alias("comp"), F.col("comp").alias("to"))
        ids = first.unionByName(second.select(F.col("comp").alias("id"), "comp")).groupBy("id").agg(F.min("comp").alias("comp"))
        return t.keep(ids.join(second, "comp", "left").select("id", F.coalesce("to", "comp").alias("comp")))


def batches(pdfs: Iterator[pd.DataFrame], rows: int = 512) -> Iterator[pd.DataFrame]:
    """Pieces of at most so many rows, so that a batch of long texts stays small in memory."""
    for b in pdfs:
        for i in range(0, len(b), rows):
            yield b.iloc[i : i + rows]
