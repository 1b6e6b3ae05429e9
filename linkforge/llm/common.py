"""What the corpus operators share: a place for shared files, hashing of words, connected components."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where that is unset a local session takes a temporary one; a cluster has no
    folder that all its machines see, so there it's an error."""
    sc = spark.sparkContext
    at = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not at:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="linkforge-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(at)
    return at


def delete(spark: SparkSession, *paths: str) -> None:
    """Files of finished steps in the shared folder; what is gone already is no error."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)


#: Rows of a batch that goes to a Python worker.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


class Scratch:
    """Tables of a job's steps, as Parquet in the shared folder: they cut the lineage and survive lost executors.

    As a context it deletes at its end what wasn't kept. drop() deletes a table that no later step reads.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        delete(self.spark, *self.paths.values())
        self.paths.clear()
        self.collect()

    def collect(self) -> None:
        """Let the driver's collector find the plans of finished steps: their shuffle files on the executors go then, which
        are many small ones where partitions are many."""
        gc.collect()
        self.spark._jvm.System.gc()

    def store(self, df: DataFrame) -> DataFrame:
        path = f"{shared_dir(self.spark).rstrip('/')}/linkforge-{uuid.uuid4().hex}"
        before = self.spark.conf.get(BATCH)
        self.spark.conf.set(BATCH, min(int(before), 2000) if int(before) > 0 else 2000)  # texts and sets can be long
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(BATCH, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        self.collect()
        return out

    def keep(self, df: DataFrame) -> DataFrame:
        """Store a result that is read after the context's end."""
        out = self.store(df)
        del self.paths[id(out)]
        return out

    def drop(self, *dfs: DataFrame) -> None:
        delete(self.spark, *[self.paths.pop(id(d)) for d in dfs if id(d) in self.paths])


def keep(df: DataFrame) -> DataFrame:
    """Compute once into the shared folder and cut the lineage; the table stays there."""
    return Scratch(df.sparkSession).keep(df)


#: Ids up to this number are broadcast (2 MB of longs); more are joined by a shuffle.
MOST_BROADCAST = 250_000


def small(df: DataFrame, most: int = MOST_BROADCAST) -> DataFrame:
    """A stored table of short rows, marked for broadcast if it is counted to hold so few."""
    return F.broadcast(df) if df.count() <= most else df


def pick(df: DataFrame, ids: DataFrame, how: str = "left_semi", most: int = MOST_BROADCAST) -> DataFrame:
    """Rows of df whose doc_id is among ids (doc_id), or isn't (left_anti). Texts are shuffled only if the ids are many."""
    return df.join(small(keep(ids.select("doc_id").distinct()), most), "doc_id", how).select(*df.columns)


def bitmap(ids: DataFrame, column: str, bits: int = 27) -> np.ndarray:
    """A filter of fixed size (16 MB) for well-mixed longs: a bit is set for each by its lower bits. What isn't in it isn't
    among ids; of much larger sets it lets more through, and nothing depends on it but the rows that are moved."""
    h = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    words = ids.select(F.shiftright(h, 6).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast(`{column}` & 63 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    got = words.toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[got["w"].to_numpy()] = got["b"].to_numpy()
    return out


def maybe_in(df: DataFrame, column: str, bits: np.ndarray) -> DataFrame:
    """Rows of df that the bitmap lets through."""
    shared, mask = df.sparkSession.sparkContext.broadcast(bits), (len(bits) << 6) - 1

    def run(pdfs):
        b = shared.value
        for x in pdfs:
            h = x[column].to_numpy() & mask
            yield x[(b[h >> 6] >> (h & 63)) & 1 == 1]

    return df.mapInPandas(run, df.schema)


class WordHashes(dict):
    """Word -> 64-bit hash; a bounded memo."""

    def __init__(self, most: int = 100_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.most:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


_MEMO = WordHashes()


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of a text's words: A-Z lower-cased, cut at space and \\t..\\r; none for null."""
    return _MEMO.of(text.encode(errors="replace").lower().split()) if isinstance(text, str) else np.empty(0, dtype=np.uint64)


M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (vectorised; wraps around)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(32)
    return x


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all windows of k words (all words as one where there are fewer)."""
    if not len(h):
        return h
    k = min(k, len(h))
    n = len(h) - k + 1
    acc = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        acc = mix(acc * M1 + h[i : i + n] + M2)
    return acc


#: Edges of which one task holds a forest at a time.
EDGES = 200_000


def _forests(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges, so many at a time, as stars of the same components: each node on the smallest one."""
    up: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while up.setdefault(root, root) != root:
            root = up[root]
        while up[x] != root:
            up[x], x = root, up[x]
        return root

    def stars() -> pd.DataFrame:
        out = [(x, find(x)) for x in list(up)]
        up.clear()
        return pd.DataFrame([p for p in out if p[0] != p[1]], columns=["a", "b"], dtype="int64")

    seen = 0
    for part in pdfs:
        for x, y in zip(part["a"].tolist(), part["b"].tolist(), strict=True):
            x, y = find(x), find(y)
            if x != y:
                up[max(x, y)] = min(x, y)
        seen += len(part)
        if seen >= EDGES:
            yield stars()
            seen = 0
    yield stars()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of edges (a long, b long): rows (id, comp), comp the smallest id reachable.

    Each task first makes stars of the edges that it holds, a bounded number at a time; partitions are as many as their
    count asks for. Then alternating large-star and small-star steps, all on DataFrames: neighbourhoods are reduced by min
    with map-side combination and never gathered in one place. Each round's edges are a table of their own; they have
    settled when every node hangs on one node that hangs on none, which a graph of a single task's edges has at once.
    """
    pairs = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")
    with Scratch(edges.sparkSession) as s:
        raw = s.store(pairs)
        now = s.store(raw.coalesce(max(1, -(-raw.count() // EDGES))).mapInPandas(_forests, "a long, b long"))
        s.drop(raw)
        for _ in range(most_rounds):
            ends = now.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(now.select(F.col("b").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
            if ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").isEmpty():
                break
            both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
            low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
            large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
            low = large.groupBy("a").agg(F.min("b").alias("m"))
            small_star = (
                large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                .unionByName(low.select("a", F.col("m").alias("b")))
                .where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
            )
            last, now = now, s.store(small_star)
            s.drop(last)
        else:
            raise RuntimeError("components did not settle")
        return s.keep(now.select(F.col("a").alias("id"), F.col("b").alias("comp")).unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("comp")).distinct()))
