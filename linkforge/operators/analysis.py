"""Reports: hosts of URLs, distributions of confidence, performance of models, coverage."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkforge.functions.urls import host


def domains(urls: DataFrame, url: str = "url", least: int = 1, examples: int = 0) -> DataFrame:
    """Hosts with the number of their URLs, the most frequent first; examples: so many URLs, the smallest by hash.

    Examples are kept as a bounded heap per host, never as a list of all its URLs."""
    rows = urls.select(host(F.col(url)).alias("domain"), F.col(url).alias("url")).where("domain <> ''")
    counts = rows.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    if examples:
        from pyspark.sql import Window

        order = Window.partitionBy("domain").orderBy(F.md5("url"), "url")
        few = rows.distinct().withColumn("r", F.row_number().over(order)).where(F.col("r") <= examples).groupBy("domain").agg(F.array_sort(F.collect_list("url")).alias("examples"))
        counts = counts.join(few, "domain")
    return counts.orderBy(F.desc("n"), "domain")


def shares(rows: DataFrame, column: str) -> DataFrame:
    """Value, count and share of all rows."""
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    return counts.join(F.broadcast(total)).select(column, "n", (F.col("n") / F.col("total")).alias("share"))


def digests(rows: DataFrame, key: str, value: str, between: str = "|") -> DataFrame:
    """key, n and v: the number of its distinct values, and the md5 of them in order, joined by `between`; nulls don't count.

    A key may have more text than a row or a task's memory can hold: its values are sorted, which spills, and read in
    turn. They are in one task, as an md5 is by its nature computed from first to last.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, last, n, md5 = None, None, None, hashlib.md5()  # n: None before the first row
        done = lambda: pa.RecordBatch.from_pylist([{"key": key, "n": n, "v": md5.hexdigest()}], pa.schema([("key", pa.string()), ("n", pa.int64()), ("v", pa.string())]))
        for b in batches:
            for k, v in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if n is None or k != key:
                    if n is not None:
                        yield done()
                    key, last, n, md5 = k, None, 0, hashlib.md5()
                if v is not None and v != last:
                    md5.update((between + v if n else v).encode())
                    last, n = v, n + 1
        if n is not None:
            yield done()

    sorted_ = rows.select(F.col(key).cast("string").alias("key"), F.col(value).alias("value")).repartition("key").sortWithinPartitions("key", "value")
    return sorted_.mapInArrow(run, "key string, n long, v string").withColumnRenamed("key", key)


def means(results: DataFrame, by: list[str], metrics: tuple[str, ...] = ("precision", "recall", "f1")) -> DataFrame:
    return results.groupBy(*by).agg(*[F.avg(m).alias(m) for m in metrics])


def coverage(matches: DataFrame, unlinked: DataFrame, key: str) -> DataFrame:
    """Matches, and distinct matched keys, over the keys without a link."""
    m = matches.agg(F.count(F.lit(1)).alias("matches"), F.countDistinct(key).alias("distinct_matches"))
    u = unlinked.agg(F.count(F.lit(1)).alias("unlinked"))
    return m.join(F.broadcast(u)).select("matches", "distinct_matches", "unlinked", F.try_divide("matches", "unlinked").alias("coverage"), F.try_divide("distinct_matches", "unlinked").alias("distinct_coverage"))


def ratios(rows: DataFrame, parts: list[str], total: str) -> DataFrame:
    return rows.withColumns({f"{p}_ratio": F.try_divide(p, total) for p in parts})


def top(rows: DataFrame, column: str | Column, k: int, *ties: str) -> DataFrame:
    return rows.orderBy(F.desc(column), *ties).limit(k)


def sample(rows: DataFrame, key: str, share: float) -> DataFrame:
    """About that share of the rows, the same at every run: drawn by the key's hash."""
    return rows.where(F.pmod(F.xxhash64(key), F.lit(1_000_000)) < int(share * 1_000_000))


def name_date_key(label: Column, born: Column, died: Column) -> Column:
    """label|YYYY-YYYY in lower case."""
    return F.lower(F.concat_ws("|", label, F.concat_ws("-", F.date_format(born, "yyyy"), F.date_format(died, "yyyy"))))


def feature_sum(vectors: DataFrame, features: list[str], least: float) -> DataFrame:
    """The untrained score: the sum of the features, kept above a bound."""
    total = F.lit(0.0)
    for f in features:
        total = total + F.col(f)
    return vectors.withColumn("score", total).where(F.col("score") > least)
