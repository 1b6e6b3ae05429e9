"""Files that jobs exchange: links, statements, identifiers, invalid identifiers, word lists, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkforge.schema import CURATION_ENTRY, LINKS, STATEMENTS


def read_links(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LINKS).csv(path)


def write_links(df: DataFrame, path: str) -> None:
    df.select("qid", "tid", "confidence").write.mode("overwrite").csv(path, compression="gzip")


def write_baseline(df: DataFrame, path: str, pid: str) -> None:
    df.select("qid", F.lit(pid).alias("pid"), "tid").write.mode("overwrite").csv(path)


def read_statements(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATEMENTS).csv(path)


def write_statements(df: DataFrame, path: str) -> None:
    df.select("subject", "predicate", "value", "tid").write.mode("overwrite").csv(path)


def read_identifiers(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object {qid: tid} to rows."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,string>").alias("m"))
    return raw.select(F.explode("m").alias("qid", "tid"))


def read_invalid(spark: SparkSession, path: str) -> DataFrame:
    """{tid: [qids]}, or lines of (tid, qids), to rows (tid, qid)."""
    return spark.read.schema("tid string, qids array<string>").json(path).select("tid", F.explode("qids").alias("qid"))


def write_invalid(df: DataFrame, path: str) -> None:
    """(tid, qid) rows as lines of (tid, qids)."""
    df.groupBy("tid").agg(F.array_sort(F.collect_set("qid")).alias("qids")).write.mode("overwrite").json(path)


def write_report(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").json(path)


def write_predictions(df: DataFrame, path: str) -> None:
    """Out-of-fold predictions beside a report: qid, tid, label, fold, confidence."""
    df.select("qid", "tid", "label", "fold", "confidence").write.mode("overwrite").csv(path, compression="gzip", header=True)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("qid string, tid string, label int, fold int, confidence double").csv(path, header=True)


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """Entries of the curation game as they stand, as JSON lines."""
    return spark.read.schema(CURATION_ENTRY).json(path)


def read_reports(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Reports by model name in one table, with the column model."""
    out = None
    for model, path in paths.items():
        part = spark.read.json(path).withColumn("model", F.lit(model))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def write_dataset(main: DataFrame, path: str) -> None:
    """A target table as JSON Lines."""
    main.write.mode("overwrite").json(path, compression="gzip")


def read_words(spark: SparkSession, path: str, most: int = 100_000) -> list[str]:
    """A list of words, one a line; empty lines are dropped. Its size is checked, as it becomes a literal."""
    rows = spark.read.text(path).where("trim(value) <> ''").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"over {most} words")
    return sorted({r["value"].strip() for r in rows})


def read_blacklist(spark: SparkSession, path: str, most: int = 100_000) -> list[str]:
    """Domains from a page that lists them: the texts of its li elements without tags, or one a line where it has none."""
    page = spark.read.text(path, wholetext=True).select(F.regexp_extract_all("value", F.lit(r"(?is)<li[^>]*>(.*?)</li>"), F.lit(1)).alias("v"))
    items = page.select(F.explode("v").alias("v")).select(F.trim(F.regexp_replace("v", r"(?s)<[^>]*>", "")).alias("v")).where("v <> ''").distinct().limit(most + 1).collect()
    if len(items) > most:
        raise ValueError(f"over {most} domains")
    return sorted(r["v"] for r in items) or read_words(spark, path, most)


def keyed(df: DataFrame, path: str, key: str) -> DataFrame:
    """A stage's result as Parquet under a key of its parameters; read back if it is there already."""
    spark = df.sparkSession
    place = f"{path}/{key}"
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{place}/_SUCCESS")
    if not fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs_path):
        df.write.mode("overwrite").parquet(place)
    return spark.read.schema(df.schema).parquet(place)
