"""Extension: linking of items that arrive as a stream against static tables, and windowed counts with late data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def match_names(items: DataFrame, target: DataFrame) -> DataFrame:
    """A stream of (qid, name) joined with static (tid, name) by equal names, whatever their case."""
    t = target.select("tid", F.lower("name").alias("key")).where("key is not null").distinct()
    return items.select("qid", F.lower("name").alias("key")).join(t, "key").select("qid", "tid")


def link_batches(items: DataFrame, link: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch goes through the batch linker and is written under its number, so that a batch that is run again
    after a failure overwrites itself."""

    def one(batch: DataFrame, n: int) -> None:
        link(batch).write.mode("overwrite").parquet(f"{out}/batch={n}")

    return items.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(events: DataFrame, late: str = "1 hour", window: str = "1 day", by: str = "event_type", time: str = "ts", value: str = "value") -> DataFrame:
    """Counts and sums per window and kind; rows later than `late` behind the newest are dropped by a stream."""
    return events.withWatermark(time, late).groupBy(F.window(time, window), by).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("window_start"), by, "n", "total")
