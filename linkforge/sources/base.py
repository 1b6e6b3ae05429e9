"""What a catalogue's reader gives: named tables, written as Parquet and read back with their explicit schemas."""

from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.sql import DataFrame, SparkSession


class CatalogReader(ABC):
    """Dump files to tables. A new catalogue is a subclass and its rows in schema.TARGETS."""

    catalog: str
    #: The dump's files by the names that read() knows, in its folder.
    files: dict[str, str] = {}

    @abstractmethod
    def read(self, spark: SparkSession, paths: dict[str, str], **options) -> dict[str, DataFrame]:
        """The tables by name; lazy."""

    def urls(self) -> list[str]:
        """Where the dumps are; only readers with an online adapter know."""
        return []

    def write(self, spark: SparkSession, paths: dict[str, str], out: str, **options) -> dict[str, DataFrame]:
        """A full refresh: every table is overwritten, clustered by its key so that later joins prune."""
        tables = self.read(spark, paths, **options)
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{out}/{name}")
        return {name: spark.read.schema(df.schema).parquet(f"{out}/{name}") for name, df in tables.items()}


    def counts(self, tables: dict[str, DataFrame]) -> dict[str, int]:
        """Rows of each table as written, for the log: Parquet knows them without reading rows."""
        return {name: df.count() for name, df in tables.items()}


#: Readers by catalogue; a new one joins by register().
READERS: dict[str, type[CatalogReader]] = {}


def register(reader: type[CatalogReader]) -> type[CatalogReader]:
    READERS[reader.catalog] = reader
    return reader


def gzip_aware(df: DataFrame, path: str, partitions: int | None = None) -> DataFrame:
    """A gzip file is one partition: spread its rows before what follows."""
    return df.repartition(partitions or df.sparkSession.sparkContext.defaultParallelism) if path.endswith(".gz") else df
