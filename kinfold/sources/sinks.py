"""Sinks: tables and files of entities, mappings and cluster state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table(df: DataFrame, path: str, partition: list[str] | None = None, mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition) if partition else writer).parquet(path)


def mapping_file(df: DataFrame, path: str, mention: str = "mention", entity: str = "entity") -> None:
    """mention, tab, entity, without a header."""
    df.select(mention, entity).write.mode("overwrite").csv(path, sep="\t", header=False, quote="")


def database(df: DataFrame, url: str, name: str, options: dict[str, str] | None = None, mode: str = "overwrite", batch: int = 100_000) -> None:
    df.write.format("jdbc").option("url", url).option("dbtable", name).option("batchsize", batch).options(**(options or {})).mode(mode).save()


def bucketed(df: DataFrame, name: str, keys: list[str], buckets: int) -> None:
    """A table whose later joins on the keys need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def unique_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once: a primary key holds if there are none."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def small_merges(log: DataFrame, path: str, below: int = 50) -> None:
    """Appends the merges of few elements to the log of dendrograms: CSV without a header, lists of keys as JSON."""
    plain = [F.to_json(f.name).alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name) for f in log.schema.fields]
    log.filter(F.col("elements") < below).select(*plain).write.mode("append").csv(path, escape='"')
