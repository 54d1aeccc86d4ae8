"""Mentions as a stream: windowed counts of blocks with late rows, and blocks touched by each micro-batch."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def counts(stream: DataFrame, time: str, block: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """canopy, hour, n: windowed counts; rows later than the watermark no longer change a window."""
    rows = stream.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late)
    return rows.groupBy(F.col(block).alias("canopy"), F.window("_t", window).alias("w")).agg(F.count(F.lit(1)).alias("n")).select("canopy", F.col("w.start").alias("hour"), "n")


def once(stream: DataFrame, time: str, key: str, late: str = "2 hours") -> DataFrame:
    """The rows without repeated deliveries: of rows of one key that arrive within `late` of each other the first stays."""
    rows = stream.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late)
    return rows.dropDuplicatesWithinWatermark([key]).drop("_t")


def sessions(stream: DataFrame, time: str, block: str, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """canopy, start, end, n: counts of runs of rows of a block that follow each other within the gap."""
    rows = stream.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late)
    found = rows.groupBy(F.col(block).alias("canopy"), F.session_window("_t", gap).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return found.select("canopy", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def block_state(stream: DataFrame, block: str, key: str) -> DataFrame:
    """canopy, n, first: how many mentions each block has had so far and the smallest of their (long) keys, in update mode.

    The state of a block is these two numbers, whatever its size.
    """

    def step(name, frames, state):
        n, first = state.get if state.exists else (0, 2**63 - 1)
        for held in frames:
            n, first = n + len(held), min(first, int(held["key"].min()))
        state.update((n, first))
        yield pd.DataFrame({"canopy": [name[0]], "n": [n], "first": [first]})

    rows = stream.select(F.col(block).cast("string").alias("canopy"), F.col(key).cast("long").alias("key")).filter("key IS NOT NULL")
    return rows.groupBy("canopy").applyInPandasWithState(step, "canopy string, n long, first long", "n long, first long", "update", "NoTimeout")


def latest(spark: SparkSession, target: str, block: str) -> DataFrame:
    """The newest result of each block among the versions that `incremental` has written to the target."""
    rows = spark.read.parquet(target)
    newest = rows.groupBy(block).agg(F.max("batch").alias("batch"))
    return rows.join(newest, [block, "batch"], "left_semi").drop("batch")


def shared_folder(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_streams"
    return f"{base}/{uuid.uuid4().hex}"


def replayed_counts(spark: SparkSession, path: str, time: str = "ts", block: str = "event_type") -> DataFrame:
    """The final state of `counts` after all files of the path: the stream is read to its end, once."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    # a path may be one file or a folder of files
    source = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
    stream = source.parquet(f"{folder}/{name[:-1]}[{name[-1]}]")
    out, state = shared_folder(spark), shared_folder(spark)

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/{number}")

    rows = stream.select(time, block)
    done = counts(rows, time, block, late="36500 days").writeStream.outputMode("complete").option("checkpointLocation", state).foreachBatch(put).trigger(availableNow=True).start()
    done.awaitTermination()
    last = done.lastProgress["batchId"] if done.lastProgress else 0
    return spark.read.parquet(f"{out}/{last}").withColumn("hour", F.col("hour").cast("timestamp_ntz"))


def incremental(stream: DataFrame, state: str, block: str, resolve: Callable[[DataFrame], DataFrame], target: str, checkpoint: str):
    """Starts a query that resolves anew only the blocks each micro-batch touches.

    state and target are folders of tables partitioned by batch; a batch that is replayed overwrites its own part.
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        try:
            old = spark.read.parquet(state).filter(F.col("batch") != number).drop("batch")
        except Exception as e:  # the first batch finds no table
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            old = batch.limit(0)
        held = batch.unionByName(old.join(batch.select(block).distinct(), block, "left_semi"))
        resolve(held).write.mode("overwrite").parquet(f"{target}/batch={number}")
        batch.write.mode("overwrite").parquet(f"{state}/batch={number}")

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step).trigger(availableNow=True).start()
