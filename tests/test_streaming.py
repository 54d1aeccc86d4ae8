import datetime as dt

from pyspark.sql import functions as F

from kinfold.operators import relational
from kinfold.streaming import canopies

SCHEMA = "ts timestamp, block string, id long"


def minute(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=n)


def stream_of(spark, folder, *files):
    """A stream that delivers the files one after the other."""
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{i}")
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*.parquet").parquet(str(folder))


def run(stream, tmp_path, mode):
    """The rows of each micro-batch, by its number."""
    out = str(tmp_path / "out")

    def put(batch, number):
        batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(out)

    stream.writeStream.outputMode(mode).option("checkpointLocation", str(tmp_path / "state")).foreachBatch(put).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.parquet(out)


def test_repeated_deliveries_are_dropped(spark, tmp_path):
    stream = stream_of(spark, tmp_path / "in", [(minute(0), "a", 1), (minute(0), "a", 1), (minute(1), "a", 2)], [(minute(5), "a", 1), (minute(6), "b", 3)])
    got = run(canopies.once(stream, "ts", "id"), tmp_path, "append")
    assert sorted(r["id"] for r in got.collect()) == [1, 2, 3]


def test_sessions(spark, tmp_path):
    stream = stream_of(spark, tmp_path / "in", [(minute(0), "a", 1), (minute(20), "a", 2), (minute(0), "b", 3)], [(minute(45), "a", 4), (minute(90), "a", 5)])
    got = run(canopies.sessions(stream, "ts", "block"), tmp_path, "complete")
    last = got.filter(F.col("batch") == got.agg(F.max("batch")).first()[0])
    assert sorted((r["canopy"], r["start"], r["n"]) for r in last.collect()) == [("a", minute(0), 3), ("a", minute(90), 1), ("b", minute(0), 1)]


def test_late_rows_do_not_change_closed_windows(spark, tmp_path):
    # late rows go by the watermark that held in the batch before: a window is closed for good a batch after it was passed
    stream = stream_of(spark, tmp_path / "in", [(minute(0), "a", 1)], [(minute(600), "a", 2)], [(minute(601), "a", 4)], [(minute(10), "a", 3)])
    got = run(canopies.counts(stream, "ts", "block"), tmp_path, "update")
    newest = got.groupBy("canopy", "hour").agg(F.max_by("n", "batch").alias("n"))
    assert sorted((r["hour"], r["n"]) for r in newest.collect()) == [(minute(0), 1), (minute(600), 2)]


def test_state_of_blocks(spark, tmp_path):
    stream = stream_of(spark, tmp_path / "in", [(minute(0), "a", 5), (minute(1), "b", 9)], [(minute(2), "a", 3), (minute(3), "a", 8), (minute(4), "a", None)])
    got = run(canopies.block_state(stream, "block", "id"), tmp_path, "update")
    newest = got.groupBy("canopy").agg(F.max_by(F.struct("n", "first"), "batch").alias("s")).select("canopy", "s.n", "s.first")
    assert sorted(map(tuple, newest.collect())) == [("a", 3, 3), ("b", 1, 9)]


def test_newest_result_of_each_block(spark, tmp_path):
    stream = stream_of(spark, tmp_path / "in", [(minute(0), "a", 5), (minute(1), "b", 9)], [(minute(2), "a", 3)])
    smallest = lambda rows: rows.groupBy("block").agg(F.min("id").alias("entity"), F.count(F.lit(1)).alias("n"))
    target = str(tmp_path / "target")
    canopies.incremental(stream, str(tmp_path / "kept"), "block", smallest, target, str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(target).count() == 3
    assert sorted(map(tuple, canopies.latest(spark, target, "block").collect())) == [("a", 3, 2), ("b", 9, 1)]


def test_batches_of_null_groups_and_many_arrow_batches(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        sizes = spark.createDataFrame([(g, i, n) for g in (None, 1, 2) for i, n in enumerate([3, 3, None, 5, 1, 1])], "g int, k int, n long")
        got = {(r["g"], r["k"]): r["batch"] for r in relational.batches(sizes, "g", "k", "n", 5).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == {(g, k): b for g in (None, 1, 2) for k, b in enumerate([0, 0, 1, 1, 2, 2])}


def test_contained(spark):
    rows = spark.createDataFrame([("x", None, "us"), ("x", "ca", "us"), ("y", "ca", "us")], "city string, state string, country string")
    database = spark.createDataFrame([("x", None, "us"), ("x", None, "us"), ("y", "ca", "us")], rows.schema)
    got = relational.contained(rows, database)
    assert got.columns == ["city", "state", "country", "known"]
    assert sorted((r["city"], r["known"]) for r in got.collect()) == [("x", False), ("x", True), ("y", True)]
