"""Relational patterns that the pipelines share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


#: Rows of a task where `tasks` says how many there are.
TASK_ROWS = 400_000


def tasks(rows: int, spark: SparkSession) -> int:
    """The number of tasks that so many rows are dealt to, so that a task's share doesn't grow with the table."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def first_by(rows: DataFrame, keys: list[str], *order: Column, n: int = 1) -> DataFrame:
    """The first n rows of each key in a total order."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_r") <= n).drop("_r")


def override(base: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of new, and of base where new lacks the key."""
    return new.unionByName(base.join(new.select(key).distinct(), key, "left_anti"))


def touched(old: DataFrame, new: DataFrame, block: str) -> DataFrame:
    """New rows with the old rows of their blocks only."""
    return new.unionByName(old.join(new.select(block).distinct(), block, "left_semi"))


def sized(rows: DataFrame, block: str, low: int = 1, high: int | None = None) -> DataFrame:
    """Rows of blocks of low to high rows; the blocks are counted by a partial aggregation, so a hot one costs no task."""
    sizes = rows.groupBy(block).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= low)
    if high is not None:
        sizes = sizes.filter(F.col("_n") <= high)
    return rows.join(sizes, block).drop("_n")


def mode(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The most frequent value of each key, the smallest of equals."""
    counts = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(value).alias("v"))).alias("_b"))
    return best.select(*keys, F.col("_b.v").alias(value), (-F.col("_b.n")).alias("n"))


def rollup(rows: DataFrame, key: str, sets: dict[str, str], name: str) -> DataFrame:
    """A group for each key: sorted sets of columns, and each exact name with its count."""
    names = rows.groupBy(key, name).agg(F.count(F.lit(1)).alias("n")).groupBy(key)
    names = names.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(name, "n")))).alias("names"))
    out = rows.groupBy(key).agg(*[F.sort_array(F.collect_set(c)).alias(a) for a, c in sets.items()])
    return out.join(names, key).join(mode(rows, [key], name).select(key, F.col(name).alias("top_name")), key)


def described(rows: DataFrame, value: str) -> DataFrame:
    v = F.col(value)
    parts = {"n": F.count(v), "mean": F.avg(v), "std": F.stddev_samp(v), "least": F.min(v), "most": F.max(v)}
    parts |= {f"p{q}": F.percentile(v, F.lit(q / 100)) for q in (25, 50, 75)}
    return rows.agg(*[e.alias(k) for k, e in parts.items()])


def right_closed_bin(value: Column, width: float) -> Column:
    """Number of the bin (k - 1) * width < value <= k * width."""
    return F.ceil(value / width).cast("long")


def routed(rows: DataFrame, first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Adds target: 'first' for keys of first, else 'second' for keys of second, else null."""
    a = first.select(F.col(key).alias("_a")).distinct()
    b = second.select(F.col(key).alias("_b")).distinct()
    out = rows.join(a, F.col(key) == F.col("_a"), "left").join(b, F.col(key) == F.col("_b"), "left")
    return out.withColumn("target", F.when(F.col("_a").isNotNull(), "first").when(F.col("_b").isNotNull(), "second")).drop("_a", "_b")


def cascade(rows: DataFrame, table: DataFrame, key: str, value: str, probes: list[Column]) -> DataFrame:
    """Adds value: that of the first probe which the table knows (of a repeated key the least value); null if none."""
    out, table = rows, table.groupBy(key).agg(F.min(value).alias(value))
    for i, probe in enumerate(probes):
        side = table.select(F.col(key).alias(f"_k{i}"), F.col(value).alias(f"_v{i}"))
        out = out.withColumn(f"_p{i}", probe).join(side, F.col(f"_p{i}") == F.col(f"_k{i}"), "left")
    n = range(len(probes))
    return out.withColumn(value, F.coalesce(*[F.col(f"_v{i}") for i in n])).drop(*[f"_{x}{i}" for i in n for x in "pkv"])


def ranged(rows: DataFrame, *order: Column, value: Column | None = None) -> DataFrame:
    """Adds `running`: the running sum of value (1 for each row) in a total order.

    Rows are sorted in ranges; each range adds up its own, and only one row for each range is added up across them.
    """
    value = F.lit(1).cast("long") if value is None else value
    held = rows.withColumn("_v", value).repartitionByRange(*order).withColumn("_p", F.spark_partition_id())
    sums = held.groupBy("_p").agg(F.sum("_v").alias("_s"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("_p", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_b"))
    own = Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = held.withColumn("_r", F.sum("_v").over(own)).join(F.broadcast(base), "_p")
    return out.withColumn("running", F.col("_b") + F.col("_r")).drop("_v", "_p", "_r", "_b")


def round_robin(sizes: DataFrame, block: str, size: str, chunks: int) -> DataFrame:
    """Adds chunk: blocks dealt in turn, the largest first."""
    ranked = ranged(sizes, F.col(size).desc(), F.col(block).desc())
    return ranked.withColumn("chunk", (F.col("running") - 1) % chunks).drop("running")


def batches(sizes: DataFrame, group: str, order: str, size: str, least: int) -> DataFrame:
    """Adds batch: within a group, a new batch begins once the running size of the last reached `least`.

    Every number depends on all before it, so a group is one task's work; it passes through as a sorted stream of
    Arrow batches and is never held. A null size counts as 0.
    """
    kinds = {f.name: f.dataType.simpleString() for f in sizes.schema.fields}
    columns = [group, order, size]

    def run(batches):
        last, total, number = None, 0, 0
        for held in batches:
            numbers = []
            for g, n in zip(held.column(group).to_pylist(), held.column(size).to_pylist(), strict=True):
                if g != last:
                    last, total, number = g, 0, 0
                numbers.append(number)
                total += n or 0
                if total >= least:
                    total, number = 0, number + 1
            yield pa.RecordBatch.from_arrays([*held.columns, pa.array(numbers, pa.int32())], names=[*columns, "batch"])

    rows = sizes.select(*columns).repartition(group).sortWithinPartitions(group, order, size)
    return rows.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", batch int")


def contained(rows: DataFrame, database: DataFrame, columns: tuple[str, ...] = ("city", "state", "country"), name: str = "known") -> DataFrame:
    """Adds `name`: whether the database has a row that equals this one in all the columns; nulls equal each other."""
    held = database.select(*[F.col(c).alias(f"_db_{c}") for c in columns]).distinct().withColumn("_db", F.lit(True))
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_db_{c}"))
    return rows.join(held, same, "left").withColumn(name, F.col("_db").isNotNull()).drop("_db", *[f"_db_{c}" for c in columns])
