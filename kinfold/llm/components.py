"""Connected components of an edge table: by alternating stars, as joins and aggregations, or of few edges in one task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm.common import BROADCAST_ROWS, cut

#: A node of more edges is a hub: its edges are joined where they are, to a broadcast row for each hub.
HUB = 500
#: So many edges (3 MB) are joined in one task, which is sooner done than a round of stars; more are never gathered.
FEW = 200_000


def _stamp(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.when(F.col("a") < F.col("b"), 1).otherwise(0))).first()
    return tuple(row)


def with_least(rows: DataFrame, among: DataFrame, least: Column, count: int) -> DataFrame:
    """rows (with a column a) with m, the aggregate `least` of `among` by a.

    There are at most among's rows / HUB hubs, which `count` bounds; where even these are too many to broadcast,
    all rows are joined by a shuffle.
    """
    found = among.groupBy("a").agg(least.alias("m"), F.count(F.lit(1)).alias("n"))
    if count // HUB > BROADCAST_ROWS:
        return rows.join(found.drop("n"), "a")
    hubs = found.filter(F.col("n") > HUB).select("a", F.col("m").alias("hub"))
    rows = rows.join(F.broadcast(hubs), "a", "left")
    few = rows.filter("hub IS NULL").drop("hub").join(found.filter(F.col("n") <= HUB).drop("n"), "a")
    return few.unionByName(rows.filter("hub IS NOT NULL").withColumnRenamed("hub", "m"))


def _large(edges: DataFrame, count: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    joined = with_least(both.filter("b > a"), both, F.least(F.first("a"), F.min("b")), 2 * count)
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame, count: int) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b")
    to = with_least(down, down, F.min("b"), count).filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return to.unionByName(down.groupBy("a").agg(F.min("b").alias("b"))).distinct()


def _few(edges: DataFrame) -> DataFrame:
    """node, root of at most FEW edges."""

    def join(batches):
        held = [np.stack([b.column("a").to_numpy(), b.column("b").to_numpy()]) for b in batches if b.num_rows]
        if not held:
            return
        ends = np.concatenate(held, axis=1)
        names, at = np.unique(ends, return_inverse=True)
        up = list(range(len(names)))

        def top(x: int) -> int:
            while up[x] != x:
                up[x] = x = up[up[x]]
            return x

        for x, y in zip(*at.reshape(ends.shape).tolist(), strict=True):
            x, y = top(x), top(y)
            up[max(x, y)] = min(x, y)
        root = np.fromiter((top(x) for x in range(len(up))), np.int64, len(up))
        own = np.flatnonzero(root != np.arange(len(root)))
        yield pa.RecordBatch.from_arrays([pa.array(names[own]), pa.array(names[root[own]])], names=["node", "root"])

    return edges.repartition(1).mapInArrow(join, "node long, root long")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Columns node, root: every node of edges (columns a, b) that isn't its component's smallest, with that smallest.

    Self links and repeated links have no effect; of no edges the result is empty. Each round is checkpointed; the
    driver sees counts only. No node's edges have to meet in one task, unless there are at most FEW edges in all.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct())
    if now.count() <= FEW:
        return cut(_few(now))
    seen = _stamp(now)
    for _ in range(rounds):
        now = cut(_small(_large(now, seen[0]), seen[0]))
        stamp = _stamp(now)
        if stamp == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = stamp
    raise RuntimeError(f"components did not settle in {rounds} rounds")
