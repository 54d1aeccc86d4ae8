"""Embedding near-dedup by Euclidean p-stable hashing with exact cosine checks.

Normalised vectors are projected on Gaussian directions, shifted and quantised in steps of WIDTH; the
PROJECTIONS numbers of a table, with label and dimension, name a bucket. Vectors of cosine >= 0.98 lie
within 0.2 of each other, share a step with probability 0.90 and so one of the TABLES buckets with
probability 1 - (1 - 0.9 ** 8) ** 20 > 0.99998. All pairs of a bucket are then compared exactly, in double
precision, each in the first bucket that it shares. Equal vectors are one representative with a
count. Large buckets are dealt out as pairs of blocks; a block returns counts and a forest of links,
never its pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm import words
from kinfold.llm.common import NO_ID, cut, partitions, real_id
from kinfold.llm.components import components
from kinfold.llm.minhash_join import _groups, _linked

TABLES, PROJECTIONS, WIDTH, BLOCK = 20, 8, 1.6, 512


def buckets(vectors: DataFrame, tables: int = TABLES) -> DataFrame:
    """vec_id, names array<long>: each vector's bucket in each table."""

    def hashed(batches):
        planes: dict[int, tuple] = {}
        for batch in batches:
            ids = batch.column("vec_id")
            size = batch.column("dim").to_numpy()
            label = batch.column("label").to_numpy()
            lists = batch.column("embedding")
            at = np.concatenate(([0], np.cumsum(size)))
            flat = lists.flatten().to_numpy().astype(np.float64)
            names = np.zeros((len(size), tables), np.uint64)
            for dim in np.unique(size).tolist():
                if dim not in planes:
                    rng = np.random.default_rng([7, dim])
                    planes[dim] = rng.normal(size=(dim, tables * PROJECTIONS)), rng.uniform(0, WIDTH, tables * PROJECTIONS)
                rows = np.flatnonzero(size == dim)
                v = flat[at[rows][:, None] + np.arange(dim)]
                v = v / np.abs(v).max(1, keepdims=True)
                v /= np.linalg.norm(v, axis=1, keepdims=True)
                steps = np.floor((v @ planes[dim][0] + planes[dim][1]) / WIDTH).astype(np.int64).view(np.uint64).reshape(len(rows), tables, PROJECTIONS)
                name = words.mix(label[rows].astype(np.int64).view(np.uint64) * np.uint64(31) + np.uint64(dim))[:, None] + np.arange(tables, dtype=np.uint64)
                for k in range(PROJECTIONS):
                    name = words.mix(name + steps[:, :, k] + np.uint64(k + 1))
                names[rows] = name
            ends = pa.array(np.arange(0, names.size + 1, tables, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(ends, pa.array(names.view(np.int64).reshape(-1)))], names=["vec_id", "names"])

    return vectors.mapInArrow(hashed, "vec_id long, names array<long>")


def _compare(rows: DataFrame, keys: list[str], least: float) -> DataFrame:
    """vec_id, links, to: links counted with copies, and for the forest one linked vector or null."""

    def compare(batches):
        for held, group in _groups(batches, keys):
            ids, copies = held.column("vec_id").to_numpy(), held.column("copies").to_numpy()
            own, table = held.column("own").to_numpy(), held.column("t").to_numpy()
            apart = held.column("x").to_numpy() != held.column("y").to_numpy()
            at = np.concatenate(([0], np.cumsum(held.column("dim").to_numpy())))
            flat = held.column("embedding").combine_chunks().flatten().to_numpy().astype(np.float64)
            names = held.column("names").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
            ends = np.append(np.flatnonzero(np.diff(group)) + 1, len(ids))
            out: list[list] = [[], [], []]
            for lo, hi in zip(np.concatenate(([0], ends[:-1])).tolist(), ends.tolist(), strict=True):
                if hi - lo < 2:
                    continue
                v = flat[at[lo] : at[hi]].reshape(hi - lo, -1)
                v = v / np.abs(v).max(1, keepdims=True)
                norm = np.sqrt(np.einsum("ij,ij->i", v, v))
                linked = (v @ v.T) / (norm[:, None] * norm[None, :]) >= least
                np.fill_diagonal(linked, False)
                if apart[lo]:
                    linked &= own[lo:hi, None] != own[None, lo:hi]
                if not linked.any():
                    continue
                first = linked.copy()
                p, q = np.nonzero(linked)
                t = int(table[lo])
                if t:
                    for part in np.array_split(np.arange(len(p)), len(p) // 100_000 + 1):
                        seen = (names[lo + p[part], :t] == names[lo + q[part], :t]).any(1)
                        first[p[part[seen]], q[part[seen]]] = False
                count = first.astype(np.int64) @ copies[lo:hi]
                a, b = _linked(ids[lo:hi], lambda i, others, linked=linked: linked[i, others])
                to = dict(zip(a, b, strict=True))
                for i in np.flatnonzero((count > 0) | np.isin(ids[lo:hi], a)).tolist():
                    out[0].append(int(ids[lo + i]))
                    out[1].append(int(count[i]))
                    out[2].append(to.get(int(ids[lo + i])))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["vec_id", "links", "to"])

    rows = rows.repartition(partitions(rows), *keys).sortWithinPartitions(*keys)
    return rows.mapInArrow(compare, "vec_id long, links long, to long")


def linked_vectors(table: DataFrame, least: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row: links join rows of equal labels and cosine >= least.

    A row whose label or vector is null, or whose vector is empty, zero or holds a null or non-finite
    component, links with nothing; so do vectors of different lengths. A null vec_id counts as the
    smallest; rows that repeat a vec_id with one vector count as links of each other. Other columns are ignored.
    """
    rows = table.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    valid = rows.filter(good)
    owners = cut(valid.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")))
    reps = owners.select(F.col("rep").alias("vec_id"), "label", "embedding", "copies", F.size("embedding").alias("dim"))
    named = cut(buckets(reps.select("vec_id", "label", "embedding", "dim")))

    posted = named.select("vec_id", F.posexplode("names").alias("t", "name"))
    met = posted.join(posted.groupBy("t", "name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), ["t", "name"])
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    met = met.withColumn("own", F.pmod(F.xxhash64("vec_id"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    met = met.select("vec_id", "t", "name", "own", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))
    met = met.join(named, "vec_id").join(reps.drop("label"), "vec_id")
    found = cut(_compare(met, ["t", "name", "x", "y"], least))
    degree = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    roots = components(found.filter("to IS NOT NULL").select(F.col("vec_id").alias("a"), F.col("to").alias("b")))

    member = valid.join(owners, ["label", "embedding"]).select("vec_id", "rep", "copies")
    member = member.join(degree.withColumnRenamed("vec_id", "rep"), "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    member = member.select("vec_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    alone = rows.filter(F.coalesce(~good, F.lit(True))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = member.unionByName(alone)
    return out.select(real_id("vec_id"), "n_links", real_id("component_id"), (F.col("vec_id") == F.col("component_id")).alias("kept"))
