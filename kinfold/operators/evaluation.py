"""Evaluation and quality checks of a resolution."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pairwise(pred: DataFrame, gold: DataFrame, key: str, skip_missing: bool = True) -> DataFrame:
    """precision, recall, f1 over pairs, from counts of (predicted, gold) labels: no pair is made.

    pred and gold: key, label. Without skip_missing, gold keys that pred lacks are clusters of their own.
    """
    both = gold.select(key, F.col("label").alias("g")).join(pred.select(key, F.col("label").cast("string").alias("p")), key, "inner" if skip_missing else "left")
    both = both.withColumn("p", F.coalesce("p", F.concat(F.lit("missing "), F.col(key).cast("string"))))
    two = lambda c: F.sum(F.col(c) * (F.col(c) - 1) / 2)
    cells = both.groupBy("p", "g").agg(F.count(F.lit(1)).alias("n"))
    tp = cells.agg(two("n").alias("tp"))
    pp = cells.groupBy("p").agg(F.sum("n").alias("n")).agg(two("n").alias("pp"))
    gp = cells.groupBy("g").agg(F.sum("n").alias("n")).agg(two("n").alias("gp"))
    one = tp.join(pp, F.lit(True)).join(gp, F.lit(True))
    one = one.select(*[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("tp", "pp", "gp")])
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    one = one.select(share("tp", "pp").alias("precision"), share("tp", "gp").alias("recall"))
    total = F.col("precision") + F.col("recall")
    return one.withColumn("f1", F.when(total > 0, 2 * F.col("precision") * F.col("recall") / total).otherwise(0.0))


def crowded(rows: DataFrame, entity: str, record: str) -> DataFrame:
    """Entities that hold several mentions of one record."""
    return rows.groupBy(entity, record).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def bounds(rows: DataFrame, entity: str, least_rows: int, entities: tuple[int, int], largest: int) -> DataFrame:
    """One row of counts and whether each keeps its bound."""
    sizes = rows.groupBy(entity).agg(F.count(F.lit(1)).alias("n"))
    one = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_entities"), F.coalesce(F.max("n"), F.lit(0)).alias("largest"))
    return one.select("*", (F.col("n_rows") >= least_rows).alias("enough_rows"), F.col("n_entities").between(*entities).alias("entities_fit"), (F.col("largest") <= largest).alias("largest_fits"))


def assignment(cost: np.ndarray) -> np.ndarray:
    """The column of each row in an assignment of least total cost (rows <= columns), by shortest augmenting paths."""
    n, m = cost.shape
    u, v, owner, way = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        owner[0], j = i, 0
        least, seen = np.full(m + 1, np.inf), np.zeros(m + 1, bool)
        while owner[j]:
            seen[j] = True
            i0 = owner[j]
            reduced = cost[i0 - 1] - u[i0] - v[1:]
            better = ~seen[1:] & (reduced < least[1:])
            least[1:][better] = reduced[better]
            way[1:][better] = j
            free = np.where(seen, np.inf, least)
            free[0] = np.inf
            k = int(free.argmin())
            delta = free[k]
            u[owner[seen]] += delta
            v[seen] -= delta
            least[~seen] -= delta
            j = k
        while j:
            owner[j], j = owner[way[j]], way[j]
    out = np.zeros(n, int)
    for j in range(1, m + 1):
        if owner[j]:
            out[owner[j] - 1] = j - 1
    return out


def aligned(a: DataFrame, b: DataFrame, key: str, k: int = 100) -> DataFrame:
    """label_a, label_b, shared: the k largest clusters of a and of b, matched one to one for the most shared members."""
    top = lambda df, name: df.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").limit(k).select(F.col("label").alias(name))
    x, y = a.select(key, F.col("label").alias("label_a")), b.select(key, F.col("label").alias("label_b"))
    over = x.join(F.broadcast(top(a, "label_a")), "label_a").join(y.join(F.broadcast(top(b, "label_b")), "label_b"), key)
    over = over.groupBy("label_a", "label_b").agg(F.count(F.lit(1)).alias("shared")).withColumn("_g", F.lit(0))

    def match(held: pd.DataFrame) -> pd.DataFrame:  # at most k * k rows
        table = held.pivot(index="label_a", columns="label_b", values="shared").fillna(0).sort_index().sort_index(axis=1)
        flipped = table.shape[0] > table.shape[1]
        t = table.T if flipped else table
        pick = assignment(-t.to_numpy(float))
        out = [(t.index[i], t.columns[j], int(t.iat[i, j])) for i, j in enumerate(pick) if t.iat[i, j] > 0]
        return pd.DataFrame([(b_, a_, s) if flipped else (a_, b_, s) for a_, b_, s in out], columns=["label_a", "label_b", "shared"])

    kinds = {f.name: f.dataType.simpleString() for f in over.schema.fields}
    return over.groupBy("_g").applyInPandas(match, f"label_a {kinds['label_a']}, label_b {kinds['label_b']}, shared long")


def split(rows: DataFrame, block: str, entity: str, every: int = 5) -> DataFrame:
    """block, part: blocks that share an entity stay together, and of those groups every n-th goes to dev."""
    from kinfold.operators.clustering import components

    edges = rows.select(F.concat(F.lit("b"), F.col(block).cast("string")).alias("a"), F.concat(F.lit("e"), F.col(entity).cast("string")).alias("b")).distinct()
    groups = components(edges).filter(F.col("node").startswith("b"))
    number = F.conv(F.substring(F.md5(F.col("root").cast("binary")), 1, 8), 16, 10).cast("long")
    part = F.when(number % every == 0, "dev").otherwise("train")
    return groups.select(F.substring("node", 2, 1 << 20).alias(block), part.alias("part"))
