"""Entity resolution from mentions to entities: blocks, features, average linkage, merging of blocks, ids, finalize."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.operators import clustering, scoring
from kinfold.sources import registry


@dataclass(frozen=True)
class Settings:
    """What a run is configured by. `least` is the similarity from which clusters merge, `penalty` the score of a forbidden link."""

    features: tuple[scoring.Feature, ...]
    least: float
    output: str | None = None
    start: dt.date | None = None
    end: dt.date | None = None
    penalty: float = -20000.0
    matrix_rows: int = 24_000
    columns: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "columns", tuple(dict.fromkeys(f.column for f in self.features)))
        if self.start is not None and self.end is None:
            raise ValueError("a start needs an end")

    @property
    def cut(self) -> float:
        """The height that the dendrogram is cut at."""
        return 1 / (1 + max(self.least, self.penalty) - min(self.penalty, 0.0))

    @property
    def copies(self) -> bool:
        """Whether no feature can hold a mention nearer to another one than to a copy of itself."""
        best = {"cosine": lambda f: f.weight >= 0 and not f.must_not, "shared": lambda f: f.weight >= 0 and not f.must_not, "no_match": lambda f: f.must_not or f.weight <= 0}
        return self.penalty <= 0 and all(f.kind in best and best[f.kind](f) for f in self.features)

    def path(self, step: str) -> str:
        """<output>/<end as yyyymmdd or all>/<step>"""
        if self.output is None:
            raise ValueError("no output folder is configured")
        return f"{self.output}/{self.end:%Y%m%d}/{step}" if self.end else f"{self.output}/all/{step}"


#: Similarities from which the three kinds of entity merge.
LEAST = {"inventor": 0.443, "assignee": 0.85, "location": 1 / (0.5 + 1e-5) - 1}


def _matrix(f: scoring.Feature, left: pd.DataFrame, right: pd.DataFrame) -> np.ndarray:
    """The feature's values of each row of left with each of right, as scoring.Feature.value of a pair."""
    a, b = left[f.column], right[f.column]
    if f.kind in ("dot", "cosine"):
        x, y = (np.stack(c.to_list()).astype(np.float64) for c in (a, b))
        out = x @ y.T
        if f.kind == "cosine":
            size = np.sqrt((x * x).sum(1))[:, None] * np.sqrt((y * y).sum(1))[None]
            out = np.divide(out, size, out=np.zeros_like(out), where=size > 0)
        return out
    if f.kind == "no_match":
        code = pd.factorize(pd.concat([a, b]))[0]  # missing values are -1
        x, y = code[: len(a), None], code[None, len(a) :]
        return ((x != y) & (x >= 0) & (y >= 0)).astype(np.float64)
    if f.kind == "shared":
        sets = [set(() if v is None else v) for v in (*a, *b)]
        number = {v: k for k, v in enumerate(set().union(*sets))}
        held = np.zeros((len(sets), max(1, len(number))))
        for i, own in enumerate(sets):
            held[i, [number[v] for v in own]] = 1
        return held[: len(a)] @ held[len(a) :].T
    raise ValueError(f"no feature is called {f.kind}")


def distances(settings: Settings) -> Callable[[pd.DataFrame, pd.DataFrame], np.ndarray]:
    """Distances of two frames' rows: as scoring.distance of scoring.score."""

    def between(left: pd.DataFrame, right: pd.DataFrame) -> np.ndarray:
        total = np.zeros((len(left), len(right)))
        for f in settings.features:
            value = _matrix(f, left, right)
            total += np.where(value > 0, settings.penalty, 0.0) if f.must_not else f.weight * value
        return 1 / (1 + np.maximum(total, settings.penalty) - min(settings.penalty, 0.0))

    return between


def clusters(blocked: DataFrame, settings: Settings, block: str = "block", key: str = "mention") -> DataFrame:
    """block, key, label: average linkage within each block."""
    cross = distances(settings)
    return clustering.cluster_blocks(blocked, block, key, list(settings.columns), lambda held: cross(held, held), settings.cut, settings.matrix_rows, cross, settings.copies)


def entities(labels: DataFrame, key: str = "mention") -> DataFrame:
    """key, entity: clusters of different blocks that share a mention are one entity, named by its smallest mention."""
    first = labels.groupBy("block", "label").agg(F.min(key).alias("b"))
    held = clustering.cut(labels.join(first, ["block", "label"]).select(key, "b"))  # clusters by their smallest mention
    low = held.groupBy(key).agg(F.min("b").alias("low"), F.max("b").alias("high"))
    edges = held.join(low.filter("low != high").select(key, "low"), key).filter("b != low").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
    roots = clustering.components(edges)
    return low.join(roots.select(F.col("node").alias("low"), "root"), "low", "left").select(key, F.coalesce("root", "low").alias("entity"))


def finalized(mentions: DataFrame, found: DataFrame, key: str = "mention") -> DataFrame:
    """key, entity of every mention: one without a cluster is its own entity."""
    return mentions.select(key).distinct().join(found, key, "left").select(key, F.coalesce("entity", key).alias("entity"))


def resolve(mentions: DataFrame, blocks: DataFrame, settings: Settings, key: str = "mention", date: str | None = None) -> DataFrame:
    """key, entity of every mention (key and the features' columns); blocks: block, key, a mention being in any number of blocks.

    With a date column and dates in the settings, only mentions of these dates are resolved.
    """
    rows = registry.dated(mentions, date, settings.end, settings.start) if date else mentions
    blocked = blocks.select("block", key).distinct().join(rows.select(key, *settings.columns), key)
    return finalized(rows, entities(clusters(blocked, settings, key=key), key), key)


def inserted(kept: DataFrame, mentions: DataFrame, blocks: DataFrame, settings: Settings, key: str = "mention") -> DataFrame:
    """As resolve, for mentions of which `kept` (block, key, label) has clustered some before.

    Only blocks that hold a mention which isn't kept are clustered again; the labels of all others stay.
    """
    blocks = blocks.select("block", key).distinct()
    touched = blocks.join(kept, ["block", key], "left_anti").select("block").distinct()
    blocked = blocks.join(touched, "block", "left_semi").join(mentions.select(key, *settings.columns), key)
    labels = kept.join(touched, "block", "left_anti").select("block", key, "label").unionByName(clusters(blocked, settings, key=key))
    return finalized(mentions, entities(labels, key), key)


def structure(rows: DataFrame, columns: set[str], without_spaces: tuple[str, ...] = ()) -> DataFrame:
    """problem, n: missing columns, an empty table, and values that hold white space in columns which must not."""
    spark = rows.sparkSession
    missing = spark.createDataFrame([(f"missing {c}", 1) for c in sorted(columns - {*rows.columns})], "problem string, n long")
    spaces = [F.count_if(F.col(c).rlike(r"\s")).alias(f"white space in {c}") for c in without_spaces if c in rows.columns]
    counts = rows.agg(F.count_if(F.lit(True)).alias("rows"), *spaces)
    empty = counts.filter("rows = 0").select(F.lit("empty").alias("problem"), F.lit(1).cast("long").alias("n"))
    out = missing.unionByName(empty)
    for c in counts.columns[1:]:
        out = out.unionByName(counts.select(F.lit(c).alias("problem"), F.col(f"`{c}`").alias("n")).filter("n > 0"))
    return out


def enough_files(rows: DataFrame, least: int) -> bool:
    """Whether a result was written to at least so many files."""
    return len(rows.inputFiles()) >= least
