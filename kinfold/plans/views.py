"""Mention views over the driver's tables: people, organisations and places."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def names(spark: SparkSession, d: str) -> DataFrame:
    """Parts as people: two-word names."""
    w = F.split("p_name", " ")
    return t(spark, d, "part").select(F.col("p_partkey").cast("string").alias("uuid"), "p_partkey", "p_name", F.get(w, F.lit(0)).alias("first"), F.get(w, F.lit(1)).alias("last"))


def people(spark: SparkSession, d: str) -> DataFrame:
    """Order lines as person mentions."""
    line = t(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return line.join(names(spark, d).select("p_partkey", "p_name", "first", "last"), F.col("l_partkey") == F.col("p_partkey")).select(F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("uuid"), "l_orderkey", "l_linenumber", "p_name", "first", "last")


def owners(spark: SparkSession, d: str) -> DataFrame:
    """Orders as organisation mentions."""
    c = t(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    return t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority").join(c, F.col("o_custkey") == F.col("c_custkey"))


def canopies(spark: SparkSession, d: str) -> DataFrame:
    from kinfold.functions.people import person_key

    return names(spark, d).withColumn("canopy", person_key(F.col("first"), F.col("last"), F.col("uuid")))


#: The same views for DuckDB.
NAMES_SQL = "(SELECT CAST(p_partkey AS VARCHAR) AS uuid, p_partkey, p_name, split_part(p_name,' ',1) AS first, split_part(p_name,' ',2) AS last FROM part)"
CANOPY_SQL = f"(SELECT *, 'fl:' || substr(lower(first),1,2) || '_ln:' || lower(last) AS canopy FROM {NAMES_SQL})"
PEOPLE_SQL = f"(SELECT concat_ws('-',l_orderkey,l_partkey,l_suppkey,l_linenumber) AS uuid, l_orderkey, l_linenumber, p_name, first, last FROM lineitem JOIN {NAMES_SQL} n ON l_partkey = p_partkey)"
OWNERS_SQL = "(SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, c_custkey, c_name, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey)"
