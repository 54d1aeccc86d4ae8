"""One query for each operator of the reference, over the driver's tables, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinfold.functions import organisations as org
from kinfold.functions import people as ppl
from kinfold.functions import places, strings
from kinfold.operators import clustering, evaluation, scoring
from kinfold.operators import relational as rel
from kinfold.plans.views import CANOPY_SQL, NAMES_SQL, OWNERS_SQL, PEOPLE_SQL, canopies, names, owners, people, t
from kinfold.sources import registry

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def count(name: str = "n"):
    return F.count(F.lit(1)).alias(name)


# --- blocking -------------------------------------------------------------------------------------


@query(f"SELECT canopy, count(*) AS n FROM {CANOPY_SQL} GROUP BY canopy")
def canopy_sizes(spark, d):
    return canopies(spark, d).groupBy("canopy").agg(count())


@query(f"SELECT canopy, uuid FROM (SELECT canopy, uuid, count(*) OVER (PARTITION BY canopy) AS c FROM {CANOPY_SQL}) WHERE c BETWEEN 3 AND 400")
def canopy_size_filter(spark, d):
    return rel.sized(canopies(spark, d), "canopy", 3, 400).select("canopy", "uuid")


@query("SELECT c_name AS canopy, CAST(min(c_custkey) AS VARCHAR) AS label FROM customer GROUP BY c_name HAVING count(*) = 1")
def singletons(spark, d):
    rows = t(spark, d, "customer").select(F.col("c_name").alias("canopy"), F.col("c_custkey").cast("string").alias("label"))
    return rel.sized(rows, "canopy", 1, 1)


@query("SELECT p_partkey, unnest(list_distinct(list_transform(list_filter(string_split(lower(p_name),' '), lambda w: length(w) >= 3), lambda w: substr(w,1,4)))) AS canopy FROM part")
def overlapping_canopies(spark, d):
    rows = t(spark, d, "part").select("p_partkey", org.key_and_canopies(F.col("p_name"), F.col("p_partkey").cast("string"), ())[1].alias("c"))
    return rows.select("p_partkey", F.explode(F.array_distinct("c")).alias("canopy"))


@query(f"SELECT c_custkey AS entity, o_orderkey, n_name FROM {OWNERS_SQL} JOIN nation ON c_nationkey = n_nationkey")
def entity_blocking(spark, d):
    n = t(spark, d, "nation").select("n_nationkey", "n_name")
    return owners(spark, d).join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("entity"), "o_orderkey", "n_name")


# --- sources and identity -------------------------------------------------------------------------


@query("""SELECT concat_ws('-',l_orderkey,l_partkey,l_suppkey,l_linenumber) AS uuid,
  CASE WHEN l_orderkey % 2 = 0 THEN l_orderkey || '-' || l_linenumber ELSE 'pg-' || l_orderkey || '-' || (l_linenumber - 1) END AS mention_id,
  CASE WHEN l_orderkey % 2 = 0 THEN CAST(l_orderkey AS VARCHAR) ELSE 'pg-' || l_orderkey END AS record_id FROM lineitem""")
def mention_and_record_ids(spark, d):
    rows = t(spark, d, "lineitem").withColumn("uuid", F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")).withColumn("k", F.col("l_orderkey").cast("string"))
    issued = registry.common(rows.filter("l_orderkey % 2 = 0"), {"uuid": "uuid", "patent_id": "k", "sequence": "l_linenumber"}, registry.MENTIONS)
    applied = registry.common(rows.filter("l_orderkey % 2 != 0"), {"uuid": "uuid", "document_number": "k", "sequence": F.col("l_linenumber") - 1}, registry.MENTIONS)
    return registry.identified(registry.union(issued, applied)).select("uuid", "mention_id", "record_id")


@query("SELECT o_orderkey, 'full' AS source FROM orders WHERE o_orderdate <= TIMESTAMP '1996-12-31' UNION ALL SELECT o_orderkey, 'delta' FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-06-30'")
def source_union_filtered(spark, d):
    import datetime as dt

    o = t(spark, d, "orders").select("o_orderkey", "o_orderdate")
    full = registry.dated(o, "o_orderdate", dt.datetime(1996, 12, 31)).select("o_orderkey", F.lit("full").alias("source"))
    delta = registry.dated(o, "o_orderdate", dt.datetime(1997, 6, 30), dt.datetime(1997, 1, 1)).select("o_orderkey", F.lit("delta").alias("source"))
    return registry.union(full, delta)


@query("SELECT l.doc_id, d.lang FROM labels l LEFT JOIN documents d USING (doc_id) WHERE l.quality IS NOT NULL AND d.doc_id IS NULL OR d.lang IS NOT NULL")
def individual_filter(spark, d):
    rows = t(spark, d, "labels").join(t(spark, d, "documents").select("doc_id", "lang", F.col("doc_id").alias("known")), "doc_id", "left")
    return rows.filter((F.col("quality").isNotNull() & F.col("known").isNull()) | F.col("lang").isNotNull()).select("doc_id", "lang")


@query(f"SELECT uuid, l_orderkey AS record, lower(first) AS first, lower(last) AS last, 'fn:' || first || '_ln:' || last AS display FROM {PEOPLE_SQL}")
def decoded_mentions(spark, d):
    rows = people(spark, d)
    f, l = F.col("first"), F.col("last")
    return rows.select("uuid", F.col("l_orderkey").alias("record"), ppl.first_name(f).alias("first"), ppl.last_name(l).alias("last"), ppl.display_name(F.lit(None).cast("string"), f, l, F.col("uuid")).alias("display"))


@query("SELECT DISTINCT d.doc_id, d.lang FROM documents d JOIN labels USING (doc_id)")
def id_semi_join(spark, d):
    return registry.lookup(t(spark, d, "documents").select("doc_id", "lang"), t(spark, d, "labels"), "doc_id")


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def id_anti_join(spark, d):
    return t(spark, d, "documents").select("doc_id", "lang").join(t(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 100 OFFSET 200")
def paged_scan(spark, d):
    return registry.page(t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 200, 100).drop("l_suppkey")


# --- joins ----------------------------------------------------------------------------------------


@query("SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def left_join_locations(spark, d):
    c, n, r = (t(spark, d, x) for x in ("customer", "nation", "region"))
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left").select("c_custkey", "n_name", "r_name")


@query("SELECT o_orderkey, coalesce(p_name, '') AS title FROM orders LEFT JOIN (SELECT l_orderkey, min(p_name) AS p_name FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linenumber = 1 GROUP BY l_orderkey) ON o_orderkey = l_orderkey")
def feature_lookup_default(spark, d):
    titles = people(spark, d).filter("l_linenumber = 1").groupBy("l_orderkey").agg(F.min("p_name").alias("title"))
    return t(spark, d, "orders").join(titles, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", F.coalesce("title", F.lit("")).alias("title"))


@query("SELECT c.c_custkey, m.entity FROM customer c LEFT JOIN (SELECT o_custkey, min(o_orderkey) AS entity FROM orders GROUP BY o_custkey) m ON c.c_custkey = m.o_custkey")
def writeback_entity(spark, d):
    m = t(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderkey").alias("entity"))
    return t(spark, d, "customer").select("c_custkey").join(m, "c_custkey", "left")


@query("SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN 'first' WHEN o_orderstatus = 'O' THEN 'second' END AS target FROM orders")
def route_by_source_precedence(spark, d):
    o = t(spark, d, "orders")
    return rel.routed(o.select("o_orderkey"), o.filter("o_orderpriority LIKE '1%'"), o.filter("o_orderstatus = 'O'"), "o_orderkey")


@query(f"SELECT o_orderkey, c_name, o_orderdate FROM {OWNERS_SQL} WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') UNION SELECT o_orderkey, c_name, o_orderdate FROM {OWNERS_SQL} WHERE o_orderpriority LIKE '2%'")
def canonical_union_join(spark, d):
    o = owners(spark, d)
    cols = ["o_orderkey", "c_name", "o_orderdate"]
    some = t(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return o.join(some, "o_orderkey", "left_semi").select(*cols).union(o.filter("o_orderpriority LIKE '2%'").select(*cols)).distinct()


@query(f"SELECT c_custkey, uuid FROM {PEOPLE_SQL} JOIN {OWNERS_SQL} ON l_orderkey = o_orderkey")
def map_join(spark, d):
    o = owners(spark, d).select("o_orderkey", "c_custkey")
    return people(spark, d).join(o, F.col("l_orderkey") == F.col("o_orderkey")).select("c_custkey", "uuid")


@query("SELECT DISTINCT d.source || '-' || d.doc_id AS mention, l.quality FROM labels l JOIN documents d USING (doc_id)")
def id_rewrite(spark, d):
    docs = t(spark, d, "documents").select("doc_id", F.concat_ws("-", "source", F.col("doc_id").cast("string")).alias("mention"))
    return t(spark, d, "labels").join(docs, "doc_id").select("mention", "quality").distinct()


@query("SELECT source, quality, min(doc_id) AS first_doc FROM labels JOIN documents USING (doc_id) GROUP BY source, quality")
def labelled_mapping(spark, d):
    rows = t(spark, d, "labels").join(t(spark, d, "documents").select("doc_id", "source"), "doc_id")
    return rows.groupBy("source", "quality").agg(F.min("doc_id").alias("first_doc"))


@query("SELECT c_custkey, c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3) AS known FROM customer")
def dictionary_probe(spark, d):
    n = t(spark, d, "nation").filter("n_regionkey < 3").select("n_nationkey").withColumn("hit", F.lit(True))
    return t(spark, d, "customer").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", F.coalesce("hit", F.lit(False)).alias("known"))


@query("""SELECT p_partkey, coalesce(a.k, b.k) AS entity FROM part
  LEFT JOIN (SELECT p_name AS s, min(p_partkey) AS k FROM part WHERE p_size < 10 GROUP BY p_name) a ON p_name = a.s
  LEFT JOIN (SELECT split_part(p_name,' ',1) AS s, min(p_partkey) AS k FROM part WHERE p_size < 10 GROUP BY 1) b ON split_part(p_name,' ',1) = b.s""")
def kb_link_cascade(spark, d):
    p = t(spark, d, "part")
    known = p.filter("p_size < 10")
    head = F.get(F.split("p_name", " "), F.lit(0))
    table = known.groupBy(F.col("p_name").alias("s")).agg(F.min("p_partkey").alias("entity")).unionByName(known.groupBy(head.alias("s")).agg(F.min("p_partkey").alias("entity")))
    return rel.cascade(p.select("p_partkey", "p_name"), table, "s", "entity", [F.col("p_name"), head]).select("p_partkey", "entity")


@query(f"SELECT DISTINCT p.p_name || '/' || o.o_custkey AS rule, CAST(count(DISTINCT p.l_orderkey) AS BIGINT) AS n FROM {PEOPLE_SQL} p JOIN orders o ON p.l_orderkey = o.o_orderkey WHERE l_linenumber < 50 GROUP BY p.p_name, o.o_custkey")
def family_rules(spark, d):
    n = rel.tasks(t(spark, d, "lineitem").count(), spark)
    lines = people(spark, d).filter("l_linenumber < 50").select("l_orderkey", "p_name").repartition(n, "l_orderkey").distinct()
    rows = lines.join(t(spark, d, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    rules = rows.select("l_orderkey", F.concat_ws("/", "p_name", F.col("o_custkey").cast("string")).alias("rule")).distinct()
    return rules.repartition(n, "rule").groupBy("rule").agg(count())


# --- aggregation ----------------------------------------------------------------------------------


@query(f"SELECT l_orderkey, string_agg(lower(last), '|' ORDER BY lower(last)) AS names FROM {PEOPLE_SQL} GROUP BY l_orderkey")
def coperson_bag(spark, d):
    return people(spark, d).groupBy("l_orderkey").agg(F.array_join(F.sort_array(F.collect_list(ppl.last_name(F.col("last")))), "|").alias("names"))


@query(f"SELECT o_orderkey, string_agg(c_name, '|' ORDER BY c_name) AS names FROM {OWNERS_SQL} GROUP BY o_orderkey")
def assignee_bag(spark, d):
    return owners(spark, d).groupBy("o_orderkey").agg(F.array_join(F.sort_array(F.collect_list("c_name")), "|").alias("names"))


@query("""WITH c AS (SELECT lower(replace(p_name,' ','')) AS k, p_type, count(*) AS n FROM part GROUP BY 1, 2),
  m AS (SELECT k, p_type, row_number() OVER (PARTITION BY k ORDER BY n DESC, p_type) AS r FROM c)
SELECT p.k AS key, p.ids, p.brands, m.p_type AS top_name FROM (SELECT lower(replace(p_name,' ','')) AS k, string_agg(DISTINCT CAST(p_partkey AS VARCHAR), ',' ORDER BY CAST(p_partkey AS VARCHAR)) AS ids, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS brands FROM part GROUP BY 1) p JOIN m ON p.k = m.k AND m.r = 1""")
def name_rollup(spark, d):
    rows = t(spark, d, "part").select(org.key_and_canopies(F.col("p_name"), F.col("p_name"), ())[0].alias("key"), F.col("p_partkey").cast("string").alias("id"), "p_brand", "p_type")
    out = rel.rollup(rows, "key", {"ids": "id", "brands": "p_brand"}, "p_type")
    return out.select("key", F.array_join("ids", ",").alias("ids"), F.array_join("brands", ",").alias("brands"), "top_name")


@query("SELECT r_regionkey AS canopy, lower(n_name) || '||' || lower(r_name) AS place, count(DISTINCT c_custkey) AS num_records FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2")
def location_rollup(spark, d):
    rows = t(spark, d, "customer").join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.groupBy(F.col("r_regionkey").alias("canopy"), places.place_string(F.lower("n_name"), F.lit(None).cast("string"), F.lower("r_name")).alias("place")).agg(F.countDistinct("c_custkey").alias("num_records"))


@query("SELECT count(n) AS n, round(avg(n),6) AS mean, round(stddev_samp(n),6) AS std, min(n) AS least, max(n) AS most, quantile_cont(n,0.25) AS p25, quantile_cont(n,0.5) AS p50, quantile_cont(n,0.75) AS p75 FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)")
def cluster_size_stats(spark, d):
    out = rel.described(t(spark, d, "lineitem").groupBy("l_orderkey").agg(count("s")), "s")
    return out.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@query("SELECT CAST(ceil(n / 3.0) AS BIGINT) AS bin, count(*) AS n FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey) GROUP BY 1")
def cluster_size_histogram(spark, d):
    sizes = t(spark, d, "lineitem").groupBy("l_orderkey").agg(count("s"))
    return sizes.groupBy(rel.right_closed_bin(F.col("s"), 3.0).alias("bin")).agg(count())


@query("SELECT p_partkey, count(*) OVER (PARTITION BY p_name) AS n FROM part")
def group_transform_count(spark, d):
    p = t(spark, d, "part").select("p_partkey", "p_name")
    return p.join(p.groupBy("p_name").agg(count()), "p_name").select("p_partkey", "n")


_BRAND_PAIRS = "(SELECT a.p_brand, a.p_name AS x, b.p_name AS y FROM (SELECT DISTINCT p_brand, p_name FROM part) a JOIN (SELECT DISTINCT p_brand, p_name FROM part) b ON a.p_brand = b.p_brand AND a.p_name < b.p_name)"


def _brand_pairs(spark, d):
    rows = t(spark, d, "part").select("p_brand", "p_name").distinct()
    return scoring.pairs(rows, "p_brand", "p_name", [])


@query(f"SELECT p_brand, CAST(sum(levenshtein(x, y)) AS BIGINT) AS total, count(*) AS pairs FROM {_BRAND_PAIRS} GROUP BY p_brand")
def within_cluster_levenshtein(spark, d):
    return _brand_pairs(spark, d).groupBy("p_brand").agg(F.sum(F.levenshtein("p_name_a", "p_name_b").cast("long")).alias("total"), count("pairs"))


@query(f"SELECT p_brand, round(sum(jaro_similarity(x, y)), 6) AS jaro, round(sum(jaro_winkler_similarity(x, y)), 6) AS winkler FROM {_BRAND_PAIRS} GROUP BY p_brand")
def within_cluster_jaro(spark, d):
    # distances depend on the two names only: each pair of names is measured once
    pairs = _brand_pairs(spark, d)
    a, b = F.col("p_name_a"), F.col("p_name_b")
    once = pairs.select(a, b).distinct().select(a, b, strings.jaro_similarity(a, b).alias("j"), strings.jaro_winkler_similarity(a, b).alias("w"))
    return pairs.join(once, ["p_name_a", "p_name_b"]).groupBy("p_brand").agg(F.round(F.sum("j"), 6).alias("jaro"), F.round(F.sum("w"), 6).alias("winkler"))


@query("SELECT round(stddev_pop(x),6) AS std, round(avg(x),6) AS mean, round(min(x),6) AS least, round(max(x),6) AS most FROM (SELECT levenshtein(x,y) AS x FROM " + _BRAND_PAIRS + ")")
def linkage_stats(spark, d):
    x = F.levenshtein("p_name_a", "p_name_b").cast("double")
    parts = {"std": F.stddev_pop(x), "mean": F.avg(x), "least": F.min(x), "most": F.max(x)}
    return _brand_pairs(spark, d).agg(*[F.round(e, 6).alias(k) for k, e in parts.items()])


@query("SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_entities, (SELECT max(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)) AS largest, count(*) >= 1000 AS enough_rows, count(DISTINCT l_orderkey) BETWEEN 100 AND 100000000 AS entities_fit, (SELECT max(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)) <= 100 AS largest_fits FROM lineitem")
def output_bounds_qc(spark, d):
    return evaluation.bounds(t(spark, d, "lineitem"), "l_orderkey", 1000, (100, 100_000_000), 100)


# --- ranking --------------------------------------------------------------------------------------


@query(f"""SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY c DESC, o_orderdate DESC, o_orderkey) AS r
  FROM (SELECT *, count(*) OVER (PARTITION BY o_custkey, o_orderpriority) AS c FROM {OWNERS_SQL})) WHERE r = 1""")
def canonical_record(spark, d):
    rows = owners(spark, d).withColumn("c", F.count(F.lit(1)).over(Window.partitionBy("o_custkey", "o_orderpriority")))
    return rel.first_by(rows, ["o_custkey"], F.col("c").desc(), F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey")).select("o_custkey", "o_orderkey", "o_orderpriority")


@query(f"SELECT l_orderkey, p_name, n FROM (SELECT l_orderkey, p_name, count(*) AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY count(*) DESC, p_name) AS r FROM {PEOPLE_SQL} GROUP BY 1, 2) WHERE r = 1")
def modal_name(spark, d):
    return rel.mode(people(spark, d), ["l_orderkey"], "p_name")


@query(f"SELECT canopy, uuid FROM (SELECT canopy, uuid, row_number() OVER (PARTITION BY canopy ORDER BY p_partkey) AS r FROM {CANOPY_SQL}) WHERE r <= 5")
def first_n_per_canopy(spark, d):
    return rel.first_by(canopies(spark, d), ["canopy"], F.col("p_partkey"), n=5).select("canopy", "uuid")


@query(f"SELECT canopy, (row_number() OVER (ORDER BY count(*) DESC, canopy DESC) - 1) % 8 AS chunk FROM {CANOPY_SQL} GROUP BY canopy")
def round_robin_chunks(spark, d):
    return rel.round_robin(canopy_sizes(spark, d), "canopy", "n", 8).select("canopy", "chunk")


@query(f"SELECT canopy, n, CAST(sum(n) OVER (ORDER BY canopy ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM (SELECT canopy, count(*) AS n FROM {CANOPY_SQL} GROUP BY canopy)")
def running_batches(spark, d):
    return rel.ranged(canopy_sizes(spark, d), F.col("canopy"), value=F.col("n"))


@query(f"""WITH RECURSIVE s AS (SELECT substr(canopy, 1, 4) AS g, canopy, count(*) AS n, row_number() OVER (PARTITION BY substr(canopy, 1, 4) ORDER BY canopy) AS r FROM {CANOPY_SQL} GROUP BY canopy),
 b(g, r, canopy, n, batch, total) AS (SELECT g, r, canopy, n, 0, n FROM s WHERE r = 1 UNION ALL
  SELECT s.g, s.r, s.canopy, s.n, CASE WHEN b.total >= 100 THEN b.batch + 1 ELSE b.batch END, CASE WHEN b.total >= 100 THEN 0 ELSE b.total END + s.n FROM b JOIN s ON s.g = b.g AND s.r = b.r + 1)
SELECT g, canopy, n, batch FROM b""")
def batches_with_reset(spark, d):
    return rel.batches(canopy_sizes(spark, d).withColumn("g", F.substring("canopy", 1, 4)), "g", "canopy", "n", 100)


@query("SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey ORDER BY n DESC, l_suppkey LIMIT 20")
def top_k_clusters(spark, d):
    return t(spark, d, "lineitem").groupBy("l_suppkey").agg(count()).orderBy(F.desc("n"), "l_suppkey").limit(20)


@query("SELECT l_suppkey, array_to_string(list_slice(list_sort(list_distinct(list(p_name))),1,10), '; ') AS names FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey")
def top_k_names_joined(spark, d):
    rows = t(spark, d, "lineitem").select("l_suppkey", "l_partkey").join(t(spark, d, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey")).select("l_suppkey", "p_name").distinct()
    return rel.first_by(rows, ["l_suppkey"], F.col("p_name"), n=10).groupBy("l_suppkey").agg(F.array_join(F.sort_array(F.collect_list("p_name")), "; ").alias("names"))


# --- sets -----------------------------------------------------------------------------------------


@query("SELECT o_orderkey AS k, 'new' AS v FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT o_orderkey, 'old' FROM orders WHERE o_orderstatus <> 'O'")
def override_union(spark, d):
    o = t(spark, d, "orders")
    base = o.select(F.col("o_orderkey").alias("k"), F.lit("old").alias("v"))
    return rel.override(base, o.filter("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("k"), F.lit("new").alias("v")), "k")


@query("SELECT o_custkey, o_orderkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')")
def touched_canopy_merge(spark, d):
    o = t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    edge = F.lit("1998-01-01").cast("timestamp_ntz")
    return rel.touched(o.filter(F.col("o_orderdate") < edge), o.filter(F.col("o_orderdate") >= edge), "o_custkey").select("o_custkey", "o_orderkey")


@query("SELECT o_custkey, max(o_orderpriority) AS feature FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY o_custkey UNION ALL SELECT o_custkey, max(o_orderpriority) FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01') GROUP BY o_custkey")
def feature_refresh(spark, d):
    o = t(spark, d, "orders")
    edge = F.lit("1998-01-01").cast("timestamp_ntz")
    f = lambda rows: rows.groupBy("o_custkey").agg(F.max("o_orderpriority").alias("feature"))
    return rel.override(f(o.filter(F.col("o_orderdate") < edge)), f(o.filter(F.col("o_orderdate") >= edge)), "o_custkey")


_A, _B = "(SELECT DISTINCT o_custkey AS k FROM orders)", "(SELECT c_custkey AS k FROM customer WHERE c_acctbal > 0)"


@query(f"SELECT 'union' AS op, k FROM (SELECT k FROM {_A} UNION SELECT k FROM {_B}) UNION ALL SELECT 'intersect', k FROM (SELECT k FROM {_A} INTERSECT SELECT k FROM {_B}) UNION ALL SELECT 'difference', k FROM (SELECT k FROM {_A} EXCEPT SELECT k FROM {_B}) UNION ALL SELECT 'repeated', o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 1")
def set_ops_bundle(spark, d):
    o = t(spark, d, "orders").select(F.col("o_custkey").alias("k"))
    a, b = o.distinct(), t(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("k"))
    tag = lambda name, df: df.select(F.lit(name).alias("op"), "k")
    return registry.union(tag("union", a.union(b).distinct()), tag("intersect", a.intersect(b)), tag("difference", a.exceptAll(b).distinct()), tag("repeated", o.groupBy("k").agg(count()).filter("n > 1")))


# --- functions ------------------------------------------------------------------------------------

_WORD = "(SELECT doc_id, split_part(text,' ',1) AS a, split_part(text,' ',2) AS b FROM documents)"
_NORM = "lower(regexp_replace(strip_accents(replace({0},'\"','')),'[^\\x00-\\x7F]','','g'))"


@query(f"""SELECT doc_id, nullif({_NORM.format('a')},'') IS NULL AS empty, substr({_NORM.format('a')},1,1) AS letter1, trim(substr({_NORM.format('a')},1,2)) AS letter2, {_NORM.format('b')} AS plain FROM {_WORD} WHERE {_NORM.format('a')} <> ''""")
def person_name_parts(spark, d):
    w = F.split("text", " ")
    rows = t(spark, d, "documents").select("doc_id", F.coalesce(F.get(w, F.lit(0)), F.lit("")).alias("a"), F.coalesce(F.get(w, F.lit(1)), F.lit("")).alias("b"))
    a = F.col("a")
    out = rows.select("doc_id", (F.nullif(ppl.normalized(a), F.lit("")).isNull()).alias("empty"), ppl.letters(a, 1).alias("letter1"), ppl.letters(a, 2).alias("letter2"), ppl.normalized(F.col("b")).alias("plain"))
    return out.filter("NOT empty")


@query(f"""SELECT uuid, lower(first) AS fname, substr(lower(first),1,1) AS initial, CAST(NULL AS VARCHAR) AS middle, lower(last) AS lname, 'fl:' || substr(lower(first),1,2) || '_ln:' || lower(last) AS key FROM {NAMES_SQL}""")
def person_keys(spark, d):
    f, l = F.col("first"), F.col("last")
    return names(spark, d).select("uuid", ppl.first_name(f).alias("fname"), ppl.initials(f).alias("initial"), ppl.middle_name(f).alias("middle"), ppl.last_name(l).alias("lname"), ppl.person_key(f, l, F.col("uuid")).alias("key"))


@query("SELECT c_custkey, trim(regexp_replace(lower(translate(c_name,'#-.,',  '    ')), '\\s+', ' ', 'g')) AS name FROM customer")
def org_normalize(spark, d):
    return t(spark, d, "customer").select("c_custkey", F.trim(org.normalized(F.col("c_name"))).alias("name"))


@query("""WITH t AS (SELECT DISTINCT unnest(string_split(lower(p_name), ' ')) AS token FROM part), w AS (SELECT token AS word FROM t WHERE length(token) >= 4),
 m AS (SELECT t.token, min(w.word) AS word FROM t JOIN w ON length(t.token) >= 4 AND levenshtein(t.token, w.word) <= 2 GROUP BY 1)
SELECT t.token, coalesce(m.word, t.token) AS corrected FROM t LEFT JOIN m ON t.token = m.token""")
def token_correction(spark, d):
    tokens = t(spark, d, "part").select(F.explode(F.split(F.lower("p_name"), " ")).alias("token"))
    words = tokens.distinct().filter(F.length("token") >= 4).select((F.dense_rank().over(Window.orderBy("token"))).alias("position"), F.col("token").alias("word"))
    return org.corrected(tokens.distinct(), "token", words, 2, 4)


@query("SELECT c_custkey, upper(substr(c_mktsegment,1,3)) || '|' || substr(c_mktsegment,4,1) || '.' AS acronyms FROM customer")
def acronyms(spark, d):
    segment = F.col("c_mktsegment")
    raw = F.concat("c_name", F.lit(" ("), F.upper(F.substring(segment, 1, 3)), F.lit(") of (x 1) ("), F.substring(segment, 4, 1), F.lit(".)"))
    return t(spark, d, "customer").select("c_custkey", F.array_join(org.acronyms(raw), "|").alias("acronyms"))


@query("SELECT doc_id, lower(replace(replace(replace(replace(regexp_replace(regexp_replace(text, '^\"', ''), '\"$', ''), '/', ' / '), '.-', ' .- '), '.', ' . '), '''', ' '' ')) AS cleaned FROM documents")
def clean_text(spark, d):
    return t(spark, d, "documents").select("doc_id", strings.clean_text(F.col("text")).alias("cleaned"))


@query("""SELECT gram, count(*) AS n FROM (SELECT unnest(flatten(list_transform(string_split(lower(p_name),' '), lambda w: flatten(list_transform(range(2, least(10, length(w)+2)+1), lambda n: list_transform(range(1, length(w)+2-n+2), lambda i: substr(' ' || w || ' ', i, n))))))) AS gram FROM part) GROUP BY gram""")
def char_wb_ngrams(spark, d):
    return t(spark, d, "part").select(F.explode(org.word_grams(F.lower("p_name"))).alias("gram")).groupBy("gram").agg(count())


@query("""WITH g AS (SELECT p_name AS k, unnest(flatten(list_transform(string_split(lower(p_name),' '), lambda w: flatten(list_transform(range(2, least(10, length(w)+2)+1), lambda n: list_transform(range(1, length(w)+2-n+2), lambda i: substr(' ' || w || ' ', i, n))))))) AS term FROM (SELECT DISTINCT p_name FROM part)),
 c AS (SELECT k, term, count(*) AS tf FROM g GROUP BY k, term), n AS (SELECT count(DISTINCT k) AS n FROM c), f AS (SELECT term, ln((1+(SELECT n FROM n))/(1.0+count(*)))+1 AS idf FROM c GROUP BY term),
 w AS (SELECT k, term, tf*idf AS w FROM c JOIN f USING (term)) SELECT k, term, round(w / sqrt(sum(w*w) OVER (PARTITION BY k)), 6) AS w FROM w""")
def name_gram_weights(spark, d):
    rows = t(spark, d, "part").select(F.col("p_name").alias("k")).distinct().withColumn("grams", org.word_grams(F.lower("k")))
    return scoring.term_weights(rows, "k", "grams").withColumn("w", F.round("w", 6))


@query("""WITH c AS (SELECT c_custkey, c_acctbal, n_name AS city, c_mktsegment AS state, r_name AS country FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)
SELECT c_custkey, EXISTS (SELECT 1 FROM c x WHERE x.c_acctbal > 8000 AND x.city IS NOT DISTINCT FROM c.city AND x.state IS NOT DISTINCT FROM c.state AND x.country IS NOT DISTINCT FROM c.country) AS known FROM c""")
def place_database(spark, d):
    c, n, r = (t(spark, d, x) for x in ("customer", "nation", "region"))
    rows = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    rows = rows.select("c_custkey", "c_acctbal", F.col("n_name").alias("city"), F.col("c_mktsegment").alias("state"), F.col("r_name").alias("country"))
    return rel.contained(rows, rows.filter("c_acctbal > 8000")).select("c_custkey", "known")


@query("SELECT p_partkey, array_to_string(list_filter(string_split(lower(p_name),' '), lambda w: w <> 'red' AND w <> 'large'), ' ') AS kept FROM part")
def stopword_drop(spark, d):
    return t(spark, d, "part").select("p_partkey", org.without_words(F.lower("p_name"), ("red", "large")).alias("kept"))


@query("SELECT p_partkey, lower(replace(p_name,' ','')) AS key FROM part")
def relaxed_key(spark, d):
    return t(spark, d, "part").select("p_partkey", org.relaxed_key(F.col("p_name"), F.col("p_partkey").cast("string")).alias("key"))


@query(f"SELECT doc_id, trim(regexp_replace({_NORM.format('a')}, '\\s+', ' ', 'g')) AS name FROM {_WORD}")
def simple_normalize(spark, d):
    return t(spark, d, "documents").select("doc_id", org.simple(F.translate(F.coalesce(F.get(F.split("text", " "), F.lit(0)), F.lit("")), '"', "")).alias("name"))


@query("SELECT p_partkey, len(string_split(p_name,' ')) AS tokens, lower(split_part(p_name,' ',1)) AS head FROM part")
def analyzer_tokens(spark, d):
    w = F.split(F.lower(org.expanded(org.spaced(F.col("p_name"), org.SPACED + "\"'"))), " ")
    return t(spark, d, "part").select("p_partkey", F.size(w).cast("long").alias("tokens"), F.get(w, F.lit(0)).alias("head"))


@query("SELECT n_nationkey, array_to_string(list_filter(string_split(lower(n_name),' '), lambda w: length(w) <> 2), '|') AS parts FROM nation")
def city_parts(spark, d):
    return t(spark, d, "nation").select("n_nationkey", F.array_join(places.city_parts(F.col("n_name")), "|").alias("parts"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def date_reformat(spark, d):
    path = F.concat(F.lit("out/run_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("/ids.tsv"))
    return t(spark, d, "orders").select("o_orderkey", strings.iso_date(strings.date_in_path(path)).alias("day"))


@query("SELECT doc_id, len(list_filter(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda s: s <> '')) AS n FROM documents")
def sentence_counts(spark, d):
    return t(spark, d, "documents").select("doc_id", F.size(strings.sentences(F.col("text"))).cast("long").alias("n"))


@query("SELECT p_brand, x AS p_name_a, y AS p_name_b, len(list_intersect(string_split(lower(x),' '), string_split(lower(y),' '))) / 2.0::DOUBLE AS ratio FROM " + _BRAND_PAIRS)
def token_set_pairs(spark, d):
    return _brand_pairs(spark, d).withColumn("ratio", strings.token_set_ratio(F.col("p_name_a"), F.col("p_name_b")))


@query()
def location_reparse(spark, d):
    rows = t(spark, d, "nation").join(t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.concat_ws(", ", F.lit("Ft Worth"), "r_name", "n_name").alias("raw"))
    return places.reparsed(rows, "raw", ["france", "germany", "japan", "china", "brazil"], ["asia", "europe", "america"])


# --- features, scores, clusters -------------------------------------------------------------------


@query("WITH n AS (SELECT p_brand, p_partkey, split_part(p_name,' ',1) AS first, split_part(p_name,' ',2) AS last FROM part) SELECT a.p_brand || '/' || a.last AS block, a.p_partkey AS a, b.p_partkey AS b FROM n a JOIN n b ON a.p_brand = b.p_brand AND a.last = b.last AND a.p_partkey < b.p_partkey AND a.first <> b.first")
def must_not_link_pairs(spark, d):
    rows = names(spark, d).join(t(spark, d, "part").select("p_partkey", "p_brand"), "p_partkey").withColumn("block", F.concat_ws("/", "p_brand", "last"))
    p = scoring.cell_pairs(rows, "block", "p_partkey", ["first"], scoring.no_match(F.col("first_a"), F.col("first_b")) == 1)
    return p.select("block", F.col("p_partkey_a").alias("a"), F.col("p_partkey_b").alias("b"))


@query("SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 4) AS sim FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id WHERE list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) >= 0.3")
def dense_cosine_pairs(spark, d):
    p = scoring.dense_pairs(t(spark, d, "embeddings"), "label", "vec_id", "embedding", 0.3)
    return p.select(F.col("vec_id_a").alias("a"), F.col("vec_id_b").alias("b"), F.round("sim", 4).alias("sim"))


@query("SELECT s, round(1/(1+greatest(s,-20000.0)+20000.0), 9) AS dist FROM (SELECT DISTINCT CAST(p_size AS DOUBLE) - 25 AS s FROM part)")
def score_to_distance(spark, d):
    s = t(spark, d, "part").select((F.col("p_size").cast("double") - 25).alias("s")).distinct()
    return s.select("s", F.round(scoring.distance(F.col("s")), 9).alias("dist"))


@query("""WITH t AS (SELECT DISTINCT p_name AS k, unnest(string_split(p_name || ' ' || p_type, ' ')) AS term FROM part),
 c AS (SELECT DISTINCT k, term FROM t), n AS (SELECT count(DISTINCT k) AS n FROM c), f AS (SELECT term, ln((1+(SELECT n FROM n))/(1.0+count(*)))+1 AS idf FROM c GROUP BY term),
 w AS (SELECT k, term, idf FROM c JOIN f USING (term)), m AS (SELECT k, sqrt(sum(idf*idf)) AS norm FROM w GROUP BY k), x AS (SELECT k, term, idf/norm AS w FROM w JOIN m USING (k))
SELECT a.k AS k_a, b.k AS k_b, round(sum(a.w*b.w), 6) AS sim FROM x a JOIN x b ON a.term = b.term AND a.k < b.k GROUP BY 1, 2""")
def tfidf_pairs(spark, d):
    rows = t(spark, d, "part").groupBy(F.col("p_name").alias("k")).agg(F.array_distinct(F.flatten(F.collect_set(F.split(F.concat_ws(" ", "p_name", "p_type"), " ")))).alias("terms"))
    return scoring.sparse_dot(scoring.term_weights(rows, "k", "terms"), "k").select("k_a", "k_b", F.round("dot", 6).alias("sim"))


@query(f"WITH c AS (SELECT l_orderkey AS k, lower(last) AS term, count(*) AS tf FROM {PEOPLE_SQL} GROUP BY 1, 2) SELECT k, term, round(tf / sqrt(sum(tf * tf) OVER (PARTITION BY k)), 9) AS w FROM c")
def hash_and_bag_features(spark, d):
    n = rel.tasks(t(spark, d, "lineitem").count(), spark)
    terms = people(spark, d).select(F.col("l_orderkey").alias("k"), ppl.last_name(F.col("last")).alias("term")).filter("term IS NOT NULL")
    return scoring.counted_weights(terms.repartition(n, "k"), "k").select("k", "term", F.round("w", 9).alias("w"))


@query("""WITH s AS (SELECT DISTINCT o_custkey, c_nationkey, date_part('year', o_orderdate) AS y FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT a.o_custkey AS a, b.o_custkey AS b, count(*) AS shared FROM s a JOIN s b ON a.c_nationkey = b.c_nationkey AND a.y = b.y AND a.o_custkey < b.o_custkey GROUP BY 1, 2""")
def set_overlap_pairs(spark, d):
    rows, sets = scoring.masked(owners(spark, d).withColumn("y", F.year("o_orderdate")), ["o_custkey", "c_nationkey"], "y")
    number = scoring.shared_masks(rows, sets)
    p = scoring.cell_pairs(rows, "c_nationkey", "o_custkey", sets, number > 0, {"shared": number})
    return p.select(F.col("o_custkey_a").alias("a"), F.col("o_custkey_b").alias("b"), "shared")


@query("SELECT a.n_nationkey AS a, b.n_nationkey AS b, CASE WHEN substr(a.n_name,1,1) = substr(b.n_name,1,1) AND (length(a.n_name) >= 1.5*length(b.n_name) OR length(b.n_name) >= 1.5*length(a.n_name) OR a.n_name = b.n_name) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS sim FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey")
def location_rule_pairs(spark, d):
    rows = t(spark, d, "nation")
    p = scoring.pairs(rows, "n_regionkey", "n_nationkey", ["n_name"])
    a, b = F.col("n_name_a"), F.col("n_name_b")
    rule = scoring.place_rule(F.substring(a, 1, 1) == F.substring(b, 1, 1), a == b, F.lit(True), F.lit(True), F.lit(True), F.length(a), F.length(b))
    return p.select(F.col("n_nationkey_a").alias("a"), F.col("n_nationkey_b").alias("b"), rule.alias("sim"))


@query("""SELECT o_orderkey, min(o_orderkey) OVER (PARTITION BY o_custkey, island) AS root FROM
 (SELECT o_orderkey, o_custkey, sum(gap) OVER (PARTITION BY o_custkey ORDER BY day, o_orderkey) AS island FROM
  (SELECT *, CASE WHEN day - lag(day) OVER (PARTITION BY o_custkey ORDER BY day, o_orderkey) <= 90 THEN 0 ELSE 1 END AS gap FROM (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders)))""")
def threshold_components(spark, d):
    # orders of a customer that follow each other within the threshold are linked: chains of several hops
    o = t(spark, d, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    before = Window.partitionBy("o_custkey").orderBy("day", "o_orderkey")
    edges = o.select(F.col("o_orderkey").alias("a"), F.lag("o_orderkey").over(before).alias("b"), F.datediff("day", F.lag("day").over(before)).alias("gap")).filter("gap <= 90").select("a", "b")
    roots = clustering.components(edges).withColumnRenamed("node", "o_orderkey")
    return o.select("o_orderkey").join(roots, "o_orderkey", "left").select("o_orderkey", F.coalesce("root", "o_orderkey").alias("root"))


@query("SELECT min(doc_id) OVER (PARTITION BY text) AS entity, doc_id AS mention FROM documents")
def entity_ids(spark, d):
    docs = t(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    first = docs.groupBy("h").agg(F.min("doc_id").alias("b"))
    edges = docs.join(first, "h").filter("doc_id != b").select(F.col("doc_id").alias("a"), "b")
    roots = clustering.components(edges).withColumnRenamed("node", "doc_id")
    return docs.join(roots, "doc_id", "left").select(F.coalesce("root", "doc_id").alias("entity"), F.col("doc_id").alias("mention"))


def _by_prices(left, right) -> np.ndarray:
    return np.abs(left["p_retailprice"].to_numpy()[:, None] - right["p_retailprice"].to_numpy()[None, :])


def _by_price(held) -> np.ndarray:
    return _by_prices(held, held)


def _priced(spark, d):
    return canopies(spark, d).select("canopy", "p_partkey").join(t(spark, d, "part").select("p_partkey", "p_retailprice"), "p_partkey")


@query()
def hac_clusters(spark, d):
    return clustering.cluster_blocks(_priced(spark, d), "canopy", "p_partkey", ["p_retailprice"], _by_price, 25.0, cross=_by_prices, copies=True)


@query()
def merge_label_table(spark, d):
    return clustering.merge_table(_priced(spark, d), "canopy", "p_partkey", ["p_retailprice"], _by_price, cross=_by_prices, copies=True)


@query("SELECT n_regionkey, n_name FROM (SELECT n_regionkey, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY count(c_custkey) DESC, n_name) AS r FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2) WHERE r = 1")
def entity_choice(spark, d):
    rows = t(spark, d, "nation").join(t(spark, d, "customer").groupBy("c_nationkey").agg(count()), F.col("c_nationkey") == F.col("n_nationkey"), "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return rel.first_by(rows, ["n_regionkey"], F.col("n").desc(), F.col("n_name")).select("n_regionkey", "n_name")


@query("SELECT p_partkey AS mention, min(p_partkey) OVER (PARTITION BY p_name) AS entity FROM part")
def resolved_parts(spark, d):
    from kinfold.plans import resolve

    p = t(spark, d, "part").select(F.col("p_partkey").alias("mention"), "p_name", F.split(F.lower("p_name"), " ").alias("words"))
    blocks = p.select(F.explode("words").alias("block"), "mention")
    settings = resolve.Settings((scoring.Feature("p_name", "no_match", must_not=True), scoring.Feature("words", "shared")), least=1.5)
    return resolve.resolve(p, blocks, settings)


# --- evaluation -----------------------------------------------------------------------------------


@query("""WITH c AS (SELECT CAST(floor(vec_id / 50) AS VARCHAR) AS p, label AS g, count(*) AS n FROM embeddings GROUP BY 1, 2), tp AS (SELECT sum(n*(n-1)/2) AS x FROM c),
 pp AS (SELECT sum(n*(n-1)/2) AS x FROM (SELECT sum(n) AS n FROM c GROUP BY p)), gp AS (SELECT sum(n*(n-1)/2) AS x FROM (SELECT sum(n) AS n FROM c GROUP BY g))
SELECT round(tp.x/pp.x, 9) AS precision, round(tp.x/gp.x, 9) AS recall, round(2*tp.x/(pp.x+gp.x), 9) AS f1 FROM tp, pp, gp""")
def pairwise_f1(spark, d):
    e = t(spark, d, "embeddings")
    out = evaluation.pairwise(e.select("vec_id", F.floor(F.col("vec_id") / 50).alias("label")), e.select("vec_id", "label"), "vec_id")
    return out.select(*[F.round(c, 9).alias(c) for c in out.columns])


@query("SELECT l_suppkey, l_orderkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def one_mention_per_record(spark, d):
    return evaluation.crowded(t(spark, d, "lineitem"), "l_suppkey", "l_orderkey")


@query()
def overlap_alignment(spark, d):
    line = t(spark, d, "lineitem").withColumn("id", F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    return evaluation.aligned(line.select("id", F.col("l_suppkey").alias("label")), line.select("id", (F.col("l_suppkey") % 40).alias("label")), "id", 50)


@query("""SELECT CAST(doc_id AS VARCHAR) AS canopy, CASE WHEN CAST('0x' || substr(md5(min('b' || doc_id) OVER (PARTITION BY text)), 1, 8) AS BIGINT) % 5 = 0 THEN 'dev' ELSE 'train' END AS part
FROM documents JOIN labels USING (doc_id)""")
def train_dev_split(spark, d):
    rows = t(spark, d, "documents").join(t(spark, d, "labels").select("doc_id"), "doc_id").select(F.col("doc_id").alias("canopy"), F.sha2("text", 256).alias("entity"))
    return evaluation.split(rows, "canopy", "entity")


@query("SELECT l.doc_id, l.quality, d.source FROM labels l JOIN documents d USING (doc_id)")
def gold_restricted(spark, d):
    return t(spark, d, "documents").select("doc_id", "source").join(t(spark, d, "labels").select("doc_id", "quality"), "doc_id")


@query("SELECT p_brand, x AS p_name_a, y AS p_name_b FROM " + _BRAND_PAIRS + " WHERE levenshtein(x, y) < 4")
def merge_log_filter(spark, d):
    return _brand_pairs(spark, d).filter(F.levenshtein("p_name_a", "p_name_b") < 4)


@query("SELECT p_partkey FROM part WHERE contains(p_name, 'red') OR starts_with(p_type, 'ECONOMY')")
def term_filter(spark, d):
    return t(spark, d, "part").filter(F.contains("p_name", F.lit("red")) | F.col("p_type").startswith("ECONOMY")).select("p_partkey")


@query("SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount IS NOT NULL AND l_discount > 0")
def positive_nonnull(spark, d):
    return t(spark, d, "lineitem").filter(F.col("l_discount").isNotNull() & (F.col("l_discount") > 0)).select("l_orderkey", "l_linenumber", "l_discount")


@query(f"SELECT CAST(ceil(levenshtein(x, y) / 2.0) AS BIGINT) AS bin, count(*) AS n FROM {_BRAND_PAIRS} GROUP BY 1")
def distance_bins(spark, d):
    return _brand_pairs(spark, d).groupBy(rel.right_closed_bin(F.levenshtein("p_name_a", "p_name_b"), 2.0).alias("bin")).agg(count())


@query("SELECT event_type AS canopy, time_bucket(INTERVAL '1 hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1, 2")
def stream_canopy_counts(spark, d):
    from kinfold.streaming.canopies import replayed_counts

    return replayed_counts(spark, f"{d}/events.parquet")
