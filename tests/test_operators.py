import itertools

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinfold.operators import clustering, evaluation, relational, scoring
from kinfold.plans import resolve
from kinfold.sources import registry, sinks


def brute_linkage(d, cut):
    groups = [[i] for i in range(len(d))]
    while len(groups) > 1:
        h, a, b = min((np.mean([d[i][j] for i in x for j in y]), a, b) for (a, x), (b, y) in itertools.combinations(enumerate(groups), 2))
        if h > cut:
            break
        groups[a] += groups.pop(b)
    return {frozenset(g) for g in groups}


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.integers(0, 10**6))
def test_linkage_equals_brute_force(n, seed):
    x = np.random.default_rng(seed).normal(size=(n, 2))
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    z = clustering.linkage(d)
    assert list(z[:, 2]) == sorted(z[:, 2])
    for cut in (0.3, 1.0, 2.0):
        label = clustering.flat(z, n, cut)
        assert {frozenset(np.flatnonzero(label == k).tolist()) for k in set(label.tolist())} == brute_linkage(d, cut)


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 6), st.integers(0, 3), st.integers(0, 10**6))
def test_assignment_is_best(n, more, seed):
    cost = np.random.default_rng(seed).integers(-9, 9, (n, n + more)).astype(float)
    pick = evaluation.assignment(cost)
    assert len(set(pick.tolist())) == n
    assert cost[np.arange(n), pick].sum() == min(sum(cost[i, p[i]] for i in range(n)) for p in itertools.permutations(range(n + more), n))


def test_components(spark):
    edges = spark.createDataFrame([("p1", "c1"), ("p1", "c2"), ("p2", "c2"), ("p3", "c3"), ("x", "x")], "a string, b string")
    got = {r["node"]: r["root"] for r in clustering.components(edges).collect()}
    assert got == {"p1": "c1", "c1": "c1", "c2": "c1", "p2": "c1", "p3": "c3", "c3": "c3", "x": "x"}


def test_components_of_a_long_chain(spark):
    edges = spark.range(60).select((F.col("id") + 1).alias("a"), F.col("id").alias("b"))
    assert {r["root"] for r in clustering.components(edges).collect()} == {0}


def test_pairwise(spark):
    gold = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B")], "id int, label string")
    pred = spark.createDataFrame([(1, "1"), (2, "1"), (3, "1")], "id int, label string")
    row = evaluation.pairwise(pred, gold, "id").first()
    assert (row["precision"], row["recall"], row["f1"]) == pytest.approx((1 / 3, 1, 0.5))


def test_split_keeps_entities_together(spark):
    rows = spark.createDataFrame([(f"c{i}", f"e{i // 3}") for i in range(60)], "canopy string, entity string")
    part = {r["canopy"]: r["part"] for r in evaluation.split(rows, "canopy", "entity", 3).collect()}
    assert all(len({part[f"c{i}"] for i in range(k, k + 3)}) == 1 for k in range(0, 60, 3))
    assert {*part.values()} == {"train", "dev"}


def test_hac_of_blocks(spark):
    rows = spark.createDataFrame([("a", i, x) for i, x in enumerate([0.0, 0.1, 5.0])] + [("b", 9, 1.0)], "canopy string, id long, x double")
    distance = lambda held: np.abs(held["x"].to_numpy()[:, None] - held["x"].to_numpy()[None])
    got = {r["id"]: r["label"] for r in clustering.cluster_blocks(rows, "canopy", "id", ["x"], distance, 1.0).collect()}
    assert got == {0: "a-0", 1: "a-0", 2: "a-1", 9: "9"}


@settings(max_examples=60, deadline=None)
@given(st.integers(2, 40), st.integers(0, 10**6), st.sampled_from([1, 60, 1 << 20]), st.booleans())
def test_lean_linkage_equals_linkage(n, seed, room, ties):
    x = np.random.default_rng(seed).integers(0, 6, n).astype(float) if ties else np.random.default_rng(seed).normal(size=n)
    distance = lambda held: np.abs(held["x"].to_numpy()[:, None] - held["x"].to_numpy()[None])
    held = pd.DataFrame({"x": x})
    z = clustering.lean_linkage(held, clustering.between(distance), room)
    assert list(z[:, 2]) == sorted(z[:, 2]) and z[-1, 3] == n
    if not ties:
        assert np.allclose(z, clustering.linkage(distance(held)))


def test_large_blocks_are_clustered(spark):
    x = np.random.default_rng(3).normal(size=60)
    rows = spark.createDataFrame([("a" if i < 50 else f"b{i % 4}", i, float(v)) for i, v in enumerate(x)], "canopy string, id long, x double")
    distance = lambda held: np.abs(held["x"].to_numpy()[:, None] - held["x"].to_numpy()[None])
    by = lambda most: sorted(map(tuple, clustering.cluster_blocks(rows, "canopy", "id", ["x"], distance, 0.3, most).collect()))
    assert by(2) == by(100) and len(by(2)) == 60
    pick = lambda r: (r["canopy"], r["step"], tuple(r["left_keys"]), tuple(r["right_keys"]), round(r["height"], 9), r["elements"])
    merges = lambda most: sorted(map(pick, clustering.merge_table(rows, "canopy", "id", ["x"], distance, most).collect()))
    assert merges(2) == merges(100) and len(merges(2)) == 60 - 5


def test_override_and_touched(spark):
    old = spark.createDataFrame([(1, "o"), (2, "o")], "k int, v string")
    new = spark.createDataFrame([(2, "n"), (3, "n")], "k int, v string")
    assert sorted(map(tuple, relational.override(old, new, "k").collect())) == [(1, "o"), (2, "n"), (3, "n")]
    assert sorted(map(tuple, relational.touched(old, new, "k").collect())) == [(2, "n"), (2, "o"), (3, "n")]


def test_batches_reset(spark):
    sizes = spark.createDataFrame([("g", f"k{i}", n) for i, n in enumerate([3, 3, 5, 1, 1])], "g string, k string, n long")
    got = {r["k"]: r["batch"] for r in relational.batches(sizes, "g", "k", "n", 5).collect()}
    assert got == {"k0": 0, "k1": 0, "k2": 1, "k3": 2, "k4": 2}


def test_mapping_file_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("m1", "e1"), ("m2", "e1")], "mention string, entity string")
    sinks.mapping_file(rows, str(tmp_path / "map"))
    assert sorted(map(tuple, registry.tsv(spark, str(tmp_path / "map"), registry.PAIR_FILE, header=False).collect())) == [("m1", "e1"), ("m2", "e1")]


def test_lines_of_wrong_arity_go(spark, tmp_path):
    (tmp_path / "bad.tsv").write_text("a\tb\nonly\nc\td\nx\ty\tz\n")
    rows = registry.tsv(spark, str(tmp_path / "bad.tsv"), registry.PAIR_FILE, header=False)
    assert rows.count() == 2 and sorted(map(tuple, rows.collect())) == [("a", "b"), ("c", "d")]


def test_line_ranges_of_split_files(spark, tmp_path):
    (tmp_path / "long.tsv").write_text("mention\tentity\n" + "".join(f"m{i}\te{i}\n" for i in range(9000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        rows = registry.tsv(spark, str(tmp_path / "long.tsv"), registry.PAIR_FILE, first=5000, last=5009)
        assert sorted(r["mention"] for r in rows.collect()) == [f"m{i}" for i in range(5000, 5010)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_quotes_are_kept_where_quoting_is_off(spark, tmp_path):
    (tmp_path / "q.tsv").write_text('"a\tb"\n')
    assert tuple(registry.tsv(spark, str(tmp_path / "q.tsv"), registry.PAIR_FILE, header=False, quote="").first()) == ('"a', 'b"')


def test_dictionaries(spark, tmp_path):
    (tmp_path / "words.txt").write_text("one\n\ntwo three\n")
    assert [r["word"] for r in registry.dictionary(spark, str(tmp_path / "words.txt")).orderBy("position").collect()] == ["one", "two three"]
    (tmp_path / "ab.json").write_text('{"co": "company"}')
    assert registry.dictionary(spark, str(tmp_path / "ab.json")).first()["value"] == "company"
    (tmp_path / "codes.csv").write_text('"korea, south",kr\nfrance,\n')
    assert sorted(map(tuple, registry.codes(spark, str(tmp_path / "codes.csv")).collect()), key=str) == [("france", None), ("korea, south", "kr")]


def test_families(spark, tmp_path):
    (tmp_path / "fam.csv").write_text("number,patent,kind,docdb,inpadoc\n1,P1,A,d1,i1\n2,P2,A,d1,i2\n")
    docdb, inpadoc = registry.families(spark, str(tmp_path / "fam.csv"))
    assert docdb.count() == 1
    assert inpadoc.count() == 2


def test_results_and_absent_sources(spark, tmp_path):
    rows = spark.createDataFrame([("m1", "e1"), ("m2", "e1")], "mention string, entity string")
    sinks.table(rows, str(tmp_path / "run" / "job-1"))
    sinks.table(rows, str(tmp_path / "run" / "job-2-internals"))
    assert registry.results(spark, str(tmp_path / "run")).count() == 2
    assert registry.newer_than(spark.read.parquet(str(tmp_path / "run" / "job-1")), "2000-01-01").count() == 2
    assert registry.Source("gone", "none").read(spark).count() == 0


def test_log_of_small_merges(spark, tmp_path):
    rows = spark.createDataFrame([("a", i, float(i * i)) for i in range(4)], "canopy string, id long, x double")
    distance = lambda held: np.abs(held["x"].to_numpy()[:, None] - held["x"].to_numpy()[None])
    log = clustering.merge_table(rows, "canopy", "id", ["x"], distance)
    for _ in range(2):
        sinks.small_merges(log, str(tmp_path / "log"), below=4)
    lines = sorted(r["value"] for r in spark.read.text(str(tmp_path / "log")).collect())
    assert len(lines) == 4 and lines[0] == lines[1] and lines[0].startswith('a,0,"[""0""]","[""1""]"')


def test_crowded_keys_and_layouts(spark):
    rows = spark.createDataFrame([("1234567890", "x"), ('"123"', "y")], "patent_id string, uuid string")
    assert sorted(map(tuple, registry.assignee_rows(rows).select("uuid", "patent_id", "document_number").collect())) == [("x", None, "1234567890"), ("y", "123", None)]
    assert sinks.unique_key(rows.union(rows.limit(1)), ["uuid"]).count() == 1
    canopies, mentions = spark.createDataFrame([("c", "x"), ("d", "y")], "canopy string, uuid string"), rows
    assert registry.of_canopies(canopies, mentions, spark.createDataFrame([("c",)], "canopy string")).first()["uuid"] == "x"


def test_dense_pairs_in_parts(spark):
    rng = np.random.default_rng(4)
    data = [(i, i % 2, [float(x) for x in rng.normal(size=3)]) for i in range(40)] + [(90, 0, None), (91, 0, [0.0] * 3)]
    got = scoring.dense_pairs(spark.createDataFrame(data, "id long, block int, v array<double>"), "block", "id", "v", 0.3, size=7).collect()
    unit = {i: (b, np.array(v) / np.linalg.norm(v)) for i, b, v in data[:40]}
    want = {(i, j) for i in unit for j in unit if i < j and unit[i][0] == unit[j][0] and unit[i][1] @ unit[j][1] >= 0.3}
    assert {(r["id_a"], r["id_b"]) for r in got} == want and len(got) == len(want)


def people_rows(spark, n=36):
    rng = np.random.default_rng(6)
    rows = [(i, str(rng.choice(["ann", "bob"])) if i % 7 else None, [f"t{x}" for x in sorted(set(rng.integers(0, 6, 3).tolist()))], [float(x) for x in rng.normal(size=3)]) for i in range(n)]
    blocks = sorted({(f"b{b}", i) for i in range(n - 2) for b in rng.integers(0, 5, 2).tolist()})
    return rows, blocks, spark.createDataFrame(rows, "mention long, first string, terms array<string>, v array<double>"), spark.createDataFrame(blocks, "block string, mention long")


SETTINGS = resolve.Settings((scoring.Feature("first", "no_match", must_not=True), scoring.Feature("terms", "shared", 0.5), scoring.Feature("v", "cosine", 2.0)), least=1.2)


def test_resolution_end_to_end(spark):
    rows, blocks, mentions, where = people_rows(spark)

    def score(a, b):
        shared = len(set(a[2]) & set(b[2]))
        x, y = np.array(a[3]), np.array(b[3])
        return (-20000.0 if a[1] and b[1] and a[1] != b[1] else 0.0) + 0.5 * shared + 2.0 * x @ y / np.linalg.norm(x) / np.linalg.norm(y)

    root = {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for b in {b for b, _ in blocks}:
        own = [rows[i] for name, i in blocks if name == b]
        d = [[1 / (1 + max(score(x, y), -20000.0) + 20000.0) for y in own] for x in own]
        for group in brute_linkage(d, SETTINGS.cut):
            group = sorted(group)
            for i in group[1:]:
                x, y = find(own[group[0]][0]), find(own[i][0])
                root[max(x, y)] = min(x, y)
    want = {i: find(i) for i in root}
    got = {r["mention"]: r["entity"] for r in resolve.resolve(mentions, where, SETTINGS).collect()}
    assert got == want and len(got) == 36 and 1 < len(set(got.values())) < 36
    pairs = scoring.score(scoring.pairs(mentions.withColumn("block", F.lit(1)), "block", "mention", ["first", "terms", "v"]), list(SETTINGS.features))
    for r in pairs.filter("mention_a < 4").collect():
        assert r["score"] == pytest.approx(score(rows[r["mention_a"]], rows[r["mention_b"]]))


def test_inserting_equals_resolving_anew(spark):
    rows, blocks, mentions, where = people_rows(spark)
    old = resolve.clusters(where.filter("mention < 25").join(mentions, "mention"), SETTINGS)
    got = sorted(map(tuple, resolve.inserted(old, mentions, where, SETTINGS).collect()))
    assert got == sorted(map(tuple, resolve.resolve(mentions, where, SETTINGS).collect()))


def test_settings_and_structure(spark, tmp_path):
    import datetime as dt

    settings = resolve.Settings((), 0.0, output="out", start=dt.date(2020, 1, 1), end=dt.date(2020, 6, 30))
    assert settings.path("canopies") == "out/20200630/canopies"
    with pytest.raises(ValueError):
        resolve.Settings((), 0.0, start=dt.date(2020, 1, 1))
    rows = spark.createDataFrame([("a b", 1), ("c", 2)], "location string, n int")
    assert sorted(map(tuple, resolve.structure(rows, {"location", "uuid"}, ("location",)).collect())) == [("missing uuid", 1), ("white space in location", 1)]
    assert [r["problem"] for r in resolve.structure(rows.limit(0), {"location"}).collect()] == ["empty"]
    sinks.table(rows.repartition(2), str(tmp_path / "two"))
    assert resolve.enough_files(spark.read.parquet(str(tmp_path / "two")), 2) and not resolve.enough_files(spark.read.parquet(str(tmp_path / "two")), 3)
