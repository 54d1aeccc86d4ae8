"""Each operator against brute force on small crafted tables: nulls, empty and long texts, ties, repeated rows, extra columns."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from kinfold.llm import agenda_pieces, anchors, automaton_dedup, bpe, minhash_join, packing, pii, quality_fm, suffix_dedup, toxicity, vector_dedup, winnowing, words
from kinfold.llm import components as hubs
from kinfold.llm.components import components

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double"


def corpus(seed=1, n=40):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    base = [" ".join(rng.choice(vocab) for _ in range(rng.randint(0, 220))) for _ in range(n)]
    passage = " ".join(rng.choice(vocab) for _ in range(70))
    out = []
    for i, text in enumerate(base):
        if i % 5 == 1:
            text = text + " " + passage + "\t" + text[:150]
        if i % 7 == 2:
            words = base[i - 1].split()
            words[len(words) // 2 : len(words) // 2 + 1] = ["changed"]
            text = " ".join(words)
        if i % 11 == 3:
            text = base[0]
        out.append((i * 3 + 50, text))
    out += [(2, None), (1, ""), (4, " \n\t "), (6, "one two"), (7, "One TWO"), (9, "a" * 3000), (10, "a" * 3000), (11, "z" * 250)]
    rng.shuffle(out)
    return out


@pytest.fixture(scope="module")
def rows():
    return corpus()


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0, 1.0) for i, t in rows], COLUMNS).repartition(3)


def groups(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("few", [0, 200_000])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(hubs, "HUB", 3)
    monkeypatch.setattr(hubs, "FEW", few)
    edges = spark.createDataFrame([(i + 1, i) for i in range(50)] + [(100, 101), (7, 7)] + [(200, 300 + i) for i in range(30)] + [(999, 400 + i) for i in range(30)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 51)}, 101: 100, **{300 + i: 200 for i in range(30)}, **{400 + i: 400 for i in range(1, 30)}, 999: 400}


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(spark, rows, k, percent, monkeypatch):
    monkeypatch.setattr(minhash_join, "BLOCK", 3)
    monkeypatch.setattr(minhash_join, "LONG", 4)
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = groups(ids, links)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash_join.near_duplicates(frame(spark, rows), k, percent).collect()}
    assert got == {i: (len(sets[i]), root[i], root[i] == i) for i in ids}
    assert len(links) > 3


def dense(n, seed=9):
    """Copies of one text with more or fewer words changed."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(60)]
    out = []
    for i in range(n):
        own = list(base)
        for _ in range(rng.choice((0, 1, 1, 2, 3, 6))):
            own[rng.randrange(60)] = rng.choice(("x", "y", f"z{i}"))
        out.append((i, " ".join(own)))
    return out


def test_dense_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash_join, "BLOCK", 12)
    monkeypatch.setattr(minhash_join, "LONG", 20)
    rows = dense(150)
    sets = {i: {tuple(t.split()[j : j + 3]) for j in range(58)} for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    root = groups(sets, links)
    got = {r["doc_id"]: r["component_id"] for r in minhash_join.near_duplicates(frame(spark, rows), 3, 85).collect()}
    assert got == root
    assert 1 < len(set(root.values())) < 100


def test_first_copies(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(1, a), (1, a), (1, b), (2, a + " more"), (None, b + " more"), (None, None), (3, ""), (3, ""), (4, "alone")]
    out = minhash_join.first_copies(frame(spark, rows))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"]
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    assert got == sorted([(1, a), (None, b + " more"), (None, None), (3, ""), (3, ""), (4, "alone")], key=str)
    assert minhash_join.first_copies(frame(spark, [])).count() == 0


def thue_morse():
    """Two words that every polynomial modulo 2**64 confuses."""
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_that_collide_in_polynomials(spark):
    one, two = thue_morse()
    long = ("c" * 9000, "c" * 4999 + "d" + "c" * 4000)
    rows = [(1, one), (2, two), (3, long[0]), (4, long[1])]
    assert all(r["kept"] for r in minhash_join.near_duplicates(frame(spark, rows), 3, 85).collect())
    data = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    at = np.cumsum([0] + [len(t) for _, t in rows])
    assert len(set(words.hashes(data, at[:-1], at[1:]).tolist())) == 4


def test_near_duplicates_of_all_sets_of_an_id(spark):
    a, b, c, d = ([f"{x}{i}" for i in range(60)] for x in "abcd")
    near = lambda w: " ".join([*w, "more"])
    rows = [(None, " ".join(a)), (None, " ".join(b)), (1, near(a)), (2, near(b)), (3, " ".join(c)), (3, " ".join(d)), (4, near(c)), (5, near(d)), (6, "alone")]
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in minhash_join.near_duplicates(frame(spark, rows), 3, 85).collect()}
    assert got == {(None, None, True), (1, None, False), (2, None, False), (3, 3, True), (4, 3, False), (5, 3, False), (6, 6, True)}


@pytest.mark.parametrize(("coordinates", "percent"), [(32, 80), (32, 85), (48, 85)])
def test_few_pairs_miss_the_match_threshold(coordinates, percent):
    s, enough = percent / 100, minhash_join.match_threshold(coordinates, percent)
    under = [math.comb(coordinates, i) * s**i * (1 - s) ** (coordinates - i) for i in range(enough + 1)]
    assert sum(under[:-1]) <= 1 / 30_000 < sum(under)


def test_near_duplicates_of_nothing(spark):
    assert minhash_join.near_duplicates(frame(spark, [])).count() == 0


def removed(units, length, within):
    """Marks of the units that go, by document in ascending order of ids."""
    seen, out = set(), {}
    for i in sorted(units):
        u, own = units[i], set()
        gone = [False] * len(u)
        for s in range(len(u) - length + 1):
            w = tuple(u[s : s + length])
            if w in seen or (within and w in own):
                gone[s : s + length] = [True] * length
            own.add(w)
        seen |= own
        out[i] = gone
    return out


@pytest.mark.parametrize("shard", [2, 1024])
@pytest.mark.parametrize("length", [30, 100])
def test_byte_repeats(spark, rows, length, shard, monkeypatch):
    monkeypatch.setattr(anchors, "SHARD", shard)
    texts = {i: (t or "").encode() for i, t in rows}
    gone = removed(texts, length, True)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.digest(frame(spark, rows), length).collect()}
    for i, b in texts.items():
        kept = bytes(x for x, g in zip(b, gone[i]) if not g)
        spans = sum(g and not (j and gone[i][j - 1]) for j, g in enumerate(gone[i]))
        assert got[i] == (len(b), sum(gone[i]), spans, hashlib.sha256(kept).hexdigest())
    assert sum(map(sum, gone.values())) > 500


def documents_in_order(spark, rows):
    """(doc_id, text) without exact repeats, by doc_id (null first) and a hash of the text."""
    plain = spark.createDataFrame([(i, t or "") for i, t in rows], "doc_id long, text string").distinct()
    got = plain.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    return [(r["doc_id"], r["text"]) for r in sorted(got, key=lambda r: (-(2**63) if r["doc_id"] is None else r["doc_id"], r["h"]))]


@pytest.mark.parametrize("shard", [2, 1024])
def test_repeats_among_rows_of_one_id(spark, shard, monkeypatch):
    monkeypatch.setattr(anchors, "SHARD", shard)
    rng = random.Random(12)
    part = [" ".join(f"{rng.choice('abcdefgh')}{rng.randrange(30)}" for _ in range(60)) for _ in range(4)]
    rows = [(1, part[0]), (1, part[0]), (2, part[0]), (7, part[0]), (7, part[1] + " " + part[2]), (7, part[3]), (None, part[2]), (None, part[2]), (None, part[1]), (9, part[1] + " x " + part[3]), (None, None), (None, ""), (8, part[0][:200])]
    order = documents_in_order(spark, rows)
    gone = removed({k: t.encode() for k, (_, t) in enumerate(order)}, 100, True)
    want = {(i, hashlib.sha256(bytes(x for x, g in zip(t.encode(), gone[k]) if not g)).hexdigest(), sum(gone[k])) for k, (i, t) in enumerate(order)}
    got = suffix_dedup.digest(frame(spark, rows), 100).collect()
    assert {(r["doc_id"], r["kept_sha256"], r["n_removed"]) for r in got} == want
    assert len(got) == len(rows)
    gone = removed({k: t.split() for k, (_, t) in enumerate(order)}, 50, False)
    want = {(i, hashlib.sha256(" ".join(x for x, g in zip(t.split(), gone[k]) if not g).encode()).hexdigest(), sum(gone[k])) for k, (i, t) in enumerate(order)}
    got = automaton_dedup.digest(frame(spark, rows), 50).collect()
    assert {(r["doc_id"], r["kept_sha256"], r["n_removed"]) for r in got} == want
    assert len(got) == len(rows)
    assert suffix_dedup.digest(frame(spark, [])).count() == automaton_dedup.digest(frame(spark, [])).count() == 0


def test_whole_characters(spark):
    text = "é" * 80
    rows = [(1, "a" + text), (2, "b" + text[:70] + "x")]
    out = suffix_dedup.cut_out(frame(spark, rows), 101, whole_characters=True, keep=("lang",))
    assert {r["doc_id"]: bytes(r["kept"]).decode() for r in out.collect()}[1]
    assert out.columns == ["doc_id", "lang", "kept", "n_bytes", "n_removed", "n_spans"]


@pytest.mark.parametrize("shard", [2, 1024])
@pytest.mark.parametrize("length", [8, 50])
def test_word_repeats(spark, rows, length, shard, monkeypatch):
    monkeypatch.setattr(anchors, "SHARD", shard)
    texts = {i: (t or "").encode().split() for i, t in rows}
    gone = removed(texts, length, False)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in automaton_dedup.digest(frame(spark, rows), length).collect()}
    for i, w in texts.items():
        kept = b" ".join(x for x, g in zip(w, gone[i]) if not g)
        assert got[i] == (len(w), sum(gone[i]), hashlib.sha256(kept).hexdigest())
    assert sum(map(sum, gone.values())) > 100


def test_against_a_reference(spark):
    docs = frame(spark, [(1, "a b c d e f"), (2, "x b c d y"), (3, None)])
    reference = spark.createDataFrame([("b c d",), (None,)], "text string")
    got = {r["doc_id"]: bytes(r["kept"]) for r in automaton_dedup.against(docs, reference, 3).collect()}
    assert got == {1: b"a e f", 2: b"x y", 3: b""}


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 50, 400):
        data = rng.integers(0, 3, n).astype(np.uint8)
        raw = data.tobytes()
        order = suffix_dedup.suffix_array(data, max(1, n))
        assert order.tolist() == sorted(range(n), key=lambda i: raw[i:])
        shared = suffix_dedup.common_prefixes(data, order, max(1, n))
        for k in range(1, n):
            a, b = raw[order[k - 1] :], raw[order[k] :]
            assert shared[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_linked_vectors(spark):
    rng = np.random.default_rng(5)
    data, n = [], 60
    for i in range(n):
        v = rng.normal(size=8)
        data += [(10 * i + j, [float(x) for x in v + rng.normal(size=8) * 0.05 * j], int(i % 3), "x") for j in range(4)]
    data += [(9001, data[0][1], 0, "x"), (9002, [2 * x for x in data[0][1]], 0, "x"), (9003, None, 0, "x"), (9004, [0.0] * 8, 0, "x"), (9005, [float("nan")] * 8, 0, "x"), (9006, data[0][1], None, "x"), (9007, [1.0, 2.0], 0, "x"), (9008, [None] * 8, 0, "x"), (9009, [], 0, "x")]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vector_dedup.linked_vectors(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int, dim string")).collect()}
    good = {i: (np.array(v), label) for i, v, label, _ in data if label is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    links = [(a, b) for a in good for b in good if a < b and good[a][1] == good[b][1] and len(good[a][0]) == len(good[b][0]) and good[a][0] @ good[b][0] / np.linalg.norm(good[a][0]) / np.linalg.norm(good[b][0]) >= 0.98]
    root = groups([r[0] for r in data], links)
    count = {i: sum(i in x for x in links) for i in root}
    assert got == {i: (count[i], root[i], root[i] == i) for i in root}
    assert len(links) > 20


@pytest.mark.parametrize(("operator", "column"), [(toxicity.toxicity, "toxic"), (quality_fm.quality, "quality")])
def test_classifiers(spark, operator, column):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(900):
        bad = i % 3 == 0
        words = [rng.choice(["the", "and", "tree", "house", "river", "walk"]) for _ in range(rng.randint(5, 40))]
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["dreadful", "rotten"])
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad), 1))
    docs += [(2000, None), (2001, ""), (2002, "rotten " * 20_000)]
    labels += [(5000, 1, 1), (3, None, 1)]
    got = operator(frame(spark, docs), spark.createDataFrame(labels, f"doc_id long, {column} int, text int")).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, _ in docs)
    held = [r for r in got if r["held_out"] and r["doc_id"] < 2000]
    mod, own = (5, 0) if column == "toxic" else (3, 1)
    assert {r["doc_id"] for r in held} == {i for i, _ in docs if zlib.crc32(b"%d" % i) % mod == own and i < 2000}
    assert np.mean([r["predicted"] == (r["doc_id"] % 3 == 0) for r in held]) > 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    same = {r["doc_id"]: r["score"] for r in got}
    assert same[2000] == same[2001]


def test_ftrl_is_the_plain_algorithm():
    """Against one dictionary entry per coordinate, after the published update."""
    rng = np.random.default_rng(3)
    rows = [(np.unique(rng.integers(0, 40, rng.integers(0, 9))) + rng.choice([0, 1 << toxicity.BITS]), int(rng.integers(0, 2))) for _ in range(200)]
    model = toxicity.Ftrl(alpha=0.2, beta=0.5, l1=0.1, l2=0.3)
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= 0.1:
            return 0.0
        return -(z[i] - math.copysign(0.1, z[i])) / ((0.5 + math.sqrt(n[i])) / 0.2 + 0.3)

    for at, label in rows:
        model.learn(at, label)
        x = {int(i): 1.0 if i < 1 << toxicity.BITS else toxicity.PAIR for i in at} | {toxicity.SIZE - 1: 1.0}
        w = {i: weight(i) for i in x}
        p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
        for i, v in x.items():
            g = (p - label) * v
            z[i] = z.get(i, 0.0) + g - (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / 0.2 * w[i]
            n[i] = n.get(i, 0.0) + g * g
    got = model.weights(np.arange(toxicity.SIZE))
    assert np.allclose(got[sorted(z)], [weight(i) for i in sorted(z)], atol=1e-12)
    assert np.count_nonzero(got) == sum(weight(i) != 0 for i in z) < len(z)


def test_machine_equals_the_sum_over_pairs():
    rng = np.random.default_rng(4)
    model = quality_fm.Machine()
    for _ in range(30):
        at = np.unique(rng.integers(0, quality_fm.SIZE, 12))
        x = rng.normal(size=len(at))
        plain = model.w0 + sum(model.w[i] * v for i, v in zip(at, x))
        plain += sum(model.v[at[a]] @ model.v[at[b]] * x[a] * x[b] for a in range(len(at)) for b in range(a + 1, len(at)))
        assert model.raw(at, x)[0] == pytest.approx(plain)
        before = abs(1 / (1 + math.exp(-plain)) - 1)
        model.learn(at, x, 1)
        assert abs(1 / (1 + math.exp(-model.raw(at, x)[0])) - 1) < before + 1e-9


def test_a_repeated_id_is_learnt_from_once(spark):
    docs = frame(spark, [(1, f"text {i}") for i in range(50)] + [(2, "other")])
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    assert toxicity.labelled(docs, labels, "toxic", None, 8).count() == 2


PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


def every_operator(spark, docs):
    """Name -> rows of each operator on documents, with labels for the classifiers."""
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(20)], "doc_id long, toxic int, quality int")
    return {
        "op2": suffix_dedup.digest(docs), "op3": toxicity.toxicity(docs, labels), "op4": quality_fm.quality(docs, labels), "op5": packing.pack(docs, WORDS),
        "op6": winnowing.fingerprints(docs), "op7": automaton_dedup.digest(docs), "op8": agenda_pieces.encode_decode(docs, PIECES), "op9": pii.digest(docs),
        "op10": minhash_join.near_duplicates(docs, 3, 85),
    }


def test_every_operator_on_an_empty_table(spark):
    docs = spark.createDataFrame([], COLUMNS)
    assert {k: v.count() for k, v in every_operator(spark, docs).items() if v.count()} == {}
    assert vector_dedup.linked_vectors(spark.createDataFrame([], "vec_id long, label int, embedding array<float>")).count() == 0


def test_every_operator_on_odd_rows(spark):
    """Null and repeated ids, null and empty texts, ties, a very long text, and columns named like the operators' own."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [(None, "null id one"), (None, "null id two"), (None, None), (3, "same text"), (3, "same text"), (3, "another text"), (4, ""), (5, None), (6, long), (7, "a@b.co a@b.co")]
    columns = "doc_id long, text string, side long, rep long, root long, n long, h long, sig string, g string, runs string, label string, score string, base string, spans string, run string, part string, rank string, length string"
    docs = spark.createDataFrame([(i, t, *[0] * 5, *["x"] * 11) for i, t in rows], columns).repartition(3)
    ids = sorted((i for i, _ in rows), key=str)
    for name, out in every_operator(spark, docs).items():
        got = out.collect()
        seen = [r["doc_id"] for r in got if name != "op5" or r["piece"] == 0]
        assert sorted(seen, key=str) == ids, name
        twice = [tuple(v for k, v in r.asDict().items() if k not in ("sequence_id", "offset")) for r in got if r["doc_id"] == 3]
        if name not in ("op6",):
            assert len(set(map(str, twice))) <= 2, name
    vectors = [(None, 1, [1.0, 0.0], 1), (None, 1, [1.0, 0.0], 2), (2, 1, [1.0, 0.0], 3), (2, 1, [0.0, 1.0], 4), (3, None, [1.0, 0.0], 5)]
    got = vector_dedup.linked_vectors(spark.createDataFrame(vectors, "vec_id long, label int, embedding array<double>, copies int")).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in got) == [("2", 0, "2"), ("2", 2, "None"), ("3", 0, "3"), ("None", 2, "None"), ("None", 2, "None")]


def test_texts_whose_words_collide_in_polynomials(spark):
    one, two = thue_morse()
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    docs = frame(spark, [(1, one), (2, two)])
    got = {r["doc_id"]: r["ids_crc32"] for r in packing.pack(docs, WORDS).collect()}
    assert got == {i: zlib.crc32(np.array(library.encode(t, add_special_tokens=False).ids + [1], "<u4").tobytes()) for i, t in ((1, one), (2, two))}
    got = {r["doc_id"]: r["decoded_sha256"] for r in agenda_pieces.encode_decode(docs, PIECES).collect()}
    assert got == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in ((1, one), (2, two))}


def test_classifier_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.toxicity(frame(spark, [(1, "a")]), labels).first()["score"] == pytest.approx(0.5)


def test_pieces(spark, rows):
    path = public_tokenizers.path("piece_bpe_32k.model")
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    more = [(900, "▁ ▁▁a  b"), (901, "<s> é́ 中文 🙂\r\n\x00"), (902, "  x  ")]
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in agenda_pieces.encode_decode(frame(spark, rows + more), path).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for i, t in rows + more:
        ids = sp.encode(t or "", add_eos=True)
        assert got[i] == (len(ids), sha(" ".join(map(str, ids))), sha(sp.decode(ids)))


def test_merge_in_step_equals_heap():
    rng = np.random.default_rng(8)
    left, right = np.divmod(rng.permutation(36)[:14], 6)
    pairs = bpe.Pairs(left, right, rng.integers(0, 5, 14), rng.integers(0, 9, 14))
    counts = rng.integers(0, 30, 300)
    symbols = rng.integers(0, 6, counts.sum())
    flat, sizes = pairs.merge(symbols, counts)
    at, out = np.concatenate(([0], np.cumsum(counts))), np.concatenate(([0], np.cumsum(sizes)))
    for i in range(len(counts)):
        assert flat[out[i] : out[i + 1]].tolist() == pairs.heap(symbols[at[i] : at[i + 1]].tolist())


def test_packing(spark, rows):
    path = public_tokenizers.path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    got = packing.pack(frame(spark, rows), path, capacity=64).collect()
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [1] for i, t in rows}
    by, bins = {}, {}
    for r in got:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        by.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"]))
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, own in by.items():
        assert [p for p, _, _ in sorted(own)] == list(range(len(own)))
        assert all(n == 64 for _, _, n in sorted(own)[:-1])
        assert sum(n for _, _, n in own) == len(ids[i])
    for held in bins.values():
        end = 0
        for offset, n in sorted(held):
            assert offset == end
            end += n
        assert end <= 64
    assert set(by) == set(ids)
    assert len(bins) <= sum(len(x) for x in ids.values()) / 64 * 1.1 + 2


def test_solve_covers_exactly():
    rng = np.random.default_rng(2)
    histogram = {int(s): int(n) for s, n in zip(rng.choice(np.arange(1, 101), 40, replace=False), rng.integers(1, 500, 40))}
    configs = packing.solve(histogram, 100)
    held = {}
    for lengths, times in configs:
        assert sum(lengths) <= 100
        for x in lengths:
            held[x] = held.get(x, 0) + times
    assert held == histogram
    assert sum(n for _, n in configs) <= 1.01 * sum(n for _, n in packing.best_fit(dict(histogram), {}, 100))
    assert packing.solve({}, 100) == []


def test_program_places_nearly_all_of_thousands_of_lengths(monkeypatch):
    sizes = np.minimum(np.random.default_rng(5).lognormal(6.8, 0.9, 20_000).astype(int) + 1, 4096)
    histogram = {int(s): int(n) for s, n in zip(*np.unique(sizes, return_counts=True), strict=True)}
    assert len(histogram) > 2000
    alone, rests = sum(n for _, n in packing.best_fit(dict(histogram), {}, 4096)), []
    fit = packing.best_fit
    monkeypatch.setattr(packing, "best_fit", lambda rest, bins, capacity: rests.append(dict(rest)) or fit(rest, bins, capacity))
    configs = packing.placed(histogram, 4096, 0.01)
    assert sum(s * n for rest in rests for s, n in rest.items()) <= 0.01 * sizes.sum()
    held = {}
    for lengths, times in configs:
        assert sum(lengths) <= 4096
        for x in lengths:
            held[x] = held.get(x, 0) + times
    assert held == histogram
    assert sum(n for _, n in configs) <= 1.01 * alone


@pytest.mark.parametrize(("mean", "spread", "n", "capacity"), [(6.2, 0.9, 3000, 4096), (3.0, 0.6, 4000, 100), (6.9, 0.4, 2000, 4096), (7.4, 0.3, 1500, 4096)])
def test_never_more_sequences_than_best_fit(mean, spread, n, capacity):
    sizes = np.minimum(np.random.default_rng(7).lognormal(mean, spread, n).astype(int) + 1, capacity)
    histogram = {int(s): int(c) for s, c in zip(*np.unique(sizes, return_counts=True), strict=True)}
    for counts in (histogram, {s: 50 * c for s, c in histogram.items()}):
        used = sum(t for _, t in packing.solve(counts, capacity))
        assert packing.least_sequences(counts, capacity) <= used <= sum(t for _, t in packing.best_fit(dict(counts), {}, capacity))
    assert used <= 1.04 * packing.least_sequences(counts, capacity)


def chosen_by_hand(spark, texts):
    """text -> [(position, hash)] that winnowing keeps, in Python from Spark's hashes of units."""
    def units(t):
        return re.findall(r"[^ \t\n\x0B\f\r]{1,%d}" % winnowing.CUT, t.lower())

    grams = {}
    for t in texts:
        u = units(t)
        n = max(len(u) - winnowing.K + 1, min(len(u), 1))
        grams[t] = [(u + [None] * winnowing.K)[i : i + winnowing.K] for i in range(n)]
    distinct = sorted({tuple(g) for own in grams.values() for g in own}, key=str)
    rows = spark.createDataFrame([(i, *g) for i, g in enumerate(distinct)], "i int, a string, b string, c string")
    one = lambda c: F.when(F.col(c).isNotNull(), F.xxhash64(c))
    value = {r["i"]: r["h"] for r in rows.select("i", F.xxhash64(one("a"), one("b"), one("c")).alias("h")).collect()}
    low = {g: value[i] & ((1 << 34) - 1) for i, g in enumerate(distinct)}
    signed = lambda h: h - (1 << 34) if h >> 33 else h
    out = {}
    for t, own in grams.items():
        h = [signed(low[tuple(g)]) for g in own]
        kept = []
        for s in range(max(len(h) - winnowing.WINDOW + 1, min(len(h), 1))):
            window = h[s : s + winnowing.WINDOW]
            p = s + max(k for k, x in enumerate(window) if x == min(window))
            if (p, h[p]) not in kept:
                kept.append((p, h[p]))
        out[t] = kept
    return out


def test_likeness_over_many_runs_of_sparse_ids(spark, monkeypatch):
    monkeypatch.setattr(winnowing, "RUN", 4)
    monkeypatch.setattr(winnowing, "SEGMENTS", 5)
    rng = random.Random(3)
    vocab = ["ab", "cd", "ef", "gh", "ij", "kl"]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randint(0, 30))) for _ in range(120)]
    ids = sorted({rng.randrange(-(2**62), 2**62) for _ in range(60)} | {10 * i for i in range(60)})
    rows = list(zip(ids, texts, strict=False))
    got = {r["doc_id"]: r for r in winnowing.fingerprints(frame(spark, rows)).collect()}
    edited = {}
    for k, (i, t) in enumerate(rows):
        follow = rows[(k + 1) % len(rows)][1]
        tail = len(t) // 4
        edited[i] = t[: len(t) - tail] + follow[:tail]
    hand = chosen_by_hand(spark, {*texts, *edited.values()})
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for k, (i, t) in enumerate(rows):
        own, after, changed = ({h for _, h in hand[x]} for x in (t, rows[(k + 1) % len(rows)][1], edited[i]))
        assert got[i]["edited_sha256"] == hashlib.sha256(edited[i].encode()).hexdigest()
        assert [int(x.split(":")[0]) for x in got[i]["fingerprint"].split(",") if x] == [p for p, _ in hand[t]]
        assert got[i]["near_next"] == pytest.approx(like(own, after))
        assert got[i]["near_edited"] == pytest.approx(like(own, changed))


def test_fingerprints(spark, rows):
    got = {r["doc_id"]: r for r in winnowing.fingerprints(frame(spark, rows)).collect()}
    order = sorted((i, t or "") for i, t in rows)
    for at, (i, t) in enumerate(order):
        follow = order[(at + 1) % len(order)][1]
        tail = len(t) // 4
        edited = t[: len(t) - tail] + follow[:tail]
        r = got[i]
        assert r["n_chars"] == len(t)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1
        assert 0 <= r["near_next"] <= 1
        assert (r["fingerprint"] == "") == (not t.split())
    same = {}
    for i, t in order:
        same.setdefault(t, set()).add(got[i]["fingerprint"])
    assert all(len(x) == 1 for x in same.values())
    assert got[9]["near_next"] == 1.0


def test_winnowing_keeps_the_rightmost_smallest(spark):
    text = " ".join(random.Random(1).choice("abcd") for _ in range(60))
    row = spark.createDataFrame([(text,)], "text string")
    units = F.transform(winnowing.units(F.col("text")), lambda w: F.xxhash64(w))
    grams = F.transform(F.sequence(F.lit(0), F.size("u") - winnowing.K), lambda i: F.xxhash64(*[F.get(F.col("u"), i + j) for j in range(winnowing.K)]))
    hashes = [(h << 30 & (1 << 64) - 1) >> 30 for h in row.select(units.alias("u")).select(grams.alias("g")).first()["g"]]
    signed = [h - (1 << 34) if h >> 33 else h for h in hashes]
    want = []
    for s in range(len(signed) - winnowing.WINDOW + 1):
        window = signed[s : s + winnowing.WINDOW]
        p = s + max(k for k, h in enumerate(window) if h == min(window))
        if p not in want:
            want.append(p)
    printed = row.select(winnowing.printed(winnowing.selected(F.col("text"))).alias("x")).first()["x"]
    assert [int(x.split(":")[0]) for x in printed.split(",")] == want


def base_spans(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    luhn = lambda s: sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(s)))) % 10 == 0
    return {
        "email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)],
        "ip": [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))],
        "card": [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))],
        "phone": [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m[0])) <= 15],
    }


def test_personal_data(spark):
    rng = random.Random(6)
    alphabet = "0123456789 -.+()@aZ%_é🙂\n"
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))) for i in range(1500)]
    rows += [(9000 + i, t) for i, t in enumerate(["x@y.z-@a.b", "1.2.3.4.5.6.7.8", "000.0001.255.1", "4111 1111 1111 1111", "+1 (555) 123-4567", "a" * 9000, "1" * 3000, "@" * 300, None, "call (030) 123-4567 ok", "mail bob (at) site (dot) com", "look at site.now"])]
    got = {r["doc_id"]: r for r in pii.digest(frame(spark, rows)).collect()}
    for i, t in rows:
        want = base_spans(t or "")
        shown = ",".join(f"{k}:{a}:{b}" for k, own in want.items() for a, b in own)
        r = got[i]
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [len(x) for x in want.values()]
        assert r["base_sha256"] == hashlib.sha256(shown.encode()).hexdigest()
        assert set(shown.split(",")) - {""} <= set(r["spans"].split(","))
    assert got[9009]["spans"] == "phone:5:19"
    assert got[9010]["spans"] == "email:5:28"
    assert got[9011]["spans"] == ""


def test_detect_keeps_columns(spark):
    rows = spark.createDataFrame([("a@b.co", 1, "x", [2]), (None, 2, "y", None)], "text string, base int, _email string, spans array<int>")
    out = pii.detect(rows)
    assert out.columns == ["text", "base", "_email", "spans", "pii"]
    got = out.orderBy("base").collect()
    assert (got[0]["base"], got[0]["_email"], got[0]["spans"], got[0]["pii"]["n_email"]) == (1, "x", [2], 1)
    assert got[1]["pii"]["spans"] == []
    with pytest.raises(ValueError):
        pii.detect(out)


def test_common_forms_are_proposed_and_accepted(spark):
    texts = ["host 2001:db8::8a2e:370:7334 up", "address fe80::1a2b", "phone 06 12 34 56 78", "std::string and a::b", "the ratio 3:4", "ssn 123-45-6789", "visa 4000 1234 5678 9010"]
    got = {r["text"]: r["pii"]["spans"] for r in pii.detect(spark.createDataFrame([(t,) for t in texts], "text string")).collect()}
    kinds = {t: [(pii.KINDS[s["k"]], t[s["start"] : s["end"]]) for s in own] for t, own in got.items()}
    assert kinds[texts[0]] == [("ip", "2001:db8::8a2e:370:7334")]
    assert kinds[texts[1]] == [("ip", "fe80::1a2b")]
    assert kinds[texts[2]] == [("phone", "06 12 34 56 78")]
    assert kinds[texts[3]] == kinds[texts[4]] == []
    assert kinds[texts[5]] == [("ssn", "123-45-6789")]
    assert [k for k, _ in kinds[texts[6]]] == ["card"]


def test_trees_tell_held_out_sentences(spark):
    rows = pii.cells(pii.sentences(spark, 4000))
    trees = pii.boost(rows)
    right = total = 0
    for bins, label, held, n in rows:
        if held:
            right += n * ((sum(pii.tree_value(t, bins) for t in trees) > 0) == bool(label))
            total += n
    assert right / total > 0.9


def test_chains_of_candidates_and_cues(spark):
    one = lambda score, start, end: F.struct(F.lit(score).alias("score"), F.lit(3).alias("k"), F.lit(start).alias("start"), F.lit(end).alias("end"))
    text = F.lit("call 030-1234567, 030-7654321")
    row = spark.range(1).select(
        pii.selected(F.array(one(1.0, 0, 10), one(2.0, 8, 20), one(3.0, 18, 30))).alias("kept"),
        pii.found(text, "[0-9]+-[0-9]+", "[0-9]").alias("hits"),
    ).first()
    assert sorted((x["start"], x["end"]) for x in row["kept"]) == [(0, 10), (18, 30)]
    assert [x["left"] for x in row["hits"]] == ["call ", "call 030-1234567, "]


def test_redaction(spark):
    out = pii.detect(frame(spark, [(1, "call +1 (555) 123-4567 or a@b.co now"), (2, None), (3, "x")]))
    got = {r["doc_id"]: r["x"] for r in out.select("doc_id", pii.redacted(F.col("text"), F.col("pii.spans")).alias("x")).collect()}
    assert got == {1: "call [PHONE] or [EMAIL] now", 2: None, 3: "x"}
