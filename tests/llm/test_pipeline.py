"""The pipeline's stages, each on its predecessor's rows, against brute force."""

import random

import corpus_pipeline as cp


def test_stages(spark, tmp_path):
    rng = random.Random(9)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    texts = [" ".join(rng.choice(vocab) for _ in range(60)) for _ in range(400)]
    passage = " ".join(rng.choice(vocab) for _ in range(40))
    rows = []
    for i, t in enumerate(texts):
        if i % 10 == 0:
            t += " worthless scum"
        if i in (21, 33):
            t += " " + passage
        if i == 45:
            t = texts[44] + " tail"
        if i == 51:
            t += " write to me.you@mail.example.com soon"
        rows.append((i, t, "en", "src", len(t)))
    rows.append((1000, None, None, None, None))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i % 10 == 0)) for i in range(0, 400, 2)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = {}
    for name, stage in cp.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = {r["doc_id"]: r for r in docs.collect()}
        if name != "packing":
            assert docs.columns == list(cp.COLUMNS)
    kept = set(seen["toxicity"])
    assert not [i for i in kept if i % 10 == 0 and i < 400]
    assert kept == {r[0] for r in rows if r[0] % 10 or r[0] == 1000}
    assert set(seen["near_duplicates"]) == kept - {45}
    assert passage in seen["suffix_arrays"][21]["text"]
    assert passage not in seen["suffix_arrays"][33]["text"]
    assert "me.you@" not in seen["personal_data"][51]["text"]
    assert "[EMAIL]" in seen["personal_data"][51]["text"]
    assert seen["personal_data"][1]["text"] == texts[1]
    assert all(r["n_chars"] == len(r["text"] or "") for r in seen["suffix_arrays"].values())
    assert set(seen["packing"]) == set(seen["personal_data"])
    assert cp.run(spark, str(tmp_path)).count() == spark.read.parquet(str(tmp_path / "packing")).count()
