"""The queries op1 to op10: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kinfold.llm.agenda_pieces import encode_decode
from kinfold.llm.automaton_dedup import digest as word_digest
from kinfold.llm.common import table
from kinfold.llm.minhash_join import near_duplicates
from kinfold.llm.packing import pack
from kinfold.llm.pii import digest as pii_digest
from kinfold.llm.quality_fm import quality
from kinfold.llm.suffix_dedup import digest as byte_digest
from kinfold.llm.toxicity import toxicity
from kinfold.llm.vector_dedup import linked_vectors
from kinfold.llm.winnowing import fingerprints


def op1_pstable_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_vectors(table(spark, sf_dir, "embeddings"))


def op2_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_digest(table(spark, sf_dir, "documents"), length=100)


def op3_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_fm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_lp_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op7_suffix_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_digest(table(spark, sf_dir, "documents"), length=50)


def op8_agenda_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(table(spark, sf_dir, "documents"))


def op10_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pstable_vectors": op1_pstable_vectors,
    "op2_suffix_arrays": op2_suffix_arrays,
    "op3_ftrl_toxicity": op3_ftrl_toxicity,
    "op4_fm_quality": op4_fm_quality,
    "op5_lp_packing": op5_lp_packing,
    "op6_winnowing": op6_winnowing,
    "op7_suffix_automata": op7_suffix_automata,
    "op8_agenda_pieces": op8_agenda_pieces,
    "op9_boosted_pii": op9_boosted_pii,
    "op10_minhash_join": op10_minhash_join,
}

_WORDS = r"list_filter(regexp_split_to_array({0}, '[\x09-\x0D\x20]+'), lambda w: w <> '')"

#: What SQL can express. The others are held against brute force in tests/llm.
ORACLE_SQL: dict[str, str] = {
    "op1_pstable_vectors": """WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
 l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
 r(vec_id, other) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.other = l.a)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = m.vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM (SELECT vec_id, min(other) AS component_id FROM r GROUP BY vec_id) m""",
    "op7_suffix_automata": f"""WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
 u AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d),
 s AS (SELECT doc_id, p, w[p] AS word, CASE WHEN p + 49 <= len(w) THEN md5(array_to_string(list_slice(w, p, p + 49), ' ')) END AS k FROM u),
 f AS (SELECT *, k IS NOT NULL AND doc_id > min(doc_id) OVER (PARTITION BY k) AS again FROM s),
 g AS (SELECT *, max(again) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM f),
 o AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE gone) AS r, string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT gone) AS kept FROM g GROUP BY doc_id)
SELECT d.doc_id, coalesce(o.n, 0) AS n_words, coalesce(o.r, 0) AS n_removed, sha256(coalesce(o.kept, '')) AS kept_sha256 FROM d LEFT JOIN o ON d.doc_id = o.doc_id""",
    "op10_minhash_join": f"""WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
 s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(list_slice(w, i, i + 2), ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS x FROM d),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
 l AS (SELECT c.a, c.b FROM c JOIN n x ON c.a = x.doc_id JOIN n y ON c.b = y.doc_id WHERE 100 * c.c >= 85 * (x.n + y.n - c.c)),
 r(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.other = l.a)
SELECT m.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, m.doc_id = component_id AS kept FROM (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id) m LEFT JOIN n ON m.doc_id = n.doc_id""",
}
