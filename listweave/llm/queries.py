"""The registered queries of this folder; ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, langid, licenses, merkle, minhash, packing, passages, repair, suffixes, toxicity, trie, vectors
from .common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), toxicity.crc_mod("doc_id", 3) != 1)
    out = toxicity.scored(docs, model)
    return out.select("doc_id", (toxicity.crc_mod("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= toxicity.REJECT).cast("int").alias("predicted"))


def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.cut(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = toxicity.crc_mod("doc_id", 5) == 0
    model = langid.learn(docs, ~held)
    return langid.identified(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("text")


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = merkle.with_next(docs).withColumn("next_text", F.coalesce("next_text", F.lit("")))
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn("edited", merkle.edited(F.col("text"), F.col("n_chars"), F.col("next_text")))
    for text, prefix in (("text", ""), ("edited", "edited_"), ("next_text", "next_")):
        rows = merkle.fingerprinted(rows, text, prefix).withColumn(f"{prefix}phrases", merkle.phrases(F.col(text)))
    near = lambda prefix: merkle.likeness(F.col("fingerprint"), F.col("phrases"), F.col(f"{prefix}fingerprint"), F.col(f"{prefix}phrases"))
    changed = merkle.differing(F.col("sections"), F.col("tree"), F.col("edited_sections"), F.col("edited_tree"))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        near("edited_").alias("near_edited"), near("next_").alias("near_next"),
        F.size(changed).alias("paragraphs_changed"),
    )


def op9_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vectors.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return licenses.scanned(docs).select(*columns)


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = chat.records_of(chat.with_trial(table(spark, sf_dir, "conversations")))
    return chat.digests(chat.formatted(records, ["conv_id", "part"])).drop("records", "layouts")


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    found = repair.conversations(repair.repaired(repair.damaged(turns))).withColumnRenamed("conv_id", "_of")
    every = turns.select("conv_id").distinct()
    none = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    filled = [F.coalesce(c, F.lit(none.get(c, 0))).alias(c) for c in found.columns[1:]]
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("_of")), "left").select("conv_id", *filled)


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(trie.rebuilt(table(spark, sf_dir, "conversations")))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_packing, op3_bpe, op4_suffixes, op5_language, op6_passages, op7_near_duplicates, op8_fingerprints, op9_vectors, op10_licenses, op11_chat, op12_repair, op13_trie)}
#: DuckDB: the whole link graph from all shared shingles, or all pairs of vectors.
_COMPONENTS = """
links AS MATERIALIZED (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach(node, low) AS (SELECT node, node FROM nodes UNION SELECT l.b, r.low FROM reach r JOIN links l ON l.a = r.node WHERE r.low < l.b),
component AS (SELECT node, min(low) AS component_id FROM reach GROUP BY node)"""
NEAR_TEXTS = r"""
WITH RECURSIVE worded AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingled AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' '))) END AS s FROM worded),
alike AS MATERIALIZED (SELECT s, min(doc_id) AS node, len(s) AS n FROM (SELECT doc_id, list_sort(s) AS s FROM shingled) GROUP BY s),
posted AS MATERIALIZED (SELECT node, n, md5(unnest(s)) AS x FROM alike),
pairs AS MATERIALIZED (SELECT a.node AS a, b.node AS b FROM posted a JOIN posted b ON a.x = b.x AND a.node < b.node AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
nodes AS (SELECT node FROM alike),""" + _COMPONENTS + """
SELECT d.doc_id, len(d.s) AS n_shingles, CASE WHEN len(d.s) = 0 THEN d.doc_id ELSE component_id END AS component_id, CASE WHEN len(d.s) = 0 THEN true ELSE d.doc_id = component_id END AS kept
FROM shingled d JOIN alike a ON a.s = list_sort(d.s) JOIN component c ON c.node = a.node"""
NEAR_VECTORS = """
WITH RECURSIVE sound AS MATERIALIZED (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS size FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL)
  WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(v, v) > 0),
pairs AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.vec_id < b.vec_id WHERE list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.95),
nodes AS (SELECT vec_id AS node FROM embeddings),""" + _COMPONENTS + """
SELECT node AS vec_id, (SELECT count(*) FROM links WHERE a = node) AS n_links, component_id, node = component_id AS kept FROM component"""

ORACLES: dict[str, str] = {
    "op7_near_duplicates": NEAR_TEXTS, "op9_vectors": NEAR_VECTORS, "op11_chat": chat.ORACLE, "op12_repair": repair.ORACLE, "op13_trie": trie.ORACLE,
}
