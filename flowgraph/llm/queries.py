"""The registered queries of the operators: whole tables, production parameters, digest columns."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgraph.llm import conversation_repair, decontaminate, jaccard, language, packing, pii, quality, signature_search, suffix_tree, token_count, topk, url_templates, vector_near
from flowgraph.llm.text import crc32_mod


def vocabulary_path(name: str) -> str:
    """A public vocabulary file, in the folder that TOKENIZERS_DIR names or where its package keeps it."""
    folder = os.environ.get("TOKENIZERS_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


URL_RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_json() -> str:
    with open(vocabulary_path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


def op1_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op2_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = suffix_tree.score(table(spark, sf_dir, "documents"), crc32_mod("doc_id", 7) != 2)
    return scored.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = T.StructField("ids_crc32", T.LongType())
    docs = table(spark, sf_dir, "documents")
    placed = packing.pack(docs, tokenizer_json(), end_id=2, window=4096, carry=digest, carried=packing.ids_crc32)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.detect(docs, pii.train(docs))

    def listed(spans: str):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.where("vec_id % 20 = 0"), k=20, scale=64)


TOPK_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels").where(crc32_mod("doc_id", 5) != 0))
    scored = quality.score(docs, model)
    predicted = (F.col("score") >= quality.KEEP).cast("int").alias("predicted")
    return scored.select("doc_id", (crc32_mod("doc_id", 5) == 0).alias("held_out"), "score", predicted, "n_lines")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.where(crc32_mod("doc_id", 4) != 2))
    found = language.identify(docs, model)
    return found.select("doc_id", (crc32_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "n_words")


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = token_count.read_vocabulary(vocabulary_path("piece_bpe_32k.model"))
    return token_count.count_tokens(table(spark, sf_dir, "documents"), vocabulary)


def op11_signature_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_auction_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    repaired = conversation_repair.repair(conversation_repair.damage(conversations))
    return conversation_repair.with_all(repaired, conversations)


def op13_pigeonhole_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_near.link(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_url_templates": op1_url_templates,
    "op2_suffix_tree": op2_suffix_tree,
    "op3_packing": op3_packing,
    "op4_pii": op4_pii,
    "op5_topk": op5_topk,
    "op6_decontamination": op6_decontamination,
    "op7_quality": op7_quality,
    "op8_language": op8_language,
    "op9_jaccard": op9_jaccard,
    "op10_token_counts": op10_token_counts,
    "op11_signature_search": op11_signature_search,
    "op12_auction_repair": op12_auction_repair,
    "op13_pigeonhole_join": op13_pigeonhole_join,
}

ORACLES = {
    "op5_topk": TOPK_SQL,
    "op1_url_templates": url_templates.duckdb_sql(URL_RULES),
    "op11_signature_search": signature_search.duckdb_sql(10),
    "op12_auction_repair": conversation_repair.duckdb_sql(),
    "op13_pigeonhole_join": vector_near.DUCKDB_SQL,
}
