"""The corpus pipeline: quality, near copies, benchmark leaks, personal data, packing.

Each stage reads the documents that its predecessor kept, and is one of the operators of ``flowgraph.llm`` whose decisions
take effect.  All but the last return the columns of ``documents``; the last returns the pieces of the packed sequences.
A stage judges rows one by one, so rows of equal id are kept or dropped each, but for near copies, of which one row of the
smallest id stays.  An empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgraph.llm import decontaminate, jaccard, packing, pii, quality
from flowgraph.llm.queries import table, tokenizer_json
from flowgraph.llm.text import crc32_mod
from flowgraph.session import Scratch


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier scores as worth keeping; a null text is judged as an empty one."""
    labels = table(spark, sf_dir, "labels").where(crc32_mod("doc_id", 5) != 0)
    return quality.keep_good(docs, quality.train(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of documents linked by similarity, the one of the smallest id; others untouched."""
    return jaccard.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced by its kind and n_chars counted anew."""
    masked = pii.mask(docs, pii.train(docs))
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences: (doc_id, start, length, doc_tokens, ids, sequence_id, offset)."""
    return packing.pack(docs, tokenizer_json(), end_id=2, window=4096)


STAGES = [
    ("quality_classifier", keep_good),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

#: The stages are learned models, a tokenizer and edit distances, which SQL cannot express; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, scratch.write(stage(spark, docs, sf_dir), name)
        scratch.drop(before)
    return docs
