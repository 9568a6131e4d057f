"""The registered queries of this subpackage, with production parameters, and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import table
from . import alignment, byte_bpe, chat, decontaminate, fingerprints, jaccard_join, line_dedup, manifest, pii, quality, rans, topk, url_filter

#: (rule, verdict); a rule is host and path.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]

BYTE_BPE_RANKS = "byte_bpe_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.deduplicated(table(spark, folder, "documents"))


def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, folder, "documents"))


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Outcomes: the page with the number of a labelled document is bad if that label is 0."""
    labels = table(spark, folder, "labels")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad"))
    return url_filter.judged(table(spark, folder, "pages"), outcomes, URL_RULES)


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    machine = quality.train(docs, table(spark, folder, "labels"))
    found = quality.scored(docs, machine, keep=["doc_id"])
    score = F.col("score")
    return found.select(
        "row.doc_id", quality.held_out("row.doc_id").alias("held_out"), score, (score >= 0.5).cast("int").alias("predicted")
    )


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"), keep=["doc_id"])
    listed = F.sha2(F.concat_ws(",", "items"), 256)
    return found.select("row.doc_id", "n_words", "n_hit", "n_items", listed.alias("items_sha256"), "contaminated")


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(table(spark, folder, "documents"), keep=["doc_id"]).select("row.*", "*").drop("row")


def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path(BYTE_BPE_RANKS)
    docs = table(spark, folder, "documents")
    return byte_bpe.encoded(docs, ranks, public_tokenizers.PATTERN, keep=["doc_id"], ids=False).select("row.*", "*").drop("row")


def op8_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return topk.nearest(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


def op9_chat(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    made = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(rows.unionByName(made))


def op10_rans(spark: SparkSession, folder: str) -> DataFrame:
    return rans.written(table(spark, folder, "documents"), public_tokenizers.path(WORD_BPE))


def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Every documents row a leaf; rows whose crc32 of the decimal id is divisible by 5 are tampered."""
    docs = table(spark, folder, "documents")
    found = manifest.manifest(docs, manifest.tamper_rule(F.col("doc_id")))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "source")


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """A: byte_bpe_50k.json's ids, computed from the rank file of the same vocabulary (tests compare the two)."""
    docs = table(spark, folder, "documents")
    return alignment.aligned(docs, public_tokenizers.path(BYTE_BPE_RANKS), public_tokenizers.path(PIECE_BPE))


def op13_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, folder, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_dedup, op2_jaccard_join, op3_url_filter, op4_quality, op5_decontaminate, op6_pii, op7_byte_bpe, op8_topk,
        op9_chat, op10_rans, op11_merkle, op12_alignment, op13_fingerprints,
    )
}

ORACLE: dict[str, str] = {}
