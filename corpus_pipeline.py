"""A corpus from documents to token ids, in five stages.

Each stage works on all that the one before kept, and is written before the next one reads it:
rejects of the quality classifier go, one document of each group of near duplicates stays, documents with
benchmark passages go, personal data is masked, and what is left is encoded.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from parchline.llm import byte_bpe, decontaminate, jaccard_join, pii, quality
from parchline.llm.queries import BYTE_BPE_RANKS
from parchline.sources.tables import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept_by_quality(docs, table(spark, sf_dir, "labels"))


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def private_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, the ids, and digests of the ids and of the decoded bytes."""
    ranks = public_tokenizers.path(BYTE_BPE_RANKS)
    found = byte_bpe.encoded(docs, ranks, public_tokenizers.PATTERN, keep=["doc_id", "lang", "source"])
    return found.select("row.*", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram jaccard join", duplicates_stage),
    ("benchmark decontamination", benchmark_stage),
    ("pii", private_stage),
    ("byte-level bpe", encoding_stage),
]

#: The classifier's scores and the tokenizer's ids cannot be had in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stored(docs, name.replace(" ", "-"))
    return docs
