"""A corpus pipeline of five stages over `documents`.

Quality rules, n-gram Jaccard join, benchmark decontamination, secret scans,
byte-level BPE.  Each stage gets what its predecessor kept, as a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marginlib.llm import bpe, decontaminate, jaccard, quality, secrets
from marginlib.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rejected documents, and the failing lines of the others."""
    return quality.clean(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (five words, 80 percent)."""
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold benchmark items."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by a mark."""
    return secrets.redact(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    import public_tokenizers
    return bpe.digest_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                                public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("byte_bpe", byte_bpe),
]

#: Greedy string tiling, line rules on Unicode case and BPE are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs)
    return docs
