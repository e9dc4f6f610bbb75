"""The registered queries: each operator over its whole table, as digests."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginlib.llm import (bpe, chat, collocation, decontaminate, filter_audit, jaccard, language, oracle,
                           private_data, quality, secrets, suffix_dedup, toxicity, unigram)
from marginlib.llm.common import table


def _tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.count_tokens(table(spark, sf_dir, "documents"), _tokenizer_file("piece_bpe_32k.model"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_copies(table(spark, sf_dir, "documents"), size=3, pct=90)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.read_back(chat.with_probe(table(spark, sf_dir, "conversations")))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))

    def count(kind: str):
        number = list(secrets.STRONG).index(kind)
        return F.size(F.filter("strong", lambda s: s["kind"] == number)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, secrets.STRONG),
                        F.sha2(secrets.written(F.col("strong")), 256).alias("base_sha256"),
                        secrets.written(F.col("spans")).alias("spans"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return bpe.digest_documents(table(spark, sf_dir, "documents"),
                                _tokenizer_file("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = private_data.scan(table(spark, sf_dir, "documents"))

    def count(kind: str):
        number = private_data.NAMES.index(kind)
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *(count(k) for k, _ in private_data.KINDS),
                        F.sha2(private_data.written(F.col("base")), 256).alias("base_sha256"),
                        private_data.written(F.col("spans")).alias("spans"))


def op13_phrase_collocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.mine(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if top not in sys.path:
        sys.path.insert(0, top)
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_decontamination, op2_token_counts, op3_quality_rules, op4_suffix_dedup, op5_toxicity,
                            op6_jaccard_join, op7_chat_format, op8_secret_scan, op9_language_id,
                            op10_byte_bpe, op11_filter_audit, op12_private_data, op13_phrase_collocation, pipeline)
}

ORACLE_SQL = {"op6_jaccard_join": oracle.JACCARD, "op7_chat_format": oracle.CHAT,
              "op11_filter_audit": oracle.FILTER_AUDIT, "op13_phrase_collocation": oracle.COLLOCATION}
