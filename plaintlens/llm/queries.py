"""One registered query per operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plaintlens.llm.bpe_codec import round_trip
from plaintlens.llm.chat_format import conversation_digests, with_probe
from plaintlens.llm.alignment import align
from plaintlens.llm.common import read
from plaintlens.llm.decontamination import decontaminate
from plaintlens.llm.exact_dedup import exact_dedup
from plaintlens.llm.html_text import extract_text
from plaintlens.llm.packing import pack_digests
from plaintlens.llm.quality_classifier import quality_scores
from plaintlens.llm.quality_rules import quality_rules
from plaintlens.llm.resampling import resample
from plaintlens.llm.simhash import simhash_components
from plaintlens.llm.suffix_dedup import suffix_dedup
from plaintlens.llm.token_counts import token_counts


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(read(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_digests(with_probe(spark, read(spark, sf_dir, "conversations")))


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return round_trip(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return pack_digests(read(spark, sf_dir, "documents"), path)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read(spark, sf_dir, "pages"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align(
        read(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_simhash": op2_simhash,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_chat_format": op4_chat_format,
    "op5_bpe_round_trip": op5_bpe_round_trip,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_packing": op8_packing,
    "op9_html_text": op9_html_text,
    "op10_quality_rules": op10_quality_rules,
    "op11_alignment": op11_alignment,
    "op12_resampling": op12_resampling,
    "op13_decontamination": op13_decontamination,
}
