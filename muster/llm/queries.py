"""The registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.llm.common import documents
from muster.llm.exact_dedup import exact_groups
from muster.llm.line_dedup import drop_frequent_lines
from muster.llm.minhash import near_sets
from muster.llm.mixing import draws
from muster.llm.packing import pack
from muster.llm.periodic_runs import periodic_runs
from muster.llm.quality import verdicts
from muster.llm.simhash import hex_print, near_groups
from muster.llm.source_divergence import divergences
from muster.llm.substring_dedup import drop_repeats
from muster.llm.suffix_dedup import drop_repeated_bytes
from muster.llm.toxicity import fit, scored
from muster.llm.url_filter import url_verdicts
from muster.plans.session import tune

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_frequent_lines(documents(tune(spark), sf_dir), min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeats(documents(tune(spark), sf_dir), window=20)
    return kept.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(documents(tune(spark), sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed"
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_bytes(documents(tune(spark), sf_dir), window=400)
    share = F.when(F.col("n_bytes") > 0, F.col("n_removed") / F.col("n_bytes")).otherwise(F.lit(0.0))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", share.alias("removed_share"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(tune(spark), sf_dir), public_tokenizers.path("word_bpe_49k.json"), sequence=2048, end_id=1)


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(tune(spark).read.parquet(f"{sf_dir}/pages.parquet"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(tune(spark), sf_dir)
    return scored(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = draws(documents(tune(spark), sf_dir))
    return drawn.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(documents(tune(spark), sf_dir))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(documents(tune(spark), sf_dir), shingle=4, max_bits=4)
    return groups.select("doc_id", hex_print().alias("fingerprint"), "component_id")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergences(documents(tune(spark), sf_dir), min_docs=3, add=1, top=200)


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_sets(documents(tune(spark), sf_dir), size=3, num=85, den=100).select("doc_id", "n_shingles", "component_id", "kept")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(documents(tune(spark), sf_dir), min_length=12, splice=True, texts=False)
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def queries() -> dict[str, Query]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_substring_dedup": op2_substring_dedup,
        "op3_quality_rules": op3_quality_rules,
        "op4_suffix_dedup": op4_suffix_dedup,
        "op5_packing": op5_packing,
        "op6_url_filters": op6_url_filters,
        "op7_toxicity": op7_toxicity,
        "op8_mixing": op8_mixing,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_simhash": op10_simhash,
        "op11_source_divergence": op11_source_divergence,
        "op12_minhash": op12_minhash,
        "op13_periodic_runs": op13_periodic_runs,
    }
