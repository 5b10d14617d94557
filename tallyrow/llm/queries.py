"""The queries of this folder and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyrow.llm import backoff, decontaminate, exactdedup, filteraudit, linededup, merkle, mixing, ngramjoin, quality, sharding, simhash, tokenstore, urltree

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return add


@query("op1_decontamination", decontaminate.ORACLE)
def op1(spark, sf_dir):
    return decontaminate.report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


@query("op2_jump_sharding")
def op2(spark, sf_dir):
    return sharding.assign(_read(spark, sf_dir, "documents"))


@query("op3_url_template_tree", urltree.ORACLE)
def op3(spark, sf_dir):
    return urltree.judge(_read(spark, sf_dir, "pages"), _read(spark, sf_dir, "labels"))


@query("op4_line_dedup")
def op4(spark, sf_dir):
    return linededup.report(_read(spark, sf_dir, "documents"))


@query("op5_curriculum_mix", mixing.ORACLE)
def op5(spark, sf_dir):
    return mixing.shares(_read(spark, sf_dir, "documents"))


@query("op6_simhash_near_dedup")
def op6(spark, sf_dir):
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


@query("op7_exact_dedup", exactdedup.ORACLE)
def op7(spark, sf_dir):
    return exactdedup.resolve(_read(spark, sf_dir, "documents"))


@query("op8_quality_classifier")
def op8(spark, sf_dir):
    return quality.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


@query("op9_token_store")
def op9(spark, sf_dir):
    import public_tokenizers

    return tokenstore.stored(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op10_backoff_scores")
def op10(spark, sf_dir):
    return backoff.held_out_scores(_read(spark, sf_dir, "documents"))


@query("op11_filter_audit", filteraudit.ORACLE)
def op11(spark, sf_dir):
    return filteraudit.audit(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


@query("op12_merkle_manifest", merkle.ORACLE)
def op12(spark, sf_dir):
    return merkle.tamper_check(_read(spark, sf_dir, "documents"))


@query("op13_ngram_jaccard_join")
def op13(spark, sf_dir):
    return ngramjoin.linked(_read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
