"""Queries of the training-data operators and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import (
    checks, collocations, compression, decontaminate, licenses, line_dedup, merkle, near_dup, packing, quality, sharding, simhash, toxicity, url_tree,
)
from millrace.llm.common import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


@query("op1_best_fit_packing")
def op1(spark, sf):
    return packing.pack(load(spark, sf, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query("op6_rendezvous_shards")
def op6(spark, sf):
    return sharding.shard_rows(load(spark, sf, "documents")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


@query("op7_compression_bands")
def op7(spark, sf):
    return compression.compression_rules(load(spark, sf, "documents"))


@query("op10_subword_toxicity")
def op10(spark, sf):
    return toxicity.toxicity(load(spark, sf, "documents"), load(spark, sf, "labels"))


@query("op5_pu_quality")
def op5(spark, sf):
    return quality.quality(load(spark, sf, "documents"), load(spark, sf, "labels"))


@query("op2_edit_lines")
def op2(spark, sf):
    return line_dedup.repeated_lines(load(spark, sf, "documents"), exact_chars=1)


@query("op9_chosen_path")
def op9(spark, sf):
    return near_dup.near_duplicates(load(spark, sf, "documents"), rules=near_dup.JoinRules(words=3, percent=85))


@query("op4_template_leaks")
def op4(spark, sf):
    return decontaminate.leaks(load(spark, sf, "documents"), load(spark, sf, "benchmark"), rules=decontaminate.LeakRules(any_case=True))


@query("op3_license_scans", licenses.notices_sql())
def op3(spark, sf):
    return licenses.license_notices(load(spark, sf, "documents"))


@query("op8_path_templates")
def op8(spark, sf):
    return url_tree.judge_urls(load(spark, sf, "pages"))


@query("op11_bit_sliced_simhash")
def op11(spark, sf):
    return simhash.simhash_duplicates(load(spark, sf, "documents"))


@query("op12_collocations", checks.COLLOCATIONS)
def op12(spark, sf):
    return collocations.collocations(load(spark, sf, "documents"))


@query("op13_merkle_manifest", checks.manifest_sql())
def op13(spark, sf):
    return merkle.manifest(load(spark, sf, "documents"), altered={"text": merkle.without_newlines("doc_id", "text")})
