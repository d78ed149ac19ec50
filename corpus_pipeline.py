"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept.  Every
result is written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import load, stored
from millrace.llm.decontaminate import LeakRules, decontaminate
from millrace.llm.line_dedup import deduplicate_lines
from millrace.llm.near_dup import JoinRules, near_duplicates
from millrace.llm.packing import pack
from millrace.llm.toxicity import fit_toxicity, held_out, score_texts

#: A document goes at this toxicity score or more.
TOXIC = 0.7
#: Near duplicates: five-word shingles, a similarity of 0.8 or more.
NEAR = JoinRules(words=5, percent=80)
LEAKS = LeakRules(any_case=True)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold; the model is fitted as in its query."""
    model = fit_toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"), ~held_out("doc_id", 3, 1))
    others = tuple(c for c in docs.columns if c != "doc_id")
    return score_texts(docs, model, "doc_id", "text", keep=others, name="__toxicity").where(F.col("__toxicity") < TOXIC).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each line class keeps its first occurrence; a document of which no line is left goes."""
    return deduplicate_lines(docs, exact_chars=1)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group stays."""
    kept = near_duplicates(docs, rules=NEAR).where(F.col("kept") & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(kept, F.col("doc_id") == F.col("__kept"), "left").where(
        F.col("__kept").isNotNull() | F.col("doc_id").isNull()
    ).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate(docs, load(spark, sf_dir, "benchmark"), rules=LEAKS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its place in a sequence of 2048 tokens."""
    return pack(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("packing", pack_sequences),
]

#: SQL can express neither the trained model nor the packing plan; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
