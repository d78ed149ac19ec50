"""Shards by weighted rendezvous hashing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import numbered


def rendezvous_score(key: Column, shard: int, weight: float = 1.0) -> Column:
    """``-weight / ln(u)`` with u in (0, 1) from a hash of key and shard number.

    A shard draws a share of the keys in proportion to its weight, and its scores do
    not depend on the other shards.
    """
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.lit(float(weight)) / F.log(u)


def best_shard(key: Column, weights: dict[int, float]) -> Column:
    """Shard of the highest score; the lower number wins a tie."""
    scores = [F.struct(rendezvous_score(key, s, w).alias("score"), F.lit(-s).alias("shard")) for s, w in sorted(weights.items())]
    return -F.array_max(F.array(*scores))["shard"]


def shard_rows(
    df: DataFrame, key: str = "doc_id", weights: dict[int, float] | None = None, grown: dict[int, float] | None = None,
    text: str = "text",
) -> DataFrame:
    """Adds ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard``.

    The law is ``key``: the key and the weighted shards decide alone, so one more shard
    takes rows only into itself.  (To keep equal texts together, pass a hash of the text
    as the key column.)  Slots are gapless from 0 in each shard.

    A null key hashes like any other value; a null text has size 16 and the CRC of no
    bytes; repeated rows share a shard and get slots of their own; an empty table gives
    an empty table.  Columns of these names in the input are replaced.
    """
    weights = weights or {s: 1.0 for s in range(40)}
    grown = grown or {**weights, max(weights) + 1: 1.0}
    made = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
    raw = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    added = {s: w for s, w in grown.items() if s not in weights}
    scored = df.drop(*[c for c in made if c not in (key, text)]).select(
        "*",
        (F.octet_length(raw) + 16).cast("bigint").alias("size"),
        F.crc32(raw).cast("bigint").alias("text_crc32"),
        F.lit("key").alias("law"),
        best_shard(F.col(key), weights).alias("shard"),
    )
    if all(grown.get(s) == w for s, w in weights.items()):  # only the new shards can win over the old choice
        new = F.array_max(F.array(*[
            F.struct(rendezvous_score(F.col(key), s, w).alias("score"), F.lit(-s).alias("shard")) for s, w in sorted(added.items())
        ])) if added else None
        old_score = F.element_at(F.array(*[rendezvous_score(F.col(key), s, w) for s, w in sorted(weights.items())]),
                                 F.array_position(F.array(*[F.lit(s) for s in sorted(weights)]), F.col("shard")).cast("int"))
        chosen = F.when(new["score"] > old_score, -new["shard"]).otherwise(F.col("shard")) if added else F.col("shard")
    else:
        chosen = best_shard(F.col(key), grown)
    return numbered(scored.withColumn("grown_shard", chosen), ["shard"], [key, "text_crc32", "size"], "slot")
