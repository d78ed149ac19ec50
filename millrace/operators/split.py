"""Deterministic splits and samples ordered by a hash of the row key.

Exact sizes need no global sort: hash prefixes are counted (a few thousand
groups, combined map-side), the prefix in which a cut falls is refined until
few rows are left, and the split is then a comparison with a literal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.numeric import col
from millrace.operators.features import base_stats
from millrace.plans.fitted import Step, applies

SEED = 42
PREFIX = 3
CELL_ROWS = 5_000
MAX_CLASSES = 1_000


def key_hash(keys: list[str], seed: int = SEED) -> Column:
    """md5 of the key text and the seed, joined by colons."""
    return F.md5(F.concat_ws(":", *[col(k).cast("string") for k in keys], F.lit(str(seed))))


def _cut_hashes(df: DataFrame, h: Column, group: Column, wanted: dict) -> dict:
    """``wanted`` maps a group to row counts k; returns {group: [hash of the
    k-th row in hash order]} ('' for k = 0)."""
    rows = df.select(group.alias("g"), h.alias("h"))
    todo = {(g, k): ("", k) for g, ks in wanted.items() for k in ks if k > 0}
    done = {(g, k): "" for g, ks in wanted.items() for k in ks if k <= 0}
    depth = 0
    step = PREFIX if len(wanted) <= 50 else PREFIX - 1
    while todo:
        depth += step
        prefixes = sorted({(g, p) for (g, _), (p, _) in todo.items()}, key=str)
        near = rows
        if depth > step:
            near = rows.where(
                F.concat_ws("\x00", F.col("g").cast("string"), F.substring("h", 1, depth - step)).isin(
                    [f"{g}\x00{p}" if g is not None else p for g, p in prefixes]
                )
            )
        # at most 16^step groups per class or prefix that holds a cut
        counts: dict = {}
        grouped = near.groupBy("g", F.substring("h", 1, depth).alias("p")).count()
        for r in sorted(grouped.collect(), key=lambda r: r["p"]):
            counts.setdefault((r["g"], r["p"][: depth - step]), []).append((r["p"], r["count"]))
        small = {}
        for (g, k), (prefix, left) in list(todo.items()):
            for p, n in counts.get((g, prefix), []):
                if left <= n:
                    todo[(g, k)] = (p, left)
                    if n <= CELL_ROWS or depth >= 30:
                        small[(g, k)] = (p, left)
                    break
                left -= n
            else:
                done[(g, k)] = "g"  # above every hash
                todo.pop((g, k))
        if small:
            cells = sorted({f"{g}\x00{p}" if g is not None else p for (g, _), (p, _) in small.items()})
            tag = F.concat_ws("\x00", F.col("g").cast("string"), F.substring("h", 1, depth))
            found: dict = {}
            for r in rows.where(tag.isin(cells)).groupBy("g", "h").count().collect():
                found.setdefault((r["g"], r["h"][:depth]), []).append((r["h"], r["count"]))
            for (g, k), (p, left) in small.items():
                for value, n in sorted(found[(g, p)]):
                    left -= n
                    if left <= 0:
                        done[(g, k)] = value
                        break
                todo.pop((g, k))
    return {g: [done[(g, k)] for k in ks] for g, ks in wanted.items()}


def _sizes(n: int, test: float, val: float, rounding: str) -> tuple[int, int]:
    if rounding == "floor":
        return int(n * test), int(n * val)
    half_up = lambda x: int(x + 0.5)
    n_test = half_up(n * test)
    return n_test, half_up(n * (test + val)) - n_test


def fit_split(df: DataFrame, keys: list[str], test: float = 0.2, val: float = 0.0, stratify: str | None = None, seed: int = SEED, rounding: str = "round", guard: bool = True) -> Step:
    """Cut hashes for test, then validation, then train.

    With ``stratify`` every class is cut at its own share (at least one test
    row per class).  ``keys`` must identify a row: copies of a key stay together.
    """
    if stratify:
        rows = df.groupBy(col(stratify).cast("string").alias("g")).count().limit(MAX_CLASSES + 1).collect()
        if len(rows) > MAX_CLASSES:
            raise ValueError(f"{stratify!r} has more than {MAX_CLASSES} classes; split without stratify")
        sizes = {r["g"]: r["count"] for r in rows}
        group = col(stratify).cast("string")
    else:
        sizes = {"": df.count()}
        group = F.lit("")
    wanted = {}
    for g, n in sizes.items():
        n_test, n_val = _sizes(n, test, val, rounding)
        if stratify and test > 0:
            n_test = min(max(n_test, 1), n)
        wanted[g] = [n_test, min(n_test + n_val, n)]
    if guard and sum(sizes.values()) <= sum(w[1] for w in wanted.values()):
        raise ValueError("no rows are left for the train part; lower the test or validation share")
    cuts = _cut_hashes(df, key_hash(keys, seed), group, wanted)
    return Step(
        "split",
        {"keys": list(keys), "seed": seed, "stratify": stratify, "cuts": [[g, *c] for g, c in cuts.items()], "val": val},
    )


@applies("split")
def _apply_split(df, p):
    """Adds ``split``: test, val or train; a projection with literal cuts."""
    h = key_hash(p["keys"], p["seed"])
    if p["stratify"]:
        g = col(p["stratify"]).cast("string")
        lows = F.create_map(*[F.lit(x) for c in p["cuts"] for x in (c[0] if c[0] is not None else "\x00", c[1])])
        highs = F.create_map(*[F.lit(x) for c in p["cuts"] for x in (c[0] if c[0] is not None else "\x00", c[2])])
        g = F.coalesce(g, F.lit("\x00"))
        low, high = F.try_element_at(lows, g), F.try_element_at(highs, g)
    else:
        _, a, b = p["cuts"][0]
        low, high = F.lit(a), F.lit(b)
    part = F.when(h <= low, "test").when(h <= high, "val").otherwise("train")
    return df.withColumn("split", part)


def split_random(df, keys, test=0.2, seed=SEED, **kw) -> DataFrame:
    return fit_split(df, keys, test, 0.0, None, seed, **kw).transform(df)


def split_train_val_test(df, keys, test=0.2, val=0.1, seed=SEED, **kw) -> DataFrame:
    return fit_split(df, keys, test, val, None, seed, **kw).transform(df)


def split_stratified(df, keys, target, test=0.2, val=0.0, seed=SEED, **kw) -> DataFrame:
    return fit_split(df, keys, test, val, target, seed, **kw).transform(df)


def should_stratify(df: DataFrame, target: str, limit: int = 20) -> bool:
    """A discrete target: text or boolean, or fewer than ``limit`` distinct numbers."""
    if not isinstance(df.schema[target].dataType, T.NumericType):
        return True
    return df.select(col(target)).distinct().limit(limit).count() < limit


def split_info(df: DataFrame, features: int, stratified: bool = False) -> DataFrame:
    """Rows and share per part of a frame that has a ``split`` column."""
    total = df.agg(F.count(F.lit(1))).scalar()
    counts = df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.select(
        "split", "n_rows", (F.col("n_rows") / total * 100).alias("pct"),
        F.lit(features).cast("bigint").alias("n_features"), F.lit(stratified).alias("stratified"),
    )


def train_test_complement(df: DataFrame, test: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(test.select(*[col(k) for k in keys]), list(keys), "left_anti")


def fit_split_scaled(df: DataFrame, cols: list[str]) -> Step:
    """Min-max bounds of the train rows only, so the test part does not leak."""
    stats = base_stats(df.where(F.col("split") == "train"), cols)
    params = {}
    for c, s in stats.items():
        if s["n"]:
            params[c] = (s["min"], (s["max"] - s["min"]) or 1.0)
    return Step("affine", {"columns": params, "how": "minmax"})


def sample_n(df: DataFrame, keys: list[str], n: int, seed: int = SEED) -> DataFrame:
    """Exactly n rows (all when the table is smaller), the same on every run.

    Rows are compared with the hash of the last one; rows of one key are told apart by a
    digest of the whole row, and only rows equal in every column are interchangeable.
    """
    if n <= 0:
        return df.limit(0)
    whole = F.concat(key_hash(keys, seed), F.md5(F.to_json(F.struct(*[col(c) for c in df.columns]), {"ignoreNullFields": "false"})))
    cut = F.lit(_cut_hashes(df, whole, F.lit(""), {"": [n]})[""][0])
    below = df.where(whole < cut)
    return below.unionByName(df.where(whole == cut).limit(n - below.count()))


def hash_fraction(df: DataFrame, keys: list[str], fraction: float, seed: int = SEED) -> DataFrame:
    """Rows whose hash falls under the fraction; no job is needed to decide."""
    first = F.conv(F.substring(key_hash(keys, seed), 1, 8), 16, 10).cast("double")
    return df.where(first < F.lit(fraction * 2.0**32))

