"""Exact interpolated quantiles for any table size, and value frequencies.

Small tables use Spark's exact ``percentile``.  That aggregate keeps every
distinct value of a column in one task, so larger tables put a narrow interval
around each wanted order statistic with ``percentile_approx`` (bounded memory,
map-side merge).  A second pass over all columns counts the values inside the
intervals one by one and the others per gap; running counts give the ranks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.numeric import col, dbl
from millrace.session import scratch_dir

EXACT_CELLS = 400_000
ACCURACY = 10_000


def _by_percentile(df, cols, probs):
    arr = F.array(*[F.lit(float(p)) for p in probs])
    row = df.agg(*[F.percentile(dbl(c), arr).alias(f"q{i}") for i, c in enumerate(cols)]).head()
    return {c: list(row[i]) if row[i] is not None else [None] * len(probs) for i, c in enumerate(cols)}


def _spans(df, cols, probs, accuracy):
    """Rows per column, and per column disjoint closed intervals that should hold every wanted
    order statistic: one sketch per column, one pass."""
    slack = 2.0 / accuracy
    ends = [e for p in probs for e in (max(0.0, p - slack), min(1.0, p + slack))]
    row = df.agg(
        *[F.count(dbl(c)).alias(f"n{i}") for i, c in enumerate(cols)],
        *[F.percentile_approx(dbl(c), ends, accuracy).alias(f"q{i}") for i, c in enumerate(cols)],
    ).head()
    sizes = list(row[: len(cols)])
    spans = []
    for n, q in zip(sizes, row[len(cols) :]):
        if not n:
            spans.append([])
        elif n * slack < 4:  # a sketch of so few rows bounds nothing
            spans.append([(-math.inf, math.inf)])
        else:
            spans.append(_merged(list(zip(q[::2], q[1::2]))))
    return sizes, spans


def _merged(spans):
    out = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _counted(df, cols, spans):
    """(n, slot, value, c): slot 2i+1 counts the values of a column's i-th interval one by one,
    slot 2i all values between the intervals before and after it."""
    bounds = [np.array(s, dtype="float64").reshape(-1, 2) for s in spans]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for n, b in enumerate(bounds):
                if not len(b):
                    continue
                v = batch.column(n).to_numpy(zero_copy_only=False)
                v, c = np.unique(v[~np.isnan(v)], return_counts=True)
                at = np.searchsorted(b[:, 1], v, "left")
                inside = (at < len(b)) & (v >= b[np.minimum(at, len(b) - 1), 0])
                gaps = np.bincount(at[~inside], weights=c[~inside], minlength=len(b) + 1).astype(np.int64)
                used = np.flatnonzero(gaps)
                found.append((np.full(len(used), n), 2 * used, np.full(len(used), np.nan), gaps[used]))
                found.append((np.full(inside.sum(), n), 2 * at[inside] + 1, v[inside], c[inside]))
            if found:
                n, slot, value, c = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(n.astype(np.int32)), pa.array(slot.astype(np.int32)), pa.array(value, from_pandas=True), pa.array(c.astype(np.int64))],
                    ["n", "slot", "value", "c"],
                )

    parts = df.select(*[dbl(c).alias(f"c{i}") for i, c in enumerate(cols)]).mapInArrow(count, "n int, slot int, value double, c bigint")
    path = scratch_dir(df.sparkSession, "quantiles")
    parts.groupBy("n", "slot", "value").agg(F.sum("c").alias("c")).write.parquet(path)
    return df.sparkSession.read.schema("n int, slot int, value double, c bigint").parquet(path)


def _by_brackets(df, cols, probs, accuracy):
    """Two passes over the table; order statistics are then found by running counts inside Spark,
    and only they (two per column and probability) and the slots' sizes reach the driver."""
    sizes, spans = _spans(df, cols, probs, accuracy)
    ranks = {
        n: sorted({r for p in probs for r in (math.floor((size - 1) * p), math.ceil((size - 1) * p))}) for n, size in enumerate(sizes) if size
    }
    values: dict[tuple[int, int], float] = {}
    while ranks:
        table = _counted(df, cols, spans)
        slots: dict[int, list] = {}
        for r in table.groupBy("n", "slot").agg(F.sum("c").alias("c")).collect():
            slots.setdefault(r["n"], []).append((r["slot"], r["c"]))
        wanted, missed = [], {}
        for n, of_column in ranks.items():
            before, left = 0, list(of_column)
            edges, wider = [-math.inf, *[e for s in spans[n] for e in s], math.inf], []
            for slot, c in sorted(slots[n]):
                here = [r for r in left if r < before + c]
                left = left[len(here) :]
                if slot % 2:
                    wanted += [(n, slot, r - before, r) for r in here]
                elif here:  # outside every interval, against the sketch's bound: look between them
                    missed.setdefault(n, set()).update(here)
                    wider.append((edges[slot], edges[slot + 1]))
                before += c
            spans[n] = _merged([*spans[n], *wider])
        if wanted:
            sought = df.sparkSession.createDataFrame(wanted, "n int, slot int, local bigint, rank bigint")  # two per column and probability
            running = Window.partitionBy("n", "slot").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
            inside = table.where("value is not null").withColumn("upto", F.sum("c").over(running))
            hit = inside.join(F.broadcast(sought), ["n", "slot"]).where("local < upto and local >= upto - c")
            values.update({(r["n"], r["rank"]): r["value"] for r in hit.select("n", "rank", "value").collect()})
        ranks = {n: sorted(r) for n, r in missed.items()}

    def at(n, p):
        if not sizes[n]:
            return None
        position = (sizes[n] - 1) * p
        low, high = values[n, math.floor(position)], values[n, math.ceil(position)]
        return low if low == high else low + (high - low) * (position - math.floor(position))

    return {c: [at(n, p) for p in probs] for n, c in enumerate(cols)}


def exact_quantiles(
    df: DataFrame,
    cols: list[str],
    probs: list[float],
    exact_cells: int = EXACT_CELLS,
    bracket_rows: int | None = None,
    total: int | None = None,
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles per column, exact at any size.

    ``bracket_rows`` asks for intervals of about so many rows in place of the finest ones.
    """
    if not cols:
        return {}
    total = df.count() if total is None else total
    if total * len(cols) <= exact_cells:
        return _by_percentile(df, cols, probs)
    return _by_brackets(df, cols, probs, max(2, min(ACCURACY, total // bracket_rows)) if bracket_rows else ACCURACY)


def long_values(df: DataFrame, cols: list[str], kind: str = "string") -> DataFrame:
    """One row per cell: (column, value)."""
    cells = df.select(
        *[(dbl(c) if kind == "double" else col(c).cast(kind)).alias(c) for c in cols]
    )
    return cells.unpivot([], [col(c) for c in cols], "column", "value")


def value_freq(df: DataFrame, cols: list[str], kind: str = "string") -> DataFrame:
    """(column, value, count) for non-null values, one shuffle for all columns."""
    return (
        long_values(df, cols, kind).where(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    )


def distinct_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, n_unique) of non-null values.  Long texts are compared by their
    128-bit digest, so the shuffle carries no documents."""
    def brief(c):
        x = col(c).cast("string")
        return F.when(F.length(x) > 40, F.md5(x.cast("binary"))).otherwise(x).alias(c)

    cells = df.select(*[brief(c) for c in cols])
    return value_freq(cells, cols).groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"))


def modes(df: DataFrame, cols: list[str], kind: str = "string") -> DataFrame:
    """(column, n_unique, mode, mode_count, n); ties give the smallest value."""
    return (
        value_freq(df, cols, kind).groupBy("column").agg(
            F.count(F.lit(1)).alias("n_unique"),
            F.min(F.struct(-F.col("count"), F.col("value"))).alias("top"),
            F.sum("count").alias("n"),
        )
        .select(
            "column", "n_unique", F.col("top.value").alias("mode"),
            (-F.col("top.col1")).alias("mode_count"), "n",
        )
    )
