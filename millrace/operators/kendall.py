"""Kendall tau-b without comparing all pairs of rows.

Equal (x, y) rows are first merged into weighted cells.  A set of cells that is
too large for one task is cut at value quantiles on both axes, so every pair of
its cells falls in exactly one class:

* different x block and different y block: counted on the block grid;
* same x block: a smaller problem of the same kind;
* same y block but different x block: a smaller problem, with the x block
  number in place of x.

Every quantile value is a block of its own, in which all pairs are tied, so a
value that holds a third of the rows never becomes a large problem.  All
problems of one level are worked on together; a problem that fits one task is
counted there in O(m log m).
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.numeric import dbl
from millrace.operators.skew import BROADCAST_ROWS
from millrace.session import ensure_checkpoint_dir

BLOCK_CELLS = 100_000
CUTS = 32


def signed_pairs(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    """Sum over unordered pairs of sign(dx) * sign(dy) * w1 * w2.

    Radix walk over the bits of the x rank: two cells are compared at the
    highest bit in which their ranks differ, with running weights in y order.
    """
    if len(x) < 2:
        return 0.0
    order = np.argsort(y, kind="stable")
    xr = np.unique(x, return_inverse=True)[1][order]
    yr = np.unique(y, return_inverse=True)[1][order]
    w = w[order].astype("float64")
    total = 0.0
    for bit in range(int(xr.max()).bit_length()):
        group = xr >> (bit + 1)
        upper = (xr >> bit) & 1
        o = np.argsort(group, kind="stable")
        g, u, yy, ww = group[o], upper[o], yr[o], w[o]
        lower = np.where(u == 0, ww, 0.0)
        upto = np.concatenate([[0.0], np.cumsum(lower)])
        starts = np.searchsorted(g, g, "left")
        ends = np.searchsorted(g, g, "right")
        span = int(yr.max()) + 1
        key = g.astype("int64") * span + yy
        below = upto[np.searchsorted(key, key, "left")] - upto[starts]
        above = upto[ends] - upto[np.searchsorted(key, key, "right")]
        total += float(np.sum(np.where(u == 1, ww, 0.0) * (below - above)))
    return total


def _grid_score(grid: pd.DataFrame) -> float:
    """Pairs in different blocks on both axes, from 2-d running sums."""
    m = grid.pivot_table(index="bx", columns="by", values="w", aggfunc="sum", fill_value=0.0).to_numpy()
    after = np.zeros((m.shape[0] + 1, m.shape[1] + 1))
    after[:-1, :-1] = m[::-1, ::-1].cumsum(0).cumsum(1)[::-1, ::-1]
    later_x = np.cumsum(m[::-1], 0)[::-1]
    row_tail = np.zeros_like(after)
    row_tail[: m.shape[0], 1:] = np.cumsum(later_x, 1)
    conc = after[1:, 1:]
    disc = np.zeros_like(m)
    disc[:-1, 1:] = np.cumsum(later_x, 1)[1:, :-1]
    return float(np.sum(m * (conc - disc)))


def _count_small(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"s": [signed_pairs(pdf["x"].to_numpy(), pdf["y"].to_numpy(), pdf["w"].to_numpy())]})


def _count_grid(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"s": [_grid_score(pdf)]})


def _sum(parts: DataFrame) -> float:
    return parts.agg(F.coalesce(F.sum("s"), F.lit(0.0))).head()[0]


def _score(cells: DataFrame, block_cells: int) -> float:
    """Concordant minus discordant weight over all pairs of cells."""
    ensure_checkpoint_dir(cells.sparkSession)
    probs = [i / CUTS for i in range(CUTS + 1)]
    level = cells.withColumn("g", F.lit("")).checkpoint()
    total = 0.0
    while True:
        sizes = level.groupBy("g").agg(
            F.count(F.lit(1)).alias("m"),
            F.percentile_approx("x", probs, 20 * CUTS).alias("qx"),
            F.percentile_approx("y", probs, 20 * CUTS).alias("qy"),
        )
        small = sizes.where(F.col("m") <= block_cells).select("g")
        large = sizes.where(F.col("m") > block_cells).select("g", "qx", "qy")
        total += _sum(level.join(small, "g", "left_semi").groupBy("g").applyInPandas(_count_small, "s double"))
        count = large.count()
        if not count:
            return total
        if count <= BROADCAST_ROWS // CUTS:
            large = F.broadcast(large)
        # odd blocks hold exactly one quantile value, even blocks lie between two
        block = lambda v, q: (F.size(F.filter(q, lambda b: b < v)) + F.size(F.filter(q, lambda b: b <= v))).cast("double")
        cut = level.join(large, "g").select(
            "g", "x", "y", "w",
            block(F.col("x"), F.array_distinct("qx")).alias("bx"), block(F.col("y"), F.array_distinct("qy")).alias("by"),
        )
        grid = cut.groupBy("g", "bx", "by").agg(F.sum("w").alias("w"))  # at most (2 CUTS + 3)^2 per problem
        total += _sum(grid.groupBy("g").applyInPandas(_count_grid, "s double"))
        name = lambda axis: F.concat("g", F.lit(axis), F.col(f"b{axis}").cast("int").cast("string"))
        mixed = lambda axis: cut.where(F.col(f"b{axis}") % 2 == 0)
        same_x = mixed("x").select("x", "y", "w", name("x").alias("g"))
        same_y = mixed("y").groupBy(name("y").alias("g"), F.col("bx").alias("x"), "y").agg(F.sum("w").alias("w"))
        level = same_x.unionByName(same_y.select("x", "y", "w", "g")).checkpoint()


def kendall_pair(df: DataFrame, a: str, b: str, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """One row (col_a, col_b, r, n): tau-b over the complete rows."""
    cells = (
        df.select(dbl(a).alias("x"), dbl(b).alias("y")).where("x is not null and y is not null")
        .groupBy("x", "y").agg(F.count(F.lit(1)).cast("double").alias("w"))
    )

    def ties(side):
        t = cells.groupBy(side).agg(F.sum("w").alias("t"))
        pairs = F.col("t") * (F.col("t") - 1) / 2
        return t.agg(F.coalesce(F.sum(pairs), F.lit(0.0)), F.coalesce(F.sum("t"), F.lit(0.0))).head()

    (tx, n), (ty, _) = ties("x"), ties("y")
    pairs = n * (n - 1) / 2
    scale = ((pairs - tx) * (pairs - ty)) ** 0.5
    r = _score(cells, block_cells) / scale if scale > 0 else None
    return df.sparkSession.createDataFrame([(a, b, r, int(n))], "col_a string, col_b string, r double, n bigint")


def kendall_pairs(df: DataFrame, cols: list[str], pairs=None) -> DataFrame:
    pairs = list(combinations(cols, 2)) if pairs is None else list(pairs)
    return reduce(lambda x, y: x.unionByName(y), [kendall_pair(df, a, b) for a, b in pairs])
