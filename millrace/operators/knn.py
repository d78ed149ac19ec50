"""Exact k nearest neighbours by pivot cells.

A bounded set of train rows serves as pivots.  Each train row belongs to the cell of its
nearest pivot and to a ring of it, a range of distances to the pivot.  By the triangle
inequality a query learns from the pivots alone how near and how far the rows of a ring can
be.  It first visits the rings that are sure to hold k rows; the k-th distance found there
rules out all rings that lie farther away, and only the others are visited.

Rings are visited in groups of a bounded number of rows: a query is sent once to each group
that holds a ring of its visit, with a bit per ring, and keeps its closest rows of the group
only.  Large rings are dealt into blocks and the queries of a group into parts, so a task
holds a bounded number of rows of either side, also where the bounds rule nothing out and all
pairs must be compared; neither side is collected, and ties are decided by the id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.numeric import col, dbl
from millrace.session import parallelism, scratch_dir

BLOCK_ROWS = 8_000
#: Pivots and rings per pivot that may go to every task (with one row of distances per query).
MAX_PIVOTS, MAX_RINGS = 512, 32
#: Rows of either side that a task compares at most, and rows compared at once.
TASK_ROWS, TILE = 32_768, 1_024
#: Bounds (queries times rings) that are held at once.
BOUNDS = 500_000
#: Distances are compared to so many digits, so bounds leave that much room.
DIGITS = 9
#: Share of the compared squares by which a bound may err in double precision.
ROUNDING = 1e-12


def _vectors(df: DataFrame, key: str, features) -> DataFrame:
    """(id, v): an array column as it is, or several numeric columns packed."""
    if isinstance(features, str):
        single = df.schema[features].dataType == T.ArrayType(T.FloatType(), df.schema[features].dataType.containsNull)
        v = col(features) if single else F.transform(col(features), lambda x: x.cast("double"))
    else:
        v = F.array(*[F.coalesce(dbl(c), F.lit(0.0)) for c in features])
    return df.select(col(key).alias("id"), v.alias("v"))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances between two small sets, from differences (no cancellation)."""
    out = np.empty((len(a), len(b)))
    for j, row in enumerate(b):
        out[:, j] = np.sqrt(((a - row) ** 2).sum(axis=1))
    return out


@dataclass
class Cells:
    """Pivots, the edges of each cell's rings, and per ring: pivot, rows, least and greatest distance."""

    pivots: np.ndarray
    edges: list[np.ndarray]
    ring_pivot: np.ndarray
    ring: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    task_rows: int = TASK_ROWS

    @cached_property
    def between(self) -> np.ndarray:
        return _distances(self.pivots, self.pivots)

    @cached_property
    def starts(self) -> np.ndarray:
        """First ring of each group: consecutive rings of at most ``task_rows`` rows, or one larger ring."""
        out, held = [], 0
        for i, n in enumerate(self.rows.tolist()):
            if not out or held + n > self.task_rows:
                out.append(i)
                held = 0
            held += n
        return np.array(out, dtype="int64")

    def bounds(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(nearest possible, farthest possible) row of each ring (columns) for each query."""
        to = _distances(v, self.pivots)
        d = to[:, self.ring_pivot]
        near = np.maximum(np.maximum(d - self.high, self.low - d), 0.0)
        # a row of a cell is nearer to its own pivot than to the query's: beyond the bisector
        own = to.argmin(axis=1)
        gap = self.between[own][:, self.ring_pivot]
        nearest = to[np.arange(len(v)), own][:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            across = np.where(gap > 0, (d**2 - nearest**2 - ROUNDING * (d**2 + nearest**2)) / (2 * gap), 0.0)
        return np.maximum(near - ROUNDING * (d + self.high), across), d + self.high

    def assign(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = _distances(v, self.pivots)
        cell = d.argmin(axis=1)
        return cell, d[np.arange(len(v)), cell]

    def sure(self, near: np.ndarray, far: np.ndarray, k: int) -> np.ndarray:
        """Which rings are visited first: by their farthest row, until they hold k rows."""
        order = np.argsort(far, axis=1, kind="stable")
        before = np.cumsum(self.rows[order], axis=1) - self.rows[order]
        out = np.zeros(far.shape, dtype=bool)
        np.put_along_axis(out, order, before < k, axis=1)
        return out


def _room(distance: np.ndarray) -> np.ndarray:
    return distance + 10.0**-DIGITS * 2 + 1e-9 * distance


def fit_cells(train: DataFrame, n: int, block_rows: int = BLOCK_ROWS) -> Cells:
    """Cells over (id, v) of ``n`` rows.  The pivots are a sample by hash, at most MAX_PIVOTS rows;
    ring edges are quantiles of the distances in a cell."""
    wanted = int(min(MAX_PIVOTS, max(1, round((n / block_rows) ** 0.5 * 4), n // block_rows)))
    picked = train.orderBy(F.xxhash64("id"), "id").limit(wanted).collect()
    pivots = np.unique(np.array([r["v"] for r in picked], dtype="float64"), axis=0)
    cells = Cells(pivots, [], *[np.zeros(0)] * 5)
    # about four tasks per core where all pairs are compared
    side = math.ceil((4 * train.sparkSession.sparkContext.defaultParallelism) ** 0.5)
    cells.task_rows = int(min(TASK_ROWS, max(block_rows, -(-n // side))))
    probs = F.array(*[F.lit(i / MAX_RINGS) for i in range(1, MAX_RINGS)])
    inside = _placed(train, cells, ringed=False)
    facts = inside.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("r", probs, F.lit(1000)).alias("q")).collect()
    cells.edges = [np.zeros(0)] * len(pivots)
    for f in facts:
        rings = min(MAX_RINGS, -(-f["n"] // block_rows))
        at = [round(i * MAX_RINGS / rings) - 1 for i in range(1, rings)]
        cells.edges[f["cell"]] = np.unique([f["q"][i] for i in at])
    found = _placed(train, cells).groupBy("cell", "ring").agg(F.count(F.lit(1)).alias("n"), F.min("r").alias("lo"), F.max("r").alias("hi")).collect()
    found.sort(key=lambda r: (r["cell"], r["ring"]))  # at most MAX_PIVOTS * MAX_RINGS rows
    cells.ring_pivot, cells.ring, cells.rows = (np.array([r[c] for r in found], dtype="int64") for c in ("cell", "ring", "n"))
    cells.low, cells.high = (np.array([r[c] for r in found], dtype="float64") for c in ("lo", "hi"))
    return cells


def _written(df: DataFrame, name: str) -> DataFrame:
    """A table below the shared checkpoint folder, read again."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _stack(values: pd.Series, width: int) -> np.ndarray:
    return np.stack(values.to_numpy()).astype("float64") if len(values) else np.zeros((0, width))


def _matrix(values: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as rows."""
    whole = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    flat = whole.flatten().to_numpy(zero_copy_only=False).astype("float64", copy=False)
    return flat.reshape(len(whole), -1) if len(whole) else np.zeros((0, 0))


def _placed(train: DataFrame, cells: Cells, ringed: bool = True) -> DataFrame:
    """Train rows with their cell, ring and distance to the pivot."""
    width = cells.pivots.shape[1]

    def place(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            cell, r = cells.assign(_stack(part["v"], width))
            ring = np.zeros(len(part), dtype="int64")
            if ringed:
                for c in np.unique(cell):
                    ring[cell == c] = np.searchsorted(cells.edges[c], r[cell == c], "right")
            yield part.assign(cell=cell, ring=ring, r=r)

    kind = train.schema["id"].dataType.simpleString()
    return train.mapInPandas(place, f"id {kind}, v {train.schema['v'].dataType.simpleString()}, cell bigint, ring bigint, r double")


def _visits(queries: DataFrame, cells: Cells, k: int, radius: bool) -> DataFrame:
    """(id, v, radius, visits): the rings a query visits first; with ``radius``, those it visits
    then, which may hold a row at that distance or nearer.  ``visits`` lists the groups with such
    rings and a bit for each ring of the group."""
    step = max(1, BOUNDS // max(1, len(cells.rows)))
    ends = [*cells.starts[1:].tolist(), len(cells.rows)]

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, step):
                part = whole.slice(i, step)
                near, far = cells.bounds(_matrix(part.column(1)))
                rings = cells.sure(near, far, k)
                reach = part.column(2).to_numpy(zero_copy_only=False)
                if radius:
                    rings = ~rings & (near <= _room(reach)[:, None])
                lists = [[] for _ in range(part.num_rows)]
                for group, (a, b) in enumerate(zip(cells.starts.tolist(), ends, strict=True)):
                    inside = rings[:, a:b]
                    rows = np.flatnonzero(inside.any(axis=1))
                    bits = np.packbits(inside[rows], axis=1)
                    for row, mask in zip(rows.tolist(), bits, strict=True):
                        lists[row].append({"group": group, "rings": mask.tobytes()})
                kind = pa.list_(pa.struct([("group", pa.int32()), ("rings", pa.binary())]))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lists, kind)], ["id", "v", "radius", "visits"])

    reach = F.col("radius") if radius else F.lit(float("inf"))
    kinds = ", ".join(f"{c} {queries.schema[c].dataType.simpleString()}" for c in ("id", "v"))
    return queries.select("id", "v", reach.alias("radius")).mapInArrow(
        visit, f"{kinds}, radius double, visits array<struct<group: int, rings: binary>>"
    )


def _first_rows(row: np.ndarray, d: np.ndarray, rank: np.ndarray, at: np.ndarray, take: int) -> tuple[np.ndarray, ...]:
    """The ``take`` closest candidates of each row, in order."""
    order = np.lexsort((rank[at], np.round(d, DIGITS), row))
    row, d, at = row[order], d[order], at[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < take
    return row[kept], d[kept], at[kept]


def _search(a: np.ndarray, bits: np.ndarray, radius: np.ndarray, b: np.ndarray, ring: np.ndarray, rank: np.ndarray, take: int) -> tuple[np.ndarray, ...]:
    """(query, distance, train row): the ``take`` closest rows within the radius among the rings
    that ``bits`` name.  Train rows are sorted by ring; ``rank`` orders ties."""
    aa, bb = (a * a).sum(1), (b * b).sum(1)
    # covers the rounding of the expanded form
    slack = 1e-9 * (1.0 + aa + bb.max())
    limit = _room(radius) ** 2
    row, d, at = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
    merged = 0
    for j in range(0, len(b), TILE):
        tile = b[j : j + TILE]
        own, back = np.unique(ring[j : j + TILE], return_inverse=True)
        asked = bits[:, own]
        active = np.flatnonzero(asked.any(axis=1))
        if not len(active):
            continue
        rough = a[active] @ tile.T
        rough *= -2.0
        rough += aa[active, None]
        rough += bb[j : j + TILE]
        if not asked[active].all():
            rough[~asked[active][:, back]] = np.inf
        open_ended = np.flatnonzero(np.isinf(limit[active]))
        if len(open_ended) and len(tile) >= take:
            kth = np.partition(rough[open_ended], take - 1, axis=1)[:, take - 1]
            limit[active[open_ended]] = _room(np.sqrt(np.maximum(kth, 0.0) + slack[active[open_ended]])) ** 2
        near = rough <= np.minimum(limit + slack, np.finfo("float64").max)[active, None]
        i, t = np.divmod(np.flatnonzero(near), len(tile))
        if not len(i):
            continue
        found = np.concatenate([
            np.sqrt(((tile[t[x : x + 8192]] - a[active[i[x : x + 8192]]]) ** 2).sum(1)) for x in range(0, len(i), 8192)
        ])
        row, d, at = np.concatenate([row, active[i]]), np.concatenate([d, found]), np.concatenate([at, t + j])
        if len(row) > merged + 2 * len(a):
            row, d, at = _first_rows(row, d, rank, at, take)
            last = np.flatnonzero(np.arange(len(row)) - np.searchsorted(row, row) == take - 1)
            limit[row[last]] = np.minimum(limit[row[last]], _room(d[last]) ** 2)
            merged = len(row)
    return _first_rows(row, d, rank, at, take)


def _closest(take: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            left = left.take(pa.array(np.argsort(left["slot"].to_numpy(), kind="stable")))
            ring, b = left["slot"].to_numpy(), _matrix(left["v"])
            order = np.argsort(left["id"].to_numpy(), kind="stable")
            rank = np.empty(len(order), dtype="int64")
            rank[order] = np.arange(len(order))
            packed = np.frombuffer(b"".join(right["rings"].to_pylist()), dtype="uint8").reshape(right.num_rows, -1)
            # queries with like visits are compared together
            like = np.argsort(np.ascontiguousarray(packed).view(f"V{packed.shape[1]}").ravel(), kind="stable")
            a, radius = _matrix(right["v"]), right["radius"].to_numpy()
            for i in range(0, len(like), TILE):
                part = like[i : i + TILE]
                bits = np.unpackbits(packed[part], axis=1).astype(bool)
                row, d, at = _search(a[part], bits, radius[part], b, ring, rank, take)
                out.append((part[row], d, at))
        row, d, at = (np.concatenate([o[i] for o in out]) if out else np.zeros(0, kind) for i, kind in enumerate(("int64", "float64", "int64")))
        return pa.table({
            "query_id": right["id"].take(pa.array(row)), "id": left["id"].take(pa.array(at)), "distance": pa.array(d, pa.float64())
        })

    return run


def _compare(placed: DataFrame, visits: DataFrame, cells: Cells, take: int, block_rows: int) -> DataFrame:
    """The ``take`` closest rows within the radius of each visited group for each query.

    A group of one large ring is dealt into blocks; the queries of a group are dealt into
    parts.  A block is copied once per part of the queries of its own group only.
    """
    spark, kind = placed.sparkSession, visits.schema["id"].dataType.simpleString()
    train_kind = placed.schema["id"].dataType.simpleString()
    size = max(cells.task_rows, block_rows)
    visits = _written(visits, "visits")
    asked_of = {r["group"]: -(-r["n"] // size) for r in visits.select(F.explode("visits.group").alias("group")).groupBy("group").agg(F.count(F.lit(1)).alias("n")).collect()}
    # one row per ring, at most MAX_PIVOTS * MAX_RINGS
    group_of = np.searchsorted(cells.starts, np.arange(len(cells.rows)), "right") - 1
    held = np.bincount(group_of, cells.rows).astype("int64")
    facts = [(g, int(-(-held[g] // size)), parts) for g, parts in asked_of.items()]
    groups = F.broadcast(spark.createDataFrame(facts, "group int, blocks bigint, parts bigint"))
    rings = F.broadcast(spark.createDataFrame(
        [(int(cells.ring_pivot[i]), int(cells.ring[i]), int(g), int(i - cells.starts[g])) for i, g in enumerate(group_of)],
        "cell bigint, ring bigint, group int, slot int",
    ))
    deal = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.col(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    blocks = placed.select("id", "v", "cell", "ring").join(rings, ["cell", "ring"]).join(groups, "group").select(
        "id", "v", "group", "slot", deal("blocks", "block").alias("b"), each("parts").alias("p")
    )
    asked = visits.select("id", "v", "radius", F.inline("visits")).join(groups, "group").select(
        "id", "v", "radius", "group", "rings", each("blocks").alias("b"), deal("parts", "part").alias("p")
    )
    # few bytes and much work per task: the number of partitions is fixed, not derived from bytes
    tasks = min(4096, max(parallelism(spark), 2 * sum(b * p for _, b, p in facts)))
    left, right = (x.repartition(tasks, "group", "b", "p").groupBy("group", "b", "p") for x in (blocks, asked))
    return left.cogroup(right).applyInArrow(_closest(take), f"query_id {kind}, id {train_kind}, distance double")


def _kept(pairs: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.round("distance", DIGITS), "id")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def neighbours(train: DataFrame, queries: DataFrame, key: str, features, k: int = 5, exclude_self: bool = False, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, id, distance, rank): the k closest train rows of each query."""
    t, q = _vectors(train, key, features), _vectors(queries, key, features)
    n = t.count()
    take = k + 1 if exclude_self else k
    if not n:
        kind = queries.schema[key].dataType.simpleString()
        return train.sparkSession.createDataFrame([], f"query_id {kind}, id {t.schema['id'].dataType.simpleString()}, distance double, rank int")
    cells = fit_cells(t, n, block_rows)
    placed = _written(_placed(t, cells), "placed")
    first = _written(_kept(_compare(placed, _visits(q, cells, take, False), cells, take, block_rows), take), "knn")
    # the whole table holds fewer rows than asked for: nothing can be ruled out by a distance
    radius = F.when(F.count(F.lit(1)) >= take, F.max("distance")).otherwise(F.lit(float("inf")))
    reach = first.groupBy("query_id").agg(radius.alias("radius")).withColumnRenamed("query_id", "id")
    then = _visits(q.join(reach, "id"), cells, take, True)
    pairs = first.drop("rank").unionByName(_compare(placed, then, cells, take, block_rows))
    if exclude_self:
        pairs = pairs.where("query_id <> id")
    return _kept(pairs, k)


def knn_predict(train: DataFrame, queries: DataFrame, key: str, features, label: str, k: int = 5, weights: str = "uniform", regression: bool = False, exclude_self: bool = False) -> DataFrame:
    """(query_id, prediction) by vote or mean of the k nearest labels."""
    near = neighbours(train, queries, key, features, k, exclude_self)
    near = near.join(train.select(col(key).alias("id"), col(label).alias("label")), "id")
    # an exact hit decides alone under distance weights, as its weight is infinite
    hit = F.max((F.col("distance") == 0).cast("int")).over(Window.partitionBy("query_id"))
    weight = F.lit(1.0)
    if weights == "distance":
        weight = F.when(hit == 1, (F.col("distance") == 0).cast("double")).otherwise(
            1.0 / F.greatest(F.col("distance"), F.lit(1e-300))
        )
    near = near.withColumn("weight", weight)
    if regression:
        total = F.sum(F.col("weight") * F.col("label")) / F.sum("weight")
        return near.groupBy("query_id").agg(total.alias("prediction"))
    votes = near.groupBy("query_id", "label").agg(F.sum("weight").alias("votes"))
    best = F.min(F.struct(-F.round("votes", 9), F.col("label")))
    return votes.groupBy("query_id").agg(best.alias("b")).select("query_id", F.col("b.label").alias("prediction"))
