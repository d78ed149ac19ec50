"""Order- and key-dependent work that stays balanced when one key is huge.

* hot keys are found with a bounded one-pass sketch (``freqItems``);
* a window over a hot key is cut into chunks of its order column, and a small
  carry table (one row per hot key and chunk) links the chunks;
* a left join against a dictionary broadcasts the entries of hot keys only.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.numeric import col
from millrace.session import ensure_checkpoint_dir, parallelism

BROADCAST_ROWS = 200_000
MIN_SUPPORT = 1e-4
MAX_CHUNKS = 2_000


def _key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*[col(k) for k in keys])


def hot_hashes(df: DataFrame, keys: list[str], support: float | None = None) -> list[int]:
    """Hashes of every key whose share of the rows may exceed ``support``.

    ``freqItems`` never misses such a key and returns at most 1/support items,
    so the list is bounded whatever the data; a false positive only means one
    more key is chunked or salted.
    """
    if support is None:
        support = max(MIN_SUPPORT, 1.0 / (2 * parallelism(df.sparkSession)))
    found = df.select(_key_hash(keys).alias("h")).stat.freqItems(["h"], support).head()
    return sorted(found[0] or []) if found else []


def order_number(df: DataFrame, name: str) -> Column | None:
    """A double that sorts like the column, or null when its type has none."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col(name)).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        # by its fields: a cast to a zoned timestamp would fold daylight-saving gaps
        t = col(name)
        minutes = (F.unix_date(t.cast("date")).cast("bigint") * 24 + F.hour(t)) * 60 + F.minute(t)
        second = (F.extract(F.lit("SECOND"), t) * 1000000).cast("bigint")
        return (minutes * 60000000 + second).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(col(name)).cast("double")
    if isinstance(kind, T.NumericType):
        return col(name).cast("double")
    return None


def chunked(df: DataFrame, order_by: list[str], keys: list[str], hot=None):
    """Add ``__k`` (key struct) and ``__ch`` (chunk, 0 for keys that are not hot).

    Chunks follow the sort order.  Bounds are quantiles of the leading order
    column over all rows, so no chunk of one key holds more than about one
    part in ``parallelism`` of the table, however large that key is.
    Returns (frame, whether any chunk other than 0 can occur).
    """
    spark = df.sparkSession
    if keys:
        hot = hot_hashes(df, keys) if hot is None else hot
        out = df.withColumn("__k", F.struct(*[col(k) for k in keys]))
        if not hot:
            return out.withColumn("__ch", F.lit(0)), False
        is_hot = _key_hash(keys).isin(hot)
    else:
        out = df.withColumn("__k", F.struct(F.lit(0).alias("all")))
        is_hot = F.lit(True)

    parts = min(parallelism(spark), MAX_CHUNKS)
    lead = order_number(df, order_by[0])
    if lead is not None:
        probs = [i / parts for i in range(1, parts)]
        row = df.where(is_hot).agg(
            F.percentile_approx(lead, probs, 20 * parts).alias("q")
        ).head()
        bounds = row[0] or []
        heavy_ties = len(order_by) > 1 and len(set(bounds)) < 0.75 * len(bounds)
        if not heavy_ties:
            splits = [float("-inf"), *sorted(set(bounds)), float("inf")]
            if len(splits) == 2:
                splits.insert(1, 0.0)
            binned = Bucketizer(
                splits=splits, inputCol="__lead", outputCol="__b", handleInvalid="keep"
            ).transform(out.withColumn("__lead", lead))
            chunk = F.when(~is_hot, 0).when(F.col("__lead").isNull(), -1)
            return (
                binned.withColumn("__ch", chunk.otherwise(F.col("__b").cast("int") + 1))
                .drop("__lead", "__b"),
                True,
            )
    # Text order keys, or one order value that fills several chunks: range
    # partition on the whole sort key and fix the assignment with a checkpoint.
    ensure_checkpoint_dir(spark)
    fixed = (
        out.repartitionByRange(parts, *[col(c) for c in [*keys, *order_by]])
        .withColumn("__p", F.spark_partition_id())
        .checkpoint()
    )
    return fixed.withColumn("__ch", F.when(is_hot, F.col("__p") + 1).otherwise(0)).drop("__p"), True


def with_row_number(
    df: DataFrame, order_by: list[str], partition_by: list[str] = (), name: str = "row_number"
) -> DataFrame:
    """Exact 1-based position in ``order_by`` within ``partition_by``.

    The whole table may be one partition: positions are counted per chunk and
    shifted by the sizes of the chunks before.
    """
    keys = list(partition_by)
    out, split = chunked(df, list(order_by), keys)
    w = Window.partitionBy("__k", "__ch").orderBy(*[col(c) for c in order_by])
    if not split:
        return out.withColumn(name, F.row_number().over(w).cast("bigint")).drop("__k", "__ch")
    before = Window.partitionBy("__k").orderBy("__ch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        out.groupBy("__k", "__ch").agg(F.count(F.lit(1)).alias("__n"))
        .select("__k", "__ch", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    )
    if not keys:
        offsets = F.broadcast(offsets)  # at most MAX_CHUNKS + 2 rows
    return (
        out.join(offsets, ["__k", "__ch"], "left")
        .withColumn(name, (F.row_number().over(w) + F.col("__off")).cast("bigint"))
        .drop("__k", "__ch", "__off")
    )


def fill_nearest(
    df: DataFrame,
    wanted: dict[str, tuple[Column, str]],
    order_by: list[str],
    partition_by: list[str] = (),
) -> DataFrame:
    """Nearest non-null value at or ``before`` / ``after`` each row.

    ``wanted`` maps a new column to (value expression, side).
    """
    keys = list(partition_by)
    out, split = chunked(df, list(order_by), keys)
    for name, (value, _) in wanted.items():
        out = out.withColumn(f"__v_{name}", value)
    order = [col(c) for c in order_by]
    w = Window.partitionBy("__k", "__ch").orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    # in reverse order: a frame that ends at the last row is evaluated anew for every row
    back = Window.partitionBy("__k", "__ch").orderBy(*[o.desc() for o in order])
    onward = back.rowsBetween(Window.unboundedPreceding, 0)
    local = {
        name: F.last(f"__v_{name}", True).over(upto if side == "before" else onward)
        for name, (_, side) in wanted.items()
    }
    if not split:
        out = out.withColumns(local)
        return out.drop("__k", "__ch", *[f"__v_{n}" for n in wanted])

    rows = out.where(F.col("__ch") != 0) if keys else out
    per_chunk = rows.groupBy("__k", "__ch").agg(
        *[
            (F.max_by if side == "before" else F.min_by)(
                F.col(f"__v_{name}"), F.when(F.col(f"__v_{name}").isNotNull(), F.struct(*order))
            ).alias(f"__e_{name}")
            for name, (_, side) in wanted.items()
        ]
    )
    c = Window.partitionBy("__k").orderBy("__ch")
    earlier = c.rowsBetween(Window.unboundedPreceding, -1)
    later = c.rowsBetween(1, Window.unboundedFollowing)
    carry = per_chunk.select(
        "__k",
        "__ch",
        *[
            (
                F.last(f"__e_{name}", True).over(earlier)
                if side == "before"
                else F.first(f"__e_{name}", True).over(later)
            ).alias(f"__c_{name}")
            for name, (_, side) in wanted.items()
        ],
    )
    if not keys:
        carry = F.broadcast(carry)  # at most MAX_CHUNKS + 2 rows
    joined = out.join(carry, ["__k", "__ch"], "left").withColumns(
        {n: F.coalesce(e, F.col(f"__c_{n}")) for n, e in local.items()}
    )
    drop = ["__k", "__ch"] + [f"__{p}_{n}" for n in wanted for p in ("v", "c")]
    return joined.drop(*drop)


def lookup(
    df: DataFrame,
    dictionary: DataFrame,
    on: list[str],
    rows: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS, hot: list[int] | None = None,
) -> DataFrame:
    """Left join against a unique-keyed dictionary.

    Broadcast while ``rows`` (the counted dictionary size) stays under the
    bound.  Beyond it only the entries of hot keys are broadcast (there are at
    most 1/support of them), and the remaining rows, whose keys are all small,
    meet the dictionary in a shuffle join.  ``hot`` gives the hashes of hot keys if they are
    known; a stream cannot be searched for them.
    """
    rows = dictionary.count() if rows is None else rows
    if rows <= broadcast_rows:
        return df.join(F.broadcast(dictionary), on, "left")
    if hot is None:
        hot = [] if df.isStreaming else hot_hashes(df, on)
    if not hot:
        return df.join(dictionary, on, "left")
    is_hot = _key_hash(on).isin(hot)
    top = df.where(is_hot).join(F.broadcast(dictionary.where(is_hot)), on, "left")
    rest = df.where(~is_hot).join(dictionary.where(~is_hot), on, "left")
    return top.unionByName(rest)
