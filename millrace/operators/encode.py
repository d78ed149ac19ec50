"""Categorical encoders.

All columns are counted together: one pass gives a table (column, value, count, target sum)
from which every encoder takes what it learns, so the jobs of a fit do not grow with the
columns.  Dictionaries are inlined while small, broadcast up to a bound of entries and bytes,
and kept as a table, a folder per column, beyond it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import text
from millrace.functions.numeric import col, dbl
from millrace.operators import schema as S
from millrace.operators.skew import BROADCAST_ROWS, MIN_SUPPORT, lookup, with_row_number
from millrace.operators.typing import _counts, text_facts
from millrace.plans.fitted import Step, applies
from millrace.session import parallelism, scratch_dir

INLINE = 200
MAX_ONEHOT = 1_000
#: A dictionary is broadcast up to BROADCAST_ROWS entries of so many bytes.
ENTRY_BYTES = 64
BINARY_MAX, ONEHOT_MAX, LABEL_MAX = 2, 10, 50
ENCODERS = ["bool", "binary", "onehot", "label", "frequency", "ordinal", "multihot", "target", "skip"]


# ---- value table: one pass over all columns ---------------------------------------

@dataclass(frozen=True)
class Ask:
    """One column to encode and what its encoder needs."""

    column: str
    how: str
    cap: int = MAX_ONEHOT
    sep: str = ","
    null_code: int | None = -1
    null_column: bool = False
    drop_first: bool = False


def _cell_of(n: int):
    return lambda v: F.struct(F.lit(n).alias("n"), v.alias("v"))


class ValueTable:
    """Counts and target sums per (column, value) of all asked columns, from one pass.

    Columns go by their number.  A null value counts the rows without one; number -1 holds
    all rows.  What is read to the driver is one row per column and the values of columns
    that fit their bound.
    """

    def __init__(self, df: DataFrame, asks: list[Ask], target: str | None = None):
        self.spark, self.asks = df.sparkSession, asks
        y = F.lit(None).cast("double") if target is None else dbl(target)
        cells = [F.array(F.struct(F.lit(-1).alias("n"), F.lit(None).cast("string").alias("v")))]
        for n, ask in enumerate(asks):
            if ask.how == "multihot":
                found = F.coalesce(text.tags(col(ask.column), ask.sep), F.array().cast("array<string>"))
                cells.append(F.transform(found, _cell_of(n)))
            else:
                cells.append(F.array(_cell_of(n)(col(ask.column).cast("string"))))
        long = df.select(F.explode(F.concat(*cells)).alias("c"), y.alias("y"))
        counts = long.groupBy(F.col("c.n").alias("n"), F.col("c.v").alias("value")).agg(
            F.count(F.lit(1)).alias("count"), F.sum("y").alias("y_sum"), F.count("y").alias("y_count")
        )
        path = scratch_dir(self.spark, "values")
        counts.write.parquet(path)
        self.table = self.spark.read.schema(counts.schema).parquet(path)
        known = F.col("value").isNotNull()
        found = self.table.groupBy("n").agg(
            F.count("value").alias("distinct"), F.sum(F.when(known, F.col("count"))).alias("total"), F.sum("count").alias("rows"),
            F.sum(F.octet_length("value")).alias("bytes"), F.sum("y_sum").alias("y_sum"), F.sum("y_count").alias("y_count"),
        ).collect()
        self.facts = {r["n"]: r for r in found}
        every = self.facts.get(-1)
        self.rows = every["rows"] if every else 0
        self.mean = every["y_sum"] / every["y_count"] if every and every["y_count"] else None
        small = [n for n in range(len(asks)) if self.distinct(n) <= self._bound(n)]
        self.small: dict[int, list] = {n: [] for n in small}
        if small:
            for r in self.table.where(known & F.col("n").isin(small)).collect():
                self.small[r["n"]].append(r)
        for rows in self.small.values():
            rows.sort(key=lambda r: r["value"])
        self._coded: dict[str, str] = {}

    def distinct(self, n: int) -> int:
        return self.facts[n]["distinct"] if n in self.facts else 0

    def _bound(self, n: int) -> int:
        return INLINE if self.asks[n].how in ("label", "frequency", "target") else self.asks[n].cap

    def values(self, n: int) -> list[str]:
        """Sorted distinct values; an error above the cap, never a cut."""
        if n not in self.small:
            what = "tags" if self.asks[n].how == "multihot" else "categories"
            raise ValueError(f"column {self.asks[n].column!r} has more than {self.asks[n].cap} {what}; use label or frequency encoding")
        return [r["value"] for r in self.small[n]]

    def _large(self, *hows: str) -> list[int]:
        return [n for n, a in enumerate(self.asks) if a.how in hows and n not in self.small]

    def path(self, how: str) -> str:
        """The written codes of all large columns of a kind, one folder per column number."""
        kind = "label" if how == "label" else "number"
        if kind not in self._coded:
            wanted = self._large("label") if kind == "label" else self._large("frequency", "target")
            rows = self.table.where(F.col("value").isNotNull() & F.col("n").isin(wanted))
            if kind == "label":
                # one numbering of all columns in ranges of (column, value), less the columns before
                before, offsets = 0, []
                for n in wanted:
                    offsets += [F.lit(n), F.lit(before)]
                    before += self.distinct(n)
                keyed = rows.select("n", "value", F.concat(F.lpad(F.col("n").cast("string"), 10, "0"), F.lit(":"), "value").alias("__key"))
                code = F.col("code") - 1 - F.element_at(F.create_map(*offsets), F.col("n"))
                coded = with_row_number(keyed, ["__key"], name="code").select("n", "value", code.cast("int").alias("code"))
            else:
                totals = F.create_map(*[F.lit(x) for n in wanted for x in (n, float(max(self.facts[n]["total"] or 0, 1)))])
                targets = [n for n in wanted if self.asks[n].how == "target"]
                mean = F.try_divide("y_sum", F.col("y_count").cast("double"))
                share = F.col("count") / F.element_at(totals, F.col("n"))
                coded = rows.select("n", "value", F.when(F.col("n").isin(targets), mean).otherwise(share).alias("code"))
            self._coded[kind] = scratch_dir(self.spark, "dictionary")
            coded.write.partitionBy("n").parquet(self._coded[kind])
        return self._coded[kind]

    @cached_property
    def hot(self) -> dict[int, list[int]]:
        """Hashes of the values of large columns that hold a large share of the rows."""
        large = self._large("label", "frequency", "target")
        support = max(MIN_SUPPORT, 1.0 / (2 * parallelism(self.spark)))
        out: dict[int, list[int]] = {n: [] for n in large}
        many = [n for n in large if self.weight(n) > BROADCAST_ROWS]
        if many:
            key = F.xxhash64("value")
            for r in self.table.where(F.col("value").isNotNull() & F.col("n").isin(many) & (F.col("count") > support * self.rows)).select("n", key.alias("h")).collect():
                out[r["n"]].append(r["h"])
        return {n: sorted(h) for n, h in out.items()}

    def weight(self, n: int) -> int:
        """Entries of a dictionary, or its bytes in entries of ENTRY_BYTES where that is more."""
        return max(self.distinct(n), -(-(self.facts[n]["bytes"] or 0) // ENTRY_BYTES))

    def dictionary(self, n: int, default, code) -> Step:
        """A dictionary step: inlined where small (``code`` of position and row), else a table."""
        c = self.asks[n].column
        if n in self.small:
            return Step("dictionary", {"column": c, "map": {r["value"]: code(i, r) for i, r in enumerate(self.small[n])}, "default": default})
        path = f"{self.path(self.asks[n].how)}/n={n}"
        return Step("dictionary", {"column": c, "table": path, "rows": self.weight(n), "default": default, "hot": self.hot[n]})

    def step(self, n: int) -> Step:
        ask = self.asks[n]
        c, how = ask.column, ask.how
        if how == "label":
            return self.dictionary(n, ask.null_code, lambda i, r: i)
        if how == "frequency":
            return self.dictionary(n, 0.0, lambda i, r: r["count"] / max(self.facts[n]["total"], 1))
        if how == "target":
            return self.dictionary(n, self.mean, lambda i, r: r["y_sum"] / r["y_count"] if r["y_count"] else None)
        if how == "binary":
            return Step("dictionary", {"column": c, "map": {v: i for i, v in enumerate(self.values(n))}, "default": None})
        if how == "ordinal":
            return ordinal_step(c, self.values(n))
        values = self.values(n)
        if how == "multihot":
            return Step("multihot", {"column": c, "sep": ask.sep, "values": values})
        return Step("onehot", {"column": c, "values": values[1:] if ask.drop_first else values, "null_column": ask.null_column})


def _fit(df: DataFrame, ask: Ask, target: str | None = None) -> Step:
    return ValueTable(df, [ask], target).step(0)


# ---- dictionary encoders ------------------------------------------------------

@applies("dictionary")
def _apply_dictionary(df, p):
    c = p["column"]
    if c not in df.columns:
        return df
    default = F.lit(p["default"])
    if "map" in p:
        if not p["map"]:
            return df.withColumn(c, default.cast("double"))
        table = F.create_map(*[F.lit(x) for x in chain.from_iterable(p["map"].items())])
        code = F.try_element_at(table, col(c).cast("string"))
        return df.withColumn(c, F.coalesce(code, default))
    pairs = df.sparkSession.read.parquet(p["table"]).withColumnRenamed("value", "__key")
    keyed = df.withColumn("__key", col(c).cast("string"))
    out = lookup(keyed, pairs, ["__key"], rows=p["rows"], hot=p.get("hot"))
    return out.withColumn(c, F.coalesce("code", default)).drop("__key", "code")


def dictionary_lookup(df: DataFrame, column: str, mapping: dict, default=None) -> DataFrame:
    return Step("dictionary", {"column": column, "map": mapping, "default": default}).transform(df)


def fit_label(df: DataFrame, c: str, null_code: int | None = -1) -> Step:
    """0-based code of the sorted text value."""
    return _fit(df, Ask(c, "label", null_code=null_code))


def fit_frequency(df: DataFrame, c: str) -> Step:
    """Share of all non-null rows that hold the value."""
    return _fit(df, Ask(c, "frequency"))


def fit_target(df: DataFrame, c: str, target: str) -> Step:
    """Mean of the target per category; unseen categories get the overall mean."""
    return _fit(df, Ask(c, "target"), target)


def fit_binary(df: DataFrame, c: str) -> Step:
    """Two sorted categories to 0 / 1, null stays null."""
    return _fit(df, Ask(c, "binary", cap=2))


def ordinal_step(c: str, order: list[str]) -> Step:
    return Step("dictionary", {"column": c, "map": {v: i for i, v in enumerate(order)}, "default": -1})


# ---- indicator encoders -------------------------------------------------------

def fit_onehot(df: DataFrame, c: str, null_column: bool = False, drop_first: bool = False, cap: int = MAX_ONEHOT) -> Step:
    return _fit(df, Ask(c, "onehot", cap, null_column=null_column, drop_first=drop_first))


@applies("onehot")
def _apply_onehot(df, p):
    c = p["column"]
    if c not in df.columns:
        return df
    x = col(c).cast("string")
    out = {f"{c}_{v}": F.when(x == F.lit(v), 1).otherwise(0) for v in p["values"]}
    if p.get("null_column"):
        out[f"{c}_nan"] = F.when(x.isNull(), 1).otherwise(0)
    return S.drop_columns(df.withColumns(out), [c])


def fit_multihot(df: DataFrame, c: str, sep: str = ",", cap: int = MAX_ONEHOT) -> Step:
    return _fit(df, Ask(c, "multihot", cap, sep))


@applies("multihot")
def _apply_multihot(df, p):
    c = p["column"]
    if c not in df.columns:
        return df
    out = df.withColumn("__tags", F.coalesce(text.tags(col(c), p["sep"]), F.array().cast("array<string>")))
    marks = {f"{c}_{v}": F.array_contains("__tags", v).cast("int") for v in p["values"]}
    return S.drop_columns(out.withColumns(marks), [c, "__tags"])


@applies("bool_int")
def _apply_bool_int(df, p):
    return df.withColumns({c: text.bool_to_int(col(c)) for c in p["columns"] if c in df.columns})


# ---- choosing -----------------------------------------------------------------

def auto_encoders(df: DataFrame, skip=()) -> dict[str, str]:
    """bool, multi-label, <= 2 binary, <= 10 one-hot, <= 50 label, else frequency."""
    names = [c for c in S.text_columns(df) + S.boolean_columns(df) if c not in skip]
    if not names:
        return {}
    part = df.select(*[col(c) for c in names])
    facts = _counts(part).join(
        text_facts(part, names).select("column", "is_bool_like", "comma_ratio"), "column"
    )
    choice = (
        F.when(F.col("is_bool_like"), "bool")
        .when(F.col("comma_ratio") >= 0.5, "multihot")
        .when(F.col("n_unique") <= BINARY_MAX, "binary")
        .when(F.col("n_unique") <= ONEHOT_MAX, "onehot")
        .when(F.col("n_unique") <= LABEL_MAX, "label")
        .otherwise("frequency")
    )
    found = {r[0]: r[1] for r in facts.select("column", choice).collect()}
    return {c: found[c] for c in names}


def fit_encode(df: DataFrame, choice: dict[str, str], target: str | None = None, orders: dict[str, list[str]] | None = None) -> list[Step]:
    """One step per column; ``skip`` drops the column.  All columns are counted in one pass."""
    unknown = [how for c, how in choice.items() if c in df.columns and how not in ENCODERS]
    if unknown:
        raise ValueError(f"unknown encoder {unknown[0]!r}; known: {ENCODERS}")
    orders = orders or {}
    counted = [c for c, how in choice.items() if c in df.columns and how not in ("bool", "skip") and not (how == "ordinal" and orders.get(c))]
    asks = [Ask(c, choice[c], cap=2 if choice[c] == "binary" else MAX_ONEHOT) for c in counted]
    needs_target = any(a.how == "target" for a in asks)
    table = ValueTable(df, asks, target if needs_target else None) if asks else None
    steps = []
    for c, how in choice.items():
        if c not in df.columns:
            continue
        if how == "bool":
            steps.append(Step("bool_int", {"columns": [c]}))
        elif how == "skip":
            steps.append(Step("drop", {"columns": [c], "reason": "skip"}))
        elif c in counted:
            steps.append(table.step(counted.index(c)))
        else:
            steps.append(ordinal_step(c, orders[c]))
    return steps


def fit_encode_auto(df: DataFrame, overrides: dict[str, str] | None = None, skip=(), target=None) -> list[Step]:
    choice = auto_encoders(df, skip)
    choice.update(overrides or {})
    return fit_encode(df, choice, target)


def fit_residual_sweep(df: DataFrame, skip=()) -> list[Step]:
    """Label-encode whatever is still not numeric."""
    left = [
        f.name for f in df.schema.fields
        if not isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]
    return fit_encode(df, dict.fromkeys(left, "label"))
