"""A Merkle manifest of a table, and the proof of each row by descent of its store.

A row is a leaf: the SHA-256 of its fields in an unambiguous form.  Within a group (source)
leaves ascend by key; every three consecutive nodes become their digest until one is left,
the group's subroot, and the subroots give the root in the same way.  Each inner node is a
record of a content-addressed store, digest to children.

A leaf's request descends from the root: the base-3 digits of its rank choose a child per
level, the unselected children are collected, and the segments of the path, reversed, are
the proof.  Requests below one node travel as one row until they part, so a level is one
join of that level's nodes with its records, and no key has more than three rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import discard, stored
from millrace.operators.skew import with_row_number

FAN = 3
#: Levels built per shuffle: a task holds FAN ** LEVELS digests of a group at a time.
LEVELS = 4
_NODE = "g string, i bigint, digest string, children array<string>, level int, top boolean, done boolean"
_PATH = "array<struct<before:string,after:string>>"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]), 256)


@dataclass
class Forest:
    """The store (one table per LEVELS levels) and the top node (g, digest, height) of each group."""

    segments: list[DataFrame]
    tops: DataFrame
    height: int

    def records(self, level: int) -> DataFrame:
        rows = self.segments[(level - 1) // LEVELS]
        return rows.where((F.col("level") == level) & F.col("children").isNotNull()).select("digest", "children").distinct()


def _grow(base: int):
    """Nodes above blocks of FAN ** LEVELS consecutive nodes (g, block, [(i, digest)])."""
    full = FAN**LEVELS

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for g, block, members in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                nodes = [m["digest"] for m in sorted(members, key=lambda m: m["i"])]
                whole = block == 0 and len(nodes) < full  # the group has no other block
                level, at = base, len(out)
                while (len(nodes) > 1) if whole else (level < base + LEVELS):
                    runs = [nodes[k : k + FAN] for k in range(0, len(nodes), FAN)]
                    nodes, level = [digest("".join(run)) for run in runs], level + 1
                    out += [(g, block, d, run, level, False, whole) for d, run in zip(nodes, runs, strict=True)]
                if len(out) == at:  # a lone node is its own top and no record
                    out.append((g, block, nodes[0], None, level, True, whole))
                else:
                    out[-1] = (*out[-1][:5], True, whole)
            columns = list(zip(*out, strict=True)) or [[]] * 7
            kinds = [pa.string(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.int32(), pa.bool_(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ["g", "i", "digest", "children", "level", "top", "done"],
            )

    return build


def forest(nodes: DataFrame) -> Forest:
    """Trees over ``nodes`` (g, i, digest), i from 0 without gaps within each group g."""
    segments, base = [], 0
    while True:
        blocks = nodes.groupBy("g", F.expr(f"i div {FAN**LEVELS}").alias("block")).agg(F.collect_list(F.struct("i", "digest")).alias("members"))
        grown = stored(blocks.mapInArrow(_grow(base), _NODE), "merkle")
        segments.append(grown)
        nodes = grown.where("top and not done").select("g", "i", "digest")
        if nodes.isEmpty():
            break
        base += LEVELS
    ends = [s.where("top and done").select("g", "digest", F.col("level").alias("height")) for s in segments]
    tops = ends[0]
    for more in ends[1:]:
        tops = tops.unionByName(more)
    return Forest(segments, tops, tops.agg(F.max("height")).head()[0] or 0)


def _step(digit: Column) -> Column:
    """One path segment: the children before and after the chosen one."""
    return F.array(F.struct(
        F.array_join(F.slice("children", F.lit(1), digit), "").alias("before"),
        F.array_join(F.slice("children", digit + 2, F.lit(FAN)), "").alias("after"),
    ))


def descend(trees: Forest, starts: DataFrame, requests: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """``requests`` (g, i, ...) with the ``path`` from the start of their group down to leaf i.

    ``starts`` (g, digest, height, path, ...) holds the top of each group; its other columns
    are passed on.  ``wanted`` (g, i) names the leaves asked for where they are few: nodes
    above none of them are left out.  By default every leaf is asked for.
    """
    carried = [c for c in starts.columns if c not in ("g", "digest", "height", "path")]
    lone = starts.where("height = 0").select("g", "path", *carried)
    found = requests.join(lone, "g")
    if not trees.height:
        return found
    level, front = trees.height, None
    while True:
        begun = starts.where(F.col("height") == level).select("g", F.lit(0).cast("bigint").alias("p"), "digest", "path", *carried)
        front = begun if front is None else front.unionByName(begun)
        opened = front.join(trees.records(level), "digest").select("g", "p", "children", "path", *carried)
        if level == 1:
            break
        front = opened.select("*", F.posexplode("children").alias("digit", "digest")).select(
            "g", (F.col("p") * FAN + F.col("digit")).alias("p"), "digest", F.concat("path", _step(F.col("digit"))).alias("path"), *carried
        )
        level -= 1
        if wanted is not None:
            asked = wanted.select("g", F.expr(f"i div {FAN**level}").alias("p")).distinct()
            front = front.join(asked, ["g", "p"], "left_semi")
    digit = F.pmod("i", F.lit(FAN)).cast("int")
    below = requests.withColumn("p", F.expr(f"i div {FAN}")).join(opened, ["g", "p"])
    return below.withColumn("path", F.concat("path", _step(digit))).select(*found.columns).unionByName(found)


def fold(start: str, path: list[dict]) -> str:
    """The root that a leaf and its proof (root first) give."""
    node = start
    for step in reversed(path):
        node = digest(step["before"] + node + step["after"])
    return node


def proof_text(path: list[dict]) -> str:
    """All siblings, from the leaf's level up, left to right."""
    return "".join(step["before"] + step["after"] for step in reversed(path))


def _prove(root: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, paths = batch.column("offered").to_pylist(), batch.column("path").to_pylist()
            folded = [fold(s, p) for s, p in zip(starts, paths, strict=True)]
            proofs = [digest(proof_text(p)) for p in paths]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("leaf"), batch.column("subroot"), pa.array([root] * batch.num_rows, pa.string()),
                 pa.array(proofs, pa.string()), pa.array(folded, pa.string()), pa.array([f == root for f in folded], pa.bool_())],
                ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
            )

    return run


def ranked_leaves(docs: DataFrame, key: str, group: str, fields: tuple[str, ...], altered: dict[str, Column]) -> DataFrame:
    """(key, g, i, leaf, offered): a group as text with null first, the rank in it, the leaf, and
    the leaf with the columns of ``altered`` in place of its own."""
    source = F.col(group).cast("string")
    rows = stored(docs.select(
        F.col(key).alias("key"), F.coalesce(F.concat(F.lit(">"), source), F.lit("")).alias("g"),
        leaf([F.col(f) for f in fields]).alias("leaf"), leaf([altered.get(f, F.col(f)) for f in fields]).alias("offered"),
    ), "leaves")
    out = stored(with_row_number(rows, ["key", "leaf"], ["g"], "__i").select("key", "g", (F.col("__i") - 1).alias("i"), "leaf", "offered"), "ranked")
    discard(rows)
    return out


def manifest(
    docs: DataFrame, key: str = "doc_id", group: str = "source", fields: tuple[str, ...] = FIELDS,
    altered: dict[str, Column] | None = None, asked: Column | None = None,
) -> DataFrame:
    """Per row: key, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``altered`` gives other values for some fields: ``folded_root`` is the root that a reader
    of those values computes from the original proof, and ``verified`` says whether it is the
    root.  ``asked`` (a condition on ``key``) limits the rows that are proved, not the tree.

    A null field is ``-``; a null group comes before all others, the empty one next; a null
    key is the first of its group; rows of equal key are ordered by their leaf, so equal rows
    are interchangeable and each has its own place.  Columns outside ``fields`` are not read.
    An empty table gives an empty table.
    """
    rows = ranked_leaves(docs, key, group, fields, altered or {})
    trees = forest(rows.select("g", "i", F.col("leaf").alias("digest")))
    tops = stored(with_row_number(trees.tops, ["g"], name="__i").withColumn("i", F.col("__i") - 1).drop("__i"), "subroots")
    crown = forest(tops.select(F.lit("").alias("g"), "i", "digest"))
    apex = crown.tops.select("digest", "height").head()
    root = apex["digest"] if apex else None
    above = crown.tops.select("g", "digest", "height", F.array().cast(_PATH).alias("path"))
    groups = tops.select(F.lit("").alias("g"), "i", F.col("g").alias("name"), F.col("digest").alias("subroot"), F.col("height").alias("levels"))
    starts = stored(descend(crown, above, groups).select(
        F.col("name").alias("g"), F.col("subroot").alias("digest"), F.col("levels").alias("height"), "path", "subroot"
    ), "starts")
    wanted = None
    if asked is not None:
        rows = rows.where(asked)
        wanted = rows.select("g", "i")
    kind = docs.schema[key].dataType.simpleString()
    text = "string"
    out = descend(trees, starts, rows, wanted).select("key", "leaf", "offered", "subroot", "path").mapInArrow(
        _prove(root), f"key {kind}, leaf {text}, subroot {text}, root {text}, proof_sha256 {text}, folded_root {text}, verified boolean"
    )
    return out.withColumnRenamed("key", key)


def without_newlines(key: str, text: str) -> Column:
    """``text`` without its newlines where 2 divides the CRC-32 of the key as text."""
    return F.when(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(2)) == 0, F.replace(F.col(text), F.lit("\n"), F.lit(""))).otherwise(F.col(text))
