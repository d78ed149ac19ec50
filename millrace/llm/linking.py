"""Connected components, and links between the members of shared keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import discard, stored


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b); a component is its smallest id.

    Alternating large and small stars: the number of rounds grows with the logarithm of
    the longest path.  Minima are combined before the shuffle, so a hub is no hot key.
    """
    edges = stored(
        links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).head()
        if state == seen or not state[0]:
            break
        seen = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
        )).alias("e")).select("e.u", "e.v").where("u != v").distinct()
        spent, edges = edges, stored(small, "edges")
        discard(spent)
    leaves = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return leaves.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def label_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``members`` with ``label``: the component of ``id``, or itself."""
    return members.join(labels, "id", "left").withColumn("label", F.coalesce("component", "id")).drop("component")


#: Test of two members by what they carry: (a, b) are columns of structs.
Alike = Callable[[Column, Column], Column]


def _any(a: Column, b: Column) -> Column:
    return F.lit(True)


def star_pairs(members: DataFrame, alike: Alike = _any) -> DataFrame:
    """Of each key (key, id, indexed, ...): its first indexed member with every other one."""
    whole = F.struct(*[c for c in members.columns if c != "key"])
    rows = members.select("key", whole.alias("m"))
    ordered = F.struct("id", *[c for c in members.columns if c not in ("key", "id", "indexed")])
    lead = members.where("indexed").groupBy("key").agg(F.min(ordered).alias("lead"))
    return (
        rows.join(lead, (rows["key"] == lead["key"]) & (F.col("m.id") != F.col("lead.id")) & alike(F.col("m"), F.col("lead")))
        .select(F.least("m.id", "lead.id").alias("a"), F.greatest("m.id", "lead.id").alias("b")).distinct()
    )


def major_pairs(members: DataFrame, alike: Alike = _any) -> DataFrame:
    """Of each key whose members have several labels: one member of its most frequent label with
    the members outside that label; at most one pair per member, whatever the label's size."""
    whole = F.struct(*[c for c in members.columns if c != "key"])
    rows = members.select("key", whole.alias("m"))
    ordered = F.struct("id", *[c for c in members.columns if c not in ("key", "id")])
    per_label = members.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"), F.min(ordered).alias("first"))
    leads = per_label.groupBy("key").agg(F.count(F.lit(1)).alias("labels"), F.max(F.struct("n", -F.col("label"), "first")).alias("top"))
    lead = leads.where("labels > 1").select("key", F.col("top.first").alias("lead"))
    return (
        rows.join(lead, (rows["key"] == lead["key"]) & (F.col("m.label") != F.col("lead.label")) & alike(F.col("m"), F.col("lead")))
        .select(F.least("m.id", "lead.id").alias("a"), F.greatest("m.id", "lead.id").alias("b")).distinct()
    )


def mixed(members: DataFrame) -> DataFrame:
    """Rows of keys whose members have several labels, with ``minors`` (rows of the key outside
    its most frequent label) and ``minor`` (this is such a row)."""
    per_label = members.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    keys = per_label.groupBy("key").agg(
        F.sum("n").alias("rows"), F.max(F.struct("n", "label")).alias("top"), F.count(F.lit(1)).alias("labels")
    ).where("labels > 1")
    majors = keys.select("key", F.col("top.label").alias("major"), (F.col("rows") - F.col("top.n")).alias("minors"))
    return members.join(majors, "key").select(*members.columns, "minors", (F.col("label") != F.col("major")).alias("minor"))


def pairs_across(rows: DataFrame, alike: Alike = _any) -> DataFrame:
    """Pairs of a key with different labels, one of them indexed (input of `mixed`).

    Members of the most frequent label are in one component already, so every pair that
    can join two components has a member outside it; pairs within it are never formed.
    """
    whole = F.struct(*[c for c in rows.columns if c != "key"])
    one, two = rows.where("minor").select("key", whole.alias("x")), rows.select("key", whole.alias("y"))
    new = F.expr("x.label != y.label and (x.indexed or y.indexed) and (not y.minor or x.id < y.id)")
    return (
        one.join(two, (one["key"] == two["key"]) & new & alike(F.col("x"), F.col("y")))
        .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    )


def linked(members: DataFrame, confirm: Callable[[DataFrame], DataFrame], alike: Alike = _any) -> DataFrame:
    """Components of the confirmed links among members of shared keys.

    First each key's members against one of them; then, of keys that still hold several
    components, the rest.  No link between two components is left out, unless ``alike`` rules
    it out by what the members carry.
    """
    first = stored(confirm(star_pairs(members, alike)), "links")
    rows = mixed(label_members(members, components(first)))
    second = stored(confirm(pairs_across(rows, alike)), "links")
    return components(first.unionByName(second))
