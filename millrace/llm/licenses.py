"""License scans: MinHash bands over overlapping text windows, then exact containment.

Main path in DataFrame functions only.  Templates are grouped by length.  For a group of
templates of at most n words, windows of n words and a stride overlap by n words, so every
notice lies whole in one window.  The number of bands (one row each) follows from the
least Jaccard similarity that a window with a matching notice can have, so that a notice
is retrieved with probability ``1 - miss``.  A retrieved template is accepted if the window
holds at least ``containment`` of its shingles.

Texts first pass a test that loses nothing: a text that holds 80 % of a template's
shingles holds a shingle with one of the template's anchor words, as more than 20 % of the
shingles have one.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import stored

# Customary notices of public licenses.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0-warranty", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
     "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("MIT", "Released under the MIT License."),
    ("MIT-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("all-rights-reserved", "All rights reserved."),
)

WORD = r"[\p{L}\p{N}]+(?:[.\-][\p{L}\p{N}]+)*"
_WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")


@dataclass(frozen=True)
class LicenseRules:
    words: int = 5
    containment: float = 0.8
    #: Chance that the bands miss a window that holds a notice.
    miss: float = 1e-6
    templates: tuple[tuple[str, str], ...] = field(default=TEMPLATES)


@dataclass(frozen=True)
class Group:
    """Templates of like length: shingle size, shingles of a window, stride, bands, anchors."""

    names: tuple[str, ...]
    texts: tuple[tuple[str, ...], ...]
    size: int
    window: int
    stride: int
    bands: int
    anchors: tuple[str, ...]


def template_words(text: str) -> tuple[str, ...]:
    return tuple(_WORD.findall(text.lower()))


def _shingles(words: tuple[str, ...], size: int) -> set[tuple[str, ...]]:
    return {words[i : i + size] for i in range(len(words) - size + 1)}


def _anchor(words: tuple[str, ...], size: int, containment: float) -> list[str]:
    """Words such that fewer than ``containment`` of the shingles have none of them."""
    found, left = [], _shingles(words, size)
    allowed = containment * len(left)
    while len(left) >= allowed and left:
        best = max(sorted(set(words)), key=lambda w: (sum(w in s for s in left) * (1 + len(w)), w))
        found.append(best)
        left = {s for s in left if best not in s}
    return found


def groups_of_templates(rules: LicenseRules) -> list[Group]:
    """Groups in which the longest template is at most half as long again as the shortest."""
    rows = sorted(((len(w), name, w) for name, text in rules.templates if (w := template_words(text))), key=lambda r: (r[0], r[1]))
    out: list[Group] = []
    while rows:
        least = rows[0][0]
        size = min(rules.words, least)
        part = [r for r in rows if r[0] <= max(least, least * 3 // 2) and min(rules.words, r[0]) == size]
        rows = [r for r in rows if r not in part]
        longest = part[-1][0]
        stride = max(2, longest // 3)
        window = longest - size + stride  # shingles of a window
        fewest = min(len(_shingles(w, size)) for _, _, w in part)
        need = math.ceil(rules.containment * fewest)
        similarity = need / (window + fewest - need)
        bands = math.ceil(math.log(rules.miss) / math.log(1 - similarity)) if similarity < 1 else 1
        anchors = sorted({a for _, _, w in part for a in _anchor(w, size, rules.containment)})
        out.append(Group(tuple(n for _, n, _ in part), tuple(w for _, _, w in part), size, window, stride, bands, tuple(anchors)))
    return out


def _has_anchor(low: Column, anchors: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(low, F.lit(a)) for a in anchors])


def _band_keys(shingles: Column, bands: int) -> Column:
    """One key per band: its number and the least hash of the shingles under its function."""

    def least(k: int) -> Column:
        return F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, F.lit(k))))

    return F.array(*[F.xxhash64(F.lit(k), least(k)) for k in range(bands)])


def _shingle_hashes(words: Column, size: int) -> Column:
    whole = F.transform(F.sequence(F.lit(1), F.size(words) - size + 1), lambda i: F.xxhash64(F.slice(words, i, size)))
    return F.when(F.size(words) >= size, whole).otherwise(F.array().cast("array<bigint>"))


def _template_table(spark: SparkSession, group: Group) -> DataFrame:
    """(license, shingles, bands) of a group: a fixed list of a few rows."""
    rows = [F.struct(F.lit(n).alias("license"), F.array(*[F.lit(w) for w in words]).alias("words")) for n, words in zip(group.names, group.texts, strict=True)]
    hashes = F.array_distinct(_shingle_hashes(F.col("words"), group.size))
    table = spark.range(1).select(F.inline(F.array(*rows))).select("license", hashes.alias("template"))
    return table.select("license", "template", _band_keys(F.col("template"), group.bands).alias("keys"))


def license_notices(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: LicenseRules = LicenseRules()) -> DataFrame:
    """One row per text and template found: key, license, shingles, matched, containment.

    ``matched`` is the best window's count of the template's distinct shingles.  Words are
    runs of letters and digits, joined by single dots or hyphens, in lower case; a template
    of fewer words than a shingle is one shingle.  Null and empty texts hold nothing; a null
    key is a row like any other; equal rows give one result; an empty table gives an empty
    table; other columns are not read.
    """
    spark = docs.sparkSession
    groups = groups_of_templates(rules)
    low = F.lower(F.col("__text"))
    flags = [_has_anchor(low, g.anchors).alias(f"g{i}") for i, g in enumerate(groups)]
    flagged = docs.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text")).select("*", *flags)
    some = reduce(lambda a, b: a | b, [F.col(f"g{i}") for i in range(len(groups))])
    words = F.regexp_extract_all(low, F.lit(WORD), F.lit(0))
    few = stored(flagged.where(some).select("__key", words.alias("words"), *[f"g{i}" for i in range(len(groups))]), "notices")
    found = None
    for i, g in enumerate(groups):
        hashed = few.where(F.col(f"g{i}")).select("__key", _shingle_hashes(F.col("words"), g.size).alias("h")).where(F.size("h") > 0)
        windows = hashed.select("__key", "h", F.explode(F.sequence(F.lit(1), F.size("h"), F.lit(g.stride))).alias("at")).select(
            "__key", F.slice("h", F.col("at"), g.window).alias("window")
        )
        keyed = windows.select("__key", "window", F.explode(_band_keys(F.col("window"), g.bands)).alias("band"))
        table = _template_table(spark, g)
        bands = F.broadcast(table.select("license", "template", F.explode("keys").alias("band")))  # templates x bands rows
        hits = keyed.join(bands, "band").select(
            "__key", "license", F.size("template").cast("bigint").alias("shingles"),
            F.size(F.array_intersect("template", "window")).cast("bigint").alias("matched"),
        ).where(F.col("matched") >= rules.containment * F.col("shingles"))
        best = hits.groupBy("__key", "license", "shingles").agg(F.max("matched").alias("matched"))
        found = best if found is None else found.unionByName(best)
    return found.select(
        F.col("__key").alias(key), "license", "shingles", "matched", F.round(F.col("matched") / F.col("shingles"), 6).alias("containment")
    )


def notices_sql(rules: LicenseRules = LicenseRules()) -> str:
    """The same result by joining every shingle (no bands, no anchors), for DuckDB."""
    values, plans = [], []
    for i, g in enumerate(groups_of_templates(rules)):
        plans.append(f"({i}, {g.size}, {g.window}, {g.stride})")
        for name, words in zip(g.names, g.texts, strict=True):
            part = sorted({" ".join(s) for s in _shingles(words, g.size)})
            values += [f"({i}, '{name}', '{s}', {len(part)})" for s in part]
    return f"""
with template(grp, license, shingle, shingles) as (values {", ".join(values)}),
plan(grp, size, wide, stride) as (values {", ".join(plans)}),
w as (select doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+(?:[.\\-][\\p{{L}}\\p{{N}}]+)*') as words from documents),
s as (
  select doc_id, grp, wide, stride, x.pos as pos, x.shingle as shingle from (
    select doc_id, grp, wide, stride, unnest([
      {{'pos': i, 'shingle': array_to_string(words[i + 1:i + size], ' ')}} for i in range(0, len(words) - size + 1)
    ]) as x from w, plan where len(words) >= size
  )
),
hit as (select doc_id, license, shingles, shingle, pos, wide, stride from s join template using (grp, shingle)),
inside as (
  select doc_id, license, shingles, shingle,
    unnest(generate_series(greatest(0, cast(ceil((pos - wide + 1) / cast(stride as double)) as bigint)), pos // stride)) as win
  from hit
),
n as (select doc_id, license, shingles, win, count(distinct shingle) as matched from inside group by all)
select doc_id, license, cast(shingles as bigint) as shingles, max(matched) as matched, round(max(matched) / shingles, 6) as containment
from n where matched >= {rules.containment} * shingles group by doc_id, license, shingles
"""
