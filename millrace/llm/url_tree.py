"""URL filters by a path-template tree.

Per host, the paths form a tree of segments.  From the root down, segments that vary become
wildcards: runs of digits and long hexadecimal ids by their form, others when a node has
many children and none holds a large share.  Sibling branches whose share of blocked
labels does not differ from the pooled share of their node are merged.  A template, i.e. a
node of the tree so made, is rejected if its smoothed purity is high.  The purity starts
from an even prior and takes in, from far to near, the same template on other registered
domains and on other hosts of its domain, its branch, what lies below it, and its own
pages.  A root is not judged by the pages below it.  Labels are the verdicts of
hand-written rules; a template without any of these is kept.

The tree is built over counts per distinct path, level by level, never over one host at once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored
from millrace.operators.skew import lookup

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRules:
    #: (verdict, host, path): holds for the host and its subdomains where the path begins so.
    rules: tuple[tuple[str, str, str], ...] = (
        ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
        ("block", "net", "/es/"), ("block", "net", "/fr/"),
    )
    #: Segments beyond this depth become one wildcard.
    depth: int = 8
    #: A node with so many children varies if its largest holds less than this share.
    children: int = 10
    share: float = 0.2
    #: Labels that a branch needs to be compared, and standard errors that count as alike.
    support: int = 5
    alike: float = 1.96
    #: Pseudo-count of an even prior, and the purity from which a template is rejected.
    smooth: float = 4.0
    purity: float = 0.8


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(raw, _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: UrlRules) -> Column:
    """Struct (length, rule, verdict) of the longest rule that fits, or null."""
    fits = [
        F.when(
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for v, h, p in rules.rules
    ]
    return F.array_max(F.array_compact(F.array(*fits)))


def shaped_segments(path: Column) -> Column:
    """Non-empty segments; hexadecimal ids of 16 or more characters and runs of digits as wildcards."""
    parts = F.filter(F.split(path, "/", -1), lambda s: s != "")
    return F.transform(parts, lambda s: F.when(s.rlike("^[0-9a-fA-F]{16,}$"), F.lit("<hex>")).otherwise(F.regexp_replace(s, "[0-9]+", "<n>")))


def path_templates(paths: DataFrame, rules: UrlRules) -> DataFrame:
    """(host, segments, template) of distinct paths (host, segments, rows, blocked, labelled)."""
    state = paths.withColumn("template", F.lit(""))
    done = None
    for level in range(rules.depth):
        state = stored(state, "paths")
        ended = state.where(F.size("segments") == level)
        done = ended if done is None else done.unionByName(ended)
        state = state.where(F.size("segments") > level)
        if state.isEmpty():
            break
        named = state.withColumn("segment", F.col("segments")[level])
        child = named.groupBy("host", "template", "segment").agg(
            F.sum("rows").alias("rows"), F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled")
        )
        known = F.col("labelled") >= rules.support
        node = child.groupBy("host", "template").agg(
            F.count(F.lit(1)).alias("children"), F.sum("rows").alias("all_rows"), F.max("rows").alias("top"),
            F.sum(F.when(known, F.col("blocked"))).alias("all_blocked"), F.sum(F.when(known, F.col("labelled"))).alias("all_labelled"),
        )
        pooled = F.col("all_blocked") / F.col("all_labelled")
        error = F.sqrt(F.col("labelled") * pooled * (1 - pooled))
        alike = known & (F.abs(F.col("blocked") - F.col("labelled") * pooled) <= rules.alike * error + 1e-9)
        varies = (F.col("children") >= rules.children) & (F.col("top") < rules.share * F.col("all_rows"))
        compared = child.join(node, ["host", "template"]).select("host", "template", "segment", varies.alias("varies"), alike.alias("alike"))
        merged = compared.where("alike and not varies").groupBy("host", "template").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        token = F.when(F.col("varies"), F.lit("*")).when(F.col("alike") & F.col("n").isNotNull(), F.lit("{alike}")).otherwise(F.col("segment"))
        tokens = compared.join(merged, ["host", "template"], "left").select("host", "template", "segment", token.alias("token"))
        state = named.join(tokens, ["host", "template", "segment"]).select(
            *paths.columns, F.concat("template", F.lit("/"), "token").alias("template")
        )
    else:
        rest = state.withColumn("template", F.concat("template", F.when(F.size("segments") > rules.depth, F.lit("/**")).otherwise(F.lit(""))))
        done = done.unionByName(rest)
    return stored(done, "templates")


def rejected_templates(named: DataFrame, rules: UrlRules) -> DataFrame:
    """(host, template, purity) of templates from ``rules.purity`` on.

    Each label counts once, where it is nearest.  Elsewhere a whole host is one observation
    (the share of its labels that are blocked), and a whole domain one beyond its domain, so
    that one large site does not speak for strangers.  Shares are whole thousandths, so sums are exact.
    """
    levels = F.split("template", "/", -1)
    own = named.groupBy("host", "template").agg(F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled")).select(
        "*", F.substring_index("host", ".", -2).alias("domain"),
        F.when(F.size(levels) > 2, F.array_join(F.slice(levels, 1, F.size(levels) - 1), "/")).alias("parent"),
        F.expr("if(labelled > 0, blocked * 1000 div labelled, 0)").alias("share"), (F.col("labelled") > 0).cast("bigint").alias("known"),
    )
    own = stored(own, "url_templates")
    labelled = own.where("known = 1")
    domains = labelled.groupBy("domain", "template").agg(F.sum("share").alias("d_share"), F.sum("known").alias("d_hosts"))
    domains = stored(domains.withColumn("d_mean", F.expr("d_share div d_hosts")), "url_domains")
    everywhere = domains.groupBy("template").agg(F.sum("d_mean").alias("e_share"), F.count(F.lit(1)).alias("e_domains"))
    below = F.transform(F.sequence(F.lit(2), F.size(levels)), lambda n: F.array_join(F.slice(levels, 1, n), "/"))
    nodes = stored(
        labelled.where("template != ''").select("host", F.explode(below).alias("node"), "blocked", "labelled")
        .groupBy("host", "node").agg(F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled")),
        "url_nodes",
    )

    def at(column: str, prefix: str) -> DataFrame:
        return nodes.select(
            "host", F.col("node").alias(column), F.col("blocked").alias(f"{prefix}_blocked"), F.col("labelled").alias(f"{prefix}_labelled")
        )

    facts = own.join(at("template", "n"), ["host", "template"], "left")
    for table, on in ((at("parent", "p"), ["host", "parent"]), (domains, ["domain", "template"]), (everywhere, ["template"])):
        facts = lookup(facts, table, on)
    facts = facts.fillna(0)

    def weighed(prior: Column, blocked: str, count: str) -> Column:
        return (F.expr(blocked) + rules.smooth * prior) / (F.expr(count) + rules.smooth)

    purity = weighed(F.lit(0.5), "(e_share - d_mean) / 1000D", "e_domains - if(d_hosts > 0, 1, 0)")
    purity = weighed(purity, "(d_share - share) / 1000D", "d_hosts - known")
    purity = F.when(F.col("parent").isNull(), purity).otherwise(weighed(purity, "p_blocked - n_blocked", "p_labelled - n_labelled"))
    purity = F.when(F.col("template") == "", purity).otherwise(weighed(purity, "n_blocked - blocked", "n_labelled - labelled"))
    purity = weighed(purity, "blocked", "labelled")
    return stored(facts.select("host", "template", purity.alias("purity")).where(F.col("purity") >= rules.purity), "url_rejected")


def judge_urls(pages: DataFrame, key: str = "page_id", url: str = "url", rules: UrlRules = UrlRules()) -> DataFrame:
    """Per row: key, host, path, rule, verdict, template, purity (of a rejected template).

    A null url or one without ``://`` has an empty host and path.  Where a rule fits, its
    verdict holds; else a rejected template blocks and any other allows.  Equal rows get
    equal verdicts, a null key is a row like any other, an empty table gives an empty
    table, other columns are not read.
    """
    parsed = pages.select(F.col(key).alias("__key"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    judged = parsed.withColumn("__rule", matching_rule(F.col("host"), F.col("path"), rules)).select(
        "__key", "host", "path", F.col("__rule.rule").alias("rule"), F.col("__rule.verdict").alias("by_rule"),
        shaped_segments(F.col("path")).alias("segments"),
    )
    counts = judged.groupBy("host", "segments").agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("by_rule") == "block", 1)).alias("blocked"), F.count("by_rule").alias("labelled")
    )
    named = path_templates(counts, rules)
    rejected = rejected_templates(named, rules)
    decided = named.join(rejected, ["host", "template"], "left").select("host", "segments", "template", "purity")
    method = F.when(F.col("purity").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return judged.join(decided, ["host", "segments"], "left").select(
        F.col("__key").alias(key), "host", "path", "rule", F.coalesce("by_rule", method).alias("verdict"), "template", "purity"
    )
