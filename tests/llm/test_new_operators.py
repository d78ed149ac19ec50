"""SimHash duplicates, collocations and the Merkle manifest against brute force."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import pytest
import xxhash

from millrace.llm import collocations, merkle, quality, simhash, toxicity, url_tree
from millrace.llm.near_dup import near_duplicates
from tests.llm.test_llm import SCHEMA, made_texts, words_of

NAMES = ["doc_id", "text", "lang", "source", "n_chars", "score", "shard"]


@pytest.fixture(scope="module")
def rows():
    texts = made_texts(80, seed=9)
    rng = random.Random(1)
    for t in texts[:30]:
        w = t.split(" ")
        w[rng.randrange(len(w))] = "Changed"
        texts.append(" ".join(w))
    texts += texts[:4] + [None, "", " \n ", "One", "two Words", "y" * 30_000, " ".join(["again"] * 5_000), "a\tb\x0bc, d  e.f"]
    out = [(i, t, rng.choice(["en", "de", None]), rng.choice(["s", "t", None, "", "é"]), len(t or ""), 0.5, "mine") for i, t in enumerate(texts)]
    out += [out[3], (7, "another text of the same key\nwith lines", "en", "s", None, None, None), (None, texts[0], None, None, None, None, None)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- 11: SimHash ------------------------------------------------------------------------


def plain_fingerprint(text):
    words = words_of("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    n = min(3, len(words))
    hs = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def smallest_reachable(nodes, edges):
    """Least label per node of an undirected graph; nodes: {node: label}."""
    near = collections.defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for start in nodes:
        if start in out:
            continue
        seen, todo = {start}, [start]
        while todo:
            for other in near[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        low = min(nodes[s] for s in seen)
        out.update(dict.fromkeys(seen, low))
    return out


def plain_components(pairs, radius=3):
    """pairs: (key, fp); the smallest key reachable per key."""
    edges = []
    by_key = collections.defaultdict(set)
    for key, fp in pairs:
        by_key[key].add(fp)
    low = {}
    for key, fp in pairs:
        low[fp] = min(key, low.get(fp, key))
    fps = sorted(low)
    edges = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= radius]
    for found in by_key.values():
        edges += [(min(found), f) for f in found]
    of_fp = smallest_reachable(low, edges)
    return {(key, fp): of_fp[fp] for key, fp in pairs}


def test_simhash_equals_brute_force(spark, docs, rows):
    out = simhash.simhash_duplicates(docs).collect()
    expected = plain_components([(k, plain_fingerprint(t)) for k, t, *_ in rows if k is not None])
    wanted = sorted([(k, f"{fp:016x}", c) for (k, fp), c in expected.items()] + [(3, f"{plain_fingerprint(rows[3][1]):016x}", expected[3, plain_fingerprint(rows[3][1])])])
    assert sorted(tuple(r) for r in out if r["doc_id"] is not None) == wanted
    assert [r["component_id"] for r in out if r["doc_id"] is None] == [None]
    assert any(c != k for (k, _), c in expected.items())


def test_simhash_of_nothing(spark, empty):
    assert simhash.simhash_duplicates(empty).count() == 0


@pytest.mark.parametrize("n", [2, 3, 40, 64, 65, 700])
def test_bit_planes_find_every_pair(n):
    rng = random.Random(n)
    centres = [rng.getrandbits(64) for _ in range(max(1, n // 20))]
    values = []
    for _ in range(n):
        v = rng.choice(centres)
        for _ in range(rng.randrange(6)):
            v ^= 1 << rng.randrange(64)
        values.append(v)
    values = np.array(values, np.uint64)
    for radius in (1, 2, 3, 5):
        expected = {(i, j) for i in range(n) for j in range(i + 1, n) if int(values[i] ^ values[j]).bit_count() <= radius}
        found = [(int(a), int(b)) for x, y in simhash.pairs_within(values, radius) for a, b in zip(x, y)]
        assert sorted(found) == sorted(expected)
        small = [(int(a), int(b)) for x, y in simhash.pairs_of_small(values, np.full(n, n), radius) for a, b in zip(x, y)]
        assert sorted(small) == sorted(expected)


def test_crowded_keys_are_dealt(spark, monkeypatch):
    """Many fingerprints around a few centres and one hot fingerprint: dealt into slices, no link lost."""
    monkeypatch.setattr(simhash, "GROUP", 64)
    monkeypatch.setattr(simhash, "SMALL", 5)
    rng = random.Random(4)
    centres = [rng.getrandbits(64) for _ in range(4)]
    fps = set()
    while len(fps) < 900:
        v = rng.choice(centres)
        for _ in range(rng.randrange(9)):
            v ^= 1 << rng.randrange(64)
        fps.add(v)
    fps = sorted(fps)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    found = simhash.links(spark.createDataFrame(signed, "fp bigint"), 3).collect()
    number = {s[0]: i for i, s in enumerate(signed)}
    got = smallest_reachable({i: i for i in range(len(fps))}, [(number[r["a"]], number[r["b"]]) for r in found])
    edges = [(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if (fps[i] ^ fps[j]).bit_count() <= 3]
    assert got == smallest_reachable({i: i for i in range(len(fps))}, edges)
    assert len(set(got.values())) > 4


# --- 12: collocations -------------------------------------------------------------------


def plain_collocations(rows, rules):
    f, n = collections.Counter(), collections.Counter()
    for _, text, lang, *_ in rows:
        lang = lang or rules.no_lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    found = collections.defaultdict(list)
    long = {g: c for g, c in f.items() if len(g) == 4 and c >= rules.least}
    for g, a in f.items():
        if len(g) < 3 or a < rules.least:
            continue
        lang, w = g[0], g[1:]
        if len(w) == 2 and any(100 * c >= rules.covered * a for t, c in long.items() if t[0] == lang and w in (t[1:3], t[2:4])):
            continue
        cuts = []
        for k in range(1, len(w)):
            left, right = f[(lang, *w[:k])], f[(lang, *w[k:])]
            cuts.append((1000000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found[lang].append((-score, -a, " ".join(w).encode(), left, right))
    out = []
    for lang, phrases in found.items():
        for rank, (s, a, w, left, right) in enumerate(sorted(phrases)[: rules.top], 1):
            out.append((lang, rank, w.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("least, covered, top, block", [(2, 50, 2000, 1 << 24), (3, 80, 20, 3000), (10, 50, 2000, 1 << 24)])
def test_collocations_equal_brute_force(spark, docs, rows, monkeypatch, least, covered, top, block):
    monkeypatch.setattr(collocations, "BLOCK", block)
    rules = collocations.PhraseRules(least=least, covered=covered, top=top)
    expected = plain_collocations(rows, rules)
    assert expected
    assert sorted(tuple(r) for r in collocations.collocations(docs, rules=rules).collect()) == expected


def test_collocations_of_clashing_columns_and_nothing(spark, empty):
    assert collocations.collocations(empty).count() == 0
    odd = spark.createDataFrame([("x y.", None, 1, "f")] * 12 + [(None, "en", 1, "g")], "text string, lang string, f int, words string")
    assert [tuple(r) for r in collocations.collocations(odd).collect()] == [("und", 1, "x y", 12, 12, 12, 24, 1000000)]


def test_large_counts_are_exact(spark):
    """A product past 64 bits divides exactly."""
    from pyspark.sql import functions as F

    rows = [(2, "p", "q", None, 3_000_000_007, 3_000_000_011, 3_000_000_029)]
    df = spark.createDataFrame(rows, "words int, w1 string, w2 string, w3 string, f bigint, p1 bigint, s1 bigint")
    score = df.select(collocations.cut_score("p1", "s1", 1).alias("c")).select("c.score").head()[0]
    assert score == 1000000 * 3_000_000_007**2 // (3_000_000_011 * 3_000_000_029)


# --- 13: manifest -----------------------------------------------------------------------


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row, text):
    doc_id, _, lang, source, n_chars, *_ = row
    values = [doc_id, source, lang, n_chars, text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][k : k + 3])) for k in range(0, len(out[-1]), 3)])
    return out


def plain_manifest(rows):
    groups = collections.defaultdict(list)
    for row in rows:
        text = row[1]
        if zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[0] is not None and text is not None:
            text = text.replace("\n", "")
        groups[row[3]].append((row[0] is not None, row[0] or 0, plain_leaf(row, row[1]), plain_leaf(row, text)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([r[2] for r in sorted(groups[s])]) for s in names}
    if not rows:
        return []
    crown = levels_of([trees[s][-1][0] for s in names])
    root, out = crown[-1][0], []
    for at, s in enumerate(names):
        for i, (known, key, leaf, offered) in enumerate(sorted(groups[s])):
            node, proof = offered, ""
            for levels, k in ((trees[s], i), (crown, at)):
                for level in levels[:-1]:
                    run = level[k - k % 3 : k - k % 3 + 3]
                    proof += "".join(run[: k % 3] + run[k % 3 + 1 :])
                    node = h("".join([*run[: k % 3], node, *run[k % 3 + 1 :]]))
                    k //= 3
            out.append((key if known else None, leaf, trees[s][-1][0], root, h(proof), node, node == root))
    return sorted(out, key=repr)


def run_manifest(docs, **more):
    found = merkle.manifest(docs, altered={"text": merkle.without_newlines("doc_id", "text")}, **more).collect()
    return sorted((tuple(r) for r in found), key=repr)


@pytest.mark.parametrize("sizes", [[], [1], [1, 1], [3, 4], [81, 82, 1], [80, 243, 244, 2]])
def test_manifest_of_group_sizes(spark, sizes):
    rows = [(100 * g + i, f"line {i}\nof {g}", "en", f"s{g}", i, None, None) for g, n in enumerate(sizes) for i in range(n)]
    assert run_manifest(spark.createDataFrame(rows, SCHEMA)) == plain_manifest(rows)


def test_manifest_equals_brute_force(spark, docs, rows):
    expected = plain_manifest(rows)
    assert run_manifest(docs) == expected
    assert {r[-1] for r in expected} == {True, False}


def test_few_requests_give_the_same_proofs(spark, docs, rows):
    from pyspark.sql import functions as F

    expected = [r for r in plain_manifest(rows) if r[0] is not None and r[0] % 17 == 0]
    assert run_manifest(docs, asked=F.col("key") % 17 == 0) == expected


# --- 2: lines of rows with equal keys -----------------------------------------------------


def test_equal_keys_with_different_texts_lose_no_line(spark):
    from millrace.llm import line_dedup

    repeated = "this line stands in three of the texts and is long enough"
    rows = [
        (0, repeated + "\nonly in the text of key zero, nowhere else at all", "en", "s", 0, None, None),
        (1, repeated + "\nonly in the first text of key one, nowhere else", "en", "s", 0, None, None),
        (1, "first line of the other text of key one, which stands alone\n" + repeated, "en", "s", 0, None, None),
    ]
    out = sorted(r["text"] for r in line_dedup.deduplicate_lines(spark.createDataFrame(rows, SCHEMA)).collect())
    assert out == sorted([rows[0][1], rows[1][1].split("\n")[1], rows[2][1].split("\n")[0]])


def test_equal_keys_with_different_texts_lose_no_link(spark):
    one, two = ([f"{w}{k}" for k in range(40)] for w in ("alpha", "beta"))
    near = [*two[:-1], "other"]
    rows = [(1, " ".join(one)), (1, " ".join(two)), (2, " ".join(near)), (3, " ".join(one)), (4, "alone here today"), (4, None)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id int, text string").repartition(3)).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in got) == [
        (1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (4, 4, True)
    ]


def test_quality_with_labels_everywhere_is_no_constant(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality is not null")
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    got = {r["doc_id"]: r["score"] for r in quality.quality(docs, labels).collect()}
    by_label = [np.mean([got[r["doc_id"]] for r in labels.collect() if r["quality"] == y]) for y in (0, 1)]
    assert len(set(got.values())) > 50 and by_label[1] > by_label[0] + 0.3


def test_edges_and_prior_are_those_of_all_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(i % 2 * 3, 1, len(quality.FACTS)).tolist()) for i in range(800)]
    facts = spark.createDataFrame(rows, "doc_id int, facts array<double>").repartition(5)
    whole = np.array([f for _, f in rows])
    for column, edge in zip(whole.T, quality.bin_edges(facts), strict=True):
        assert np.allclose(edge, np.unique(np.quantile(column, quality.PROBS)))
    fit = quality._Fit(quality.bin_edges(facts), whole[1:400:2], whole[:400], 1e-3, 100)
    model, positive = fit.model(fit.apart(), 0.5), whole[401::2]
    found = quality.prior_of_corpus(facts, model, positive)
    assert found == quality.estimate_prior(model.logits(positive), model.logits(whole)) and abs(found - 0.5) < 0.1


def test_bags_train_as_whole_texts():
    texts = [(" ".join(made_texts(1, s)) + " vile Vile vile rot rot" * (s % 2) * 40).encode() for s in range(60)]
    labels = np.array([s % 2 for s in range(60)])
    bags = [toxicity.bag_of(t, toxicity.TELLING) for t in texts]
    one = toxicity.fit_subwords(texts, labels, 0.3)
    two = toxicity.fit_subwords([b for b, _ in bags], labels, 0.3, weights_of=[w for _, w in bags])
    assert np.allclose(one.table, two.table, atol=1e-6) and abs(one.bias - two.bias) < 1e-6
    assert all(abs(sum(w) - len(re.findall(rb"[A-Za-z0-9\x80-\xff]+", t))) < 1e-6 for t, (_, w) in zip(texts, bags, strict=True))
    assert len(bags[1][0]) < len(texts[1])


def test_training_holds_few_copies_of_the_vectors():
    """Vectors and their two moments take 25 MB; copies beside them brought the peak to 70 MB."""
    texts = [f"word{i} other{i % 7} third{i % 5}".encode() for i in range(200)]
    tracemalloc.start()
    try:
        toxicity.fit_subwords(texts, np.arange(200) % 2, 0.3, rounds=2, steps=2)
        assert tracemalloc.get_traced_memory()[1] < 60e6
    finally:
        tracemalloc.stop()


def test_templates_reach_hosts_without_rules(spark):
    blocked = tuple(("block", f"site{k}.org", "/promo/") for k in range(15))
    rules = url_tree.UrlRules(rules=(*blocked, ("block", "big.com", "/win/"), ("block", "x.net", "/es/"), ("allow", "site1.org", "/")))
    urls = [f"http://site{k}.org/promo/{n}" for k in range(15) for n in range(3)] + [f"http://site{k}.org/" for k in range(15)]
    urls += [f"http://w{n}.big.com/win/{n}" for n in range(60)] + [f"http://x.net/es/{n}" for n in range(30)]
    verdicts = {
        "http://fresh.info/promo/77": "block",  # the template is blocked on 15 domains
        "http://fresh.info/news/77": "allow", "http://fresh.info/": "allow",
        "http://other.info/win/5": "allow",  # one domain, however large, does not speak for others
        "http://x.net/": "allow", "http://x.net": "allow",  # not judged by the pages below
        "http://x.net/es": "block", "http://x.net/de/1": "allow",
        "http://site1.org/": "allow", "http://site2.org/": "allow",
    }
    rows = list(enumerate([*urls, *verdicts]))
    got = {r["page_id"]: r for r in url_tree.judge_urls(spark.createDataFrame(rows, "page_id int, url string"), rules=rules).collect()}
    assert len(got) == len(rows)
    assert {u: got[len(urls) + i]["verdict"] for i, u in enumerate(verdicts)} == verdicts
    assert all(got[i]["verdict"] == "block" for i, u in enumerate(urls) if "/promo/" in u or "/es/" in u)


def brute_purity(own, host, template, smooth):
    """The purity by its definition; own: {(host, template): (blocked, labelled)}."""
    domain = ".".join(host.split(".")[-2:])
    shares = {}
    for (h, t), (b, n) in own.items():
        if t == template and n:
            shares.setdefault(".".join(h.split(".")[-2:]), {})[h] = b * 1000 // n
    others = [sum(v.values()) // len(v) for d, v in shares.items() if d != domain]
    near = [v for h, v in shares.get(domain, {}).items() if h != host]

    def inside(node):
        found = [c for (h, t), c in own.items() if h == host and (t == node or t.startswith(node + "/"))]
        return sum(b for b, _ in found), sum(n for _, n in found)

    parts = [(sum(others) / 1000, len(others)), (sum(near) / 1000, len(near))]
    mine, parent = own[host, template], template.rpartition("/")[0]
    if parent:
        parts.append(tuple(x - y for x, y in zip(inside(parent), inside(template), strict=True)))
    if template:
        parts.append(tuple(x - y for x, y in zip(inside(template), mine, strict=True)))
    p = 0.5
    for blocked, count in [*parts, mine]:
        p = (blocked + smooth * p) / (count + smooth)
    return p


def test_purity_equals_brute_force(spark):
    rng = random.Random(5)
    own = {}
    for h in [f"{a}.d{k}.org" for a in "abc" for k in range(6)] + ["d1.org", "", "lone"]:
        for t in ("", "/a", "/a/<n>", "/a/<n>/*", "/b", "/b/c", "/b/<n>"):
            if rng.random() < 0.8:
                n = rng.choice([0, 0, 1, 4, 20])
                own[h, t] = (rng.choice([0, n // 2, n, n]), n)
    rows = [(h, t, b, n) for (h, t), (b, n) in own.items()]
    named = spark.createDataFrame(rows, "host string, template string, blocked bigint, labelled bigint").repartition(3)
    got = {(r["host"], r["template"]): r["purity"] for r in url_tree.rejected_templates(named, url_tree.UrlRules(purity=0.0)).collect()}
    assert set(got) == set(own)
    assert all(abs(got[k] - brute_purity(own, *k, 4.0)) < 1e-12 for k in own)
    high = url_tree.rejected_templates(named, url_tree.UrlRules()).count()
    assert high == sum(brute_purity(own, *k, 4.0) >= 0.8 for k in own) > 0
