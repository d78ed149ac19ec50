"""The training-data operators against brute force, on small tables with awkward rows."""

from __future__ import annotations

import collections
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest

from millrace.llm import (
    compression, decontaminate, licenses, line_dedup, linking, near_dup, packing, quality, sharding, toxicity, url_tree,
)

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars int, score double, shard string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text):
    return WORD.findall(text or "")


def made_texts(n=60, seed=3):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(150)]
    out = []
    for _ in range(n):
        lines = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(4, 25))) + "." for _ in range(rng.randint(1, 6))]
        out.append("\n".join(lines))
    return out


@pytest.fixture(scope="module")
def rows():
    """Texts, near copies, equal rows, nulls, empties, ties and one very long text."""
    texts = made_texts()
    rng = random.Random(5)
    for t in texts[:12]:  # near copies
        w = t.split(" ")
        w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    texts += texts[:5]  # equal texts
    texts += [None, "", "   \n\t ", "one", "two words", "x" * 50_000, " ".join(["again"] * 20_000)]
    out = [(i, t, "en", "s", len(t or ""), 0.5, "mine") for i, t in enumerate(texts)]
    out.append(out[3])  # a repeated row
    out.append((None, texts[0], None, None, None, None, None))
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- 1: packing -------------------------------------------------------------------------


def test_token_ids_equal_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(1)
    alphabet = ["a", "É", "don't", "x1", "99", " ", "  ", "\n", "\n\n", "\t", ".", ",", "...", "日本", "'s", "\x00", " ", "<|endoftext|>", "!"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(1500)] + made_texts(20)
    units = packing.token_units("byte_bpe_50k.json")
    for t in texts:
        assert np.frombuffer(units.ids(t), dtype="<u4").tolist() == reference.encode(t, add_special_tokens=False).ids, repr(t)
    assert np.frombuffer(units.ids("x <|endoftext|> y"), dtype="<u4").tolist() == [87, 220, 50256, 331]


def test_packing_round_trip(spark, docs, rows):
    packed = packing.pack(docs, capacity=64, with_ids=True).collect()
    units = packing.token_units("byte_bpe_50k.json")
    expected = sorted(np.frombuffer(units.ids(t or ""), dtype="<u4").tolist() + [0] for _, t, *_ in rows)
    pieces = collections.defaultdict(list)
    for i, r in enumerate(packed):
        assert r["length"] == len(r["ids"]) <= 64
        assert zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) == r["ids_crc32"]
        assert r["piece"] == 0 or r["length"] == 64  # only the first piece is short
        pieces[r["doc_id"]].append(r)
    whole = []
    for key, found in pieces.items():
        found.sort(key=lambda r: (r["piece"], r["start"]))
        copies = sum(r["piece"] == 0 for r in found)
        assert len(found) % copies == 0
        ids = [x for r in found[::copies] for x in r["ids"]]
        assert [r["start"] for r in found[::copies]] == list(np.cumsum([0] + [r["length"] for r in found[::copies]])[:-1])
        whole += [ids] * copies
    assert sorted(whole) == expected
    used = collections.defaultdict(list)
    for r in packed:
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_close_to_the_bound_and_places_all(seed):
    rng = random.Random(seed)
    counts = collections.Counter(min(100, 1 + int(rng.expovariate(1 / rng.choice([5, 20, 45])))) for _ in range(4000))
    runs = packing.plan_sequences(dict(counts), 100)
    placed = collections.Counter()
    for r in runs:
        assert sum(length * copies for length, _, copies, _ in r.parts) == 100 - r.free
        for length, _, copies, _ in r.parts:
            placed[length] += copies * r.n
    assert placed == counts
    bound = math.ceil(sum(k * v for k, v in counts.items()) / 100)
    forced = sum(v for k, v in counts.items() if k > 50)  # two of these never share a sequence
    assert sum(r.n for r in runs) <= max(bound, forced) * 1.01 + 1


def test_packing_of_nothing(spark, empty):
    assert packing.pack(empty).count() == 0


# --- 2: lines ---------------------------------------------------------------------------


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_banded_distance():
    rng = random.Random(2)
    for _ in range(5000):
        tau = rng.choice([1, 2, 3, 5])
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))
        b = list(a)
        for _ in range(rng.randint(0, tau + 2)):
            k = rng.randint(0, len(b))
            b[k : k + rng.randint(0, 1)] = rng.choice(["", "a", "b"])
        b = "".join(b)
        assert line_dedup.edit_distance(a, b, tau) == min(levenshtein(a, b), tau + 1)


def brute_line_classes(rows, tau, least):
    where = collections.defaultdict(set)
    for key, text, *_ in rows:
        if key is not None:
            for i, line in enumerate((text or "").split("\n")):
                if len(line) >= least and words_of(line):
                    where[line].add((key, i))
    parent = {line: line for line in where}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(where, 2):
        if abs(len(a) - len(b)) <= tau and levenshtein(a, b) <= tau:
            parent[root(a)] = root(b)
    classes = collections.defaultdict(set)
    for line, at in where.items():
        classes[root(line)] |= at
    return where, classes


@pytest.fixture(scope="module")
def line_rows():
    rng = random.Random(11)
    base = ["".join(rng.choice("abcd ") for _ in range(rng.randint(12, 30))) for _ in range(30)]
    out = []
    for i in range(90):
        lines = []
        for _ in range(3):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 2, 3, 4])):
                k = rng.randrange(len(line))
                line[k : k + rng.randint(0, 1)] = rng.choice(["", "x", "é"])
            lines.append("".join(line))
        out.append((i, "\n".join(lines), "en", "s", 0, 0.0, ""))
    return out + [(90, None, "", "", 0, 0.0, ""), (91, "", "", "", 0, 0.0, ""), (92, "short\nshort", "", "", 0, 0.0, ""), (None, out[0][1], "", "", 0, 0.0, ""), out[5]]


def test_line_classes_equal_brute_force(spark, line_rows):
    found = line_dedup.repeated_lines(spark.createDataFrame(line_rows, SCHEMA), tau=2, min_chars=10).distinct().collect()
    where, classes = brute_line_classes(line_rows, 2, 10)
    twice = collections.Counter()  # the repeated row counts twice
    for key, text, *_ in line_rows:
        if key is not None:
            for i, line in enumerate((text or "").split("\n")):
                twice[(key, i)] += 1
    expected = {}
    for members in classes.values():
        total = sum(twice[m] for m in members)
        if total > 1:
            first = min(members)
            expected.update({m: (first, total, m == first) for m in members})
    got = {(r["doc_id"], r["line_no"]): ((r["class_key"], r["class_line_no"]), r["class_lines"], r["kept"]) for r in found}
    assert got == expected
    assert any(not r["exact"] for r in found)


def test_lines_are_removed(spark, line_rows, empty):
    docs = spark.createDataFrame(line_rows, SCHEMA)
    gone = {
        (r["doc_id"], r["line_no"])
        for r in line_dedup.repeated_lines(docs, min_chars=10).where("not kept").collect()
    }
    expected = []
    for row in line_rows:
        key, text = row[0], row[1]
        if key is None or not any((key, i) in gone for i in range(len((text or "").split("\n")))):
            expected.append(row)
            continue
        left = "\n".join(x for i, x in enumerate(text.split("\n")) if (key, i) not in gone)
        if left.strip(" "):
            expected.append((key, left, *row[2:4], len(left), *row[5:]))
    out = line_dedup.deduplicate_lines(docs, min_chars=10)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(expected, key=repr)
    assert line_dedup.deduplicate_lines(empty).count() == 0


def test_long_lines_and_passages(spark):
    passage = " ".join(f"word{i}" for i in range(60))
    rows = [(i, f"own text number {i} " + "z" * i + "\n" + passage, "", "", 0, 0.0, "") for i in range(40)]
    rows.append((50, "y" * 40_000, "", "", 0, 0.0, ""))
    rows.append((51, "y" * 39_999 + "k", "", "", 0, 0.0, ""))
    out = {r["doc_id"]: r["text"] for r in line_dedup.deduplicate_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sum(passage in t for t in out.values()) == 1 and passage in out[0]
    assert 50 in out and 51 not in out


def test_short_lines_repeat_exactly(spark, line_rows, tmp_path):
    """Short lines go by equality in the operator, the query and the pipeline; the others stay as they were."""
    import corpus_pipeline

    from millrace.llm.queries import QUERIES

    def places(found):
        return {(r["doc_id"], r["line_no"]): (r["class_key"], r["class_line_no"], r["class_lines"], r["exact"], r["kept"]) for r in found.collect()}

    notice = "All rights reserved."
    rows = [(i, f"{notice}\nown words of text {i * 1111111} and more {i * 77777}\n}}\n \nAll rights reserved{'!' * i}", "", "", 0, 0.0, "") for i in range(1, 4)]
    docs = spark.createDataFrame(rows, SCHEMA)
    expected = {(i, k): (1, k, 3, True, i == 1) for i in (1, 2, 3) for k in (0, 2)}
    assert places(line_dedup.repeated_lines(docs, exact_chars=1)) == expected and line_dedup.repeated_lines(docs).count() == 0
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert places(QUERIES["op2_edit_lines"](spark, str(tmp_path))) == expected
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_repeated_lines(spark, docs, str(tmp_path)).collect()}
    assert left[1] == rows[0][1] and left[2] == "own words of text 2222222 and more 155554\n \nAll rights reserved!!"

    mixed = spark.createDataFrame(line_rows, SCHEMA)
    got, long_only = places(line_dedup.repeated_lines(mixed, min_chars=20, exact_chars=1)), places(line_dedup.repeated_lines(mixed, min_chars=20))
    assert long_only and long_only.items() <= got.items()
    where = collections.defaultdict(set)
    for key, text, *_ in line_rows:
        for i, line in enumerate((text or "").split("\n")):
            if key is not None and len(line) < 20 and words_of(line):
                where[line].add((key, i))
    short = {m for at in where.values() if len(at) > 1 or next(iter(at))[0] == 5 for m in at}  # row 5 is there twice
    assert short == set(got) - set(long_only) and len(short) > 2


# --- 9: near duplicates, components -------------------------------------------------------


def brute_components(rows, n, percent):
    sets = {}
    for key, text, *_ in rows:
        if key is not None:
            w = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
            sets[key] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {k: (len(sets[k]), root(k)) for k in sets}


@pytest.mark.parametrize("n, percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, docs, rows, n, percent):
    got = near_dup.near_duplicates(docs, rules=near_dup.JoinRules(words=n, percent=percent)).collect()
    assert len(got) == len(rows)
    expected = brute_components(rows, n, percent)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == expected[r["doc_id"]]
            assert r["kept"] == (r["component_id"] == r["doc_id"])


def test_large_groups_branch(spark):
    """A family of many variants, compared after branching (leaf of 2), equals brute force."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 4, 6])):
            w[rng.randrange(80)] = f"v{rng.randrange(1000)}"
        rows.append((i, " ".join(w), "", "", 0, 0.0, ""))
    rules = near_dup.JoinRules(words=3, percent=85, leaf=2)
    got = near_dup.near_duplicates(spark.createDataFrame(rows, SCHEMA), rules=rules).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(rows, 3, 85)


def test_a_dense_family_among_strangers_is_joined_by_few_links(spark, monkeypatch):
    """The first member of each root is a stranger to the family, which only the last turn finds."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(460):
        w = list(base)
        for _ in range(12 if i < 400 else 1):
            w[rng.randrange(120)] = f"v{rng.randrange(10_000)}"
        rows.append((i, " ".join(w), "", "", 0, 0.0, ""))
    seen, components = [], near_dup.components

    def counted(links):
        seen.append(links.where("a != b").distinct().count())
        return components(links)

    monkeypatch.setattr(near_dup, "components", counted)
    rules = near_dup.JoinRules(words=3, percent=85, leaf=2, rounds=1, levels=2)
    got = near_dup.near_duplicates(spark.createDataFrame(rows, SCHEMA), rules=rules).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(rows, 3, 85)
    assert max(seen) < 600, seen


def test_the_last_star_forms_no_pairs_that_the_parities_rule_out(spark, monkeypatch):
    """A large family below the threshold costs few pairs beside a component."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(340):
        w = list(base)
        for _ in range(3 if i < 300 else 1):
            w[rng.randrange(120)] = f"v{rng.randrange(10_000)}"
        rows.append((i, " ".join(w), "", "", 0, 0.0, ""))
    made = []
    for name in ("star_pairs", "major_pairs"):
        if star := getattr(near_dup, name, None):

            def counted(*args, star=star):
                out = star(*args)
                made.append(out.count())
                return out

            monkeypatch.setattr(near_dup, name, counted)
    rules = near_dup.JoinRules(words=3, percent=85, leaf=2, rounds=1, levels=1)
    got = near_dup.near_duplicates(spark.createDataFrame(rows, SCHEMA), rules=rules).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(rows, 3, 85)
    assert len(made) == 2 and made[1] < made[0], made


def test_a_tight_family_branches_once(spark, monkeypatch):
    """Members that a round leaves together are joined and compared then, not dealt out again each round."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(200):
        w = list(base)
        for _ in range(rng.choice([1, 2, 3, 4])):
            w[rng.randrange(120)] = f"v{rng.randrange(10_000)}"
        rows.append((i, " ".join(w), "", "", 0, 0.0, ""))
    dealt, branches = [], near_dup.branches

    def counted(nodes, rules):
        dealt.append(nodes.count())
        return branches(nodes, rules)

    monkeypatch.setattr(near_dup, "branches", counted)
    rules = near_dup.JoinRules(words=3, percent=85, leaf=2, levels=2)
    got = near_dup.near_duplicates(spark.createDataFrame(rows, SCHEMA), rules=rules).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(rows, 3, 85)
    assert len(dealt) == 1, dealt


@pytest.mark.parametrize("rows", [1, 3, 1024])
def test_short_batches_keep_signatures(spark, monkeypatch, rows):
    texts = [(i, "" if i % 4 == 0 else " ".join(f"w{(i * j) % 17}" for j in range(i))) for i in range(9)]
    docs = spark.createDataFrame(texts, "doc_id int, text string").coalesce(1)
    whole = near_dup.signatures(docs, "doc_id", "text", near_dup.JoinRules()).collect()
    cut = near_dup._slices
    monkeypatch.setattr(near_dup, "_slices", lambda batches: cut(batches, rows))
    assert near_dup.signatures(docs, "doc_id", "text", near_dup.JoinRules()).collect() == whole


@pytest.mark.parametrize("n, percent", [(3, 85), (5, 80)])
def test_miss_at_the_threshold(n, percent):
    """Calculated for a pair at the threshold: all trees share the coordinates, and every node branches to the end."""
    rules = near_dup.JoinRules(words=n, percent=percent)
    size, more = rules.coordinates, 100 / (percent - rules.slack) - 1

    def chance(k, m, p):
        return math.comb(m, k) * p**k * (1 - p) ** (m - k)

    branched = roots = 0.0
    for agree in range(size + 1):
        dead = 0.0  # of a node that holds the pair: no common node is left below it
        for _ in range(rules.levels * rules.rounds):
            child = 1 - agree / size * (1 - dead)
            dead = (1 - more) * child + more * child**2
        of_roots = [math.comb(agree, j) * math.comb(size - agree, rules.trees - j) / math.comb(size, rules.trees) for j in range(rules.trees + 1)]
        branched += chance(agree, size, percent / 100) * sum(x * dead**j for j, x in enumerate(of_roots))
        roots += chance(agree, size, percent / 100) * of_roots[0]
    sketch = sum(chance(k, size, (1 + percent / 100) / 2) for k in range(rules.least_bits()))
    assert branched + sketch < 1e-3 and roots + sketch < 1e-9


def test_near_duplicates_of_nothing(spark, empty):
    assert near_dup.near_duplicates(empty).count() == 0


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(0, 30)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 200), (300, 300)]
    got = {r["id"]: r["component"] for r in linking.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}


# --- 3: licenses ------------------------------------------------------------------------


def test_licenses_equal_brute_force(spark, empty):
    rng = random.Random(4)
    texts = [None, "", "Reserved rights all.", "All rights reserved", "a license of sorts " * 5000]
    for _, notice in licenses.TEMPLATES:
        w = notice.split()
        for drop in (0, 1, 3):
            part = [x for i, x in enumerate(w) if not (drop and i in rng.sample(range(len(w)), min(drop, len(w))))]
            texts.append(f"{'some words ' * rng.randint(0, 9)}{' '.join(part)} {'and more ' * rng.randint(0, 9)}".upper())
    docs = spark.createDataFrame([(i, t, "", "", 0, 0.0, "") for i, t in enumerate(texts)], SCHEMA)
    got = {(r["doc_id"], r["license"]): r["matched"] for r in licenses.license_notices(docs).collect()}
    rules = licenses.LicenseRules()
    expected = {}
    for i, t in enumerate(texts):
        w = licenses.template_words(t or "")
        for g in licenses.groups_of_templates(rules):
            shingles = [w[k : k + g.size] for k in range(len(w) - g.size + 1)]
            for name, words in zip(g.names, g.texts, strict=True):
                target = licenses._shingles(words, g.size)
                best = max((len(target & set(shingles[k : k + g.window])) for k in range(0, len(shingles), g.stride)), default=0)
                if best >= rules.containment * len(target):
                    expected[(i, name)] = best
    assert got == expected and len({n for _, n in got}) == len(licenses.TEMPLATES)
    assert licenses.license_notices(empty).count() == 0


def test_anchors_lose_nothing():
    for g in licenses.groups_of_templates(licenses.LicenseRules()):
        for words in g.texts:
            shingles = licenses._shingles(words, g.size)
            without = [s for s in shingles if not any(a in w for a in g.anchors for w in s)]
            assert len(without) < 0.8 * len(shingles)


# --- 4: decontamination -----------------------------------------------------------------


def test_leaks(spark, empty):
    item = "A farmer called Anna Berg has 12 apples and 30 pears and gives 12 apples to her brother Carl before he walks 5 km home."
    other = "A farmer called Lena Holt has 70 apples and 44 pears and gives 70 apples to her brother Omar before he walks 9 miles home."
    clash = "A farmer called Lena Holt has 70 apples and 44 pears and gives 71 apples to her brother Omar before he walks 9 miles home."
    filler = " ".join(made_texts(1, 8))
    rows = [
        (1, f"{filler} {item} {filler}"), (2, f"{filler}\n{other}\n{filler}"), (3, f"{filler} {clash} {filler}"), (4, filler), (5, None), (6, ""),
        (7, " ".join(item.split()[:9])), (8, item.upper().lower()), (9, "x " * 60_000), (None, item), (1, f"{filler} {item} {filler}"),
        (10, f"and then the one short thing was said here {filler}"),
    ]
    docs = spark.createDataFrame([(k, t, "", "", 0, 0.0, "") for k, t in rows], SCHEMA)
    bench = spark.createDataFrame([(1, item), (2, None), (3, "too short"), (4, "One short thing was said"), (None, item)], "item_id int, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.leaks(docs, bench).collect()}
    assert set(got) == {(1, 1), (2, 1), (10, 4)}
    assert got[(1, 1)]["verbatim"] and got[(1, 1)]["coverage"] == 1.0
    assert not got[(2, 1)]["verbatim"] and got[(2, 1)]["changed"] >= 6
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["3", "4", "5", "6", "7", "8", "9", "None"])
    assert decontaminate.leaks(empty, bench).count() == 0 and decontaminate.leaks(docs, bench.limit(0)).count() == 0


def test_leaks_of_repeating_items(spark):
    """An item that repeats its template is found verbatim, with new values and with a word put in."""
    item = "Tom has 3 red apples, Ann has 4 red apples, Bob has 5 red apples, Eve has 6 red apples in total now"
    new = "Max has 8 red apples, Ida has 9 red apples, Tim has 2 red apples, Zoe has 7 red apples in total now"
    put = item.replace("Eve has 6", "then Eve has 6")
    clash = "Max has 8 red apples, Max has 9 red apples, Max has 2 red apples, Max has 8 red apples in total now"
    filler = " ".join(made_texts(1, 8))
    texts = [f"{filler} {item} {filler}", f"{filler} so {new} {filler}", f"{filler} {put} {filler}", f"{filler} so {clash} {filler}", item]
    docs = spark.createDataFrame([(i, t, "", "", 0, 0.0, "") for i, t in enumerate(texts)], SCHEMA)
    got = {r["doc_id"]: r for r in decontaminate.leaks(docs, spark.createDataFrame([(1, item)], "item_id int, text string")).collect()}
    assert set(got) == {0, 1, 2, 4}
    assert got[0]["verbatim"] and got[0]["coverage"] == 1.0 and got[2]["verbatim"] and got[4]["verbatim"]
    assert not got[1]["verbatim"] and got[1]["changed"] >= 6


def test_verbatim_leaks_without_templates(spark, tmp_path):
    """Other capitals, windows poor in literals, and items of few tokens, in the operator, the query and the pipeline."""
    import corpus_pipeline

    from millrace.llm.queries import QUERIES

    item = "A farmer called Anna Berg has 12 apples and gives Carl Holm 5 of the apples before Anna walks home to Lena Berg."
    numbers = "Compute 12 + 5 7 9 11 13 15 17 19 for Anna Berg Carl Holm Lena Dahl Omar Lind"
    filler = " ".join(made_texts(1, 8))
    texts = [f"{filler} {item.lower()} {filler}", f"{filler}\n{numbers}\n{filler}", f"{filler} two Words {filler}", filler, f"{filler} {item.upper()}", "two x words"]
    docs = spark.createDataFrame([(i, t, "", "", 0, 0.0, "") for i, t in enumerate(texts)], SCHEMA)
    bench = spark.createDataFrame([(1, item), (2, numbers), (3, "Two words"), (4, "...")], "item_id int, text string")
    rules = decontaminate.LeakRules(any_case=True)
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.leaks(docs, bench, rules=rules).collect()}
    assert set(got) == {(0, 1), (1, 2), (2, 3), (4, 1)}
    assert all(r["verbatim"] and r["coverage"] == 1.0 for r in got.values())
    assert got[(2, 3)]["first_token"] == len(words_of(filler))
    assert {(r[0], r[1]) for r in decontaminate.leaks(docs, bench).collect()} == {(1, 2)}
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    assert {(r[0], r[1]) for r in QUERIES["op4_template_leaks"](spark, str(tmp_path)).collect()} == set(got)
    assert {r[0] for r in corpus_pipeline.drop_leaks(spark, docs, str(tmp_path)).collect()} == {3, 5}


# --- 5 and 10: classifiers ----------------------------------------------------------------


def auc(scores, labels):
    rank = np.argsort(np.argsort(scores)) + 1.0
    labels = np.asarray(labels)
    n = labels.sum()
    return (rank[labels == 1].sum() - n * (n + 1) / 2) / (n * (len(labels) - n))


@pytest.mark.parametrize("label", ["quality", "toxic"])
def test_held_out_accuracy(spark, label):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    run = quality.quality if label == "quality" else toxicity.toxicity
    got = {r["doc_id"]: r for r in run(docs, labels).collect()}
    known = [r for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    modulus, rest = (5, 0) if label == "quality" else (3, 1)
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % modulus == rest) for k, r in got.items())
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert auc([got[r["doc_id"]]["score"] for r in known], [r[label] for r in known]) > 0.85
    agree = [got[r["doc_id"]]["predicted"] == r[label] for r in known]
    assert np.mean(agree) > 0.9


def test_unseen_misspelling_shares_vectors():
    rng = random.Random(1)
    clean = [" ".join(made_texts(1, s)).encode() for s in range(60)]
    bad = []
    for s in range(60, 120):
        w = " ".join(made_texts(1, s)).split(" ")
        for word in ("grumbold", "snarkface", "vilewort"):
            w.insert(rng.randrange(len(w)), word)
        bad.append(" ".join(w).encode())
    model = toxicity.fit_subwords(clean + bad, np.array([0] * 60 + [1] * 60), 0.5)

    def score(text):
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        starts, ends, _ = toxicity.token_spans(raw, np.array([0, len(raw)]))
        return toxicity.telling_mean(toxicity.word_scores(model.table, raw, starts, ends), model.k)

    plain = " ".join(made_texts(1, 500))
    assert score(plain + " grumbbold snarkfacce") > score(plain) + 0.5 * (score(plain + " grumbold snarkface") - score(plain)) > score(plain)


@pytest.mark.parametrize("run", [quality.quality, toxicity.toxicity])
def test_classifier_edges(spark, docs, rows, empty, run):
    labels = spark.createDataFrame(
        [(i, i % 2, (i + 1) % 2, 1.0) for i in range(40)] + [(None, 1, 1, 0.0), (3, None, None, 0.0), (4, 1, 1, 0.0)],
        "doc_id bigint, quality int, toxic int, score double",
    )
    got = run(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in got)
    same = [r["score"] for r in got if r["doc_id"] == 3]
    assert len(same) == 2 and same[0] == same[1]
    assert run(empty, labels).count() == 0
    assert run(docs, labels.limit(0)).count() == len(rows)
    one = run(docs, labels.where("doc_id < 2")).collect()
    assert len(one) == len(rows)


def test_prior_is_estimated():
    rng = np.random.default_rng(0)
    positive = rng.normal(2, 1, 4000)
    for share in (0.3, 0.6, 0.9):
        mixed = np.concatenate([rng.normal(2, 1, int(4000 * share)), rng.normal(-2, 1, 4000 - int(4000 * share))])
        assert abs(quality.estimate_prior(positive, mixed) - share) < 0.06


# --- 6: shards --------------------------------------------------------------------------


def test_shards(spark, docs, rows, empty):
    got = sharding.shard_rows(docs).collect()
    assert len(got) == len(rows)
    of = {}
    for r in got:
        text = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(text) + 16, zlib.crc32(text), "key")
        assert r["grown_shard"] in (r["shard"], 40)
        assert of.setdefault(r["doc_id"], r["shard"]) == r["shard"]
    for shard, part in itertools.groupby(sorted(got, key=lambda r: (r["shard"], r["slot"])), key=lambda r: r["shard"]):
        part = list(part)
        assert [r["slot"] for r in part] == list(range(len(part)))
    more = {r["doc_id"]: r["shard"] for r in sharding.shard_rows(docs, weights={s: 1.0 for s in range(41)}).collect()}
    assert {r["doc_id"]: r["grown_shard"] for r in got} == more
    assert sharding.shard_rows(empty).count() == 0


def test_weights_are_honoured(spark):
    keys = spark.range(40_000).selectExpr("id as doc_id", "'t' as text")
    weights = {0: 1.0, 1: 2.0, 2: 5.0}
    counts = {r["shard"]: r["count"] for r in sharding.shard_rows(keys, weights=weights).groupBy("shard").count().collect()}
    for s, w in weights.items():
        assert abs(counts[s] / 40_000 - w / 8) < 0.01


# --- 7: compression bands ---------------------------------------------------------------


def test_base_facts_equal_brute_force(spark, docs, rows, empty):
    got = collections.defaultdict(list)
    for r in compression.compression_rules(docs).collect():
        got[r["doc_id"]].append(r)
    for key, text, *_ in rows:
        text = text or ""
        w = words_of(text)
        seen, lines = set(), 0
        for line in text.split("\n"):
            lines += bool(words_of(line)) and line in seen
            seen.add(line)
        at = collections.defaultdict(list)
        for i in range(len(w) - 7):
            at[tuple(w[i : i + 8])].append(i)
        covered = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(8)}
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        expected = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(covered), failed)
        for r in got[key]:
            assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == expected
            assert not (failed and r["kept"])
    assert compression.compression_rules(empty).count() == 0


def test_bands_reject_both_ends(spark):
    rng = random.Random(6)
    prose = "\n".join(made_texts(12, 77))
    noise = " ".join("".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(60)) for _ in range(60))
    sentence = "the quick brown fox jumps over the lazy dog and runs to the far away green hills of "
    repeated = " ".join(sentence + str(i) for i in range(200))
    rows = [(1, prose), (2, noise), (3, repeated)]
    kept = {r["doc_id"]: r["kept"] for r in compression.compression_rules(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert not kept[2] and not kept[3]


# --- 8: urls ----------------------------------------------------------------------------

URLS = [
    None, "", "no scheme", "http://", "http://A.Example.COM", "http://example.com/en/1", "http://www.example.com/en/1", "https://x.net/es/2?q=/fr/",
    "https://x.net/fr#top", "https://x.net/fr/9#top", "http://notexample.com/en/4", "http://com/en", "http://a.com?x=/", "ftp://h.org/a//b/", "http://É.Net/es/x",
    "http://x.org://y.com/en/", "http://user@x.net:80/es/1",
]


def brute_url(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, v) for v, h, p in url_tree.UrlRules().rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1:] if fits else (None, None)


def test_urls(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(0, None, "x")]
    got = url_tree.judge_urls(spark.createDataFrame(rows, "page_id int, url string, host string")).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, (rule, verdict) = brute_url(URLS[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or r["verdict"]) and r["verdict"] in ("allow", "block")
    assert url_tree.judge_urls(spark.createDataFrame([], "page_id int, url string")).count() == 0


def test_templates_learn_from_rules(spark):
    rules = url_tree.UrlRules(rules=(("block", "shop.org", "/ads/0"), ("allow", "shop.org", "/news/0")), depth=3)
    urls = [f"http://shop.org/ads/{k:02d}/page-{'abcdefghij'[k % 10]}{k}" for k in range(60)]
    urls += [f"http://shop.org/news/{k:02d}" for k in range(60)] + ["http://shop.org/ads/77/b/c/d/e", "http://other.org/ads/3"]
    got = {r["url_no"]: r for r in url_tree.judge_urls(
        spark.createDataFrame(list(enumerate(urls)), "url_no int, url string"), key="url_no", rules=rules
    ).collect()}
    assert {got[k]["template"] for k in range(60)} == {"/ads/<n>/*"}
    assert all(got[k]["verdict"] == "block" for k in range(60))  # 10 to 59 by the template
    assert all(got[k]["verdict"] == "allow" for k in range(60, 120)) and got[121]["verdict"] == "allow"
