"""Near duplicates by a chosen-path similarity join.

A document is the set of its word shingles.  Documents are branched by minwise tokens: a
node of a tree holds the documents that chose the same tokens so far, and each node takes
on average 1 / similarity further coordinates, so that a pair at the threshold is expected
to stay together in one child however deep the tree grows.  Small nodes are compared
exhaustively, large ones branch on; independent trees are repeated for the recall.  Each
link is confirmed on the full sets of both texts.

Equal sets are one member from the start, a node whose members are in one component is
done, and members of a node's most frequent component are never paired with one another;
so groups of copies cost no pairs, and no link between two components is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import discard, hash_words, in_bitmap, key_bitmap, mix64, shingle_hashes, stored
from millrace.llm.linking import components, label_members, major_pairs, mixed, pairs_across, star_pairs


@dataclass(frozen=True)
class JoinRules:
    words: int = 5
    #: Least Jaccard similarity in hundredths.
    percent: int = 80
    #: Under 1 in 1000 for a pair at 80 hundredths to part in all trees, by its shared coordinates (tested).
    trees: int = 32
    coordinates: int = 256
    #: Hundredths below the threshold down to which a pair's expected number of common nodes does
    #: not fall with the depth (the agreement of its coordinates scatters around its similarity).
    slack: int = 4
    #: A node with at most so many members outside its most frequent component is compared.
    leaf: int = 32
    #: The same for nodes that a round of branching has left: what is still together mostly stays so, and a
    #: member is cheaper to test against these than to deal out again in every round.
    late_leaf: int = 1024
    #: Rounds of branching by `levels` levels; what is still large then is compared all the same.
    rounds: int = 3
    levels: int = 5
    #: Standard deviations below the threshold at which an estimate rules a pair out.
    margin: float = 7.0

    def least_bits(self) -> int:
        """Equal bits of two sketches, at ``margin`` below the mean of a pair at the threshold.

        A coordinate's bit is equal with probability s, else by chance.
        """
        p = (1 + self.percent / 100) / 2
        return int(np.floor(self.coordinates * p - self.margin * np.sqrt(self.coordinates * p * (1 - p))))


PARITIES = 512
#: Rows whose minwise tokens or pairs of texts a task holds at once.
SLICE = 1024
_SALT = [np.uint64(0x632BE59BD9B4E019), np.uint64(0xE220A8397B1DCDAF)]


def distinct_shingles(words: np.ndarray, n: int) -> np.ndarray:
    return np.unique(shingle_hashes(words, n))


def shingle_sets(column: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingles) of each text, A-Z lower-cased."""
    for i, j, words, firsts in hash_words(column, fold=True):
        for d in range(j - i):
            yield i + d, distinct_shingles(words[firsts[d] : firsts[d + 1]], n)


def _longs(bits: np.ndarray) -> pa.Array:
    """Rows of bits as lists of longs."""
    longs = np.ascontiguousarray(np.packbits(bits, axis=1)).view(np.int64)
    return pa.FixedSizeListArray.from_arrays(pa.array(longs.ravel()), bits.shape[1] // 64).cast(pa.list_(pa.int64()))


def _slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The same rows in short batches, so that a task's arrays stay small."""
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def row_hash(key: str, text: str) -> Column:
    """Tells the texts of equal keys apart."""
    return F.xxhash64(F.col(key), F.col(text).cast("string"))


def signatures(docs: DataFrame, key: str, text: str, rules: JoinRules) -> DataFrame:
    """(key, row, n_shingles, set1, set2, sig, root, sketch, parity): a hash of key and text (`row_hash`),
    two digests of the set, 16 bits of each minwise token, all 64 of those that trees start from, one more bit of each as longs, and
    the parities of PARITIES buckets of shingles."""
    k = rules.coordinates
    factors = mix64(np.arange(1, k + 1, dtype=np.uint64) * _SALT[0]) | np.uint64(1)
    shifts = mix64(np.arange(1, k + 1, dtype=np.uint64) * _SALT[1])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows = batch.num_rows
            size, one, two = (np.zeros(rows, dtype=np.int64) for _ in range(3))
            sig = np.zeros((rows, k), dtype=np.uint64)
            odd = np.zeros((rows, PARITIES), dtype=np.uint8)
            for row, found in shingle_sets(batch.column(1), rules.words):
                size[row] = len(found)
                if not len(found):
                    continue
                one[row] = mix64(found ^ _SALT[0]).sum(dtype=np.uint64).astype(np.int64)
                two[row] = mix64(found ^ _SALT[1]).sum(dtype=np.uint64).astype(np.int64)
                odd[row] = np.bincount((found >> np.uint64(20)).astype(np.int64) % PARITIES, minlength=PARITIES) & 1
                for a in range(0, len(found), 1024):
                    least = (found[a : a + 1024, None] * factors + shifts).min(axis=0)
                    sig[row] = least if a == 0 else np.minimum(sig[row], least)
            mixed = mix64(sig)
            tokens = (mixed >> np.uint64(48)).astype("<u2")
            first = mixed[:, np.arange(rules.trees) % k]
            root = pa.FixedSizeListArray.from_arrays(pa.array(first.view(np.int64).ravel()), rules.trees).cast(pa.list_(pa.int64()))
            lists = [_longs((mixed & np.uint64(1)).astype(np.uint8)), _longs(odd)]
            raw = pa.array([t.tobytes() for t in tokens], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(size), pa.array(one), pa.array(two), raw, root, *lists],
                [key, "row", "n_shingles", "set1", "set2", "sig", "root", "sketch", "parity"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key), F.col(text).cast("string"), row_hash(key, text)).mapInArrow(
        sign, f"`{key}` {kind}, row bigint, n_shingles bigint, set1 bigint, set2 bigint, sig binary, root array<bigint>, sketch array<bigint>, parity array<bigint>"
    )


def _token(c: Column) -> Column:
    return F.substring("sig", 2 * c + 1, F.lit(2))


def roots(reps: DataFrame, rules: JoinRules) -> DataFrame:
    """(key, id) of the first level: tree t branches by its own coordinate.

    Whole tokens: with 16 bits of them, strangers would share nearly every root of a large table.
    """
    return reps.select(F.explode(F.transform("root", lambda token, t: F.xxhash64(t, token))).alias("key"), "id")


def branches(rows: DataFrame, rules: JoinRules) -> DataFrame:
    """Children of nodes (key, id, sig): one coordinate, and a second one as often as 1 / similarity
    asks for.  The coordinates are a function of the node, so its members choose alike."""
    more = int(round((100 / (rules.percent - rules.slack) - 1) * 1_000_000))
    for _ in range(rules.levels):
        one, two = (F.pmod(F.xxhash64("key", F.lit(s)), F.lit(rules.coordinates)).cast("int") for s in ("one", "two"))
        coin = F.pmod(F.xxhash64("key", F.lit("coin")), F.lit(1_000_000))
        picked = F.when((coin < more) & (one != two), F.array(one, two)).otherwise(F.array(one))
        rows = rows.select("id", "sig", "key", F.explode(picked).alias("c")).select(
            "id", "sig", F.xxhash64("key", "c", _token(F.col("c"))).alias("key")
        )
    return rows.select("key", "id").distinct()


def _differ(x: Column, y: Column, longs: int) -> Column:
    """Bits in which two lists of longs differ."""
    return sum((F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(1, longs)), F.bit_count(x[0].bitwiseXOR(y[0])))


def sets_may_link(rules: JoinRules):
    """Lossless test by parities: each shingle that only one set has flips one parity at most."""

    def alike(x: Column, y: Column) -> Column:
        most = (x["n_shingles"] + y["n_shingles"]) * (100 - rules.percent)
        return _differ(x["parity"], y["parity"], PARITIES // 64) * (100 + rules.percent) <= most

    return alike


def may_link(rules: JoinRules):
    """Test of two members by sizes and sketches; what it rules out is below the threshold."""
    longs = rules.coordinates // 64

    def alike(x: Column, y: Column) -> Column:
        sizes = 100 * F.least(x["n_shingles"], y["n_shingles"]) >= rules.percent * F.greatest(x["n_shingles"], y["n_shingles"])
        return sizes & (_differ(x["sketch"], y["sketch"], longs) <= rules.coordinates - rules.least_bits())

    return alike


def confirm(
    pairs: DataFrame, docs: DataFrame, classes: DataFrame, key: str, text: str, rules: JoinRules
) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of ``classes`` (id, low: key and row of one of its texts) whose full sets reach
    the threshold, and the table of texts that they are tested on."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = stored(classes.join(ids, "id", "left_semi").select("id", F.col("low.key").alias("key"), F.col("low.row").alias("row")), "wanted")
    bitmap = docs.sparkSession.sparkContext.broadcast(key_bitmap(wanted, "row"))  # fixed size

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(bitmap.value, batch.column(2).to_numpy())))

    kind = docs.schema[key].dataType.simpleString()
    source = docs.where(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.col(text).cast("string").alias("body"), row_hash(key, text).alias("row")
    )
    texts = stored(
        source.mapInArrow(thin, f"key {kind}, body string, row bigint").join(wanted, ["key", "row"])
        .groupBy("id").agg(F.min("body").alias("body")), "texts"
    )
    discard(wanted)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            ok = np.zeros(batch.num_rows, dtype=bool)
            other = shingle_sets(batch.column(3), rules.words)
            a_ids, last, kept = batch.column(0).to_pylist(), None, None
            for (row, two), (_, one) in zip(other, _cached(batch.column(2), a_ids, rules), strict=True):
                both = len(np.intersect1d(one, two, assume_unique=True))
                ok[row] = both > 0 and 100 * both >= rules.percent * (len(one) + len(two) - both)
            yield batch.filter(pa.array(ok)).select(["a", "b"])

    joined = pairs.join(texts.select(F.col("id").alias("b"), F.col("body").alias("two")), "b").join(
        texts.select(F.col("id").alias("a"), F.col("body").alias("one")), "a"
    )
    return joined.select("a", "b", "one", "two").mapInArrow(test, "a bigint, b bigint"), texts


def _cached(column: pa.Array, ids: list, rules: JoinRules) -> Iterator[tuple[int, np.ndarray]]:
    """As `shingle_sets`, but a run of equal ids is computed once."""
    starts = [i for i in range(len(ids)) if i == 0 or ids[i] != ids[i - 1]]
    ends = [*starts[1:], len(ids)]
    for (k, found), a, b in zip(shingle_sets(column.take(pa.array(starts, pa.int64())), rules.words), starts, ends, strict=True):
        for row in range(a, b):
            yield row, found


def same_key(sets: DataFrame, classes: DataFrame, key: str) -> DataFrame:
    """Links (a, b) between the classes of the different texts of one key."""
    digest = F.struct("n_shingles", "set1", "set2")
    shared = (
        sets.where(F.col(key).isNotNull() & (F.col("n_shingles") > 0))
        .groupBy(F.col(key).alias("__key")).agg(F.min(digest).alias("lead"), F.max(digest).alias("end")).where("lead != end")
    )
    several = sets.join(shared, F.col(key) == F.col("__key")).where("n_shingles > 0").select(digest.alias("own"), "lead").distinct()
    one, two = (classes.select(digest.alias(c), F.col("id").alias(i)) for c, i in (("lead", "a"), ("own", "b")))
    return stored(several.where("own != lead").join(one, "lead").join(two, "own").select("a", "b"), "same_key")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: JoinRules = JoinRules()) -> DataFrame:
    """Per row: key, n_shingles, component_id (smallest key reachable), kept.

    A text with fewer words than a shingle is one shingle; one without words (null, empty,
    blank) has none, is linked with nothing and kept.  A null key takes no part: its
    component is null and it is kept.  Rows with equal keys are one document, whose texts are
    linked with one another; each comes out with its own n_shingles.  Equal texts share a component, an
    empty table gives an empty table, other columns are not read.
    """
    signed = stored(signatures(docs, key, text, rules), "signatures")
    usable = signed.where(F.col(key).isNotNull() & (F.col("n_shingles") > 0))
    reps = stored(usable.groupBy("n_shingles", "set1", "set2").agg(
        F.min(F.struct(F.col(key).alias("key"), "row")).alias("low"), F.first("sig").alias("sig"), F.first("root").alias("root"), F.first("sketch").alias("sketch"), F.first("parity").alias("parity")
    ).withColumn("id", F.monotonically_increasing_id()), "classes")  # numbers of the written rows
    slim = stored(signed.select(key, "n_shingles", "set1", "set2"), "sets")
    discard(signed)
    facts, alike, same = reps.select("id", "n_shingles", "sketch"), may_link(rules), sets_may_link(rules)
    parities = reps.select("id", "parity")

    def possible(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that the parities leave possible."""
        both = F.struct("n_shingles", "parity")
        one, two = (reps.select(F.col("id").alias(c), both.alias(f"of_{c}")) for c in "ab")
        return pairs.join(one, "a").join(two, "b").where(same(F.col("of_a"), F.col("of_b"))).select("a", "b")

    def crowded(nodes: DataFrame) -> DataFrame:
        """Members of nodes of two and more, with what they are compared by."""
        crowd = nodes.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low != high").select("key")
        return nodes.join(crowd, "key", "left_semi").join(facts, "id").select("key", "id", F.lit(True).alias("indexed"), "n_shingles", "sketch")

    def confirmed(pairs: DataFrame) -> DataFrame:
        found = stored(pairs, "pairs")
        tested, spent = confirm(found, docs, reps.select("id", "low"), key, text, rules)
        out = stored(tested, "links")
        discard(found, spent)
        return out

    members = stored(crowded(roots(reps, rules)), "nodes")
    links = confirmed(possible(star_pairs(members, alike))).unionByName(same_key(slim, reps, key))
    labels = stored(components(links), "labels")

    def merged(links: DataFrame, name: str) -> DataFrame:
        """Components of ``links`` on top of the known ones, which count one edge per member."""
        known = labels.select(F.col("id").alias("a"), F.col("component").alias("b"))
        return stored(components(known.unionByName(links)), name)

    # nodes with several components: the nearly pure are compared now, the others branch on
    ready, level = None, members
    for turn in range(rules.rounds + 1):
        last = turn == rules.rounds
        # families that are still together: the members outside a node's most frequent component against one of it, so
        # that a family is joined by few links and not by all of its pairs; where rounds are left, twice, as the first
        # links make a component whose first member may reach the rest
        for _ in range(0 if not turn else 1 if last else 2):
            stars = major_pairs(label_members(level, labels).join(parities, "id"), lambda x, y: alike(x, y) & same(x, y))
            labels = merged(confirmed(stars if ready is None else stars.unionByName(ready).distinct()), "labels")
            ready = None
        rows = stored(mixed(label_members(level, labels)), "mixed")
        discard(level)
        few = F.col("minors") <= (max(rules.leaf, rules.late_leaf) if turn else rules.leaf)
        now = rows if last else rows.where(few)
        if turn:
            pairs = pairs_across(now.join(parities, "id"), lambda x, y: alike(x, y) & same(x, y))
        else:  # most rows are here; few pairs are left to bring the parities to
            pairs = possible(pairs_across(now, alike))
        ready = stored(pairs, "pairs")
        large = rows.where(~few)
        if last or large.isEmpty():
            discard(rows)
            break
        level = stored(crowded(branches(large.select("key", "id").join(reps.select("id", "sig"), "id"), rules)), "nodes")
        discard(rows)
    joined = merged(confirmed(ready.distinct()), "components")
    own = reps.select("n_shingles", "set1", "set2", "id", F.col("low.key").alias("rep"))
    least = joined.join(own, "id").groupBy("component").agg(F.min("rep").alias("least"))
    of_class = own.join(joined.join(least, "component").select("id", "least"), "id", "left").select(
        "n_shingles", "set1", "set2", "rep", F.col("least").alias("component")
    )
    named = slim.join(of_class, ["n_shingles", "set1", "set2"], "left")
    linked = F.coalesce("component", F.when(F.col("n_shingles") > 0, F.col("rep")), F.col(key))
    return named.select(
        key, "n_shingles",
        F.when(F.col(key).isNotNull(), linked).alias("component_id"),
        (F.col(key).isNull() | (linked == F.col(key))).alias("kept"),
    )
