"""MinHash near-duplicate groups, verified by odd sketches and then on full shingle sets.

A document's set holds its distinct 5-word shingles. The least similarity of a link is an argument, and the number of
bands follows from it. Two kinds of MinHash samples are taken: minima of bands * ROWS hash functions make the bands, whose equal keys bring candidates together, and the minima of
BINS slices of one hash are folded into an odd sketch, a bitmap in which every (slice, minimum) flips
one bit. The population count of two sketches' XOR estimates how many samples differ; with
the two sets' sizes that bounds their similarity from above, and discards nearly all false
candidates without their sets. What is left is confirmed on the full sets, so every link is
true; a pair at the least similarity misses all bands with a probability below 1e-6 and is
discarded by its sketch with one below 1e-5.

Documents with equal sets are one class, represented by their smallest doc_id. Only
representatives enter the bands. Links are sought in rounds, between different components only. In the
first round a bucket proposes a spanning forest of its most similar pairs, so a group of g similar
texts costs g - 1 proposals, not g * g / 2. Later, each member outside the bucket's main component
proposes its q most similar members of other components; q grows from round to round until nothing is left
out. Of the buckets that two members share, only the first proposes the pair. Buckets of more than
BLOCK members are split into blocks: first every block meets the bucket's first one, later the members outside the
main component meet all blocks. No bucket, class or component is ever gathered in one task.

Defined cases: a null or empty text, or one without words, has an empty set, links with nothing
and is kept; a text of fewer than 5 words has its whole sequence as its only shingle; each row is judged
on its own text even if its doc_id repeats; a row without doc_id belongs to no group and is kept.
"""

from __future__ import annotations

import re
from fractions import Fraction
from functools import cache
from itertools import combinations
from math import ceil, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.llm.common import documents, kept, partitions
from barline.llm.words import flat, mixed, pieces, shingles, word_hashes

SHINGLE = 5
LEAST = 0.8  # links have a Jaccard similarity of this at least, unless the caller names another one
CONTRACT = 0.85  # that of the query
ROWS = 5
MISSED = 1e-6  # a pair at the least similarity shares no band with this probability at most
BINS = 8192
SKETCH_BITS = 2048
SURE = 4.5  # deviations allowed between a pair's sketch and its expectation at the least similarity
BLOCK = 2048
FIRST_PROPOSALS, GROWTH = 4, 32


def ratio(least: float) -> Fraction:
    """A least similarity as the decimal that it is written as."""
    if not 0 < least <= 1:
        raise ValueError(f"least similarity not above 0 and up to 1: {least}")
    return Fraction(str(least))


def bands_for(least: float) -> int:
    """Bands of ROWS minima that miss a pair at the least similarity with a probability of MISSED at most."""
    shared = float(ratio(least)) ** ROWS
    return 1 if shared == 1 else ceil(log(MISSED) / log1p(-shared))


@cache
def _functions(bands: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and addends of the hash functions."""
    rng = np.random.default_rng(20240131)
    mul = rng.integers(1, 1 << 63, bands * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
    return mul, rng.integers(0, 1 << 63, bands * ROWS, np.uint64)


def minima(s: np.ndarray, bands: int) -> np.ndarray:
    """The smallest value of every hash function over a set."""
    mul, add = _functions(bands)
    out = np.full(bands * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 2048):
        part = s[at : at + 2048]
        out = np.minimum(out, (part[None, :] * mul[:, None] + add[:, None]).min(1))
    return out


def band_keys(m: np.ndarray) -> np.ndarray:
    h = np.arange(1, len(m) // ROWS + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
    for column in mixed(m).reshape(-1, ROWS).T:
        h = mixed(h ^ column)
    return h


def odd_sketch(s: np.ndarray) -> tuple[np.ndarray, int]:
    """Parity bitmap of the smallest value of each slice of a hash, as bytes, and the number of slices in use."""
    v = np.sort(mixed(s * np.uint64(0x9FB21C651E98DF25) + np.uint64(1)))
    slices = v >> np.uint64(64 - BINS.bit_length() + 1)
    v = v[np.concatenate([[True], slices[1:] != slices[:-1]])]
    bits = np.bincount((mixed(v) % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(bits.astype(np.uint8)), len(v)


def farthest(n: np.ndarray, used: np.ndarray, least: float = CONTRACT) -> np.ndarray:
    """Differing sketch bits that a linked pair stays under; n: sum of the two sets' sizes, used: of their slices in use."""
    j = float(least)
    union = n / (1 + j)
    slices = BINS * -np.expm1(-union / BINS)
    # Each slice of the union holds a common minimum with probability j; nearly all elements are drawn from small sets.
    drawn = np.sqrt(j * (1 - j) * slices * np.clip(1 - slices / np.maximum(union, 1), 0.005, 1))
    samples = np.maximum(used - 2 * j * slices, 0) + 1
    bits = SKETCH_BITS / 2 * -np.expm1(-2 * samples / SKETCH_BITS)
    kept = np.exp(-2 * samples / SKETCH_BITS)
    noise = np.sqrt((2 * drawn * kept) ** 2 + np.minimum(2 * samples**2 / SKETCH_BITS, SKETCH_BITS / 4)) + 0.5
    return np.minimum(bits + SURE * noise, SKETCH_BITS).astype(np.int64)


def _sets(texts: pa.Array):
    """The shingle set of every text."""
    data, offsets = flat(texts)
    for first, last, piece, at in pieces(data, offsets):
        words, begin = word_hashes(piece, at)
        for k in range(last - first):
            yield shingles(words[begin[k] : begin[k + 1]], SHINGLE)


SIGNATURES = "doc_id long, n long, one long, two long, bands array<long>, used int, sketch binary"


def _signatures(least: float):
    count = bands_for(least)

    def run(batches):
        for batch in batches:
            n, one, two, bands, used, sketch = [], [], [], [], [], []
            for s in _sets(batch.column(1)):
                n.append(len(s))
                one.append(int(s.sum(dtype=np.uint64).view(np.int64)))
                two.append(int(np.bitwise_xor.reduce(mixed(s)).view(np.int64)) if len(s) else 0)
                if len(s):
                    keys = band_keys(minima(s, count))
                    bands.append(keys.view(np.int64))
                    bits, slices = odd_sketch(s)
                    used.append(slices)
                    # With the band keys, in short, so that two members know the first band that they share.
                    sketch.append(bits.tobytes() + keys.astype(np.uint32).tobytes())
                else:
                    bands.append(None)
                    used.append(0)
                    sketch.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(used, pa.int32()), pa.array(sketch, pa.binary())],
                ["doc_id", "n", "one", "two", "bands", "used", "sketch"],
            )

    return run


def _set_rows(batches):
    for batch in batches:
        rows = [s.tobytes() for s in _sets(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["doc_id", "shingles"])


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits that differ, for all pairs of rows of two sketch matrices of 64-bit words."""
    out = np.zeros((len(a), len(b)), np.uint16)
    for w in range(a.shape[1]):
        out += np.bitwise_count(a[:, w, None] ^ b[None, :, w])
    return out


PROPOSALS = "a long, b long, cut boolean"


def forest(far: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that join all rows a matrix of distances can join, nearest first: each component in turn takes its nearest pair."""
    out = []
    _, part = np.unique(label, return_inverse=True)
    far = np.where(part[:, None] == part[None, :], SKETCH_BITS + 1, far)
    # One order for all, so that equal distances can't close a circle.
    g = len(far)
    low, high = np.minimum.outer(np.arange(g), np.arange(g)), np.maximum.outer(np.arange(g), np.arange(g))
    rank = (far.astype(np.int64) * g + low) * g + high
    none = np.int64(SKETCH_BITS + 1) * g * g
    while True:
        to = rank.argmin(1)
        best = rank[np.arange(g), to]
        least = np.full(part.max() + 1, none)
        np.minimum.at(least, part, best)
        mine = np.flatnonzero((best == least[part]) & (best < none))
        if not len(mine):
            break
        a, b = np.minimum(mine, to[mine]), np.maximum(mine, to[mine])
        pair = np.unique(a * g + b)
        out.append(pair)
        root = np.arange(part.max() + 1)
        for x, y in zip(part[pair // g], part[pair % g], strict=True):
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            root[max(x, y)] = min(x, y)
        while (root[root] != root).any():
            root = root[root]
        part = root[part]
        _, part = np.unique(part, return_inverse=True)
        rank[part[:, None] == part[None, :]] = none
    pair = np.concatenate(out) if out else np.zeros(0, np.int64)
    return pair // g, pair % g


def _proposals(q: int, least: float):
    """Proposes pairs with different labels: q = 0, a forest over each block; else the q nearest of every asking row."""
    part, whole = ratio(least).as_integer_ratio()

    def propose(table: pa.Table) -> pa.Table:
        key = np.stack([table.column(c).to_numpy() for c in ("key", "part", "ask_part")])
        order = np.lexsort(key[::-1])
        cuts = np.flatnonzero((np.diff(key[:, order], axis=1) != 0).any(0)) + 1
        doc, label, size, used, band = (table.column(c).to_numpy() for c in ("doc_id", "label", "n", "used", "band"))
        asks, base = (table.column(c).to_numpy(zero_copy_only=False) for c in ("asks", "base"))
        raw = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(doc), -1)
        words = np.ascontiguousarray(raw[:, : SKETCH_BITS // 8]).view(np.uint64)
        keys = np.ascontiguousarray(raw[:, SKETCH_BITS // 8 :]).view(np.uint32)
        found, cut = [], []

        def distances(x, y):
            far = differing(words[x], words[y])
            far[far > farthest(size[x][:, None] + size[y][None, :], used[x][:, None] + used[y][None, :], least)] = SKETCH_BITS + 1
            small, large = np.minimum.outer(size[x], size[y]), np.maximum.outer(size[x], size[y])
            far[(whole * small < part * large) | (label[x][:, None] == label[y][None, :])] = SKETCH_BITS + 1
            return far

        def add(x, y, more):
            first = (keys[x] == keys[y]).argmax(1) == band[x]
            # A pair is told in its first band only; that its row has more to try is told in any case, by a pair with itself.
            rest = np.unique(x[more & ~first]) if q else x[:0]
            x, y, more = x[first], y[first], more[first]
            found.append(np.stack([np.minimum(doc[x], doc[y]), np.maximum(doc[x], doc[y])]))
            found.append(np.stack([doc[rest], doc[rest]]))
            cut.extend([more, np.ones(len(rest), bool)])

        for rows in np.split(order, cuts):
            rows = rows[np.argsort(doc[rows], kind="stable")]
            if len(rows) < 2 or label[rows].min() == label[rows].max():
                continue
            to, who = rows[base[rows]], rows[asks[rows]]
            if q == 0:
                i, j = forest(distances(rows, rows), label[rows])
                add(rows[i], rows[j], np.ones(len(i), bool))
                continue
            for at in range(0, len(who), 512):
                block = who[at : at + 512]
                far = distances(block, to)
                near, last = np.broadcast_to(np.arange(len(to)), far.shape), np.full(len(block), SKETCH_BITS + 1)
                if q < len(to):
                    near = np.argpartition(far.astype(np.int64) * len(to) + np.arange(len(to)), q, axis=1)
                    last = np.take_along_axis(far, near[:, q : q + 1], 1)[:, 0]
                    near = near[:, :q]
                i, j = np.nonzero(np.take_along_axis(far, near, 1) <= SKETCH_BITS)
                add(block[i], to[near[i, j]], (last <= SKETCH_BITS)[i])
        a, b = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        more = np.concatenate(cut) if cut else np.zeros(0, bool)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "cut": pa.array(more)})

    return propose


def _confirmed(least: float):
    """Pairs that hold on their full sets."""
    part, whole = ratio(least).as_integer_ratio()

    def run(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                small, large = (s, t) if len(s) <= len(t) else (t, s)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                same = int((large[at] == small).sum())
                ok.append(whole * same >= part * (len(s) + len(t) - same))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok, pa.bool_())], ["a", "b", "ok"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable along the edges (a, b), for every node on an edge.

    Every round takes the smallest root among a node's neighbours and then that root's root, so paths
    shrink by doubling; it ends when no root changes.
    """
    both = kept(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    roots = kept(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("root")))
    while True:
        near = both.join(roots, both.b == roots.node).groupBy("a").agg(F.min("root").alias("least"))
        step = roots.join(near, roots.node == near.a).select("node", "root", F.least("root", "least").alias("to"))
        far = step.select(F.col("node").alias("to"), F.col("to").alias("further"))
        step = step.join(far, "to", "left").select("node", "root", F.coalesce(F.least("to", "further"), "to").alias("new"))
        step = kept(step)
        if step.where("root <> new").isEmpty():
            return step.select("node", F.col("new").alias("root"))
        roots = step.select("node", F.col("new").alias("root"))


MEMBER = ["key", "band", "doc_id", "n", "used", "sketch"]


def _links(docs: DataFrame, reps: DataFrame, text: str, least: float) -> DataFrame | None:
    """(doc_id, root) of the representatives that link with another one."""
    spark = docs.sparkSession
    keys = reps.select("doc_id", F.posexplode("bands").alias("band", "key")).select("doc_id", "band", F.xxhash64("band", "key").alias("key"))
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    parts = F.ceil(F.col("members") / BLOCK).cast("int")
    shared = keys.join(sizes, "key").join(reps.select("doc_id", "n", "used", "sketch"), "doc_id")
    members = kept(shared.select(*MEMBER, parts.alias("parts"), F.pmod(F.xxhash64("doc_id", "key"), parts).cast("int").alias("part")))
    if members.isEmpty():
        return None
    # The same join at every size: a small corpus should not show a plan that a large one can't have.
    needed = members.select("doc_id").distinct().hint("merge")
    sets = kept(docs.join(needed, "doc_id", "left_semi").select("doc_id", text).mapInArrow(_set_rows, "doc_id long, shingles binary"))
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    labels, tried, q = None, None, 0
    while True:
        if tried is None:
            asked = _first_blocks(members.withColumn("label", F.col("doc_id")))
        else:
            asked = _later_blocks(members.join(labels, "doc_id", "left").withColumn("label", F.coalesce("root", "doc_id")))
        task = F.pmod(F.xxhash64("key", "part", "ask_part"), F.lit(4 * partitions(spark))).cast("int")
        found = asked.withColumn("task", task).groupBy("task").applyInArrow(_proposals(q, least), PROPOSALS)
        found = kept(found.groupBy("a", "b").agg(F.max("cut").alias("cut")))
        # Round 0 has not met the pairs between two later blocks of a bucket.
        more = tried is None or not found.where("cut").isEmpty()
        pairs = found.where("a <> b")
        if tried is None:
            pairs = pairs.hint("merge")
        else:
            pairs = pairs.join(tried.select("a", "b"), ["a", "b"], "left_anti")
        checked = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(_confirmed(least), "a long, b long, ok boolean")
        checked = kept(checked.groupBy("a", "b").agg(F.max("ok").alias("ok")))
        if labels is None or not checked.where("ok").isEmpty():
            tried = checked if tried is None else kept(tried.unionByName(checked))
            labels = kept(components(tried.where("ok").select("a", "b")).withColumnRenamed("node", "doc_id"))
        else:
            tried = kept(tried.unionByName(checked))
        if not more:
            return labels
        q = GROWTH * q or FIRST_PROPOSALS


BLOCK_ROW = [*MEMBER, "part", "ask_part", "label", "asks", "base"]


def _first_blocks(rows: DataFrame) -> DataFrame:
    """Every block by itself, with the bucket's block 0."""
    own = F.when(F.col("part") == 0, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("part"))
    rows = rows.withColumn("part", F.explode(own))
    return rows.withColumns({"ask_part": F.lit(0), "asks": F.lit(True), "base": F.lit(True)}).select(BLOCK_ROW)


def _later_blocks(rows: DataFrame) -> DataFrame:
    """Of buckets with several labels: the members outside the main one against all, block by block."""
    spread = rows.groupBy("key").agg(F.min("label").alias("main"), F.max("label").alias("other")).where("main <> other")
    rows = rows.join(spread.select("key", "main"), "key")
    small = rows.where("parts = 1").withColumns({"ask_part": F.lit(0), "asks": F.col("label") != F.col("main"), "base": F.lit(True)})
    large = rows.where("parts > 1")
    asks = large.where("label <> main").withColumns({"ask_part": F.col("part"), "asks": F.lit(True), "base": F.lit(False)})
    asks = asks.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    asking = large.where("label <> main").select("key", F.col("part").alias("ask_part")).distinct()
    base = large.join(asking, "key").withColumns({"asks": F.lit(False), "base": F.lit(True)})
    return small.select(BLOCK_ROW).unionByName(base.select(BLOCK_ROW)).unionByName(asks.select(BLOCK_ROW))


def groups(docs: DataFrame, text: str = "text", least: float = LEAST) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept; texts link from a Jaccard similarity of `least`."""
    rows = kept(docs.select("doc_id", text).mapInArrow(_signatures(least), SIGNATURES))
    alike = ["n", "one", "two"]
    classes = rows.where("n > 0 and doc_id is not null").groupBy(*alike).agg(F.min("doc_id").alias("rep"))
    rows = kept(rows.join(classes, alike, "left").select("doc_id", "n", "rep", F.when(F.col("doc_id") == F.col("rep"), F.col("bands")).alias("bands"), "used", "sketch"))
    roots = _links(docs, rows.where(F.col("bands").isNotNull()).select("doc_id", "n", "bands", "used", "sketch"), text, least)
    found = F.coalesce("rep", "doc_id")
    if roots is not None:
        rows = rows.join(roots.select(F.col("doc_id").alias("rep"), "root"), "rep", "left")
        found = F.coalesce("root", "rep", "doc_id")
    rows = rows.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), found))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, text: str = "text", least: float = LEAST) -> DataFrame:
    """One row of each group, with all columns as they are: the one with the smallest id.

    Rows that share an id, or have none, are judged each by its own text: they come after those with an id of their own, and
    of rows equal in id and text one stays. Rows without a word belong to no group, so only their equals go.
    """
    shared = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1 or doc_id is null").select(F.col("doc_id").alias("shared_id"))
    shared = kept(shared)
    if shared.isEmpty():
        gone = groups(docs, text, least).where("not kept").select("doc_id").distinct()
        return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    # Such rows get numbers above all usual ids, from their id and text.
    number = F.xxhash64(docs["doc_id"], docs[text]).bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    alone = shared["shared_id"].isNull() & docs["doc_id"].isNotNull()
    joined = docs.join(shared, docs["doc_id"].eqNullSafe(shared["shared_id"]), "left")
    rows = joined.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.when(alone, docs["doc_id"]).otherwise(number).alias("doc_id"))
    rows = kept(rows.dropDuplicates(["doc_id"]))
    gone = groups(rows.select("doc_id", F.col(f"row.{text}").alias("text")), "text", least).where("not kept").select("doc_id").distinct()
    return rows.join(gone, "doc_id", "left_anti").select("row.*")


def query(spark: SparkSession, folder: str) -> DataFrame:
    return groups(documents(spark, folder, "doc_id", "text"), least=CONTRACT)


def brute(texts: dict[int, str | None], least: float = CONTRACT) -> dict[int, tuple[int, int, bool]]:
    """The query's rows by comparing the word tuples of all pairs, for tests."""
    low = {i: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "") for i, t in texts.items()}
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t) for i, t in low.items()}
    sets = {i: {tuple(w[k : k + SHINGLE]) for k in range(max(1, len(w) - SHINGLE + 1))} if w else set() for i, w in words.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(sorted(texts), 2):
        if sets[i] and sets[j] and len(sets[i] & sets[j]) >= ratio(least) * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return {i: (len(sets[i]), find(i), find(i) == i) for i in texts}
