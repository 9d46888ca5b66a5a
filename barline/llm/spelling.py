"""Spelling variants: words one letter apart, and the frequent form that each rare one stands for.

Two words are near if exactly one inserted, deleted or replaced code point turns one into the
other. The words form a trie, their reversals another, and the nodes of both are numbered. A word
has, for each of its places, the pair of integers (node of what stands before it, node of what
stands after it). Two dictionaries of such pairs hold everything: the pair around a gap between
two letters names a whole word, and the pair around one skipped letter names all words that agree
but for that letter. So words that share a pair around a skipped letter differ by a replacement,
and a pair around a skipped letter that equals another word's pair around a gap says that the
other word has one letter less. No distance is computed and no candidate is wrong. Of a run of
equal letters only the last is skipped for the second kind, so each near pair is met once.

At most one word per letter of the alphabet shares a pair, so a group is small however frequent a
word is; counts and the best partner are taken inside the groups, and no pairs are written out.
A trie is numbered in sorted ranges of words: within a range from each word and the one before it,
while the nodes on the way to a range's border, which several ranges may share, have
numbers that follow from the borders alone. Borders come from a sample of SAMPLE words a
range; they affect balance only. No step joins on a node, so the root of a trie is no hot key.

A word's form is its near word with the largest count (of equal ones the first in code-point
order), if that is at least `factor` times its own; its root is what following forms ends in. As
counts grow by the factor in each step, the doubled pointers that find it need few rounds.

Defined cases: null texts and null ids count as empty; texts without letters give no word; words
of any length are taken whole; repeated documents count each time; an empty table gives none.
"""

from __future__ import annotations

import math
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.llm.common import bounded_sample, documents, kept, partitions

RUN = "[a-zÀ-ÿ]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMAGE_ONE_IN = 199
LEAST_LENGTH, LEAST_COUNT, FACTOR = 6, 5, 5
SAMPLE = 32
BORDER_LETTERS = 64


def runs(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row for each maximal run of letters, A-Z read as a-z."""
    low = F.translate(F.col(text), CAPITALS, SMALL)
    return docs.select(*keep, F.explode(F.regexp_extract_all(low, F.lit(RUN), 0)).alias("run"))


def damaged(run: Column, doc_id: Column, one_in: int = DAMAGE_ONE_IN) -> Column:
    """The run, but without one code point if the CRC-32 of `<doc_id>:<run>` is a multiple of `one_in`."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % one_in == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def counted(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words, one row each occurrence, that are long and frequent enough."""
    n = words.where(F.char_length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return n.where(F.col("n") >= least_count)


def _shared(a: str, b: str) -> int:
    """Letters that two words begin with alike."""
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def _border_nodes(borders: list[str]) -> list[list[int]]:
    """Negative numbers of the nodes on the way to each border, by depth."""
    paths, before, used = [], "", 0
    for border in borders:
        same = _shared(before, border)
        path = paths[-1][: same + 1] if paths else []
        new = len(border) + 1 - len(path)
        path = path + [-(used + k + 1) for k in range(new)]
        used += new
        paths.append(path)
        before = border
    return paths


def numbered(words: DataFrame, reverse: bool = False) -> DataFrame:
    """(word, n, place, nodes, ends_run): the words with the numbers of their trie nodes by depth, the root first.

    `place` grows with the words' order; `ends_run` says of each letter that the next is another. With `reverse`, words are
    read from the end.
    """
    spark = words.sparkSession
    ranges = partitions(spark)
    rows = words.select("word", "n", (F.reverse("word") if reverse else F.col("word")).alias("read"))
    sample = bounded_sample(rows, "word", SAMPLE * ranges).select(F.substring("read", 1, BORDER_LETTERS)).collect()
    sample = sorted({r[0] for r in sample})
    borders = sorted({sample[len(sample) * k // ranges] for k in range(1, ranges)}) if sample else []

    @F.arrow_udf("int")
    def range_of(read: pa.Array) -> pa.Array:
        return pa.array([bisect_right(borders, w) for w in read.to_pylist()], pa.int32())

    def number(batches):
        paths = _border_nodes(borders)
        now, before, path, used, place = -1, "", [], 0, 0
        for batch in batches:
            places, nodes, ends = [], [], []
            for part, word in zip(batch.column("part").to_pylist(), batch.column("read").to_pylist(), strict=True):
                if part != now:
                    now, before, path, used, place = part, "", [], 0, 0
                known = path[: _shared(before, word) + 1]
                for k in (part - 1, part):
                    if 0 <= k < len(borders) and (same := _shared(borders[k], word)) >= len(known):
                        known = known + paths[k][len(known) : same + 1]
                new = len(word) + 1 - len(known)
                path = known + [(part << 40) + used + k for k in range(new)]
                used, before, place = used + new, word, place + 1
                places.append((part << 40) + place)
                nodes.append(path)
                ends.append([a != b for a, b in zip(word, word[1:], strict=False)] + [True] * bool(word))
            new = [pa.array(places, pa.int64()), pa.array(nodes, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), *new], ["word", "n", "place", "nodes", "ends_run"])

    dealt = rows.withColumn("part", range_of("read")).repartitionById(ranges, "part").sortWithinPartitions("part", "read")
    return dealt.mapInArrow(number, "word string, n bigint, place bigint, nodes array<bigint>, ends_run array<boolean>")


def pairs(words: DataFrame) -> DataFrame:
    """(p, s, kind, n, back): both dictionaries, by prefix and suffix node.

    `back` is the word's place with its sign changed. Kinds: 0 a gap, 1 a skipped letter, 2 a skipped letter that ends a
    run of equal ones.
    """
    back = numbered(words, reverse=True).select("word", F.col("nodes").alias("tails"))
    size = F.size("nodes") - 1

    def around(length: Column, kind) -> Column:
        places = F.when(length >= 0, F.sequence(F.lit(0), length)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.struct(F.col("nodes")[i].alias("p"), F.col("tails")[length - i].alias("s"), kind(i).alias("kind")))

    gaps = around(size, lambda i: F.lit(0))
    skips = around(size - 1, lambda i: F.when(F.col("ends_run")[i], 2).otherwise(1))
    rows = numbered(words).join(back, "word")
    return rows.select("n", (-F.col("place")).alias("back"), F.inline(F.concat(gaps, skips)))


def near(words: DataFrame) -> DataFrame:
    """(back, n_near, best) of every word that has near words.

    `best` is (count, back), so that the greatest is the most frequent, then the first.
    """
    word = F.struct("n", "back")
    groups = pairs(words).groupBy("p", "s").agg(
        F.max(F.when(F.col("kind") == 0, word)).alias("whole"),
        F.sort_array(F.collect_list(F.when(F.col("kind") > 0, F.struct(word.alias("word"), "kind"))), False).alias("skipped"),
    )
    longer = F.filter("skipped", lambda x: x.kind == 2)
    first, second = F.try_element_at("skipped", F.lit(1)).word, F.try_element_at("skipped", F.lit(2)).word
    shorter = F.size(longer) > 0
    of_skipped = F.transform(
        "skipped",
        lambda x: F.struct(
            x.word.back.alias("back"),
            (F.size("skipped") - 1 + F.when((x.kind == 2) & F.isnotnull("whole"), 1).otherwise(0)).alias("met"),
            F.greatest(F.when(x.word == first, second).otherwise(first), F.when(x.kind == 2, F.col("whole"))).alias("best"),
        ),
    )
    of_whole = F.struct(F.col("whole.back").alias("back"), F.size(longer).alias("met"), F.try_element_at(longer, F.lit(1)).word.alias("best"))
    met = groups.where((F.size("skipped") > 1) | (F.isnotnull("whole") & shorter)).select(
        F.inline(F.concat(of_skipped, F.when(F.isnotnull("whole") & shorter, F.array(of_whole)).otherwise(F.array().cast(_MET))))
    )
    return met.where("met > 0").groupBy("back").agg(F.sum("met").cast("long").alias("n_near"), F.max("best").alias("best"))


_MET = "array<struct<back:bigint,met:int,best:struct<n:bigint,back:bigint>>>"


def variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of (word, n); words are distinct."""
    words = kept(words.select("word", F.col("n").cast("long").alias("n")))
    places = numbered(words).select("word", "n", (-F.col("place")).alias("back"))
    best = F.when(F.col("best.n") >= factor * F.col("n"), F.col("best"))
    rows = kept(places.join(near(words), "back", "left").select("word", "n", "back", "n_near", best.alias("form")))
    # A root is reached in fewer steps than the count can be divided by the factor.
    most, least = words.agg(F.max("n"), F.min("n")).first()
    steps = math.floor(math.log(most / max(least, 1), factor)) + 1 if most else 0
    pointer = rows.where("form is not null").select("back", F.col("form.back").alias("to"))
    done = 1
    while done < steps:
        further = pointer.select(F.col("back").alias("to"), F.col("to").alias("beyond"))
        pointer = kept(pointer.join(further, "to", "left").select("back", F.coalesce("beyond", "to").alias("to")))
        done *= 2
    named = rows.select(F.col("back").alias("to"), "word")
    roots = pointer.join(named.withColumnRenamed("word", "root"), "to").select("back", "root")
    forms = rows.where("form is not null").select("back", F.col("form.back").alias("to"))
    forms = forms.join(named.withColumnRenamed("word", "form_word"), "to").select("back", "form_word")
    out = rows.join(forms, "back", "left").join(roots, "back", "left")
    return out.select(
        "word",
        F.col("form_word").alias("form"),
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.col("form.n").alias("form_n"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    found = runs(documents(spark, folder, "doc_id", "text")).where(F.char_length("run") >= LEAST_LENGTH)
    return variants(counted(found.select(damaged(F.col("run"), F.col("doc_id")).alias("word"))))
