"""Byte-level BPE: whole texts to token ids and back, each merge found in a segment tree.

A text is cut by the tokenizer's pattern; each match is coded by itself, as its UTF-8 bytes. A
match that is a token is that token. Otherwise every byte starts as a symbol, and the leaves of a
segment tree over the byte positions hold the rank of the pair that begins there, joined with the
position, so that the least value of the root is the lowest rank and, of equal ranks, the leftmost
pair. A merge writes three leaves: that of the new symbol, of the live symbol before it, and of the
position that is no symbol any more; the nodes above them follow, one a level. The rank of a pair
is the id of the token it becomes.

The distinct matches of some megabytes of text are coded once each. Matches of up to LONG bytes
share one array of trees and merge side by side, one merge each in a round; a longer one has a
tree of its own. Both cost a logarithm of the length for each merge.

Defined cases: a null text has null ids (the query: as an empty text), an empty one none; equal
texts have equal ids; no text makes a special token; ids of a null list decode to null, and bytes
that are no UTF-8 to U+FFFD. A column that has the name of an added one is replaced. A vocabulary
without all 256 bytes is refused, an id outside of it fails.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.llm.common import documents
from barline.llm.words import flat, pieces, taken

PIECE_BYTES = 1 << 24
TREE_BYTES = 1 << 20
LONG = 256
#: Where a match begins in any case, so that a text may be split there first.
BREAK = re.compile(r"(?= \S)")
NONE = np.iinfo(np.int64).max
SHIFT = 32


@dataclass
class Vocabulary:
    """Tokens by their bytes; `pattern` cuts a text, and must begin a match at each blank that something else follows."""

    ranks: dict[bytes, int]
    pattern: str
    pairs: np.ndarray = field(init=False)  # left id << 32 | right id, ascending
    joined: np.ndarray = field(init=False)  # the token of each pair
    byte_ids: np.ndarray = field(init=False)
    out_bytes: np.ndarray = field(init=False)
    out_at: np.ndarray = field(init=False)

    def __post_init__(self):
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("a vocabulary with all 256 bytes is needed")
        found = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    found[a << SHIFT | b] = rank
        self.pairs = np.array(sorted(found), np.int64)
        self.joined = np.array([found[p] for p in self.pairs.tolist()], np.int64)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        by_id = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            by_id[rank] = token
        self.out_bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.out_at = np.concatenate([[0], np.cumsum([len(t) for t in by_id])])

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token that each pair of ids becomes, NONE where there is none."""
        want = left << SHIFT | right
        at = np.minimum(np.searchsorted(self.pairs, want), len(self.pairs) - 1)
        return np.where(self.pairs[at] == want, self.joined[at], NONE)


def vocabulary(path: str | None = None, pattern: str | None = None) -> Vocabulary:
    """Reads a file of ranks on the driver; its size is that of the vocabulary."""
    import public_tokenizers

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, file))}
    return Vocabulary(ranks, pattern or public_tokenizers.PATTERN)


def _side_by_side(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of several byte strings of two or more bytes, each with a tree of the same size, and how many each has."""
    n, size = len(words), 1 << (max(map(len, words)) - 1).bit_length()
    lengths = np.array([len(w) for w in words])
    symbol = v.byte_ids[np.frombuffer(b"".join(w.ljust(size, b"\0") for w in words), np.uint8)]
    place = np.tile(np.arange(size), n)
    base = np.repeat(np.arange(n) * size, size)
    end = np.repeat(lengths, size)
    live = place < end
    after = np.where(place + 1 < end, place + 1, -1)  # places of the neighbours in the same word
    before = np.where(live, place - 1, -1)

    def leaves(at: np.ndarray) -> np.ndarray:
        """What the leaves of live symbols hold now."""
        out = np.full(len(at), NONE)
        some = np.flatnonzero(after[at] >= 0)
        a = at[some]
        rank = v.pair_ranks(symbol[a], symbol[base[a] + after[a]])
        out[some] = np.where(rank == NONE, NONE, rank << SHIFT | place[a])
        return out

    tree = np.full((n, 2 * size), NONE)
    first = np.full(n * size, NONE)
    first[live] = leaves(np.flatnonzero(live))
    tree[:, size:] = first.reshape(n, size)
    level = size
    while level > 1:
        tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level //= 2
    flat_tree = tree.reshape(-1)
    word = np.flatnonzero(tree[:, 1] != NONE)
    while len(word):
        top = tree[word, 1]
        at = word * size + (top & ((1 << SHIFT) - 1))
        gone = word * size + after[at]
        symbol[at] = top >> SHIFT
        live[gone] = False
        after[at] = after[gone]
        later = np.flatnonzero(after[at] >= 0)
        before[base[at[later]] + after[at[later]]] = place[at[later]]
        earlier = np.flatnonzero(before[at] >= 0)
        left = base[at[earlier]] + before[at[earlier]]
        changed = np.concatenate([at, left, gone])
        root = changed // size * (2 * size)
        node = size + place[changed]
        flat_tree[root + node] = np.concatenate([leaves(np.concatenate([at, left])), np.full(len(gone), NONE)])
        while node[0] > 1:
            node = node >> 1
            flat_tree[root + node] = np.minimum(flat_tree[root + 2 * node], flat_tree[root + 2 * node + 1])
        word = word[tree[word, 1] != NONE]
    return symbol[live], live.reshape(n, size).sum(1)


def _alone(word: bytes, v: Vocabulary) -> np.ndarray:
    """Ids of one long byte string; its tree lies in a list."""
    n, size = len(word), 1 << (len(word) - 1).bit_length()
    symbol = v.byte_ids[np.frombuffer(word, np.uint8)]
    rank = v.pair_ranks(symbol[:-1], symbol[1:])
    row = np.full(size, NONE)
    row[: n - 1] = np.where(rank == NONE, NONE, rank << SHIFT | np.arange(n - 1))
    rows = [row]
    while len(rows[-1]) > 1:
        rows.append(np.minimum(rows[-1][::2], rows[-1][1::2]))
    tree = [NONE, *np.concatenate(rows[::-1]).tolist()]
    symbol, after, before = symbol.tolist(), [*range(1, n), -1], list(range(-1, n - 1))
    own, none, by_id = v.ranks, int(NONE), {}

    def token(k: int) -> bytes:
        if k not in by_id:
            by_id[k] = v.out_bytes[v.out_at[k] : v.out_at[k + 1]].tobytes()
        return by_id[k]

    def leaf(i: int) -> int:
        j = after[i]
        got = own.get(token(symbol[i]) + token(symbol[j])) if j >= 0 else None
        return none if got is None else got << SHIFT | i

    def write(i: int, value: int) -> None:
        node = size + i
        tree[node] = value
        while node > 1:
            node >>= 1
            a, b = tree[2 * node], tree[2 * node + 1]
            best = a if a < b else b
            if tree[node] == best:
                break
            tree[node] = best

    while tree[1] != none:
        i = tree[1] & ((1 << SHIFT) - 1)
        j = after[i]
        symbol[i] = tree[1] >> SHIFT
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
        symbol[j] = -1
        write(j, none)
        write(i, leaf(i))
        if before[i] >= 0:
            write(before[i], leaf(before[i]))
    return np.array([s for s in symbol if s >= 0], np.int64)


def coded(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all byte strings in one array, and for each where its ids begin and how many they are."""
    tokens, sizes, values, found = [], defaultdict(list), [], []
    for k, word in enumerate(words):
        if word in v.ranks:
            tokens.append(k)
        elif word:
            sizes[(len(word) - 1).bit_length() if len(word) <= LONG else LONG].append(k)
    found.append((tokens, np.ones(len(tokens), np.int64)))
    values.append(np.array([v.ranks[words[k]] for k in tokens], np.int64))
    for k in sizes.pop(LONG, ()):
        values.append(_alone(words[k], v))
        found.append(([k], np.array([len(values[-1])])))
    for bits, rows in sizes.items():
        share = TREE_BYTES >> bits
        for first in range(0, len(rows), share):
            some = rows[first : first + share]
            ids, count = _side_by_side([words[k] for k in some], v)
            values.append(ids)
            found.append((some, count))
    begin, n = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    at = 0
    for rows, count in found:
        n[rows] = count
        begin[rows] = at + np.cumsum(count) - count
        at += int(count.sum())
    return np.concatenate(values), begin, n


def _encode_texts(texts: list[str | None], v: Vocabulary, cut: regex.Pattern) -> tuple[np.ndarray, np.ndarray]:
    """Ids of some texts, one after the other, and how many each has."""
    unit, match, matches = defaultdict(itertools.count().__next__), defaultdict(itertools.count().__next__), []
    found = []
    for text in texts:
        units = BREAK.split(text) if text else []
        found.append(np.fromiter(map(unit.__getitem__, units), np.int64, len(units)))
    for word in unit:
        matches.append([match[m] for m in cut.findall(word)])
    ids, begin, n = coded([m.encode() for m in match], v)
    # Ids of the distinct units, then those of the texts.
    parts = np.array([len(x) for x in matches], np.int64)
    kind = np.fromiter(itertools.chain.from_iterable(matches), np.int64, int(parts.sum()))
    n = n[kind]
    ids = taken(ids, begin[kind], n)
    total = np.concatenate([[0], np.cumsum(n)])
    last = np.cumsum(parts)
    begin, n = total[last - parts], total[last] - total[last - parts]
    kind = np.concatenate(found) if found else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(texts)), [len(x) for x in found])
    return taken(ids, begin[kind], n[kind]), np.bincount(row, n[kind], len(texts)).astype(np.int64)


def _parts(texts: pa.Array, v: Vocabulary) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    cut = regex.compile(v.pattern)
    for first, last, _, _ in pieces(*flat(texts), PIECE_BYTES):
        yield _encode_texts(texts.slice(first, last - first).to_pylist(), v, cut)


def encode_batch(texts: pa.Array, v: Vocabulary) -> pa.Array:
    """Ids of a batch of texts as list<int32>."""
    parts = list(_parts(texts, v))
    ids = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
    at = np.concatenate([[0], np.cumsum(np.concatenate([p[1] for p in parts]) if parts else [])])
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)), mask=texts.is_null())


def decoded(ids: np.ndarray, v: Vocabulary) -> bytes:
    """The bytes of a list of ids."""
    if len(ids) and not (0 <= ids.min() and ids.max() < len(v.out_at) - 1):
        raise ValueError("an id outside the vocabulary")
    return taken(v.out_bytes, v.out_at[ids], v.out_at[ids + 1] - v.out_at[ids]).tobytes()


def encode(docs: DataFrame, v: Vocabulary, text: str = "text", into: str = "ids") -> DataFrame:
    """Adds the ids of every whole text."""

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        return encode_batch(texts, v)

    return docs.withColumn(into, run(F.col(text)))


def decode(docs: DataFrame, v: Vocabulary, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Adds the text of every list of ids."""

    @F.arrow_udf("string")
    def run(lists: pa.Array) -> pa.Array:
        return pa.array([None if x is None else decoded(np.array(x, np.int64), v).decode("utf-8", "replace") for x in lists.to_pylist()], pa.string())

    return docs.withColumn(into, run(F.col(ids)))


def digests(docs: DataFrame, v: Vocabulary, text: str = "text", into: str = "digest") -> DataFrame:
    """Adds a struct of every text's number of ids, their SHA-256 and that of what they decode to; no ids are sent back."""

    @F.arrow_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def run(texts: pa.Array) -> pa.Array:
        n, of_ids, of_bytes = [], [], []
        for ids, counts in _parts(texts, v):
            n += counts.tolist()
            for mine in np.split(ids, np.cumsum(counts)[:-1]):
                of_ids.append(hashlib.sha256(mine.astype("<u4").tobytes()).hexdigest())
                of_bytes.append(hashlib.sha256(decoded(mine, v)).hexdigest())
        columns = [pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]
        return pa.StructArray.from_arrays(columns, ["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.withColumn(into, run(F.col(text)))


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    return digests(docs, vocabulary()).select("doc_id", "digest.*")
