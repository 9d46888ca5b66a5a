"""The tokenizer's own library gives the ids to match."""

import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from barline.llm import bytebpe
from barline.llm.queries import QUERIES


@pytest.fixture(scope="module")
def vocabulary():
    return bytebpe.vocabulary()


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def random_texts(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        yield "".join(chr(rng.choice([rng.randint(0, 127), rng.randint(0, 0x2FFF), rng.randint(0x1F000, 0x1FFFF)])) for _ in range(rng.randint(0, 200)))
        yield "".join(rng.choice("abcdeèst  \n'.0") for _ in range(rng.randint(1, 500)))


def test_ids_equal_the_library(vocabulary, library):
    texts = [*random_texts(3, 200), "x" * 20000, "ab" * 4000, " " * 999 + "y", "日本語" * 700, "a'lls 's  'll", "<|endoftext|>", "a \x1cb \x85c \xa0d"]
    assert bytebpe.encode_batch(pa.array(texts), vocabulary).to_pylist() == [library.encode_ordinary(t) for t in texts]


def test_every_code_point(vocabulary, library):
    texts = [f" a{chr(c)}1{chr(c)} b" for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    assert bytebpe.encode_batch(pa.array(texts), vocabulary).to_pylist() == library.encode_ordinary_batch(texts)


@pytest.mark.parametrize("long", [1, 8, 1 << 30])
def test_both_kinds_of_trees_agree(vocabulary, library, monkeypatch, long):
    monkeypatch.setattr(bytebpe, "LONG", long)
    texts = list(random_texts(5, 40))
    assert bytebpe.encode_batch(pa.array(texts), vocabulary).to_pylist() == [library.encode_ordinary(t) for t in texts]


def test_parts_of_a_batch(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bytebpe, "PIECE_BYTES", 100)
    monkeypatch.setattr(bytebpe, "TREE_BYTES", 64)
    texts = [None, "", *random_texts(6, 30), None]
    got = bytebpe.encode_batch(pa.array(texts, pa.string()).slice(1), vocabulary).to_pylist()
    assert got == [None if t is None else library.encode_ordinary(t) for t in texts[1:]]


def test_a_small_vocabulary_takes_the_leftmost_of_equal_pairs():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"ab": 257, b"aaaa": 258}
    v = bytebpe.Vocabulary(ranks, public_tokenizers.PATTERN)
    assert bytebpe.encode_batch(pa.array(["aaaaa", "aaab", "ba"]), v).to_pylist() == [[258, 97], [256, 257], [98, 97]]
    with pytest.raises(ValueError):
        bytebpe.Vocabulary({b"a": 0}, "x")
    with pytest.raises(ValueError):
        bytebpe.decoded(np.array([300]), v)


def test_encode_and_decode_tables(spark, vocabulary, edges):
    docs = spark.createDataFrame([(d, t, [1], "x") for d, t in edges], "doc_id long, text string, ids array<int>, decoded string")
    back = bytebpe.decode(bytebpe.encode(docs, vocabulary), vocabulary)
    assert back.columns == docs.columns
    rows = back.select((F.col("decoded").eqNullSafe(F.col("text"))).alias("same"), F.isnull("ids").alias("none"), F.isnull("text").alias("null")).collect()
    assert len(rows) == len(edges) and all(r.same and r.none == r.null for r in rows)


def test_query(spark, folder, edges, library):
    at = folder(docs=[*edges, edges[6]])
    rows = QUERIES["op13_byte_bpe"](spark, at).collect()

    def digest(d, text):
        ids = library.encode_ordinary(text or "")
        packed = struct.pack(f"<{len(ids)}I", *ids)
        return d, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()

    assert sorted(map(tuple, rows), key=str) == sorted((digest(*e) for e in [*edges, edges[6]]), key=str)


def test_query_of_an_empty_table(spark, folder):
    assert QUERIES["op13_byte_bpe"](spark, folder()).collect() == []
