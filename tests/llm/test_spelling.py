"""Spelling variants next to a plain version that compares all words."""

import random
import re
import zlib
from collections import Counter

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barline.llm import spelling
from barline.llm.queries import QUERIES, SQL

LETTERS = "abcdeéß"


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    if len(a) == len(b):
        return a[k + 1 :] == b[k + 1 :]
    return a[k + 1 :] == b[k:] if len(a) > len(b) else a[k:] == b[k + 1 :]


def plain(counts, factor=5):
    forms, rows = {}, {}
    for w, n in counts.items():
        found = [u for u in counts if one_apart(w, u)]
        best = min(found, key=lambda u: (-counts[u], u), default=None)
        forms[w] = best if best is not None and counts[best] >= factor * n else None
        rows[w] = (n, len(found))
    out = []
    for w, (n, near) in rows.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n, near, counts.get(forms[w])))
    return sorted(out)


def plain_words(docs):
    counts = Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def result(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("seed", range(3))
def test_all_near_pairs(spark, seed):
    rng = random.Random(seed)
    words = {"".join(rng.choice(LETTERS[: 2 + 2 * seed]) for _ in range(rng.randint(1, 7))) for _ in range(400)}
    counts = {w: 5 ** rng.randint(0, 6) * rng.randint(1, 2) for w in words} | {"": 3, "aaaa": 4, "aaaaa": 700, "x" * 3000: 9, "x" * 2999: 50}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    assert result(spelling.variants(df)) == plain(counts)


def test_long_chains_of_forms(spark):
    counts = {"a" * k: 5**k for k in range(1, 12)}
    df = spark.createDataFrame(list(counts.items()), "word string, n int")
    got = result(spelling.variants(df))
    assert got == plain(counts) and {r[2] for r in got} == {"a" * 11}


def test_nodes_are_those_of_a_trie(spark, monkeypatch):
    rng = random.Random(9)
    words = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(600)]
    df = spark.createDataFrame([(w, 1) for w in set(words)], "word string, n long")
    for reverse in (False, True):
        prefixes = {}
        rows = spelling.numbered(df, reverse).collect()
        for r in rows:
            word = r.word[::-1] if reverse else r.word
            assert len(r.nodes) == len(word) + 1
            for k, node in enumerate(r.nodes):
                assert prefixes.setdefault(word[:k], node) == node
        assert len(set(prefixes.values())) == len(prefixes)
        if not reverse:
            assert [r.word for r in sorted(rows, key=lambda r: r.place)] == sorted(set(words))


def test_query_next_to_plain_version(spark, folder, edges):
    rng = random.Random(4)
    words = [w for w in ("Étoile", "étoile", "letters", "letter", "leter's", "ÿÿÿÿÿÿ", "strasse", "straße", "planets", "PLANETS", "planet")]
    docs = [(k if k % 7 else None, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for k in range(300)]
    at = folder(docs=[*docs, *edges, docs[1], docs[1]])
    assert result(QUERIES["op12_spelling_variants"](spark, at)) == plain(plain_words([*docs, *edges, docs[1], docs[1]]))


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert result(QUERIES["op12_spelling_variants"](spark, folder)) == plain(plain_words(docs))


def test_empty_tables_and_clashing_columns(spark, folder):
    assert QUERIES["op12_spelling_variants"](spark, folder()).collect() == []
    df = spark.createDataFrame([("abc", 1, "p", 2)], "word string, n long, form string, back long")
    assert result(spelling.variants(df)) == [("abc", None, "abc", 1, 0, None)]
    docs = spark.createDataFrame([(1, "ab CD", "r")], "doc_id long, text string, run string")
    assert [r.run for r in spelling.runs(docs).collect()] == ["ab", "cd"]
    assert spelling.runs(docs).select(F.count("*")).first()[0] == 2


def test_sql_next_to_plain_version():
    rng = random.Random(14)
    words = ["".join(rng.choice("aabé") for _ in range(rng.randint(5, 8))) for _ in range(60)]
    docs = [(k if k % 7 else None, " ".join(w.upper() if k % 2 else w for w in rng.choices(words, weights=range(1, 61), k=40))) for k in range(200)] + [(3, None), (4, "")]
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([d for d, _ in docs], pa.int64()), "text": pa.array([t for _, t in docs], pa.string())}))
    got = con.execute(SQL["op12_spelling_variants"]).fetchall()
    want = plain(plain_words(docs))
    assert sorted(map(tuple, got)) == want and any(r[1] for r in want)
