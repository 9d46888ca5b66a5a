"""The SQL of the text operators against their plain versions."""

import random

import duckdb
import pyarrow as pa
import pytest

from barline.llm import neardup, repeats, sql


@pytest.fixture
def texts(edges):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(40)]
    passage = " ".join(rng.choice(words) for _ in range(30))
    base = [rng.choice(words) for _ in range(90)]
    more = [" ".join(rng.choice(words) for _ in range(20)) + passage for _ in range(6)]
    for k in range(8):
        changed = list(base)
        changed[rng.randrange(90)] = f"new{k}"
        more.append(" ".join(changed))
    return edges + list(enumerate(more, 100))


def answer(query, texts):
    con = duckdb.connect()
    ids, bodies = zip(*texts, strict=True) if texts else ((), ())
    con.register("documents", pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(bodies, pa.string())}))
    return sorted(con.execute(query).fetchall(), key=repr)


def test_repeats(texts):
    assert answer(sql.REPEATS, texts) == sorted(repeats.brute(texts), key=repr)
    assert answer(sql.REPEATS, []) == []


def test_near_duplicates(texts):
    known = [(i, t) for i, t in texts if i is not None]
    want = [(i, *v) for i, v in neardup.brute(dict(known)).items()]
    assert answer(sql.NEAR_DUPLICATES, known) == sorted(want, key=repr)
    assert answer(sql.NEAR_DUPLICATES, []) == []
