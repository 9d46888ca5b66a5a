"""Conversation repair next to a plain version that tries the edits in order of cost."""

import hashlib
import heapq
import random
import re
import zlib

import duckdb
import pyarrow as pa
import pytest

from barline.llm import conversations
from barline.llm.queries import QUERIES, SQL

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def filled(x):
    return " " if x is None else str(x)


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text, kind = filled(role), filled(text), zlib.crc32(f"{filled(conv)}:{filled(turn)}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        own = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not own else "duplicate" if (role, text) in seen else "truncated" if own[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows, kinds):
    """Cheapest first, then by audit; a script that reaches a state a second time is no better."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, said, left = heapq.heappop(heap)
        state = (i, said if len(said) < 2 and said != "a" else said[-1] + "+")
        if state in done:
            continue
        done.add(state)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", said):
            return cost, audit, left
        if i < len(rows):
            _, _, role, text = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, said, left))
            if kinds[i] not in ("blank", "duplicate"):
                more = 3 * (kinds[i] == "truncated")
                for letter, to, c in (("K", role, 0), ("R", "user", 3), ("R", "assistant", 3)):
                    if fits(said + to[:1]) and to:
                        heapq.heappush(heap, (cost + c + more, audit + letter, i + 1, said + to[:1], (*left, f"{to}:{text}")))
        for to in ("user", "assistant"):
            if fits(said + to[0]):
                heapq.heappush(heap, (cost + 3, audit + "I", i, said + to[0], (*left, f"{to}:")))
    raise AssertionError


def fits(said):
    return re.fullmatch("s?(ua)*u?", said) is not None


def plain(rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1], r[2], r[3]))
    kinds = faults(rows)
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    cost, audit, left = cheapest(rows, kinds)
    sha = hashlib.sha256("\n".join(left).encode()).hexdigest()
    return gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha


def by_conversation(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def random_rows(seed, conversations, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "no", "What? ", "", " \n", "Well!\t", "so,", "A.B", "é?", "x\x85"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "u", "", "sys", None]
    for conv in range(conversations):
        for turn in range(rng.randint(1, longest)):
            if rng.random() < 0.9:
                text = rng.choice(texts) if rng.random() < 0.5 else f"Line {rng.randint(0, 99)}."
                role = ["user", "assistant"][turn % 2] if rng.random() < 0.6 else rng.choice(roles)
                yield conv, rng.choice([turn, turn, turn, None, turn - 1]), role, rng.choice([text] * 9 + [None])


def result(df):
    assert df.columns == COLUMNS
    return sorted(((r[0], tuple(r[1:])) for r in df.collect()), key=str)


@pytest.mark.parametrize("bits", [0, 1, 12])
def test_summary_next_to_plain_version(spark, monkeypatch, bits):
    monkeypatch.setattr(conversations, "PIECE_BITS", bits)
    monkeypatch.setattr(conversations, "NODES", 64)
    rows = [*random_rows(bits, 150, 9), (None, 1, "user", "A."), (None, 2, "assistant", "B."), (None, None, None, None)]
    want = {c: plain([(c, t, filled(r), filled(x)) for c, t, r, x in own]) for c, own in by_conversation(rows).items()}
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert result(conversations.summary(df)) == sorted(want.items(), key=str)


def test_a_long_conversation_lies_in_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(conversations, "PIECE_BITS", 4)
    rows = [(7, t, r, x) for _, _, r, x in random_rows(21, 60, 9) for t in [random.Random(filled(x) + filled(r)).randint(0, 400)]]
    want = plain([(c, t, filled(r), filled(x)) for c, t, r, x in rows])
    assert result(conversations.summary(spark.createDataFrame(rows, SCHEMA).repartition(4))) == [(7, want)]


def test_repaired_messages_take_turns(spark):
    rows = list(random_rows(5, 80, 9))
    out = {}
    found = conversations.repaired(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", line string, piece int")).collect()
    for r in sorted(found, key=lambda r: (r.conv_id, r.line, r.nth)):
        out.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for c, own in by_conversation(rows).items():
        own = sorted([(c, t, filled(r), filled(x)) for c, t, r, x in own], key=lambda r: (r[1] is not None, r[1], r[2], r[3]))
        assert tuple(out.get(c, ())) == cheapest(own, faults(own))[2]


def test_query(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(10**6 + k, 0, "user", "Alone.") for k in range(60)] + [(None, None, None, "x" * 100_000), (None, 3, "user", None)]
    spark.createDataFrame(rows, SCHEMA).withColumnRenamed("text", "text").repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    left = by_conversation(plain_damage(rows))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    want = {c: plain(left[c]) if c in left else nothing for c in {r[0] for r in rows}}
    assert any(c not in left for c in want)
    assert result(QUERIES["op11_conversation_repair"](spark, str(tmp_path))) == sorted(want.items(), key=str)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert QUERIES["op11_conversation_repair"](spark, str(tmp_path)).collect() == []


def test_sql_next_to_plain_version():
    rows = [*random_rows(31, 200, 9), *((900 + k, 0, "user", "Alone.") for k in range(60)), (None, None, None, None), (None, 3, "user", "a.")]
    columns = zip(("conv_id", "turn", "role", "text"), (pa.int64(), pa.int64(), pa.string(), pa.string()), zip(*rows, strict=True), strict=True)
    con = duckdb.connect()
    con.register("conversations", pa.table({name: pa.array(values, kind) for name, kind, values in columns}))
    found = con.execute(SQL["op11_conversation_repair"])
    assert [d[0] for d in found.description] == COLUMNS
    left = by_conversation(plain_damage(rows))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    want = {c: plain(left[c]) if c in left else nothing for c in {r[0] for r in rows}}
    assert sorted(((r[0], tuple(r[1:])) for r in found.fetchall()), key=str) == sorted(want.items(), key=str)
