"""Fingerprints, repeated strings and near duplicates against plain versions."""

import hashlib
import random
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import xxhash
from pyspark.sql import functions as F

from barline.llm import neardup, repeats, syncmers

WORDS = [a + b for a in ("ka", "lo", "mi", "ra", "tu", "ve", "zo", "pi") for b in ("n", "sto", "rel", "d", "mash", "q")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def near_copies(rng, n=60, words=80, edits=4):
    base = prose(rng, words).split()
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = rng.choice(WORDS)
        out.append(" ".join(w))
    return out


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_edited_texts_and_fingerprints(spark, folder, edges):
    docs = [(d, t) for d, t in edges if d is not None]
    got = {r.doc_id: r for r in syncmers.query(spark, folder(edges)).collect()}
    order = sorted(docs, key=lambda x: -x[0])
    for k, (d, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        assert got[d].n_chars == len(t)
        assert got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[d].near_edited <= 1 and 0 <= got[d].near_next <= 1
        assert (got[d].fingerprint == "") == (not t.strip(" \n\t"))
        if edited == t:
            assert got[d].fingerprint == got[d].edited_fingerprint and got[d].near_edited == 1
    assert got[7].fingerprint == got[8].fingerprint != got[9].fingerprint
    assert got[8].near_next == 1.0
    assert got[None].n_chars == len(edges[9][1])


def plain_hash(*parts):
    """Spark's xxhash64 of strings and longs."""
    seed = 42
    for p in parts:
        raw = p.encode() if isinstance(p, str) else struct.pack("<q", p)
        seed = xxhash.xxh64_intdigest(raw, seed=seed)
    return seed - (1 << 64) if seed >> 63 else seed


def plain_form(letters, s, k):
    """{anchor: place} of all closed syncmers of a form."""
    if not letters:
        return {}
    h = [plain_hash(x) for x in letters]

    def smer(i, n):
        return h[i] if n == 1 else plain_hash(smer(i, n // 2), smer(i + n // 2, n // 2))

    out = {}
    for i in range(len(h) - k + 1):
        sub = [smer(j, s) for j in range(i, i + k - s + 1)]
        if min(sub) in (sub[0], sub[-1]):
            out.setdefault(plain_hash(plain_hash(sub[0], sub[-1]), sub[s]), i + 1)
    return out or {plain_hash(*h): 1}


def plain_print(text):
    words = (text or "").strip(" \t\n").split()
    cut = [x for w in words for x in (w if len(w) > 24 or len(w.encode()) > 2 * len(w) else [w])]
    short = len((text or "").strip(" \t\n")) <= 512
    return plain_form(cut, 2, 5), plain_form(list(" ".join(words)), 4, 12) if short else None


def plain_likeness(a, b):
    one, two = (a[1], b[1]) if a[1] is not None and b[1] is not None else (a[0], b[0])
    both = sorted(set(one) | set(two))[:128]
    return len([x for x in both if x in one and x in two]) / len(both) if both else 1.0


CHINESE = [chr(k) for k in range(0x4E00, 0x4E00 + 800)]


def test_fingerprints_and_likeness_against_a_plain_version(spark):
    rng = random.Random(3)
    texts = [None, "", " \n", "one", "a b c d", "x" * 700, "short text of eight words is all here", prose(rng, 40), prose(rng, 120)]
    texts += [prose(rng, 9) + " " + "".join(rng.choice("abcdef") for _ in range(300)), "".join(rng.choices(CHINESE, k=600))]
    texts += ["".join(rng.choices(CHINESE, k=40)) + "\n\t" + prose(rng, 30), prose(rng, 120) + "\U0001f600 " * 3]
    rows = [(k, a, b) for k, (a, b) in enumerate((a, b) for a in texts for b in (a, rng.choice(texts)))]
    df = spark.createDataFrame(rows, "k int, a string, b string")
    df = syncmers.fingerprint(syncmers.fingerprint(df, "a", "p"), "b", "q")
    for r in df.withColumn("near", syncmers.likeness("p", "q")).collect():
        own, other = plain_print(r.a), plain_print(r.b)
        assert list(r.p_words) == sorted(own[0])[:128] and (r.p_chars is None) == (own[1] is None)
        assert list(r.p_word_places) == [own[0][x] for x in r.p_words]
        if r.p_chars is not None:
            assert list(r.p_chars) == sorted(own[1])[:128] and list(r.p_char_places) == [own[1][x] for x in r.p_chars]
        assert r.near == pytest.approx(plain_likeness(own, other))


def test_an_edit_moves_only_its_own_anchors(spark):
    rng = random.Random(1)
    w = prose(rng, 400).split()
    chinese, few = "".join(rng.choices(CHINESE, k=400)), prose(rng, 9)
    parts = [prose(rng, 20) for _ in range(8)]
    pairs = [
        (0, " ".join(w), " ".join([*w[:200], "edit", *w[201:]])),
        (1, " ".join(w), prose(rng, 400)),
        (2, chinese, chinese[:200] + "".join(rng.choices(CHINESE, k=200))),
        (3, few, few[: len(few) - len(few) // 2] + prose(rng, 9)[: len(few) // 2]),
        (4, " ".join(parts), " ".join(parts)),
        (5, " ".join(parts), " ".join(reversed(parts))),
    ]
    df = spark.createDataFrame(pairs, "k long, a string, b string")
    df = syncmers.fingerprint(syncmers.fingerprint(df, "a", "p"), "b", "q")
    got = df.select("k", syncmers.likeness("p", "q").alias("near"), syncmers.in_order("p", "q").alias("order")).orderBy("k").collect()
    near, order = [r.near for r in got], [r.order for r in got]
    assert near[0] > 0.85 and near[1] < 0.1 and 0.2 < near[2] < 0.6 and 0.1 < near[3] < 0.6
    assert near[4] == order[4] == 1.0 and near[5] < 1.0 and order[5] < 1.0


def test_the_next_document_of_repeated_ids(spark, folder):
    """Nulls come first among rows of one id, inside a group of ids and across groups."""
    got = syncmers.query(spark, folder([(1, None), (1, "b" * 8), (5000, "c" * 8), (5000, None), (9000, "d" * 8)])).collect()
    want = {"d" * 8: "", "c" * 8: "", "b" * 8: "dddd"}
    for t, after in want.items():
        edited = hashlib.sha256((t[: 8 - 8 // 2] + after).encode()).hexdigest()
        assert edited in [r.edited_sha256 for r in got], t


def test_order_reaches_over_groups_of_ids(spark, folder):
    ids = sorted({k * k * 7919 - 3 * 10**6 for k in range(60)} | {2**50, -(2**50)})
    got = {r.doc_id: r.edited_sha256 for r in syncmers.query(spark, folder([(d, f"text of {d} here") for d in ids])).collect()}
    for k, d in enumerate(ids):
        t, after = f"text of {d} here", f"text of {ids[k - 1]} here"
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        assert got[d] == hashlib.sha256(edited.encode()).hexdigest()


def test_native_plan(spark, folder):
    text = syncmers.query(spark, folder([(1, "a b c d e f")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in text for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


@pytest.mark.parametrize("hot", [1, 32])
def test_repeated_strings_against_a_dictionary(spark, folder, edges, monkeypatch, hot):
    rng = random.Random(hot)
    passage = prose(rng, 30)
    docs = edges + [(100 + k, prose(rng, rng.randint(0, 40)) + passage + prose(rng, rng.randint(0, 40))) for k in range(60)]
    docs += [(200 + k, t) for k, t in enumerate(near_copies(rng, 20))] + [(300, "ab" * 400), (301, "ab" * 300), (302, passage[:49]), (303, passage[:50])]
    docs += [(7, PART := passage[:70]), (304, PART)]
    monkeypatch.setattr(repeats, "HOT", hot)
    got = repeats.query(spark, folder(docs))
    assert sorted(rows(got), key=repr) == sorted(repeats.brute(docs), key=repr)


def test_runs_cut_by_segments_change_nothing(spark, folder, monkeypatch):
    rng = random.Random(5)
    docs = [(k, t) for k, t in enumerate(near_copies(rng, 12, 200))] + [(50, prose(rng, 900))]
    monkeypatch.setattr(repeats, "SEGMENT", 128)
    assert sorted(rows(repeats.query(spark, folder(docs)))) == sorted(repeats.brute(docs))


FEW = ["kal ", "ost ", "mir ", "tun ", "vez ", "pix "]


def few_words(rng, n):
    return "".join(rng.choice(FEW) for _ in range(n))


@pytest.mark.parametrize("hot", [1, 32])
def test_passages_amid_anchors_that_repeat_by_chance(spark, folder, monkeypatch, hot):
    """Passages of one window and more, so that of a run only windows on one side of its anchor repeat."""
    rng = random.Random(10 + hot)
    docs = []
    for k in range(60):
        whole = few_words(rng, 40)
        at = rng.randrange(60)
        passage = whole[at : at + rng.randint(49, 90)]
        docs += [(2 * k, few_words(rng, rng.randint(0, 30)) + passage + few_words(rng, rng.randint(0, 30))), (rng.choice([2 * k + 1, 2 * k]), few_words(rng, rng.randint(0, 30)) + passage)]
    docs += [(None, docs[5][1] + "end"), (500, docs[8][1]), (501, None), (501, docs[9][1][1:])]
    monkeypatch.setattr(repeats, "HOT", hot)
    got = rows(repeats.query(spark, folder(docs)))
    assert sorted(got, key=repr) == sorted(repeats.brute(docs), key=repr)
    assert sum(0 < r[2] < r[1] for r in got) > 20


class Steps:
    """The steps of op 5 one after the other, without Spark."""

    def __init__(self, docs, ranges=3, chunks=4):
        def of(table, column, n):
            return [table.filter(pc.equal(table.column(column), k)) for k in range(n)]

        ids = pa.array([repeats.LAST if d is None else d for d, _ in docs], pa.int64())
        chunk = pa.array([hash(d) % chunks for d, _ in docs], pa.int32())
        batch = pa.RecordBatch.from_pydict({"id": ids, "text": pa.array([t for _, t in docs], pa.string()), "chunk": chunk})
        cuts = np.array([b"m", b"p"], f"S{repeats.LENGTH}")
        texts = of(pa.Table.from_batches([*repeats._dealt([batch.slice(0, 50)]), *repeats._dealt([batch.slice(50)])]), "chunk", chunks)
        none = repeats._message([])
        self.sent = pa.concat_tables(repeats._send_fingerprints(ranges)(t, none) for t in texts)
        self.answers = pa.concat_tables([none, *(repeats._repeated(t) for t in of(self.sent, "place", ranges) if t.num_rows)])
        self.records = pa.concat_tables(repeats._send_records(ranges, cuts)(t, a) for t, a in zip(texts, of(self.answers, "chunk", chunks), strict=True))
        self.verdicts = pa.concat_tables([none, *(repeats._judge(t) for t in of(self.records, "place", ranges) if t.num_rows)])
        cut = pa.concat_tables(repeats._cut(ranges, cuts, False)(t, v) for t, v in zip(texts, of(self.verdicts, "chunk", chunks), strict=True))
        self.rows = [tuple(r.values()) for r in cut.drop_columns(["kept"]).to_pylist()]


@pytest.mark.parametrize(("hot", "segment", "windows"), [(32, 1 << 18, 1 << 20), (1, 1 << 18, 1), (2, 128, 50), (32, 100, 300)])
def test_steps_against_a_dictionary(edges, monkeypatch, hot, segment, windows):
    for name, value in (("HOT", hot), ("SEGMENT", segment), ("WINDOWS", windows)):
        monkeypatch.setattr(repeats, name, value)
    for seed in range(6):
        rng = random.Random(seed)
        docs = [(k, t) for k, t in enumerate(near_copies(rng, 30, 60))] + edges
        for k in range(40):
            passage = few_words(rng, 30)[rng.randrange(4) :][: rng.randint(49, 90)]
            docs += [(rng.choice([100 + k, 100, None]), few_words(rng, rng.randint(0, 20)) + passage + few_words(rng, rng.randint(0, 20))) for _ in range(rng.randint(1, 4))]
        assert sorted(Steps(docs).rows, key=repr) == sorted(repeats.brute(docs), key=repr)


def test_anchors_that_repeat_by_chance_are_not_sent():
    """Most 20-byte strings of these texts are in two of them, hardly any 50-byte string is: no records are sent for the former."""
    rng = random.Random(4)
    docs = [(k, few_words(rng, 400)) for k in range(120)]
    grams = [g for _, t in docs for g in {t[k : k + 20] for k in range(0, len(t) - 19, 4)}]
    assert len(set(grams)) < 0.6 * len(grams)
    steps = Steps(docs)
    assert sorted(steps.rows) == sorted(repeats.brute(docs))
    payload = steps.records.filter(pc.equal(steps.records.column("kind"), repeats.RECORDS)).column("payload").to_pylist()
    assert sum(map(len, payload)) < 0.1 * sum(len(t) for _, t in docs)
    assert sum(map(len, steps.answers.column("payload").to_pylist())) < 0.1 * sum(map(len, steps.sent.column("payload").to_pylist()))


def test_multikey_order():
    rng = random.Random(2)
    data = np.frombuffer("".join(rng.choice("ab") for _ in range(500)).encode(), np.uint8)
    at = np.arange(480)
    order, group = repeats.multikey_order(data, at, 20)
    raw = [bytes(data[k : k + 20]) for k in at]
    assert [raw[k] for k in order] == sorted(raw)
    assert all((raw[a] == raw[b]) == (x == y) for a, b, x, y in zip(order, order[1:], group, group[1:]))


def expected(docs):
    return {d: v for d, v in neardup.brute({d: t for d, t in docs}).items()}


@pytest.mark.parametrize("block", [16, 2048])
def test_near_duplicates_against_all_pairs(spark, folder, edges, monkeypatch, block):
    rng = random.Random(block)
    docs = [(d, t) for d, t in edges if d is not None]
    docs += [(100 + k, t) for k, t in enumerate(near_copies(rng, 120, 80, 5))]
    docs += [(400 + k, t) for k, t in enumerate(near_copies(rng, 40, 12, 1))] + [(500 + k, prose(rng, 60)) for k in range(30)]
    docs += [(600 + k, docs[20][1]) for k in range(20)]
    monkeypatch.setattr(neardup, "BLOCK", block)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.query(spark, folder(docs)).collect()}
    assert got == expected(docs)
    assert len({v[1] for v in got.values()}) < len(docs) - 60


def test_documents_without_id_and_repeated_rows(spark, folder, edges):
    got = rows(neardup.query(spark, folder([*edges, (7, edges[6][1])])))
    assert len(got) == len(edges) + 1
    assert [r for r in got if r[0] is None] == [(None, 17, None, True)]
    seven = [r for r in got if r[0] == 7]
    assert len(seven) == 2 and seven[0] == seven[1]


def test_deduplicated_keeps_columns_and_one_of_each_group(spark, folder):
    rng = random.Random(3)
    texts = near_copies(rng, 10, 100, 1)
    df = spark.createDataFrame([(k, t, k, "x", "y") for k, t in enumerate(texts)], "doc_id long, text string, root long, key string, rep string")
    out = neardup.deduplicated(df)
    want = {d for d, v in neardup.brute(dict(enumerate(texts))).items() if v[2]}
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} == want


def test_least_similarity_is_an_argument(spark, folder):
    rng = random.Random(11)
    docs = []
    for k in range(40):
        w = prose(rng, 104).split()
        # Two replaced words, far apart: 90 of 110 shingles are shared, a similarity of 0.818.
        docs += [(2 * k, " ".join(w)), (2 * k + 1, " ".join([*w[:20], "edit", *w[21:70], "edit", *w[71:]]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.groups(df).collect()}
    assert got == neardup.brute(dict(docs), 0.8) and sum(v[2] for v in got.values()) == 40
    assert neardup.deduplicated(df).count() == 40 and neardup.deduplicated(df, least=0.85).count() == 80
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.query(spark, folder(docs)).collect()} == neardup.brute(dict(docs))


def test_bands_follow_from_the_least_similarity():
    assert (neardup.bands_for(0.85), neardup.bands_for(0.8), neardup.bands_for(1)) == (24, 35, 1)
    assert all((1 - s**neardup.ROWS) ** neardup.bands_for(s) <= neardup.MISSED for s in (0.5, 0.7, 0.8, 0.85, 0.9))
    with pytest.raises(ValueError):
        neardup.bands_for(0)


def test_forest_joins_what_can_be_joined():
    far = np.full((6, 6), neardup.SKETCH_BITS + 1)
    for a, b, d in ((0, 1, 5), (1, 2, 5), (0, 2, 5), (3, 4, 1)):
        far[a, b] = far[b, a] = d
    i, j = neardup.forest(far, np.arange(6))
    assert len(i) == 3 and {(3, 4)} < set(zip(i.tolist(), j.tolist()))


def test_sketches_bound_linked_pairs():
    rng = np.random.default_rng(0)
    for n in (30, 150, 600, 4000):
        for _ in range(30):
            base = rng.integers(1, 2**63, n, np.uint64)
            k = int(n * 0.081)  # replaced in one of two sets: similarity 0.85
            other = np.concatenate([base[k:], rng.integers(1, 2**63, k, np.uint64)])
            a, b = np.unique(base), np.unique(other)
            (x, u), (y, v) = neardup.odd_sketch(a), neardup.odd_sketch(b)
            bits = int(np.unpackbits(x ^ y).sum())
            assert bits <= neardup.farthest(np.array([len(a) + len(b)]), np.array([u + v]))[0]


def test_empty_tables(spark, folder):
    empty = folder()
    for module in (syncmers, repeats, neardup):
        assert module.query(spark, empty).count() == 0


def test_components(spark):
    pairs = [(k, k + 1) for k in range(40)] + [(100, 101), (102, 101)]
    got = neardup.components(spark.createDataFrame(pairs, "a long, b long"))
    want = {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}
    assert {r.node: r.root for r in got.collect()} == want
    assert got.where(F.col("node").isNull()).count() == 0
