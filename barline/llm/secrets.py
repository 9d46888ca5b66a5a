"""Secret scan: fixed patterns, and probabilistic automata inferred from labelled credentials.

The fixed patterns find assignments, access keys and hex strings. What they find, all over the
corpus, serves as labelled credentials: all distinct values, one set per pattern, run as words of
character classes through an automaton that starts as one state. In rounds, Spark counts what follows
every state and every move that has no target yet; such a move leads to the first statistically
compatible state (a Hoeffding bound on the frequencies of up to LOOK symbols ahead), or to a new one, until no
move is open. This folds the prefix tree of all values without building it. Every
other candidate token of every text is then scored by the automata against a model of ordinary
tokens, the class bigrams of all tokens of all texts, and those that read like a credential are added as spans of kind `format`.

Defined cases: a null or empty text has no spans; equal texts have equal spans; a corpus without
labelled credentials gives no automaton, so only the fixed patterns count; an empty table gives an
empty result. Equal values, and equal texts, are learned from once. Extra columns pass through `scan` untouched; its result column can be renamed.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field
from math import log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.llm.common import documents, kept
from barline.llm.words import flat, pieces

KINDS = ["assign", "access", "hex", "format"]
FORMAT = KINDS.index("format")

# The patterns of the base scan and the shortest value each may have.
ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST = 8

# An ordinary or secret token; the automata judge those at least as long as the shortest labelled value.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % ASSIGN_LEAST)
TOKEN = re.compile(r"[A-Za-z0-9+/_=.-]+")

LOOK = 4  # symbols ahead of a state that its test compares
LEAST_ARRIVALS = 8  # what follows fewer arrivals is not compared
ALPHA = 0.05
LEAST_GAIN = 0.25
BINS = 1024

SPANS = "array<struct<kind:int,start:int,stop:int>>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in code points."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


_CLASS = {c: "d" for c in "0123456789"} | {c: "h" for c in "abcdef"} | {c: "H" for c in "ABCDEF"}
_CLASS |= {c: "l" for c in "ghijklmnopqrstuvwxyz"} | {c: "U" for c in "GHIJKLMNOPQRSTUVWXYZ"}
_CLASSES = str.maketrans(_CLASS)


def shape(token: str) -> str:
    """A token as character classes; punctuation stands for itself."""
    return token.translate(_CLASSES)


END = "$"
Moves = list[dict[str, int]]  # per state the target of each symbol


def ahead(word: str, at: int) -> str:
    """The LOOK symbols of a word from a place on, END being its last."""
    return word[at : at + LOOK] + (END if at + LOOK > len(word) else "")


def visits(word: str, moves: Moves):
    """(state, symbol of an open move or "", symbols ahead) along a word's way, up to its end or the first open move."""
    at = 0
    for k, c in enumerate(word):
        yield at, "", ahead(word, k)
        to = moves[at].get(c)
        if to is None:
            yield at, c, ahead(word, k + 1)
            return
        at = to
    yield at, "", END


class Tree:
    """Arrivals by the symbols ahead, up to LOOK of them."""

    def __init__(self):
        self.n: dict[str, int] = {}
        self.after: dict[str, set[str]] = {}

    def add(self, symbols: str, n: int) -> None:
        self.n[""] = self.n.get("", 0) + n
        for k, c in enumerate(symbols):
            self.after.setdefault(symbols[:k], set()).add(c)
            self.n[symbols[: k + 1]] = self.n.get(symbols[: k + 1], 0) + n

    def alike(self, other: Tree) -> bool:
        """Hoeffding test on the end and move frequencies of two states and of what follows them."""
        todo = [""]
        while todo:
            w = todo.pop()
            na, nb = self.n.get(w, 0), other.n.get(w, 0)
            if not na or not nb:
                continue
            bound = sqrt(0.5 * log(2 / ALPHA)) * (1 / sqrt(na) + 1 / sqrt(nb))
            for c in {*self.after.get(w, ()), *other.after.get(w, ())}:
                ca, cb = self.n.get(w + c, 0), other.n.get(w + c, 0)
                if abs(ca / na - cb / nb) > bound:
                    return False
                if len(w) + 1 < LOOK and c != END and min(ca, cb) >= LEAST_ARRIVALS:
                    todo.append(w + c)
        return True

    def fold(self, other: Tree) -> None:
        for w, n in other.n.items():
            self.n[w] = self.n.get(w, 0) + n
        for w, cs in other.after.items():
            self.after.setdefault(w, set()).update(cs)


Table = list[tuple[dict[str, tuple[int, float]], float]]


def table(moves: Moves, trees: list[Tree]) -> Table:
    """Per state: target and log probability by symbol, and log probability of the end; add-half smoothed."""
    out = []
    for to, tree in zip(moves, trees, strict=True):
        total = tree.n[""] + 0.5 * (len(to) + 2)
        out.append(({c: (t, log((tree.n.get(c, 0) + 0.5) / total)) for c, t in to.items()}, log((tree.n.get(END, 0) + 0.5) / total)))
    return out


def merged(kinds: list[int], counted: Callable[[dict[int, Moves]], dict[tuple[int, int, str, str], int]]) -> list[Table]:
    """The automaton of each kind; `counted` gives for automata how often all words make each of their `visits`.

    In every round the open moves, in order of state and symbol, are led to the first compatible state or to a new one.
    """
    moves: dict[int, Moves] = {k: [{}] for k in kinds}
    tables: dict[int, Table] = {}
    while len(tables) < len(moves):
        found: dict[int, dict[tuple[int, str], Tree]] = {k: {} for k in moves if k not in tables}
        for (kind, state, symbol, symbols), n in counted({k: moves[k] for k in found}).items():
            found[kind].setdefault((state, symbol), Tree()).add(symbols, n)
        for kind, trees in found.items():
            mine = moves[kind]
            known = [trees.get((k, ""), Tree()) for k in range(len(mine))]
            waiting = sorted(at for at in trees if at[1])
            if not waiting:
                tables[kind] = table(mine, known)
            for state, c in waiting:
                tree = trees[state, c]
                same = next((k for k, t in enumerate(known) if t.alike(tree)), None)
                if same is None:
                    same = len(known)
                    known.append(tree)
                    mine.append({})
                else:
                    known[same].fold(tree)
                mine[state][c] = same
    return [tables[k] for k in sorted(tables)]


UNSEEN = log(1e-3)


def likelihood(table, word: str) -> float:
    """Log probability of a word; a symbol without a move costs UNSEEN and stays in the state."""
    at, total = 0, 0.0
    for c in word:
        to, p = table[at][0].get(c, (at, UNSEEN))
        total += p
        at = to
    return total + table[at][1]


@dataclass
class Model:
    automata: list  # tables of the formats
    ordinary: dict  # log probability of a class after a class
    threshold: float  # least gain per character
    shortest: int = ASSIGN_LEAST  # characters of the shortest labelled value
    known: dict = field(default_factory=dict)  # gains of shapes seen

    def gain(self, token: str) -> float:
        """Best log-likelihood ratio to ordinary tokens, per character."""
        word = shape(token)
        if word not in self.known:
            if len(self.known) >= 1 << 16:
                self.known.clear()
            self.known[word] = self.word_gain(word)
        return self.known[word]

    def word_gain(self, word: str) -> float:
        plain = sum(self.ordinary.get(p, UNSEEN) for p in zip("^" + word, word + "$", strict=True))
        return max((likelihood(t, word) for t in self.automata), default=-1e9) / len(word) - plain / len(word)


def ordinary(pairs: dict[str, int]) -> dict[tuple[str, str], float]:
    """Log probability of a class after a class."""
    firsts = Counter()
    for p, n in pairs.items():
        firsts[p[0]] += n
    return {(p[0], p[1]): log((n + 0.5) / (firsts[p[0]] + 10)) for p, n in pairs.items()}


def learned(values: dict[int, list[str]], tokens: list[str]) -> Model | None:
    """Automata of the labelled values by kind, and class bigrams of ordinary tokens, from lists at hand."""
    words = Counter((kind, shape(v)) for kind, vs in values.items() for v in vs)
    if not words:
        return None

    def counted(moves):
        out = Counter()
        for (kind, word), n in words.items():
            for visit in visits(word, moves[kind]) if kind in moves else ():
                out[(kind, *visit)] += n
        return out

    pairs = Counter(a + b for t in tokens for a, b in zip("^" + shape(t), shape(t) + END, strict=True))
    model = Model(merged(sorted(values), counted), ordinary(pairs), 0)
    seen = sorted(model.gain(v) for vs in values.values() for v in vs)
    model.threshold = max(LEAST_GAIN, seen[len(seen) // 100])
    model.shortest = min(len(word) for _, word in words)
    model.known.clear()
    return model


# Classes of bytes for the bigrams; 0 is what parts tokens.
_SYMBOLS = "^" + "".join(sorted({*_CLASS.values(), *"+/_=.-"}))
_CODES = np.zeros(256, np.uint8)
for _c in filter(TOKEN.fullmatch, map(chr, range(128))):
    _CODES[ord(_c)] = _SYMBOLS.index(shape(_c))
PAIRS = [a + b for a in _SYMBOLS for b in END + _SYMBOLS[1:]]


def pair_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How often each row of a piece has each of PAIRS in its tokens."""
    rows, size = len(offsets) - 1, len(_SYMBOLS)
    wide = np.zeros(len(data) + rows + 1, np.int64)
    row = np.repeat(np.arange(rows), np.diff(offsets) + 1)
    wide[1 + np.arange(len(data)) + np.repeat(np.arange(rows), np.diff(offsets))] = _CODES[data]
    out = np.bincount((row * size + wide[:-1]) * size + wide[1:], minlength=rows * size * size).reshape(rows, -1)
    out[:, 0] = 0
    return out


def _examples(batches):
    """(kind, key, counts): distinct labelled values; for `format` the digest of a text and its pair counts."""
    for batch in batches:
        found, texts = set(), batch.column(0)
        for text in texts.to_pylist():
            if text:
                for start, kind, end in base_spans(text):
                    m = ASSIGN.match(text, start) if kind == 0 else None
                    found.add((kind, (m[2] if m else text[start:end]).encode()))
        rows = [(kind, value, None) for kind, value in found]
        data, offsets = flat(texts)
        for _, _, piece, at in pieces(data, offsets):
            raw = piece.tobytes()
            for k, counts in enumerate(pair_counts(piece, at).astype(np.int32)):
                if counts.any():
                    digest = hashlib.blake2b(raw[at[k] : at[k + 1]], digest_size=16).digest()
                    rows.append((FORMAT, digest, counts.tobytes()))
        kinds = (pa.int32(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in rows], t) for c, t in enumerate(kinds)], ["kind", "key", "counts"])


def _words(batches):
    """(kind, word, n) of distinct examples: shapes of values; for `format` pairs of classes."""
    for batch in batches:
        found, total = Counter(), np.zeros(len(PAIRS), np.int64)
        for kind, key, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if counts is None:
                found[kind, shape(key.decode())] += 1
            else:
                total += np.frombuffer(counts, np.int32)
        found.update({(FORMAT, PAIRS[k]): int(total[k]) for k in np.flatnonzero(total)})
        rows = [(kind, word, n) for (kind, word), n in found.items()]
        kinds = (pa.int32(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in rows], t) for c, t in enumerate(kinds)], ["kind", "word", "n"])


MOST_VISITS = 1 << 18  # kinds of visits that a task counts before it hands them on


def _visited(moves: dict[int, Moves]):
    def told(found):
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.string())
        columns = [pa.array([x[c] for x in found], t) for c, t in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(found.values(), pa.int64())], ["kind", "state", "symbol", "symbols", "n"])

    def run(batches):
        found = Counter()
        for batch in batches:
            for kind, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for visit in visits(word, moves[kind]):
                    found[(kind, *visit)] += n
                if len(found) > MOST_VISITS:
                    yield told(found)
                    found.clear()
        yield told(found)

    return run


def nth_smallest(rows: DataFrame, at: int) -> float:
    """The value that `at` others precede in order; `rows` has values x and their counts n."""
    low, high = rows.agg(F.min("x"), F.max("x")).first()
    while low < high:
        place = F.least(F.floor((F.col("x") - low) / ((high - low) / BINS)), F.lit(BINS - 1))
        some = rows.where(F.col("x").between(low, high)).groupBy(place.alias("bin"))
        for r in sorted(some.agg(F.sum("n").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).collect()):
            if at < r.n:
                low, high = r.low, r.high
                break
            at -= r.n
    return low


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Model | None:
    """Learns the formats from all distinct values that the fixed patterns find, and ordinary tokens from all distinct texts."""
    found = (
        docs.select(text)
        .mapInArrow(_examples, "kind int, key binary, counts binary")
        .groupBy("kind", "key")
        .agg(F.first("counts").alias("counts"))
        .select("kind", "key", "counts")
        .mapInArrow(_words, "kind int, word string, n long")
        .groupBy("kind", "word")
        .agg(F.sum("n").alias("n"))
    )
    rows = kept(found)
    words = rows.where(F.col("kind") != FORMAT)
    facts = words.groupBy("kind").agg(F.sum("n").alias("n"), F.min(F.length("word")).alias("least")).collect()
    if not facts:
        return None

    def counted(moves):
        seen = words.where(F.col("kind").isin(list(moves))).mapInArrow(_visited(moves), "kind int, state int, symbol string, symbols string, n long")
        total = seen.groupBy("kind", "state", "symbol", "symbols").agg(F.sum("n").alias("n")).collect()
        return {(r.kind, r.state, r.symbol, r.symbols): r.n for r in sorted(total)}

    pairs = {r.word: r.n for r in sorted(rows.where(F.col("kind") == FORMAT).collect())}
    model = Model(merged(sorted(r.kind for r in facts), counted), ordinary(pairs), 0, min(r.least for r in facts))

    def gains(batches):
        for batch in batches:
            gain = [model.word_gain(w) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(gain, pa.float64()), batch.column(1)], ["x", "n"])

    seen = kept(words.select("word", "n").mapInArrow(gains, "x double, n long").groupBy("x").agg(F.sum("n").alias("n")))
    model.threshold = max(LEAST_GAIN, nth_smallest(seen, sum(r.n for r in facts) // 100))
    return model


def spans(text: str | None, model: Model | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all secrets, sorted; spans of kind `format` never touch the others."""
    if not text:
        return []
    out = base_spans(text)
    if model is None:
        return out
    more, at = [], 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        if end - start < model.shortest:
            continue
        while at < len(out) and out[at][2] <= start:
            at += 1
        if any(s < end and e > start for s, _, e in out[max(0, at - 3) : at + 8]):
            continue
        if model.gain(m[0]) >= model.threshold:
            more.append((start, FORMAT, end))
    return sorted(out + more) if more else out


def scan(docs: DataFrame, model: Model | None, text: str = "text", into: str = "spans") -> DataFrame:
    """Adds the spans of every whole text."""

    @F.arrow_udf(SPANS)
    def found(texts: pa.Array) -> pa.Array:
        rows = [spans(t, model) for t in texts.to_pylist()]
        kind = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())])
        return pa.array([[{"kind": k, "start": s, "stop": e} for s, k, e in row] for row in rows], pa.list_(kind))

    return docs.withColumn(into, found(F.col(text)))


def redact(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Texts with every secret replaced by [kind]; overlapping spans become one."""

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            found = spans(t, model)
            if found:
                parts, at = [], 0
                for start, kind, end in found:
                    if start >= at:
                        parts += [t[at:start], f"[{KINDS[kind]}]"]
                    at = max(at, end)
                t = "".join(parts) + t[at:]
            out.append(t)
        return pa.array(out, pa.string())

    return docs.withColumn(text, clean(F.col(text)))


def joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found)


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, "doc_id", "text")
    rows = scan(docs, fit(docs)).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s.kind < FORMAT)

    def told(c):
        names = F.array(*[F.lit(k) for k in KINDS])
        return F.array_join(F.transform(c, lambda s: F.concat_ws(":", names[s.kind], s.start.cast("string"), s.stop.cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return rows.select("doc_id", *[count(k) for k in range(FORMAT)], F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


def brute(text: str | None) -> dict:
    """The base part of the query's row for one text, for tests."""
    found = base_spans(text or "")
    n = [sum(k == j for _, k, _ in found) for j in range(FORMAT)]
    return {"n": n, "base_sha256": hashlib.sha256(joined(found).encode()).hexdigest()}
