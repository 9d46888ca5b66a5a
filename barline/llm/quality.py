"""Quality classifier from weak labels.

LABELLERS look at one statistic each (symbols, capitals, repetition, ...) and vote good, bad or
abstain; they overlap, and none is trusted. The counts of all vote patterns over the whole corpus are
a table of at most 3 ** 8 rows, on which expectation-maximisation estimates each labeller's accuracy
and the share of bad texts. The posterior of a text's pattern is its label, and all labelled texts
train a linear scorer over hashed word shapes, which then judges every text alone: Newton steps on the logistic
loss, whose sums over the texts Spark takes. The `labels` table is not used.

Defined cases: a null or empty text, or one without words, has the lowest score, 0, and is
rejected; an empty corpus trains nothing and yields no rows; equal texts have equal scores.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.llm.common import documents, kept
from barline.llm.words import LOWER, SPACE, flat, mixed, pieces, span_hashes, spans_of

SHAPES = 256
SHRINK = 1e-4
LEAST_STEP = 1e-6  # a smaller Newton step is the last
SUMS = 16  # sums that reach the driver in each step
CHUNK = 2048
ROUNDS = 200
LEAST_SCORE = 0.5

_CLASS = np.zeros(256, np.uint8)  # word shapes: capitals X, other letters x, digits 9, everything else itself
_CLASS[:] = np.arange(256)
_CLASS[65:91] = ord("X")
_CLASS[97:123] = ord("x")
_CLASS[128:] = ord("x")
_CLASS[48:58] = ord("9")
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_ODD = np.zeros(256, bool)
_ODD[[k for k in range(33, 127) if not chr(k).isalnum() and chr(k) not in ".,;:'\"()-?"]] = True

STATISTICS = ["words", "odd", "capitals", "adjacent", "trigrams", "top", "plain", "distinct"]


def statistics(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row of a piece: STATISTICS, and shares of hashed word shapes."""
    rows = len(offsets) - 1
    low = LOWER[data]
    start, end, row = spans_of(~SPACE[data], offsets)
    n = np.bincount(row, minlength=rows)

    def by_row(flags):
        total = np.concatenate([[0], np.cumsum(flags)])
        return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)

    letters, size = by_row(_LETTER[data]), np.maximum(1, np.diff(offsets))
    words = span_hashes(low, start, end)
    begin = np.searchsorted(row, np.arange(rows + 1))
    same = np.concatenate([[False], (words[1:] == words[:-1]) & (row[1:] == row[:-1])])[: len(row)]
    many = np.maximum(1, n)
    # A plain word has no capital but its first letter and no odd byte.
    ups, odds = (np.concatenate([[0], np.cumsum(f[data])]) for f in (_UPPER, _ODD))
    plain = (ups[end] - ups[np.minimum(start + 1, end)] == 0) & (odds[end] - odds[start] == 0)
    out = np.zeros((rows, len(STATISTICS)))
    out[:, 0] = n
    out[:, 1] = by_row(_ODD[data]) / size
    out[:, 2] = by_row(_UPPER[data]) / np.maximum(1, letters)
    out[:, 3] = np.bincount(row, same, rows) / many
    out[:, 6] = np.bincount(row, plain, rows) / many
    for r in range(rows):
        w = words[begin[r] : begin[r + 1]]
        if len(w):
            _, c = np.unique(w, return_counts=True)
            out[r, 5], out[r, 7] = c.max() / len(w), len(c) / len(w)
        if len(w) > 2:
            t = mixed(w[:-2]) + np.uint64(3) * w[1:-1] + np.uint64(5) * w[2:]
            out[r, 4] = len(np.unique(t)) / len(t)
        else:
            out[r, 4] = 1
    shape = _CLASS[data]
    tail = span_hashes(shape, np.maximum(start, end - 3), end)
    slot = (tail % np.uint64(SHAPES)).astype(np.int64)
    shares = np.bincount(row * SHAPES + slot, minlength=rows * SHAPES).reshape(rows, SHAPES) / many[:, None]
    return out, shares


BAD, ABSTAIN, GOOD = 0, 1, 2

# (name, statistic, fewest words, good below, bad from); a negative pair means good above, bad up to.
LABELLERS = [
    ("symbols", "odd", 5, 0.02, 0.04),
    ("more symbols", "odd", 20, 0.01, 0.08),
    ("capitals", "capitals", 5, 0.15, 0.35),
    ("adjacent repeats", "adjacent", 8, 0.1, 0.2),
    ("repeated trigrams", "trigrams", 12, -0.85, -0.6),
    ("one word dominates", "top", 20, 0.15, 0.3),
    ("plain words", "plain", 5, -0.85, -0.6),
    ("few distinct words", "distinct", 30, -0.35, -0.2),
]


def votes(s: np.ndarray) -> np.ndarray:
    """The vote of every labeller on every row."""
    out = np.full((len(s), len(LABELLERS)), ABSTAIN, np.int8)
    for k, (_, name, fewest, good, bad) in enumerate(LABELLERS):
        x = s[:, STATISTICS.index(name)]
        sign = 1 if good > 0 else -1
        enough = s[:, 0] >= fewest
        out[enough & (sign * x < good), k] = GOOD
        out[enough & (sign * x >= bad), k] = BAD
    return out


def codes(v: np.ndarray) -> np.ndarray:
    return (v.astype(np.int64) * 3 ** np.arange(v.shape[1])).sum(1)


def posteriors(pattern: np.ndarray, count: np.ndarray) -> tuple[dict[int, float], np.ndarray]:
    """EM over vote patterns: the probability of good for each, and P(vote | class) by labeller."""
    v = np.stack([pattern // 3**k % 3 for k in range(len(LABELLERS))], 1)
    # To begin with, two bad votes outweigh anything; one counts for a third.
    bad = (v == BAD).sum(1)
    good = 1 - np.clip(np.where(bad >= 2, 0.95, 0.33 * bad), 0.02, 0.98)
    for _ in range(ROUNDS):
        table = np.zeros((2, len(LABELLERS), 3))
        for c, weight in enumerate((count * (1 - good), count * good)):
            for k in range(len(LABELLERS)):
                table[c, k] = np.bincount(v[:, k], weight, 3) + 0.1
        # Abstaining says nothing about the class.
        table[:, :, ABSTAIN] = 0
        table /= table.sum(2, keepdims=True)
        table[:, :, ABSTAIN] = 1
        prior = np.clip(np.average(good, weights=count), 0.01, 0.99)
        like = [np.log(table[c, np.arange(len(LABELLERS))[None, :], v]).sum(1) for c in (0, 1)]
        odds = like[1] - like[0] + np.log(prior / (1 - prior))
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - good).max() < 1e-6:
            break
        good = new
    return dict(zip(pattern.tolist(), good.tolist(), strict=True)), table


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    accuracies: np.ndarray

    def score(self, s: np.ndarray, shares: np.ndarray) -> np.ndarray:
        x = features(s, shares)
        out = 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))
        return np.where(s[:, 0] > 0, out, 0.0)


def features(s: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Hashed shape shares and the statistics, those of repetition scaled down in short texts, where they mean little."""
    sure = np.clip(s[:, 0] / 30, 0, 1)
    dense = np.stack(
        [s[:, 1] * 10, s[:, 2], s[:, 3] * sure, (1 - s[:, 4]) * sure, s[:, 5] * sure, 1 - s[:, 6], (1 - s[:, 7]) * sure], 1
    )
    return np.concatenate([shares, dense], 1)


def _training_rows(batches):
    for batch in batches:
        data, offsets = flat(batch.column(0))
        for _, _, piece, at in pieces(data, offsets):
            s, shares = statistics(piece, at)
            x = features(s, shares).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array(codes(votes(s))), pa.array([r.tobytes() for r in x])], ["code", "x"])


def sums(x: np.ndarray, y: np.ndarray, weight: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Weighted logistic loss of some rows at a point, its gradient and its second derivatives, in one array; the bias is last."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    z = x @ at
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    loss = weight @ (np.logaddexp(0, z) - y * z)
    return np.concatenate([[loss], x.T @ (weight * (p - y)), ((x * (weight * p * (1 - p))[:, None]).T @ x).ravel()])


def minimised(total: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Where the shrunken loss is least: Newton steps, each halved until the loss does not grow."""
    shrink = np.full(size, SHRINK)
    shrink[-1] = 0

    def evaluated(at):
        out = total(at)
        return out[0] + 0.5 * (shrink * at) @ at, out[1 : size + 1] + shrink * at, out[size + 1 :].reshape(size, size) + np.diag(shrink + 1e-12)

    at = np.zeros(size)
    loss, slope, curve = evaluated(at)
    for _ in range(ROUNDS):
        step = np.linalg.solve(curve, slope)
        new = evaluated(at - step)
        while new[0] > loss + 1e-12 and np.abs(step).max() >= LEAST_STEP:
            step /= 2
            new = evaluated(at - step)
        at = at - step
        loss, slope, curve = new
        if np.abs(step).max() < LEAST_STEP:
            break
    return at


def _summed(label: dict[int, float], weights: tuple[float, float], at: np.ndarray):
    """(group, task, blob): the sums over a task's training rows."""

    def run(batches):
        total = 0.0
        for batch in batches:
            y = np.array([label[c] for c in batch.column(0).to_pylist()])
            for k in range(0, len(y), CHUNK):
                x = np.frombuffer(b"".join(batch.column(1).slice(k, CHUNK).to_pylist()), np.float32).reshape(-1, len(at) - 1).astype(float)
                mine = y[k : k + CHUNK]
                total = total + sums(x, mine, mine * weights[1] + (1 - mine) * weights[0], at)
        if isinstance(total, np.ndarray):
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([task % SUMS], pa.int32()), pa.array([task], pa.int32()), pa.array([total.tobytes()])], ["group", "task", "blob"])

    return run


def _added(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("task")
    total = sum(np.frombuffer(b.as_py()) for b in rows.column("blob"))
    return pa.table({"group": rows.column("group").slice(0, 1), "blob": pa.array([total.tobytes()], pa.binary())})


def fit(docs: DataFrame, text: str = "text", key: str = "doc_id") -> Model | None:
    """Votes of all texts, EM on their patterns, then logistic regression on all texts."""
    rows = kept(docs.select(text).mapInArrow(_training_rows, "code long, x binary"))
    found = sorted(rows.groupBy("code").agg(F.count("*").alias("n")).collect())
    if not found:
        return None
    count = np.array([r.n for r in found], float)
    label, table = posteriors(np.array([r.code for r in found]), count)
    good = np.array([label[r.code] for r in found])
    # Each class weighs half, so that the smaller one is not drowned.
    weights = tuple(0.5 / max(count @ y, 1e-9) for y in (1 - good, good))

    def total(at):
        parts = rows.mapInArrow(_summed(label, weights, at), "group int, task int, blob binary")
        parts = parts.groupBy("group").applyInArrow(_added, "group int, blob binary").collect()
        return sum(np.frombuffer(r.blob) for r in sorted(parts))

    # The number of words is no feature, and the bias is one. Rounded, so that the order of the sums does not show.
    at = np.round(minimised(total, SHAPES + len(STATISTICS)), 8)
    return Model(at[:-1], float(at[-1]), table)


def score_column(model: Model | None, text: str = "text") -> Column:
    """The probability of a good text."""
    if model is None:
        return F.lit(0.0)

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        data, offsets = flat(texts)
        return pa.array(np.concatenate([model.score(*statistics(piece, at)) for _, _, piece, at in pieces(data, offsets)] or [np.zeros(0)]))

    return run(F.col(text))


def accepted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that the classifier keeps; all columns as they are."""
    return docs.where(score_column(fit(docs, text), text) >= LEAST_SCORE)


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, "doc_id", "text")
    rows = docs.select("doc_id", score_column(fit(docs)).alias("score"))
    return rows.select("doc_id", "score", (F.col("score") >= LEAST_SCORE).alias("kept"))
