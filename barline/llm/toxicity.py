"""Toxicity by the nearest labelled examples.

Terms are words and word beginnings, each in LEVELS grades: grade j is held by a text with j or more
occurrences, so term frequency counts although vectors have unit length. Training counts every
graded term's texts by label, keeps those that tell the labels apart (log-likelihood ratio), and
turns the labelled texts into TF-IDF vectors over them. Texts are scored by the exact cosine to their NEAREST examples: an inverted index holds, per term
and block of examples, the largest weight; blocks are visited by their upper bound and the search
ends when no further block can hold a nearer example. Neighbours vote with weights that fall with
their distance; votes are calibrated on the training examples, each judged without itself. The neighbours are
the evidence.

Examples with equal vectors share one index entry with their counts, so copies cost nothing. A text
with no telling term has no nearest example; its score is the calibrated share of toxic examples
among labelled texts of that kind.

Defined cases: a null or empty text has no telling term; a text with both labels counts as toxic; without labelled examples all scores are 0;
equal texts have equal scores; ties between examples go to the smaller entry number, which depends on the
training texts alone; a repeated label row counts once per distinct text and label.
"""

from __future__ import annotations

from dataclasses import dataclass, field


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.llm.common import bounded_sample, documents, remainder
from barline.llm.words import flat, folded, mixed, pieces, span_hashes, spans_of

BEGINNINGS = (5, 6, 7)  # bytes
SAMPLE_ROWS = 24_000
LEAST_TEXTS = 6
LEAST_RATIO = 30.0
TERMS = 4096
LEVELS = 4
NEAREST = 15
BLOCK = 64
AT_A_TIME = 4
TOXIC_FROM = 0.7

_MEMBER = np.zeros(256, bool)
_MEMBER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def terms(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hash, row) of the words of a piece and of their beginnings, one pair of arrays for each sort of term."""
    low = folded(data)
    start, end, row = spans_of(_MEMBER[low], offsets)
    out = [(span_hashes(low, start, end), row)]
    for n in BEGINNINGS:
        longer = end - start > n
        h = span_hashes(low, start[longer], start[longer] + n)
        out.append((mixed(h + np.uint64(n)), row[longer]))
    return out


@dataclass
class Index:
    """Vectors of the examples by term, in blocks of BLOCK entries."""

    known: np.ndarray  # term hashes, sorted
    grades: np.ndarray  # by term and grade: number of the graded term, or -1
    idf: np.ndarray  # by graded term
    entries: list[np.ndarray] = field(default_factory=list)  # by term: entry numbers, ascending
    weights: list[np.ndarray] = field(default_factory=list)
    blocks: list[np.ndarray] = field(default_factory=list)  # by term: blocks it occurs in
    tops: list[np.ndarray] = field(default_factory=list)  # and its largest weight there
    begins: list[np.ndarray] = field(default_factory=list)  # and where the block's postings begin
    toxic: np.ndarray = None  # by entry
    total: np.ndarray = None
    ids: np.ndarray = None  # by entry: smallest doc_id of its examples
    base: float = 0.0
    knots: tuple = ((0.0, 1.0), (0.0, 1.0))

    def __post_init__(self):
        self.sieve = np.zeros(1 << 16, bool)
        self.sieve[(self.known & np.uint64(0xFFFF)).astype(np.int64)] = True

    def vectors(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unit TF-IDF vectors of a piece's rows: where each begins, its terms, and their weights."""
        rows, found = [], []
        for h, row in terms(data, offsets):
            maybe = self.sieve[(h & np.uint64(0xFFFF)).astype(np.int64)]
            h, row = h[maybe], row[maybe]
            at = np.minimum(np.searchsorted(self.known, h), max(0, len(self.known) - 1))
            ok = self.known[at] == h if len(self.known) else np.zeros(len(h), bool)
            rows.append(row[ok])
            found.append(at[ok])
        row, term = np.concatenate(rows), np.concatenate(found)
        key, n = np.unique(row * max(1, len(self.known)) + term, return_counts=True)
        row, term = np.divmod(key, max(1, len(self.known)))
        graded = self.grades[term] if len(term) else np.zeros((0, LEVELS), np.int64)
        held = (graded >= 0) & (np.arange(1, LEVELS + 1)[None, :] <= n[:, None])
        row, term = np.repeat(row, held.sum(1)), graded[held]
        w = self.idf[term]
        norm = np.sqrt(np.bincount(row, w * w, len(offsets) - 1))
        return np.searchsorted(row, np.arange(len(offsets))), term, w / norm[row] if len(row) else w

    def add(self, vectors: list[tuple[tuple, tuple]]) -> None:
        """Postings of the entries, given as (terms, weights)."""
        n = np.array([len(t) for t, _ in vectors], np.int64)
        entry = np.repeat(np.arange(len(vectors)), n)
        term = np.fromiter((x for t, _ in vectors for x in t), np.int64, n.sum())
        weight = np.fromiter((x for _, w in vectors for x in w), float, n.sum())
        order = np.lexsort((entry, term))
        cuts = np.searchsorted(term[order], np.arange(len(self.idf) + 1))
        for k in range(len(self.idf)):
            mine = order[cuts[k] : cuts[k + 1]]
            e, w = entry[mine], weight[mine]
            block, begin = np.unique(e // BLOCK, return_index=True)
            self.entries.append(e)
            self.weights.append(w)
            self.blocks.append(block)
            self.tops.append(np.maximum.reduceat(w, begin) if len(w) else w)
            self.begins.append(np.append(begin, len(e)))

    def nearest(self, term: np.ndarray, weight: np.ndarray, leave: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Entries of at least NEAREST nearest examples and their cosines, nearest first; exact.

        `leave`: an entry that counts one example less.
        """
        count = self.total if leave < 0 else np.where(np.arange(len(self.total)) == leave, self.total - 1, self.total)
        bound = np.zeros(-(-len(self.total) // BLOCK))
        for t, w in zip(term, weight, strict=True):
            bound[self.blocks[t]] += w * self.tops[t]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        best, cos = np.zeros(0, np.int64), np.zeros(0)
        for at in range(0, len(order), AT_A_TIME):
            if len(best) and count[best].sum() >= NEAREST and cos[-1] > bound[order[at]] + 1e-12:
                break
            here = np.sort(order[at : at + AT_A_TIME])
            score = np.zeros(len(here) * BLOCK)
            for t, w in zip(term, weight, strict=True):
                k = np.minimum(np.searchsorted(self.blocks[t], here), max(0, len(self.blocks[t]) - 1))
                for j in np.flatnonzero(self.blocks[t][k] == here) if len(self.blocks[t]) else ():
                    a, b = self.begins[t][k[j]], self.begins[t][k[j] + 1]
                    score[j * BLOCK + self.entries[t][a:b] - here[j] * BLOCK] += w * self.weights[t][a:b]
            got = np.flatnonzero(score)
            entry = here[got // BLOCK] * BLOCK + got % BLOCK
            best, cos = np.concatenate([best, entry]), np.concatenate([cos, score[got]])
            ranked = np.lexsort((best, -np.round(cos, 9)))
            best, cos = best[ranked], cos[ranked]
            enough = int(np.searchsorted(np.cumsum(count[best]), NEAREST)) + 1
            best, cos = best[:enough], cos[:enough]
        return best, cos

    def vote(self, term: np.ndarray, weight: np.ndarray, leave: int = -1, was_toxic: bool = False) -> tuple[float, np.ndarray, np.ndarray]:
        """Share of the neighbours' votes for toxic, and the neighbours. A vote weighs 1 / (distance + 0.1)."""
        if not len(term):
            return -1.0, np.zeros(0, np.int64), np.zeros(0)
        best, cos = self.nearest(term, weight, leave)
        total, toxic = self.total[best].astype(float), self.toxic[best].astype(float)
        if leave >= 0:
            total[best == leave] -= 1
            toxic[best == leave] -= was_toxic
        w = 1 / (1.1 - np.minimum(cos, 1.0))
        all_ = float((w * total).sum())
        return (float((w * toxic).sum()) / all_ if all_ > 0 else -1.0), best, cos

    def calibrated(self, vote: float) -> float:
        return self.base if vote < 0 else float(np.interp(vote, *self.knots))


def _counts(batches):
    """(term, grade, toxic texts, texts) of a batch."""
    for batch in batches:
        data, offsets = flat(batch.column(0))
        toxic = batch.column(1).to_numpy()
        parts = []
        for first, _, piece, at in pieces(data, offsets):
            for h, row in terms(piece, at):
                if len(h):
                    parts.append(_graded(h, row + first))
        if not parts:
            continue
        h, level, row = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((level, h))
        h, level, bad = h[order], level[order], toxic[row[order]].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (level[1:] != level[:-1])]))
        n = np.diff(np.append(first, len(h)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(h[first].view(np.int64)), pa.array(level[first].astype(np.int32)), pa.array(np.add.reduceat(bad, first)), pa.array(n)],
            ["term", "level", "toxic", "n"],
        )


def _graded(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term, grade, row): the j-th occurrence of a term in a row has grade j; those above LEVELS are left out."""
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])])
    first = np.flatnonzero(new)
    level = np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h)))) + 1
    ok = level <= LEVELS
    return h[ok], level[ok], row[ok]


def _vector_rows(index: Index):
    def run(batches):
        for batch in batches:
            data, offsets = flat(batch.column(0))
            for first, last, piece, at in pieces(data, offsets):
                begin, term, weight = index.vectors(piece, at)
                t = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(term.astype(np.int32)))
                w = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(weight.astype(np.float64)))
                yield pa.RecordBatch.from_arrays([batch.column(1)[first:last], batch.column(2)[first:last], t, w], ["toxic", "doc_id", "terms", "weights"])

    return run


def _ratio(k: np.ndarray, n: np.ndarray, bad: float, total: float) -> np.ndarray:
    """Log-likelihood ratio of a term's split by label against the overall split."""
    def part(x, m, p):
        return np.where(x > 0, x * np.log(np.maximum(x, 1e-9) / np.maximum(m * p, 1e-9)), 0.0)

    p = bad / total
    return 2 * (part(k, n, p) + part(n - k, n, 1 - p) + part(bad - k, total - n, p) + part(total - n - bad + k, total - n, 1 - p))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text") -> Index | None:
    """Learns from labels (doc_id, toxic) of documents: at most about SAMPLE_ROWS, chosen by a hash of doc_id.

    The sample is taken before texts are looked at, so only its texts are moved.
    """
    few = bounded_sample(labels.where("toxic is not null and doc_id is not null").select("doc_id", "toxic"), "doc_id", SAMPLE_ROWS)
    rows = docs.where(F.col(text).isNotNull()).join(F.broadcast(few), "doc_id")
    one = rows.groupBy(F.col(text).alias("text")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"), F.min("doc_id").alias("doc_id"))
    one = one.persist()
    size = one.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("bad")).first()
    if not size.n:
        one.unpersist()
        return None
    counts = one.select("text", "toxic").mapInArrow(_counts, "term long, level int, toxic long, n long").groupBy("term", "level")
    counts = counts.agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n")).where(f"n >= {LEAST_TEXTS}")
    bad, total = float(size.bad), float(size.n)
    # Far from the overall share, in standard deviations: an order that only picks what is sent to the driver.
    p = min(max(bad / total, 1 / total), 1 - 1 / total)
    far = F.abs(F.col("toxic") - F.col("n") * F.lit(p)) / F.sqrt(F.col("n") * F.lit(p * (1 - p)))
    few = counts.orderBy(F.desc(far), "term", "level").limit(8 * TERMS).toPandas()
    ratio = _ratio(few.toxic.to_numpy(float), few.n.to_numpy(float), bad, total)
    picked = np.lexsort((few.level.to_numpy(), few.term.to_numpy(), -ratio))[:TERMS]
    picked = picked[ratio[picked] >= LEAST_RATIO]
    known, at = np.unique(few.term.to_numpy(np.int64)[picked].view(np.uint64), return_inverse=True)
    grades = np.full((len(known), LEVELS), -1, np.int64)
    grades[at, few.level.to_numpy()[picked] - 1] = np.arange(len(picked))
    index = Index(known, grades, np.log((1 + total) / (1 + few.n.to_numpy(float)[picked])))
    found = one.select("text", "toxic", "doc_id").mapInArrow(_vector_rows(index), "toxic int, doc_id long, terms array<int>, weights array<double>")
    examples = found.groupBy("terms", "weights").agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("id"))
    vectors = sorted(examples.toPandas().itertuples(index=False), key=lambda r: (tuple(r.terms), tuple(r.weights)))
    one.unpersist()
    plain = [r for r in vectors if not len(r.terms)]
    vectors = [r for r in vectors if len(r.terms)]
    index.base = (sum(r.toxic for r in plain) + 0.5) / (sum(r.n for r in plain) + 1) if plain else bad / total
    index.toxic, index.total, index.ids = (np.array([getattr(r, c) or 0 for r in vectors], np.int64) for c in ("toxic", "n", "id"))
    index.add([(tuple(r.terms), tuple(r.weights)) for r in vectors])
    _calibrate(index, vectors)
    return index


def _calibrate(index: Index, vectors: list) -> None:
    """Isotonic regression of the label on the votes of all examples, each left out in turn."""
    points = []
    for e, r in enumerate(vectors):
        t, w = np.asarray(r.terms), np.asarray(r.weights)
        for label, n in ((1, r.toxic), (0, r.n - r.toxic)):
            if n:
                v = index.vote(t, w, e, bool(label))[0]
                if v >= 0:
                    points.append((v, float(label), float(n)))
    points.sort()
    pools = []  # vote x weight, label x weight, weight
    for v, y, n in points:
        pools.append([v * n, y * n, n])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    if pools:
        index.knots = (tuple(p[0] / p[2] for p in pools), tuple((p[1] + 0.5 * index.base) / (p[2] + 0.5) for p in pools))


def score(docs: DataFrame, index: Index | None, text: str = "text") -> DataFrame:
    """Adds score and evidence (the nearest examples' ids) for every whole text."""
    if index is None:
        return docs.withColumns({"score": F.lit(0.0), "evidence": F.array().cast("array<bigint>")})

    @F.arrow_udf("struct<score:double,evidence:array<bigint>>")
    def run(texts: pa.Array) -> pa.Array:
        data, offsets = flat(texts)
        scores, evidence, seen = [], [], {}
        for first, last, piece, at in pieces(data, offsets):
            begin, term, weight = index.vectors(piece, at)
            for k in range(last - first):
                t, w = term[begin[k] : begin[k + 1]], weight[begin[k] : begin[k + 1]]
                key = (t.tobytes(), w.tobytes())
                if key not in seen:
                    v, best, _ = index.vote(t, w)
                    seen[key] = (index.calibrated(v), index.ids[best[:3]].tolist())
                scores.append(seen[key][0])
                evidence.append(seen[key][1])
        return pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.array(evidence, pa.list_(pa.int64()))], ["score", "evidence"])

    return docs.withColumn("_found", run(F.col(text))).withColumns({"score": F.col("_found.score"), "evidence": F.col("_found.evidence")}).drop("_found")


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, "doc_id", "text")
    held = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    index = fit(docs, labels.where(~held))
    rows = score(docs, index)
    return rows.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), "evidence")


