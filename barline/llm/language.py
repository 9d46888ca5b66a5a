"""Language identification with bit-sliced Bloom filters of byte n-grams.

Training counts hashed n-grams per language on labelled rows and keeps, for each language, the most
telling ones. The filters of all languages are sliced the other way: slot i of one shared array
holds a bitmask with a bit per language, so that HASHES lookups and an AND return all languages
that hold an n-gram; over 64 languages take an array for each 64. A text's score of a language is its count of n-grams with that bit, less the
count that the filter's false positives explain, divided by what is left of the n-grams.

Defined cases: a null text or one without a letter is `und` with score 0, as is every text when
nothing could be learned; ties go to the first language by name; a repeated row gets the same
prediction; extra columns pass through `predict`, but those named like an added one are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.llm.common import bounded_sample, documents, remainder
from barline.llm.words import LOWER, SPACE, flat, mixed, pieces

GRAM = 4
HASHES = 3
SLOTS = 1 << 18
PER_LANGUAGE = 20_000
SAMPLE_ROWS = 20_000
MASK_BITS = 64

_A = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]

# Bytes that part words: white space, ASCII digits and punctuation. All other bytes count as letters.
_PART = np.zeros(256, bool)
_PART[:128] = ~np.char.isalpha(np.arange(128).astype(np.uint8).view("S1").astype("U1"))
_PART |= SPACE


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the GRAM-byte strings of a piece's words, a blank before and after each, and where each row's begin.

    A-Z reads as a-z. Strings never cross rows; only those that start at a letter or at the blank
    before one are kept.
    """
    n = len(data)
    low = np.where(_PART[data], np.uint8(32), LOWER[data])
    # One blank ahead of every row, so that strings at a row's edge are like those inside.
    rows = len(offsets) - 1
    place = np.arange(n, dtype=np.int64) + np.repeat(np.arange(1, rows + 1), np.diff(offsets))
    wide = np.full(n + rows + GRAM, 32, np.uint8)
    wide[place] = low
    code = np.zeros(n + rows, np.uint32)
    for j in range(GRAM):
        code = (code << np.uint32(8)) | wide[j : j + n + rows]
    blank = wide == 32
    at = np.flatnonzero(~(blank[: n + rows] & blank[1 : n + rows + 1]))
    starts = offsets[:-1] + np.arange(rows)
    inside = np.ones(len(at), bool)
    nexts = np.append(starts[1:], n + rows)
    row = np.searchsorted(starts, at, "right") - 1
    inside &= at + GRAM <= nexts[row] + 1
    at, row = at[inside], row[inside]
    return code[at], np.searchsorted(row, np.arange(rows + 1))


def slots(codes: np.ndarray) -> list[np.ndarray]:
    return [(mixed(codes.astype(np.uint64) * a) >> np.uint64(20)) & np.uint64(SLOTS - 1) for a in _A[:HASHES]]


@dataclass
class Model:
    languages: list[str]
    tables: list[np.ndarray]  # bitmask per slot, for MASK_BITS languages each
    wrong: list[float]  # each language's rate of false positives

    def masks(self, codes: np.ndarray) -> list[np.ndarray]:
        places = slots(codes)
        out = []
        for table in self.tables:
            mask = table[places[0]]
            for s in places[1:]:
                mask = mask & table[s]
            out.append(mask)
        return out

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """A corrected share of n-grams per row and language, 0 to 1."""
        codes, at = grams(data, offsets)
        masks = self.masks(codes)
        total = np.maximum(1, np.diff(at))
        out = np.zeros((len(total), len(self.languages)))
        for j, wrong in enumerate(self.wrong):
            found = masks[j // MASK_BITS]
            hits = np.concatenate([[0], np.cumsum((found >> found.dtype.type(j % MASK_BITS)) & found.dtype.type(1), dtype=np.int64)])
            share = (hits[at[1:]] - hits[at[:-1]]) / total
            out[:, j] = np.clip((share - wrong) / max(1e-9, 1 - wrong), 0, 1)
        return out


def _counts(batches):
    """Partial sums by language and n-gram: number of texts' occurrences, per batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        langs = pc.dictionary_encode(batch.column(1))
        names, ids = langs.dictionary.to_pylist(), langs.indices.to_numpy()
        data, offsets = flat(batch.column(0))
        parts = []
        for first, last, piece, at in pieces(data, offsets):
            codes, begin = grams(piece, at)
            lang = np.repeat(ids[first:last], np.diff(begin)).astype(np.uint64)
            key, n = np.unique((lang << np.uint64(32)) | codes, return_counts=True)
            parts.append((key, n))
        key, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        n = np.bincount(back, np.concatenate([p[1] for p in parts]), len(key)).astype(np.int64)
        lang = pa.array(names).take(pa.array((key >> np.uint64(32)).astype(np.int64)))
        yield pa.RecordBatch.from_arrays([lang, pa.array((key & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(n)], ["lang", "code", "n"])


def fit(rows: DataFrame, text: str = "text", lang: str = "lang") -> Model | None:
    """Learns from labelled rows, at most about SAMPLE_ROWS of them, chosen by a hash of the text.

    Of each language the PER_LANGUAGE n-grams with the largest share x log-odds against the other
    languages are kept, so what reaches the driver is bounded by languages x PER_LANGUAGE.
    """
    rows = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("t"), F.col(lang).alias("l"))
    counts = bounded_sample(rows, "t", SAMPLE_ROWS).mapInArrow(_counts, "lang string, code long, n long")
    counts = counts.groupBy("code", "lang").agg(F.sum("n").alias("n"))
    sums = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy("lang").collect()}
    if not sums:
        return None
    total = F.create_map(*[F.lit(x) for kv in sums.items() for x in kv])
    share = F.col("n") / total[F.col("lang")]
    by_code = counts.withColumn("share", share).groupBy("code").agg(F.collect_list(F.struct("lang", "share", "n")).alias("all"))
    other = F.aggregate("all", F.lit(0.0), lambda a, x: a + x.share)
    each = by_code.withColumn("sum", other).select("code", "sum", F.explode("all").alias("x")).select("code", "sum", "x.*")
    rest = (F.col("sum") - F.col("share")) / max(1, len(sums) - 1)
    telling = each.where(F.col("share") > 2 * rest).withColumn("worth", F.col("share") * F.log(F.col("share") / (rest + F.lit(1e-7))))
    # The best n-grams of a language: candidates per slice of codes first, then over the slices.
    part = telling.withColumn("part", F.pmod(F.xxhash64("code"), F.lit(64)))
    best = F.reverse(F.array_sort(F.collect_list(F.struct("worth", "code"))))
    few = part.groupBy("lang", "part").agg(F.slice(best, 1, PER_LANGUAGE // 64).alias("b")).select("lang", F.explode("b.code").alias("code"))
    picked = few.toPandas()
    names = sorted(sums)
    kind = np.uint8 if len(names) <= 8 else np.uint64
    tables = [np.zeros(SLOTS, kind) for _ in range(0, len(names), MASK_BITS)]
    full = []
    for j, name in enumerate(names):
        codes = picked.code[picked.lang == name].to_numpy(np.uint32)
        table, bit = tables[j // MASK_BITS], kind(j % MASK_BITS)
        for s in slots(codes):
            table[s] |= kind(1) << bit
        full.append(float(((table >> bit) & kind(1)).mean()) ** HASHES)
    return Model(names, tables, full)


HAS_LETTER = r"\p{L}"


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Adds lang_pred and score for every whole text."""
    if model is None:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def judged(texts: pa.Array) -> pa.Array:
        data, offsets = flat(texts)
        best, score = np.zeros(len(texts), np.int64), np.zeros(len(texts))
        for first, last, piece, at in pieces(data, offsets):
            s = model.scores(piece, at)
            best[first:last] = s.argmax(1)
            score[first:last] = s.max(1) / np.maximum(s.sum(1), 1e-9)
        return pa.StructArray.from_arrays([pa.array(model.languages).take(pa.array(best)), pa.array(score)], ["lang_pred", "score"])

    known = F.coalesce(F.col(text).rlike(HAS_LETTER), F.lit(False))
    rows = docs.withColumn("_judged", judged(F.col(text)))
    return rows.withColumns(
        {
            "lang_pred": F.when(known, F.col("_judged.lang_pred")).otherwise("und"),
            "score": F.when(known, F.col("_judged.score")).otherwise(0.0),
        }
    ).drop("_judged")


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, "doc_id", "text", "lang")
    held = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    model = fit(docs.where(~held))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score")
