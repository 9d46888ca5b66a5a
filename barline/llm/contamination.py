"""Benchmark decontamination by templates.

Words become template tokens: numbers, units and names are replaced by typed placeholders, all
else is lower-cased. Windows of WINDOW template tokens of the benchmark items and of the documents are matched by
a hash join; documents send only windows whose hash passes a fixed-size bitmap of the benchmark's hashes,
so the join sees few of them whatever the corpus. A document is contaminated by an item if at least
NEED of the item's windows are found close together in it, and if the slots agree: the values of
the item's placeholders each have one value in the document, as a re-parameterised question
has them (two may have the same), along an alignment in which each window of either side has one partner. Numbers may be written
in words. As a capital may only mark the start of a sentence or a line in capitals, every window is matched with
names as placeholders, with names as words, and with the capitals that open a sentence and words all in capitals as names, too.

A document also is contaminated by a part of an item, if RUN consecutive windows of the item (RUN + WINDOW - 1 words)
stand in it one after the other and their slots agree.

Defined cases: a null or empty text, and an item without a token, match nothing; an item with fewer than
WINDOW tokens is one window of its own length; a window without a plain word is no evidence unless the
item has no other; of repeated items each is reported; rows of equal id and text are one document and reported once, rows that share only
the id are judged and removed each by its own text; rows without an id are judged if `without_id` is set, as the
query and the pipeline do, and kept otherwise.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.llm.common import documents
from barline.llm.words import flat, folded, mixed, pieces, span_hashes, spans_of

WINDOW = 5
NEED = 0.8
RUN = 16  # windows in a row that are enough: 20 words
SLOTS_AGREE = 0.8
BITMAP_BITS = 1 << 22

# Units of measure that make a slot.
UNITS = """
mm cm m km inch inches foot feet yard yards mile miles
mg g kg ton tons tonne tonnes ounce ounces pound pounds lb lbs oz
ml l liter liters litre litres gallon gallons cup cups
second seconds sec minute minutes min hour hours day days week weeks month months year years
dollar dollars cent cents euro euros usd eur gbp percent degree degrees
watt watts kw volt volts amp amps joule joules hz khz mhz ghz kb mb gb tb kmh mph
""".split()

# Numbers in words.
NUMBERS = """
zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen
twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion
""".split()

_MEMBER = np.zeros(256, bool)
_MEMBER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:\n"]] = True

WORD, NUMBER, UNIT, NAME = range(4)
_KIND = mixed(np.arange(1, 5, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _hashes(words: list[str]) -> np.ndarray:
    return np.sort(np.concatenate([span_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w)])) for w in words]))


_UNIT_HASHES, _NUMBER_HASHES = _hashes(UNITS), _hashes(NUMBERS)


def _among(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes


def _capitals(data: np.ndarray) -> np.ndarray:
    """Marks the first byte of the capitals of the basic Latin, Latin-1, Greek and Cyrillic alphabets."""
    out = _CAPITAL[data]
    lead, next_ = data[:-1], data[1:]
    latin = (lead == 0xC3) & (next_ >= 0x80) & (next_ <= 0x9E) & (next_ != 0x97)
    out[:-1] |= latin | ((lead == 0xCE) & (next_ >= 0x91) & (next_ <= 0xAB)) | ((lead == 0xD0) & (next_ >= 0x90) & (next_ <= 0xAF))
    return out


class Tokens:
    """Template tokens of a piece: spans, rows, kinds, and a hash per token with names as words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(data)
        member = _MEMBER[data]
        digit = _DIGIT[data]
        if n > 2:  # a point, comma or stroke between digits belongs to the number
            mark = (data[1:-1] == 46) | (data[1:-1] == 44) | (data[1:-1] == 47)
            member[1:-1] |= mark & digit[:-2] & digit[2:]
        self.start, self.end, self.row = spans_of(member, offsets)
        low = folded(data)
        plain = span_hashes(low, self.start, self.end)
        digits = np.concatenate([[0], np.cumsum(digit)])
        capital_at = _capitals(data)
        capitals = np.concatenate([[0], np.cumsum(capital_at)])
        letters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        stops = np.concatenate([[0], np.cumsum(_STOP[data])])
        length = self.end - self.start
        some = digits[self.end] - digits[self.start]
        first = capital_at[self.start] if len(length) else np.zeros(0, bool)
        before = np.concatenate([[0], self.end[:-1]])[: len(length)]
        opens = np.concatenate([[True], self.row[1:] != self.row[:-1]])[: len(length)] if len(length) else first
        opens = opens | (stops[self.start] > stops[np.minimum(before, self.start)])
        n_capitals, n_letters = capitals[self.end] - capitals[self.start], letters[self.end] - letters[self.start]
        capital = first & (n_capitals == 1) & (n_letters > 1) & (some == 0)
        loud = (n_capitals == n_letters) & (n_letters > 1)
        name = capital & ~opens
        kind = np.full(len(length), WORD)
        kind[name] = NAME
        kind[_among(plain, _UNIT_HASHES)] = UNIT
        kind[_among(plain, _NUMBER_HASHES)] = NUMBER
        kind[(some > 0) & (some >= length - 2 * (some < length)) & digit[np.minimum(self.start, max(0, n - 1))]] = NUMBER
        self.kind = kind
        slot = (kind == NUMBER) | (kind == UNIT)
        self.words = np.where(slot, _KIND[kind], plain)
        self.names = np.where(kind == NAME, _KIND[NAME], self.words)
        self.capital = (kind == NAME) | ((capital | loud) & (kind == WORD))
        self.capitals = np.where(self.capital, _KIND[NAME], self.words)
        self.plain = plain

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Windows of `length` tokens within one row: first token, and hashes with names, no names, or all capitals as slots."""
        n = len(self.row) - length + 1
        if n <= 0:
            return np.zeros(0, np.int64), *[np.zeros(0, np.uint64)] * 3
        at = np.flatnonzero(self.row[:n] == self.row[length - 1 : length - 1 + n])
        out = []
        for tokens in (self.names, self.words, self.capitals):
            h = np.full(len(at), length, np.uint64)
            for k in range(length):
                h = mixed(h ^ tokens[at + k]) * np.uint64(0x9E3779B97F4A7C15)
            out.append(h)
        return at, *out


def _cells(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(17)) % np.uint64(BITMAP_BITS)).astype(np.int64)


ITEM_WINDOWS = "item_id long, hash long, item_at int, n_windows int, size int, slots array<int>, slot_values array<long>"


def _item_windows(batches):
    """The windows of the benchmark items, with all readings of names, and their slots: token places and value hashes."""
    for batch in batches:
        data, offsets = flat(batch.column(1))
        ids = batch.column(0).to_pylist()
        rows = []
        for first, _, piece, at in pieces(data, offsets):
            t = Tokens(piece, at)
            cuts = np.searchsorted(t.row, np.arange(len(at)))
            for r in range(len(at) - 1):
                n = int(cuts[r + 1] - cuts[r])
                if not n:
                    continue
                size = min(WINDOW, n)
                base = int(cuts[r])
                w, a, b, c = t.windows(size)
                mine = np.flatnonzero((w >= base) & (w < base + n))
                word = t.kind == WORD
                full = [k for k in mine if word[w[k] : w[k] + size].any()] or list(mine)
                for k in full:
                    place = int(w[k]) - base
                    span = np.arange(int(w[k]), int(w[k]) + size)
                    fixed = (t.kind[span] == NUMBER) | (t.kind[span] == UNIT)
                    readings = [(a[k], t.kind[span] != WORD), (b[k], fixed)]
                    if not (fixed | t.capital[span]).all():
                        readings.append((c[k], fixed | t.capital[span]))
                    for h, slot in readings:
                        where = span[slot]
                        rows.append((ids[first + r], int(h.view(np.int64)), place, len(full), size, (where - int(w[k])).tolist(), t.plain[where].view(np.int64).tolist()))
        rows = list({(r[0], r[1], r[2]): r for r in rows}.values())
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["item_id", "hash", "item_at", "n_windows", "size", "slots", "slot_values"])


DOC_WINDOWS = "doc_id long, key long, hash long, doc_at int, tokens array<long>"


def _doc_windows(bitmap: bytes, sizes: list[int]):
    cells = np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little").view(bool)

    def run(batches):
        for batch in batches:
            data, offsets = flat(batch.column(2))
            for first, last, piece, at in pieces(data, offsets):
                t = Tokens(piece, at)
                begin = np.searchsorted(t.row, np.arange(last - first + 1))
                for size in sizes:
                    w, a, b, c = t.windows(size)
                    for place, h in ((w, a), (w[a != b], b[a != b]), (w[a != c], c[a != c])):
                        hit = cells[_cells(h)]
                        place, h = place[hit], h[hit]
                        if not len(place):
                            continue
                        row = t.row[place]
                        of = pa.array(first + row)
                        tokens = t.plain[place[:, None] + np.arange(size)].view(np.int64)
                        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(place) + 1, dtype=np.int32) * size), pa.array(tokens.ravel()))
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(of).cast(pa.int64()), batch.column(1).take(of), pa.array(h.view(np.int64)), pa.array((place - begin[row]).astype(np.int32)), lists],
                            ["doc_id", "key", "hash", "doc_at", "tokens"],
                        )

    return run


def _or_bitmaps(rows: DataFrame) -> tuple[bytes, list[int]]:
    """A bitmap of all item hashes and the window sizes in use: of a fixed size however many items there are."""

    def part(batches):
        cells, sizes = np.zeros(BITMAP_BITS, bool), set()
        for batch in batches:
            cells[_cells(batch.column(0).to_numpy().view(np.uint64))] = True
            sizes |= set(batch.column(1).to_pylist())
        if sizes:
            yield pa.RecordBatch.from_arrays([pa.array([np.packbits(cells, bitorder="little").tobytes()]), pa.array([sorted(sizes)], pa.list_(pa.int32()))], ["bits", "sizes"])

    out, sizes = np.zeros(BITMAP_BITS // 8, np.uint8), set()
    for r in rows.select("hash", "size").coalesce(16).mapInArrow(part, "bits binary, sizes array<int>").toLocalIterator():
        out |= np.frombuffer(r.bits, np.uint8)
        sizes |= set(r.sizes)
    return out.tobytes(), sorted(sizes)


def _aligned(by_shift: dict[int, list[dict]], shifts: list[int]) -> list[dict]:
    """Matches that give each item window one place of the document and the reverse; the shifts named first choose first."""
    to_doc, to_item, out = {}, {}, []
    for shift in shifts:
        for h in by_shift[shift]:
            # Several readings of a window may match at the same places.
            if to_doc.setdefault(h["item_at"], h["doc_at"]) == h["doc_at"]:
                if to_item.setdefault(h["doc_at"], h["item_at"]) == h["item_at"]:
                    out.append(h)
                else:
                    del to_doc[h["item_at"]]
    return sorted(out, key=lambda h: (h["doc_at"], h["item_at"]))


def _densest(hits: list[dict], reach: int) -> tuple[int, int, int]:
    """The stretch of `reach` document tokens with most item windows: their number, its first match, past its last."""
    count, left, best = defaultdict(int), 0, (0, 0, 0)
    for right, h in enumerate(hits):
        count[h["item_at"]] += 1
        while hits[left]["doc_at"] < h["doc_at"] - reach:
            at = hits[left]["item_at"]
            count[at] -= 1
            if not count[at]:
                del count[at]
            left += 1
        if len(count) > best[0]:
            best = (len(count), left, right + 1)
    return best


def _longest(hits: list[dict]) -> tuple[int, int, int]:
    """The longest run of item windows one by one along one shift: their number, its first match, past its last."""
    best, begin, n = (0, 0, 0), 0, 0
    for k, h in enumerate(hits):
        step = h["item_at"] - hits[k - 1]["item_at"] if k else 0
        if k and (step not in (0, 1) or h["doc_at"] - hits[k - 1]["doc_at"] != step):
            begin, n = k, 0
        n += step == 1 or k == begin
        if n > best[0] or begin == best[1]:
            best = (n, begin, k + 1)
    return best


def _slots(hits: list[dict]) -> tuple[int, float] | None:
    """Changed slots and agreement, if each of the item's values has one value in the document."""
    votes = defaultdict(lambda: defaultdict(int))
    for h in hits:
        for place, value in zip(h["slots"], h["slot_values"], strict=True):
            votes[value][h["tokens"][place]] += 1
    agreed = sum(max(v.values()) for v in votes.values())
    total = sum(sum(v.values()) for v in votes.values())
    to = [max(v, key=v.get) for v in votes.values()]
    same = agreed / total if total else 1.0
    if same < SLOTS_AGREE:
        return None
    return sum(v != t for v, t in zip(votes, to, strict=True)), same


def judged(hits: list[dict], n_windows: int) -> dict | None:
    """An alignment of an item with a document whose slots agree: NEED of the item's windows close together, or RUN in a row.

    Each shift (place in the document less place in the item) in turn, the most frequent first, has the first choice of
    the windows, then the others by their frequency, so a template that the item repeats meets its own repetition only.
    """
    need, reach = ceil(NEED * n_windows), 2 * (max(h["item_at"] for h in hits) + WINDOW)
    by_shift = defaultdict(list)
    for h in sorted(hits, key=lambda h: (h["doc_at"], h["item_at"])):
        by_shift[h["doc_at"] - h["item_at"]].append(h)
    shifts = sorted(by_shift)
    for first in sorted(by_shift, key=lambda d: (-len(by_shift[d]), d)):
        near = shifts[bisect_left(shifts, first - 2 * reach) : bisect_right(shifts, first + 2 * reach)]
        near.sort(key=lambda d: (d != first, -len(by_shift[d]), abs(d - first)))
        chosen = _aligned(by_shift, near)
        for (matched, left, right), least in ((_densest(chosen, reach), need), (_longest(chosen), RUN)):
            if matched >= least and (found := _slots(chosen[left:right])):
                return {"matched": matched, "doc_from": chosen[left]["doc_at"], "changed_slots": found[0], "agreement": found[1]}
    return None


def _found(docs: DataFrame, items: DataFrame, text: str, item_text: str, without_id: bool) -> DataFrame:
    """One row per distinct document, told by its id and a key of its id and text, and benchmark item found in it."""
    windows = items.select("item_id", item_text).mapInArrow(_item_windows, ITEM_WINDOWS)
    bitmap, sizes = _or_bitmaps(windows)
    rows = docs if without_id else docs.where("doc_id is not null")
    found = rows.select("doc_id", _key(docs, text).alias("key"), text).mapInArrow(_doc_windows(bitmap, sizes), DOC_WINDOWS)
    hits = found.join(windows, "hash").groupBy("doc_id", "key", "item_id")
    hit = F.struct("doc_at", "item_at", "slots", "slot_values", "tokens")
    pairs = hits.agg(F.first("n_windows").alias("n_windows"), F.collect_set("item_at").alias("places"), F.collect_list(hit).alias("hits"))
    pairs = pairs.where(F.size("places") >= F.least(F.ceil(F.lit(NEED) * F.col("n_windows")), F.lit(RUN)))

    @F.arrow_udf("struct<matched:int,doc_from:int,changed_slots:int,agreement:double>")
    def judge(hits: pa.Array, n_windows: pa.Array) -> pa.Array:
        rows = [judged(h, n) for h, n in zip(hits.to_pylist(), n_windows.to_pylist(), strict=True)]
        kind = pa.struct([("matched", pa.int32()), ("doc_from", pa.int32()), ("changed_slots", pa.int32()), ("agreement", pa.float64())])
        return pa.array(rows, kind)

    rows = pairs.select("doc_id", "key", "item_id", "n_windows", judge("hits", "n_windows").alias("j")).where("j is not null")
    return rows.select("doc_id", "key", "item_id", "n_windows", "j.*", (F.col("j.matched") / F.col("n_windows")).alias("coverage"))


def _key(docs: DataFrame, text: str) -> Column:
    return F.xxhash64(docs["doc_id"], docs[text])


def contaminated(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", without_id: bool = False) -> DataFrame:
    """One row per distinct document (id and text) and benchmark item found in it; rows without an id only if asked for."""
    return _found(docs, items, text, item_text, without_id).drop("key")


def clean(docs: DataFrame, items: DataFrame, text: str = "text", without_id: bool = False) -> DataFrame:
    """The documents that hold no benchmark item; all columns as they are. Rows without an id are kept, unless asked to be judged."""
    gone = _found(docs, items, text, "text", without_id).select("doc_id", "key").distinct()
    return docs.join(gone, (_key(docs, text) == gone["key"]) & docs["doc_id"].eqNullSafe(gone["doc_id"]), "left_anti").select(docs.columns)


def benchmark(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text")


def query(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(documents(spark, folder, "doc_id", "text"), benchmark(spark, folder), without_id=True)


def words_of(text: str | None) -> list[str]:
    """Lower-case words, for tests against plain containment."""
    return re.findall(r"[^\W_]+", (text or "").lower())
