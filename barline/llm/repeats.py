"""Exact removal of long byte strings that an earlier document holds, by a distributed sparse suffix array.

A byte goes if a LENGTH-byte string that covers it also starts in a document with a smaller
doc_id. Sorting the suffixes at all bytes would multiply the corpus, so suffixes are taken at
anchors only: of the GRAM-byte strings in a LENGTH-byte window the one with the smallest hash is
the window's anchor. Equal windows have their anchor at the same place, so two equal windows meet
wherever the suffixes at their anchors meet. Neighbouring windows share an anchor: such a run is
one record, of at most 2 * LENGTH - GRAM bytes.

0. A text that equals one with a smaller doc_id goes whole and holds nothing that is not there, too, so it takes no further part.
1. Texts are dealt into chunks by doc_id once, compressed; each of the next steps reads that one shuffle.
2. Each chunk sends a fingerprint per distinct anchor string and its sides. A window holds its anchor string and either the
   SIDE bytes before it or the SIDE + 1 bytes behind it, so the reply names the sides that two documents hold: in a large
   corpus most anchor strings meet again by chance, few of them with a side. It has three bits per fingerprint.
3. The windows of such sides are sent, those of each distinct run once per chunk with its smallest doc_id. Splitters
   sampled from suffixes deal them into ranges of the anchor's leading bytes.
4. A range sorts its suffixes by multikey quicksort, a word of 8 bytes at a time. A suffix is kept whole,
   and a range's borders lie between different anchor strings, so the strings that two ranges might share
   at a border are in one of them. Where an anchor string has several runs, their windows are sorted
   too, and each window gets its smallest doc_id.
5. Chunks get back two bits per record, more where only some of its windows go, and cut their texts.

Copies shrink in their chunk before they are sent, so a group of copies costs a record per chunk. An
anchor string with more than HOT different runs in some chunk (a passage amid ever different text)
is hot everywhere: its windows are sent one by one, dealt by all their bytes, so a passage in a third of all rows
spreads over the ranges and shrinks like the rest.

Defined cases: a null or empty text has no bytes and the hash of nothing; a text under LENGTH bytes keeps
all; rows that share a doc_id do not remove from each other; a row without doc_id counts as the last.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.llm.common import bounded_sample, documents, kept, partitions
from barline.llm.words import flat, mixed, span_hashes, spans_of, taken

LENGTH = 50
GRAM = 20
SIDE = (LENGTH - GRAM) // 2
HOT = 32
SAMPLE_DOCUMENTS = 1000
CHUNKS_A_PARTITION = 2
RANGES_A_PARTITION = 1
SEGMENT = 1 << 18
WINDOWS = 1 << 20
LAST = (1 << 63) - 1

_MUL = 0x5851F42D4C957F2D
_LETTER = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_PLACE_BITS = np.uint64(20)
_PLACE = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
GRAM_BITS = np.uint64(18)
SIDE_BITS = np.uint64(18)
_SIDE_MASK = (np.uint64(1) << SIDE_BITS) - np.uint64(1)
_TO_RIGHT, _TO_LEFT, _TO_GRAM = np.uint64(2), np.uint64(2) + SIDE_BITS, np.uint64(2) + np.uint64(2) * SIDE_BITS
_TEXTS, _HOT = np.uint64(2), np.uint64(1)


def gram_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the GRAM = 16 + 4 bytes and of the SIDE + 1 = 16 bytes from every place on."""
    step = [np.uint64(pow(_MUL, k, 1 << 64)) for k in (1, 2, 4, 8)]
    h = _LETTER[data]
    four = None
    for k, m in zip((1, 2, 4, 8), step, strict=True):
        h = h[:-k] * m + h[k:]
        if k == 2:
            four = h
    return mixed(h[: len(data) - GRAM + 1] * step[2] + four[16 : 16 + len(data) - GRAM + 1]), h


class Runs:
    """The runs of windows that share an anchor, in a flat array of texts.

    `start`, `stop`: first and last window of a run; `anchor`: where its anchor string begins;
    `gram`: the anchor string's hash; `row`: the text. `left`, `right`: SIDE_BITS of a hash of the anchor string and
    the bytes before or behind it that all windows with SIDE or more bytes before the anchor share, or all others; 0
    where a run has no such windows.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        parts, windows = [], LENGTH - GRAM + 1
        for first in range(0, len(data) - LENGTH + 1, SEGMENT):
            piece = data[first : first + SEGMENT + LENGTH - 1]
            h, side = gram_hashes(piece)
            v = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
            for k in (1, 2, 4, 8):
                v = np.minimum(v[:-k], v[k:])
            v = np.minimum(v[: len(h) - windows + 1], v[windows - 16 : windows - 16 + len(h) - windows + 1])
            at = (v & _PLACE).astype(np.int64)
            cut = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            start, at = cut + first, at[cut]
            stop = np.append(cut[1:], len(v)) - 1 + first
            parts.append((start, stop, at + first, h[at], side[np.maximum(at - SIDE, 0)], side[np.minimum(at + GRAM, len(side) - 1)]))
        cols = [np.concatenate(c) if parts else np.zeros(0, np.int64) for c in (zip(*parts, strict=True) if parts else [[]] * 6)]
        start, stop, anchor, gram, left, right = cols
        # Windows must lie within one text: a run is clipped to the text that holds its anchor.
        row = np.searchsorted(offsets, anchor, "right") - 1
        start = np.maximum(start, offsets[row]) if len(row) else start
        stop = np.minimum(stop, offsets[row + 1] - LENGTH) if len(row) else stop
        ok = start <= stop
        self.start, self.stop, self.anchor, self.row = start[ok], stop[ok], anchor[ok], row[ok]
        self.gram, left, right = (c[ok].astype(np.uint64) for c in (gram, left, right))
        self.left = np.where(self.start <= self.anchor - SIDE, _side(self.gram, left), np.uint64(0))
        self.right = np.where(self.stop > self.anchor - SIDE, _side(self.gram, right), np.uint64(0))
        self.data = data

    def hashes(self, which: np.ndarray) -> np.ndarray:
        """Of the bytes of some runs, in ascending order, and of where their anchors lie in them."""
        start = self.start[which]
        return run_hashes(self.data, start, self.stop[which] + LENGTH, self.anchor[which] - start)


def _side(gram: np.ndarray, side: np.ndarray) -> np.ndarray:
    return np.maximum(mixed(gram * np.uint64(_MUL) + side) >> (np.uint64(64) - SIDE_BITS), np.uint64(1))


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    return mixed(hashed(data, starts, ends) + anchors.astype(np.uint64))


def hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """span_hashes of spans in ascending order, a few megabytes at a time."""
    out = np.zeros(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + (1 << 20))))
        low, high = starts[at], ends[at:to].max()
        out[at:to] = span_hashes(data[low:high], starts[at:to] - low, ends[at:to] - low)
        at = to
    return out


def _squeezed(raw: bytes, level: int) -> bytes:
    return np.int64(len(raw)).tobytes() + pa.Codec("zstd", level).compress(raw, asbytes=True)


def _restored(blob: bytes) -> bytes:
    return pa.decompress(memoryview(blob)[8:], int(np.frombuffer(blob, np.int64, 1)[0]), "zstd", asbytes=True)


TEXTS = "chunk int, texts binary"


def _dealt(batches):
    """The rows of each batch that go to one chunk as one: their number, ids, sizes and bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = batch.take(pc.sort_indices(batch.column("chunk")))
        chunk, ids = batch.column("chunk").to_numpy(), batch.column("id").to_numpy()
        data, offsets = flat(batch.column("text"))
        size = np.diff(offsets)
        first = np.flatnonzero(_changes(chunk))
        out = []
        for a, b in zip(first, np.append(first[1:], len(chunk)), strict=True):
            out.append(_squeezed(np.int64(b - a).tobytes() + ids[a:b].tobytes() + size[a:b].tobytes() + data[offsets[a] : offsets[b]].tobytes(), 3))
        yield pa.RecordBatch.from_arrays([pa.array(chunk[first], pa.int32()), pa.array(out, pa.binary())], ["chunk", "texts"])


def _texts(table: pa.Table, messages: pa.Table):
    """A chunk's rows in one fixed order: ids, bytes without those of copies, offsets, which rows are copies, all sizes."""
    ids, size, data = [], [], []
    for blob in table.column("texts").to_pylist():
        raw = _restored(blob)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        ids.append(np.frombuffer(raw, np.int64, n, 8))
        size.append(np.frombuffer(raw, np.int64, n, 8 + 8 * n))
        data.append(memoryview(raw)[8 + 16 * n :])
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(size))])
    texts = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(data))])
    table = pa.table([pa.array(np.concatenate(ids)), texts], names=["id", "text"]).sort_by([("id", "ascending"), ("text", "ascending")])
    ids, texts = table.column("id").to_numpy(), table.column("text").combine_chunks()
    named = [b for k, b in zip(messages.column("kind").to_pylist(), messages.column("payload").to_pylist(), strict=True) if k == COPY]
    copies = np.frombuffer(b"".join(named), ">i8")
    size = np.diff(flat(texts)[1])
    copy = np.isin(ids, copies) & (size >= LENGTH)
    data, offsets = flat(pc.if_else(pa.array(copy), pa.scalar(b"", pa.large_binary()), texts))
    return ids, data[offsets[0] : offsets[-1]], offsets - offsets[0], copy, size


def _fingerprints(runs: Runs, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """The range of fingerprints that each run belongs to, and its fingerprint there: anchor string, left and right side, two bits left free."""
    gram = (runs.gram // np.uint64(ranges)) & ((np.uint64(1) << GRAM_BITS) - np.uint64(1))
    return (runs.gram % np.uint64(ranges)).astype(np.int64), (gram << _TO_GRAM) | (runs.left << _TO_LEFT) | (runs.right << _TO_RIGHT)


def _in_order(place: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs by range and fingerprint, and which of them come first with theirs."""
    order = np.argsort(value)
    order = order[np.argsort(place[order], kind="stable")]
    p, v = place[order], value[order]
    return order, _changes(p) | _changes(v)


def _changes(values: np.ndarray) -> np.ndarray:
    """Which values differ from the one before."""
    out = np.ones(len(values), bool)
    out[1:] = values[1:] != values[:-1]
    return out


def _packed(values: np.ndarray) -> bytes:
    """56-bit values byte by byte, the highest first: those of sorted values hardly change."""
    return values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 1:].T.tobytes()


def _unpacked(blob: bytes) -> np.ndarray:
    wide = np.zeros((len(blob) // 7, 8), np.uint8)
    wide[:, 1:] = np.frombuffer(blob, np.uint8).reshape(7, -1).T
    return wide.view(">u8")[:, 0].astype(np.uint64)


def _flags(blob: bytes, n: int, rows: int) -> np.ndarray:
    """`rows` arrays of n bits that np.packbits has packed together."""
    return np.unpackbits(np.frombuffer(blob, np.uint8, (rows * n + 7) // 8), count=rows * n).reshape(rows, n).astype(bool)


MESSAGE = "place int, chunk int, kind int, payload binary"
FINGERPRINTS, RECORDS, SIDES, VERDICTS, COPY = range(5)


def _message(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.table([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["place", "chunk", "kind", "payload"])


def _send_fingerprints(ranges: int):
    """Per chunk and range: the distinct fingerprints, each with two bits, for 'in two texts here' and 'hot here'."""

    def run(table: pa.Table, messages: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _message([])
        chunk = table.column("chunk")[0].as_py()
        ids, data, offsets, _, _ = _texts(table, messages)
        runs = Runs(data, offsets)
        place, value = _fingerprints(runs, ranges)
        order, new = _in_order(place, value)
        first = np.flatnonzero(new)
        if not len(first):
            return _message([])
        p, v, doc = place[order], value[order], ids[runs.row[order]]
        several = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)

        gram = np.flatnonzero(_changes(p) | _changes(v >> _TO_GRAM))
        size = np.diff(np.append(gram, len(p)))
        hot = np.zeros(len(p), bool)
        big = np.flatnonzero(size > HOT)
        if len(big):
            mine = np.flatnonzero(np.repeat(size > HOT, size))
            up = np.sort(order[mine])
            h = runs.hashes(up)[np.searchsorted(up, order[mine])]
            cuts = np.cumsum(np.append(0, size[big]))
            for k, g in enumerate(big):
                hot[gram[g] : gram[g] + size[g]] = len(np.unique(h[cuts[k] : cuts[k + 1]])) > HOT

        out = v[first] | np.where(several, _TEXTS, np.uint64(0)) | np.where(hot[first], _HOT, np.uint64(0))
        cuts = np.searchsorted(p[first], np.arange(ranges + 1))
        return _message([(r, chunk, FINGERPRINTS, _packed(out[cuts[r] : cuts[r + 1]])) for r in range(ranges) if cuts[r] < cuts[r + 1]])

    return run


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where groups of equal sorted keys begin, and their sizes."""
    first = np.flatnonzero(_changes(keys))
    return first, np.diff(np.append(first, len(keys)))


def _repeated(table: pa.Table) -> pa.Table:
    """Answers every chunk of a range, in the order of its fingerprints: whether two texts hold the left side, the right side, and whether the anchor string is hot."""
    sent = [_unpacked(b) for b in table.column("payload").to_pylist()]
    value = np.concatenate(sent)
    order = np.argsort(value)
    v = value[order]
    texts = (v & _TEXTS) > 0
    first, size = _groups(v >> _TO_GRAM)
    hot = np.repeat(np.bitwise_or.reduceat(v & _HOT, first) > 0, size)
    shared = np.flatnonzero(np.repeat(size > 1, size))
    left, right = texts.copy(), texts.copy()
    first, size = _groups(v >> _TO_LEFT)
    left |= np.repeat((size > 1) | (np.bitwise_or.reduceat(v & _TEXTS, first) > 0), size)
    if len(shared):
        key = ((v[shared] >> _TO_GRAM) << SIDE_BITS) | ((v[shared] >> _TO_RIGHT) & _SIDE_MASK)
        by = np.argsort(key)
        first, size = _groups(key[by])
        right[shared[by]] = np.repeat((size > 1) | np.logical_or.reduceat(texts[shared[by]], first), size)
    left &= (v >> _TO_LEFT) & _SIDE_MASK > 0
    right &= (v >> _TO_RIGHT) & _SIDE_MASK > 0
    answer = np.empty((3, len(v)), bool)
    answer[:, order] = left, right, hot
    cuts = np.cumsum([0, *(len(x) for x in sent)])
    place, rows = table.column("place")[0].as_py(), []
    for k, chunk in enumerate(table.column("chunk").to_pylist()):
        mine = answer[:, cuts[k] : cuts[k + 1]]
        if mine[:2].any():
            rows.append((place, chunk, FINGERPRINTS, np.packbits(mine).tobytes()))
    return _message(rows)


def suffix(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """The `length` bytes from each place on, zeros past the end, as fixed-width strings."""
    wide = np.concatenate([data, np.zeros(length, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(wide, length)[at]
    return np.ascontiguousarray(rows).view(f"S{length}")[:, 0]


RECORD = np.dtype([("id", "<i8"), ("length", "u1"), ("anchor", "u1")])


class Records:
    """What a chunk sends of the runs whose left or right windows are wanted.

    `start`, `stop`, `anchor`, `row`: like those of runs, of the wanted windows of each run, or of each such window alone
    where the anchor string is hot, which then is the anchor itself. `same`: the record that each of them is sent as; `one`:
    the first of them for each record, which has the smallest id; `order`, `cuts`: the records by the range they go to.
    """

    def __init__(self, runs: Runs, left: np.ndarray, right: np.ndarray, hot: np.ndarray, ranges: int, splitters: np.ndarray):
        data, parts, cold = runs.data, [], np.flatnonzero((left | right) & ~hot)
        start = np.where(left, runs.start, np.maximum(runs.start, runs.anchor - SIDE + 1))
        stop = np.where(right, runs.stop, np.minimum(runs.stop, runs.anchor - SIDE))
        h = run_hashes(data, start[cold], stop[cold] + LENGTH, runs.anchor[cold] - start[cold])
        parts.append((start[cold], stop[cold], runs.anchor[cold], runs.row[cold], h))
        which = np.flatnonzero((left | right) & hot)
        n = stop[which] - start[which] + 1
        at = np.repeat(start[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        parts.append((at, at, at, np.repeat(runs.row[which], n), hashed(data, at, at + LENGTH)))
        self.start, self.stop, self.anchor, self.row = (np.concatenate(c) for c in list(zip(*parts, strict=True))[:4])
        _, one, same = np.unique(parts[0][-1], return_index=True, return_inverse=True)
        _, more, rest = np.unique(parts[1][-1], return_index=True, return_inverse=True)
        self.one, self.same = np.concatenate([one, more + len(cold)]), np.concatenate([same, rest + len(one)])
        keys = suffix(data, self.anchor[self.one], LENGTH)
        keys[: len(one)] = keys[: len(one)].astype(f"S{GRAM}").astype(f"S{LENGTH}")
        to = np.searchsorted(splitters, keys, "right")
        self.order = np.argsort(to, kind="stable")
        self.cuts = np.searchsorted(to[self.order], np.arange(ranges + 1))


def _send_records(ranges: int, splitters: np.ndarray):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows or not answers.num_rows:
            return _message([])
        chunk = docs.column("chunk")[0].as_py()
        ids, data, offsets, _, _ = _texts(docs, answers)
        runs = Runs(data, offsets)
        place, value = _fingerprints(runs, ranges)
        order, new = _in_order(place, value)
        sent = np.zeros((3, int(new.sum())), bool)
        cuts = np.searchsorted(place[order[new]], np.arange(ranges + 1))
        for kind, p, blob in zip(*(answers.column(c).to_pylist() for c in ("kind", "place", "payload")), strict=True):
            if kind == FINGERPRINTS:
                sent[:, cuts[p] : cuts[p + 1]] = _flags(blob, cuts[p + 1] - cuts[p], 3)
        flags = np.empty((3, len(order)), bool)
        flags[:, order] = sent[:, np.cumsum(new) - 1]
        if not flags[:2].any():
            return _message([])
        out = Records(runs, *flags, ranges, splitters)
        first = out.one[out.order]
        start, end = out.start[first], out.stop[first] + LENGTH
        head = np.empty(len(first), RECORD)
        head["id"], head["length"], head["anchor"] = ids[out.row[first]], end - start, out.anchor[first] - start
        rows = [(chunk % ranges, chunk, SIDES, np.packbits(flags).tobytes())]
        for r in range(ranges):
            mine = slice(out.cuts[r], out.cuts[r + 1])
            s, n = start[mine], (end - start)[mine]
            if len(s):
                take = np.repeat(s - (np.cumsum(n) - n), n) + np.arange(n.sum())
                rows.append((r, chunk, RECORDS, _squeezed(np.int64(len(n)).tobytes() + head[mine].tobytes() + data[take].tobytes(), 6)))
        return _message(rows)

    return run


def _words(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one number that sorts as they do."""
    out = np.zeros(len(at), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | data[at + k]
    return out


def multikey_order(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorts the `length`-byte strings at given places: the order, and the number of each string's group of equals.

    Splits by one word of 8 bytes and goes on to the next word only among strings that are equal so
    far. Strings may reach past the end, where zeros stand.
    """
    data = np.concatenate([data, np.zeros(length + 8, np.uint8)])
    group = np.zeros(len(at), np.int64)
    order = np.arange(len(at))
    open_ = np.ones(len(at), bool)
    for depth in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        mine = np.flatnonzero(open_)
        if not len(mine):
            break
        w = _words(data, at[order[mine]] + depth)
        sub = np.lexsort((w, group[mine]))
        order[mine], w, g = order[mine][sub], w[sub], group[mine][sub]
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (w[1:] != w[:-1])])
        first = mine[np.flatnonzero(new)]
        group[mine] = first[np.cumsum(new) - 1]
        single = new & np.append(new[1:], True)
        open_[mine[single]] = False
    return order, group


def _windows(count: np.ndarray) -> np.ndarray:
    """A bit for each of `count` windows."""
    return (np.uint64(1) << count.astype(np.uint64)) - np.uint64(1)


def _judge(table: pa.Table) -> pa.Table:
    """For each record of a range the windows whose smallest id over all records is below the record's: all, none or some by bits."""
    rows, heads, texts, source = [], [], [], []
    place = table.column("place")[0].as_py()
    chunks = table.column("chunk").to_pylist()
    for k, (kind, blob) in enumerate(zip(table.column("kind").to_pylist(), table.column("payload").to_pylist(), strict=True)):
        if kind == SIDES:
            rows.append((place, chunks[k], SIDES, blob))
            continue
        blob = _restored(blob)
        n = int(np.frombuffer(blob, np.int64, 1)[0])
        heads.append(np.frombuffer(blob, RECORD, n, 8))
        texts.append(np.frombuffer(blob, np.uint8, -1, 8 + n * RECORD.itemsize))
        source.append(np.full(n, k))
    if not heads:
        return _message(rows)
    head, data, source = np.concatenate(heads), np.concatenate(texts), np.concatenate(source)
    length = head["length"].astype(np.int64)
    begin = np.cumsum(length) - length
    # Equal records first: one for each, with its smallest id.
    h = run_hashes(data, begin, begin + length, head["anchor"])
    _, one, same = np.unique(h, return_index=True, return_inverse=True)
    least = np.full(len(one), LAST)
    np.minimum.at(least, same, head["id"])
    order, group = multikey_order(data, begin[one] + head["anchor"][one], GRAM)
    _, group = np.unique(group, return_inverse=True)
    alone = np.bincount(group)[group] == 1
    bits = np.zeros(len(head), np.uint64)
    count = length - LENGTH + 1
    full = _windows(count)
    only = np.zeros(len(one), bool)
    only[order[alone]] = True
    bits[:] = np.where(only[same] & (least[same] < head["id"]), full, np.uint64(0))
    # Records that share an anchor string: their windows, those of a few anchor strings at a time.
    which, several = order[~alone], np.flatnonzero(_changes(group[~alone]))
    if len(which):
        back, held = np.argsort(same, kind="stable"), np.bincount(same)
        at = np.cumsum(held) - held
        load = np.cumsum(np.add.reduceat(count[one[which]] * held[which], several))
        edges = several[_changes(np.append(0, load[:-1]) // WINDOWS)]
        for mine in np.split(which, edges[1:]):
            n, stands = count[one[mine]], held[mine]
            rec = np.repeat(mine, n)
            nth = np.arange(len(rec)) - np.repeat(np.cumsum(n) - n, n)
            order, group = multikey_order(data, begin[one[rec]] + nth, LENGTH)
            smallest = np.full(len(rec), LAST)
            np.minimum.at(smallest, group, least[rec[order]])
            low = np.empty(len(rec), np.int64)
            low[order] = smallest[group]
            # Back to every record that a distinct one stands for.
            each, m = taken(back, at[mine], stands), np.repeat(n, stands)
            low = taken(low, np.repeat(np.cumsum(n) - n, stands), m)
            first = np.cumsum(m) - m
            nth = (np.arange(len(low)) - np.repeat(first, m)).astype(np.uint64)
            bits[each] = np.bitwise_or.reduceat((low < np.repeat(head["id"][each], m)).astype(np.uint64) << nth, first)
    cuts = np.searchsorted(source, np.arange(len(chunks) + 1))
    whole = bits == full
    some = (bits > 0) & ~whole
    for k in range(len(chunks)):
        mine = slice(cuts[k], cuts[k + 1])
        if bits[mine].any():
            rows.append((place, chunks[k], VERDICTS, np.packbits([whole[mine], some[mine]]).tobytes() + bits[mine][some[mine]].astype("<u4").tobytes()))
    return _message(rows)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _cut(ranges: int, splitters: np.ndarray, with_text: bool):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(),) * 4 + (pa.string(), pa.binary())], names=NAMES)
        ids, data, offsets, copy, size = _texts(docs, answers)
        runs = Runs(data, offsets)
        cover = np.zeros(len(data) + 1, np.int32)
        kinds, places, blobs = (answers.column(c).to_pylist() for c in ("kind", "place", "payload"))
        if SIDES in kinds:
            out = Records(runs, *_flags(blobs[kinds.index(SIDES)], len(runs.start), 3), ranges, splitters)
            count = out.stop - out.start + 1
            bits = np.zeros(len(out.one), np.uint64)
            for kind, r, blob in zip(kinds, places, blobs, strict=True):
                if kind == VERDICTS:
                    mine = out.order[out.cuts[r] : out.cuts[r + 1]]
                    whole, some = _flags(blob, len(mine), 2)
                    bits[mine[whole]] = _windows(count[out.one[mine[whole]]])
                    bits[mine[some]] = np.frombuffer(blob, "<u4", int(some.sum()), (2 * len(mine) + 7) // 8)
            # Of each record this chunk's smaller ids hold all windows; for the smallest the answers count.
            least = ids[out.row[out.one]][out.same]  # rows are in order of their ids
            bits = np.where(ids[out.row] > least, _windows(count), bits[out.same])

            def mark(starts, ends):
                np.add.at(cover, starts, 1)
                np.add.at(cover, ends, -1)

            whole = bits == _windows(count)
            mark(out.start[whole], out.stop[whole] + LENGTH)
            some = np.flatnonzero((bits > 0) & ~whole)
            for k in range(int(count[some].max(initial=0))):
                hit = some[(bits[some] >> np.uint64(k)) & np.uint64(1) == 1]
                mark(out.start[hit] + k, out.start[hit] + k + LENGTH)
        gone = np.cumsum(cover[:-1]) > 0
        total = np.concatenate([[0], np.cumsum(gone)])
        _, _, row = spans_of(gone, offsets)
        spans = np.bincount(row, minlength=len(ids))
        removed = np.where(copy, size, total[offsets[1:]] - total[offsets[:-1]])
        spans = np.where(copy, 1, spans)
        raw, sums, keeps = data.tobytes(), [], []
        for k in range(len(ids)):
            a, b = int(offsets[k]), int(offsets[k + 1])
            left = raw[a:b] if not removed[k] or copy[k] else data[a:b][~gone[a:b]].tobytes()
            sums.append(hashlib.sha256(left).hexdigest())
            keeps.append(left if with_text else None)
        own = pa.array(ids, mask=ids == LAST)
        return pa.table([own, pa.array(size), pa.array(removed.astype(np.int64)), pa.array(spans.astype(np.int64)), pa.array(sums), pa.array(keeps, pa.binary())], names=NAMES)

    return run


NAMES = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]


def _sampled(batches):
    for batch in batches:
        data, offsets = flat(batch.column(0))
        data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        runs = Runs(data, offsets)
        some = np.flatnonzero(mixed(runs.gram) % np.uint64(16) == 0)
        yield pa.RecordBatch.from_arrays([pa.array(suffix(data, runs.anchor[some], LENGTH).tolist(), pa.binary())], ["suffix"])


def splitters(docs: DataFrame, text: str, ranges: int) -> np.ndarray:
    """Cuts the sorted anchor suffixes of at most about SAMPLE_DOCUMENTS texts into even ranges."""
    rows = bounded_sample(docs.select("doc_id", text), "doc_id", SAMPLE_DOCUMENTS).select(text)
    found = rows.mapInArrow(_sampled, "suffix binary")
    quota = F.pmod(F.xxhash64("suffix"), F.lit(1 << 20))
    n = max(1, found.count())
    found = found.where(quota < max(1, int((1 << 20) * min(1.0, 64 * ranges / n)))).limit(128 * ranges).collect()
    got = np.sort(np.array([r.suffix for r in found], f"S{LENGTH}"))
    return got[np.linspace(0, len(got), ranges + 1).astype(np.int64)[1:-1]] if len(got) else got


def without_repeats(docs: DataFrame, text: str = "text", with_text: bool = True) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes, if asked for)."""
    ranges = RANGES_A_PARTITION * partitions(docs.sparkSession)
    chunks = F.lit(CHUNKS_A_PARTITION * partitions(docs.sparkSession))
    cuts = splitters(docs, text, ranges)
    rows = docs.select(F.coalesce("doc_id", F.lit(LAST)).alias("id"), F.col(text).alias("text"))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("id"), chunks).cast("int"))
    copies = _copies(rows)
    texts = rows.mapInArrow(_dealt, TEXTS)
    sent = texts.groupBy("chunk").cogroup(copies.groupBy("chunk")).applyInArrow(_send_fingerprints(ranges), MESSAGE)
    answers = sent.groupBy("place").applyInArrow(_repeated, MESSAGE).unionByName(copies)
    records = texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_send_records(ranges, cuts), MESSAGE)
    bits = records.groupBy("place").applyInArrow(_judge, MESSAGE).unionByName(copies)
    return texts.groupBy("chunk").cogroup(bits.groupBy("chunk")).applyInArrow(_cut(ranges, cuts, with_text), RESULT)


def _copies(rows: DataFrame) -> DataFrame:
    """A message to each chunk for every id of a text that also has a smaller id and no smaller text under its own id."""
    known = rows.select("id", "chunk", F.unhex(F.sha2("text", 256)).alias("sum"))
    least = known.groupBy("sum").agg(F.min("id").alias("least"))
    copy = known.join(least, "sum").where("id > least")
    # An id whose rows hold several texts stays in: its other texts must be compared.
    several = known.groupBy("id").agg(F.min("sum").alias("x"), F.max("sum").alias("y")).where("x <> y").select("id")
    copy = copy.join(several, "id", "left_anti").select("id", "chunk").distinct()
    payload = F.unhex(F.lpad(F.hex("id"), 16, "0"))
    return kept(copy.select(F.lit(0).alias("place"), "chunk", F.lit(COPY).alias("kind"), payload.alias("payload")))


def query(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeats(documents(spark, folder, "doc_id", "text"), with_text=False).drop("kept")


def brute(rows: list[tuple[int | None, str | None]]) -> list[tuple]:
    """The query's rows with a dictionary of all strings, for tests."""
    texts = [(LAST if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in texts:
        for k in range(len(t) - LENGTH + 1):
            s = t[k : k + LENGTH]
            first[s] = min(first.get(s, i), i)
    out = []
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - LENGTH + 1):
            if first[t[k : k + LENGTH]] < i:
                gone[k : k + LENGTH] = True
        left = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((None if i == LAST else i, len(t), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return out
