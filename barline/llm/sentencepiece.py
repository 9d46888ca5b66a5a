"""SentencePiece encoding and decoding of whole texts by suffix-array matching.

A text gets a blank in front, as the model says, and is cut before each run of blanks; no piece
crosses such a cut. (A blank stands for the model's U+2581 throughout.) The distinct units of
some megabytes of text that the worker has not met lately are laid end to end and the suffixes at their characters sorted; a binary search of
every piece then gives its range of occurrences, which are the edges of a lattice over the units. Edges are
sorted by place and relaxed until nothing changes. The models at hand are BPE, so an edge may be
taken when it spans exactly two current symbols, and in each round a unit takes its best such
edge: the highest score, then the leftmost. This gives the ids of the reference algorithm. A unit
of more than LONG characters takes its edges from a heap instead of in rounds, so its cost stays near-linear.
Characters that are no piece become their bytes.

Defined cases: a null text has null ids, an empty one none; decoding restores every text without
U+2581, which reads as a blank; equal texts have equal ids; a model without byte pieces, or one
that is not BPE, is refused; an input column with the name of an added one is replaced.
"""

from __future__ import annotations

import hashlib
import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.llm.common import documents
from barline.llm.repeats import multikey_order, suffix
from barline.llm.words import flat, mixed, pieces, span_hashes

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
PIECE_BYTES = 1 << 21
BLOCK_BYTES = 1 << 19
MEMO_UNITS = 1 << 18  # units a worker remembers, of at most MEMO_UNIT bytes each
MEMO_UNIT = 32
LONG = 48
BETWEEN = 0xFF  # never part of UTF-8


@dataclass
class Vocabulary:
    pieces: list[bytes]  # by id, with blanks; empty for control, unknown and byte pieces
    rank: np.ndarray  # by id; smaller is better
    byte_ids: np.ndarray  # id of each byte

    def __post_init__(self):
        self.longest = max(map(len, self.pieces))
        self.ids = {p: k for k, p in enumerate(self.pieces) if p}
        texts = {k: p.decode() for p, k in self.ids.items()}
        self.multi = np.array([k for k, t in texts.items() if len(t) > 1])
        self.low = np.array([self.pieces[k] for k in self.multi], f"S{self.longest}")
        self.high = np.array([self.pieces[k] + b"\xff" * (self.longest - len(self.pieces[k])) for k in self.multi], f"S{self.longest}")
        self.chars = np.array([len(texts[k]) for k in self.multi])
        own = list(self.pieces)
        for b, k in enumerate(self.byte_ids):
            own[k] = bytes([b])
        self.out_bytes = np.frombuffer(b"".join(own), np.uint8)
        self.out_at = np.concatenate([[0], np.cumsum([len(p) for p in own])])


def vocabulary(model_file: str = MODEL_FILE) -> Vocabulary:
    """Reads a model on the driver; its size is that of the vocabulary."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(sp.serialized_model_proto())
    n = proto.normalizer_spec
    if proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback:
        raise ValueError("a BPE model with byte pieces is needed")
    if n.name != "identity" or not n.add_dummy_prefix or n.remove_extra_whitespaces or not n.escape_whitespaces:
        raise ValueError("a model that leaves texts as they are is needed")
    size = sp.get_piece_size()
    special = [sp.is_control(k) or sp.is_unknown(k) or sp.is_byte(k) or sp.is_unused(k) for k in range(size)]
    pieces = [b"" if special[k] else sp.id_to_piece(k).replace(BLANK, " ").encode() for k in range(size)]
    score = np.array([sp.get_score(k) for k in range(size)])
    rank = np.unique(-score, return_inverse=True)[1].astype(np.int64)
    return Vocabulary(pieces, rank, np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]))


def edges(data: np.ndarray, places: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All occurrences of pieces of two or more characters: first character, one past the last, piece."""
    padded = np.concatenate([data, np.full(v.longest, BETWEEN, np.uint8)])
    order, _ = multikey_order(padded, places, v.longest) if len(places) else (np.zeros(0, np.int64), None)
    ordered = suffix(padded, places[order], v.longest)
    low, high = np.searchsorted(ordered, v.low, "left"), np.searchsorted(ordered, v.high, "right")
    n = high - low
    which = np.repeat(np.arange(len(n)), n)
    at = order[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    by_place = np.argsort(at * (v.longest + 1) + v.chars[which])  # a place has one piece of a length
    at, which = at[by_place], which[by_place]
    return at, at + v.chars[which], v.multi[which]


def _heap(start: int, end: int, first: dict[int, list[tuple[int, int]]], rank: np.ndarray) -> list[tuple[int, int]]:
    """Merges of one unit from a heap: (first character, piece) of what is left after each merge."""
    piece_at = {(i, j): p for i in range(start, end) for j, p in first.get(i, ())}
    after = {i: i + 1 for i in range(start, end)}
    before = {i + 1: i for i in range(start, end)}
    heap = []

    def offer(i):
        j = after.get(i)
        k = after.get(j)
        if k is not None and (i, k) in piece_at:
            heapq.heappush(heap, (rank[piece_at[i, k]], i, j, k))

    for i in range(start, end):
        offer(i)
    done = []
    while heap:
        _, i, j, k = heapq.heappop(heap)
        if after.get(i) != j or after.get(j) != k:
            continue
        after[i], before[k] = k, i
        del after[j]
        done.append((i, j, piece_at[i, k]))
        offer(i)
        if i in before and before[i] >= start:
            offer(before[i])
    return done


def segment(data: np.ndarray, begin: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of units laid end to end, each followed by BETWEEN, and how many each has."""
    places = np.flatnonzero(((data & 0xC0) != 0x80) & (data != BETWEEN))
    char_unit = np.searchsorted(begin, places, "right") - 1
    n_chars = np.bincount(char_unit, minlength=len(begin))
    first_char = np.cumsum(n_chars) - n_chars
    i, j, piece = edges(data, places, v)
    # Characters, as symbols to begin with; `edge[k]` says that a symbol begins at character k.
    ends = np.append(places[1:], len(data))
    last = np.append(char_unit[1:] != char_unit[:-1], True) if len(places) else np.zeros(0, bool)
    ends = ends - last
    symbol = _char_ids(data, places, ends, v)
    edge = np.ones(len(places) + 1, bool)
    unit_first = np.zeros(len(places) + 1, bool)
    unit_first[first_char[n_chars > 0]] = True
    unit_first[-1] = True
    unit = char_unit[i] if len(i) else np.zeros(0, np.int64)
    long = n_chars > LONG
    if long.any():
        mine = np.flatnonzero(long[unit])
        found = {}
        for a, b, p in zip(i[mine].tolist(), j[mine].tolist(), piece[mine].tolist(), strict=True):
            found.setdefault(a, []).append((b, p))
        for u in np.flatnonzero(long):
            for a, m, p in _heap(int(first_char[u]), int(first_char[u] + n_chars[u]), found, v.rank):
                edge[m] = False
                symbol[a] = p
        keep = ~long[unit]
        i, j, piece, unit = i[keep], j[keep], piece[keep], unit[keep]
    key = (v.rank[piece] << 32) | i
    while len(i):
        count = np.cumsum(edge)
        ok = edge[i] & edge[j]
        i, j, piece, unit, key = i[ok], j[ok], piece[ok], unit[ok], key[ok]
        if not len(i):
            break
        inside = count[j - 1] - count[i]
        ready = np.flatnonzero(inside == 1)
        live = inside >= 1
        if not len(ready):
            break
        cuts = np.flatnonzero(np.concatenate([[True], unit[ready][1:] != unit[ready][:-1]]))
        best = np.minimum.reduceat(key[ready], cuts)
        spread = np.repeat(best, np.diff(np.append(cuts, len(ready))))
        take = ready[key[ready] == spread]
        # Of pieces with one first character and score, the edge list has one per end; the shorter one comes first.
        take = take[np.concatenate([[True], unit[take][1:] != unit[take][:-1]])]
        edge[np.flatnonzero(edge)[count[i[take]]]] = False
        symbol[i[take]] = piece[take]
        left = np.zeros(len(begin), bool)
        left[unit[take]] = True
        live &= left[unit]
        i, j, piece, unit, key = i[live], j[live], piece[live], unit[live], key[live]
    at = np.flatnonzero(edge[:-1])
    ids = symbol[at]
    width = np.where(ids >= 0, 1, ends[at] - places[at])
    out = np.repeat(ids, width)
    raw = np.flatnonzero(ids < 0)
    if len(raw):
        n = width[raw]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat((np.cumsum(width) - width)[raw], n) + nth] = v.byte_ids[data[np.repeat(places[at[raw]], n) + nth]]
    return out.astype(np.int32), np.bincount(char_unit[at], width, len(begin)).astype(np.int64)


def _char_ids(data, places, ends, v: Vocabulary) -> np.ndarray:
    """The piece of every single character, -1 where there is none."""
    code = np.zeros(len(places), np.int64)
    for k in range(4):
        more = places + k < ends
        code = np.where(more, (code << 8) | data[np.minimum(places + k, len(data) - 1)], code)
    values, back = np.unique(code, return_inverse=True)
    ids = [v.ids.get(int(c).to_bytes(max(1, (int(c).bit_length() + 7) // 8), "big"), -1) for c in values]
    return np.array(ids, np.int64)[back] if len(values) else np.zeros(0, np.int64)


_OTHER = mixed(np.arange(256, dtype=np.uint64)).astype(np.uint8)


def _units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A piece's bytes with a blank in front of every row, and the units: starts, ends, rows. Empty rows have none."""
    rows = len(offsets) - 1
    wide = np.full(len(data) + rows, 32, np.uint8)
    wide[np.arange(len(data)) + np.repeat(np.arange(1, rows + 1), np.diff(offsets))] = data
    row_starts = offsets[:-1] + np.arange(rows)
    blank = wide == 32
    new = blank & ~np.concatenate([[False], blank[:-1]])
    new[row_starts] = True
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(wide))
    row = np.searchsorted(row_starts, starts, "right") - 1
    some = np.diff(offsets)[row] > 0
    return wide, starts[some], ends[some], row[some]


def _distinct(wide: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One unit of each kind, the kind of every unit, and the kinds' keys: two hashes and the length.

    Kinds go by a hash; units that the rest of the key tells apart stay alone.
    """
    h, check = span_hashes(wide, starts, ends), span_hashes(_OTHER[wide], starts, ends)
    _, one, kind = np.unique(h, return_index=True, return_inverse=True)
    odd = np.flatnonzero((check[one][kind] != check) | ((ends - starts)[one][kind] != ends - starts))
    kind[odd] = len(one) + np.arange(len(odd))
    one = np.concatenate([one, odd])
    return one, kind, np.stack([h[one], check[one], (ends - starts)[one].astype(np.uint64)])


class Memo:
    """Ids of short units met lately, by their keys; what it holds spares work and changes no result."""

    def __init__(self, limit: int = MEMO_UNITS):
        self.limit = limit
        self.keys = np.zeros((3, 0), np.uint64)  # sorted by the first hash, which is unique
        self.begin = self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are held, and the places of all in the memo."""
        if not self.keys.shape[1]:
            return np.zeros(keys.shape[1], bool), np.zeros(keys.shape[1], np.int64)
        at = np.minimum(np.searchsorted(self.keys[0], keys[0]), self.keys.shape[1] - 1)
        return (self.keys[:, at] == keys).all(0), at

    def add(self, keys: np.ndarray, ids: np.ndarray, counts: np.ndarray, used: np.ndarray) -> None:
        """Takes in units with their ids, one after the other; a full memo keeps of the old ones the `used`."""
        take = np.flatnonzero(keys[2] <= MEMO_UNIT)[: self.limit]
        old = np.arange(self.keys.shape[1])
        if len(old) + len(take) > self.limit:
            old = old[used][: self.limit - len(take)]
        all_keys = np.concatenate([self.keys[:, old], keys[:, take]], 1)
        _, one = np.unique(all_keys[0], return_index=True)
        begin = np.concatenate([self.begin[old], len(self.ids) + (np.cumsum(counts) - counts)[take]])[one]
        n = np.concatenate([self.count[old], counts[take]])[one]
        self.ids = _taken(np.concatenate([self.ids, ids]), begin, n)
        self.keys, self.begin, self.count = all_keys[:, one], np.cumsum(n) - n, n


def _taken(values: np.ndarray, begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Stretches of an array, one after the other."""
    return values[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def _encode_piece(data: np.ndarray, offsets: np.ndarray, v: Vocabulary, memo: Memo) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a piece's rows, one after the other, and how many each has."""
    if b"\xe2\x96\x81" in data.tobytes():
        raw = data.tobytes()
        texts = [raw[a:b].replace(BLANK.encode(), b" ") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    wide, starts, ends, row = _units(data, offsets)
    one, kind, keys = _distinct(wide, starts, ends)
    held, place = memo.find(keys)
    new = np.flatnonzero(~held)
    fresh, ids, counts, size = one[new], [], [], (ends - starts)[one[new]]
    total, first = np.cumsum(size), 0
    while first < len(fresh):
        done = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, done + BLOCK_BYTES, "right")))
        n = size[first:last] + 1
        begin = np.cumsum(n) - n
        block = np.full(n.sum(), BETWEEN, np.uint8)
        keep = np.ones(len(block), bool)
        keep[begin + n - 1] = False
        block[keep] = _taken(wide, starts[fresh[first:last]], n - 1)
        got, count = segment(block, begin, v)
        ids.append(got)
        counts.append(count)
        first = last
    ids = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    begin, n = np.zeros(len(one), np.int64), np.zeros(len(one), np.int64)
    begin[held], n[held] = memo.begin[place[held]], memo.count[place[held]]
    begin[new], n[new] = len(memo.ids) + np.cumsum(counts) - counts, counts
    begin, n = begin[kind], n[kind]
    per_row = np.bincount(row, n, len(offsets) - 1).astype(np.int64)
    out = _taken(np.concatenate([memo.ids, ids]), begin, n)
    if len(new):
        used = np.zeros(len(memo.count), bool)
        used[place[held]] = True
        memo.add(keys[:, new], ids, counts, used)
    return out, per_row


def encode_batch(texts: pa.Array, v: Vocabulary, memo: Memo | None = None) -> pa.Array:
    """Ids of a batch of texts as list<int32>; a memo carries units over to the next batch."""
    data, offsets = flat(texts)
    memo = Memo() if memo is None else memo
    parts = [_encode_piece(piece, at, v, memo) for _, _, piece, at in pieces(data, offsets, PIECE_BYTES)]
    ids = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int32)
    total = np.concatenate([[0], np.cumsum(np.concatenate([p[1] for p in parts]) if parts else [])])
    return pa.ListArray.from_arrays(pa.array(total.astype(np.int32)), pa.array(ids, pa.int32()), mask=texts.is_null())


def decoded(ids: pa.ListArray, v: Vocabulary):
    """The bytes of every list of ids, None for null."""
    values, offsets = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
    for k, null in enumerate(ids.is_null().to_pylist()):
        mine = values[offsets[k] : offsets[k + 1]]
        raw = _taken(v.out_bytes, v.out_at[mine], v.out_at[mine + 1] - v.out_at[mine]).tobytes()
        yield None if null else raw[raw[:1] == b" " :]


def decode_batch(ids: pa.ListArray, v: Vocabulary) -> pa.Array:
    """Texts of a batch of id lists; bytes that are no UTF-8 become U+FFFD."""
    return pa.array([None if raw is None else raw.decode("utf-8", "replace") for raw in decoded(ids, v)], pa.string())


def encode(docs: DataFrame, v: Vocabulary, text: str = "text") -> DataFrame:
    """Adds `ids` of every whole text, `decoded_sha256` of what they decode to, and `exact`: is that the text.

    Decoding in the same pass spares a second set of workers and sends no text back.
    """

    memo = Memo()  # every task starts with a copy of its own

    @F.arrow_udf("struct<ids:array<int>,decoded_sha256:string,exact:boolean>")
    def run(texts: pa.Array) -> pa.Array:
        ids = encode_batch(texts, v, memo)
        data, offsets = flat(texts)
        sums, exact = [], []
        for k, raw in enumerate(decoded(ids, v)):
            sums.append(None if raw is None else hashlib.sha256(raw).hexdigest())
            exact.append(raw is None or raw == data[offsets[k] : offsets[k + 1]].tobytes())
        return pa.StructArray.from_arrays([ids, pa.array(sums, pa.string()), pa.array(exact, pa.bool_())], ["ids", "decoded_sha256", "exact"])

    rows = docs.withColumn("_coded", run(F.col(text)))
    return rows.withColumns({c: F.col(f"_coded.{c}") for c in ("ids", "decoded_sha256", "exact")}).drop("_coded")


def decode(docs: DataFrame, v: Vocabulary, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Adds the text of every list of ids."""

    @F.arrow_udf("string")
    def run(lists: pa.Array) -> pa.Array:
        return decode_batch(lists, v)

    return docs.withColumn(into, run(F.col(ids)))


def query(spark: SparkSession, folder: str) -> DataFrame:
    rows = encode(documents(spark, folder, "doc_id", "text"), vocabulary())
    n = F.coalesce(F.size("ids"), F.lit(0)).cast("long")
    return rows.select("doc_id", n.alias("n_tokens"), "decoded_sha256", "exact", "ids")
