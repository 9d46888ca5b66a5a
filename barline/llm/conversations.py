"""Repairs the order of roles in conversations at the least cost.

A row may be kept (cost 0), given the role user or assistant (3) or deleted (4), and an empty
message of one of those roles may be inserted anywhere (3); a blank or repeated row must go, and a
truncated one that stays costs 3 more. The roles that are left must read as the initials
`(s?(ua)+)?`. The letters D, I, K, R of the edits in order are the audit; of all cheapest edits the
audit that comes first in ASCII order is taken.

A node is a row and what has been said so far: nothing, s, an even or an odd number of messages. A
cost DP gives every node its cheapest way to the end; arcs on such ways are optimal. A node has at
most one arc of each letter, so the least letter picks its arc, and that letter is its first
rank. Ranks of audits of length 1 give those of length 2, 4, 8, ..., each from the pair of
a node's rank and that of the node its pointer has reached, while the pointers double. Equal
ranks at last mean equal audits, which are then written once, along the doubled pointers.

A conversation may be of any length: rows are dealt out by ranges of (conversation, turn) and numbered, and
PIECE lines make a piece. Of each piece a table of 4 x 4 costs from entry to exit state is taken,
the tables of a conversation are folded from its end, and then every piece is ranked on its own, for
each state it may be entered in; a fold from the front picks one. Texts are not part of this: a line is a byte.
Only `summary` puts a whole conversation's audit and digest together, line by line in one task,
as a digest of one text is; everything else is spread over pieces.

Defined cases: null roles and texts count as one space; rows are taken by turn, nulls first, then by
role, the text's first 64 code points and its SHA-256, so equal rows stand together; a null
conv_id is a conversation of its own; a conversation without rows is absent from `repaired`;
other columns are dropped; an empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.llm.common import kept, partitions

PIECE_BITS = 12
BLANKS = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a message of a user or an assistant leads to, by state.
NEXT = np.array([USER, USER, ASSISTANT, USER])
#: Costs from each state at the end of a conversation, and the messages to insert there.
END = np.array([0, 2 * INSERT, INSERT, 0])
LAST = [[], ["user", "assistant"], ["assistant"], []]
FAR = 1 << 40
NODES = 1 << 19
LETTERS = " DIKR"
ROLES = {USER: "user", ASSISTANT: "assistant"}


def _filled(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with faults planted by the CRC-32 of `conv_id:turn`, modulo 20: 0 drops a row, 1 empties its text, 2 takes
    its `.!?` away, 3 repeats it, 4 makes it the user's."""
    kind = F.crc32(F.concat(_filled("conv_id"), F.lit(":"), _filled("turn")).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", _filled("role").alias("role"), _filled("text").alias("text"), kind.alias("kind")).where("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def lines(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, fault, line, piece): the rows in order, numbered, each with its first fault."""
    spark = rows.sparkSession
    rows = kept(rows.select("conv_id", "turn", _filled("role").alias("role"), _filled("text").alias("text")).withColumn("row", F.monotonically_increasing_id()))
    # The first of equal messages is a number of its own, so that many copies of one message meet in no join.
    same = rows.groupBy("conv_id", "role", F.sha2("text", 256).alias("digest")).agg(F.min(F.struct("turn", "row")).alias("first"))
    firsts = same.select("first.row", F.lit(False).alias("repeats"))
    end = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    fault = F.when(end == "", "blank").when(F.isnull("repeats"), "duplicate").when(~end.isin(".", "!", "?"), "truncated")
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", F.substring("text", 1, 64), F.sha2("text", 256), F.asc_nulls_last("repeats"), "row"]
    flagged = rows.join(firsts, "row", "left")
    dealt = flagged.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    dealt = dealt.select("conv_id", "turn", "role", "text", fault.alias("fault"), F.monotonically_increasing_id().alias("line"))
    return kept(dealt.withColumn("piece", F.shiftright("line", PIECE_BITS)))


def _codes(rows: DataFrame) -> DataFrame:
    """(conv_id, piece, start, codes): a byte a line, its role's initial (1 s, 2 u, 3 a, 0 another), 4 if it must go, 8 if truncated."""
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(0)
    code = code + F.when(F.col("fault").isin("blank", "duplicate"), 4).otherwise(0) + F.when(F.col("fault") == "truncated", 8).otherwise(0)
    both = F.struct("line", code.cast("tinyint").alias("code"))
    pieces = rows.groupBy("conv_id", "piece").agg(F.min("line").alias("start"), F.sort_array(F.collect_list(both)).alias("both"))
    return pieces.select("conv_id", "piece", "start", F.col("both.code").alias("codes"))


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of all lists of a column, and how many each has."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def _costs(codes: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Least costs from every node to the exits: (line, state, exit), pieces one after the other with a line for the exit each.

    `ends` has the costs from each piece's exit states, (piece, state, exit).
    """
    first = np.cumsum(sizes + 1) - sizes - 1
    read = np.cumsum(sizes) - sizes
    out = np.empty((int((sizes + 1).sum()), 4, ends.shape[2]), np.int64)
    out[first + sizes] = ends
    order = np.argsort(-sizes, kind="stable")
    falling = sizes[order]
    for back in range(1, int(sizes.max(initial=0)) + 1):
        some = order[: np.searchsorted(-falling, -back, "right")]
        at = first[some] + sizes[some] - back
        code, after = codes[read[some] + sizes[some] - back], out[at + 1]
        cost = after + DELETE
        stays = (code & 4) == 0
        more = np.where(stays, (code >> 3) * TRUNCATED, FAR)[:, None, None]
        initial = np.where(stays, code & 3, 0)
        said = after[:, NEXT] + more + np.where(initial[:, None] == NEXT, 0, REROLE)[:, :, None]
        cost = np.minimum(cost, said)
        system = np.flatnonzero(initial == SYSTEM)
        cost[system, NOTHING] = np.minimum(cost[system, NOTHING], after[system, SYSTEM] + more[system, 0])
        user, assistant = cost[:, USER], cost[:, ASSISTANT]
        cost[:, USER], cost[:, ASSISTANT] = np.minimum(user, assistant + INSERT), np.minimum(assistant, user + INSERT)
        cost[:, :USER] = np.minimum(cost[:, :USER], cost[:, USER, None] + INSERT)
        out[at] = np.minimum(cost, FAR)
    return out


def _arcs(codes: np.ndarray, sizes: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every node (four a line) the least letter of its optimal arcs, as its place in LETTERS, and where that arc leads."""
    lines = len(cost)
    exits = np.zeros(lines, bool)
    exits[np.cumsum(sizes + 1) - 1] = True
    code = np.full(lines, 4)
    code[~exits] = codes
    stays = ((code & 4) == 0)[:, None]
    more = ((code >> 3) * TRUNCATED)[:, None]
    after = np.concatenate([cost[1:], cost[:1]])
    state = np.arange(4)
    here = np.arange(lines)[:, None] * 4
    same = (code & 3)[:, None] == NEXT
    opens = stays & ((code & 3) == SYSTEM)[:, None] & (state == NOTHING)
    # In falling order of letters: a later one is written over an earlier one.
    letter, to = np.zeros((lines, 4), np.int64), here + state
    ways = [
        (4, stays & (after[:, NEXT] + more + REROLE == cost), here + 4 + NEXT),
        (3, stays & same & (after[:, NEXT] + more == cost), here + 4 + NEXT),
        (3, opens & (after[:, [SYSTEM]] + more == cost), here + 4 + SYSTEM),
        (2, cost[:, NEXT] + INSERT == cost, here + NEXT),
        (1, after + DELETE == cost, here + 4 + state),
    ]
    for k, optimal, target in ways:
        optimal = optimal & ~exits[:, None]
        letter[optimal], to[optimal] = k, np.broadcast_to(target, (lines, 4))[optimal]
    return letter.reshape(-1), to.reshape(-1)


def _audits(letter: np.ndarray, to: np.ndarray, entries: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The audit from each entry node to its exit, and that exit."""
    rank, steps, pointers = letter, (letter > 0).astype(np.int64), []
    while True:
        pointers.append(to)
        if (letter[to] == 0).all():
            break
        rank = np.unique(rank * (rank.max(initial=0) + 1) + rank[to], return_inverse=True)[1]
        steps = steps + steps[to]
        to = to[to]
    rank = np.unique(rank * (rank.max(initial=0) + 1) + rank[to], return_inverse=True)[1]
    one, which = np.unique(rank[entries], return_index=True, return_inverse=True)[1:]
    alphabet = np.frombuffer(LETTERS.encode(), np.uint8)
    written = []
    for node in entries[one].tolist():
        path, k = np.array([node]), 0
        while len(path) < steps[node]:
            path = np.concatenate([path, pointers[k][path]])
            k += 1
        written.append(alphabet[letter[path[: steps[node]]]].tobytes().decode())
    return [written[k] for k in which.tolist()], to[entries]


def _groups(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Consecutive pieces with about NODES nodes."""
    total, first = np.cumsum((sizes + 1) * 4), 0
    while first < len(sizes):
        last = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + NODES, "right")))
        yield first, last
        first = last


def _with(batch: pa.RecordBatch, names: list[str], **new: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([batch.column(c) for c in names] + list(new.values()), [*names, *new])


def _tables(batches):
    """Adds each piece's costs from entry to exit state, and its adjacent initials that may not be."""
    identity = np.where(np.eye(4, dtype=bool), 0, FAR)
    for batch in batches:
        codes, sizes = _flat(batch.column("codes"))
        begin, tables = np.cumsum(sizes) - sizes, []
        for a, b in _groups(sizes):
            mine = sizes[a:b]
            cost = _costs(codes[begin[a] : begin[a] + mine.sum()], mine, np.tile(identity, (b - a, 1, 1)))
            tables.append(cost[np.cumsum(mine + 1) - mine - 1].reshape(b - a, 16))
        table = np.concatenate(tables).reshape(-1) if tables else np.zeros(0, np.int64)
        initial = codes & 3
        wrong = np.append(~_follows(initial[:-1], initial[1:]), False) if len(codes) else np.zeros(0, bool)
        wrong[begin + sizes - 1] = False
        illegal = np.add.reduceat(wrong.astype(np.int64), begin) if len(begin) else np.zeros(0, np.int64)
        offsets = pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * 16)
        yield _with(batch, ["conv_id", "piece", "start", "codes"], costs=pa.ListArray.from_arrays(offsets, pa.array(table)), illegal=pa.array(illegal))


def _follows(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """May initial `b` stand right after `a`: su, ua or au."""
    return ((b == USER) & ((a == SYSTEM) | (a == ASSISTANT))) | ((a == USER) & (b == ASSISTANT))


def _folded(batches):
    """Pieces of a conversation from its end: adds the costs from the exit states of each."""
    now, ends, head = (), END, None
    for batch in batches:
        togo, last, illegal = [], [], []
        rows = zip(batch.column("conv_id").to_pylist(), batch.column("costs").to_pylist(), batch.column("codes"), batch.column("illegal").to_pylist(), strict=True)
        for conv, costs, codes, wrong in rows:
            fresh = (conv,) != now
            if fresh:
                now, ends = (conv,), END
            elif not _follows(np.array([codes[-1].as_py() & 3]), np.array([head]))[0]:
                wrong += 1
            head = codes[0].as_py() & 3
            togo.append(ends.tolist())
            last.append(fresh)
            illegal.append(wrong)
            ends = np.minimum((np.array(costs).reshape(4, 4) + ends).min(1), FAR)
        yield _with(
            batch, ["conv_id", "piece", "start", "codes"], togo=pa.array(togo, pa.list_(pa.int64())), last=pa.array(last, pa.bool_()), illegal=pa.array(illegal, pa.int64())
        )


def _ranked(batches):
    """Adds the least audit of a piece and its exit state for each state that it may be entered in."""
    for batch in batches:
        codes, sizes = _flat(batch.column("codes"))
        togo = _flat(batch.column("togo"))[0].reshape(-1, 4, 1)
        begin, audits, exits = np.cumsum(sizes) - sizes, [], []
        for a, b in _groups(sizes):
            mine = sizes[a:b]
            own = codes[begin[a] : begin[a] + mine.sum()]
            letter, to = _arcs(own, mine, _costs(own, mine, togo[a:b])[:, :, 0])
            first = (np.cumsum(mine + 1) - mine - 1) * 4
            got, end = _audits(letter, to, (first[:, None] + np.arange(4)).reshape(-1))
            audits += got
            exits.append(end & 3)
        offsets = pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * 4)
        exits = np.concatenate(exits) if exits else np.zeros(0, np.int64)
        yield _with(
            batch,
            ["conv_id", "piece", "start", "codes", "last"],
            audits=pa.ListArray.from_arrays(offsets, pa.array(audits, pa.string())),
            exits=pa.ListArray.from_arrays(offsets, pa.array(exits, pa.int64())),
        )


EDITS = "line bigint, edit string, new_role string, before array<string>, after array<string>"


def _edits(batches):
    """Pieces of a conversation from its front: the edit of every line."""
    now, state = (), NOTHING
    for batch in batches:
        out = []
        rows = zip(*(batch.column(c).to_pylist() for c in ("conv_id", "start", "codes", "last", "audits", "exits")), strict=True)
        for conv, line, codes, last, audits, exits in rows:
            if (conv,) != now:
                now, state = (conv,), NOTHING
            entered, before, nth = state, [], 0
            for letter in audits[entered]:
                if letter == "I":
                    state = int(NEXT[state])
                    before.append(ROLES[state])
                    continue
                role = None
                if letter == "K" and codes[nth] & 3 == SYSTEM:
                    state = SYSTEM
                elif letter != "D":
                    state = int(NEXT[state])
                    role = ROLES[state] if letter == "R" else None
                out.append((line, letter, role, before, []))
                line, nth, before = line + 1, nth + 1, []
            if last:
                out[-1][4].extend(LAST[state])
        columns = list(zip(*out, strict=True)) or [[]] * 5
        types = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["line", "edit", "new_role", "before", "after"])


def edited(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every line with its edit and the roles inserted before and after it; and (conv_id, illegal) of every piece."""
    rows = lines(rows)
    n = partitions(rows.sparkSession)
    code = "conv_id {}, piece bigint, start bigint, codes array<tinyint>".format(rows.schema["conv_id"].dataType.simpleString())
    tables = _codes(rows).mapInArrow(_tables, f"{code}, costs array<bigint>, illegal bigint")
    folded = tables.repartition(n, "conv_id").sortWithinPartitions("conv_id", F.desc("piece"))
    folded = kept(folded.mapInArrow(_folded, f"{code}, togo array<bigint>, last boolean, illegal bigint"))
    ranked = folded.repartition(n, "conv_id", "piece").mapInArrow(_ranked, f"{code}, last boolean, audits array<string>, exits array<bigint>")
    edits = ranked.repartition(n, "conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(_edits, EDITS)
    return rows.join(edits, "line"), folded.select("conv_id", "illegal")


def _messages() -> Column:
    """What stays of a line and what is inserted around it, in order."""

    def empty(c: str) -> Column:
        return F.transform(c, lambda r: F.struct(r.alias("role"), F.lit("").alias("text")))

    own = F.array(F.struct(F.coalesce("new_role", "role").alias("role"), F.col("text")))
    return F.concat(empty("before"), F.when(F.col("edit") == "D", F.filter(own, lambda _: F.lit(False))).otherwise(own), empty("after"))


def repaired(rows: DataFrame) -> DataFrame:
    """(conv_id, line, nth, role, text): the messages after repair; those with one `line` in order of `nth`."""
    found = edited(rows)[0].select("conv_id", "line", F.posexplode(_messages()).alias("nth", "m"))
    return found.select("conv_id", "line", "nth", "m.role", "m.text")


def _digests(batches):
    """Lines of a conversation in order: its audit and the SHA-256 of what is left."""
    now, audit, digest, some = (), [], None, False

    def row():
        return now[0], "".join(audit), digest.hexdigest()

    for batch in batches:
        done = []
        for conv, letters, messages in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "letters", "messages")), strict=True):
            if (conv,) != now:
                if now:
                    done.append(row())
                now, audit, digest, some = (conv,), [], hashlib.sha256(), False
            audit.append(letters)
            for m in messages:
                digest.update((("\n" if some else "") + f"{m['role']}:{m['text']}").encode())
                some = True
        kind = batch.schema.field("conv_id").type
        yield _digest_rows(done, kind)
    if now:
        yield _digest_rows([row()], kind)


def _digest_rows(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*done, strict=True)) or [[]] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (kind, pa.string(), pa.string()), strict=True)], ["conv_id", "audit", "repaired_sha256"])


def summary(rows: DataFrame) -> DataFrame:
    """One row for each conversation: gaps, faults, cost, audit and a digest of the repaired messages."""
    found, pieces = edited(rows)
    found = kept(found)
    n = partitions(found.sparkSession)

    def count(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0)).cast("long")

    edit, fault = F.col("edit"), F.col("fault")
    cost = F.when(edit == "D", DELETE).when(edit == "R", REROLE).otherwise(0) + F.when((fault == "truncated") & (edit != "D"), TRUNCATED).otherwise(0)
    cost = cost + INSERT * (F.size("before") + F.size("after"))
    turns = found.groupBy("conv_id", "turn").agg(
        *(count(fault == f).alias(f) for f in ("blank", "duplicate", "truncated")), F.sum(cost).cast("long").alias("cost")
    )
    counts = turns.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        *(F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated", "cost")),
    )
    letters = F.concat(F.repeat(F.lit("I"), F.size("before")), edit, F.repeat(F.lit("I"), F.size("after")))
    dealt = found.select("conv_id", "line", letters.alias("letters"), _messages().alias("messages"))
    dealt = dealt.repartition(n, "conv_id").sortWithinPartitions("conv_id", "line")
    kind = found.schema["conv_id"].dataType.simpleString()
    whole = dealt.mapInArrow(_digests, f"conv_id {kind}, audit string, repaired_sha256 string")
    illegal = pieces.groupBy("conv_id").agg(F.sum("illegal").alias("illegal"))
    for part in (illegal, whole):
        counts = _beside(counts, part)
    return counts.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _beside(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join by conversation; the null conversation meets itself."""
    right = right.withColumnRenamed("conv_id", "_conv")
    return left.join(right, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")


def query(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    found = _beside(rows.select("conv_id").distinct(), summary(damaged(rows)))
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
