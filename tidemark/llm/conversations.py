"""Conversations repaired by the cheapest edits.

A repaired conversation has roles whose initials read ``(s?(ua)+)?``.  Turns are kept (0),
given the role user or assistant (3) or deleted (4), and empty turns are inserted anywhere
(3); a turn that stays though its text breaks off costs 3 more; blank and repeated turns
must go.  Of the cheapest edits those whose initials are ASCII-least are taken.

The cost of the rest of a conversation depends only on what the last turn kept was (nothing,
system, user or assistant), so a vector of four costs, computed backward, decides every edit
on a walk forward.  Vectors are stored at checkpoints only, every square root of the turns,
and recomputed block by block during the walk.

Across machines the same holds at a larger scale.  Turns are sorted by range, so a
conversation may lie in many partitions, and are cut into blocks of consecutive rows.  What
lies of a conversation in one block is a piece, one byte a turn.  Where a conversation has
several pieces, each becomes a matrix from costs after it to costs before it; scanning the
matrices backward gives the vector behind every piece, and scanning forward, with where
each piece leads from each state, the state before it.  Then every piece is walked by
itself.  Only the repaired text's digest, which is one running hash, reads a conversation's
texts one after another, as a stream in constant memory.

Defined results: null roles and texts are one space, a null turn comes before all others;
turns with equal numbers stand in the order of role and then of the digest of role and text;
equal rows are repeated turns; a null id is a conversation of its own; an empty table gives
an empty result; other columns play no part, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 14  # turns of a block: 2 ** 14 at most
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3  # costs, fixed by the contract
NOTHING, SYSTEM, USER, ASSISTANT = range(4)  # what the last turn kept was
FREE, BROKEN, GONE = range(3)  # turns that may stay, that may stay at a price, that must go
OTHER = 3
NEVER = 1 << 40
SPACE = "\t\n\x0b\x0c\r "

Vector = tuple[int, int, int, int]


def damage(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``turn``, ``role``, ``text`` and ``copies`` (0: the row is lost) of conversations damaged by the
    checksum of their id and turn: 0 of 20 drops a row, 1 empties its text, 2 removes its sentence ends, 3 repeats it,
    4 makes it the user's."""
    conv, number = (F.col(f"`{c}`") for c in (conv_id, turn))
    named = [F.coalesce(c.cast("string"), F.lit(" ")) for c in (conv, number)]
    spoken, said = (F.coalesce(F.col(f"`{c}`"), F.lit(" ")) for c in (role, text))
    fate = F.crc32(F.concat(named[0], F.lit(":"), named[1])) % 20
    return rows.select(
        conv.alias("conv"), number.alias("turn"), F.when(fate == 4, "user").otherwise(spoken).alias("role"),
        F.when(fate.isin(0, 1), "").when(fate == 2, F.translate(said, ".!?", "")).otherwise(said).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("copies"))


def rows_of(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Undamaged conversations in the form that ``repair`` takes."""
    return turns.select(F.col(f"`{conv_id}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
                        *(F.coalesce(F.col(f"`{c}`"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))),
                        F.lit(1).alias("copies"))


# --- the four costs ---------------------------------------------------------------------


def _closed(e: int, s: int, u: int, a: int) -> Vector:
    """Costs at a place where empty turns may be inserted first."""
    u, a = min(u, INSERT + a), min(a, INSERT + u)
    return min(e, INSERT + u), min(s, INSERT + u), u, a


END = _closed(0, NEVER, NEVER, 0)


def _before(code: int, after: Vector) -> Vector:
    """Costs before a turn from those after it; ``code`` is four times its kind plus its initial."""
    kind, initial = divmod(code, 4)
    e, s, u, a = after
    if kind == GONE:
        return _closed(DELETE + e, DELETE + s, DELETE + u, DELETE + a)
    more = TRUNCATED if kind == BROKEN else 0
    to_user = more + u + (0 if initial == USER - 1 else REROLE)
    to_assistant = more + a + (0 if initial == ASSISTANT - 1 else REROLE)
    first = min(to_user, more + s) if initial == SYSTEM - 1 else to_user
    return _closed(min(DELETE + e, first), min(DELETE + s, to_user), min(DELETE + u, to_assistant), min(DELETE + a, to_user))


def _step(code: int, state: int, here: Vector, after: Vector) -> str:
    """The ASCII-least of the cheapest edits at a turn; here and after are the costs before and after it."""
    kind, initial = divmod(code, 4)
    cost = here[state]
    if DELETE + after[state] == cost:
        return "D"
    if INSERT + here[ASSISTANT if state == USER else USER] == cost:
        return "I"
    if kind != GONE:
        to = kept(state, initial)
        if to is not None and after[to] + (TRUNCATED if kind == BROKEN else 0) == cost:
            return "K"
    return "R"


def kept(state: int, initial: int) -> int | None:
    """The state after a turn is kept as it is, if it can be."""
    if initial == USER - 1:
        return USER if state != USER else None
    if initial == ASSISTANT - 1:
        return ASSISTANT if state == USER else None
    return SYSTEM if initial == SYSTEM - 1 and state == NOTHING else None


def spoken(state: int) -> int:
    """The state after an inserted or renamed turn."""
    return ASSISTANT if state == USER else USER


def costs(codes: Sequence[int], after: Vector) -> Vector:
    """Costs before the turns from those after them."""
    for code in reversed(codes):
        after = _before(code, after)
    return after


def walk(codes: bytes, state: int = NOTHING, after: Vector = END, last: bool = True) -> tuple[str, int]:
    """The edits of the turns, and the state they lead to.

    Backward, a vector is stored at every checkpoint; forward, the vectors between two are
    computed again.  Insertions at the end belong to the turns that follow, if any do.
    """
    n = len(codes)
    size = max(1, int(np.ceil(np.sqrt(n))))
    stored = {}
    vector = after
    for begin in range((max(n, 1) - 1) // size * size, -1, -size):
        stored[begin] = vector  # behind the block that begins here
        vector = costs(codes[begin:begin + size], vector)
    edits = []
    for begin in range(0, n, size):
        block = codes[begin:begin + size]
        vectors = [stored[begin]]
        for code in reversed(block):
            vectors.append(_before(code, vectors[-1]))
        vectors.reverse()
        for i, code in enumerate(block):
            while True:
                edit = _step(code, state, vectors[i], vectors[i + 1])
                edits.append(edit)
                if edit == "K":
                    state = kept(state, code % 4)
                elif edit != "D":
                    state = spoken(state)
                if edit != "I":
                    break
    while last and END[state]:
        edits.append("I")
        state = spoken(state)
    return "".join(edits), state


# --- pieces -----------------------------------------------------------------------------

PIECE = ("conv {conv}, piece long, block long, codes binary, turns long, first_turn long, last_turn long, n_turns long, blank long, "
         "duplicate long, truncated long, illegal long, first_initial int, last_initial int")
_LEGAL = {(SYSTEM - 1, USER - 1), (USER - 1, ASSISTANT - 1), (ASSISTANT - 1, USER - 1)}


def _piece(rows: pa.Table) -> dict:
    """What the rest needs to know of the turns of a conversation in a block, in their order."""
    copies = rows.column("copies").to_numpy()
    first = np.repeat(np.cumsum(copies) - copies, copies)
    copy = np.arange(len(first)) - first  # 0 for a turn, 1 for its repetition
    fault, initial, seen = (np.repeat(rows.column(c).to_numpy(), copies) for c in ("fault", "initial", "seen"))
    again = (seen | (copy > 0)) & (fault != 1)
    codes = np.where((fault == 1) | again, GONE, np.where(fault == 2, BROKEN, FREE)) * 4 + initial
    turns = rows.column("turn").filter(pa.array(copies > 0)).drop_null().to_numpy()  # ascending
    pairs = zip(initial[:-1].tolist(), initial[1:].tolist())
    return {
        "conv": rows.column("conv")[0], "piece": rows.column("pos")[0].as_py(), "block": rows.column("block")[0].as_py(),
        "codes": codes.astype(np.uint8).tobytes(), "turns": len(codes),
        "first_turn": int(turns[0]) if len(turns) else None, "last_turn": int(turns[-1]) if len(turns) else None,
        "n_turns": len(np.unique(turns)), "blank": int((fault == 1).sum()), "duplicate": int(again.sum()),
        "truncated": int(((fault == 2) & ~again).sum()), "illegal": sum(p not in _LEGAL for p in pairs),
        "first_initial": int(initial[0]) if len(codes) else None, "last_initial": int(initial[-1]) if len(codes) else None}


def _sorted(rows: DataFrame, folder: str) -> DataFrame:
    """The turns in their order, numbered by it, written; conversations are spread over partitions where they are long."""
    trimmed = F.rtrim("text", F.lit(SPACE))
    fault = F.when(trimmed == "", 1).when(F.substring(trimmed, -1, 1).isin(".", "!", "?"), 0).otherwise(2)
    letter = F.substring("role", 1, 1)
    initial = F.when(letter == "s", SYSTEM - 1).when(letter == "u", USER - 1).when(letter == "a", ASSISTANT - 1).otherwise(OTHER)
    said = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    # equal rows are dealt by where they were read: any order of them is the same
    told = rows.select("conv", "turn", "role", "text", "copies", fault.alias("fault"), initial.alias("initial"), said.alias("said"),
                       F.monotonically_increasing_id().alias("read"))
    order = ("conv", "turn", "role", "said", "read")
    placed = told.repartitionByRange(*order).sortWithinPartitions(*order).select(
        *(c for c in told.columns if c != "read"), F.monotonically_increasing_id().alias("pos"))
    placed.write.parquet(f"{folder}/turns")
    return rows.sparkSession.read.parquet(f"{folder}/turns")


def _pieces(turns: DataFrame, conv: str, folder: str) -> DataFrame:
    """The turns by conversation and block, written."""
    spark = turns.sparkSession
    narrow = turns.select("conv", "turn", "copies", "fault", "initial", "pos", "said")
    told = narrow.where("copies > 0").groupBy("conv", "said").agg(F.min("pos").alias("first_pos"), F.count("*").alias("times"))
    again = told.where("times > 1").select(F.col("conv").alias("conv_"), F.col("said").alias("said_"), "first_pos")
    marked = narrow.join(again, F.col("conv").eqNullSafe(F.col("conv_")) & (F.col("said") == F.col("said_")), "left").select(
        "conv", "turn", "copies", "fault", "initial", "pos", F.coalesce(F.col("pos") > F.col("first_pos"), F.lit(False)).alias("seen"),
        F.shiftright("pos", BLOCK_BITS).alias("block"))
    def of_block(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("pos")
        kind = rows.schema.field("conv").type
        ids = rows.column("conv").combine_chunks()
        null = np.asarray(ids.is_null())
        values = ids.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        begins = np.flatnonzero(np.r_[True, (values[1:] != values[:-1]) | (null[1:] != null[:-1])])
        found = [_piece(rows.slice(b, e - b)) for b, e in zip(begins.tolist(), [*begins[1:].tolist(), len(rows)])]
        columns = {name: [p[name] for p in found] for name in found[0]}
        types = {"conv": kind, "codes": pa.binary(), "first_initial": pa.int32(), "last_initial": pa.int32()}
        columns["conv"] = [c.as_py() for c in columns["conv"]]
        return pa.table({name: pa.array(x, types.get(name, pa.int64())) for name, x in columns.items()})

    marked.groupBy("block").applyInArrow(of_block, PIECE.format(conv=conv)).write.parquet(f"{folder}/pieces")
    return spark.read.parquet(f"{folder}/pieces")


def _routes(pieces: DataFrame, conv: str, folder: str) -> DataFrame:
    """For the pieces of conversations that lie in several blocks: the state before and the costs after."""
    spark = pieces.sparkSession
    several = pieces.groupBy("conv").agg(F.count("*").alias("n")).where("n > 1").select(F.col("conv").alias("conv_"))
    cut = pieces.select("conv", "piece", "codes").join(several, F.col("conv").eqNullSafe(F.col("conv_")), "left_semi")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            columns = [[costs(r["codes"], tuple(0 if i == j else NEVER for i in range(4))) for j in range(4)] for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([sum(map(list, c), []) for c in columns], pa.list_(pa.int64()))],
                                             names=["conv", "piece", "matrix"])

    def backward(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("piece")
        after, found = END, []
        for matrix in reversed(rows.column("matrix").to_pylist()):
            found.append(list(after))
            after = tuple(min(matrix[4 * j + i] + after[j] for j in range(4)) for i in range(4))
        return pa.table({"piece": rows.column("piece"), "after": pa.array(found[::-1], pa.list_(pa.int64()))})

    behind = cut.mapInArrow(matrices, f"conv {conv}, piece long, matrix array<long>").groupBy("conv").applyInArrow(backward, "piece long, after array<long>")

    def leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            to = [[walk(r["codes"], s, tuple(r["after"]), False)[1] for s in range(4)] for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("piece"), batch.column("after"), pa.array(to, pa.list_(pa.int64()))],
                                             names=["conv", "piece", "after", "to"])

    def forward(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("piece")
        state, found = NOTHING, []
        for to in rows.column("to").to_pylist():
            found.append(state)
            state = to[state]
        last = np.arange(len(rows)) == len(rows) - 1
        return pa.table({"piece": rows.column("piece"), "state": pa.array(found, pa.int64()), "after": rows.column("after"), "last": pa.array(last)})

    led = cut.join(behind, "piece").select("conv", "piece", "codes", "after").mapInArrow(leads, f"conv {conv}, piece long, after array<long>, to array<long>")
    led.groupBy("conv").applyInArrow(forward, "piece long, state long, after array<long>, last boolean").write.parquet(f"{folder}/routes")
    return spark.read.parquet(f"{folder}/routes")


RESULT = ("conv {conv}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
_NAMES = {USER: b"user", ASSISTANT: b"assistant"}


class _Repaired:
    """The result of one conversation under construction: its pieces first, then its texts."""

    def __init__(self, conv):
        self.conv, self.audit, self.at, self.state = conv, [], 0, NOTHING
        self.sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.edits, self.digest, self.lines, self.last, self.cost = None, hashlib.sha256(), 0, None, 0
        self.least = self.greatest = None
        self.turns = 0

    def piece(self, row: dict) -> None:
        if not row["turns"]:
            return
        self.audit.append(row["audit"])
        for name in self.sums:
            self.sums[name] += row[name]
        if self.last is not None and (self.last, row["first_initial"]) not in _LEGAL:
            self.sums["illegal"] += 1
        self.last = row["last_initial"]
        self.turns += row["n_turns"] - (self.greatest is not None and row["first_turn"] == self.greatest)
        self.least = row["first_turn"] if self.least is None else self.least
        self.greatest = row["last_turn"] if row["last_turn"] is not None else self.greatest

    def _line(self, role: bytes, text: bytes = b"") -> None:
        self.digest.update(b"\n" + role + b":" + text if self.lines else role + b":" + text)
        self.lines += 1

    def _inserted(self) -> None:
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self.state = spoken(self.state)
            self._line(_NAMES[self.state])
            self.cost += INSERT
            self.at += 1

    def turn(self, row: dict) -> None:
        self._joined()
        for _ in range(row["copies"]):
            self._inserted()
            edit = self.edits[self.at]
            self.at += 1
            if edit == "D":
                self.cost += DELETE
                continue
            self.cost += TRUNCATED if row["fault"] == 2 else 0
            if edit == "K":
                self.state = kept(self.state, row["initial"])
                self._line(row["role"].encode(), row["text"].encode())
            else:
                self.cost += REROLE
                self.state = spoken(self.state)
                self._line(_NAMES[self.state], row["text"].encode())

    def _joined(self) -> None:
        if self.edits is None:
            self.edits, self.audit = "".join(self.audit), []

    def result(self) -> tuple:
        self._joined()
        self._inserted()
        gaps = 0 if self.least is None else self.greatest - self.least + 1 - self.turns
        return (self.conv, gaps, *self.sums.values(), self.cost, self.edits, self.digest.hexdigest())


def repair(rows: DataFrame, folder: str) -> DataFrame:
    """One row a conversation: ``conv``, faults, cost, edits (``audit``) and the digest of what is left.

    ``rows`` as of ``damage`` or ``rows_of``; ``folder`` is shared and gets the sorted turns and the pieces.
    """
    conv = rows.schema["conv"].dataType.simpleString()
    turns = _sorted(rows, folder)
    pieces = _pieces(turns, conv, folder)
    routed = pieces.join(_routes(pieces, conv, folder), "piece", "left")
    told = [c for c in routed.columns if c not in ("codes", "state", "after", "last", "block")]

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            state, after, last = (batch.column(c).to_pylist() for c in ("state", "after", "last"))
            edits = [walk(c) if s is None else walk(c, s, tuple(a), z)
                     for c, s, a, z in zip(batch.column("codes").to_pylist(), state, after, last)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in told), pa.array([e for e, _ in edits], pa.string())], names=[*told, "audit"])

    kinds = ", ".join(f"{c} {routed.schema[c].dataType.simpleString()}" for c in told)
    edited = routed.mapInArrow(walked, f"{kinds}, audit string").withColumnRenamed("piece", "pos")
    texts = turns.where("copies > 0").select("conv", "pos", "role", "text", "copies", "fault", "initial")
    both = edited.unionByName(texts, allowMissingColumns=True).withColumn("is_text", F.col("audit").isNull())
    streamed = both.repartition("conv").sortWithinPartitions("conv", "is_text", "pos")
    kind = rows.sparkSession.createDataFrame([], f"conv {conv}").toArrow().schema.field("conv").type

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, done = None, []

        def batch_of(results: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*results))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:7]), *(pa.array(c, pa.string()) for c in columns[7:])],
                names=["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"])

        for batch in batches:
            for row in batch.to_pylist():
                if open_ is None or open_.conv != row["conv"]:
                    if open_ is not None:
                        done.append(open_.result())
                    open_ = _Repaired(row["conv"])
                (open_.turn if row["is_text"] else open_.piece)(row)
            if done:
                yield batch_of(done)
                done = []
        if open_ is not None:
            yield batch_of([open_.result()])

    return streamed.mapInArrow(finish, RESULT.format(conv=conv))
