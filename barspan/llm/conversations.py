"""Conversation structure repair: the cheapest edits that make a conversation's roles alternate, and of equally cheap ones the least audit.

The roles of a repaired conversation read nothing, or an optional system turn and then pairs of user and assistant. A node is a row and
a state of that grammar. Costs to the end are found backwards; arcs whose cost fills the gap between two nodes are optimal. Such arcs
are ranked by what they spell: by their own letter, then by the next 2, 4, 8, ... letters, each step from the ranks before and a pointer
that doubles its reach. The least arc at the start and the doubled pointers give the whole path.

A conversation may be longer than a task holds. Rows are sorted over the cluster by conversation and turn, and cut into pieces of bounded
size. A piece is a matrix of costs between states at its ends. Matrices are multiplied within a task's share of a
conversation, then over its shares (at most one per partition); that gives the costs at the end of each piece. Each piece then tells which state it leads
to from each state, in the same two steps, and finally all pieces spell their part of the path. A conversation in one piece needs none of this.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barspan.llm import texts as tx
from barspan.session import scratch_dir

#: Bounds of a piece; one row may be longer.
PIECE_ROWS = 1024
PIECE_BYTES = 1 << 20

# What the edits cost; a truncated row that stays costs more.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

# States of the grammar: at the start, after system, after user, after assistant. All letters but a first 's' lead to NEXT.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = np.array([USER, USER, ASSISTANT, USER])
#: Inserted turns that are left at the end of a conversation, in each state.
TO_END = np.array([0, 2, 1, 0]) * INSERT

# A row's code is 4 * initial + fault.
INITIALS = "sua"
OTHER = 3
SOUND, BLANK, DUPLICATE, CUT = range(4)

_FAR = 1 << 40


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code and state: what keeping costs, and where it leads; by code: what a new role costs."""
    keep, to, rerole = np.full((16, 4), _FAR), np.zeros((16, 4), np.int64), np.full(16, _FAR)
    allowed = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
    for code in range(16):
        initial, fault = divmod(code, 4)
        if fault in (BLANK, DUPLICATE):
            continue
        more = TRUNCATED if fault == CUT else 0
        rerole[code] = REROLE + more
        for state in range(4):
            if (state, initial) in allowed:
                keep[code, state], to[code, state] = KEEP + more, allowed[state, initial]
    return keep, to, rerole


KEEP_COST, KEEP_TO, REROLE_COST = _tables()

_LEGAL = {(0, 1), (1, 2), (2, 1)}  # su, ua, au

# Letters of the audit in ASCII order; 0 ends a path.
LETTERS = np.frombuffer(b"\0DIKR", np.uint8)
_DELETE, _INSERT, _KEEP, _REROLE = range(1, 5)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) with planted faults, chosen by crc32('conv_id:turn') % 20; nulls read as one space.

    0 drops a row, 1 empties its text, 2 removes '.', '!' and '?', 3 repeats it, 4 makes it a user's. Other columns are left out.
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), fault.alias("fault")).where("fault <> 0")
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("fault") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("_copy")).drop("_copy")


def _coded(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, code without duplicates, digest of role and text)."""
    blank = r"[^\x20\x09-\x0D]"
    rows = rows.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text")
    )
    initial = F.substring("role", 1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    fault = F.when(~F.col("text").rlike(blank), BLANK).when(F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), SOUND).otherwise(CUT)
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256))
    return rows.select("*", (number * 4 + fault).alias("code"), digest.alias("digest"))


class _Open:
    """The piece that rows are added to."""

    def __init__(self, conv, number: int, first: bool):
        self.conv, self.number, self.first = conv, number, first
        self.codes, self.digests = bytearray(), bytearray()
        self.bytes = self.n_turns = self.illegal = 0
        self.turns: list = []  # first and last, nulls too
        self.known: list = []  # first and last that are not null

    def row(self, whole: bool) -> tuple:
        return (
            self.conv, self.number, bytes(self.codes), bytes(self.digests) if whole else None, self.illegal, self.n_turns,
            self.turns[0], self.turns[-1], self.known[0] if self.known else None, self.known[-1] if self.known else None,
        )


_PIECE = ["conv", "piece", "codes", "digests", "illegal", "n_turns", "first_turn", "last_turn", "min_turn", "max_turn"]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to pieces. Duplicates within the task's share of a conversation are marked; the digests of a share that may go on in
    another partition are kept, so that the rest can be found."""
    part, kinds = TaskContext.get().partitionId(), None
    now: _Open | None = None
    seen: set[bytes] = set()
    before: tuple | None = None  # turn and initial of the row before in this conversation
    share = 0
    waiting: list[pa.Array] = []

    def told(done: list[tuple]) -> pa.RecordBatch:
        sizes = np.array([len(d[2]) for d in done])
        rows = pa.concat_arrays(waiting)
        waiting[:] = [rows.slice(int(sizes.sum()))]
        listed = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), rows.slice(0, int(sizes.sum())))
        columns = [pa.array(v, kinds[name]) for name, v in zip(_PIECE, zip(*done))]
        return pa.RecordBatch.from_arrays([*columns, pa.array([part] * len(done), pa.int32()), listed], [*_PIECE, "part", "rows"])

    for batch in batches:
        schema = batch.schema
        if kinds is None:
            turn = schema.field("turn").type
            kinds = {
                "conv": schema.field("conv").type, "piece": pa.int32(), "codes": pa.binary(), "digests": pa.binary(), "illegal": pa.int64(),
                "n_turns": pa.int64(), "first_turn": turn, "last_turn": turn, "min_turn": turn, "max_turn": turn,
            }
        done = []
        columns = [batch.column(c).to_pylist() for c in ("conv", "turn", "code", "digest")]
        sizes = pc.binary_length(batch.column("text")).to_pylist()
        for conv, turn, code, digest, size in zip(*columns, sizes):
            if now is None or conv != now.conv:
                if now is not None:
                    done.append(now.row(now.first))
                    share += 1
                now, before = _Open(conv, 0, share == 0), None
                seen.clear()
            elif len(now.codes) == PIECE_ROWS or now.bytes + size > PIECE_BYTES:
                done.append(now.row(True))
                now = _Open(conv, now.number + 1, share == 0)
            if digest in seen and code % 4 != BLANK:
                code += DUPLICATE - code % 4
            seen.add(digest)
            now.codes.append(code)
            now.digests += digest
            now.bytes += size
            if before is not None and (before[1], code // 4) not in _LEGAL:
                now.illegal += 1
            if turn is not None and (before is None or before[0] != turn):
                now.n_turns += 1
            before = (turn, code // 4)
            now.turns[1:] = [turn]
            if turn is not None:
                now.known[1:] = [turn]
        waiting.append(pa.StructArray.from_arrays([batch.column("role"), batch.column("text")], ["role", "text"]))
        if done:
            yield told(done)
    if now is not None:
        yield told([now.row(True)])


def matrix(codes: bytes) -> np.ndarray:
    """Least cost from each state before these rows to each state behind them; inserted turns stand before a row."""
    out = np.where(np.eye(4, dtype=bool), 0, _FAR)
    for code in codes:
        out = np.minimum(_product(out, _STEPS[code]), _FAR)
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None]).min(axis=1)


def _steps() -> np.ndarray:
    inserts = np.full((4, 4), _FAR)
    for state in range(4):
        one, two = NEXT[state], NEXT[NEXT[state]]
        for to, cost in ((two, 2 * INSERT), (one, INSERT), (state, 0)):
            inserts[state, to] = min(inserts[state, to], cost)
    out = np.full((16, 4, 4), _FAR)
    for code in range(16):
        for state in range(4):
            for to, cost in ((state, DELETE), (KEEP_TO[code, state], KEEP_COST[code, state]), (NEXT[state], REROLE_COST[code])):
                out[code, state, to] = min(out[code, state, to], cost)
        out[code] = np.minimum(_product(inserts, out[code]), _FAR)
    return out


_STEPS = _steps()


class Paths:
    """Optimal paths through a batch of pieces: from each row and state on, by cost and then by letters.

    ``exits`` are the costs that remain behind each piece, ``last`` says which ones end a conversation.
    """

    def __init__(self, codes: list[bytes], exits: np.ndarray, last: np.ndarray):
        sizes = np.array([len(c) for c in codes], np.int64)
        self.layers = np.cumsum(sizes + 1) - sizes - 1  # first layer of each piece; layer i of a piece is before its row i
        rows = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(codes), np.uint8)
        cost = np.zeros((int(sizes.sum()) + len(sizes), 4), np.int64)
        cost[self.layers + sizes] = np.where(last[:, None], TO_END, exits)
        longest_first = np.argsort(-sizes, kind="stable")
        for k in range(1, int(sizes.max(initial=0)) + 1):
            some = longest_first[: int(np.searchsorted(-sizes[longest_first], -k, side="right"))]
            layer, code = self.layers[some] + sizes[some] - k, flat[rows[some] + sizes[some] - k]
            behind = cost[layer + 1]
            least = np.minimum(DELETE + behind, KEEP_COST[code] + np.take_along_axis(behind, KEEP_TO[code], axis=1))
            least = np.minimum(least, REROLE_COST[code][:, None] + behind[:, NEXT])
            cost[layer] = np.minimum(least, np.minimum(INSERT + least[:, NEXT], 2 * INSERT + least[:, NEXT[NEXT]]))
        self.cost = cost
        self._link(flat, sizes, last)
        self._rank()

    def _link(self, flat: np.ndarray, sizes: np.ndarray, last: np.ndarray) -> None:
        """Optimal arcs (from, letter, to, row) between nodes 4 * layer + state; paths end in arcs of letter 0 onto themselves."""
        cost, state = self.cost, np.arange(4)
        ends = self.layers + sizes
        inner = np.ones(len(cost), bool)
        inner[ends] = False
        layer = np.flatnonzero(inner)
        behind, here = cost[layer + 1], cost[layer]
        kept, found = KEEP_TO[flat], []

        def arcs(optimal: np.ndarray, letter: int, at: np.ndarray, to_layer: np.ndarray, to_state: np.ndarray, row: np.ndarray) -> None:
            i, s = np.nonzero(optimal)
            target = 4 * to_layer[i] + np.broadcast_to(to_state, optimal.shape)[i, s]
            found.append((4 * at[i] + s, np.full(len(i), letter), target, row[i]))

        row = np.arange(len(flat))
        none = np.full(len(cost), -1)
        arcs(DELETE + behind == here, _DELETE, layer, layer + 1, state, row)
        arcs(KEEP_COST[flat] + np.take_along_axis(behind, kept, axis=1) == here, _KEEP, layer, layer + 1, kept, row)
        arcs(REROLE_COST[flat][:, None] + behind[:, NEXT] == here, _REROLE, layer, layer + 1, NEXT, row)
        # Turns are inserted before a row, and at the end of the last piece.
        open_layer = np.concatenate([layer, ends[last]])
        arcs(INSERT + cost[open_layer][:, NEXT] == cost[open_layer], _INSERT, open_layer, open_layer, NEXT, none)
        stop = np.where(last[:, None], cost[ends] == 0, True)
        arcs(stop, 0, ends, ends, state, none)
        self.source, self.letter, self.target, self.row = (np.concatenate(x) for x in zip(*found))

    def _least(self, rank: np.ndarray) -> np.ndarray:
        """The arc of the least rank out of each node."""
        order = np.lexsort((rank, self.source))
        first = np.flatnonzero(np.append(True, np.diff(self.source[order]) > 0)) if len(order) else order
        out = np.full(4 * len(self.cost), -1)
        out[self.source[order][first]] = order[first]
        return out

    def _rank(self) -> None:
        """Ranks of the arcs by 1, 2, 4, ... letters, and pointers as many arcs ahead.

        The arcs out of a node have different letters, as each edit leads to one node; so what an arc spells ahead settles where it is then,
        and one pointer per arc and length is enough.
        """
        rank = self.letter.astype(np.int64)
        self.pointers = [self._least(rank)[self.target]]
        while len(rank) and self.letter[self.pointers[-1]].any():
            ahead = self.pointers[-1]
            _, rank = np.unique(rank * (rank.max() + 1) + rank[ahead], return_inverse=True)
            self.pointers.append(ahead[ahead])
        self.start = self._least(rank)

    def exit_states(self, piece: int) -> list[int]:
        """Where the least path from each state before the piece leaves it."""
        arcs = self.start[4 * self.layers[piece] + np.arange(4)]
        # The last pointer reaches the end of every path, from its second arc on.
        return (self.target[self.pointers[-1][arcs]] % 4).tolist()

    def spelled(self, entries: np.ndarray) -> np.ndarray:
        """[piece, place]: the arcs of the least path from these states before the pieces; arcs of letter 0 fill up."""
        path = self.start[4 * self.layers + entries][:, None]
        for ahead in reversed(self.pointers):
            path = np.stack([path, ahead[path]], axis=2).reshape(len(path), -1)
        return path


def _by_run(df: DataFrame, run: list[str], order: Column) -> DataFrame:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *run).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in run], order)


def _carry(df: DataFrame, run: list[str], schema: str, begin: Callable, step: Callable) -> DataFrame:
    """Rows of each run in their order, with new columns from what the rows before left: step(state, row) gives the new state and the values."""
    names = [c.split()[0] for c in schema.split(", ")]

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = object(), None
        for batch in batches:
            values = []
            for row in batch.to_pylist():
                own = tuple(row[c] for c in run)
                if own != key:
                    key, state = own, begin()
                state, new = step(state, row)
                values.append(new)
            arrays = [pa.array([v[i] for v in values], f.type) for i, f in enumerate(added)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, *names])

    added = pa.schema([(n, pa.list_(pa.int64()) if "array" in c else pa.int64()) for n, c in zip(names, schema.split(", "))])
    return df.mapInArrow(go, df.select("*", *[F.lit(None).cast(c.split()[1]).alias(n) for n, c in zip(names, schema.split(", "))]).schema)


def _same(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys of which the conversation may be null; the keys come once."""
    b = b.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return a.join(b, cond, how).drop(*[f"_r_{k}" for k in keys])


def _written(df: DataFrame, label: str) -> DataFrame:
    folder = scratch_dir(df.sparkSession, label)
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


RUN, PIECE = ["conv", "part"], ["conv", "part", "piece"]


def _late_duplicates(narrow: DataFrame) -> DataFrame:
    """(conv, part, piece, late): places of rows whose role and text another partition's share of the conversation has seen earlier."""
    held = narrow.where(F.col("digests").isNotNull())
    spanning = held.groupBy("conv").agg(F.min("part").alias("_low"), F.max("part").alias("_high")).where("_low < _high").select("conv")
    places = F.sequence(F.lit(0), (F.length("digests") / 32 - 1).cast("int"))
    rows = _same(held.select(*PIECE, "digests"), spanning, ["conv"]).withColumn("at", F.explode(places))
    rows = rows.select(*PIECE, "at", F.substring("digests", F.col("at") * 32 + 1, F.lit(32)).alias("digest"))
    first = rows.groupBy("conv", "digest").agg(F.min("part").alias("_first"), F.max("part").alias("_last")).where("_first < _last")
    again = _same(rows, first.select("conv", "digest", "_first"), ["conv", "digest"]).where("part > _first")
    return again.groupBy(*PIECE).agg(F.collect_list("at").alias("late"))


def _with_late(codes: bytes, late: list[int] | None) -> bytes:
    """The codes with these rows as duplicates, unless they are blank."""
    out = bytearray(codes)
    for at in late or ():
        if out[at] % 4 != BLANK:
            out[at] += DUPLICATE - out[at] % 4
    return bytes(out)


def _plan(narrow: DataFrame) -> DataFrame:
    """For the pieces of conversations with several ones: late duplicates, costs behind the piece, whether it is the last, and the state before it."""
    many = narrow.groupBy("conv").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("conv")
    several = _same(narrow.select(*PIECE, "codes", "first_turn", "last_turn"), many, ["conv"])
    several = _written(_same(several, _late_duplicates(narrow), PIECE, "left"), "pieces-of-several")

    # From the end of each share: the matrix behind a piece, and the one with it.
    def back(behind, row):
        own = matrix(_with_late(row["codes"], row["late"]))
        upto = np.minimum(_product(own, behind), _FAR)
        return upto, (behind.ravel().tolist(), upto.ravel().tolist())

    whole = lambda: np.where(np.eye(4, dtype=bool), 0, _FAR)
    behind = _carry(_by_run(several, RUN, F.desc("piece")), RUN, "behind array<bigint>, upto array<bigint>", whole, back)
    behind = _written(behind, "pieces-behind")
    first_code, last_code = F.conv(F.hex(F.substring("codes", 1, 1)), 16, 10).cast("long"), F.conv(F.hex(F.substring("codes", -1, 1)), 16, 10).cast("long")
    shares = behind.groupBy(*RUN).agg(
        F.min_by("upto", "piece").alias("total"), F.max("piece").alias("_last_piece"),
        F.min_by(first_code, "piece").alias("first_code"), F.max_by(last_code, "piece").alias("last_code"),
        F.min_by(F.struct("first_turn"), "piece").alias("first_turn"), F.max_by(F.struct("last_turn"), "piece").alias("last_turn"),
    )

    # From the end of each conversation: costs behind a share; its border with the next one.
    def close(state, row):
        costs, following = state
        own = np.array(row["total"]).reshape(4, 4)
        border = [0, 0]
        if following is not None:
            turn = row["last_turn"]["last_turn"]
            border = [int((row["last_code"] // 4, following[0] // 4) not in _LEGAL), int(turn is not None and turn == following[1])]
        new = ((own + costs[None]).min(axis=1), (row["first_code"], row["first_turn"]["first_turn"]))
        return new, (costs.tolist(), int(following is None), *border)

    ends = _carry(
        _by_run(shares, ["conv"], F.desc("part")), ["conv"], "share_exit array<bigint>, share_last bigint, border_illegal bigint, border_turn bigint",
        lambda: (TO_END, None), close,
    )
    ends = ends.select(*RUN, "_last_piece", "share_exit", "share_last", "border_illegal", "border_turn")
    pieces = _same(behind.drop("upto", "first_turn", "last_turn"), ends, RUN)

    # Forward: the state that each state before the share has become before a piece, and behind it.
    def forth(states, row):
        last = bool(row["share_last"]) and row["piece"] == row["_last_piece"]
        costs = (np.array(row["behind"]).reshape(4, 4) + np.array(row["share_exit"])[None]).min(axis=1)
        paths = Paths([_with_late(row["codes"], row["late"])], costs[None], np.array([last]))
        led = paths.exit_states(0)
        return [led[s] for s in states], (costs.tolist(), int(last), states, [led[s] for s in states])

    led = _carry(
        _by_run(pieces, RUN, F.asc("piece")), RUN, "exit array<bigint>, last bigint, before array<bigint>, after array<bigint>", lambda: list(range(4)), forth
    )
    led = _written(led.drop("codes", "behind", "share_exit", "share_last"), "pieces-led")
    turns = led.groupBy(*RUN).agg(F.max_by("after", "piece").alias("led"))
    entries = _carry(_by_run(turns, ["conv"], F.asc("part")), ["conv"], "entry bigint", lambda: START, lambda s, row: (row["led"][s], (s,)))
    out = _same(led, entries.select(*RUN, "entry"), RUN)
    ending = F.col("piece") == F.col("_last_piece")
    return out.select(
        *PIECE, "late", "exit", "last", F.get("before", F.col("entry").cast("int")).alias("entry"),
        F.when(ending, F.col("border_illegal")).otherwise(0).alias("border_illegal"), F.when(ending, F.col("border_turn")).otherwise(0).alias("border_turn"),
    )


_EDITED = "array<struct<edit:string,role:string,text:string>>"
_COUNTS = ["blank", "duplicate", "truncated"]


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces and what is known of their surroundings to edits and repaired turns."""
    letters = pa.array([chr(c) for c in LETTERS], pa.string())
    for batch in batches:
        if not batch.num_rows:
            continue
        single = np.array([x is None for x in batch.column("entry").to_pylist()])
        codes = [_with_late(c, late) for c, late in zip(batch.column("codes").to_pylist(), batch.column("late").to_pylist())]
        exits = np.array([x or [0] * 4 for x in batch.column("exit").to_pylist()], np.int64)
        last = np.array([x is None or x == 1 for x in batch.column("last").to_pylist()])
        entries = np.array([x or START for x in batch.column("entry").to_pylist()], np.int64)
        paths = Paths(codes, exits, last)
        spelled = paths.spelled(entries)
        letter = paths.letter[spelled]
        audit = [LETTERS[x[x > 0]].tobytes().decode() for x in letter]

        # Turns of the result: a row's own role and text, or a new role, or an empty text.
        listed = batch.column("rows")
        rows = listed.flatten()
        n = len(rows)
        roles = pa.concat_arrays([rows.field("role"), pa.array(["user", "assistant"], rows.field("role").type)])
        words = pa.concat_arrays([rows.field("text"), pa.array([""], rows.field("text").type)])
        stays = letter > _DELETE
        arc, edit = spelled[stays], letter[stays]
        new_role = n + (paths.target[arc] % 4 == ASSISTANT)
        role = roles.take(pa.array(np.where(edit == _KEEP, paths.row[arc], new_role)))
        text = words.take(pa.array(np.where(edit == _INSERT, n, paths.row[arc])))
        offsets = pa.array(np.concatenate([[0], np.cumsum(stays.sum(axis=1))]), pa.int32())
        repaired = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([letters.take(pa.array(edit)), role, text], ["edit", "role", "text"]))

        faults = [np.frombuffer(c, np.uint8) % 4 for c in codes]
        counts = [pa.array([int((f == kind).sum()) for f in faults], pa.int64()) for kind in (BLANK, DUPLICATE, CUT)]
        cost = paths.cost[paths.layers, entries]
        kept = [c for c in batch.schema.names if c in _KEPT]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), pa.array(single), *counts, pa.array(cost), pa.array(audit, pa.string()), repaired],
            [*kept, "single", *_COUNTS, "cost", "audit", "repaired"],
        )


_KEPT = ["conv", "part", "piece", "illegal", "n_turns", "min_turn", "max_turn"]


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Pieces of repaired conversations, in the order (conv, part, piece): counts, cost to the end, audit, and the repaired turns.

    ``single`` says that the piece is its whole conversation; see ``summary`` for one line per conversation and ``repaired_turns`` for one per turn.
    Rows are ordered by turn, nulls first; rows of one turn by role and then a hash of role and text. Faults of a row, the first of which counts: ``blank`` (no other character
    than white space), ``duplicate`` (the conversation has its role and text earlier), ``truncated`` (its last character that is no
    white space is none of '.!?'). Blank and duplicate rows must be deleted.

    A null role or text reads as one space, a null conversation is a conversation, a role that starts with none of 's', 'u', 'a' (an
    empty one too) can't stay as it is. Rows equal in all columns are duplicates. Other columns are left out. An empty table gives no rows.
    """
    spark = rows.sparkSession
    tx.small_batches(spark)
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest"]
    coded = _coded(rows, conv_col, turn_col, role_col, text_col).repartitionByRange(*order).sortWithinPartitions(*order)
    kinds = {
        "conv": "conv", "piece": "int", "codes": "binary", "digests": "binary", "illegal": "long", "n_turns": "long",
        "first_turn": "turn", "last_turn": "turn", "min_turn": "turn", "max_turn": "turn", "part": "int", "rows": "array<struct<role:string,text:string>>",
    }
    types = {c: coded.schema[c].dataType for c in ("conv", "turn")}
    shape = coded.select(*[F.lit(None).cast(types.get(k, k)).alias(n) for n, k in kinds.items()])
    pieces = _written(coded.mapInArrow(_cut, shape.schema), "conversation-pieces")
    plan = _written(_plan(pieces.drop("rows")), "conversation-plan")
    # A written table has a size that Spark knows; most conversations have no line in it.
    known = _same(pieces.drop("digests", "first_turn", "last_turn"), plan, PIECE, "left")
    known = known.withColumns({
        "illegal": F.col("illegal") + F.coalesce("border_illegal", F.lit(0)), "n_turns": F.col("n_turns") - F.coalesce("border_turn", F.lit(0)),
    })
    new = {"single": "boolean", **{c: "long" for c in (*_COUNTS, "cost")}, "audit": "string", "repaired": _EDITED}
    return known.mapInArrow(_finish, known.select(*[c for c in known.columns if c in _KEPT], *[F.lit(None).cast(k).alias(n) for n, k in new.items()]).schema)


def summary(pieces: DataFrame, *more: Column) -> DataFrame:
    """One line per conversation: gaps in the turns, faults, illegal neighbours, cost, audit, and ``more`` aggregates of its pieces."""
    spelled = F.array_sort(F.collect_list(F.struct("part", "piece", "audit")))
    gaps = F.max("max_turn") - F.min("min_turn") + 1 - F.sum("n_turns")
    return pieces.groupBy("conv").agg(
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), *[F.sum(c).alias(c) for c in (*_COUNTS, "illegal")], F.max("cost").alias("cost"),
        F.array_join(F.transform(spelled, lambda x: x["audit"]), "").alias("audit"), *more,
    )


def repaired_turns(pieces: DataFrame) -> DataFrame:
    """(conv, part, piece, place, edit, role, text) of every turn of the repaired conversations, in this order."""
    return pieces.select("conv", "part", "piece", F.posexplode("repaired").alias("place", "_turn")).select("conv", "part", "piece", "place", "_turn.*")


def digests(pieces: DataFrame) -> DataFrame:
    """The summary with ``repaired_sha256``: the SHA-256 of all repaired turns as ``role:text``, joined by newlines.

    A conversation in several pieces is hashed as its text goes by: the pieces come in order and none is kept.
    """
    text = F.array_join(F.transform("repaired", lambda x: F.concat(x["role"], F.lit(":"), x["text"])), "\n")
    empty = F.size("repaired") == 0
    rows = pieces.select(
        "*", F.when(F.col("single"), F.sha2(text.cast("binary"), 256)).alias("sha"), F.when(~F.col("single") & ~empty, text).alias("joined")
    ).drop("repaired")
    rows = _written(rows, "conversation-digests")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, begun = object(), None, False
        for batch in batches:
            done = []
            for conv, joined in zip(batch.column("conv").to_pylist(), batch.column("joined").to_pylist()):
                if conv != now:
                    if state is not None:
                        done.append((now, state.hexdigest()))
                    now, state, begun = conv, hashlib.sha256(), False
                if joined is not None:
                    state.update(((chr(10) if begun else "") + joined).encode())
                    begun = True
            kind = batch.schema.field("conv").type
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], kind), pa.array([d[1] for d in done], pa.string())], ["conv", "streamed"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array([state.hexdigest()], pa.string())], ["conv", "streamed"])

    several = rows.where(~F.col("single")).select("conv", "part", "piece", "joined")
    ordered = _by_run(several, RUN[:1], F.struct("part", "piece").asc())
    streamed = ordered.select("conv", "joined").mapInArrow(stream, ordered.select("conv", F.lit("").alias("streamed")).schema)
    lines = _same(summary(rows, F.max("sha").alias("sha")), streamed, ["conv"], "left")
    return lines.select("*", F.coalesce("sha", "streamed").alias("repaired_sha256")).drop("sha", "streamed")
