"""Repairs the structure of conversations by the cheapest edits, and tells which these are.

A repaired conversation's role initials are `(s?(ua)+)?`. Turn by turn a row is kept (free),
given the role user or assistant (REROLE) or deleted (DELETE; a blank or repeated row must be), and
rows without text may be inserted anywhere (INSERT). A row that is cut off and stays costs CUT_OFF.
The audit has the initial of each edit, K, R, D and I; of the cheapest the least in ASCII is taken.

1. Persistent audits: in the dynamic programme over the rows and the four states of the grammar, an
   audit is a node that shares its prefix with others by its parent, and holds a rolling hash of the
   whole audit and its ancestors 1, 2, 4 ... letters back. Of two audits of one cost the longest
   common prefix is found by binary lifting over these, and the next letters decide. A prefix that is
   equal by its hash is one node, or is compared letter by letter.
2. A conversation may be of any length: its rows are range-sorted by turn and cut into chunks of
   ROWS rows or TEXT characters. A chunk is solved from each state that it may begin in, which gives a
   four by four table of costs, and the order of the audits of one beginning. All end with the edit of
   a row, so none is a prefix of another, and such tables can be put together: at equal cost the
   order of the first parts decides. The tables of a range, then those of a conversation, are put
   together; the way through them gives each chunk its states, and with them its audit and rows.

Rows equal in all columns are counted, not sorted one by one, until the chunks are made. The
repaired rows of a conversation meet in one stream in the end, as their hash needs their order.

Faults: a row is blank without a character beyond blanks, a duplicate if role and text stood
earlier in its conversation, truncated if its last character beyond blanks is none of `.!?`; the
first of these counts.

Edge cases: a null role or text is one blank. A null conv_id is a conversation of its own. Null
turns come first; rows of one turn go by role, then text. An empty role can't be kept. Without
rows a conversation has zeros and an empty audit. An empty table gives no rows. Other columns do not
matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cmp_to_key

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.common import shuffle_partitions, tidy, written

REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
#: Rows, and about characters, of a chunk.
ROWS, TEXT = 512, 1 << 20
#: Characters of a text that tell apart ranges of rows of one turn.
RANGED = 64
_BLANKS = " \t\n\x0b\x0c\r"
_EMPTY, _SYSTEM, _USER, _ASSISTANT = range(4)
#: Where a role's initial leads from each state.
_STEPS = ({"s": _SYSTEM, "u": _USER}, {"u": _USER}, {"a": _ASSISTANT}, {"u": _USER})
_NAMES = {"u": "user", "a": "assistant"}
#: Inserts after the last row that a state needs.
_CLOSING = (0, 2, 1, 0)
_LEGAL = ("su", "ua", "au")
_MODULUS, _BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E681
MUST_GO = (None, None)

Row = tuple[str | None, str | None, bool]  # role, text, whether cut off; no role and text must go


class Audits:
    """Strings of edits as nodes that share their prefixes."""

    def __init__(self, modulus: int = _MODULUS):
        self.modulus = modulus
        self.parent, self.letter, self.depth, self.hash = [0], [""], [0], [0]
        self.up: list[tuple[int, ...]] = [()]

    def child(self, node: int, letter: str) -> int:
        self.parent.append(node)
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * _BASE + ord(letter)) % self.modulus)
        up, k = [node], 0
        while k < len(self.up[up[k]]):
            up.append(self.up[up[k]][k])
            k += 1
        self.up.append(tuple(up))
        return len(self.parent) - 1

    def text(self, node: int) -> str:
        letters = []
        while node:
            letters.append(self.letter[node])
            node = self.parent[node]
        return "".join(reversed(letters))

    def _lifted(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            gap = self.depth[node] - depth
            node = self.up[node][gap.bit_length() - 1]
        return node

    def _same(self, x: int, y: int) -> bool:
        """Whether audits of one hash are equal: down to a shared node, letter by letter."""
        while x != y:
            if self.letter[x] != self.letter[y]:
                return False
            x, y = self.parent[x], self.parent[y]
        return True

    def compared(self, x: int, y: int) -> int:
        """Below 0, 0 or above, as x comes before y, equals it or comes after."""
        if x == y:
            return 0
        least = min(self.depth[x], self.depth[y])
        a, b = self._lifted(x, least), self._lifted(y, least)
        if self.hash[a] == self.hash[b]:
            if self._same(a, b):
                return self.depth[x] - self.depth[y]
            return -1 if self.text(x) < self.text(y) else 1
        # the longest common prefix: as far up as the hashes still differ
        for k in range(least.bit_length() - 1, -1, -1):
            if k < len(self.up[a]) and self.hash[self.up[a][k]] != self.hash[self.up[b][k]]:
                a, b = self.up[a][k], self.up[b][k]
        if not self._same(self.parent[a], self.parent[b]):
            return -1 if self.text(x) < self.text(y) else 1
        return -1 if self.letter[a] < self.letter[b] else 1


Cells = dict[int, tuple[int, int]]  # state: cost, audit


def _better(cells: Cells, audits: Audits, state: int, cost: int, node: int, letter: str) -> None:
    known = cells.get(state)
    if known is None or cost < known[0]:
        cells[state] = cost, audits.child(node, letter)
    elif cost == known[0]:
        new = audits.child(node, letter)
        if audits.compared(new, known[1]) < 0:
            cells[state] = cost, new


def _after(row: Row, cells: Cells, audits: Audits) -> Cells:
    """The cells behind a row, with what is inserted before it."""
    opened = dict(cells)
    for _ in range(2):  # more inserts in a row lead back to a state
        for state, (cost, node) in list(opened.items()):
            for initial, to in _STEPS[state].items():
                if initial in _NAMES:
                    _better(opened, audits, to, cost + INSERT, node, "I")
    role, text, cut_off = row
    found: Cells = {}
    for state, (cost, node) in opened.items():
        _better(found, audits, state, cost + DELETE, node, "D")
        if text is not None:
            stays = cost + CUT_OFF * cut_off
            for initial, to in _STEPS[state].items():
                if role[:1] == initial:
                    _better(found, audits, to, stays, node, "K")
                elif initial in _NAMES:
                    _better(found, audits, to, stays + REROLE, node, "R")
    return found


Table = tuple[list[int], list[int]]  # costs and ranks by 4 * first state + last; -1 for no way


def solved(rows: list[Row], firsts: tuple[int, ...] = (0, 1, 2, 3)) -> tuple[Table, list[str | None]]:
    """A chunk's costs, ranks and audits from each of the first states."""
    costs, ranks, texts = [-1] * 16, [-1] * 16, [None] * 16
    for first in firsts:
        audits = Audits()
        cells: Cells = {first: (0, 0)}
        for row in rows:
            cells = _after(row, cells, audits)
        order = sorted(cells, key=cmp_to_key(lambda p, q: audits.compared(cells[p][1], cells[q][1])))
        for rank, last in enumerate(order):
            at = 4 * first + last
            costs[at], ranks[at], texts[at] = cells[last][0], rank, audits.text(cells[last][1])
    return (costs, ranks), texts


def joined(one: Table, two: Table) -> tuple[Table, list[int]]:
    """The table of both in a row, and the state between them."""
    costs, ranks, between = [-1] * 16, [-1] * 16, [-1] * 16
    for first in range(4):
        keys = {}
        for last in range(4):
            ways = [
                (one[0][4 * first + mid] + two[0][4 * mid + last], one[1][4 * first + mid], mid)
                for mid in range(4)
                if one[0][4 * first + mid] >= 0 and two[0][4 * mid + last] >= 0
            ]
            if ways:
                cost, rank, mid = min(ways)
                at = 4 * first + last
                costs[at], between[at] = cost, mid
                keys[last] = rank, two[1][4 * mid + last]
        for rank, last in enumerate(sorted(keys, key=keys.get)):
            ranks[4 * first + last] = rank
    return (costs, ranks), between


def way(tables: list[Table], first: int, last: int) -> list[tuple[int, int]]:
    """The first and last state of each table on the best way through all."""
    upto, steps = tables[0], []
    for table in tables[1:]:
        upto, between = joined(upto, table)
        steps.append(between)
    found = []
    for between in reversed(steps):
        mid = between[4 * first + last]
        found.append((mid, last))
        last = mid
    return [(first, last), *reversed(found)]


def ending(table: Table) -> int:
    """The best last state of a whole conversation; the audits of two are told apart before what
    is inserted at the end."""
    ends = [last for last in range(4) if table[0][last] >= 0]
    return min(ends, key=lambda last: (table[0][last] + INSERT * _CLOSING[last], table[1][last]))


def replayed(audit: str, rows: list[Row], state: int) -> list[tuple[str, str]]:
    """The repaired rows of an audit: role and text."""
    out, at = [], 0
    for edit in audit:
        role, text = None, None
        if edit != "I":
            role, text, _ = rows[at]
            at += 1
        if edit == "D":
            continue
        initial = role[:1] if edit == "K" else next(x for x in _STEPS[state] if x in _NAMES)
        out.append((role if edit == "K" else _NAMES[initial], text or ""))
        state = _STEPS[state][initial]
    return out


class Chunk:
    """Rows of one conversation that follow one another."""

    def __init__(self) -> None:
        self.rows: list[Row] = []
        self.characters = 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.first_initial, self.last_initial = 0, None, None
        self.turns, self.first_turn, self.last_turn = 0, None, None

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        initial = role[:1]
        if self.rows and self.last_initial + initial not in _LEGAL:
            self.illegal += 1
        if not self.rows:
            self.first_initial = initial
        self.last_initial = initial
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        end = text.rstrip(_BLANKS)[-1:]
        fault = "blank" if not end else "duplicate" if again else "truncated" if end not in ".!?" else None
        if fault:
            self.faults[fault] += 1
        if fault in ("blank", "duplicate"):
            self.rows.append((*MUST_GO, False))
        else:
            self.rows.append((role, text, fault == "truncated"))
            self.characters += len(text)

    def full(self, rows: int) -> bool:
        return len(self.rows) >= rows or self.characters >= TEXT


_TABLE = "costs array<int>, ranks array<int>"
_SUMMARY = (
    "blank long, duplicate long, truncated long, illegal long, first_initial string, last_initial string, "
    "turns long, first_turn long, last_turn long"
)
_CHUNKS = (
    f"conv_id long, part int, no int, alone boolean, {_SUMMARY}, {_TABLE}, audits array<string>, "
    "rows array<struct<role:string,text:string>>"
)
_INTS = pa.list_(pa.int32())
_KINDS = {
    "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "array<int>": _INTS,
    "array<string>": pa.list_(pa.string()),
    "array<struct<role:string,text:string>>": pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])),
}


def _arrow(schema: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (x.split(" ") for x in schema.split(", "))])


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, _arrow(schema))


def _made(most: int):
    """Sorted rows (conv_id, turn, role, text, n, again) to chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        out: list[dict] = []
        held = 0
        now: tuple | None = None  # the conversation
        chunk, no, first = Chunk(), 0, True

        def close(last: bool, final: bool) -> None:
            """Solves the chunk; `last` of its conversation here, `final` of the partition."""
            nonlocal chunk, no, held
            # the first conversation of a partition may have begun before it, the last may go on
            begins, alone = no == 0 and not first, no == 0 and last and not first and not final
            table, audits = solved(chunk.rows, (_EMPTY,) if begins else (0, 1, 2, 3))
            out.append(
                {
                    "conv_id": now[0], "part": part, "no": no, "alone": alone, **chunk.faults,
                    **{x: getattr(chunk, x) for x in ("illegal", "first_initial", "last_initial", "turns", "first_turn", "last_turn")},
                    "costs": table[0], "ranks": table[1], "audits": audits,
                    "rows": [{"role": role, "text": text} for role, text, _ in chunk.rows],
                }
            )
            held += chunk.characters + 32 * len(chunk.rows) + 400
            chunk, no = Chunk(), no + 1

        for batch in batches:
            for conv_id, turn, role, text, n, again in zip(*(c.to_pylist() for c in batch.columns)):
                if now != (conv_id,):
                    if now is not None:
                        close(True, False)
                        first = False
                    now, no = (conv_id,), 0
                for k in range(n):
                    if chunk.full(most):
                        close(False, False)
                    chunk.add(turn, role, text, again or k > 0)
                if held > TEXT:
                    yield _batch(out, _CHUNKS)
                    out, held = [], 0
        if now is not None:
            close(True, True)
        yield _batch(out, _CHUNKS)

    return run


def _tables(frame: pa.Table, *order: str) -> tuple[list[int], list[Table]]:
    frame = frame.sort_by([(x, "ascending") for x in order])
    return frame[order[-1]].to_pylist(), list(zip(frame["costs"].to_pylist(), frame["ranks"].to_pylist()))


def _of_range(key: tuple, frame: pa.Table) -> pa.Table:
    """The chunks of a conversation in one range as one table."""
    _, tables = _tables(frame, "no")
    whole = tables[0]
    for table in tables[1:]:
        whole, _ = joined(whole, table)
    row = {"conv_id": key[0].as_py(), "part": key[1].as_py(), "costs": whole[0], "ranks": whole[1]}
    return pa.Table.from_pylist([row], _arrow(f"conv_id long, part int, {_TABLE}"))


def _through(frame: pa.Table, first: int, last: int | None, order: str) -> tuple[list[int], list[tuple[int, int]]]:
    names, tables = _tables(frame, order)
    if last is None:
        whole = tables[0]
        for table in tables[1:]:
            whole, _ = joined(whole, table)
        last = ending(whole)
    return names, way(tables, first, last)


_STATES = "conv_id long, part int, first int, last int"


def _of_conversation(key: tuple, frame: pa.Table) -> pa.Table:
    """The states of a conversation at the ends of each of its ranges."""
    parts, states = _through(frame, _EMPTY, None, "part")
    rows = [{"conv_id": key[0].as_py(), "part": p, "first": a, "last": b} for p, (a, b) in zip(parts, states)]
    return pa.Table.from_pylist(rows, _arrow(_STATES))


_CHUNK_STATES = "conv_id long, part int, no int, first int, last int"


def _of_chunks(chunks: pa.Table, states: pa.Table) -> pa.Table:
    """The states at the ends of each chunk of a range."""
    first, last = states["first"][0].as_py(), states["last"][0].as_py()
    names, found = _through(chunks, first, last, "no")
    same = {x: chunks[x][0].as_py() for x in ("conv_id", "part")}
    return pa.Table.from_pylist([{**same, "no": n, "first": a, "last": b} for n, (a, b) in zip(names, found)], _arrow(_CHUNK_STATES))


_PIECE = f"conv_id long, part int, no int, {_SUMMARY}, cost long, audit string, last int, repaired array<struct<role:string,text:string>>"


def _piece(row: dict, first: int, last: int) -> dict:
    """What a chunk gives when it begins and ends in these states."""
    at = 4 * first + last
    audit = row["audits"][at]
    repaired = replayed(audit, [(r["role"], r["text"], False) for r in row["rows"]], first)
    out = {x: row[x] for x in row if x not in ("alone", "costs", "ranks", "audits", "rows", "first")}
    pairs = [{"role": role, "text": text} for role, text in repaired]
    return {**out, "cost": row["costs"][at], "audit": audit, "last": last, "repaired": pairs}


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        told = "first" in batch.schema.names
        yield _batch([_piece(r, r["first"], r["last"]) if told else _piece(r, _EMPTY, ending((r["costs"], r["ranks"]))) for r in rows], _PIECE)


_RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


class _Whole:
    """A conversation that pieces are added to in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.counts, self.turns = conv_id, dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0), 0
        self.first_turn = self.last_turn = self.initial = None
        self.audit, self.hash, self.any, self.last = [], hashlib.sha256(), False, _EMPTY

    def _put(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.any else "") + f"{role}:{text}").encode())
        self.any = True

    def add(self, piece: dict) -> None:
        for x in self.counts:
            self.counts[x] += piece[x]
        if self.initial is not None and piece["first_initial"] is not None and self.initial + piece["first_initial"] not in _LEGAL:
            self.counts["illegal"] += 1
        self.initial = self.initial if piece["last_initial"] is None else piece["last_initial"]
        if piece["turns"]:
            self.turns += piece["turns"] - (piece["first_turn"] == self.last_turn)
            self.first_turn = piece["first_turn"] if self.first_turn is None else self.first_turn
            self.last_turn = piece["last_turn"]
        self.audit.append(piece["audit"])
        self.last = piece["last"]
        for r in piece["repaired"]:
            self._put(r["role"], r["text"])

    def row(self) -> dict:
        for _ in range(_CLOSING[self.last]):
            initial = next(x for x in _STEPS[self.last] if x in _NAMES)
            self.last = _STEPS[self.last][initial]
            self.audit.append("I")
            self.counts["cost"] += INSERT
            self._put(_NAMES[initial], "")
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return {
            "conv_id": self.conv_id, "gaps": min(gaps, (1 << 63) - 1), **self.counts, "audit": "".join(self.audit),
            "repaired_sha256": self.hash.hexdigest(),
        }


def _wholes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order to conversations, as a stream."""
    whole = None
    for batch in batches:
        out = []
        for piece in batch.to_pylist():
            if whole is None or whole.conv_id != piece["conv_id"]:
                if whole is not None:
                    out.append(whole.row())
                whole = _Whole(piece["conv_id"])
            whole.add(piece)
        yield _batch(out, _RESULT)
    yield _batch([whole.row()] if whole else [], _RESULT)


def pieces(turns: DataFrame, times: Column | None = None, *, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """The repaired pieces of conversations of one chunk, and those of the others; by conv_id, part and
    no in order. `times` tells how often a row counts; one that counts 0 times only names its
    conversation."""
    parts = shuffle_partitions(turns.sparkSession)
    times = F.lit(1) if times is None else times
    text = lambda name: F.when(F.col("n") > 0, F.coalesce(name, F.lit(" ")))
    told = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text", times.cast("long").alias("n"))
    told = told.select("conv_id", F.when(F.col("n") > 0, F.col("turn")).alias("turn"), text("role").alias("role"), text("text").alias("text"), "n")
    told = written(told.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n")))
    told = told.withColumn("said", F.struct(F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit(1), "role", "text").alias("b")))
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = told.where("n > 0").groupBy("conv_id", "said").agg(F.min(place).alias("first"), F.count("*").alias("often"))
    firsts = firsts.where("often > 1").select(F.col("conv_id").alias("of"), F.col("said").alias("same"), "first")
    match = F.col("conv_id").eqNullSafe(F.col("of")) & F.col("said").eqNullSafe(F.col("same"))
    told = told.join(firsts, match, "left").withColumn("again", F.coalesce(place > F.col("first"), F.lit(False)))
    told = told.select("conv_id", "turn", "role", "text", F.col("n").cast("int"), "again")
    dealt = told.repartitionByRange(parts, "conv_id", "turn", "role", F.substring("text", 1, RANGED))
    chunks = written(dealt.sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(tidy(_made(rows)), _CHUNKS))
    alone = chunks.where("alone").mapInArrow(_pieces, _PIECE)
    more = chunks.where("NOT alone")
    light = more.select("conv_id", "part", "no", "costs", "ranks")
    ranges = light.groupBy("conv_id", "part").applyInArrow(_of_range, f"conv_id long, part int, {_TABLE}")
    states = ranges.groupBy("conv_id").applyInArrow(_of_conversation, _STATES)
    states = light.groupBy("conv_id", "part").cogroup(states.groupBy("conv_id", "part")).applyInArrow(_of_chunks, _CHUNK_STATES)
    states = states.toDF("of", "of_part", "of_no", "first", "last")
    here = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("part") == F.col("of_part")) & (F.col("no") == F.col("of_no"))
    return alone, more.join(states, here).drop("of", "of_part", "of_no").mapInArrow(_pieces, _PIECE)


def repaired(turns: DataFrame, times: Column | None = None, *, rows: int = ROWS) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 (of
    `role:text`, joined by line ends) of every conversation."""
    alone, more = pieces(turns, times, rows=rows)
    more = more.repartition(shuffle_partitions(turns.sparkSession), "conv_id").sortWithinPartitions("conv_id", "part", "no")
    return alone.mapInArrow(_wholes, _RESULT).union(more.mapInArrow(_wholes, _RESULT))
