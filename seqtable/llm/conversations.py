"""Repair of the structure of conversations by cheapest edits.

A sound conversation has roles `(s?(ua)+)?`: nothing, or turns of user and assistant
in pairs after at most one system turn (roles are told by their first letters).
Edits and their costs: Keep 0, Rerole to user or assistant 3, Delete 4 (blank turns
and repeated ones must go), Insert an empty user or assistant turn 3; a truncated
turn that stays costs 3 more. Of the cheapest lists of edits the one whose initials
come first in ASCII order is taken.

Rows are dealt to tasks by conversation and sorted by turn within each (nulls first,
ties by role and text). A task streams them: dynamic programming over the four
states that roles can be in (start, after s, after u, after a) holds a cost and a rank
for each state, whatever the length of the conversation, across Arrow batches. What
led to each state is one small code a row. As soon as all states go back to one
state, the rows before it are decided and handed on; rows that stay open are
held, and beyond HELD bytes spilled, codes and texts, to a temporary file of the task
in the worker's Spark folder (a lost task starts again with another). So a
conversation with a third of all rows needs one task's time, but not its memory.

    damage(turns)   repeatable faults, for tests of the repair
    repair(turns)   one row per edit: the repaired turns and the deleted ones
    audits(turns)   one row per conversation: faults, cost, edits, digest of the result

Results for odd input: null roles and texts count as one blank; a null conversation
is one of its own; null turns come first and don't count in gaps. Repeated rows are
duplicates. A conversation without rows (all `dropped`) has zeros, no edits and the
digest of an empty text. Extra columns don't matter; an empty table gives an empty one.
"""

import hashlib
import os
import pickle
import tempfile
from array import array
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of open rows in memory, and rows between two looks for decided ones.
HELD, LOOK = 16 << 20, 256
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States after no turn, a system turn, a user turn, an assistant turn; sound ends are the first and the last.
START, SYSTEM, USER, ASSISTANT = range(4)
#: More than any state can save on what comes: it inserts at most two turns (6) and deletes a system turn (4).
HOPELESS = 2 * INSERT + DELETE
SOLID = r"[^\x20\x09-\x0D]"
NAMES = {USER: "user", ASSISTANT: "assistant"}


def damage(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, dropped): rows changed by crc32(`conv_id:turn`) % 20.

    0 drops the row (it stays as a mark of its conversation, `dropped`), 1 empties its
    text, 2 removes its full stops, exclamation and question marks, 3 repeats it, 4
    makes its role user.
    """
    blank = F.lit(" ")
    named = turns.select(
        turns[conversation].cast("bigint").alias("conv_id"),
        turns[turn].cast("bigint").alias("turn"),
        F.coalesce(turns[role], blank).alias("role"),
        F.coalesce(turns[text], blank).alias("text"),
    )
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    fault = F.crc32(place) % 20
    changed = named.withColumn("fault", fault).select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault").isin(0, 1), "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("fault") == 0).alias("dropped"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return changed.drop("copy")


def _ordered(turns: DataFrame) -> DataFrame:
    """Rows of a conversation in one task, in order, with their first fault.

    One shuffle: repeats are found by a window whose key begins with the
    conversation, so the rows are in the right task already.
    """
    dropped = F.coalesce("dropped", F.lit(False)) if "dropped" in turns.columns else F.lit(False)
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        dropped.alias("dropped"),
    ).repartition("conv_id")
    copies = Window.partitionBy("conv_id", "dropped", "role", "text").orderBy("turn")
    last = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    fault = (
        F.when(~F.col("text").rlike(SOLID), "blank")
        .when(F.row_number().over(copies) > 1, "duplicate")
        .when(~last.rlike("[.!?]"), "truncated")
    )
    return rows.withColumn("fault", fault).sortWithinPartitions("conv_id", "dropped", "turn", "role", "text")


class Step(NamedTuple):
    """What a row does to the states: their next vector, the least cost added, and a code of how each came about."""

    state: tuple
    added: int
    code: int  # place in Automaton.came


def _moves(initial: str, must_go: bool, extra: int) -> list[tuple[int, str, int, int]]:
    """(state before, initials, cost, state after) of one row, inserts before it included."""
    steps = {START: [(0, START), (1, USER), (2, ASSISTANT)], SYSTEM: [(0, SYSTEM), (1, USER), (2, ASSISTANT)]}
    steps |= {USER: [(0, USER), (1, ASSISTANT), (2, USER)], ASSISTANT: [(0, ASSISTANT), (1, USER), (2, ASSISTANT)]}
    out = []
    for before, reached in steps.items():
        for inserts, at in reached:
            head, cost = "I" * inserts, INSERT * inserts
            out.append((before, head + "D", cost + DELETE, at))
            if must_go:
                continue
            next_ = ASSISTANT if at == USER else USER
            out.append((before, head + "R", cost + REROLE + extra, next_))
            if initial == "s" and at == START:
                out.append((before, head + "K", cost + extra, SYSTEM))
            if initial == ("a" if at == USER else "u"):
                out.append((before, head + "K", cost + extra, next_))
    return out


class Automaton:
    """Steps of the dynamic programming, worked out once for each state vector and kind of row.

    A state vector holds (cost above the least, rank) or None for each of the four
    states; ranks order the initials of the edits so far. No two are equal and
    none begins another (all end with the edit of the same row), so equal costs are
    told apart by rank, then by the row's own initials.
    """

    first = ((0, 0), None, None, None)

    def __init__(self):
        self.known: dict[tuple, Step] = {}
        self.moves: dict[tuple, list] = {}
        #: By code: the state before and the row's initials, for each state after.
        self.came: list[tuple] = []

    def step(self, state: tuple, kind: tuple) -> Step:
        found = self.known.get((state, kind))
        if found is None:
            found = self.known[state, kind] = self._step(state, kind)
        return found

    def _step(self, state: tuple, kind: tuple) -> Step:
        if kind not in self.moves:
            self.moves[kind] = _moves(*kind)
        best: list = [None] * 4
        for before, initials, cost, after in self.moves[kind]:
            if state[before] is not None:
                way = (state[before][0] + cost, state[before][1], initials, before)
                if best[after] is None or way < best[after]:
                    best[after] = way
        least = min(w[0] for w in best if w)
        best = [w if w and w[0] - least <= HOPELESS else None for w in best]
        order = sorted((w[1], w[2], k) for k, w in enumerate(best) if w)
        rank = {k: r for r, (_, _, k) in enumerate(order)}
        state = tuple((w[0] - least, rank[k]) if w else None for k, w in enumerate(best))
        self.came.append(tuple((w[3], w[2]) if w else None for w in best))
        return Step(state, least, len(self.came) - 1)

    @staticmethod
    def end(state: tuple) -> tuple[int, str, int]:
        """(state, closing inserts, cost) of the best sound end."""
        ways = []
        for k, held in enumerate(state):
            if held is not None:
                inserts = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}[k]
                # Closing inserts come last, so rank decides before them.
                ways.append((held[0] + INSERT * inserts, held[1], k, "I" * inserts))
        cost, _, k, initials = min(ways)
        return k, initials, cost


class Open:
    """Rows not yet decided, each with the code of how states came about; beyond `most` bytes on disk."""

    def __init__(self, came: list[tuple], most: int):
        self.came, self.most = came, most
        self.codes, self.rows, self.bytes = array("I"), [], 0
        self.file = None
        self.pieces: list[tuple[int, int]] = []  # place and rows of each spilled piece

    def add(self, code: int, row: tuple) -> None:
        self.codes.append(code)
        self.rows.append(row)
        self.bytes += 64 + len(row[1]) + len(row[2])
        if self.bytes > self.most:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
            self.file = tempfile.TemporaryFile(dir=folder if os.path.isdir(folder) else None)
        self.pieces.append((self.file.seek(0, os.SEEK_END), len(self.rows)))
        # Codes first: going back needn't read the texts.
        self.codes.tofile(self.file)
        for row in self.rows:
            pickle.dump(row, self.file, pickle.HIGHEST_PROTOCOL)
        self.codes, self.rows, self.bytes = array("I"), [], 0

    def decided(self, ends: set[int]) -> tuple[int, int] | None:
        """(rows in memory, state after them) that all of the states `ends` go back to, if there are such."""
        for n in range(len(self.rows) - 1, -1, -1):
            came = self.came[self.codes[n]]
            ends = {came[k][0] for k in ends}
            if len(ends) == 1:
                return n, ends.pop()
        return None

    def _back(self, codes: array, state: int) -> tuple[int, list[str]]:
        """The state before some rows, and the initials of each, given the state after them."""
        path = []
        for code in reversed(codes):
            state, initials = self.came[code][state]
            path.append(initials)
        return state, path[::-1]

    def flush(self, n: int, state: int) -> Iterator[tuple[str, tuple]]:
        """(initials, row) of all spilled rows and the first n in memory, given the state that follows them."""
        state, path = self._back(self.codes[:n], state)
        if self.pieces:
            yield from self._spilled(state)
        yield from zip(path, self.rows[:n], strict=True)
        self.codes, self.rows = self.codes[n:], self.rows[n:]
        self.bytes = sum(64 + len(r[1]) + len(r[2]) for r in self.rows)

    def _codes(self, piece: tuple[int, int]) -> array:
        codes = array("I")
        self.file.seek(piece[0])
        codes.fromfile(self.file, piece[1])
        return codes

    def _spilled(self, state: int) -> Iterator[tuple[str, tuple]]:
        ends = []
        for piece in reversed(self.pieces):
            ends.append(state)
            state, _ = self._back(self._codes(piece), state)
        for piece, state in zip(self.pieces, reversed(ends), strict=True):
            _, path = self._back(self._codes(piece), state)
            for initials in path:  # the rows follow the codes
                yield initials, pickle.load(self.file)
        self.file.close()
        self.file, self.pieces = None, []


#: An edit: its initial, the row it is about (turn, role, text, fault) unless inserted, the role it leaves unless deleted.
Edit = tuple[str, tuple | None, str | None]


class Conversation:
    """Hands on the edits of one conversation as they are decided, and counts its faults."""

    def __init__(self, automaton: Automaton, held: int):
        self.automaton, self.open = automaton, Open(automaton.came, held)
        self.state, self.cost, self.look = Automaton.first, 0, LOOK
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.distinct = 0
        self.first_turn = self.last_turn = self.last_initial = None
        self.at = START

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> Iterable[Edit]:
        initial = role[:1]
        if fault:
            self.faults[fault] += 1
        if self.last_initial is not None:
            self.illegal += self.last_initial + initial not in ("su", "ua", "au")
        self.last_initial = initial
        if turn is not None and turn != self.last_turn:
            self.distinct += 1
            self.first_turn, self.last_turn = turn if self.first_turn is None else self.first_turn, turn
        kind = (initial if initial in ("s", "u", "a") else "", fault in ("blank", "duplicate"), TRUNCATED * (fault == "truncated"))
        step = self.automaton.step(self.state, kind)
        self.state, self.cost = step.state, self.cost + step.added
        self.open.add(step.code, (turn, role, text, fault))
        if len(self.open.rows) < self.look:
            return ()
        found = self.open.decided({k for k, held in enumerate(self.state) if held is not None})
        if found is None:
            self.look = 2 * len(self.open.rows)
            return ()
        self.look = 2 * (len(self.open.rows) - found[0]) + LOOK
        return self._edits(self.open.flush(*found))

    def _edits(self, decided: Iterator[tuple[str, tuple]]) -> Iterator[Edit]:
        for initials, row in decided:
            yield from self._inserts(initials[:-1])
            edit, role = initials[-1], row[1]
            if edit == "D":
                yield "D", row, None
                continue
            if edit == "K" and role[:1] == "s":
                self.at = SYSTEM
            else:
                self.at = ASSISTANT if self.at == USER else USER
                role = role if edit == "K" else NAMES[self.at]
            yield edit, row, role

    def _inserts(self, initials: str) -> Iterator[Edit]:
        for edit in initials:
            self.at = ASSISTANT if self.at == USER else USER
            yield edit, None, NAMES[self.at]

    def end(self) -> Iterator[Edit]:
        """All edits that are left; adds the closing cost."""
        state, closing, cost = self.automaton.end(self.state)
        self.cost += cost
        yield from self._edits(self.open.flush(len(self.open.rows), state))
        yield from self._inserts(closing)

    @property
    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.distinct


def _edits(own: Conversation, rows: Iterator[tuple]) -> Iterator[Edit]:
    for _, turn, role, text, dropped, fault in rows:
        if not dropped:
            yield from own.add(turn, role, text, fault)
    yield from own.end()


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator[tuple]]]:
    """(conv_id, its rows in order) from sorted batches; a conversation's rows must be read before the next one is asked for."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    row = next(rows, None)

    def own(name):
        nonlocal row
        while row is not None and row[0] == name:
            yield row
            row = next(rows, None)

    while row is not None:
        name = row[0]
        yield name, own(name)


def _mapped(turns: DataFrame, schema: str, rows_of: Callable[[Automaton, int | None, Iterator[tuple]], Iterator[tuple[tuple, int]]]) -> DataFrame:
    """Rows (and their sizes in letters) that `rows_of` makes of each conversation, in batches of bounded size."""
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [{"bigint": pa.int64(), "string": pa.string()}[part.split()[1]] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, out, size = Automaton(), [], 0
        for name, rows in _conversations(batches):
            for row, letters in rows_of(automaton, name, rows):
                out.append(row)
                size += letters
                if len(out) == 2000 or size > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return _ordered(turns).mapInArrow(run, schema)


def audits(turns: DataFrame, held: int = HELD) -> DataFrame:
    """One row per conversation.

    gaps, blank, duplicate, truncated, illegal   faults (long)
    cost, audit                                  of the cheapest edits, and their initials
    repaired_sha256                              of the repaired `role:text`, one a line
    """

    def rows_of(automaton: Automaton, name: int | None, rows: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        own, audit, digest, line = Conversation(automaton, held), bytearray(), hashlib.sha256(), b""
        for edit, row, role in _edits(own, rows):
            audit += edit.encode()
            if role is not None:
                digest.update(line + role.encode() + b":" + (row[2].encode() if row else b""))
                line = b"\n"
        yield (name, own.gaps, *own.faults.values(), own.illegal, own.cost, audit.decode(), digest.hexdigest()), len(audit)

    longs = ", ".join(f"{n} bigint" for n in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    return _mapped(turns, f"{longs}, audit string, repaired_sha256 string", rows_of)


def repair(turns: DataFrame, held: int = HELD) -> DataFrame:
    """One row per edit: conv_id, place (from 0), edit, turn, role (null if deleted), text, was_role, fault.

    The rows whose edit isn't D are the repaired conversation in order of place;
    turn and was_role are null in inserted ones.
    """

    def rows_of(automaton: Automaton, name: int | None, rows: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        for place, (edit, row, role) in enumerate(_edits(Conversation(automaton, held), rows)):
            turn, was, text, fault = row or (None, None, "", None)
            yield (name, place, edit, turn, role, text, was, fault), len(text)

    return _mapped(turns, "conv_id bigint, place bigint, edit string, turn bigint, role string, text string, was_role string, fault string", rows_of)
