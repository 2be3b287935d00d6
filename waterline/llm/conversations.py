"""Repair of the structure of conversations by the cheapest edits.

A sound conversation is empty or starts with one system row perhaps and goes on in pairs of user and
assistant. Rows are dealt out by conversation and sorted by turn; one pass carries the state of a
dynamic program from one Arrow batch to the next. Its four states say what was kept last. Per row and
state it notes in one byte where the best path came from; what a giant conversation holds beyond a
fixed size is spilled to an unnamed file of the task, as Spark's own sort does, and read back once.
"""

from __future__ import annotations

import hashlib
import itertools
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waterline.llm.tables import prepare

KEEP, REROLE, DELETE, INSERT = "KRDI"
COSTS = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
# What a truncated row costs that stays.
TRUNCATED = 5
ROLES = {"u": "user", "a": "assistant"}
# Nothing kept yet; a system row, a user row, an assistant row kept last.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = (EMPTY, SYSTEM, USER, ASSISTANT)
_AFTER = {
    (EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER,
}
_NEXT = {EMPTY: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
_SOUND = (EMPTY, ASSISTANT)
# Two insertions bring back what can follow; a third is never the cheapest.
MOST_INSERTED = 2
# Held of one conversation before it is spilled, in characters and rows; rows of a batch that is given back.
HELD_CHARS, HELD_ROWS = 1 << 25, 1 << 17
OUT_ROWS, OUT_CHARS = 1000, 1 << 23

EDITS = "part string, step long, edit string, fault string, turn long, role_before string, role string, text string"
_COLUMNS = [c.split()[0] for c in EDITS.split(", ")]


def _inserted(state: int, count: int) -> int:
    for _ in range(count):
        state = _AFTER[state, _NEXT[state]]
    return state


def _moves(initial: str, fault: str | None) -> list[tuple[int, int, int, str]]:
    """``(from, to, cost, letters)`` of all ways to treat a row, insertions before it included."""
    out = []
    extra = TRUNCATED if fault == "truncated" else 0
    for state, count in itertools.product(STATES, range(MOST_INSERTED + 1)):
        at, before = _inserted(state, count), COSTS[INSERT] * count
        ways = [(at, DELETE, 0)]
        if fault not in ("blank", "duplicate"):
            ways += [(_AFTER.get((at, initial)), KEEP, extra), (_AFTER[at, _NEXT[at]], REROLE, extra)]
        out += [(state, to, before + COSTS[edit] + more, INSERT * count + edit) for to, edit, more in ways if to is not None]
    return out


_LAST = [
    (state, _inserted(state, count), COSTS[INSERT] * count, INSERT * count)
    for state, count in itertools.product(STATES, range(MOST_INSERTED + 1))
    if _inserted(state, count) in _SOUND
]
_WAYS = [INSERT * count + edit for count in range(MOST_INSERTED + 1) for edit in (KEEP, REROLE, DELETE)]
_CODE = {letters: code for code, letters in enumerate(_WAYS)}
_FAULTS = (None, "blank", "duplicate", "truncated")
_TABLE = {(initial, fault): _moves(initial, fault) for initial in ("s", "u", "a", "") for fault in _FAULTS}


class _Path:
    """The best paths into each state so far: cost, and place in the order of their letters.

    After a row all paths have as many letters for rows and end in one, so none is the beginning of
    another and their order holds whatever follows.
    """

    def __init__(self) -> None:
        self.cost: dict[int, int] = {EMPTY: 0}
        self.place: dict[int, int] = {EMPTY: 0}

    def step(self, moves) -> bytes:
        """Take one row; a byte per state: where its best path came from and by what letters."""
        best: dict[int, tuple] = {}
        for state, to, cost, letters in moves:
            if state in self.cost:
                found = (self.cost[state] + cost, self.place[state], letters, state)
                if to not in best or found < best[to]:
                    best[to] = found
        self.cost = {state: found[0] for state, found in best.items()}
        order = sorted(best, key=lambda state: best[state][1:3])
        self.place = {state: at for at, state in enumerate(order)}
        return bytes(best[s][3] << 4 | _CODE[best[s][2]] if s in best else 255 for s in STATES)

    def finish(self) -> tuple[int, str]:
        """State before the last insertions, and their letters."""
        found = min(
            (self.cost[state] + cost, self.place[state], letters, state) for state, _, cost, letters in _LAST if state in self.cost
        )
        return found[3], found[2]


class _Conversation:
    """Rows and backpointers of one conversation, spilled in blocks when they grow."""

    def __init__(self, part: str | None) -> None:
        self.part, self.path = part, _Path()
        self.rows: list[tuple] = []
        self.pointers = bytearray()
        self.chars = 0
        self.file, self.blocks = None, []

    def add(self, turn, role: str, text: str, fault: str | None) -> None:
        initial = role[:1] if role[:1] in ("s", "u", "a") else ""
        self.pointers += self.path.step(_TABLE[initial, fault])
        self.rows.append((turn, role, text, fault))
        self.chars += len(role) + len(text)
        if self.chars >= HELD_CHARS or len(self.rows) >= HELD_ROWS:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        pointers_at = self.file.tell()
        self.file.write(self.pointers)
        rows_at = self.file.tell()
        pickle.dump(self.rows, self.file, pickle.HIGHEST_PROTOCOL)
        self.blocks.append((pointers_at, len(self.pointers), rows_at))
        self.rows, self.pointers, self.chars = [], bytearray(), 0

    def _letters(self, pointers: bytes, state: int) -> tuple[bytes, int]:
        """Codes of the letters of a block's rows, walked from its end, and the state before it."""
        codes = bytearray(len(pointers) // len(STATES))
        for row in range(len(codes) - 1, -1, -1):
            pointer = pointers[row * len(STATES) + state]
            codes[row], state = pointer & 15, pointer >> 4
        return bytes(codes), state

    def edits(self) -> Iterator[tuple]:
        """The rows of the edit log, in order."""
        state, last = self.path.finish()
        held, state = self._letters(self.pointers, state)
        codes = []
        for pointers_at, size, _ in reversed(self.blocks):
            self.file.seek(pointers_at)
            found, state = self._letters(self.file.read(size), state)
            codes.append(found)
        at, step = EMPTY, 0
        for found, rows in self._blocks(codes[::-1], held):
            for code, (turn, role, text, fault) in zip(found, rows, strict=True):
                for edit in _WAYS[code]:
                    if edit == INSERT:
                        new = _NEXT[at]
                        yield self.part, step, edit, None, None, None, ROLES[new], ""
                        at = _AFTER[at, new]
                    elif edit == DELETE:
                        yield self.part, step, edit, fault, turn, role, None, text
                    else:
                        new = role[:1] if edit == KEEP else _NEXT[at]
                        yield self.part, step, edit, fault, turn, role, role if edit == KEEP else ROLES[new], text
                        at = _AFTER[at, new]
                    step += 1
        for edit in last:
            new = _NEXT[at]
            yield self.part, step, edit, None, None, None, ROLES[new], ""
            at, step = _AFTER[at, new], step + 1
        if self.file is not None:
            self.file.close()

    def _blocks(self, codes: list[bytes], held: bytes):
        for found, (_, _, rows_at) in zip(codes, self.blocks, strict=True):
            self.file.seek(rows_at)
            yield found, pickle.load(self.file)
        yield held, self.rows


def _log(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edits of sorted rows; one conversation is held at a time."""
    out: list[tuple] = []
    size = 0
    current = None

    def ended(conversation):
        nonlocal out, size
        for edit in conversation.edits():
            out.append(edit)
            size += len(edit[-1])
            if len(out) >= OUT_ROWS or size >= OUT_CHARS:
                yield _frame(out)
                out, size = [], 0

    for batch in batches:
        columns = [batch[c] for c in ("part", "turn", "role", "text", "fault")]
        for part, turn, role, text, fault in zip(*columns, strict=True):
            if current is None or current.part != part:
                if current is not None:
                    yield from ended(current)
                current = _Conversation(part)
            current.add(None if turn is None else int(turn), role, text, fault)
    if current is not None:
        yield from ended(current)
    if out:
        yield _frame(out)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=_COLUMNS)
    frame["turn"] = frame["turn"].astype("Int64")
    return frame


def _filled(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def edits(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The edit log that makes every conversation sound, a row per edit, in order within partitions.

    ``part`` is the conversation's id as text, ``step`` counts its edits, ``edit`` is K (keep),
    R (other role), D (delete) or I (insert), ``fault`` is blank, duplicate, truncated or null.
    ``role`` is the new role (null if deleted), ``role_before`` the old one (null if inserted).
    Of all cheapest logs the one whose letters come first is taken.

    Rows go by turn, nulls first, and by role and text within a turn. One shuffle deals them out by
    conversation; sorts and the search for earlier equal rows stay within its partitions.

    Nulls: a null role or text counts as one space, rows without an id are one conversation, and rows
    without a turn come first. Empty texts are blank, equal rows duplicates, texts of any length are
    whole. Roles count by their first letter; an empty role has none, so its row cannot be kept as it is. An
    empty table gives no rows.
    Other columns are not read.
    """
    prepare(rows.sparkSession)
    plain = rows.select(
        F.col(conversation).cast("string").alias("part"),
        F.col(turn).cast("long").alias("turn"),
        _filled(F.col(role)).alias("role"),
        _filled(F.col(text)).alias("text"),
    )
    dealt = plain.repartition("part")
    # dealt by conversation already: no further shuffle
    earlier = Window.partitionBy("part", "role", "text").orderBy(F.asc_nulls_first("turn"))
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    marked = dealt.withColumn("seen", F.row_number().over(earlier)).withColumn("last", last)
    fault = (
        F.when(F.col("last") == "", "blank")
        .when(F.col("seen") > 1, "duplicate")
        .when(~F.col("last").isin(".", "!", "?"), "truncated")
    )
    ordered = marked.select("part", "turn", "role", "text", "seen", fault.alias("fault")).sortWithinPartitions(
        F.asc_nulls_first("part"), F.asc_nulls_first("turn"), "role", "text", "seen"
    )
    # a text, so that no null turns whole numbers into floating point
    return ordered.withColumn("turn", F.col("turn").cast("string")).mapInPandas(_log, EDITS)


def repaired(log: DataFrame) -> DataFrame:
    """The rows that stay or are new, from ``edits``: ``(part, step, role, text)``."""
    return log.filter(F.col("edit") != DELETE).select("part", "step", "role", "text")


class _Report:
    """Counts over the edits of one conversation."""

    def __init__(self, part: str | None) -> None:
        self.part, self.audit, self.hash, self.started = part, [], hashlib.sha256(), False
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = self.turns = 0
        self.first = self.last = self.before = None

    def add(self, edit: str, fault: str | None, turn: int | None, role_before: str | None, role: str | None, text: str) -> None:
        self.audit.append(edit)
        self.cost += COSTS[edit]
        if edit != INSERT:
            if fault is not None:
                setattr(self, fault, getattr(self, fault) + 1)
            if fault == "truncated" and edit != DELETE:
                self.cost += TRUNCATED
            if self.before is not None and self.before + role_before[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = role_before[:1]
            if turn is not None:
                # turns come sorted
                self.turns += turn != self.last
                self.first, self.last = (turn if self.first is None else self.first), turn
        if edit != DELETE:
            self.hash.update((("\n" if self.started else "") + f"{role}:{text}").encode())
            self.started = True

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (
            self.part, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost,
            "".join(self.audit), self.hash.hexdigest(),
        )


REPORT = (
    "part string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)
_NAMES = [c.split()[0] for c in REPORT.split(", ")]


def _reports(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    current, out = None, []
    for batch in batches:
        columns = [batch[c] for c in ("part", "edit", "fault", "turn", "role_before", "role", "text")]
        for part, edit, fault, turn, role_before, role, text in zip(*columns, strict=True):
            if current is None or current.part != part:
                if current is not None:
                    out.append(current.row())
                current = _Report(part)
            current.add(edit, fault, None if turn is None else int(turn), role_before, role, text)
        if len(out) >= OUT_ROWS:
            yield pd.DataFrame(out, columns=_NAMES)
            out = []
    if current is not None:
        out.append(current.row())
    yield pd.DataFrame(out, columns=_NAMES)


def reports(log: DataFrame) -> DataFrame:
    """One row per conversation of an edit log as ``edits`` gives it: faults, gaps, cost, letters, hash."""
    return log.withColumn("turn", F.col("turn").cast("string")).mapInPandas(_reports, REPORT)


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with known faults, by a checksum of id and turn: see the query's contract."""
    case = F.crc32(F.concat(_filled(F.col("conv_id")), F.lit(":"), _filled(F.col("turn"))).cast("binary")) % 20
    text = _filled(F.col("text"))
    damaged = rows.select(
        "conv_id",
        "turn",
        F.when(case == 4, "user").otherwise(_filled(F.col("role"))).alias("role"),
        F.when(case == 1, "").when(case == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        case.alias("case"),
    ).filter(F.col("case") != 0)
    copies = F.when(F.col("case") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return damaged.withColumn("copy", F.explode(copies)).drop("case", "copy")


def repair_conversations(rows: DataFrame) -> DataFrame:
    """Every original conversation with the report on the repair of its damaged rows.

    Conversations without rows after the damage have zeros, no letters and the hash of nothing. Odd
    rows are treated as in ``edits``; an id that is null is an id of its own. An empty table gives no
    rows. Other columns are not read.
    """
    found = reports(edits(damage(rows)))
    kind = rows.schema["conv_id"].dataType
    ids = rows.select("conv_id").distinct()
    joined = ids.join(found.withColumn("of", F.col("part").cast(kind)), F.col("conv_id").eqNullSafe(F.col("of")), "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in _NAMES[1:7]]
    return joined.select(
        "conv_id",
        *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
