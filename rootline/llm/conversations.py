"""Conversation structure repair: the cheapest edits that make the roles of a conversation ``(s?(ua)+)?``.

The edits are a weighted automaton over the rows' symbols (a role's initial, and whether a row must go or is truncated) with
four states: nothing yet, after a system row, after a user row, after an assistant row. It is determinised lazily: the vector
of the states' costs, less its least entry, is a state of the deterministic automaton, and what a symbol makes of it stands in
a transition table once it was computed. Entries that can't be part of a cheapest repair any more are infinite, so the vectors
are few. A scan by the table gives the costs; tight arcs traced backward from the end mark what lies on a cheapest repair, and
the walk along these, least letter first, is the audit.

The rows are never gathered by conversation with their texts before the plan stands: faults come from marks (two hashes of role
and text), rows that repeat are counted before they are shuffled, and runs of rows are turned into strings of symbols where a
sort by range has put them, so a long conversation is cut over many tasks; the strings of a conversation, a letter for each row
as in its audit, are then put together. Texts are shuffled once, for the repaired rows, and streamed through.

Defined cases: a null role or text is one space, as is a null conv_id or turn in the key of the damage; null ids are one
conversation; null turns come first; rows of a turn are in the order of role, then of the marks; rows that repeat are rows each,
and the first alone is no duplicate; a role whose initial isn't s, u or a can't be kept; a conversation without rows has an
empty plan; an empty table gives an empty table; other columns are not read. SHA-256 takes a conversation's bytes one after the
other, so one task streams them, in bounded memory.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootline.llm.common import stored
from rootline.llm.words import tidied

WHITE = " \t\n\x0b\x0c\r"
ENDINGS = ".!?"
INITIALS = "sua"
FINE, TRUNCATED, GONE = 0, 1, 2
REROLE, DELETE, INSERT, STAYS_TRUNCATED = 2, 3, 2, 1
NEVER = 10**9
#: States: nothing yet, after s, after u, after a. What each goes to by an initial, and by a user/assistant row put there.
_KEEP = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
_PUT = {0: 2, 1: 2, 2: 3, 3: 2}
_ENDS = (0, 3)
_ROLE = {2: "user", 3: "assistant"}


def symbol(role: str, kind: int) -> int:
    """A row's symbol: 3 x (place of the initial among s, u, a, others) + kind."""
    at = INITIALS.find(role[:1]) if role else -1
    return 3 * (at if at >= 0 else len(INITIALS)) + kind


def _arcs(q: int, sym: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of what a row may become, letters in order."""
    at, kind = divmod(sym, 3)
    out = [("D", DELETE, q)]
    if kind != GONE:
        more = STAYS_TRUNCATED if kind == TRUNCATED else 0
        if at < len(INITIALS) and INITIALS[at] in _KEEP[q]:
            out.append(("K", more, _KEEP[q][INITIALS[at]]))
        out.append(("R", REROLE + more, _PUT[q]))
    return out


class Determinised:
    """The lazily determinised automaton, with its tables: transitions, and steps of the backward trace."""

    def __init__(self):
        self.vectors: list[tuple[int, ...]] = []
        self.number: dict[tuple[int, ...], int] = {}
        self.next: list[int] = []
        self.added: list[int] = []
        self.steps: list[tuple[int, tuple]] = []
        self.step_of: dict[tuple[int, int, int], int] = {}
        self.start, _ = self._state([0, NEVER, NEVER, NEVER])

    def _state(self, v: list[int]) -> tuple[int, int]:
        """The number of a cost vector, after rows were put in, and what was taken off it."""
        v[2] = min(v[2], *(v[q] + INSERT for q in (0, 1, 3)))
        v[3] = min(v[3], v[2] + INSERT)
        # all that can follow a system row can follow an assistant's too; what can follow nothing can too, for one deletion
        v[1] = NEVER if v[1] > v[3] else v[1]
        v[0] = NEVER if v[0] > v[3] + DELETE else v[0]
        least = min(v)
        own = tuple(NEVER if x >= NEVER else x - least for x in v)
        if own not in self.number:
            self.number[own] = len(self.vectors)
            self.vectors.append(own)
            self.next += [-1] * 12
            self.added += [0] * 12
        return self.number[own], least

    def _go(self, state: int, sym: int) -> int:
        v = [NEVER] * 4
        for q, cost in enumerate(self.vectors[state]):
            if cost < NEVER:
                for _, more, to in _arcs(q, sym):
                    v[to] = min(v[to], cost + more)
        k = 12 * state + sym
        to, self.added[k] = self._state(v)
        self.next[k] = to
        return to

    def _put_in(self, v: tuple[int, ...], q: int) -> bool:
        return v[q] < NEVER and v[q] + INSERT == v[_PUT[q]]

    def _step(self, state: int, sym: int, alive: int) -> int:
        """Which states before a row are on a cheapest repair, given those after it, and the letters and state that follow."""
        v, k = self.vectors[state], 12 * state + sym
        after = [x + self.added[k] if x < NEVER else NEVER for x in self.vectors[self.next[k]]]
        row: list = [None] * 4
        for q in range(4):
            if v[q] < NEVER:
                row[q] = next(((letter, to) for letter, more, to in _arcs(q, sym) if alive >> to & 1 and v[q] + more == after[to]), None)
        # a deletion comes before a row put in, and that before the other letters
        for _ in range(2):
            for q in range(4):
                put = row[_PUT[q]]
                if self._put_in(v, q) and put and not (row[q] and row[q][0][0] in "DI"):
                    row[q] = ("I" + put[0], put[1])
        self.steps.append((sum(1 << q for q in range(4) if row[q]), tuple(row)))
        self.step_of[state, sym, alive] = len(self.steps) - 1
        return len(self.steps) - 1

    def repair(self, symbols: bytes) -> tuple[int, str]:
        """The cost of the cheapest repair of a conversation, and the least audit of that cost."""
        state, cost, states = self.start, 0, array("i")
        go, added = self.next, self.added
        for sym in symbols:
            states.append(state)
            k = 12 * state + sym
            to = go[k]
            state = to if to >= 0 else self._go(state, sym)
            cost += added[k]
        v = self.vectors[state]
        least = min(v[q] for q in _ENDS)
        alive = sum(1 << q for q in range(4) if (q in _ENDS and v[q] == least) or (self._put_in(v, q) and _PUT[q] in _ENDS and v[_PUT[q]] == least))
        alive |= sum(1 << q for q in range(4) if self._put_in(v, q) and alive >> _PUT[q] & 1)
        taken, last = array("i", bytes(4 * len(symbols))), alive
        for k in range(len(symbols) - 1, -1, -1):
            at = self.step_of.get((states[k], symbols[k], alive))
            taken[k] = at = self._step(states[k], symbols[k], alive) if at is None else at
            alive = self.steps[at][0]
        out, q = [], 0
        for at in taken:
            letters, q = self.steps[at][1][q]
            out.append(letters)
        while not (q in _ENDS and v[q] == least and last >> q & 1):
            out.append("I")
            q = _PUT[q]
        return cost + least, "".join(out)


@cache
def automaton() -> Determinised:
    """One for each Python worker, so that its tables serve all conversations."""
    return Determinised()


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows by crc32('conv_id:turn') % 20, where 0 drops a row (no copies), 1 empties its
    text, 2 takes its sentence ends out, 3 repeats it and 4 makes it a user's."""
    words = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(words("conv_id"), F.lit(":"), words("turn")).cast("binary")) % 20
    text = F.when(h == 1, "").when(h == 2, F.translate(words("text"), ENDINGS, "")).otherwise(words("text"))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.when(h == 4, "user").otherwise(words("role")).alias("role"), text.alias("text"),
        F.when(h == 0, 0).when(h == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _marks() -> tuple[Column, Column]:
    return F.xxhash64("role", "text").alias("m1"), F.xxhash64(F.lit(1), "role", "text").alias("m2")


_ORDER = ("role", "m1", "m2")


def _counted(rows: DataFrame) -> DataFrame:
    """Equal rows of a turn as one: (conv_id, turn, role, m1, m2, kind, n, fresh). ``fresh``: no such role and text before."""
    stripped = F.rtrim("text", F.lit(WHITE))
    kind = F.when(stripped == "", GONE).when(F.right(stripped, F.lit(1)).isin(*ENDINGS), FINE).otherwise(TRUNCATED)
    own = rows.select("conv_id", "turn", "role", *_marks(), kind.alias("kind"), "copies").groupBy("conv_id", "turn", "role", "m1", "m2", "kind").agg(F.sum("copies").alias("n"))
    # the earliest turn of what several turns have; it is joined, so that no task needs all turns of a text
    again = own.where("n > 0").groupBy(F.col("conv_id").alias("_c"), F.col("m1").alias("_1"), F.col("m2").alias("_2")).agg(F.count(F.lit(1)).alias("_turns"), F.max(F.col("turn").isNull()).alias("_null"), F.min("turn").alias("_least")).where("_turns > 1")
    joined = own.join(again, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("m1") == F.col("_1")) & (F.col("m2") == F.col("_2")), "left")
    fresh = F.col("_turns").isNull() | F.when(F.col("_null"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("_least"))
    return joined.select("conv_id", "turn", "role", "m1", "m2", "kind", "n", fresh.alias("fresh"))


_RUN = "conv_id long, part int, symbols binary, least long, most long, turns long, blank long, duplicate long, truncated long"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows -> a string of symbols, and counts, for each conversation's rows in this partition."""
    part, done = TaskContext.get().partitionId() if TaskContext.get() else 0, pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("symbols", pa.binary()), *((n, pa.int64()) for n in ("least", "most", "turns", "blank", "duplicate", "truncated"))])
    now, held, out = None, False, []

    def close() -> None:
        conv, text, turns, counts = now
        out.append((conv, part, bytes(text), *turns, *counts))

    def flush() -> pa.RecordBatch:
        cols = list(zip(*out, strict=True)) if out else [()] * len(done)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, done, strict=True)], schema=done)

    for batch in batches:
        for conv, turn, role, kind, n, fresh in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "turn", "role", "kind", "n", "fresh")), strict=True):
            if not held or conv != now[0]:
                if held:
                    close()
                now, held = (conv, bytearray(), [None, None, 0], [0, 0, 0]), True
            if not n:
                continue
            gone = symbol(role, GONE)
            if kind == GONE:
                now[3][0] += n
                now[1].extend(bytes([gone]) * n)
            else:
                now[3][1] += n - 1 if fresh else n
                now[3][2] += kind == TRUNCATED and fresh
                now[1].append(symbol(role, kind) if fresh else gone)
                now[1].extend(bytes([gone]) * (n - 1))
            if turn is not None and turn != now[2][1]:
                now[2][:] = [turn if now[2][0] is None else now[2][0], turn, now[2][2] + 1]
        if len(out) >= 4096:
            yield flush()
    if held:
        close()
    yield flush()


_PLAN = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted runs -> the plan of each conversation."""
    legal = {("s", "u"), ("u", "a"), ("a", "u")}
    letters = {3 * k + kind: c for k, c in enumerate(INITIALS + "o") for kind in (FINE, TRUNCATED, GONE)}
    bad = {bytes([x, y]) for x, c in letters.items() for y, d in letters.items() if (c, d) not in legal}
    now, held, out = [], False, []

    def close() -> None:
        symbols = b"".join(r[0] for r in now[1])
        least, most, turns = None, None, 0
        for _, a, z, n, *_ in now[1]:
            if n:
                turns += n - (a == most)
                least, most = a if least is None else least, z
        cost, audit = automaton().repair(symbols)
        illegal = sum(symbols[k : k + 2] in bad for k in range(len(symbols) - 1))
        out.append((now[0], most - least + 1 - turns if turns else 0, *(sum(r[k] for r in now[1]) for k in (4, 5, 6)), illegal, cost, audit))

    def flush() -> pa.RecordBatch:
        cols = list(zip(*out, strict=True)) if out else [()] * 8
        out.clear()
        names = [x.split()[0] for x in _PLAN.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n == "audit" else pa.int64()) for c, n in zip(cols, names, strict=True)], names)

    for batch in batches:
        for conv, *run in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "symbols", "least", "most", "turns", "blank", "duplicate", "truncated")), strict=True):
            if not held or conv != now[0]:
                if held:
                    close()
                now, held = (conv, []), True
            now[1].append(run)
        if len(out) >= 1024:
            yield flush()
    if held:
        close()
    yield flush()


def plan_repairs(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) for each conversation of rows as damage() gives them:
    counts of faults, and the cheapest repair's cost and letters (Keep, Rerole, Delete, Insert)."""
    order = ["conv_id", F.col("turn").asc_nulls_first(), *_ORDER]
    counted = _counted(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    runs = counted.select("conv_id", "turn", "role", "kind", "n", "fresh").mapInArrow(_runs, _RUN)
    return runs.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(tidied(_plans), _PLAN)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str | None, str, str]]:
    """Streams (conv_id, edit, role, text): the repaired rows of conversation after conversation, by their audits. The edit of a
    conversation's last item is None."""
    conv, held, audit, at, q = None, False, "", 0, 0

    def put() -> Iterator[tuple]:
        nonlocal at, q
        while at < len(audit) and audit[at] == "I":
            at, q = at + 1, _PUT[q]
            yield conv, "I", _ROLE[q], ""

    for batch in batches:
        for c, turn_or_plan, role, copies, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "plan", "role", "copies", "text")), strict=True):
            if turn_or_plan:
                if held:
                    yield from put()
                    yield conv, None, "", ""
                conv, held, audit, at, q = c, True, text, 0, 0
                continue
            for _ in range(copies):
                yield from put()
                letter, at = audit[at], at + 1
                if letter == "K":
                    q = _KEEP[q][role[0]]
                    yield conv, "K", role, text
                elif letter == "R":
                    q = _PUT[q]
                    yield conv, "R", _ROLE[q], text
    if held:
        yield from put()
        yield conv, None, "", ""


def _met(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The rows of each conversation in order, after its plan."""
    own = rows.where("copies > 0").select("conv_id", F.lit(False).alias("plan"), "turn", "role", *_marks(), "copies", "text")
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    plan = plans.select("conv_id", F.lit(True).alias("plan"), none("long", "turn"), F.lit("").alias("role"), none("long", "m1"), none("long", "m2"), F.lit(0).cast("long").alias("copies"), F.col("audit").alias("text"))
    both = plan.union(own).repartition("conv_id").sortWithinPartitions("conv_id", F.col("plan").desc(), F.col("turn").asc_nulls_first(), *_ORDER)
    return both.select("conv_id", "plan", "role", "copies", "text")


def repaired_rows(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the rows of the repaired conversations, from place 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, out, size = 0, [], 0
        names = ["conv_id", "place", "edit", "role", "text"]
        make = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * 5, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()), strict=True)], names)
        for conv, edit, role, text in _walk(batches):
            if edit is None:
                place = 0
                continue
            out.append((conv, place, edit, role, text))
            place, size = place + 1, size + len(text)
            if len(out) >= 4096 or size > 4_000_000:
                yield make()
                out, size = [], 0
        yield make()

    return _met(rows, plans).mapInArrow(tidied(run), "conv_id long, place long, edit string, role string, text string")


def digests(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): of the repaired rows as ``role:text``, joined by newlines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, empty, out = hashlib.sha256(), True, []
        make = lambda: pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string())], ["conv_id", "repaired_sha256"])
        for conv, edit, role, text in _walk(batches):
            if edit is None:
                out.append((conv, digest.hexdigest()))
                digest, empty = hashlib.sha256(), True
                if len(out) >= 4096:
                    yield make()
                    out = []
                continue
            digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
            empty = False
        yield make()

    return _met(rows, plans).mapInArrow(tidied(run), "conv_id long, repaired_sha256 string")


def repair(conversations: DataFrame) -> DataFrame:
    """The damaged conversations' plans with the digest of their repaired rows."""
    rows = damage(conversations)
    plans = stored(plan_repairs(rows), "repairs").df
    return plans.join(digests(rows, plans).withColumnRenamed("conv_id", "_c"), F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c")
