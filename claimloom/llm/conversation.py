"""Conversation repair: the cheapest edits that make roles alternate.

A conversation is well formed if its role initials match ``(s?(ua)+)?``. Its
turns are aligned with each feasible length of that alternating string by
Wagner and Fischer's table: keep a turn (0), give it another role (1), delete it
(2; a must for blank and repeated turns), insert an empty turn (5); a truncated
turn that stays costs 5 more. Alternating strings of all lengths share their
suffixes, so one table over (turns left, length left) holds the costs of all of
them. Its rows are banded as by Ukkonen: with an incumbent of cost C, no more than
C/5 turns are inserted and C/2 deleted. Of equal costs, the least audit (the
edits' initials in order) is picked by comparing the backtraced ones.

A long conversation is aligned in blocks of ``BLOCK`` turns, one table per block
and per role that the block may end with; the best way through all blocks joins
them by the role that must come next. An insertion belongs to the turn after it,
so of two audits of a block none is a prefix of the other, and the least whole
audit is made of least parts.

What is told by the text alone is computed in Spark: blank, truncated, and which
texts come up again in their conversation. A task gets a conversation twice in
order, first as such flags, then the texts; it holds one byte a turn, no texts.

Defined results
---------------
A null role, text or id is one space; null ids are one conversation. Turns are
in the order of ``turn``, nulls first; ties go by role, then by the SHA-256 of
the text. Repeated rows are repeated turns. A role is told by its first
character; one that is none of s, u, a can only be given another or deleted, an
empty one too. A conversation whose rows all have ``copies`` 0 keeps its id, with
zeros and an empty audit. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from claimloom.llm.common import frees_memory, join_measured, stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Turns aligned in one table, and turns up to which an alignment is remembered.
BLOCK, SHORT = 512, 12
FAR = 1 << 29
#: A turn in one byte: its role, and what is wrong with it.
SYSTEM, USER, ASSISTANT, OTHER = range(4)
CUT, MUST_GO = 4, 8
ROLES = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: What has been written: nothing, the system turn, a whole exchange, a user turn.
NOTHING, AFTER_SYSTEM, AFTER_ASSISTANT, AFTER_USER = range(4)
LEGAL = {"su", "ua", "au"}

NO_BLANK, ENDED = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"
FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


# --- alignment ---------------------------------------------------------------


class Table:
    """Costs of aligning turns i.. of a block with the r last roles before ``last`` has been written.

    ``open_end``: turns may be inserted behind the block's last one.
    """

    def __init__(self, codes: bytes, last: int, open_end: bool, most: int):
        self.codes, self.last = codes, last
        n = len(codes)
        self.width = n + most // INSERT + 1
        steps = INSERT * np.arange(self.width)
        odd = np.arange(self.width) % 2 == 1
        self.rows = [steps if open_end else np.where(steps, FAR, 0)]
        for i in range(n - 1, -1, -1):
            low, high = max(0, n - i - most // DELETE), min(self.width, n - i + most // INSERT + 1)
            below = self.rows[-1]
            new = below + DELETE
            written = np.where(odd, self.write_cost(i, self.role(1)), self.write_cost(i, self.role(2)))
            np.minimum(new[1:], below[:-1] + written[1:], out=new[1:])
            new[:low] = FAR
            new[high:] = FAR
            # Insertions before this turn, any number of them.
            new[low:high] = np.minimum.accumulate(new[low:high] - steps[low:high]) + steps[low:high]
            self.rows.append(np.minimum(new, FAR))
        self.rows.reverse()

    def role(self, left: int) -> int:
        """The role written when ``left`` are still to be written."""
        return self.last if left % 2 else ASSISTANT + USER - self.last

    def write_cost(self, i: int, role: int) -> int:
        code = self.codes[i]
        if code & MUST_GO:
            return FAR
        return (KEEP if code & 3 == role else REROLE) + (TRUNCATED if code & CUT else 0)

    def trace(self, i: int, left: int) -> str:
        """The least of the cheapest audits from here on; letters are tried in their order."""
        audit = []
        n = len(self.codes)
        while i < n or left:
            cost = self.rows[i][left]
            if i < n and self.rows[i + 1][left] + DELETE == cost:
                audit.append("D")
                i += 1
            elif left and self.rows[i][left - 1] + INSERT == cost:
                audit.append("I")
                left -= 1
            else:
                audit.append("K" if self.codes[i] & 3 == self.role(left) else "R")
                i, left = i + 1, left - 1
        return "".join(audit)

    def best(self, start: int, parity: int, least: int = 0) -> tuple[int, str] | None:
        """Cost and audit of turns ``start``.. over all lengths of one parity, of ``least`` roles or more."""
        row = self.rows[start]
        lengths = np.arange(least + (least + parity) % 2, self.width, 2)
        if not len(lengths) or row[lengths].min() >= FAR:
            return None
        cost = int(row[lengths].min())
        return cost, min(self.trace(start, int(left)) for left in lengths[row[lengths] == cost])


def incumbent(codes: bytes) -> int:
    """No less than the cheapest way through a block, from any role to any other."""
    cost, role = 0, USER
    for code in codes:
        if code & MUST_GO or (code & CUT and code & 3 != role):
            cost += DELETE
        else:
            cost += (KEEP if code & 3 == role else REROLE) + (TRUNCATED if code & CUT else 0)
            role = ASSISTANT + USER - role
    return min(cost, DELETE * len(codes)) + 2 * INSERT + 2 * REROLE


def ways(codes: bytes, closing: bool) -> dict[tuple[int, int], tuple[int, str]]:
    """The cheapest way through a block for each (written before, written after)."""
    n = len(codes)
    found: dict[tuple[int, int], tuple[int, str]] = {}

    def offer(before: int, after: int, way: tuple[int, str] | None) -> None:
        if way and ((before, after) not in found or way < found[before, after]):
            found[before, after] = way

    nothing = (DELETE * n, "D" * n)
    for state in range(4):
        offer(state, state, nothing)
    firsts = [i for i, code in enumerate(codes) if code & 3 == SYSTEM and not code & MUST_GO]
    for last, after in ((ASSISTANT, AFTER_ASSISTANT), (USER, AFTER_USER)):
        if closing and after == AFTER_USER:
            continue
        table = Table(codes, last, closing, incumbent(codes))
        from_user = 0 if last == ASSISTANT else 1  # parity of a rest that starts with a user turn
        for before in (NOTHING, AFTER_SYSTEM, AFTER_ASSISTANT):
            offer(before, after, table.best(0, from_user, 1))
        offer(AFTER_USER, after, table.best(0, 1 - from_user, 1))
        for i in firsts:
            rest = table.best(i + 1, from_user, 1)
            if rest:
                kept = DELETE * i + KEEP + (TRUNCATED if codes[i] & CUT else 0)
                offer(NOTHING, after, (kept + rest[0], "D" * i + "K" + rest[1]))
    if not closing:
        for i in firsts:
            kept = DELETE * (n - 1) + KEEP + (TRUNCATED if codes[i] & CUT else 0)
            offer(NOTHING, AFTER_SYSTEM, (kept, "D" * i + "K" + "D" * (n - 1 - i)))
    return found


def align(codes: bytes, block: int = BLOCK) -> tuple[int, str]:
    """Cost and audit of a conversation."""
    return _aligned_short(codes) if len(codes) <= min(SHORT, block) else _aligned(codes, block)


def _aligned(codes: bytes, block: int) -> tuple[int, str]:
    parts = [codes[at : at + block] for at in range(0, len(codes), block)]
    steps = [ways(part, k == len(parts) - 1) for k, part in enumerate(parts)]
    accepted = {NOTHING, AFTER_ASSISTANT}
    costs = [{state: 0 if state in accepted else FAR for state in range(4)}]
    for step in reversed(steps):
        ahead = costs[-1]
        costs.append({s: min((way[0] + ahead[t] for (f, t), way in step.items() if f == s), default=FAR) for s in range(4)})
    costs.reverse()
    state, audit = NOTHING, []
    for step, here, ahead in zip(steps, costs, costs[1:]):
        letters, state = min(
            (way[1], t) for (f, t), way in step.items() if f == state and way[0] + ahead[t] == here[state]
        )
        audit.append(letters)
    return costs[0][NOTHING], "".join(audit)


@lru_cache(maxsize=100_000)
def _aligned_short(codes: bytes) -> tuple[int, str]:
    return _aligned(codes, SHORT) if codes else (0, "")


# --- a task's conversations --------------------------------------------------


class Conversation:
    """One conversation as it comes along: first the flags of all turns, then their texts."""

    def __init__(self, key):
        self.key = key
        self.codes = bytearray()
        self.figures = dict.fromkeys(FIGURES, 0)
        self.first_turn = self.last_turn = self.initial = None
        self.turns = 0
        self.audit: str | None = None
        self.at = self.written = 0
        self.hash = hashlib.sha256()

    def flags(self, turn, initial: str, n: int, blank: bool, again: bool, cut: bool) -> None:
        """``n`` equal rows; those after the first repeat it."""
        if not n:
            return
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
            self.turns += 1
        for copy in range(n):
            fault = "blank" if blank else "duplicate" if again or copy else "truncated" if cut else None
            if fault:
                self.figures[fault] += 1
            if self.initial is not None and self.initial + initial not in LEGAL:
                self.figures["illegal"] += 1
            self.initial = initial
            wrong = CUT if fault == "truncated" else MUST_GO if fault else 0
            self.codes.append(ROLES.get(initial, OTHER) | wrong)

    def settle(self) -> None:
        """All flags are in."""
        if self.audit is None:
            self.figures["cost"], self.audit = align(bytes(self.codes))
            if self.turns:
                self.figures["gaps"] = self.last_turn - self.first_turn + 1 - self.turns

    def write(self, role: str, text: str) -> tuple:
        if self.written:
            self.hash.update(b"\n")
        self.hash.update(f"{role}:{text}".encode())
        self.written += 1
        self.expected = ASSISTANT if role[:1] == "u" else USER
        return self.written - 1, role, text

    def inserted(self) -> Iterator[tuple]:
        """Turns inserted before the next one of the input."""
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield (*self.write(NAMES[self.next_role], ""), True)

    @property
    def next_role(self) -> int:
        return self.expected if self.written else USER

    def text(self, role: str, text: str) -> Iterator[tuple]:
        """The repaired turns that a turn of the input leads to: place, role, text, added."""
        self.settle()
        yield from self.inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit != "D":
            yield (*self.write(role if edit == "K" else NAMES[self.next_role], text), False)

    def finish(self) -> Iterator[tuple]:
        self.settle()
        yield from self.inserted()


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            yield from batch.slice(at, 1000).to_pylist()


@frees_memory
def repair_task(batches: Iterator[pa.RecordBatch], schema: pa.Schema, turns: bool) -> Iterator[pa.RecordBatch]:
    """Repaired turns, or a row of figures per conversation."""
    rows: list[tuple] = []
    open_: Conversation | None = None

    def take(found: Iterator[tuple]) -> None:
        for turn in found:
            if turns:
                rows.append((open_.key, *turn))

    def end() -> None:
        if open_ is not None:
            take(open_.finish())
            if not turns:
                figures = [open_.figures[f] for f in FIGURES]
                rows.append((open_.key, *figures, open_.audit, open_.hash.hexdigest()))

    def batch() -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(schema)
        return pa.record_batch([pa.array(c, k.type) for c, k in zip(columns, schema)], schema=schema)

    held = 0
    for row in _in_order(batches):
        if open_ is None or row["conv_id"] != open_.key:
            end()
            open_ = Conversation(row["conv_id"])
        if row["texts"]:
            for _ in range(row["n"]):
                take(open_.text(row["role"], row["text"]))
            held += len(row["text"]) * row["n"] if turns else 0
        else:
            open_.flags(row["turn"], row["role"][:1], row["n"], row["blank"], row["again"], row["cut"])
        if len(rows) >= 5000 or held > 1 << 22:
            yield batch()
            rows, held = [], 0
    end()
    yield batch()


# --- Spark -------------------------------------------------------------------


def _turns(conversations: DataFrame, copies: str | None) -> DataFrame:
    """conv_id, turn, role, text, copies, digest; nulls as one space."""
    text = F.coalesce("text", F.lit(" "))
    return conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        text.alias("text"),
        (F.lit(1) if copies is None else F.col(copies).cast("int")).alias("copies"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
    )


def _flags(turns: DataFrame) -> DataFrame:
    """One row per distinct turn, with ``n``, blank, cut, and whether its text came up ``again``."""
    text = F.col("text")
    distinct = stored(
        turns.groupBy("conv_id", "turn", "role", "digest").agg(
            F.sum("copies").cast("int").alias("n"),
            F.bool_or(~text.rlike(NO_BLANK)).alias("blank"),
            F.bool_or(~text.rlike(ENDED)).alias("cut"),
        ),
        "turns",
    )
    keys = ["conv_id", "role", "digest"]
    # A struct, as its smallest value may hold a null turn, which comes first.
    repeated = (
        distinct.where("n > 0")
        .groupBy(*keys)
        .agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("places"))
        .where("places > 1")
        .select(*keys, "first")
    )
    found = join_measured(distinct, stored(repeated, "repeated"), keys, "left")
    again = F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    return found.select("conv_id", "turn", "role", "digest", "n", "blank", "cut", again.alias("again"))


def _in_tasks(conversations: DataFrame, copies: str | None) -> DataFrame:
    turns = _turns(conversations, copies)
    none = F.lit(None).cast("boolean")
    texts = turns.where("copies > 0").select(
        "conv_id", F.lit(True).alias("texts"), "turn", "role", "digest", F.col("copies").alias("n"),
        none.alias("blank"), none.alias("cut"), none.alias("again"), "text",
    )
    flags = _flags(turns).select(
        "conv_id", F.lit(False).alias("texts"), "turn", "role", "digest", "n",
        "blank", "cut", "again", F.lit(None).cast("string").alias("text"),
    )
    dealt = flags.unionByName(texts).repartition("conv_id")
    return dealt.sortWithinPartitions("conv_id", "texts", F.asc_nulls_first("turn"), "role", "digest")


def _run(conversations: DataFrame, copies: str | None, columns: str, turns: bool) -> DataFrame:
    columns = f"conv_id {conversations.schema['conv_id'].dataType.simpleString()}, {columns}"
    task = partial(repair_task, schema=to_arrow_schema(StructType.fromDDL(columns)), turns=turns)
    return _in_tasks(conversations, copies).mapInArrow(task, columns)


def repaired(conversations: DataFrame, copies: str | None = None) -> DataFrame:
    """The repaired turns: conv_id, place (from 0), role, text, added (inserted by the repair).

    ``copies`` names a column that says how often a row counts; 0 only keeps the id.
    """
    return _run(conversations, copies, "place long, role string, text string, added boolean", turns=True)


def audits(conversations: DataFrame, copies: str | None = None) -> DataFrame:
    """Per conversation: conv_id, FIGURES, audit, and the digest of its repaired turns as ``role:text`` lines."""
    figures = ", ".join(f"{f} long" for f in FIGURES)
    return _run(conversations, copies, f"{figures}, audit string, repaired_sha256 string", turns=False)


# --- damage ------------------------------------------------------------------


def damage_of(conv_id: Column, turn: Column) -> Column:
    """What happens to a turn, 0 to 19, by the checksum of its place."""
    parts = [F.coalesce(c.cast("string"), F.lit(" ")) for c in (conv_id, turn)]
    return F.crc32(F.concat_ws(":", *parts).cast("binary")) % 20


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: turns dropped (0 copies), emptied, cut off, repeated or given to the user."""
    kind = damage_of(F.col("conv_id"), F.col("turn"))
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )
