"""Operator 13, conversation structure repair by secondary-sorted streaming.

The cheapest edits turn a conversation's role initials into ``(s?(ua)+)?``:
Keep 0, Rerole to user or assistant 3, Delete 4 (the only choice for blank and
duplicate rows), Insert an empty user or assistant turn 3; a truncated row that
is not deleted costs 3 more. Ties go to the ASCII-least string of edit initials.

Rows are repartitioned by conversation, sorted by turn and streamed through
``mapInPandas``. The stream runs from the last turn to the first: the state is
the cost of finishing from each of the four grammar states (nothing yet, after
system, after user, after assistant), carried across Arrow batches. A row's
backpointers are one byte, the first edit of the best completion from each
state, two bits each; as every edit leads from a state to one state, choosing
the least letter among the cheapest at every step gives the least string. At
the conversation's first row the bytes are walked forward and the repaired
turns come out in order, one by one. Costs relative to each other take few
values, so steps are remembered per (relative costs, kind of row).

Memory: rows and backpointers of one conversation up to ``SPILL_BYTES``; beyond
that they go in chunks to the shared folder and are read back, last chunk first,
so a conversation that holds a third of all rows needs no more memory (but is
one task's stream, as the method asks). Chunk names carry the task attempt, so
a repeated task reads its own. What "seen earlier" means is settled before the
stream by a window over (conversation, role, text) inside the same partitions,
so no set of texts is held and the rows move once.

Defined results: NULL role and text count as one space; NULL turns sort first;
rows with equal turns are ordered by role and text; rows with a NULL
conversation id are one conversation; repeated rows are duplicates; a
conversation all of whose rows were dropped gives zeros, an empty audit and the
hash of the empty string; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featlab.llm.shared import shared_folder, small_batches, task_count
from featlab.llm.store import open_folder, put

#: Bytes of one conversation's rows held in memory.
SPILL_BYTES = 8 << 20

EDITS = "DIKR"  # two bits each, in ASCII order
DELETE, INSERT, KEEP, REROLE = range(4)
COST = {DELETE: 4, INSERT: 3, KEEP: 0, REROLE: 3}
TRUNCATED_COST = 3
#: Grammar states: nothing yet, after system, after user, after assistant.
INITIALS = "sua"
#: From a state by an initial to a state (1, 2, 3: after s, u, a).
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: The turn that may be inserted, or that a row may be reroled to, in each state.
NEXT_ROLE = ("user", "user", "assistant", "user")
END = (0, 6, 3, 0)  # cost of finishing without rows, by insertions

SUMMARY = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")
TURNS = "conv_id long, position long, edit string, role string, text string"


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage, by ``crc32("conv_id:turn") % 20``: 0 drops the row
    (it stays with ``present`` false, so that its conversation is known), 1
    empties the text, 2 removes ``.!?``, 3 repeats the row, 4 makes it a user's."""
    def named(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn")).cast("binary")) % 20
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate(named("text"), ".!?", "")).otherwise(named("text"))
    copies = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", "role", "text", kind.alias("_kind")).select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(named("role")).alias("role"), text.alias("text"),
        (F.col("_kind") != 0).alias("present"), F.explode(copies).alias("copy")).drop("copy")


def prepared(rows: DataFrame, present: str | None = None) -> DataFrame:
    """Rows with their fault, by conversation, from the last turn to the first.
    ``present``: a boolean column, false for rows that only name their conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    base = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                       (F.col(present) if present else F.lit(True)).alias("present"))
    dealt = base.repartition(task_count(rows.sparkSession), "conv_id")
    # dealt by conversation already: this window sorts, but does not shuffle again
    same = Window.partitionBy("conv_id", "present", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    again = F.row_number().over(same) > 1
    fault = F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "b").when(F.col("again"), "d") \
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "t").otherwise("-")
    return dealt.withColumn("again", again).withColumn("fault", fault) \
        .sortWithinPartitions("conv_id", F.col("turn").desc_nulls_last(), F.desc("role"), F.desc("text"), F.desc("again")) \
        .select(F.coalesce("conv_id", F.lit(0).cast("long")).alias("conv"), F.col("conv_id").isNull().alias("no_conv"),
                F.coalesce("turn", F.lit(0).cast("long")).alias("turn"), F.col("turn").isNull().alias("no_turn"), "role", "text", "present", "fault")


def best_step(costs: tuple[int, ...], initial: str, fault: str) -> tuple[tuple[int, ...], int]:
    """Costs of finishing from each state before a row, given those after it, and the row's backpointer byte."""
    options: list[list[tuple[int, int]]] = []
    extra = TRUNCATED_COST if fault == "t" else 0
    for state in range(4):
        found = [(COST[DELETE] + costs[state], DELETE)]
        if fault not in "bd":
            if (state, initial) in STEP:
                found.append((COST[KEEP] + extra + costs[STEP[state, initial]], KEEP))
            found.append((COST[REROLE] + extra + costs[STEP[state, NEXT_ROLE[state][0]]], REROLE))
        options.append(found)
    plain = [min(o)[0] for o in options]
    user, assistant = min(plain[2], COST[INSERT] + plain[3]), min(plain[3], COST[INSERT] + plain[2])
    after_insert = (user, user, assistant, user)
    out, byte = [], 0
    for state in range(4):
        cost, edit = min(options[state] + [(COST[INSERT] + after_insert[state], INSERT)])
        out.append(cost)
        byte |= edit << 2 * state
    return tuple(out), byte


class Conversation:
    """State of one conversation while its rows come, last turn first."""

    def __init__(self, conv_id: int | None, spill: Spill, steps: dict):
        self.conv_id, self.spill, self.steps = conv_id, spill, steps
        self.costs, self.base = END, 0
        self.faults = {"b": 0, "d": 0, "t": 0}
        self.illegal = self.distinct = 0
        self.following = ""
        self.last_turn = self.high = None
        self.rows: list[tuple[int, str, str]] = []
        self.held = self.chunks = 0

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if fault != "-":
            self.faults[fault] += 1
        initial = role[:1]
        if self.following and initial + self.following not in ("su", "ua", "au"):
            self.illegal += 1
        self.following = initial or "?"
        if turn is not None and turn != self.last_turn:
            self.distinct += 1
            self.high = turn if self.high is None else self.high
            self.last_turn = turn
        key = (self.costs, initial, fault)
        found = self.steps.get(key)
        if found is None:
            costs, byte = best_step(self.costs, initial, fault)
            low = min(costs)
            found = self.steps[key] = tuple(c - low for c in costs), low, byte
        self.costs, low, byte = found
        self.base += low
        self.rows.append((byte, role, text))
        self.held += len(text) + len(role) + 16
        if self.held >= self.spill.most:
            self.spill.write(self.chunks, self.rows)
            self.rows, self.held, self.chunks = [], 0, self.chunks + 1

    def forward(self) -> Iterator[tuple[int, str, str]]:
        yield from reversed(self.rows)
        self.rows = []
        for k in reversed(range(self.chunks)):
            yield from reversed(self.spill.read(k))

    def turns(self) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) in order; a deleted row has its own role and text."""
        state = 0
        for byte, role, text in self.forward():
            while (edit := byte >> 2 * state & 3) == INSERT:
                yield "I", NEXT_ROLE[state], ""
                state = STEP[state, NEXT_ROLE[state][0]]
            if edit == REROLE:
                role = NEXT_ROLE[state]
            yield EDITS[edit], role, text
            if edit != DELETE:
                state = STEP[state, role[0]]
        while END[state]:
            yield "I", NEXT_ROLE[state], ""
            state = STEP[state, NEXT_ROLE[state][0]]

    def summary(self) -> tuple:
        digest, audit, first = hashlib.sha256(), io.StringIO(), True
        for edit, role, text in self.turns():
            audit.write(edit)
            if edit != "D":
                digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
        gaps = 0 if self.high is None else self.high - self.last_turn + 1 - self.distinct
        return (self.conv_id, gaps, self.faults["b"], self.faults["d"], self.faults["t"], self.illegal, self.base + self.costs[0], audit.getvalue(),
                digest.hexdigest())


class Spill:
    """Chunks of one conversation's rows in the shared folder."""

    def __init__(self, folder: str, most: int):
        task = TaskContext.get()
        self.most, self.folder, self.name = most, folder, f"{task.partitionId():06d}-{task.taskAttemptId()}" if task else "local"
        self.used: set[int] = set()

    def write(self, k: int, rows: list[tuple[int, str, str]]) -> None:
        table = pa.table([pa.array(c, t) for c, t in zip(zip(*rows), (pa.uint8(), pa.string(), pa.large_string()))], names=["byte", "role", "text"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_file(sink, table.schema) as out:
            out.write_table(table)
        put(self.folder, f"{self.name}-{k}", [sink.getvalue()], "part")
        self.used.add(k)

    def read(self, k: int) -> list[tuple[int, str, str]]:
        files, path = open_folder(self.folder)
        with files.open_input_file(f"{path}/{self.name}-{k}") as f:
            table = pa.ipc.open_file(f.read_buffer()).read_all()
        return list(zip(*(table.column(c).to_pylist() for c in table.column_names)))

    def clear(self) -> None:
        files, path = open_folder(self.folder)
        for k in self.used:
            files.delete_file(f"{path}/{self.name}-{k}")
        self.used = set()


def _conversations(frames: Iterator[pd.DataFrame], folder: str, most: int) -> Iterator[Conversation]:
    """Conversations as their last row is met; each is to be used before the next."""
    steps: dict = {}
    spill = Spill(folder, most)
    now: Conversation | None = None
    for frame in frames:
        for conv, no_conv, turn, no_turn, role, text, present, fault in zip(*(frame[c].tolist() for c in frame.columns)):
            conv_id = None if no_conv else conv
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    yield now
                    spill.clear()
                now = Conversation(conv_id, spill, steps)
            if present:
                now.add(None if no_turn else turn, role, text, fault)
    if now is not None:
        yield now
        spill.clear()


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[f.split()[0] for f in schema.split(", ")])
    out["conv_id"] = pd.array(out["conv_id"].tolist(), dtype="Int64")
    return out


def _batched(found: Iterator[tuple], schema: str, most_bytes: int = 4 << 20) -> Iterator[pd.DataFrame]:
    rows: list[tuple] = []
    held = 0
    for row in found:
        rows.append(row)
        held += sum(len(x) if isinstance(x, str) else 8 for x in row)
        if held > most_bytes:
            yield _frame(rows, schema)
            rows, held = [], 0
    if rows:
        yield _frame(rows, schema)


def repair(rows: DataFrame, present: str | None = None, spill_bytes: int = SPILL_BYTES) -> DataFrame:
    """One row per conversation: the faults found, the cost, the edits and the digest of the repaired turns."""
    small_batches(rows.sparkSession)
    folder = shared_folder(rows.sparkSession, "turn-spill")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _batched((c.summary() for c in _conversations(frames, folder, spill_bytes)), SUMMARY)
    return prepared(rows, present).mapInPandas(run, SUMMARY)


def repaired_turns(rows: DataFrame, present: str | None = None, spill_bytes: int = SPILL_BYTES) -> DataFrame:
    """The repaired turns themselves, one row each (``position`` from 0; deleted rows are left out)."""
    small_batches(rows.sparkSession)
    folder = shared_folder(rows.sparkSession, "turn-spill")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def kept() -> Iterator[tuple]:
            for c in _conversations(frames, folder, spill_bytes):
                position = 0
                for edit, role, text in c.turns():
                    if edit != "D":
                        yield c.conv_id, position, edit, role, text
                        position += 1
        yield from _batched(kept(), TURNS)
    return prepared(rows, present).mapInPandas(run, TURNS)
