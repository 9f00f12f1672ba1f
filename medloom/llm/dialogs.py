"""Conversation repair by two secondary-sorted streams.

The fewest edits that make a conversation's roles alternate are found by dynamic programming over four
states of the role grammar `(s?(ua)+)?`: nothing yet, after the system's, after a user's, after an
assistant's turn. `Keep` costs nothing, `Rerole` 2, `Delete` 3, `Insert` of an empty turn 2, and a truncated
turn that stays 1; blank and duplicate turns have to go.

1. Rows without their texts are repartitioned by conversation and sorted by turn, last turn first. A task
   carries four costs from row to row and from Arrow batch to Arrow batch; what is cheapest to do with a row in
   each state is one byte, two bits a state. Bytes are spilled as rows of `BLOCK` bytes to a stored table, so
   a task holds one block of a conversation of any length. Of edits with equal cost the one with the
   ASCII-least initial is taken: in one state no two edits share an initial, and the costs behind them are
   known, so that the whole audit is the least.
2. Rows with their texts, and the blocks, are repartitioned by conversation and sorted by turn, first turn
   first, a block just before its first row. A task follows the bytes from state to state and feeds the
   repaired lines to a running digest; it holds one text and the audit.

Null roles and texts are one space, a null conversation or turn is a space in the damage key; a null
conversation is one of its own, and null turns come first. Rows of one turn go by a digest of role and text.
Rows repeated in full are counted before they are shuffled; all but the first are duplicates. A conversation
without rows has zeros, an empty audit and the digest of the empty string. Empty tables give no rows. Other
columns are not read.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.llm.common import prepare, stored

#: Rows whose back pointers are spilled together; rows of an Arrow batch.
BLOCK, ROWS = 1 << 16, 4000
WHITE = " \t\n\x0b\x0c\r"

# States: nothing yet, after s, after u, after a.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
EDITS = "DIKR"
DELETE, INSERT, KEEP, REROLE = range(4)
INITIALS = ("", "s", "u", "a")
#: The state after a user's or assistant's turn that is put in, and the states that a kept initial leads to.
NEXT = (USER, USER, ASSISTANT, USER)
KEPT = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Costs of ending in each state.
AT_END = (0, 4, 2, 0)


def step(initial: str, truncated: bool, after: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """Costs from a row on, by state before it, and the byte of edits, from the costs behind the row."""
    options = []
    for q in range(4):
        here = {DELETE: 3 + after[q], REROLE: 2 + truncated + after[NEXT[q]]}
        if (kept := KEPT.get(initial, {}).get(q)) is not None:
            here[KEEP] = truncated + after[kept]
        options.append(here)
    cost = [min(o.values()) for o in options]
    for _ in range(3):  # inserts lead from state to state at the same row
        cost = [min(c, 2 + cost[NEXT[q]]) for q, c in enumerate(cost)]
    byte = 0
    for q, here in enumerate(options):
        here[INSERT] = 2 + cost[NEXT[q]]
        byte |= min(e for e, c in here.items() if c == cost[q]) << 2 * q
    return tuple(cost), byte


class Steps(dict):
    """`step` for costs less their smallest: few kinds of rows and differences of costs ever occur."""

    def __missing__(self, key):
        cost, byte = step(*key)
        least = min(cost)
        self[key] = least, tuple(c - least for c in cost), byte
        return self[key]


_STEPS = Steps()
_BLOCKS = "key string, known boolean, turn long, digest binary, edits binary, blank long, duplicate long, truncated long, illegal long, cost long"


def back_pointers(batches):
    """Rows sorted by conversation, last turn first, to blocks of bytes in the order of the turns."""
    now = None  # of the conversation that is being read
    for b in batches:
        out = []
        for key, known, turn, digest, initial, blank, truncated, again, times in b.itertuples(index=False, name=None):
            if now is None or now.key != key:
                if now is not None:
                    out.append(now.block())
                now = Reversed(key)
            elif len(now.edits) >= BLOCK:
                out.append(now.block())
            now.row(known, turn, digest, INITIALS[initial], blank, truncated, again, times)
        yield pd.DataFrame(out, columns=[c.split()[0] for c in _BLOCKS.split(", ")])
    if now is not None:
        yield pd.DataFrame([now.block()], columns=[c.split()[0] for c in _BLOCKS.split(", ")])


class Reversed:
    """The state carried from row to row while a conversation is read backwards."""

    def __init__(self, key: str):
        self.key, self.behind, self.after = key, AT_END, None  # after: the initial of the row behind
        self._clear()

    def _clear(self):
        self.edits, self.blank, self.duplicate, self.truncated, self.illegal, self.cost = bytearray(), 0, 0, 0, 0, 0

    def row(self, known, turn, digest, initial, blank, truncated, again, times):
        self.at = known, turn, digest
        self.illegal += times - 1 + (self.after is not None and initial + self.after not in ("su", "ua", "au"))
        self.after = initial
        gone = times if blank or again else times - 1
        self.cost += 3 * gone
        if blank:
            self.blank += times
        else:
            self.duplicate += gone
        if gone == times:
            self.edits.append(0)  # delete it in any state
            return
        self.truncated += truncated
        least, self.behind, byte = _STEPS[initial, bool(truncated), self.behind]
        self.cost += least
        self.edits.append(byte)

    def block(self) -> tuple:
        """What has gathered since the last block, its bytes turned round; the costs of all blocks add up to that of the first row."""
        from_here = self.behind[NOTHING]
        out = (self.key, *self.at, bytes(reversed(self.edits)), self.blank, self.duplicate, self.truncated, self.illegal, self.cost + from_here)
        self._clear()
        self.cost = -from_here
        return out


def repaired(batches):
    """Rows and blocks sorted by conversation, first turn first, to one row a conversation."""
    now = None
    for b in batches:
        out = []
        for r in b.itertuples(index=False, name=None):
            if now is None or now.key != r[0]:
                if now is not None:
                    out.append(now.end())
                now = Forward(r[0])
            now.take(*r[1:])
        yield pd.DataFrame(out, columns=[c.split()[0] for c in _REPAIRED.split(", ")])
    if now is not None:
        yield pd.DataFrame([now.end()], columns=[c.split()[0] for c in _REPAIRED.split(", ")])


_REPAIRED = "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class Forward:
    """The state carried from row to row while a conversation is repaired."""

    def __init__(self, key: str):
        self.key, self.state, self.audit, self.sha, self.lines = key, NOTHING, bytearray(), hashlib.sha256(), 0
        self.blocks, self.at, self.last, self.sums = [], 0, None, [0] * 5
        self.low = self.high = None
        self.turns = 0

    def take(self, known, turn, digest, kind, role, text, times, edits, *sums):
        if kind == 0:
            self.blocks.append(edits)
            self.sums = [a + b for a, b in zip(self.sums, sums)]
        elif kind == 1:
            if known and (self.high is None or turn != self.high):
                self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
            again = self.last == (known, turn, digest)
            if not again:
                self.last = known, turn, digest
                self._edit(role, text)
            self.audit += b"D" * (times if again else times - 1)

    def _line(self, role: str, text: str = ""):
        self.sha.update((f"\n{role}:" if self.lines else f"{role}:").encode())
        self.sha.update(text.encode())
        self.lines += 1

    def _insert(self):
        self.state = NEXT[self.state]
        self.audit += b"I"
        self._line(ROLE[self.state])

    def _edit(self, role: str, text: str):
        if self.at == len(self.blocks[0]):
            self.blocks.pop(0)
            self.at = 0
        byte = self.blocks[0][self.at]
        self.at += 1
        while (edit := byte >> 2 * self.state & 3) == INSERT:
            self._insert()
        self.audit += EDITS[edit].encode()
        if edit == KEEP:
            self.state = KEPT[role[:1]][self.state]
            self._line(role, text)
        elif edit == REROLE:
            self.state = NEXT[self.state]
            self._line(ROLE[self.state], text)

    def end(self) -> tuple:
        while self.state in (SYSTEM, USER):
            self._insert()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.key, gaps, *self.sums, self.audit.decode(), self.sha.hexdigest()


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(key, known, turn, role, text, times): times is 0 for a dropped row and 2 for a repeated one; key is empty for a null conversation."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv_col).cast("string"), blank), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), blank))
    fault = F.pmod(F.crc32(key), F.lit(20))
    role, text = F.coalesce(F.col(role_col), blank), F.coalesce(F.col(text_col), blank)
    return rows.select(
        F.coalesce(F.concat(F.lit("="), F.col(conv_col).cast("string")), F.lit("")).alias("key"),
        F.col(turn_col).isNotNull().alias("known"), F.coalesce(F.col(turn_col).cast("long"), F.lit(0)).alias("turn"),
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when((fault == 0) | (fault == 1), "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("times"),
    )


def repair(rows: DataFrame) -> DataFrame:
    """One row a key: what is wrong, the cheapest edits and the digest of the repaired conversation. `rows` as `damaged` gives them."""
    prepare(rows.sparkSession, ROWS)
    same = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    rows = rows.withColumn("digest", same)
    end = F.rtrim(F.col("text"), F.lit(WHITE))
    letter = F.substring("role", 1, 1)
    initial = F.when(letter == "s", 1).when(letter == "u", 2).when(letter == "a", 3).otherwise(0)  # a place in INITIALS
    marks = [initial.alias("initial"), (end == "").alias("blank"), (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("truncated")]
    place = ["key", "known", "turn", "digest"]
    entries = rows.filter("times > 0").select(*place, *marks, "times").groupBy(*place).agg(
        F.first("initial").alias("initial"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated"), F.sum("times").alias("times")
    )
    first = entries.groupBy("key", "digest").agg(F.min(F.struct("known", "turn")).alias("first"))
    marked = entries.join(first, ["key", "digest"]).withColumn("again", F.struct("known", "turn") > F.col("first"))
    backwards = marked.select(*place, "initial", "blank", "truncated", "again", "times").repartition("key").sortWithinPartitions(
        "key", F.desc("known"), F.desc("turn"), F.desc("digest")
    )
    blocks = stored(backwards.mapInPandas(back_pointers, _BLOCKS), "edits")
    sums = ["blank", "duplicate", "truncated", "illegal", "cost"]
    none: Column = F.lit(None)
    texts = rows.select(*place, F.when(F.col("times") > 0, 1).otherwise(2).alias("kind"), "role", "text", F.col("times").cast("long"), none.cast("binary").alias("edits"), *[F.lit(0).cast("long").alias(c) for c in sums])
    bytes_ = blocks.select(*place, F.lit(0).alias("kind"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit(0).cast("long").alias("times"), "edits", *sums)
    forwards = texts.unionByName(bytes_).repartition("key").sortWithinPartitions("key", "known", "turn", "digest", "kind")
    return forwards.mapInPandas(repaired, _REPAIRED)


def repair_damaged(conversations: DataFrame, conv_col: str = "conv_id", **columns) -> DataFrame:
    """Per original conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256, after the rows have been damaged."""
    kind = conversations.schema[conv_col].dataType
    conv = F.when(F.col("key") != "", F.expr("substring(key, 2)").cast(kind)).alias(conv_col)
    return repair(damaged(conversations, conv_col, **columns)).select(conv, *[c.split()[0] for c in _REPAIRED.split(", ")[1:]])
