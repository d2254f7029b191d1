"""Repair of conversation structure: the cheapest edits that make the roles alternate, over streams sorted by turn."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from tempfile import SpooledTemporaryFile

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: ASCII white space; a text of nothing else is blank.
SPACE = " \t\n\x0b\x0c\r"
#: What one conversation keeps in memory of its messages, and of its backpointers, before they go to the task's own disk.
MEMORY_BYTES = 1 << 20
OUT_BYTES, OUT_ROWS = 4 << 20, 10_000

DELETE, INSERT, REROLE, CUT = 2, 5, 1, 5
NONE = 1 << 40
# What has been put out so far: nothing, a system turn, a user turn last, an assistant turn last. The next turn to insert or to
# give a new role is then user, user, assistant, user; a conversation may end in the first and the last.
NEXT = (2, 2, 3, 2)
ENDS = (0, 3)
ROLES = {2: "user", 3: "assistant"}
EDITS = "DKR"
START = ((0, NONE, NONE, NONE), (0, 1, 2, 3))


def _kept(initial: str, state: int) -> int | None:
    """The state after a row with this initial is kept, if it may be."""
    if initial == "s":
        return 1 if state == 0 else None
    return NEXT[state] if initial == {2: "u", 3: "a"}[NEXT[state]] else None


def _advanced(costs: tuple, ranks: tuple, initial: str, fault: int) -> tuple:
    """One row further: (least cost, costs above it, ranks, backpointers) by state.

    ranks order the audits of the four states. Every audit ends with the edit of the row, so none is the beginning of another,
    and the least of several continued audits is that of the least rank, then of the least continuation. A backpointer is a
    byte: state before, turns inserted (0 to 2; more come back to a state that costs less), edit.
    """
    best: list = [None] * 4
    for before, cost in enumerate(costs):
        if cost >= NONE:
            continue
        state = before
        for more in range(3):
            ways = [(DELETE, "D", state)]
            if fault not in (1, 2):
                kept, worse = _kept(initial, state), CUT if fault == 3 else 0
                ways += [(worse, "K", kept)] if kept is not None else []
                ways.append((REROLE + worse, "R", NEXT[state]))
            for price, edit, after in ways:
                key = (cost + INSERT * more + price, ranks[before], "I" * more + edit, before | more << 2 | EDITS.index(edit) << 4)
                if best[after] is None or key < best[after]:
                    best[after] = key
            state = NEXT[state]
    least = min(b[0] for b in best if b)
    order = sorted((s for s in range(4) if best[s]), key=lambda s: best[s][1:3]) + [s for s in range(4) if not best[s]]
    return (
        least,
        (tuple(b[0] - least if b else NONE for b in best), tuple(order.index(s) for s in range(4))),
        bytes(b[3] if b else 255 for b in best),
    )


def _ended(costs: tuple, ranks: tuple) -> tuple[int, int, int]:
    """(cost, state before, turns inserted) of the cheapest end."""
    found = []
    for before, cost in enumerate(costs):
        state = before
        for more in range(3):
            if cost < NONE and state in ENDS:
                found.append((cost + INSERT * more, ranks[before], more, before))
            state = NEXT[state]
    cost, _, more, before = min(found)
    return cost, before, more


class _Talk:
    """One conversation while its rows stream by: the costs so far, and its messages and backpointers, on disk if they are many.
    known: steps made before, by state and kind of row; costs are relative, so there are few."""

    def __init__(self, key, known: dict):
        self.key, self.known = key, known
        self.state, self.cost, self.rows = START, 0, 0
        self.counts, self.illegal, self.last = [0, 0, 0, 0], 0, None
        self.first_turn, self.last_turn, self.turns = None, None, 0
        self.messages = SpooledTemporaryFile(MEMORY_BYTES)
        self.back = SpooledTemporaryFile(MEMORY_BYTES)

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        self.counts[fault] += 1
        self.illegal += self.last is not None and self.last + initial not in ("su", "ua", "au")
        self.last = initial
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        step = (self.state, initial if initial in ("s", "u", "a") else "", fault)
        if step not in self.known:
            self.known[step] = _advanced(*self.state, *step[1:])
        least, self.state, pointers = self.known[step]
        self.cost, self.rows = self.cost + least, self.rows + 1
        self.back.write(pointers)
        said, named = text.encode(), role.encode()
        self.messages.write(struct.pack("<II", len(named), len(said)) + named + said)

    def edits(self) -> Iterator[tuple]:
        """First (0, None, None, None, counts...), then each edit in order: (step, edit, role, text)."""
        cost, state, more = _ended(*self.state)
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        yield (0, None, None, None, gaps, *self.counts[1:], int(self.illegal), self.cost + cost)
        chosen = SpooledTemporaryFile(MEMORY_BYTES)  # from the last row to the first
        at = self.rows
        while at:
            begin = max(0, at - MEMORY_BYTES // 4)
            self.back.seek(begin * 4)
            block = self.back.read((at - begin) * 4)
            codes = bytearray()
            for k in range(at - begin - 1, -1, -1):
                code = block[4 * k + state]
                codes.append(code)
                state = code & 3
            chosen.write(codes)
            at = begin
        self.messages.seek(0)
        step, state, left = 0, 0, self.rows
        while left:
            begin = max(0, left - MEMORY_BYTES)
            chosen.seek(begin)
            for code in reversed(chosen.read(left - begin)):
                for _ in range(code >> 2 & 3):
                    state, step = NEXT[state], step + 1
                    yield (step, "I", ROLES[state], "")
                named, said = struct.unpack("<II", self.messages.read(8))
                role, text = self.messages.read(named).decode(), self.messages.read(said).decode()
                edit, step = EDITS[code >> 4], step + 1
                if edit == "K":
                    state = _kept(role[:1], state)
                elif edit == "R":
                    state = NEXT[state]
                    role = ROLES[state]
                yield (step, edit, role, text)
            left = begin
        for _ in range(more):
            state, step = NEXT[state], step + 1
            yield (step, "I", ROLES[state], "")

    def close(self) -> None:
        self.messages.close()
        self.back.close()


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def repaired(
    rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", names_only: Column | None = None
) -> DataFrame:
    """(key, step, edit, role, text, gaps, blank, duplicate, truncated, illegal, cost): the edits of each conversation in order.

    Step 0 of each conversation has its counts and cost; the steps after it have an edit, K(eep), D(elete), R(erole) or I(nsert),
    with the role and text of the repaired turn (of the removed one for D). The edits are the cheapest that leave an empty
    conversation, or an optional system turn and then pairs of user and assistant turns; of several, those whose initials are
    least. Keep costs 0, a new role 1, a deletion 2 and is required for blank and repeated rows, an empty inserted turn 5, and a
    row whose text is cut off and that stays 5 more. gaps: turns missing between the least and the greatest; illegal: adjacent
    rows that are not system-user, user-assistant or assistant-user.

    Rows are dealt by conversation and sorted by turn, nulls first, then by role and the MD5 of the text; repeated rows stay side by side. Each
    task reads its stream once: the costs of four states pass from row to row over Arrow batches, while four bytes of
    backpointers and the message of each row go to a file beyond 1 MB, so a giant conversation takes disk and not memory. Whether
    a row repeats an earlier one is numbered by Spark on the same partitions. Output is in order inside each task.

    A null role or text is one space; null keys are one conversation; rows of names_only stand for no message, but their
    conversation is listed. Without rows the result is empty. Other columns are not read.
    """
    own = [F.col(key).cast("string").alias("key"), F.col(turn).cast("long").alias("turn")]
    own += [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))]
    named = F.coalesce(names_only, F.lit(False)) if names_only is not None else F.lit(False)
    kind = rows.schema[key].dataType
    dealt = rows.select(*own, named.alias("named")).repartition("key")
    same = Window.partitionBy("key", "named", "role", "digest").orderBy(F.asc_nulls_first("turn"))
    told = dealt.withColumn("digest", F.md5("text")).withColumn("nth", F.row_number().over(same))
    said = F.rtrim("text", F.lit(SPACE))
    fault = F.when(said == "", 1).when(F.col("nth") > 1, 2).when(~F.substring(said, -1, 1).isin(".", "!", "?"), 3).otherwise(0)
    ordered = told.withColumn("fault", fault).sortWithinPartitions(
        F.asc_nulls_first("key"), F.asc_nulls_first("turn"), "role", "digest", "nth"
    )
    columns = ["key", "named", "turn", "role", "text", "fault"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, talk, out, size = {}, None, [], 0

        def frame() -> pd.DataFrame:
            made = pd.DataFrame(out, columns=["key", "step", "edit", "role", "text", *_COUNTS])
            return made.astype({c: "Int64" for c in ["step", *_COUNTS]})

        def flushed() -> Iterator[pd.DataFrame]:
            nonlocal out, size
            for edit in talk.edits():
                out.append((talk.key, *edit, *[None] * (10 - len(edit))))
                size += len(edit[3] or "")
                if size > OUT_BYTES or len(out) >= OUT_ROWS:
                    yield frame()
                    out, size = [], 0
            talk.close()

        for batch in batches:
            turns = [None if t is pd.NA else t for t in batch["turn"].astype("Int64")]
            for k, name, t, r, x, f in zip(batch["key"], batch["named"], turns, batch["role"], batch["text"], batch["fault"], strict=True):
                if talk is None or k != talk.key:
                    if talk is not None:
                        yield from flushed()
                    talk = _Talk(k, known)
                if not name:
                    talk.add(t, r, x, f)
        if talk is not None:
            yield from flushed()
        if out:
            yield frame()

    schema = "key string, step long, edit string, role string, text string, " + ", ".join(f"{c} long" for c in _COUNTS)
    edits = ordered.select(*columns).mapInPandas(run, schema)
    return edits.withColumn("key", F.col("key").cast(kind))


def digests(edits: DataFrame) -> DataFrame:
    """(key, counts..., cost, audit, repaired_sha256) of each conversation, from the rows of `repaired` as they come: audit joins
    the edits, the digest is of the repaired turns as role:text, joined by line feeds. There is no shuffle."""
    kind = edits.schema["key"].dataType

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["key", *_COUNTS, "audit", "repaired_sha256"]
        head, audit, digest, empty = None, bytearray(), None, True

        def row() -> tuple:
            return (*head, audit.decode(), digest.hexdigest())

        for batch in batches:
            out = []
            for values in batch.itertuples(index=False):
                if values.step == 0:
                    if head is not None:
                        out.append(row())
                    head = (values.key, *[int(getattr(values, c)) for c in _COUNTS])
                    audit, digest, empty = bytearray(), hashlib.sha256(), True
                    continue
                audit += values.edit.encode()
                if values.edit != "D":
                    digest.update(f"{'' if empty else chr(10)}{values.role}:{values.text}".encode())
                    empty = False
            if out:
                yield pd.DataFrame(out, columns=columns)
        if head is not None:
            yield pd.DataFrame([row()], columns=columns)

    schema = "key string, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired_sha256 string"
    made = edits.withColumn("key", F.col("key").cast("string")).mapInPandas(run, schema)
    return made.withColumn("key", F.col("key").cast(kind))


def damaged(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(key, turn, role, text, dropped): rows with planted faults, by the CRC-32 of `key:turn` modulo 20: 0 drops the row, 1 empties
    its text, 2 removes its . ! ?, 3 repeats it, 4 makes it a user's. Nulls are one space, but for a null turn. A dropped row
    stays as one that only names its conversation."""
    either = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (key, turn, role, text)]
    fate = F.crc32(F.concat(either[0], F.lit(":"), either[1]).cast("binary")) % 20
    said = F.when(fate == 1, "").when(fate == 2, F.translate(either[3], ".!?", "")).otherwise(either[3])
    twice = F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select(
        F.col(key), F.col(turn), F.when(fate == 4, "user").otherwise(either[2]).alias(role), said.alias(text), (fate == 0).alias("dropped"), twice.alias("copy")
    ).drop("copy")
