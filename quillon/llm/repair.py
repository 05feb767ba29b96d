"""Operator 12: repair of conversation structure by a retained-subsequence DP.

A repaired conversation keeps or reroles a subsequence of its turns, deletes the
others and inserts empty turns so that the role initials read ``(s?(ua)+)?``.  With
the prefix sums D of deletion costs, the cost of retaining turn j after turn i is
D[j] - D[i + 1], plus the insertions that the pair of roles asks for, plus turn j's
own cost.  So per role state a running minimum of D[j] + cost is all that turn i
needs, and the whole is linear.  The minima run from the end; the audit is then
read from the start, at each place the least letter that a cheapest repair can
go on with (D before I before K before R), so ties need no strings compared.

Spark sorts the turns of each conversation twice: first as hashes and one code a
turn, from which the DP makes the audit, then with their texts, which stream
through one hash per conversation after its audit.  A task holds one byte a turn
and four a turn of decisions, never a conversation's texts.

Cases: null role, text and parts of the key are one space (such a text is blank);
null turns come first; rows of one turn are ordered by role and then by the hash of
the text, so repeated rows lie side by side and all but the first are duplicates; a
null conv_id is a conversation of its own; conversations that lose all rows remain
with zeros; empty roles have no initial; very long texts are hashed as they stream;
gaps above the range of a long are that range's end; an empty table gives no rows;
further columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .clusterio import checkpointed, read

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
KINDS = 20
START, SYSTEM, USER, ASSISTANT = range(4)
#: Turns to insert between a state and a retained role: (state, role) -> how many, with the roles that follow.
BETWEEN = {
    (START, SYSTEM): "", (START, USER): "", (START, ASSISTANT): "u", (SYSTEM, USER): "", (SYSTEM, ASSISTANT): "u",
    (USER, USER): "a", (USER, ASSISTANT): "", (ASSISTANT, USER): "", (ASSISTANT, ASSISTANT): "u",
}
#: Turns to insert after the last retained one.
AFTER = {START: "", SYSTEM: "ua", USER: "a", ASSISTANT: ""}
ROLES = {"u": "user", "a": "assistant"}
#: Codes of a turn: initial (s, u, a, other) + 4 * (0 sound, 1 truncated, 2 to be deleted).
#: Turns of codes whose repair is kept for the next conversation of the same codes.
KEPT_CODES = 64


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, lost): rows after damage; a lost row stays as a mark of its conversation."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % KINDS
    role, text = spaced("role"), spaced("text")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") == 0).alias("lost"), F.explode(copies).alias("copy")).drop("copy")


def local_fault(text: Column) -> Column:
    """2 blank, 1 truncated, 0 neither, from the text alone."""
    return F.when(~text.rlike(r"[^\x20\x09-\x0D]"), 2).when(~text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), 1).otherwise(0)


def repair(codes: bytes) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair; codes: one byte a turn."""
    return _repair(codes) if len(codes) > KEPT_CODES else _kept(codes)


def _repair(codes: bytes) -> tuple[int, str]:
    n = len(codes)
    # every deletion costs the same, so D[j] is DELETE * j; minima of D[j] + what follows, by state
    best = [DELETE * n + INSERT * len(AFTER[s]) for s in range(4)]
    # per place and state what a cheapest repair does there: least letter first
    steps, after = bytearray(4 * (n + 1)), best
    for i in range(n, -1, -1):
        if i < n:
            initial, fault = codes[i] & 3, codes[i] >> 2
            if fault < 2:
                follow = [b - DELETE * (i + 1) for b in best]  # from the place after turn i
                own = TRUNCATED * fault
                retained = {}
                for role in (SYSTEM, USER, ASSISTANT):
                    if role == initial + 1:
                        retained[role] = own + follow[role]
                    elif role != SYSTEM:
                        retained[role] = own + REROLE + follow[role]
                for (state, role), between in BETWEEN.items():
                    if role in retained:
                        best[state] = min(best[state], DELETE * i + INSERT * len(between) + retained[role])
        here = [b - DELETE * i for b in best]
        for s in range(4):
            steps[4 * i + s] = _least_step(s, codes[i], here, after) if i < n else ord("I" if AFTER[s] else ".")
        after = here
    return here[START], _read(codes, steps, n)


def _next(state: int) -> int:
    """State after an inserted or reroled turn: a user's, or an assistant's after a user."""
    return ASSISTANT if state == USER else USER


def _least_step(state: int, code: int, here: list[int], after: list[int]) -> int:
    """The least letter of a cheapest repair; here, after: costs by state before and behind the turn."""
    want, initial, fault = here[state], code & 3, code >> 2
    if DELETE + after[state] == want:
        return ord("D")
    if INSERT + here[_next(state)] == want:
        return ord("I")
    if fault < 2 and BETWEEN.get((state, initial + 1)) == "" and TRUNCATED * fault + after[initial + 1] == want:
        return ord("K")
    return ord("R")


def _read(codes: bytes, steps: bytearray, n: int) -> str:
    audit, i, state = bytearray(), 0, START
    while True:
        step = steps[4 * i + state]
        if step == ord("."):
            return audit.decode()
        audit.append(step)
        if step == ord("K"):
            state = (codes[i] & 3) + 1
        elif step != ord("D"):
            state = _next(state)
        i += step != ord("I")


_kept = lru_cache(maxsize=1 << 16)(_repair)

_FACTS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_FACT_NAMES = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
_LEGAL = {(0, 1), (1, 2), (2, 1)}
_MOST = (1 << 63) - 1


def _runs(key: pa.Array) -> np.ndarray:
    """First rows of runs of equal keys, null equal to null, and the end."""
    v, null = key.fill_null(0).to_numpy(zero_copy_only=False), key.is_null().to_numpy(zero_copy_only=False)
    return np.append(np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]) | (null[1:] != null[:-1])])), len(v))


class _Turns:
    """What is known of a conversation whose rows come in order."""

    def __init__(self, conv_id):
        self.conv_id, self.codes, self.seen = conv_id, bytearray(), [0, 0, 0]
        self.least, self.most, self.kinds = None, None, 0

    def add(self, lost, turn, initial, fault) -> None:
        for gone, t, x, f in zip(lost, turn, initial, fault, strict=True):
            if gone:
                continue
            if t is not None and t != self.most:
                self.least, self.most, self.kinds = (t if self.least is None else self.least), t, self.kinds + 1
            if f:
                self.seen[f - 1] += 1
            self.codes.append(x + 4 * (1 if f == 1 else 2 if f else 0))

    def row(self) -> tuple:
        codes = bytes(self.codes)
        initials = [c & 3 for c in codes]
        illegal = sum(p not in _LEGAL for p in zip(initials, initials[1:], strict=False))
        gaps = 0 if self.least is None else min(_MOST, self.most - self.least + 1 - self.kinds)
        truncated, blank, duplicate = self.seen
        return self.conv_id, gaps, blank, duplicate, truncated, illegal, *repair(codes)


def _facts(batches):
    """Facts and audits of conversations whose rows come sorted."""
    now = None
    for batch in batches:
        done = []
        if batch.num_rows:
            edges = _runs(batch["conv_id"])
            columns = [batch[c] for c in ("lost", "turn", "initial", "fault")]
            for a, b in zip(edges, edges[1:], strict=False):
                conv = batch["conv_id"][int(a)].as_py()
                if now is None or now.conv_id != conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Turns(conv)
                now.add(*[c.slice(a, b - a).to_pylist() for c in columns])
        yield _batch(done, _FACT_NAMES, _FACTS)
    if now is not None:
        yield _batch([now.row()], _FACT_NAMES, _FACTS)


def _batch(rows: list[tuple], names, schema: str) -> pa.RecordBatch:
    kinds = [pa.string() if f.split()[-1] == "string" else pa.int64() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=list(names))


def repairs(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``damaged`` rows: its faults, cost and audit.

    Of equal rows the first in order is no duplicate: they are numbered by (role,
    text hash) on the partitioning that the ordered rows need anyway.
    """
    initial = F.coalesce(F.nullif(F.instr(F.lit("sua"), F.substring("role", 1, 1)), F.lit(0)) - 1, F.lit(3))
    initial = F.when(F.col("role") == "", 3).otherwise(initial)
    facts = rows.select("conv_id", "turn", "role", F.xxhash64(F.lit(1), "text").alias("t1"), F.xxhash64(F.lit(2), "text").alias("t2"), "lost", initial.cast("int").alias("initial"), local_fault(F.col("text")).alias("fault")).repartition("conv_id")
    again = F.row_number().over(Window.partitionBy("conv_id", "lost", "role", "t1", "t2").orderBy(F.col("turn").asc_nulls_first())) > 1
    # 3 duplicate; a blank row stays blank
    faulty = facts.withColumn("fault", F.when(again & (F.col("fault") != 2), 3).otherwise(F.col("fault")).cast("int"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "t1", "t2", "fault"]
    return faulty.sortWithinPartitions(*order).select("conv_id", "lost", "turn", "initial", "fault").mapInArrow(_facts, _FACTS)


_OUT = _FACTS + ", repaired_sha256 string"
_OUT_NAMES = (*_FACT_NAMES, "repaired_sha256")


class _Repaired:
    """Hash of a conversation's repaired turns, which come one by one."""

    def __init__(self, facts: tuple):
        self.facts, self.audit, self.at, self.state, self.hash, self.begun = facts, facts[-1], 0, START, hashlib.sha256(), False

    def _put(self, role: bytes, text: bytes) -> None:
        self.hash.update((b"\n" if self.begun else b"") + role + b":")
        self.hash.update(text)
        self.begun = True

    def _inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.state = _next(self.state)
            self._put(b"user" if self.state == USER else b"assistant", b"")
            self.at += 1

    def add(self, role: str, text: bytes) -> None:
        self._inserted()
        step = self.audit[self.at]
        self.at += 1
        if step == "K":
            self.state = "sua".index(role[0]) + 1
            self._put(role.encode(), text)
        elif step == "R":
            self.state = _next(self.state)
            self._put(b"user" if self.state == USER else b"assistant", text)

    def row(self) -> tuple:
        self._inserted()
        return *self.facts, self.hash.hexdigest()


def _hashed(batches):
    """Repaired hashes from each conversation's facts and then its rows in order."""
    now = None
    for batch in batches:
        done, columns = [], {c: batch[c].to_pylist() for c in batch.schema.names if c != "text"}
        for k, facts in enumerate(columns["audit"]):
            if facts is not None:
                if now is not None:
                    done.append(now.row())
                now = _Repaired(tuple(columns[c][k] for c in _FACT_NAMES))
            else:
                now.add(columns["role"][k], batch["text"][k].as_buffer())
        yield _batch(done, _OUT_NAMES, _OUT)
    if now is not None:
        yield _batch([now.row()], _OUT_NAMES, _OUT)


def repaired(rows: DataFrame) -> DataFrame:
    """``repairs`` plus repaired_sha256."""
    facts = repairs(rows).withColumn("tag", F.lit(0))
    texts = rows.filter("not lost").select("conv_id", "turn", "role", F.xxhash64(F.lit(1), "text").alias("t1"), F.xxhash64(F.lit(2), "text").alias("t2"), F.col("text").cast("binary").alias("text"), F.lit(1).alias("tag"))
    both = facts.unionByName(texts, allowMissingColumns=True).repartition("conv_id")
    order = [F.col("conv_id").asc_nulls_first(), "tag", F.col("turn").asc_nulls_first(), "role", "t1", "t2"]
    return both.sortWithinPartitions(*order).select(*_FACT_NAMES, "role", "text").mapInArrow(_hashed, _OUT)


def _places(audit: str) -> list[tuple[int, int | None, str | None]]:
    """(place, turn from 1, given role) of each turn an audit leaves; an odd number begins with a kept system turn."""
    left = [x for x in audit if x != "D"]
    out, pos, roles = [], 0, ["user", "assistant"]
    for step in audit:
        pos += step != "I"
        if step == "D":
            continue
        place = len(out)
        out.append((place, None if step == "I" else pos, None if step == "K" else roles[(place - len(left)) % 2]))
    return out


def repaired_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, place, role, text): the repaired conversations, from the ``damaged`` rows.

    An audit is dealt out as one row per retained or inserted turn; deleted turns
    have none.
    """
    audits = checkpointed(repairs(rows)).select("conv_id", "audit")

    def walk(batches):
        for batch in batches:
            out = []
            for conv, audit in zip(batch["conv_id"].to_pylist(), batch["audit"].to_pylist(), strict=True):
                out += [(conv, *x) for x in _places(audit)]
            yield _batch(out, ("conv_id", "place", "pos", "role"), "conv_id long, place long, pos long, given string")

    places = audits.mapInArrow(walk, "conv_id long, place long, pos long, given string")
    in_order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", F.xxhash64(F.lit(1), "text"), F.xxhash64(F.lit(2), "text"))
    turns = rows.filter("not lost").withColumn("pos", F.row_number().over(in_order).cast("long"))
    same = places["conv_id"].eqNullSafe(turns["conv_id"]) & (places["pos"] == turns["pos"])
    out = places.join(turns, same, "left").select(places["conv_id"], "place", F.coalesce("given", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return out


def op12_conversation_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(damaged(read(spark, sf_dir, "conversations")))
