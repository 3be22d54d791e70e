"""Conversation structure repair by Knuth's lightest derivation.

A conversation's rows, in the order of their turns, are edited until the initials
of their roles read ``(s?(ua)+)?``: Keep costs 0, Rerole (to user or assistant) 1,
Delete 2, Insert (an empty user or assistant row) 5; a truncated row that stays
adds 5; blank and duplicate rows must go.  The cheapest edits win, of equals
those whose initials (the audit) come first in ASCII order.

The edits are deductions of a weighted hypergraph.  An item says that so many
rows are read and which role was written last; a deduction adds one edit to the
(cost, audit) of its antecedent.  Costs only grow and audits only get longer, so
these functions are superior, and they keep the order of any two derivations of
one item (equally cheap ones have as many inserts, so neither audit begins the
other).  The agenda pops items by (cost, audit); the first pop of an item is its
lightest derivation, and the search ends when the goal item is popped.

On Spark the rows are range-partitioned and sorted by conversation and turn, so
a conversation of any size lies in several tasks.  One that lies within a task is
repaired there.  Of others, pieces of at most ``SEGMENT`` rows are summed up by
the lightest derivation from every role to every other (a further hypergraph,
of two antecedents: what came before, and the piece), and one task
composes the pieces and streams the rows through the digest, which is sequential
by definition; it holds pieces' audits, never rows.

Cases: null roles and texts are one space; null turns come first; a null
conversation is one; rows that tie in turn are ordered by role, then text;
identical rows are one row with a count (``times``), of which the second and
later are duplicates; a conversation that has only rows with ``times`` 0 has an
empty repair; a text of any length is one row and must fit a task; other
columns are never read; no rows, no result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import math
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import arrow_batch, staged

DAMAGE_KINDS = 20
SEGMENT = 512           # rows of a piece
HELD_BYTES = 4 << 20    # of a conversation that a task holds; larger ones go by pieces
ROWS_A_TASK = 50_000

# fixed values: costs, and the roles by the state they lead to
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
LEADS = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
ROLE = {"u": "user", "a": "assistant"}
WANTED = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}   # that an edit can write
ENDS = (START, ASSISTANT)
LEGAL = {"su", "ua", "au"}

COUNTS = ["blank", "duplicate", "truncated", "illegal"]
FOUND = T.StructType([*[T.StructField(c, T.LongType()) for c in ["gaps", *COUNTS, "cost"]],
                      T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, times`` of ``conversations`` with rows
    dropped (``times`` 0, so that their conversation is known), emptied, cut,
    repeated (2) and given another role by a rule."""
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(c)
                     for c in ("conv_id", ":", "turn")])
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                                F.coalesce("text", F.lit(" ")).alias("text"),
                                F.pmod(F.crc32(key.cast("binary")), F.lit(DAMAGE_KINDS)).alias("kind"))
    gone = F.col("kind") == 0
    return rows.select(
        "conv_id", F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, "").when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(gone | (F.col("kind") == 1), "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(gone, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("times"))


def faulted(rows: DataFrame) -> DataFrame:
    """``rows`` with identical ones counted as one, and its ``fault`` (of the
    first of them): blank, duplicate, truncated or none."""
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    blank = F.regexp_replace("text", r"[\x20\x09-\x0D]", "") == ""
    said = rows.where(F.col("times") > 0).where(~blank).groupBy("conv_id", "role", F.md5("text").alias("said")).agg(
        F.min(order).alias("first"), F.max(order).alias("last")).where("first < last")
    own = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("times").alias("times"))
    both = own.withColumn("said", F.md5("text")).alias("r").join(
        said.alias("s"), F.col("r.conv_id").eqNullSafe(F.col("s.conv_id"))
        & (F.col("r.role") == F.col("s.role")) & (F.col("r.said") == F.col("s.said")), "left")
    return both.select("r.conv_id", "r.turn", "r.role", "r.text", "r.times", F.when(blank, "blank")
                       .when(F.col("s.first") < order, "duplicate")
                       .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated").otherwise("").alias("fault"))


def lightest(start: tuple, deductions: Callable[[tuple], Iterable[tuple]],
             goals: frozenset = frozenset()) -> dict:
    """The lightest (cost, audit) of every item derived before a goal is popped
    (of all items without ``goals``).  ``deductions(item)`` gives cost, audit and
    consequent of what follows from an item."""
    agenda, final = [(0, "", start)], {}
    while agenda:
        cost, audit, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = (cost, audit)
        if item in goals:
            break
        for more, letters, follows in deductions(item):
            if follows not in final:
                heapq.heappush(agenda, (cost + more, audit + letters, follows))
    return final


def edits(rows: list[tuple]) -> Callable[[tuple], Iterator[tuple]]:
    """The deductions over ``rows`` (initial of the role, fault, times)."""

    def deductions(item: tuple) -> Iterator[tuple]:
        at, state = item
        wanted = WANTED[state]
        yield INSERT, "I", (at, LEADS[state][wanted])
        if at == len(rows):
            return
        initial, fault, times = rows[at]
        yield DELETE * times, "D" * times, (at + 1, state)
        if fault in ("blank", "duplicate"):
            return
        stays = DELETE * (times - 1) + (TRUNCATED if fault == "truncated" else 0)
        rest = "D" * (times - 1)
        if initial in LEADS[state]:
            yield KEEP + stays, "K" + rest, (at + 1, LEADS[state][initial])
        if initial != wanted:
            yield REROLE + stays, "R" + rest, (at + 1, LEADS[state][wanted])

    return deductions


def summed(rows: list[tuple], whole: bool) -> dict:
    """Counts of the piece ``rows`` (turn, role, text, fault, times) and its
    lightest derivations: from every state to every other, or of a whole
    conversation from the start to the goal."""
    own = [(r[1][:1], r[3], r[4]) for r in rows]
    turns = [r[0] for r in rows if r[0] is not None]
    out: dict = {c: sum(r[3] == c for r in rows) for c in COUNTS[:3]}
    for _, _, _, fault, times in rows:
        out["blank" if fault == "blank" else "duplicate"] += times - 1
    out["illegal"] = sum(a[0] + b[0] not in LEGAL for a, b in zip(own, own[1:])) + \
        sum(n - 1 for _, _, n in own)  # no role may follow itself
    out |= {"rows": len(rows), "opens": own[0][0] if own else "", "closes": own[-1][0] if own else "",
            "turns": [turns[0], turns[-1], len(set(turns))] if turns else None}
    step, last = edits(own), len(own)
    if whole:
        goals = frozenset((last, q) for q in ENDS)
        out["paths"] = [[START, q, *v] for (at, q), v in lightest((0, START), step, goals).items()
                        if (at, q) in goals]
    else:
        out["paths"] = [[p, q, *v] for p in range(4) for (at, q), v in lightest((0, p), step).items() if at == last]
    return out


def composed(pieces: list[dict]) -> dict:
    """Counts, cost and audit of the conversation of ``pieces``, in order."""
    out: dict = {c: sum(p[c] for p in pieces) for c in COUNTS}
    pieces = [p for p in pieces if p["rows"]]
    out["illegal"] += sum(a["closes"] + b["opens"] not in LEGAL for a, b in zip(pieces, pieces[1:]))
    known = [p["turns"] for p in pieces if p["turns"]]
    distinct = sum(t[2] for t in known) - sum(a[1] == b[0] for a, b in zip(known, known[1:]))
    out["gaps"] = known[-1][1] - known[0][0] + 1 - distinct if known else 0

    def deductions(item: tuple) -> Iterator[tuple]:
        at, state = item
        if at < len(pieces):
            for p, q, cost, audit in pieces[at]["paths"]:
                if p == state:
                    yield cost, audit, (at + 1, q)

    goals = frozenset((len(pieces), q) for q in ENDS)
    done = lightest((0, START), deductions, goals)
    out["cost"], out["audit"] = next(done[g] for g in goals if g in done)
    return out


class Replay:
    """Carries an audit out: ``over(rows)`` gives the repaired role and text of
    each row as it comes, ``rest()`` what is inserted at the end."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _write(self, letter: str) -> str:
        self.state = LEADS[self.state][letter]
        return letter

    def rest(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield ROLE[self._write(WANTED[self.state])], ""

    def over(self, rows: Iterable[tuple]) -> Iterator[tuple[str, str]]:
        for _, role, text, _, times in rows:
            yield from self.rest()
            edit = self.audit[self.at]
            self.at += times
            if edit == "K":
                self._write(role[:1])
                yield role, text
            elif edit == "R":
                yield ROLE[self._write(WANTED[self.state])], text


class Sums:
    """SHA-256 of the repaired rows as they come."""

    def __init__(self) -> None:
        self.hash, self.n = hashlib.sha256(), 0

    def add(self, lines: Iterable[tuple[str, str]]) -> Iterator[tuple[int, str, str]]:
        for role, text in lines:
            self.hash.update(f"{chr(10) if self.n else ''}{role}:{text}".encode())
            self.n += 1
            yield self.n, role, text


class Out:
    """Output rows, given out as Arrow batches.  Kinds: 0 a piece's sums, 1 a
    piece's row, 2 a conversation's result, 3 a repaired row."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.bytes = schema, [], 0

    def add(self, kind: int, conv, seq: int, part: int = 0, **more) -> None:
        self.rows.append({"kind": kind, "conv_id": conv, "part": part, "seq": seq, **more})
        self.bytes += 64 + len(more.get("text") or "") + len(more.get("sums") or "")

    def full(self, least: int = HELD_BYTES) -> Iterator[pa.RecordBatch]:
        if self.rows and self.bytes >= least:
            yield arrow_batch(self.schema, {f.name: pa.array([r.get(f.name) for r in self.rows], f.type)
                                            for f in self.schema})
            self.rows, self.bytes = [], 0


def _finished(out: Out, conv, sums: dict, lines: Iterable[tuple], digest: Sums, keep: bool) -> None:
    for n, role, text in digest.add(lines):
        if keep:
            out.add(3, conv, n, role=role, text=text)
    out.add(2, conv, 0, found={k: sums[k] for k in ("gaps", *COUNTS, "cost", "audit")}
            | {"repaired_sha256": digest.hash.hexdigest()})


def repair(spark: SparkSession, rows: DataFrame, keep_rows: bool = True, segment: int = SEGMENT,
           held_bytes: int = HELD_BYTES, rows_a_task: int = ROWS_A_TASK) -> tuple[DataFrame, DataFrame]:
    """Of ``rows(conv_id, turn, role, text, times)``: a result per conversation
    (``conv_id`` and the columns of ``FOUND``), and the repaired rows ``conv_id,
    place, role, text`` (none unless ``keep_rows``)."""
    tasks = max(1, math.ceil(rows.count() / rows_a_task))
    rows = faulted(rows.select("conv_id", "turn", "role", "text", "times"))
    ranged = rows.repartitionByRange(tasks, "conv_id", "turn", "role", "text").sortWithinPartitions(
        "conv_id", "turn", "role", "text")
    conv_type = rows.schema["conv_id"].dataType
    schema = T.StructType([
        T.StructField("kind", T.IntegerType()), T.StructField("conv_id", conv_type),
        T.StructField("part", T.IntegerType()), T.StructField("seq", T.LongType()),
        T.StructField("sums", T.StringType()), T.StructField("turn", rows.schema["turn"].dataType),
        T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
        T.StructField("fault", T.StringType()), T.StructField("times", T.LongType()),
        T.StructField("found", FOUND)])
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)
    row_names = ["turn", "role", "text", "fault", "times"]

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole conversations of a partition repaired, others as pieces."""
        part, out = TaskContext.get().partitionId(), Out(arrow)
        held: list[tuple] = []
        conv, size, seq, first, pieced, begun = None, 0, 0, True, True, False

        def piece() -> None:
            nonlocal held, seq, size
            for at in range(0, max(1, len(held)), segment):
                some = held[at:at + segment]
                out.add(0, conv, seq, part, sums=json.dumps(summed(some, False)))
                for r in some:
                    out.add(1, conv, seq, part, **dict(zip(row_names, r)))
                    seq += 1
            held, size = [], 0

        def whole() -> None:
            sums = composed([summed(held, True)]) if len(held) <= segment else composed(
                [summed(held[at:at + segment], False) for at in range(0, len(held), segment)])
            replay, digest = Replay(sums["audit"]), Sums()

            def lines() -> Iterator[tuple[str, str]]:
                yield from replay.over(held)
                yield from replay.rest()
            _finished(out, conv, sums, lines(), digest, keep_rows)

        for batch in batches:
            for own_conv, *r in zip(batch.column("conv_id").to_pylist(),
                                    *[batch.column(c).to_pylist() for c in row_names]):
                if not begun or own_conv != conv:
                    if begun and pieced:
                        piece()
                    elif begun:
                        whole()
                    # what comes first in a partition may have begun in the one before
                    conv, held, size, seq, pieced, first = own_conv, [], 0, 0, first, False
                    begun = True
                if r[4]:
                    held.append(tuple(r))
                    size += 64 + len(r[2])
                if size >= held_bytes:
                    piece()
                    pieced = True
                yield from out.full()
        if begun:
            piece()  # and may go on in the next
        yield from out.full(0)

    done = staged(spark, ranged.mapInArrow(within, schema), "conversations")
    pieces = done.where("kind < 2")

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Conversations put together: the sums of all pieces come first, then
        the rows, which pass by."""
        out = Out(arrow)
        conv, begun, sums, replay, digest = None, False, [], None, Sums()
        total: dict = {}

        def settle() -> None:
            nonlocal total, replay
            total = composed(sums)
            replay = Replay(total["audit"])

        def end() -> None:
            if replay is None:
                settle()
            _finished(out, conv, total, replay.rest(), digest, keep_rows)

        for batch in batches:
            for kind, own_conv, text_sums, *r in zip(*[batch.column(c).to_pylist() for c in
                                                       ("kind", "conv_id", "sums", *row_names)]):
                if not begun or own_conv != conv:
                    if begun:
                        end()
                    conv, begun, sums, replay, digest = own_conv, True, [], None, Sums()
                if kind == 0:
                    sums.append(json.loads(text_sums))
                    continue
                if replay is None:
                    settle()
                for n, role, text in digest.add(replay.over([tuple(r)])):
                    if keep_rows:
                        out.add(3, conv, n, role=role, text=text)
                yield from out.full()
        if begun:
            end()
        yield from out.full(0)

    joined = staged(spark, pieces.repartition(max(1, math.ceil(tasks / 8)), "conv_id").sortWithinPartitions(
        "conv_id", "kind", "part", "seq").mapInArrow(across, schema), "conversations-joined")
    every = done.where("kind >= 2").unionByName(joined)
    return (every.where("kind = 2").select("conv_id", "found.*"),
            every.where("kind = 3").select("conv_id", F.col("seq").alias("place"), "role", "text"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.plans.tables import table

    found, _ = repair(spark, damaged(table(spark, sf_dir, "conversations")), keep_rows=False)
    return found.select("conv_id", "gaps", *COUNTS, "cost", "audit", "repaired_sha256")
