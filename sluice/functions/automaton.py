"""C2 with the token list in a table: an Aho-Corasick automaton.

A regular expression of many alternatives tries them one by one at every place
of a text; the automaton reads each character once, however many tokens there
are.  Which match counts is the same: the leftmost, of those the token listed
first, and the search goes on after it.

Tokens are dealt into blocks of about ``BLOCK_CHARS`` characters.  Each block's
automaton is sent to the executors.  One block is found and settled in one pass;
of several, each is a pass of its own, and what it finds in a text is kept beside
the text, in a table of the shared folder, until the last pass settles it.  So a
worker never holds more than one automaton, none grows with the token list, and
nothing of the texts is shuffled.  Matches are flat arrays, and of those that start
at one place only the one listed first is kept: a worker holds those of about
``TEXT_BYTES`` of text at a time.
"""

from __future__ import annotations

import io
from array import array
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.slices import text_slices
from sluice.session import drop_scratch, scratch_dir

BLOCK_CHARS = 1 << 19
TEXT_BYTES = 1 << 20
KNOWN_STEPS = 1 << 17  # steps past the trie that an automaton remembers

MATCHES = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("rank", T.LongType()),
                                    T.StructField("end", T.IntegerType())]))

_LEAF: dict[str, int] = {}  # the steps of every state that has none


class Automaton:
    """All places of ``tokens`` (rank, token) in a text, in one pass.  ``steps``:
    the trie; ``back``: the state of the longest proper suffix; ``ends``: rank and
    length of the token that a state spells; ``shorter``: the nearest suffix that
    spells one."""

    def __init__(self, tokens: list[tuple[int, str]]):
        self.steps: list[dict[str, int]] = [_LEAF]
        self.ends: list[tuple[int, int] | None] = [None]
        for rank, token in tokens:
            state = 0
            for c in token:
                after = self.steps[state].get(c)
                if after is None:
                    if self.steps[state] is _LEAF:
                        self.steps[state] = {}
                    after = self.steps[state][c] = len(self.steps)
                    self.steps.append(_LEAF)
                    self.ends.append(None)
                state = after
            if token and (self.ends[state] is None or rank < self.ends[state][0]):
                self.ends[state] = (rank, len(token))
        self.back, self.shorter = [0] * len(self.steps), [0] * len(self.steps)
        queue = deque(self.steps[0].values())
        while queue:
            state = queue.popleft()
            for c, after in self.steps[state].items():
                suffix = self.back[state]
                while suffix and c not in self.steps[suffix]:
                    suffix = self.back[suffix]
                found = self.steps[suffix].get(c, 0)
                self.back[after] = found if found != after else 0
                queue.append(after)
            suffix = self.back[state]
            self.shorter[state] = suffix if self.ends[suffix] else self.shorter[suffix]

        self.nearest = [state if own else near for state, (own, near) in enumerate(zip(self.ends, self.shorter))]
        self.room = KNOWN_STEPS

    def _past(self, state: int, c: str) -> int:
        """The state after ``c`` where the trie has no step: that of the longest
        suffix that has one.  Remembered as a step, which changes no other."""
        at, after = state, None
        while after is None and at:
            at = self.back[at]
            after = self.steps[at].get(c)
        after = after or 0
        if self.room:
            self.room -= 1
            if self.steps[state] is _LEAF:
                self.steps[state] = {}
            self.steps[state][c] = after
        return after

    def find(self, text: str) -> Iterator[tuple[int, int, int]]:
        """``start, rank, end`` of every match, overlaps included."""
        steps, ends, shorter, nearest, state = self.steps, self.ends, self.shorter, self.nearest, 0
        for at, c in enumerate(text, 1):
            after = steps[state].get(c)
            state = self._past(state, c) if after is None else after
            hit = nearest[state]
            while hit:
                rank, length = ends[hit]
                yield at - length, rank, at
                hit = shorter[hit]


Matches = tuple[np.ndarray, np.ndarray, np.ndarray]  # starts, ranks, ends


def best(starts: np.ndarray, ranks: np.ndarray, ends: np.ndarray) -> Matches:
    """By start, of the matches of each the one listed first."""
    order = np.lexsort((ranks, starts))
    starts, ranks, ends = starts[order], ranks[order], ends[order]
    first = np.ones(len(starts), bool)
    first[1:] = starts[1:] != starts[:-1]
    return starts[first], ranks[first], ends[first]


def matches(automaton: Automaton, text: str) -> Matches:
    """The :func:`best` of what the automaton finds in ``text``."""
    starts, ranks, ends = array("i"), array("q"), array("i")
    for start, rank, end in automaton.find(text):
        starts.append(start)
        ranks.append(rank)
        ends.append(end)
    return best(np.array(starts, np.int32), np.array(ranks, np.int64), np.array(ends, np.int32))


def _settled(found: Iterable[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    free = 0
    for start, rank, end in found:
        if start >= free:
            yield start, rank, end
            free = end


def settled(matches: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The matches that count, from left to right."""
    return list(_settled(sorted(matches)))  # of one start the smallest rank is first


def replaced(text: str, found: Matches, replacement: str) -> tuple[str, int]:
    """``text`` with its matches, as :func:`best` gives them, settled and replaced;
    how many there were."""
    out, at, count = io.StringIO(), 0, 0
    for start, _, end in _settled(zip(*found)):
        out.write(text[at:start])
        out.write(replacement)
        at, count = end, count + 1
    if not count:
        return text, 0
    out.write(text[at:])
    return out.getvalue(), count


def _blocks(spark: SparkSession, tokens: DataFrame, block_chars: int) -> tuple[int, Iterator[list[tuple[int, str]]]]:
    """``tokens(token, rank)`` in blocks, one at a time on the driver; how many."""
    path = scratch_dir(spark, "tokens")
    tokens.where("token IS NOT NULL AND token <> ''").groupBy("token").agg(
        F.min(F.col("rank").cast("long")).alias("rank")).write.parquet(path)
    own = spark.read.schema("token string, rank long").parquet(path)
    total = own.agg(F.sum(F.char_length("token"))).first()[0] or 0
    count = -(-total // block_chars)
    block = F.pmod(F.xxhash64("token"), F.lit(max(1, count)))
    return count, ([(r["rank"], r["token"]) for r in own.where(block == i).collect()] for i in range(count))


def replace_token_table(df: DataFrame, column: str, tokens: DataFrame, replacement: str, out: str,
                        block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``df`` with ``out``: the text of ``column`` in which every match of the
    ``tokens(token, rank)`` is the ``replacement``, and ``<out>_matches``, how many
    there were.  Of repeated tokens the smallest rank counts; null and empty tokens
    have no match; a null text stays null with 0 matches; no tokens, no change."""
    spark = df.sparkSession
    names = [out, f"{out}_matches"]
    taken = set(names) & set(df.columns)
    if taken:
        raise ValueError(f"columns are there already: {sorted(taken)}")
    at = df.columns.index(column)
    count, blocks = _blocks(spark, tokens, block_chars)
    if not count:
        return df.select("*", F.col(f"`{column}`").alias(names[0]), F.lit(0).cast("int").alias(names[1]))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    row = rows.schema["row"]
    made = T.StructType([row, T.StructField("made", T.StringType()), T.StructField("n", T.IntegerType())])
    kept, before = T.StructType([row, T.StructField("found", MATCHES)]), None
    for i, block in enumerate(blocks):
        if i == count - 1:
            done = rows.mapInArrow(_replacer(spark, block, at, replacement), made)
            return done.select("row.*", F.col("made").alias(names[0]), F.col("n").alias(names[1]))
        path = scratch_dir(spark, "matches")
        rows.mapInArrow(_finder(spark, block, at), kept).write.parquet(path)
        rows = spark.read.schema(kept).parquet(path)
        if before:
            drop_scratch(spark, before)
        before = path


def _found(spark: SparkSession, block: list[tuple[int, str]], at: int):
    """From batches of ``row`` and, after other blocks, ``found``: slices, their
    texts, and for each text that is not null its matches so far."""
    shared = spark.sparkContext.broadcast(block)  # at most about BLOCK_CHARS characters

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list, Iterator[Matches]]]:
        own = Automaton(shared.value)

        def of(texts: list, old: pa.Array | None) -> Iterator[Matches]:
            if old is not None:
                flat, ends = old.flatten(), np.cumsum(pc.list_value_length(old).to_numpy())
                fields = [f.to_numpy(zero_copy_only=False) for f in flat.flatten()]
            for i, text in enumerate(texts):
                new = matches(own, text or "")
                if old is not None:
                    part = slice(ends[i - 1] if i else 0, ends[i])
                    new = best(*[np.concatenate([f[part], n]) for f, n in zip(fields, new)])
                yield new

        for batch in batches:
            row = batch.column("row")
            whole = pa.RecordBatch.from_arrays(
                [row, pc.struct_field(row, [at]), *batch.columns[1:]], names=["row", "text", *batch.schema.names[1:]])
            for part in text_slices(iter([whole]), "text", TEXT_BYTES):
                texts = part.column("text").to_pylist()
                yield part.column("row"), texts, of(texts, part.column("found") if len(part.columns) > 2 else None)

    return find


def _finder(spark: SparkSession, block: list[tuple[int, str]], at: int):
    find = _found(spark, block, at)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, _, found in find(batches):
            starts, ranks, ends = zip(*found)
            offsets = np.cumsum([0, *map(len, starts)])
            items = pa.StructArray.from_arrays(
                [pa.array(np.concatenate(x)) for x in (starts, ranks, ends)], names=["start", "rank", "end"])
            yield pa.RecordBatch.from_arrays(
                [row, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items)], names=["row", "found"])

    return keep


def _replacer(spark: SparkSession, block: list[tuple[int, str]], at: int, replacement: str):
    find = _found(spark, block, at)

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, texts, found in find(batches):
            made = [replaced(t, [x.tolist() for x in f], replacement) if t is not None else (None, 0)
                    for t, f in zip(texts, found)]
            yield pa.RecordBatch.from_arrays(
                [row, pa.array([m for m, _ in made], pa.string()), pa.array([n for _, n in made], pa.int32())],
                names=["row", "made", "n"])

    return replace
