"""A5: user-defined aggregates whose buffer only the aggregate understands.

:class:`BufferAggregate` has the four parts of Spark's typed ``Aggregator``:
``reduce`` (rows -> buffer), ``merge`` (buffers -> buffer), ``finish`` (buffer ->
result) and the type of the result.  A buffer is bytes, so ``merge`` can be any
function, not only sums and extremes (for those
:mod:`sluice.functions.aggregates` merges in the JVM).

* map side: every Arrow batch is reduced per key, and a task merges what it has of
  a key, holding at most ``HELD_KEYS`` buffers;
* merge: a tree over the numbers of the map tasks.  At level ``l`` the buffers of
  ``FAN_IN ** l`` neighbouring tasks meet, so a key that every task has -- one that
  holds a third of all rows, say -- is merged by many tasks, and no task merges more
  than ``FAN_IN`` buffers of a key at a time or receives more than that many
  after the first level.  The depth follows from the number of map tasks.
* the map side's buffers are a table in the shared folder: a lost executor never
  sends the merge back to the rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import scratch_dir

FAN_IN = 64
HELD_KEYS = 4096


@dataclass(frozen=True)
class BufferAggregate:
    """``reduce``: the input columns of one key's rows in a batch -> buffer;
    ``merge``: two or more buffers -> buffer, in any order and grouping;
    ``finish``: buffer -> value of ``result``."""

    name: str
    inputs: Sequence[str]
    reduce: Callable[[pd.DataFrame], bytes]
    merge: Callable[[list[bytes]], bytes]
    finish: Callable[[bytes], Any]
    result: T.DataType


def aggregate_buffers(df: DataFrame, keys: Sequence[str], agg: BufferAggregate, fan_in: int = FAN_IN,
                      held_keys: int = HELD_KEYS) -> DataFrame:
    """``df.groupBy(keys).agg(agg)``: ``keys`` and ``agg.name``.  Null keys are
    keys; no rows, no result."""
    spark, key_list = df.sparkSession, list(keys)
    key_fields = [T.StructField(f"k{i}", df.schema[k].dataType) for i, k in enumerate(key_list)]
    names = [f.name for f in key_fields]
    buffer_schema = T.StructType([*key_fields, T.StructField("part", T.LongType()),
                                  T.StructField("buffer", T.BinaryType())])
    inputs = list(agg.inputs)
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(key_list, names)], *inputs)

    def reduced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held = TaskContext.get().partitionId(), {}

        def given() -> pd.DataFrame:
            made = pd.DataFrame([(*k, part, b) for k, b in held.values()], columns=[*names, "part", "buffer"])
            held.clear()
            return made

        for batch in batches:
            for key, own in batch.groupby(names, dropna=False, sort=False) if names else [((), batch)]:
                # a null of any kind is one key
                known = tuple(None if pd.isna(x) else x for x in key)
                made = agg.reduce(own[inputs])
                before = held.get(known)
                held[known] = (known, agg.merge([before[1], made]) if before else made)
            if len(held) >= held_keys:
                yield given()
        if held:
            yield given()

    path = scratch_dir(spark, "buffers")
    rows.mapInPandas(reduced, buffer_schema).write.parquet(path)
    level = spark.read.schema(buffer_schema).parquet(path)
    tasks = (level.agg(F.max("part")).first()[0] or 0) + 1
    depth = max(1, math.ceil(math.log(tasks, fan_in))) if tasks > 1 else 1

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Buffers that are neighbours in key and part, merged as they come."""
        now, held = None, []
        for batch in batches:
            made: list[tuple] = []
            ids = list(zip(*[batch.column(n).to_pylist() for n in (*names, "part")]))
            for own, buffer in zip(ids, batch.column("buffer").to_pylist()):
                if own != now:
                    if held:
                        made.append((now, agg.merge(held) if len(held) > 1 else held[0]))
                    now, held = own, []
                held.append(buffer)
                if len(held) == fan_in:
                    held = [agg.merge(held)]
            if made:
                yield _batch(made)
        if held:
            yield _batch([(now, agg.merge(held) if len(held) > 1 else held[0])])

    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(buffer_schema)

    def _batch(made: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*[(*own, buffer) for own, buffer in made]))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    for _ in range(depth):
        up = level.withColumn("from", F.col("part")).withColumn("part", F.expr(f"part div {int(fan_in)}"))
        level = (up.repartition(*names, "part").sortWithinPartitions(*names, "part", "from")
                 .select(*names, "part", "buffer").mapInArrow(merged, buffer_schema))

    out_schema = T.StructType([*[T.StructField(k, f.dataType) for k, f in zip(key_list, key_fields)],
                               T.StructField(agg.name, agg.result)])
    arrow_out = to_arrow_schema(out_schema)

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results = [agg.finish(b) for b in batch.column("buffer").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(results, arrow_out.field(agg.name).type)], schema=arrow_out)

    return level.mapInArrow(finished, out_schema)


# --------------------------------------------------------------------------
# A quantile summary with a proven error
# --------------------------------------------------------------------------

class QuantileSummary:
    """Values in levels: one of level ``h`` stands for ``2 ** h`` values.  A level
    of more than ``size`` values is sorted and every other one moves up, which
    shifts no rank by more than ``2 ** h``; the sum of these shifts is the bound.
    It stays below about ``n / size * log2(n / size)`` ranks."""

    def __init__(self, size: int):
        self.size, self.n, self.error = size, 0, 0
        self.levels: list[np.ndarray] = []
        self.turns: list[int] = []

    def add(self, level: int, values: np.ndarray) -> None:
        while len(self.levels) <= level:
            self.levels.append(np.zeros(0))
            self.turns.append(0)
        self.levels[level] = np.concatenate([self.levels[level], values])

    def compact(self) -> "QuantileSummary":
        level = 0
        while level < len(self.levels):
            values = self.levels[level]
            if len(values) > self.size:
                values = np.sort(values)
                even = len(values) // 2 * 2
                # the two ways alternate, so that shifts tend to cancel
                self.add(level + 1, values[self.turns[level] % 2:even:2])
                self.levels[level] = values[even:]
                self.turns[level] += 1
                self.error += 1 << level
            level += 1
        return self

    def pack(self) -> bytes:
        head = np.array([self.size, self.n, self.error, len(self.levels), *self.turns,
                         *map(len, self.levels)], "<i8")
        return head.tobytes() + b"".join(v.astype("<f8").tobytes() for v in self.levels)

    @classmethod
    def unpack(cls, buffer: bytes) -> "QuantileSummary":
        size, n, error, count = np.frombuffer(buffer, "<i8", 4).tolist()
        out = cls(size)
        out.n, out.error = n, error
        turns = np.frombuffer(buffer, "<i8", count, 32).tolist()
        lengths = np.frombuffer(buffer, "<i8", count, 32 + 8 * count).tolist()
        at = 32 + 16 * count
        for length in lengths:
            out.levels.append(np.frombuffer(buffer, "<f8", length, at))
            at += 8 * length
        out.turns = turns
        return out

    @classmethod
    def of(cls, size: int, values: np.ndarray) -> "QuantileSummary":
        out = cls(size)
        out.n = len(values)
        out.add(0, values)
        return out.compact()

    def merge(self, other: "QuantileSummary") -> "QuantileSummary":
        self.n += other.n
        self.error += other.error
        for level, (values, turn) in enumerate(zip(other.levels, other.turns)):
            self.add(level, values)
            self.turns[level] += turn
        return self.compact()

    def at(self, shares: Sequence[float]) -> list[float | None]:
        """For each share the smallest value held whose rank reaches it."""
        if not self.n:
            return [None] * len(shares)
        values = np.concatenate(self.levels)
        weights = np.concatenate([np.full(len(v), 1 << h, np.int64) for h, v in enumerate(self.levels)])
        order = np.argsort(values, kind="stable")
        ranks = np.cumsum(weights[order])
        # compaction keeps weights: the ranks end at n
        spots = np.searchsorted(ranks, [max(1, math.ceil(p * self.n)) for p in shares], "left")
        return [float(values[order[min(s, len(order) - 1)]]) for s in spots]


def quantile_summary(value: str, shares: Sequence[float], size: int = 1024,
                     name: str = "quantiles") -> BufferAggregate:
    """Quantiles of the non-null, non-NaN ``value`` at ``shares``, as a struct of
    ``n``, ``error`` (no answer's rank is further than this from what was asked)
    and ``at`` (nulls if there are no values)."""

    def reduce(rows: pd.DataFrame) -> bytes:
        own = rows[value].to_numpy(dtype="float64", na_value=np.nan)
        return QuantileSummary.of(size, own[~np.isnan(own)]).pack()

    def merge(buffers: list[bytes]) -> bytes:
        out = QuantileSummary.unpack(buffers[0])
        for b in buffers[1:]:
            out = out.merge(QuantileSummary.unpack(b))
        return out.pack()

    def finish(buffer: bytes) -> dict:
        own = QuantileSummary.unpack(buffer)
        return {"n": own.n, "error": own.error, "at": own.at(shares)}

    return BufferAggregate(name, [value], reduce, merge, finish, T.StructType([
        T.StructField("n", T.LongType()), T.StructField("error", T.LongType()),
        T.StructField("at", T.ArrayType(T.DoubleType()))]))
