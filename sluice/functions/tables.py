"""U4: table functions -- one row in, any number of rows out.

* :class:`Pieces` is called per row in a lateral join.  Its ``analyze`` settles
  the result's columns from the constant arguments, so the plan knows them.  Rows
  travel pickled: with ``useArrow`` Spark makes a frame of every call's result.
* :class:`Sessions` takes a whole table, ``PARTITION BY`` a key and ``ORDER BY`` a
  time.  Spark streams each partition through one instance in Arrow batches; what
  is kept between them is one open session.

A partition is one task's work, as in any ``PARTITION BY``, and costs a call and a
table of its own.  Where there are many small keys, partition by a hash of the key
and order by (key, time).  Where a key may hold a large share of the rows, partition
by a stretch of time as well and put the pieces together with
:func:`joined_sessions`, which moves one row per piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult


@F.udtf(useArrow=False)
class Pieces:
    """``pieces(text, separator [, with_length])``: ``at int, piece string`` and,
    if asked for, ``letters int``.  A null text gives no row; an empty text or one
    without the separator is one piece."""

    @staticmethod
    def analyze(text: AnalyzeArgument, separator: AnalyzeArgument,
                with_length: AnalyzeArgument | None = None) -> AnalyzeResult:
        if not isinstance(text.dataType, (T.StringType, T.NullType)):
            raise ValueError("the first argument is a text")
        if not separator.isConstantExpression or not separator.value:
            raise ValueError("the separator is a constant text that is not empty")
        fields = [T.StructField("at", T.IntegerType()), T.StructField("piece", T.StringType())]
        if with_length is not None:
            if not with_length.isConstantExpression:
                raise ValueError("with_length is a constant")
            if with_length.value:
                fields.append(T.StructField("letters", T.IntegerType()))
        return AnalyzeResult(T.StructType(fields))

    def eval(self, text: str | None, separator: str, with_length: bool = False) -> Iterator[tuple]:
        if text is not None:
            for at, piece in enumerate(text.split(separator)):
                yield (at, piece, len(piece)) if with_length else (at, piece)


SESSION = ("key long, begun timestamp_ntz, ended timestamp_ntz, n long, amount long")


@F.arrow_udtf(returnType=SESSION)
class Sessions:
    """``sessions(TABLE(rows) PARTITION BY key ORDER BY time, gap_seconds)``
    of rows ``key long, time timestamp_ntz, amount long``: runs of rows of one key
    no more than the gap apart; a partition of several keys is ordered by key and
    time.  Rows without a time are in no session; a null amount adds nothing."""

    def __init__(self) -> None:
        self.open: tuple | None = None  # key, begun, ended, n, amount

    def eval(self, rows: pa.RecordBatch, gap_seconds: pa.Array) -> Iterator[pa.Table]:
        rows = rows.filter(pc.is_valid(rows.column("time")))
        if not rows.num_rows:
            return
        gap = gap_seconds[0].as_py() * 1_000_000
        keyed = pc.is_valid(rows.column("key")).to_numpy(zero_copy_only=False)
        key = pc.fill_null(rows.column("key"), 0).to_numpy(zero_copy_only=False)
        time = rows.column("time").cast(pa.timestamp("us")).cast(pa.int64()).to_numpy(zero_copy_only=False)
        amount = pc.fill_null(rows.column("amount"), 0).to_numpy(zero_copy_only=False)
        apart = (np.diff(time) > gap) | (key[1:] != key[:-1]) | (keyed[1:] != keyed[:-1])
        starts = np.concatenate([[0], np.flatnonzero(apart) + 1])
        ends = np.concatenate([starts[1:], [len(time)]])
        begun, n, total = time[starts], ends - starts, np.add.reduceat(amount, starts)
        own, owned, ended = key[starts], keyed[starts], time[ends - 1]
        if self.open:
            first = int(own[0]) if owned[0] else None
            if first == self.open[0] and begun[0] - self.open[2] <= gap:
                begun[0] = self.open[1]
                n[0] += self.open[3]
                total[0] += self.open[4]
            else:
                yield from self.terminate()
        self.open = (int(own[-1]) if owned[-1] else None, int(begun[-1]), int(ended[-1]), int(n[-1]), int(total[-1]))
        if len(own) > 1:
            yield self._table(*[x[:-1] for x in (own, begun, ended, n, total)], mask=~owned[:-1])

    def terminate(self) -> Iterator[pa.Table]:
        if self.open:
            yield self._table(*[[x] for x in self.open])

    def _table(self, key, begun, ended, n, amount, mask: np.ndarray | None = None) -> pa.Table:
        return pa.table({"key": pa.array(key, pa.int64(), mask=mask),
                         "begun": pa.array(begun, pa.int64()).cast(pa.timestamp("us")),
                         "ended": pa.array(ended, pa.int64()).cast(pa.timestamp("us")),
                         "n": pa.array(n, pa.int64()), "amount": pa.array(amount, pa.int64())})


def register_table_functions(spark: SparkSession) -> None:
    spark.udtf.register("sluice_pieces", Pieces)
    spark.udtf.register("sluice_sessions", Sessions)


def joined_sessions(pieces: DataFrame, gap_seconds: int) -> DataFrame:
    """Sessions of :class:`Sessions` over stretches of time, put together where
    no more than the gap lies between them; ``pieces`` of one key do not overlap."""
    by_key = Window.partitionBy("key").orderBy("begun", "ended")
    apart = F.expr(f"begun > last + make_dt_interval(0, 0, 0, {int(gap_seconds)})")
    marked = pieces.withColumn("last", F.lag("ended").over(by_key)).withColumn(
        "first", F.when(F.col("last").isNull() | apart, 1).otherwise(0))
    numbered = marked.withColumn("session", F.sum("first").over(by_key))
    return numbered.groupBy("key", "session").agg(
        F.min("begun").alias("begun"), F.max("ended").alias("ended"), F.sum("n").alias("n"),
        F.sum("amount").alias("amount")).drop("session")
