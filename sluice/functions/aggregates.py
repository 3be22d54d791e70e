"""A5: user-defined aggregates with map-side partials.

Spark's typed ``Aggregator`` splits an aggregate into reduce (rows -> buffer),
merge (buffer + buffer) and finish (buffer -> result).  :class:`UserAggregate`
keeps that split in PySpark: ``reduce`` runs vectorised in pandas on each
Arrow batch inside ``mapInPandas`` (map side, bounded by the batch size; one
pandas group-by per batch, not a Python call per group),
``merge`` is a built-in aggregate per buffer field (JVM, partial + final), and
``finish`` is a Column expression on the merged buffer.  A key holding a third
of all rows therefore never meets a single task as a whole.

A grouped-aggregate pandas UDF (series -> scalar) is the other PySpark form:
it can be registered for SQL, but Spark gives it no partial aggregation, so
every group is materialised in one task.  Use it only for bounded groups.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A group of a registered series aggregate is one task's array: at most this many rows.
MAX_GROUP_ROWS = 5_000_000

# Merge operations a buffer field may use.
_MERGES = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.sum}


@dataclass(frozen=True)
class UserAggregate:
    """reduce: (batch with key and input columns, key names) -> one row per
    key present in the batch, with the key columns and every buffer field;
    buffer: buffer field name -> (Spark type, merge op);
    finish: merged buffer columns (by name) -> result Column."""
    name: str
    inputs: Sequence[str]
    reduce: Callable[[pd.DataFrame, list[str]], pd.DataFrame]
    buffer: dict[str, tuple[T.DataType, str]]
    finish: Callable[[dict[str, Column]], Column]


def aggregate_by(df: DataFrame, keys: Sequence[str], agg: UserAggregate) -> DataFrame:
    """``df.groupBy(keys).agg(agg)`` with map-side partial buffers."""
    key_fields = [df.schema[k] for k in keys]
    out_schema = T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in key_fields]
        + [T.StructField(b, t, True) for b, (t, _) in agg.buffer.items()])
    names = list(agg.buffer)
    reduce = agg.reduce
    key_list = list(keys)

    def partials(batches):
        for pdf in batches:
            if not pdf.empty:
                yield reduce(pdf, key_list)[[*key_list, *names]]

    part = df.select(*keys, *agg.inputs).mapInPandas(partials, out_schema)
    merged = part.groupBy(*keys).agg(
        *[_MERGES[op](F.col(b)).alias(b) for b, (_, op) in agg.buffer.items()])
    return merged.select(*keys, agg.finish({b: F.col(b) for b in names}).alias(agg.name))


def root_sum_squares(value_col: str, name: str = "rss") -> UserAggregate:
    """sqrt(sum(x^2)) over non-null x -- the example aggregate of the tests."""
    def reduce(pdf: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
        x = pdf[value_col].astype("float64")
        present = x.notna()
        parts = pdf[keys].assign(ssq=(x * x).where(present, 0.0), n=present.astype("int64"))
        return parts.groupby(keys, dropna=False, sort=False, as_index=False).sum()

    def finish(b: dict[str, Column]) -> Column:
        return F.when(b["n"] > 0, F.sqrt(b["ssq"]))

    return UserAggregate(name, [value_col], reduce,
                         {"ssq": (T.DoubleType(), "sum"), "n": (T.LongType(), "count")},
                         finish)


def register_series_aggregate(spark: SparkSession, name: str,
                              fn: Callable[[pd.Series], float],
                              return_type: T.DataType = T.DoubleType(),
                              max_rows: int = MAX_GROUP_ROWS):
    """Register a series -> scalar pandas UDF for SQL (``SELECT name(x) ...
    GROUP BY``).  It has no partial aggregation, so a group of more than
    ``max_rows`` rows raises; call it in two steps over salted groups where a
    key may be hot (the function must then accept its own results)."""
    def series_to_scalar(values: pd.Series) -> float:
        if len(values) > max_rows:
            raise ValueError(f"{name}: a group of {len(values)} rows, at most {max_rows}")
        return fn(values)

    udf = F.pandas_udf(series_to_scalar, return_type)
    spark.udf.register(name, udf)
    return udf
