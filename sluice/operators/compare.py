"""Comparison of two datasets as multisets of rows.

Order, files and partitions do not matter, repeated rows count.  A tree of hash
sums finds where the two differ, and only rows there are moved:

1. every row is hashed into one of ``FAN`` buckets; both sides give a count and
   sums of two hashes per bucket (combined map-side: ``FAN`` rows a task);
2. rows of buckets whose sums differ are hashed on into ``FAN`` buckets each, with
   sums again, unless most buckets differ and there is little left to rule out;
3. rows of the buckets that still differ are compared whole.

Equal datasets thus shuffle sums only, and what is shuffled of others grows with
their differences and not with their size.  Two differing buckets agree in count
and both sums with a chance of about 2^-128.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FAN = 4096


def _plain(df: DataFrame, name: str) -> Column:
    """A column as hashing and grouping take it: a map as its sorted entries, an
    equal float as the same bits."""
    kind = df.schema[name].dataType
    col = F.col(f"`{name}`")
    if isinstance(kind, T.MapType):
        return F.sort_array(F.map_entries(col)).alias(name)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (col + F.lit(0.0).cast(kind)).alias(name)  # -0.0 is 0.0
    return col


def _hashed(df: DataFrame, names: Sequence[str], side: int) -> DataFrame:
    rows = df.select(F.lit(side).alias("_side"), F.struct(*[_plain(df, n) for n in names]).alias("_row"))
    a, b = F.xxhash64(F.lit(1), "_row"), F.xxhash64(F.lit(2), "_row")
    return rows.select("_side", "_row", a.alias("_a"), b.alias("_b"),
                       F.pmod(a, F.lit(FAN)).cast("int").alias("_x"),
                       F.pmod(b, F.lit(FAN)).cast("int").alias("_y"))


def _differing(rows: DataFrame, by: list[str]) -> DataFrame:
    """Buckets whose counts or sums differ between the sides.  Sums of 32-bit
    halves stay exact for 2^31 rows a bucket."""
    sign = F.when(F.col("_side") == 0, F.lit(1).cast("long")).otherwise(F.lit(-1).cast("long"))
    halves = [F.sum(sign * part).alias(f"_{h}{i}") for h in ("a", "b")
              for i, part in enumerate((F.col(f"_{h}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftright(f"_{h}", 32)))]
    sums = rows.groupBy(*by).agg(F.sum(sign).alias("_n"), *halves)
    return sums.where("_n <> 0 OR _a0 <> 0 OR _a1 <> 0 OR _b0 <> 0 OR _b1 <> 0").select(*by)


def opened_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows of both sides (``_side`` 0 and 1, ``_row``) that lie in buckets
    which differ; all others are equal."""
    names = left.columns
    if sorted(names) != sorted(right.columns):
        raise ValueError(f"columns differ: {sorted(set(names) ^ set(right.columns))}")
    types = {n: left.schema[n].dataType for n in names}
    right = right.select(*[F.col(f"`{n}`").cast(types[n]).alias(n) for n in names])
    rows = _hashed(left, names, 0).unionByName(_hashed(right, names, 1))
    # at most FAN numbers
    first = [r["_x"] for r in _differing(rows, ["_x"]).collect()]
    if not first:
        return rows.limit(0).select("_side", "_row")
    rows = rows.where(F.col("_x").isin(first)) if len(first) < FAN else rows
    if len(first) <= FAN // 2:
        # how the small side is sent is left to its measured size
        rows = rows.join(_differing(rows, ["_x", "_y"]), ["_x", "_y"], "left_semi")
    return rows.select("_side", "_row")


def difference(left: DataFrame, right: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``status, times, before, after``: rows that ``left`` has more often
    (``missing``, in ``before``) or ``right`` has (``surplus``, in ``after``), and how
    much more often.  With ``keys``, one distinct row missing and one surplus under
    one key, equally often, are one ``changed`` row.  Nulls equal nulls."""
    names = left.columns
    counted = (opened_rows(left, right).groupBy("_row")
               .agg(F.sum(F.when(F.col("_side") == 0, 1).otherwise(-1)).alias("_n")).where("_n <> 0"))
    empty = F.lit(None).cast(counted.schema["_row"].dataType)
    lone = counted.select(
        F.when(F.col("_n") > 0, "missing").otherwise("surplus").alias("status"),
        F.abs("_n").alias("times"), F.when(F.col("_n") > 0, F.col("_row")).otherwise(empty).alias("before"),
        F.when(F.col("_n") < 0, F.col("_row")).otherwise(empty).alias("after"))
    if not keys:
        return lone
    unknown = set(keys) - set(names)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    # a key's numbers only, so that a key with many rows is not gathered
    by_key = [F.coalesce("before", "after").getField(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    named = [f"_k{i}" for i in range(len(keys))]
    lone = lone.select(*by_key, "*")
    per = lone.groupBy(*named).agg(
        F.sum(F.when(F.col("status") == "missing", 1).otherwise(0)).alias("_m"),
        F.sum(F.when(F.col("status") == "surplus", 1).otherwise(0)).alias("_s"),
        F.min("times").alias("_low"), F.max("times").alias("_high"))
    pairs = per.where("_m = 1 AND _s = 1 AND _low = _high").select(
        *[F.col(n).alias(f"_p{n}") for n in named], F.lit(True).alias("_pair"))
    same = None
    for n in named:
        one = F.col(n).eqNullSafe(F.col(f"_p{n}"))
        same = one if same is None else same & one
    marked = lone.join(pairs, same, "left")
    changed = (marked.where("_pair").groupBy(*named)
               .agg(F.max("times").alias("times"),
                    F.first("before", ignorenulls=True).alias("before"),
                    F.first("after", ignorenulls=True).alias("after"))
               .select(F.lit("changed").alias("status"), "times", "before", "after"))
    return marked.where("_pair IS NULL").select("status", "times", "before", "after").unionByName(changed)


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """Whether both hold the same rows equally often; moves nothing but sums
    unless they do not."""
    return difference(left, right).isEmpty()
