"""A2, mergeable: distinct counts kept as sketches by day.

A HyperLogLog sketch per (key, day) is stored as a binary column.  Any range of
days is then answered by merging its sketches, without the rows; a distinct count
of counts would be wrong, since days share values.  The table has a row per key
and day whatever the number of rows, and a day that is written again replaces
itself.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LG_K = 12


def relative_error(lg_k: int = LG_K) -> float:
    """One standard error of an estimate, of merged sketches too."""
    return 1.04 / math.sqrt(1 << lg_k)


def daily_sketches(df: DataFrame, keys: Sequence[str], time: str, value: Column,
                   lg_k: int = LG_K) -> DataFrame:
    """``keys, day, n`` (rows) and ``sketch`` of the non-null values (int, long,
    text or binary), built map-side.  A null key or day is one of its own; a day
    without values has an empty sketch."""
    return (df.select(*keys, F.to_date(time).alias("day"), value.alias("_value"))
            .groupBy(*keys, "day")
            .agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg("_value", F.lit(lg_k)).alias("sketch")))


def write_days(sketches: DataFrame, path: str) -> None:
    """Append the days of ``sketches`` to the table at ``path``; a day that is
    there already is replaced, so a repeated run changes nothing."""
    (sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day").parquet(path))


def read_days(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path)


def distinct_over(sketches: DataFrame, keys: Sequence[str], ranges: DataFrame) -> DataFrame:
    """``range_id, keys, n, distinct`` (the last an estimate) over each of ``ranges(range_id, first_day,
    last_day)``, both days included.  A range becomes its days, which join the
    sketches by equality; days outside those of the table are cut off first, so an
    open-ended range costs no more than the table has."""
    low, high = sketches.agg(F.min("day"), F.max("day")).first()
    days = (ranges.select("range_id", F.greatest("first_day", F.lit(low).cast("date")).alias("a"),
                          F.least("last_day", F.lit(high).cast("date")).alias("b"))
            .where("a <= b").select("range_id", F.explode(F.sequence("a", "b")).alias("day")))
    return (sketches.join(days, "day").groupBy("range_id", *keys)
            .agg(F.sum("n").alias("n"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct")))
