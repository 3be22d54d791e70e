"""A1: end offset of every log partition, computed from the records."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITION_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType(), False),
    T.StructField("partition", T.IntegerType(), False),
])


def end_offsets(records: DataFrame, topic: str | None = None,
                partitions: DataFrame | Iterable[tuple[str, int]] | None = None) -> DataFrame:
    """``(topic, partition, end_offset)``: the next offset to be written.

    From data this is ``max(offset) + 1``; ``max`` is combined map-side, so a
    partition holding a third of the log costs one partial row per task.
    ``partitions`` only adds partitions: those that must appear even without
    records (end offset 0), as the broker reports them.  With a compacted or expired
    log the broker's figure can be higher than what the records show.
    """
    scoped = records if topic is None else records.where(F.col("topic") == topic)
    ends = (scoped.groupBy("topic", "partition")
                  .agg((F.max("offset") + 1).cast("long").alias("end_offset")))
    if partitions is None:
        return ends
    spark = records.sparkSession
    if not isinstance(partitions, DataFrame):
        partitions = spark.createDataFrame(
            [(str(t), int(p)) for t, p in partitions], PARTITION_SCHEMA)
    listed = partitions.select("topic", "partition")
    if topic is not None:
        listed = listed.where(F.col("topic") == topic)
    # listed partitions come in as 0; one max per partition merges both sides,
    # so a partition with records stays whether it is listed or not
    zeros = listed.withColumn("end_offset", F.lit(0).cast("long"))
    return (ends.unionByName(zeros).groupBy("topic", "partition")
                .agg(F.max("end_offset").alias("end_offset")))


def end_offset_map(ends: DataFrame) -> dict[tuple[str, int], int]:
    """``{(topic, partition): end_offset}``; one row per log partition, which
    is what a consumer's position map holds."""
    return {(r["topic"], r["partition"]): r["end_offset"] for r in ends.collect()}
