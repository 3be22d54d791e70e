"""A record log kept as sorted segment files with a sparse index.

Layout below the log's folder::

    data/batch=<name>/topic=<t>/partition=<p>/*.parquet   segments, sorted by offset
    index/*.parquet                                       one row per segment

The index holds each segment's smallest and largest offset and timestamp and its
number of records.  Offset bounds, end offsets, the files of an offset range and
offsets by time come from it, so none of them scans the log.  A segment belongs
to the log once the index lists it: a batch whose write was cut short, or is
written again, leaves files that nothing reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators import offsets
from sluice.sources import records as R

SEGMENT_RECORDS = 1 << 20

_RELATIVE = r"^.*/data/(batch=)"


def _index_schema(timestamp: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
        T.StructField("file", T.StringType()), T.StructField("first_offset", T.LongType()),
        T.StructField("last_offset", T.LongType()), T.StructField("first_time", timestamp),
        T.StructField("last_time", timestamp), T.StructField("n", T.LongType())])


class SegmentedLog:
    """The log at ``path``, whose records have the columns ``schema``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = schema
        self.index_schema = _index_schema(schema["timestamp"].dataType)

    def append(self, records: DataFrame, segment_records: int = SEGMENT_RECORDS) -> "SegmentedLog":
        """Write ``records`` as a batch of segments and list them in the index.

        A range partitioning by (topic, partition, offset) makes every segment a
        run of consecutive offsets and spreads a log partition that holds most
        records over many tasks; no file holds more than ``segment_records``.
        The index reads back the offsets and timestamps of this batch only."""
        batch = f"{self.path}/data/batch=b{uuid.uuid4().hex[:12]}"
        keys = ["topic", "partition", "offset"]
        (records.select(*self.schema.names).repartitionByRange(*keys).sortWithinPartitions(*keys)
         .write.option("maxRecordsPerFile", int(segment_records))
         .partitionBy("topic", "partition").parquet(batch))
        # the path is a URI: decoded once it is the name that readers take
        name = F.url_decode(F.replace(F.col("uri"), F.lit("+"), F.lit("%2B")))
        written = self.spark.read.schema(self.schema).parquet(batch).select(
            *keys, "timestamp", F.col("_metadata.file_path").alias("uri"))
        (written.groupBy("topic", "partition", "uri")
         .agg(F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
              F.min("timestamp").alias("first_time"), F.max("timestamp").alias("last_time"),
              F.count(F.lit(1)).alias("n"))
         .withColumn("file", F.regexp_replace(name, _RELATIVE, "$1")).select(*self.index_schema.names)
         .coalesce(1).write.mode("append").parquet(f"{self.path}/index"))
        return self

    def index(self) -> DataFrame:
        return self.spark.read.schema(self.index_schema).parquet(f"{self.path}/index")

    def bounds(self) -> DataFrame:
        """``topic, partition, first_offset, end_offset`` of every log partition."""
        return self.index().groupBy("topic", "partition").agg(
            F.min("first_offset").alias("first_offset"), (F.max("last_offset") + 1).alias("end_offset"))

    def end_offsets(self, topic: str | None = None,
                    partitions: DataFrame | Iterable[tuple[str, int]] | None = None) -> DataFrame:
        """:func:`sluice.operators.offsets.end_offsets` without reading records."""
        last = self.index().select("topic", "partition", F.col("last_offset").alias("offset"))
        return offsets.end_offsets(last, topic, partitions)

    def files(self, names: Iterable[str]) -> DataFrame:
        """The records of the segments ``names``."""
        names = sorted(set(names))
        if not names:
            return self.spark.createDataFrame([], self.schema)
        return (self.spark.read.schema(self.schema).option("basePath", f"{self.path}/data")
                .parquet(*[f"{self.path}/data/{n}" for n in names]).select(*self.schema.names))

    def records(self) -> DataFrame:
        """The whole log: all segments that the index lists (the driver holds
        their names, as it does for any table's files)."""
        return self.files(r["file"] for r in self.index().select("file").distinct().collect())

    def read_ranges(self, ranges: Iterable | DataFrame, bucket_width: int = R.RANGE_BUCKET) -> DataFrame:
        """:func:`sluice.sources.records.read_offset_ranges` over the segments
        that the ranges meet; open-ended ranges are clamped by the index."""
        ranges = R.checked(ranges)
        if isinstance(ranges, list):
            rows = [r for r in ranges if r[2] < r[3]]
            if not rows:
                return self.files([])
            if len(rows) <= R.MAX_TERMS:
                # one small job: the segments that the ranges meet, and their offsets
                met = self.index().where(R.within(rows, "first_offset", "last_offset")).collect()
                low, high = {}, {}
                for r in met:
                    key = (r["topic"], r["partition"])
                    low[key] = min(low.get(key, r["first_offset"]), r["first_offset"])
                    high[key] = max(high.get(key, 0), r["last_offset"] + 1)
                rows = [(t, p, max(a, low[t, p]), min(b, high[t, p])) for t, p, a, b in rows if (t, p) in low]
                return R.read_offset_ranges(self.files(r["file"] for r in met), rows, bucket_width)
            ranges = self.spark.createDataFrame(rows, R.RANGE_SCHEMA)
        clamped = R.clamped_ranges(ranges, self.bounds())
        met = (self.index().alias("i").join(clamped.alias("r"),
               (F.col("i.topic") == F.col("r.topic")) & (F.col("i.partition") == F.col("r.partition"))
               & (F.col("i.first_offset") < F.col("r.until_offset"))
               & (F.col("i.last_offset") >= F.col("r.from_offset")), "left_semi").select("file").collect())
        return R.join_ranges(self.files(r["file"] for r in met), clamped, bucket_width)

    def offsets_for_times(self, times: DataFrame | Iterable[tuple]) -> DataFrame:
        """``topic, partition, time, offset``: for each of ``times(topic,
        partition, time)`` the smallest offset whose timestamp is not before it;
        null if there is none.

        A segment's largest timestamp tells whether it has such a record.  Of
        those that have, the answer is not above the smallest last offset, so only
        segments that begin by then are read: one, where segments do not overlap."""
        kind = self.schema["timestamp"].dataType
        if not isinstance(times, DataFrame):
            times = self.spark.createDataFrame(list(times), T.StructType([
                T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
                T.StructField("time", kind)]))
        times = times.select("topic", F.col("partition").cast("int").alias("partition"),
                             F.col("time").cast(kind).alias("time"))
        asked = times.distinct()
        late = asked.join(self.index(), ["topic", "partition"]).where("last_time >= time")
        first = late.groupBy("topic", "partition", "time").agg(F.min("last_offset").alias("latest"))
        chosen = late.join(first, ["topic", "partition", "time"]).where("first_offset <= latest")
        names = [r["file"] for r in chosen.select("file").distinct().collect()]
        found = (self.files(names).select("topic", "partition", "offset", "timestamp")
                 .join(first, ["topic", "partition"]).where("timestamp >= time AND offset <= latest")
                 .groupBy("topic", "partition", "time").agg(F.min("offset").alias("offset")))
        t = times.alias("t").join(found.alias("f"), F.col("t.topic").eqNullSafe(F.col("f.topic"))
                                  & F.col("t.partition").eqNullSafe(F.col("f.partition"))
                                  & F.col("t.time").eqNullSafe(F.col("f.time")), "left")
        return t.select("t.topic", "t.partition", "t.time", "f.offset")
