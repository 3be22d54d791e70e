"""Record logs in Kafka's layout: bounded offset-range reads and inspection.

A record table has Spark's Kafka-source columns::

    key binary, value binary, topic string, partition int, offset bigint,
    timestamp timestamp[_ntz], timestampType int

It comes either from ``spark.read.format("kafka")`` (see
:func:`kafka_range_reader`) or from any table reshaped by
:func:`records_from_table`.  Everything downstream is an ordinary DataFrame,
so Catalyst prunes columns and pushes the offset predicates to the scan.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import scratch_dir


RECORD_COLUMNS = ["key", "value", "topic", "partition", "offset",
                  "timestamp", "timestampType"]

RECORD_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

RANGE_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType(), False),
    T.StructField("partition", T.IntegerType(), False),
    T.StructField("from_offset", T.LongType(), False),
    T.StructField("until_offset", T.LongType(), False),
])

# A log partition may hold a third of all records, so ranges and records meet on
# stretches of this many offsets, not on whole partitions.
RANGE_BUCKET = 1 << 20

# So many terms at most are pushed to a scan as one disjunction.
MAX_TERMS = 256

# Ranges of more stretches than this in all are clamped to the log first.
MAX_STRETCHES = 1 << 16

# Rows without an order key are dealt over this many buckets of a log partition.
NULL_KEY_BUCKETS = 1 << 20

# --------------------------------------------------------------------------
# Offsets: contiguous per-partition numbering without a hot task
# --------------------------------------------------------------------------

def assign_offsets(df: DataFrame, partition_col: str, order_col: str,
                   out_col: str = "offset", bucket_width: int = 1 << 20,
                   buckets_per_group: int = 1 << 20) -> DataFrame:
    """Number the rows of each ``partition_col`` value 0, 1, 2, ... in
    ``order_col`` order -- ``row_number() OVER (PARTITION BY p ORDER BY o) - 1``
    -- without sending one log partition to one task.

    ``order_col`` is an integral column, unique within a partition value.

    Rows are cut into buckets ``o div bucket_width``, so a bucket holds at
    most ``bucket_width`` rows of one partition, however hot the partition.
    The offset is (rows in earlier buckets of the partition) + (row number in
    the bucket).  The first term is a prefix sum over the per-bucket count
    table, done in two levels -- inside groups of ``buckets_per_group``
    consecutive buckets, then over the group totals -- so no window task ever
    holds more than ``buckets_per_group`` buckets, or 2^63 / (bucket_width *
    buckets_per_group) groups, even for very sparse keys.

    The per-bucket count table (about one row per ``bucket_width`` offsets
    of a partition) is written once as a table in the shared checkpoint
    folder: both prefix-sum levels read it, so the input is scanned twice in
    all -- once for counts, once for numbering -- nothing stays cached after
    the call, and the table survives executor loss.

    Every step is deterministic -- no sampling and no dependence on task ids
    -- so recomputation after an executor loss gives the same offsets.  A
    null partition is a partition of its own and null order keys come first,
    as in ``ORDER BY o``, dealt over many buckets by the hash of their row;
    no row is dropped.  The numbered side is
    hash-partitioned on ``(p, bucket)`` by its window and joins on exactly
    those keys, so only the small count tables move; whether they are
    broadcast is decided from their measured size.
    """
    w, g = int(bucket_width), int(buckets_per_group)
    hashed = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields
                          if not isinstance(f.dataType, (T.MapType, T.VariantType))])
    null_key = F.col(order_col).isNull()
    # integral ``div`` (truncating, still monotone in the key): exact for any long;
    # null keys are dealt over buckets of their own by the row's hash
    staged = (df.withColumn("_null", null_key)
                .withColumn("_bucket", F.when(null_key, F.pmod(hashed, F.lit(NULL_KEY_BUCKETS)))
                            .otherwise(F.expr(f"cast(`{order_col}` as long) div {w}"))))
    counts_path = scratch_dir(df.sparkSession, "offset-counts")
    (staged.groupBy(partition_col, "_null", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
           .write.parquet(counts_path))
    counts = (df.sparkSession.read.parquet(counts_path)
                .withColumn("_group", F.expr(f"_bucket div {g}")))
    before = Window.unboundedPreceding
    in_group = (Window.partitionBy(partition_col, "_null", "_group").orderBy("_bucket")
                      .rowsBetween(before, -1))
    group_bases = (counts.groupBy(partition_col, "_null", "_group").agg(F.sum("_n").alias("_gn"))
                         .select(F.col(partition_col).alias("_gp"), F.col("_null").alias("_gnull"),
                                 F.col("_group").alias("_gg"),
                                 F.coalesce(F.sum("_gn").over(
                                     Window.partitionBy(partition_col)
                                           .orderBy(F.col("_null").desc(), "_group")
                                           .rowsBetween(before, -1)), F.lit(0)).alias("_gbase")))
    inner = counts.select(partition_col, "_null", "_bucket", "_group",
                          F.coalesce(F.sum("_n").over(in_group), F.lit(0)).alias("_inner"))
    bases = (inner.join(group_bases, _same(inner[partition_col], "_gp")
                        & (inner["_null"] == F.col("_gnull")) & (inner["_group"] == F.col("_gg")))
                  .select(F.col(partition_col).alias("_bp"), F.col("_null").alias("_bn"),
                          F.col("_bucket").alias("_bb"),
                          (F.col("_gbase") + F.col("_inner")).alias("_base")))
    inside = Window.partitionBy(partition_col, "_null", "_bucket").orderBy(order_col, hashed)
    numbered = staged.withColumn("_local", F.row_number().over(inside) - 1)
    # null-safe: rows of a null partition are numbered, never dropped
    return (numbered.join(bases, _same(numbered[partition_col], "_bp")
                          & (numbered["_null"] == F.col("_bn"))
                          & (numbered["_bucket"] == F.col("_bb")))
                    .withColumn(out_col, (F.col("_base") + F.col("_local")).cast("long"))
                    .drop("_null", "_bucket", "_local", "_base", "_bp", "_bn", "_bb"))


def _same(left: Column, right: str) -> Column:
    return left.eqNullSafe(F.col(right))


def records_from_table(df: DataFrame, topic: str | Column, partition: Column,
                       order_col: str, key: Column, value: Column,
                       timestamp: Column | None = None,
                       bucket_width: int = 1 << 20) -> DataFrame:
    """Reshape a table into Kafka's record layout.

    ``partition`` decides the log partition of each row, ``order_col`` (an
    integral key) the order inside it; offsets are dense from 0, see
    :func:`assign_offsets`.
    ``key`` and ``value`` are cast to binary.
    """
    topic_col = F.lit(topic) if isinstance(topic, str) else topic
    ts = timestamp if timestamp is not None else F.lit(None).cast("timestamp")
    staged = df.select(
        key.cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        topic_col.alias("topic"),
        partition.cast("int").alias("partition"),
        ts.alias("timestamp"),
        F.lit(0).alias("timestampType"),
        F.col(order_col).alias("_order"),
    )
    with_offsets = assign_offsets(staged, "partition", "_order", bucket_width=bucket_width)
    return with_offsets.select(*RECORD_COLUMNS)


# --------------------------------------------------------------------------
# Bounded offset-range read
# --------------------------------------------------------------------------

def _normalise_ranges(ranges: Iterable) -> list[tuple[str, int, int, int]]:
    out = []
    for r in ranges:
        if isinstance(r, dict):
            t, p, a, b = r["topic"], r["partition"], r["from_offset"], r["until_offset"]
        else:
            t, p, a, b = r
        t, p, a, b = str(t), int(p), int(a), int(b)
        if a < 0 or b < a:
            raise ValueError(f"bad offset range {t}/{p} [{a}, {b})")
        out.append((t, p, a, b))
    return out


def _checked_ranges(ranges: DataFrame) -> DataFrame:
    """A table of ranges as ``RANGE_SCHEMA``; as in a list, a range that is
    negative, reversed or incomplete raises."""
    rdf = ranges.select(*[F.col(f.name).cast(f.dataType) for f in RANGE_SCHEMA.fields])
    good = (F.col("topic").isNotNull() & F.col("partition").isNotNull()
            & (F.col("from_offset") >= 0) & (F.col("until_offset") >= F.col("from_offset")))
    bad = rdf.where(~F.coalesce(good, F.lit(False))).first()
    if bad is not None:
        raise ValueError(f"bad offset range {bad['topic']}/{bad['partition']} "
                         f"[{bad['from_offset']}, {bad['until_offset']})")
    return rdf


def _any_of(predicates: list[Column]) -> Column:
    """A balanced disjunction: its depth is the logarithm of its length."""
    while len(predicates) > 1:
        predicates = [a | b for a, b in zip(predicates[::2], predicates[1::2])] \
            + predicates[len(predicates) // 2 * 2:]
    return predicates[0]


def _overlap(rows: Iterable[tuple[str, int, int, int]]) -> bool:
    ordered = sorted(r for r in rows if r[2] < r[3])
    return any(x[:2] == y[:2] and y[2] < x[3] for x, y in zip(ordered, ordered[1:]))


def within(rows: Iterable[tuple[str, int, int, int]], low: str = "offset", high: str = "offset") -> Column:
    """Whether ``[low, high]`` meets one of the ranges of its log partition."""
    return _any_of([(F.col("topic") == t) & (F.col("partition") == p)
                    & (F.col(high) >= a) & (F.col(low) < b) for t, p, a, b in rows])


def checked(ranges: Iterable | DataFrame) -> list[tuple[str, int, int, int]] | DataFrame:
    """``ranges`` normalised; raises for a bad one."""
    return _checked_ranges(ranges) if isinstance(ranges, DataFrame) else _normalise_ranges(ranges)


def clamped_ranges(ranges: DataFrame, bounds: DataFrame) -> DataFrame:
    """``ranges`` cut to ``bounds(topic, partition, first_offset, end_offset)``;
    those without an offset left are gone."""
    return (ranges.join(bounds, ["topic", "partition"])
            .select("topic", "partition", F.greatest("from_offset", "first_offset").alias("from_offset"),
                    F.least("until_offset", "end_offset").alias("until_offset"))
            .where("from_offset < until_offset"))


def own_bounds(records: DataFrame, ranges: DataFrame) -> DataFrame:
    """``topic, partition, first_offset, end_offset`` of the log partitions that
    ``ranges`` name, from the records themselves (combined map-side)."""
    named = ranges.select("topic", "partition").distinct()
    return (records.select("topic", "partition", "offset").join(named, ["topic", "partition"], "left_semi")
            .groupBy("topic", "partition")
            .agg(F.min("offset").alias("first_offset"), (F.max("offset") + 1).alias("end_offset")))


def read_offset_ranges(records: DataFrame, ranges: Iterable | DataFrame,
                       bucket_width: int = RANGE_BUCKET) -> DataFrame:
    """Exactly the records in each ``(topic, partition, [from, until))``.

    ``ranges`` is a list of tuples / dicts, or a DataFrame with the columns of
    ``RANGE_SCHEMA``.  As with one RDD partition per offset range, a record
    inside two overlapping ranges is returned once per range.

    * Up to ``MAX_TERMS`` listed ranges that do not overlap are one pushed
      filter: folders are pruned, row groups skipped, nothing is shuffled.
    * Otherwise ranges are cut into stretches of ``bucket_width`` offsets and
      joined on ``(topic, partition, stretch)`` with the bounds as residual, so a
      hot partition is many keys; the optimizer broadcasts the ranges if they
      measure small.  Up to ``MAX_TERMS`` spans (lowest to highest offset of a log
      partition) are pushed to the scan; beyond that the join alone decides.
    * Only ranges of more than ``MAX_STRETCHES`` stretches in all, open-ended ones
      that is, are first clamped by the smallest and largest offset of the log
      partitions they name.  A log with a segment index knows those without
      reading records: :class:`sluice.sources.segments.SegmentedLog`.
    """
    spark, w = records.sparkSession, int(bucket_width)
    ranges = checked(ranges)
    if isinstance(ranges, list):
        rows = [r for r in ranges if r[2] < r[3]]
        if not rows:
            return records.limit(0)
        if len(rows) <= MAX_TERMS and not _overlap(rows):
            return records.where(within(rows))
        wide = sum((b - 1) // w - a // w + 1 for _, _, a, b in rows) > MAX_STRETCHES
        ranges = spark.createDataFrame(rows, RANGE_SCHEMA)
    else:
        ranges = ranges.where("from_offset < until_offset")
        stretches = F.expr(f"cast((until_offset - 1) div {w} - from_offset div {w} + 1 as decimal(38,0))")
        wide = (ranges.agg(F.sum(stretches)).first()[0] or 0) > MAX_STRETCHES
    if wide:
        ranges = clamped_ranges(ranges, own_bounds(records, ranges))
    return join_ranges(records, ranges, w)


def join_ranges(records: DataFrame, ranges: DataFrame, bucket_width: int = RANGE_BUCKET) -> DataFrame:
    """``records`` once for every one of ``ranges`` (none open-ended) that holds
    their offset."""
    w = int(bucket_width)
    # a row per log partition, of at most so many
    spans = (ranges.groupBy("topic", "partition")
             .agg(F.min("from_offset").alias("a"), F.max("until_offset").alias("b"))
             .limit(MAX_TERMS + 1).collect())
    if not spans:
        return records.limit(0)
    if len(spans) <= MAX_TERMS:
        records = records.where(within(sorted(map(tuple, spans))))
    cut = ranges.withColumn("_stretch", F.explode(F.sequence(
        F.expr(f"from_offset div {w}"), F.expr(f"(until_offset - 1) div {w}")))).alias("r")
    k = records.withColumn("_stretch", F.expr(f"offset div {w}")).alias("k")
    cond = ((F.col("k.topic") == F.col("r.topic"))
            & (F.col("k.partition") == F.col("r.partition"))
            & (F.col("k._stretch") == F.col("r._stretch"))
            & (F.col("r.from_offset") <= F.col("k.offset"))
            & (F.col("k.offset") < F.col("r.until_offset")))
    return k.join(cut, cond, "inner").select(*[F.col(f"k.{c}") for c in records.columns])


def kafka_range_options(ranges: Iterable) -> list[dict[str, str]]:
    """Kafka-source options for offset ranges: one option set per layer.

    The Kafka source takes one ``[starting, ending)`` pair per topic-partition,
    so ranges of the same partition are spread over layers that are read
    separately and unioned.
    """
    layers: list[dict[tuple[str, int], tuple[int, int]]] = []
    for t, p, a, b in _normalise_ranges(ranges):
        for layer in layers:
            if (t, p) not in layer:
                layer[(t, p)] = (a, b)
                break
        else:
            layers.append({(t, p): (a, b)})
    out = []
    for layer in layers:
        assign: dict[str, list[int]] = {}
        start: dict[str, dict[str, int]] = {}
        end: dict[str, dict[str, int]] = {}
        for (t, p), (a, b) in sorted(layer.items()):
            assign.setdefault(t, []).append(p)
            start.setdefault(t, {})[str(p)] = a
            end.setdefault(t, {})[str(p)] = b
        out.append({"assign": json.dumps(assign),
                    "startingOffsets": json.dumps(start),
                    "endingOffsets": json.dumps(end)})
    return out


def kafka_range_reader(spark: SparkSession, bootstrap_servers: str, ranges: Iterable,
                       min_partitions: int, **options: str) -> DataFrame:
    """Batch read of offset ranges straight from Kafka (needs the
    spark-sql-kafka package on the classpath).  Nothing is committed.
    ``min_partitions`` splits large ranges over tasks; without it a log
    partition is one task.  No ranges, no rows."""
    frames = []
    for opts in kafka_range_options(ranges):
        reader = (spark.read.format("kafka")
                  .option("kafka.bootstrap.servers", bootstrap_servers)
                  .option("minPartitions", str(int(min_partitions))))
        for k, v in {**opts, **options}.items():
            reader = reader.option(k, v)
        frames.append(reader.load())
    if not frames:
        return spark.createDataFrame([], RECORD_SCHEMA)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def kafka_stream_reader(spark: SparkSession, bootstrap_servers: str, topic: str,
                        max_offsets_per_trigger: int, starting: str = "earliest",
                        **options: str) -> DataFrame:
    """Streaming Kafka source subscribed to one topic, from ``earliest``.
    ``max_offsets_per_trigger`` bounds every micro-batch, so a backlog is
    taken and committed in steps."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("maxOffsetsPerTrigger", str(int(max_offsets_per_trigger)))
              .option("startingOffsets", starting))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


# --------------------------------------------------------------------------
# K2 / K3: preview and inspection
# --------------------------------------------------------------------------

def preview(df: DataFrame, order_by: Sequence[str], n: int = 20) -> DataFrame:
    """The first ``n`` rows in a stable order (what ``show()`` prints).
    ``orderBy + limit`` plans as TakeOrderedAndProject: a per-task top-n,
    never a full sort."""
    return df.orderBy(*order_by).limit(n)


def inspect_records(records: DataFrame, n: int | None = None) -> DataFrame:
    """K3: key and value text of every record; of the first ``n`` in log order
    when ``n`` is given."""
    text = records.select("topic", "partition", "offset",
                          F.col("key").cast("string").alias("key"),
                          F.col("value").cast("string").alias("value"))
    return text if n is None else preview(text, ["topic", "partition", "offset"], n)
