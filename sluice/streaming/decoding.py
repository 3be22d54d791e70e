"""Registry decoding on a stream, with a replay of what was rejected.

Each micro-batch is decoded with the registry as it is then, into two folders of
its own::

    <target>/good/batch=b<id>/       decoded records
    <target>/rejected/batch=b<id>/   the others: key columns, schema id, raw value, reason

Both are overwritten as a whole, so a batch that is tried again after a failure
between the two replaces what the first attempt left.  Records whose schema was
unknown are not lost: once it is registered, :func:`replay_rejected` decodes them
into ``good/batch=r<name>``.  A record that was replayed is told from one that is
still rejected by its topic, partition and offset.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sluice.operators import decode
from sluice.operators.registry import avro_to_spark
from sluice.operators.resolution import nullable

KEYS = decode.META_COLUMNS
KEY_FIELDS = [T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
              T.StructField("offset", T.LongType())]
REJECTED = T.StructType([*KEY_FIELDS, T.StructField("schema_id", T.IntegerType()),
                         T.StructField("value", T.BinaryType()), T.StructField("reason", T.StringType())])


def good_schema(reader_schema: str) -> T.StructType:
    return T.StructType([*KEY_FIELDS, *nullable(avro_to_spark(reader_schema)).fields])


def decode_batch(batch: DataFrame, name: str, registry: DataFrame, reader_schema: str, target: str,
                 subject: str | None = None) -> None:
    """One batch into its two folders."""
    batch = batch.select(*KEYS, "value").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        good, bad = decode.decode_by_schema_id(batch, registry, reader_schema, subject=subject)
        good.write.mode("overwrite").parquet(f"{target}/good/batch={name}")
        bad.write.mode("overwrite").parquet(f"{target}/rejected/batch={name}")
    finally:
        batch.unpersist()


def decode_stream(stream: DataFrame, registry: Callable[[], DataFrame], reader_schema: str, target: str,
                  checkpoint: str, subject: str | None = None) -> StreamingQuery:
    """Decode everything available, batch by batch, and stop; ``registry`` is
    called for each batch, so versions registered meanwhile are known."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        decode_batch(batch, f"b{batch_id}", registry(), reader_schema, target, subject)

    query = (stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def good_records(spark: SparkSession, target: str, reader_schema: str) -> DataFrame:
    return spark.read.schema(good_schema(reader_schema)).parquet(f"{target}/good").drop("batch")


def still_rejected(spark: SparkSession, target: str, reader_schema: str) -> DataFrame:
    """The rejected records that no replay has decoded since, with the reason
    that was found last.  Only keys of replays are read beside them."""
    name = T.StructField("batch", T.StringType())
    rejected = spark.read.schema(T.StructType([*REJECTED.fields, name])).parquet(f"{target}/rejected")
    good = spark.read.schema(T.StructType([*good_schema(reader_schema).fields, name])).parquet(f"{target}/good")
    replayed = F.col("batch").startswith("r")
    settled = good.where(replayed).select(*KEYS).unionByName(rejected.where(replayed).select(*KEYS))
    first = rejected.where(~replayed).join(settled, list(KEYS), "left_anti")
    return first.unionByName(rejected.where(replayed)).drop("batch")


def replay_rejected(spark: SparkSession, name: str, registry: DataFrame, reader_schema: str, target: str,
                    subject: str | None = None,
                    reasons: Sequence[str] = (decode.UNKNOWN_ID, decode.UNRESOLVED)) -> int:
    """Decode again what was rejected for ``reasons`` and can be decoded now, as
    the batch ``r<name>``; returns how many records that were.  One that turns out
    to be bad for another reason is settled too, in ``rejected``.  Without new
    schemas nothing changes, and another ``name`` is another replay."""
    waiting = still_rejected(spark, target, reader_schema).where(F.col("reason").isin(list(reasons)))
    good, bad = decode.decode_by_schema_id(waiting.select(*KEYS, "value"), registry, reader_schema, subject=subject)
    # written beside the table first: a replay must not read what it adds to
    beside = f"{target}/replays/{name}"
    good.write.mode("overwrite").parquet(f"{beside}/good")
    bad.where(~F.col("reason").isin(list(reasons))).write.mode("overwrite").parquet(f"{beside}/rejected")
    count = 0
    for kind, schema in (("rejected", REJECTED), ("good", good_schema(reader_schema))):
        made = spark.read.schema(schema).parquet(f"{beside}/{kind}")
        count = made.count()
        if count:
            made.write.mode("overwrite").parquet(f"{target}/{kind}/batch=r{name}")
    return count
