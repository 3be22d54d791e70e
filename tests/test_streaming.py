"""S2 (availableNow ingestion) and Q1 on streams (FIXTURES A.6)."""

from pyspark.sql import functions as F

from sluice.operators.quality import null_any
from sluice.session import scratch_dir
from sluice.sources.files import read_json
from sluice.streaming import ingest


def _batch(spark, lo, hi):
    return spark.range(lo, hi).select(
        F.lit("t").alias("topic"), (F.col("id") % 2).cast("int").alias("partition"),
        F.col("id").alias("offset"), F.col("id").cast("string").cast("binary").alias("value"))


def test_available_now_equals_batch_and_resumes(spark):
    src, sink, ckpt = (scratch_dir(spark, n) for n in ("src", "sink", "ckpt"))
    _batch(spark, 0, 50).write.parquet(src)
    schema = spark.read.parquet(src).schema

    def run():
        stream = spark.readStream.schema(schema).parquet(src)
        ingest.run_available_now(stream, sink, ckpt)
        return spark.read.schema(schema).parquet(sink)

    assert sorted(r["offset"] for r in run().collect()) == list(range(50))
    # same checkpoint, nothing new: nothing added
    assert run().count() == 50
    # new records are picked up by the next run
    _batch(spark, 50, 80).write.mode("append").parquet(src)
    assert sorted(r["offset"] for r in run().collect()) == list(range(80))


def test_stream_quarantine_equals_batch(spark):
    src, target, ckpt = (scratch_dir(spark, n) for n in ("src", "bad", "ckpt"))
    df = spark.range(0, 40).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.lit("x")).alias("name"))
    df.repartition(4).write.parquet(src)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", "1").parquet(src)
    ingest.quarantine_stream(stream, target, ckpt)
    got = read_json(spark, target, schema=df.schema)
    expected = df.where(null_any(df.columns))
    assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in expected.collect())
    # one folder per micro-batch that had bad rows
    assert got.count() == expected.count()


def test_replayed_micro_batch_is_not_counted_twice(spark):
    df = spark.range(0, 30).select(
        "id", F.when(F.col("id") % 4 == 0, F.lit(None)).otherwise(F.lit("x")).alias("name"))
    target = scratch_dir(spark, "bad")
    assert ingest.quarantine_batch(df, 7, target)
    assert ingest.quarantine_batch(df, 7, target)  # the same batch, replayed
    ingest.quarantine_batch(df.where("id >= 10"), 8, target)
    got = sorted(r["id"] for r in read_json(spark, target, schema=df.schema).collect())
    assert got == sorted(list(range(0, 30, 4)) + list(range(12, 30, 4)))
