"""Q1/D4 on a stream: two sinks per batch, retries, replay after a registration."""

import json

import pytest
from pyspark.sql import functions as F

from sluice.operators import decode as D
from sluice.session import scratch_dir
from sluice.streaming import decoding as S

V1 = json.dumps({"type": "record", "name": "R", "fields": [{"name": "k", "type": "int"}]})
V2 = json.dumps({"type": "record", "name": "R", "fields": [{"name": "old", "type": "int"}]})
READER = json.dumps({"type": "record", "name": "R", "fields": [
    {"name": "k", "type": "long", "aliases": ["old"]}, {"name": "note", "type": "string", "default": "none"}]})


def _source(spark, n=90):
    """Ids 1, 2 (not registered at first) and 9 (never), some values null."""
    path = scratch_dir(spark, "framed")
    sid = F.get(F.array(F.lit(1), F.lit(2), F.lit(9)), F.col("offset").cast("int") % 3)
    doc = F.when(F.col("offset") % 3 == 1, F.format_string('{"old": %d}', "offset")).otherwise(
        F.format_string('{"k": %d}', "offset"))
    df = spark.range(n).select(F.lit("t").alias("topic"), (F.col("id") % 2).cast("int").alias("partition"),
                               F.col("id").alias("offset"))
    doc = F.when(F.col("offset") % 10 == 3, F.lit("no object")).otherwise(doc)
    df = df.withColumn("value", F.when(F.col("offset") % 10 != 7, D.frame_value(doc, sid)))
    df.repartition(3).write.parquet(path)
    return path, df


def _registry(spark, versions):
    return spark.createDataFrame([("t-value", i, i, text) for i, text in versions],
                                 "subject string, version int, id int, schema_json string")


def _run(spark, path, df, target, checkpoint, registry):
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", "1").parquet(path)
    return S.decode_stream(stream, registry, READER, target, checkpoint, subject="t-value")


def _state(spark, target):
    good = sorted(tuple(r) for r in S.good_records(spark, target, READER).select("offset", "k", "note").collect())
    bad = sorted((r["offset"], r["reason"]) for r in S.still_rejected(spark, target, READER).collect())
    return good, bad


def _reason(o, known):
    return D.NULL_VALUE if o % 10 == 7 else D.UNKNOWN_ID if o % 3 not in known else D.UNPARSABLE if o % 10 == 3 else None


def _expected(n, known):
    return ([(o, o, "none") for o in range(n) if _reason(o, known) is None],
            [(o, _reason(o, known)) for o in range(n) if _reason(o, known)])


def test_rejected_records_are_replayed_once_their_schema_is_known(spark):
    path, df = _source(spark)
    target, checkpoint = scratch_dir(spark, "decoded"), scratch_dir(spark, "ckpt")
    _run(spark, path, df, target, checkpoint, lambda: _registry(spark, [(1, V1)]))
    assert _state(spark, target) == _expected(90, {0})
    assert S.replay_rejected(spark, "a", _registry(spark, [(1, V1)]), READER, target, "t-value") == 0
    both = _registry(spark, [(1, V1), (2, V2)])
    assert S.replay_rejected(spark, "b", both, READER, target, "t-value") == 24
    assert _state(spark, target) == _expected(90, {0, 1})
    # a replay of nothing changes nothing, and neither does the stream without new input
    assert S.replay_rejected(spark, "c", both, READER, target, "t-value") == 0
    _run(spark, path, df, target, checkpoint, lambda: both)
    assert _state(spark, target) == _expected(90, {0, 1})
    # and the whole equals a batch decode
    good, bad = D.decode_by_schema_id(df, both, READER, subject="t-value")
    assert sorted((r["offset"], r["k"], r["note"]) for r in good.collect()) == _state(spark, target)[0]
    assert sorted((r["offset"], r["reason"]) for r in bad.collect()) == _state(spark, target)[1]


def test_a_batch_that_fails_between_its_sinks_is_retried(spark):
    path, df = _source(spark)
    target, checkpoint = scratch_dir(spark, "decoded"), scratch_dir(spark, "ckpt")
    calls = []

    def registry():
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("killed")
        return _registry(spark, [(1, V1)])

    with pytest.raises(Exception, match="killed"):
        _run(spark, path, df, target, checkpoint, registry)
    # what a first attempt of the next batch left in one sink only
    df.limit(5).select("topic", "partition", "offset", F.lit(5).cast("long").alias("k"), F.lit("x").alias("note")) \
        .write.parquet(f"{target}/good/batch=b1")
    _run(spark, path, df, target, checkpoint, registry)
    assert _state(spark, target) == _expected(90, {0})


def test_the_registry_is_read_for_every_batch(spark):
    path, df = _source(spark)
    target, checkpoint = scratch_dir(spark, "decoded"), scratch_dir(spark, "ckpt")
    calls = []

    def registry():
        calls.append(1)
        return _registry(spark, [(1, V1), (2, V2)][:len(calls)])

    _run(spark, path, df, target, checkpoint, registry)
    assert len(calls) == 3
    S.replay_rejected(spark, "late", registry(), READER, target, "t-value")
    assert _state(spark, target) == _expected(90, {0, 1})
