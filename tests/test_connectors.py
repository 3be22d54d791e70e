"""Kafka source and spark-avro: thin calls of Spark's public APIs.  Neither
module is on this installation's classpath, so the tests pin the clear
errors; with the modules present they check the real path instead."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sluice.operators import decode as D
from sluice.sources import records as R

SCHEMA = '{"type": "record", "name": "R", "fields": [{"name": "a", "type": "int"}]}'


def _avro_loaded(spark) -> bool:
    try:
        from pyspark.sql.avro.functions import to_avro
        spark.range(1).select(to_avro(F.struct(F.col("id").cast("int").alias("a")))).collect()
        return True
    except AnalysisException:
        return False


def test_decode_avro(spark):
    # Avro int 1 is the zig-zag varint 0x02
    df = spark.createDataFrame([("t", 0, 0, bytes([2]))],
                               "topic string, partition int, offset long, payload binary")
    if not _avro_loaded(spark):
        with pytest.raises(AnalysisException, match="AVRO"):
            D.decode_avro(df, SCHEMA).collect()
        return
    assert [r["a"] for r in D.decode_avro(df, SCHEMA).collect()] == [1]


def test_kafka_reader(spark):
    try:
        df = R.kafka_range_reader(spark, "localhost:1", [("t", 0, 0, 10)], min_partitions=2)
    except AnalysisException as exc:
        assert "kafka" in str(exc).lower()
        return
    assert df.columns[:2] == ["key", "value"]
