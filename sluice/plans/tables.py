"""Input tables of the registered queries and the record-log view of
``events`` (each log partition is ``user_id % 4``, offsets follow
``event_id``)."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import scratch_dir
from sluice.sources.records import RECORD_COLUMNS, records_from_table
from sluice.sources.segments import SegmentedLog

EVENTS_TOPIC = "events"
LOG_PARTITIONS = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_records(ev: DataFrame, value=None, key=None) -> DataFrame:
    """``events`` as a record log: key = event id text, value = ``props``
    bytes (a JSON document), timestamp = ``ts``."""
    return records_from_table(
        ev, EVENTS_TOPIC, F.col("user_id") % LOG_PARTITIONS, "event_id",
        key=key if key is not None else F.col("event_id").cast("string"),
        value=value if value is not None else F.col("props"),
        timestamp=F.col("ts"))


_LOGS: dict[tuple, tuple[str, object]] = {}
_LOGS_LOCK = threading.Lock()


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, schema = events_log_table(spark, sf_dir)
    # the schema is given, so the partition columns keep their types
    return spark.read.schema(schema).parquet(f"{path}/data").select(*RECORD_COLUMNS)


def events_segments(spark: SparkSession, sf_dir: str) -> SegmentedLog:
    return SegmentedLog(spark, *events_log_table(spark, sf_dir))


def _file_state(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files at ``path`` (a file or folder),
    through Hadoop's file system; empty if there is none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return ()
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime())
                        for f in fs.listStatus(where)))


def events_log_key(spark: SparkSession, sf_dir: str) -> tuple:
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    return spark.sparkContext.applicationId, path, _file_state(spark, path)


def events_log_table(spark: SparkSession, sf_dir: str):
    """``(path, schema)`` of :func:`events_records`, materialised once per
    application and state of the input files as a segmented log in the shared
    checkpoint folder -- the way a record log exists before anyone reads it
    (see :func:`events_log` and :func:`events_segments`).  Reading it also cuts
    the lineage back to ``events``.
    """
    key = events_log_key(spark, sf_dir)
    with _LOGS_LOCK:
        known = _LOGS.get(key)
        if known is not None and not _file_state(spark, known[0]):
            del _LOGS[key]  # scratch folder released meanwhile: rebuild
        if key not in _LOGS:
            path = scratch_dir(spark, "events-log")
            log = events_records(table(spark, sf_dir, "events"))
            SegmentedLog(spark, path, log.schema).append(log)
            _LOGS[key] = (path, log.schema)
        return _LOGS[key]


def with_gaps(ev: DataFrame) -> DataFrame:
    """``event_type`` nulled where it says ``error``: the bad rows of the
    quality queries (works on a batch or a streaming frame)."""
    return ev.select("event_id", "ts", "user_id",
                     F.when(F.col("event_type") != "error", F.col("event_type"))
                      .alias("event_type"),
                     "value", "props")


def events_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_gaps(table(spark, sf_dir, "events"))
