"""Bad-record quarantine (Q1-Q5) and the JSON-lines sink (K1).

``write_bad_records`` keeps the reference behaviour: filter, cache, skip the
write when nothing is bad, otherwise append JSON lines, and always release
the cache -- also when the write fails.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

# PySpark's MEMORY_AND_DISK is the serialized memory-then-disk level.
QUARANTINE_LEVEL = StorageLevel.MEMORY_AND_DISK

# JSON options shared by the quarantine writer and its readers: null fields
# kept, timestamps at full microsecond precision (Spark's default JSON
# pattern stops at milliseconds, which would alter quarantined rows).
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def null_any(columns: Sequence[str]) -> Column:
    """Q3: true when any of ``columns`` is null -- the default bad-record rule."""
    if not columns:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def bad_condition(df: DataFrame, condition: str | Column | None = None) -> Column:
    """The bad-record test as a Column: a SQL string (Q2), a Column, or Q3 by
    default.  As with ``df.filter(condition)``, a row is bad only when the
    condition is true; a null (undecidable) condition leaves it good, so the
    good and the bad side always add up to the input."""
    if condition is None:
        return null_any(df.columns)
    cond = F.expr(condition) if isinstance(condition, str) else condition
    return F.coalesce(cond, F.lit(False))


def filter_sql(df: DataFrame, condition: str) -> DataFrame:
    """Q2: rows matching a SQL predicate string (parsed by Catalyst, so it is
    pushed to the scan like any other filter)."""
    return df.filter(condition)


def split_good_bad(df: DataFrame, condition: str | Column | None = None
                   ) -> tuple[DataFrame, DataFrame]:
    """Two views of one input: rows that pass and rows that are bad; every row
    lands in exactly one side."""
    cond = bad_condition(df, condition)
    return df.where(~cond), df.where(cond)


def write_json_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    """K1: JSON lines with null fields kept (``{"id":2,"name":null}``)."""
    df.write.mode(mode).options(**JSON_OPTIONS).json(path)


def write_bad_records(df: DataFrame, target: str, condition: str | Column | None = None,
                      level: StorageLevel = QUARANTINE_LEVEL, mode: str = "append") -> bool:
    """Q1: append the bad rows of ``df`` to ``target`` as JSON lines.

    Returns True when something was written.  With no bad row nothing is
    written and ``target`` is not created (Q4).  The bad rows are cached for
    the emptiness probe and the write (Q5) and released in every case.
    ``mode="overwrite"`` makes the write idempotent (stream micro-batches).
    """
    bad = df.filter(bad_condition(df, condition)).persist(level)
    try:
        if bad.isEmpty():
            log.info("no bad records found")
            return False
        write_json_lines(bad, target, mode)
        log.info("bad records written to %s", target)
        return True
    finally:
        bad.unpersist()
