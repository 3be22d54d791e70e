"""The bad-record quarantine and its golden output."""

import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.operators import quality as Q
from sluice.session import scratch_dir
from sluice.sources.files import read_json_lines_text

# Rows and the lines that they give.
SCHEMA = "id int, name string"
ROWS = [(1, "Alice"), (2, None), (3, "Charlie"), (None, "David")]
GOLDEN = ['{"id":2,"name":null}', '{"id":null,"name":"David"}']


def _lines(spark, path):
    return sorted(r["value"] for r in read_json_lines_text(spark, path).collect())


def test_golden_bad_records(spark):
    # FIXTURES A.4: exactly these two lines, once each
    df = spark.createDataFrame(ROWS, SCHEMA)
    target = scratch_dir(spark, "bad")
    assert Q.write_bad_records(df, target) is True
    assert _lines(spark, target) == sorted(GOLDEN)
    # a second call appends: the lines double
    Q.write_bad_records(df, target)
    assert _lines(spark, target) == sorted(GOLDEN * 2)


def _count_cache_calls(monkeypatch, df):
    """Count persist / unpersist calls, as the reference's mocked tests do."""
    calls = {"persist": [], "unpersist": 0}
    cls = type(df)
    real_persist, real_unpersist = cls.persist, cls.unpersist

    def persist(self, level=Q.QUARANTINE_LEVEL):
        calls["persist"].append(level)
        return real_persist(self, level)

    def unpersist(self, blocking=False):
        calls["unpersist"] += 1
        return real_unpersist(self, blocking)

    monkeypatch.setattr(cls, "persist", persist)
    monkeypatch.setattr(cls, "unpersist", unpersist)
    return calls


def test_no_bad_records_writes_nothing_and_releases_cache(spark, monkeypatch):
    df = spark.createDataFrame([(1, "Alice"), (3, "Charlie")], SCHEMA)
    target = scratch_dir(spark, "bad")
    calls = _count_cache_calls(monkeypatch, df)
    assert Q.write_bad_records(df, target) is False
    assert not os.path.exists(target)
    assert calls == {"persist": [Q.QUARANTINE_LEVEL], "unpersist": 1}


def test_some_bad_records_one_append_and_release(spark, monkeypatch):
    df = spark.createDataFrame(ROWS, SCHEMA)
    calls = _count_cache_calls(monkeypatch, df)
    writes = []
    real = Q.write_json_lines
    monkeypatch.setattr(Q, "write_json_lines",
                        lambda d, p, m="append": (writes.append((p, m)), real(d, p, m)))
    target = scratch_dir(spark, "bad")
    assert Q.write_bad_records(df, target) is True
    assert writes == [(target, "append")]
    assert calls == {"persist": [Q.QUARANTINE_LEVEL], "unpersist": 1}


def test_failing_write_still_releases_cache(spark, monkeypatch):
    df = spark.createDataFrame(ROWS, SCHEMA)
    calls = _count_cache_calls(monkeypatch, df)

    def boom(*a, **k):
        raise OSError("disk full")

    monkeypatch.setattr(Q, "write_json_lines", boom)
    with pytest.raises(OSError):
        Q.write_bad_records(df, scratch_dir(spark, "bad"))
    assert calls["unpersist"] == 1


def test_sql_condition_and_column_condition(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert Q.filter_sql(df, "id > 1").count() == 2
    target = scratch_dir(spark, "bad")
    Q.write_bad_records(df, target, F.col("name") == "Alice")
    assert _lines(spark, target) == ['{"id":1,"name":"Alice"}']
    with pytest.raises(Exception):
        # the reference's placeholder text is not a valid condition
        Q.filter_sql(df, "mock condition").count()


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 5)),
                          st.one_of(st.none(), st.sampled_from(["a", "b"]))), max_size=30))
def test_good_plus_bad_is_input(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    good, bad = Q.split_good_bad(df)
    assert good.count() + bad.count() == len(rows)
    assert bad.count() == sum(1 for r in rows if None in r)
    assert good.where(Q.null_any(df.columns)).count() == 0


def test_quarantine_keeps_microseconds(spark):
    df = spark.sql("SELECT 1 AS id, CAST(NULL AS STRING) AS name, "
                   "TIMESTAMP_NTZ '2024-01-01 00:00:07.179575' AS ts")
    target = scratch_dir(spark, "bad")
    Q.write_bad_records(df, target)
    from sluice.sources.files import read_json
    back = read_json(spark, target, schema=df.schema).collect()[0]
    assert back["ts"].microsecond == 179575


def test_undecidable_rows_stay_good(spark):
    # as with df.filter(condition): only a true condition marks a bad row
    df = spark.createDataFrame([(1, "a"), (None, "b"), (5, "c")], SCHEMA)
    good, bad = Q.split_good_bad(df, "id > 2")
    assert sorted(r["name"] for r in good.collect()) == ["a", "b"]
    assert sorted(r["name"] for r in bad.collect()) == ["c"]
    target = scratch_dir(spark, "bad")
    Q.write_bad_records(df, target, "id > 2")
    assert _lines(spark, target) == ['{"id":5,"name":"c"}']
