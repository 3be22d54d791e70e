"""Driver contract: entry smoke check, query/oracle agreement at sf0.001."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from sluice.plans.queries import QUERIES
from conftest import SF_SMALL, python_nodes

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["partition", "n_records", "n_bad", "end_offset"]
    assert sum(r["n_records"] for r in rows) == 1000
    assert all(r["end_offset"] == r["n_records"] for r in rows)
    # rows without a user have no partition: all of them are bad
    assert [r["n_bad"] == r["n_records"] for r in rows if r["partition"] is None] == [True]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())


def _norm(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return tuple(_norm(x) for x in v.tolist())
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) & set(QUERIES)))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    order = [df.columns.index(c) for c in sorted(ocols)]
    oorder = [ocols.index(c) for c in sorted(ocols)]
    got = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in df.collect())
    exp = sorted(repr(tuple(_norm(r[i]) for i in oorder)) for r in res.fetchall())
    assert got == exp


# queries whose plan must stay in the JVM (no Python execution node)
JVM_ONLY = ["kafka_offset_range", "kafka_offset_range_overlap", "latest_schema", "wire_split",
            "sql_filter", "null_any", "end_offsets", "approx_distinct", "sum_distinct",
            "builtin_aggs", "decode_dynamic", "replace_chars", "split_tokens", "bit_ops",
            "registry_decode", "key_to_string", "decode_fixed", "schema_round_trip", "preview",
            "record_inspect", "generic_load", "generic_load_default", "temp_view",
            "explode_col", "explode_rows", "explode_rows_dynamic", "degrees_radians", "row_ids",
            "kafka_offset_range_table", "records_with_schema", "json_strings_infer"]


@pytest.mark.parametrize("name", JVM_ONLY)
def test_plan_has_no_python(spark, name):
    assert python_nodes(E.queries()[name](spark, SF_SMALL)) == []


def test_filter_and_projection_reach_the_scan(spark):
    from conftest import plan_text
    text = plan_text(E.queries()["parquet_read"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate" in text
    assert not math.isnan(0.0)


def test_events_log_built_once_and_rebuilt_if_gone(spark, tmp_path):
    from sluice.plans import tables
    first = tables.events_log(spark, SF_SMALL)
    key = tables.events_log_key(spark, SF_SMALL)
    path, schema = tables._LOGS[key]
    assert tables.events_log(spark, SF_SMALL).count() == first.count() == 1000
    assert tables._LOGS[key][0] == path  # reused, not rebuilt
    # a memo entry whose folder is gone is rebuilt
    tables._LOGS[key] = (str(tmp_path / "missing"), schema)
    assert tables.events_log(spark, SF_SMALL).count() == 1000
    assert tables._LOGS[key][0] not in (path, str(tmp_path / "missing"))


def test_offset_range_read_is_one_pruned_scan(spark):
    from conftest import plan_text
    df = E.queries()["kafka_offset_range"](spark, SF_SMALL)
    df.collect()  # final adaptive plan
    text = plan_text(df)
    assert "PartitionFilters: [" in text and "partition" in text.split("PartitionFilters: [")[1]
    pushed = text.split("PushedFilters: [")[1].split("]")[0]
    assert "offset" in pushed
    # the log is neither shuffled nor sorted: the ranges are what moves
    assert "hashpartitioning" not in text.split("== Initial Plan")[0]
    assert "SortMergeJoin" not in text.split("Initial Plan")[0]


def test_a_changed_input_is_a_new_log(spark, tmp_path):
    import shutil

    import pyarrow.parquet as pq

    from sluice.plans import tables
    folder = tmp_path / "sf"
    folder.mkdir()
    shutil.copyfile(f"{SF_SMALL}/events.parquet", folder / "events.parquet")
    assert tables.events_log(spark, str(folder)).count() == 1000
    pq.write_table(pq.read_table(f"{SF_SMALL}/events.parquet").slice(0, 7), folder / "events.parquet")
    assert tables.events_log(spark, str(folder)).count() == 7


def test_scratch_is_empty_after_release(spark):
    from sluice import session
    before = list(session._SCRATCH)
    session._SCRATCH.clear()
    try:
        E.queries()["ingest_summary"](spark, SF_SMALL).collect()
        made = list(session._SCRATCH)
        there = lambda p: (path := spark._jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(
            spark._jsc.hadoopConfiguration()).exists(path)
        assert made and any(there(p) for p in made)
        session.release_scratch(spark)
        assert not any(there(p) for p in made) and session._SCRATCH == []
    finally:
        session._SCRATCH.extend(before)
