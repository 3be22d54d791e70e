"""S1/A1 over a segmented log: bounds, files and times come from its index."""

import datetime as dt
import random

import pytest

from conftest import plan_text
from sluice.operators.offsets import end_offset_map
from sluice.sources import records as R
from sluice.sources.segments import SegmentedLog

TOP = (1 << 63) - 1
T0 = dt.datetime(2024, 1, 1)


def _rows(seed=1):
    """A compacted log (offsets have gaps) whose timestamps are not in order;
    one log partition holds most records."""
    rng = random.Random(seed)
    out = []
    for topic, p, n in (("a", 0, 900), ("a", 1, 60), ("b.c-d_e", 0, 40), ("b.c-d_e", 3, 1)):
        offset = rng.randrange(5)
        for i in range(n):
            out.append((topic, p, offset, T0 + dt.timedelta(minutes=i + rng.randrange(-30, 30))))
            offset += rng.choice([1, 1, 1, 7])
    return out


def _frame(spark, rows):
    df = spark.createDataFrame([(f"k{o}", "v", t, p, o, ts) for t, p, o, ts in rows],
                               "key string, value string, topic string, partition int, offset long, ts timestamp_ntz")
    return df.selectExpr("cast(key as binary) key", "cast(value as binary) value", "topic", "partition", "offset",
                         "ts as timestamp", "0 as timestampType")


@pytest.fixture(scope="module")
def rows():
    return _rows()


@pytest.fixture(scope="module")
def log(spark, rows, tmp_path_factory):
    first, second = _frame(spark, rows[:500]), _frame(spark, rows[500:])
    made = SegmentedLog(spark, str(tmp_path_factory.mktemp("log") / "my log+100%"), first.schema)
    return made.append(first, segment_records=50).append(second.limit(0)).append(second, segment_records=50)


def _expected(rows, ranges):
    return sorted((t, p, o) for t, p, o, _ in rows for rt, rp, a, b in ranges if (t, p) == (rt, rp) and a <= o < b)


def _got(df):
    return sorted(tuple(r) for r in df.select("topic", "partition", "offset").collect())


def test_index_lists_every_record_once(log, rows):
    index = log.index().collect()
    assert sum(r["n"] for r in index) == len(rows) and all(0 < r["n"] <= 50 for r in index)
    by = {}
    for r in sorted(index, key=lambda r: (r["topic"], r["partition"], r["first_offset"])):
        own = [x for x in rows if x[:2] == (r["topic"], r["partition"]) and r["first_offset"] <= x[2] <= r["last_offset"]]
        assert (len(own), min(x[3] for x in own), max(x[3] for x in own)) == (r["n"], r["first_time"], r["last_time"])
        assert by.get(r[:2], -1) < r["first_offset"]  # runs that do not overlap
        by[r[:2]] = r["last_offset"]
    assert _got(log.records()) == sorted(r[:3] for r in rows)


RANGES = [
    [("a", 0, 0, 100)], [("a", 0, 10, TOP), ("a", 1, 0, TOP)], [("a", 0, 0, 100), ("a", 0, 50, 150)],
    [("a", 0, 5, 5)], [("nowhere", 0, 0, 9)], [("a", 0, 10 ** 9, TOP)], [("b.c-d_e", 3, 0, TOP), ("b.c-d_e", 0, 3, 4)], [],
    [("a", 0, i, i + 2) for i in range(0, 1200, 3)],
]


@pytest.mark.parametrize("ranges", RANGES)
@pytest.mark.parametrize("as_table", [False, True])
def test_ranges_agree_with_brute_force(spark, log, rows, ranges, as_table):
    given = spark.createDataFrame(ranges, R.RANGE_SCHEMA) if as_table else ranges
    assert _got(log.read_ranges(given, bucket_width=64)) == _expected(rows, ranges)
    assert _got(R.read_offset_ranges(log.records(), given, bucket_width=64)) == _expected(rows, ranges)


def test_only_the_segments_of_a_range_are_opened(log, rows):
    ranges = [("a", 0, 200, 230)]
    df = log.read_ranges(ranges)
    opened = df.inputFiles()
    met = [r for r in log.index().collect() if r["topic"] == "a" and r["partition"] == 0
           and r["first_offset"] < 230 and r["last_offset"] >= 200]
    assert len(opened) == len(met) <= 2 < log.index().count()
    text = plan_text(df)
    assert "Join" not in text and "Exchange" not in text and "PushedFilters: [" in text
    assert _got(df) == _expected(rows, ranges)


def test_bounds_and_end_offsets_read_the_index_only(log, rows):
    listed = [("a", 0), ("a", 7)]
    ends = log.end_offsets("a", listed)
    last = {}
    for t, p, o, _ in rows:
        last[t, p] = max(last.get((t, p), 0), o + 1)
    assert end_offset_map(ends) == {("a", 0): last["a", 0], ("a", 1): last["a", 1], ("a", 7): 0}
    assert {(r[0], r[1]): r[3] for r in log.bounds().collect()} == last
    for df in (ends, log.bounds()):
        assert df.inputFiles() and all("/index/" in f for f in df.inputFiles())


def test_open_ranges_of_a_table_do_not_scan_the_log_for_bounds(spark, log, rows):
    ranges = [("b.c-d_e", 0, 7, TOP)]
    df = log.read_ranges(spark.createDataFrame(ranges, R.RANGE_SCHEMA))
    assert _got(df) == _expected(rows, ranges)
    data = [f for f in df.inputFiles() if "/data/" in f]
    assert data and all("partition=0" in f and "b.c-d_e" in f for f in data)


def test_offsets_by_time(spark, log, rows):
    times = [(t, p, T0 + dt.timedelta(minutes=m)) for t, p in (("a", 0), ("a", 1), ("b.c-d_e", 0), ("x", 0))
             for m in (-99, 0, 13, 14, 30, 59, 500, 870, 5000)]
    times += times[:2] + [(None, 0, T0), ("a", 0, None)]
    got = [tuple(r) for r in log.offsets_for_times(times).collect()]
    assert len(got) == len(times)
    for t, p, at, offset in got:
        later = [o for rt, rp, o, ts in rows if (rt, rp) == (t, p) and at is not None and ts >= at]
        assert offset == min(later, default=None), (t, p, at)


def test_few_segments_are_read_for_a_time(log):
    df = log.offsets_for_times([("a", 0, T0 + dt.timedelta(minutes=400))])
    opened = [f for f in df.inputFiles() if "/data/" in f]
    assert 1 <= len(opened) <= 2


def test_a_batch_that_is_not_listed_is_not_read(spark, tmp_path):
    rows = _rows(2)[:80]
    df = _frame(spark, rows)
    log = SegmentedLog(spark, str(tmp_path / "log"), df.schema).append(df)
    df.write.partitionBy("topic", "partition").parquet(f"{log.path}/data/batch=bcutshort")
    assert _got(log.records()) == sorted(r[:3] for r in rows)
    assert _got(log.read_ranges([("a", 0, 0, TOP)])) == sorted(r[:3] for r in rows)


def test_more_spans_than_are_pushed(spark, log, rows, monkeypatch):
    monkeypatch.setattr(R, "MAX_TERMS", 1)
    ranges = [("a", 0, 3, 40), ("a", 1, 0, 9), ("b.c-d_e", 0, 0, TOP)]
    for given in (ranges, spark.createDataFrame(ranges, R.RANGE_SCHEMA)):
        assert _got(log.read_ranges(given)) == _expected(rows, ranges)
        assert _got(R.read_offset_ranges(log.records(), given)) == _expected(rows, ranges)


def test_closed_ranges_need_no_bounds(spark, log, monkeypatch):
    def refused(*_):
        raise AssertionError("the log was scanned for its bounds")
    monkeypatch.setattr(R, "own_bounds", refused)
    ranges = [("a", 0, 0, 100), ("a", 0, 50, 150)]
    assert R.read_offset_ranges(log.records(), spark.createDataFrame(ranges, R.RANGE_SCHEMA)).count()
    assert R.read_offset_ranges(log.records(), ranges).count()
