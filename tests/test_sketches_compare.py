"""A2 by merged sketches, S9 dataset comparison, S5 without loss."""

import datetime as dt
import json
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import plan_text, python_nodes
from sluice.functions import sketches as K
from sluice.operators import compare as C
from sluice.sources import files

D0 = dt.date(2024, 1, 1)


def _events(spark, rows):
    return spark.createDataFrame([(k, None if d is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=d, hours=5), v)
                                  for k, d, v in rows], "k string, ts timestamp_ntz, v long")


def test_ranges_are_answered_from_the_daily_table(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(12), rng.randrange(30_000)) for _ in range(20_000)]
    rows += [("a", 3, None), ("none", 4, None), ("a", None, 5)]
    daily = K.daily_sketches(_events(spark, rows), ["k"], "ts", F.col("v"))
    path = str(tmp_path / "daily")
    K.write_days(daily, path)
    table = K.read_days(spark, path, daily)
    assert table.count() == len({(k, d) for k, d, _ in rows})
    ranges = [(1, 0, 11), (2, 3, 3), (3, -400, 400), (4, 50, 60), (5, 5, 2)]
    asked = spark.createDataFrame([(i, D0 + dt.timedelta(days=a), D0 + dt.timedelta(days=b)) for i, a, b in ranges],
                                  "range_id int, first_day date, last_day date")
    out = K.distinct_over(table, ["k"], asked)
    got = {(r["range_id"], r["k"]): (r["n"], r["distinct"]) for r in out.collect()}
    expected = {}
    for i, a, b in ranges:
        for k, d, v in rows:
            if d is not None and a <= d <= b:
                n, values = expected.setdefault((i, k), [0, set()])
                expected[i, k][0] = n + 1
                if v is not None:
                    values.add(v)
    assert set(got) == set(expected)
    for key, (n, values) in expected.items():
        assert got[key][0] == n
        assert abs(got[key][1] - len(values)) <= max(1, 4 * K.relative_error() * len(values)), key
    assert "NestedLoop" not in plan_text(out) and "Cartesian" not in plan_text(out)


def test_a_day_written_again_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "daily")
    first = K.daily_sketches(_events(spark, [("a", 0, 1), ("a", 1, 2)]), ["k"], "ts", F.col("v"))
    K.write_days(first, path)
    K.write_days(K.daily_sketches(_events(spark, [("a", 1, 3), ("a", 1, 4)]), ["k"], "ts", F.col("v")), path)
    asked = spark.createDataFrame([(1, D0, D0 + dt.timedelta(days=9))], "range_id int, first_day date, last_day date")
    row = K.distinct_over(K.read_days(spark, path, first), ["k"], asked).first()
    assert (row["n"], row["distinct"]) == (3, 3)


# -- comparison ----------------------------------------------------------------

DDL = "i int, s string, d double, m map<string,int>"


def plain_difference(left, right, key=None):
    freeze = lambda r: (r[0], r[1], r[2], None if r[3] is None else tuple(sorted(r[3].items())))
    a, b = Counter(map(freeze, left)), Counter(map(freeze, right))
    missing, surplus = a - b, b - a
    out = []
    if key is not None:
        by = {}
        for side, some in ((0, missing), (1, surplus)):
            for r, n in some.items():
                by.setdefault(r[key], ([], []))[side].append((r, n))
        for m, s in by.values():
            if len(m) == len(s) == 1 and m[0][1] == s[0][1]:
                out.append(("changed", m[0][1], m[0][0], s[0][0]))
                del missing[m[0][0]], surplus[s[0][0]]
    out += [("missing", n, r, None) for r, n in missing.items()]
    out += [("surplus", n, None, r) for r, n in surplus.items()]
    return sorted(out, key=repr)


def _found(df):
    def row(r):
        return None if r is None else (r["i"], r["s"], r["d"], None if r["m"] is None else tuple(
            sorted((e["key"], e["value"]) for e in r["m"])))
    return sorted(((r["status"], r["times"], row(r["before"]), row(r["after"])) for r in df.collect()), key=repr)


_ROW = st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.sampled_from(["", "x"])),
                 st.sampled_from([0.0, 1.5]), st.one_of(st.none(), st.just({"k": 1, "a": 2}), st.just({})))


@settings(max_examples=12, deadline=None)
@given(st.lists(_ROW, max_size=8), st.lists(_ROW, max_size=8))
def test_difference_agrees_with_counters(spark, left, right):
    a, b = spark.createDataFrame(left, DDL), spark.createDataFrame(right, DDL)
    assert _found(C.difference(a, b)) == plain_difference(left, right)
    assert _found(C.difference(a, b, keys=["i"])) == plain_difference(left, right, 0)


def test_order_partitions_and_signed_zeros_do_not_matter(spark):
    rows = [(i % 7, str(i % 3), float(i % 2), {"b": 1, "a": i % 2}) for i in range(500)] + [(1, "z", 0.0, None)]
    a = spark.createDataFrame(rows, DDL)
    b = spark.createDataFrame([*rows[:-1][::-1], (1, "z", -0.0, None)], DDL).repartition(5)
    assert C.same_rows(a, b.select("m", "d", "i", "s"))
    assert not C.same_rows(a, b.limit(500))
    assert C.same_rows(a.limit(0), b.limit(0)) and not C.same_rows(a.limit(0), b)
    with pytest.raises(ValueError, match="columns differ"):
        C.difference(a, b.drop("m"))
    with pytest.raises(ValueError, match="no such columns"):
        C.difference(a, b.limit(3), keys=["nope"])


def test_what_is_moved_grows_with_the_differences(spark):
    n = 60_000
    a = spark.range(n).selectExpr("id", "id * 7 as v")
    for changed in (1, 10, 40):
        b = a.withColumn("v", F.when(F.col("id") % (n // changed) == 5, -1).otherwise(F.col("v")))
        opened = C.opened_rows(a, b)
        assert 2 * changed <= opened.count() <= 2 * changed + 2
        assert C.difference(a, b, ["id"]).count() == changed
    assert C.opened_rows(a, a.repartition(3)).count() == 0
    text = plan_text(C.difference(a, b, ["id"]))
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_everything_differs(spark):
    a, b = spark.range(20_000).selectExpr("id", "0 as v"), spark.range(20_000).selectExpr("id", "1 as v")
    assert {(r[0], r[1]) for r in C.difference(a, b, ["id"]).groupBy("status").count().collect()} == {("changed", 20_000)}


# -- rescued JSON -----------------------------------------------------------------

SCHEMA = T.StructType([
    T.StructField("a", T.IntegerType()), T.StructField("s", T.StringType()), T.StructField("d", T.DoubleType()),
    T.StructField("n", T.DecimalType(6, 2)), T.StructField("t", T.DateType()), T.StructField("b", T.BooleanType()),
    T.StructField("r", T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y", T.StringType())])),
    T.StructField("l", T.ArrayType(T.IntegerType()))])


@pytest.mark.parametrize("line, typed, rescued, corrupt", [
    ('{"a": 1, "s": "x", "d": 0.5, "n": 1.25, "t": "2024-01-02", "b": true, "r": {"y": "q", "x": 2}, "l": [1, 2]}',
     {"a": 1, "s": "x", "d": 0.5, "t": D0 + dt.timedelta(days=1), "b": True, "l": [1, 2]}, None, False),
    ('{"a": "many", "s": "x"}', {"a": None, "s": "x"}, {"a": "many"}, False),
    ('{"a": 99999999999}', {"a": None}, {"a": "99999999999"}, False),
    ('{"extra": {"k": [1]}, "a": 3}', {"a": 3}, {"extra": '{"k":[1]}'}, False),
    ('{"r": {"x": "no", "y": "q"}}', {}, {"r": '{"x":"no","y":"q"}'}, False),
    ('{"r": {"x": 1, "z": 2}}', {}, {"r": '{"x":1,"z":2}'}, False),
    ('{"l": [1, "two"]}', {}, {"l": '[1,"two"]'}, False),
    ('{"n": 1.23456}', {}, {"n": "1.23456"}, False),
    ('{"t": "no day"}', {"t": None}, {"t": "no day"}, False),
    ('{"a": null, "s": null, "z": null}', {"a": None, "s": None}, {"z": None}, False),
    ('{"a": 1, "a": 2}', {"a": 2}, {"a": "1"}, False),
    ("{}", {"a": None}, None, False),
    ('{"a": 1', {"a": None}, None, True), ("[1, 2]", {"a": None}, None, True), ("7", {"a": None}, None, True),
    ("", {"a": None}, None, True), (None, {"a": None}, None, False)])
def test_nothing_a_line_says_is_lost(spark, line, typed, rescued, corrupt):
    df = spark.createDataFrame([(9, line)], "id int, line string")
    out = files.rescue_json(df, "line", SCHEMA, keep=("id",))
    assert out.columns == ["id", *SCHEMA.names, "_rescued", "_corrupt_record"]
    r = out.first()
    assert r["id"] == 9 and r["_corrupt_record"] == (line if corrupt else None)
    assert {k: r[k] for k in typed} == typed
    assert r["_rescued"] == rescued


def test_rescued_good_and_corrupt_add_up(spark):
    rng = random.Random(4)
    lines = []
    for i in range(400):
        doc = {"a": rng.choice([i, "x", None, 1.5]), "s": rng.choice(["t", 5, {"q": 1}])}
        if i % 3 == 0:
            doc["more"] = i
        text = json.dumps(doc)
        lines.append((i, text[:-2] if i % 11 == 0 else None if i % 17 == 0 else text))
    out = files.rescue_json(spark.createDataFrame(lines, "i int, line string"), "line", SCHEMA, keep=("i",))
    assert python_nodes(out) == []
    by = {r["i"]: r for r in out.collect()}
    assert len(by) == len(lines)
    for i, line in lines:
        r = by[i]
        try:
            doc = json.loads(line) if line is not None else {}
        except ValueError:
            assert r["_corrupt_record"] == line
            continue
        assert r["_corrupt_record"] is None
        left = r["_rescued"] or {}
        for k, v in doc.items():
            text = v if isinstance(v, str) else json.dumps(v, separators=(",", ":"))
            assert k in left and (left[k] == text or v is None) or r[k] == (v if k == "a" else text if v is not None else v)
    with pytest.raises(ValueError, match="there already"):
        files.rescue_json(spark.createDataFrame(lines, "a int, line string"), "line", SCHEMA, keep=("a",))
