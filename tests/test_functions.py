"""Aggregates, bit and angle functions, UDFs, explode."""

import math
import pathlib
import random
import re

import pytest

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from conftest import python_nodes
from sluice.functions.aggregates import (UserAggregate, aggregate_by, register_series_aggregate,
                                         root_sum_squares)
from sluice.functions.udfs import (call, count_ascii_upper, explode_column, explode_rows, explode_rows_by,
                                   leading_digit, register_udf)


def test_user_aggregate_matches_brute_force_with_hot_key(spark):
    rnd = random.Random(5)
    rows = [("hot" if rnd.random() < 0.4 else f"k{rnd.randrange(20)}",
             None if rnd.random() < 0.05 else rnd.uniform(-10, 10)) for _ in range(5000)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    got = {r["k"]: r["rss"] for r in aggregate_by(df, ["k"], root_sum_squares("v")).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "v"])
    exp = pdf.groupby("k")["v"].apply(lambda s: math.sqrt((s.dropna() ** 2).sum()))
    assert set(got) == set(exp.index)
    for k, v in exp.items():
        assert math.isclose(got[k], v, rel_tol=1e-9)


def test_user_aggregate_merges_in_jvm(spark):
    df = spark.createDataFrame([("a", 1.0)], "k string, v double")
    plan = aggregate_by(df, ["k"], root_sum_squares("v"))
    from conftest import plan_text
    text = plan_text(plan)
    assert "MapInPandas" in text and "partial_sum" in text
    assert "FlatMapGroupsInPandas" not in text and "AggregateInPandas" not in text


def test_user_aggregate_custom_min_max(spark):
    from pyspark.sql import types as T

    def reduce(pdf, keys):
        return pdf.groupby(keys, as_index=False).agg(lo=("v", "min"), hi=("v", "max"))

    agg = UserAggregate("span", ["v"], reduce,
                        {"lo": (T.DoubleType(), "min"), "hi": (T.DoubleType(), "max")},
                        lambda b: b["hi"] - b["lo"])
    df = spark.createDataFrame([("a", float(i)) for i in range(100)], "k string, v double")
    assert aggregate_by(df.repartition(5), ["k"], agg).collect()[0]["span"] == 99.0


def test_registered_series_aggregate_in_sql(spark):
    register_series_aggregate(spark, "sluice_test_rss",
                              lambda s: float(math.sqrt((s * s).sum())))
    spark.createDataFrame([("a", 3.0), ("a", 4.0)], "k string, v double") \
         .createOrReplaceTempView("sluice_t")
    assert spark.sql("SELECT sluice_test_rss(v) AS r FROM sluice_t GROUP BY k").collect()[0][0] == 5.0


def test_builtin_aggregates_skip_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    row = df.agg(F.sum_distinct("x").alias("sd"), F.approx_count_distinct("x").alias("ad"),
                 F.count("x").alias("c"), F.avg("x").alias("a")).collect()[0]
    assert (row["sd"], row["ad"], row["c"]) == (3, 2, 3)
    assert math.isclose(row["a"], 4 / 3)
    assert python_nodes(df.agg(F.sum_distinct("x"))) == []


def test_bit_and_angle_functions(spark):
    row = spark.sql("SELECT -1 AS m, 5 AS f, 180.0 AS d").select(
        F.shiftright("m", 1).alias("sr"), F.shiftrightunsigned("m", 1).alias("sru"),
        F.bitwise_not("f").alias("bn"), F.shiftleft("f", 2).alias("sl"),
        F.radians("d").alias("r"), F.degrees(F.lit(math.pi)).alias("g")).collect()[0]
    assert (row["sr"], row["sru"], row["bn"], row["sl"]) == (-1, 2147483647, -6, 20)
    assert math.isclose(row["r"], math.pi) and math.isclose(row["g"], 180.0)


def test_monotonic_ids_unique(spark):
    ids = spark.range(0, 1000, numPartitions=7).select(F.monotonically_increasing_id().alias("m"))
    got = [r["m"] for r in ids.collect()]
    assert len(set(got)) == 1000 and min(got) >= 0


def test_udfs(spark):
    df = spark.createDataFrame([("1-URGENT Ab",), ("x",), (None,)], "t string")
    register_udf(spark, "sluice_test_digit", leading_digit)
    rows = df.select(count_ascii_upper("t").alias("u"),
                     call("sluice_test_digit", "t").alias("d")).collect()
    assert [(r["u"], r["d"]) for r in rows] == [(7, 1), (0, None), (None, None)]
    assert spark.sql("SELECT sluice_test_digit('5-LOW') AS d").collect()[0]["d"] == 5


def test_explode_forms(spark):
    df = spark.createDataFrame([(1, "a b"), (2, ""), (3, None)], "id int, t string")
    words = explode_column(df, F.split("t", " "), "w", keep=("id",))
    assert sorted(tuple(r) for r in words.collect()) == [(1, "a"), (1, "b"), (2, "")]
    empty = spark.createDataFrame([(1, [])], "id int, a array<int>")
    assert explode_column(empty, F.col("a"), "x").count() == 0
    rows = explode_rows(df, ["id"], [[F.lit("x"), F.col("id") * 10], [F.lit("y"), F.col("id")]],
                        ["kind", "v"])
    assert rows.count() == 6
    assert python_nodes(rows) == []


def test_no_deprecated_names_in_library():
    # fixed values: deprecated API names whose replacements the library uses
    old = ["approxCountDistinct", "bitwiseNOT", "shiftLeft(", "shiftRight(", "sumDistinct",
           "toDegrees", "toRadians", "registerTempTable", "createExternalTable", "callUDF",
           "monotonicallyIncreasingId", "jsonFile", "jsonRDD", "parquetFile", "applySchema"]
    root = pathlib.Path(__file__).resolve().parents[1] / "sluice"
    text = "\n".join(p.read_text() for p in root.rglob("*.py"))
    for name in old:
        assert not re.search(re.escape(name), text), name


def test_user_aggregate_keeps_null_keys(spark):
    rows = [(None, 3.0), (None, 4.0), ("a", 1.0), ("a", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(3)
    got = {r["k"]: r["rss"] for r in aggregate_by(df, ["k"], root_sum_squares("v")).collect()}
    assert got == {None: 5.0, "a": 1.0}


def test_series_aggregate_in_two_steps_and_its_bound(spark):
    rows = [("a", float(i), i) for i in range(50)] + [("b", 2.0, 0)]
    spark.createDataFrame(rows, "k string, v double, i int").createOrReplaceTempView("sluice_rss_v")
    register_series_aggregate(spark, "sluice_bound_rss", lambda x: float((x * x).sum() ** 0.5),
                              max_rows=20)
    salted = spark.sql("SELECT k, sluice_bound_rss(p) AS r FROM (SELECT k, sluice_bound_rss(v) AS p "
                       "FROM sluice_rss_v GROUP BY k, i % 5) GROUP BY k").collect()
    expected = math.sqrt(sum(i * i for i in range(50)))
    assert {r["k"]: round(r["r"], 9) for r in salted} == {"a": round(expected, 9), "b": 2.0}
    with pytest.raises(Exception, match="at most 20"):
        spark.sql("SELECT k, sluice_bound_rss(v) FROM sluice_rss_v GROUP BY k").collect()


def test_explode_rows_by_any_count(spark):
    df = spark.createDataFrame([(1, 3), (2, 0), (3, None), (4, 1)], "id int, n int")
    rows = F.when(F.col("n") > 0, F.transform(F.sequence(F.lit(1), F.col("n")),
                                              lambda i: F.struct(i.alias("i"))))
    out = explode_rows_by(df, ["id"], rows)
    assert sorted(tuple(r) for r in out.collect()) == [(1, 1), (1, 2), (1, 3), (4, 1)]
    assert python_nodes(out) == []


def test_capitals_are_counted_on_arrow_data(spark):
    texts = ["AB", "before", None, "", "éÀZ", "x" * 10, "Q" * 9_000_000, None]
    own = pa.array(texts, pa.string())
    expected = [None if t is None else len(re.findall("[A-Z]", t)) for t in texts]
    assert count_ascii_upper.func(own).to_pylist() == expected
    assert count_ascii_upper.func(own.slice(2)).to_pylist() == expected[2:]
    assert count_ascii_upper.func(own.cast(pa.large_string())).to_pylist() == expected
    assert count_ascii_upper.func(own.slice(0, 0)).to_pylist() == []
