"""K4 over partitioned folders, and ties of registry versions."""

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import plan_text
from sluice.operators import registry
from sluice.sources import catalog

SCHEMA = T.StructType([T.StructField("p", T.IntegerType()), T.StructField("id", T.LongType()),
                       T.StructField("q", T.StringType()), T.StructField("odd `name`", T.StringType())])


def _rows(spark, n, shift=0):
    return spark.range(n).select((F.col("id") % 5 + shift).cast("int").alias("p"), "id",
                                 F.when(F.col("id") % 2 == 0, "a b").otherwise("c'd").alias("q"),
                                 F.lit("x").alias("odd `name`"))


def _name():
    return f"sluice_part_{uuid.uuid4().hex[:8]}"


@pytest.fixture()
def table(spark, tmp_path):
    path, name = str(tmp_path / "it's here"), _name()
    _rows(spark, 100).write.partitionBy("p", "q").parquet(path)
    yield name, path, catalog.partitioned_table(spark, name, path, SCHEMA, ["p", "q"])
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_partitions_are_discovered_and_recovered(spark, table):
    name, path, df = table
    assert df.columns == ["id", "odd `name`", "p", "q"] and df.schema["p"].dataType == T.IntegerType()
    assert sorted((r["id"], r["p"], r["q"]) for r in df.collect()) == sorted(
        (r["id"], r["p"], r["q"]) for r in _rows(spark, 100).collect())
    assert spark.catalog.getTable(name).tableType == "EXTERNAL"
    _rows(spark, 10, shift=70).write.mode("append").partitionBy("p", "q").parquet(path)
    again = catalog.recover_partitions(spark, name)
    assert again.count() == 110 and again.where("p >= 70").count() == 10
    spark.sql(f"DROP TABLE {name}")
    assert spark.read.parquet(path).count() == 110  # the files stay


def test_filters_and_joins_prune_folders(spark, table):
    name, _, df = table
    fixed = df.where("p = 3")
    assert "PartitionFilters: [isnotnull(p" in plan_text(fixed) and fixed.count() == 20
    side = spark.createDataFrame([(1, "keep"), (4, "drop")], "p int, tag string")
    joined = df.join(side.where("tag = 'keep'"), "p")
    assert "dynamicpruning" in plan_text(joined)
    assert sorted(r["id"] for r in joined.collect()) == [i for i in range(100) if i % 5 == 1]


def test_wrong_partitions_are_refused(spark, table, tmp_path):
    name, path, _ = table
    for given, of, message in ((name, ["p"], "exists"), (_name(), ["nope"], "no such"), (_name(), [], "no partition")):
        with pytest.raises(ValueError, match=message):
            catalog.partitioned_table(spark, given, path, SCHEMA, of)


def test_repeated_versions_go_to_the_larger_id(spark):
    rows = [("s", 2, 5, "b"), ("s", 2, 9, "a"), ("s", 1, 99, "z"), ("t", 1, 3, "x"), ("t", 1, 3, "y")]
    df = spark.createDataFrame(rows, "subject string, version int, id int, schema_json string")
    for parts in (1, 4):
        got = sorted(tuple(r) for r in registry.latest_schemas(df.repartition(parts)).collect())
        assert got == [("s", 2, 9, "a"), ("t", 1, 3, "y")]
