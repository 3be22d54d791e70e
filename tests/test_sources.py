"""Reader and catalog variants."""

import pytest
from pyspark.sql import types as T

from conftest import SF_SMALL
from sluice.operators import decode as D
from sluice.operators import registry as G
from sluice.plans.tables import table
from sluice.session import scratch_dir
from sluice.sources import catalog, files


def test_rows_to_frame_binds_by_position(spark):
    schema = T.StructType([T.StructField("b", T.StringType()), T.StructField("a", T.LongType())])
    rdd = spark.sparkContext.parallelize([("x", 1), ("y", 2)])
    df = files.rows_to_frame(spark, rdd, schema)
    assert [tuple(r) for r in df.orderBy("a").collect()] == [("x", 1), ("y", 2)]
    assert df.schema == schema


def test_rows_to_frame_binds_a_dataframe_in_the_jvm(spark):
    from conftest import python_nodes
    schema = T.StructType([T.StructField("b.x", T.StringType()), T.StructField("a", T.LongType())])
    rows = spark.createDataFrame([(1, 2), (3, 4)], "a int, b int")
    df = files.rows_to_frame(spark, rows, schema)
    assert sorted(tuple(r) for r in df.collect()) == [("1", 2), ("3", 4)]
    assert [f.dataType for f in df.schema.fields] == [T.StringType(), T.LongType()]
    assert python_nodes(df) == []
    with pytest.raises(ValueError):
        files.rows_to_frame(spark, rows.select("a"), schema)


def test_json_inference_ignores_nulls_and_malformed_texts(spark):
    from conftest import python_nodes
    docs = ['{"k": 3, "s": "a", "d": 1.5, "n": null, "o": {"p q": [1, 2]}}', None, '{"k": ',
            '{"k": 4, "m": true}']
    df = spark.createDataFrame(list(enumerate(docs)), "id int, doc string")
    out = files.parse_json_strings(spark, df, "doc", keep=("id",))
    assert dict(out.dtypes) == {"id": "int", "k": "bigint", "s": "string", "d": "double",
                                "n": "string", "o": "struct<p q:array<bigint>>", "m": "boolean"}
    assert {r["id"]: r["k"] for r in out.collect()} == {0: 3, 1: None, 2: None, 3: 4}
    assert python_nodes(out) == []
    nothing = files.parse_json_strings(spark, df.where("doc IS NULL"), "doc", keep=("id",))
    assert nothing.columns == ["id"] and nothing.count() == 1
    with pytest.raises(ValueError):
        files.parse_json_strings(spark, spark.createDataFrame([("[1]",)], "doc string"), "doc")


def test_external_table_never_drops_a_managed_table(spark):
    path = scratch_dir(spark, "ext")
    table(spark, SF_SMALL, "region").write.parquet(path)
    spark.sql("DROP TABLE IF EXISTS sluice_managed")
    spark.range(10).write.saveAsTable("sluice_managed")
    try:
        for replace in (False, True):
            with pytest.raises(ValueError):
                catalog.external_table(spark, "sluice_managed", path, replace=replace)
        assert spark.table("sluice_managed").count() == 10
    finally:
        spark.sql("DROP TABLE sluice_managed")
    catalog.external_table(spark, "sluice_ext_again", path, source="parquet")
    with pytest.raises(ValueError):
        catalog.external_table(spark, "sluice_ext_again", path, source="parquet")
    catalog.external_table(spark, "sluice_ext_again", path, source="parquet", replace=True)
    assert spark.table("sluice_ext_again").count() == 5
    spark.sql("DROP TABLE sluice_ext_again")
    assert spark.read.parquet(path).count() == 5  # the files stay


def test_json_files_with_and_without_schema(spark):
    path = scratch_dir(spark, "json")
    nation = table(spark, SF_SMALL, "nation")
    nation.write.json(path)
    typed = files.read_json(spark, path, schema=nation.schema)
    assert typed.schema == nation.schema and typed.count() == 25
    inferred = files.read_json(spark, [path], sampling_ratio=0.5)
    assert sorted(inferred.columns) == sorted(nation.columns)
    assert dict(inferred.dtypes)["n_nationkey"] == "bigint"


def test_json_strings_schema_and_inference(spark):
    df = spark.createDataFrame([(1, '{"k": 3, "s": "a"}'), (2, '{"k": 4}')], "id int, doc string")
    typed = files.parse_json_strings(spark, df, "doc", T.StructType([T.StructField("k", T.IntegerType())]),
                                     keep=("id",))
    assert [tuple(r) for r in typed.orderBy("id").collect()] == [(1, 3), (2, 4)]
    inferred = files.parse_json_strings(spark, df, "doc", sampling_ratio=1.0)
    assert sorted(inferred.columns) == ["k", "s"]


def test_parquet_many_paths_and_generic_load(spark):
    p1, p2 = scratch_dir(spark, "p"), scratch_dir(spark, "p")
    spark.range(0, 10).write.parquet(p1)
    spark.range(10, 15).write.parquet(p2)
    assert files.read_parquet(spark, p1, p2).count() == 15
    # default source is parquet
    assert files.load(spark, p1).count() == 10
    assert files.load(spark, p1, fmt="parquet").count() == 10
    assert files.load(spark, fmt="parquet", path=p2, mergeSchema="false").count() == 5
    only = files.load(spark, p1, fmt="parquet", schema="id long")
    assert only.columns == ["id"]


def test_jdbc_arguments_checked(spark):
    with pytest.raises(ValueError):
        files.read_jdbc(spark, "jdbc:none", "t", column="id", lower_bound=0)


def test_external_table_variants(spark):
    path = scratch_dir(spark, "ext")
    table(spark, SF_SMALL, "region").write.parquet(path)
    catalog.external_table(spark, "sluice_ext_default", path)
    catalog.external_table(spark, "sluice_ext_src", path, source="parquet")
    catalog.external_table(spark, "sluice_ext_opts", path, source="parquet", mergeSchema="false")
    schema = T.StructType([T.StructField("r_regionkey", T.IntegerType()),
                           T.StructField("r_name", T.StringType())])
    catalog.external_table(spark, "sluice_ext_schema", path, source="parquet", schema=schema)
    # each call registers a new name; see the replacement rules above
    for name in ("sluice_ext_default", "sluice_ext_src", "sluice_ext_opts", "sluice_ext_schema"):
        assert spark.table(name).count() == 5
        assert spark.catalog.getTable(name).tableType == "EXTERNAL"
    assert spark.table("sluice_ext_schema").columns == ["r_regionkey", "r_name"]


def test_temp_view_sql(spark):
    name = catalog.temp_view(table(spark, SF_SMALL, "nation"), "sluice_nation_v")
    n = spark.sql(f"SELECT count(*) AS n FROM {name} WHERE n_regionkey = 0").collect()[0]["n"]
    assert n == table(spark, SF_SMALL, "nation").where("n_regionkey = 0").count()


def test_older_writer_fields_resolve_by_name(spark):
    # records written under version 1 decode under the latest version 2:
    # the field added in version 2 is null, order follows the latest schema
    v1 = '{"type": "record", "name": "R", "fields": [{"name": "a", "type": "int"}]}'
    v2 = ('{"type": "record", "name": "R", "fields": [{"name": "b", "type": ["null", "string"]},'
          ' {"name": "a", "type": "int"}]}')
    reg = spark.createDataFrame([("t-value", 1, 1, v1), ("t-value", 2, 2, v2)],
                                "subject string, version int, id int, schema_json string")
    latest = G.latest_schema_text(reg, G.value_subject("t"))
    vals = spark.createDataFrame([("t", 0, 0, b'{"a": 1}'), ("t", 0, 1, b'{"a": 2, "b": "x"}')],
                                 "topic string, partition int, offset long, value binary")
    out = D.decode_json(vals, latest).orderBy("offset")
    assert out.columns == ["topic", "partition", "offset", "b", "a"]
    assert [(r["b"], r["a"]) for r in out.collect()] == [(None, 1), ("x", 2)]
