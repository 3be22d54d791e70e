"""Latest registry schema, Avro -> Spark mapping, JSON round trip."""

import json

import pytest
from pyspark.sql import types as T

from sluice.operators import registry as G

# The registry test's schema.
TEST_RECORD = json.dumps({"type": "record", "name": "TestRecord",
                          "fields": [{"name": "field1", "type": "string"},
                                     {"name": "field2", "type": "int"}]})


def test_registry_fixture_schema():
    s = G.avro_to_spark(TEST_RECORD)
    assert [(f.name, f.dataType, f.nullable) for f in s.fields] == [
        ("field1", T.StringType(), False), ("field2", T.IntegerType(), False)]
    # the reference test: the schema equals its own JSON round trip
    assert G.round_trips(s)
    assert G.schema_from_json(json.dumps(json.loads(s.json()), indent=2)) == s


def test_latest_version_wins(spark):
    reg = spark.createDataFrame(
        [("test-topic-value", 1, 10, TEST_RECORD.replace("int", "long")),
         ("test-topic-value", 2, 11, TEST_RECORD),
         ("other-value", 5, 12, "{}")],
        "subject string, version int, id int, schema_json string")
    latest = {r["subject"]: (r["version"], r["id"]) for r in G.latest_schemas(reg).collect()}
    assert latest == {"test-topic-value": (2, 11), "other-value": (5, 12)}
    text = G.latest_schema_text(reg, G.value_subject("test-topic"))
    assert G.avro_to_spark(text)["field2"].dataType == T.IntegerType()
    with pytest.raises(LookupError):
        G.latest_schema_text(reg, "missing-value")


@pytest.mark.parametrize("avro, spark_type, nullable", [
    ("boolean", T.BooleanType(), False),
    ("long", T.LongType(), False),
    ("float", T.FloatType(), False),
    ("double", T.DoubleType(), False),
    ("bytes", T.BinaryType(), False),
    (["null", "string"], T.StringType(), True),
    (["int", "long"], T.LongType(), False),
    (["float", "double", "null"], T.DoubleType(), True),
    (["int", "string"], T.StructType([T.StructField("member0", T.IntegerType()),
                                      T.StructField("member1", T.StringType())]), False),
    ({"type": "enum", "name": "E", "symbols": ["A"]}, T.StringType(), False),
    ({"type": "fixed", "name": "F", "size": 4}, T.BinaryType(), False),
    ({"type": "array", "items": "int"}, T.ArrayType(T.IntegerType(), False), False),
    ({"type": "map", "values": ["null", "double"]},
     T.MapType(T.StringType(), T.DoubleType(), True), False),
    ({"type": "int", "logicalType": "date"}, T.DateType(), False),
    ({"type": "long", "logicalType": "timestamp-micros"}, T.TimestampType(), False),
    ({"type": "long", "logicalType": "local-timestamp-millis"}, T.TimestampNTZType(), False),
    ({"type": "bytes", "logicalType": "decimal", "precision": 10, "scale": 2},
     T.DecimalType(10, 2), False),
])
def test_type_mapping(avro, spark_type, nullable):
    s = G.avro_to_spark({"type": "record", "name": "R", "fields": [{"name": "f", "type": avro}]})
    assert s["f"].dataType == spark_type
    assert s["f"].nullable == nullable
    assert G.round_trips(s)


def test_nested_record_and_named_reference():
    inner = {"type": "record", "name": "Inner", "fields": [{"name": "x", "type": "int"}]}
    s = G.avro_to_spark({"type": "record", "name": "Outer", "fields": [
        {"name": "a", "type": inner}, {"name": "b", "type": ["null", "Inner"]}]})
    assert s["a"].dataType == T.StructType([T.StructField("x", T.IntegerType(), False)])
    assert s["b"].nullable and s["b"].dataType == s["a"].dataType


def test_root_must_be_record_and_no_recursion():
    with pytest.raises(TypeError):
        G.avro_to_spark('"string"')
    with pytest.raises(TypeError):
        G.avro_to_spark({"type": "record", "name": "N", "fields": [
            {"name": "next", "type": ["null", "N"]}]})


def test_attach_latest_schema(spark):
    reg = spark.createDataFrame(
        [("a-value", 1, 10, "s1"), ("a-value", 3, 12, "s3"), ("b-value", 1, 20, "t1")],
        "subject string, version int, id int, schema_json string")
    recs = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0), ("c", 0)],
                                 "topic string, offset long")
    out = G.attach_latest_schema(recs, reg)
    got = sorted((r["topic"], r["offset"], r["latest_version"], r["latest_id"])
                 for r in out.collect())
    assert got == [("a", 0, 3, 12), ("a", 1, 3, 12), ("b", 0, 1, 20), ("c", 0, None, None)]
    assert out.columns == ["topic", "offset", "latest_version", "latest_id"]  # no schema texts


def _record(name, fields, **more):
    return {"type": "record", "name": name, "fields":
            [{"name": n, "type": t} for n, t in fields], **more}


def test_nested_types_inherit_the_namespace():
    inner = _record("Inner", [("x", "int")])
    s = G.avro_to_spark(_record("Outer", [("a", inner), ("b", "com.a.Inner"), ("c", "Inner")],
                                namespace="com.a"))
    assert s["a"].dataType == s["b"].dataType == s["c"].dataType
    dotted = G.avro_to_spark(_record("com.a.Outer", [("a", inner), ("b", "com.a.Inner")]))
    assert dotted["a"].dataType == dotted["b"].dataType


def test_namespaced_enum_and_fixed_by_full_name():
    s = G.avro_to_spark(_record("R", [
        ("e", {"type": "enum", "name": "E", "namespace": "n.one", "symbols": ["A"]}),
        ("e2", "n.one.E"),
        ("f", {"type": "fixed", "name": "n.two.F", "size": 4}), ("f2", ["null", "n.two.F"])]))
    assert s["e2"].dataType == T.StringType() and s["f2"].dataType == T.BinaryType()


def test_equal_short_names_in_two_namespaces():
    s = G.avro_to_spark(_record("R", [
        ("a", _record("P", [("x", "int")], namespace="n.one")),
        ("b", _record("P", [("y", "string")], namespace="n.two")),
        ("a2", "n.one.P"), ("b2", "n.two.P")]))
    assert s["a2"].dataType.names == ["x"] and s["b2"].dataType.names == ["y"]
    with pytest.raises(TypeError):
        G.avro_to_spark(_record("R", [("a", _record("P", [("x", "int")], namespace="n")), ("b", "P")]))
