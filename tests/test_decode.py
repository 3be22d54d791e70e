"""Schema-driven decoding, fixed projection, keys, wire format."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators import decode as D
from test_registry import TEST_RECORD


def _values(spark, docs):
    return spark.createDataFrame(
        [("t", 0, i, None if d is None else d.encode()) for i, d in enumerate(docs)],
        "topic string, partition int, offset long, value binary")


def test_decode_json_by_name_under_avro_schema(spark):
    docs = ['{"field2": 1, "field1": "a"}', '{"field1": null, "field2": 2}',
            '{"field1": "c"}', None, '{"field1": "d", "field2": "x"}', "not json"]
    out = D.decode_json(_values(spark, docs), TEST_RECORD, record_col="rec").orderBy("offset")
    assert out.columns == ["topic", "partition", "offset", "field1", "field2", "rec"]
    rows = [(r["field1"], r["field2"], r["rec"] is None) for r in out.collect()]
    assert rows == [("a", 1, False), (None, 2, False), ("c", None, False),
                    (None, None, True), ("d", None, False), (None, None, False)]


def test_typed_projection_fixture(spark):
    # FIXTURES A.1 sample rows for D5: null stays null (no 0), wrong type -> null
    df = spark.createDataFrame([("a", "1"), (None, "2"), ("c", None), ("d", "x")],
                               "field1 string, field2 string")
    out = D.typed_projection(df, [("field1", "field1", "string"), ("field2", "field2", "int")])
    assert [tuple(r) for r in out.collect()] == [("a", 1), (None, 2), ("c", None), ("d", None)]
    assert out.schema["field2"].dataType == T.IntegerType()


def test_key_as_string(spark):
    df = spark.createDataFrame([("t", 0, 0, b"abc"), ("t", 0, 1, None)],
                               "topic string, partition int, offset long, key binary")
    assert [r["key"] for r in D.key_as_string(df).orderBy("offset").collect()] == ["abc", None]


def test_wire_split_fixture(spark):
    # FIXTURES A.7
    vals = [bytes.fromhex("00000001020661 6263".replace(" ", "")), bytes.fromhex("017A7A"),
            None, bytes.fromhex("00FFFFFFFF00")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "offset long, value binary")
    rows = D.wire_split(df).orderBy("offset").collect()
    assert (rows[0]["magic"], rows[0]["schema_id"], bytes(rows[0]["payload"]), rows[0]["wire_ok"]) \
        == (0, 258, bytes.fromhex("06616263"), True)
    assert rows[1]["wire_ok"] is False and rows[1]["magic"] == 1 and rows[1]["payload"] is None
    assert rows[2]["wire_ok"] is False
    assert rows[3]["schema_id"] == -1 and bytes(rows[3]["payload"]) == b"\x00"


def test_frame_value_round_trip(spark):
    df = spark.createDataFrame([(i, f'{{"k": {i}}}') for i in (0, 7, 70000)],
                               "sid int, doc string")
    framed = df.select("sid", "doc", D.frame_value(F.col("doc"), F.col("sid")).alias("value"))
    rows = D.wire_split(framed).collect()
    for r in rows:
        assert r["wire_ok"] and r["schema_id"] == r["sid"]
        assert bytes(r["payload"]).decode() == r["doc"]


def test_decode_is_not_python(spark):
    from conftest import plan_text, python_nodes
    out = D.decode_json(_values(spark, ['{"field1": "a", "field2": 1}']), TEST_RECORD)
    assert python_nodes(out) == [] and "from_json" in plan_text(out)


def test_writer_schemas_found_by_id(spark):
    recs = spark.createDataFrame([(i, f'{{"k": {i}}}', 7 if i % 2 else 9) for i in range(20)],
                                 "offset long, doc string, sid int")
    framed = D.wire_split(recs.select("offset", D.frame_value(F.col("doc"), F.col("sid"))
                                      .alias("value")))
    reg = spark.createDataFrame([("t-value", 1, 7, "s7"), ("t-value", 2, 9, "s9"),
                                 ("t-value", 3, 11, "s11")],
                                "subject string, version int, id int, schema_json string")
    assert D.writer_schemas(framed, reg) == {7: "s7", 9: "s9"}


def test_decode_nested_avro_declared_schema(spark):
    import json
    schema = json.dumps({"type": "record", "name": "Outer", "fields": [
        {"name": "id", "type": "long"},
        {"name": "tags", "type": {"type": "array", "items": "string"}},
        {"name": "attrs", "type": {"type": "map", "values": "int"}},
        {"name": "inner", "type": ["null", {"type": "record", "name": "Inner",
                                            "fields": [{"name": "x", "type": "double"}]}]}]})
    docs = ['{"id": 1, "tags": ["a", "b"], "attrs": {"k": 2}, "inner": {"x": 1.5}}',
            '{"id": 2, "tags": [], "attrs": {}, "inner": null}']
    out = D.decode_json(_values(spark, docs), schema).orderBy("offset").collect()
    assert (out[0]["id"], out[0]["tags"], out[0]["attrs"], out[0]["inner"]["x"]) == \
        (1, ["a", "b"], {"k": 2}, 1.5)
    assert (out[1]["tags"], out[1]["attrs"], out[1]["inner"]) == ([], {}, None)


def _framed(spark):
    good = bytes.fromhex("0000000007") + b'{"field1": "a", "field2": 1}'
    values = [good, None, b"\x00\x00", b"\x01" + good[1:], b"\x00\x00\x00\x00\x63" + good[5:],
              good[:5] + b"{not json", good[:5], good[:5] + b"5"]
    return spark.createDataFrame([("t", 0, i, v) for i, v in enumerate(values)],
                                 "topic string, partition int, offset long, value binary")


def _registry(spark):
    return spark.createDataFrame([("t-value", 1, 7, TEST_RECORD)],
                                 "subject string, version int, id int, schema_json string")


def test_every_record_is_decoded_or_rejected(spark):
    good, bad = D.decode_or_reject(_framed(spark), _registry(spark), TEST_RECORD)
    assert [(r["offset"], r["field1"], r["field2"], r["schema_id"]) for r in good.collect()] == \
        [(0, "a", 1, 7)]
    reasons = {r["offset"]: r["reason"] for r in bad.collect()}
    assert reasons == {1: D.NULL_VALUE, 2: D.SHORT_HEADER, 3: D.MAGIC_BYTE, 4: D.UNKNOWN_ID,
                       5: D.UNPARSABLE, 6: D.UNPARSABLE, 7: D.UNPARSABLE}


def test_writer_schemas_decode_their_own_partition(spark):
    def as_json(records, writer, reader, value_col, keep):
        return D.decode_json(records, reader, value_col, keep)

    good, bad = D.decode_by_schema_id(_framed(spark), _registry(spark), TEST_RECORD, decode=as_json)
    assert sorted(r["offset"] for r in good.collect()) == [0, 5, 6, 7]
    assert {r["offset"]: r["reason"] for r in bad.collect()} == {
        1: D.NULL_VALUE, 2: D.SHORT_HEADER, 3: D.MAGIC_BYTE, 4: D.UNKNOWN_ID}


def test_no_known_schema_all_rejected(spark):
    nothing = _registry(spark).limit(0)
    good, bad = D.decode_by_schema_id(_framed(spark), nothing, TEST_RECORD)
    assert good.columns == ["topic", "partition", "offset", "field1", "field2"]
    assert good.count() == 0 and bad.count() == 8
