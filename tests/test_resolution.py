"""Avro's resolution rules, one by one, and against a plain reader."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import python_nodes
from sluice.operators import decode as D
from sluice.operators import registry
from sluice.operators.resolution import PROMOTIONS, SchemaResolutionError, expanded, nullable, resolve, spark_type


def rec(*fields, name="R", **more):
    return {"type": "record", "name": name, "fields": [
        {"name": n, "type": t, **(f[0] if f else {})} for n, t, *f in fields], **more}


def read(spark, values, writer, reader):
    """``values`` (rows of the writer's type) as the reader sees them."""
    df = spark.createDataFrame([(v,) for v in values], T.StructType([
        T.StructField("v", nullable(registry.avro_to_spark(writer)))])).select(resolve(F.col("v"), writer, reader).alias("v"))
    assert nullable(df.schema["v"].dataType) == nullable(registry.avro_to_spark(reader))
    return [None if r["v"] is None else r["v"].asDict(recursive=True) for r in df.collect()]


def test_fields_by_name_alias_order_and_default(spark):
    writer = rec(("a", "int"), ("b", "string"), ("gone", "string"))
    reader = rec(("x", "string", {"aliases": ["none", "b"]}), ("a", "int"), ("n", "int", {"default": 5}),
                 ("u", ["null", "string"], {"default": None}))
    assert read(spark, [(1, "s", "g"), (None, None, None), None], writer, reader) == [
        {"x": "s", "a": 1, "n": 5, "u": None}, {"x": None, "a": None, "n": 5, "u": None}, None]


@pytest.mark.parametrize("w, r, value, seen", [
    ("int", "long", 2 ** 31 - 1, 2 ** 31 - 1), ("int", "float", 3, 3.0), ("int", "double", 3, 3.0),
    ("long", "float", 3, 3.0), ("long", "double", 2 ** 40, float(2 ** 40)), ("float", "double", 0.5, 0.5),
    ("string", "bytes", "é", "é".encode()), ("bytes", "string", "é".encode(), "é")])
def test_promotions(spark, w, r, value, seen):
    assert read(spark, [(value,)], rec(("a", w)), rec(("a", r))) == [{"a": seen}]
    assert r in PROMOTIONS[w]


@pytest.mark.parametrize("w, r", [
    ("long", "int"), ("double", "float"), ("string", "int"), ("boolean", "int"), ("null", "int"), ("int", "null"),
    ({"type": "int", "logicalType": "date"}, "int"), ({"type": "array", "items": "long"}, {"type": "array", "items": "int"}),
    ({"type": "fixed", "name": "F", "size": 2}, {"type": "fixed", "name": "F", "size": 3}),
    ({"type": "enum", "name": "E", "symbols": ["A"]}, {"type": "enum", "name": "G", "symbols": ["A"]}),
    (rec(("x", "int"), name="P"), rec(("y", "int"), name="P")), (["int", "string"], "boolean"), ("string", ["null", "int"]),
    ("null", ["int", "string"])])
def test_what_cannot_be_read(w, r):
    with pytest.raises(SchemaResolutionError):
        resolve(F.lit(None), rec(("a", w)), rec(("a", r)))


def test_names_and_defaults_are_checked():
    with pytest.raises(SchemaResolutionError, match="no default"):
        resolve(F.lit(None), rec(("a", "int")), rec(("b", "int")))
    with pytest.raises(SchemaResolutionError, match="read as"):
        resolve(F.lit(None), rec(("a", "int"), name="R"), rec(("a", "int"), name="S"))
    resolve(F.lit(None), rec(("a", "int"), name="x.R"), rec(("a", "int"), name="S", namespace="y", aliases=["R"]))
    for bad in ("x", True, 1.5, [1], {"a": 1}):
        with pytest.raises(SchemaResolutionError, match="default"):
            resolve(F.lit(None), rec(), rec(("b", "int", {"default": bad})))


def test_unions(spark):
    one, many = rec(("a", ["null", "int"])), rec(("a", ["null", "string", "int"]))
    assert read(spark, [(3,), (None,)], one, rec(("a", "long"))) == [{"a": 3}, {"a": None}]
    assert read(spark, [(3,), (None,)], rec(("a", "int")), rec(("a", ["string", "double"]))) == [
        {"a": {"member0": None, "member1": 3.0}}, {"a": None}]
    both = [({"member0": "s", "member1": None},), ({"member0": None, "member1": 4},), (None,)]
    assert read(spark, both, many, rec(("a", ["long", "string", "null"]))) == [
        {"a": {"member0": None, "member1": "s"}}, {"a": {"member0": 4, "member1": None}}, {"a": None}]
    # a branch that the reader has no place for is null; the exact kind comes before a promotion
    assert read(spark, both, many, rec(("a", "string"))) == [{"a": "s"}, {"a": None}, {"a": None}]
    assert read(spark, [(1,)], rec(("a", "int")), rec(("a", ["double", "int", "string"]))) == [
        {"a": {"member0": None, "member1": 1, "member2": None}}]


def test_nested(spark):
    inner_w, inner_r = rec(("x", "int"), name="P"), rec(("y", "long", {"aliases": ["x"]}), ("z", "int", {"default": 0}), name="P")
    writer = rec(("l", {"type": "array", "items": ["null", inner_w]}), ("m", {"type": "map", "values": "P"}))
    reader = rec(("l", {"type": "array", "items": ["null", inner_r]}), ("m", {"type": "map", "values": "P"}))
    assert read(spark, [([(1,), None], {"k": (2,)}), ([], None)], writer, reader) == [
        {"l": [{"y": 1, "z": 0}, None], "m": {"k": {"y": 2, "z": 0}}}, {"l": [], "m": None}]


def test_enums(spark):
    def e(symbols, **more):
        return {"type": "enum", "name": "E", "symbols": symbols, **more}
    rows = [("A",), ("B",), (None,)]
    assert read(spark, rows, rec(("a", e(["A", "B"]))), rec(("a", e(["A", "C"], default="C")))) == [
        {"a": "A"}, {"a": "C"}, {"a": None}]
    assert read(spark, rows, rec(("a", e(["A", "B"]))), rec(("a", e(["A"])))) == [{"a": "A"}, {"a": None}, {"a": None}]


def test_every_kind_of_default(spark):
    fields = [
        ("b", "boolean", True, True), ("l", "long", 2 ** 40, 2 ** 40), ("f", "float", 1, 1.0), ("d", "double", 0.25, 0.25),
        ("s", "string", "é", "é"), ("y", "bytes", "ÿ\u0001", b"\xff\x01"),
        ("x", {"type": "fixed", "name": "X", "size": 2}, "ab", b"ab"),
        ("e", {"type": "enum", "name": "E", "symbols": ["A", "B"]}, "B", "B"),
        ("a", {"type": "array", "items": "int"}, [1, 2], [1, 2]), ("a0", {"type": "array", "items": "int"}, [], []),
        ("m", {"type": "map", "values": "long"}, {"k": 1}, {"k": 1}), ("m0", {"type": "map", "values": "long"}, {}, {}),
        ("r", rec(("p", "int"), ("q", "string", {"default": "dflt"}), name="I"), {"p": 4}, {"p": 4, "q": "dflt"}),
        ("u", ["null", "int"], None, None), ("v", ["int", "null"], 3, 3),
        ("w", ["string", "int"], "x", {"member0": "x", "member1": None}),
        ("dt", {"type": "int", "logicalType": "date"}, 1, dt.date(1970, 1, 2)),
        ("ts", {"type": "long", "logicalType": "timestamp-millis"}, 1500, dt.datetime(1970, 1, 1, 0, 0, 1, 500_000)),
        ("lt", {"type": "long", "logicalType": "local-timestamp-micros"}, 7, dt.datetime(1970, 1, 1, 0, 0, 0, 7)),
        ("dec", {"type": "bytes", "logicalType": "decimal", "precision": 5, "scale": 2}, "ÿ\u009c", Decimal("-1.00"))]
    reader = rec(*[(n, t, {"default": v}) for n, t, v, _ in fields])
    with_tz = spark.conf.get("spark.sql.session.timeZone")
    assert with_tz == "UTC"
    got = read(spark, [()], rec(), reader)[0]
    local = got.pop("ts").astimezone(dt.timezone.utc).replace(tzinfo=None)
    assert local == dict((n, s) for n, _, _, s in fields)["ts"]
    assert got == {n: s for n, _, _, s in fields if n != "ts"}


def test_references_and_namespaces():
    schema = {"type": "record", "name": "A", "namespace": "n", "fields": [
        {"name": "p", "type": {"type": "record", "name": "P", "fields": [{"name": "k", "type": "int"}]}},
        {"name": "q", "type": ["null", "n.P"]}, {"name": "r", "type": "P"}]}
    fields = {f["name"]: f["type"] for f in expanded(schema)["fields"]}
    assert fields["p"]["name"] == fields["r"]["name"] == fields["q"][1]["name"] == "n.P"
    assert spark_type(fields["q"]) == spark_type(fields["p"])
    with pytest.raises(TypeError, match="recursive"):
        expanded({"type": "record", "name": "L", "fields": [{"name": "next", "type": ["null", "L"]}]})


_NUMBERS = ["int", "long", "float", "double"]


def plain_read(value, writer, reader):
    """The same rules over Python values, for records of numbers and records."""
    own = {f["name"]: f for f in writer["fields"]}
    out = {}
    for f in reader["fields"]:
        name = next((n for n in (f["name"], *f.get("aliases", [])) if n in own), None)
        if name is None:
            out[f["name"]] = f["default"]
        elif isinstance(f["type"], dict):
            out[f["name"]] = plain_read(value[name], own[name]["type"], f["type"])
        else:
            out[f["name"]] = float(value[name]) if f["type"] in ("float", "double") else value[name]
    return out


@st.composite
def schema_pairs(draw, depth=0):
    names = draw(st.lists(st.sampled_from("abcdef"), min_size=1, max_size=4, unique=True))
    written, wanted, value = [], [], {}
    for n in names:
        if depth < 2 and draw(st.booleans()) and draw(st.booleans()):
            w, r, v = draw(schema_pairs(depth=depth + 1))
            value[n] = v
        else:
            i = draw(st.integers(0, 3))
            w, r = _NUMBERS[i], draw(st.sampled_from(_NUMBERS[i:]))
            v = value[n] = draw(st.integers(-1000, 1000))
            value[n] = float(v) if w in ("float", "double") else v
        written.append({"name": n, "type": w})
        action = draw(st.integers(0, 3))
        if action == 0:
            wanted.append({"name": n.upper(), "aliases": ["zz", n], "type": r})
        elif action < 3:
            wanted.append({"name": n, "type": r})
    wanted.append({"name": "extra", "type": "long", "default": 9})
    wanted = draw(st.permutations(wanted))
    kind = f"R{depth}"
    return {"type": "record", "name": kind, "fields": written}, {"type": "record", "name": kind, "fields": list(wanted)}, value


@settings(max_examples=25, deadline=None)
@given(schema_pairs())
def test_agrees_with_a_plain_reader(spark, pair):
    writer, reader, value = pair
    assert read(spark, [value], writer, reader) == [plain_read(value, writer, reader)]


def _topic(spark):
    payloads = [(1, {"id": 1, "kind": "a"}), (2, {"id": 2, "kind": None, "score": 1.5}), (3, {"other": 1}),
                (5, {"id": 3, "kind": "c"}), (1, None), (2, "x"), (99, {"id": 9})]
    rows = [("t", 0, i, sid, None if p is None else json.dumps(p)) for i, (sid, p) in enumerate(payloads)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long, sid int, doc string")
    return df.select("topic", "partition", "offset", D.frame_value(F.col("doc"), F.col("sid")).alias("value"))


V1 = rec(("id", "int"), ("kind", "string"))
V2 = rec(("id", "long"), ("kind", ["null", "string"]), ("score", "float"))
V3 = rec(("other", "int"))
LATEST = rec(("key", "long", {"aliases": ["id"]}), ("kind", ["null", "string"]), ("score", "double", {"default": -1.0}))


@pytest.mark.parametrize("subject", [None, "t-value"])
def test_versions_of_a_topic_in_one_pass(spark, subject):
    reg = spark.createDataFrame([("t-value", i, i, json.dumps(s)) for i, s in ((1, V1), (2, V2), (3, V3), (5, V1))],
                                "subject string, version int, id int, schema_json string")
    good, bad = D.decode_by_schema_id(_topic(spark), reg, json.dumps(LATEST), subject=subject)
    assert good.columns == ["topic", "partition", "offset", "key", "kind", "score"]
    assert sorted((r["offset"], r["key"], r["kind"], r["score"]) for r in good.collect()) == [
        (0, 1, "a", -1.0), (1, 2, None, 1.5), (3, 3, "c", -1.0)]
    assert {r["offset"]: r["reason"] for r in bad.collect()} == {
        2: D.UNRESOLVED, 4: D.NULL_VALUE, 5: D.UNPARSABLE, 6: D.UNKNOWN_ID}
    from conftest import plan_text
    text = plan_text(good)
    assert "Exchange" not in text and "Join" not in text and python_nodes(good) == []
