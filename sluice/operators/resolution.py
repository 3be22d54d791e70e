"""Avro schema resolution as Column expressions.

Records written under one schema and read under another are resolved by the
rules of the Avro specification: fields by name or by the reader's aliases,
defaults for fields the writer lacks, numeric promotion, string and bytes for
each other, records inside records, arrays, maps, enums and unions.
:func:`resolve` compiles the two schemas once, on the driver, to an expression
over a value of the writer's Spark type; rows are read by generated code.

What only a record's data can show to be wrong gives null where it stands: a
null, or a union branch or enum symbol, that the reader has no place for.  What
the schemas show raises :class:`SchemaResolutionError`.
"""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.registry import _PRIMITIVES, _full_name, avro_to_spark


class SchemaResolutionError(ValueError):
    """No record written under the one schema can be read under the other."""


# What a writer's primitive may be read as, beside itself.
PROMOTIONS = {
    "int": ("long", "float", "double"),
    "long": ("float", "double"),
    "float": ("double",),
    "string": ("bytes",),
    "bytes": ("string",),
}

NAMED = ("record", "error", "enum", "fixed")


def expanded(schema: str | dict) -> Any:
    """The schema with every reference to a named type replaced by its
    definition, names full, and primitives but null as ``{"type": name}``."""
    doc = json.loads(schema) if isinstance(schema, str) else schema
    return _expand(doc, {}, (), "")


def _expand(node: Any, named: dict, stack: tuple, space: str) -> Any:
    if isinstance(node, str):
        if node == "null":
            return node
        if node in _PRIMITIVES:
            return {"type": node}
        full = _full_name(node, space)
        if full not in named:
            raise TypeError(f"unknown Avro type {node!r}")
        if full in stack:
            raise TypeError(f"recursive Avro type {node!r} has no Spark equivalent")
        return _expand(*named[full][:1], named, stack, named[full][1])
    if isinstance(node, list):
        return [_expand(m, named, stack, space) for m in node]
    kind = node["type"]
    if kind in NAMED:
        name = node["name"]
        inner = name.rpartition(".")[0] if "." in name else node.get("namespace", space) or ""
        full = _full_name(name, inner)
        named[full] = ({**node, "name": full}, inner)
        out = {**node, "name": full, "aliases": [_full_name(a, inner) for a in node.get("aliases", [])]}
        out.pop("namespace", None)
        if kind in ("record", "error"):
            out["fields"] = [{**f, "type": _expand(f["type"], named, stack + (full,), inner)}
                             for f in node["fields"]]
        return out
    if kind == "array":
        return {**node, "items": _expand(node["items"], named, stack, space)}
    if kind == "map":
        return {**node, "values": _expand(node["values"], named, stack, space)}
    if isinstance(kind, (dict, list)) or kind not in _PRIMITIVES:
        return _expand(kind, named, stack, space)
    return node


def nullable(dtype: T.DataType) -> T.DataType:
    """``dtype`` with nulls allowed everywhere: what decoding can promise."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType)) for f in dtype])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(nullable(dtype.elementType))
    if isinstance(dtype, T.MapType):
        return T.MapType(dtype.keyType, nullable(dtype.valueType))
    return dtype


def spark_type(node: Any) -> T.DataType:
    return nullable(avro_to_spark({"type": "record", "name": "_", "fields": [
        {"name": "v", "type": node}]})["v"].dataType)


def resolve(value: Column, writer: str | dict, reader: str | dict) -> Column:
    """``value``, of the writer's Spark type, as a value of the reader's (with
    nulls allowed everywhere)."""
    w, r = expanded(writer), expanded(reader)
    return _resolve(value, w, r).cast(spark_type(r))


def _short(name: str) -> str:
    return name.rpartition(".")[2]


def _same_name(w: dict, r: dict) -> bool:
    return _short(w["name"]) in {_short(r["name"]), *map(_short, r.get("aliases", []))}


def _kind(node: Any) -> str:
    if isinstance(node, str):
        return node
    return "union" if isinstance(node, list) else "record" if node["type"] == "error" else node["type"]


def _members(union: list) -> list:
    return [m for m in union if _kind(m) != "null"]


def _flat(union: list) -> dict | None:
    """What a union of one kind of value is to Spark: that value."""
    members = _members(union)
    kinds = {_kind(m) for m in members}
    if len(members) == 1:
        return members[0]
    if members and not any("logicalType" in m for m in members):
        if kinds <= {"int", "long"}:
            return {"type": "long"}
        if kinds <= {"float", "double"}:
            return {"type": "double"}
    return None


def _null(node: Any) -> Column:
    return F.lit(None).cast(spark_type(node))


def _resolve(value: Column, w: Any, r: Any) -> Column:
    wk, rk = _kind(w), _kind(r)
    if wk == "union":
        return _from_union(value, w, r)
    if rk == "union":
        return _into_union(value, w, r)
    if wk == "null":
        if rk != "null":
            raise SchemaResolutionError(f"null is read as {rk}")
        return _null(r)
    if wk in ("record", "enum", "fixed") and wk == rk and not _same_name(w, r):
        raise SchemaResolutionError(f"{w['name']} is read as {r['name']}")
    if wk == rk == "record":
        return F.when(value.isNotNull(), F.struct(*_fields(value, w, r)))
    if wk == rk == "enum":
        symbol = F.when(value.isin(r["symbols"]), value)
        return F.coalesce(symbol, F.when(value.isNotNull(), F.lit(r["default"]))) if "default" in r else symbol
    if wk == rk == "array":
        return F.transform(value, lambda x: _resolve(x, w["items"], r["items"]).cast(spark_type(r["items"])))
    if wk == rk == "map":
        return F.transform_values(value, lambda _, x: _resolve(x, w["values"], r["values"])
                                  .cast(spark_type(r["values"])))
    if wk == rk == "fixed" and w["size"] != r["size"]:
        raise SchemaResolutionError(f"{w['name']} has another size")
    if spark_type(w) == spark_type(r):
        return value
    if rk == "null" or "logicalType" in w or "logicalType" in r or rk not in PROMOTIONS.get(wk, ()):
        raise SchemaResolutionError(f"{_said(w)} is read as {_said(r)}")
    return value.cast(spark_type(r))


def _said(node: Any) -> str:
    if isinstance(node, dict):
        return node.get("logicalType") or node.get("name") or _kind(node)
    return _kind(node)


def _fields(value: Column, w: dict, r: dict) -> list[Column]:
    by_name = {f["name"]: f for f in w["fields"]}
    out = []
    for f in r["fields"]:
        own = next((by_name[n] for n in (f["name"], *f.get("aliases", [])) if n in by_name), None)
        if own is not None:
            try:
                made = _resolve(value.getField(own["name"]), own["type"], f["type"])
            except SchemaResolutionError as exc:
                raise SchemaResolutionError(f"{f['name']}: {exc}") from None
        elif "default" in f:
            made = default(f["type"], f["default"])
        else:
            raise SchemaResolutionError(f"{f['name']}: not written, and no default")
        out.append(made.cast(spark_type(f["type"])).alias(f["name"]))
    return out


def _from_union(value: Column, w: list, r: Any) -> Column:
    flat = _flat(w)
    if flat is not None:
        return _resolve(value, flat, r)
    members = _members(w)
    if not members:
        return _resolve(_null("null"), "null", r)
    found, faults = [], []
    for i, m in enumerate(members):
        own = value.getField(f"member{i}")
        try:
            found.append(F.when(own.isNotNull(), _resolve(own, m, r).cast(spark_type(r))))
        except SchemaResolutionError as exc:
            faults.append(str(exc))
    if not found:
        raise SchemaResolutionError("; ".join(faults))
    return F.coalesce(*found)


def _into_union(value: Column, w: Any, r: list) -> Column:
    if _kind(w) == "null":
        if not any(_kind(m) == "null" for m in r):
            raise SchemaResolutionError("null is read as a union without null")
        return _null(r)
    members = _members(r)
    # the branch of the same kind, else the first that can be promoted to
    for same in (True, False):
        for i, m in enumerate(members):
            if same != (_kind(m) == _kind(w)):
                continue
            try:
                return _in_branch(_resolve(value, w, m), r, i)
            except SchemaResolutionError:
                continue
    raise SchemaResolutionError(f"{_said(w)} is in no branch of the union")


def _in_branch(made: Column, union: list, at: int) -> Column:
    if _flat(union) is not None:
        return made
    members = _members(union)
    cells = [(made if i == at else F.lit(None)).cast(spark_type(m)).alias(f"member{i}")
             for i, m in enumerate(members)]
    return F.when(made.isNotNull(), F.struct(*cells))


EPOCH = dt.datetime(1970, 1, 1)


def default(node: Any, value: Any) -> Column:
    """The JSON default ``value`` of a field of type ``node``, as a literal."""
    kind = _kind(node)
    if kind == "null":
        return _null(node)
    if kind == "union":
        members = [m for m in node if _kind(m) != "null"]
        if value is None:
            return _null(node)
        for i, m in enumerate(members):
            try:
                return _in_branch(default(m, value), node, i)
            except SchemaResolutionError:
                continue
        raise SchemaResolutionError(f"default {value!r} is in no branch of the union")
    made = _literal(node, kind, value)
    if made is None:
        raise SchemaResolutionError(f"default {value!r} is not of type {_said(node)}")
    return made.cast(spark_type(node))


def _literal(node: dict, kind: str, value: Any) -> Column | None:
    logical = node.get("logicalType")
    if kind == "boolean":
        return F.lit(value) if isinstance(value, bool) else None
    if kind in ("int", "long"):
        if isinstance(value, bool) or not isinstance(value, int):
            return None
        if logical == "date":
            return F.lit(EPOCH.date() + dt.timedelta(days=value))
        if logical in ("timestamp-millis", "timestamp-micros"):
            return (F.timestamp_millis if logical.endswith("millis") else F.timestamp_micros)(F.lit(value).cast("long"))
        if logical in ("local-timestamp-millis", "local-timestamp-micros"):
            unit = "milliseconds" if logical.endswith("millis") else "microseconds"
            return F.lit((EPOCH + dt.timedelta(**{unit: value})).isoformat(" "))
        return F.lit(value)
    if kind in ("float", "double"):
        return F.lit(float(value)) if isinstance(value, (int, float)) and not isinstance(value, bool) else None
    if kind == "enum":
        return F.lit(value) if value in node["symbols"] else None
    if kind == "string":
        return F.lit(value) if isinstance(value, str) else None
    if kind in ("bytes", "fixed"):
        if not isinstance(value, str) or any(ord(c) > 255 for c in value):
            return None
        raw = value.encode("latin-1")  # Avro's JSON form of bytes
        if logical == "decimal":
            scale = int(node.get("scale", 0))
            return F.lit(str(Decimal(int.from_bytes(raw, "big", signed=True)).scaleb(-scale)))
        return F.lit(raw) if kind == "bytes" or len(raw) == node["size"] else None
    if kind == "array":
        return F.array(*[default(node["items"], x) for x in value]) if isinstance(value, list) else None
    if not isinstance(value, dict):
        return None
    if kind == "map":
        pairs = [c for k, v in value.items() for c in (F.lit(k), default(node["values"], v))]
        return F.create_map(*pairs) if pairs else F.from_json(F.lit("{}"), spark_type(node))
    missing = [f["name"] for f in node["fields"] if f["name"] not in value and "default" not in f]
    if missing:
        return None
    return F.struct(*[default(f["type"], value.get(f["name"], f.get("default"))).alias(f["name"])
                      for f in node["fields"]])
