"""Schema registry as a table (D1), Avro -> Spark schema mapping (D2) and the
Spark schema JSON round trip (D3).

The registry is a table ``(subject, version, id, schema_json)`` -- for example
an export of the registry's ``_schemas`` topic.  The latest version of a
subject is an ordinary aggregate; no HTTP client runs on executors.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VALUE_SUFFIX = "-value"


def value_subject(topic: str) -> str:
    """Subject name of a topic's value schema (topic-name strategy)."""
    return f"{topic}{VALUE_SUFFIX}"


def latest_schemas(registry: DataFrame, subject: str = "subject", version: str = "version",
                   payload: tuple[str, ...] = ("id", "schema_json")) -> DataFrame:
    """One row per subject: the highest version and its payload columns.  Of rows
    that repeat a subject and version the largest payload (the larger id) counts.

    ``max_by`` is a declarative aggregate with map-side partials, so a subject
    with very many versions is still reduced per task before the shuffle.
    """
    packed = F.struct(*[F.col(c) for c in payload])
    return (registry.groupBy(subject)
                    .agg(F.max(version).alias(version),
                         F.max_by(packed, F.struct(F.col(version), packed)).alias("_latest"))
                    .select(subject, version, *[F.col(f"_latest.{c}").alias(c) for c in payload]))


def attach_latest_schema(records: DataFrame, registry: DataFrame,
                         topic_col: str = "topic") -> DataFrame:
    """Adds ``latest_version`` and ``latest_id``: the latest registry version
    of each record's value subject (``<topic>-value``).

    Only ``(subject, version, id)`` is joined, never the schema texts; how is
    left to the optimizer and AQE, which go by measured bytes and split the
    hot key that a topic is.
    """
    latest = latest_schemas(registry, payload=("id",)).select(
        F.col("subject").alias("_subject"), F.col("version").alias("latest_version"),
        F.col("id").alias("latest_id"))
    keyed = records.withColumn("_subject", F.concat(F.col(topic_col), F.lit(VALUE_SUFFIX)))
    return keyed.join(latest, "_subject", "left").drop("_subject")


def latest_schema_text(registry: DataFrame, subject_name: str, subject: str = "subject",
                       version: str = "version", schema_col: str = "schema_json") -> str:
    """Schema text of the latest version of one subject (a single row)."""
    row = (latest_schemas(registry.where(F.col(subject) == subject_name), subject, version,
                          (schema_col,))
           .select(schema_col).first())
    if row is None:
        raise LookupError(f"subject {subject_name!r} not in registry")
    return row[0]


# --------------------------------------------------------------------------
# Avro schema -> Spark type, following spark-avro's public mapping
# --------------------------------------------------------------------------

# Avro primitive type -> Spark SQL type (spark-avro mapping).
_PRIMITIVES = {
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "bytes": T.BinaryType(),
}


def avro_to_spark(schema: str | dict) -> T.StructType:
    """Spark schema of an Avro record schema; the root must be a record."""
    doc = json.loads(schema) if isinstance(schema, str) else schema
    dtype, _ = _convert(doc, {}, (), "")
    if not isinstance(dtype, T.StructType):
        raise TypeError("Avro schema root is not a record")
    return dtype


def _full_name(name: str, namespace: str) -> str:
    """A dotted name is full already; others take the namespace."""
    return name if "." in name or not namespace else f"{namespace}.{name}"


def _convert(node: Any, named: dict[str, Any], stack: tuple[str, ...],
             space: str) -> tuple[T.DataType, bool]:
    """(Spark type, nullable) of one Avro schema node.  ``named``: definitions
    by full name, with the namespace they enclose; ``space``: the enclosing
    namespace, which names without one inherit."""
    if isinstance(node, str):
        if node in _PRIMITIVES:
            return _PRIMITIVES[node], False
        if node == "null":
            return T.NullType(), True
        full = _full_name(node, space)
        if full not in named:
            raise TypeError(f"unknown Avro type {node!r}")
        if full in stack:
            raise TypeError(f"recursive Avro type {node!r} has no Spark equivalent")
        definition, inner = named[full]
        return _convert(definition, named, stack, inner)
    if isinstance(node, list):
        return _union(node, named, stack, space)
    kind = node.get("type")
    full, inner = "", space
    if kind in ("record", "error", "enum", "fixed"):
        name = node.get("name", "")
        if "." in name:
            inner = name.rpartition(".")[0]
        elif "namespace" in node:
            inner = node["namespace"] or ""
        full = _full_name(name, inner)
        # the definition is kept with its own namespace settled
        named[full] = ({**node, "name": full, "namespace": inner}, inner)
    logical = node.get("logicalType")
    if logical == "date" and kind == "int":
        return T.DateType(), False
    if logical in ("timestamp-millis", "timestamp-micros") and kind == "long":
        return T.TimestampType(), False
    if logical in ("local-timestamp-millis", "local-timestamp-micros") and kind == "long":
        return T.TimestampNTZType(), False
    if logical == "decimal" and kind in ("bytes", "fixed"):
        return T.DecimalType(int(node["precision"]), int(node.get("scale", 0))), False
    if kind in ("record", "error"):
        fields = []
        for f in node.get("fields", []):
            ftype, nullable = _convert(f["type"], named, stack + (full,), inner)
            fields.append(T.StructField(f["name"], ftype, nullable))
        return T.StructType(fields), False
    if kind == "enum":
        return T.StringType(), False
    if kind == "fixed":
        return T.BinaryType(), False
    if kind == "array":
        elem, nullable = _convert(node["items"], named, stack, space)
        return T.ArrayType(elem, nullable), False
    if kind == "map":
        val, nullable = _convert(node["values"], named, stack, space)
        return T.MapType(T.StringType(), val, nullable), False
    if isinstance(kind, (str, list, dict)):
        return _convert(kind, named, stack, space)
    raise TypeError(f"cannot map Avro node {node!r}")


def _union(members: list, named: dict[str, Any], stack: tuple[str, ...],
           space: str) -> tuple[T.DataType, bool]:
    has_null = any(m == "null" for m in members)
    rest = [m for m in members if m != "null"]
    if not rest:
        return T.NullType(), True
    if len(rest) == 1:
        dtype, _ = _convert(rest[0], named, stack, space)
        return dtype, has_null
    types = [_convert(m, named, stack, space)[0] for m in rest]
    if all(isinstance(t, (T.IntegerType, T.LongType)) for t in types):
        return T.LongType(), has_null
    if all(isinstance(t, (T.FloatType, T.DoubleType)) for t in types):
        return T.DoubleType(), has_null
    fields = [T.StructField(f"member{i}", t, True) for i, t in enumerate(types)]
    return T.StructType(fields), has_null


# --------------------------------------------------------------------------
# D3: schema JSON round trip
# --------------------------------------------------------------------------

def schema_to_json(schema: T.StructType) -> str:
    return schema.json()


def schema_from_json(text: str) -> T.StructType:
    dtype = T.StructType.fromJson(json.loads(text))
    return dtype


def round_trips(schema: T.StructType) -> bool:
    """True when the schema survives its JSON form unchanged."""
    return schema_from_json(schema_to_json(schema)) == schema
