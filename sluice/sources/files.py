"""File, RDD and JDBC sources.

Thin on purpose: these are Spark's current reader APIs, collected here with
the options that make them safe at scale (explicit schemas instead of
inference, partitioned JDBC reads, bounded sampling).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rows_to_frame(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """S3: apply a schema to rows; values bind by position.

    A DataFrame is renamed and cast in the JVM.  An RDD of tuples/Rows is the
    other form; it goes through Python row by row.
    """
    if not isinstance(rows, DataFrame):
        return spark.createDataFrame(rows, schema)
    if len(rows.columns) != len(schema.fields):
        raise ValueError(f"{len(rows.columns)} columns for {len(schema.fields)} fields")
    # positions as names first: neither side's names need be unique or plain
    bare = rows.toDF(*[f"_{i}" for i in range(len(schema.fields))])
    return bare.select(*[F.col(f"_{i}").cast(f.dataType).alias(f.name)
                         for i, f in enumerate(schema.fields)])


def read_json(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None,
              sampling_ratio: float | None = None, **options: str) -> DataFrame:
    """JSON-lines files.  With ``schema`` nothing is inferred; without it
    inference reads ``sampling_ratio`` of the input.  Timestamps are parsed at
    microsecond precision, matching :func:`sluice.operators.quality.write_json_lines`."""
    from sluice.operators.quality import JSON_OPTIONS
    reader = spark.read.option("timestampFormat", JSON_OPTIONS["timestampFormat"]) \
                       .option("timestampNTZFormat", JSON_OPTIONS["timestampNTZFormat"])
    if schema is not None:
        reader = reader.schema(schema)
    if sampling_ratio is not None:
        reader = reader.option("samplingRatio", str(sampling_ratio))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.json(path if isinstance(path, str) else list(path))


# Quoted names stay; variant type names become those of a DDL schema.
_VARIANT_TYPES = re.compile(r"`(?:[^`]|``)*`|\bOBJECT<|\bDECIMAL\(\d+,\s*\d+\)|\bVARIANT\b|\bVOID\b")


def infer_json_schema(strings: DataFrame, column: str,
                      sampling_ratio: float | None = None) -> T.StructType:
    """The schema of the JSON objects in a string column, in the JVM: one
    partial aggregate over ``sampling_ratio`` of the rows.  Null and malformed
    texts have no say; fractions are double, fields of mixed or no type string."""
    rows = strings if sampling_ratio is None or sampling_ratio >= 1 \
        else strings.sample(sampling_ratio, seed=1)
    found = rows.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(column)))).first()[0]
    if found is None or found == "VOID":
        return T.StructType([])
    if not found.startswith("OBJECT<"):
        raise ValueError(f"column {column} holds more than JSON objects: {found}")

    def ddl(part: re.Match) -> str:
        text = part[0]
        if text[0] == "`":
            return text
        return {"OBJECT<": "STRUCT<"}.get(text, "DOUBLE" if text[0] == "D" else "STRING")

    return T.StructType.fromDDL("j " + _VARIANT_TYPES.sub(ddl, found))["j"].dataType


def parse_json_strings(spark: SparkSession, strings: DataFrame, column: str,
                       schema: T.StructType | None = None,
                       sampling_ratio: float | None = None,
                       keep: Sequence[str] = ()) -> DataFrame:
    """JSON documents held in a string column, parsed by ``from_json``
    with the ``keep`` columns carried along.  Without a schema it is inferred
    first (:func:`infer_json_schema`).  A null or malformed text gives nulls."""
    if schema is None:
        schema = infer_json_schema(strings, column, sampling_ratio)
    parsed = strings.select(*keep, F.from_json(F.col(column), schema).alias("_j"))
    return parsed.select(*keep, *[F.col("_j").getField(f.name).alias(f.name)
                                  for f in schema.fields])


RESCUED, CORRUPT = "_rescued", "_corrupt_record"


def rescue_json(strings: DataFrame, column: str, schema: T.StructType,
                keep: Sequence[str] = ()) -> DataFrame:
    """S4/S5 without loss: ``keep``, the fields of ``schema``, ``_rescued`` and
    ``_corrupt_record``; whatever a line says is in one of them.

    ``_rescued`` holds, by name, the raw text of every field that the schema does
    not have, or whose value the field's type does not hold: of another type, out
    of range, rounded, or nested with something left out.  It is null if there is
    none.  ``_corrupt_record`` is the whole line where it is no JSON object, and
    then all fields are null; a null line gives nulls throughout.  Of a field that
    a line repeats, the last value counts and every other one is rescued under its
    name and a number.

    Two JVM parses a line, of the schema's fields and of the raw ones.
    """
    taken = {f.name for f in schema.fields} & {RESCUED, CORRUPT, *keep}
    if taken:
        raise ValueError(f"columns of these names are there already: {sorted(taken)}")
    line = F.col(column)
    parsed = strings.select(
        *keep, line.alias("_line"), F.from_json(line, schema, {"mode": "PERMISSIVE"}).alias("_typed"),
        F.map_entries(F.from_json(line, T.MapType(T.StringType(), T.StringType()))).alias("_raw"),
        F.json_object_keys(line).isNotNull().alias("_object"))

    def held(raw: Column) -> Column:
        """Whether the typed field says all that the raw text does."""
        out = F.lit(False)
        for f in schema.fields:
            own = F.col("_typed").getField(f.name)
            out = F.when(raw["key"] == f.name, F.coalesce(_says(own, raw["value"], f.dataType), F.lit(False))
                         ).otherwise(out)
        return out

    numbered = F.transform(F.col("_raw"), lambda e, i: F.struct(
        e["key"].alias("key"), e["value"].alias("value"), i.alias("at")))
    # entries of one name before this one number it
    named = F.transform(
        F.filter(numbered, lambda e: ~held(e)),
        lambda e: F.struct(F.when(F.exists(numbered, lambda o: (o["key"] == e["key"]) & (o["at"] < e["at"])),
                                  F.concat(e["key"], F.lit("#"), e["at"].cast("string"))).otherwise(e["key"]).alias("key"),
                           e["value"].alias("value")))
    found = parsed.withColumn("_left", F.when(F.col("_object"), named))
    fields = [F.when(F.col("_object"), F.col("_typed").getField(f.name)).alias(f.name) for f in schema.fields]
    return found.select(
        *keep, *fields, F.when(F.size("_left") > 0, F.map_from_entries("_left")).alias(RESCUED),
        F.when(F.col("_line").isNotNull() & ~F.col("_object"), F.col("_line")).alias(CORRUPT))


def _says(typed: Column, raw: Column, kind: T.DataType) -> Column:
    both_null = typed.isNull() & raw.isNull()
    if isinstance(kind, T.StringType):
        return typed.eqNullSafe(raw)
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        exact = "decimal(38,18)" if isinstance(kind, T.DecimalType) else \
            "double" if isinstance(kind, (T.FloatType, T.DoubleType)) else kind.simpleString()
        value = typed.cast(exact) if not isinstance(kind, T.FloatType) else typed.cast("string").cast("double")
        return both_null | (value == raw.try_cast(exact))
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        # the same JSON once both are in one form, fields in one order
        def form(text: Column) -> Column:
            return F.to_json(F.try_parse_json(text))
        return both_null | (form(F.to_json(typed)) == form(raw))
    return both_null | typed.isNotNull()  # dates and timestamps, once they parse


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """One or many parquet paths (column pruning and filter push-down
    reach the scan)."""
    return spark.read.parquet(*paths)


def load(spark: SparkSession, path: str | None = None, fmt: str | None = None,
         schema: T.StructType | str | None = None, **options: str) -> DataFrame:
    """The generic reader; without ``fmt`` the session default
    (``spark.sql.sources.default``, parquet) is used."""
    reader = spark.read
    if fmt:
        reader = reader.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if options:
        reader = reader.options(**options)
    return reader.load(path) if path is not None else reader.load()


def read_jdbc(spark: SparkSession, url: str, table: str, *,
              predicates: Sequence[str] | None = None,
              column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              properties: dict[str, str] | None = None) -> DataFrame:
    """A JDBC table -- whole, one partition per predicate, or range
    partitioned on a numeric column.  The bounds only set the stride of the
    partition ranges; rows outside them are still read (first and last
    partitions are open-ended)."""
    props = dict(properties or {})
    if predicates is not None:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=props)
    if column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("range partitioning needs lower, upper bound and partition count")
        return spark.read.jdbc(url, table, column=column, lowerBound=lower_bound,
                               upperBound=upper_bound, numPartitions=num_partitions,
                               properties=props)
    return spark.read.jdbc(url, table, properties=props)


def read_json_lines_text(spark: SparkSession, path: str) -> DataFrame:
    """The raw lines of every ``*.json`` file below ``path`` (one column
    ``value``), e.g. to compare a quarantine folder with golden lines."""
    return (spark.read.option("pathGlobFilter", "*.json")
                      .option("recursiveFileLookup", "true").text(path))
