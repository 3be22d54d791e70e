"""Record values -> typed columns.

Decoding is a Catalyst expression (``from_json`` / ``from_avro``), never a
Python row function, so it runs inside whole-stage code generation and the
optimizer can prune the decoded fields nobody selects.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.registry import avro_to_spark
from sluice.operators.resolution import SchemaResolutionError, nullable, resolve
from sluice.session import scratch_dir

META_COLUMNS = ("topic", "partition", "offset")
PERMISSIVE = {"mode": "PERMISSIVE"}


def _as_struct(schema: T.StructType | str | dict) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    return avro_to_spark(schema)


def decode_json(records: DataFrame, schema: T.StructType | str | dict,
                value_col: str = "value", keep: Sequence[str] = META_COLUMNS,
                record_col: str | None = None) -> DataFrame:
    """D4 for JSON payloads: every field of ``schema`` by name, in schema order.

    ``schema`` may be a Spark ``StructType`` or an Avro record schema (text or
    dict), converted by D2.  A field missing from the payload is null; a value
    of the wrong type is null; a null or unparsable payload gives a record
    whose fields are all null.  With ``record_col`` the struct is kept whole
    (null for a null payload) next to the expanded fields.
    """
    struct = _as_struct(schema)
    text = F.col(value_col).cast("string")
    rec = F.from_json(text, struct, PERMISSIVE)
    staged = records.select(*keep, rec.alias("_rec"))
    fields = [F.col(f"_rec.{f.name}").alias(f.name) for f in struct.fields]
    extra = [F.col("_rec").alias(record_col)] if record_col else []
    return staged.select(*keep, *fields, *extra)


def decode_avro(records: DataFrame, writer_schema: str, reader_schema: str | None = None,
                value_col: str = "payload", keep: Sequence[str] = META_COLUMNS) -> DataFrame:
    """D4 for Avro payloads, through Spark's ``from_avro`` (spark-avro module).

    ``reader_schema`` (the latest registry version) is applied as the Avro
    reader schema, so records written with an older schema resolve by field
    name.  Malformed payloads become null records (PERMISSIVE).
    """
    try:
        from pyspark.sql.avro.functions import from_avro
    except ImportError as exc:  # pragma: no cover - depends on the install
        raise RuntimeError("pyspark.sql.avro is not available") from exc
    opts = dict(PERMISSIVE)
    if reader_schema:
        opts["avroSchema"] = reader_schema
    struct = avro_to_spark(reader_schema or writer_schema)
    staged = records.select(*keep, from_avro(F.col(value_col), writer_schema, opts).alias("_rec"))
    return staged.select(*keep, *[F.col(f"_rec.{f.name}").alias(f.name) for f in struct.fields])


def writer_schemas(framed: DataFrame, registry: DataFrame) -> dict[int, str]:
    """``{schema id: schema text}`` for the writer schema ids present in
    wire-format records (output of :func:`wire_split`).

    The distinct ids are found by an aggregate (a topic carries few of them)
    and joined to the registry on the executors; only the matching registry
    rows -- one per id -- reach the driver.
    """
    ids = framed.where("wire_ok").select("schema_id").distinct()
    found = ids.join(registry.select(F.col("id").alias("schema_id"), "schema_json"),
                     "schema_id").distinct()
    return {r["schema_id"]: r["schema_json"] for r in found.collect()}


# Why a record is rejected.
NULL_VALUE = "null value"
SHORT_HEADER = "short header"
MAGIC_BYTE = "magic byte"
UNKNOWN_ID = "unknown schema id"
UNPARSABLE = "unparsable payload"
UNRESOLVED = "unresolvable schema"


def reject_reason(split: DataFrame, registry: DataFrame, value_col: str = "value") -> DataFrame:
    """Adds ``reason`` to the output of :func:`wire_split`: why its header or
    schema id is bad, or null.  ``registry`` has the known ``id``s; only those
    are joined."""
    known = registry.select(F.col("id").cast("int").alias("_known")).where(
        "_known IS NOT NULL").distinct()
    v = F.col(value_col)
    reason = (F.when(v.isNull(), NULL_VALUE).when(F.length(v) < 5, SHORT_HEADER)
               .when(F.col("magic") != 0, MAGIC_BYTE).when(F.col("_known").isNull(), UNKNOWN_ID))
    return (split.join(known, split["schema_id"] == known["_known"], "left")
                 .withColumn("reason", reason).drop("_known"))


def decode_or_reject(records: DataFrame, registry: DataFrame, schema: T.StructType | str | dict,
                     value_col: str = "value", keep: Sequence[str] = META_COLUMNS
                     ) -> tuple[DataFrame, DataFrame]:
    """Wire-format JSON records -> ``(good, bad)``; every record is in one.

    ``good``: ``keep``, ``schema_id`` and the fields of ``schema`` by name;
    ``bad``: ``keep``, ``schema_id``, the raw value and a ``reason``: null
    value, short header, wrong magic byte, an id the registry does not have,
    or a payload that is no JSON object.  A field of the wrong type is null,
    as in :func:`decode_json`.
    """
    flagged = reject_reason(wire_split(records, value_col), registry, value_col)
    readable = F.json_object_keys(F.col("payload").cast("string")).isNotNull()
    flagged = flagged.withColumn("reason", F.when(F.col("reason").isNotNull(), F.col("reason"))
                                 .when(~readable, UNPARSABLE))
    good = decode_json(flagged.where("reason IS NULL"), schema, "payload", (*keep, "schema_id"))
    bad = flagged.where("reason IS NOT NULL").select(*keep, "schema_id", value_col, "reason")
    return good, bad


def json_value(payload: Column, writer_schema: str) -> tuple[Column, Column]:
    """A JSON payload as a value of the writer's Spark type, and whether it is
    a JSON object at all."""
    text = payload.cast("string")
    return F.from_json(text, avro_to_spark(writer_schema), PERMISSIVE), F.json_object_keys(text).isNotNull()


def avro_value(payload: Column, writer_schema: str) -> tuple[Column, Column]:
    """The same for an Avro payload (spark-avro module); a malformed one is null."""
    from pyspark.sql.avro.functions import from_avro
    value = from_avro(payload, writer_schema, PERMISSIVE)
    return value, value.isNotNull()


def decode_by_schema_id(records: DataFrame, registry: DataFrame, reader_schema: str,
                        keep: Sequence[str] = META_COLUMNS,
                        decode: Callable[..., DataFrame] | None = None, subject: str | None = None,
                        value_of: Callable[[Column, str], tuple[Column, Column]] = json_value
                        ) -> tuple[DataFrame, DataFrame]:
    """Topics written with several schema versions -> ``(good, bad)``.

    Every writer schema is compiled with the reader's to one expression
    (:func:`sluice.operators.resolution.resolve`: defaults, aliases, promotion),
    and a record's schema id picks it: one pass over the records, nothing is
    shuffled or written.  ``registry`` has rows ``subject, id, schema_json``;
    with ``subject`` its versions are the writers, else the ids that occur are
    looked up first (an aggregate over the records' headers).  Ids that share a
    schema text share an expression.

    ``good``: ``keep`` and the reader's fields; ``bad``: ``keep``,
    ``schema_id``, the raw value and why: the reasons of :func:`reject_reason`,
    a payload that ``value_of`` cannot read, or a writer whose schema cannot be
    resolved (no default for a field it lacks, say).

    A ``decode(records, writer_schema, reader_schema, value_col, keep)`` of frames
    takes the place of all this: see :func:`_decode_parts`.
    """
    if decode is not None:
        return _decode_parts(records, registry, reader_schema, keep, decode)
    split = wire_split(records)
    if subject is None:
        writers = writer_schemas(split, registry)
    else:
        # one row per version of the subject
        writers = {r["id"]: r["schema_json"] for r in
                   registry.where(F.col("subject") == subject).select("id", "schema_json").collect()}
    ids: dict[str, list[int]] = {}
    for sid, text in sorted(writers.items()):
        ids.setdefault(text, []).append(sid)
    fields = avro_to_spark(reader_schema)
    # first the writers' values, so that each payload is parsed once
    parsed, made, unresolved = [], [], []
    for i, (text, own) in enumerate(ids.items()):
        mine = F.col("schema_id").isin(own)
        try:
            made.append((own, resolve(F.col(f"_value{i}"), text, reader_schema), i))
        except SchemaResolutionError:
            unresolved += own
            continue
        value, readable = value_of(F.when(mine, F.col("payload")), text)
        parsed += [value.alias(f"_value{i}"), readable.alias(f"_readable{i}")]
    staged = split.select("*", *parsed)
    v = F.col("value")
    reason = (F.when(v.isNull(), NULL_VALUE).when(F.length(v) < 5, SHORT_HEADER)
               .when(F.col("magic") != 0, MAGIC_BYTE)
               .when(~F.col("schema_id").isin(list(writers)), UNKNOWN_ID)
               .when(F.col("schema_id").isin(unresolved), UNRESOLVED))
    record = F.lit(None).cast(nullable(fields))
    for own, value, i in made:
        mine = F.col("schema_id").isin(own)
        reason = reason.when(mine & ~F.coalesce(f"_readable{i}", F.lit(False)), UNPARSABLE)
        record = F.when(mine, value).otherwise(record)
    # a generator keeps the optimizer from copying the parsing into filter and fields
    judged = staged.select(*keep, "schema_id", "value", F.inline(F.array(F.struct(
        reason.alias("reason"), record.alias("_record")))))
    good = judged.where("reason IS NULL").select(
        *keep, *[F.col("_record").getField(f.name).alias(f.name) for f in fields])
    return good, judged.where("reason IS NOT NULL").select(*keep, "schema_id", "value", "reason")


def _decode_parts(records: DataFrame, registry: DataFrame, reader_schema: str, keep: Sequence[str],
                  decode: Callable[..., DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The split records are written once, partitioned by schema id, to the
    shared folder; each writer schema that occurs decodes its own partition.  A
    payload that ``decode`` cannot read becomes a record of nulls (PERMISSIVE)."""
    spark = records.sparkSession
    path = scratch_dir(spark, "by-schema")
    flagged = reject_reason(wire_split(records), registry)
    split = (flagged.withColumn("_part", F.when(F.col("reason").isNull(), F.col("schema_id"))
                                .otherwise(F.lit(None).cast("int"))))
    split.write.partitionBy("_part").parquet(path)
    split = spark.read.schema(split.schema).parquet(path)
    good = split.where("_part IS NOT NULL")
    parts = [decode(good.where(F.col("_part") == sid), text, reader_schema, "payload", keep)
             for sid, text in sorted(writer_schemas(good, registry).items())]
    if not parts:
        fields = [F.lit(None).cast(f.dataType).alias(f.name)
                  for f in avro_to_spark(reader_schema).fields]
        parts = [good.limit(0).select(*keep, *fields)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out, split.where("_part IS NULL").select(*keep, "schema_id", "value", "reason")


# --------------------------------------------------------------------------
# Fixed projection and string normalisation
# --------------------------------------------------------------------------

def typed_projection(df: DataFrame, fields: Sequence[tuple[str | Column, str, str]],
                     keep: Sequence[str] = ()) -> DataFrame:
    """Pick fields by name and give each a type: ``(source, name, type)``.

    ``try_cast`` turns a value of the wrong type into null rather than failing
    the job (ANSI mode) or inventing 0; the null then marks a bad record.
    """
    cols = []
    for src, name, dtype in fields:
        c = F.col(src) if isinstance(src, str) else src
        cols.append(c.try_cast(dtype).alias(name))
    return df.select(*keep, *cols)


def key_as_string(records: DataFrame, keep: Sequence[str] = META_COLUMNS) -> DataFrame:
    """D6 on the record key: bytes -> UTF-8 string (null stays null)."""
    return records.select(*keep, F.col("key").cast("string").alias("key"))


# --------------------------------------------------------------------------
# Wire format  [magic byte 0][4-byte big-endian schema id][payload]
# --------------------------------------------------------------------------

def frame_value(payload: Column, schema_id: Column) -> Column:
    """Build a wire-format value from a payload and an int schema id."""
    header = F.concat(F.unhex(F.lit("00")),
                      F.unhex(F.lpad(F.hex(schema_id.cast("int")), 8, "0")))
    return F.concat(header, payload.cast("binary"))


def wire_split(records: DataFrame, value_col: str = "value") -> DataFrame:
    """Adds ``magic``, ``schema_id``, ``payload`` and ``wire_ok``.

    ``wire_ok`` is false for a null value, a value shorter than the 5-byte
    header or a magic byte other than 0; such records are bad records.
    """
    v = F.col(value_col)
    magic = F.conv(F.hex(F.substring(v, 1, 1)), 16, 10).cast("int")
    unsigned = F.conv(F.hex(F.substring(v, 2, 4)), 16, 10).cast("long")
    # the id is a signed 32-bit integer
    sid = F.when(unsigned >= 2 ** 31, unsigned - 2 ** 32).otherwise(unsigned).cast("int")
    ok = v.isNotNull() & (F.length(v) >= 5) & (magic == 0)
    return records.select(
        "*",
        magic.alias("magic"),
        F.when(ok, sid).alias("schema_id"),
        F.when(ok, F.expr(f"substring(`{value_col}`, 6)")).alias("payload"),
        F.coalesce(ok, F.lit(False)).alias("wire_ok"),
    )
