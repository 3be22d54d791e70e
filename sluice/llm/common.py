"""Small helpers that several operators share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.slices import text_slices  # noqa: F401
from sluice.session import scratch_dir


def staged_at(spark: SparkSession, df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """:func:`staged` and the folder, for :func:`sluice.session.drop_scratch`."""
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def staged(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once as a table in the shared folder and reread: cuts the
    lineage, so that a lost executor never sends a later job back beyond it."""
    return staged_at(spark, df, purpose)[0]


def order_id(column: str = "doc_id") -> Column:
    """An id to order by: a null id comes after all others."""
    return F.coalesce(F.col(column).cast("long"), F.lit((1 << 63) - 1))


def arrow_batch(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type)
         for f in schema], schema=schema)
