"""Scalar UDFs, calling a registered function by name, and the two
explode forms.

Scalar UDFs are Arrow-batched (Arrow or pandas UDFs); Spark's built-ins stay the
first choice wherever they can express the function.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.slices import text_slices


@F.arrow_udf(T.LongType())
def count_ascii_upper(text: pa.Array) -> pa.Array:
    """U1 example: number of ASCII capital letters in each text, null for a null
    one.  Counted on the batch's own bytes, a slice at a time: no text becomes a
    Python object."""
    wide = np.int64 if pa.types.is_large_string(text.type) else np.int32
    counts = []
    for batch in text_slices(iter([pa.RecordBatch.from_arrays([text], names=["text"])]), "text"):
        own = batch.column("text")
        _, offsets, data = own.buffers()
        ends = np.frombuffer(offsets, wide)[own.offset:own.offset + len(own) + 1]
        letters = np.frombuffer(data or b"", np.uint8)[ends[0]:ends[-1]]
        places = np.flatnonzero((letters >= ord("A")) & (letters <= ord("Z")))
        found = np.diff(np.searchsorted(places, ends - ends[0]))
        counts.append(pa.array(found, pa.int64(), mask=own.is_null().to_numpy(zero_copy_only=False)))
    return pa.concat_arrays(counts) if counts else pa.array([], pa.int64())


@F.pandas_udf(T.IntegerType())
def leading_digit(text: pd.Series) -> pd.Series:
    """U2 example: the leading decimal digit of a text such as ``1-URGENT``."""
    return pd.to_numeric(text.str.extract(r"^(\d)", expand=False), errors="coerce").astype("Int32")


def register_udf(spark: SparkSession, name: str, fn) -> None:
    """Register a (pandas) UDF under ``name`` for SQL and :func:`call`."""
    spark.udf.register(name, fn)


def call(name: str, *cols: str | Column) -> Column:
    """Call a registered function by name."""
    return F.call_udf(name, *[F.col(c) if isinstance(c, str) else c for c in cols])


def explode_column(df: DataFrame, array_col: Column, out: str, keep: Sequence[str] = ("*",),
                   with_position: bool = False) -> DataFrame:
    """One row per array element, other columns kept; no row for an
    empty or null array."""
    if with_position:
        return df.select(*keep, F.posexplode(array_col).alias(f"{out}_pos", out))
    return df.select(*keep, F.explode(array_col).alias(out))


def explode_rows(df: DataFrame, keep: Sequence[str], variants: Sequence[Sequence[Column]],
                 names: Sequence[str]) -> DataFrame:
    """U4: each input row becomes ``len(variants)`` rows; variant ``i`` gives
    the values of the new columns ``names``.  ``inline`` over a literal-size
    array stays a JVM generator (no Python)."""
    structs = [F.struct(*[c.alias(n) for c, n in zip(v, names)]) for v in variants]
    return df.select(*keep, F.inline(F.array(*structs)))


def explode_rows_by(df: DataFrame, keep: Sequence[str], rows: Column) -> DataFrame:
    """U4 with any number of rows: ``rows`` is an array of structs computed
    from each row; every element is a row of its own, and an empty or null
    array gives none.  A JVM generator (no Python)."""
    return df.select(*keep, F.inline(rows))
