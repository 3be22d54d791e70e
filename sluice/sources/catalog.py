"""Catalog tables and temporary views (K4, K5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _quoted_part(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _quoted(name: str) -> str:
    """A possibly qualified table name with every part quoted."""
    return ".".join(map(_quoted_part, name.split(".")))


def external_table(spark: SparkSession, name: str, path: str, source: str | None = None,
                   schema: T.StructType | None = None, replace: bool = False,
                   **options: str) -> DataFrame:
    """K4: register files at ``path`` as an external catalog table.

    The catalog stores only the location; dropping the table leaves the files.
    An existing name raises.  With ``replace`` an existing external table or
    its entry is replaced; a managed table still raises, as dropping it would
    delete its files.
    """
    quoted = _quoted(name)
    if spark.catalog.tableExists(quoted):
        kind = spark.catalog.getTable(quoted).tableType
        if not replace:
            raise ValueError(f"table {name} exists ({kind})")
        if kind != "EXTERNAL":
            raise ValueError(f"table {name} is {kind}, not EXTERNAL: not replaced")
        spark.sql(f"DROP TABLE {quoted}")
    kwargs: dict = {"path": path}
    if source:
        kwargs["source"] = source
    if schema is not None:
        kwargs["schema"] = schema
    return spark.catalog.createTable(quoted, **kwargs, **options)


def partitioned_table(spark: SparkSession, name: str, path: str, schema: T.StructType,
                      partitions: Sequence[str], source: str = "parquet") -> DataFrame:
    """K4 over a partitioned folder (``<path>/<column>=<value>/...``): an external
    table whose ``partitions``, columns of ``schema``, are found in the folder.

    Filters on them prune folders when the query is planned; a join that
    restricts them prunes folders while it runs (dynamic partition pruning), so
    a scan reads what the other side selects.  Folders that are added later are
    seen after :func:`recover_partitions`.  An existing name raises.
    """
    quoted = _quoted(name)
    if spark.catalog.tableExists(quoted):
        raise ValueError(f"table {name} exists")
    missing = [p for p in partitions if p not in schema.names]
    if missing or not partitions:
        raise ValueError(f"no such partition columns: {missing}" if missing else "no partition columns")
    # partition columns come last in a table, as in the folders' rows
    ordered = [f for f in schema if f.name not in partitions] + [schema[p] for p in partitions]
    columns = ", ".join(f"{_quoted_part(f.name)} {f.dataType.simpleString()}" for f in ordered)
    by = ", ".join(map(_quoted_part, partitions))
    where = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {quoted} ({columns}) USING {source} PARTITIONED BY ({by}) LOCATION '{where}'")
    return recover_partitions(spark, name)


def recover_partitions(spark: SparkSession, name: str) -> DataFrame:
    """The table with all partition folders that are there now."""
    quoted = _quoted(name)
    spark.catalog.recoverPartitions(quoted)
    spark.catalog.refreshTable(quoted)
    return spark.table(quoted)


def temp_view(df: DataFrame, name: str) -> str:
    """K5: a session-scoped view over ``df``; returns the name for SQL."""
    df.createOrReplaceTempView(name)
    return name
