"""Table scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..columns import UPDATED
from ..operators.clean import prefix_columns, union_all
from ..operators.dedup import keep_first

FORMATS = ("csv", "delta", "parquet", None)


def load_table(path: str, table_type: str | None, spark: SparkSession,
               schema: str | StructType | None = None, multi_line: bool = False) -> DataFrame:
    """Read a CSV, Delta or Parquet table; no type means Delta.

    Pass a schema for CSV: inference reads the files twice and turns codes such
    as ``0110`` into numbers. ``multi_line`` lets quoted CSV values span lines; such
    a file is read whole by one task, so it is for exchanges of bounded file size.
    """
    if table_type not in FORMATS:
        raise ValueError(f"unsupported table type {table_type!r}, expected csv, delta or parquet")
    reader = spark.read.format(table_type or "delta")
    if table_type == "csv":
        reader = reader.options(header=True, multiLine=multi_line, escape='"',
                                inferSchema=schema is None)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def project(df: DataFrame, columns: Sequence[str], where: str | Column | None = None) -> DataFrame:
    """Filter, then select (with renames); the filter may use dropped columns."""
    return (df if where is None else df.where(where)).selectExpr(*columns)


Moment = str | datetime | Column


def in_window(df: DataFrame, start: Moment | None, end: Moment, column: str = UPDATED,
              look_back: timedelta | None = None) -> DataFrame:
    """Rows with ``start <= column <= end``; without a start all up to the end.
    ``look_back`` moves the start back for rows that arrived late.

    The bounds take the column's own timestamp type, so that the column is
    compared as stored and the condition reaches the scan.
    """
    kind = df.schema[column].dataType

    def moment(value: Moment) -> Column:
        return (value if isinstance(value, Column) else F.lit(value)).cast(kind)

    upto = F.col(column) <= moment(end)
    if start is None:
        return df.where(upto)
    lower = moment(start)
    if look_back is not None:
        lower = lower - F.lit(look_back)
    return df.where((F.col(column) >= lower) & upto)


def unpredicted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Items the vendor has not answered yet."""
    return project(df, columns).where(F.col("EXTERNAL_PREDICATION_LASTUPDATED_AT").isNull())


def latest_predictions(feed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The newest vendor answer per description."""
    return keep_first(project(feed, columns), "PROCESSED_DESCRIPTION",
                      [F.col("PREDICATION_LASTUPDATED_AT").desc()])


COMMUNITY = "production_2022_community_"
REFERENCE = "unspsc_reference_table"


def load_training_inputs(inputs: Mapping[str, Mapping[str, str]], spark: SparkSession,
                         table_type: str = "csv", schema: str | None = None,
                         reference_schema: str | None = None, community: str = COMMUNITY,
                         code_reference: str = REFERENCE) -> tuple[DataFrame, DataFrame | None]:
    """Union of all community tables without repeated rows, and the code
    reference if one is configured. An input has a ``path`` and may have a
    ``prefix`` for its columns. Names tell what an input is: one that contains
    ``community``, or equals ``code_reference``; any other is an error."""
    strange = [name for name in inputs if community not in name and name != code_reference]
    if strange:
        raise ValueError(f"inputs of unknown use: {', '.join(sorted(strange))}")

    def load(entry: Mapping[str, str], kind: str | None) -> DataFrame:
        df = load_table(entry["path"], table_type, spark, kind)
        return prefix_columns(df, entry["prefix"]) if entry.get("prefix") else df

    communities = [load(entry, schema) for name, entry in inputs.items() if community in name]
    reference = inputs.get(code_reference)
    return union_all(*communities, scanned=True), load(reference, reference_schema) if reference else None
