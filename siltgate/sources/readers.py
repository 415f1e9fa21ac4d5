"""Scans. Schemas are declared; inference is a choice of the caller."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltgate.functions import sql
from siltgate.sources.files import ESCAPES, Folders


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    multi_line: bool = False,
    escaped: bool = False,
) -> DataFrame:
    """CSV with a header; an empty field is NULL, short rows are padded with NULL.

    Without a schema the types are inferred, which costs a pass over the file
    and turns code columns such as ``007`` into numbers. Quoted line breaks belong to
    their field only with ``multi_line``, which reads each file in one task. ``escaped``
    reads what ``write_csv(..., escaped=True)`` wrote: line breaks are codes there, so
    files are split as any others.
    """
    reader = spark.read.option("header", True).option("nullValue", "")
    reader = reader.option("multiLine", multi_line)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    rows = reader.csv(path)
    return rows.select(*[_unescape(f) for f in rows.schema.fields]) if escaped else rows


def _unescape(field: T.StructField) -> Column:
    value = F.col(sql.name(field.name))
    if isinstance(field.dataType, T.StringType):
        for plain, code in reversed(ESCAPES):
            value = F.replace(value, F.lit(code), F.lit(plain))
    return value.alias(field.name)


def read_layer(spark: SparkSession, where: str) -> DataFrame:
    """A layer table by path, or by name when ``where`` has no slash."""
    if "/" not in where:
        return spark.table(where)
    try:
        return spark.read.parquet(where)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND" and Folders(spark).recover(where.rstrip("/")):
            return spark.read.parquet(where)
        raise


def read_layer_if_present(spark: SparkSession, where: str) -> DataFrame | None:
    """A layer table, or None when nothing was ever stored there."""
    try:
        return read_layer(spark, where)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
            return None
        raise


def read_history(spark: SparkSession, where: str) -> DataFrame:
    """A history by path or table name, its run ids as they were written. Runs written
    to a folder under older schemas read with NULLs."""
    if "/" not in where:
        return spark.table(where)
    found = spark.read.option("mergeSchema", True).parquet(where)
    fields = [f for f in found.schema.fields if f.name != "run_id"]
    typed = T.StructType([*fields, T.StructField("run_id", T.StringType())])
    return spark.read.schema(typed).parquet(where)


def preview(df: DataFrame, order_by: list[str], rows: int = 20) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*order_by).limit(rows)
