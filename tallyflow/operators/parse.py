"""Reading JSON text into typed rows, with three ways to treat bad lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas


def _parsed(value: Column, schema: T.StructType, mode: str) -> Column:
    fields = schema.fields
    if mode == "PERMISSIVE":
        fields = [*fields, T.StructField(schemas.CORRUPT, T.StringType())]
    options = {"mode": mode, "columnNameOfCorruptRecord": schemas.CORRUPT}
    return F.from_json(value, T.StructType(fields), options)


def clean_rows(lines: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Rows of the lines that are JSON objects of the schema; other lines are left out.

    The parse sits in a generator, so that a line is parsed once however many
    fields and filters use it (a filter on a plain column would be pushed below
    the parse and repeat it).
    """
    row = F.array(_parsed(F.col(value), schema, "PERMISSIVE"))
    parsed = lines.select(F.inline(F.filter(row, lambda r: r.isNotNull())))
    return parsed.where(F.col(schemas.CORRUPT).isNull()).drop(schemas.CORRUPT)


def dirty_lines(lines: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """The lines `clean_rows` leaves out, as they came; no payload gives an empty text."""
    text = F.coalesce(F.col(value), F.lit(""))
    pair = F.struct(text.alias(value), _parsed(text, schema, "PERMISSIVE").alias("_row"))
    parsed = lines.select(F.inline(F.array(pair)))
    bad = F.col("_row").isNull() | F.col("_row")[schemas.CORRUPT].isNotNull()
    return parsed.where(bad).select(value)


def strict_rows(lines: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """As `clean_rows`, but the job fails on the first bad line."""
    row = _parsed(F.col(value), schema, "FAILFAST").alias("_row")
    return lines.select(row).select("_row.*")


def to_lines(df: DataFrame, value: str = "value") -> DataFrame:
    """Each row as one JSON text."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(value))
