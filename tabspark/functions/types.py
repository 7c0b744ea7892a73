"""Column type families: numeric, categorical, datetime, boolean, other."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F, types as T

FAMILIES = ("numeric", "categorical", "datetime", "boolean", "other")


def family_of(dtype: T.DataType) -> str:
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if isinstance(dtype, T.NumericType):
        return "numeric"
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return "categorical"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "datetime"
    return "other"


def families(df: DataFrame) -> dict[str, str]:
    """Column name -> family, in column order; metadata only."""
    return {f.name: family_of(f.dataType) for f in df.schema.fields}


def columns_of(df: DataFrame, family: str, exclude: tuple | list = ()) -> list[str]:
    return [c for c, fam in families(df).items() if fam == family and c not in exclude]


def numeric_columns(df: DataFrame, exclude: tuple | list = ()) -> list[str]:
    return columns_of(df, "numeric", exclude)


def categorical_columns(df: DataFrame, exclude: tuple | list = ()) -> list[str]:
    return columns_of(df, "categorical", exclude)


def datetime_columns(df: DataFrame, exclude: tuple | list = ()) -> list[str]:
    return columns_of(df, "datetime", exclude)


def boolean_columns(df: DataFrame, exclude: tuple | list = ()) -> list[str]:
    return columns_of(df, "boolean", exclude)


def is_integer(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def is_fractional(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType))


def q(name: str) -> Column:
    """Column by exact name, also when it holds dots or spaces."""
    return F.col(name_sql(name))


def name_sql(name: str) -> str:
    """The column's name in SQL text. Projections of hundreds of columns are written as text: one call instead of several a column."""
    return "`" + name.replace("`", "``") + "`"


def number_sql(v: float) -> str:
    v = float(v)
    return f"{v!r}D" if math.isfinite(v) else f"CAST('{v}' AS DOUBLE)"


def text_sql(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def dbl(name: str) -> Column:
    return F.expr(f"CAST({name_sql(name)} AS DOUBLE)")


def column_families(df: DataFrame) -> DataFrame:
    """(column, family) rows for every column."""
    rows = [(c, fam) for c, fam in families(df).items()]
    return df.sparkSession.createDataFrame(rows, "column string, family string")
