"""Forcing rows into a declared schema; a value that does not convert becomes null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

_MOMENTS = (T.DateType, T.TimestampNTZType)
_ZERO_WHEN_ABSENT = (T.IntegerType, T.DoubleType)


def typed(column: Column, data_type: T.DataType) -> Column:
    """``column`` as the declared type, or null."""
    if isinstance(data_type, T.IntegerType):
        # Through double, so that the text 12.5 gives 12 and not null.
        return column.try_cast("double").try_cast("int")
    if isinstance(data_type, T.TimestampType):
        return F.try_to_timestamp(column.cast("string"))
    return column.try_cast(data_type)


def absent(data_type: T.DataType) -> Column:
    """What a column that does not occur at all is filled with."""
    fill = F.lit(0) if isinstance(data_type, _ZERO_WHEN_ABSENT) else F.lit(None)
    return fill.cast(data_type)


def conform_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in declared order and type."""
    given = {f.name: f.dataType for f in df.schema.fields}

    def column(name: str, wanted: T.DataType) -> Column:
        if name not in given:
            return absent(wanted)
        if given[name] == wanted:
            return F.col(name)
        if isinstance(wanted, T.TimestampType) and isinstance(given[name], _MOMENTS):
            return F.col(name).cast(wanted)
        return typed(F.col(name), wanted)

    return df.select(*(column(f.name, f.dataType).alias(f.name) for f in schema.fields))


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns in the given order."""
    return df.select(*columns)
