"""One representation of results for comparison between engines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def plain(df: DataFrame) -> DataFrame:
    """Whole numbers and flags as bigint, fractions as double, dates and times as ISO text."""

    def simple(field: T.StructField):
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.BooleanType, T.IntegralType)):
            column = column.cast("bigint") if not isinstance(kind, T.BooleanType) else column.cast("int").cast("bigint")
        elif isinstance(kind, T.FractionalType):
            column = column.cast("double")
        elif isinstance(kind, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            column = column.cast("string")
        return column.alias(field.name)

    return df.select(*[simple(field) for field in df.schema])
