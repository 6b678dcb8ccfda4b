"""When does a cell count as *unset*, so that a seed value may fill it?"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The "empty" GUID and the earliest date count as unset.
ZERO_GUID = "00000000-0000-0000-0000-000000000000"
EARLIEST_DATE = "0001-01-01"

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
DATES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def is_unset(col: Column, dtype: T.DataType, sql_type: str | None = None) -> Column:
    """NULL, or the type's default value. Types without a default are unset only when NULL.

    ``sql_type`` tells GUIDs and time-zoned dates apart, which share a Spark type with others.
    """
    missing = col.isNull()
    if sql_type == "datetimeoffset":
        return missing
    if sql_type == "uniqueidentifier":
        default = F.lower(col) == ZERO_GUID
    elif isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        default = col == ""
    elif isinstance(dtype, NUMERIC):
        default = col == F.lit(0)
    elif isinstance(dtype, T.BooleanType):
        default = ~col
    elif isinstance(dtype, DATES):
        default = col == F.lit(EARLIEST_DATE).cast(dtype)
    else:
        return missing
    return missing | F.coalesce(default, F.lit(False))


def default_value(dtype: T.DataType) -> Column | None:
    """The value a NOT NULL column gets in place of NULL; None where the type has no default."""
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return F.lit("")
    if isinstance(dtype, NUMERIC):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    return None
