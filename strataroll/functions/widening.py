"""Types that hold every value of another type, and columns read under a wider type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataroll.functions.names import named

#: Decimal digits that a whole-number type needs.
WHOLE_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def widens(old: T.DataType, new: T.DataType) -> bool:
    """True if every value of the old type is a value of the new one, and the two differ.

    Whole numbers widen to longer ones and to decimals that hold their digits, decimals to those with as many
    digits on both sides of the point, float to double, and dates to timestamps (their midnight).
    """
    if old == new:
        return False
    digits = WHOLE_DIGITS.get(type(old))
    if isinstance(new, T.DecimalType):
        if isinstance(old, T.DecimalType):
            return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
        return digits is not None and new.precision - new.scale >= digits
    if digits:
        return WHOLE_DIGITS.get(type(new), 0) > digits
    if isinstance(old, T.FloatType):
        return isinstance(new, T.DoubleType)
    return isinstance(old, T.DateType) and isinstance(new, (T.TimestampType, T.TimestampNTZType))


def widened(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema``: those it lacks are null, those of a narrower type are cast.

    A column whose type does not widen to the wanted one raises an error.
    """
    types = {f.name: f.dataType for f in df.schema}
    clashes = [f.name for f in schema if f.name in types and types[f.name] != f.dataType and not widens(types[f.name], f.dataType)]
    if clashes:
        raise ValueError(f"The types of {clashes} do not widen to the wanted ones")
    columns = []
    for f in schema:
        if f.name not in types:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif types[f.name] == f.dataType:
            columns.append(named(f.name))
        else:
            columns.append(named(f.name).cast(f.dataType).alias(f.name))
    return df.select(*columns)
