"""Records of different schemas as records of one: fields by name, at any depth.

A field that a record's schema lacks is null if it may be, else it's an error; fields that the wanted schema lacks are
left out.  Whole numbers go to longer ones, floats and doubles, floats to doubles, text and bytes to each other; nothing else is
converted.  A null where the wanted schema has none raises when it's read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.schemas import IncompatibleSchemaError

#: Types in order of widening; each may become any after it.
WIDER = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()]


def _widens(a: T.DataType, b: T.DataType) -> bool:
    if a in WIDER and b in WIDER:
        return WIDER.index(a) <= WIDER.index(b)
    return {type(a), type(b)} == {T.StringType, T.BinaryType}


def _as(c: Column, have: T.DataType, want: T.DataType, at: str) -> Column:
    """``c`` as ``want``."""
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        fields = [_field(c[f.name] if f.name in have.fieldNames() else None, have, f, at).alias(f.name) for f in want.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(c, lambda x: _given(_as(x, have.elementType, want.elementType, f"{at}[]"), have.containsNull, want.containsNull, f"{at}[]"))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType) and have.keyType == want.keyType:
        return F.transform_values(c, lambda _, x: _given(_as(x, have.valueType, want.valueType, f"{at}{{}}"), have.valueContainsNull, want.valueContainsNull, f"{at}{{}}"))
    if have == want:
        return c
    if not _widens(have, want):
        raise IncompatibleSchemaError(f"{at} is {have.simpleString()}, which can't become {want.simpleString()}")
    return c.cast(want)


def _given(c: Column, may_be: bool, may: bool, at: str) -> Column:
    """``c``, raising for a null that mustn't be."""
    return F.coalesce(c, F.raise_error(F.lit(f"{at} is null, but mustn't be"))) if may_be and not may else c


def _field(c: Column | None, have: T.StructType, want: T.StructField, above: str) -> Column:
    at = f"{above}.{want.name}".lstrip(".")
    if c is None:
        if not want.nullable:
            raise IncompatibleSchemaError(f"{at} is missing, but mustn't be null")
        return F.lit(None).cast(want.dataType)
    return _given(_as(c, have[want.name].dataType, want.dataType, at), have[want.name].nullable, want.nullable, at)


def conform(df: DataFrame, want: T.StructType) -> DataFrame:
    """``df`` with the columns of ``want``."""
    return df.select(*[_field(df[f"`{f.name}`"] if f.name in df.columns else None, df.schema, f, "").alias(f.name) for f in want.fields])


def merged(a: T.DataType, b: T.DataType, at: str = "") -> T.DataType:
    """The least schema that both conform to; fields of only one of them may be null."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        out = []
        for f in [*a.fields, *[x for x in b.fields if x.name not in a.fieldNames()]]:
            if f.name in a.fieldNames() and f.name in b.fieldNames():
                g = b[f.name]
                out.append(T.StructField(f.name, merged(f.dataType, g.dataType, f"{at}.{f.name}".lstrip(".")), f.nullable or g.nullable))
            else:
                out.append(T.StructField(f.name, f.dataType, True))
        return T.StructType(out)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merged(a.elementType, b.elementType, f"{at}[]"), a.containsNull or b.containsNull)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and a.keyType == b.keyType:
        return T.MapType(a.keyType, merged(a.valueType, b.valueType, f"{at}{{}}"), a.valueContainsNull or b.valueContainsNull)
    for x, y in ((a, b), (b, a)):
        if x == y or _widens(x, y):
            return y
    raise IncompatibleSchemaError(f"{at or 'the records'} is {a.simpleString()} and {b.simpleString()}")


def union(*frames: DataFrame, want: T.StructType | None = None) -> DataFrame:
    """All rows, as records of ``want`` or else of the least schema that all conform to."""
    want = want or reduce(merged, [df.schema for df in frames])
    return reduce(DataFrame.union, [conform(df, want) for df in frames])
