"""JSON payloads to records by strict rules: one value that doesn't fit its field makes the whole record null.

Payloads are parsed once into variants; every rule is an expression over them, so that decoding stays in the JVM.  By
kind of field:

* numbers without fraction or exponent for integers, in the type's range; numbers, ``"NaN"``, ``"Infinity"`` and ``"-Infinity"`` for
  floats; numbers for decimals, rounded to the scale and within the precision;
* true and false; text, and for anything else its JSON text; base64 for binary;
* text or whole seconds for timestamps; text, as a date or as days since the epoch, for dates;
* objects for structs and maps, arrays for arrays, with the same rules inside.

Null and missing values are null.  The empty string is null for integers, decimals, booleans, structs, maps and arrays; for
floats, dates and timestamps it doesn't fit.  Unknown fields are left out and names are case-sensitive.  A payload that is null
or holds no value has no record and isn't malformed; one that isn't a whole JSON object is.  Of a name that comes twice the last
counts where :func:`last_of_names` was called, else such a payload is malformed.  Numbers in JSON text are written anew
(``1.0`` as ``1``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGERS = {T.ByteType: "tinyint", T.ShortType: "smallint", T.IntegerType: "int", T.LongType: "bigint"}
#: How JSON text says what numbers can't.
_SPECIAL = ("NaN", "Infinity", "-Infinity")


def last_of_names(spark: SparkSession) -> None:
    """From now on in this session, variants keep the last of several values of one name."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def _path(name: str) -> str:
    """Where a field is; variants' paths know no escapes, so that a name can't hold both kinds of quotes."""
    quote = '"' if "'" in name else "'"
    return f"$[{quote}{name}{quote}]"


def _get(v: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(v, path, kind)


def _text(v: Column) -> Column:
    return _get(v, "$", "string")


class _Kind:
    """The token that a variant holds; all are null for a value that is missing."""

    def __init__(self, v: Column):
        name = F.schema_of_variant(v)
        self.null = v.isNull() | F.is_variant_null(v)
        self.text, self.flag, self.whole = name == "STRING", name == "BOOLEAN", name == "BIGINT"
        self.number = name.isin("BIGINT", "DOUBLE", "FLOAT") | name.startswith("DECIMAL")
        self.object, self.array = name.startswith("OBJECT"), name.startswith("ARRAY")
        self.blank = self.text & (_text(v) == "")


def _value(v: Column, kind: T.DataType) -> tuple[Column, Column]:
    """A variant as one of ``kind``, and whether it fits; what is null fits."""
    k = _Kind(v)
    null = F.lit(None).cast(kind)

    def given(value: Column, fits: Column, blank: bool = True) -> tuple[Column, Column]:
        fine = k.null | (k.blank if blank else F.lit(False)) | F.coalesce(fits, F.lit(False))
        return F.when(~k.null & F.coalesce(fits, F.lit(False)), value).otherwise(null), fine

    if isinstance(kind, T.StringType):
        return given(F.when(k.text, _text(v)).otherwise(F.to_json(v)), F.lit(True))
    if isinstance(kind, T.BooleanType):
        return given(_get(v, "$", "boolean"), k.flag)
    if type(kind) in _INTEGERS:
        value = _get(v, "$", _INTEGERS[type(kind)])
        return given(value, k.whole & value.isNotNull())
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return given(_get(v, "$", "double").cast(kind), k.number | k.text & _text(v).isin(*_SPECIAL), False)
    if isinstance(kind, T.DecimalType):
        value = _get(v, "$", kind.simpleString())
        return given(value, k.number & value.isNotNull())
    if isinstance(kind, T.BinaryType):
        value = F.try_to_binary(_text(v), F.lit("base64"))
        return given(value, k.text & value.isNotNull(), False)
    if isinstance(kind, T.TimestampType):
        value = F.when(k.whole, F.timestamp_seconds(_get(v, "$", "bigint"))).when(k.text, F.try_to_timestamp(_text(v)))
        return given(value, (k.whole | k.text) & value.isNotNull(), False)
    if isinstance(kind, T.DateType):
        days = F.when(_text(v).rlike(r"^[+-]?\d{1,9}$"), F.date_from_unix_date(_text(v).try_cast("int")))
        value = F.coalesce(days, _text(v).try_cast("date"))
        return given(value, k.text & value.isNotNull(), False)
    if isinstance(kind, T.StructType):
        fields = [_value(_get(v, _path(f.name), "variant"), f.dataType) for f in kind.fields]
        fits = k.object
        for _, fine in fields:
            fits = fits & fine
        return given(F.struct(*[value.alias(f.name) for (value, _), f in zip(fields, kind.fields, strict=True)]), fits)
    if isinstance(kind, T.ArrayType):
        items = _get(v, "$", "array<variant>")
        return given(F.transform(items, lambda x: _value(x, kind.elementType)[0]), k.array & F.forall(items, lambda x: _value(x, kind.elementType)[1]))
    if isinstance(kind, T.MapType):
        pairs = _get(v, "$", "map<string,variant>")
        fits = k.object & F.forall(F.map_values(pairs), lambda x: _value(x, kind.valueType)[1])
        return given(F.transform_values(pairs, lambda _, x: _value(x, kind.valueType)[0]), fits)
    raise ValueError(f"JSON has no {kind.simpleString()}")


def decode(payload: Column, schema: T.StructType) -> Column:
    """A struct of ``record`` (null if it doesn't fit) and ``malformed``; the payload is text or UTF-8 bytes."""
    text = payload.cast("string")
    v = F.try_parse_json(text)
    value, fits = _value(v, schema)
    none = text.isNull() | ~text.rlike(r"[^ \t\r\n]")
    fine = ~none & v.isNotNull() & F.coalesce(_Kind(v).object, F.lit(False)) & fits
    return F.struct(F.when(fine, value).alias("record"), (~none & ~fine).alias("malformed"))


def flattened(log: DataFrame, payload: str, schema: T.StructType, keep: list[str]) -> DataFrame:
    """The payload's fields as top-level columns, then the columns ``keep``."""
    df = log.withColumn("_value", decode(F.col(payload), schema)["record"])
    return df.select(*[F.col("_value")[n].alias(n) for n in schema.fieldNames()], *keep)
