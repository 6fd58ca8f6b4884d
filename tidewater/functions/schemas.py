"""Topic schemas and Spark types: primitives by name, records through Avro's JSON form."""

from __future__ import annotations

from typing import Any

from pyspark.sql import types as T

from tidewater.functions.envelope import META


class IncompatibleSchemaError(ValueError):
    """A schema that has no counterpart on the other side."""


#: Primitive topic types and their Spark types.
PRIMITIVES: dict[str, T.DataType] = {
    "NONE": T.BinaryType(),
    "BYTES": T.BinaryType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "STRING": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
    "INT8": T.ByteType(),
    "INT16": T.ShortType(),
    "INT32": T.IntegerType(),
    "INT64": T.LongType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
}
#: Avro's own primitive types.
AVRO = {"boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(), "string": T.StringType(), "enum": T.StringType(), "bytes": T.BinaryType(), "fixed": T.BinaryType()}
LOGICAL = {("int", "date"): T.DateType(), ("long", "timestamp-millis"): T.TimestampType(), ("long", "timestamp-micros"): T.TimestampType()}
RECORD = "topLevelRecord"


def _fields(schema: dict, open_names: tuple[str, ...]) -> T.StructType:
    name = f"{schema.get('namespace', '')}.{schema['name']}"
    if name in open_names:
        raise IncompatibleSchemaError(f"found a recursive reference in an Avro schema, which Spark can't represent: {name}")
    out = []
    for f in schema["fields"]:
        kind, null = from_avro(f["type"], (*open_names, name))
        out.append(T.StructField(f["name"], kind, null))
    return T.StructType(out)


def from_avro(schema: Any, open_names: tuple[str, ...] = ()) -> tuple[T.DataType, bool]:
    """The Spark type of an Avro schema, and whether it may be null."""
    if isinstance(schema, list):
        return _union(schema, open_names)
    if isinstance(schema, str):
        schema = {"type": schema}
    kind = schema["type"]
    if isinstance(kind, (dict, list)):
        return from_avro(kind, open_names)
    if any(n.rpartition(".")[2] == kind for n in open_names):
        raise IncompatibleSchemaError(f"found a recursive reference in an Avro schema, which Spark can't represent: {kind}")
    logical = schema.get("logicalType")
    if (kind, logical) in LOGICAL:
        return LOGICAL[kind, logical], False
    if logical == "decimal" and kind in {"bytes", "fixed"}:
        return T.DecimalType(schema["precision"], schema.get("scale", 0)), False
    if kind in AVRO:
        return AVRO[kind], False
    if kind == "record":
        return _fields(schema, open_names), False
    if kind == "array":
        inner, null = from_avro(schema["items"], open_names)
        return T.ArrayType(inner, null), False
    if kind == "map":
        inner, null = from_avro(schema["values"], open_names)
        return T.MapType(T.StringType(), inner, null), False
    raise IncompatibleSchemaError(f"Avro type {kind} has no Spark type")


def _union(branches: list, open_names: tuple[str, ...]) -> tuple[T.DataType, bool]:
    real = [b for b in branches if b != "null" and not (isinstance(b, dict) and b.get("type") == "null")]
    null = len(real) < len(branches)
    if not real:
        raise IncompatibleSchemaError("a union of null alone has no Spark type")
    if len(real) == 1:
        return from_avro(real[0], open_names)[0], null
    names = {b if isinstance(b, str) else b.get("type") for b in real if isinstance(b, (str, dict))}
    if len(real) == 2 and names == {"int", "long"}:
        return T.LongType(), null
    if len(real) == 2 and names == {"float", "double"}:
        return T.DoubleType(), null
    return T.StructType([T.StructField(f"member{i}", from_avro(b, open_names)[0], True) for i, b in enumerate(real)]), null


def bytes_for(precision: int) -> int:
    """Bytes of the shortest two's complement number that holds any decimal of ``precision`` digits."""
    return ((10**precision - 1).bit_length() + 8) // 8


def to_avro(kind: T.DataType, nullable: bool = False, name: str = RECORD) -> Any:
    """The Avro schema that values of a Spark type are written with."""
    simple = {T.BooleanType: "boolean", T.ByteType: "int", T.ShortType: "int", T.IntegerType: "int", T.LongType: "long", T.FloatType: "float", T.DoubleType: "double", T.StringType: "string", T.BinaryType: "bytes"}
    out: Any
    if type(kind) in simple:
        out = simple[type(kind)]
    elif isinstance(kind, T.DateType):
        out = {"type": "int", "logicalType": "date"}
    elif isinstance(kind, T.TimestampType):
        out = {"type": "long", "logicalType": "timestamp-micros"}
    elif isinstance(kind, T.DecimalType):
        out = {"type": "fixed", "name": f"{name}_fixed", "size": bytes_for(kind.precision), "logicalType": "decimal", "precision": kind.precision, "scale": kind.scale}
    elif isinstance(kind, T.ArrayType):
        out = {"type": "array", "items": to_avro(kind.elementType, kind.containsNull, f"{name}_item")}
    elif isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
        out = {"type": "map", "values": to_avro(kind.valueType, kind.valueContainsNull, f"{name}_value")}
    elif isinstance(kind, T.StructType):
        out = {"type": "record", "name": name, "fields": [{"name": f.name, "type": to_avro(f.dataType, f.nullable, f"{name}_{f.name}")} for f in kind.fields]}
    else:
        raise IncompatibleSchemaError(f"{kind.simpleString()} has no Avro type")
    return [out, "null"] if nullable else out


def topic_schema(values: T.StructType) -> dict:
    """The schema that value columns are written with: a primitive one for a single simple column, else a record."""
    if len(values.fields) == 1 and not isinstance(values.fields[0].dataType, T.StructType):
        kind = values.fields[0].dataType
        for name, known in PRIMITIVES.items():
            if name != "NONE" and known == kind:
                return {"type": name}
        raise IncompatibleSchemaError(f"{kind.simpleString()} as the only value column is not supported yet")
    return {"type": "AVRO", "schema": to_avro(values)}


def value_fields(schema: dict | None) -> T.StructType:
    """The value columns of a topic's schema: a record's fields, or one column ``value``; without a schema, its bytes."""
    kind = (schema or {"type": "BYTES"})["type"].upper()
    if kind in {"AVRO", "JSON"}:
        inner, null = from_avro(schema["schema"])
        if isinstance(inner, T.StructType):
            return inner
        return T.StructType([T.StructField("value", inner, null)])
    if kind not in PRIMITIVES:
        raise IncompatibleSchemaError(f"topic type {kind} isn't supported")
    return T.StructType([T.StructField("value", PRIMITIVES[kind], False)])


def read_schema(schema: dict | None) -> T.StructType:
    """What a topic reads as: value columns, then the metadata columns."""
    return T.StructType([*value_fields(schema).fields, *META.fields])


def common_schema(schemas: list[dict | None], allow_different: bool) -> dict | None:
    """The one schema of several topics; bytes if they may differ or there are none."""
    if allow_different or not schemas:
        return None
    if any(s != schemas[0] for s in schemas):
        raise ValueError("topics to be read have different schemas. Set allowDifferentTopicSchemas to 'true' to read their values as bytes.")
    return schemas[0]


def check_same(given: T.StructType, inferred: T.StructType) -> None:
    """Raises ValueError, naming the fields, if a schema that was given isn't the one that the topics read as."""
    if given != inferred:
        shown = lambda a, b: ", ".join(f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' not null'}" for f in a.fields if f not in b.fields) or "no other field"
        raise ValueError(f"the schema given has {shown(given, inferred)} where the topics read as {shown(inferred, given)} (the order of fields counts)")
