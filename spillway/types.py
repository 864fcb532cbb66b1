"""Store types by name: their Spark types, and how a value of such a type can be mapped."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

# Store type names and their aliases, by Spark type. INT8 means eight bytes.
_NAMES: dict[str, T.DataType] = {}
for _kind, _names in (
    (T.BooleanType(), "BOOLEAN BOOL LOGICAL"),
    (T.ByteType(), "TINYINT INT1"),
    (T.ShortType(), "SMALLINT INT2 INT16 SHORT"),
    (T.IntegerType(), "INTEGER INT INT4 INT32 SIGNED"),
    (T.LongType(), "BIGINT INT8 INT64 LONG"),
    (T.ShortType(), "UTINYINT UINT8"),
    (T.IntegerType(), "USMALLINT UINT16"),
    (T.LongType(), "UINTEGER UINT32"),
    (T.DecimalType(20, 0), "UBIGINT UINT64"),
    (T.DecimalType(38, 0), "HUGEINT INT128"),
    (T.FloatType(), "FLOAT FLOAT4 REAL"),
    (T.DoubleType(), "DOUBLE FLOAT8"),
    (T.DecimalType(18, 3), "DECIMAL NUMERIC DEC"),
    (T.StringType(), "VARCHAR TEXT STRING CHAR BPCHAR UUID JSON"),
    (T.BinaryType(), "BLOB BYTEA BINARY VARBINARY GEOMETRY"),
    (T.DateType(), "DATE"),
    (T.TimestampNTZType(), "TIMESTAMP DATETIME TIMESTAMP_NS TIMESTAMP_MS TIMESTAMP_S"),
    (T.TimestampType(), "TIMESTAMPTZ"),
    (T.LongType(), "TIME TIMETZ TIME_NS"),
    (T.DayTimeIntervalType(), "INTERVAL"),
    (T.VariantType(), "VARIANT"),
):
    for _name in _names.split():
        _NAMES.setdefault(_name, _kind)

#: Ranges of the unsigned store types, which are widened.
UNSIGNED = {"UTINYINT": 2**8 - 1, "USMALLINT": 2**16 - 1, "UINTEGER": 2**32 - 1, "UBIGINT": 2**64 - 1}


@dataclass(frozen=True)
class StoreType:
    """kind: ScalarProperty, ComplexProperty, RawReaderOnly or Unsupported."""

    name: str
    kind: str
    spark: T.DataType | None


def _split(body: str) -> list[str]:
    out, depth, now = [], 0, ""
    for ch in body:
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            out.append(now.strip())
            now = ""
        else:
            now += ch
    return [*out, now.strip()] if now.strip() else out


def inspect(name: str) -> StoreType:
    """Classifies a store type name, nested ones too."""
    text = " ".join(name.strip().split())
    upper = text.upper().replace("TIMESTAMP WITH TIME ZONE", "TIMESTAMPTZ").replace("TIME WITH TIME ZONE", "TIMETZ").replace("DOUBLE PRECISION", "DOUBLE")
    if m := re.fullmatch(r"(.*)\[(\d*)\]", text, re.S):
        inner = inspect(m[1])
        if inner.spark is None:
            return StoreType(name, "Unsupported", None)
        plain = inner.kind == "ScalarProperty" and not m[2] and not isinstance(inner.spark, T.ArrayType)
        return StoreType(name, "ScalarProperty" if plain else "RawReaderOnly", T.ArrayType(inner.spark))
    if m := re.fullmatch(r"STRUCT\s*\((.*)\)", text, re.S | re.I):
        fields = []
        for part in _split(m[1]):
            field, _, kind = part.partition(" ")
            inner = inspect(kind)
            if inner.spark is None:
                return StoreType(name, "Unsupported", None)
            fields.append(T.StructField(field.strip('"'), inner.spark))
        return StoreType(name, "ComplexProperty", T.StructType(fields))
    if m := re.fullmatch(r"MAP\s*\((.*)\)", text, re.S | re.I):
        parts = [inspect(p).spark for p in _split(m[1])]
        return StoreType(name, "RawReaderOnly" if len(parts) == 2 and all(parts) else "Unsupported", T.MapType(*parts) if len(parts) == 2 and all(parts) else None)
    if re.match(r"UNION\s*\(|ENUM\s*\(", upper):
        return StoreType(name, "RawReaderOnly", T.StringType())
    if m := re.fullmatch(r"(?:DECIMAL|NUMERIC|DEC)\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)", upper):
        return StoreType(name, "ScalarProperty", T.DecimalType(int(m[1]), int(m[2] or 0)))
    bare = re.sub(r"\(.*\)$", "", upper)
    if bare in _NAMES:
        return StoreType(name, "RawReaderOnly" if bare in ("HUGEINT", "INT128", "VARIANT", "INTERVAL") else "ScalarProperty", _NAMES[bare])
    # Unknown names go by what they contain.
    for part, kind in (("INT", T.LongType()), ("CHAR", T.StringType()), ("BLOB", T.BinaryType())):
        if part in bare:
            return StoreType(name, "ScalarProperty", kind)
    return StoreType(name, "Unsupported", None)


def store_name(kind: T.DataType) -> str:
    """The store type name of a Spark type."""
    if isinstance(kind, T.ArrayType):
        return store_name(kind.elementType) + "[]"
    if isinstance(kind, T.StructType):
        return "STRUCT(" + ", ".join(f"{f.name} {store_name(f.dataType)}" for f in kind.fields) + ")"
    if isinstance(kind, T.MapType):
        return f"MAP({store_name(kind.keyType)}, {store_name(kind.valueType)})"
    if isinstance(kind, T.DecimalType):
        return f"DECIMAL({kind.precision},{kind.scale})"
    return next((n for n, k in _NAMES.items() if k == kind), "UNSUPPORTED")
