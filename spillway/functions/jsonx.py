"""JSON kept as text: paths, element tables, lengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def path(*steps: str | int) -> str:
    """A path whose names may hold any character but a single quote."""
    out = "$"
    for s in steps:
        if isinstance(s, int):
            out += f"[{s}]"
        elif "'" in s:
            raise ValueError("a name with a single quote cannot be addressed")
        else:
            out += f"['{s}']"
    return out


def _at(x: Column, steps: tuple[str | int, ...]) -> Column:
    """The text at a path. Names with a single quote, which paths cannot hold, are looked up in the object's fields."""
    plain: list[str | int] = []
    for i, s in enumerate(steps):
        if isinstance(s, str) and "'" in s:
            held = F.get_json_object(x, path(*plain)) if plain else x
            return _at(F.get(F.map_values(F.map_filter(F.from_json(held, "map<string,string>"), lambda k, _: k == F.lit(s))), F.lit(0)), steps[i + 1 :])
        plain.append(s)
    return F.get_json_object(x, path(*plain)) if plain else x


def value(x: Column, *steps: str | int, kind: str = "string") -> Column:
    return _at(x, steps).cast(kind)


def canonical(x: Column) -> Column:
    """Valid JSON without blanks and with each object's fields in order, so that equal documents are equal texts; else NULL."""
    return F.to_json(F.try_parse_json(x))


def equal(a: Column, b: Column) -> Column:
    """Whether two texts are the same JSON document, whatever the order of fields; two-valued."""
    return canonical(a).eqNullSafe(canonical(b))


def owned(x: Column, schema: str) -> Column:
    """An owned object as a struct, whose fields can be filtered, grouped and set."""
    return F.from_json(x, schema)


def set_fields(x: Column, schema: str, **fields: Column) -> Column:
    """The text with fields of the owned object set; NULL stays NULL. schema names all fields that are to stay."""
    made = owned(x, schema)
    for name, v in fields.items():
        made = made.withField(name, v)
    return F.when(x.isNotNull(), F.to_json(made))


def element(x: Column, index: Column, kind: str = "string") -> Column:
    """An element of a JSON array by a position that may differ from row to row."""
    return F.get(F.from_json(x, f"array<{kind}>"), index)


def length(x: Column, *steps: str | int) -> Column:
    return F.json_array_length(F.get_json_object(x, path(*steps)) if steps else x)


def each(df: DataFrame, column: str, kind: str = "string", *steps: str | int) -> DataFrame:
    """A row per element of a JSON array: df's columns, key (position) and value."""
    text = F.get_json_object(F.col(column), path(*steps)) if steps else F.col(column)
    return df.select("*", F.posexplode(F.from_json(text, f"array<{kind}>")).alias("key", "value"))


def fields(df: DataFrame, column: str) -> DataFrame:
    """A row per field of a JSON object: df's columns, key and value (text)."""
    return df.select("*", F.explode(F.from_json(F.col(column), "map<string,string>")).alias("key", "value"))
