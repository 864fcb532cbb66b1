"""String functions. Positions are counted from 0, and searches answer false, not NULL, for a NULL operand."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def starts_with(x: Column, part) -> Column:
    return F.coalesce(F.startswith(x, _c(part)), F.lit(False))


def ends_with(x: Column, part) -> Column:
    return F.coalesce(F.endswith(x, _c(part)), F.lit(False))


def contains(x: Column, part) -> Column:
    return F.coalesce(F.contains(x, _c(part)), F.lit(False))


def escape_pattern(part: str, escape: str = "$") -> str:
    """part as a literal within a LIKE pattern."""
    return "".join(escape + ch if ch in (escape, "%", "_") else ch for ch in part)


def search_ci(x: Column, part: str, where: str = "contains") -> Column:
    """Case-insensitive search for a literal part: contains, starts or ends."""
    inner = escape_pattern(part)
    pattern = {"contains": f"%{inner}%", "starts": f"{inner}%", "ends": f"%{inner}"}[where]
    return F.coalesce(F.ilike(x, F.lit(pattern), F.lit("$")), F.lit(False))


def substring(x: Column, start, length=None) -> Column:
    at = _c(start) + 1
    return F.substr(x, at) if length is None else F.substr(x, at, _c(length))


def index_of(x: Column, part, start: int | None = None) -> Column:
    """-1 if not found. With a start, the search begins there; not found is then start - 1, as the generated SQL has it."""
    if start is None:
        return F.instr(x, part) - 1 if isinstance(part, str) else F.locate(part, x) - 1
    return F.instr(F.substr(x, F.lit(start + 1)), part) - 1 + start


def trim(x: Column, chars: str = " ") -> Column:
    return F.btrim(x, F.lit(chars))


def trim_start(x: Column, chars: str = " ") -> Column:
    return F.ltrim(x, F.lit(chars))


def trim_end(x: Column, chars: str = " ") -> Column:
    return F.rtrim(x, F.lit(chars))


def null_or_empty(x: Column) -> Column:
    return x.isNull() | (F.char_length(x) == 0)


def null_or_space(x: Column) -> Column:
    """Spaces only count as blank, not tabs or line ends."""
    return x.isNull() | (F.char_length(F.trim(x)) == 0)


def first_char(x: Column) -> Column:
    return F.left(x, F.lit(1))


def last_char(x: Column) -> Column:
    return F.right(x, F.lit(1))


def join(sep: str, *parts: Column) -> Column:
    """Joins parts; a NULL counts as empty, not as missing."""
    return F.concat_ws(sep, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def concat(*parts: Column) -> Column:
    """The + of two strings in the query language: a NULL counts as empty."""
    return F.concat(*[F.coalesce(p, F.lit("")) for p in parts])


def regex_match(x: Column, pattern: str) -> Column:
    """Whether some part matches."""
    return x.rlike(pattern)


def split_part(x: Column, sep: str, index: int) -> Column:
    """Counted from 1, from the end if negative; '' outside the range and for 0."""
    return F.when(x.isNotNull(), F.lit("")) if index == 0 else F.split_part(x, F.lit(sep), F.lit(index))


def compare(a: Column, b) -> Column:
    """-1, 0 or 1 by code points; NULL if one is NULL."""
    b = _c(b)
    return F.when(a < b, -1).when(a == b, 0).when(a > b, 1)


def like(x: Column, pattern: str, escape: str | None = None) -> Column:
    """LIKE; without an escape character, a backslash is an ordinary one."""
    return F.like(x, F.lit(pattern if escape else pattern.replace("\\", "\\\\")), F.lit(escape or "\\"))


def to_text(x: Column, boolean: bool = False) -> Column:
    """A value's text; '' for NULL, True and False for booleans."""
    return F.when(x.isNull(), "").when(x, "True").otherwise("False") if boolean else F.coalesce(x.cast("string"), F.lit(""))


def has_flag(x: Column, flag: int) -> Column:
    return x.bitwiseAND(F.lit(flag)) == F.lit(flag)
