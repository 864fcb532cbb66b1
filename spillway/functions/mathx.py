"""Math functions. NaN results are NULL; rounding is half away from zero; floor and ceiling stay double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def no_nan(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def unary(name: str, x: Column) -> Column:
    """abs, acos, acosh, asin, asinh, atan, cbrt, cos, cosh, degrees, exp, radians, sin, sinh, sqrt, tan, tanh."""
    return no_nan(getattr(F, name)(x.cast("double")))


def floor(x: Column) -> Column:
    return F.floor(x).cast("double")


def ceiling(x: Column) -> Column:
    return F.ceil(x).cast("double")


def trunc(x: Column) -> Column:
    return F.signum(x) * F.floor(F.abs(x)).cast("double")


def log(x: Column, kind: str = "ln") -> Column:
    """ln, log10 or log2: minus infinity at zero, NULL below."""
    f = {"ln": F.ln, "log10": F.log10, "log2": F.log2}[kind]
    return F.when(x == 0, F.lit(float("-inf"))).when(x > 0, f(x))


def log_base(x: Column, base) -> Column:
    return no_nan(log(x) / log(_c(base).cast("double")))


def atan2(y: Column, x) -> Column:
    return no_nan(F.atan2(y, _c(x)))


def atanh(x: Column) -> Column:
    return F.when(x.between(-1, 1), F.atanh(x))


def power(x: Column, y) -> Column:
    return no_nan(F.pow(x, _c(y)))


def sign(x: Column) -> Column:
    return F.signum(x).cast("int")


def round_to(x: Column, digits: int = 0) -> Column:
    return F.round(x, digits)


def greatest(*xs: Column) -> Column:
    return F.greatest(*xs)


def least(*xs: Column) -> Column:
    return F.least(*xs)


def shift_left(x: Column, n: int) -> Column:
    """NULL for a negative left operand."""
    return F.when(x >= 0, F.shiftleft(x, n))


def shift_right(x: Column, n: int) -> Column:
    return F.when(x >= 0, F.shiftright(x, n))


def xor_bool(a: Column, b: Column) -> Column:
    return (a & ~b) | (~a & b)


def has_flag(x: Column, flag: int) -> Column:
    """Whether all bits of the flag are set; NULL for NULL."""
    return x.bitwiseAND(F.lit(flag)) == flag


def divide_int(a: Column, b: Column) -> Column:
    """Integer division that drops the remainder toward zero, as the query language has it; NULL for a zero divisor."""
    return F.when(b != 0, F.call_function("div", a.cast("long"), b.cast("long")))


def quotient_type(p1: int, s1: int, p2: int, s2: int) -> tuple[int, int]:
    """Precision and scale of a decimal quotient: integral digits come first, at least six decimals if there is room."""
    integral = min(38, max(0, p1 - s1 + s2))
    scale = min(max(6, s1 + p2 + 1), 38 - integral)
    return max(1, integral + scale), scale


def divide_decimal(a: Column, b: Column, first: tuple[int, int] = (18, 3), second: tuple[int, int] = (18, 3)) -> Column:
    p, s = quotient_type(*first, *second)
    return F.when(b != 0, a.cast(f"decimal({first[0]},{first[1]})") / b.cast(f"decimal({second[0]},{second[1]})")).cast(f"decimal({p},{s})")


def to_int(x: Column, kind: str = "int", from_decimal: bool = False) -> Column:
    """Conversion to a whole number: doubles round half to even, decimals half up."""
    return (F.round(x, 0) if from_decimal else F.rint(x)).cast(kind)
