"""Column types from text by a mergeable state (Q6): bigint, decimal(38), double, boolean, string.

What a column's text says is summed up in a few values (``FIELDS``): counts, "all values are ..."
flags, and the most digits before and after the point. The state of many files or splits is the
sum, the conjunction and the maximum of theirs, in any order, so a new file only widens a type and
earlier files are not read again. ``resolve`` names the type that holds every value unchanged:

* whole numbers that fit: bigint; longer ones up to 38 digits: decimal(38,0);
* numbers that a double gives back digit for digit: double;
* other numbers up to 38 digits in all: decimal(38, most digits after the point);
* true / false: boolean; anything else, longer digit strings included: string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, StringType

_WHOLE = r"^[+-]?[0-9]+$"
# what a number looks like in text; a bare cast would also take Java suffixes (12D, 7F)
_NUMBER = (r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
           r"|^[+-]?(?i:inf|infinity)$")
#: Decimal numbers of so many digits are told apart by a double.
_SAFE = 15
#: How two states become one, by field.
FIELDS = {"n": F.sum, "whole": F.bool_and, "big": F.bool_and, "number": F.bool_and,
          "plain": F.bool_and, "exact": F.bool_and, "flag": F.bool_and, "digits": F.max,
          "scale": F.max}


def _significant(v: Column) -> Column:
    """Digits without sign, point, exponent, leading and trailing zeros."""
    bare = F.regexp_replace(F.regexp_replace(v, "[eE].*$", ""), "[^0-9]", "")
    return F.regexp_replace(bare, "^0+|0+$", "")


def _exact(v: Column) -> Column:
    """A double gives the number back: its shortest text has the same digits. (Java may print
    more digits than are needed; then the shorter text is as good.)"""
    mine = _significant(v)
    back = _significant(v.try_cast("double").cast("string"))
    return F.when(F.length(v) <= _SAFE, True).otherwise(
        (F.length(mine) <= _SAFE) | (mine == back)
        | ((F.length(back) > F.length(mine)) & (F.length(mine) <= 17)))


def state(cols: list[str]) -> list[Column]:
    """Aggregates ``<field><i>`` for each text column."""
    out = []
    for i, c in enumerate(cols):
        v = F.trim(F.col(f"`{c}`"))
        none, number = v.isNull(), v.rlike(_NUMBER)
        whole = v.rlike(_WHOLE)
        each = {
            "whole": whole, "big": whole & v.try_cast("bigint").isNotNull(), "number": number,
            "plain": v.rlike(r"^[+-]?[0-9.]+$"), "exact": _exact(v),
            "flag": F.lower(v).isin("true", "false")}
        out.append(F.count(v).alias(f"n{i}"))
        out += [F.coalesce(F.bool_and(none | x), F.lit(True)).alias(f"{k}{i}")
                for k, x in each.items()]
        # digits matter only where all values are numbers
        out += [F.max(F.when(number, F.length(F.regexp_extract(v, x, 1)))).alias(f"{k}{i}")
                for k, x in (("digits", r"^[+-]?0*([0-9]*)"),
                             ("scale", r"\.([0-9]*?)0*(?:[eE].*)?$"))]
    return out


def merged(n: int) -> list[Column]:
    """The state over rows that each hold a state of n columns."""
    return [fn(f"{k}{i}").alias(f"{k}{i}") for i in range(n) for k, fn in FIELDS.items()]


def resolve(row, i: int) -> str | None:
    """The type of column i, or None for string (also where there is no value)."""
    get = {k: row[f"{k}{i}"] for k in FIELDS}
    digits, scale = get["digits"] or 0, get["scale"] or 0
    if not get["n"]:
        return None
    if get["whole"]:
        return "bigint" if get["big"] else "decimal(38,0)" if digits <= 38 else None
    if get["number"]:
        if get["exact"]:
            return "double"
        return f"decimal(38,{scale})" if get["plain"] and digits + scale <= 38 else None
    return "boolean" if get["flag"] else None


def typed(df: DataFrame, types: dict[str, str | None]) -> DataFrame:
    """``df`` with its text columns cast."""
    if not any(types.values()):
        return df
    return df.select(*[F.trim(F.col(f"`{c}`")).try_cast(types[c]).alias(c) if types.get(c)
                       else F.col(f"`{c}`") for c in df.columns])


def number_type(a: DataFrame, b: DataFrame, column: str) -> DataType:
    """The type for a column that one side holds as double and the other as whole or decimal
    numbers: double if it tells all of these apart, else decimal(38) if that holds all doubles,
    else string. One aggregate over each side; needed only where two types meet."""
    doubles, exact = (a, b) if isinstance(a.schema[column].dataType, DoubleType) else (b, a)
    x, kind = F.col(f"`{column}`"), exact.schema[column].dataType
    scale = kind.scale if isinstance(kind, DecimalType) else 0
    same = x.cast("decimal(38,%d)" % scale) == x.cast("double").cast("string").try_cast(
        "decimal(38,%d)" % scale)
    if exact.agg(F.bool_and(x.isNull() | F.coalesce(same, F.lit(False)))).first()[0] in (None, True):
        return DoubleType()
    wide = max(18, scale)
    fits = x.cast("string").try_cast(f"decimal(38,{wide})")
    held = (fits.cast("double") == x) & (F.abs(x) < F.lit(10.0 ** (38 - wide)))
    if doubles.agg(F.bool_and(x.isNull() | F.coalesce(held, F.lit(False)))).first()[0] in (None, True):
        whole = exact.agg(F.bool_and(x.isNull() | x.try_cast(f"decimal(38,{wide})").isNotNull())
                          ).first()[0]
        if whole in (None, True):
            return DecimalType(38, wide)
    return StringType()
