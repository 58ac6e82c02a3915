"""Casts, renames and text cleanup as single projections."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def strip(c: Column | str) -> Column:
    """Remove leading/trailing whitespace of any kind (blanks, tabs, CR, LF).

    ``trim`` only removes blanks, which leaves the CR of CRLF files behind.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, r"^\s+|\s+$", "")


# Bounds of the integral targets. As doubles, a value fits if it is above the
# first less one and below the second plus one; 2**63 is a double itself, and
# below -2**63 no double rounds into the range.
_RANGE = {
    "int": (-(1 << 31), (1 << 31) - 1),
    "integer": (-(1 << 31), (1 << 31) - 1),
    "bigint": (-(1 << 63), (1 << 63) - 1),
    "long": (-(1 << 63), (1 << 63) - 1),
}


def narrow(c: Column | str, target: str) -> Column:
    """Fractional number -> ``target`` integral type, truncating; out of range,
    NaN and infinities -> null.

    Same result as ``try_cast``, but a range test decides instead of a raised
    and caught overflow per bad row, which keeps bad-heavy columns fast.
    """
    c = F.col(c) if isinstance(c, str) else c
    lo, hi = _RANGE[target]
    above = c >= F.lit(float(lo)) if hi >= 1 << 53 else c > F.lit(float(lo - 1))
    return F.when(above & (c < F.lit(float(hi + 1))), c.cast(target))


# Text Spark's integral cast can accept: optional sign and digits, padded by
# the characters its cast trims (code points up to space).
_INTEGRAL_TEXT = r"^[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*$"
_INTEGRAL = ("tinyint", "smallint", "int", "bigint")
_FRACTIONAL = ("float", "double")


def integral(c: Column | str, target: str) -> Column:
    """A column of any number or text type -> ``target``, chosen by its own type.

    Integral columns are range-tested and cast as they are, text of digits is
    cast directly (no digit is lost), all else goes through double. The type test
    is a constant, so only the fitting branch stays in the plan.
    """
    c = F.col(c) if isinstance(c, str) else c
    lo, hi = _RANGE[target]
    kind, number = F.typeof(c), narrow(c.try_cast("double"), target)
    whole = c.try_cast("bigint")
    digits = F.when(c.cast("string").rlike(_INTEGRAL_TEXT), c.cast("string").try_cast(target)).otherwise(number)
    return (
        F.when(kind.isin(*_INTEGRAL), F.when(whole.between(F.lit(lo), F.lit(hi)), whole.cast(target)))
        .when(kind == "string", digits)
        .otherwise(number)
    )
def convert(df: DataFrame, name: str, target: str) -> Column:
    """Best conversion of column ``name`` of ``df`` to ``target`` (null when it cannot).

    Numbers into integral types take the range test; text into integral types
    is shape-checked first, so only digit strings reach the cast. Either way
    bad rows cost no exception.
    """
    source = dict(df.dtypes)[name]
    if target in _RANGE and source in _INTEGRAL:
        return integral(name, target)
    if target in _RANGE and source in _FRACTIONAL:
        return narrow(name, target)
    if target in _RANGE and source == "string":
        return F.when(F.col(name).rlike(_INTEGRAL_TEXT), F.col(name).try_cast(target))
    return F.col(name).try_cast(target)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast many columns in one ``select``.

    Numbers narrow by truncation, out-of-range values and unparsable text become
    null. One projection keeps the analyzed plan flat however many columns move.
    """
    return df.select(
        *[convert(df, c, types[c]).alias(c) if c in types else F.col(c) for c in df.columns]
    )


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by mapping; identity pairs and names absent from ``df`` are ignored."""
    present = {old: new for old, new in mapping.items() if old in df.columns and old != new}
    return df.withColumnsRenamed(present) if present else df


def reject_counts(pairs: Mapping[str, tuple[Column, Column]]) -> list[Column]:
    """Aggregate columns counting values lost by a conversion.

    ``pairs`` maps a metric name to (source, converted); a reject is a non-null
    source whose converted value is null. Meant for ``DataFrame.observe`` so the
    counts come for free with the write that materialises the data.
    """
    return [
        F.count_if(src.isNotNull() & dst.isNull()).alias(name)
        for name, (src, dst) in pairs.items()
    ]
