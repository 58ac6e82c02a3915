"""Date conversions of the raw file.

Every function returns a Column built from Spark built-ins, so it stays inside
whole-stage codegen. Bad input yields null (the ``try_`` forms), never an
error under ANSI mode; reject counts are taken separately.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.functions.casts import narrow
from starmart.schemas import MONTH_NAMES, SAS_EPOCH


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_day_to_date(c: Column | str, epoch: str = SAS_EPOCH) -> Column:
    """Day number (fractions truncated) -> date counted from ``epoch``; null stays null."""
    c = _col(c)
    return F.date_add(F.lit(epoch).cast("date"), narrow(c.try_cast("double"), "int"))


def compact_date(c: Column | str, pattern: str) -> Column:
    """Compact date text such as ``yyyyMMdd`` or ``MMddyyyy`` -> date.

    The column itself is parsed (never a neighbouring, already converted
    column), and text that does not fit the pattern becomes null.
    """
    text = _col(c).cast("string")
    parsed = F.try_to_date(text, pattern)
    if set(pattern) <= set("yMd"):
        # All-digit patterns: text of another shape (``D/S``, blanks) is null
        # without entering the parser, whose failures cost an exception each.
        return F.when(text.rlike(f"^[0-9]{{{len(pattern)}}}$"), parsed)
    return parsed


def month_name_to_number(c: Column | str) -> Column:
    """Full English month name (any case) -> 1..12; anything else -> null.

    Same answers as parsing with the ``MMMM`` pattern, as a lookup in the
    twelve names: no parser, no per-row exception on bad text.
    """
    names = F.array(*[F.lit(n) for n in MONTH_NAMES])
    return F.nullif(F.array_position(names, F.lower(_col(c))), F.lit(0)).cast("int")
