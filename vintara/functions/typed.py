"""Text -> dates, numbers and flags; what cannot be read becomes null."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintara.functions.text import col, strip

#: Date layouts seen across releases, tried in this order.
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "M/d/yyyy", "d-MMM-yy")

_SHAPES = {"yyyy": "[0-9]{4}", "yy": "[0-9]{2}", "MMM": "[A-Za-z]{3}", "M": "[0-9]{1,2}", "d": "[0-9]{1,2}"}
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_SERIAL = r"^[0-9]{5}$"


def _read(text: Column, fmt: str) -> Column:
    """Timestamp of the texts that have the shape of the format.

    The shape test is far cheaper than a failed parse, and most formats fail on most values.
    """
    shape = re.sub("[A-Za-z]+", lambda m: _SHAPES.get(m[0], "[0-9]{%d}" % len(m[0])), fmt)
    return F.when(text.rlike(f"^{shape}$"), F.try_to_timestamp(text, F.lit(fmt)))


def parse_date(
    c: Column | str, formats: Sequence[str] = DATE_FORMATS, serials: bool = True, trim: bool = True
) -> Column:
    """Timestamp of a date in any of the layouts; five digits are a workbook day number."""
    text = strip(c) if trim else col(c)
    readings = [_read(text, f) for f in formats]
    if serials:
        day = F.when(text.rlike(_SERIAL), text.try_cast("int"))
        readings.append(F.date_add(F.lit("1899-12-30").cast("date"), day).cast("timestamp"))
    return F.coalesce(*readings)


def parse_like_first(
    df: DataFrame, name: str, order: str, formats: Sequence[str] = DATE_FORMATS
) -> Column:
    """Timestamp of the values that share the layout of the first non-null value.

    The first value (by ``order``) is a one-row scalar subquery: one aggregate with
    map-side combine, nothing collected.
    """
    text = strip(F.col(name))
    first = df.where(F.col(name).isNotNull()).agg(F.min_by(text, F.col(order))).scalar()
    result = F.lit(None).cast("timestamp")
    for fmt in reversed(formats):
        result = F.when(_read(first, fmt).isNotNull(), _read(text, fmt)).otherwise(result)
    return result


def parse_number(c: Column | str, trim: bool = True) -> Column:
    """Double of a plain decimal; thousands separators, currency and suffixes are not numbers."""
    text = strip(c) if trim else col(c)
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def parse_flag(c: Column | str, trim: bool = True) -> Column:
    """Whole number as bigint; fractions become null."""
    number = parse_number(c, trim)
    return F.when(number == F.floor(number), number.try_cast("bigint"))


def flag_rejected(c: Column | str) -> Column:
    """True where a value is a number but not a whole one."""
    number = parse_number(c)
    return F.coalesce(number != F.floor(number), F.lit(False))
