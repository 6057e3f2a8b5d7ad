"""Text cleaning, Column -> Column."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from vintara.config.values import BLANKS, NA_TOKENS

#: Every character Python's ``str.strip`` removes, so that values match text cleaned there.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quoted(name: str) -> str:
    """Column reference by exact name, dots and blanks included."""
    return "`" + name.replace("`", "``") + "`"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it.

    Plain nesting repeats the value's expression at every use, which for regular expressions
    costs time and can outgrow the size of generated code.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column | str) -> Column:
    """Remove leading and trailing whitespace of any kind, no-break spaces included."""
    return F.btrim(col(c), F.lit(WHITESPACE))


def squeeze(c: Column | str) -> Column:
    """Strip, and turn every run of whitespace into one blank; null becomes empty."""
    return F.regexp_replace(strip(F.coalesce(col(c), F.lit(""))), r"(?U)[\s\x1c-\x1f]+", " ")


def null_if_in(c: Column | str, texts: Sequence[str]) -> Column:
    c = col(c)
    return F.when(~c.isin(list(texts)), c)


def na_to_null(c: Column | str) -> Column:
    """Texts that stand for a missing cell become null (exact, case-sensitive)."""
    return null_if_in(c, NA_TOKENS)


def recode(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Replace the values the mapping knows; others stay."""
    c = col(c)
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(table, c), c)


def clean_text(c: Column | str) -> Column:
    return null_if_in(strip(c), BLANKS)


def upper_code(c: Column | str, mapping: Mapping[str, str] | None = None) -> Column:
    """Strip, upper-case, blank to null, and recode."""
    value = null_if_in(F.upper(strip(c)), ["NAN", ""])
    return recode(value, mapping) if mapping else value


def plain_code(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Strip, blank to null, and recode; the case of the value counts."""
    return recode(clean_text(c), mapping)


def case_key(c: Column | str, trim: bool = True, null_as: str | None = None) -> Column:
    """Case number as a grouping key."""
    key = F.upper(strip(c) if trim else col(c))
    return key if null_as is None else F.coalesce(key, F.lit(null_as))


def normalise_header(c: Column | str) -> Column:
    """Header text -> column name, for tables that hold headers as data."""
    name = F.translate(F.lower(strip(c)), " -", "__")
    return F.regexp_replace(name, "^unnamed.*", "")


def normalise_header_text(name: str) -> str:
    """The same rule for one header of a schema."""
    name = name.strip().lower().replace(" ", "_").replace("-", "_")
    return "" if name.startswith("unnamed") else name
