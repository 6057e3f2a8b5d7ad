"""What a file name, link text or heading says: year, period, program."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from vintara.config.sites import (
    DEPRECATED_TEXTS,
    FOLDERS,
    LAYOUT_TEXTS,
    MONTHS,
    NO_PROGRAM,
    PROGRAM_KEYS,
)
from vintara.functions.text import bind, col, squeeze, strip


def _found(c: Column, pattern: str, group: int) -> Column:
    """The group of the first match, or null."""
    hit = F.regexp_extract(c, pattern, group)
    return F.when(hit != "", hit)


def _fiscal_year(c: Column) -> Column:
    digits = _found(c, r"(?iU)fy\s*(\d{2,4})", 1)
    return F.when(F.length(digits) == 2, F.concat(F.lit("20"), digits)).otherwise(digits)


def year_of_file(c: Column | str) -> Column:
    """Fiscal year, else the first year 19xx/20xx, else ``unknown_year``."""
    c = col(c)
    return F.coalesce(_fiscal_year(c), _found(c, r"((?:19|20)\d{2})", 1), F.lit("unknown_year"))


def year_of_hub_file(c: Column | str) -> Column:
    """Fiscal year, else a free-standing year 20xx, else null."""
    c = col(c)
    return F.coalesce(_fiscal_year(c), _found(c, r"(?U)\b(20\d{2})\b", 1))


def year_of_link(text: Column | str, href: Column | str) -> Column:
    pattern = r"(?U)\b(20\d{2})\b"
    return F.coalesce(_found(col(text), pattern, 1), _found(col(href), pattern, 1))


def hub_period(visa_type: Column | str, filename: Column | str) -> Column:
    year = F.coalesce(year_of_hub_file(filename), F.lit("misc"))
    return F.concat(col(visa_type), F.lit("/"), year)


def program_period(program: Column | str, year: Column | str) -> Column:
    return F.concat(col(program), F.lit("/"), col(year))


def month_period(text: Column | str, href: Column | str) -> Column:
    """``FYyyyy-mm``, ``FYyyyy`` or ``misc``.

    Month words win over numeric forms (``M/yyyy``, ``yyyy-MM``); without either the
    month stays unknown.
    """
    words = F.lit(r"(?iU)\b(" + "|".join(MONTHS) + r")\b")
    address = F.coalesce(col(href), F.lit(""))
    texts = bind(squeeze(text), lambda t: F.struct(t.alias("text"), F.concat(t, F.lit(" "), address).alias("both")))
    parts = bind(texts, lambda f: F.struct(
        F.regexp_extract_all(f["both"], words, 1).alias("words"),
        F.regexp_extract(f["text"], _SLASH, 1).alias("slash_month"),
        F.regexp_extract(f["text"], _SLASH, 2).alias("slash_year"),
        F.regexp_extract(f["text"], _DASH, 2).alias("dash_month"),
        F.regexp_extract(f["text"], _DASH, 1).alias("dash_year"),
        F.regexp_extract(f["both"], r"(?iU)\bfy\s*(20\d{2})\b", 1).alias("fiscal"),
        F.regexp_extract(f["both"], r"(?U)\b(20\d{2})\b", 1).alias("year"),
    ))
    read = bind(parts, lambda p: F.struct(
        _first_month(p["words"]).alias("word_month"),
        F.coalesce(_full(p["slash_month"]), _full(p["dash_month"])).cast("int").alias("month"),
        F.coalesce(_full(p["slash_year"]), _full(p["dash_year"])).alias("month_year"),
        _full(p["fiscal"]).alias("fiscal"),
        _full(p["year"]).alias("year"),
    ))
    return bind(read, _period)


def _full(c: Column) -> Column:
    return F.when(c != "", c)


_SLASH = r"(?:^|\D)(\d{1,2})/(20\d{2})(?:\D|$)"
_DASH = r"(?:^|\D)(20\d{2})-(\d{2})(?:\D|$)"


def _first_month(words: Column) -> Column:
    """Number of the month whose word comes first in the dictionary, not in the text."""
    order = F.array(*[F.lit(w) for w in MONTHS])
    rank = F.array_min(F.transform(words, lambda w: F.array_position(order, F.lower(w))))
    return F.get(F.array(*[F.lit(n) for n in MONTHS.values()]), (rank - 1).cast("int"))


def _period(p: Column) -> Column:
    numeric = p["word_month"].isNull() & p["month"].between(1, 12)
    month = F.coalesce(p["word_month"], F.when(numeric, p["month"]))
    year = F.coalesce(p["fiscal"], F.when(numeric, p["month_year"]), p["year"])
    return (
        F.when(year.isNull(), F.lit("misc"))
        .when(month.isNull(), F.concat(F.lit("FY"), year))
        .otherwise(F.concat(F.lit("FY"), year, F.lit("-"), F.lpad(month.cast("string"), 2, "0")))
    )


def _first_key(hit: Callable[[str], Column]) -> Column:
    """Program of the first key that ``hit(key)`` accepts, in dictionary order."""
    return F.coalesce(*[F.when(hit(key), F.lit(name)) for key, name in PROGRAM_KEYS.items()])


def program_of(c: Column | str) -> Column:
    text = F.lower(col(c))
    return _first_key(text.contains)


def program_of_row(cell: Column | str, filename: Column | str) -> Column:
    """Program of a table row's link, from the row's first cell or the file name."""
    cell, name = F.lower(col(cell)), F.lower(col(filename))
    return F.coalesce(_first_key(lambda key: cell.contains(key) | name.contains(key)), F.lit(NO_PROGRAM))


def heading_program(c: Column | str) -> Column:
    """Program a heading announces; headings of annual reports announce none."""
    text = F.lower(col(c))
    return F.when(~text.contains("annual"), program_of(text))


def is_deprecated(filename: Column | str, context: Column | str | None = None) -> Column:
    """Deprecated annual report, unless it is a record layout."""
    name = F.lower(col(filename))
    context = F.lit("") if context is None else F.lower(col(context))

    def verdict(both: Column) -> Column:
        def any_of(texts: list[str]) -> Column:
            return reduce(lambda a, b: a | b, [both.contains(t) for t in texts])

        report = both.contains("annual") & both.contains("report") & name.endswith(".pdf")
        return ~any_of(LAYOUT_TEXTS) & (any_of(DEPRECATED_TEXTS) | report)

    return bind(F.concat(name, F.lit(" "), context), verdict)


def safe_name(c: Column | str, limit: int | None = 80) -> Column:
    """Name usable as a folder."""
    name = F.regexp_replace(strip(c), r'[\\/*?:"<>|]', "_")
    return F.substring(name, 1, limit) if limit else name


def storage_folder(file_type: Column | str, program: Column | str, period: Column | str,
                   root: str = "/data") -> Column:
    """Folder a file is stored in: by type, then program, then period or year."""
    file_type, program, period = col(file_type), col(program), col(period)
    fiscal = F.regexp_extract(period, r"^(FY\d{4})", 1)
    base = F.coalesce(*[
        F.when(file_type == kind, F.lit(f"{root}/{folder}")) for kind, folder in FOLDERS.items()
    ])
    return (
        F.when(file_type == "monthly", F.concat_ws("/", base, program, F.when(fiscal != "", fiscal), period))
        .when(file_type == "dol", F.concat_ws("/", base, safe_name(program, limit=None), period))
        .when(file_type == "uscis", F.concat_ws("/", base, program, period))
        .otherwise(F.concat_ws("/", base, period))
    )


def form_type(filename: Column | str, year: Column | str) -> Column:
    """``old`` or ``new`` form; null when the year is not a number."""
    number = col(year).try_cast("int")
    return (
        F.when(F.lower(col(filename)).contains("old_form"), "old")
        .when(number <= 2023, "old")
        .when(number > 2023, "new")
    )


def is_companion(filename: Column | str) -> Column:
    """Appendix and worksite files that accompany a release."""
    return F.lower(col(filename)).rlike("appendix|worksite")
