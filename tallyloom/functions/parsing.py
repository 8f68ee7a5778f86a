"""Text-to-value rules of the ledgers, as Column builders.

Every cast is a ``try_cast`` so one bad cell never fails a job under ANSI mode,
and trimming uses the native character-set trim rather than a regular expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters stripped around a cell, the texts that mean "no value"
# on reading a file, the calendar offset and the years a date may lie in. Texts such as
# "None" or "nan" need no list: they fit no number shape.
BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
NO_CELL = ["", "null", "NULL", "N/A", "-"]
BUDDHIST_OFFSET = 543
YEAR_RANGE = (1900, 2100)

NUMBER_SHAPE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
YMD_DASH = r"^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})$"
YMD_SLASH = r"^([0-9]{4})/([0-9]{1,2})/([0-9]{1,2})$"
TWO_TWO_YEAR = r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})$"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(value: Column | str) -> Column:
    return F.btrim(_column(value), F.lit(BLANKS))


def cell(value: Column | str) -> Column:
    """A raw file cell with the no-value texts turned into null."""
    value = _column(value)
    return F.when(~strip(value).isin(NO_CELL), value)


# A rule comes in two halves: ``*_text`` tidies a raw cell, ``read_*`` turns tidy text
# into a value. Jobs put them in two projections, so the tidying runs once per cell
# however often the reading refers to it.


def number_text(value: Column | str) -> Column:
    """A stripped number without thousands commas."""
    return F.replace(strip(value), F.lit(","), F.lit(""))


def read_number(text: Column | str, kind: str = "double") -> Column:
    """Tidy text to a number of that type, anything unreadable (or too large) is null."""
    text = _column(text)
    # The shape test keeps out forms only the JVM reads as numbers, such as 1d.
    return F.when(text.rlike(NUMBER_SHAPE), text.try_cast(kind))


def number_or_null(value: Column | str) -> Column:
    return read_number(number_text(value))


def number(value: Column | str, default: float = 0.0) -> Column:
    """Text to double, unreadable or missing values become ``default``."""
    return F.coalesce(number_or_null(value), F.lit(float(default)))


def whole_number(value: Column | str, default: int = 0) -> Column:
    """As ``number``, cut to an integer."""
    return number(value, default).try_cast("bigint")


def is_unreadable_number(value: Column | str) -> Column:
    """True where a balance is missing or unreadable and so counts as zero."""
    return number_or_null(value).isNull()


def ledger_date_text(value: Column | str) -> Column:
    """A stripped date without its time part."""
    text, midnight = strip(value), " 00:00:00"
    return F.when(
        F.contains(text, F.lit(midnight)), F.replace(text, F.lit(midnight), F.lit(""))
    ).otherwise(F.substring_index(text, " ", 1))


def schedule_date_text(value: Column | str) -> Column:
    return F.substring_index(strip(value), " ", 1)


def _turned(text: Column, year: int, month: int, day: int) -> Column:
    """The slash-separated fields, by position, as a date."""
    fields = [F.split_part(text, F.lit("/"), F.lit(i)) for i in (year, month, day)]
    return F.concat_ws("-", *fields).try_cast("date")


def read_ledger_date(text: Column | str) -> Column:
    """Y-m-d, d/m/Y or Y/m/d; a layout that fits but is no date gives null."""
    text = _column(text)
    return (
        F.when(text.rlike(YMD_DASH), text.try_cast("date"))
        .when(text.rlike(TWO_TWO_YEAR), _turned(text, 3, 2, 1))
        .when(text.rlike(YMD_SLASH), _turned(text, 1, 2, 3))
    )


def read_schedule_date(text: Column | str) -> Column:
    """As the system ledger, and m/d/Y where d/m/Y is no date."""
    text = _column(text)
    month_first = F.when(text.rlike(TWO_TWO_YEAR), _turned(text, 3, 1, 2))
    return F.coalesce(read_ledger_date(text), month_first)


def ledger_date(value: Column | str) -> Column:
    """System-ledger date with an optional time part."""
    return read_ledger_date(ledger_date_text(value))


def schedule_date(value: Column | str) -> Column:
    return read_schedule_date(schedule_date_text(value))


def read_buddhist_date(text: Column | str) -> Column:
    """``d/m/y`` in the Buddhist Era; null outside 1900..2100 or where it is no date."""
    text = _column(text)
    day, month, year_be = (F.trim(F.split_part(text, F.lit("/"), F.lit(i))).try_cast("int") for i in (1, 2, 3))
    year = year_be - F.lit(BUDDHIST_OFFSET)
    two_slashes = F.length(text) - F.length(F.replace(text, F.lit("/"), F.lit(""))) == 2
    # concat, unlike concat_ws, is null as soon as one part is.
    date = F.concat(year.cast("string"), F.lit("-"), month.cast("string"), F.lit("-"), day.cast("string"))
    return F.when(two_slashes & year.between(*YEAR_RANGE), date.try_cast("date"))


def buddhist_date(value: Column | str) -> Column:
    return read_buddhist_date(strip(value))


def buddhist_text(value: Column | str, pattern: str = "dd/MM") -> Column:
    """A date as day, month and Buddhist-Era year."""
    value = _column(value)
    return F.concat(F.date_format(value, pattern), F.lit("/"), buddhist_year(value).cast("string"))


def buddhist_year(value: Column | str) -> Column:
    return F.year(_column(value)) + F.lit(BUDDHIST_OFFSET)


def gregorian_year(year_be: Column | str) -> Column:
    return _column(year_be) - F.lit(BUDDHIST_OFFSET)


def iso_text(value: Column | str) -> Column:
    """ISO text of a date, empty where there is none."""
    return F.coalesce(_column(value).cast("string"), F.lit(""))


def account_key(value: Column | str) -> Column:
    """Join key of an account: stripped, leading zeros dropped, may be empty."""
    return F.ltrim(strip(value), F.lit("0"))


def is_active_group(value: Column | str) -> Column:
    """The group flag is one, as number or as text; a null flag is not active."""
    value = _column(value).cast("string")
    return F.coalesce((value.try_cast("bigint") == 1) | (value == "1"), F.lit(False))
