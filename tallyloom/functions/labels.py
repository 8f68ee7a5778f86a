"""Small display rules: layouts, padding, bands, ratios."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def relayout_date(value: Column, pattern: str = "dd/MM/yyyy") -> Column:
    return F.date_format(value, pattern)


def shorten(value: Column, size: int) -> Column:
    return F.when(F.length(value) > size, F.concat(F.substring(value, 1, size), F.lit("..."))).otherwise(value)


def padded_id(value: Column, size: int = 3) -> Column:
    """Zero-padded; an id longer than ``size`` is kept whole."""
    text = value.cast("string")
    return F.when(F.length(text) >= size, text).otherwise(F.lpad(text, size, "0"))


def money_text(value: Column) -> Column:
    """Grouped, two decimals, missing as zero."""
    return F.format_number(F.coalesce(value, F.lit(0)).cast("decimal(38,2)"), 2)


def percent_of(value: Column, required: Column) -> Column:
    return F.round(value / required * 100).cast("bigint")


def shortfall(value: Column, required: Column) -> Column:
    return F.greatest(F.lit(0), required - value)


def threshold_label(value: Column, limits: Sequence[tuple[float, str]], otherwise: str, inclusive: bool = False) -> Column:
    """First label whose limit the value passes; limits in falling order."""
    label = F.lit(otherwise)
    for limit, name in reversed(list(limits)):
        passes = value >= limit if inclusive else value > limit
        label = F.when(passes, F.lit(name)).otherwise(label)
    return label


def mapped_label(value: Column, labels: Mapping[object, str], otherwise: str | None) -> Column:
    label = F.lit(otherwise)
    for key, name in reversed(list(labels.items())):
        label = F.when(value == F.lit(key), F.lit(name)).otherwise(label)
    return label


def keyword_class(value: Column, classes: Mapping[str, Sequence[str]], otherwise: str) -> Column:
    """First class with a keyword inside the value, in the given order."""
    label = F.lit(otherwise)
    for name, words in reversed(list(classes.items())):
        hit = F.lit(False)
        for word in words:
            hit = hit | F.contains(value, F.lit(word))
        label = F.when(hit, F.lit(name)).otherwise(label)
    return label


def payment_count_band(count: Column, few: int = 20) -> Column:
    """Accounts without payments, with few, and with more."""
    return F.when(count == 0, F.lit("0")).when(count <= few, F.lit(f"1-{few}")).otherwise(F.lit(f"{few + 1}+"))
