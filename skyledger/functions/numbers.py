"""Numbers and dates out of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import text


def first_number(c: Column) -> Column:
    """The first number anywhere in the text; null if there is none or it isn't finite."""
    v = F.regexp_extract(text(c), r"([-+]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][-+]?\d+)?)", 1).try_cast("double")
    return F.when(F.abs(v) < float("inf"), v)


def strict_number(c: Column) -> Column:
    """The whole text as a number, or null; nan and infinity count."""
    v = F.trim(text(c))
    return F.when(v.rlike(r"(?i)^[-+]?(?:(\d+(\.\d*)?|\.\d+)(e[-+]?\d+)?|inf|infinity|nan)$"), F.regexp_replace(v, "(?i)^[-+]nan$", "nan").try_cast("double"))


#: Parts of a header cell that make it look like a unit.
UNIT_PARTS = ("[", "]", "km/s", "mag", "mas", "yr", "dex", "nm", "k ")


def unit_like(c: Column) -> Column:
    v = F.lower(text(c))
    out = F.lit(False)
    for part in UNIT_PARTS:
        out = out | v.contains(part)
    return out


def column_type(values: Column) -> Column:
    """number, mixed or string, from the cells that are neither empty nor `...`: mixed if at least half of them (one at least)
    are numbers. Empty if there are none."""
    some = F.filter(F.transform(values, text), lambda v: ~v.isin("", "..."))
    n = F.size(F.filter(some, lambda v: F.regexp_replace(F.regexp_replace(v, r"(\+/-|±).*$", ""), ",", "").rlike(r"^\s*[-+]?(\d+(\.\d*)?|\.\d+)([eE][-+]?\d+)?\s*$")))
    return F.when(F.size(some) == 0, "").when(n == F.size(some), "number").when(n >= F.greatest(F.lit(1), F.floor(F.size(some) / 2)), "mixed").otherwise("string")


def period_date(c: Column, end: bool) -> Column:
    """YYYY, YYYY-MM or YYYY-MM-DD as the first or last day it covers."""
    v = F.trim(text(c))
    y, m = F.substr(v, F.lit(1), F.lit(4)), F.substr(v, F.lit(6), F.lit(2))
    first = F.when(v.rlike(r"^\d{4}$"), F.concat(y, F.lit("-01-01"))).when(v.rlike(r"^\d{4}-\d{2}$"), F.concat(v, F.lit("-01"))).when(v.rlike(r"^\d{4}-\d{2}-\d{2}$"), v)
    day = first.try_cast("date")
    if not end:
        return day
    return F.when(v.rlike(r"^\d{4}$"), F.concat(y, F.lit("-12-31")).try_cast("date")).when(F.length(v) == 7, F.last_day(day)).otherwise(day)


def month_index(month: Column) -> Column:
    return F.substr(month, F.lit(1), F.lit(4)).cast("int") * 12 + F.substr(month, F.lit(6), F.lit(2)).cast("int") - 1


def month_label(index: Column) -> Column:
    return F.format_string("%04d-%02d", F.floor(index / 12).cast("int"), (index % 12 + 1).cast("int"))


def probability_tone(p: Column) -> Column:
    return F.when(p.isNull(), "none").when(p >= 0.95, "high").when(p >= 0.5, "mid").when(p < 0.05, "low").otherwise("some")
