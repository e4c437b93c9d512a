"""The catalogue view: search, range filters and ordering over catalogue rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def natural_key(c: Column) -> Column:
    """Case-insensitive key in which numbers sort by size; null for missing text."""
    parts = F.regexp_extract_all(F.lower(F.nullif(c, F.lit(""))), F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"^\d"), F.lpad(p, 20, "0")).otherwise(p)), "")


def catalog_view(df: DataFrame, text: list[str], search: str = "", ranges: dict[str, tuple[float | None, float | None]] | None = None, sort: str | None = None, descending: bool = False, limit: int | None = None) -> DataFrame:
    """Rows whose joined text contains the search and whose numbers lie in every valid range; an invalid range (bounds in the
    wrong order, or none) passes all rows, a valid one drops rows without a number. Missing sort keys go last either way.
    A limited sort keeps only its leaders in memory."""
    out = df
    if search.strip():
        out = out.where(F.contains(F.lower(F.concat_ws(" ", *text)), F.lit(search.strip().lower())))
    for c, (lo, hi) in (ranges or {}).items():
        if lo is None and hi is None or lo is not None and hi is not None and lo > hi:
            continue
        inside = F.lit(True)
        if lo is not None:
            inside = inside & (F.col(c) >= lo)
        if hi is not None:
            inside = inside & (F.col(c) <= hi)
        out = out.where(F.col(c).isNotNull() & inside)
    if sort:
        key = natural_key(F.col(sort)) if dict(df.dtypes)[sort] == "string" else F.col(sort)
        out = out.orderBy(key.desc_nulls_last() if descending else key.asc_nulls_last())
    return out.limit(limit) if limit else out


def column_bounds(df: DataFrame, columns: list[str]) -> DataFrame:
    """name, low, high, n of the numbers of each column, in one pass; a column without numbers has null bounds."""
    x = df.agg(*(f(c).cast(k).alias(f"{c}_{f.__name__}") for c in columns for f, k in ((F.min, "double"), (F.max, "double"), (F.count, "bigint"))))
    made = F.array(*(F.struct(F.lit(c).alias("name"), F.col(f"{c}_min").alias("low"), F.col(f"{c}_max").alias("high"), F.col(f"{c}_count").alias("n")) for c in columns))
    return x.select(F.inline(made))
