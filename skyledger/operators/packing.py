"""Packing of source lines as context: cited bibliography entries and the surroundings of lines of interest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Blocks of a bibliography that are kept whatever is cited.
KEPT_BLOCKS = ("string", "preamble")
_ENTRY = r"^\s*@(\w+)\s*\{\s*([^,\s}]*)"


def cited_entries(lines: DataFrame, cited: DataFrame) -> DataFrame:
    """doc, line, until, text of the packed bibliography of each document.

    `lines` (doc, line from 1, text) are the lines of bibliographies, `cited` (doc, key) the keys their documents cite. A kept
    line is a row of its own with its physical number; a run of omitted lines is one row with a null text. Lines before the
    first entry are kept. A null text counts as empty. Work is by document; only keys are joined.
    """
    text = F.coalesce("text", F.lit(""))
    kind, key = F.lower(F.regexp_extract(text, _ENTRY, 1)), F.regexp_extract(text, _ENTRY, 2)
    x = lines.select("doc", "line", "text", kind.alias("_kind"), key.alias("_key"))
    known = cited.select("doc", F.col("key").alias("_key")).where(F.col("_key") != "").distinct().withColumn("_cited", F.lit(True))
    x = x.join(known, ["doc", "_key"], "left")
    starts = F.when(F.col("_kind") != "", F.col("_kind").isin(*KEPT_BLOCKS) | F.coalesce("_cited", F.lit(False)))
    by_line = Window.partitionBy("doc").orderBy("line")
    x = x.withColumn("_keep", F.coalesce(F.last(starts, ignorenulls=True).over(by_line), F.lit(True)))
    run = F.when(F.col("_keep"), F.col("line")).otherwise(F.col("line") - F.row_number().over(Window.partitionBy("doc", "_keep").orderBy("line")))
    out = x.withColumn("_run", run).groupBy("doc", "_keep", "_run").agg(F.min("line").alias("line"), F.max("line").alias("until"), F.min("text").alias("_text"))
    return out.select("doc", "line", "until", F.when(F.col("_keep"), F.coalesce("_text", F.lit(""))).alias("text"))


def surroundings(df: DataFrame, key: str, text: str, pattern: str, reach: int = 2) -> DataFrame:
    """key, line, context of every line that matches, with `reach` lines before and after it, ends trimmed. No shuffle."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    x = df.select(key, lines.alias("_l")).withColumn("line", F.explode(F.filter(F.sequence(F.lit(1), F.size("_l")), lambda i: F.get(F.col("_l"), i - 1).rlike(pattern))))
    first = F.greatest(F.lit(1), F.col("line") - reach)
    near = F.array_join(F.slice("_l", first, F.col("line") + reach - first + 1), "\n")
    return x.select(key, "line", F.regexp_replace(near, r"^\s+|\s+$", "").alias("context"))
