"""Aggregations: year and total counters, histograms, merged hits, percentiles, sampling and batches."""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .linkage import dropped, stored


def year_and_total(df: DataFrame, year: str, **metrics: Column) -> DataFrame:
    """One row a year and one for all years (year null), by one rollup."""
    return df.rollup(year).agg(*(c.alias(n) for n, c in metrics.items()))


def histogram(df: DataFrame, keys: list[str], values: str, default: str = "unknown") -> DataFrame:
    """Counts of the members of an array column; rows without any count under `default`. Members of a row count each."""
    return df.select(*keys, F.explode_outer(values).alias("label")).groupBy(*keys, F.coalesce("label", F.lit(default)).alias("label")).agg(F.count("*").alias("n"))


def merged_hits(hits: DataFrame, key: str, query: str, score: str, order: list[str], fill: list[str]) -> DataFrame:
    """One row a key: sorted distinct queries, the highest score, the first non-empty value of each fill column in order."""
    place = F.struct(*order)
    firsts = [F.min_by(F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.col(c)), F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", place)).alias(c) for c in fill]
    return hits.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(query)), ",").alias("queries"), F.max(score).alias("score"), F.count("*").alias("n_hits"), *firsts)


def percentiles(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Exact 16th, 50th and 84th percentiles, linearly interpolated, and the number of values."""
    p = F.percentile(value, F.array(F.lit(0.16), F.lit(0.5), F.lit(0.84)))
    return df.groupBy(*keys).agg(p.alias("p"), F.count(value).alias("n")).select(*keys, *(F.round(F.col("p")[i], 6).alias(n) for i, n in enumerate(("p16", "median", "p84"))), "n")


def top_k_flag(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """All rows with `selected`: whether they are among the first k. Only the k leaders' order is global.

    Rows equal in all columns are told apart by number only, so of more such rows than places just the places are selected.
    """
    lead = df.orderBy(*order).limit(k).groupBy(*df.columns).agg(F.count("*").alias("_m")).select(*(F.col(c).alias(f"_k_{c}") for c in df.columns), "_m")
    same = F.lit(True)
    for c in df.columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    lead = F.broadcast(lead)  # at most k rows
    among = df.join(lead, same).withColumn("_r", F.row_number().over(Window.partitionBy(*df.columns).orderBy(F.lit(0))))
    rest = df.join(lead, same, "left_anti").withColumn("selected", F.lit(False))
    return among.select(*df.columns, (F.col("_r") <= F.col("_m")).alias("selected")).unionByName(rest)


def numbered_globally(df: DataFrame, order: list[str], name: str = "n") -> DataFrame:
    """Row numbers from 0 in a total order, without one task for all rows: ranges are written once, numbered apart, then shifted
    by the rows of the ranges before them (a table of one row a range, which is broadcast)."""
    parts = stored(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    local = parts.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1)
    sizes = parts.groupBy("_p").agg(F.count("*").alias("_n"))
    shift = sizes.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_s"))
    return local.join(F.broadcast(shift), "_p").withColumn(name, F.col("_r") + F.col("_s")).drop("_p", "_r", "_s")


def numbered_within(df: DataFrame, key: str, order: list[str], name: str = "n") -> DataFrame:
    """Row numbers from 1 within each key, without one task for a very common key: ranges as in numbered_globally, of key and order.

    Only the first key of a range can go on from the ranges before it, so the shifts are one row a range at most. df is written
    first, since the bounds of the ranges take a pass of their own.
    """
    once = stored(df)
    parts = stored(once.repartitionByRange(key, *order).withColumn("_range", F.spark_partition_id()))
    dropped(once)
    local = parts.withColumn("_row", F.row_number().over(Window.partitionBy("_range", key).orderBy(*order)))
    sizes = parts.groupBy("_range", key).agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    shift = sizes.select(F.col("_range").alias("_after"), F.col(key).alias("_same"), before.alias("_shift")).where("_shift > 0")
    x = local.join(F.broadcast(shift), (F.col("_range") == F.col("_after")) & F.col(key).eqNullSafe(F.col("_same")), "left")
    return x.withColumn("_row", F.col("_row") + F.coalesce("_shift", F.lit(0))).select(*df.columns, F.col("_row").alias(name))


def allocation(sizes: dict[str, int], total: int) -> dict[str, int]:
    """Largest-remainder shares of total, at most each bin's size; ties by name. A few bins, on the driver."""
    whole = sum(sizes.values())
    if not whole:
        return dict.fromkeys(sizes, 0)
    exact = {k: total * n / whole for k, n in sizes.items()}
    out = {k: min(sizes[k], math.floor(v)) for k, v in exact.items()}
    while sum(out.values()) < min(total, whole):
        k = min((k for k in sizes if out[k] < sizes[k]), key=lambda k: (-(exact[k] - out[k]), k))
        out[k] += 1
    return out


def allocated(df: DataFrame, stratum: str, total: int) -> DataFrame:
    """stratum, population, sampled and weight: largest-remainder shares of total, ties by stratum, with the inverse chance of
    a draw (null where nothing is drawn). Only the counts, one row a stratum, meet in one task. A total above the population
    is an error when the result is computed."""
    sizes = df.groupBy(stratum).agg(F.count("*").alias("population"))
    all_of = F.sum("population").over(Window.partitionBy())
    share = F.least(F.lit(total), all_of).cast("double") * F.col("population") / all_of
    share = F.when(F.lit(total) > all_of, F.raise_error(F.lit("more is asked for than there is"))).otherwise(share)
    x = sizes.withColumn("_share", share).withColumn("_floor", F.floor("_share"))
    left = F.least(F.lit(total), all_of) - F.sum("_floor").over(Window.partitionBy())
    x = x.withColumn("_more", F.row_number().over(Window.orderBy((F.col("_share") - F.col("_floor")).desc(), stratum)) <= left)
    x = x.withColumn("sampled", (F.col("_floor") + F.col("_more").cast("int")).cast("bigint"))
    return x.select(stratum, "population", "sampled", F.when(F.col("sampled") > 0, F.round(F.col("population") / F.col("sampled"), 6)).alias("weight"))


def systematic_sample(df: DataFrame, order: list[str], k: int, seed: str) -> DataFrame:
    """k rows at even steps of the order, from a start that the seed text draws, with weight = rows / k; all rows if there are
    no more than k."""
    numbers = numbered_globally(df, order, "position")
    n = df.count()
    some = min(k, n)
    if some <= 0:
        return numbers.where("false").withColumn("weight", F.lit(0.0))
    step = n / some
    start = random.Random(seed).uniform(0, step) if n > k else 0.0
    wanted = df.sparkSession.range(some).select(F.least(F.floor(F.lit(start) + F.col("id") * F.lit(step)), F.lit(n - 1)).alias("position"))
    return numbers.join(wanted, "position", "left_semi").withColumn("weight", F.lit(round(n / some, 6)))
