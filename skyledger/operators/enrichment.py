"""Provider rows for objects: by identifier, then by position; claims of several objects; source ids, then positions again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sky
from ..functions import text as tx
from .catalogue import provider_status

RADIUS = 5.0


def by_identifier(objects: DataFrame, rows: DataFrame) -> DataFrame:
    """object_id, oid and place of the first provider row that shares a name with an object: a join of normalised names, in which
    a name that many share is a skewed key that adaptive execution splits."""
    own = objects.select("object_id", F.explode(F.array_distinct(F.transform("names", tx.alias))).alias("n")).where("n <> ''")
    theirs = rows.select("oid", "place", F.explode(F.array_distinct(F.transform("aliases", tx.alias))).alias("n"))
    return own.join(theirs, "n").select("object_id", "oid", "place").distinct()


def by_position(objects: DataFrame, rows: DataFrame, ident: str) -> DataFrame:
    """object_id, the nearest row's ident within the radius, inclusive, its separation and how many lie there; ties by place."""
    met = sky.within(objects.select("object_id", "ra", "dec"), rows.select(ident, "place", "ra", "dec"), RADIUS, inclusive=True)
    nearest = F.min_by(f"r_{ident}", F.struct("sep", "r_place")).alias(ident)
    return met.groupBy(F.col("l_object_id").alias("object_id")).agg(nearest, F.round(F.min("sep"), 6).alias("sep"), F.count("*").alias("n"))


def source_numbers(aliases: Column) -> Column:
    """Numbers of the DR3 and EDR3 ids among a provider's names."""
    some = F.filter(aliases, lambda a: tx.gaia_release(a).isin("DR3", "EDR3"))
    return F.transform(some, tx.gaia_number)


def cascade(objects: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """object_id, oid and how it was matched, source_id and how, warnings and status of every object.

    objects: object_id, names, numbers (literature source numbers), ra, dec. first: oid, place, aliases, ra, dec. second:
    source_id, place, ra, dec. An object's row of the first provider is the first that shares a name, else the nearest; its row of
    the second is that of the first known number, the literature's before the provider's, else the nearest. A row of the first
    provider that several objects claim by name is reported at each.
    """
    claims = by_identifier(objects, first)
    named = claims.groupBy("object_id").agg(F.min_by("oid", F.struct("place", "oid")).alias("oid"))
    shared = claims.join(claims.groupBy("oid").agg(F.count_distinct("object_id").alias("n")).where("n > 1"), "oid").select("object_id").distinct().withColumn("claimed", F.lit(True))
    open_ = objects.join(named, "object_id", "left_anti")
    near = by_position(open_, first, "oid")
    a = named.select("object_id", "oid", F.lit("identifier").alias("by"), F.lit(None).cast("double").alias("sep"), F.lit(1).cast("bigint").alias("n"))
    a = a.unionByName(near.select("object_id", "oid", F.lit("coordinates").alias("by"), "sep", "n"))
    names = first.select(F.col("oid").alias("_o"), "aliases").dropDuplicates(["_o"])
    x = objects.join(a, "object_id", "left").join(names, F.col("oid") == F.col("_o"), "left")
    numbers = F.array_distinct(F.concat(F.coalesce("numbers", F.array().cast("array<string>")), F.coalesce(source_numbers(F.col("aliases")), F.array().cast("array<string>"))))
    asked = x.select("object_id", F.posexplode(numbers).alias("order", "number"))
    known = second.groupBy(F.col("source_id").cast("string").alias("number")).agg(F.max_by("source_id", "place").alias("source_id"))
    hit = asked.join(known, "number").groupBy("object_id").agg(F.min_by("source_id", "order").alias("source_id"))
    far = by_position(objects.join(hit, "object_id", "left_anti"), second, "source_id")
    b = hit.select("object_id", "source_id", F.lit("source_id").alias("by2"), F.lit(None).cast("double").alias("sep2"), F.lit(1).cast("bigint").alias("n2"))
    b = b.unionByName(far.select("object_id", "source_id", F.lit("coordinates").alias("by2"), F.col("sep").alias("sep2"), F.col("n").alias("n2")))
    y = x.join(b, "object_id", "left").join(shared, "object_id", "left")
    say = lambda when, what: F.when(when, what)
    notes = F.array_compact(
        F.array(
            say(F.col("by") == "coordinates", "first_coordinate_match"), say(F.col("n") > 1, "several_first_matches"), say(F.col("claimed"), "duplicate_object_match"),
            say(F.col("by2") == "coordinates", "second_coordinate_match"), say(F.col("n2") > 1, "several_second_matches"),
        )
    )
    state = lambda c: F.when(F.col(c).isNotNull(), "matched").otherwise("not_found")
    return y.select("object_id", "oid", F.col("by").alias("matched_by"), "source_id", F.col("by2").alias("source_matched_by"), "sep", "sep2", notes.alias("warnings"), provider_status(state("oid"), state("source_id"), F.lit(0)).alias("status"))


def halved(values: list, query, least: int = 1) -> list:
    """Results of a query over a list of values; a batch that fails is halved until the values that fail stand alone, which are
    left out. For callers that ask a remote service from a partition."""
    try:
        return list(query(values))
    except Exception:
        if len(values) <= least:
            return []
        middle = len(values) // 2
        return halved(values[:middle], query, least) + halved(values[middle:], query, least)
