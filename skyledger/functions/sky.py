"""Positions on the sky: parsing, separations, propagation, cells and joins within a radius."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import text

MODES = ("catalogue", "provider", "referee", "annotation")


def parse_angle(value: Column, unit: Column, form: Column, is_ra: bool, mode: str) -> Column:
    """Degrees of an RA or Dec text. The modes differ in when an RA is in hours:

    catalogue: the unit says hours, the format is hms, or there is a colon and the unit isn't degrees; provider: a colon and the
    unit isn't degrees; referee: the unit says hours or the format is hms; annotation: an `h`, or a colon without a `d`.
    """
    v, u, f = F.trim(text(value)), F.lower(text(unit)), F.lower(text(form))
    colon, degrees = v.contains(":"), u.isin("deg", "degree", "degrees")
    hours = {
        "catalogue": u.contains("hour") | f.endswith("hms") | (colon & ~degrees),
        "provider": colon & ~degrees,
        "referee": u.contains("hour") | f.endswith("hms"),
        "annotation": v.contains("h") | (colon & ~v.contains("d")),
    }[mode]
    parts = F.filter(F.split(F.regexp_replace(v, "^[-+]", ""), r"[:hdms°'\"\s]+"), lambda p: p != "")
    number = lambda i: F.coalesce(F.get(parts, F.lit(i)).try_cast("double"), F.lit(0.0))
    fine = (F.size(parts) > 0) & F.forall(parts, lambda p: p.try_cast("double").isNotNull())
    size = number(0) + number(1) / 60.0 + number(2) / 3600.0
    degree = F.when(v.startswith("-"), -size).otherwise(size)
    return F.when(fine, F.when(hours, degree * 15.0).otherwise(degree) if is_ra else degree)


def separation(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Great-circle separation in arcseconds; null if a position is missing."""
    h = F.pow(F.sin(F.radians(dec2 - dec1) / 2), 2) + F.cos(F.radians(dec1)) * F.cos(F.radians(dec2)) * F.pow(F.sin(F.radians(ra2 - ra1) / 2), 2)
    return F.when(h.isNotNull(), F.degrees(2 * F.asin(F.least(F.lit(1.0), F.sqrt(h)))) * 3600.0)  # least() skips nulls


def propagated(ra: Column, dec: Column, pm_ra: Column, pm_dec: Column, years: Column) -> tuple[Column, Column]:
    """Position after years of proper motion in mas a year; the cosine has a floor of 1e-9."""
    return ra + pm_ra * years / 3.6e6 / F.greatest(F.cos(F.radians(dec)), F.lit(1e-9)), dec + pm_dec * years / 3.6e6


def healpix5(source_id: Column) -> Column:
    """Level 5 cell of a source id, by division in double precision."""
    return F.floor(source_id.cast("double") / 562949953421312.0).cast("bigint")


def position_slug(ra: Column, dec: Column) -> Column:
    """JHHMMSSss±DDMMSSs, rounded, with carry."""
    r = F.pmod(F.round(ra * 24000.0).cast("bigint"), F.lit(8640000))  # hundredths of a second of time
    d = F.round(F.abs(dec) * 36000.0).cast("bigint")
    return F.format_string("J%02d%02d%04d%s%02d%02d%03d", F.floor(r / 360000).cast("int"), (F.floor(r / 6000) % 60).cast("int"), (r % 6000).cast("int"), F.when(dec < 0, "-").otherwise("+"), F.floor(d / 36000).cast("int"), (F.floor(d / 600) % 60).cast("int"), (d % 600).cast("int"))


def _zone(dec: Column, size: float) -> Column:
    return F.floor((dec + 90.0) / size)


def _cells_in(zone: Column, size: float) -> Column:
    """Cells of a zone: as many as its widest circle allows."""
    low = F.greatest(F.lit(0.0), F.least(F.abs(zone * size - 90.0), F.abs((zone + 1) * size - 90.0)))
    high = F.greatest(F.abs(zone * size - 90.0), F.abs((zone + 1) * size - 90.0))
    return F.greatest(F.lit(1), F.floor(360.0 * F.cos(F.radians(F.least(F.lit(90.0), F.greatest(low, high)))) / size))


def within(left: DataFrame, right: DataFrame, radius_arcsec: float, inclusive: bool = False) -> DataFrame:
    """Pairs of left and right rows with columns prefixed l_ and r_ and their `sep`, closer than the radius.

    Both have ra, dec (degrees). The sky is cut into cells of twice the radius; a right row is copied to the nine cells around
    its own, so the join is on equal cells and its work grows with the number of near pairs. A crowded cell is a skewed key
    that adaptive execution splits. Rows without a position join nothing.
    """
    size = 2 * radius_arcsec / 3600.0
    l = left.where(F.col("ra").isNotNull() & F.col("dec").isNotNull())
    r = right.where(F.col("ra").isNotNull() & F.col("dec").isNotNull())
    zone = _zone(F.col("dec"), size)
    l = l.withColumn("_z", zone).withColumn("_n", _cells_in(F.col("_z"), size)).withColumn("_k", F.least(F.col("_n") - 1, F.floor(F.pmod(F.col("ra"), F.lit(360.0)) / 360.0 * F.col("_n"))))
    r = r.withColumn("_z", F.explode(F.sequence(zone - 1, zone + 1))).withColumn("_n", _cells_in(F.col("_z"), size))
    k = F.least(F.col("_n") - 1, F.floor(F.pmod(F.col("ra"), F.lit(360.0)) / 360.0 * F.col("_n")))
    r = r.withColumn("_k", F.explode(F.array_distinct(F.array(*(F.pmod(k + d, F.col("_n")) for d in (-1, 0, 1))))))
    l = l.drop("_n").select(*(F.col(c).alias(f"l_{c}") for c in l.columns if c != "_n"))
    r = r.select(*(F.col(c).alias(f"r_{c}") for c in r.columns if c != "_n"))
    met = l.join(r, (l.l__z == r.r__z) & (l.l__k == r.r__k)).withColumn("sep", separation(F.col("l_ra"), F.col("l_dec"), F.col("r_ra"), F.col("r_dec")))
    return met.where(F.col("sep") <= radius_arcsec if inclusive else F.col("sep") < radius_arcsec).drop("l__z", "l__k", "r__z", "r__k")
