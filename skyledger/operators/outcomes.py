"""What becomes of an object's dynamics: the source id and radial velocity that are used, why it is skipped, and the summary of
posterior draws."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers as nm
from ..functions import text as tx
from . import dynamics

NOT_AVAILABLE, LARGE, NO_ZERO_POINT = "gaia astrometry not available", "parallax uncertainty too large", "zero point correction not available"


def source_choice(canonical: Column, values: Column) -> Column:
    """struct<number, several>: the DR3-family id that an object uses, its canonical identifier's or the first of its values', and
    whether its values name several. number is null without one."""
    family = lambda v: tx.gaia_release(v).isin("DR3", "EDR3")
    numbers = F.array_distinct(F.transform(F.filter(F.concat(F.array(canonical), F.coalesce(values, F.array().cast("array<string>"))), lambda v: F.coalesce(family(v), F.lit(False))), tx.gaia_number))
    own = F.when(F.coalesce(family(canonical), F.lit(False)), tx.gaia_number(canonical))
    return F.struct(F.coalesce(own, F.get(numbers, F.lit(0))).alias("number"), (F.size(numbers) > 1).alias("several"))


def velocity_choice(choices: Column) -> Column:
    """struct<value, error, source, lower_limit, warning> of an object's radial velocity: of the literature's (array of value and error
    texts, in order) the one of smallest error, else the first; without any, the one of least speed of each draw."""
    made = F.transform(F.coalesce(choices, F.array().cast("array<struct<value:string,error:string>>")), lambda q, i: F.struct(nm.first_number(q["value"]).alias("v"), nm.first_number(q["error"]).alias("e"), i.alias("i")))
    usable = F.filter(made, lambda q: q["v"].isNotNull())
    sure = F.array_min(F.transform(F.filter(usable, lambda q: q["e"] > 0), lambda q: F.struct(q["e"].alias("e"), q["i"].alias("i"), q["v"].alias("v"))))
    first = F.get(usable, F.lit(0))
    say = lambda v, e, source, low, warning: F.struct(v.cast("double").alias("value"), e.cast("double").alias("error"), F.lit(source).alias("source"), F.lit(low).alias("lower_limit"), F.lit(warning).alias("warning"))
    none = F.lit(None)
    return (
        F.when(sure.isNotNull(), say(sure["v"], sure["e"], "literature", False, ""))
        .when(first.isNotNull(), say(first["v"], none, "literature", False, "radial_velocity_uncertainty_missing"))
        .otherwise(say(none, none, "minimum_grf_velocity", True, "minimum_grf_velocity_assumption"))
    )


def decided(objects: DataFrame) -> DataFrame:
    """object_id, status (ready or skipped), reason, number, warnings, and for a parallax that is too uncertain its ratio.

    objects: object_id, canonical, values (its identifiers), cached (struct of the provider's row: status, number, the fields of
    dynamics.REQUIRED and of the zero point, and zero_point itself), choices (radial velocities). The tests stand in the order in
    which they end the work: no id, no row of that id, bad astrometry, no zero point, a parallax of at most five errors.
    """
    x = objects.withColumn("_s", source_choice(F.col("canonical"), F.col("values")))
    row = F.col("cached")
    matched = F.coalesce(row["status"] == "matched", F.lit(False))
    own = F.col("_s.number")
    theirs = F.when(matched & row["number"].rlike(r"^\d+$"), row["number"])
    number = F.coalesce(own, theirs)
    fits = matched & F.coalesce((F.coalesce(row["number"], F.lit("")) == "") | (row["number"] == number), F.lit(False))
    bad = dynamics.astrometry_error({f: row[f] for f in dynamics.REQUIRED})
    zero = dynamics.corrected_parallax({f: row[f] for f in ("phot_g_mean_mag", "ecl_lat", "astrometric_params_solved", "parallax", "nu_eff_used_in_astrometry", "pseudocolour")}, row["zero_point"])
    ratio = zero["parallax"] / row["parallax_error"]
    reason = F.when(number.isNull() | ~fits, NOT_AVAILABLE).when(bad != "", NOT_AVAILABLE).when(zero["error"] != "", NO_ZERO_POINT).when(ratio <= 5, LARGE).otherwise("")
    rv = velocity_choice(F.col("choices"))
    warn = lambda when, what: F.when(when, F.lit(what))
    ready = reason == ""
    notes = F.array_compact(
        F.array(
            warn(F.col("_s.several"), "multiple_gaia_dr3_source_ids"),
            warn(own.isNull() & theirs.isNotNull(), "gaia_source_id_from_external_cache"),
            warn(number.isNotNull() & ~fits, "gaia_external_cache_missing"),
            warn(number.isNotNull() & fits & (bad != ""), "gaia_astrometry_invalid"),
            warn(number.isNotNull() & fits & (bad == "") & (zero["error"] != ""), "zero_point_correction_failed"),
            F.when(ready & (rv["warning"] != ""), rv["warning"]),
            warn(ready & rv["error"].isNull() & ~rv["lower_limit"], "radial_velocity_held_fixed"),
        )
    )
    return x.select(
        "object_id", F.when(ready, "ready").otherwise("skipped").alias("status"), reason.alias("reason"), number.alias("number"), notes.alias("warnings"),
        F.when(reason == LARGE, ratio).alias("corrected_parallax_over_error"), F.when(ready, rv).alias("radial_velocity"),
    )


def summary(draws: DataFrame, key: str, speed: str, escape: str) -> DataFrame:
    """key, draws, unbound draws and their share, percentiles of both speeds, mean of the Beta posterior, and `graveyard` (no draw is
    unbound). The escape speed is the caller's, from the potential of choice. Percentiles are exact, so an object's draws meet in
    one task; there are as many as the sampler made."""
    p = lambda c: F.percentile(c, F.array(F.lit(0.16), F.lit(0.5), F.lit(0.84)))
    g = draws.groupBy(key).agg(F.count("*").alias("n"), F.count(F.when(F.col(speed) > F.col(escape), 1)).alias("unbound"), p(speed).alias("_s"), p(escape).alias("_e"))
    _, _, mean = dynamics.jeffreys(F.col("unbound"), F.col("n"))
    cols = [F.round(F.col(c)[i], 10).alias(f"{name}_{q}") for name, c in (("speed", "_s"), ("escape", "_e")) for i, q in enumerate(("p16", "median", "p84"))]
    return g.select(key, "n", "unbound", F.round(F.col("unbound") / F.col("n"), 12).alias("unbound_fraction"), F.round(mean, 12).alias("p_unbound"), (F.col("unbound") == 0).alias("graveyard"), *cols)


def reasons(found: DataFrame) -> DataFrame:
    """Counts by status and reason: the histogram of a batch."""
    return found.groupBy("status", "reason").agg(F.count("*").alias("n"))
