"""What produced a quantity: its category by place and words, the actions that a method step tells of, and steps that mix them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words by which a quantity outside the typed groups is put in a category, in the order in which they are tried.
WORDS = {
    "bound_assessment": r"(?i)escape|unbound|bound[_ -]?probability|boundness|positive[_ -]?energy|escape[_ -]?margin",
    "origin": r"(?i)origin|ejection[_ -]?site|progenitor|galactic[_ -]?center|gc[_ -]?origin",
    "orbit": r"(?i)orbit|eccentricity|pericentre|pericenter|apocentre|apocenter|angular[_ -]?momentum|\blz\b|r[_ -]?min|r[_ -]?max|time[_ -]?of[_ -]?flight|flight[_ -]?time|disk[_ -]?cross",
    "distance": r"(?i)distance|dist\b|rgeo|photogeometric|heliocentric[_ -]?distance",
    "radial_velocity": r"(?i)radial[_ -]?velocity|\brv\b|vlos|line[_ -]?of[_ -]?sight",
    "velocity": r"(?i)velocity|v[_ -]?(?:tot|tan|gc|rf|grf|ej)|galactocentric[_ -]?v|galactic[_ -]?rest|azimuthal[_ -]?velocity",
    "stellar_parameter": r"(?i)stellar|spectral[_ -]?type|luminosity[_ -]?class|teff|log[_ -]?g|metallicity|\[?fe/h\]?|\bage\b|mass|abundance",
    "quality": r"(?i)ruwe|parallax[_ -]?over[_ -]?error|visibility[_ -]?period|significance|signal[_ -]?to[_ -]?noise|\bs/?n\b|transit|template|quality|flag",
    "photometric": r"(?i)photometr|magnitude|colour|color|redden|extinction|e\(b-v\)|bp-rp",
    "candidate_classification": r"(?i)classification|candidate[_ -]?status|ranking|score",
    "sample_selection": r"(?i)selection|selected|candidate[_ -]?sample|quality[_ -]?filtered",
}
#: Signals of an action in a step's outputs, those its type stands for, and pairs that one step should not join.
SIGNALS = {
    "distance": r"(?i)distance|photogeometric|bailer|parallax",
    "velocity": r"(?i)(?<!high[- ])(?<!hyper)velocit(?:y|ies)|galactocentric|tangential|v[_ -]?(?:tot|gc|rf|tan)",
    "orbit": r"(?i)orbit|integrat|trajectory|eccentricity|pericentre|apocentre",
    "bound_assessment": r"(?i)escape|bound|unbound|positive energy|\bp[_ -]?ub\b",
    "radial_velocity": r"(?i)radial velocity|\brv\b",
    "follow_up": r"(?i)follow[- ]?up|validation|observations?",
}
TOLD = {
    "distance": r"\b(?:estimating|estimated|derive[ds]?|comput(?:e|ed|ing))\b[^.]{0,80}\bdistances?\b",
    "velocity": r"\b(?:comput(?:e|ed|ing)|calculat(?:e|ed|ing)|conversion|converted)\b[^.]{0,100}\b(?:velocity|velocities|v[_ -]?(?:tot|gc|rf|tan)|galactocentric)\b",
    "orbit": r"\b(?:integrat(?:e|ed|ing)|traceback)\b|\b(?:comput(?:e|ed|ing)|calculat(?:e|ed|ing))\b[^.]{0,80}\b(?:orbit|trajectory)\b|\borbit integration using\b",
    "bound_assessment": r"\b(?:assess(?:ed|ing)?|classif(?:y|ied|ication)|compar(?:e|ed|ing))\b[^.]{0,120}\b(?:escape|bound|unbound|positive energy|p[_ -]?ub)\b",
    "radial_velocity": r"\b(?:measur(?:e|ed|ing|ement)|determin(?:e|ed|ing))\b[^.]{0,80}\b(?:radial velocity|rv)\b",
    "follow_up": SIGNALS["follow_up"],
}
OF_TYPE = {
    "distance_estimation": "distance", "radial_velocity_measurement": "radial_velocity", "velocity_calculation": "velocity", "escape_or_bound_assessment": "bound_assessment",
    "orbit_integration": "orbit", "origin_assessment": "origin", "follow_up_validation": "follow_up",
}
MIXED = (("distance", "velocity"), ("velocity", "orbit"), ("orbit", "bound_assessment"), ("radial_velocity", "follow_up"))
#: For a type of step, the signals that it implies always, and those that it implies unless its outputs name them.
IMPLIED = {
    "radial_velocity_measurement": ("radial_velocity", ("follow_up",), ()),
    "velocity_calculation": ("velocity", (), ("distance", "radial_velocity", "orbit")),
    "orbit_integration": ("orbit", ("velocity",), ("distance", "bound_assessment")),
    "escape_or_bound_assessment": ("bound_assessment", ("orbit", "velocity"), ("distance", "radial_velocity")),
    "origin_assessment": (None, ("velocity", "orbit"), ()),
    "galactic_potential_model": (None, ("orbit",), ("bound_assessment",)),
}


def category(location: Column, field: Column, q: Column) -> Column:
    """One of twelve categories, or null: the typed group decides, words only where there is none (or, for a spectrum, within it)."""
    inside = location.contains
    said = F.concat_ws(" ", field, q["name"], q["kind"], q["description"], q["unit"])
    words = F.lit(None).cast("string")
    for name, pattern in reversed(WORDS.items()):
        words = F.when(said.rlike(pattern), name).otherwise(words)
    observed = F.when(field.isin("ra", "dec", "parallax", "proper_motion_ra", "proper_motion_dec"), "catalog_observed").when(field == "distance", "distance").when(field == "radial_velocity", "radial_velocity")
    return (
        F.when(inside(".core.observed_phase_space.") & observed.isNotNull(), observed)
        .when(inside(".core.derived_kinematics."), "velocity")
        .when(inside(".core.bound_assessment."), "bound_assessment")
        .when(inside(".photometry["), "photometric")
        .when(inside(".spectroscopy["), F.when(said.rlike(WORDS["radial_velocity"]), "radial_velocity").otherwise("stellar_parameter"))
        .when(inside(".stellar_parameters.") | inside(".abundances["), "stellar_parameter")
        .when(inside(".quality_flags["), "quality")
        .when(inside(".orbit."), "orbit")
        .when(inside(".astrophysical_origin."), "origin")
        .otherwise(words)
    )


def signals(step_type: Column, outputs: Column, summary: Column) -> Column:
    """Actions that a step seems to perform: its type's, those of its outputs and those its summary tells of, without those that
    its type implies. Inputs say nothing: a velocity is made of distances without making them."""
    out = F.array_join(F.coalesce(outputs, F.array().cast("array<string>")), " ")
    told = F.lower(F.coalesce(summary, F.lit("")))
    told = F.when(told.rlike(r"\b(?:no|not|without)\b[^.]{0,80}\b(?:bound|unbound|escape)\b"), F.regexp_replace(told, SIGNALS["bound_assessment"], " ")).otherwise(told)
    told = {name: F.regexp_replace(told, r"\bused for orbit integration\b", " ") if name == "orbit" else told for name in TOLD}
    own = [F.when(step_type == t, s) for t, s in OF_TYPE.items()]
    named = {name: out.rlike(pattern) for name, pattern in SIGNALS.items()}
    every = F.array_distinct(F.array_compact(F.array(*own, *(F.when(named[n], n) for n in SIGNALS), *(F.when(told[n].rlike(p), n) for n, p in TOLD.items()))))
    kept = F.when(step_type == "input_catalog", F.array().cast("array<string>"))
    for t, (sign, always, unless) in IMPLIED.items():
        gone = F.array_compact(F.array(*(F.lit(x) for x in always), *(F.when(~named[x], x) for x in unless), F.lit(None).cast("string")))
        applies = step_type == t if sign is None else (step_type == t) & F.array_contains(every, sign)
        kept = kept.when(applies, F.array_except(every, gone))
    return F.array_sort(kept.otherwise(every))


def mixed_actions(found: Column) -> Column:
    """array of `a and b` for the pairs of actions that one step should not join."""
    return F.array_compact(F.array(*(F.when(F.array_contains(found, a) & F.array_contains(found, b), f"{a} and {b}") for a, b in MIXED)))


def compatible(categories: Column, allowed: dict[str, tuple[str, ...]]) -> Column:
    """Whether one type of step could produce all the categories; one of them, or one that is known, is always compatible."""
    every = F.array(*(F.struct(F.lit(k).alias("k"), F.array(*map(F.lit, v)).alias("types")) for k, v in allowed.items()))
    own = F.transform(F.filter(every, lambda e: F.array_contains(categories, e["k"])), lambda e: e["types"])
    none = F.lit(None).cast("array<string>")
    meet = F.aggregate(own, none, lambda a, t: F.when(a.isNull(), t).otherwise(F.array_intersect(a, t)))
    return (F.size(categories) <= 1) | (F.size(own) <= 1) | (F.size(meet) > 0)
