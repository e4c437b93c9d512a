"""Declarative validation: rules are data (name, severity, condition, message), violations are rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: For each quantity category, the step types that may produce it and those its lineage must contain.
PROVENANCE = {
    "catalog_observed": (("input_catalog", "astrometric_calibration"), ()),
    "radial_velocity": (("input_catalog", "radial_velocity_measurement"), ()),
    "distance": (("distance_estimation",), (("input_catalog", "astrometric_calibration"),)),
    "velocity": (("velocity_calculation",), (("input_catalog", "astrometric_calibration"),)),
    "bound_assessment": (("escape_or_bound_assessment",), (("velocity_calculation",), ("galactic_potential_model",))),
    "orbit": (("orbit_integration",), (("velocity_calculation",), ("galactic_potential_model",))),
    "origin": (("origin_assessment",), (("orbit_integration",),)),
    "stellar_parameter": (("stellar_parameter_inference", "photometric_or_sed_modeling"), ()),
    "photometric": (("input_catalog", "photometric_or_sed_modeling"), ()),
    "quality": (("quality_filter",), ()),
    "sample_selection": (("sample_selection", "quality_filter", "candidate_classification"), ()),
    "candidate_classification": (("candidate_classification", "escape_or_bound_assessment"), ()),
}

NUMERIC = r"^[-+]?(\d+(\.\d*)?|\.\d+)([eE][-+]?\d+)?$"


class Rule:
    def __init__(self, name: str, broken: Column, message: Column | str, severity: str = "error"):
        self.name, self.broken, self.severity = name, broken, severity
        self.message = F.lit(message) if isinstance(message, str) else message


def violations(df: DataFrame, location: Column, rules: list[Rule]) -> DataFrame:
    """location, rule, severity, message of every broken rule: one pass over the rows, whatever the number of rules."""
    made = F.array(*(F.when(r.broken, F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), r.message.alias("message"))) for r in rules))
    return df.select(location.alias("location"), F.explode(F.array_compact(made)).alias("v")).select("location", "v.rule", "v.severity", "v.message")


def quantity_rules(value: str, error: str, lower: str, upper: str, unit: str, kind: str) -> list[Rule]:
    """Rules of one quantity: plain numbers, matching errors, probabilities in range without unit, clean text."""
    v = lambda c: F.coalesce(F.trim(c), F.lit(""))
    odd = lambda c: (v(c) != "") & ~v(c).rlike(NUMERIC)
    p = v(value).try_cast("double")
    return [
        Rule("value_is_number", odd(value), F.concat(F.lit("not a plain number: "), v(value))),
        Rule("error_is_number", odd(error), "error is not a plain number"),
        Rule("one_kind_of_error", (v(error) != "") & ((v(lower) != "") | (v(upper) != "")), "both symmetric and asymmetric errors"),
        Rule("both_sides", (v(lower) != "") != (v(upper) != ""), "one side of an asymmetric error is missing"),
        Rule("probability_range", (F.col(kind) == "probability") & ~F.coalesce(p.between(0, 1), F.lit(False)), "probability outside 0 to 1"),
        Rule("probability_unit", (F.col(kind) == "probability") & (v(unit) != ""), "a probability has no unit"),
        Rule("clean_text", v(value).rlike(r"[\\${}]"), "markup in a machine value"),
    ]


def coordinate_rules(ra: str, dec: str) -> list[Rule]:
    return [Rule("ra_range", (F.col(ra) < 0) | (F.col(ra) >= 360), "RA outside [0, 360)"), Rule("dec_range", ~F.col(dec).between(-90, 90), "Dec outside [-90, 90]")]


#: Kinds of limit that a quantity may state.
LIMIT_KINDS = ("", "lower_limit", "upper_limit", "range")


def limit_rules(kind: str, value: str, lower: str, upper: str) -> list[Rule]:
    """Rules of a quantity that states a limit or a range: a limit is the value, a range has both ends and no value."""
    v = lambda c: F.coalesce(F.trim(c), F.lit(""))
    k, ends = F.coalesce(kind, F.lit("")), (v(lower) != "") | (v(upper) != "")
    bound = k.isin("lower_limit", "upper_limit")
    return [
        Rule("limit_kind", ~k.isin(*LIMIT_KINDS), "no such kind of limit"),
        Rule("range_without_kind", (k == "") & ends, "ends of a range need the kind 'range'"),
        Rule("range_of_a_limit", bound & ends, "a limit has no ends of a range"),
        Rule("limit_without_value", bound & (v(value) == ""), "the bound belongs in the value"),
        Rule("value_of_a_range", (k == "range") & (v(value) != ""), "a range leaves the value empty"),
        Rule("ends_of_a_range", (k == "range") & ((v(lower) == "") | (v(upper) == "")), "a range has both ends"),
    ]


def sexagesimal_rules(ra: str, dec: str) -> list[Rule]:
    """Minutes and seconds below 60, hours below 24, degrees within 90; a text without three numbers is left to other rules."""

    def parts(c: str) -> list[Column]:
        found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(\d+(?:\.\d+)?)"), F.lit(1))
        return [F.when(F.size(found) == 3, F.get(found, F.lit(i))).cast("double") for i in range(3)]

    (h, rm, rs), (d, dm, ds) = parts(ra), parts(dec)
    fine = lambda m, s: (m < 60) & (s < 60)
    return [
        Rule("ra_sixtieths", ~fine(rm, rs), "RA minutes and seconds outside [0, 60)"),
        Rule("dec_sixtieths", ~fine(dm, ds), "Dec minutes and seconds outside [0, 60)"),
        Rule("ra_hours", fine(rm, rs) & (h >= 24), "RA hours outside [0, 24)"),
        Rule("dec_degrees", fine(dm, ds) & (d > 90), "Dec degrees outside [-90, 90]"),
    ]


def producer_allowed(category: Column, step_type: Column) -> Column:
    """Whether a step of this type may produce a quantity of the category; null for a category without rules."""
    allowed = F.create_map(*(F.lit(x) if isinstance(x, str) else F.array(*map(F.lit, x)) for k, (types, _) in PROVENANCE.items() for x in (k, types)))
    return (step_type == "reported_value_adoption") | F.array_contains(allowed[category], step_type)


def lineage_gaps(category: Column, step_type: Column, lineage: Column) -> Column:
    """How many groups of required types the lineage (array of step types, the step's own included) holds none of; an adopted
    value needs none."""
    gaps = F.lit(0)
    for k, (_, groups) in PROVENANCE.items():
        for g in groups:
            gaps = gaps + F.when((category == k) & ~F.arrays_overlap(lineage, F.array(*map(F.lit, g))), 1).otherwise(0)
    return F.when(step_type == "reported_value_adoption", 0).otherwise(gaps)


def duplicates(df: DataFrame, document: str, value: str) -> DataFrame:
    """Values that occur more than once in a document, with their number."""
    return df.where(F.col(value).isNotNull() & (F.col(value).cast("string") != "")).groupBy(document, value).agg(F.count("*").alias("n")).where("n > 1")


def grouped(found: DataFrame, index: str) -> DataFrame:
    """Messages grouped by rule with their index lists as ranges (`1-3,5`).

    A run starts at an index whose predecessor is absent and ends where the successor is: two joins on (rule, index), so only the
    runs of a rule meet, not its rows.
    """
    each = found.select("rule", F.col(index).alias("i")).distinct()
    first = each.join(each.select("rule", (F.col("i") + 1).alias("i")), ["rule", "i"], "left_anti")
    last = each.join(each.select("rule", (F.col("i") - 1).alias("i")), ["rule", "i"], "left_anti")
    ends = lambda x, name: x.groupBy("rule").agg(F.array_sort(F.collect_list("i")).alias(name))
    label = lambda a, b: F.when(a == b, a.cast("string")).otherwise(F.concat_ws("-", a.cast("string"), b.cast("string")))
    lists = ends(first, "a").join(ends(last, "b"), "rule").select("rule", F.array_join(F.zip_with("a", "b", label), ",").alias("indexes"))
    return found.groupBy("rule").agg(F.count("*").alias("n")).join(lists, "rule")


def unknown_keys(raw: Column, known: list[str]) -> Column:
    """Keys of a JSON object that a strict model forbids."""
    return F.array_sort(F.array_except(F.map_keys(F.from_json(raw, "map<string,string>")), F.array(*map(F.lit, known))))
