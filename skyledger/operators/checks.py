"""Validation of paper documents as data: each rule is a condition over one row of a flat table, each violation a row.

Tables come from papers.py: quantities, candidates, steps, references. A rule that needs several rows (an order, a duplicate, a
lineage) gets them as a window or an array of the same document, whose steps and candidates are few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from . import papers, rules
from .rules import Rule

#: Vocabularies of the record model.
STATUSES = ("candidates_found", "no_candidates", "partial", "needs_review", "source_missing")
LABELS = ("hvs_candidate", "hyper_runaway_candidate", "escaping_star", "unbound_star", "high_velocity_star", "runaway_candidate", "candidate_group_member", "other")
CLAIMS = ("unbound", "likely_unbound", "possibly_unbound", "escaping", "not_reported")
BASES = ("explicit_candidate_text", "explicit_unbound_text", "cited_prior_candidate_reassessed", "candidate_table_with_text_anchor")
CONFIDENCE = ("high", "medium", "low")
ORIGINS = ("introduced_by_this_paper", "cited_from_literature")
STEP_TYPES = (
    "input_catalog", "sample_selection", "cross_match", "quality_filter", "astrometric_calibration", "distance_estimation", "radial_velocity_measurement",
    "stellar_parameter_inference", "photometric_or_sed_modeling", "velocity_calculation", "solar_position_and_motion", "galactic_potential_model",
    "escape_or_bound_assessment", "orbit_integration", "origin_assessment", "candidate_classification", "follow_up_validation", "reported_value_adoption", "other",
)
PARAMETERS = ("R0", "z0", "v_circ_sun", "solar_motion_u", "solar_motion_v", "solar_motion_w", "potential_name", "escape_velocity_definition", "other")
TEXTUAL = ("potential_name", "escape_velocity_definition", "other")
FORMATS = ("decimal_degrees", "sexagesimal_hms", "sexagesimal_dms", "sexagesimal_colon")
EPOCHS = ("reference_epoch", "equinox", "ambiguous", "not_reported")
#: Patterns of machine values, limits, frames and phrases.
NUMBER = r"^[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?$"
RESIDUE = r"\\[A-Za-z]+|[{}$]|[\^_]|\+/-|±"
ASYMMETRIC = r"\^\s*\{?\s*\+[^}_\s]+\}?\s*_\s*\{?\s*-[^}\s]+|_\s*\{?\s*-[^}^\s]+\}?\s*\^\s*\{?\s*\+[^}\s]+"
SYMMETRIC = r"\+/-|±|\\pm"
LIMIT_MARK = r">|<|\\geq|\\leq|\\gtrsim|\\lesssim|≥|≤|≳|≲"
FRAME = r"(?i)\b(?:ICRS|FK[45]|J\d{4}(?:\.\d+)?|epoch|equinox)\b"
SHAPES = {
    "sexagesimal_hms": r"^[+-]?\d{1,2}h\d{1,2}m\d{1,2}(?:\.\d+)?s?$",
    "sexagesimal_dms": r"^[+-]?\d{1,3}[d°]\d{1,2}[m']\d{1,2}(?:\.\d+)?[s\"]?$",
    "sexagesimal_colon": r"^[+-]?\d{1,3}:\d{1,2}:\d{1,2}(?:\.\d+)?$",
}
BOUND_PHRASE = r"(?i)\bbound\s+to\s+the\s+Galaxy|\bcurrently\s+bound|\bbound\s+trajectory|remains?\s+Galaxy[- ]bound"
POSITIVE = r"(?i)classif\w+(?:\s+\w+){0,3}\s+as\s+HVSs?|HVS\s+status|gravitationally\s+unbound|positive\s+(?:total\s+)?energ(?:y|ies)"
_NOT, _FAST = r"(?:\b(?:does|do|did)\s+not\b|\bnot\b|\bno\b|\bwithout\b)", r"\b(?:HVS|hypervelocity|unbound|escaping|positive\s+(?:total\s+)?energ(?:y|ies))\b"
NEGATED = rf"(?i){_NOT}.{{0,120}}{_FAST}|{_FAST}.{{0,120}}{_NOT}"
STANDARD = (
    r"(?i)probab|p[_ -]?(?:esc|ub|unbound|bound|mw|lmc)|likelihood|photometr|magnitude|colour|color|spectr|abundance|\[?[a-z]{1,2}/h\]?|orbit|eccentricity|"
    r"pericentre|pericenter|apocentre|apocenter|origin|ejection|flight[_ -]?time|disk[_ -]?cross|ruwe|quality|flag|teff|log[_ -]?g|metallicity|mass|luminosity"
)
QUANTITATIVE = (
    r"(?i)velocity|speed|distance|parallax|proper[_ -]?motion|radial[_ -]?velocity|escape|energy|eccentricity|mass|age|magnitude|luminosity|temperature|teff|"
    r"log[_ -]?g|metallicity|\[?fe/h\]?|probability|ratio|angular[_ -]?momentum|\blz\b|transit|count|period|time[_ -]?of[_ -]?flight|flight[_ -]?time|ruwe|gof|"
    r"chi|signal[_ -]?to[_ -]?noise|\bs/?n\b|snr"
)
GAIA = r"^Gaia E?DR[0-9]+ [0-9]+$"
#: Line patterns without substance (page marks, structure commands, assignments).
HOLLOW = (
    r"(?i)^---\s*Page\s+\d+\s*---$",
    r"^\\(?:section|subsection|subsubsection|paragraph|chapter|part|begin|end|maketitle|keywords|label|bibliography|bibliographystyle)\*?(?:\[[^\]]*\])?(?:\{[^{}]*\})?\s*$",
    r"^[A-Za-z_][A-Za-z0-9_]*\s*=\s*[^,]+,?\s*$",
)


def blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def has(c: Column) -> Column:
    return ~blank(c)


def residue(c: Column) -> Column:
    """Whether a machine value is missing or keeps markup."""
    return c.isNull() | c.rlike(RESIDUE)


# --- quantities: tables with location, field and q --------------------------------------------------------------------


def must_be_number(location: Column, field: Column, q: Column) -> Column:
    """Whether the machine fields of a quantity must be plain numbers, by its place."""
    inside = lambda part: location.contains(part)
    searchable = F.concat_ws(" ", q["name"], q["kind"], q["description"])
    return (
        F.when(inside(".core.derived_kinematics.") | inside(".core.bound_assessment."), True)
        .when(inside(".core.observed_phase_space."), field.isin("distance", "parallax", "proper_motion_ra", "proper_motion_dec", "radial_velocity"))
        .when(inside(".photometry[") | inside(".abundances[") | inside(".orbit."), True)
        .when(inside(".stellar_parameters."), field != "spectral_type")
        .when(inside(".astrophysical_origin.hypothesis_metrics["), ~q["metric_type"].eqNullSafe(F.lit("classification")))
        .when(inside(".astrophysical_origin."), ~field.isin("origin_site", "origin_classification"))
        .when(inside(".extra["), has(q["unit"]) | searchable.rlike(QUANTITATIVE))
        .otherwise(False)
    )


def number_rules(location: Column, field: Column, q: Column) -> list[Rule]:
    numeric = must_be_number(location, field, q)
    return [Rule(f"{k}_not_plain", numeric & has(q[k]) & ~F.trim(q[k]).rlike(NUMBER), f"{k} is no single plain number") for k in ("value", "error", "lower_error", "upper_error")]


def probability_rules(location: Column, q: Column) -> list[Rule]:
    here = location.contains(".core.bound_assessment.bound_probability") | location.contains(".core.bound_assessment.unbound_probability")
    plain = F.coalesce(F.trim(q["value"]).rlike(NUMBER), F.lit(False))
    return [
        Rule("probability_not_plain", here & ~plain, "a probability is a plain fraction"),
        Rule("probability_outside", here & plain & ~F.coalesce(F.trim(q["value"]).try_cast("double").between(0, 1), F.lit(False)), "a probability lies in 0 to 1"),
        Rule("probability_unit", here & plain & has(q["unit"]), "a probability has no unit"),
    ]


def uncertainty_rules(q: Column) -> list[Rule]:
    """Marks of an error in the raw value need the fields they stand for."""
    raw = F.coalesce(q["raw_value"], F.lit(""))
    two = raw.rlike(ASYMMETRIC)
    empty = lambda f: F.coalesce(q[f], F.lit("")) == ""
    return [
        Rule("lower_error_missing", two & empty("lower_error"), "an asymmetric raw value needs lower_error"),
        Rule("upper_error_missing", two & empty("upper_error"), "an asymmetric raw value needs upper_error"),
        Rule("error_missing", ~two & raw.rlike(SYMMETRIC) & empty("error"), "a symmetric raw value needs error"),
    ]


def text_rules(q: Column) -> list[Rule]:
    """Machine text without markup, a raw value, and limits that agree with their fields."""
    limits = rules.limit_rules(q["limit_kind"], q["value"], q["range_lower"], q["range_upper"])
    bound = q["limit_kind"].isin("lower_limit", "upper_limit")
    ranged = (q["limit_kind"] == "range") & has(q["range_lower"]) & has(q["range_upper"])
    return [
        Rule("value_markup", residue(q["value"]), "markup in a machine value"),
        *(Rule(f"{f}_markup", (F.coalesce(q[f], F.lit("")) != "") & residue(q[f]), f"markup in {f}") for f in ("error", "lower_error", "upper_error")),
        Rule("raw_value_missing", q["raw_value"].isNull(), "a quantity needs its raw value"),
        *limits,
        Rule("no_limit_mark", bound & (q["raw_value"] != "") & ~q["raw_value"].rlike(LIMIT_MARK), "the raw value shows no limit", "warning"),
        *(Rule(f"{f}_markup", ranged & residue(q[f]), f"markup in {f}") for f in ("range_lower", "range_upper")),
    ]


def reference_rules(q: Column) -> list[Rule]:
    """A quantity names sources; one that quotes a table cell quotes the raw value."""
    refs = F.coalesce(q["source_refs"], F.array().cast(f"array<{papers.REF}>"))
    quoted = lambda r: F.coalesce(F.nullif(r["component_raw_value"], F.lit("")), r["raw_value"])
    return [
        Rule("source_refs_missing", F.size(refs) == 0, "expected at least one source reference"),
        Rule("cell_not_raw_value", F.exists(refs, lambda r: is_cell(r) & ~quoted(r).eqNullSafe(q["raw_value"])), "a table reference quotes another value"),
    ]


def quantity_rules(complete: bool) -> list[Rule]:
    """All rules of one row (location, field, q, and steps: the document's step types by id)."""
    location, field, q = F.col("location"), F.col("field"), F.col("q")
    return [*text_rules(q), *uncertainty_rules(q), *number_rules(location, field, q), *probability_rules(location, q), *reference_rules(q), *method_ref_rules(q, F.col("steps"), complete)]


def method_ref_rules(q: Column, steps: Column, complete: bool) -> list[Rule]:
    """Method references name steps of the chain; a complete document has exactly one for each quantity."""
    refs, none = q["method_refs"], F.array().cast("array<string>")
    unknown = F.array_except(F.filter(F.coalesce(refs, none), lambda r: r != ""), F.map_keys(steps))
    return [
        Rule("method_refs_missing", refs.isNull(), "a quantity needs method references"),
        Rule("method_ref_count", refs.isNotNull() & (F.size(refs) != 1) & F.lit(complete), "exactly one direct step is expected"),
        Rule("method_ref_empty", F.exists(F.coalesce(refs, none), lambda r: F.coalesce(r, F.lit("")) == ""), "an empty step id"),
        Rule("method_ref_unknown", F.size(unknown) > 0, F.concat(F.lit("no such step: "), F.array_join(F.array_sort(unknown), ", "))),
    ]


def needs_solar_lineage(category: Column, field: Column) -> Column:
    return (category == "bound_assessment") | ((category == "velocity") & field.rlike("(?i)galactocentric|rest_frame"))


def producer_rules(category: Column, field: Column, step_type: Column, lineage: Column) -> list[Rule]:
    """The direct step may produce the category, and what it builds on holds the required types. lineage: types, its own included."""
    allowed = F.coalesce(rules.producer_allowed(category, step_type), F.lit(False))
    judged = category.isNotNull() & allowed & (step_type != "reported_value_adoption")
    return [
        Rule("producer_type", category.isNotNull() & ~allowed, "this type of step does not produce such a quantity"),
        Rule("lineage_gap", judged & (rules.lineage_gaps(category, step_type, lineage) > 0), "the lineage lacks a required type"),
        Rule("solar_step", judged & needs_solar_lineage(category, field) & ~F.array_contains(lineage, "solar_position_and_motion"), "no solar position and motion", "warning"),
    ]


def incompatible_steps(used: DataFrame) -> DataFrame:
    """path, step, categories of steps that produce categories without a common type. used: path, step, category, repeated at will."""
    shared = F.lit(None).cast("array<string>")
    every = F.array(*(F.struct(F.lit(k).alias("k"), F.array(*map(F.lit, types)).alias("types")) for k, (types, _) in rules.PROVENANCE.items()))
    x = used.groupBy("path", "step").agg(F.array_sort(F.collect_set("category")).alias("categories"))
    own = F.transform(F.filter(every, lambda e: F.array_contains(F.col("categories"), e["k"])), lambda e: e["types"])
    meet = F.aggregate(own, shared, lambda a, t: F.when(a.isNull(), t).otherwise(F.array_intersect(a, t)))
    return x.where((F.size("categories") > 1) & (F.size(own) > 1) & (F.size(meet) == 0))


# --- coordinates ------------------------------------------------------------------------------------------------------


def context_rules(c: Column, kind: str) -> list[Rule]:
    """Rules of the reference frame or epoch that a coordinate states."""
    basis = F.lower(F.trim(F.coalesce(c["inference_basis"], F.lit(""))))
    value = F.lower(F.trim(F.coalesce(c["value"], F.lit(""))))
    sourced = F.coalesce(F.size(c["source_refs"]), F.lit(-1)) > 0
    unknown, absent = value.isin("", "unknown"), basis.isin("not_in_reference", "not_reported")
    out = [
        Rule(f"{kind}_missing", c.isNull(), f"{kind} is missing"),
        Rule(f"{kind}_value", c.isNotNull() & blank(c["value"]), "expected a value or 'unknown'"),
        Rule(f"{kind}_source", c.isNotNull() & ~sourced, "no source reference", "warning"),
        Rule(f"{kind}_unknown", c.isNotNull() & (unknown | absent) & ~(unknown & absent & sourced), "unknown, and not documented as such", "warning"),
    ]
    if kind == "epoch":
        out.append(Rule("epoch_kind", c.isNotNull() & ~F.coalesce(c["epoch_kind"].isin(*EPOCHS), F.lit(False)), "no such kind of epoch"))
    return out


def coordinate_rules(field: Column, q: Column) -> list[Rule]:
    """Format, unit, content and range of one right ascension or declination."""
    f, value = F.coalesce(q["coordinate_format"], F.lit("")), F.coalesce(F.trim(q["value"]), F.lit(""))
    unit, ra = F.lower(F.coalesce(F.trim(q["unit"]), F.lit(""))), field == "ra"
    degrees, hours = unit.isin("deg", "degree", "degrees"), unit == "hourangle"
    fits = (
        F.when(f == "decimal_degrees", degrees)
        .when(f == "sexagesimal_hms", ra & hours)
        .when(f == "sexagesimal_dms", ~ra & degrees)
        .when(f == "sexagesimal_colon", F.when(ra, hours).otherwise(degrees))
        .otherwise(True)
    )
    plain = value.rlike(NUMBER)
    d = value.try_cast("double")
    parts = [F.regexp_extract(value, r"^([+-]?\d{1,3})[:hd°](\d{1,2})[:m'](\d{1,2}(?:\.\d+)?)[s\"]?$", i).try_cast("double") for i in (1, 2, 3)]
    sixty = (parts[1] < 60) & (parts[2] < 60)
    decimal, sexagesimal = f == "decimal_degrees", f.isin(*SHAPES)
    shape = F.lit(True)
    for name, pattern in SHAPES.items():
        shape = F.when(f == name, value.rlike(pattern)).otherwise(shape)
    any_of = lambda fields, test: F.coalesce(F.greatest(*(F.coalesce(test(q[x]), F.lit(False)) for x in fields)), F.lit(False))
    return [
        Rule("format", ~f.isin(*FORMATS), "no such coordinate format"),
        Rule("unit_missing", unit == "", "a coordinate needs a unit"),
        Rule("unit_of_format", (unit != "") & ~fits, "the unit does not fit the format"),
        Rule("several_values", any_of(("value", "raw_value"), lambda c: c.rlike(r"[,()]")), "more than one component, or prose"),
        Rule("frame_in_field", any_of(("value", "raw_value", "unit", "description"), lambda c: c.rlike(FRAME)), "frame or epoch have fields of their own"),
        Rule("not_plain", decimal & ~plain, "a decimal coordinate is a plain number"),
        Rule("ra_outside", decimal & plain & ra & ~((d >= 0) & (d < 360)), "RA outside [0, 360)"),
        Rule("dec_outside", decimal & plain & ~ra & ~d.between(-90, 90), "Dec outside [-90, 90]"),
        Rule("shape", sexagesimal & ~shape, "the value does not have the shape of its format"),
        Rule("sixtieths", sexagesimal & ~sixty, "minutes and seconds lie in [0, 60)"),
        Rule("hours", sexagesimal & sixty & ra & ~((parts[0] >= 0) & (parts[0] < 24)), "hours lie in [0, 24)"),
        Rule("degrees", sexagesimal & sixty & ~ra & ~parts[0].between(-90, 90), "degrees lie in [-90, 90]"),
        *context_rules(q["reference_frame"], "reference_frame"),
        *context_rules(q["epoch"], "epoch"),
    ]


# --- candidates -------------------------------------------------------------------------------------------------------


def in_(c: Column, values) -> Column:
    return F.coalesce(c.isin(*values), F.lit(False))


def inclusion_rules(a: Column) -> list[Rule]:
    labels = F.coalesce(a["paper_labels"], F.array().cast("array<string>"))
    return [
        Rule("summary", blank(a["summary"]), "no rationale"),
        Rule("labels_missing", F.size(labels) == 0, "expected at least one label"),
        Rule("label_unknown", F.size(F.array_except(labels, F.array(*map(F.lit, LABELS)))) > 0, "no such label"),
        Rule("label_twice", F.size(F.array_distinct(labels)) < F.size(labels), "a label occurs twice"),
        Rule("claim", ~in_(a["galactic_bound_claim"], CLAIMS), "no such claim"),
        Rule("basis", ~in_(a["inclusion_basis"], BASES), "no such basis"),
        Rule("confidence", ~in_(a["extraction_confidence"], CONFIDENCE), "no such confidence"),
        Rule("confidence_reason", blank(a["confidence_reason"]), "no reason for the confidence"),
        *evidence_rules("inclusion", a["source_refs"]),
    ]


def evidence_rules(name: str, refs: Column) -> list[Rule]:
    """References that cite the paper's text and nothing but text."""
    some = F.coalesce(refs, F.array().cast(f"array<{papers.REF}>"))
    return [
        Rule(f"{name}_refs", F.size(some) == 0, "expected at least one source reference"),
        Rule(f"{name}_no_text", ~F.exists(some, is_paper_text), "expected a reference to the paper's text"),
        Rule(f"{name}_not_text", F.exists(some, lambda r: suffix(r["path"]).isin(".json", ".bib", ".bbl", ".ecsv")), "evidence cites text, not metadata"),
    ]


def origin_rules(o: Column) -> list[Rule]:
    cited, cite = o["origin_type"] == "cited_from_literature", o["citation"]
    return [
        Rule("origin_type", ~in_(o["origin_type"], ORIGINS), "no such origin"),
        Rule("reassesses", o["paper_reassesses_unbound_status"].isNull(), "expected true or false"),
        *evidence_rules("origin", o["source_refs"]),
        Rule("citation_missing", cited & cite.isNull(), "a cited candidate needs its citation"),
        Rule("bibkey_missing", cited & cite.isNotNull() & blank(cite["bibkey"]), "a cited candidate needs a key"),
        *citation_rules(cite, F.coalesce(cited, F.lit(False))),
    ]


def structured(cite: Column) -> Column:
    """Whether a citation has a field that a bibliography could support."""
    some = F.lit(False)
    for f in papers.CITATION:
        some = some | has(cite[f])
    return some | F.coalesce(F.exists(cite["authors"], has), F.lit(False))


def citation_rules(cite: Column, required: Column) -> list[Rule]:
    none = F.array().cast(f"array<{papers.REF}>")
    around, listed = F.coalesce(cite["citation_context_refs"], none), F.coalesce(cite["bibliography_refs"], none)
    asked = cite.isNotNull() & (required | cite["citation_context_refs"].isNotNull())
    wanted = cite.isNotNull() & (required | cite["bibliography_refs"].isNotNull() | structured(cite))
    bib = lambda r: suffix(r["path"]).isin(".bib", ".bbl")
    return [
        Rule("citation_context", asked & ~F.exists(around, is_paper_text), "expected where the paper cites it"),
        Rule("bibliography_missing", wanted & ~F.exists(listed, bib), "expected a bibliography entry"),
        Rule("bibliography_only", wanted & F.exists(listed, bib) & ~F.forall(listed, bib), "only bibliography entries belong here"),
    ]


def bibliography_rules(cite: Column, entries: Column) -> list[Rule]:
    """A citation's fields occur in the text of its bibliography entries (`entries`, empty if it can't be read)."""
    text = F.coalesce(entries, F.lit(""))
    key = F.trim(F.coalesce(cite["bibkey"], F.lit("")))
    keys = F.concat(F.regexp_extract_all(text, F.lit(r"@\w+\s*\{\s*([^\s,{}]+)\s*,"), F.lit(1)), F.regexp_extract_all(text, F.lit(r"\\bibitem(?:\[[^\]]*\])?\s*\{\s*([^\s{}]+)\s*\}"), F.lit(1)))
    readable = has(text)
    return [
        Rule("bibliography_unreadable", structured(cite) & ~readable, "no readable bibliography entry"),
        Rule("bibkey_unsupported", readable & (key != "") & ~F.array_contains(keys, key), "no entry has this key"),
        Rule("author_unsupported", readable & F.coalesce(F.exists(cite["authors"], lambda a: blank(a) | ~supported(a, text)), F.lit(False)), "an author is not in the entries"),
        *(Rule(f"{f}_unsupported", readable & (F.coalesce(cite[f], F.lit("")) != "") & ~supported(cite[f], text), f"{f} is not in the entries") for f in papers.CITATION[1:]),
    ]


#: Words that show no agreement of two texts.
STOP = (
    "and", "are", "caption", "context", "data", "description", "field", "fields", "for", "from", "line", "lines", "object", "objects", "paper", "reference", "references",
    "section", "source", "table", "text", "that", "the", "this", "value", "values", "were", "with",
)


def supported(value: Column, text: Column) -> Column:
    """All terms of a value stand in a text; a value without terms must stand in it as letters and digits."""
    terms = tx.terms(value, STOP)
    return F.when(F.size(terms) > 0, F.size(F.array_except(terms, tx.terms(text, STOP))) == 0).otherwise(tx.letters_only(text).contains(tx.letters_only(value)))


def overlaps_weakly(values: list[Column], text: Column) -> Column:
    """Whether any term of the values stands in a text, as a term or inside a word; values without terms agree with all."""
    terms = F.array_distinct(F.concat(*(tx.terms(v, STOP) for v in values)))
    low = F.lower(F.coalesce(text, F.lit("")))
    return (F.size(terms) == 0) | F.exists(terms, lambda t: low.contains(t))


def identifier_rules(c: Column, arxiv_id: Column, complete: bool) -> list[Rule]:
    """Form and agreement of a candidate's identifiers; duplicates over a document are another function."""
    i = c["identifiers"]
    every = F.transform(F.coalesce(i["all"], F.array().cast(f"array<struct<value:string,source_refs:array<{papers.REF}>>>")), lambda x: F.trim(x["value"]))
    some = F.filter(every, lambda v: F.coalesce(v, F.lit("")) != "")
    record, own, gaia = (F.trim(F.coalesce(i[f], F.lit(""))) for f in ("record_id", "paper_candidate_id", "gaia_source_id"))
    shaped = record.startswith(F.concat(arxiv_id, F.lit(":cand-"))) & record.rlike(r":cand-[0-9]{3}$") & (F.length(record) == F.length(arxiv_id) + 9)
    return [
        Rule("record_id_missing", record == "", "no record id"),
        Rule("record_id_form", (record != "") & ~F.coalesce(shaped, F.lit(False)), "expected the paper's id and cand-XXX"),
        Rule("own_id_missing", own == "", "no identifier of the paper's"),
        Rule("gaia_form", (gaia != "") & ~gaia.rlike(GAIA), "not a strict source id"),
        Rule("all_missing", F.size(every) == 0, "no identifiers"),
        Rule("identifier_empty", F.size(some) < F.size(every), "an empty identifier"),
        Rule("identifier_unsourced", F.lit(complete) & F.exists(F.coalesce(i["all"], F.array().cast(f"array<struct<value:string,source_refs:array<{papers.REF}>>>")), lambda x: F.coalesce(F.size(x["source_refs"]), F.lit(0)) < 1), "an identifier without a source"),
        Rule("identifier_twice", F.size(F.array_distinct(some)) < F.size(some), "an identifier occurs twice"),
        Rule("record_id_among_all", (record != "") & F.array_contains(some, record), "the record id is internal"),
        Rule("own_id_not_among_all", (own != "") & (F.size(every) > 0) & ~F.array_contains(some, own), "the paper's identifier is not among all"),
        Rule("gaia_not_among_all", (gaia != "") & (F.size(every) > 0) & ~F.array_contains(some, gaia), "the source id is not among all"),
        Rule("gaia_not_set", (gaia == "") & F.exists(some, lambda v: v.rlike(GAIA)), "a strict source id among all must be set"),
    ]


def content_rules(c: Column) -> list[Rule]:
    """Groups that exist, standard quantities in their place, and no word of a bound star."""
    a = c["inclusion_assessment"]
    searchable = lambda q: F.concat_ws(" ", *(F.coalesce(q[f], F.lit("")) for f in ("name", "kind", "description", "unit", "raw_value")))
    groups = F.coalesce(F.map_keys(c["core"]), F.array().cast("array<string>"))
    names = F.array(*map(F.lit, papers.CORE))
    return [
        *(Rule(f"{f}_missing", c[f].isNull(), f"{f} is missing") for f in papers.CANDIDATE_KEYS),
        Rule("core_group_unknown", F.size(F.array_except(groups, names)) > 0, "no such core group"),
        Rule("core_group_missing", c["core"].isNotNull() & (F.size(F.array_except(names, groups)) > 0), "a core group is missing"),
        Rule("standard_in_extra", F.coalesce(F.exists(c["extra"], lambda q: searchable(q).rlike(STANDARD)), F.lit(False)), "a standard quantity stands in extra"),
        Rule("bound_phrase", F.coalesce(a["summary"].rlike(BOUND_PHRASE), F.lit(False)), "the evidence says that the star is bound"),
    ]


def repeated_identifiers(found: DataFrame) -> DataFrame:
    """path, kind, value, n and first of identifiers that several candidates of a document share."""
    ids = F.col("c.identifiers")
    each = F.array(*(F.struct(F.lit(f).alias("kind"), F.trim(ids[f]).alias("value")) for f in ("record_id", "paper_candidate_id", "gaia_source_id")))
    x = found.select("path", "index", F.explode(each).alias("i")).where("i.value <> ''")
    return x.groupBy("path", "i.kind", "i.value").agg(F.count("*").alias("n"), F.min("index").alias("first")).where("n > 1")


# --- documents --------------------------------------------------------------------------------------------------------


def document_rules(doc: Column, complete: bool) -> list[Rule]:
    """Status, candidates and completion of a document."""
    status, n = doc["extraction"]["status"], F.coalesce(F.size(doc["candidates"]), F.lit(0))
    tool = doc["extraction"]["tooling"]
    done = F.lit(complete)
    return [
        Rule("arxiv_id_missing", blank(doc["paper"]["arxiv_id"]), "no paper id"),
        Rule("status", ~in_(status, STATUSES), "no such status"),
        Rule("candidates_unexpected", (status == "no_candidates") & (n > 0), "candidates in spite of the status"),
        Rule("candidates_missing", (status == "candidates_found") & (n == 0), "no candidates in spite of the status"),
        Rule("groups_missing", (status == "no_candidates") & (F.coalesce(F.size(doc["candidate_groups_considered"]), F.lit(0)) < 1), "groups considered are required"),
        Rule("needs_review", done & (status == "needs_review"), "not complete"),
        Rule("summary_missing", done & (status != "source_missing") & blank(doc["extraction"]["summary"]), "no summary"),
        Rule("tooling_missing", done & tool.isNull(), "no tooling"),
        *(Rule(f"{f}_missing", done & tool.isNotNull() & blank(tool[f]), f"no {f}") for f in ("model_id", "prompt_version")),
    ]


def group_rules(g: Column, status: Column) -> list[Rule]:
    """Rules of a group of objects that a paper considered; words of a candidate without a negation call for a review."""
    like = F.lit(False)
    for f in ("description", "reason", "decision"):
        like = like | F.coalesce(g[f].rlike(POSITIVE) & ~g[f].rlike(NEGATED), F.lit(False))
    evidence = [Rule(r.name, g["source_refs"].isNotNull() & r.broken, r.message, r.severity) for r in evidence_rules("group", g["source_refs"])]
    return [Rule("group_refs_missing", (status == "no_candidates") & g["source_refs"].isNull(), "references are required"), *evidence, Rule("group_like_candidate", like, "words of a candidate", "warning")]


def steps(docs: DataFrame) -> DataFrame:
    """path, index, step, and what its rules need: the numbers and ids before it."""
    x = docs.where("doc is not null").select("path", F.col("doc.method_chain").alias("chain")).select("path", "chain", F.posexplode("chain").alias("index", "step"))
    before = F.transform(F.slice("chain", F.lit(1), F.col("index")), lambda s: s["id"])
    number = lambda i: F.regexp_extract(i, r"^step-(\d{2})$", 1).try_cast("int")
    return x.select("path", "index", F.format_string("$.method_chain[%d]", "index").alias("location"), "step", before.alias("before"), F.array_max(F.transform(before, number)).alias("last"), number(F.col("step.id")).alias("number"))


def step_rules() -> list[Rule]:
    """Ids in order, known types, and references to earlier steps only, which also rules out cycles."""
    s, before = F.col("step"), F.col("before")
    needs = F.coalesce(s["depends_on"], F.array().cast("array<string>"))
    told = F.lower(F.coalesce(s["summary"], F.lit("")))
    p = F.coalesce(s["parameters"], F.array().cast(f"array<{papers.PARAMETER}>"))
    machine = lambda x: ~in_(x["name"], TEXTUAL) & (residue(x["value"]) | F.coalesce(x["error"].rlike(RESIDUE) | x["lower_error"].rlike(RESIDUE) | x["upper_error"].rlike(RESIDUE), F.lit(False)))
    own = F.col("step.id")
    return [
        Rule("step_id_missing", F.coalesce(own, F.lit("")) == "", "no id"),
        Rule("step_id_form", (own != "") & F.col("number").isNull(), "expected step-XX"),
        Rule("step_order", F.col("number") <= F.coalesce(F.col("last"), F.lit(0)), "ids must ascend"),
        Rule("step_twice", F.array_contains(before, own), "the id occurs before"),
        Rule("step_type", ~in_(s["step_type"], STEP_TYPES), "no such type"),
        Rule("depends_on_missing", s["depends_on"].isNull(), "depends_on is missing"),
        Rule("depends_on_itself", F.array_contains(needs, own), "a step cannot depend on itself"),
        Rule("depends_on_twice", F.size(F.array_distinct(needs)) < F.size(needs), "a dependency occurs twice"),
        Rule("depends_on_unknown", F.size(F.array_except(F.filter(needs, lambda d: d != own), before)) > 0, "a dependency is no earlier step"),
        Rule("solar_parameters", (s["step_type"] == "solar_position_and_motion") & (F.size(p) == 0) & ~told.rlike("not[_ ]reported"), "parameters, or that none are reported"),
        Rule("parameter_name", F.exists(p, lambda x: ~in_(x["name"], PARAMETERS)), "no such parameter"),
        Rule("parameter_raw", F.exists(p, lambda x: blank(x["raw_value"])), "a parameter without its text"),
        Rule("parameter_markup", F.exists(p, machine), "markup in a parameter"),
    ]


def report(*found: DataFrame) -> DataFrame:
    """All violations of a document in one table, ordered by errors first, place and rule."""
    every = found[0]
    for x in found[1:]:
        every = every.unionByName(x)
    return every.orderBy("severity", "location", "rule")


# --- references to lines and cells ------------------------------------------------------------------------------------


def suffix(path: Column) -> Column:
    """Lower-case ending of the last part of a path, with its dot; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(path, F.lit("")), r"(?<=[^/])(\.[^./]*)$", 1))


def is_cell(r: Column) -> Column:
    return F.coalesce(r["kind"] == "ecsv_cell", F.lit(False)) | F.coalesce(F.lower(r["path"]).endswith(".ecsv"), F.lit(False))


def is_paper_text(r: Column) -> Column:
    return F.coalesce(r["kind"] == "text", F.lit(False)) & ~suffix(r["path"]).isin(".ecsv", ".json", ".bib", ".bbl")


def reference_kind_rules(r: Column) -> list[Rule]:
    """Path and kind of a reference, before its file is looked at."""
    cell = F.coalesce(r["kind"] == "ecsv_cell", F.lit(False))
    table = suffix(r["path"]) == ".ecsv"
    return [
        Rule("path_missing", F.coalesce(r["path"], F.lit("")) == "", "no path"),
        Rule("cell_path", (r["path"] != "") & cell & ~table, "a cell reference points to a table file"),
        Rule("cell_kind", (r["path"] != "") & ~cell & table, "a table file needs a cell reference"),
    ]


def substantive(line: Column) -> Column:
    """Whether a line says something: no blank, comment, lone brace, page mark, structure command or assignment."""
    x = F.trim(line)
    out = (x != "") & ~x.rlike("^[%#]") & ~x.isin("{", "}")
    for pattern in HOLLOW:
        out = out & ~x.rlike(pattern)
    return out


def line_range(lines: Column, start: Column, end: Column) -> Column:
    """The lines of a range (from 1, both ends in it), null if it lies outside the text."""
    ok = (start >= 1) & (end >= start) & (end <= F.size(lines))
    return F.when(ok, F.slice(lines, F.when(ok, start).otherwise(1), F.when(ok, end - start + 1).otherwise(0)))


def text_ref_rules(r: Column, lines: Column) -> list[Rule]:
    """A range of lines that exists and says something, with words of its context. lines: of the file, null if there is none."""
    chosen = line_range(lines, r["start_line"], r["end_line"])
    said = F.exists(chosen, substantive)
    return [
        Rule("file_missing", lines.isNull(), "the file does not exist"),
        Rule("line_missing", lines.isNotNull() & (r["start_line"].isNull() | r["end_line"].isNull()), "no line numbers"),
        Rule("line_range", lines.isNotNull() & r["start_line"].isNotNull() & r["end_line"].isNotNull() & chosen.isNull(), "no such lines"),
        Rule("line_hollow", ~said, "blank or comment lines only"),
        Rule("context_elsewhere", said & ~overlaps_weakly([r["context"]], F.array_join(chosen, "\n")), "the lines have no word of the context", "warning"),
    ]


def excerpt(path: Column, lines: Column, start: Column, end: Column) -> Column:
    """struct<excerpt, error> of a range of lines, as far as the file goes, each with its line end. error says which of four things
    is wrong, and is empty if nothing is."""
    first, last = F.coalesce(start, F.lit(0)), F.coalesce(end, F.lit(0))
    error = (
        F.when(blank(path), "no path").when(lines.isNull(), "no such file").when((first < 1) | (last < first), "no valid line range").when(first > F.size(lines), "range past the end").otherwise("")
    )
    ok = error == ""
    chosen = F.slice(lines, F.when(ok, first).otherwise(1), F.when(ok, F.least(last, F.size(lines)) - first + 1).otherwise(0))
    return F.struct(F.when(ok, F.concat(F.array_join(chosen, "\n"), F.lit("\n"))).otherwise("").alias("excerpt"), error.alias("error"))


def tokens(line: Column) -> Column:
    """Cells of a table line: parted by spaces, double quotes hold a cell together, doubled quotes inside stand for one."""
    found = F.regexp_extract_all(line, F.lit(r'("(?:[^"]|"")*"|[^\s"]+)'), F.lit(1))
    return F.transform(found, lambda x: F.when(x.startswith('"'), F.replace(F.regexp_replace(x, '^"|"$', ""), F.lit('""'), F.lit('"'))).otherwise(x))


def cell_ref_rules(r: Column, lines: Column, columns: Column) -> list[Rule]:
    """A cell that exists and holds the raw value. columns: names of the table's columns."""
    inside = (r["line"] >= 1) & (r["line"] <= F.size(lines))
    line = F.when(inside, F.get(lines, r["line"] - 1))
    cells = tokens(line)
    at = F.array_position(columns, r["column"])
    data = line.isNotNull() & ~line.startswith("#") & ~(cells == columns)
    found = data & (at >= 1) & (at <= F.size(cells))
    part = r["component_raw_value"]
    return [
        Rule("cell_line", ~F.coalesce(inside, F.lit(False)), "no such line"),
        Rule("cell_column", F.coalesce(at, F.lit(0)) < 1, "no such column"),
        Rule("cell_metadata", line.startswith("#"), "the line is metadata"),
        Rule("cell_header", ~line.startswith("#") & (cells == columns), "the line is the header"),
        Rule("cell_short", data & (at > F.size(cells)), "the row has fewer cells"),
        Rule("cell_value", found & ~(F.get(cells, (at - 1).cast("int")).eqNullSafe(r["raw_value"])), "the cell holds another value"),
        Rule("cell_part", part.isNotNull() & (blank(part) | ~F.coalesce(r["raw_value"].contains(part), F.lit(False))), "the part is not in the cell"),
    ]


# --- annotations and staged replies -----------------------------------------------------------------------------------

#: Units that a field's name lets expect, and marks of a transformed form.
UNITS = {"velocity": ("km/s", "km s^-1", "km s-1"), "parallax": ("mas",), "proper_motion": ("mas/yr", "mas yr^-1"), "distance": ("pc", "kpc", "mpc"), "radius": ("pc", "kpc")}
TRANSFORMED = "log|dex|mag"
SCORED = tuple(f"{g}.{f}" for g, fields in papers.CORE.items() for f in fields)


def unit_lint(field: Column, unit: Column) -> Column:
    """`unitless`, `unusual` or null: whether a unit is odd for its field. The first name that the field contains decides."""
    u = F.lower(F.coalesce(F.trim(unit), F.lit("")))
    odd = F.lit(None).cast("string")
    for part, usual in reversed(UNITS.items()):
        odd = F.when(field.contains(part) & (u != "") & ~u.isin(*usual), "unusual").otherwise(odd)
    return F.when(field.contains("probability") & (u != ""), "unitless").when(~u.rlike(TRANSFORMED), odd)


def annotated_quantity_rules(q: Column) -> list[Rule]:
    """Rules of a scored quantity of an annotation."""
    odd = lambda f: has(q[f]) & F.trim(q[f]).try_cast("double").isNull()
    k = F.coalesce(q["limit_kind"], F.lit(""))
    ends = has(q["range_lower"]) | has(q["range_upper"])
    return [
        Rule("field_unknown", ~in_(q["field"], SCORED), "no scored field"),
        Rule("limit_kind", ~k.isin(*rules.LIMIT_KINDS), "no such kind of limit"),
        *(Rule(f"{f}_not_number", odd(f), f"{f} is no plain number") for f in ("value", "error", "lower_error", "upper_error", "range_lower", "range_upper")),
        Rule("range_value", (k == "range") & has(q["value"]), "a range leaves the value empty"),
        Rule("range_ends", (k == "range") & ~(has(q["range_lower"]) & has(q["range_upper"])), "a range has both ends"),
        Rule("ends_without_range", (k != "range") & ends, "ends need the kind 'range'"),
        Rule("value_missing", (k != "range") & blank(q["value"]), "no value"),
    ]


def annotated_candidate_rules(c: Column) -> list[Rule]:
    """Rules of an annotated candidate: names, claim, origin, evidence, coordinates given once and in range, epoch."""
    gaia = has(c["gaia_source_id"])
    both = lambda raw, value: has(c[raw]) & c[value].isNotNull()
    return [
        Rule("record_id_missing", blank(c["record_id"]), "no record id"),
        Rule("nameless", (F.coalesce(F.size(c["names"]), F.lit(0)) < 1) & ~gaia, "neither a name nor a source id"),
        Rule("gaia_form", gaia & ~c["gaia_source_id"].rlike(r"(?i)^\s*Gaia\s+E?DR[0-9]\s+[0-9]+\s*$"), "not a source id"),
        Rule("claim", ~in_(F.coalesce(c["galactic_bound_claim"], F.lit("not_reported")), CLAIMS), "no such claim"),
        Rule("origin", ~in_(c["origin_type"], ORIGINS), "no such origin"),
        Rule("evidence_missing", F.coalesce(F.size(c["evidence"]), F.lit(0)) < 1, "no evidence"),
        Rule("ra_twice", both("ra_raw", "ra_deg"), "the raw and the decimal form"),
        Rule("dec_twice", both("dec_raw", "dec_deg"), "the raw and the decimal form"),
        Rule("ra_range", ~((c["ra_deg"] >= 0) & (c["ra_deg"] < 360)), "RA outside [0, 360)"),
        Rule("dec_range", ~c["dec_deg"].between(-90, 90), "Dec outside [-90, 90]"),
        Rule("epoch_range", ~c["epoch_year"].between(1900, 2100), "epoch outside 1900 to 2100"),
    ]


def method_fact_rules(f: Column) -> list[Rule]:
    return [
        Rule("fact_name", ~in_(f["name"], PARAMETERS), "no such fact"),
        Rule("fact_status", ~in_(f["status"], ("reported", "not_reported")), "no such status"),
        Rule("fact_value_missing", (f["status"] == "reported") & blank(f["value"]), "a reported fact needs a value"),
        Rule("fact_value_unexpected", (f["status"] == "not_reported") & has(f["value"]), "a fact that isn't reported has no value"),
    ]


def annotation_rules(a: Column) -> list[Rule]:
    """Rules of a whole annotation: required fields, status, unique ids, types and facts."""
    ids = F.transform(a["candidates"], lambda c: c["record_id"])
    kinds = F.coalesce(a["step_types_present"], F.array().cast("array<string>"))
    facts = F.filter(F.transform(a["method_facts"], lambda f: f["name"]), lambda n: n != "other")
    n = F.coalesce(F.size(a["candidates"]), F.lit(0))
    return [
        *(Rule(f"{f}_missing", blank(a[f]), f"no {f}") for f in ("arxiv_id", "annotator", "annotated_at", "guideline_version")),
        Rule("candidates_unexpected", (a["status"] == "no_candidates") & (n > 0), "candidates in spite of the status"),
        Rule("candidates_missing", (a["status"] == "candidates_found") & (n <= 0), "no candidates in spite of the status"),
        Rule("record_id_twice", F.size(F.array_distinct(ids)) < F.size(ids), "a record id occurs twice"),
        Rule("step_type", F.size(F.array_except(kinds, F.array(*map(F.lit, STEP_TYPES)))) > 0, "no such step type"),
        Rule("step_type_twice", F.size(F.array_distinct(kinds)) < F.size(kinds), "a step type occurs twice"),
        Rule("fact_twice", F.size(F.array_distinct(facts)) < F.size(facts), "a fact occurs twice"),
    ]


def scaffold_rules(doc: Column, arxiv_id: Column) -> list[Rule]:
    """Structure of the first stage's reply: a roster that fits the status, ids of the paper, each once."""
    ids = F.transform(doc["candidates"], lambda c: F.coalesce(c["identifiers"]["record_id"], F.lit("")))
    status, n = doc["extraction"]["status"], F.coalesce(F.size(doc["candidates"]), F.lit(0))
    return [
        *(Rule(f"{k}_missing", doc[k].isNull(), f"no {k}") for k in ("paper", "extraction", "method_chain", "candidates")),
        Rule("roster_unexpected", (status == "no_candidates") & (n > 0), "a roster in spite of the status"),
        Rule("roster_missing", (status == "candidates_found") & (n <= 0), "no roster in spite of the status"),
        Rule("source_missing", status == "source_missing", "the sources are there"),
        Rule("roster_id", F.exists(ids, lambda i: ~i.startswith(F.concat(arxiv_id, F.lit(":cand-")))), "not an id of the paper"),
        Rule("roster_twice", F.size(F.array_distinct(ids)) < F.size(ids), "an id occurs twice"),
    ]


def batch_rules(got: Column, wanted: Column) -> list[Rule]:
    """Record ids of a batch's reply against those asked for, in order."""
    pairs = F.arrays_zip(got.alias("a"), wanted.alias("b"))
    same = F.size(got) == F.size(wanted)
    return [Rule("batch_size", ~same, "another number of candidates"), Rule("batch_order", same & F.exists(pairs, lambda p: ~p["a"].eqNullSafe(p["b"])), "another candidate at a place")]


def routed(errors: DataFrame, message: str = "message") -> DataFrame:
    """Adds `candidate`: the index that a message is about, null if it is about the document."""
    place = F.substring_index(F.col(message), ":", 1)
    return errors.withColumn("candidate", F.regexp_extract(place, r"candidates[.\[](\d+)", 1).try_cast("int"))


def lines_table(files: DataFrame, path: str, text: str) -> DataFrame:
    """path and lines of each file; a final line end makes no line."""
    lines = F.split(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"\n\z", ""), "\n", -1)
    return files.select(F.col(path).alias("path"), F.when(F.coalesce(F.col(text), F.lit("")) == "", F.array().cast("array<string>")).otherwise(lines).alias("lines"))


def unique_ids(df: DataFrame, base: str, order: list[str], scope: list[str] | None = None) -> DataFrame:
    """Adds `unique_id`: the base for its first row in the order, then base-2, base-3 and so on, within the scope."""
    n = F.row_number().over(Window.partitionBy(*(scope or []), base).orderBy(*order))
    return df.withColumn("unique_id", F.when(n == 1, F.col(base)).otherwise(F.concat_ws("-", F.col(base), n.cast("string"))))
