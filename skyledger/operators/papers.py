"""Paper documents: their record model, strict reading, compact candidates and the walk over their quantities.

A document is one JSON text. The schema below is the record model; reading never fails on a bad document, which becomes a
skipped entry with its reason. Everything is a projection of the parsed struct: no shuffle and no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx

#: The version that documents carry, and the names of the record model.
VERSION = "literature_candidates.v0.1"
CORE = {
    "observed_phase_space": ("ra", "dec", "distance", "parallax", "proper_motion_ra", "proper_motion_dec", "radial_velocity"),
    "derived_kinematics": (
        "galactocentric_x", "galactocentric_y", "galactocentric_z", "galactocentric_radius", "galactocentric_vx", "galactocentric_vy",
        "galactocentric_vz", "tangential_velocity", "galactocentric_tangential_velocity", "total_velocity", "galactic_rest_frame_velocity",
    ),
    "bound_assessment": ("escape_velocity", "escape_velocity_ratio", "escape_margin", "bound_probability", "unbound_probability", "bound_status_metric"),
}
#: Lists of quantities, with the fields beside value and error that the compact form keeps.
LISTS = {
    "photometry": ("measurement_type", "band", "system", "survey"),
    "spectroscopy": ("measurement_type", "spectral_type", "line", "instrument", "survey"),
    "abundances": ("element", "abundance_scale", "reference_element"),
    "quality_flags": ("name",),
    "extra": ("name",),
}
#: Objects of named quantities, and the lists inside them.
OBJECTS = {
    "stellar_parameters": (("teff", "log_g", "metallicity", "mass", "radius", "age", "luminosity", "spectral_type"), {"other": ("name",)}),
    "orbit": (("eccentricity", "pericenter", "apocenter", "zmax", "flight_time", "disk_crossing_radius", "angular_momentum"), {"other": ("name",)}),
    "astrophysical_origin": (("origin_site", "origin_classification", "ejection_velocity", "travel_time"), {"hypothesis_metrics": ("hypothesis", "metric_type"), "other": ("name",)}),
}
TOP = ("schema_version", "generated_at", "paper", "inputs", "extraction", "method_chain", "candidates", "candidate_groups_considered")
CITATION = ("bibkey", "year", "title", "doi", "bibcode", "arxiv_id")
_TEXTS = (
    "raw_value value error lower_error upper_error unit kind description limit_kind range_lower range_upper name measurement_type band system "
    "survey spectral_type line instrument element abundance_scale reference_element hypothesis metric_type coordinate_format"
).split()


def _struct(texts, *more: str) -> str:
    return "struct<" + ",".join([*(f"{t}:string" for t in texts), *more]) + ">"


REF = _struct(("kind", "path", "context", "column", "raw_value", "column_header", "component_raw_value"), "start_line:int", "end_line:int", "line:int")
REFS = f"source_refs:array<{REF}>"
CONTEXT = _struct(("value", "raw_value", "epoch_kind", "source_catalog", "data_release", "inference_basis", "reference_entry_id", "confidence", "description"), REFS)
QUANTITY = _struct(_TEXTS, f"reference_frame:{CONTEXT}", f"epoch:{CONTEXT}", "method_refs:array<string>", REFS)
CANDIDATE = _struct(
    (),
    "identifiers:" + _struct(("record_id", "paper_candidate_id", "gaia_source_id"), f"all:array<{_struct(('value',), REFS)}>"),
    "inclusion_assessment:" + _struct(("summary", "galactic_bound_claim", "inclusion_basis", "extraction_confidence", "confidence_reason"), "paper_labels:array<string>", REFS),
    "candidate_origin:" + _struct(("origin_type",), "paper_reassesses_unbound_status:boolean", "citation:" + _struct(CITATION, "authors:array<string>", f"citation_context_refs:array<{REF}>", f"bibliography_refs:array<{REF}>"), REFS),
    f"core:map<string,map<string,{QUANTITY}>>",
    *(f"{name}:array<{QUANTITY}>" for name in LISTS),
    *(f"{name}:" + _struct((), *(f"{f}:{QUANTITY}" for f in fields), *(f"{x}:array<{QUANTITY}>" for x in lists)) for name, (fields, lists) in OBJECTS.items()),
)
PARAMETER = _struct(("name", "raw_value", "value", "error", "lower_error", "upper_error", "unit"), REFS)
STEP = _struct(("id", "step_type", "summary"), "depends_on:array<string>", "inputs:array<string>", "outputs:array<string>", f"parameters:array<{PARAMETER}>", REFS)
GROUP = _struct(("group_id", "description", "decision", "reason"), REFS)
PAPER = _struct(
    ("schema_version", "generated_at"),
    "paper:" + _struct(("arxiv_id", "bibcode", "month", "title", "year")),
    "inputs:map<string,string>",
    "extraction:" + _struct(("status", "summary"), "tooling:" + _struct(("agent_runtime", "model_id", "prompt_version"))),
    f"method_chain:array<{STEP}>",
    f"candidates:array<{CANDIDATE}>",
    f"candidate_groups_considered:array<{GROUP}>",
)


def scan(raw: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """path, doc (the parsed document) and error of each document; of doc and error one is null.

    A text that is no JSON object, an unknown key at the top or of a candidate, and another version make an error.
    """
    known = lambda names: F.array(*map(F.lit, names))
    top = F.map_keys(F.from_json(text, "map<string,string>"))
    each = F.from_json(text, "struct<candidates:array<map<string,string>>>")["candidates"]
    odd = F.array_except(top, known(TOP))
    parts = F.array_distinct(F.flatten(F.transform(each, lambda m: F.array_except(F.map_keys(m), known([*CANDIDATE_KEYS])))))
    error = (
        F.when(top.isNull(), "not a JSON object")
        .when(F.size(odd) > 0, F.concat(F.lit("unknown keys: "), F.array_join(F.array_sort(odd), ", ")))
        .when(F.size(parts) > 0, F.concat(F.lit("unknown candidate keys: "), F.array_join(F.array_sort(parts), ", ")))
        .when(~F.get_json_object(text, "$.schema_version").eqNullSafe(VERSION), "another version")
    )
    x = raw.select(F.col(path).alias("path"), error.alias("error"), F.col(text).alias("_t"))
    return x.select("path", F.when(F.col("error").isNull(), F.from_json("_t", PAPER)).alias("doc"), "error")


CANDIDATE_KEYS = ("identifiers", "inclusion_assessment", "candidate_origin", "core", *LISTS, *OBJECTS)


def candidates(docs: DataFrame) -> DataFrame:
    """path, arxiv_id, month, index (from 0) and c of every candidate of the documents that could be read."""
    x = docs.where("doc is not null").select("path", "doc.paper.arxiv_id", "doc.paper.month", F.posexplode("doc.candidates").alias("index", "c"))
    return x.withColumn("location", F.format_string("candidates[%d]", "index"))


def named(values: Column) -> Column:
    """Identifiers of a candidate by their collapsed text; the first spelling of each stays, in order."""
    return tx.ordered_distinct(F.transform(F.coalesce(values, F.array()), lambda x: x["value"]))


def simple(q: Column, keep: tuple[str, ...] = ()) -> Column:
    """The compact form of a quantity: value, unit and references, errors and the kept fields only where they are set."""
    set_ = lambda f: F.nullif(q[f], F.lit("")).alias(f)
    made = F.struct(
        *(set_(f) for f in keep),
        F.coalesce(q["value"], F.lit("")).alias("value"),
        F.coalesce(q["unit"], F.lit("")).alias("unit"),
        F.coalesce(q["method_refs"], F.array().cast("array<string>")).alias("method_refs"),
        *map(set_, ("error", "lower_error", "upper_error")),
    )
    return F.when(q.isNotNull(), made)


def simple_list(qs: Column, keep: tuple[str, ...]) -> Column:
    return F.transform(F.filter(F.coalesce(qs, F.array().cast(f"array<{QUANTITY}>")), lambda q: q.isNotNull()), lambda q: simple(q, keep))


def simple_object(o: Column, fields: tuple[str, ...], lists: dict[str, tuple[str, ...]]) -> Column:
    return F.struct(*(simple(o[f]).alias(f) for f in fields), *(simple_list(o[x], keep).alias(x) for x, keep in lists.items()))


def simple_core(core: Column) -> Column:
    """The three groups, each a map of compact quantities; other groups go, absent ones are empty."""

    def group(name: str) -> Column:
        found = F.coalesce(core[name], F.create_map().cast(f"map<string,{QUANTITY}>"))
        return F.transform_values(F.map_filter(found, lambda k, q: q.isNotNull()), lambda k, q: simple(q))

    return F.struct(*(group(g).alias(g) for g in CORE))


def context(c: Column) -> Column:
    """Why a candidate is in: labels, claim, basis, confidence, origin and the citation's fields where set."""
    a, o = c["inclusion_assessment"], c["candidate_origin"]
    none = F.lit("")
    cited = F.struct(*(F.nullif(o["citation"][f], none).alias(f) for f in CITATION), F.filter(o["citation"]["authors"], lambda x: F.trim(x) != "").alias("authors"))
    return F.struct(
        F.coalesce(a["paper_labels"], F.array().cast("array<string>")).alias("paper_labels"),
        *(F.coalesce(a[f], none).alias(f) for f in ("galactic_bound_claim", "inclusion_basis", "extraction_confidence")),
        F.coalesce(o["origin_type"], none).alias("origin_type"),
        F.coalesce(o["paper_reassesses_unbound_status"], F.lit(False)).alias("paper_reassesses_unbound_status"),
        F.when(o["citation"].isNotNull(), cited).alias("citation"),
    )


def simplified(c: Column) -> Column:
    """The compact candidate: identifiers, context, core and the other groups, without source references."""
    ids = c["identifiers"]
    return F.struct(
        F.struct(*(F.coalesce(ids[f], F.lit("")).alias(f) for f in ("record_id", "paper_candidate_id", "gaia_source_id")), named(ids["all"]).alias("all")).alias("identifiers"),
        context(c).alias("candidate_context"),
        simple_core(c["core"]).alias("core"),
        *(simple_list(c[name], keep).alias(name) for name, keep in LISTS.items()),
        *(simple_object(c[name], *shape).alias(name) for name, shape in OBJECTS.items()),
    )


def strong_aliases(c: Column, provider_names: Column | None = None) -> Column:
    """Distinct identifiers that can link: of the candidate's own name, all its identifiers and the provider's, those not weak."""
    own = F.concat(F.array(c["paper_candidate_id"]), F.transform(F.coalesce(c["all"], F.array()), lambda x: x["value"]))
    every = own if provider_names is None else F.concat(own, F.coalesce(provider_names, F.array().cast("array<string>")))
    return F.filter(tx.ordered_distinct(every), lambda v: ~tx.weak_identifier(v))


def candidate_ref(c: Column, path: Column) -> Column:
    """The four fields by which an object names a contribution."""
    ids = c["identifiers"]
    return F.struct(*(F.coalesce(ids[f], F.lit("")).alias(f) for f in ("record_id", "paper_candidate_id", "gaia_source_id")), path.alias("source_json_path"))


def quantities(found: DataFrame) -> DataFrame:
    """path, index, location (as `candidates[3].core.orbit.zmax`), field and q of every quantity of the candidates.

    The model is known, so the walk is a list of places: one row function, whatever the depth. References and the context of
    coordinates hold no quantities of their own.
    """
    c, at = F.col("c"), F.col("location")

    def place(path: Column, field: Column, q: Column) -> Column:
        return F.struct(F.concat(at, path).alias("location"), field.alias("field"), q.alias("q"))

    def of_list(qs: Column, path: str, field: str) -> Column:
        return F.transform(F.coalesce(qs, F.array().cast(f"array<{QUANTITY}>")), lambda q, i: place(F.concat(F.lit(f"{path}["), i.cast("string"), F.lit("]")), F.lit(field), q))

    def of_group(g: str) -> Column:
        entries = F.map_entries(F.coalesce(c["core"][g], F.create_map().cast(f"map<string,{QUANTITY}>")))
        return F.transform(entries, lambda e: place(F.concat(F.lit(f".core.{g}."), e["key"]), e["key"], e["value"]))

    places = [of_group(g) for g in CORE]
    for name in LISTS:
        places.append(of_list(c[name], f".{name}", name))
    for name, (fields, lists) in OBJECTS.items():
        places.append(F.array(*(place(F.lit(f".{name}.{f}"), F.lit(f), c[name][f]) for f in fields)))
        places += [of_list(c[name][x], f".{name}.{x}", x) for x in lists]
    every = F.filter(F.concat(*places), lambda p: p["q"]["value"].isNotNull())
    return found.select("path", "index", F.explode(every).alias("p")).select("path", "index", "p.location", "p.field", "p.q")


def coverage(c: Column) -> Column:
    """How many quantities the candidate has in each group."""
    core = [F.size(F.coalesce(F.map_keys(c["core"][g]), F.array().cast("array<string>"))).alias(g) for g in CORE]
    lists = [F.size(F.coalesce(c[name], F.array().cast(f"array<{QUANTITY}>"))).alias(name) for name in LISTS]

    def inside(name: str, fields, more) -> Column:
        n = F.lit(0)
        for f in fields:
            n = n + c[name][f].isNotNull().cast("int")
        for x in more:
            n = n + F.coalesce(F.size(F.coalesce(c[name][x], F.array().cast(f"array<{QUANTITY}>"))), F.lit(0))
        return n.alias(name)

    return F.struct(*core, *lists, *(inside(name, *shape) for name, shape in OBJECTS.items()))
