"""Queries over paper documents: JSON texts made from `customer`, ten candidates a paper, read back through the record model.

The SQL never parses JSON: it derives the expected rows from `customer` by the same arithmetic, so that an error in the model,
the walk or a rule shows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import checks, papers, rules
from .queries import c, lit, query, t

#: One row a candidate, for both engines: k, paper number p, arxiv id, index in the paper and location.
_BASE = "SELECT c_custkey AS k, CAST(floor(c_custkey / 10) AS BIGINT) AS p, concat('2001.', lpad(CAST(CAST(floor(c_custkey / 10) AS BIGINT) AS {s}), 5, '0')) AS arxiv, c_custkey - CAST(floor(c_custkey / 10) AS BIGINT) * 10 AS idx FROM customer"
_DUCK = f"b AS ({_BASE.format(s='VARCHAR')}), base AS (SELECT *, concat('candidates[', idx, ']') AS loc FROM b)"
_OWN, _GAIA = "concat('HVS ', k % 8)", "CASE WHEN k % 3 = 0 THEN concat('Gaia DR3 ', k) WHEN k % 12 = 4 THEN concat('gaia dr2 ', k) ELSE '' END"
_RECORD = "CASE WHEN k % 17 = 0 THEN 'bad-id' ELSE concat(arxiv, ':cand-', lpad(CAST(idx + 1 AS {s}), 3, '0')) END"
_CLAIM = "CASE k % 4 WHEN 0 THEN 'unbound' WHEN 1 THEN 'escaping' WHEN 2 THEN 'bound' ELSE 'not_reported' END"
_SUMMARY = "CASE k % 7 WHEN 0 THEN '' WHEN 1 THEN 'it remains Galaxy-bound' ELSE 'a fast star' END"
#: Per quantity: place, field, condition, value, raw value, unit, error, kind of limit, name.
_QUANTITIES = (
    (".core.observed_phase_space.ra", "ra", "true", "CASE k % 4 WHEN 0 THEN '12.5' WHEN 1 THEN '17h39m53.68s' WHEN 2 THEN '400' ELSE '16:61:00' END", "'12.5'", "CASE k % 4 WHEN 1 THEN 'hourangle' ELSE 'deg' END", "''", "''", "''"),
    (".core.observed_phase_space.distance", "distance", "true", "CASE k % 5 WHEN 0 THEN '8.5' WHEN 1 THEN '~8' WHEN 2 THEN '$8$' WHEN 3 THEN '' ELSE '1e3' END", "CASE k % 4 WHEN 0 THEN '8.5 ± 0.2' WHEN 1 THEN '8.5^{+1}_{-2}' WHEN 2 THEN '> 8' ELSE '8.5' END", "'kpc'", "CASE WHEN k % 3 = 0 THEN '0.2' ELSE '' END", "CASE WHEN k % 11 = 0 THEN 'lower_limit' WHEN k % 11 = 1 THEN 'range' ELSE '' END", "''"),
    (".core.bound_assessment.bound_probability", "bound_probability", "k % 2 = 1", "CASE k % 3 WHEN 0 THEN '0.5' WHEN 1 THEN '1.5' ELSE '50%' END", "'p'", "CASE WHEN k % 3 = 0 THEN '%' ELSE '' END", "''", "''", "''"),
    (".photometry[0]", "photometry", "true", "'12.3'", "'12.3'", "'mag'", "CASE WHEN k % 13 = 0 THEN 'low' ELSE '' END", "''", "''"),
    (".extra[0]", "extra", "k % 9 = 0", "'high'", "'high'", "''", "''", "''", "CASE WHEN k % 2 = 0 THEN 'log_g' ELSE 'remark' END"),
    (".stellar_parameters.teff", "teff", "k % 2 = 0", "'5000'", "'5000 \\pm 50'", "'K'", "''", "''", "''"),
    (".stellar_parameters.spectral_type", "spectral_type", "k % 6 = 0", "'B9 V'", "'B9 V'", "''", "''", "''", "''"),
    (".orbit.other[0]", "other", "k % 4 = 3", "'_x'", "'x'", "''", "''", "'odd'", "'n'"),
)
_REF = "CASE WHEN k % 10 = 3 THEN '' WHEN k % 10 = 4 THEN 'ecsv_cell' ELSE 'text' END"
_STEP = "CASE WHEN k % 10 = 0 THEN 'step-09' WHEN k % 10 = 9 THEN '' ELSE 'step-01' END"


def _quantity(k: DataFrame | None, row, spark_frame: str | None = None):
    """A quantity as a Spark struct, null where the paper has none."""
    _, field, when, value, raw, unit, error, limit, name = row
    ref = F.expr(_REF)
    refs = F.when(ref == "", F.array().cast("array<struct<kind:string,path:string,raw_value:string>>")).otherwise(F.array(F.struct(ref.alias("kind"), F.when(ref == "text", "a.tex").otherwise("a.ecsv").alias("path"), lit("12.3").alias("raw_value"))))
    steps = F.when(F.expr(_STEP) == "", F.array(lit("step-01"), lit("step-02"))).otherwise(F.array(F.expr(_STEP)))
    sql = lambda x: F.expr(x.replace("\\", "\\\\"))
    made = [sql(value).alias("value"), sql(raw).alias("raw_value"), sql(unit).alias("unit"), sql(error).alias("error"), sql(limit).alias("limit_kind"), sql(name).alias("name"), refs.alias("source_refs"), steps.alias("method_refs")]
    if field == "ra":
        made.append(F.expr("CASE k % 4 WHEN 1 THEN 'sexagesimal_hms' WHEN 3 THEN 'sexagesimal_colon' ELSE 'decimal_degrees' END").alias("coordinate_format"))
        made.append(F.when(F.expr("k % 5 = 0"), F.struct(lit("ICRS").alias("value"), refs.alias("source_refs"))).alias("reference_frame"))
        made.append(F.struct(F.expr("CASE WHEN k % 2 = 0 THEN 'unknown' ELSE '2016.0' END").alias("value"), F.expr("CASE WHEN k % 3 = 0 THEN 'later' ELSE 'equinox' END").alias("epoch_kind"), F.expr("CASE WHEN k % 6 = 0 THEN 'not_reported' END").alias("inference_basis"), refs.alias("source_refs")).alias("epoch"))
    return F.when(F.expr(when), F.struct(*made))


def documents(spark, d) -> DataFrame:
    """path and text of the papers: one shuffle, ten candidates a group."""
    x = t(spark, d, "customer").selectExpr("c_custkey AS k", "CAST(floor(c_custkey / 10) AS BIGINT) AS p").withColumn("arxiv", F.expr("concat('2001.', lpad(CAST(p AS STRING), 5, '0'))")).withColumn("idx", F.expr("k - p * 10"))
    q = {r[1]: _quantity(None, r) for r in _QUANTITIES}
    one = lambda f: F.array_compact(F.array(q[f]))
    gaia = F.expr(_GAIA)
    names = F.array_compact(F.array(F.expr(_OWN), F.when((gaia != "") & (c("k") % 5 != 0), gaia), lit("star"), F.lower(F.expr(_OWN))))
    refs = F.when(c("k") % 10 == 3, F.array().cast("array<struct<kind:string,path:string>>")).otherwise(F.array(F.struct(F.when(c("k") % 10 == 5, "x").otherwise("text").alias("kind"), F.when(c("k") % 10 == 6, "m.json").otherwise("a.tex").alias("path"))))
    labels = F.expr("CASE k % 6 WHEN 0 THEN array() WHEN 1 THEN array('hvs_candidate', 'hvs_candidate') WHEN 2 THEN array('odd') ELSE array('hvs_candidate', 'escaping_star') END")
    cite = F.when(c("k") % 4 == 1, F.struct(F.expr("CASE WHEN k % 3 = 0 THEN '' ELSE concat('key', k % 5) END").alias("bibkey"), lit("2001").alias("year"), F.array(F.struct(lit("text").alias("kind"), F.when(c("k") % 8 == 1, "a.bib").otherwise("a.tex").alias("path"))).alias("bibliography_refs")))
    candidate = F.struct(
        F.struct(F.expr(_RECORD.format(s="STRING")).alias("record_id"), F.expr(_OWN).alias("paper_candidate_id"), gaia.alias("gaia_source_id"), F.transform(names, lambda v: F.struct(v.alias("value"), refs.alias("source_refs"))).alias("all")).alias("identifiers"),
        F.struct(F.expr(_SUMMARY).alias("summary"), labels.alias("paper_labels"), F.expr(_CLAIM).alias("galactic_bound_claim"), lit("explicit_candidate_text").alias("inclusion_basis"), F.expr("CASE WHEN k % 5 = 0 THEN 'sure' ELSE 'high' END").alias("extraction_confidence"), lit("read").alias("confidence_reason"), refs.alias("source_refs")).alias("inclusion_assessment"),
        F.struct(F.when(c("k") % 4 < 2, "cited_from_literature").otherwise("introduced_by_this_paper").alias("origin_type"), (c("k") % 2 == 0).alias("paper_reassesses_unbound_status"), cite.alias("citation"), refs.alias("source_refs")).alias("candidate_origin"),
        F.struct(F.struct(q["ra"].alias("ra"), q["distance"].alias("distance")).alias("observed_phase_space"), F.struct(q["bound_probability"].alias("bound_probability")).alias("bound_assessment"), F.when(c("k") % 3 == 0, F.struct(lit(None).cast("string").alias("x"))).alias("other_group")).alias("core"),
        one("photometry").alias("photometry"), F.array().cast("array<string>").alias("spectroscopy"), F.array().cast("array<string>").alias("abundances"), F.array().cast("array<string>").alias("quality_flags"), one("extra").alias("extra"),
        F.struct(q["teff"].alias("teff"), q["spectral_type"].alias("spectral_type")).alias("stellar_parameters"), F.struct(one("other").alias("other")).alias("orbit"), F.when(c("k") % 10 != 8, F.struct(F.array().cast("array<string>").alias("other"))).alias("astrophysical_origin"),
    )
    steps = F.expr("""array(
      named_struct('id', 'step-01', 'step_type', 'distance_estimation', 'summary', 'a', 'depends_on', array(cast(null as string)), 'parameters', array(named_struct('name', 'R0', 'raw_value', '8.2', 'value', '8.2'))),
      named_struct('id', CASE WHEN p % 3 = 0 THEN 'step-01' WHEN p % 3 = 1 THEN 'two' ELSE 'step-02' END, 'step_type', CASE WHEN p % 4 = 0 THEN 'guess' ELSE 'velocity_calculation' END, 'summary', 'b', 'depends_on', array(CASE WHEN p % 5 = 0 THEN 'step-07' ELSE 'step-01' END), 'parameters', array(named_struct('name', CASE WHEN p % 2 = 0 THEN 'R1' ELSE 'z0' END, 'raw_value', '', 'value', '$1$'))),
      named_struct('id', 'step-03', 'step_type', 'solar_position_and_motion', 'summary', CASE WHEN p % 2 = 0 THEN 'not reported' ELSE 'c' END, 'depends_on', array('step-03', 'step-01', 'step-01'), 'parameters', cast(array() as array<struct<name:string,raw_value:string,value:string>>)))""")
    steps = F.transform(steps, lambda s: s.withField("depends_on", F.array_compact(s["depends_on"])))
    g = x.groupBy("p", "arxiv").agg(F.array_sort(F.collect_list(F.struct("k", candidate.alias("c")))).alias("cs"))
    groups = F.expr("CASE WHEN p % 3 = 0 THEN array(named_struct('group_id', 'g', 'description', 'stars with HVS status', 'decision', CASE WHEN p % 2 = 0 THEN 'it is gravitationally unbound' ELSE 'this is not an HVS status' END, 'reason', 'x')) ELSE array() END")
    doc = F.struct(
        F.expr(f"CASE WHEN p % 11 = 10 THEN 'v0' ELSE '{papers.VERSION}' END").alias("schema_version"), lit("").alias("generated_at"),
        F.struct(F.expr("CASE WHEN p % 7 = 6 THEN '' ELSE arxiv END").alias("arxiv_id"), F.expr("concat('20', lpad(CAST(10 + p % 10 AS STRING), 2, '0'), '-05')").alias("month")).alias("paper"), F.create_map().cast("map<string,string>").alias("inputs"),
        F.struct(F.expr("CASE p % 4 WHEN 0 THEN 'candidates_found' WHEN 1 THEN 'no_candidates' WHEN 2 THEN 'needs_review' ELSE 'odd' END").alias("status"), F.expr("CASE WHEN p % 2 = 0 THEN 'done' ELSE ' ' END").alias("summary"), F.when(c("p") % 3 > 0, F.struct(lit("m").alias("model_id"), F.expr("CASE WHEN p % 3 = 1 THEN '' ELSE 'v' END").alias("prompt_version"))).alias("tooling")).alias("extraction"),
        steps.alias("method_chain"), F.transform("cs", lambda z: z["c"]).alias("candidates"), groups.alias("candidate_groups_considered"), F.when(c("p") % 13 == 12, "x").alias("surprise"),
    )
    return g.select(c("arxiv").alias("path"), F.when(c("p") % 17 == 16, "{not json").otherwise(F.to_json(doc)).alias("text"))


_READ = "p % 17 <> 16 AND p % 13 <> 12 AND p % 11 <> 10"


@query(f"""WITH {_DUCK} SELECT arxiv AS path, max(CASE WHEN p % 17 = 16 THEN 'not a JSON object' WHEN p % 13 = 12 THEN 'unknown keys: surprise' WHEN p % 11 = 10 THEN 'another version' ELSE '' END) AS error,
  CASE WHEN max(CASE WHEN {_READ} THEN 1 ELSE 0 END) = 1 THEN count(*) ELSE 0 END::INTEGER AS n_candidates FROM base GROUP BY arxiv""")
def paper_documents_scan(spark, d):
    return papers.scan(documents(spark, d)).select("path", F.coalesce("error", lit("")).alias("error"), F.coalesce(F.size("doc.candidates"), lit(0)).alias("n_candidates"))


def read(spark, d) -> DataFrame:
    return papers.candidates(papers.scan(documents(spark, d)))


_ALL = f"[{_OWN}, CASE WHEN {_GAIA} <> '' AND k % 5 <> 0 THEN {_GAIA} END, 'star']"


@query(f"""WITH {_DUCK} SELECT {_RECORD.format(s='VARCHAR')} AS record_id, arxiv AS path, idx::INTEGER AS index, {_GAIA} AS gaia_source_id,
  array_to_string(list_filter({_ALL}, lambda x: x IS NOT NULL), '|') AS names, concat({_OWN}) AS strong,
  CASE k % 6 WHEN 0 THEN '' WHEN 1 THEN 'hvs_candidate|hvs_candidate' WHEN 2 THEN 'odd' ELSE 'hvs_candidate|escaping_star' END AS labels, CASE WHEN k % 4 < 2 THEN 'cited_from_literature' ELSE 'introduced_by_this_paper' END AS origin,
  CASE WHEN k % 4 = 1 THEN CASE WHEN k % 3 = 0 THEN '' ELSE concat('key', k % 5) END END AS bibkey,
  CASE k % 5 WHEN 0 THEN '8.5' WHEN 1 THEN '~8' WHEN 2 THEN '$8$' WHEN 3 THEN '' ELSE '1e3' END AS distance, CASE WHEN k % 3 = 0 THEN '0.2' END AS distance_error,
  2::INTEGER AS n_observed, (CASE WHEN k % 9 = 0 THEN 1 ELSE 0 END)::INTEGER AS n_extra, ((k % 2 = 0)::INTEGER + (k % 6 = 0)::INTEGER)::INTEGER AS n_stellar FROM base WHERE {_READ}""")
def candidate_compact_form(spark, d):
    x = read(spark, d).withColumn("s", papers.simplified(c("c")))
    ids, why = c("s.identifiers"), c("s.candidate_context")
    distance = c("s.core.observed_phase_space")["distance"]
    n = papers.coverage(c("c"))
    return x.select(
        ids["record_id"].alias("record_id"), "path", "index", ids["gaia_source_id"].alias("gaia_source_id"), F.array_join(ids["all"], "|").alias("names"), F.array_join(papers.strong_aliases(c("c.identifiers")), "|").alias("strong"),
        F.array_join(why["paper_labels"], "|").alias("labels"), why["origin_type"].alias("origin"), F.when(why["citation"].isNotNull(), F.coalesce(why["citation"]["bibkey"], lit(""))).alias("bibkey"),
        distance["value"].alias("distance"), distance["error"].alias("distance_error"), n["observed_phase_space"].alias("n_observed"), n["extra"].alias("n_extra"), n["stellar_parameters"].alias("n_stellar"),
    )


def _union() -> str:
    """The expected quantities: one SELECT a place."""
    return " UNION ALL ".join(f"SELECT k, p, arxiv AS path, concat(loc, '{place}') AS location, '{field}' AS field, {value} AS value, {raw} AS raw, {unit} AS unit, {error} AS error, {limit} AS limit_kind, {name} AS name FROM base WHERE {_READ} AND {when}" for place, field, when, value, raw, unit, error, limit, name in _QUANTITIES)


_NUMERIC = "(location LIKE '%.core.derived_kinematics.%' OR location LIKE '%.core.bound_assessment.%' OR field IN ('distance', 'parallax') OR location LIKE '%.photometry[%' OR location LIKE '%.orbit.%' OR (location LIKE '%.stellar_parameters.%' AND field <> 'spectral_type') OR (location LIKE '%.extra[%' AND name = 'log_g'))"


@query(f"WITH {_DUCK}, q AS ({_union()}) SELECT path, location, field, value, {_NUMERIC} AS numeric FROM q")
def quantity_walk(spark, d):
    x = papers.quantities(read(spark, d))
    return x.select("path", "location", "field", c("q.value").alias("value"), checks.must_be_number(c("location"), c("field"), c("q")).alias("numeric"))


def _sql(rules_: dict[str, str], source: str, warnings: tuple[str, ...] = ()) -> str:
    return " UNION ALL ".join(f"SELECT path, location, '{name}' AS rule, '{'warning' if name in warnings else 'error'}' AS severity FROM {source} WHERE {when}" for name, when in rules_.items())


_RESIDUE = r"regexp_matches({0}, '\\[A-Za-z]+|[{{}}$]|[\^_]|\+/-|±')"
_PLAIN = r"regexp_full_match(trim({0}), '[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?')"
_TWO = r"regexp_matches(raw, '\^\s*\{?\s*\+[^}_\s]+\}?\s*_\s*\{?\s*-[^}\s]+')"
_PROBABILITY = "field = 'bound_probability'"
_QUANTITY_RULES = {
    "value_markup": _RESIDUE.format("value"),
    "error_markup": "error <> '' AND " + _RESIDUE.format("error"),
    "limit_kind": "limit_kind NOT IN ('', 'lower_limit', 'upper_limit', 'range')",
    "limit_without_value": "limit_kind = 'lower_limit' AND trim(value) = ''",
    "value_of_a_range": "limit_kind = 'range' AND trim(value) <> ''",
    "ends_of_a_range": "limit_kind = 'range'",
    "no_limit_mark": "limit_kind = 'lower_limit' AND NOT regexp_matches(raw, '>|<')",
    "lower_error_missing": _TWO,
    "upper_error_missing": _TWO,
    "error_missing": f"NOT {_TWO} AND regexp_matches(raw, '±|\\\\pm') AND error = ''",
    "value_not_plain": f"{_NUMERIC} AND trim(value) <> '' AND NOT {_PLAIN.format('value')}",
    "error_not_plain": f"{_NUMERIC} AND trim(error) <> '' AND NOT {_PLAIN.format('error')}",
    "probability_not_plain": f"{_PROBABILITY} AND NOT {_PLAIN.format('value')}",
    "probability_outside": f"{_PROBABILITY} AND {_PLAIN.format('value')} AND try_cast(value AS DOUBLE) > 1",
    "probability_unit": f"{_PROBABILITY} AND {_PLAIN.format('value')} AND unit <> ''",
    "source_refs_missing": "k % 10 = 3",
    "cell_not_raw_value": "k % 10 = 4 AND raw <> '12.3'",
    "method_ref_count": "k % 10 = 9",
    "method_ref_unknown": "k % 10 = 0 OR (k % 10 = 9 AND p % 3 <> 2)",
}


@query(f"WITH {_DUCK}, q AS ({_union()}) " + _sql(_QUANTITY_RULES, "q", ("no_limit_mark",)))
def quantity_violations(spark, d):
    docs = papers.scan(documents(spark, d))
    types = F.map_from_entries(F.array_distinct(F.transform("doc.method_chain", lambda s: F.struct(s["id"], lit("")))))
    x = papers.quantities(papers.candidates(docs)).join(docs.where("doc is not null").select("path", types.alias("steps")), "path")
    found = rules.violations(x, F.struct("path", "location"), checks.quantity_rules(True))
    return found.select("location.path", "location.location", "rule", "severity")


_COORDINATE_RULES = {
    "unit_of_format": "k % 4 = 3",
    "ra_outside": "k % 4 = 2",
    "sixtieths": "k % 4 = 3",
    "reference_frame_missing": "k % 5 <> 0",
    "reference_frame_source": "k % 5 = 0 AND k % 10 = 3",
    "epoch_source": "k % 10 = 3",
    "epoch_unknown": "(k % 2 = 0 OR k % 6 = 0) AND NOT (k % 2 = 0 AND k % 6 = 0 AND k % 10 <> 3)",
    "epoch_kind": "k % 3 = 0",
}


@query(f"WITH {_DUCK}, q AS (SELECT * FROM ({_union()}) WHERE field = 'ra') " + _sql(_COORDINATE_RULES, "q", ("reference_frame_source", "epoch_source", "epoch_unknown")))
def coordinate_violations(spark, d):
    x = papers.quantities(read(spark, d)).where("location like '%.core.observed_phase_space.%' and field in ('ra', 'dec')")
    found = rules.violations(x, F.struct("path", "location"), checks.coordinate_rules(c("field"), c("q")))
    return found.select("location.path", "location.location", "rule", "severity")


_EVIDENCE = {"refs": "k % 10 = 3", "no_text": "k % 10 IN (3, 5, 6)", "not_text": "k % 10 = 6"}
_CITED = "k % 4 < 2"
_CANDIDATE_RULES = {
    "record_id_form": "k % 17 = 0 OR p % 7 = 6",
    "gaia_form": "k % 12 = 4",
    "identifier_twice": "false",
    "identifier_unsourced": "k % 10 = 3",
    "gaia_not_among_all": f"{_GAIA} <> '' AND k % 5 = 0",
    "summary": "k % 7 = 0",
    "labels_missing": "k % 6 = 0",
    "label_unknown": "k % 6 = 2",
    "label_twice": "k % 6 = 1",
    "claim": "k % 4 = 2",
    "confidence": "k % 5 = 0",
    **{f"inclusion_{n}": w for n, w in _EVIDENCE.items()},
    **{f"origin_{n}": w for n, w in _EVIDENCE.items()},
    "citation_missing": "k % 4 = 0",
    "bibkey_missing": "k % 4 = 1 AND k % 3 = 0",
    "citation_context": "k % 4 = 1",
    "bibliography_missing": "k % 4 = 1 AND k % 8 <> 1",
    "core_group_unknown": "k % 3 = 0",
    "core_group_missing": "true",
    "standard_in_extra": "k % 9 = 0 AND k % 2 = 0",
    "bound_phrase": "k % 7 = 1",
    "astrophysical_origin_missing": "k % 10 = 8",
}


@query(f"WITH {_DUCK}, q AS (SELECT *, arxiv AS path, loc AS location FROM base WHERE {_READ}) " + _sql(_CANDIDATE_RULES, "q"))
def candidate_violations(spark, d):
    one = c("c")
    every = [*checks.identifier_rules(one, F.coalesce("arxiv_id", lit("")), True), *checks.inclusion_rules(one["inclusion_assessment"]), *checks.origin_rules(one["candidate_origin"]), *checks.content_rules(one)]
    found = rules.violations(read(spark, d), F.struct("path", "location"), every)
    return found.select("location.path", "location.location", "rule", "severity")


@query(f"""WITH {_DUCK}, q AS (SELECT arxiv AS path, idx, unnest([['record_id', {_RECORD.format(s='VARCHAR')}], ['paper_candidate_id', {_OWN}], ['gaia_source_id', {_GAIA}]]) AS i FROM base WHERE {_READ})
  SELECT path, i[1] AS kind, i[2] AS value, count(*) AS n, min(idx)::INTEGER AS first FROM q WHERE i[2] <> '' GROUP BY ALL HAVING count(*) > 1""")
def repeated_identifiers(spark, d):
    return checks.repeated_identifiers(read(spark, d))


_PAPER = f"q AS (SELECT DISTINCT p, arxiv AS path, '$' AS location FROM base WHERE {_READ})"
_DOCUMENT_RULES = {
    "arxiv_id_missing": "p % 7 = 6",
    "status": "p % 4 = 3",
    "candidates_unexpected": "p % 4 = 1",
    "groups_missing": "p % 4 = 1 AND p % 3 <> 0",
    "needs_review": "p % 4 = 2",
    "summary_missing": "p % 2 = 1",
    "tooling_missing": "p % 3 = 0",
    "prompt_version_missing": "p % 3 = 1",
}


@query(f"WITH {_DUCK}, {_PAPER} " + _sql(_DOCUMENT_RULES, "q"))
def document_violations(spark, d):
    docs = papers.scan(documents(spark, d)).where("doc is not null")
    found = rules.violations(docs, F.struct("path", lit("$").alias("location")), checks.document_rules(c("doc"), True))
    return found.select("location.path", "location.location", "rule", "severity")


_STEP_RULES = {
    "step_id_form": "i = 1 AND p % 3 = 1",
    "step_order": "i = 1 AND p % 3 = 0",
    "step_twice": "i = 1 AND p % 3 = 0",
    "step_type": "i = 1 AND p % 4 = 0",
    "depends_on_itself": "i = 2 OR (i = 1 AND p % 3 = 0 AND p % 5 <> 0)",
    "depends_on_twice": "i = 2",
    "depends_on_unknown": "i = 1 AND p % 5 = 0",
    "solar_parameters": "i = 2 AND p % 2 = 1",
    "parameter_name": "i = 1 AND p % 2 = 0",
    "parameter_raw": "i = 1",
    "parameter_markup": "i = 1",
}


@query(f"WITH {_DUCK}, {_PAPER}, s AS (SELECT p, path, i, concat('$.method_chain[', i, ']') AS location FROM q, (VALUES (0), (1), (2)) v(i)) " + _sql(_STEP_RULES, "s"))
def method_chain_violations(spark, d):
    x = checks.steps(papers.scan(documents(spark, d)))
    found = rules.violations(x, F.struct("path", "location"), checks.step_rules())
    return found.select("location.path", "location.location", "rule", "severity")


_GROUP_RULES = {"group_refs_missing": "p % 4 = 1", "group_like_candidate": "true"}


@query(f"WITH {_DUCK}, {_PAPER}, s AS (SELECT p, path, '$.candidate_groups_considered[0]' AS location FROM q WHERE p % 3 = 0) " + _sql(_GROUP_RULES, "s", ("group_like_candidate",)))
def group_violations(spark, d):
    docs = papers.scan(documents(spark, d)).where("doc is not null")
    x = docs.select("path", c("doc.extraction.status").alias("status"), F.posexplode("doc.candidate_groups_considered").alias("i", "g")).withColumn("location", F.format_string("$.candidate_groups_considered[%d]", "i"))
    found = rules.violations(x, F.struct("path", "location"), checks.group_rules(c("g"), c("status")))
    return found.select("location.path", "location.location", "rule", "severity")


@query(f"""WITH {_DUCK}, q AS ({_union()}), m AS ({_sql(_QUANTITY_RULES, 'q', ('no_limit_mark',))}) SELECT path, regexp_extract(location, 'candidates\\[(\\d+)', 1)::INTEGER AS candidate, count(*) AS n, min(rule) AS first_rule FROM m GROUP BY ALL""")
def messages_by_candidate(spark, d):
    found = quantity_violations(spark, d).withColumn("message", F.concat_ws(": ", "location", "rule"))
    return checks.routed(found).groupBy("path", "candidate").agg(F.count("*").alias("n"), F.min("rule").alias("first_rule"))


# --- references to the lines of texts ---------------------------------------------------------------------------------

_LINES = "(SELECT doc_id, text, CASE WHEN coalesce(text, '') = '' THEN [] ELSE string_split(regexp_replace(text, '\\n$', ''), chr(10)) END AS l, (doc_id % 7)::INTEGER AS a, (doc_id % 7 + doc_id % 3 - 1)::INTEGER AS z FROM documents)"


@query(f"""SELECT doc_id, CASE WHEN text IS NULL THEN 'no such file' WHEN a < 1 OR z < a THEN 'no valid line range' WHEN a > len(l) THEN 'range past the end' ELSE '' END AS error,
  sha256(CASE WHEN text IS NULL OR a < 1 OR z < a OR a > len(l) THEN '' ELSE concat(array_to_string(l[a:least(z, len(l))], chr(10)), chr(10)) END) AS excerpt FROM {_LINES}""")
def line_range_excerpt(spark, d):
    x = t(spark, d, "documents")
    a, z = (c("doc_id") % 7).cast("int"), (c("doc_id") % 7 + c("doc_id") % 3 - 1).cast("int")
    got = x.select("doc_id", F.when(c("text").isNotNull(), lines_of(c("text"))).alias("l")).select("doc_id", checks.excerpt(c("doc_id").cast("string"), c("l"), a, z).alias("e"))
    return got.select("doc_id", "e.error", F.sha2("e.excerpt", 256).alias("excerpt"))


def lines_of(text):
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(text, r"\n\z", ""), "\n", -1))


@query(f"""WITH r AS (SELECT *, a >= 1 AND z >= a AND z <= len(l) AS ok FROM {_LINES}), s AS (SELECT *, CASE WHEN ok THEN len(list_filter(l[a:z], lambda x: trim(x) <> '' AND NOT regexp_matches(trim(x), '^[%#]') AND trim(x) NOT IN ('{{', '}}') AND NOT regexp_matches(trim(x), '^[A-Za-z_][A-Za-z0-9_]*\\s*=\\s*[^,]+,?\\s*$'))) > 0 END AS said FROM r)
  SELECT doc_id, 'file_missing' AS rule FROM s WHERE text IS NULL UNION ALL SELECT doc_id, 'line_range' FROM s WHERE text IS NOT NULL AND NOT ok UNION ALL SELECT doc_id, 'line_hollow' FROM s WHERE NOT said
  UNION ALL SELECT doc_id, 'context_elsewhere' FROM s WHERE said AND NOT contains(lower(array_to_string(l[a:z], chr(10))), 'ing')""")
def text_reference_violations(spark, d):
    ref = F.struct(lit("the text: ing").alias("context"), (c("doc_id") % 7).cast("int").alias("start_line"), (c("doc_id") % 7 + c("doc_id") % 3 - 1).cast("int").alias("end_line"))
    x = t(spark, d, "documents").select("doc_id", ref.alias("r"), F.when(c("text").isNotNull(), lines_of(c("text"))).alias("l"))
    return rules.violations(x, c("doc_id"), checks.text_ref_rules(c("r"), c("l"))).select(c("location").alias("doc_id"), "rule")
