"""Queries of provenance, replies, object records and what is shown of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import replies
from ..operators import dynamics, objects, papers, provenance, rollups, rules, tables
from . import paper_queries
from .queries import c, lit, query, t

_K = "c_custkey"
_PLACES = ("core.observed_phase_space.ra", "core.observed_phase_space.distance", "core.derived_kinematics.total_velocity", "photometry[0]", "spectroscopy[1]", "orbit.zmax", "extra[0]", "extra[1]", "stellar_parameters.teff", "quality_flags[0]")
_NAMES = ("escape speed", "age of star", "heliocentric distance", "rv", "g magnitude", "ranking", "selected", "nothing at all")


def _pick(values, n: str):
    return F.element_at(F.array(*map(lit, values)), (c(_K) % len(values) + 1).cast("int")).alias(n)


@query(f"""WITH x AS (SELECT c_custkey, {list(_PLACES)}[c_custkey % 10 + 1] AS place, {list(_NAMES)}[c_custkey % 8 + 1] AS name FROM customer) SELECT c_custkey, CASE WHEN place LIKE 'core.observed%.ra' THEN 'catalog_observed' WHEN place LIKE '%.distance' THEN 'distance' WHEN place LIKE '%derived%' THEN 'velocity'
  WHEN place LIKE 'phot%' THEN 'photometric' WHEN place LIKE 'spec%' THEN CASE WHEN name = 'rv' THEN 'radial_velocity' ELSE 'stellar_parameter' END WHEN place LIKE 'orbit%' THEN 'orbit' WHEN place LIKE 'stellar%' THEN 'stellar_parameter' WHEN place LIKE 'quality%' THEN 'quality'
  ELSE CASE name WHEN 'escape speed' THEN 'bound_assessment' WHEN 'age of star' THEN 'stellar_parameter' WHEN 'heliocentric distance' THEN 'distance' WHEN 'rv' THEN 'radial_velocity' WHEN 'g magnitude' THEN 'photometric' WHEN 'ranking' THEN 'candidate_classification' WHEN 'selected' THEN 'sample_selection' END END AS category FROM x""")
def quantity_categories(spark, d):
    x = t(spark, d, "customer").select(_K, _pick(_PLACES, "place"), _pick(_NAMES, "name"))
    q = F.struct("name", lit("").alias("kind"), lit("").alias("description"), lit("").alias("unit"))
    field = F.regexp_replace(F.substring_index("place", ".", -1), r"\[\d+\]", "")
    return x.select(_K, provenance.category(F.concat(lit("candidates[0]."), c("place")), field, q).alias("category"))


_TYPES = ("velocity_calculation", "orbit_integration", "escape_or_bound_assessment", "input_catalog", "radial_velocity_measurement", "sample_selection")
_SUMMARIES = ("we integrated the orbit and computed the velocity", "distances were not used", "compared to the escape speed", "measured the radial velocity in follow-up observations", "computed distances")
_OUT = ("", "distance", "total velocity")


@query(f"""WITH x AS (SELECT c_custkey, {list(_TYPES)}[c_custkey % 6 + 1] AS t, c_custkey % 5 AS s, c_custkey % 3 AS o FROM customer), e AS (SELECT *, list_distinct(list_filter([
    CASE t WHEN 'velocity_calculation' THEN 'velocity' WHEN 'orbit_integration' THEN 'orbit' WHEN 'escape_or_bound_assessment' THEN 'bound_assessment' WHEN 'radial_velocity_measurement' THEN 'radial_velocity' END, CASE WHEN o = 1 THEN 'distance' END, CASE WHEN o = 2 THEN 'velocity' END,
    CASE WHEN s = 0 THEN 'orbit' END, CASE WHEN s = 0 THEN 'velocity' END, CASE WHEN s = 2 THEN 'bound_assessment' END, CASE WHEN s = 3 THEN 'radial_velocity' END, CASE WHEN s = 3 THEN 'follow_up' END, CASE WHEN s = 4 THEN 'distance' END], lambda v: v IS NOT NULL)) AS e FROM x),
  k AS (SELECT c_custkey, list_sort(CASE t WHEN 'input_catalog' THEN [] WHEN 'velocity_calculation' THEN list_filter(e, lambda v: v NOT IN ('radial_velocity', 'orbit') AND (v <> 'distance' OR o = 1)) WHEN 'orbit_integration' THEN list_filter(e, lambda v: v NOT IN ('velocity', 'bound_assessment') AND (v <> 'distance' OR o = 1))
    WHEN 'escape_or_bound_assessment' THEN list_filter(e, lambda v: v NOT IN ('orbit', 'velocity', 'radial_velocity') AND (v <> 'distance' OR o = 1)) WHEN 'radial_velocity_measurement' THEN list_filter(e, lambda v: v <> 'follow_up') ELSE e END) AS k FROM e)
  SELECT c_custkey, array_to_string(k, ',') AS signals, concat_ws('|', CASE WHEN list_contains(k, 'distance') AND list_contains(k, 'velocity') THEN 'distance and velocity' END, CASE WHEN list_contains(k, 'velocity') AND list_contains(k, 'orbit') THEN 'velocity and orbit' END,
    CASE WHEN list_contains(k, 'orbit') AND list_contains(k, 'bound_assessment') THEN 'orbit and bound_assessment' END, CASE WHEN list_contains(k, 'radial_velocity') AND list_contains(k, 'follow_up') THEN 'radial_velocity and follow_up' END) AS mixed FROM k""")
def method_step_signals(spark, d):
    x = t(spark, d, "customer").select(_K, provenance.signals(_pick(_TYPES, "t"), F.array(_pick(_OUT, "o")), _pick(_SUMMARIES, "s")).alias("s"))
    return x.select(_K, F.array_join("s", ",").alias("signals"), F.array_join(provenance.mixed_actions(c("s")), "|").alias("mixed"))


@query("""WITH x AS (SELECT l_orderkey, l_linenumber, ['distance', 'orbit', 'velocity', 'quality', 'sample_selection', 'photometric', 'stellar_parameter', 'unknown'] AS n, [l_partkey % 8 + 1, l_suppkey % 8 + 1] AS i FROM lineitem), y AS (SELECT l_orderkey, l_linenumber, list_sort([n[i[1]], n[i[2]]]) AS p FROM x)
  SELECT l_orderkey, l_linenumber, p[1] = p[2] OR list_contains(p, 'unknown') OR p IN (['quality', 'sample_selection'], ['photometric', 'stellar_parameter']) AS compatible FROM y""")
def compatible_categories(spark, d):
    names = ("distance", "orbit", "velocity", "quality", "sample_selection", "photometric", "stellar_parameter", "unknown")
    pick = lambda k: F.element_at(F.array(*map(lit, names)), (c(k) % 8 + 1).cast("int"))
    types = {k: v for k, (v, _) in rules.PROVENANCE.items()}
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", provenance.compatible(F.array_distinct(F.array(pick("l_partkey"), pick("l_suppkey"))), types).alias("compatible"))


@query("""SELECT event_id, CASE event_id % 6 WHEN 5 THEN NULL ELSE 'v' || event_id END AS got, CASE event_id % 4 WHEN 0 THEN 2 WHEN 1 THEN 1 END::INTEGER AS n_items, CASE WHEN event_id % 3 = 0 THEN 'note' ELSE '' END AS cjk, CASE WHEN event_id % 5 = 0 THEN true WHEN event_id % 5 = 1 THEN false END AS thinking,
  CASE WHEN event_id % 2 = 0 THEN '- a' || chr(10) || '- b' ELSE '- a' || chr(10) || '- b' || chr(10) || '- and 1 more' END AS feedback FROM events""")
def reply_parsing(spark, d):
    k, v = c("event_id"), F.concat(lit('{"a":"v'), c("event_id").cast("string"), lit('"}'))
    m = k % 6
    text = F.when(m == 0, v).when(m == 1, F.concat(lit("```json\n"), v, lit("\n```"))).when(m == 2, F.concat(lit("Here it is: "), v, lit(" done."))).when(m == 3, F.concat(lit("``` \n"), v, lit("```"))).when(m == 4, F.concat(lit("\n "), v)).otherwise('{"a": ')
    listed = F.when(k % 4 == 0, lit("so: [1, 2] ok")).when(k % 4 == 1, lit("[{}]")).when(k % 4 == 2, lit("none")).otherwise("[1,")
    fields = F.create_map(lit("raw_value"), lit("星"), lit("note"), F.when(k % 3 == 0, "a 星").otherwise("a"))
    option = F.when(k % 5 == 0, " On ").when(k % 5 == 1, "disabled").otherwise("perhaps")
    errors = F.when(k % 2 == 0, F.array(lit("a"), lit("b"))).otherwise(F.array(lit("a"), lit("b"), lit("c")))
    return t(spark, d, "events").select("event_id", F.get_json_object(replies.json_object(text), "$.a").alias("got"), F.json_array_length(replies.json_array(listed)).alias("n_items"), F.array_join(replies.cjk_fields(fields), ",").alias("cjk"), replies.thinking(option).alias("thinking"), replies.feedback(errors, 2).alias("feedback"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_acctbal::VARCHAR END AS scalar, concat_ws('|', c_name, CASE WHEN c_custkey % 2 = 0 THEN 'Alias ' || c_custkey END) AS aliases, c_custkey % 4 <> 3 AS same,
  CASE WHEN c_custkey % 2 = 0 THEN 'ra:1:deg,name:x:' ELSE 'ra:1:deg' END AS fields, CASE c_custkey % 3 WHEN 0 THEN 'v3' WHEN 1 THEN 'v3' ELSE 'other' END AS version FROM customer""")
def provider_rows(spark, d):
    k = c(_K)
    ids = F.when(k % 2 == 0, F.concat(F.upper("c_name"), lit("| Alias  "), k.cast("string"), lit("|"))).otherwise("")
    row = F.create_map(lit("ra"), lit("1"), lit("name"), F.when(k % 2 == 0, "x").otherwise(""), lit("more"), lit("y"))
    group = replies.field_group(replies.filled(row), ("ra", "name"), {"ra": "deg"})
    left = F.when(k % 4 == 0, F.concat(lit("Gaia DR3 "), F.lpad(k.cast("string"), 12, "1"))).when(k % 4 == 1, "HVS  5").otherwise("a")
    right = F.when(k % 4 == 0, F.concat(lit("dr2 "), F.lpad(k.cast("string"), 12, "1"))).when(k % 4 == 1, "hvs 5").when(k % 4 == 2, "A ").otherwise("b")
    version = F.when(k % 3 == 0, "v1").when(k % 3 == 1, "v2").otherwise("other")
    return t(spark, d, "customer").select(
        _K, F.when(k % 3 == 0, replies.scalar(lit(float("nan")))).otherwise(replies.scalar(c("c_acctbal"))).alias("scalar"), F.array_join(replies.provider_aliases(c("c_name"), ids), "|").alias("aliases"), replies.equivalent(left, right).alias("same"),
        F.array_join(F.transform(F.map_entries(group), lambda e: F.concat_ws(":", e["key"], e["value"]["value"], e["value"]["unit"])), ",").alias("fields"), replies.rewritten(version, {"v1": "v3", "v2": "v3"}).alias("version"),
    )


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN '0.5 [0.25, 0.75]' WHEN o_orderkey % 4 = 1 THEN '1.23e+03' WHEN o_orderkey % 4 = 2 THEN '120 [99.5, 1e-05]' ELSE '' END AS text FROM orders")
def interval_texts(spark, d):
    m = c("o_orderkey") % 4
    v = lambda *x: F.when(m == 0, x[0]).when(m == 1, x[1]).when(m == 2, x[2])
    return t(spark, d, "orders").select("o_orderkey", replies.interval_text(v(0.5, 1234.0, 120.0), v(0.25, None, 99.54), v(0.75, 2000.0, 0.00001)).alias("text"))


# --- object records ---------------------------------------------------------------------------------------------------


_ORDER = ["month", "path", "index"]


def object_parts(spark, d):
    """The paper candidates as contributions to objects, by their own names."""
    x = paper_queries.read(spark, d).withColumn("s", papers.simplified(c("c")))
    return x.select(F.col("s.identifiers.paper_candidate_id").alias("object_id"), "arxiv_id", "month", "path", "index", "s")


def object_rows(spark, d):
    """Object records of the paper candidates."""
    return objects.records(object_parts(spark, d), "object_id", _ORDER)


_OBJ = f"""{paper_queries._DUCK}, o AS (SELECT *, {paper_queries._OWN} AS object_id, concat('20', lpad((10 + p % 10)::VARCHAR, 2, '0'), '-05') AS month, {paper_queries._GAIA} AS gaia, CASE k % 5 WHEN 0 THEN '8.5' WHEN 1 THEN '~8' WHEN 2 THEN '$8$' WHEN 3 THEN '' ELSE '1e3' END AS dist,
  row_number() OVER (PARTITION BY {paper_queries._OWN} ORDER BY concat('20', lpad((10 + p % 10)::VARCHAR, 2, '0'), '-05'), arxiv, idx) AS n FROM base WHERE {paper_queries._READ})"""


@query(f"""WITH {_OBJ} SELECT object_id, count(*)::INTEGER AS source_count, min(month) AS discovery_month, count(DISTINCT CASE WHEN gaia <> '' THEN gaia END)::INTEGER AS n_gaia, arg_min(CASE WHEN dist = '' THEN '' WHEN k % 3 = 0 THEN dist || ' ± 0.2' ELSE dist END, n) AS distance,
  count(*)::INTEGER AS n_photometry, sum((k % 9 = 0)::INTEGER)::INTEGER AS n_extra, sum((k % 2 = 0)::INTEGER + (k % 6 = 0)::INTEGER)::INTEGER AS n_stellar, sum((k % 4 = 3)::INTEGER)::INTEGER AS n_orbit,
  sum((k % 2 = 0)::INTEGER)::INTEGER AS n_reassessed, count(DISTINCT {paper_queries._CLAIM})::INTEGER AS n_claims FROM o GROUP BY object_id""")
def object_index_rows(spark, d):
    x = objects.index_rows(object_rows(spark, d), "object_id")
    return x.select(
        "object_id", "source_count", "discovery_month", F.size("gaia_source_ids").alias("n_gaia"), c("best.distance").alias("distance"), c("coverage.photometry").alias("n_photometry"), c("coverage.extra").alias("n_extra"), c("coverage.stellar_parameters").alias("n_stellar"),
        c("coverage.orbit").alias("n_orbit"), c("context.reassessed_source_count").alias("n_reassessed"), F.size("context.bound_claims").alias("n_claims"),
    )


@query(f"""WITH {_OBJ} SELECT object_id, format('src-{{:03d}}', n) AS source, gaia AS gaia_source_id, arxiv AS path, trim(concat_ws(' ', 'arXiv', CASE WHEN p % 7 = 6 THEN '' ELSE arxiv END, left(month, 4))) AS reported_by, CASE WHEN dist = '' THEN '' WHEN k % 3 = 0 THEN dist || ' ± 0.2' ELSE dist END AS distance,
  {paper_queries._CLAIM} AS bound_claim, CASE k % 6 WHEN 0 THEN '' WHEN 1 THEN 'hvs_candidate' WHEN 2 THEN 'odd' ELSE 'hvs_candidate|escaping_star' END AS labels FROM o""")
def object_sources(spark, d):
    s = objects.source_summaries(object_parts(spark, d), "object_id", _ORDER, lit(""), lit(""))
    return s.select("object_id", "s.source", "s.gaia_source_id", "path", "s.reported_by", c("s.phase_space.distance").alias("distance"), "s.bound_claim", F.array_join("s.paper_labels", "|").alias("labels"))


@query(f"WITH {_OBJ} SELECT object_id, format('src-{{:03d}}', n) AS source, CASE WHEN k % 17 = 0 THEN 'bad-id' ELSE concat(arxiv, ':cand-', lpad((idx + 1)::VARCHAR, 3, '0')) END AS record_id FROM o")
def object_contributions(spark, d):
    x = objects.contributions_of(object_rows(spark, d), "object_id")
    return x.select("object_id", c("row.source").alias("source"), c("s.identifiers.record_id").alias("record_id"))


@query(f"""WITH {_OBJ}, d AS (SELECT object_id, string_agg(format('src-{{:03d}}', n) || '=' || CASE WHEN k % 3 = 0 THEN dist || ' ± 0.2' ELSE dist END, ';' ORDER BY n) AS v FROM o WHERE dist <> '' GROUP BY 1), sp AS (SELECT object_id, count(*) AS n FROM o WHERE k % 6 = 0 GROUP BY 1), te AS (SELECT object_id, count(*) AS n FROM o WHERE k % 2 = 0 GROUP BY 1)
  SELECT object_id, coalesce(v, '') AS distances, coalesce(sp.n, 0)::INTEGER AS n_types, coalesce(te.n, 0)::INTEGER AS n_teff FROM (SELECT DISTINCT object_id FROM o) LEFT JOIN d USING (object_id) LEFT JOIN sp USING (object_id) LEFT JOIN te USING (object_id)""")
def viewer_columns(spark, d):
    k = F.array(F.struct(lit("").alias("source"), "s"))  # each contribution alone; it gets its source once it is only texts and counts
    listed = objects.literature_items(k, "observed_phase_space", "distance")["value"]
    x = object_parts(spark, d).select("object_id", *_ORDER, listed.alias("v"), F.size(objects.spectral_type_items(k)).alias("n_types"), F.size(objects.parameter_items(k, "teff")).alias("n_teff"))
    x = rollups.numbered_within(x, "object_id", _ORDER)
    v = F.transform("v", lambda i: F.concat_ws("=", objects.source_number(c("n")), i))
    g = x.groupBy("object_id").agg(F.array_sort(F.collect_list(F.when(F.size("v") > 0, F.struct("n", v.alias("v"))))).alias("e"), *(F.sum(n).cast("int").alias(n) for n in ("n_types", "n_teff")))
    return g.select("object_id", F.array_join(F.flatten("e.v"), ";").alias("distances"), "n_types", "n_teff")


@query("""WITH x AS (SELECT c_nationkey, c_custkey, (1990 + c_custkey % 30)::VARCHAR AS month, CASE WHEN c_custkey % 4 > 0 THEN c_custkey % 7 END AS cites, c_name AS label FROM customer) SELECT c_nationkey, arg_min(label, (month, label)) AS earliest, arg_max(label, (month, -c_custkey)) AS latest, arg_max(label, (coalesce(cites, -1), -c_custkey)) AS cited FROM x GROUP BY 1""")
def reporter_order(spark, d):
    k = c(_K)
    e = F.struct((lit(1990) + k % 30).cast("string").alias("month"), F.when(k % 4 > 0, k % 7).alias("citations"), c("c_name").alias("label"))
    x = t(spark, d, "customer").groupBy("c_nationkey").agg(F.collect_list(e).alias("e"))
    return x.select("c_nationkey", *(objects.selected_reporter(c("e"), m).alias(m) for m in ("earliest", "latest", "cited")))


@query("""SELECT c_custkey, concat_ws('|', CASE WHEN c_custkey % 5 = 0 THEN 'minimum is no number' END, CASE WHEN c_custkey % 5 > 0 AND (c_custkey % 50 < 10 OR c_custkey % 50 > 20) THEN 'minimum outside the data' END, CASE WHEN c_custkey % 30 > 20 OR c_custkey % 30 < 10 THEN 'maximum outside the data' END, CASE WHEN c_custkey % 5 > 0 AND c_custkey % 50 > c_custkey % 30 THEN 'minimum above maximum' END) AS errors,
  CASE WHEN c_custkey % 3 = 0 THEN 'HVS ' || c_custkey END AS object_id, CASE WHEN c_custkey % 3 = 0 THEN CASE WHEN c_custkey % 2 = 0 THEN 'src-001' ELSE '' END END AS source FROM customer""")
def range_and_route(spark, d):
    k = c(_K)
    low = F.when(k % 5 == 0, "x").otherwise((k % 50).cast("string"))
    errors = objects.range_errors(low, (k % 30).cast("string"), lit(10.0), lit(20.0))
    link = F.when(k % 3 == 0, F.concat(lit("#/object/HVS%20"), k.cast("string"), F.when(k % 2 == 0, "/src-001").otherwise(""))).otherwise("#/about")
    return t(spark, d, "customer").select(_K, F.array_join(errors, "|").alias("errors"), objects.route(link)["object_id"].alias("object_id"), objects.route(link)["source"].alias("source"))


@query("""SELECT n_regionkey, '# Region ' || n_regionkey || chr(10) || chr(10) || '| Name | Note |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || n_name || ' | a\\|' || n_nationkey || ' |', chr(10) ORDER BY n_name) || chr(10) AS text FROM nation GROUP BY n_regionkey""")
def markdown_tables(spark, d):
    x = t(spark, d, "nation").withColumn("note", F.concat(lit("a|"), c("n_nationkey").cast("string")))
    return objects.markdown(x, ["n_regionkey"], ["n_name"], {"n_name": "Name", "note": "Note"}, F.concat(lit("Region "), c("n_regionkey").cast("string")))


@query("""SELECT n_nationkey, '# %ECSV 1.0' || chr(10) || '# ---' || chr(10) || '# datatype:' || chr(10) || '# - {name: col_001, datatype: string}' || chr(10) || '# - {name: col_002, datatype: string}' || chr(10) || '# meta: {description: ["' || n_name || '"]}' || chr(10) || 'col_001 col_002' || chr(10) || CASE WHEN contains(n_name, ' ') THEN '"' || n_name || '"' ELSE n_name END || ' "a ' || repeat('"', 2) || 'b' || repeat('"', 3) || chr(10) || '"" 1' || chr(10) AS text FROM nation""")
def ecsv_text(spark, d):
    rows = F.array(F.array(c("n_name"), lit('a "b"')), F.array(lit(""), lit("1")))
    return t(spark, d, "nation").select("n_nationkey", objects.ecsv(["col_001", "col_002"], rows, c("n_name")).alias("text"))


@query(r"""SELECT page_id, page_id % 4 = 0 OR regexp_matches(html, '(?i)<(script|img|iframe)\b[^>]*\bsrc\s*=\s*["'']?(https?:)?//|<link\b[^>]*\bhref\s*=\s*["'']?(https?:)?//|@import\s+(url\()?["'']?(https?:)?//') AS external FROM pages""")
def external_page_parts(spark, d):
    html = F.concat(F.coalesce("html", lit("")), F.when(c("page_id") % 4 == 0, lit('<IMG alt="" SRC="//x.org/a.png">')).otherwise('<img src="a.png"><a href="https://x.org">'))
    return t(spark, d, "pages").select("page_id", objects.external_dependencies(html).alias("external"))


# --- tables out of files, and dynamics --------------------------------------------------------------------------------


@query("""SELECT n_nationkey, CASE n_nationkey % 5 WHEN 0 THEN 'Name [km/s]|key' WHEN 1 THEN '' WHEN 2 THEN '' WHEN 3 THEN 'name|key' ELSE 'key|name' END AS header, CASE n_nationkey % 5 WHEN 0 THEN n_name || ',' || n_nationkey WHEN 1 THEN '' WHEN 2 THEN '' WHEN 3 THEN n_name || ',' || n_nationkey ELSE n_nationkey || ',' || n_name END AS first_row,
  CASE n_nationkey % 5 WHEN 1 THEN 'nothing is read into other' WHEN 2 THEN 'no such columns: age' ELSE '' END AS error FROM nation""")
def plotted_file_tables(spark, d):
    k, name = c("n_nationkey"), c("n_name")
    m = k % 5
    source = F.concat(lit("% \\\\pgfplotstableread{no.csv}\\\\data\n\\\\pgfplotstableread[col sep=").cast("string"), F.when(m == 4, "semicolon").otherwise("comma"), lit("]{t.csv}\\\\data"))
    source = F.replace(source, lit("\\\\"), lit("\\"))
    what = F.when(m == 0, "[columns={name,key}, columns/name/.style={column name={Name [km/s]}}]{\\data}").when(m == 1, "{\\other}").when(m == 2, "[columns={name,age}]{\\data}").when(m == 3, "[columns={name,key}]{\\data}").otherwise("{\\data}")
    text = F.when(m == 4, F.concat(lit("key;name\n"), k.cast("string"), lit(";"), name)).otherwise(F.concat(lit("key, name\n"), k.cast("string"), lit(', "'), name, lit('"')))
    x = t(spark, d, "nation").select("n_nationkey", F.concat(lit("\\pgfplotstabletypeset"), what).alias("excerpt"), source.alias("source"), F.create_map(lit("t.csv"), text).alias("files"))
    got = tables.plotted_rows(x, "n_nationkey", "excerpt", "source", "files")
    return got.select("n_nationkey", F.array_join("header", "|").alias("header"), F.coalesce(F.array_join(F.get("rows", lit(0)), ","), lit("")).alias("first_row"), "error")


@query("""SELECT c_custkey, 'col_001:Name:' || CASE WHEN c_custkey % 2 = 0 THEN ':mixed' ELSE ':string' END || ';col_002:Speed | [km/s]:[km/s]:' || CASE WHEN c_custkey % 3 = 0 THEN 'number' WHEN c_custkey % 3 = 1 THEN '' ELSE 'mixed' END AS columns, CASE WHEN c_custkey % 2 = 1 THEN '\\alpha,\\foo' ELSE '\\foo' END AS macros FROM customer""")
def column_records(spark, d):
    k = c("c_custkey")
    header = F.array(F.array(lit("Name"), lit("Speed")), F.array(lit(""), lit("[km/s]")))
    third = k % 3
    cell = lambda a, b, z: F.when(third == 0, a).when(third == 1, b).otherwise(z)
    rows = F.array(F.array(F.when(k % 2 == 0, "7").otherwise("a \\alpha"), cell("1,000", "...", "3 +/- 1")), F.array(lit("\\foo"), cell("2", "", "x")))
    x = tables.columns_of(header, rows)
    shown = F.array_join(F.transform(x, lambda r: F.concat_ws(":", r["name"], r["original_header"], r["unit_text"], r["data_type"])), ";")
    return t(spark, d, "customer").select("c_custkey", shown.alias("columns"), F.array_join(tables.macros_left(rows), ",").alias("macros"))


@query("""WITH x AS (SELECT s_suppkey AS k FROM supplier) SELECT k, CASE k % 8 WHEN 0 THEN 'missing required zero-point values' WHEN 1 THEN 'missing nu_eff_used_in_astrometry for a five-parameter solution' WHEN 2 THEN 'missing pseudocolour for a six-parameter solution' WHEN 3 THEN 'unsupported solution: 3' WHEN 4 THEN 'the calibration failed' WHEN 5 THEN 'the zero point is not finite' ELSE '' END AS error,
  CASE WHEN k % 8 > 5 THEN 2.5 END::DOUBLE AS parallax, CASE WHEN k % 5 = 0 THEN 'missing or invalid field: parallax' WHEN k % 5 = 1 THEN 'missing or non-positive uncertainty: pmra_error' ELSE '' END AS row_error, CASE WHEN k % 3 = 0 THEN 0.0 ELSE greatest(0.0, 1.0 - 0.05 * (k - 1)) END::DOUBLE AS axis_start FROM x WHERE k > 1""")
def astrometry_gates(spark, d):
    x = t(spark, d, "supplier").select(c("s_suppkey").alias("k")).where("k > 1")
    k, none = c("k"), F.lit(None).cast("double")
    m = k % 8
    row = {
        "phot_g_mean_mag": F.when(m != 0, 15.0), "ecl_lat": lit(1.0), "astrometric_params_solved": F.when(m == 3, 3.0).when(m == 2, 95.0).otherwise(31.0), "parallax": lit(2.0),
        "nu_eff_used_in_astrometry": F.when(m != 1, 1.5), "pseudocolour": none,
    }
    zero = F.when(m == 4, none).when(m == 5, float("nan")).otherwise(-0.5)
    full = {f: lit(1.0) for f in dynamics.REQUIRED} | {"parallax": F.when(k % 5 == 0, float("nan")).otherwise(1.0), "pmra_error": F.when(k % 5 == 1, 0.0).otherwise(0.1)}
    p = dynamics.corrected_parallax(row, zero)
    low = F.when(k % 3 == 0, 0.01).otherwise(1.0)
    return x.select("k", p["error"].alias("error"), p["parallax"].alias("parallax"), dynamics.astrometry_error(full).alias("row_error"), F.get(dynamics.grid_axis(low, F.when(k % 3 == 0, lit(5.0)).otherwise(k.cast("double"))), lit(0)).alias("axis_start"))


@query()
def unbound_share_quantiles(spark, d):
    x = t(spark, d, "supplier").select("s_suppkey", (c("s_suppkey") * 7 % 101).alias("hits"))
    return x.withColumn("q", dynamics.beta_quantiles(c("hits"), lit(100))).select("s_suppkey", "hits", "q.p16", "q.median", "q.p84")
