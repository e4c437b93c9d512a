"""Queries of reviews, extractions, providers and migrations over rows made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalogue, checks, rules
from .queries import c, lit, query, t


def _rules_sql(found: dict[str, str], table: str, key: str) -> str:
    return " UNION ALL ".join(f"SELECT {key} AS location, '{name}' AS rule FROM {table} WHERE {when}" for name, when in found.items())


_REVIEW = {
    "table_twice": "c_custkey % 4 = 0",
    "table_unsourced": "c_custkey % 5 = 0",
    "resource_url": "c_custkey % 6 = 5",
    "needs_review": "c_custkey % 7 = 3",
    "summary_missing": "c_custkey % 7 <> 6 AND c_custkey % 3 = 0",
    "table_asset_type_missing": "c_custkey % 7 <> 6 AND c_custkey % 8 = 0",
    "column_meaning_missing": "c_custkey % 7 <> 6 AND c_custkey % 9 = 0",
    "resource_evidence_missing": "c_custkey % 7 <> 6 AND c_custkey % 10 > 4",
}


@query(_rules_sql(_REVIEW, "customer", "c_custkey"))
def review_violations(spark, d):
    k = c("c_custkey")
    refs = F.when(k % 5 == 0, F.array().cast("array<string>")).otherwise(F.array(lit("r")))
    columns = F.array(F.struct(F.when(k % 9 == 0, " ").otherwise("m").alias("meaning")))
    table = lambda ident: F.struct(ident.alias("id"), F.when(k % 8 == 0, "").otherwise("a").alias("asset_type"), lit("x").alias("role_in_paper"), lit("e").alias("evidence"), columns.alias("columns"), refs.alias("source_refs"))
    tables_ = F.array(table(lit("t1")), table(F.when(k % 4 == 0, "t1").otherwise("t2")))
    resource = F.struct(lit("r1").alias("id"), F.when(k % 6 == 5, "ftp://x").when(k % 6 == 4, "").otherwise("https://x").alias("url"), lit("d").alias("description"), F.when(k % 10 > 4, "").otherwise("e").alias("evidence"), F.array(lit("r")).alias("source_refs"))
    status = F.when(k % 7 == 3, "needs_review").when(k % 7 == 6, "source_missing").otherwise("reviewed")
    x = t(spark, d, "customer").select("c_custkey", tables_.alias("t"), F.array(resource).alias("r"), status.alias("s"), F.when(k % 3 == 0, "").otherwise("done").alias("m"))
    return rules.violations(x, c("c_custkey"), catalogue.review_rules(c("t"), c("r"), c("s"), c("m"), True)).select("location", "rule")


_EXTRACTION = {"excerpt_missing": "s < 3 AND text IS NULL", "hash": "s < 3 AND doc_id % 7 = 0 AND text IS NOT NULL", "row_count": "s < 3 AND doc_id % 6 = 1", "column_count": "s < 3 AND doc_id % 9 = 2"}


@query("WITH x AS (SELECT doc_id, text, doc_id % 5 AS s FROM documents) " + _rules_sql(_EXTRACTION, "x", "doc_id"))
def extraction_violations(spark, d):
    k = c("doc_id")
    status = F.element_at(F.array(*map(lit, ("success", "skipped_existing", "written", "failed", "deferred"))), (k % 5 + 1).cast("int"))
    digest = F.when(k % 7 == 0, F.sha2(lit("other"), 256)).when(k % 7 == 1, "").otherwise(F.sha2("text", 256))
    found = catalogue.extraction_rules(status, digest, c("text"), k % 6, k % 9, F.when(k % 6 == 1, 0).otherwise(k % 6), F.when(k % 9 == 2, 0).otherwise(k % 9))
    return rules.violations(t(spark, d, "documents"), k, found).select("location", "rule")


@query("""SELECT doc_id, CASE WHEN text IS NULL OR doc_id % 3 = 1 THEN true ELSE contains(string_split(text, chr(10))[1], 'the') END AS present FROM documents WHERE coalesce(text, '') <> ''""")
def resource_urls_in_lines(spark, d):
    x = t(spark, d, "documents").where("text <> ''")
    return x.select("doc_id", catalogue.url_in_lines(F.when(c("doc_id") % 3 == 1, "").otherwise("the"), F.split("text", "\n", -1), lit(1), lit(1)).alias("present"))


@query("""SELECT s_suppkey, CASE WHEN a > 0 AND f = 0 THEN 'success' WHEN a > 0 THEN 'partial' WHEN w = 0 THEN 'skipped' ELSE 'failed' END AS run, CASE WHEN f = 0 AND e > 0 THEN 'partial' WHEN f = 0 THEN 'success' WHEN e > 0 THEN 'failed' ELSE 'not_found' END AS provider FROM (SELECT s_suppkey, s_suppkey % 3 AS a, s_suppkey % 2 AS f, s_suppkey % 5 AS w, s_suppkey % 7 AS e FROM supplier)""")
def run_statuses(spark, d):
    k = c("s_suppkey")
    return t(spark, d, "supplier").select("s_suppkey", catalogue.run_status(k % 3, k % 2, k % 5).alias("run"), catalogue.provider_status(F.when(k % 2 == 0, "matched"), lit("not_found"), k % 7).alias("provider"))


_R = "r AS (SELECT CASE WHEN o_orderkey % 10 = 9 THEN 'unknown' ELSE year(o_orderdate)::VARCHAR END AS year, o_orderkey % 4 AS s, o_orderkey % 7 AS e, o_orderkey % 3 AS n, o_orderkey % 2 AS m FROM orders)"


@query(f"""WITH {_R} SELECT year, grouping(year) = 1 AS total, count(*) AS paper_count, count(*) FILTER (s = 0) AS reviewed_count, count(*) FILTER (s IN (1, 2)) AS needs_review_count, count(*) FILTER (n > 0) AS has_internal_table_count, count(*) FILTER (n > 0 OR m > 0) AS has_data_asset_count,
  sum(n)::BIGINT AS internal_table_count, sum(m)::BIGINT AS external_resource_count, count(*) FILTER (s = 2) AS review_status_warning_count, count(*) FILTER (e < 5) AS extraction_manifest_count, count(*) FILTER (e = 0) AS extraction_success_count, count(*) FILTER (e = 1) AS extraction_partial_count,
  count(*) FILTER (e IN (2, 5, 6)) AS extraction_failed_count, count(*) FILTER (e = 3) AS extraction_not_started_count, count(*) FILTER (e = 4) AS extraction_not_applicable_count, sum(n)::BIGINT AS table_success_count, sum(m)::BIGINT AS table_failed_count FROM r GROUP BY ROLLUP (year)""")
def review_index_counters(spark, d):
    k = c("o_orderkey")
    status = F.element_at(F.array(*map(lit, ("reviewed", "partial", "needs_review", "source_missing"))), (k % 4 + 1).cast("int"))
    state = F.get(F.array(*map(lit, catalogue.EXTRACTION)), (k % 7).cast("int"))
    x = t(spark, d, "orders").select(
        F.when(k % 10 == 9, "").otherwise(F.year("o_orderdate").cast("string")).alias("year"), status.alias("review_status"), F.when(k % 7 == 6, "odd").otherwise(state).alias("extraction_status"), (k % 3).alias("n_tables"), (k % 2).alias("n_resources"),
        (k % 4 == 2).alias("warned"), (k % 7 < 5).alias("manifest"), (k % 3).alias("tables_done"), (k % 2).alias("tables_failed"),
    )
    return catalogue.index_counters(x, "year")


@query("""WITH x AS (SELECT s_suppkey AS k, 'Star ' || s_suppkey AS n FROM supplier) SELECT k, CASE WHEN k % 2 = 0 THEN n ELSE '' END AS alias_matches, k % 2 = 0 AS identifier_match, k % 3 = 0 AS gaia_match, round(CASE WHEN k % 5 = 0 THEN 3.6 ELSE 36.0 END::DOUBLE, 4) AS separation1,
  concat_ws(',', CASE WHEN k % 3 = 1 THEN 'source_id_mismatch' END, CASE WHEN k % 5 > 0 THEN 'first_provider_far' END) AS warnings FROM x""")
def provider_verification(spark, d):
    k = c("s_suppkey")
    name = F.concat(lit("Star "), k.cast("string"))
    x = t(spark, d, "supplier").select(
        k.alias("k"), F.array(name).alias("names"), F.array(lit("5")).alias("gaia_numbers"), lit(10.0).alias("ra"), lit(20.0).alias("dec"), F.array(F.when(k % 2 == 0, F.upper(F.replace(name, lit(" "), lit("  ")))).otherwise("x")).alias("provider_names"),
        F.when(k % 3 == 0, "5").when(k % 3 == 1, "6").otherwise("").alias("provider_number"), lit(10.0).alias("ra1"), (lit(20.0) + F.when(k % 5 == 0, 0.001).otherwise(0.01)).alias("dec1"), F.lit(None).cast("double").alias("ra2"), lit(1.0).alias("dec2"),
    )
    return catalogue.verified(x).select("k", F.array_join("alias_matches", "|").alias("alias_matches"), "identifier_match", "gaia_match", F.round("separation1", 4).alias("separation1"), F.array_join("warnings", ",").alias("warnings"))


@query("""WITH l AS (SELECT c_custkey % 50 AS k, 'src-' || c_custkey AS source, CASE c_custkey % 3 WHEN 0 THEN 'parallax' WHEN 1 THEN 'radial_velocity' ELSE 'other' END AS field, c_custkey % 3 AS f, c_custkey AS v FROM customer WHERE c_custkey % 7 <> 0) , o AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 2 = 0 THEN 'parallax' ELSE 'radial_velocity' END AS field, s_suppkey AS v FROM supplier)
  SELECT l.k, l.source, l.field, round((l.v + 0.5::DOUBLE) - o.v, 12) AS difference, CASE WHEN o.v % 4 = 0 THEN 'mas' ELSE 'u' END AS unit FROM l JOIN o ON l.k = o.k AND l.field = o.field""")
def literature_differences(spark, d):
    k, s = c("c_custkey"), c("s_suppkey")
    l = t(spark, d, "customer").select((k % 50).alias("k"), F.concat(lit("src-"), k.cast("string")).alias("source"), F.when(k % 3 == 0, "parallax").when(k % 3 == 1, "radial_velocity").otherwise("other").alias("field"), F.when(k % 7 == 0, "none").otherwise(F.concat(lit("~"), k.cast("string"), lit(".5"))).alias("value"), lit("u").alias("unit"))
    o = t(spark, d, "supplier").select(s.alias("k"), F.when(s % 2 == 0, "parallax").otherwise("radial_velocity").alias("field"), s.cast("string").alias("value"), F.when(s % 4 == 0, "mas").otherwise("").alias("unit"))
    return catalogue.differences(l, o, "k").select("k", "source", "field", "difference", "unit")


@query("""WITH g AS (SELECT l_orderkey, count(*) AS n, min(l_linenumber) FILTER (l_partkey % 5 = l_orderkey % 5) AS hit, min(l_linenumber) AS first FROM lineitem GROUP BY 1) SELECT l_orderkey, coalesce(hit, CASE WHEN n = 1 THEN first END) AS line FROM g WHERE coalesce(hit, CASE WHEN n = 1 THEN first END) IS NOT NULL""")
def chosen_provider_rows(spark, d):
    x = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (c("l_partkey") % 5).cast("string").alias("ident"), (c("l_orderkey") % 5).cast("string").alias("wanted"))
    return catalogue.chosen_row(x, "l_orderkey", "wanted", "ident", "l_linenumber").select("l_orderkey", c("l_linenumber").alias("line"))


@query("""WITH p AS (SELECT p_partkey % 40 AS cell, max(p_partkey) FILTER (p_partkey % 6 <> 0) AS k FROM part GROUP BY 1) SELECT s_suppkey, CASE WHEN k % 5 > 0 THEN (k % 5)::DOUBLE END AS alpha, CASE WHEN k % 5 > 0 THEN k / 1000.0 END::DOUBLE AS length_kpc FROM supplier LEFT JOIN p ON cell = s_suppkey % 50""")
def distance_priors(spark, d):
    k = c("p_partkey")
    p = t(spark, d, "part").select((k % 40).cast("bigint").alias("cell"), k.alias("place"), F.when(k % 6 == 0, "none").otherwise((k % 5).cast("string")).alias("alpha"), lit("1").alias("beta"), k.cast("string").alias("length_pc"))
    x = t(spark, d, "supplier").select("s_suppkey", ((c("s_suppkey") % 50) * lit(562949953421312)).alias("source_id"))
    return catalogue.priors_for(x, p, "source_id").select("s_suppkey", "alpha", F.round("length_kpc", 9).alias("length_kpc"))


@query("""SELECT doc_id % 20 AS folder, sum(CASE doc_id % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 0 END)::BIGINT AS n_tables, max(CASE WHEN doc_id % 3 < 2 THEN doc_id % 4 ELSE 0 END)::INTEGER AS max_rows FROM documents GROUP BY 1""")
def tex_complexity(spark, d):
    k = c("doc_id")
    rows = F.expr(r"repeat('a & b \\\\\\\\ ', cast(doc_id % 4 as int))")
    rows = F.replace(rows, lit("\\\\\\\\"), lit("\\\\"))
    block = F.concat(lit("\\begin{table}\\begin{tabular}{c}"), rows, lit("\\end{tabular}\\end{table}"))
    text = F.when(k % 3 == 0, F.concat(block, lit("\\begin{deluxetable*}x\\end{deluxetable*}\\begin{longtable}\\end{longtable}"))).when(k % 3 == 1, block)
    return catalogue.complexity(t(spark, d, "documents").select((k % 20).alias("folder"), text.alias("text")), "folder", "text")


@query("SELECT l_orderkey, sum(l_partkey)::BIGINT AS prompt_tokens, sum(CASE WHEN l_linenumber % 2 = 0 THEN l_suppkey ELSE 0 END)::BIGINT AS completion_tokens, sum(l_linenumber)::BIGINT AS total_tokens, count(*) AS calls FROM lineitem GROUP BY 1")
def token_usage(spark, d):
    x = t(spark, d, "lineitem").select("l_orderkey", c("l_partkey").cast("bigint").alias("prompt_tokens"), F.when(c("l_linenumber") % 2 == 0, c("l_suppkey").cast("bigint")).alias("completion_tokens"), c("l_linenumber").cast("bigint").alias("total_tokens"))
    return catalogue.usage(x, ["l_orderkey"])


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'b' WHEN c_custkey % 5 <> 0 THEN 'n' || c_custkey ELSE '' END AS bibcode, c_custkey % 3 <> 0 AND c_custkey % 5 <> 0 AS updated, CASE WHEN c_custkey % 4 < 2 THEN 'v3' ELSE 'v9' END AS version, CASE WHEN c_custkey % 4 < 2 THEN 1 ELSE 0 END + CASE WHEN c_custkey % 6 = 0 THEN 1 ELSE 0 END AS changes FROM customer""")
def fill_and_migrate(spark, d):
    k = c("c_custkey")
    x = t(spark, d, "customer").select("c_custkey", F.when(k % 3 == 0, "b").otherwise("").alias("bibcode"), F.when(k % 4 == 0, "v1").when(k % 4 == 1, "v2").otherwise("v9").alias("version"), F.when(k % 6 != 0, "tool").alias("tooling"))
    other = t(spark, d, "customer").where("c_custkey % 5 <> 0").select("c_custkey", F.concat(lit("n"), k.cast("string")).alias("bibcode"))
    return catalogue.migrated(catalogue.filled(x, "bibcode", other, "c_custkey"), {"v1": "v3", "v2": "v3"}, "version", "tooling").select("c_custkey", "bibcode", "updated", "version", "changes")


@query("""SELECT o_orderkey, coalesce((SELECT string_agg(l_partkey::VARCHAR, ',' ORDER BY l_linenumber % 3, l_linenumber, l_partkey::VARCHAR) FROM lineitem WHERE l_orderkey = o_orderkey), '') AS candidates FROM orders""")
def merged_batch_documents(spark, d):
    b = t(spark, d, "lineitem").select(c("l_orderkey").alias("o_orderkey"), (c("l_linenumber") % 3).alias("batch"), c("l_linenumber").alias("place"), c("l_partkey").cast("string").alias("record"))
    return catalogue.merged_batches(t(spark, d, "orders").select("o_orderkey"), b, "o_orderkey").select("o_orderkey", F.array_join("candidates", ",").alias("candidates"))


@query("""WITH q AS (SELECT l_orderkey, l_linenumber, l_orderkey % 12 AS k FROM lineitem) SELECT l_orderkey, l_linenumber, CASE k WHEN 0 THEN 'unitless' WHEN 2 THEN 'unusual' WHEN 4 THEN 'unusual' WHEN 6 THEN NULL END AS lint FROM q""")
def unit_lint(spark, d):
    k = (c("l_orderkey") % 12).cast("int")
    field = F.when(k < 2, "bound_assessment.bound_probability").when(k < 4, "derived_kinematics.total_velocity").when(k < 6, "observed_phase_space.distance").otherwise("observed_phase_space.proper_motion_ra")
    unit = F.when(k == 0, "%").when(k == 1, "").when(k == 2, "m/s").when(k == 3, " km/s ").when(k == 4, "au").when(k == 5, "log kpc").otherwise("mas/yr")
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", checks.unit_lint(field, unit).alias("lint"))


_GOLD = {
    "field_unknown": "k % 5 = 4", "limit_kind": "k % 6 = 5", "error_not_number": "k % 7 = 6", "range_value": "k % 6 = 1 AND k % 2 = 0", "range_ends": "k % 6 = 1 AND k % 3 = 0", "ends_without_range": "k % 6 <> 1 AND k % 3 > 0", "value_missing": "k % 6 <> 1 AND k % 2 = 1",
    "record_id_missing": "k % 8 = 7", "nameless": "k % 9 = 0 AND k % 4 <> 0", "gaia_form": "k % 12 = 4", "claim": "k % 10 = 9", "origin": "k % 11 = 0", "evidence_missing": "k % 13 = 0", "ra_twice": "k % 14 = 0", "ra_range": "k % 15 = 0", "epoch_range": "k % 16 = 0",
    "fact_name": "k % 5 = 3", "fact_value_missing": "k % 2 = 0 AND k % 3 = 0", "fact_value_unexpected": "k % 2 = 1 AND k % 3 > 0",
}


@query("WITH x AS (SELECT c_custkey AS k FROM customer) " + _rules_sql(_GOLD, "x", "k"))
def annotation_violations(spark, d):
    k = c("k")
    q = F.struct(
        F.when(k % 5 == 4, "odd").otherwise("observed_phase_space.distance").alias("field"), F.when(k % 6 == 5, "about").when(k % 6 == 1, "range").otherwise("").alias("limit_kind"), F.when(k % 2 == 0, "1.5").otherwise(" ").alias("value"),
        F.when(k % 7 == 6, "2x").otherwise("0.1").alias("error"), lit("").alias("lower_error"), lit("").alias("upper_error"), F.when(k % 3 > 0, "1").otherwise("").alias("range_lower"), F.when(k % 3 > 0, "2").otherwise("").alias("range_upper"),
    )
    names = F.when(k % 9 == 0, F.array().cast("array<string>")).otherwise(F.array(lit("n")))
    one = F.struct(
        F.when(k % 8 == 7, "").otherwise("r").alias("record_id"), names.alias("names"), F.when(k % 12 == 4, "HVS 1").when(k % 4 == 0, "gaia dr3 12").otherwise("").alias("gaia_source_id"), F.when(k % 10 == 9, "maybe").otherwise("unbound").alias("galactic_bound_claim"),
        F.when(k % 11 == 0, "").otherwise("cited_from_literature").alias("origin_type"), F.when(k % 13 == 0, F.array().cast("array<string>")).otherwise(F.array(lit("e"))).alias("evidence"), F.when(k % 14 == 0, "1h").otherwise("").alias("ra_raw"), lit("").alias("dec_raw"),
        F.when(k % 15 == 0, 360.0).otherwise(1.0).alias("ra_deg"), lit(None).cast("double").alias("dec_deg"), F.when(k % 16 == 0, 1899.5).otherwise(2016.0).alias("epoch_year"),
    )
    fact = F.struct(F.when(k % 5 == 3, "R1").otherwise("R0").alias("name"), F.when(k % 2 == 0, "reported").otherwise("not_reported").alias("status"), F.when(k % 3 == 0, "").otherwise("8").alias("value"))
    x = t(spark, d, "customer").select(c("c_custkey").alias("k")).select("k", q.alias("q"), one.alias("c"), fact.alias("f"))
    found = [*checks.annotated_quantity_rules(c("q")), *checks.annotated_candidate_rules(c("c")), *checks.method_fact_rules(c("f"))]
    return rules.violations(x, c("k"), found).select("location", "rule")
