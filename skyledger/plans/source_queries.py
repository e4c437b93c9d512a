"""Queries of provider matching, paper inventories and feeds over rows made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import enrichment, inventory, outcomes
from ..streaming import windows
from .queries import c, lit, query, t

_SEP = "degrees(2 * asin(least(1, sqrt(pow(sin(radians({1}.dec - {0}.dec) / 2), 2) + cos(radians({0}.dec)) * cos(radians({1}.dec)) * pow(sin(radians({1}.ra - {0}.ra) / 2), 2))))) * 3600"


@query(f"""WITH o AS (SELECT c_custkey AS object_id, CASE WHEN c_custkey % 3 = 0 THEN 'star ' || c_custkey % 60 ELSE 'l' || c_custkey END AS n, CASE WHEN c_custkey % 4 = 1 THEN (c_custkey % 50)::VARCHAR END AS num, CASE WHEN c_custkey % 7 < 6 THEN (c_custkey % 90) * 4.0::DOUBLE END AS ra, (c_custkey % 40) * 2.0::DOUBLE - 40 AS dec FROM customer),
  a AS (SELECT s_suppkey AS oid, 'star ' || s_suppkey % 60 AS n, CASE WHEN s_suppkey % 5 = 0 THEN (s_suppkey % 50)::VARCHAR END AS num, (s_suppkey % 90) * 4.0::DOUBLE + 0.0003::DOUBLE AS ra, (s_suppkey % 40) * 2.0::DOUBLE - 40 AS dec FROM supplier), b AS (SELECT p_partkey AS source_id, (p_partkey % 90) * 4.0::DOUBLE + 0.0006::DOUBLE AS ra, (p_partkey % 40) * 2.0::DOUBLE - 40 AS dec FROM part WHERE p_partkey <= 45),
  cl AS (SELECT object_id, oid FROM o JOIN a ON o.n = a.n), sh AS (SELECT oid FROM cl GROUP BY 1 HAVING count(DISTINCT object_id) > 1), na AS (SELECT object_id, min(oid) AS oid FROM cl GROUP BY 1), ne AS (SELECT o.object_id, a.oid, {_SEP.format('o', 'a')} AS sep FROM o JOIN a ON abs(a.dec - o.dec) < 0.01 WHERE o.object_id NOT IN (SELECT object_id FROM na) AND {_SEP.format('o', 'a')} <= 5),
  fa AS (SELECT object_id, oid, 'identifier' AS how, 1 AS n FROM na UNION ALL SELECT object_id, arg_min(oid, (sep, oid)), 'coordinates', count(*) FROM ne GROUP BY 1), nu AS (SELECT object_id, num, 0 AS k FROM o WHERE num IS NOT NULL UNION ALL SELECT fa.object_id, a.num, 1 FROM fa JOIN a USING (oid) WHERE a.num IS NOT NULL),
  hi AS (SELECT object_id, arg_min(source_id, k) AS source_id FROM nu JOIN b ON source_id::VARCHAR = num GROUP BY 1), nb AS (SELECT o.object_id, b.source_id, {_SEP.format('o', 'b')} AS sep FROM o JOIN b ON abs(b.dec - o.dec) < 0.01 WHERE o.object_id NOT IN (SELECT object_id FROM hi) AND {_SEP.format('o', 'b')} <= 5),
  fb AS (SELECT object_id, source_id, 'source_id' AS by2, 1 AS n2 FROM hi UNION ALL SELECT object_id, arg_min(source_id, (sep, source_id)), 'coordinates', count(*) FROM nb GROUP BY 1)
  SELECT o.object_id, fa.oid, how AS matched_by, fb.source_id, by2 AS source_matched_by, concat_ws(',', CASE WHEN how = 'coordinates' THEN 'first_coordinate_match' END, CASE WHEN n > 1 THEN 'several_first_matches' END, CASE WHEN o.object_id IN (SELECT object_id FROM cl WHERE oid IN (SELECT oid FROM sh)) THEN 'duplicate_object_match' END,
    CASE WHEN by2 = 'coordinates' THEN 'second_coordinate_match' END, CASE WHEN n2 > 1 THEN 'several_second_matches' END) AS warnings, CASE WHEN how IS NOT NULL OR by2 IS NOT NULL THEN 'success' ELSE 'not_found' END AS status FROM (SELECT object_id FROM o) o LEFT JOIN fa ON o.object_id = fa.object_id LEFT JOIN fb ON o.object_id = fb.object_id""")
def provider_cascade(spark, d):
    k, s, p = c("c_custkey"), c("s_suppkey"), c("p_partkey")
    text = lambda x: x.cast("string")
    objects = t(spark, d, "customer").select(
        k.alias("object_id"), F.array(F.when(k % 3 == 0, F.concat(lit("Star "), text(k % 60))).otherwise(F.concat(lit("L"), text(k)))).alias("names"), F.when(k % 4 == 1, F.array(text(k % 50))).alias("numbers"), F.when(k % 7 < 6, (k % 90) * lit(4.0)).alias("ra"), ((k % 40) * lit(2.0) - 40).alias("dec")
    )
    gaia = F.when(s % 5 == 0, F.concat(lit("Gaia EDR3 "), text(s % 50)))
    first = t(spark, d, "supplier").select(s.alias("oid"), s.alias("place"), F.array_compact(F.array(F.concat(lit("STAR  "), text(s % 60)), gaia)).alias("aliases"), ((s % 90) * lit(4.0) + 0.0003).alias("ra"), ((s % 40) * lit(2.0) - 40).alias("dec"))
    second = t(spark, d, "part").where("p_partkey <= 45").select(p.alias("source_id"), p.alias("place"), ((p % 90) * lit(4.0) + 0.0006).alias("ra"), ((p % 40) * lit(2.0) - 40).alias("dec"))
    x = enrichment.cascade(objects, first, second)
    return x.select("object_id", "oid", "matched_by", "source_id", "source_matched_by", F.array_join("warnings", ",").alias("warnings"), "status")


_FILES = "SELECT o_orderkey AS k, o_custkey % 60 AS paper, CASE o_orderkey % 4 WHEN 0 THEN 'f' || o_orderkey || '.tex' WHEN 1 THEN 'd' || o_orderkey || '.FITS.GZ' WHEN 2 THEN 'd' || o_orderkey || '.csv' ELSE 'f' || o_orderkey || '.png' END AS path FROM orders"


def _inventories(spark, d):
    k = c("o_orderkey")
    path = F.when(k % 4 == 0, F.concat(lit("f"), k.cast("string"), lit(".tex"))).when(k % 4 == 1, F.concat(lit("d"), k.cast("string"), lit(".FITS.GZ"))).when(k % 4 == 2, F.concat(lit("d"), k.cast("string"), lit(".csv"))).otherwise(F.concat(lit("f"), k.cast("string"), lit(".png")))
    body = F.concat(lit("a\n% \\begin{table}no\\end{table}\nb \\begin{table*}\n\\caption[x]{Of {\\bf "), k.cast("string"), lit("}\n stars}\nrow\\\\\n\\end{table*}\n50\\% \\begin{deluxetable}\\tablecaption{Second}\\label{tab:x}\n\\end{deluxetable}"))
    return inventory.inventories(t(spark, d, "orders").select((c("o_custkey") % 60).alias("paper"), path.alias("path"), body.alias("text")), "paper")


@query(f"""WITH f AS ({_FILES}) SELECT paper, count(*) FILTER (k % 4 = 0) AS tex_file_count, (count(*) FILTER (k % 4 = 0) * 2)::INTEGER AS n_tables, coalesce(string_agg(path, ',' ORDER BY path) FILTER (k % 4 IN (1, 2)), '') AS files,
  coalesce(arg_min('3-7:table*:Of \\bf ' || k || ' stars:', path) FILTER (k % 4 = 0), '') AS first_table FROM f GROUP BY paper""".replace("\\\\bf", "\\bf"))
def paper_inventories(spark, d):
    first = F.get("tables", lit(0))
    shown = F.concat(F.concat_ws("-", first["start_line"].cast("string"), first["end_line"].cast("string")), lit(":"), first["environment"], lit(":"), F.regexp_replace(first["caption"], "[{}]", ""), lit(":"), first["label"])
    return _inventories(spark, d).select("paper", "tex_file_count", F.size("tables").alias("n_tables"), F.array_join(F.transform("files", lambda f: f["path"]), ",").alias("files"), F.coalesce(shown, lit("")).alias("first_table"))


@query(f"""WITH f AS ({_FILES}), n AS (SELECT paper, path, row_number() OVER (PARTITION BY paper ORDER BY path) AS r FROM f WHERE k % 4 = 0), i AS (SELECT paper, 'tab-x' || CASE WHEN r > 1 THEN '-' || r ELSE '' END AS id, r FROM n)
  SELECT paper, id, CASE WHEN r = 1 AND paper % 2 = 0 THEN 'selected' ELSE 'rejected' END AS decision, CASE WHEN r = 1 AND paper % 2 = 0 THEN NULL WHEN r = 2 AND paper % 3 = 0 THEN 'too small' ELSE 'not identified as an object catalogue' END AS reason FROM i""")
def reviewed_tables(spark, d):
    x = inventory.review_templates(_inventories(spark, d), "paper").where("id like 'tab-x%'")
    p = spark.range(60).select(c("id").alias("paper"))
    yes = p.where("paper % 2 = 0").select("paper", lit("tab-x").alias("id"), lit(True).alias("selected"), lit("").alias("reason"))
    no = p.where("paper % 3 = 0").select("paper", lit("tab-x-2").alias("id"), lit(False).alias("selected"), lit("too small").alias("reason"))
    return inventory.reviewed(x, yes.union(no).union(p.select("paper", lit("none").alias("id"), lit(True), lit(""))), "paper").select("paper", "id", "decision", "reason")


@query("""SELECT doc_id, '20' || doc_id AS arxiv_id, 'T ' || doc_id AS title, CASE WHEN doc_id % 2 = 0 THEN 'A|B C' ELSE 'A' END AS authors, CASE WHEN doc_id % 3 = 0 THEN 'p|x|y' ELSE 'x|y' END AS categories, '2020-01-02T00:00:00Z' AS publish_at FROM documents""")
def feed_entries(spark, d):
    k = c("doc_id")
    s = k.cast("string")
    xml = F.concat(
        lit('<entry xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://arxiv.org/schemas/atom"><id>http://arxiv.org/abs/20'), s, lit("v3</id><title> T\n  "), s, lit("</title><summary>s &lt; t</summary><author><name>A</name></author>"),
        F.when(k % 2 == 0, "<author><name> B  C</name></author><author><name> </name></author>").otherwise(""), lit('<published>2020-01-02T00:00:00Z</published><category term="x"/><category term="y"/><arxiv:primary_category term="'),
        F.when(k % 3 == 0, "p").otherwise("x"), lit('"/></entry>'),
    )
    x = t(spark, d, "documents").select("doc_id", inventory.feed_entry(xml).alias("e"))
    return x.select("doc_id", "e.arxiv_id", "e.title", F.array_join("e.authors", "|").alias("authors"), F.array_join("e.categories", "|").alias("categories"), "e.publish_at")


@query("""SELECT c_custkey AS object_id, CASE WHEN c_custkey % 3 = 0 THEN 1000 - c_custkey ELSE 4611686018427387904 END::BIGINT AS position FROM customer WHERE c_custkey % 5 <> 0""")
def catalogue_snapshot(spark, d):
    k = c("c_custkey")
    objects = t(spark, d, "customer").select(k.alias("object_id"), F.when(k % 5 == 0, "v0").when(k % 5 == 1, "v1").otherwise("v2").alias("schema_version"))
    index = t(spark, d, "customer").where("c_custkey % 3 = 0").select(k.alias("object_id"), (lit(1000) - k).alias("place"))
    return inventory.snapshot(objects, index, ("v1", "v2")).select("object_id", c("position").cast("bigint").alias("position"))


@query("""WITH p AS (SELECT c_nationkey::VARCHAR AS arxiv_id, lpad(c_custkey::VARCHAR, 9, '0') AS month, c_name FROM customer WHERE c_custkey % 3 = 1) SELECT arxiv_id, max(month) AS month, arg_max(c_name, month) AS name FROM p GROUP BY 1""")
def papers_with_catalogues(spark, d):
    k = c("c_custkey")
    x = t(spark, d, "customer").select(c("c_nationkey").cast("string").alias("arxiv_id"), F.lpad(k.cast("string"), 9, "0").alias("month"), F.when(k % 3 == 1, lit(True)).when(k % 3 == 2, lit(False)).alias("flag"), c("c_name").alias("name"))
    return inventory.with_catalogues(x).select("arxiv_id", "month", "name")


@query("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, event_type, count(*) AS n FROM events GROUP BY ALL")
def event_windows(spark, d):
    x = windows.windowed_counts(t(spark, d, "events"), "ts", "event_type")
    return x.select(F.date_format("window.start", "yyyy-MM-dd HH").alias("hour"), "event_type", "n")


# --- outcomes of the dynamics -----------------------------------------------------------------------------------------


def _outcomes(spark, d):
    k = c("c_custkey")
    s = k.cast("string")
    canonical = F.when(k % 4 == 0, F.concat(lit("Gaia EDR3 "), s)).otherwise("HVS 1")
    values = F.when(k % 3 == 0, F.array(F.concat(lit("gaia dr3 "), s), lit("Gaia DR2 1"))).when(k % 3 == 1, F.array(lit("x"), lit("Gaia DR3 7")))
    one = lit(1.0)
    cached = F.struct(
        F.when(k % 5 == 0, "missing").otherwise("matched").alias("status"), F.when(k % 10 == 1, "").when(k % 10 == 2, "99").otherwise(F.when((k % 3 == 1) & (k % 4 > 0), "7").otherwise(s)).alias("number"),
        one.alias("ra"), one.alias("dec"), one.alias("parallax"), F.when(k % 6 == 5, 0.25).otherwise(0.1).alias("parallax_error"), one.alias("pmra"), one.alias("pmdec"), one.alias("pmra_error"), F.when(k % 7 == 6, 0.0).otherwise(1.0).alias("pmdec_error"),
        one.alias("phot_g_mean_mag"), one.alias("ecl_lat"), lit(31.0).alias("astrometric_params_solved"), F.when(k % 8 != 7, 1.5).alias("nu_eff_used_in_astrometry"), lit(None).cast("double").alias("pseudocolour"), lit(-0.25).alias("zero_point"),
    )
    quantity = lambda v, e: F.struct(lit(v).alias("value"), lit(e).alias("error"))
    choices = F.when(k % 9 < 3, F.array(quantity("500 km/s", ""), quantity("480", "±5"), quantity("470", "2"))).when(k % 9 < 6, F.array(quantity("none", "1"), quantity("300", "")))
    return t(spark, d, "customer").select(k.alias("object_id"), canonical.alias("canonical"), values.alias("values"), cached.alias("cached"), choices.alias("choices"))


_OUT = """o AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 0 OR c_custkey % 3 = 0 THEN c_custkey::VARCHAR WHEN c_custkey % 3 = 1 THEN '7' END AS own, c_custkey % 5 > 0 AS matched, CASE WHEN c_custkey % 10 = 1 THEN '' WHEN c_custkey % 10 = 2 THEN '99' WHEN c_custkey % 3 = 1 AND c_custkey % 4 > 0 THEN '7' ELSE c_custkey::VARCHAR END AS row FROM customer),
  p AS (SELECT *, coalesce(own, CASE WHEN matched AND row <> '' THEN row END) AS number FROM o), q AS (SELECT *, matched AND (row = '' OR row = number) AS fits FROM p), r AS (SELECT *, CASE WHEN number IS NULL OR NOT fits THEN 'gaia astrometry not available' WHEN k % 7 = 6 THEN 'gaia astrometry not available' WHEN k % 8 = 7 THEN 'zero point correction not available' WHEN k % 6 = 5 THEN 'parallax uncertainty too large' ELSE '' END AS reason FROM q)"""


@query(f"""WITH {_OUT} SELECT k AS object_id, CASE WHEN reason = '' THEN 'ready' ELSE 'skipped' END AS status, reason, number, CASE WHEN reason = '' THEN CASE WHEN k % 9 < 3 THEN 470 WHEN k % 9 < 6 THEN 300 END END::DOUBLE AS rv, concat_ws(',', CASE WHEN k % 4 = 0 AND k % 3 = 1 AND k <> 7 THEN 'multiple_gaia_dr3_source_ids' END, CASE WHEN own IS NULL AND number IS NOT NULL THEN 'gaia_source_id_from_external_cache' END,
    CASE WHEN number IS NOT NULL AND NOT fits THEN 'gaia_external_cache_missing' END, CASE WHEN number IS NOT NULL AND fits AND k % 7 = 6 THEN 'gaia_astrometry_invalid' END, CASE WHEN number IS NOT NULL AND fits AND k % 7 < 6 AND k % 8 = 7 THEN 'zero_point_correction_failed' END,
    CASE WHEN reason = '' AND k % 9 BETWEEN 3 AND 5 THEN 'radial_velocity_uncertainty_missing' WHEN reason = '' AND k % 9 > 5 THEN 'minimum_grf_velocity_assumption' END, CASE WHEN reason = '' AND k % 9 BETWEEN 3 AND 5 THEN 'radial_velocity_held_fixed' END) AS warnings FROM r""")
def dynamics_decisions(spark, d):
    x = outcomes.decided(_outcomes(spark, d))
    return x.select("object_id", "status", "reason", "number", c("radial_velocity.value").alias("rv"), F.array_join("warnings", ",").alias("warnings"))


@query(f"WITH {_OUT} SELECT CASE WHEN reason = '' THEN 'ready' ELSE 'skipped' END AS status, reason, count(*) AS n FROM r GROUP BY ALL")
def dynamics_reasons(spark, d):
    return outcomes.reasons(outcomes.decided(_outcomes(spark, d)))


@query("""SELECT l_partkey AS object_id, count(*) AS n, count(*) FILTER (l_quantity * 1000 < l_extendedprice) AS unbound, round(count(*) FILTER (l_quantity * 1000 < l_extendedprice) / count(*), 12) AS unbound_fraction, round((count(*) FILTER (l_quantity * 1000 < l_extendedprice) + 0.5::DOUBLE) / (count(*) + 1), 12) AS p_unbound, count(*) FILTER (l_quantity * 1000 < l_extendedprice) = 0 AS graveyard,
  round(quantile_cont(l_extendedprice::DOUBLE, 0.5), 6) AS speed_median, round(quantile_cont(l_extendedprice::DOUBLE, 0.16), 6) AS speed_p16, round(quantile_cont((l_quantity * 1000)::DOUBLE, 0.84), 6) AS escape_p84 FROM lineitem GROUP BY 1""")
def posterior_summary(spark, d):
    x = t(spark, d, "lineitem").select(c("l_partkey").alias("object_id"), c("l_extendedprice").cast("double").alias("speed"), (c("l_quantity") * 1000).cast("double").alias("escape"))
    s = outcomes.summary(x, "object_id", "speed", "escape")
    return s.select("object_id", "n", "unbound", "unbound_fraction", "p_unbound", "graveyard", F.round("speed_median", 6).alias("speed_median"), F.round("speed_p16", 6).alias("speed_p16"), F.round("escape_p84", 6).alias("escape_p84"))
