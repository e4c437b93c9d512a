"""Queries of the search and referee operators, over hits and record pairs made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import papers, referee, search
from . import paper_queries
from .queries import c, lit, query, t

# --- hits -------------------------------------------------------------------------------------------------------------


def hits(spark, d):
    """doc_id and hit: a JSON text of changing shape for each document."""
    k, text = c("doc_id"), lambda f: F.concat(lit(f), c("doc_id").cast("string"))
    listed = F.to_json(F.array(text("A "), lit(""), lit("B")))
    title = F.expr("element_at(array('A hyper-velocity star', 'The fastest stars in the galaxy', 'OB runaway stars', 'An unbound candidate star', 'walkaway stars', 'Survey of high velocity halo stars', 'nothing here', '<b>HVS</b> &amp; more'), CAST(doc_id % 8 + 1 AS INT))")
    parts = [
        F.concat(F.when(k % 2 == 0, '"arxiv_id":').otherwise('"id":'), lit('"'), text(" p"), lit('"')),
        F.when(k % 9 != 8, F.concat(lit('"title":'), F.to_json(F.array(title)))),
        F.when(k % 3 == 0, F.concat(lit('"authors":'), listed)).when(k % 3 == 1, lit('"authors":"Solo, A"')),
        F.when(k % 4 == 0, lit('"categories":["astro-ph.GA, astro-ph.SR","x"]')).when(k % 4 == 1, lit('"categories":"hep-th"')),
        F.concat(F.when(k % 5 == 0, '"publish_at":"').when(k % 5 == 1, '"published_at":"').when(k % 5 == 2, '"published":"').otherwise('"other_date":"'), F.when(k % 7 == 0, "2019-02-30").when(k % 7 == 1, "2020-03-05T01:02:03Z").otherwise("2018-11-09 10:00:00"), lit('"')),
        F.when(k % 6 == 0, lit('"score":"0.5"')).when(k % 6 == 1, lit('"score":0.25')).when(k % 6 == 2, lit('"score":"high"')),
        F.when(k % 10 == 0, lit('"_best_score":0.9')),
        F.concat(F.when(k % 2 == 0, '"abstract":').otherwise('"summary":'), F.when(k % 4 == 3, lit('" "')).otherwise(F.to_json(F.array(F.concat(lit("We study stars with space velocities "), k.cast("string")))))),
        F.when(k % 8 == 5, lit('"venue":"X","_internal":1')),
        F.when(k % 12 == 0, lit('"_search_source":"other"')),
    ]
    one = F.concat(lit("{"), F.concat_ws(",", *parts), lit("}"))
    return t(spark, d, "documents").select("doc_id", title.alias("wanted"), F.regexp_replace(F.regexp_replace(one, r'"(title|abstract|summary)":\["', '"$1":"'), r'"\](?=[,}])(?<!B"\])(?<!x"\])', '"').alias("hit"))


_TITLE = "['A hyper-velocity star', 'The fastest stars in the galaxy', 'OB runaway stars', 'An unbound candidate star', 'walkaway stars', 'Survey of high velocity halo stars', 'nothing here', '<b>HVS</b> &amp; more'][doc_id % 8 + 1]"


@query(f"""SELECT doc_id, 'p' || doc_id AS arxiv_id, CASE WHEN doc_id % 9 = 8 THEN 'Untitled' ELSE {_TITLE} END AS title, CASE doc_id % 3 WHEN 0 THEN 'A ' || doc_id || ', B' WHEN 1 THEN 'Solo, A' ELSE '' END AS author_names,
  CASE doc_id % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 0 END AS n_authors, CASE doc_id % 4 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS n_categories, CASE WHEN doc_id % 5 > 2 THEN '' WHEN doc_id % 7 = 0 THEN '2019-02-30' WHEN doc_id % 7 = 1 THEN '2020-03-05T01:02:03Z' ELSE '2018-11-09 10:00:00' END AS published_at,
  CASE WHEN doc_id % 10 = 0 THEN 0.9 WHEN doc_id % 6 = 0 THEN 0.5 WHEN doc_id % 6 = 1 THEN 0.25 END::DOUBLE AS best_score, CASE WHEN doc_id % 4 = 3 THEN '' ELSE 'We study stars with space velocities ' || doc_id END AS abstract,
  CASE WHEN doc_id % 4 = 3 THEN NULL WHEN doc_id % 12 = 0 THEN 'other' ELSE 'main' END AS abstract_source, CASE WHEN doc_id % 12 = 0 THEN 'main' END AS configured,
  concat_ws(',', CASE WHEN doc_id % 5 > 2 THEN 'other_date' END, CASE WHEN doc_id % 8 = 5 THEN 'venue' END) AS other_fields, 'https://arxiv.org/pdf/p' || doc_id AS pdf FROM documents""")
def canonical_paper_record(spark, d):
    x = hits(spark, d).select("doc_id", search.paper_record(c("hit"), "main", "run").alias("p"))
    return x.select(
        "doc_id", "p.arxiv_id", "p.title", "p.author_names", F.size("p.authors").alias("n_authors"), F.size("p.categories").alias("n_categories"), "p.published_at", c("p.match.best_score").alias("best_score"), c("p.abstract.text").alias("abstract"),
        c("p.abstract.source").alias("abstract_source"), c("p.provenance.configured_search_source").alias("configured"), F.array_join(F.array_sort(F.map_keys("p.source_fields")), ",").alias("other_fields"), c("p.links.pdf").alias("pdf"),
    )


@query(f"""SELECT doc_id, CASE WHEN doc_id % 9 = 8 OR doc_id % 8 = 6 THEN false ELSE true END AS include, CASE WHEN doc_id % 9 = 8 OR doc_id % 8 = 6 THEN 0.4 ELSE 0.95 END::DOUBLE AS confidence,
  CASE WHEN doc_id % 9 = 8 THEN '' ELSE ['hypervelocity stars', 'high-velocity or extreme-velocity stars', 'runaway stars', 'unbound, escaping, or ejected stars', 'stellar escapers', 'high-velocity or extreme-velocity stars, high-velocity star surveys or candidates', '', 'hypervelocity stars'][doc_id % 8 + 1] END AS labels,
  concat_ws('|', CASE WHEN doc_id % 9 <> 8 AND doc_id % 8 IN (0, 7) THEN 'hypervelocity star' END, CASE WHEN doc_id % 4 <> 3 THEN 'high-velocity star' END, CASE WHEN doc_id % 9 <> 8 AND doc_id % 8 = 2 THEN 'runaway star' END) AS relevance FROM documents""")
def title_triage_rules(spark, d):
    h = hits(spark, d)
    x = h.select("doc_id", search.title_decision(search.as_text(c("hit"), "title")).alias("t"), F.array_join(search.labels(search.paper_text(F.regexp_replace("hit", '"summary"', '"abstract"')), search.RELEVANCE), "|").alias("relevance"))
    label = F.when(c("t.include"), F.replace(c("t.reason"), lit("Rule-related title match: "), lit(""))).otherwise("")
    return x.select("doc_id", "t.include", c("t.confidence").cast("double").alias("confidence"), label.alias("labels"), "relevance")


_DATE = "CASE WHEN doc_id % 5 > 2 OR doc_id % 7 = 0 THEN NULL WHEN doc_id % 7 = 1 THEN DATE '2020-03-05' ELSE DATE '2018-11-09' END"


@query(f"""SELECT doc_id, {_DATE} AS published, coalesce({_DATE} BETWEEN DATE '2018-11-01' AND DATE '2018-11-30', false) AS in_window, doc_id % 4 <> 1 AS category, CASE WHEN doc_id % 6 = 0 THEN true ELSE false END AS scored FROM documents""")
def hit_filters(spark, d):
    h = c("hit")
    day = search.publication_date(h)
    return hits(spark, d).select("doc_id", day.alias("published"), F.coalesce(day.between(lit("2018-11-01").cast("date"), lit("2018-11-30").cast("date")), lit(False)).alias("in_window"), search.category_matches(search.as_list(h, "categories"), ["astro-ph.SR"]).alias("category"), search.score_matches(search.raw(h, "score"), 0.5).alias("scored"))


@query("""WITH r AS (SELECT c_custkey, c_custkey % 3 AS n FROM customer) SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 77 ELSE n END::BIGINT AS total, i::INTEGER AS place, 'h' || i AS arxiv_id, CASE WHEN c_custkey % 2 = 0 THEN 'A, C' ELSE '' END AS author_names, '2020' AS publish_at, '5' AS citations
  FROM r, (VALUES (0), (1)) v(i) WHERE i < n UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 77 ELSE 0 END, NULL, '', '', '', '' FROM r WHERE n = 0""")
def search_envelopes(spark, d):
    k = c("c_custkey")
    people = F.when(k % 2 == 0, lit('[{"name":"A"},{"x":"B"},{"name":"C"}]')).otherwise("[]")
    one = lambda i: F.concat(lit(f'{{"id":"h{i}","date":"2020","citation_count":5,"authors":'), people, lit("}"))
    body = F.concat(F.when(k % 2 == 0, '{"results":[').otherwise('{"result":['), F.array_join(F.slice(F.array(one(0), one(1)), lit(1), (k % 3).cast("int")), ","), lit("]"), F.when(k % 8 == 0, ',"total":77').when(k % 8 == 4, ',"total_count":"77"').otherwise(""), lit("}"))
    x = search.unwrapped(t(spark, d, "customer").select("c_custkey", body.alias("body")), "body").withColumn("r", search.result_item(F.coalesce("hit", lit("{}"))))
    return x.select("c_custkey", "total", "place", "r.arxiv_id", "r.author_names", "r.publish_at", "r.citations")


@query("""WITH x AS (SELECT doc_id, doc_id % 3 AS a, doc_id % 5 AS b, doc_id % 7 AS m FROM documents) SELECT doc_id, CASE WHEN a = 0 THEN '2001-01-01' WHEN m <> 6 AND b > 0 THEN '2002-02-02' ELSE '' END AS published_at,
  CASE WHEN b = 0 THEN 'own' WHEN a <> 0 AND m <> 6 THEN 'm' || doc_id ELSE '' END AS title, CASE WHEN a = 0 THEN 'not_needed' WHEN m = 6 THEN 'no_metadata' WHEN b > 0 THEN 'publication_backfilled' ELSE 'no_publication_date' END AS status,
  CASE WHEN a = 0 OR m = 6 THEN '' ELSE concat_ws(',', CASE WHEN b > 0 THEN 'published_at' END, CASE WHEN b > 0 THEN 'title' END) END AS applied FROM x""")
def metadata_backfill(spark, d):
    x = t(spark, d, "documents").select("doc_id", c("doc_id").cast("string").alias("arxiv_id"), F.when(c("doc_id") % 3 == 0, "2001-01-01").otherwise("").alias("published_at"), F.when(c("doc_id") % 5 == 0, "own").otherwise("").alias("title"))
    meta = t(spark, d, "documents").where("doc_id % 7 <> 6").select(c("doc_id").cast("string").alias("arxiv_id"), F.when(c("doc_id") % 5 > 0, "2002-02-02").alias("published_at"), F.concat(lit("m"), c("doc_id").cast("string")).alias("title"))
    got = search.backfilled(x, meta, ("published_at", "title"))
    return got.select("doc_id", "published_at", "title", "status", F.array_join("applied", ",").alias("applied"))


@query("""WITH p AS (SELECT o_orderkey AS k, (1992 + o_orderkey % 7)::VARCHAR AS y, lpad((1 + o_orderkey % 12)::VARCHAR, 2, '0') AS m, o_orderkey % 3 AS s FROM orders), f AS (SELECT y || '-' || m AS month, CASE s WHEN 0 THEN y || '/' || y || '-' || m || '/' || k || '.json' WHEN 1 THEN y || '-' || m || '/' || k || '.json' ELSE 'x/' || y || m || '.json' END AS path, s FROM p WHERE s < 2)
  SELECT month, arg_min(path, (s, path)) AS path FROM f GROUP BY month""")
def month_files(spark, d):
    y, m = "CAST(1992 + o_orderkey % 7 AS STRING)", "lpad(CAST(1 + o_orderkey % 12 AS STRING), 2, '0')"
    path = F.expr(f"CASE o_orderkey % 3 WHEN 0 THEN concat({y}, '/', {y}, '-', {m}, '/', o_orderkey, '.json') WHEN 1 THEN concat({y}, '-', {m}, '/', o_orderkey, '.json') ELSE concat('x/', {y}, {m}, '.json') END")
    return search.newest_layout(t(spark, d, "orders").select(path.alias("path")))


@query("""SELECT strftime(m, '%Y-%m') AS month, greatest(m, DATE '1993-05-17')::DATE AS date_from, least(last_day(m), DATE '1998-02-03')::DATE AS date_to,
  CASE WHEN strftime(m, '%Y-%m') <= '1994-12' THEN 'old' WHEN strftime(m, '%Y-%m') = '1995-01' THEN 'old|new' ELSE 'new' END AS categories, CASE WHEN strftime(m, '%Y-%m') > '1996-06' THEN 'a|b' ELSE 'a|b|c' END AS queries
  FROM (SELECT unnest(generate_series(TIMESTAMP '1993-05-01', TIMESTAMP '1998-02-03', INTERVAL 1 MONTH))::DATE AS m)""")
def month_windows_and_eras(spark, d):
    m = c("month")
    return search.months_between(spark, "1993-05-17", "1998-02-03").select("month", "date_from", "date_to", F.array_join(search.era_categories(m, ["new"], "old", "1994-12", "1995-01"), "|").alias("categories"), F.array_join(search.era_queries(m, ["a", "b"], ["b", "c"], "1996-06"), "|").alias("queries"))


@query("""WITH p AS (SELECT c_nationkey::VARCHAR AS arxiv_id, lpad((c_custkey % 12)::VARCHAR, 2, '0') AS month, c_custkey AS place FROM customer WHERE c_custkey % 4 = 1 AND lpad((c_custkey % 12)::VARCHAR, 2, '0') BETWEEN '02' AND '09')
  SELECT arxiv_id, min(month) AS month, arg_min(place, (month, place)) AS place FROM p GROUP BY 1""")
def selected_papers(spark, d):
    flag = F.when(c("c_custkey") % 4 == 1, lit(True)).when(c("c_custkey") % 4 == 2, lit(False))
    x = t(spark, d, "customer").select(c("c_nationkey").cast("string").alias("arxiv_id"), F.lpad((c("c_custkey") % 12).cast("string"), 2, "0").alias("month"), c("c_custkey").alias("place"), flag.alias("flag"))
    return search.selected_ids(x, "02", "09")


@query("""WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY CASE WHEN doc_id % 6 = 0 THEN 0.5 WHEN doc_id % 6 = 1 THEN 0.25 ELSE 0 END DESC, CASE WHEN doc_id % 5 > 0 THEN '2018-11-0' || doc_id % 5 ELSE '0001-01-01' END DESC, doc_id) AS r FROM documents) SELECT doc_id, CASE WHEN r <= 30 THEN 'selected' ELSE 'skipped' END AS review FROM o""")
def review_leaders(spark, d):
    k = c("doc_id")
    x = t(spark, d, "documents").select("doc_id", F.when(k % 6 == 0, "0.5").when(k % 6 == 1, "0.25").when(k % 6 == 2, "high").alias("score"), F.when(k % 5 > 0, F.concat(lit("2018-11-0"), (k % 5).cast("string"))).alias("day"))
    return search.review_leaders(x, "score", "day", "doc_id", 30).select("doc_id", "review")


@query("""WITH d AS (SELECT doc_id % 50 AS k, bool_or(doc_id % 3 = 0) AS i FROM documents WHERE doc_id % 5 <> 0 GROUP BY 1), j AS (SELECT CASE WHEN i IS NULL THEN 'missing' WHEN i THEN 'confirmed' ELSE 'not_confirmed' END AS decision FROM documents LEFT JOIN d ON doc_id = k) SELECT decision, count(*) AS n FROM j GROUP BY 1""")
def reviewed_decisions(spark, d):
    x = t(spark, d, "documents").select("doc_id")
    return search.decided(x, x.where("doc_id % 5 <> 0").selectExpr("doc_id % 50 AS doc_id", "doc_id % 3 = 0 AS include"), "doc_id")[1]


# --- referee ----------------------------------------------------------------------------------------------------------

_SIDE = """SELECT {k} AS k, {k} % 4 AS scope, {k} AS i, CASE WHEN {k} % 5 = 0 THEN 'DR3' WHEN {k} % 5 = 1 THEN 'EDR3' ELSE '' END AS release, CASE WHEN {k} % 5 < 2 THEN CAST(CAST(floor({k} / 8) AS BIGINT) AS {s}) ELSE '' END AS number,
  CASE WHEN {k} % 3 = 0 THEN concat('HVS', CAST(floor({k} / 12) AS BIGINT)) ELSE concat('{t}', {k}) END AS name, CASE WHEN {k} % 7 = 6 THEN NULL ELSE CAST(floor({k} / 4) AS BIGINT) % 90 * 4.0{d} + {o} END AS ra, CAST(floor({k} / 4) AS BIGINT) % 40 * 2.0{d} - 40.0{d} AS dec FROM {table}"""


def _side(spark, d, table, key, tag, offset):
    x = t(spark, d, table)
    x.createOrReplaceTempView("_side_rows")
    y = spark.sql(_SIDE.format(k=key, t=tag, s="STRING", d="D", o=f"{offset}D", table="_side_rows"))
    none = F.lit(None).cast("double")
    ident = F.struct(c("k").cast("string").alias("record_id"), c("release"), c("number"), F.array("name").alias("names"), c("ra"), c("dec"), none.alias("pm_ra"), none.alias("pm_dec"), none.alias("year"))
    return y.select("scope", "i", ident.alias("identity"))


_PAIR = f"""l AS ({_SIDE.format(k='c_custkey', t='L', s='VARCHAR', d='::DOUBLE', o='0.0::DOUBLE', table='customer')}), r AS ({_SIDE.format(k='s_suppkey', t='R', s='VARCHAR', d='::DOUBLE', o='0.001::DOUBLE', table='supplier')}),
  p AS (SELECT l.scope, l.i, r.i AS j, CASE WHEN l.number <> '' AND r.number <> '' AND l.release = r.release THEN CASE WHEN l.number = r.number THEN 'gaia_id' ELSE 'gaia_conflict' END WHEN l.name = r.name THEN 'alias' WHEN l.ra IS NULL OR r.ra IS NULL THEN 'no_evidence'
    WHEN degrees(2 * asin(least(1, sqrt(pow(sin(radians(r.dec - l.dec) / 2), 2) + cos(radians(l.dec)) * cos(radians(r.dec)) * pow(sin(radians(r.ra - l.ra) / 2), 2))))) * 3600 <= 5 THEN 'coordinates' ELSE 'coordinates_too_far' END AS method FROM l JOIN r ON l.scope = r.scope)"""


@query(f"WITH {_PAIR} SELECT scope, i, j, method FROM p WHERE method IN ('gaia_id', 'alias', 'coordinates')")
def identity_pairs(spark, d):
    got = referee.possible(_side(spark, d, "customer", "c_custkey", "L", "0.0"), _side(spark, d, "supplier", "s_suppkey", "R", "0.001"), "scope", referee.PROPAGATED, referee.FALLBACK)
    return got.select(c("s").alias("scope"), "i", "j", "method")


@query()
def identity_sets(spark, d):
    got = referee.matched_sets(_side(spark, d, "customer", "c_custkey", "L", "0.0"), _side(spark, d, "supplier", "s_suppkey", "R", "0.001"), "scope")
    return got.select("scope", "i", "j", "method", "detail", F.round("sep", 6).alias("sep"))


_READ = paper_queries._READ
_DUCK = paper_queries._DUCK
_A = f"""base2 AS (SELECT *, CASE WHEN k % 17 = 0 THEN 'bad-id' ELSE concat(arxiv, ':cand-', lpad(CAST(idx + 1 AS VARCHAR), 3, '0')) END AS record FROM base WHERE {_READ}), doc AS (SELECT DISTINCT arxiv AS path, p FROM base2)"""


@query(f"""WITH {_DUCK}, {_A} SELECT path, 'document' AS "group", 'extraction.status' AS label, CASE p % 4 WHEN 0 THEN 'candidates_found' WHEN 1 THEN 'no_candidates' WHEN 2 THEN 'needs_review' ELSE 'odd' END AS display, '' AS anchors FROM doc
  UNION ALL SELECT path, 'method', 'step types present', array_to_string(list_sort(list_distinct(['distance_estimation', 'solar_position_and_motion', CASE WHEN p % 4 = 0 THEN 'guess' ELSE 'velocity_calculation' END])), ', '), '' FROM doc
  UNION ALL SELECT path, 'method', 'distance_estimation: R0', '8.2', '8.2' FROM doc UNION ALL SELECT path, 'method', CASE WHEN p % 4 = 0 THEN 'guess' ELSE 'velocity_calculation' END || ': ' || CASE WHEN p % 2 = 0 THEN 'R1' ELSE 'z0' END, '$1$', '$1$' FROM doc
  UNION ALL SELECT arxiv, 'candidate:' || record, 'bound_assessment.bound_probability', CASE k % 3 WHEN 0 THEN '0.5 %' WHEN 1 THEN '1.5' ELSE '50%' END, CASE k % 3 WHEN 0 THEN '0.5' WHEN 1 THEN '1.5' ELSE '50%' END FROM base2 WHERE k % 2 = 1
  UNION ALL SELECT arxiv, 'candidate:' || record, 'inclusion_assessment', CASE k % 6 WHEN 0 THEN '' WHEN 1 THEN 'hvs_candidate, hvs_candidate' WHEN 2 THEN 'odd' ELSE 'hvs_candidate, escaping_star' END || ' — bound claim: ' || {paper_queries._CLAIM} || ' — ' || {paper_queries._SUMMARY},
    concat_ws('|', {paper_queries._OWN}, CASE WHEN {paper_queries._GAIA} <> '' AND k % 5 <> 0 THEN {paper_queries._GAIA} END, 'star', lower({paper_queries._OWN}), CASE WHEN {paper_queries._GAIA} <> '' THEN {paper_queries._GAIA} END, CASE WHEN {paper_queries._GAIA} <> '' AND k >= 100 THEN k::VARCHAR END) FROM base2""")
def document_assertions(spark, d):
    x = referee.assertions(papers.scan(paper_queries.documents(spark, d)))
    some = c("label").isin("extraction.status", "step types present", "inclusion_assessment", "bound_assessment.bound_probability") | (c("group") == "method")
    return x.where(some).select("path", "group", "label", "display", F.array_join("anchors", "|").alias("anchors"))


@query("""WITH a AS (SELECT item_id, string_split(trim(text), ' ')[1:2] AS w FROM benchmark), t AS (SELECT item_id, array_to_string(w, ' ') AS term FROM a), h AS (SELECT item_id, term, doc_id AS page, contains(text, 'the') AS named FROM t JOIN documents ON contains(text, term) AND doc_id % 5 = item_id % 5)
  SELECT item_id::VARCHAR AS path, arg_min(page, (NOT named, page)) AS page, min(term) AS term FROM h GROUP BY item_id""")
def anchor_pages(spark, d):
    a = t(spark, d, "benchmark").select((c("item_id") % 5).alias("path"), c("item_id").cast("string").alias("group"), lit("x").alias("label"), F.array(lit("the")).alias("context"), F.array(F.array_join(F.slice(F.split(F.trim("text"), " "), 1, 2), " ")).alias("anchors"))
    pages = t(spark, d, "documents").select((c("doc_id") % 5).alias("path"), c("doc_id").alias("page"), "text")
    return referee.located(a, pages).select(c("group").alias("path"), "page", "term")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN CASE WHEN c_custkey % 2 = 0 THEN 2000 + c_custkey % 20 ELSE 2016.5 END END::DOUBLE AS year, CASE WHEN c_custkey % 4 < 2 THEN c_custkey / 10.0::DOUBLE END AS pm,
  regexp_replace(CASE c_custkey % 5 WHEN 0 THEN '1..2 ± 0.5 km/s [range]' WHEN 1 THEN '7 +2 / -1 [lower_limit]' WHEN 2 THEN '7 km/s' ELSE '7 ± 0.5' END, '^$', '') AS display FROM customer""")
def referee_fields(spark, d):
    k = c("c_custkey")
    e = F.struct(F.when(k % 3 == 0, "reference_epoch").otherwise("equinox").alias("epoch_kind"), F.when(k % 2 == 0, F.concat(lit("J"), (lit(2000) + k % 20).cast("string"))).otherwise("2016.5").alias("value"))
    pm = F.struct((k / 10.0).cast("string").alias("value"), F.when(k % 4 < 2, "mas/yr").otherwise("arcsec/yr").alias("unit"))
    m = k % 5
    q = F.struct(
        F.when(m == 0, "").otherwise("7").alias("value"), F.when((m == 0) | (m > 2), "0.5").otherwise("").alias("error"), F.when(m == 1, "1").otherwise("").alias("lower_error"), F.when(m == 1, "2").otherwise("").alias("upper_error"),
        F.when((m == 0) | (m == 2), "km/s").otherwise("").alias("unit"), F.when(m == 0, "range").when(m == 1, "lower_limit").otherwise("").alias("limit_kind"), lit("1").alias("range_lower"), lit("2").alias("range_upper"),
    )
    return t(spark, d, "customer").select("c_custkey", referee.epoch_year(e).alias("year"), referee.proper_motion(pm).alias("pm"), referee.quantity_display(q).alias("display"))


@query("SELECT page_id, 'T & P' || page_id AS title, CASE WHEN page_id % 3 = 0 THEN 'page ' || page_id ELSE '' END AS doi, 7::INTEGER AS version, CASE WHEN page_id % 2 = 0 THEN 4 END::INTEGER AS margin FROM pages")
def page_metadata(spark, d):
    k = c("page_id").cast("string")
    html = F.concat(lit('<meta content="T &amp; P'), k, lit('" name="citation_title"><a href="/abs/2001.00001v2">v2</a> 2001.00001v7 2001.00009v9 '), c("html"), F.when(c("page_id") % 3 == 0, F.concat(lit("<META name='citation_doi' content='page "), k, lit("'>"))).otherwise(""))
    tags = search.meta_tags(html)
    margin = F.concat(lit("x\narXiv:2001.00001v"), F.when(c("page_id") % 2 == 0, "4").otherwise("x"), lit("  [astro-ph.GA]"))
    return t(spark, d, "pages").select("page_id", tags["citation_title"].alias("title"), F.coalesce(tags["citation_doi"], lit("")).alias("doi"), search.latest_version(html, lit("2001.00001")).alias("version"), search.watermark_version(margin, lit("2001.00001")).alias("margin"))
