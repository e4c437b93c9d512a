"""Scenarios of text, sky, linkage, rules, tables and sampling, and every SQL oracle on the smallest tables."""

import glob
import math
import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from skyledger.functions import numbers as nm
from skyledger.functions import sky
from skyledger.functions import text as tx
from skyledger.operators import dynamics, lineage, linkage, packing, rollups, rules, tables, view
from skyledger.plans import queries as catalog
from skyledger.plans import shape_queries

SF = "/root/testdata/sf0.001"
SCHEMA = "record_id string, gaia_id string, provider_id string, object_key string, name string, ra double, dec double, month string"


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_text(spark):
    assert one(spark, tx.match_key(F.lit(" gaia  EDR3 12"))) == "gaia DR3 12"
    assert one(spark, tx.match_key(F.lit("Odd Name"))) == "odd name"
    assert one(spark, tx.slug(F.lit("__a b//c_"))) == "a_b_c" and one(spark, tx.slug(F.lit(None).cast("string"))) == "candidate"
    assert [one(spark, tx.weak_identifier(F.lit(v))) for v in ("", "S5", "star", "123456", "HVS 123", "Gaia DR3 5")] == [True, True, True, True, False, True]
    assert one(spark, tx.cited_keys(F.lit(r"\citep[see]{b, a} \cite{a}"))) == ["a", "b"]
    assert one(spark, tx.numbered_lines(F.lit("a\nb\n"))) == "1|a\n2|b"
    assert one(spark, tx.ordered_distinct(F.array(F.lit("B "), F.lit("a"), F.lit("b")))) == ["B", "a"]


def test_numbers(spark):
    assert one(spark, nm.first_number(F.lit("12±3"))) == 12 and one(spark, nm.first_number(F.lit("none"))) is None
    assert one(spark, nm.strict_number(F.lit("1,2"))) is None
    assert one(spark, nm.column_type(F.array(F.lit("1"), F.lit("2.5 ± 1"), F.lit("x")))) == "mixed"


def test_sky(spark):
    assert one(spark, sky.parse_angle(F.lit("-1:30:00"), F.lit(""), F.lit(""), True, "catalogue")) == -22.5
    assert one(spark, sky.parse_angle(F.lit("10:00:00"), F.lit(""), F.lit(""), True, "referee")) == 10
    assert one(spark, F.round(sky.separation(F.lit(0.0), F.lit(89.9), F.lit(180.0), F.lit(89.9)), 6)) == 720.0
    assert one(spark, sky.healpix5(F.lit(1000 * 2**49 - 1))) == 1000


@pytest.mark.parametrize("ra, dec", [(0.0, 0.0), (0.0, 89.9999), (359.9999, -45.0), (10.0, -90.0)])
def test_cone_join_edges(spark, ra, dec):
    near = spark.createDataFrame([(1, ra, dec), (2, (ra + 4.9 / 3600) % 360, dec), (3, ra, max(-90.0, dec - 5.1 / 3600))], "id int, ra double, dec double")
    got = {(r.l_id, r.r_id) for r in sky.within(near, near, 5.0).where("l_id < r_id").collect()}
    rows = near.collect()

    def sep(a, b):
        h = math.sin(math.radians(b.dec - a.dec) / 2) ** 2 + math.cos(math.radians(a.dec)) * math.cos(math.radians(b.dec)) * math.sin(math.radians(b.ra - a.ra) / 2) ** 2
        return math.degrees(2 * math.asin(min(1, math.sqrt(h)))) * 3600

    assert got == {(a.id, b.id) for a in rows for b in rows if a.id < b.id and sep(a, b) < 5}


@pytest.mark.parametrize(
    "mode, a, b, merged",
    [
        ("off", ("Gaia EDR3 7", None, None, "x"), ("Gaia DR3 7", None, None, "y"), True),
        ("off", ("Gaia DR2 7", None, None, "x"), ("Gaia DR3 7", None, None, "y"), False),
        ("off", ("", None, None, "HVS 1234"), ("", None, None, "hvs  1234"), False),
        ("auto", ("", None, None, "HVS 1234"), ("", None, None, "hvs  1234"), True),
        ("review", ("", None, None, "HVS 1234"), ("", None, None, "hvs  1234"), False),
        ("auto", ("", "gaia DR3 9", None, "x"), ("", "gaia DR3 9", None, "y"), True),
        ("auto", ("", None, "k", "x"), ("", None, "k", "y"), True),
        ("auto", ("", None, None, "S5"), ("", None, None, "S5"), False),
    ],
)
def test_tiers(spark, mode, a, b, merged):
    rows = [("A:cand-1", *a, None, None, "2020-01"), ("B:cand-1", *b, None, None, "2020-02")]
    comp = linkage.linked(spark.createDataFrame(rows, SCHEMA), mode)[2]
    assert (comp.select("component").distinct().count() == 1) == merged


def test_crowded_positions_block(spark):
    rows = [(f"A:cand-{i}", "", None, None, "x", 10.0, i * 2 / 3600, "2020-01") for i in range(3)]
    x = spark.createDataFrame(rows, SCHEMA)
    assert linkage.linked(x, "auto")[2].select("component").distinct().count() == 3
    assert linkage.linked(x, "off")[2].select("component").distinct().count() == 1


def test_empty_linkage(spark):
    assert linkage.object_index(spark.createDataFrame([], SCHEMA), "auto").count() == 0


def test_lineage(spark):
    e = spark.createDataFrame([(1, "a", "b"), (1, "b", "c"), (1, "c", "a"), (2, "x", "y")], "doc int, step string, depends_on string")
    reach = lineage.closure(e)
    assert {(r.step, r.ancestor) for r in reach.where("doc = 1").collect()} == {(a, b) for a in "abc" for b in "abc" if a != b}
    assert {r.step for r in lineage.cyclic(e, reach).collect()} == {"a", "b", "c"}


def test_lineage_of_a_long_chain(spark):
    e = spark.range(1, 301).selectExpr("1 AS doc", "id AS step", "id - 1 AS depends_on")
    e = e.union(e.where("step > 2").selectExpr("doc", "step", "step DIV 2")).union(spark.sql("SELECT 2, a, b FROM VALUES (1L, 1L), (1L, 2L), (2L, 3L), (3L, 1L), (3L, NULL) AS x(a, b)")).union(spark.sql("SELECT NULL, 1L, 2L"))
    up = {}
    for r in e.collect():
        up.setdefault((r.doc, r.step), set()).add(r.depends_on)
    want = set()
    for doc, step in up:
        found, edge, n = {step}, {step}, 0
        while edge:
            edge, n = {a for s in edge for a in up.get((doc, s), ()) if a is not None} - found, n + 1
            found |= edge
            want |= {(doc, step, a, n) for a in edge}
    reach = lineage.closure(e)
    got = [tuple(r) for r in reach.collect()]
    assert len(got) == len(want) and set(got) == want and max(n for *_, n in got) > 100


def test_depth_is_the_longest_path(spark):
    rng = random.Random(3)
    edges = [(1, 2, 1), (1, 3, 2), (1, 3, 1), (1, 4, 3), (1, 4, 1), (1, 4, 4), (1, 2, 9), (2, 700, 699)]
    edges += [(3, s, rng.randrange(s)) for s in range(1, 900) for _ in range(rng.randint(0, 3))]
    down = {}
    for doc, s, d in edges:
        if d < s:
            down.setdefault((doc, s), set()).add(d)
    deep = {}
    for doc, s in sorted(down):
        deep[doc, s] = 1 + max(deep.get((doc, d), 0) for d in down[doc, s])
    x = spark.createDataFrame(edges, "doc long, step long, depends_on long")
    for block in (4096, 64):
        assert {(r.doc, r.step): r.depth for r in lineage.depths(x, block).collect()} == deep
    assert deep[1, 3] == 2 and deep[1, 4] == 3 and lineage.depths(x.where("false")).count() == 0


def test_tables():
    head, data = tables.latex_table("% \\begin{tabular}{c} no \\end{tabular}\n\\begin{tabular}{lc}\nid & v \\\\[2pt] \\hline\n1 & $2\\pm1$ \\\\\n3 & \\textbf{a\\&b}\n\\end{tabular}")
    assert head == [["id", "v"]] and data == [["1", "2±1"], ["3", "a&b"]]
    head, data = tables.html_table("<table><tr><th>a</th><th colspan=2>b</th></tr><tr><td rowspan=2>1</td><td>2</td><td>3</td></tr><tr><td>4</td><td>5</td></tr></table>")
    assert head == [["a", "b", ""]] and data == [["1", "2", "3"], ["1", "4", "5"]]


def test_sampling():
    assert rollups.allocation({"high": 26, "low": 23}, 28) == {"high": 15, "low": 13}
    assert rollups.allocation({"a": 1, "b": 2}, 9) == {"a": 1, "b": 2}


def test_systematic_sample_and_leaders(spark):
    x = spark.range(100).selectExpr("id", "id % 3 AS g")
    step = 100 / 7
    start = random.Random("s").uniform(0, step)
    got = sorted(r.position for r in rollups.systematic_sample(x, ["id"], 7, "s").collect())
    assert got == [min(int(start + i * step), 99) for i in range(7)]
    assert rollups.systematic_sample(x, ["id"], 200, "s").count() == 100 and rollups.systematic_sample(x, ["id"], 0, "s").count() == 0
    ties = spark.createDataFrame([(5, None), (5, None), (5, None), (4, "x")], "v int, w string")
    marked = [(r.v, r.selected) for r in rollups.top_k_flag(ties, [F.col("v").desc()], 2).collect()]
    assert sorted(marked) == [(4, False), (5, False), (5, True), (5, True)]


def test_view(spark):
    x = spark.createDataFrame([("a10", 1.0), ("a9", None), (None, 3.0)], "name string, v double")
    assert [r.name for r in view.catalog_view(x, ["name"], sort="name").collect()] == ["a9", "a10", None]
    assert [r.name for r in view.catalog_view(x, ["name"], sort="name", descending=True).collect()] == ["a10", "a9", None]
    assert view.catalog_view(x, ["name"], ranges={"v": (2, 1)}).count() == 3 and view.catalog_view(x, ["name"], ranges={"v": (0, 2)}).count() == 1


def test_sampler(spark):
    x = spark.createDataFrame([("o", 1.0, 0.01, 1.0, 2.0, 1.5)], "object_id string, parallax double, parallax_error double, alpha double, beta double, length double")
    r = dynamics.posterior(x, 2000, 200).first()
    assert abs(r.median - 1) < 0.01 and 0.005 < (r.p84 - r.p16) / 2 < 0.015


def test_sampler_draws_all_dimensions(spark):
    x = spark.sql("""SELECT 'Gaia DR3 1' AS object_id, 1.0D AS parallax, 0.02D AS parallax_error, 1.0D AS alpha, 2.0D AS beta, 1.5D AS length, 10 AS ra, 20 AS dec, 5.0D AS pmra, 0.05D AS pmra_error,
        -3.0D AS pmdec, 0.04D AS pmdec_error, 0.8D AS parallax_pmra_corr, -0.5D AS pmra_pmdec_corr, 100.0D AS radial_velocity, 2.0D AS radial_velocity_error""")
    x = x.union(x.withColumn("object_id", F.lit("Gaia DR3 2")).withColumn("radial_velocity", F.lit(None))).union(x.withColumn("object_id", F.lit("Gaia DR3 3")).withColumn("radial_velocity_error", F.lit(None)))
    d = {r.object_id[-1]: [np.array(v) if v is not None else None for v in r[1:]] for r in dynamics.draws(x).collect()}
    assert all(len(v) == 10_000 for v in d["1"]) and d["2"][3] is None and set(d["3"][3]) == {100.0} and not np.allclose(d["2"][0], d["3"][0])
    for i, ((value, error), v) in enumerate(zip(((1, 0.02), (5, 0.05), (-3, 0.04), (100, 2)), d["1"])):
        assert abs(v.mean() - value) < error / 5 and abs(v.std() / error - 1) < 0.1, i
    rho = np.corrcoef(d["1"])
    assert abs(rho[0, 1] - 0.8) < 0.05 and abs(rho[0, 2]) < 0.1 and abs(rho[1, 2] + 0.5) < 0.07 and abs(rho[0, 3]) < 0.1
    p = {r.object_id[-1]: r for r in dynamics.posterior(x).collect()}
    assert p["2"].radial_velocity_median is None and p["2"].speed_median < p["1"].speed_median
    args = [F.lit(float(v)) for v in (10, 20, p["3"].median, p["3"].pmra_median, p["3"].pmdec_median)]
    assert abs(one(spark, dynamics.speed(dynamics.velocity(*args, F.lit(100.0)))) - p["3"].speed_median) < 1
    assert abs(one(spark, dynamics.speed(dynamics.velocity(*args, dynamics.slowest_rv(*args)))) - p["2"].speed_median) < 1


def test_posterior_query_samples_every_supplier(spark):
    got = catalog.QUERIES["mcmc_posterior"](spark, SF)
    assert got.where("median > 0 and speed_median > 0").count() == spark.read.parquet(f"{SF}/supplier.parquet").count()


def same(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return ""
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    got = catalog.QUERIES[name](spark, SF)
    want = con.sql(catalog.ORACLES[name])
    order = [want.columns.index(x) for x in got.columns]
    assert sorted(tuple(map(same, r)) for r in got.collect()) == sorted(tuple(same(r[i]) for i in order) for r in want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_bibliography_keeps_cited_entries_and_blocks(spark):
    text = ["% head", "@string{x = 1}", "@article{a,", " t", "@book{b,", " t", None, "@misc{c,"]
    lines = spark.createDataFrame([(1, i, x) for i, x in enumerate(text, 1)] + [(2, 1, "@article{a,")], "doc int, line int, text string")
    cited = spark.createDataFrame([(1, "b"), (1, "b"), (2, "z"), (None, "a")], "doc int, key string")
    got = {(r.doc, r.line): (r.until, r.text) for r in packing.cited_entries(lines, cited).collect()}
    assert got == {(1, 1): (1, "% head"), (1, 2): (2, "@string{x = 1}"), (1, 3): (4, None), (1, 5): (5, "@book{b,"), (1, 6): (6, " t"), (1, 7): (7, ""), (1, 8): (8, None), (2, 1): (1, None)}
    assert packing.cited_entries(lines.where("false"), cited).count() == 0


def test_surroundings(spark):
    x = spark.createDataFrame([(1, "a\nb\nc github\nd\ne\nf"), (2, None), (3, "")], "id int, text string")
    assert [tuple(r) for r in packing.surroundings(x, "id", "text", "github").collect()] == [(1, 3, "a\nb\nc github\nd\ne")]


def test_limit_and_sexagesimal_rules(spark):
    x = spark.createDataFrame([(1, "range", None, "1", "2"), (2, "range", "3", "1", None), (3, "upper_limit", " ", "", ""), (4, None, "1", None, None), (5, "x", None, None, None)], "id int, k string, v string, lo string, hi string")
    found = {(r.location, r.rule) for r in rules.violations(x, F.col("id"), rules.limit_rules("k", "v", "lo", "hi")).collect()}
    assert found == {(2, "value_of_a_range"), (2, "ends_of_a_range"), (3, "limit_without_value"), (5, "limit_kind")}
    y = spark.createDataFrame([(1, "23:59:59.9", "-90:00:00"), (2, "24:00:00", "-91:10:10"), (3, "10:60:00", "10:10:60"), (4, "150.5", None)], "id int, ra string, dec string")
    found = {(r.location, r.rule) for r in rules.violations(y, F.col("id"), rules.sexagesimal_rules("ra", "dec")).collect()}
    assert found == {(2, "ra_hours"), (2, "dec_degrees"), (3, "ra_sixtieths"), (3, "dec_sixtieths")}


def test_provenance_and_allocation(spark):
    assert one(spark, rules.producer_allowed(F.lit("orbit"), F.lit("orbit_integration"))) and not one(spark, rules.producer_allowed(F.lit("orbit"), F.lit("input_catalog")))
    assert one(spark, rules.lineage_gaps(F.lit("orbit"), F.lit("orbit_integration"), F.array(F.lit("velocity_calculation")))) == 1
    x = spark.createDataFrame([("a",)] * 7 + [("b",)] * 2 + [("c",)], "s string")
    assert {r.s: r.sampled for r in rollups.allocated(x, "s", 5).collect()} == rollups.allocation({"a": 7, "b": 2, "c": 1}, 5)
    assert rollups.allocated(x.where("false"), "s", 5).count() == 0 and {r.weight for r in rollups.allocated(x, "s", 10).collect()} == {1.0}
    with pytest.raises(Exception, match="more is asked for than there is"):  # more than the population is refused
        rollups.allocated(x, "s", 99).collect()


def against_sql(spark, name, folder):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{folder}/documents.parquet'")
    got, want = catalog.QUERIES[name](spark, str(folder)), con.sql(catalog.ORACLES[name])
    order = [want.columns.index(x) for x in got.columns]
    return sorted(tuple(r) for r in got.collect()), sorted(tuple(r[i] for i in order) for r in want.fetchall())


@pytest.fixture(scope="module")
def odd_words(tmp_path_factory):
    folder = tmp_path_factory.mktemp("words")
    texts = [None, "", "The", "öthe", "thé", "theö x", "dießung", "Die_x", "die9", "ȧder", "DİE", "dİ̇e", "other", "Kthe", "der\nthe", "𝒜the", "the²", "dıe", "x-die!"]
    duckdb.from_query(f"select i as doc_id, t as text from (select unnest({list(range(len(texts)))}) as i, unnest(?::varchar[]) as t)", params=[texts]).write_parquet(f"{folder}/documents.parquet")
    return folder


def test_words_end_as_in_sql(spark, odd_words):
    got, want = against_sql(spark, "rule_triage", odd_words)
    assert got == want and len(got) == 19


def test_counts_of_words_that_end_as_in_sql(spark, odd_words):
    got, want = against_sql(spark, "rule_triage_counts", odd_words)
    assert got == want and len(got) == 3


@pytest.fixture(scope="module")
def many_customers(tmp_path_factory):
    folder = tmp_path_factory.mktemp("customers")  # more than 999 contributions for each of eight objects
    duckdb.sql(f"copy (select c_custkey + i * 150 as c_custkey, * exclude (c_custkey) from '{SF}/customer.parquet', range(76) r(i)) to '{folder}/customer.parquet'")
    return folder


def test_more_than_999_sources_in_order(spark, many_customers):
    con = duckdb.connect()
    con.sql(f"create view customer as select * from '{many_customers}/customer.parquet'")
    got = catalog.QUERIES["viewer_columns"](spark, str(many_customers)).select("object_id", "distances", "n_types", "n_teff").collect()
    assert sorted(map(tuple, got)) == sorted(con.sql(catalog.ORACLES["viewer_columns"]).fetchall()) and any("src-1000=" in r.distances for r in got)


def test_records_of_more_than_999_sources(spark, many_customers):
    x = shape_queries.object_rows(spark, str(many_customers)).select("sources.source", F.col("candidates.source").alias("of")).first()
    assert len(x.source) > 999 and x.source == x.of == [f"src-{i + 1:03d}" for i in range(len(x.source))]
