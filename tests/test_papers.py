"""Paper documents, referee, tables read from files and other operators without SQL, against plain versions and on odd rows."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.functions import numbers as nm
from skyledger.functions import replies
from skyledger.operators import catalogue, checks, dynamics, enrichment, inventory, objects, outcomes, papers, referee, rollups, rules, search, tables
from skyledger.plans import shape_queries


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_scan_diverts_bad_documents(spark):
    good = json.dumps({"schema_version": papers.VERSION, "paper": {"arxiv_id": "1"}, "candidates": [{"identifiers": {"record_id": "r"}}]})
    rows = [(1, good), (2, None), (3, ""), (4, "[1]"), (5, "{bad"), (6, good.replace('"identifiers"', '"odd":1,"identifiers"')), (7, good.replace(papers.VERSION, "x")), (8, good.replace('"paper"', '"extra":0,"paper"'))]
    got = {r.path: (r.doc is not None, r.error) for r in papers.scan(spark.createDataFrame(rows, "path int, text string")).collect()}
    assert got[1] == (True, None) and not any(ok for k, (ok, _) in got.items() if k > 1)
    assert got[6][1] == "unknown candidate keys: odd" and got[8][1] == "unknown keys: extra" and got[7][1] == "another version"
    assert papers.candidates(papers.scan(spark.createDataFrame([], "path int, text string"))).count() == 0


def test_matched_sets_are_greedy(spark):
    rng = random.Random(6)

    def side(n):
        out = []
        for i in range(n):
            number = str(rng.randint(0, 12)) if rng.random() < 0.4 else ""
            names = [f"N{rng.randint(0, 25)}" for _ in range(rng.randint(0, 2))]
            ra, dec = (10 + rng.randint(0, 6) * 0.0007, 5.0) if rng.random() < 0.8 else (None, None)
            out.append((1, i, (str(i), "DR3" if number else "", number, names, ra, dec, None, None, None)))
        return out

    kind = "s int, i int, identity struct<record_id:string,release:string,number:string,names:array<string>,ra:double,dec:double,pm_ra:double,pm_dec:double,year:double>"
    for _ in range(3):
        left, right = side(25), side(30)

        def compare(a, b):
            if a[2] and b[2]:
                return ("gaia_id", 0.0) if a[2] == b[2] else (None, 0.0)
            if set(a[3]) & set(b[3]):
                return "alias", 0.0
            if None in (a[4], b[4]):
                return None, 0.0
            sep = abs(a[4] - b[4]) * math.cos(math.radians(5)) * 3600
            return ("coordinates", sep) if sep <= 5 else (None, sep)

        free_l, free_r, want = set(range(25)), set(range(30)), set()
        for tier in ("gaia_id", "alias"):
            for i in sorted(free_l):
                for j in sorted(free_r):
                    if compare(left[i][2], right[j][2])[0] == tier:
                        want.add((i, j, tier))
                        free_l.discard(i)
                        free_r.discard(j)
                        break
        near = sorted((round(s, 5), i, j) for i in free_l for j in free_r for m, s in [compare(left[i][2], right[j][2])] if m == "coordinates")
        pairs = [(i, j) for _, i, j in near]
        got = {(r.i, r.j, r.method) for r in referee.matched_sets(spark.createDataFrame(left, kind), spark.createDataFrame(right, kind), "s").collect()}
        assert {g for g in got if g[2] != "coordinates"} == want
        placed = [g[:2] for g in got if g[2] == "coordinates"]
        assert len({i for i, _ in placed}) == len({j for _, j in placed}) == len(placed) and set(placed) <= set(pairs)
        # none that is left could still be matched
        assert not [p for p in pairs if p[0] not in {i for i, _ in placed} and p[1] not in {j for _, j in placed}]


def test_tables_read_from_files():
    source = "\\pgfplotstableread[col sep=semicolon]{a.csv}\\first % \\pgfplotstableread{no.csv}\\first\n\\pgfplotstableread{b.csv}{\\second}"
    files = {"a.csv": "x;y\n1;2\n\n3", "b.csv": "", "c.csv": "z"}
    assert tables.reads(source) == [("first", "a.csv", "col sep=semicolon"), ("second", "b.csv", "")]
    assert tables.plotted_table("\\pgfplotstabletypeset[columns={y,x}, columns/y/.style={column name={$v$, km}}]{\\first}", source, files) == (["v, km", "x"], [["2", "1"], ["", "3"]], "")
    errors = {"nothing": "no table is typeset from a file", "\\pgfplotstabletypeset[a": "the source argument is missing", "\\pgfplotstabletypeset{\\none}": "nothing is read into none", "\\pgfplotstabletypeset{\\second}": "no header row: b.csv", "\\pgfplotstabletypeset[columns={q}]{\\first}": "no such columns: q"}
    for excerpt, error in errors.items():
        assert tables.plotted_table(excerpt, source, files)[2] == error
    assert tables.plotted_table("\\pgfplotstabletypeset{\\first}", source, {})[2] == "no such data file: a.csv"


def test_converters_in_turn(spark):
    none = F.lit(None).cast("string")
    got = one(spark, tables.converted([("a", none, F.lit("broken")), ("b", F.lit("rows"), none), ("c", F.lit("x"), none)]))
    assert (got["method"], got["rows"], got["log"]) == ("b", "rows", ["a: broken", "b: success"])


@pytest.mark.parametrize("a, b", [(0.5, 10.5), (10.5, 0.5), (3.5, 7.5), (120.5, 880.5), (5000.5, 5000.5)])
def test_beta_quantiles(a, b):
    for q in (0.16, 0.5, 0.84):
        x = float(dynamics.beta_quantile(q, np.array([a]), np.array([b]))[0])
        angle = (np.arange(400_000) + 0.5) * (math.asin(math.sqrt(x)) / 400_000)  # x = sin^2 leaves no pole at the ends
        density = 2 * np.exp((2 * a - 1) * np.log(np.sin(angle)) + (2 * b - 1) * np.log(np.cos(angle)) - (math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)))
        assert abs(density.mean() * math.asin(math.sqrt(x)) - q) < 1e-6
    assert dynamics.beta_share(np.array([0.0, 1.0]), np.array([a, a]), np.array([b, b])).tolist() == [0.0, 1.0]


def test_three_digits_as_the_usual_format(spark):
    rng = random.Random(2)
    values = [0.0, 1.0, 999.0, 999.6, 1000.0, 0.0001, 0.00001, 123456.0, -12.345, 0.1, *(rng.uniform(-1, 1) * 10 ** rng.randint(-6, 6) for _ in range(300))]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", replies.three_digits(F.col("v")).alias("t")).collect()
    assert [(r.v, r.t) for r in got if r.t != f"{r.v:.3g}"] == []


def test_replies(spark):
    assert one(spark, replies.json_object(F.lit('```json\n{"a": 1}\n```'))) == '{"a": 1}' and one(spark, replies.json_object(F.lit("no"))) is None
    assert one(spark, replies.json_array(F.lit("x [1] y"))) == "[1]" and one(spark, replies.json_array(F.lit(None).cast("string"))) is None
    assert one(spark, nm.unit_like(F.lit("v [km/s]"))) and not one(spark, nm.unit_like(F.lit("name")))


def test_odd_rows_of_rules_and_records(spark):
    none = F.lit(None).cast(papers.QUANTITY)
    q = spark.range(1).select(F.lit("candidates[0].core.orbit.x").alias("location"), F.lit("x").alias("field"), none.alias("q"), F.create_map().cast("map<string,string>").alias("steps"))
    assert {r.rule for r in rules.violations(q, F.col("location"), checks.quantity_rules(True)).collect()} >= {"value_markup", "raw_value_missing", "source_refs_missing", "method_refs_missing"}
    c = spark.range(1).select(F.lit(None).cast(papers.CANDIDATE).alias("c"))
    assert c.select(papers.simplified(F.col("c")).alias("s")).select("s.identifiers.record_id", F.size("s.photometry")).first() == ("", 0)
    assert one(spark, referee.quantity_display(F.lit(None).cast(papers.QUANTITY))) == ""
    assert one(spark, objects.route(F.lit("#/about"))) is None
    line = [F.lit(x) for x in ("% c", "x = 1,", "--- Page 3 ---", "\\section{A}", "words")]
    assert [one(spark, checks.substantive(x)) for x in line] == [False, False, False, False, True]
    assert one(spark, checks.tokens(F.lit('a "b c" "d""e" f'))) == ["a", "b c", 'd"e', "f"]


def test_cell_references(spark):
    lines, columns = F.array(F.lit("# m"), F.lit("a b"), F.lit('1 "x y"'), F.lit("2")), F.array(F.lit("a"), F.lit("b"))
    ref = lambda line, column, raw: F.struct(F.lit(line).alias("line"), F.lit(column).alias("column"), F.lit(raw).alias("raw_value"), F.lit(None).cast("string").alias("component_raw_value"))
    want = {(3, "b", "x y"): set(), (3, "b", "z"): {"cell_value"}, (4, "b", "z"): {"cell_short"}, (1, "a", "m"): {"cell_metadata"}, (2, "a", "a"): {"cell_header"}, (9, "a", "1"): {"cell_line"}, (3, "c", "1"): {"cell_column"}}
    for (line, column, raw), broken in want.items():
        found = rules.violations(spark.range(1), F.lit("x"), checks.cell_ref_rules(ref(line, column, raw), lines, columns)).collect()
        assert {r.rule for r in found} == broken


def test_incompatible_steps_and_unique_ids(spark):
    used = spark.createDataFrame([(1, "s1", "distance"), (1, "s1", "orbit"), (1, "s2", "quality"), (1, "s2", "sample_selection"), (1, "s3", "orbit"), (1, "s3", "orbit")], "path int, step string, category string")
    assert [(r.step, r.categories) for r in checks.incompatible_steps(used).collect()] == [("s1", ["distance", "orbit"])]
    ids = checks.unique_ids(spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "base string, n int"), "base", ["n"])
    assert sorted(r.unique_id for r in ids.collect()) == ["a", "a-2", "b"]


def test_sources_and_files(spark):
    files = spark.createDataFrame([("lit/p1/x.json",), ("lit/index/x.json",), ("lit/p2/y.json",)], "path string")
    assert [r.path for r in search.without_reserved(files, "x.json", ("index",)).collect()] == ["lit/p1/x.json"]
    tex = spark.createDataFrame([("f", "a.tex", "\\documentclass{x}"), ("f", "main.tex", "\\documentclass{x}\\begin{document}"), ("g", "z.tex", None)], "folder string, path string, text string")
    assert dict(search.tex_root(tex, "folder", "path", "text").collect()) == {"f": "main.tex", "g": "z.tex"}
    x = spark.createDataFrame([("k", "2019-01", 1), ("k", "2020-01", 2)], "id string, month string, v int")
    assert search.latest_by(x, "id", F.col("month")).first().v == 2
    months = search.month_records(x, "month", ["v"], most=F.max("v")).collect()
    assert sorted((r.month, r.n_papers, r.most) for r in months) == [("2019-01", 1, 1), ("2020-01", 1, 2)]
    t = one(spark, search.triage_record(F.lit('{"id":"1","_title_triage":{"label":"x","confidence":0.5},"_review":{"status":"ok"}}'), "main", "r"))
    assert (t["title_triage"]["label"], t["title_triage"]["confidence"], t["review"]["status"]) == ("x", 0.5, "ok")
    assert one(spark, catalogue.version_agreement(F.lit(None).cast("int"), F.lit(2))) is None


def test_halved_batches():
    asked = []

    def query(values):
        asked.append(list(values))
        if 3 in values or len(values) > 4:
            raise RuntimeError("refused")
        return [v * 10 for v in values]

    assert enrichment.halved(list(range(8)), query) == [0, 10, 20, 40, 50, 60, 70]
    assert enrichment.halved([], query) == [] and [3] in asked


def test_inventory_of_odd_sources(spark):
    texts = [None, "", "\\begin{table}", "50\\% \\begin{table}\\caption{a {b {c}} d}\n\\end{table}", "\\begin{longtable}\\label{x}\\end{longtable}\n\n\\begin{table*}\\end{table}\\end{table*}"]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", inventory.table_blocks(F.col("t")).alias("b")).collect()
    assert [len(r.b) for r in got] == [0, 0, 0, 1, 2]
    assert (got[3].b[0].caption, got[3].b[0].start_line, got[3].b[0].end_line) == ("a {b {c}} d", 1, 2) and got[4].b[1].start_line == 3
    paths = ["a/x.FITS.gz", "b.csv", "c.tex", "README", ".csv", None]
    assert [one(spark, inventory.data_suffix(F.lit(p).cast("string"))) for p in paths] == [".fits.gz", ".csv", None, None, None, None]


def test_outcomes_without_anything(spark):
    assert one(spark, outcomes.velocity_choice(F.lit(None).cast("array<struct<value:string,error:string>>")))["lower_limit"]
    chosen = one(spark, outcomes.source_choice(F.lit(None).cast("string"), F.array(F.lit("x"), F.lit("Gaia DR3 5"), F.lit("gaia edr3 6"))))
    assert (chosen["number"], chosen["several"]) == ("5", True)


def test_numbers_within_very_common_keys(spark):
    rng = random.Random(11)
    rows = [(k, v) for k, n in ((None, 30), ("a", 700), ("b", 1), ("c", 300)) for v in range(n)]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows make one range
    try:
        shown = rollups.numbered_within(spark.createDataFrame(rows, "k string, v int"), "k", ["v"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((r.k or "", r.v, r.n) for r in shown.collect()) == sorted((k or "", v, v + 1) for k, v in rows)
    assert rollups.numbered_within(spark.createDataFrame([], "k string, v int"), "k", ["v"]).count() == 0


def test_sources_of_a_common_object_stay_apart(spark):
    plan = shape_queries.object_sources(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan  # no row holds all candidates of an object
