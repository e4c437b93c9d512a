"""Referee: whether records of two sides are the same object, one-to-one matching of two sets, and anchors of assertions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sky
from ..functions import text as tx
from . import papers
from .linkage import dropped, stored

#: Arcseconds within which positions brought to a common year, or positions as they stand, count as one; that year.
PROPAGATED, FALLBACK, YEAR = 2.0, 5.0, 2016.0
GAIA = r"(?i)^\s*Gaia\s+(E?DR[0-9])\s+([0-9]+)\s*$"


def epoch_year(e: Column) -> Column:
    """The year of a reference epoch such as J2016.0; other kinds of epoch are no observation."""
    return F.when(e["epoch_kind"] == "reference_epoch", F.regexp_extract(F.trim(e["value"]), r"^[BJ]?(\d{4}(?:\.\d+)?)$", 1).try_cast("double"))


def proper_motion(q: Column) -> Column:
    """A proper motion in mas/yr; other units give null."""
    unit = F.lower(F.coalesce(q["unit"], F.lit("")))
    return F.when(unit.contains("mas") & unit.contains("yr"), F.trim(q["value"]).try_cast("double"))


def identity(c: Column) -> Column:
    """What a candidate record can be recognised by: id by release, names that are no ids, position, motion, epoch."""
    ids, seen = c["identifiers"], c["core"]["observed_phase_space"]
    every = F.concat(F.transform(F.coalesce(ids["all"], F.array()), lambda x: x["value"]), F.array(ids["paper_candidate_id"]))
    names = F.array_distinct(F.filter(F.transform(F.filter(every, lambda v: ~v.rlike(GAIA)), tx.referee_name), lambda v: v != ""))

    def degrees(q: Column, ra: bool) -> Column:
        return sky.parse_angle(q["value"], F.coalesce(q["unit"], F.lit("")), F.coalesce(q["coordinate_format"], F.lit("")), ra, "referee")

    return F.struct(
        ids["record_id"].alias("record_id"),
        F.upper(F.regexp_extract(F.coalesce(ids["gaia_source_id"], F.lit("")), GAIA, 1)).alias("release"),
        F.regexp_extract(F.coalesce(ids["gaia_source_id"], F.lit("")), GAIA, 2).alias("number"),
        names.alias("names"),
        degrees(seen["ra"], True).alias("ra"),
        degrees(seen["dec"], False).alias("dec"),
        proper_motion(seen["proper_motion_ra"]).alias("pm_ra"),
        proper_motion(seen["proper_motion_dec"]).alias("pm_dec"),
        F.coalesce(epoch_year(seen["ra"]["epoch"]), epoch_year(seen["dec"]["epoch"])).alias("year"),
    )


def compared(l: Column, r: Column, propagated: float = PROPAGATED, fallback: float = FALLBACK) -> Column:
    """struct<matched, method, detail, sep> of two identities: equal ids of a release settle, then a shared name, then positions,
    brought to a common year where both have motions and epochs."""
    both = (l["number"] != "") & (r["number"] != "") & (l["release"] == r["release"])
    shared = F.array_min(F.array_intersect(l["names"], r["names"]))
    placed = l["ra"].isNotNull() & l["dec"].isNotNull() & r["ra"].isNotNull() & r["dec"].isNotNull()
    moving = lambda x: x["pm_ra"].isNotNull() & x["pm_dec"].isNotNull() & x["year"].isNotNull()
    moved = moving(l) & moving(r)
    at = lambda x: sky.propagated(x["ra"], x["dec"], x["pm_ra"], x["pm_dec"], F.lit(YEAR) - x["year"])
    (lra, ldec), (rra, rdec) = at(l), at(r)
    sep = F.when(moved, sky.separation(lra, ldec, rra, rdec)).otherwise(sky.separation(l["ra"], l["dec"], r["ra"], r["dec"]))
    near = sep <= F.when(moved, propagated).otherwise(fallback)
    say = lambda matched, method, detail, s=None: F.struct(F.lit(matched).alias("matched"), F.lit(method).alias("method"), detail.alias("detail"), (F.lit(None).cast("double") if s is None else s).alias("sep"))
    regime = F.concat(F.when(moved, "propagated").otherwise("unpropagated"), F.format_string(" %.3f", sep))
    return (
        F.when(both & (l["number"] == r["number"]), say(True, "gaia_id", F.concat_ws(" ", F.lit("Gaia"), l["release"], l["number"])))
        .when(both, say(False, "gaia_conflict", F.concat_ws(" ", l["number"], F.lit("vs"), r["number"])))
        .when(shared.isNotNull(), say(True, "alias", shared))
        .when(~placed, say(False, "no_evidence", F.lit("")))
        .when(near, say(True, "coordinates", regime, sep))
        .otherwise(say(False, "coordinates_too_far", regime, sep))
    )


def possible(left: DataFrame, right: DataFrame, scope: str, propagated: float, fallback: float) -> DataFrame:
    """scope, i, j, method and sep of the pairs that match: met by id, by name and by sky cell, never all with all."""
    l, r = left.select(F.col(scope).alias("s"), F.col("i"), F.col("identity").alias("a")), right.select(F.col(scope).alias("s"), F.col("i").alias("j"), F.col("identity").alias("b"))
    by_id = l.where("a.number <> ''").join(r.where("b.number <> ''"), (l.s == r.s) & (F.col("a.release") == F.col("b.release")) & (F.col("a.number") == F.col("b.number"))).select(l.s, "i", "j")
    ln, rn = l.select("s", "i", F.explode("a.names").alias("n")), r.select("s", "j", F.explode("b.names").alias("n"))
    by_name = ln.join(rn, ["s", "n"]).select("s", "i", "j")

    def placed(x: DataFrame, side: str, key: str) -> DataFrame:
        q = F.col(side)
        moving = q["pm_ra"].isNotNull() & q["pm_dec"].isNotNull() & q["year"].isNotNull()
        ra, dec = sky.propagated(q["ra"], q["dec"], q["pm_ra"], q["pm_dec"], F.lit(YEAR) - q["year"])
        each = F.array(F.struct(q["ra"].alias("ra"), q["dec"].alias("dec")), F.struct(F.when(moving, ra).alias("ra"), F.when(moving, dec).alias("dec")))
        return x.select("s", key, F.explode(each).alias("p")).select("s", key, "p.ra", "p.dec")

    near = sky.within(placed(l, "a", "i"), placed(r, "b", "j"), max(propagated, fallback), inclusive=True).where("l_s = r_s")
    met = by_id.union(by_name).union(near.select("l_s", "l_i", "r_j")).distinct()
    x = met.join(l, ["s", "i"]).join(r, ["s", "j"]).withColumn("m", compared(F.col("a"), F.col("b"), propagated, fallback))
    return x.where("m.matched").select("s", "i", "j", "m.method", "m.detail", F.coalesce("m.sep", F.lit(0.0)).alias("sep"))


def greedy(pairs: DataFrame) -> DataFrame:
    """Pairs (s, i, j, order columns o1, o2) that greedy one-to-one matching takes, by the order and then i, j.

    A pair that comes first among all pairs of its i and of its j is taken whatever else happens; taken ones remove the others of
    their i and j; rounds go on until none is left. Every round takes at least the first pair of each scope.
    """
    left, taken = stored(pairs), None
    rank = F.struct("o1", "o2", "i", "j")
    while left.head(1):
        best_i = left.groupBy("s", "i").agg(F.min(rank).alias("bi"))
        best_j = left.groupBy("s", "j").agg(F.min(rank).alias("bj"))
        now = stored(left.join(best_i, ["s", "i"]).join(best_j, ["s", "j"]).where((F.struct("o1", "o2", "i", "j") == F.col("bi")) & (F.col("bi") == F.col("bj"))).select(*left.columns))
        rest = stored(left.join(now.select("s", "i"), ["s", "i"], "left_anti").join(now.select("s", "j"), ["s", "j"], "left_anti").select(*left.columns))
        dropped(left)
        left, taken = rest, now if taken is None else taken.unionByName(now)
    return taken if taken is not None else left


def matched_sets(left: DataFrame, right: DataFrame, scope: str, propagated: float = PROPAGATED, fallback: float = FALLBACK) -> DataFrame:
    """scope, i, j, method, detail, sep of the one-to-one matches of two sets within each scope: all by id first, then by name, in
    the order of the left and right places, then the closest by position.

    left and right: scope, i (place) and identity. What is absent from the result is unmatched.
    """
    some = possible(left, right, scope, propagated, fallback)
    tier = F.when(F.col("method") == "gaia_id", 0).when(F.col("method") == "alias", 1).otherwise(2)
    # within the first two tiers the order is that of the places; the separation only orders the third
    ordered = some.withColumn("o1", tier).withColumn("o2", F.when(tier == 2, F.col("sep")).otherwise(0.0))
    return greedy(ordered).select(F.col("s").alias(scope), "i", "j", "method", "detail", "sep")


def quantity_display(q: Column) -> Column:
    """A quantity in words: range or value, error, unit, kind of limit."""
    g = lambda f: F.coalesce(q[f], F.lit(""))
    ranged = g("limit_kind") == "range"
    some = lambda c, v: F.when(c, v)
    return F.trim(
        F.concat_ws(
            " ",
            F.when(ranged, F.concat(g("range_lower"), F.lit(".."), g("range_upper"))).when(g("value") != "", g("value")),
            F.when(g("error") != "", F.concat(F.lit("± "), g("error"))).when((g("lower_error") != "") | (g("upper_error") != ""), F.concat(F.lit("+"), g("upper_error"), F.lit(" / -"), g("lower_error"))),
            some(g("unit") != "", g("unit")),
            some(g("limit_kind") != "", F.concat(F.lit("["), g("limit_kind"), F.lit("]"))),
        )
    )


def anchors(q: Column) -> Column:
    """Texts by which a quantity can be found on a page, in order of trust."""
    found = F.transform(F.array(*(q[f] for f in ("raw_value", "value", "range_lower", "range_upper"))), lambda v: F.trim(F.coalesce(v, F.lit(""))))
    return F.array_distinct(F.filter(found, lambda v: (F.length(v) >= 3) & (F.lower(v) != "unknown")))


def candidate_names(c: Column) -> Column:
    """Names of a candidate, its source id and the digits of that, of three characters or more."""
    ids = c["identifiers"]
    gaia = F.nullif(ids["gaia_source_id"], F.lit(""))
    last = F.regexp_extract(gaia, r"(?:^|\s)(\d+)$", 1)
    every = F.concat(F.transform(F.coalesce(ids["all"], F.array()), lambda x: x["value"]), F.array(gaia, last))
    return F.filter(every, lambda v: F.length(v) >= 3)


def assertions(docs: DataFrame) -> DataFrame:
    """path, group, label, display, raw_value, anchors and context: what a document asserts, a row each: its status, each
    candidate's identifiers and inclusion, each core quantity, each parameter of a method, and the types of its steps."""
    none = F.array().cast("array<string>")
    cols = ["path", "group", "label", "display", "raw_value", "anchors", "context"]
    d = docs.where("doc is not null")
    status = d.select("path", F.lit("document"), F.lit("extraction.status"), F.col("doc.extraction.status"), F.lit(""), none, none).toDF(*cols)
    cands = papers.candidates(docs)
    c, ids = F.col("c"), F.col("c.identifiers")
    group, names = F.concat(F.lit("candidate:"), F.coalesce(ids["record_id"], F.lit("?"))), candidate_names(F.col("c"))
    listed = F.array_join(F.transform(ids["all"], lambda x: x["value"]), ", ")
    who = F.concat(ids["record_id"], F.when(F.coalesce(ids["gaia_source_id"], F.lit("")) != "", F.concat(F.lit(" — Gaia: "), ids["gaia_source_id"])).otherwise(""), F.when(listed != "", F.concat(F.lit(" — names: "), listed)).otherwise(""))
    a = c["inclusion_assessment"]
    why = F.concat(F.array_join(a["paper_labels"], ", "), F.lit(" — bound claim: "), F.coalesce(a["galactic_bound_claim"], F.lit("")), F.lit(" — "), F.coalesce(a["summary"], F.lit("")))
    own = cands.select("path", group, F.lit("identifiers"), who, F.lit(""), names, names).toDF(*cols).union(cands.select("path", group, F.lit("inclusion_assessment"), why, F.lit(""), names, names).toDF(*cols))
    core = _core(cands, group, names)
    q = F.col("e.q")
    shown = core.where((quantity_display(q) != "") | (F.coalesce(q["raw_value"], F.lit("")) != "")).select("path", "group", "e.label", quantity_display(q), F.coalesce(q["raw_value"], F.lit("")), anchors(q), "names").toDF(*cols)
    steps = d.select("path", F.explode("doc.method_chain").alias("s"))
    p = F.col("p")
    used = steps.select("path", "s", F.explode("s.parameters").alias("p0")).select("path", "s", F.col("p0").withField("limit_kind", F.lit("")).withField("range_lower", F.lit("")).withField("range_upper", F.lit("")).alias("p"))
    told = used.select("path", F.lit("method"), F.concat("s.step_type", F.lit(": "), p["name"]), quantity_display(p), F.coalesce(p["raw_value"], F.lit("")), anchors(p), none).toDF(*cols)
    kinds = d.where(F.size("doc.method_chain") > 0).select("path", F.lit("method"), F.lit("step types present"), F.array_join(F.array_sort(F.array_distinct(F.transform("doc.method_chain", lambda s: s["step_type"]))), ", "), F.lit(""), none, none).toDF(*cols)
    return status.union(own).union(shown).union(told).union(kinds)


def _labelled(group: str):
    return lambda e: F.struct(F.concat(F.lit(f"{group}."), e["key"]).alias("label"), e["value"].alias("q"))


def _core(cands: DataFrame, group: Column, names: Column) -> DataFrame:
    none = F.create_map().cast(f"map<string,{papers.QUANTITY}>")
    every = F.concat(*(F.transform(F.map_entries(F.coalesce(F.col("c")["core"][g], none)), _labelled(g)) for g in papers.CORE))
    return cands.select("path", group.alias("group"), names.alias("names"), F.explode(F.filter(every, lambda e: e["q"].isNotNull())).alias("e"))


def located(found: DataFrame, pages: DataFrame) -> DataFrame:
    """path, group, label, page and term: the first anchor of an assertion that a page of its document holds; of the pages that
    hold it one that also names the candidate comes first, then the earliest. pages: path, page, text.

    Assertions meet the pages of their own document only; those without an anchor anywhere are absent.
    """
    a = found.select("path", "group", "label", "context", F.posexplode("anchors").alias("place", "term"))
    hit = a.join(pages, "path").where(F.col("text").contains(F.col("term")))
    named = F.exists("context", lambda x: F.col("text").contains(x))
    best = hit.groupBy("path", "group", "label").agg(F.min(F.struct("place", (~named).alias("bare"), "page", "term")).alias("b"))
    return best.select("path", "group", "label", "b.page", "b.term")
