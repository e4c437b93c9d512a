"""Object records and what a viewer shows of them: sources, best values, context, coverage, index rows, columns by source mode.

An object record holds numbered sources and their compact candidates (see papers.simplified). Everything is a projection of
one record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import replies
from ..functions import text as tx
from . import papers, rollups

OBSERVED = papers.CORE["observed_phase_space"]


def source_number(n: Column) -> Column:
    return F.format_string("src-%03d", n)


def source_row(source: Column, s: Column, path: Column, paper: Column) -> Column:
    """The row by which an object names a contribution: its source, the four fields of its reference and its paper."""
    ref = papers.candidate_ref(s, path)
    return F.struct(source.alias("source"), *(ref[f].alias(f) for f in ("record_id", "paper_candidate_id", "gaia_source_id", "source_json_path")), paper.alias("paper"))


def records(contributions: DataFrame, key: str, order: list[str]) -> DataFrame:
    """key, sources (src-001 and so on in order, with paper and reference) and candidates (with their source) of each object.

    contributions: key, order columns, arxiv_id, month, path and s (compact candidate). A very common object is one record, as
    its document is; its contributions are numbered by a window over its key.
    """
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    x = contributions.withColumn("_n", n)
    source = source_row(source_number(F.col("_n")), F.col("s"), F.col("path"), F.struct("arxiv_id", "month"))
    g = x.groupBy(key).agg(F.collect_list(F.struct("_n", source.alias("row"), F.col("s").alias("s"))).alias("e"))
    g = g.withColumn("e", F.array_sort("e", lambda a, b: F.when(a["_n"] < b["_n"], -1).when(a["_n"] > b["_n"], 1).otherwise(0)))  # by number: src-1000 comes after src-999; compact candidates hold maps, which have no order
    return g.select(key, F.transform("e", lambda e: e["row"]).alias("sources"), F.transform("e", lambda e: F.struct(e["row"]["source"].alias("source"), e["s"].alias("s"))).alias("candidates"))


def contributions_of(objects: DataFrame, key: str) -> DataFrame:
    """The contributions of object records again: key, source row and compact candidate; a candidate without its source is left out."""
    s = objects.select(key, F.explode("sources").alias("row"))
    c = objects.select(F.col(key).alias("_k"), F.explode("candidates").alias("e"))
    return s.join(c, (F.col(key) == F.col("_k")) & (F.col("row.source") == F.col("e.source"))).select(key, "row", F.col("e.s").alias("s"))


def candidate_for(candidates: Column, source: Column) -> Column:
    """The compact candidate of a source, the first if there are several."""
    return F.get(F.filter(candidates, lambda e: e["source"] == source), F.lit(0))["s"]


def best_quantity(candidates: Column, group: str, field: str) -> Column:
    """The first quantity of a field over the candidates in order."""
    found = F.filter(F.transform(candidates, lambda e: e["s"]["core"][group][field]), lambda q: q.isNotNull())
    return F.get(found, F.lit(0))


def value_text(q: Column) -> Column:
    return tx.quantity_text(q["value"], q["error"], q["lower_error"], q["upper_error"])


def reported_by(label: Column, year: Column, month: Column, arxiv_id: Column) -> Column:
    """A paper's label, or its id and the year of its month."""
    when = F.coalesce(F.nullif(F.trim(year), F.lit("")), F.left(F.coalesce(month, F.lit("")), F.lit(4)))
    return F.coalesce(F.nullif(F.trim(label), F.lit("")), F.trim(F.concat_ws(" ", F.lit("arXiv"), F.coalesce(arxiv_id, F.lit("")), when)))


def distinct_texts(values: Column) -> Column:
    """Trimmed texts that are not empty, each once, in order; case counts."""
    return F.array_distinct(F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda v: F.trim(F.coalesce(v, F.lit("")))), lambda v: v != ""))


def context_summary(candidates: Column) -> Column:
    """Labels, claims, origins and confidences over all sources, and how many reassess the status."""
    why = F.transform(candidates, lambda e: e["s"]["candidate_context"])
    union = lambda f: distinct_texts(F.transform(why, lambda w: w[f]))
    return F.struct(
        distinct_texts(F.flatten(F.transform(why, lambda w: w["paper_labels"]))).alias("paper_labels"),
        union("galactic_bound_claim").alias("bound_claims"),
        union("origin_type").alias("origin_types"),
        union("extraction_confidence").alias("extraction_confidence"),
        F.size(F.filter(why, lambda w: w["paper_reassesses_unbound_status"])).alias("reassessed_source_count"),
    )


def coverage(candidates: Column) -> Column:
    """How many entries the sources have in each typed group."""

    def of_list(name: str) -> Column:
        return F.aggregate(F.transform(candidates, lambda e: F.size(e["s"][name])), F.lit(0), lambda a, n: a + F.greatest(n, F.lit(0))).alias(name)

    def of_object(name: str) -> Column:
        fields, more = papers.OBJECTS[name]

        def one(e: Column) -> Column:
            n = F.lit(0)
            for f in fields:
                n = n + e["s"][name][f].isNotNull().cast("int")
            for x in more:
                n = n + (F.coalesce(F.size(e["s"][name][x]), F.lit(0)) > 0).cast("int")
            return n

        return F.aggregate(F.transform(candidates, one), F.lit(0), lambda a, n: a + n).alias(name)

    return F.struct(*map(of_list, papers.LISTS), *map(of_object, papers.OBJECTS))


def source_summary(row: Column, candidates: Column, label: Column, year: Column) -> Column:
    """What the index shows of one source: references, paper, quantities as text, context."""
    return summary_of(row, candidate_for(candidates, row["source"]), label, year)


def source_summaries(contributions: DataFrame, key: str, order: list[str], label: Column, year: Column) -> DataFrame:
    """key, path and s (summary) of every contribution, with the sources that records() gives them.

    An object's contributions are never brought together: each is summed up alone, and the numbers come from ranges.
    """
    row = source_row(F.lit(""), F.col("s"), F.col("path"), F.struct("arxiv_id", "month"))
    x = contributions.select(key, *order, F.col("path").alias("_path"), summary_of(row, F.col("s"), label, year).alias("_summary"))
    x = rollups.numbered_within(x, key, order, "_number")
    return x.select(key, F.col("_path").alias("path"), F.col("_summary").withField("source", source_number(F.col("_number"))).alias("s"))


def summary_of(row: Column, s: Column, label: Column, year: Column) -> Column:
    """The summary of a source and its compact candidate."""
    core, why, paper = s["core"], s["candidate_context"], row["paper"]
    return F.struct(
        *(row[f].alias(f) for f in ("source", "record_id", "paper_candidate_id", "gaia_source_id")),
        paper["arxiv_id"].alias("arxiv_id"),
        paper["month"].alias("month"),
        reported_by(label, year, paper["month"], paper["arxiv_id"]).alias("reported_by"),
        F.struct(*(value_text(core["observed_phase_space"][f]).alias(f) for f in OBSERVED)).alias("phase_space"),
        value_text(core["derived_kinematics"]["total_velocity"]).alias("total_velocity"),
        value_text(core["bound_assessment"]["unbound_probability"]).alias("unbound_probability"),
        F.coalesce(why["galactic_bound_claim"], F.lit("")).alias("bound_claim"),
        distinct_texts(why["paper_labels"]).alias("paper_labels"),
        F.coalesce(why["origin_type"], F.lit("")).alias("origin_type"),
        F.coalesce(why["extraction_confidence"], F.lit("")).alias("extraction_confidence"),
    )


def index_rows(objects: DataFrame, key: str) -> DataFrame:
    """One row an object: ids, months, number of sources, best values, context and coverage."""
    sources, cands = F.col("sources"), F.col("candidates")
    months = distinct_texts(F.transform(sources, lambda s: s["paper"]["month"]))
    best = [value_text(best_quantity(cands, "observed_phase_space", f)).alias(f) for f in OBSERVED]
    best += [value_text(best_quantity(cands, g, f)).alias(f) for g, f in (("derived_kinematics", "total_velocity"), ("bound_assessment", "unbound_probability"))]
    return objects.select(
        key,
        distinct_texts(F.transform(sources, lambda s: s["gaia_source_id"])).alias("gaia_source_ids"),
        distinct_texts(F.transform(sources, lambda s: s["paper_candidate_id"])).alias("paper_candidate_ids"),
        F.size(sources).alias("source_count"),
        F.coalesce(F.array_min(months), F.lit("")).alias("discovery_month"),
        F.struct(*best).alias("best"),
        context_summary(cands).alias("context"),
        coverage(cands).alias("coverage"),
    )


def dynamics_summary(d: Column) -> Column:
    """Status, posterior intervals as text and numbers, and the margin of the median speed over the median escape speed."""
    median = lambda f: d[f]["median"]
    text = lambda f: replies.interval_text(d[f]["median"], d[f]["p16"], d[f]["p84"])
    return F.struct(
        F.coalesce(d["status"], F.lit("not_computed")).alias("status"),
        F.coalesce(d["status_reason"], F.lit("")).alias("status_reason"),
        *(text(f).alias(f) for f in ("p_unbound_beta", "total_velocity_grf_kms", "escape_velocity_kms")),
        (median("total_velocity_grf_kms") - median("escape_velocity_kms")).alias("velocity_margin_kms"),
        F.coalesce(d["lower_limit"], F.lit(False)).alias("lower_limit"),
    )


# --- columns of the viewer --------------------------------------------------------------------------------------------


def item(kind: str, source: Column, value: Column, *numbers: Column) -> Column:
    """One shown value: where it comes from, its text, and the numbers that filters and sorting use."""
    some = F.filter(F.array(*(n.cast("double") for n in numbers)), lambda n: n.isNotNull() & ~F.isnan(n))
    return F.struct(F.lit(kind).alias("kind"), source.alias("source"), F.coalesce(value, F.lit("")).alias("value"), some.alias("numbers"))


def shown(items: Column) -> Column:
    return F.filter(items, lambda i: i["value"] != "")


def literature_items(candidates: Column, group: str, field: str) -> Column:
    """A core quantity as each source gives it."""

    def one(e: Column) -> Column:
        q = e["s"]["core"][group][field]
        return item("literature", e["source"], value_text(q), F.regexp_extract(q["value"], r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?", 0).try_cast("double"))

    return shown(F.transform(candidates, one))


def parameter_items(candidates: Column, field: str) -> Column:
    """A stellar parameter as each source gives it."""

    def one(e: Column) -> Column:
        q = e["s"]["stellar_parameters"][field]
        return item("literature", e["source"], value_text(q), q["value"].try_cast("double"))

    return shown(F.transform(candidates, one))


def spectral_type_items(candidates: Column) -> Column:
    """Spectral types as stellar parameters and as spectroscopy says them, each of a source once."""

    def seen(e: Column) -> Column:
        return F.transform(F.filter(e["s"]["spectroscopy"], lambda q: q["measurement_type"] == "spectral_type"), lambda q: item("literature", e["source"], F.coalesce(F.nullif(q["spectral_type"], F.lit("")), q["value"])))

    both = F.concat(parameter_items(candidates, "spectral_type"), F.flatten(F.transform(candidates, seen)))
    return F.array_distinct(F.transform(shown(both), lambda i: i.withField("numbers", F.array().cast("array<double>"))))


def metallicity_items(candidates: Column) -> Column:
    """Metallicities and iron abundances against hydrogen."""

    def iron(e: Column) -> Column:
        some = F.filter(e["s"]["abundances"], lambda a: (a["element"] == "Fe") & (a["reference_element"] == "H"))
        return F.transform(some, lambda a: item("literature", e["source"], value_text(a), a["value"].try_cast("double")))

    return F.concat(parameter_items(candidates, "metallicity"), shown(F.flatten(F.transform(candidates, iron))))


def interval_item(kind: str, source: Column, interval: Column, lower_limit: Column) -> Column:
    """A posterior interval: its text, with a mark if it is a lower limit, and its three numbers."""
    text = replies.interval_text(interval["median"], interval["p16"], interval["p84"])
    marked = F.when(F.coalesce(lower_limit, F.lit(False)) & (text != ""), F.concat(F.lit("≥ "), text)).otherwise(text)
    return item(kind, source, marked, interval["median"], interval["p16"], interval["p84"])


def pair_item(kind: str, source: Column, first: Column, second: Column) -> Column:
    """Two parts in one column, such as a position; empty unless both are there."""
    both = F.when((first != "") & (second != ""), F.concat_ws(", ", first, second))
    return item(kind, source, both, first.try_cast("double"), second.try_cast("double"))


def search_text(*parts: Column) -> Column:
    """What a free search looks in: all texts of a row, in lower case."""
    return F.lower(F.concat_ws(" ", *parts))


def ordered_papers(entries: Column, mode: str) -> Column:
    """Papers (month, citations, label) by mode: earliest, latest or most cited first; ties by label."""
    if mode not in ("earliest", "latest", "cited"):
        raise ValueError(f"no such order: {mode}")
    month = lambda e: F.coalesce(F.nullif(e["month"], F.lit("")), F.lit("9999-99" if mode == "earliest" else "0000-00"))
    key = {"earliest": lambda e: F.struct(month(e).alias("a"), e["label"].alias("b")), "latest": lambda e: F.struct(F.translate(month(e), "0123456789", "9876543210").alias("a"), e["label"].alias("b")), "cited": lambda e: F.struct((-F.coalesce(e["citations"], F.lit(-1)).cast("bigint")).alias("a"), e["label"].alias("b"))}[mode]
    keyed = F.array_sort(F.transform(entries, lambda e: F.struct(key(e).alias("k"), e.alias("e"))))
    return F.transform(keyed, lambda x: x["e"])


def selected_reporter(entries: Column, mode: str) -> Column:
    """The label of the paper that comes first."""
    return F.get(ordered_papers(entries, mode), F.lit(0))["label"]


def range_errors(low: Column, high: Column, least: Column, most: Column) -> Column:
    """What is wrong with the texts of a range filter: no numbers, outside of what there is, or the wrong way round."""
    a, z = F.trim(low).try_cast("double"), F.trim(high).try_cast("double")
    bad = lambda t, v: (F.coalesce(F.trim(t), F.lit("")) != "") & v.isNull()
    return F.array_compact(
        F.array(
            F.when(bad(low, a), "minimum is no number"),
            F.when(bad(high, z), "maximum is no number"),
            F.when((a < least) | (a > most), "minimum outside the data"),
            F.when((z < least) | (z > most), "maximum outside the data"),
            F.when(a > z, "minimum above maximum"),
        )
    )


def route(fragment: Column) -> Column:
    """struct<object_id, source> of a link fragment `#/object/<id>/<source>`; null for another."""
    v = F.coalesce(fragment, F.lit(""))
    ident = F.regexp_extract(v, r"^#?/?object/([^/]+)", 1)
    return F.when(ident != "", F.struct(F.url_decode(ident).alias("object_id"), F.regexp_extract(v, r"^#?/?object/[^/]+/([^/]+)", 1).alias("source")))


# --- Markdown ---------------------------------------------------------------------------------------------------------


def table_line(*cells: Column) -> Column:
    """One row of a Markdown table; bars and line ends in cells are escaped."""
    safe = (F.regexp_replace(tx.escape_pipe(c.cast("string")), r"\s*\n\s*", " ") for c in cells)
    return F.concat(F.lit("| "), F.concat_ws(" | ", *safe), F.lit(" |"))


def markdown(df: DataFrame, group: list[str], order: list[str], head: dict[str, str], title: Column) -> DataFrame:
    """group and text: a titled Markdown table of each group's rows in order; head: column names and their headings."""
    line = table_line(*(F.col(c) for c in head))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, line.alias("_line")))), lambda x: x["_line"]), "\n")
    top = f"| {' | '.join(head.values())} |\n|{'|'.join(' --- ' for _ in head)}|\n"
    g = df.groupBy(*group).agg(lines.alias("_t"), F.count("*").alias("n"))
    return g.select(*group, F.concat(F.lit("# "), title, F.lit("\n\n"), F.lit(top), F.col("_t"), F.lit("\n")).alias("text"))


def ecsv(names: list[str], rows: Column, description: Column) -> Column:
    """A parsed table (array<array<string>>) as ECSV text: a commented header with all columns as text, then the rows by spaces."""
    quote = lambda v: F.when(v.rlike(r"[\s\"']") | (v == ""), F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(v)
    head = "# %ECSV 1.0\n# ---\n# datatype:\n" + "".join(f"# - {{name: {n}, datatype: string}}\n" for n in names)
    body = F.array_join(F.transform(rows, lambda r: F.array_join(F.transform(r, lambda v: quote(F.coalesce(v, F.lit("")))), " ")), "\n")
    return F.concat(F.lit(head), F.lit("# meta: {description: "), F.to_json(F.array(description)), F.lit("}\n" + " ".join(names) + "\n"), body, F.when(F.size(rows) > 0, "\n").otherwise(""))


def external_dependencies(html: Column) -> Column:
    """Whether a page loads a script, style sheet, image, frame or style import from another host."""
    out = F.lit(False)
    for pattern in (r"<script\b[^>]*\bsrc\s*=\s*[\"']?(?:https?:)?//", r"<link\b[^>]*\bhref\s*=\s*[\"']?(?:https?:)?//", r"<img\b[^>]*\bsrc\s*=\s*[\"']?(?:https?:)?//", r"<iframe\b[^>]*\bsrc\s*=\s*[\"']?(?:https?:)?//", r"@import\s+(?:url\()?[\"']?(?:https?:)?//"):
        out = out | html.rlike(f"(?i){pattern}")
    return out
