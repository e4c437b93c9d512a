"""Reviews, extractions and providers: their checks, counters by year and in total, verification, selection and migration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers as nm
from ..functions import sky
from ..functions import text as tx
from . import checks
from .rules import Rule

#: Statuses of extractions and files that count as success.
EXTRACTION = ("success", "partial", "failed", "not_started", "not_applicable")
FILES_DONE = ("success", "skipped_existing", "would_write", "written")
#: Arcseconds beyond which a provider's position does not agree with the literature's.
RADIUS = 5.0


def review_rules(tables: Column, resources: Column, status: Column, summary: Column, complete: bool) -> list[Rule]:
    """Rules of a catalogue review: ids once, references, web addresses, and in a complete one filled fields.

    tables: array<struct<id, asset_type, role_in_paper, evidence, columns array<struct<meaning>>, source_refs>>; resources:
    array<struct<id, url, description, evidence, source_refs>>.
    """
    ids = lambda xs: F.transform(xs, lambda x: x["id"])
    twice = lambda xs: F.size(F.array_distinct(ids(xs))) < F.size(xs)
    none = lambda x: F.coalesce(F.size(x["source_refs"]), F.lit(0)) < 1
    open_ = F.lit(complete) & ~status.eqNullSafe(F.lit("source_missing"))
    empty = lambda xs, f: open_ & F.exists(xs, lambda x: checks.blank(x[f]))
    return [
        Rule("table_twice", twice(tables), "a table id occurs twice"),
        Rule("table_unsourced", F.exists(tables, none), "a table without a source reference"),
        Rule("resource_twice", twice(resources), "a resource id occurs twice"),
        Rule("resource_url", F.exists(resources, lambda x: (F.coalesce(x["url"], F.lit("")) != "") & ~x["url"].rlike("^https?://")), "not a web address"),
        Rule("needs_review", F.lit(complete) & (status == "needs_review"), "not complete"),
        Rule("summary_missing", open_ & checks.blank(summary), "no summary"),
        *(Rule(f"table_{f}_missing", empty(tables, f), f"a table without {f}") for f in ("asset_type", "role_in_paper", "evidence")),
        Rule("column_meaning_missing", open_ & F.exists(tables, lambda x: F.coalesce(F.exists(x["columns"], lambda y: checks.blank(y["meaning"])), F.lit(False))), "a column without a meaning"),
        Rule("resource_description_missing", empty(resources, "description"), "a resource without a description"),
        Rule("resource_evidence_missing", open_ & F.exists(resources, lambda x: checks.blank(x["evidence"]) & ~none(x)), "a resource without evidence"),
    ]


def url_in_lines(url: Column, lines: Column, start: Column, end: Column) -> Column:
    """Whether a resource's address stands in the lines that it cites; true without an address or readable lines."""
    chosen = checks.line_range(lines, start, end)
    return F.coalesce((F.coalesce(url, F.lit("")) == "") | F.array_join(chosen, "\n").contains(url), F.lit(True))


def extraction_rules(status: Column, digest: Column, found: Column, rows_: Column, columns: Column, said_rows: Column, said_columns: Column) -> list[Rule]:
    """Rules of an extracted table: its excerpt's hash and the counts of the file that was written. found: the excerpt's text."""
    written = status.isin("success", "skipped_existing", "written")
    return [
        Rule("excerpt_missing", written & found.isNull(), "the excerpt does not exist"),
        Rule("hash", written & (F.coalesce(digest, F.lit("")) != "") & (F.sha2(found, 256) != digest), "the hash is another excerpt's"),
        Rule("row_count", written & ~rows_.eqNullSafe(said_rows), "another number of rows"),
        Rule("column_count", written & ~columns.eqNullSafe(said_columns), "another number of columns"),
    ]


def run_status(done: Column, failed: Column, work: Column) -> Column:
    """success, partial, skipped or failed, by what a run did."""
    return F.when((done > 0) & (failed == 0), "success").when(done > 0, "partial").when(work == 0, "skipped").otherwise("failed")


def provider_status(a: Column, b: Column, failures: Column) -> Column:
    """Status over two providers' statuses and the number of failed queries."""
    matched = F.coalesce(a == "matched", F.lit(False)) | F.coalesce(b == "matched", F.lit(False))
    return F.when(matched & (failures > 0), "partial").when(matched, "success").when(failures > 0, "failed").otherwise("not_found")


def index_counters(papers: DataFrame, year: str) -> DataFrame:
    """Counters by year and over all (year null, total true) of reviewed papers, by one rollup.

    papers: year, review_status, extraction_status, n_tables, n_resources, warned, manifest, tables_done, tables_failed.
    """
    n = lambda c: F.count(F.when(c, 1))
    s = F.coalesce("extraction_status", F.lit(""))
    counters = {
        "paper_count": F.count("*"),
        "reviewed_count": n(F.col("review_status") == "reviewed"),
        "needs_review_count": n(F.col("review_status").isin("needs_review", "partial", "unknown")),
        "has_internal_table_count": n(F.col("n_tables") > 0),
        "has_data_asset_count": n((F.col("n_tables") > 0) | (F.col("n_resources") > 0)),
        "internal_table_count": F.sum(F.coalesce("n_tables", F.lit(0))),
        "external_resource_count": F.sum(F.coalesce("n_resources", F.lit(0))),
        "review_status_warning_count": n(F.col("warned")),
        "extraction_manifest_count": n(F.col("manifest")),
        **{f"extraction_{x}_count": n((s == x) | (F.lit(x == "failed") & ~s.isin(*EXTRACTION))) for x in EXTRACTION},
        "table_success_count": F.sum(F.coalesce("tables_done", F.lit(0))),
        "table_failed_count": F.sum(F.coalesce("tables_failed", F.lit(0))),
    }
    known = papers.withColumn(year, F.coalesce(F.nullif(F.col(year), F.lit("")), F.lit("unknown")))
    return known.rollup(year).agg(F.grouping(year).cast("boolean").alias("total"), *(c.cast("bigint").alias(k) for k, c in counters.items()))


def status_count(items: Column, statuses: tuple[str, ...]) -> Column:
    """How many members of an array have one of the statuses."""
    return F.size(F.filter(items, lambda i: F.coalesce(i["status"], F.lit("")).isin(*statuses)))


def histograms(found: DataFrame, keys: list[str], label: Column, name: str) -> DataFrame:
    """keys, histogram, label and n of a scalar; empty ones count as unknown."""
    value = F.coalesce(F.nullif(label, F.lit("")), F.lit("unknown"))
    return found.groupBy(*keys, F.lit(name).alias("histogram"), value.alias("label")).agg(F.count("*").alias("n"))


def sample_values(values: Column, most: int = 5) -> Column:
    """The first values that are not blank, trimmed."""
    return F.slice(F.filter(F.transform(values, lambda v: F.trim(F.coalesce(v, F.lit("")))), lambda v: v != ""), 1, most)


def verified(objects: DataFrame) -> DataFrame:
    """Adds to objects (names, gaia_numbers, ra, dec, main names and position of two providers) what agrees with the literature.

    alias_matches: literature names among the first provider's; gaia_match: the second's id among the literature's; the
    separations of both in arcseconds; warnings about another id and about positions too far away.
    """
    fold = lambda xs: F.transform(F.coalesce(xs, F.array().cast("array<string>")), tx.alias)
    theirs = fold(F.col("provider_names"))
    hits = F.array_sort(F.filter("names", lambda v: F.array_contains(theirs, tx.alias(v))))
    number = F.coalesce("provider_number", F.lit(""))
    gaia = (number != "") & F.array_contains("gaia_numbers", number)
    one = F.round(sky.separation(F.col("ra"), F.col("dec"), F.col("ra1"), F.col("dec1")), 6)
    two = F.round(sky.separation(F.col("ra"), F.col("dec"), F.col("ra2"), F.col("dec2")), 6)
    other = (number != "") & (F.size("gaia_numbers") > 0) & ~gaia
    notes = F.array_compact(F.array(F.when(other, "source_id_mismatch"), F.when(one > RADIUS, "first_provider_far"), F.when(two > RADIUS, "second_provider_far")))
    return objects.withColumns({"alias_matches": hits, "identifier_match": (F.size("names") > 0) & (F.size(hits) > 0), "gaia_match": gaia, "separation1": one, "separation2": two, "warnings": notes})


def differences(literature: DataFrame, official: DataFrame, key: str) -> DataFrame:
    """key, source, field, literature_value, official_value, difference and unit: every literature value against every official
    value of its field, in numbers found in the texts; what holds no number is left out."""
    o = official.select(F.col(key).alias("_k"), F.col("field").alias("_f"), F.col("value").alias("official_value"), F.col("unit").alias("_u"))
    j = literature.join(o, (F.col(key) == F.col("_k")) & (F.col("field") == F.col("_f")))
    a, b = nm.first_number(F.col("value")), nm.first_number(F.col("official_value"))
    unit = F.coalesce(F.nullif(F.col("_u"), F.lit("")), F.nullif(F.col("unit"), F.lit("")), F.lit(""))
    return j.where(a.isNotNull() & b.isNotNull()).select(key, "source", "field", F.col("value").alias("literature_value"), "official_value", F.round(a - b, 12).alias("difference"), unit.alias("unit"))


def chosen_row(rows_: DataFrame, key: str, wanted: str, ident: str, order: str) -> DataFrame:
    """One row a key: the first whose id is the wanted one, else the only row; keys with several others have none."""
    hit = F.trim(F.col(ident)) == F.col(wanted)
    row = F.struct(*(c for c in rows_.columns if c != key))
    g = rows_.groupBy(key).agg(F.min_by(F.when(hit, row), F.when(hit, F.col(order))).alias("hit"), F.count("*").alias("n"), F.min_by(row, F.col(order)).alias("only"))
    best = F.coalesce("hit", F.when(F.col("n") == 1, F.col("only")))
    return g.select(key, best.alias("r")).where("r is not null").select(key, "r.*")


def priors_for(objects: DataFrame, priors: DataFrame, source_id: str) -> DataFrame:
    """objects with the distance prior of their sky cell (alpha, beta, length in kpc), null where it is missing or not positive.

    priors: cell, file order and three texts; of a cell the last row that can be read counts. There is one row a cell, of which
    level 5 has 12 288, so the table is broadcast.
    """
    p = priors.select("cell", "place", *(F.col(c).try_cast("double").alias(c) for c in ("alpha", "beta", "length_pc"))).where("alpha is not null and beta is not null and length_pc is not null and cell between 0 and 12287")
    last = p.groupBy("cell").agg(F.max_by(F.struct("alpha", "beta", (F.col("length_pc") * 1e-3).alias("length_kpc")), "place").alias("p"))
    cell = sky.healpix5(F.col(source_id))
    j = objects.withColumn("_c", cell).join(F.broadcast(last), F.col("_c") == F.col("cell"), "left").drop("_c", "cell")
    ok = (F.col("p.alpha") > 0) & (F.col("p.length_kpc") > 0)
    return j.select(*objects.columns, *(F.when(ok, F.col(f"p.{f}")).alias(f) for f in ("alpha", "beta", "length_kpc")))


def complexity(files: DataFrame, folder: str, text: str) -> DataFrame:
    """folder, n_tables and max_rows: table environments in the files of a folder, and the row ends of the longest block."""
    t = F.coalesce(F.col(text), F.lit(""))
    begun = F.size(F.regexp_extract_all(t, F.lit(r"\\begin\{(deluxetable\*?|table\*?|longtable)\}"), F.lit(1)))
    blocks = F.regexp_extract_all(t, F.lit(r"(?s)\\begin\{(tabular\*?|array|deluxetable\*?|longtable)\}(.*?)\\end\{\1\}"), F.lit(2))
    ends = F.transform(blocks, lambda b: ((F.length(b) - F.length(F.replace(b, F.lit("\\\\"), F.lit("")))) / 2).cast("int"))
    return files.groupBy(folder).agg(F.sum(begun).alias("n_tables"), F.max(F.coalesce(F.array_max(ends), F.lit(0))).alias("max_rows"))


def usage(calls: DataFrame, keys: list[str]) -> DataFrame:
    """Token counters of calls (prompt_tokens, completion_tokens, total_tokens), summed; missing ones count as 0."""
    return calls.groupBy(*keys).agg(*(F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in ("prompt_tokens", "completion_tokens", "total_tokens")), F.count("*").alias("calls"))


def version_agreement(manifest: Column, page: Column) -> Column:
    """true, false, or null where either version is unknown."""
    return manifest == page


def filled(df: DataFrame, field: str, other: DataFrame, key: str) -> DataFrame:
    """df with an empty field taken from other (key, field); `updated` says where. Filled ones stay."""
    o = other.select(F.col(key).alias("_k"), F.col(field).alias("_v")).dropDuplicates(["_k"])
    empty = F.coalesce(F.trim(field), F.lit("")) == ""
    j = df.join(o, F.col(key) == F.col("_k"), "left").withColumn("updated", empty & (F.coalesce("_v", F.lit("")) != ""))
    return j.withColumn(field, F.when(F.col("updated"), F.col("_v")).otherwise(F.col(field))).drop("_k", "_v")


def migrated(docs: DataFrame, versions: dict[str, str], version: str, tooling: str) -> DataFrame:
    """docs with versions rewritten and missing tooling filled; `changes` counts both, and a second run changes nothing."""
    old = F.col(version)
    new = old
    for a, b in versions.items():
        new = F.when(old == a, b).otherwise(new)
    bare = F.col(tooling).isNull()
    return docs.withColumn("changes", F.when(~old.eqNullSafe(new), 1).otherwise(0) + bare.cast("int")).withColumn(version, new).withColumn(tooling, F.coalesce(tooling, F.lit("legacy")))


def merged_batches(scaffold: DataFrame, batches: DataFrame, key: str) -> DataFrame:
    """scaffold with `candidates`: the records of its batches (key, batch, place, record), in roster order."""
    one = batches.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("batch", "place", "record"))).alias("_b"))
    return scaffold.join(one, key, "left").withColumn("candidates", F.coalesce(F.transform("_b", lambda b: b["record"]), F.array().cast("array<string>"))).drop("_b")


def source_order(month: Column, arxiv_id: Column, record_id: Column, path: Column) -> Column:
    """The total order of contributions: by month (missing last), paper, record and path."""
    none = lambda c: F.coalesce(c, F.lit(""))
    return F.struct(F.coalesce(F.nullif(month, F.lit("")), F.lit("9999-99")).alias("a"), none(arxiv_id).alias("b"), none(record_id).alias("c"), none(path).alias("d"))
