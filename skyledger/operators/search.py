"""Search hits: normalising two response shapes, canonical paper records, relevance and title triage, month windows, upserts.

A raw hit is a JSON text, as remote sources return them; every function is a column over that text, so a scan of hits is one
projection whatever the shape of its fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx

#: Relevance rules over title, abstract, summary and keywords, and title rules, in their order.
RELEVANCE = (
    ("hypervelocity star", r"(?i)\bhyper[-\s]?velocity\s+stars?\b|\bHVSs?\b"),
    ("high-velocity star", r"(?i)\bhigh[-\s]?velocity\s+(?:candidate\s+)?stars?\b|\bstars?\s+with\s+galactocentric\s+velocit(?:y|ies)\b|\bstars?\s+with\s+space\s+velocit(?:y|ies)\b"),
    ("runaway star", r"(?i)\b(?:OB\s+)?runaway\s+stars?\b"),
    ("fast-moving star", r"(?i)\bfast[-\s]?moving\s+stars?\b"),
    ("unbound star", r"(?i)\bunbound\s+stars?\b|\bescaping\s+stars?\b"),
    ("peculiar-velocity star", r"(?is)\bpeculiar\s+velocit(?:y|ies)\b.{0,100}\bstars?\b|\bstars?\b.{0,100}\bpeculiar\s+velocit(?:y|ies)\b"),
)
_SOME = r"(?:[A-Za-z0-9+/-]+\s+){0,4}stars?\b"
TITLES = (
    ("hypervelocity stars", r"(?i)\bhyper[-\s]?velocity\s+stars?\b|\bHVSs?\b"),
    ("high-velocity or extreme-velocity stars", rf"(?i)\b(?:high|extreme)[-\s]?velocity\s+{_SOME}|\bhigh\s+radial\s+velocity\s+{_SOME}|\bHRV\s+stars?\b|\b(?:fastest|fast)\s+stars?\s+in\s+the\s+galax(?:y|ies)\b"),
    ("runaway stars", r"(?i)\b(?:hyper[-\s]?runaway|(?:OB|B[-\s]?type|O[-\s]?type)?\s*runaway)\s+stars?\b"),
    ("unbound, escaping, or ejected stars", rf"(?is)\b(?:unbound|escaping|ejected)\s+{_SOME}|\bstars?\s+ejected\s+(?:from|by)\b|\bgalactic\s+cent(?:er|re)[-\s]?ejected\s+stars?\b|\bSgr\s*A\*?.{{0,80}}\bstars?\s+ejected\b"),
    ("stellar escapers", r"(?i)\bstellar\s+escapers?\b|\bwalkaway\s+stars?\b"),
    ("high-velocity star surveys or candidates", rf"(?is)\b(?:candidate|candidates|survey|surveys|search|searching|census|catalog(?:ue)?)\b.{{0,80}}\b(?:hyper[-\s]?velocity|high[-\s]?velocity|high\s+radial\s+velocity|extreme[-\s]?velocity|unbound)\s+{_SOME}"),
)
#: Fields of a hit that the record has places for; others are kept as they are.
KNOWN = (
    "id", "arxiv_id", "title", "abstract", "summary", "author_names", "authors", "categories", "publish_at", "published_at", "published", "updated_at", "updated", "score",
    "citation", "citations", "keywords", "source", "tldr",
)


def raw(h: Column, name: str) -> Column:
    return F.get_json_object(h, f"$.{name}")


def as_list(h: Column, name: str) -> Column:
    """A list field as it is, a scalar as a list of one, nothing as an empty list."""
    v = raw(h, name)
    return F.when(v.startswith("["), F.from_json(v, "array<string>")).when(F.trim(v) != "", F.array(F.trim(v))).otherwise(F.array().cast("array<string>"))


def as_text(h: Column, name: str) -> Column:
    """A list field joined by commas without its empty members, a scalar as it is, nothing as empty text."""
    v = raw(h, name)
    joined = F.array_join(F.filter(F.from_json(v, "array<string>"), lambda x: F.coalesce(x, F.lit("")) != ""), ", ")
    return F.coalesce(F.when(v.startswith("["), joined).otherwise(v), F.lit(""))


def first(h: Column, *names: str, default: str = "") -> Column:
    """The first of the fields that is not blank, trimmed."""
    return F.coalesce(*(F.nullif(F.trim(as_text(h, n)), F.lit("")) for n in names), F.lit(default))


def number(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit("")).try_cast("double")


def unwrapped(responses: DataFrame, body: str) -> DataFrame:
    """One row a hit of responses in either envelope (`results` and `total`, or `result` and `total_count`): total and hit."""
    b = F.col(body)
    hits = F.from_json(F.coalesce(raw(b, "results"), raw(b, "result"), F.lit("[]")), "array<string>")
    total = F.coalesce(raw(b, "total"), raw(b, "total_count")).try_cast("bigint")
    return responses.select(*responses.columns, F.coalesce(total, F.size(hits).cast("bigint")).alias("total"), F.posexplode_outer(hits).alias("place", "hit"))


def result_item(h: Column) -> Column:
    """A hit under canonical names: date as publish_at, citation_count as citations, author objects as their names."""
    people = F.from_json(raw(h, "authors"), "array<map<string,string>>")
    names = F.array_join(F.filter(F.transform(people, lambda a: a["name"]), lambda n: F.coalesce(n, F.lit("")) != ""), ", ")
    return F.struct(
        first(h, "arxiv_id", "id").alias("arxiv_id"),
        as_text(h, "title").alias("title"),
        first(h, "publish_at", "date").alias("publish_at"),
        first(h, "citations", "citation", "citation_count").alias("citations"),
        F.coalesce(F.nullif(as_text(h, "author_names"), F.lit("")), F.nullif(names, F.lit("")), F.lit("")).alias("author_names"),
    )


def source_fields(h: Column) -> Column:
    """The fields that the record has no place for; names that begin with an underscore are internal."""
    return F.map_filter(F.from_json(h, "map<string,string>"), lambda k, v: ~k.startswith("_") & ~k.isin(*KNOWN))


def paper_record(h: Column, source: str, run_id: str) -> Column:
    """The canonical record of a hit."""
    ident, abstract = first(h, "arxiv_id", "id"), first(h, "abstract", "summary")
    best, found = number(first(h, "_best_score", "score")), first(h, "_search_source", default=source)
    link = lambda kind: F.when(ident != "", F.concat(F.lit(f"https://arxiv.org/{kind}/"), ident)).otherwise("")
    return F.struct(
        ident.alias("arxiv_id"),
        first(h, "title", default="Untitled").alias("title"),
        as_list(h, "authors").alias("authors"),
        first(h, "author_names", "authors").alias("author_names"),
        as_list(h, "categories").alias("categories"),
        first(h, "publish_at", "published_at", "published").alias("published_at"),
        first(h, "updated_at", "updated").alias("updated_at"),
        F.struct(link("abs").alias("abs"), link("pdf").alias("pdf")).alias("links"),
        F.struct(F.when(abstract != "", found).alias("source"), abstract.alias("text")).alias("abstract"),
        F.struct(as_list(h, "_matched_queries").alias("queries"), as_list(h, "_matched_categories").alias("categories"), best.alias("best_score")).alias("match"),
        F.struct(number(raw(h, "score")).alias("score"), best.alias("best_score"), raw(h, "keywords").alias("search_keywords"), first(h, "citations", "citation").alias("citations")).alias("ranking"),
        F.struct(
            found.alias("search_source"), F.lit(run_id).alias("run_id"), F.when(found != source, F.lit(source)).alias("configured_search_source"), F.nullif(first(h, "_fallback_from"), F.lit("")).alias("fallback_from")
        ).alias("provenance"),
        source_fields(h).alias("source_fields"),
    )


def triage_record(h: Column, source: str, run_id: str) -> Column:
    """The canonical record with its title triage and, where there was one, its review."""
    t = lambda part, *names: F.struct(*(number(raw(h, f"{part}.{n}")).alias(n) if n == "confidence" else first(h, f"{part}.{n}").alias(n) for n in names))
    review = F.when(raw(h, "_review").isNotNull() & (raw(h, "_review") != "{}"), t("_review", "status", "confidence", "reason", "model", "reviewed_at"))
    return F.struct(paper_record(h, source, run_id).alias("paper"), t("_title_triage", "label", "confidence", "reason").alias("title_triage"), review.alias("review"))


def paper_text(h: Column) -> Column:
    """What relevance is judged by: title, abstract, summary and keywords, cleaned, a line each."""
    parts = [F.nullif(as_text(h, n), F.lit("")) for n in ("title", "abstract", "tldr", "keywords")]
    return F.concat_ws("\n", *(cleaned(p) for p in parts))


def cleaned(c: Column) -> Column:
    """Entities become their characters, then tags become spaces; null stays null."""
    v = c
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&nbsp;", "\u00a0"), ("&amp;", "&")):
        v = F.replace(v, F.lit(entity), F.lit(char))
    return F.regexp_replace(v, "<[^>]+>", " ")


def labels(text: Column, rules_: tuple[tuple[str, str], ...]) -> Column:
    """Names of all rules that a text matches, in their order."""
    return F.array_compact(F.array(*(F.when(text.rlike(pattern), name) for name, pattern in rules_)))


def title_decision(title: Column) -> Column:
    """struct<include, confidence, reason, label> by the title alone."""
    found = labels(F.coalesce(cleaned(title), F.lit("")), TITLES)
    yes = F.size(found) > 0
    reason = F.when(yes, F.concat(F.lit("Rule-related title match: "), F.array_join(found, ", "))).otherwise("Title does not contain a clear high-velocity-star rule match.")
    return F.struct(yes.alias("include"), F.when(yes, 0.95).otherwise(0.4).alias("confidence"), reason.alias("reason"), F.when(yes, "rule-related").otherwise("no-clear-title-evidence").alias("label"))


def category_matches(categories: Column, allowed: list[str]) -> Column:
    """Whether a category is allowed; members may list several by space or comma. No allowed ones, or no known ones, pass."""
    parts = F.filter(F.flatten(F.transform(categories, lambda x: F.split(x, r"[\s,]+"))), lambda x: x != "")
    if not allowed:
        return F.lit(True)
    return F.coalesce(F.size(categories) <= 0, F.lit(True)) | F.coalesce(F.arrays_overlap(parts, F.array(*map(F.lit, allowed))), F.lit(False))


def score_matches(score: Column, least: float | None) -> Column:
    """Whether a score (text or number, missing as 0) reaches the least; what is no number fails; no least passes."""
    if least is None:
        return F.lit(True)
    return F.coalesce(F.coalesce(F.nullif(F.trim(score.cast("string")), F.lit("")), F.lit("0")).try_cast("double") >= least, F.lit(False))


def moment(c: Column) -> Column:
    """A date or time of the forms `Y-m-d H:M:S`, `Y-m-dTH:M:S` or `Y-m-d`, read from the start of the text; null if none fits."""
    v = F.coalesce(c, F.lit(""))
    at = F.regexp_extract(v, r"^(\d{4}-\d{1,2}-\d{1,2})[ T](\d{1,2}:\d{1,2}:\d{1,2})", 0)
    day = F.regexp_extract(v, r"^\d{4}-\d{2}-\d{2}", 0)
    return F.coalesce(F.try_to_timestamp(F.replace(at, F.lit("T"), F.lit(" ")), F.lit("yyyy-M-d H:m:s")), F.try_to_timestamp(day, F.lit("yyyy-MM-dd")))


def publication_date(h: Column) -> Column:
    """Day of the first of the three date fields that can be read."""
    return F.coalesce(*(moment(raw(h, n)) for n in ("publish_at", "published_at", "published"))).cast("date")


def backfilled(hits: DataFrame, metadata: DataFrame, fields: tuple[str, ...], published: str = "published_at") -> DataFrame:
    """hits (arxiv_id, fields) with empty fields filled from metadata of the same id, `status` of the fill and `applied` fields."""
    other = metadata.select(F.col("arxiv_id").alias("_id"), *(F.col(f).alias(f"_{f}") for f in fields)).dropDuplicates(["_id"])
    j = hits.join(other, F.col("arxiv_id") == F.col("_id"), "left")
    empty = lambda f: F.coalesce(F.col(f).cast("string"), F.lit("")) == ""
    known = moment(F.col(published)).isNotNull()
    use = {f: ~known & empty(f) & F.col(f"_{f}").isNotNull() & (F.col(f"_{f}").cast("string") != "") for f in fields}
    applied = F.array_compact(F.array(*(F.when(use[f], F.lit(f)) for f in fields)))
    after = moment(F.when(use[published], F.col(f"_{published}")).otherwise(F.col(published))).isNotNull()
    status = (
        F.when(known, "not_needed").when(F.coalesce(F.col("arxiv_id"), F.lit("")) == "", "missing_arxiv_id").when(F.col("_id").isNull(), "no_metadata").when(after, "publication_backfilled").otherwise("no_publication_date")
    )
    rest = [c for c in hits.columns if c not in fields]
    return j.select(*rest, *(F.when(use[f], F.col(f"_{f}")).otherwise(F.col(f)).alias(f) for f in fields), status.alias("status"), applied.alias("applied"))


def months_between(spark, first_day: str, last_day: str) -> DataFrame:
    """month, date_from, date_to: calendar months clipped to the range."""
    a, z = F.lit(first_day).cast("date"), F.lit(last_day).cast("date")
    x = spark.range(1).select(F.explode(F.sequence(F.trunc(a, "MM"), z, F.expr("interval 1 month"))).alias("m"))
    return x.select(F.date_format("m", "yyyy-MM").alias("month"), F.greatest("m", a).alias("date_from"), F.least(F.last_day("m"), z).alias("date_to"))


def era_categories(month: Column, categories: list[str], legacy: str, last_legacy: str, transition: str) -> Column:
    """Categories to search in a month: the old one up to its last month, both in the transition, then the new ones."""
    new = F.array(*map(F.lit, categories))
    return F.when(month <= last_legacy, F.array(F.lit(legacy))).when(month == transition, F.concat(F.array(F.lit(legacy)), new)).otherwise(new)


def era_queries(month: Column, queries: list[str], extra: list[str], last_legacy: str) -> Column:
    """Queries of a month: early ones have further spellings, each once."""
    own = F.array(*map(F.lit, queries))
    return F.when(month > last_legacy, own).otherwise(F.array_union(own, F.array(*map(F.lit, extra))))


def newest_layout(files: DataFrame, path: str = "path") -> DataFrame:
    """month and path of the month files: `Y/Y-m/` is the new layout, `Y-m/` the old one; of a month the new one wins."""
    p = F.col(path)
    new = F.regexp_extract(p, r"(?:^|/)(\d{4})/(\1-\d{2})/[^/]+\.json$", 2)
    old = F.regexp_extract(p, r"(?:^|/)(\d{4}-\d{2})/[^/]+\.json$", 1)
    x = files.select(F.when(new != "", new).otherwise(old).alias("month"), p.alias("path"), F.when(new != "", 0).otherwise(1).alias("_rank")).where("month <> ''")
    return x.groupBy("month").agg(F.min_by("path", F.struct("_rank", "path")).alias("path"))


def without_reserved(files: DataFrame, name: str, reserved: tuple[str, ...], path: str = "path") -> DataFrame:
    """Files of one name, one folder down, but not in a reserved folder, by path."""
    p = F.col(path)
    parent = F.element_at(F.split(p, "/"), -2)
    return files.where((F.element_at(F.split(p, "/"), -1) == name) & ~parent.isin(*reserved)).orderBy(path)


def selected_ids(papers: DataFrame, month_from: str | None, month_to: str | None) -> DataFrame:
    """arxiv_id and place of first sight of the papers (month, place, arxiv_id, flag) in a range of months whose flag is true."""
    some = papers.where(F.col("flag").eqNullSafe(F.lit(True)))
    if month_from:
        some = some.where(F.col("month") >= month_from)
    if month_to:
        some = some.where(F.col("month") <= month_to)
    return some.groupBy("arxiv_id").agg(F.min(F.struct("month", "place")).alias("at")).select("arxiv_id", "at.month", "at.place")


def review_leaders(papers: DataFrame, score: str, published: str, key: str, k: int) -> DataFrame:
    """papers with `review`: the first k by score, then date, are `selected`, the others `skipped`. Missing ones come last."""
    order = [F.coalesce(F.col(score).try_cast("double"), F.lit(0.0)).desc(), F.coalesce(moment(F.col(published)), F.lit("0001-01-01").cast("timestamp")).desc(), F.col(key)]
    lead = papers.orderBy(*order).limit(k).select(F.col(key).alias("_k")).distinct()
    j = papers.join(F.broadcast(lead), F.col(key).eqNullSafe(F.col("_k")), "left")
    return j.withColumn("review", F.when(F.col("_k").isNotNull(), "selected").otherwise("skipped")).drop("_k")


def decided(papers: DataFrame, decisions: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """papers with the decision of their id (confirmed, not_confirmed, missing), and the counts of each.

    decisions: key, include. Of several decisions on an id one that includes wins.
    """
    d = decisions.groupBy(F.col(key).alias("_k")).agg(F.max("include").alias("_i"))
    j = papers.join(d, F.col(key) == F.col("_k"), "left")
    out = j.withColumn("decision", F.when(F.col("_i").isNull(), "missing").when(F.col("_i"), "confirmed").otherwise("not_confirmed")).drop("_k", "_i")
    return out, out.groupBy("decision").agg(F.count("*").alias("n"))


def month_records(papers: DataFrame, month: str, order: list[str], **stats: Column) -> DataFrame:
    """One document a month: its papers in order, their number and further counters."""
    rest = F.struct(*order, *(c for c in papers.columns if c not in (month, *order)))
    return papers.groupBy(month).agg(F.array_sort(F.collect_list(rest)).alias("papers"), F.count("*").alias("n_papers"), *(c.alias(n) for n, c in stats.items()))


def latest_by(df: DataFrame, key: str, order: Column) -> DataFrame:
    """One row a key: the last in the order; later files overwrite earlier ones."""
    row = F.row_number().over(Window.partitionBy(key).orderBy(order.desc()))
    return df.withColumn("_r", row).where("_r = 1").drop("_r")


def meta_tags(html: Column) -> Column:
    """map<name, content> of the citation_* meta tags of a page, either attribute first; the first of a name counts."""
    one = F.regexp_extract_all(html, F.lit(r"(?i)<meta\b[^>]*\bname\s*=\s*[\"']?(citation_[a-z_]+)[^>]*>"), F.lit(0))
    pair = F.transform(one, lambda m: F.struct(F.lower(F.regexp_extract(m, r"(?i)\bname\s*=\s*[\"']?(citation_[a-z_]+)", 1)).alias("k"), tx.plain(F.regexp_extract(m, r"(?i)\bcontent\s*=\s*[\"']([^\"']*)[\"']", 1)).alias("v")))
    keys = F.array_distinct(F.transform(pair, lambda p: p["k"]))
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k, F.element_at(F.filter(pair, lambda p: p["k"] == k), 1)["v"])))


def tex_root(files: DataFrame, folder: str, path: str, text: str) -> DataFrame:
    """The likely main file of each folder: one with a document class, a begun document, a good name; ties by path."""
    t, p = F.coalesce(F.col(text), F.lit("")), F.col(path)
    score = t.rlike(r"\\documentclass").cast("int") * 4 + t.rlike(r"\\begin\{document\}").cast("int") * 2 + F.lower(p).rlike(r"(?:^|/)(?:main|ms|paper|manuscript)\.tex$").cast("int")
    return files.groupBy(folder).agg(F.min_by(path, F.struct(-score, p)).alias("root"))


def latest_version(html: Column, arxiv_id: Column) -> Column:
    """The largest version number that a page names for its id, null without one."""
    found = F.regexp_extract_all(html, F.lit(r"(\d{4}\.\d{4,5}v\d+)"), F.lit(1))
    own = F.filter(found, lambda x: x.startswith(F.concat(arxiv_id, F.lit("v"))))
    return F.array_max(F.transform(own, lambda x: F.substring_index(x, "v", -1).cast("int")))


def watermark_version(text: Column, arxiv_id: Column) -> Column:
    """The version in the margin of a first page, null without one."""
    found = F.regexp_extract_all(text, F.lit(r"(?i)arXiv:(\S+v\d+)"), F.lit(1))
    own = F.filter(found, lambda x: x.startswith(F.concat(arxiv_id, F.lit("v"))))
    return F.substring_index(F.get(own, F.lit(0)), "v", -1).try_cast("int")
