"""What a paper's sources offer: table blocks with caption and label, data files, feed entries, reviews of them, snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx

#: Environments that hold tables, and endings of files that machines read.
BLOCK = r"(?s)\\begin\{(table\*?|deluxetable\*?|longtable|sidewaystable\*?)\}.*?\\end\{\1\}"
SUFFIXES = (".csv", ".tsv", ".dat", ".txt", ".fits", ".fits.gz", ".vot", ".votable", ".xml", ".ecsv", ".mrt", ".json")


def uncommented(text: Column) -> Column:
    """LaTeX without its comments: each line up to the first percent sign that isn't escaped."""
    return F.regexp_replace(text, r"(?m)(?<!\\)((?:\\\\)*)%.*$", "$1")


def argument(text: Column, command: str) -> Column:
    """The braced argument of the first use of a command, up to three levels deep, as one line; empty without one."""
    inner = r"[^{}\\]|\\."
    for _ in range(3):
        inner = rf"(?:[^{{}}\\]|\\.|\{{(?:{inner})*+\}})"
    found = F.regexp_extract(text, rf"(?s)\\{command}\s*(?:\[[^\]]*\])?\s*\{{((?:{inner})*+)\}}", 1)
    return tx.collapse(found)


def table_blocks(text: Column) -> Column:
    """array<struct<environment, start_line, end_line, caption, label, excerpt>> of the table environments outside comments."""
    clean = uncommented(F.coalesce(text, F.lit("")))
    blocks, between = F.regexp_extract_all(clean, F.lit(BLOCK), F.lit(0)), F.split(clean, BLOCK, -1)
    ends = lambda v: F.length(v) - F.length(F.replace(v, F.lit("\n"), F.lit("")))
    pairs = F.filter(F.arrays_zip(between.alias("g"), blocks.alias("m")), lambda x: x["m"].isNotNull())
    kind = "array<struct<a:int,z:int,m:string>>"
    start = F.struct(F.lit(1).alias("line"), F.array().cast(kind).alias("out"))

    def step(s: Column, x: Column) -> Column:
        a = s["line"] + ends(x["g"])
        z = a + ends(x["m"])
        return F.struct(z.alias("line"), F.concat(s["out"], F.array(F.struct(a.alias("a"), z.alias("z"), x["m"].alias("m")))).alias("out"))

    placed = F.aggregate(pairs, start, step, lambda s: s["out"])

    def one(b: Column) -> Column:
        caption = F.coalesce(F.nullif(argument(b["m"], "caption"), F.lit("")), argument(b["m"], "tablecaption"))
        return F.struct(F.regexp_extract(b["m"], BLOCK, 1).alias("environment"), b["a"].alias("start_line"), b["z"].alias("end_line"), caption.alias("caption"), argument(b["m"], "label").alias("label"), b["m"].alias("excerpt"))

    return F.transform(placed, one)


def data_suffix(path: Column) -> Column:
    """Ending of a path if machines read such files, else null; `.fits.gz` is one ending."""
    name = F.lower(F.element_at(F.split(path, "/"), -1))
    end = F.when(name.endswith(".fits.gz"), ".fits.gz").otherwise(F.regexp_extract(name, r".(\.[^.]+)$", 1))
    return F.when(end.isin(*SUFFIXES), end)


def inventories(files: DataFrame, paper: str) -> DataFrame:
    """One row a paper: its table blocks (by path and line), data files and number of TeX files. files: paper, path, text."""
    tex = F.lower("path").endswith(".tex")
    found = files.select(paper, "path", tex.alias("tex"), data_suffix(F.col("path")).alias("suffix"), F.when(tex, table_blocks(F.col("text"))).alias("blocks"))
    blocks = F.flatten(F.collect_list(F.transform("blocks", lambda b: F.struct("path", *(b[f].alias(f) for f in ("start_line", "end_line", "environment", "caption", "label"))))))
    return found.groupBy(paper).agg(F.array_sort(blocks).alias("tables"), F.array_sort(F.collect_list(F.when(F.col("suffix").isNotNull(), F.struct("path", "suffix")))).alias("files"), F.count(F.when(F.col("tex"), 1)).alias("tex_file_count"))


def review_templates(found: DataFrame, paper: str) -> DataFrame:
    """paper, id, path, start_line, end_line of each table block, for a reviewer to fill: ids are labels or captions as slugs,
    numbered where they repeat within a paper."""
    x = found.select(paper, F.posexplode("tables").alias("place", "t")).select(paper, "place", "t.*")
    base = tx.slug(F.coalesce(F.nullif("label", F.lit("")), F.nullif(F.left("caption", F.lit(40)), F.lit("")), F.lit("table")), "._-", "-", "table")
    n = F.row_number().over(Window.partitionBy(paper, "_b").orderBy("place"))
    y = x.withColumn("_b", base).withColumn("_n", n)
    return y.select(paper, F.when(F.col("_n") > 1, F.concat_ws("-", "_b", F.col("_n").cast("string"))).otherwise(F.col("_b")).alias("id"), "path", "start_line", "end_line")


def reviewed(found: DataFrame, decisions: DataFrame, paper: str, reason: str = "not identified as an object catalogue") -> DataFrame:
    """Each item of an inventory (paper, id, ...) with its decision: selected, with the decision's fields, or rejected, with the
    reason that was given or a default one. decisions: paper, id, selected, reason; those on unknown ids are left out."""
    d = decisions.groupBy(F.col(paper).alias("_p"), F.col("id").alias("_i")).agg(F.max("selected").alias("_s"), F.min("reason").alias("_r"))
    j = found.join(d, (F.col(paper) == F.col("_p")) & (F.col("id") == F.col("_i")), "left")
    yes = F.coalesce("_s", F.lit(False))
    return j.withColumn("decision", F.when(yes, "selected").otherwise("rejected")).withColumn("reason", F.when(~yes, F.coalesce(F.nullif("_r", F.lit("")), F.lit(reason)))).drop("_p", "_i", "_s", "_r")


def feed_entry(xml: Column) -> Column:
    """The paper that a feed entry (one `<entry>` as text) describes: id without version, title, abstract, authors, categories with the
    primary one first, dates."""
    bare = F.regexp_replace(F.regexp_replace(xml, r"<(/?)[A-Za-z]+:", "<$1"), r"\sxmlns(?::\w+)?=\"[^\"]*\"", "")
    get = lambda path: tx.collapse(F.xpath_string(bare, F.lit(path)))
    authors = F.filter(F.transform(F.xpath(bare, F.lit("entry/author/name/text()")), tx.collapse), lambda a: a != "")
    terms = F.filter(F.xpath(bare, F.lit("entry/category/@term")), lambda c: c != "")
    primary = F.xpath_string(bare, F.lit("entry/primary_category/@term"))
    ident = tx.strip_version(F.substring_index(get("entry/id"), "/", -1))
    return F.struct(
        ident.alias("arxiv_id"),
        get("entry/title").alias("title"),
        get("entry/summary").alias("abstract"),
        authors.alias("authors"),
        F.when((primary != "") & ~F.array_contains(terms, primary), F.concat(F.array(primary), terms)).otherwise(terms).alias("categories"),
        get("entry/published").alias("publish_at"),
        get("entry/updated").alias("updated_at"),
    )


def snapshot(objects: DataFrame, index: DataFrame, versions: tuple[str, ...]) -> DataFrame:
    """object records of a readable version with `position`: their place in the index, those it lacks after the others by id.

    objects: object_id, schema_version, ...; index: object_id, place. Order by position and object_id.
    """
    places = index.groupBy(F.col("object_id").alias("_o")).agg(F.max("place").alias("_p"))
    some = objects.where(F.col("schema_version").isin(*versions))
    return some.join(places, F.col("object_id") == F.col("_o"), "left").withColumn("position", F.coalesce("_p", F.lit(2**62))).drop("_o", "_p")


def with_catalogues(papers: DataFrame) -> DataFrame:
    """The latest month's record of each paper whose flag is strictly true. papers: month, arxiv_id, flag, ..."""
    some = papers.where(F.col("flag").eqNullSafe(F.lit(True)) & (F.trim(F.coalesce("arxiv_id", F.lit(""))) != ""))
    row = F.struct(*(c for c in papers.columns if c != "arxiv_id"))
    return some.groupBy("arxiv_id").agg(F.max_by(row, "month").alias("r")).select("arxiv_id", "r.*")
