"""Quality rules: a length-normalised log-likelihood ratio of hashed word n-grams, trusted target against raw corpus.

Built-in functions only. Each word is its crc32; a bigram is the two numbers side by side in 64 bits; the bucket of
either is its remainder modulo BUCKETS. Both multinomials are smoothed counts over these buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 16381
#: A document is kept if its mean log ratio is at least this.
LEAST = -0.1
WORD_SPLIT = "[\\x20\\x09-\\x0D]+"


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_SPLIT), lambda w: w != "")


def repeated(windows: Column, n: Column, width: int) -> Column:
    """Words covered by windows that occur twice or more. windows: array of (hash, position), sorted; n: their number.

    The positions of windows equal to a neighbour in the order are sorted, and each adds its width or the way to the next.
    """
    hits = F.sort_array(
        F.transform(
            F.filter(windows, lambda x, i: ((i > 0) & (F.get(windows, i - 1)["h"] == x["h"])) | ((i < n - 1) & (F.get(windows, i + 1)["h"] == x["h"]))),
            lambda x: x["p"],
        )
    )
    start = F.struct(F.lit(0).alias("total"), F.lit(-width).alias("last"))
    return F.aggregate(hits, start, lambda s, p: F.struct((s["total"] + F.least(F.lit(width), p - s["last"])).alias("total"), p.alias("last")), lambda s: s["total"])


def base_statistics(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """keep columns, `crcs` (crc32 of each word), `_p` (its pairs, see pairs()) and the base counts. A null text counts as empty: no words, all counts 0.

    Each step is a projection of its own, so that arrays used in lambdas are built once for a row. Most texts repeat no
    window and skip the sort.
    """
    keep = keep or []
    one = docs.select(
        *keep,
        words(F.col(text)).alias("_w"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(r"[#*$%&|<>]")), F.lit(0)).cast("bigint").alias("n_symbols"),
        F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )
    two = one.select(
        *keep,
        "n_symbols",
        F.transform("_w", lambda w: F.crc32(w.cast("binary"))).alias("crcs"),
        F.size("_w").cast("bigint").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("bigint").alias("word_chars"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
    )
    c, p, n = F.col("crcs"), F.col("_p"), F.col("n_words").cast("int")
    some = F.greatest(n - 4, F.lit(0))
    four_words = F.zip_with(F.slice(p, F.lit(1), some), F.slice(p, F.lit(3), some), lambda x, y: F.xxhash64(x, y))
    three = two.withColumn("_p", pairs(c, n)).withColumn("_h", F.zip_with(four_words, F.slice(c, F.lit(5), some), lambda x, y: F.xxhash64(x, y)))
    four = three.withColumn("_n", F.size("_h")).withColumn("_same", F.size(F.array_distinct("_h")) == F.size("_h"))
    five = four.withColumn("_s", F.when(F.col("_same"), F.lit(None)).otherwise(F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))))
    return five.select(
        *keep,
        "crcs",
        "_p",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.when(F.col("_same"), F.lit(0)).otherwise(repeated(F.col("_s"), F.col("_n"), 5)).cast("bigint").alias("n_repeat_words"),
    )


def pairs(crcs: Column, n: Column) -> Column:
    """Each word and the next as one 64-bit number: the first's crc32 in the high half, the second's in the low one."""
    some = F.greatest(n - 1, F.lit(0))
    return F.zip_with(F.slice(crcs, F.lit(1), some), F.slice(crcs, F.lit(2), some), lambda x, y: F.shiftleft(x, 32).bitwiseOR(y))


def bucket(gram: Column) -> Column:
    return F.pmod(gram, F.lit(BUCKETS)).cast("int")


def log_ratios(docs: DataFrame, trusted: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row, one array: ln(target / raw) of each bucket, smoothed by one half. Target counts cover all trusted documents,
    raw counts all documents.

    Partial sums are formed before the shuffle, of at most BUCKETS rows a task. Texts are shuffled once to meet the
    trusted ids, whose number has no bound. Without a document or a trusted one all ratios come from the smoothing alone.
    """
    ids = trusted.select(F.col(id_col)).where(F.col(id_col).isNotNull()).distinct().withColumn("_t", F.lit(1))
    flagged = docs.select(id_col, text).join(ids.hint("shuffle_hash"), id_col, "left")
    c = flagged.select("_t", F.transform(words(F.col(text)), lambda w: F.crc32(w.cast("binary"))).alias("crcs"))
    each = c.select("_t", F.explode(F.concat("crcs", pairs(F.col("crcs"), F.size("crcs")))).alias("g"))
    counts = each.select("_t", bucket(F.col("g")).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("raw"), F.count("_t").alias("target"))
    full = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(F.broadcast(counts), "bucket", "left").na.fill(0, ["raw", "target"])
    sums = full.agg(F.array_sort(F.collect_list(F.struct("bucket", "raw", "target"))).alias("v"), F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    half, all_ = F.lit(0.5), F.lit(0.5 * BUCKETS)
    return sums.select(F.transform("v", lambda x: F.log((x["target"] + half) / (F.col("target") + all_)) - F.log((x["raw"] + half) / (F.col("raw") + all_))).alias("ratio"))


def score(docs: DataFrame, trusted: DataFrame, least: float = LEAST, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The base counts, base_failed, llr (mean log ratio of the document's n-grams, 6 decimals; 0 without words) and kept.

    base_failed: under 10 words, or more than a fifth of them in repeated windows. kept: not so, and llr >= least. Every row
    is judged on its whole text; nulls count as empty, repeated rows are judged alike, other columns are left out.
    """
    stats = base_statistics(docs.select(id_col, text), text, [id_col])
    ratio = log_ratios(docs, trusted, text, id_col).scalar()
    with_grams = stats.withColumn("_g", F.concat("crcs", "_p")).drop("crcs", "_p").withColumn("_r", ratio)
    total = F.aggregate("_g", F.lit(0.0), lambda a, g: a + F.get(F.col("_r"), bucket(g)))
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    out = with_grams.select(
        id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        F.when(F.size("_g") > 0, F.round(total / F.size("_g"), 6)).otherwise(F.lit(0.0)).alias("llr"),
    )
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= least))
