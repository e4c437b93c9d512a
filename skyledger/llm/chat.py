"""Chat formatting by quotation linking: quoted passages are joined to the messages they come from, and conversations are
rebuilt in reply order without quotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, written

#: Quote marks at the start of a line, white space between them; their number is the quote level. Possessive, so that the
#: matcher loops over a long run of marks rather than recursing.
MARK = r"^[\x20\t]*+((?:>[\x20\t]?+)++)"
#: "On ... wrote:" lines before a quote say who wrote it; they go with the quote.
ATTRIBUTION = r"(?i)^[\x20\t]*(?:on\b.*\bwrote|am\b.*\bschrieb.*|le\b.*\ba [ée]crit|el\b.*\bescribi[óo])[\x20\t]*:[\x20\t]*$"

#: Messages of a conversation that one sort holds at most, if their turns differ: hot conversations are cut into blocks of turns.
BLOCK = 4096
NODE = ["k", "s", "leave"]


def normal(text: Column) -> Column:
    """Lower case, white space runs as one space, ends trimmed."""
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def paragraphs(text: Column) -> Column:
    """array<string> of what blank lines part."""
    return F.split(text, "\n[\\x20\\t]*+\n")


def hashes(texts: Column) -> Column:
    """array<bigint>: one for each text that isn't empty after normalising."""
    return F.transform(F.filter(F.transform(texts, normal), lambda x: x != ""), lambda x: F.xxhash64(x))


def lines_of(text: Column) -> Column:
    """array<struct<level, body>> of the lines: quote level (0 for own words) and the line without marks."""
    return F.transform(
        F.split(F.coalesce(text, F.lit("")), "\r?\n", -1),
        lambda x: F.struct(F.length(F.regexp_replace(F.regexp_extract(x, MARK, 1), "[^>]", "")).alias("level"), F.regexp_replace(x, MARK, "").alias("body")),
    )


def run_starts(lines: Column) -> Column:
    """array<int>: numbers (from 1) of the lines whose level is not that of the line before."""
    return F.filter(F.sequence(F.lit(1), F.greatest(F.size(lines), F.lit(1))), lambda i: ~F.get(lines, i - 1)["level"].eqNullSafe(F.get(lines, i - 2)["level"]))


def passages(lines: Column, starts: Column) -> Column:
    """array<struct<level, text>>: runs of lines of one level, blank lines staying with the run they are in. Each line is copied
    once. Both arguments must be columns, not expressions, as each passage reads them."""

    def one(s: Column, k: Column) -> Column:
        after = F.coalesce(F.get(starts, k + 1), F.size(lines) + 1)
        return F.struct(F.get(lines, s - 1)["level"].alias("level"), F.array_join(F.transform(F.slice(lines, s, after - s), lambda x: x["body"]), "\n").alias("text"))

    return F.transform(F.filter(starts, lambda s: s <= F.size(lines)), one)


def link(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row a message: conv, turn, role, content (without quotes), n_quotes, n_linked, reply_to (number of the message in its
    conversation, from 0, or null), depth and position (from 0, reply order: by path of message numbers from the root).

    A message replies to the latest earlier message of its conversation that holds one of its first-level quotes: own words of
    that message, a passage of them between quotes, a paragraph or a line, equal after normalising. A quote may also be put
    together: a message holds it if it holds all its paragraphs, and a paragraph if it holds all its lines, so quotes that leave
    out lines or paragraphs are found; the order of the pieces and what lies between them don't count. Without such a link it replies to the message before it.
    Deeper levels count in n_quotes and link in their own right, but only the first level makes a reply. Passages meet by
    (conversation, passage hash) in a running maximum, never as pairs, so a passage that many messages share costs one row each.

    Messages are numbered by turn (null first), role and text; repeated rows of a turn number on. Null texts are empty. A row
    without a conversation is a conversation of its own, shared only with rows equal to it.

    No conversation is gathered: numbers, quotes and reply trees work on blocks of `block` turns and on ranges of ids. Only
    rows of one turn of one conversation are sorted together. The parsed messages are written to the shared folder once.
    """
    own = F.when(F.col("c").isNull(), F.xxhash64("t", "r", "x"))
    m = messages.select(F.col(conv).alias("c"), F.col(turn).alias("t"), F.col(role).alias("r"), F.col(text).alias("x"))
    m = m.withColumn("k", F.struct("c", own.alias("own"))).withColumn("tb", F.floor(F.col("t") / block))
    m = m.withColumn("at", F.row_number().over(Window.partitionBy("k", "tb").orderBy(F.col("t").asc_nulls_first(), "r", "x")) - 1)
    m = m.withColumn("_l", lines_of(F.col("x"))).withColumn("_l", F.filter("_l", lambda l: ~((l["level"] == 0) & l["body"].rlike(ATTRIBUTION) & F.exists("_l", lambda y: y["level"] > 0))))
    m = m.withColumn("_s", run_starts(F.col("_l"))).withColumn("_p", passages(F.col("_l"), F.col("_s")))
    own_parts = F.transform(F.filter("_p", lambda p: p["level"] == 0), lambda p: p["text"])
    m = m.withColumn("parts", F.when(F.size(own_parts) > 1, own_parts))
    m = m.withColumn("content", F.trim(F.array_join(own_parts, "\n")))
    # of a quote, its hash and those of its paragraphs, each with its lines'
    in_it = lambda p: F.transform(F.filter(paragraphs(p), lambda x: normal(x) != ""), lambda x: F.struct(F.xxhash64(normal(x)).alias("h"), hashes(F.split(x, "\n")).alias("parts")))
    quoted = F.filter("_p", lambda p: (p["level"] > 0) & (normal(p["text"]) != ""))
    m = m.withColumn("quotes", F.transform(quoted, lambda p: F.struct(p["level"].alias("level"), F.xxhash64(normal(p["text"])).alias("h"), in_it(p["text"]).alias("paragraphs"))))
    m = numbered(written(m.select("k", "t", "r", "tb", "at", "content", "parts", "quotes"), "messages"))
    linked = written(links(m, block), "links")
    j = m.join(linked, ["k", "seq"], "left").withColumn("parent", F.coalesce("parent", F.when(F.col("seq") > 0, F.col("seq") - 1)))
    out = ["k.c", "t", "r", "content", F.size("quotes").cast("bigint").alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).cast("bigint").alias("n_linked"), "parent"]
    branches = linked.where(F.col("parent") != F.col("seq") - 1)
    if not branches.head(1):  # every message answers the one before it
        found = j.select(*out, F.col("seq").alias("depth"), F.col("seq").alias("position"))
    else:
        places = reply_order(m.select("k", "seq"), branches, block)
        found = j.join(places, ["k", "seq"], "left").select(*out, F.coalesce("depth", "seq").alias("depth"), F.coalesce("position", "seq").alias("position"))
    return found.toDF(conv, turn, role, "content", "n_quotes", "n_linked", "reply_to", "depth", "position")


def numbered(m: DataFrame) -> DataFrame:
    """Turns places `at` inside blocks `tb` into `seq`, numbers in the whole conversation: only later blocks need an offset.

    The offsets are a table of their own, so that their size is known and texts aren't shuffled to meet a small one.
    """
    before = F.sum("n").over(Window.partitionBy("k").orderBy(F.col("tb").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1))
    offsets = m.groupBy("k", "tb").agg(F.count("*").alias("n")).withColumn("off", before).where("off is not null").selectExpr("k as ko", "tb as to", "off")
    offsets = written(offsets, "offsets")
    j = m.join(offsets, (F.col("k") == F.col("ko")) & F.col("tb").eqNullSafe(F.col("to")), "left")
    return j.select("k", "t", "r", (F.col("at") + F.coalesce("off", F.lit(0))).cast("bigint").alias("seq"), "content", "parts", "quotes")


def running_max(df: DataFrame, keys: list[str], at: str, value: str, block: int) -> DataFrame:
    """Replaces `value` by its maximum over the rows of the same keys up to the row's `at`, in blocks of `at`; nulls don't count."""
    df = df.withColumn("_b", F.floor(F.col(at) / block))
    inside = Window.partitionBy(*keys, "_b").orderBy(at).rangeBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = df.groupBy(*keys, "_b").agg(F.max(value).alias("_v")).withColumn("_v", F.max("_v").over(before)).where("_v is not null")
    return df.withColumn(value, F.max(value).over(inside)).join(carry, [*keys, "_b"], "left").withColumn(value, F.greatest(value, "_v")).drop("_b", "_v")


def holders(sources: DataFrame, wholes: DataFrame) -> DataFrame:
    """k, seq, h of the messages that hold all parts of a whole (k, h, parts), from the pieces (k, seq, h) of the messages.

    Only the messages that hold the rarest part are tried.
    """
    wholes = wholes.withColumn("parts", F.array_distinct("parts")).distinct().withColumnRenamed("h", "whole")
    seen = sources.groupBy("k", "h").agg(F.count("*").alias("n"))
    rarest = wholes.select("*", F.explode("parts").alias("h")).join(seen, ["k", "h"]).groupBy("k", "whole", "parts").agg(F.min_by("h", F.struct("n", "h")).alias("h"), F.count("*").alias("known"))
    tried = rarest.where(F.col("known") == F.size("parts")).join(sources, ["k", "h"]).select("k", "whole", "seq", "parts", F.explode("parts").alias("h"))
    held = tried.join(sources, ["k", "seq", "h"]).groupBy("k", "whole", "seq", "parts").agg(F.count("*").alias("n"))
    return held.where(F.col("n") == F.size("parts")).select("k", "seq", F.col("whole").alias("h"))


def links(m: DataFrame, block: int) -> DataFrame:
    """k, seq, n_linked and parent of the messages of which a quote is found in an earlier one."""
    asked = m.where(F.size("quotes") > 0).select("k", "seq", F.explode("quotes").alias("q")).select("k", "seq", "q.level", "q.h", "q.paragraphs")
    quotes = asked.where(F.size("paragraphs") > 1).select("k", "h", F.col("paragraphs.h").alias("parts"))
    quoted = asked.select("k", F.explode("paragraphs").alias("p")).select("k", "p.h", "p.parts").where(F.size("parts") > 1)
    wanted = asked.select("k", "h")
    for wholes in (quotes, quoted):
        wanted = wanted.union(wholes.select("k", F.explode("parts").alias("h")))
    split = F.coalesce("parts", F.array().cast("array<string>"))
    pieces = F.array_distinct(hashes(F.concat(F.array("content"), paragraphs(F.col("content")), F.split("content", "\n"), split, F.flatten(F.transform(split, paragraphs)))))
    sources = m.where(F.col("content") != "").select("k", "seq", F.explode(pieces).alias("h"))
    sources = written(sources.join(wanted.distinct(), ["k", "h"], "left_semi"), "pieces")
    # paragraphs that are put together are pieces of the quotes that hold them
    sources = written(sources.unionByName(holders(sources, quoted)).distinct(), "pieces")
    sources = sources.unionByName(holders(sources, quotes))
    # a message's own words come after its quotes: doubled numbers keep them apart
    both = asked.select("k", "h", "level", (F.col("seq") * 2).alias("at"), F.lit(None).cast("bigint").alias("from"))
    both = both.unionByName(sources.select("k", "h", F.lit(None).cast("int").alias("level"), (F.col("seq") * 2 + 1).alias("at"), F.col("seq").alias("from")))
    met = running_max(both, ["k", "h"], "at", "from", block).where("level is not null and from is not null")
    found = met.groupBy("k", (F.col("at") / 2).cast("bigint").alias("seq"))
    return found.agg(F.countDistinct("h", "level").alias("n_linked"), F.max(F.when(F.col("level") == 1, F.col("from"))).alias("parent"))


def followers(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Adds `follower`: `value` of the next row of the same keys in the given order, null for the last. The order must be total.

    Rows are range-partitioned by keys and order, so that a key with very many rows is cut; each cut knows the next one's first row.
    """
    d = written(df.repartitionByRange(*keys, *order).withColumn("_p", F.spark_partition_id()), "ranges")
    heads = d.groupBy(*keys, "_p").agg(F.min_by(value, F.struct(*order)).alias("_h")).withColumn("_h", F.lead("_h").over(Window.partitionBy(*keys).orderBy("_p"))).where("_h is not null")
    d = d.withColumn("follower", F.lead(value).over(Window.partitionBy(*keys, "_p").orderBy(*order)))
    return d.join(heads, [*keys, "_p"], "left").withColumn("follower", F.coalesce("follower", "_h")).drop("_p", "_h")


def reply_order(places: DataFrame, branches: DataFrame, block: int) -> DataFrame:
    """k, seq, depth and position of the messages of conversations with branches (k, seq, parent).

    A run is a message that starts a branch (or the conversation) and those after it that each answer the one before. The runs
    of a conversation form a tree; a walk enters and leaves each. Pointer doubling over the walk gives, for every run, the
    messages after it and its depth, in as many rounds as the logarithm of the longest walk, without gathering a conversation.
    """
    places = places.join(branches.select("k").distinct(), "k", "left_semi")
    starts = places.where("seq = 0").select("k", "seq", F.lit(None).cast("bigint").alias("parent")).unionByName(branches.select("k", "seq", "parent"))
    of_run = running_max(places.join(starts.select("k", "seq", F.col("seq").alias("s")), ["k", "seq"], "left"), ["k"], "seq", "s", block)
    of_run = written(of_run, "runs")
    lengths = of_run.groupBy("k", "s").agg(F.count("*").alias("n"))
    above = of_run.select("k", F.col("seq").alias("parent"), F.col("s").alias("up"))
    runs = starts.withColumnRenamed("seq", "s").join(lengths, ["k", "s"]).join(above, ["k", "parent"], "left")
    # a run's own messages come first; of the branches, those off its later messages are met first
    runs = runs.withColumn("step", F.coalesce(F.col("parent") - F.col("up") + 1, F.lit(0))).withColumn("back", -F.col("parent"))
    runs = written(followers(runs, ["k", "up"], ["back", "s"], "s"), "tree")
    first = runs.where("up is not null").groupBy("k", "up").agg(F.min_by("s", F.struct("back", "s")).alias("child")).withColumnRenamed("up", "s")
    enter = runs.join(first, ["k", "s"], "left").select("k", "s", F.lit(False).alias("leave"), F.coalesce("child", "s").alias("ns"), F.col("child").isNull().alias("nl"), "n", "step")
    leave = runs.select("k", "s", F.lit(True).alias("leave"), F.coalesce("follower", "up").alias("ns"), F.col("follower").isNull().alias("nl"), F.lit(0).cast("bigint").alias("n"), (-F.col("step")).alias("step"))
    walk = written(enter.unionByName(leave), "walk")
    while walk.where("ns is not null").head(1):
        ahead = walk.select(F.col("k"), F.col("s").alias("ns"), F.col("leave").alias("nl"), F.col("ns").alias("ns2"), F.col("nl").alias("nl2"), F.col("n").alias("n2"), F.col("step").alias("step2"))
        plus = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
        longer = written(walk.join(ahead, ["k", "ns", "nl"], "left").select(*NODE, F.col("ns2").alias("ns"), F.col("nl2").alias("nl"), plus("n", "n2"), plus("step", "step2")), "walk")
        dropped(walk)
        walk = longer
    # sums from a run's entry to the end of the walk, itself included: depths of the whole walk add up to nothing
    entries = walk.where("not leave").select("k", "s", F.col("n").alias("rest"), F.col("step").alias("sum"))
    totals = entries.where("s = 0").select("k", F.col("rest").alias("total"))
    tops = runs.select("k", "s", "step").join(entries, ["k", "s"]).join(totals, "k").select("k", "s", (F.col("step") - F.col("sum")).alias("top"), (F.col("total") - F.col("rest")).alias("before"))
    inside = F.col("seq") - F.col("s")
    return of_run.join(tops, ["k", "s"]).select("k", "seq", (F.col("top") + inside).alias("depth"), (F.col("before") + inside).alias("position"))
