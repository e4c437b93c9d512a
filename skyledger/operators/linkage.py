"""Record linkage: evidence by tiers, components, object ids, and updates."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sky
from ..functions import text as tx

RADIUS = 5.0


def prepared(contributions: DataFrame) -> DataFrame:
    """Contributions (record_id, gaia_id, provider_id, object_key, name, ra, dec, month) with their match keys and order."""
    return contributions.select(
        "record_id", "ra", "dec", "month", "name", "gaia_id",
        tx.match_key(F.col("gaia_id")).alias("gaia"), F.coalesce("provider_id", F.lit("")).alias("provider"), F.coalesce("object_key", F.lit("")).alias("object"),
        F.when(tx.weak_identifier(F.col("name")), "").otherwise(tx.alias(F.col("name"))).alias("alias"),
        F.concat_ws("|", F.coalesce("month", F.lit("9999-99")), "record_id").alias("ord"),
    )


def candidate_pairs(c: DataFrame, near: DataFrame) -> DataFrame:
    """Distinct ordered pairs (l, r) that share a key or are near: one equi-join for each kind of evidence."""
    found = near.where("l_ord < r_ord").select(F.col("l_record_id").alias("l"), F.col("r_record_id").alias("r"))
    for key in ("gaia", "provider", "object", "alias"):
        some = c.where(F.col(key) != "").select(key, "record_id", "ord")
        l, r = some.toDF(key, "l", "lo"), some.toDF(key, "r", "ro")
        found = found.union(l.join(r, key).where("lo < ro").select("l", "r"))
    return found.distinct()


def near_pairs(c: DataFrame) -> DataFrame:
    """All pairs nearer than the radius, both ways and each record with itself, as a table in the shared folder."""
    pos = c.select("record_id", "ord", "ra", "dec")
    return stored(sky.within(pos, pos, RADIUS).select("l_record_id", "l_ord", "r_record_id", "r_ord"))


def neighbour_counts(c: DataFrame, near: DataFrame | None = None) -> DataFrame:
    """record_id and the number of other records nearer than the radius, 0 included."""
    if near is None:
        pos = c.select("record_id", "ra", "dec")
        near = sky.within(pos, pos, RADIUS)
    n = near.where("l_record_id <> r_record_id").groupBy(F.col("l_record_id").alias("record_id")).agg(F.count("*").alias("n"))
    return c.select("record_id").join(n, "record_id", "left").select("record_id", F.coalesce("n", F.lit(0)).alias("neighbours"))


def evidence(c: DataFrame, mode: str = "off") -> DataFrame:
    """left, right, kind and decision (merge, review, blocked) of each pair; tiers in order, the first that applies ends the pair.

    Two literature ids settle a pair between them. Blocked aliases go on to the coordinates, which cannot merge them. The sky
    is joined once; neighbours are counted in the one mode that asks for them.
    """
    if mode not in ("auto", "review", "off"):
        raise ValueError(f"no such mode: {mode}")
    near_by = near_pairs(c)
    counted = c.join(neighbour_counts(c, near_by), "record_id") if mode == "auto" else c
    l, r = counted.select(*(F.col(x).alias(f"l_{x}") for x in counted.columns)), counted.select(*(F.col(x).alias(f"r_{x}") for x in counted.columns))
    p = candidate_pairs(c, near_by).join(l, F.col("l") == F.col("l_record_id")).join(r, F.col("r") == F.col("r_record_id"))
    sep = sky.separation(F.col("l_ra"), F.col("l_dec"), F.col("r_ra"), F.col("r_dec"))
    near = F.coalesce(sep < RADIUS, F.lit(False))
    far = F.coalesce(sep >= RADIUS, F.lit(False))
    same = lambda k: (F.col(f"l_{k}") != "") & (F.col(f"l_{k}") == F.col(f"r_{k}"))
    differ = lambda k: (F.col(f"l_{k}") != "") & (F.col(f"r_{k}") != "") & (F.col(f"l_{k}") != F.col(f"r_{k}"))
    say = lambda kind, decision: F.struct(F.lit(kind).alias("kind"), F.lit(decision).alias("decision"))
    hit = "merge" if mode == "auto" else "review"
    out: Column = F.when(same("gaia"), say("literature_id", "merge")).when(differ("gaia") & near, say("literature_id_conflict", "blocked")).when(differ("gaia"), F.lit(None))
    if mode != "off":
        out = out.when(same("provider"), say("provider_id", hit)).when(same("object"), say("provider_object", hit)).when(same("alias") & far, say("alias", "blocked")).when(same("alias"), say("alias", hit))
    if mode == "auto":
        crowded = (F.col("l_neighbours") != 1) | (F.col("r_neighbours") != 1) | differ("provider") | differ("object")
        out = out.when(near & crowded, say("coordinates", "blocked"))
    out = out.when(near, say("coordinates", "merge"))
    return p.select(F.col("l").alias("left_id"), F.col("r").alias("right_id"), out.alias("e")).where("e IS NOT NULL").select("left_id", "right_id", "e.kind", "e.decision")


def stored(df: DataFrame) -> DataFrame:
    """df as a table in the session's checkpoint folder, deleted with the session; only a local master may go without one."""
    spark = df.sparkSession
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"{tempfile.gettempdir()}/checkpoints"
    path = f"{base.rstrip('/')}/catalogue-{uuid.uuid4().hex}"
    df.write.parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Deletes the files of a table that stored() made and nothing will read again."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node, component (smallest node): labels pass along edges and jump to their labels' labels until none changes."""
    both = stored(edges.toDF("a", "b").union(edges.select(*reversed(edges.columns)).toDF("a", "b")).distinct())
    first = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))  # labels start at the smallest neighbour
    labels = stored(nodes.toDF("node").distinct().join(first, "node", "left").select("node", F.least("node", F.coalesce("b", "node")).alias("label")))
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        low = labels.join(near, labels.node == near.a, "left").select("node", "label", F.least("label", F.coalesce("near", "label")).alias("low"))
        tops = labels.select(F.col("node").alias("low"), F.col("label").alias("top"))
        new = stored(low.join(tops, "low").select("node", F.col("label").alias("was"), F.least("low", "top").alias("label")))
        dropped(labels)
        labels = new.select("node", "label")
        if not new.where("label <> was").limit(1).count():
            dropped(both)
            return labels.withColumnRenamed("label", "component")


def linked(contributions: DataFrame, mode: str = "off") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Prepared contributions, their evidence, and record_id, component."""
    c = prepared(contributions)
    ev = stored(evidence(c, mode))
    comp = components(c.select("record_id"), ev.where("decision = 'merge'").select("left_id", "right_id")).withColumnRenamed("node", "record_id")
    return c, ev, comp


def strategies(ev: DataFrame, comp: DataFrame) -> DataFrame:
    """component, n_records and strategy: singleton, the one kind of merging evidence, or mixed."""
    kinds = ev.where("decision = 'merge'").join(comp, ev.left_id == comp.record_id).groupBy("component").agg(F.min("kind").alias("k0"), F.max("kind").alias("k1"))
    sizes = comp.groupBy("component").agg(F.count("*").alias("n_records"))
    one = F.when(F.col("n_records") == 1, "singleton").when(F.col("k0") == F.col("k1"), F.col("k0")).otherwise("mixed")
    return sizes.join(kinds, "component", "left").select("component", "n_records", one.alias("strategy"))


def object_ids(c: DataFrame, comp: DataFrame) -> DataFrame:
    """component, object_id and first_record: the slug of the canonical id; every holder of a base that occurs twice gets its
    first record's slug as a suffix, and what still collides a number.

    Canonical: the literature id (DR3, EDR3, other releases, other text), the first strong name, the position, the record id.
    """
    j = c.join(comp, "record_id")
    rel = tx.gaia_release(F.col("gaia_id"))
    rank = F.when(rel == "DR3", 0).when(rel == "EDR3", 1).when(rel != "", 2).otherwise(3)
    first = lambda v, cond, *order: F.min_by(F.when(cond, v), F.when(cond, F.struct(*order, F.col("ord"))))
    a = j.groupBy("component").agg(
        first(F.col("gaia"), F.col("gaia") != "", rank).alias("g"),
        first(F.col("name"), F.col("alias") != "").alias("n"),
        first(sky.position_slug(F.col("ra"), F.col("dec")), F.col("ra").isNotNull() & F.col("dec").isNotNull()).alias("p"),
        F.min_by("record_id", "ord").alias("first_record"),
    )
    base = F.coalesce(F.when(F.col("g").isNotNull(), tx.slug(F.col("g"))), F.when(F.col("n").isNotNull(), tx.slug(F.col("n"))), F.col("p"), F.concat(F.lit("src_"), tx.slug(F.col("first_record"))))
    b = a.select("component", "first_record", base.alias("base"))
    n = b.withColumn("n", F.count("*").over(Window.partitionBy("base")))
    s = n.withColumn("id", F.when(F.col("n") > 1, F.concat("base", F.lit("__"), tx.slug(F.col("first_record")))).otherwise(F.col("base")))
    k = F.row_number().over(Window.partitionBy("id").orderBy("first_record"))
    return s.withColumn("k", k).select("component", "first_record", F.when(F.col("k") > 1, F.concat("id", F.lit("_"), F.col("k").cast("string"))).otherwise(F.col("id")).alias("object_id"))


def object_index(contributions: DataFrame, mode: str = "off") -> DataFrame:
    """object_id, n_records, strategy, first_month, n_blocked of every object."""
    c, ev, comp = linked(contributions, mode)
    blocked = ev.where("decision = 'blocked'").select(F.explode(F.array("left_id", "right_id")).alias("record_id")).join(comp, "record_id").groupBy("component").agg(F.count("*").alias("n_blocked"))
    months = c.join(comp, "record_id").groupBy("component").agg(F.min("month").alias("first_month"))
    out = object_ids(c, comp).join(strategies(ev, comp), "component").join(months, "component").join(blocked, "component", "left")
    return out.select("object_id", "n_records", "strategy", "first_month", F.coalesce("n_blocked", F.lit(0)).alias("n_blocked"))


def nearest(left: DataFrame, right: DataFrame, radius: float = RADIUS) -> DataFrame:
    """For each left row (id, ra, dec) the nearest right row within the radius, inclusive, its separation and how many lie there."""
    met = sky.within(left, right, radius, inclusive=True)
    return met.groupBy(F.col("l_id").alias("id")).agg(F.min_by("r_id", F.struct("sep", "r_id")).alias("nearest_id"), F.round(F.min("sep"), 6).alias("sep"), F.count("*").alias("n_within"))


def replaced(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """existing without the identities that new brings, and new."""
    return existing.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)
