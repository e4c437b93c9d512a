"""Closures over small dependency graphs: ancestors, depth and cycles, by joins of paths that double in length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .linkage import stored


def closure(edges: DataFrame) -> DataFrame:
    """doc, step, ancestor, distance (shortest) from edges (doc, step, depends_on), however long the paths are.

    A round doubles the distance: what is at most 2n away is at most n away or at most n behind an ancestor that is n away. The
    pairs found go to the shared folder, so a chain of n steps takes about log2(n) rounds. It ends when no ancestor is n away.
    """
    key, far = ["doc", "step", "ancestor"], 1
    reach = stored(edges.where("step <> depends_on").select("doc", "step", F.col("depends_on").alias("ancestor"), F.lit(1).alias("distance")).distinct())
    while reach.where(F.col("distance") == far).head(1):
        ahead = reach.select("doc", F.col("step").alias("via"), "ancestor", F.col("distance").alias("more"))
        paths = reach.where(F.col("distance") == far).select("doc", "step", F.col("ancestor").alias("via")).join(ahead, ["doc", "via"]).where("step <> ancestor")
        new = stored(paths.groupBy(key).agg((F.min("more") + far).alias("distance")).join(reach, key, "left_anti"))
        reach, far = reach.union(new), far * 2
    return reach


def depths(edges: DataFrame, block: int = 256) -> DataFrame:
    """doc, step and depth: the steps of the longest path from a step back to one without dependencies, of steps that have some.

    Steps are numbers and depend on earlier ones, as valid chains do; other edges are left out, which also breaks cycles. Blocks
    of `block` numbers are solved one after the other, each from the depths of those before it, so a document with very many
    steps is never gathered; one of at most `block` needs one round.
    """
    of = lambda c: F.floor(F.col(c) / block)
    e = stored(edges.where("depends_on < step").select("doc", "step", "depends_on").distinct().withColumn("b", of("step")))
    known = None
    for b in sorted(r["b"] for r in e.select("b").distinct().collect()):  # as many as the largest step number over `block`
        now = e.where(F.col("b") == b)
        base = now.select("doc", "step", F.when(of("depends_on") == b, F.col("depends_on")).alias("inside"), "depends_on")
        if known is None:
            base = base.withColumn("depth", F.lit(0))
        else:
            base = base.join(known.withColumnRenamed("step", "depends_on"), ["doc", "depends_on"], "left").withColumn("depth", F.coalesce("depth", F.lit(0)))
        rows = base.groupBy("doc", "step").agg((F.max("depth") + 1).alias("least"), F.collect_list("inside").alias("inside"))
        one = rows.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("step", "least", "inside"))).alias("rows"))
        start = F.array().cast("array<struct<step:bigint,depth:bigint>>")

        def longer(a: Column, x: Column) -> Column:
            below = F.array_max(F.transform(F.filter(a, lambda s: F.array_contains(x["inside"], s["step"])), lambda s: s["depth"]))
            made = F.struct(x["step"].cast("bigint").alias("step"), F.greatest(x["least"].cast("bigint"), F.coalesce(below, F.lit(0)) + 1).alias("depth"))
            return F.concat(a, F.array(made))

        solved = stored(one.select("doc", F.explode(F.aggregate("rows", start, longer)).alias("s")).select("doc", "s.step", "s.depth"))
        known = solved if known is None else known.union(solved)
    return known if known is not None else edges.select("doc", F.col("step").cast("bigint").alias("step"), F.lit(0).cast("bigint").alias("depth")).where("false")


def cyclic(edges: DataFrame, reach: DataFrame) -> DataFrame:
    """doc, step of steps that reach themselves: an ancestor that depends on them, or a direct self-reference."""
    back = reach.join(reach.select("doc", F.col("step").alias("ancestor"), F.col("ancestor").alias("step")), ["doc", "step", "ancestor"], "left_semi").select("doc", "step")
    return back.union(edges.where("step = depends_on").select("doc", "step")).distinct()
