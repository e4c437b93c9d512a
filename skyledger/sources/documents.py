"""Strict reading of JSON documents, and sinks for catalogue tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_strict(spark: SparkSession, paths: str | list[str], schema: T.StructType, version: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Good documents, and skipped ones as (path, error). A document is skipped if it doesn't parse, has an unknown top-level
    key, or another schema version; one bad file never stops the read."""
    raw = spark.read.text(paths, wholetext=True).select(F.col("value"), F.col("_metadata.file_path").alias("path"))
    parsed = raw.withColumn("keys", F.map_keys(F.from_json("value", "map<string,string>"))).withColumn("doc", F.from_json("value", schema))
    extra = F.array_except("keys", F.array(*(F.lit(f.name) for f in schema.fields)))
    error = F.when(F.col("keys").isNull() | F.col("doc").isNull(), "not a JSON object").when(F.size(extra) > 0, F.concat(F.lit("unknown keys: "), F.array_join(F.array_sort(extra), ",")))
    if version is not None:
        error = error.when(~F.col("doc.schema_version").eqNullSafe(F.lit(version)), "another schema version")
    judged = parsed.withColumn("error", error)
    return judged.where("error IS NULL").select("path", "doc.*"), judged.where("error IS NOT NULL").select("path", "error")


def newest_layout(files: DataFrame) -> DataFrame:
    """One path a month from (month, path): the layout YYYY/YYYY-MM wins over YYYY-MM."""
    rank = F.when(F.col("path").rlike(r"/\d{4}/\d{4}-\d{2}/"), 0).otherwise(1)
    return files.groupBy("month").agg(F.min_by("path", F.struct(rank, F.col("path"))).alias("path"))


def write_catalog(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def planned(wanted: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """key and action (write or delete) that a rewrite would take."""
    return wanted.select(key).distinct().withColumn("action", F.lit("write")).union(existing.join(wanted, key, "left_anti").select(key).distinct().withColumn("action", F.lit("delete")))


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)
