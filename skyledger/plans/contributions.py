"""Contributions derived from `customer` (paper A) and `supplier` (paper B), by arithmetic that any engine evaluates alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_FIELDS = """concat('{p}:cand-', cast({k} AS STRING)) AS record_id,
    CASE WHEN {k} % 3 = 0 THEN concat('Gaia {r} ', cast(floor({k} / 4) AS BIGINT)) ELSE '' END AS gaia_id,
    CASE WHEN {k} % 7 = 0 THEN concat('gaia DR3 ', cast(floor({k} / 14) AS BIGINT)) ELSE '' END AS provider_id,
    CASE WHEN {k} % 11 = 1 THEN concat('obj-', cast(floor({k} / 22) AS BIGINT)) ELSE '' END AS object_key,
    CASE WHEN {k} % 5 = 0 THEN concat(' Fast  Star ', cast(floor({k} / 10) AS BIGINT)) WHEN {k} % 5 = 1 THEN 'star' ELSE cast({k} AS STRING) END AS name,
    CASE WHEN {k} % 13 = 0 THEN NULL ELSE ((cast(floor({k} / 3) AS BIGINT) * 137) % 3600) / 10.0D END AS ra,
    ((cast(floor({k} / 3) AS BIGINT) * 59) % 1700) / 10.0D - 85.0D + ({k} % 3) * 3.0D / 3600.0D AS dec,
    concat('20', cast(10 + {k} % 15 AS STRING), '-0', cast(1 + {k} % 9 AS STRING)) AS month"""


def fields(prefix: str, key: str, release: str, duck: bool) -> str:
    sql = _FIELDS.format(p=prefix, k=key, r=release)
    return sql.replace("10.0D", "10.0::DOUBLE").replace("85.0D", "85.0::DOUBLE").replace("3.0D", "3.0::DOUBLE").replace("3600.0D", "3600.0::DOUBLE").replace("STRING", "VARCHAR") if duck else sql


def contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr(*_split(fields("A", "c_custkey", "EDR3", False)))
    b = spark.read.parquet(f"{sf_dir}/supplier.parquet").selectExpr(*_split(fields("B", "s_suppkey", "DR3", False)))
    return a.unionByName(b)


def _split(sql: str) -> list[str]:
    return [x.strip().rstrip(",") for x in sql.split("\n")]


SQL = f"SELECT {fields('A', 'c_custkey', 'EDR3', True)} FROM customer UNION ALL SELECT {fields('B', 's_suppkey', 'DR3', True)} FROM supplier"
