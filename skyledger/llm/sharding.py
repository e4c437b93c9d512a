"""Sharding by jump consistent hashing: a stable key and the number of shards decide, no table of a ring is kept.

Built-in functions only. The published algorithm steps a 64-bit linear congruential generator; products are formed from
16- and 32-bit limbs, so that no step can overflow, whatever the ANSI setting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

#: Fixed value: the generator's multiplier in the published algorithm.
MULTIPLIER = 2862933555777941757
#: Rows of a shard are numbered within so many parts of it, each a sort of its own.
PARTS = 256
LOW32 = 0xFFFFFFFF


def jump_hash(key: Column, shards: int) -> Column:
    """Shard of a 64-bit key, 0 to shards - 1. The expected number of jumps is ln(shards); at most min(shards, 256) are taken
    (256 jumps would need a chance of less than 1e-100 for any number of shards)."""
    c_hi, c_lo = MULTIPLIER >> 32, MULTIPLIER & LOW32
    c0, c1 = c_lo & 0xFFFF, c_lo >> 16
    h0, h1 = c_hi & 0xFFFF, c_hi >> 16

    def times(x: Column, a: int, b: int) -> Column:
        """x * (b << 16 | a) modulo 2**32 or a little more, for x under 2**32."""
        return x * F.lit(a) + F.shiftleft((x * F.lit(b)).bitwiseAND(F.lit(0xFFFF)), 16)

    def step(s: Column, _: Column) -> Column:
        hi, lo = s["hi"], s["lo"]
        high_part = lo * F.lit(c1)
        low = lo * F.lit(c0) + F.shiftleft(high_part.bitwiseAND(F.lit(0xFFFF)), 16) + F.lit(1)
        carry = F.shiftright(low, 32) + F.shiftright(high_part, 16)
        new_hi = (carry + times(hi, c0, c1) + times(lo, h0, h1)).bitwiseAND(F.lit(LOW32))
        new_lo = low.bitwiseAND(F.lit(LOW32))
        jump = F.floor((s["j"] + 1).cast("double") * (F.lit(2147483648.0) / (F.shiftright(new_hi, 1) + 1).cast("double")))
        moved = F.struct(new_hi.alias("hi"), new_lo.alias("lo"), s["j"].alias("b"), jump.cast("bigint").alias("j"))
        return F.when(s["j"] >= F.lit(shards), s).otherwise(moved)

    start = F.struct(F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(F.lit(LOW32)).alias("lo"), F.lit(-1).cast("bigint").alias("b"), F.lit(0).cast("bigint").alias("j"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, 256))), start, step, lambda s: s["b"].cast("int"))


def stable_key(docs: DataFrame, id_col: str) -> Column:
    """The id itself if it is a whole number, else its 64-bit hash; a null id counts as 0."""
    whole = isinstance(docs.schema[id_col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    c = F.col(id_col)
    return F.coalesce(c.cast("bigint") if whole else F.xxhash64(c), F.lit(0).cast("bigint"))


def shard(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text: str = "text", parts: int = PARTS) -> DataFrame:
    """id, size, text_crc32, law, shard, slot and grown_shard of every row.

    Law `key`: equal ids share a shard, and with one shard more a row stays or goes to the new one. size is the text's UTF-8
    bytes plus 16; a null text has none and its crc32 is that of an empty text. Slots number a shard's rows from 0 without
    gaps, by part (key modulo `parts`), id, size and crc32; equal rows share out their slots in either order.

    Texts are read once and never shuffled: the narrow rows go to the shared folder, are numbered within (shard, part), and
    the parts' offsets come from their counts, a table of shards x parts rows at most (about 250 KB), which is broadcast.
    """
    key = stable_key(docs, id_col)
    narrow = docs.select(
        F.col(id_col),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        jump_hash(key, shards).alias("shard"),
        jump_hash(key, shards + 1).alias("grown_shard"),
        F.pmod(key, F.lit(parts)).cast("int").alias("part"),
    )
    rows = written(narrow, "shards")
    counts = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "part").orderBy(id_col, "size", "text_crc32")
    numbered = rows.withColumn("_n", F.row_number().over(within) - 1)
    return numbered.join(F.broadcast(offsets), ["shard", "part"]).select(
        id_col, "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("offset") + F.col("_n")).cast("bigint").alias("slot"), "grown_shard"
    )


def oracle(shards: int = 40, parts: int = PARTS) -> str:
    """DuckDB SQL for shard() over `documents`: wide integers for the generator, a table-driven crc32 over the text's bytes."""

    def jumps(n: int) -> str:
        return f"""(WITH RECURSIVE j(k, b, j) AS (
            SELECT ((doc_id::HUGEINT + 18446744073709551616) % 18446744073709551616)::UHUGEINT, -1::BIGINT, 0::BIGINT
            UNION ALL SELECT k2, j, floor((j + 1)::DOUBLE * (2147483648.0::DOUBLE / ((k2 // 8589934592) + 1)::DOUBLE))::BIGINT
            FROM (SELECT ((k * {MULTIPLIER}::UHUGEINT + 1) % 18446744073709551616::UHUGEINT) AS k2, j FROM j WHERE j < {n}))
            SELECT max(b) FROM j WHERE b < {n})::INTEGER"""

    return f"""WITH RECURSIVE bits(i, c, k) AS (SELECT i, i, 0 FROM range(256) r(i)
            UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
        t AS (SELECT list(c ORDER BY i) AS crc FROM bits WHERE k = 8),
        d AS (SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 16 AS size,
            xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
                lambda c, b: xor(c >> 8, t.crc[xor(c & 255, b) + 1])), 4294967295)::BIGINT AS text_crc32,
            {jumps(shards)} AS shard, {jumps(shards + 1)} AS grown_shard FROM documents, t)
        SELECT doc_id, size, text_crc32, 'key' AS law, shard,
            (row_number() OVER (PARTITION BY shard ORDER BY ((doc_id % {parts}) + {parts}) % {parts}, doc_id, size, text_crc32) - 1)::BIGINT AS slot, grown_shard FROM d"""
