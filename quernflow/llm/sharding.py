"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Every shard draws a number for the key; the smallest exponential draw ``-ln(u) / weight`` wins. The draw knows the key and
the shard alone, so a new shard takes its own rows and moves no other, and a shard's share follows its weight.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Shards are numbered within 4096 cells of the key's hash, so that no task sorts a whole shard.
CELL_DIGITS = 3
_UNIT = float(1 << 52)


def draw(key: Column, label: Column) -> Column:
    """A number in (0, 1) from the key and a label: 52 bits of the MD5."""
    digits = F.substring(F.md5(F.concat(key, F.lit("#"), label)), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(_UNIT)


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard (int, from 0) of a key. Shards of weight 0 get nothing; a null key counts as the empty string."""
    if not any(w > 0 for w in weights):
        raise ValueError("no shard has a weight")
    key = F.coalesce(key.cast("string"), F.lit(""))
    runners = F.array(*[F.struct(F.lit(s).alias("shard"), F.lit(float(w)).alias("weight")) for s, w in enumerate(weights) if w > 0])
    race = lambda r: F.struct((-F.ln(draw(key, r["shard"].cast("string"))) / r["weight"]).alias("time"), r["shard"].alias("shard"))
    return F.array_min(F.transform(runners, race))["shard"]


def assign_shards(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, grown_shard, slot) for all rows.

    ``size`` is the text's UTF-8 bytes plus 1 (a null text has none and the checksum of an empty one). ``grown_shard`` is the
    shard under the weights ``grown``, null without them. ``slot`` numbers a shard's rows from 0 without gaps: counts by
    (shard, cell), of which there are 4096 a shard at most, give each cell its first number, and rows are ranked within their
    cell by key, checksum and size, so only equal rows can swap places. Rows with a null key are one key.
    """
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    cell = F.conv(F.substring(F.md5(name), 14, CELL_DIGITS), 16, 10).cast("int").alias("cell")
    place = [shard_of(F.col(key), weights).alias("shard"), cell]
    other = shard_of(F.col(key), grown) if grown else F.lit(None).cast("int")
    size = (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size")
    crc = F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32")
    rows = docs.select(F.col(key), size, crc, other.alias("grown_shard"), *place)
    cells = docs.select(F.col(key)).select(*place).groupBy("shard", "cell").count()
    before = W.partitionBy("shard").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.select("shard", "cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    within = W.partitionBy("shard", "cell").orderBy(F.col(key).asc_nulls_first(), "text_crc32", "size")
    ranked = rows.withColumn("rank", F.row_number().over(within))
    slot = (F.col("first") + F.col("rank") - 1).cast("long").alias("slot")
    return ranked.join(cells, ["shard", "cell"]).select(key, "size", "text_crc32", "shard", "grown_shard", slot)


def op2_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = assign_shards(docs, [1.0] * 16, [1.0] * 17)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def _draw_sql(label: str) -> str:
    return f"(('0x' || substr(md5(k || '#{label}'), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE"


def _winner_sql(n: int) -> str:
    races = ", ".join(f"{{'t': -ln({_draw_sql(str(s))}), 's': {s}}}" for s in range(n))
    return f"(list_sort([{races}])[1]).s::INT"


#: DuckDB SQL for op2_sharding; the checksum is the table-driven CRC-32 over each text's bytes.
ORACLE = f"""
WITH RECURSIVE bits(b, i, c) AS (
  SELECT b, 0, b::BIGINT FROM range(256) t(b)
  UNION ALL SELECT b, i + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE i < 8),
tbl AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE i = 8),
d AS (SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS k, coalesce(text, '') AS x FROM documents),
rows_ AS (
  SELECT doc_id, k, (octet_length(encode(x)) + 1)::BIGINT AS size, ('0x' || substr(md5(k), 14, 3))::INT AS cell,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(x)), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)::BIGINT AS text_crc32,
    {_winner_sql(16)} AS shard, {_winner_sql(17)} AS grown_shard FROM d, tbl)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  (row_number() OVER (PARTITION BY shard ORDER BY cell, doc_id NULLS FIRST, text_crc32, size) - 1)::BIGINT AS slot, grown_shard FROM rows_
"""
