"""Mixing sources to target weights by systematic sampling, with DataFrame operations alone.

A source's target over its size is the expected number of copies of each of its documents. The prefix sum of those numbers,
one random offset added, crosses an integer once per copy to emit. Documents are taken in the order of their size, so that
each stretch of sizes gives its share and the words taken come near the target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quernflow.scratch import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = 42


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _hash(text: Column, label: str) -> Column:
    """52 bits of the MD5 of a label and a string."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{label}:"), text)), 1, 13), 16, 10).cast("long")


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size): ``share`` of the whole by weight, none above ``most`` times.

    Sources stand in code point order, null last, and take the weights in turn. Where a source reaches its limit, the rest
    is shared by weight among the others: sorted by limit over weight, the sources at their limit come first, and the level
    of the rest is what is left over what weight is left. One row a source goes through the two unpartitioned windows.
    """
    turn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("turn") - 1, F.lit(len(weights))) + 1).cast("int"))
    known = sources.withColumn("turn", turn).withColumn("weight", weight).withColumn("limit", F.col("source_size") * most)
    known = known.withColumn("ratio", F.col("limit") / F.col("weight"))
    order = W.orderBy("ratio", "turn")
    before = F.coalesce(F.sum("limit").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    weight_left = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    whole = F.sum("source_size").over(W.orderBy("ratio", "turn").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    level = (whole * F.lit(share) - before) / weight_left
    known = known.withColumn("level", level)
    settled = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "turn", "level"))).over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    target = F.coalesce(F.least(F.col("limit").cast("double"), settled["level"] * F.col("weight")), F.col("limit").cast("double"))
    return known.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) for all rows: how many copies of each the mix takes.

    A null text has size 0; null is a source of its own; a source without words has target 0 and gives nothing. Equal rows
    may get different numbers of copies, as rows of their own. Sizes fall into classes a sixteenth of a power of two wide and
    those into 64 cells by the hash of doc_id; counts by (source, cell) give each cell its first rank, and rows are ranked
    within their cell, so no task holds a source. Reruns agree.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    narrow = docs.select("doc_id", "source", words_in(F.col("text")).alias("size"), _hash(key, f"order-{seed}").alias("h"))
    narrow = materialize(narrow, "sizes")
    digits = "length(bin(size))"
    cell = F.expr(f"({digits} * 16 + (shiftright(size, greatest({digits} - 5, 0)) & 15)) * 64 + cast(shiftright(h, 46) as int)").cast("int")
    rows = narrow.withColumn("cell", cell)
    counts = rows.groupBy("source", "cell").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    before = W.partitionBy("source").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    firsts = counts.select(F.col("source").alias("s"), F.col("cell").alias("c"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    sources = targets(counts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    name = F.concat(F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), "source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = (_hash(name, f"offset-{seed}") + F.lit(0.5)) / F.lit(float(1 << 52))
    sources = sources.select(F.col("source").alias("t"), "source_size", "target", rate.alias("rate"), offset.alias("offset"))
    plan = firsts.join(sources, F.col("s").eqNullSafe(F.col("t"))).drop("t")
    within = W.partitionBy("source", "cell").orderBy("h", F.col("doc_id").asc_nulls_first(), "size")
    ranked = rows.withColumn("at", F.row_number().over(within))
    ranked = ranked.join(plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("c")))
    upto = lambda rank: F.floor(rank * F.col("rate") + F.col("offset"))
    rank = F.col("first") + F.col("at")
    copies = (upto(rank) - upto(rank - 1)).cast("long").alias("copies")
    return ranked.select("doc_id", "source", "size", "source_size", "target", copies)


def emit(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as ``mix`` takes it, with its columns.

    Rows with one doc_id, source and size share their copies: each comes as often as the average over them, rounded up or
    down so that the total stays.
    """
    taken = mix(docs, weights, share, most, seed).groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    taken = taken.where("copies > 0")
    rows = docs.select(F.struct(*docs.columns).alias("row"), words_in(F.col("text")).alias("own"))
    same = F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & F.col("row.source").eqNullSafe(F.col("source")) & (F.col("own") == F.col("size"))
    rows = rows.join(taken, same)
    alone = rows.where("rows = 1").withColumn("mine", F.col("copies"))
    turn = F.row_number().over(W.partitionBy("doc_id", "source", "size").orderBy("row.text"))
    several = rows.where("rows > 1").withColumn("turn", turn)
    several = several.withColumn("mine", F.expr("copies div rows + if(turn <= copies % rows, 1, 0)")).drop("turn")
    out = alone.unionByName(several).where("mine > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("mine").cast("int")))).select("row.*")


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


#: DuckDB SQL for op3_mixing on any table of documents; {docs} is its name.
ORACLE = """
WITH narrow AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('order-42:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT AS h FROM documents),
rows_ AS (SELECT *, (length(bin(size)) * 16 + ((size >> greatest(length(bin(size)) - 5, 0)) & 15)) * 64 + (h >> 46) AS cell FROM narrow),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM narrow GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS turn FROM sources),
k AS (SELECT *, ([5.0, 2.0, 1.0])[((turn - 1) % 3 + 1)::INT]::DOUBLE AS weight, source_size * 2 AS lim FROM w),
r AS (SELECT *, lim::DOUBLE / weight AS ratio FROM k),
l AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(lim) OVER (ORDER BY ratio, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
  / sum(weight) OVER (ORDER BY ratio, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM r),
settled AS (SELECT arg_min(lvl, (ratio, turn)) AS lvl FROM l WHERE lvl <= ratio),
t AS (SELECT source, source_size, CASE WHEN s.lvl IS NULL THEN lim::DOUBLE ELSE least(lim::DOUBLE, s.lvl * weight) END AS target
  FROM l LEFT JOIN settled s ON true),
p AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
  (('0x' || substr(md5('offset-42:' || CASE WHEN source IS NULL THEN '-' ELSE '+' || source END), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS off FROM t),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY cell, h, doc_id NULLS FIRST, size) AS rank FROM rows_)
SELECT doc_id, size, source_size, target,
  ((floor(rank * rate + off) - floor((rank - 1) * rate + off))::BIGINT * size)::BIGINT AS taken
FROM ranked JOIN p ON ranked.source IS NOT DISTINCT FROM p.source
"""
