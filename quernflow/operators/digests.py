"""Order-free digests of rows, and the reconciliation of two tables by them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_json(*columns: Column | str) -> Column:
    """A row as text; nulls stay apart from missing and empty values."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def multiset(row: Column) -> Column:
    """An aggregate: the digest of a multiset of texts, whatever their order: count, and sums of two 64-bit halves of their SHA-256."""
    sha = F.sha2(row, 256)
    half = lambda i: F.sum(F.conv(F.substring(sha, i, 16), 16, 10).cast("decimal(20,0)"))
    return F.concat_ws(":", F.count(F.lit(1)).cast("string"), half(1).cast("string"), half(17).cast("string"))


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def reconcile(left: DataFrame, right: DataFrame, key: Sequence[str], columns: Sequence[str] | None = None, buckets: int = 1024) -> DataFrame:
    """(key, fault, left_rows, right_rows) of keys that are only ``left``, only ``right``, or whose rows ``differ``.

    Each side is summed by bucket of the key's hash; buckets whose digests agree are never joined. Rows are compared by
    ``columns`` (all that both have), as multisets, so order and repeats within a key are judged right; null keys are keys.
    """
    key = list(key)
    names = sorted(columns or set(left.columns) & set(right.columns))
    narrow = [df.select(*key, row_json(*names).alias("__row"), bucket_of(key, buckets).alias("__bucket")) for df in (left, right)]
    sums = [df.groupBy("__bucket").agg(multiset(F.col("__row")).alias("sum")) for df in narrow]
    same = sums[0].join(sums[1], ["__bucket", "sum"]).select("__bucket")  # a row a bucket at most
    keyed = []
    for df, side in zip(narrow, ("left", "right"), strict=True):
        rest = df.join(same, "__bucket", "left_anti")
        keyed.append(rest.select(*key, "__row", F.lit(side).alias("__side")))
    mine = lambda side, c: F.when(F.col("__side") == side, F.col(c))
    rows = keyed[0].unionByName(keyed[1]).groupBy(*key, "__side").agg(multiset(F.col("__row")).alias("sum"), F.count("*").alias("rows"))
    both = rows.groupBy(*key).agg(*[F.max(mine(s, c)).alias(f"{s}_{c}") for s in ("left", "right") for c in ("sum", "rows")])
    fault = F.when(F.col("right_sum").isNull(), "left").when(F.col("left_sum").isNull(), "right").when(F.col("left_sum") != F.col("right_sum"), "differ")
    counts = [F.coalesce(f"{s}_rows", F.lit(0)).alias(f"{s}_rows") for s in ("left", "right")]
    return both.select(*key, fault.alias("fault"), *counts).where("fault IS NOT NULL")
