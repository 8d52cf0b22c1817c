"""Token counts as delta-maintained rollups.

A batch of changes (inserts, deletes, revised texts) becomes signed rows: what its documents count now less what they
counted before, summed by source, language and tokenizer version. Totals are the sum of the signed rows of all committed
batches. A batch is committed by creating one small file that names its tables; a batch whose file is there is not applied
again, and tables that no file names count for nothing, so a batch can be tried again after any failure.
"""

from __future__ import annotations

import base64
import hashlib
import json
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quernflow.llm import batches
from quernflow.scratch import fresh_path, materialize
from quernflow.session import setting

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The split that belongs to the rank files. A fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A vocabulary is sent to the executors whole; a larger file is refused.
MOST_BYTES = 64 << 20
_GROUP = ["source", "lang", "tokenizer_version"]
_STATE = "doc_id long, source string, lang string, tokenizer_version string, tokens long, live boolean"


@lru_cache(4)
def _encoding(data: bytes, pattern: str):
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class Tokenizer:
    """A rank file read through Spark, so that it can lie in any store; its version is its name and checksum."""

    def __init__(self, spark: SparkSession, path: str = VOCABULARY, pattern: str = PATTERN):
        batches.bound(spark)
        found = spark.read.format("binaryFile").load(path if "://" in path else f"file://{path}").where(F.col("length") <= MOST_BYTES)
        row = found.select("content").first()
        if row is None:
            raise ValueError(f"{path} is missing or larger than {MOST_BYTES} bytes")
        data = bytes(row["content"])
        self.version = f"{path.rpartition('/')[2]}@{hashlib.sha256(data + pattern.encode()).hexdigest()[:12]}"
        self._shared, self._pattern = spark.sparkContext.broadcast(data), pattern

    def count(self, text: Column) -> Column:
        """Tokens of a text, its special strings taken as ordinary ones; null: 0."""
        shared, pattern = self._shared, self._pattern

        @F.pandas_udf("long")
        def of(texts: pd.Series) -> pd.Series:
            encode = _encoding(shared.value, pattern).encode_ordinary
            return pd.Series([len(encode(t)) if t else 0 for t in texts], dtype="int64")

        return of(text)


class Rollup:
    """Totals kept in a folder that the cluster shares."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.path}/commits"))

    def batches(self) -> dict[int, dict]:
        """The committed batches by number, with the places of their tables: one small file a batch, all read by one job."""
        if not any(status.getPath().getName().endswith(".json") for status in self._fs.listStatus(self._path(f"{self.path}/commits"))):
            return {}
        files = self.spark.read.text(f"{self.path}/commits", wholetext=True, pathGlobFilter="*.json").collect()
        return dict(sorted((found["batch"], found) for found in (json.loads(r["value"]) for r in files)))

    def _commit(self, batch: int, tables: dict) -> bool:
        """Create the batch's file, whole or not at all; False if another attempt was first."""
        part, final = f"{self.path}/commits/.{fresh_path(self.spark, 'c').rpartition('/')[2]}", self._path(f"{self.path}/commits/{batch}.json")
        stream = self._fs.create(self._path(part), False)
        stream.write(bytearray(json.dumps(tables | {"batch": batch}).encode()))
        stream.close()
        if self._fs.exists(final) or not self._fs.rename(self._path(part), final):
            self._fs.delete(self._path(part), False)
            return False
        return True

    def state(self) -> DataFrame:
        """The last committed row of each document and tokenizer version, deleted ones included."""
        known = self.batches()
        if not known:
            return self.spark.createDataFrame([], _STATE)
        rows = self.spark.read.schema(_STATE + ", batch int").parquet(*[t["state"] for t in known.values()])
        last = F.max_by(F.struct("source", "lang", "tokens", "live"), "batch").alias("s")
        return rows.groupBy("doc_id", "tokenizer_version").agg(last).select("doc_id", "s.source", "s.lang", "tokenizer_version", "s.tokens", "s.live")

    def apply(self, batch: int, changes: DataFrame, tokenizer: Tokenizer) -> bool:
        """Apply changes (op, doc_id, source, lang, text) under a batch number; False if that batch was committed before.

        Changes may bring ``tokens``, counted before by this tokenizer, in place of ``text``.
        ``op`` is ``delete`` or anything else for insert or revise. Rows without a doc_id are left out: they could not be
        revised or deleted. Where a batch repeats a doc_id, a delete loses against the others and of those the row with the
        greatest (tokens, source, lang) counts. Deleting what is not there changes nothing. Null source or lang is a group.
        """
        if batch in self.batches():
            return False
        deleted = F.coalesce(F.col("op") == "delete", F.lit(False))
        new = changes.where("doc_id is not null").withColumn("live", ~deleted)
        if "tokens" not in changes.columns:
            new = new.withColumn("tokens", tokenizer.count(F.when(F.col("live"), F.col("text"))))
        new = new.select("doc_id", "source", "lang", "live", F.when(F.col("live"), F.col("tokens")).otherwise(F.lit(0)).cast("long").alias("tokens"))
        new = new.groupBy("doc_id").agg(F.max(F.struct("live", "tokens", "source", "lang")).alias("n"))
        version = F.lit(tokenizer.version).alias("tokenizer_version")
        new = materialize(new.select("doc_id", "n.source", "n.lang", version, "n.tokens", "n.live"), "counted")
        old = self.state().where(F.col("tokenizer_version") == tokenizer.version).join(new.select("doc_id"), "doc_id", "left_semi")
        plus = new.where("live").select(*_GROUP, F.lit(1).cast("long").alias("docs"), "tokens")
        minus = old.where("live").select(*_GROUP, F.lit(-1).cast("long").alias("docs"), (-F.col("tokens")).alias("tokens"))
        signed = plus.unionByName(minus).groupBy(*_GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 or tokens <> 0")
        places = {"state": f"{fresh_path(self.spark, 'state')}", "deltas": f"{fresh_path(self.spark, 'deltas')}"}
        new.withColumn("batch", F.lit(batch)).write.parquet(places["state"])
        signed.write.parquet(places["deltas"])
        return self._commit(batch, places)

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer_version, docs, tokens) of the live documents; groups without documents are left out."""
        schema = "source string, lang string, tokenizer_version string, docs long, tokens long"
        known = self.batches()
        if not known:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(*[t["deltas"] for t in known.values()])
        out = rows.groupBy(*_GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return out.where("docs <> 0")


def op10_token_counts(spark, sf_dir: str) -> DataFrame:
    """All rows are inserted, those of documents labelled toxic deleted, inserted with a revised count (that of the text twice)
    and revised back, and a batch is sent twice: the totals are those of all rows of the table. A row's key is its place in
    the table of counts, so rows without a doc_id and rows that repeat one count as well."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rollup, tokenizer = Rollup(spark, fresh_path(spark, "rollup")), Tokenizer(spark, setting(spark, "spark.quernflow.vocabulary", VOCABULARY))
    counted = materialize(docs.select("doc_id", "source", "lang", tokenizer.count(F.col("text")).alias("tokens"), F.monotonically_increasing_id().alias("row")), "counts")
    toxic = spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic = 1").select("doc_id").distinct()
    keyed = lambda rows, op: rows.select(F.lit(op).alias("op"), F.col("row").alias("doc_id"), "source", "lang", "tokens")
    again = materialize(counted.join(toxic, "doc_id", "left_semi"), "again")
    rollup.apply(1, keyed(counted, "insert"), tokenizer)
    rollup.apply(2, keyed(again, "delete"), tokenizer)
    rollup.apply(3, keyed(again.withColumn("tokens", F.col("tokens") * 2), "insert"), tokenizer)
    rollup.apply(4, keyed(again, "revise"), tokenizer)
    rollup.apply(2, keyed(again, "delete"), tokenizer)
    return rollup.totals()
