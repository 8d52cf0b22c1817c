"""Results kept by key and recomputed only where their input or the policy changed.

Rows lie in buckets by the hash of their key and carry the digest of what they were made from and the policy that made them.
A rebuild compares digests, computes the keys that changed or are new, and writes the buckets that hold such keys, or keys that
are gone, once more; others are not touched. A commit is one small file that says where each bucket lies now: readers see the
state before or after it, and a rebuild that fails leaves files that nothing names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernflow.operators.digests import bucket_of, multiset, row_json
from quernflow.scratch import materialize

_META = ["__digest", "__policy"]


class Kept:
    """A table of results below a folder that the cluster shares. key: the columns that results and inputs share."""

    def __init__(self, spark: SparkSession, path: str, key: list[str], buckets: int = 256):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.path}/_commits"))

    def _state(self) -> dict:
        """The last commit: its number, the schema, the number of buckets, and the folder of each that has rows."""
        numbers = [int(n[:-5]) for n in (s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.path}/_commits"))) if n.endswith(".json") and not n.startswith(".")]
        if not numbers:
            return {"number": 0, "places": {}, "buckets": self.buckets}
        text = self.spark.read.text(f"{self.path}/_commits/{max(numbers)}.json", wholetext=True).first()["value"]
        return json.loads(text)

    def _commit(self, state: dict) -> None:
        part, final = (self._path(f"{self.path}/_commits/{n}") for n in (f".{uuid.uuid4().hex}", f"{state['number']}.json"))
        stream = self._fs.create(part, False)
        stream.write(bytearray(json.dumps(state).encode()))
        stream.close()
        if self._fs.exists(final) or not self._fs.rename(part, final):
            self._fs.delete(part, False)
            raise RuntimeError(f"another rebuild of {self.path} was committed meanwhile")

    def _rows(self, state: dict, some: set[int] | None = None) -> DataFrame | None:
        places = sorted(f"{self.path}/{p}/bucket={b}" for b, p in state["places"].items() if some is None or int(b) in some)
        return self.spark.read.schema(state["schema"]).parquet(*places) if places else None

    def read(self) -> DataFrame | None:
        """The results as last committed; None before the first commit and when all are gone."""
        rows = self._rows(self._state())
        return None if rows is None else rows.drop(*_META)

    def rebuild(self, inputs: DataFrame, compute: Callable[[DataFrame], DataFrame], policy: str) -> dict:
        """Bring the results up to date with ``inputs``: rows with the key, whatever else they have, any number a key.

        ``compute`` gets a table of keys and gives their results, any number of rows a key, none as well. Results of a key whose
        inputs and policy are as they were stay as they are. Gives counts: keys, computed and removed keys, buckets written.
        A null in the key is an error; results for keys that were not asked for count for nothing.
        """
        state = self._state()
        if state["buckets"] != self.buckets:
            raise ValueError(f"{self.path} has {state['buckets']} buckets")
        rest = [c for c in inputs.columns if c not in self.key]
        now = inputs.groupBy(*self.key).agg(multiset(row_json(*sorted(rest)) if rest else F.lit("")).alias("__digest"))
        now = materialize(now, "digests")
        if not now.where(" OR ".join(f"`{k}` IS NULL" for k in self.key)).isEmpty():
            raise ValueError("an input has no key")
        old = now.withColumn("__policy", F.lit(policy))
        places = self._known(state)
        old = self.spark.read.schema(old.schema).parquet(*places) if places else old.limit(0)
        same = [now[k] == old[k] for k in self.key] + [now["__digest"] == old["__digest"], old["__policy"] == policy]
        todo = materialize(now.join(old, same, "left_anti"), "todo")
        gone = old.join(now, self.key, "left_anti").select(*self.key).distinct()
        bucket = bucket_of(self.key, self.buckets)
        touched = {r["b"]: (r["todo"], r["gone"]) for r in todo.select(bucket.alias("b"), F.lit(1).alias("todo"), F.lit(0).alias("gone")).unionByName(gone.select(bucket.alias("b"), F.lit(0).alias("todo"), F.lit(1).alias("gone"))).groupBy("b").agg(F.sum("todo").alias("todo"), F.sum("gone").alias("gone")).collect()}  # a row a bucket
        counts = {"keys": now.count(), "computed": sum(t for t, _ in touched.values()), "removed": sum(g for _, g in touched.values()), "buckets": len(touched)}
        if not touched:
            return counts
        place = f"v{state['number'] + 1}-{uuid.uuid4().hex[:8]}"
        marked = todo.withColumn("__policy", F.lit(policy))
        found = compute(todo.select(*self.key))
        fresh = marked.join(found, self.key).select(*found.columns, *_META)
        kept = self._rows(state, set(touched))
        if kept is not None:
            alive = now.join(todo.select(*self.key), self.key, "left_anti").select(*self.key)
            fresh = fresh.unionByName(kept.join(alive, self.key, "left_semi").select(*fresh.columns))
        fresh.withColumn("bucket", bucket).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.path}/{place}")
        marks = now.withColumn("__policy", F.lit(policy)).withColumn("bucket", bucket).where(F.col("bucket").isin(*touched))
        marks.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.path}/{place}-keys")
        filled, known = ({s.getPath().getName().removeprefix("bucket=") for s in self._fs.listStatus(self._path(f"{self.path}/{p}")) if s.getPath().getName().startswith("bucket=")} for p in (place, f"{place}-keys"))
        dropped = {str(b) for b in touched}
        merged = lambda before, have, at: {b: p for b, p in before.items() if b not in dropped} | {b: at for b in have}
        self._commit({
            "number": state["number"] + 1, "buckets": self.buckets, "schema": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fresh.schema),
            "places": merged(state["places"], filled, place), "keys": merged(state.get("keys", {}), known, f"{place}-keys"),
        })
        return counts

    def _known(self, state: dict) -> list[str]:
        """Where the keys lie that were computed, those without results included."""
        return sorted(f"{self.path}/{p}/bucket={b}" for b, p in state.get("keys", {}).items())

    def vacuum(self) -> int:
        """Remove folders that the last commit does not name; readers of an older state must be done."""
        state = self._state()
        named = set(state["places"].values()) | set(state.get("keys", {}).values())
        old = [s.getPath() for s in self._fs.listStatus(self._path(self.path)) if s.getPath().getName().startswith("v") and s.getPath().getName() not in named]
        for p in old:
            self._fs.delete(p, True)
        return len(old)
