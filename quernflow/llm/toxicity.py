"""Toxicity by a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

Features are the n-grams of three to five code points of the lower-cased text, hashed into buckets, each present or not. Over
the documents fitted on, a bucket's ratio is the log of its share among toxic documents over that among clean ones; the
classifier is a logistic regression on presence times ratio. It is fitted on a bounded sample of the labelled documents, and
scores every whole text.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernflow.llm import batches
from quernflow.scratch import materialize

GRAMS = (3, 4, 5)
BITS = 20
#: Labelled documents that the classifier is fitted on, at most: those of the least hashes of their doc_id.
MOST_LABELLED = 12_000
#: Buckets of the classifier, at most: those whose ratio stands out most from its sampling error.
MOST_FEATURES = 1 << 11
#: Documents that a bucket must be in.
LEAST_DOCS = 5
#: Added to each count before the ratio.
SMOOTHING = 5.0
#: Strength of the penalty on squared weights, for a mean loss.
PENALTY = 1e-3
_STEPS = 300
THRESHOLD = 0.7
#: Code points that are hashed at a time.
_PIECE = 1 << 19
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _buckets(points: np.ndarray, n: int) -> np.ndarray:
    """The bucket of the n-gram that starts at each code point, the last n - 1 left out."""
    count = len(points) - n + 1
    h = np.full(count, n, np.uint64)
    for i in range(n):
        h = (h ^ points[i : i + count]) * _MIX
        h ^= h >> np.uint64(29)
    return (h * _MIX >> np.uint64(64 - BITS)).astype(np.int64)


def _present(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) once for each bucket that a text has; with ``wanted``, only for buckets where it is set.

    Texts are taken as one run of code points, a piece of it at a time, and n-grams across two texts left out.
    """
    data = [(t or "").lower().encode("utf-32-le") for t in texts.to_pylist()]
    ends = np.cumsum([len(d) // 4 for d in data])
    points = np.frombuffer(b"".join(data), np.uint32)
    del data
    found = np.zeros(0, np.int64)
    fresh: list[np.ndarray] = []
    waiting = 0
    for start in range(0, len(points), _PIECE):
        piece = points[start : start + _PIECE + max(GRAMS) - 1].astype(np.uint64)
        last = min(_PIECE, len(points) - start)
        row = np.searchsorted(ends, np.arange(start, start + last), "right")
        for n in GRAMS:
            at = np.arange(min(last, max(0, len(piece) - n + 1)))
            at = at[at + start + n <= ends[row[at]]]
            bucket = _buckets(piece, n)[at] if len(at) else at
            own = row[at]
            if wanted is not None:
                some = wanted[bucket]
                bucket, own = bucket[some], own[some]
            fresh.append(np.unique(own << BITS | bucket))
            waiting += len(fresh[-1])
        if waiting > 1 << 22:
            found, fresh, waiting = np.unique(np.concatenate([found, *fresh])), [], 0
    found = np.unique(np.concatenate([found, *fresh]))
    return found >> BITS, found & ((1 << BITS) - 1)


def held_out(doc_id: Column) -> Column:
    """True for documents whose labels are not to be learnt from; a null doc_id counts as the empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def labelled(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """(text, toxic, rank) of at most ``most`` documents of the labelled ones that may be learnt from."""
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("rank", F.xxhash64("doc_id"))
    total = known.count()
    share = min(1.0, 1.1 * most / max(1, total) + 1e-9)  # by hash, so that no task sorts all labels; the limit makes it exact
    known = known.where(F.pmod("rank", F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1)).orderBy("rank", "doc_id").limit(most)
    known = known.select(F.col("doc_id").alias("labelled_id"), "toxic", "rank")
    rows = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("labelled_id"))
    return rows.select("doc_id", "text", (F.col("toxic") > 0).cast("int").alias("toxic"), "rank")


@dataclass
class Classifier:
    """weights: of a bucket's presence, ratio included; 0 where the classifier does not know the bucket."""

    bias: float
    weights: np.ndarray

    def score(self, docs: DataFrame) -> DataFrame:
        """(doc_id, score) for every row; null and empty texts score by the bias alone."""
        batches.bound(docs.sparkSession)
        shared = docs.sparkSession.sparkContext.broadcast((self.bias, self.weights))

        def of(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bias, weights = shared.value
            known = weights != 0
            for batch in found:
                rows, buckets = _present(batch.column("text"), known)
                z = bias + np.bincount(rows, weights[buckets], batch.num_rows)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700))))], names=["doc_id", "score"])

        return docs.select("doc_id", "text").mapInArrow(of, "doc_id long, score double")


def _counted(rows: DataFrame) -> DataFrame:
    """(bucket, toxic, docs): documents that have a bucket, counted by batch and then over all."""

    def of(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            at, buckets = _present(batch.column("text"))
            toxic = batch.column("toxic").to_numpy()[at] > 0
            all_, bad = (np.bincount(x, minlength=1 << BITS) for x in (buckets, buckets[toxic]))
            some = np.flatnonzero(all_)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(bad[some]), pa.array(all_[some])], names=["bucket", "toxic", "docs"])

    rows = rows.select("text", "toxic").mapInArrow(of, "bucket long, toxic long, docs long")
    return rows.groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("docs").alias("docs"))


def log_count_ratios(rows: DataFrame, smoothing: float = SMOOTHING, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(bucket, ratio, docs): the log of a bucket's share of all buckets of toxic documents over that of clean ones."""
    counts = materialize(_counted(rows), "grams")
    whole = counts.agg(F.sum("toxic").alias("toxic"), F.sum(F.col("docs") - F.col("toxic")).alias("clean"), F.count("*").alias("n")).first()
    bad, good = ((whole[c] or 0) + smoothing * whole["n"] for c in ("toxic", "clean"))
    ratio = F.log((F.col("toxic") + smoothing) / bad) - F.log((F.col("docs") - F.col("toxic") + smoothing) / good)
    return counts.where(F.col("docs") >= least_docs).select("bucket", ratio.alias("ratio"), "docs")


def _logistic(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, y: np.ndarray, width: int, penalty: float, steps: int = _STEPS) -> tuple[float, np.ndarray]:
    """Bias and weights of least mean loss and penalty, by accelerated gradient steps with restarts.

    Steps are scaled by column: a bound on the curvature is a quarter of the mean of value times the row's sum of values.
    """
    n = max(1, len(y))
    row_sums = 1 + np.bincount(rows, np.abs(values), len(y))
    scale = 1 / (np.bincount(columns, np.abs(values) * row_sums[rows], width) / (4 * n) + penalty)
    bias_scale = 4 * n / max(1.0, row_sums.sum())
    w, b = np.zeros(width), 0.0
    v, c, t = w, b, 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(c + np.bincount(rows, values * v[columns], len(y)), -700, 700)))
        slope, bias_slope = np.bincount(columns, values * (p - y)[rows], width) / n + penalty * v, float((p - y).mean()) if len(y) else 0.0
        new_w, new_b = v - scale * slope, c - bias_scale * bias_slope
        if slope @ (new_w - w) + bias_slope * (new_b - b) > 0:  # uphill: start the momentum anew
            t = 1.0
        after = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, c = new_w + (t - 1) / after * (new_w - w), new_b + (t - 1) / after * (new_b - b)
        w, b, t = new_w, new_b, after
    return b, w


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, penalty: float = PENALTY, least_docs: int = LEAST_DOCS) -> Classifier:
    """A classifier from the labelled documents that may be learnt from.

    A document with several labels is toxic if one says so; null labels and labels without a document count for nothing.
    Without documents of both kinds all texts score the share of toxic ones, (toxic + 1) / (all + 2). Equal tables give equal
    classifiers. The last step is one task over at most ``most`` documents and ``MOST_FEATURES`` buckets.
    """
    spark = docs.sparkSession
    batches.bound(spark)
    rows = materialize(labelled(docs, labels, most), "labelled")
    n, toxic = (int(x or 0) for x in rows.agg(F.count("*"), F.sum("toxic")).first())
    weights = np.zeros(1 << BITS)
    if not 0 < toxic < n:
        share = (toxic + 1) / (n + 2)
        return Classifier(math.log(share / (1 - share)), weights)
    kept = log_count_ratios(rows, least_docs=least_docs).orderBy(F.desc(F.abs("ratio") * F.sqrt("docs")), "bucket").limit(MOST_FEATURES).collect()
    buckets, ratios = np.array([r["bucket"] for r in kept], np.int64), np.array([r["ratio"] for r in kept])
    place = np.full(1 << BITS, -1, np.int64)
    place[buckets] = np.arange(len(buckets))
    shared = spark.sparkContext.broadcast((place, ratios))

    def features(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, _ = shared.value
        for batch in found:
            at, own = _present(batch.column("text"), place >= 0)
            first = np.searchsorted(at, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(first), pa.array(place[own].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("rank"), batch.column("doc_id"), batch.column("toxic"), lists], names=["rank", "doc_id", "toxic", "found"])

    def estimate(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, ratios = shared.value
        table = pa.Table.from_batches(list(found)).combine_chunks()
        lists = table["found"].chunk(0)
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        columns = lists.flatten().to_numpy()
        bias, weights = _logistic(np.repeat(np.arange(len(counts)), counts), columns, ratios[columns], table["toxic"].to_numpy().astype(float), len(ratios), penalty)
        yield pa.RecordBatch.from_arrays([pa.array([bias]), pa.array([weights.tolist()])], names=["bias", "weights"])

    known = rows.select("text", "toxic", "rank", "doc_id").mapInArrow(features, "rank long, doc_id long, toxic int, found array<int>")
    known = materialize(known, "features").coalesce(1).sortWithinPartitions("rank", "doc_id", "toxic", F.xxhash64("found"))
    model = known.mapInArrow(estimate, "bias double, weights array<double>").first()
    weights[buckets] = np.array(model["weights"]) * ratios
    return Classifier(model["bias"], weights)


def op11_toxicity(spark, sf_dir: str) -> DataFrame:
    """All documents scored. A row without a doc_id is not held out; edge cases else as in ``fit`` and ``score``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).score(docs)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
