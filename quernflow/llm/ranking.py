"""Ranked lexical search by Fagin's threshold algorithm over a document-partitioned index.

One pass counts the terms asked for in every document: the forward index. Corpus figures (documents, terms, documents with a
term) are sums over it. Then each task takes its documents in shards of bounded size: a shard's postings, sorted by impact,
are the inverted lists; lists are read in rounds, the same depth in each; a document that a list shows for the first time gets
its whole score from the forward index; an item stops once what unread postings could still give falls strictly below its
k-th score. That score is carried from shard to shard of a task, and the tasks' best meet in one ranking.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quernflow.llm import batches
from quernflow.scratch import materialize

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: As bytes: letters lower-case, what is in no term a space; beyond ASCII all is in terms.
_TABLE = bytes(ord(chr(b).lower()) if b > 127 or chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))
TOP = 10
#: (item, term) pairs that one search sends to all tasks, at most; more items are searched in further passes.
BLOCK_PAIRS = 200_000
#: Postings of a shard.
SHARD = 1 << 20
#: Text counted at a time.
_PIECE = 1 << 20
_FIRST_ROUND = 16


def terms_of(text: Column) -> Column:
    """The terms of a text, repeats included; null has none."""
    return F.coalesce(F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(TERM), F.lit(0)), F.array().cast("array<string>"))


def _pieces(raw: bytes) -> Iterator[bytes]:
    """Stretches of about ``_PIECE`` bytes, cut between terms."""
    start = 0
    while start < len(raw):
        end = raw.find(b" ", start + _PIECE)
        end = len(raw) if end < 0 else end
        yield raw[start:end]
        start = end


def forward_index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs): a document's terms with repeats, and the vocabulary's numbers in it with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))])

    def of(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in found:
            sizes, terms, tfs = [], [], []
            for raw in batch.column("text").cast(pa.binary()):
                n, counts = 0, Counter()
                for piece in _pieces((raw.as_py() or b"").translate(_TABLE)):
                    words = piece.split(b" ")
                    n += len(words) - words.count(b"")
                    counts.update(map(number, words))
                counts.pop(None, None)
                sizes.append(n)
                terms.append(list(counts))
                tfs.append(list(counts.values()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *(pa.array(x, f.type) for x, f in zip((sizes, terms, tfs), list(schema)[1:], strict=True))], schema=schema)

    batches.bound(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(of, "doc_id long, n long, terms array<int>, tfs array<long>")


class _Shard:
    """Some documents: postings by document, and as lists by falling impact."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, counts: np.ndarray, terms: np.ndarray, tfs: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int):
        self.ids, self.counts, self.terms = ids, counts, terms
        self.first = np.concatenate([[0], np.cumsum(counts)])
        m = 100 - 75 + (75 * sizes * n_docs) // n_terms
        row = np.repeat(np.arange(len(ids)), counts)
        self.impacts = weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * m[row]))
        order = np.lexsort((-self.impacts, terms))
        self.list_docs, self.list_impacts = row[order], self.impacts[order]
        self.list_first = np.searchsorted(terms[order], np.arange(len(weights) + 1))

    def scores(self, docs: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Whole scores of documents, each with a posting at least, from the forward index."""
        counts = self.counts[docs]
        ends = np.cumsum(counts)
        at = np.arange(ends[-1]) + np.repeat(self.first[docs] - (ends - counts), counts)
        return np.add.reduceat(asked[self.terms[at]] * self.impacts[at], ends - counts)

    def search(self, terms: np.ndarray, repeats: np.ndarray, asked: np.ndarray, best: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best (score, doc_id) of ``best`` and this shard. asked: the item's repeats by term."""
        start, end = self.list_first[terms], self.list_first[terms + 1]
        seen = np.zeros(len(self.ids), bool)
        depth, step = 0, _FIRST_ROUND
        while (start + depth < end).any():
            at = start[:, None] + np.arange(depth, depth + step)
            docs = np.unique(self.list_docs[at[at < end[:, None]]])
            depth, step = depth + step, step * 2
            docs = docs[~seen[docs]]
            if len(docs):
                seen[docs] = True
                scores = np.concatenate([best[0], self.scores(docs, asked)])
                ids = np.concatenate([best[1], self.ids[docs]])
                kept = np.lexsort((ids, -scores))[:k]
                kept = kept[scores[kept] > 0]
                best = scores[kept], ids[kept]
            left = start + depth < end  # what is unread gives no more than what was read last
            threshold = int((repeats * self.list_impacts[np.minimum(start + depth, end) - 1])[left].sum())
            if len(best[0]) == k and threshold < best[0][-1]:
                break
        return best


#: Documents without an id come last among equal scores.
_NO_ID = np.iinfo(np.int64).max


def _shards(found: Iterable[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Whole documents with a posting at least, as many as have ``most`` postings together, or one that has more."""
    kept: list[tuple[np.ndarray, ...]] = []
    total = 0
    for batch in found:
        ids, sizes = (pc.fill_null(batch.column(c), v).to_numpy(zero_copy_only=False) for c, v in (("doc_id", _NO_ID), ("n", 0)))
        lists = batch.column("terms")
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        terms, tfs = lists.flatten().to_numpy(), batch.column("tfs").flatten().to_numpy()
        ends = np.cumsum(counts)
        at = 0
        while at < len(ids):
            before = ends[at] - counts[at]
            to = max(at + 1, int(np.searchsorted(ends, before + most - total, "right")))
            some = counts[at:to] > 0
            kept.append((ids[at:to][some], sizes[at:to][some], counts[at:to][some], terms[before : ends[to - 1]], tfs[before : ends[to - 1]]))
            total, at = total + int(ends[to - 1] - before), to
            if total >= most or at < len(ids):
                yield tuple(np.concatenate(x) for x in zip(*kept, strict=True))
                kept, total = [], 0
    if kept:
        yield tuple(np.concatenate(x) for x in zip(*kept, strict=True))


def _search_block(docs: DataFrame, asked: DataFrame, k: int, shard: int) -> DataFrame:
    """(key, doc_id, score): each task's best for the items of ``asked`` (key, term, repeats), which are few enough to send."""
    spark = docs.sparkSession
    rows = asked.orderBy("key", "term").collect()
    vocabulary = {t: i for i, t in enumerate(sorted({r["term"] for r in rows}))}
    forward = materialize(forward_index(docs, {t.encode(): i for t, i in vocabulary.items()}), "forward")
    figures = forward.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    n_docs, n_terms = int(figures["docs"]), int(figures["terms"])
    weights = np.zeros(len(vocabulary), np.int64)
    for r in forward.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row a term of the vocabulary
        weights[r["term"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["count"] + 1)))
    items: dict[int, list[tuple[int, int]]] = {}
    for r in rows:
        items.setdefault(r["key"], []).append((vocabulary[r["term"]], r["repeats"]))
    asked_for = {key: tuple(np.array(x, np.int64) for x in zip(*pairs, strict=True)) for key, pairs in items.items()}
    shared = spark.sparkContext.broadcast((weights, asked_for))
    schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def of(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, asked_for = shared.value
        nothing = np.zeros(0, np.int64)
        best = dict.fromkeys(asked_for, (nothing, nothing))
        dense = np.zeros(len(weights), np.int64)
        for part in _shards(found, shard):
            here = _Shard(*part, weights, n_docs, n_terms)
            for key, (terms, repeats) in asked_for.items():
                dense[terms] = repeats
                best[key] = here.search(terms, repeats, dense, best[key], k)
                dense[terms] = 0
        for key, (scores, ids) in best.items():
            if len(ids):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), key)), pa.array(ids, mask=ids == _NO_ID), pa.array(scores)], schema=schema)

    return forward.select("doc_id", "n", "terms", "tfs").mapInArrow(of, "key long, doc_id long, score long")


def _join_scores(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """(key, doc_id, score) by joins alone, for items with too many terms to send to a task."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", terms_of(F.col("text")).alias("terms"))
    rows = materialize(rows.withColumn("n", F.size("terms").cast("long")), "terms")
    figures = rows.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    n_docs, n_terms = int(figures["docs"]), int(figures["terms"])
    counted = rows.select("row", "doc_id", "n", F.explode("terms").alias("term")).groupBy("row", "doc_id", "n", "term").agg(F.count("*").alias("tf"))
    counted = materialize(counted.join(asked.select("term").distinct(), "term", "left_semi"), "postings")
    weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1)))
    weights = counted.groupBy("term").agg(F.count("*").alias("df")).select("term", weight.alias("w"))
    m = F.expr(f"25 + (75 * n * {n_docs}L) div {max(1, n_terms)}L")
    scored = counted.withColumn("m", m).join(weights, "term").withColumn("impact", F.expr("w * ((1000000000 * tf) div (1000 * tf + 8 * m))"))
    scored = scored.join(asked, "term").groupBy("key", "row", "doc_id").agg(F.sum(F.col("impact") * F.col("repeats")).alias("score"))
    return scored.where("score > 0").select("key", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block_pairs: int = BLOCK_PAIRS, shard: int = SHARD) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item, equal scores by ascending doc_id.

    Every row of ``docs`` is a document and every row of ``items`` an item, also where an id is null or repeats; documents
    without an id come last among equals. Null and empty texts have no terms, and an item without one has no rows; nor has
    any on an empty table. Texts count whole, very long ones in pieces; other columns are not looked at. At most
    ``block_pairs`` pairs of item and term are sent to the tasks at a time, further items are a further pass over ``docs``,
    and an item that has more than that by itself is scored by joins.
    """
    items = materialize(items.select(F.monotonically_increasing_id().alias("key"), "item_id", terms_of(F.col("text")).alias("terms")), "items")
    asked = items.select("key", F.explode("terms").alias("term")).groupBy("key", "term").agg(F.count("*").alias("repeats"))
    asked = materialize(asked, "asked")
    widths = asked.groupBy("key").agg(F.count("*").alias("pairs"))
    wide = widths.where(F.col("pairs") > block_pairs).select("key")
    narrow = asked.join(wide, "key", "left_anti")
    n_wide, blocks = wide.count(), 1
    while True:  # as many blocks, by hash of the item, as keep each under its bound
        block = F.pmod(F.xxhash64("key"), F.lit(blocks))
        sizes = [r["count"] for r in narrow.groupBy(block.alias("block")).count().orderBy(F.desc("count")).take(1)]
        if not sizes or sizes[0] <= block_pairs:
            break
        blocks *= 2
    found = docs.sparkSession.createDataFrame([], "key long, doc_id long, score long")
    for i in range(blocks if sizes else 0):
        found = found.unionByName(_search_block(docs, narrow.where(block == i), k, shard))
    if n_wide:
        found = found.unionByName(_join_scores(docs, asked.join(wide, "key", "left_semi")))
    rank = F.row_number().over(W.partitionBy("key").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    best = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.join(items.select("key", "item_id"), "key").select("item_id", "rank", "doc_id", "score")


def op12_search(spark, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item. Edge cases as in ``search``."""
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: DuckDB SQL for op12_search: every document scored for every item that shares a term.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
q AS (SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM benchmark),
c AS (SELECT count(*)::BIGINT AS big_n, coalesce(sum(len(ts)), 0)::BIGINT AS big_l FROM d WHERE len(ts) > 0),
a AS (SELECT i, item_id, t, count(*)::BIGINT AS repeats FROM (SELECT i, item_id, unnest(ts) AS t FROM q) GROUP BY ALL),
p AS (SELECT k, doc_id, n, t, count(*)::BIGINT AS tf FROM (SELECT k, doc_id, len(ts)::BIGINT AS n, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM a) GROUP BY ALL),
w AS (SELECT t, floor(1000::DOUBLE * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, c GROUP BY t, big_n),
x AS (SELECT k, doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * big_n) // big_l))) AS impact FROM p JOIN w USING (t), c),
s AS (SELECT i, item_id, k, doc_id, sum(impact * repeats)::BIGINT AS score FROM x JOIN a USING (t) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM r WHERE rank <= 10
"""
