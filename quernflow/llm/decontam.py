"""Benchmark passages in documents, within an edit budget: q-gram lemma filtering, then banded alignment.

An item of m characters within k edits of a stretch of text shares at least ``m - q + 1 - k * q`` q-grams with it, on
diagonals that lie within k of each other. Diagonals are cut into bands of twice ``k + 1``, one every ``k + 1``, so some
band holds all of those q-grams; bands with enough of them are aligned, and no occurrence is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernflow.llm import batches

Q = 8
MAX_ERROR = 0.1
#: Characters of benchmark text indexed and broadcast at a time; a larger benchmark takes several passes.
BLOCK_CHARS = 4_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BITS = 22
_CHUNK = 1 << 19
#: Places of q-grams in the benchmark that are looked at together.
_ROWS = 1 << 20

RESULT = "doc_id long, item_id long, edits int, start int, length int"


def normal(text: str | None) -> str:
    """Lower case, white space runs as one space."""
    return " ".join((text or "").lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def qgrams(chars: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit polynomial hash of each q-gram, built by doubling."""
    n = len(chars) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        power, width, part = _BASE, 1, chars.astype(np.uint64) + np.uint64(1)
        out, done = None, 0
        while True:
            if q & width:
                tail = part[done : done + n]
                out = tail.copy() if out is None else out * power + tail
                done += width
            if done == q:
                return out ^ out >> np.uint64(29)
            part = part[:-width] * power + part[width:]
            power, width = power * power, width * 2


class Index:
    """A block of items: those too short for a q-gram and for an edit as they are, the others' q-grams by size.

    An item's grams are as long as the lemma allows, ``q`` at most: with k edits in m characters one of m // (k + 1) is left
    whole. So each item has the budget of its length, and from 40 characters on (at a tenth) grams of 8.
    """

    def __init__(self, items: list[tuple[int | None, str]], q: int = Q, max_error: float = MAX_ERROR):
        self.short, self.items = [], []
        for item_id, text in items:
            text = normal(text)
            edits = int(max_error * len(text))
            if 0 < len(text) < q and not edits:
                self.short.append((item_id, text))
            elif text:
                self.items.append((item_id, text, edits))
        sized: dict[int, list] = {}
        for item in self.items:
            sized.setdefault(min(q, len(item[1]) // (item[2] + 1)), []).append(item)
        self.parts = [Grams(some, size) for size, some in sorted(sized.items())]


class Grams:
    """The q-grams of items (item_id, text, edits), with their places."""

    def __init__(self, items: list[tuple[int | None, str, int]], q: int):
        self.q, self.items = q, items
        grams = [qgrams(codes(t), q) for _, t, _ in self.items]
        keys = np.concatenate(grams)
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams])
        order = np.argsort(keys, kind="stable")
        self.owner, self.place = owner[order].astype(np.int64), place[order].astype(np.int64)
        self.keys, self.first, self.count = np.unique(keys[order], return_index=True, return_counts=True)
        self.stride = np.array([k + 1 for _, _, k in self.items], dtype=np.int64)
        self.least = np.array([len(t) - q + 1 - k * q for _, t, k in self.items], dtype=np.int64)
        self.seen = np.zeros(1 << _BITS, dtype=bool)
        self.seen[(self.keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def _expanded(self, at: np.ndarray, key: np.ndarray, shift: np.int64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(item and band, place in the item) of hits, each in the two bands that hold it, some hits at a time."""
        upto = np.cumsum(self.count[key])
        first = 0
        while first < len(key):
            before = int(upto[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(upto, before + _ROWS, "right")))
            n = self.count[key[first:last]]
            row = np.repeat(self.first[key[first:last]] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(int(n.sum()))
            item, place = self.owner[row], self.place[row]
            band = item * shift + (np.repeat(at[first:last], n) - place) // self.stride[item] + 1_000_000
            yield np.concatenate([band, band - 1]), np.tile(place, 2)
            first = last

    def candidates(self, chars: np.ndarray) -> np.ndarray:
        """(item, band) rows whose bands hold enough shared q-grams; band b starts at diagonal b * stride."""
        hits_at, hits_key = [], []
        for at in range(0, len(chars), _CHUNK):
            grams = qgrams(chars[at : at + _CHUNK + self.q - 1], self.q)
            some = np.flatnonzero(self.seen[(grams >> np.uint64(64 - _BITS)).astype(np.int64)])
            where = np.searchsorted(self.keys, grams[some])
            where[where == len(self.keys)] = 0
            good = self.keys[where] == grams[some]
            hits_at.append(some[good] + at)
            hits_key.append(where[good])
        at, key = np.concatenate(hits_at), np.concatenate(hits_key)
        shift = np.int64(1) << 36
        parts = list(self._expanded(at, key, shift))
        if not parts:
            return np.zeros((0, 2), np.int64)
        if len(parts) > 1:
            # count first, in a table of fixed size, so that only bands that may have enough are held together
            votes = np.zeros(1 << _BITS, np.int64)
            slot = lambda both: (both.astype(np.uint64) * _BASE >> np.uint64(64 - _BITS)).astype(np.int64)
            for both, _ in self._expanded(at, key, shift):
                votes += np.bincount(slot(both), minlength=len(votes))
            parts = []
            for both, place in self._expanded(at, key, shift):
                some = votes[slot(both)] >= self.least[both // shift]
                parts.append((both[some], place[some]))
        both, place = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.argsort(both)
        both = both[order]
        cuts = np.flatnonzero(np.r_[True, both[1:] != both[:-1]])
        votes = np.diff(np.r_[cuts, len(both)])
        cuts, votes = cuts[keep := votes >= self.least[both[cuts] // shift]], votes[keep]
        # a q-gram that the text repeats counts once: the lemma is about the item's places
        place = place[order]
        many = [len(np.unique(place[c : c + v])) for c, v in zip(cuts.tolist(), votes.tolist(), strict=True)]
        found = both[cuts]
        found = found[np.array(many, dtype=np.int64) >= self.least[found // shift]]
        return np.stack([found // shift, found % shift - 1_000_000], axis=1)


def banded(pattern: np.ndarray, text: np.ndarray, low: int, high: int, budget: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best place of the whole pattern in the text whose path stays on diagonals low..high."""
    width, n = high - low + 1, len(text)
    offsets = np.arange(width)
    far = budget + len(pattern) + 1
    cost = np.where((low + offsets >= 0) & (low + offsets <= n), 0, far)
    start = low + offsets
    for i, char in enumerate(pattern, 1):
        j = i + low + offsets
        inside = (j >= 0) & (j <= n)
        same = np.ones(width, dtype=np.int64)
        ok = (j >= 1) & (j <= n)
        same[ok] = text[j[ok] - 1] != char
        across = np.where(j >= 1, cost + same, far)
        down = np.r_[cost[1:] + 1, far]
        best = np.where(inside, np.minimum(across, down), far)
        came = np.where(across <= down, start, np.r_[start[1:], 0])
        run = np.minimum.accumulate(best - offsets)
        new = run + offsets
        source = np.maximum.accumulate(np.where(best - offsets == run, offsets, 0))
        cost, start = np.where(inside, new, far), came[source]
        if cost.min() > budget:
            return None
    at = int(cost.argmin())
    return (int(cost[at]), int(start[at]), len(pattern) + low + at) if cost[at] <= budget else None


def within_budget(chars: np.ndarray, jobs: list[tuple[np.ndarray, int, int, int, int, int]]) -> np.ndarray:
    """For jobs (pattern, text start, text length, low, high, budget): whether ``banded`` would find a place.

    The same recurrence for all jobs at once, a row of the pattern at a time.
    """
    order = sorted(range(len(jobs)), key=lambda i: -len(jobs[i][0]))
    sizes = np.array([len(jobs[i][0]) for i in order])
    base, length, low, high, budget = (np.array([jobs[i][k] for i in order], dtype=np.int64)[:, None] for k in range(1, 6))
    patterns = np.zeros((len(jobs), int(sizes[0])), dtype=np.uint32)
    for row, i in enumerate(order):
        patterns[row, : sizes[row]] = jobs[i][0]
    offsets = np.arange(int((high - low).max()) + 1)[None, :]
    far = int(sizes[0]) + int(budget.max()) + 1
    lane = offsets <= high - low
    cost = np.where(lane & (low + offsets >= 0) & (low + offsets <= length), 0, far)
    live, done = np.arange(len(jobs)), np.zeros(len(jobs), dtype=bool)
    for i in range(1, int(sizes[0]) + 1):
        j = i + low[live] + offsets
        inside = lane[live] & (j >= 0) & (j <= length[live])
        at = base[live] + np.clip(j, 1, np.maximum(length[live], 1)) - 1
        differ = (chars[at] != patterns[live, i - 1][:, None]) | (j < 1) | (j > length[live])
        across = np.where(j >= 1, cost + differ, far)
        down = np.concatenate([cost[:, 1:] + 1, np.full((len(live), 1), far)], axis=1)
        best = np.where(inside, np.minimum(across, down), far)
        cost = np.where(inside, np.minimum.accumulate(best - offsets, axis=1) + offsets, far)
        good = cost.min(axis=1) <= budget[live, 0]
        done[live[good & (sizes[live] == i)]] = True
        keep = good & (sizes[live] > i)
        if not keep.all():
            live, cost = live[keep], cost[keep]
            if not len(live):
                break
    out = np.zeros(len(jobs), dtype=bool)
    out[np.array(order)[done]] = True
    return out


def matches(texts: list[str], index: Index) -> Iterator[tuple[int, int, int, int, int]]:
    """(text number, item_id, edits, start, length) of the best occurrence of each item in each normalised text."""
    for number, text in enumerate(texts):
        for item_id, pattern in index.short:  # too short for a q-gram and for an edit
            at = text.find(pattern)
            if at >= 0:
                yield number, item_id, 0, at, len(pattern)
    if not index.items:
        return
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    chars = codes("\0".join(texts) + "\0")
    for part in index.parts:
        yield from _matches(texts, starts, chars, part)


def _matches(texts: list[str], starts: np.ndarray, chars: np.ndarray, index: Grams) -> Iterator[tuple[int, int, int, int, int]]:
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    jobs, about = [], []
    for item, band in index.candidates(chars):
        _, pattern, budget = index.items[item]
        stride = int(index.stride[item])
        low, high = int(band) * stride, int(band) * stride + 2 * stride - 1
        first = max(0, int(np.searchsorted(starts, max(low, 0), "right")) - 1)
        last = min(len(texts) - 1, int(np.searchsorted(starts, high + len(pattern), "right")) - 1)
        for number in range(first, last + 1):
            base, size = int(starts[number]), len(texts[number])
            lo, hi = max(0, low - base - budget), min(size, high - base + len(pattern) + budget)
            if hi - lo < len(pattern) - budget:
                continue
            exact = texts[number].find(pattern, lo, hi)
            if exact >= 0:
                best[number, item] = (0, exact, len(pattern))
            else:
                jobs.append((codes(pattern), base, size, low - base - budget, high - base + budget, budget))
                about.append((number, item))
    for at in range(0, len(jobs), 4000):
        part = jobs[at : at + 4000]
        for i in np.flatnonzero(within_budget(chars, part)):
            pattern, base, size, low, high, budget = part[i]
            key = about[at + i]
            found = banded(pattern, chars[base : base + size], low, high, budget)
            if found and found[0] < best.get(key, (budget + 1,))[0]:
                best[key] = (found[0], found[1], found[2] - found[1])
    for (number, item), (edits, at, length) in best.items():
        yield number, index.items[item][0], edits, at, length


def find_leaks(docs: DataFrame, benchmark: DataFrame, max_error: float = MAX_ERROR, q: int = Q, block_chars: int = BLOCK_CHARS, unnamed: bool = False) -> DataFrame:
    """(doc_id, item_id, edits, start, length): each item that occurs in a document within its budget, at its best place.

    The budget is ``max_error`` of the item's characters, rounded down, whatever its length; null or empty items match nothing, and
    those without an id are passed over, or with ``unnamed`` found under a null one. Places count characters of the text in lower case with single spaces. The benchmark is indexed in blocks of ``block_chars`` characters at most (more only for one longer item), each
    broadcast and held against all documents. Null texts match nothing; repeated rows are found each by itself, and equal
    results are one row; no rows for an empty table.
    """
    spark = docs.sparkSession
    batches.bound(spark)
    items = benchmark.where("text is not null" if unnamed else "text is not null and item_id is not null").groupBy("item_id", "text").agg(F.length("text").alias("n"))
    blocks = max(1, ceil((items.agg(F.sum("n")).first()[0] or 0) / block_chars))
    out = None
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        shared = spark.sparkContext.broadcast([(r["item_id"], r["text"]) for r in mine.orderBy("item_id", "text").select("item_id", "text").toLocalIterator()])
        found = docs.select("doc_id", "text").where("text is not null").mapInArrow(_search(shared, q, max_error), RESULT)
        out = found if out is None else out.unionByName(found)
    return out.distinct()


def _search(shared, q: int, max_error: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(shared.value, q, max_error)
        for batch in batches:
            ids, column = batch.column(0).to_pylist(), batch.column(1)
            texts, held, rows = [], 0, []
            at = 0
            for i in range(batch.num_rows):
                texts.append(normal(column[i].as_py()))
                held += len(texts[-1])
                if held > 1 << 21 or i == batch.num_rows - 1:
                    rows += [(ids[at + n], *found) for n, *found in matches(texts, index)]
                    texts, held, at = [], 0, i + 1
            if rows:
                cols = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "item_id", "edits", "start", "length"])

    return run


def drop_leaks(docs: DataFrame, benchmark: DataFrame, max_error: float = MAX_ERROR, q: int = Q) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item occurs, with an id or without one; all columns come back.

    Texts are searched and dropped under the 64-bit hash of the text, so repeated or missing doc_ids do not matter.
    """
    key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    leaks = find_leaks(docs.select(key.alias("doc_id"), "text"), benchmark, max_error, q, unnamed=True).select(F.col("doc_id").alias("leak")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), key.alias("leak"))
    return rows.join(leaks, "leak", "left_anti").select("row.*")


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), unnamed=True)
