"""Removal of byte strings that an earlier document holds too, with run-length indexes over parts of the corpus.

Equal 50-byte strings have the same least-hashed 24-mer at the same place, so each document is cut into stretches of windows
with one such anchor, and stretches with one anchor meet in one part, wherever they come from. Equal stretches need only
their least doc_id. Where an anchor stands in different stretches, their texts are fetched once each, and a run-length index
of the part's texts streams the lengths of their matches and marks windows that an earlier document has (see ``rindex``).
Stretches and marks travel as packed arrays, a row per batch and part; texts are dealt by document only. Stretches that a
bounded sample shows to be frequent do not gather in one part (see ``frequent_stretches``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernflow.llm import batches as arrow
from quernflow.llm import rindex
from quernflow.scratch import materialize

LENGTH, ANCHOR = 50, 24
#: Bytes of text whose stretches make a part, and bytes of text in a document bucket: what one task holds at a time.
PART = 8 << 20
_PIECE = 2 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_LAST = np.iinfo(np.int64).max  # stands for a null doc_id, which is later than any other

#: Documents in the sample for frequent stretches, about; documents of it that have a frequent one; how many are kept.
SAMPLE, SEEN, MOST_FREQUENT = 8_000, 8, 100_000

STRETCHES = "part int, ids binary, texts binary, anchor binary, stretch binary, doc binary, start binary, windows binary, told binary"
MARKS = "kind int, bucket int, id binary, key binary, part binary, first binary, last binary"


def anchor_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A scrambled polynomial hash of each k-mer, by doubling."""
    n = len(data) - k + 1
    power, width, part = _BASE, 1, data.astype(np.uint64) + np.uint64(1)
    out, done = None, 0
    with np.errstate(over="ignore"):
        while True:
            if k & width:
                tail = part[done : done + n]
                out = tail.copy() if out is None else out * power + tail
                done += width
            if done == k:
                break
            part = part[:-width] * power + part[width:]
            power, width = power * power, width * 2
        out ^= out >> np.uint64(32)
        out *= _MIX
        out ^= out >> np.uint64(29)
    return out


def least_in_window(hashes: np.ndarray, w: int) -> np.ndarray:
    """Place of the first least hash (by its upper 40 bits) in each run of w hashes; fewer than 2^24 hashes at a time."""
    low = np.uint64(24)
    best = hashes >> low << low | np.arange(len(hashes), dtype=np.uint64)
    size = 1
    while size * 2 <= w:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    if w > size:
        best = np.minimum(best[: len(best) - (w - size)], best[w - size :])
    return (best & np.uint64((1 << 24) - 1)).astype(np.int64)


def stretches(texts: list[bytes], length: int = LENGTH, k: int = ANCHOR) -> Iterator[tuple[np.ndarray, ...]]:
    """(text number, start, windows, anchor hash, stretch hash) arrays over all windows of the texts."""
    pieces: list[tuple[int, int, bytes]] = []
    held = 0
    for number, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), _PIECE):
            piece = text[at : at + _PIECE + length - 1]
            if len(piece) >= length:
                pieces.append((number, at, piece))
                held += len(piece)
                if held >= _PIECE:
                    yield _stretches(pieces, length, k)
                    pieces, held = [], 0
    if pieces:
        yield _stretches(pieces, length, k)


def _stretches(pieces: list[tuple[int, int, bytes]], length: int, k: int) -> tuple[np.ndarray, ...]:
    joined = b"".join(p for _, _, p in pieces)
    offsets = np.cumsum([0, *(len(p) for _, _, p in pieces)])
    hashes = anchor_hashes(np.frombuffer(joined, np.uint8), k)
    place = least_in_window(hashes, length - k + 1)
    piece = np.repeat(np.arange(len(pieces)), np.diff(offsets))[: len(place)]
    window = np.flatnonzero(np.arange(len(place)) + length <= offsets[piece + 1])
    place, piece = place[window], piece[window]
    cut = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (piece[1:] != piece[:-1])])
    count = np.diff(np.r_[cut, len(window)])
    first = window[cut]
    hashed = xxhash.xxh3_64_intdigest
    texts = np.array([hashed(joined[a:b]) for a, b in zip(first.tolist(), (first + count + length - 1).tolist(), strict=True)], dtype=np.uint64)
    with np.errstate(over="ignore"):
        anchor = hashes[place[cut]] * _BASE
        anchor ^= anchor >> np.uint64(31)
    number = np.array([p[0] for p in pieces])[piece[cut]]
    start = first - offsets[piece[cut]] + np.array([p[1] for p in pieces])[piece[cut]]
    return number, start, count, anchor, texts


def _part_of(anchor: np.ndarray, parts: int) -> np.ndarray:
    return ((anchor >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _batch(names_kinds: str, rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in names_kinds.split(", ")]
    kinds = [{"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}[x.split()[1]] for x in names_kinds.split(", ")]
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _holders(length: int, k: int):
    """(stretch, anchor, id, n): distinct stretches of a batch with the least id and the number of the documents that have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for number, _, _, anchor, text in stretches(batch.column(2).to_pylist(), length, k):
                order = np.lexsort((ids[number], text))
                text, anchor, at = text[order], anchor[order], ids[number][order]
                cut = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
                new = np.r_[True, (text[1:] != text[:-1]) | (at[1:] != at[:-1])]
                yield pa.RecordBatch.from_arrays([pa.array(text[cut].view(np.int64)), pa.array(anchor[cut].astype(np.uint32).astype(np.int64)), pa.array(at[cut]), pa.array(np.add.reduceat(new.astype(np.int64), cut))], names=["stretch", "anchor", "id", "n"])

    return run


def frequent_stretches(rows: DataFrame, count: int, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches that many of about ``SAMPLE`` documents have, in order, their anchors, and for each the least id among those.

    Whoever has one of them under a larger id has it from an earlier document, whatever others there are; so only the few
    below that id need meet in the stretch's part. This bears on where a repeat is decided, not on what is removed.
    """
    drawn = F.pmod(F.xxhash64("id", "key"), F.lit(count // SAMPLE + 1)) == 0
    found = rows.where(drawn).mapInArrow(_holders(length, k), "stretch long, anchor long, id long, n long")
    found = found.groupBy("stretch", "anchor").agg(F.sum("n").alias("n"), F.min("id").alias("id")).where(F.col("n") >= SEEN)
    top = found.orderBy(F.desc("n"), "stretch").limit(MOST_FREQUENT).collect()
    table = np.array([(r["stretch"], r["anchor"], r["id"]) for r in top], dtype=np.int64).reshape(-1, 3)
    known = np.ascontiguousarray(table[:, 0]).view(np.uint64)
    order = np.argsort(known, kind="stable")
    return known[order], table[order, 1].astype(np.uint32), table[order, 2]


def _told(frequent, text: np.ndarray, anchor: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Entries of frequent stretches whose document comes after one that is known to have the same."""
    known, anchors, least = frequent
    if not len(known):
        return np.zeros(len(text), dtype=bool)
    at = np.minimum(np.searchsorted(known, text), len(known) - 1)
    return (known[at] == text) & (anchors[at] == anchor.astype(np.uint32)) & (ids > least[at])


def _cut(parts: int, length: int, k: int, shared):
    """Documents (id, key, text) to packed stretches by part; what is told already goes to any part, by its document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for number, start, count, anchor, text in stretches(batch.column(2).to_pylist(), length, k):
                told = _told(shared.value, text, anchor, ids[number])
                part = np.where(told, _bucket(keys[number], parts), _part_of(anchor, parts))
                order = np.argsort(part, kind="stable")
                edges = np.flatnonzero(np.r_[True, np.diff(part[order]) > 0])
                rows = []
                for a, b in zip(edges.tolist(), np.r_[edges[1:], len(order)].tolist(), strict=True):
                    at = order[a:b]
                    docs, local = np.unique(number[at], return_inverse=True)
                    rows.append((int(part[at[0]]), ids[docs].tobytes(), keys[docs].tobytes(), anchor[at].astype(np.uint32).tobytes(), text[at].tobytes(), local.astype(np.uint32).tobytes(), start[at].astype(np.uint32).tobytes(), count[at].astype(np.uint8).tobytes(), told[at].astype(np.uint8).tobytes()))
                yield _batch(STRETCHES, rows)

    return run


def _groups(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[int, list[tuple]]]:
    """Rows of batches sorted by ``column``, a list of raw values for each of its values."""
    held, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[column] != held:
                if rows:
                    yield held, rows
                held, rows = row[column], []
            rows.append(row)
    if rows:
        yield held, rows


def _pack(kind: int, buckets: int, ids, keys, part, first, last) -> list[tuple]:
    """Marks (kind 0) or requests (kind 1) of documents, a row per bucket of documents."""
    bucket = _bucket(keys, buckets)
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.r_[True, np.diff(bucket[order]) > 0]) if len(order) else []
    out = []
    for a, b in zip(edges, [*edges[1:], len(order)] if len(order) else [], strict=True):
        at = order[a:b]
        out.append((kind, int(bucket[at[0]]), ids[at].tobytes(), keys[at].tobytes(), part[at].astype(np.int32).tobytes(), first[at].astype(np.uint32).tobytes(), last[at].astype(np.uint32).tobytes()))
    return out


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys.view(np.uint64) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _meet(buckets: int, length: int):
    """Stretches of a part to marks of those that an earlier document has whole, and requests for the texts of others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _groups(batches, 0):
            base = np.cumsum([0, *(len(r[1]) // 8 for r in rows)])
            ids, keys = (np.frombuffer(b"".join(r[i] for r in rows), np.int64) for i in (1, 2))
            anchor, start = (np.frombuffer(b"".join(r[i] for r in rows), np.uint32) for i in (3, 6))
            text = np.frombuffer(b"".join(r[4] for r in rows), np.uint64)
            doc = np.concatenate([np.frombuffer(r[5], np.uint32) + b for r, b in zip(rows, base[:-1], strict=True)])
            windows = np.frombuffer(b"".join(r[7] for r in rows), np.uint8)
            told = np.frombuffer(b"".join(r[8] for r in rows), np.uint8).astype(bool)
            begin, end = start[told].astype(np.int64), start[told].astype(np.int64) + windows[told] + length - 1
            out = _pack(0, buckets, ids[doc[told]], keys[doc[told]], np.full(len(begin), part), begin, end)
            anchor, text, doc, start, windows = (c[~told] for c in (anchor, text, doc, start, windows))
            if not len(doc):
                yield _batch(MARKS, out)
                continue
            order = np.lexsort((text, anchor))
            anchor, text, doc = anchor[order], text[order], doc[order]
            first, last = start[order].astype(np.int64), start[order].astype(np.int64) + windows[order]
            place = ids[doc]
            new_anchor = np.r_[True, anchor[1:] != anchor[:-1]]
            new_entry = new_anchor | np.r_[True, text[1:] != text[:-1]]
            entry_at, anchor_at = np.flatnonzero(new_entry), np.flatnonzero(new_anchor)
            entry = np.cumsum(new_entry) - 1
            least = np.minimum.reduceat(place, entry_at)[entry]
            later = place > least
            # an anchor in different stretches of different documents: windows of a stretch may stand in another one
            group = np.cumsum(new_anchor) - 1
            several = (np.add.reduceat(new_entry.astype(np.int64), anchor_at) > 1) & (np.minimum.reduceat(place, anchor_at) < np.maximum.reduceat(place, anchor_at))
            ask = ~later & several[group]
            where = np.full(len(doc), part)
            out += _pack(0, buckets, place[later], keys[doc[later]], where[later], first[later], last[later] + length - 1)
            out += _pack(1, buckets, place[ask], keys[doc[ask]], where[ask], first[ask], last[ask] + length - 1)
            yield _batch(MARKS, out)

    return run


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bucket's requests, then its documents: the texts asked for, packed by part."""
    for _, rows, docs in _with_documents(batches):
        ids, keys, part, first, last = _arrays(rows)
        out: dict[int, list[list]] = {}
        for i, key, text in docs:
            a, b = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            for at in range(a, b):
                if ids[at] == i:
                    lists = out.setdefault(int(part[at]), [[], [], [], []])
                    for held, value in zip(lists, (i, key, int(first[at]), text[first[at] : last[at]]), strict=True):
                        held.append(value)
        packed = [(p, np.array(i, np.int64).tobytes(), np.array(k, np.int64).tobytes(), np.array(f, np.uint32).tobytes(), np.array([len(t) for t in texts], np.uint32).tobytes(), b"".join(texts)) for p, (i, k, f, texts) in out.items()]
        yield _batch(_TEXTS, packed)


_TEXTS = "part int, id binary, key binary, first binary, size binary, text binary"


def _arrays(rows: list[tuple]) -> tuple[np.ndarray, ...]:
    """Packed marks or requests, sorted by text key."""
    ids, keys = (np.frombuffer(b"".join(r[i] for r in rows), np.int64) for i in (2, 3))
    part = np.frombuffer(b"".join(r[4] for r in rows), np.int32)
    first, last = (np.frombuffer(b"".join(r[i] for r in rows), np.uint32) for i in (5, 6))
    order = np.argsort(keys, kind="stable")
    return ids[order], keys[order], part[order], first[order], last[order]


def _with_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple], Iterator[tuple[int, int, bytes]]]]:
    """(bucket, packed rows, its documents one by one) from rows sorted by (bucket, kind), documents being the last kind."""

    def rows():
        for batch in batches:
            for i in range(batch.num_rows):
                yield tuple(c[i].as_py() for c in batch.columns)

    source = rows()
    row = next(source, None)
    while row is not None:
        bucket, packed = row[1], []
        while row is not None and row[1] == bucket and row[0] != 2:
            packed.append(row)
            row = next(source, None)

        def docs():
            nonlocal row
            while row is not None and row[1] == bucket:
                yield row[7], row[8], row[9]
                row = next(source, None)

        yield bucket, packed, docs()
        while row is not None and row[1] == bucket:
            row = next(source, None)


def _index(buckets: int, length: int):
    """Texts of a part to marks of their windows that an earlier document has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _groups(batches, 0):
            ids, keys = (np.frombuffer(b"".join(r[i] for r in rows), np.int64) for i in (1, 2))
            first, size = (np.frombuffer(b"".join(r[i] for r in rows), np.uint32).astype(np.int64) for i in (3, 4))
            whole, at = b"".join(r[5] for r in rows), np.cumsum(np.r_[0, size])
            order = np.argsort(ids, kind="stable")
            texts = [whole[at[i] : at[i + 1]] for i in order.tolist()]
            index, starts = rindex.build(texts)
            owner = np.repeat(np.arange(len(texts)), size[order] + 1)
            nodes, least = rindex.least_over_matches(index, length, ids[order][owner])
            hit = nodes[least < ids[order][owner[nodes]]]
            who = order[owner[hit]]
            begin = first[who] + hit - starts[owner[hit]]
            # runs of neighbouring windows become one mark
            cut = np.flatnonzero(np.r_[True, (who[1:] != who[:-1]) | (begin[1:] != begin[:-1] + 1)]) if len(hit) else np.zeros(0, np.int64)
            stop = np.r_[cut[1:], len(hit)] - 1 if len(hit) else cut
            yield _batch(MARKS, _pack(0, buckets, ids[who[cut]], keys[who[cut]], np.full(len(cut), part), begin[cut], begin[stop] + length))

    return run


def spans(size: int, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the union of [first, last) ranges."""
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, first, 1)
    np.add.at(edge, last, -1)
    covered = np.cumsum(edge)[:size] > 0
    change = np.diff(np.r_[0, covered.astype(np.int8), 0])
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bucket's marks, then its documents: the removed spans of each document."""
    for _, rows, docs in _with_documents(batches):
        ids, keys, _, first, last = _arrays(rows)
        out, held = [], 0
        for i, key, text in docs:
            a, b = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            mine = np.arange(a, b)[ids[a:b] == i]
            starts, ends = spans(len(text), first[mine], last[mine])
            kept = b"".join(text[x:y] for x, y in zip([0, *ends.tolist()], [*starts.tolist(), len(text)], strict=True))
            out.append((None if i == _LAST else int(i), len(text), int((ends - starts).sum()), len(starts), hashlib.sha256(kept).hexdigest(), kept))
            held += len(kept)
            if held > 8 << 20:
                yield _batch(_RESULT, out)
                out, held = [], 0
        yield _batch(_RESULT, out)


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def remove_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, part_bytes: int = PART) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for every row of ``docs``: ``kept`` is the text's UTF-8 bytes
    without each byte covered by a ``length``-byte string that also starts in a row with a smaller doc_id.

    A null text is empty; a text of fewer bytes keeps them all. A null doc_id counts as larger than any other. Rows that
    repeat a doc_id take nothing from each other. Strings are judged on the input. An empty table gives no rows.
    """
    if not anchor < length < anchor + 256:
        raise ValueError("the anchor must be shorter than the string, by less than 256")
    arrow.bound(docs.sparkSession)
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    data = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("id"), key.alias("key"), data.alias("text"))
    total, count = rows.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    parts = max(1, ceil((total or 0) / part_bytes))
    long = rows.where(F.octet_length("text") >= length)
    shared = docs.sparkSession.sparkContext.broadcast(frequent_stretches(long, count, length, anchor))
    met = long.mapInArrow(_cut(parts, length, anchor, shared), STRETCHES).repartition(parts, "part").sortWithinPartitions("part")
    met = materialize(met.mapInArrow(_meet(parts, length), MARKS), "met")
    dealt = F.expr(f"cast(shiftright(shiftrightunsigned(key, 32) * {parts}L, 32) as int)")
    base = rows.select(F.lit(2).alias("kind"), dealt.alias("bucket"), F.lit(None).cast("binary").alias("id"), *[F.lit(None).cast("binary").alias(n) for n in ("key", "part", "first", "last")], F.col("id").alias("doc"), F.col("key").alias("doc_key"), "text")
    blank = [F.lit(None).cast("long").alias("doc"), F.lit(None).cast("long").alias("doc_key"), F.lit(None).cast("binary").alias("text")]

    def beside(packed: DataFrame, only: DataFrame) -> DataFrame:
        both = packed.select("*", *blank).unionByName(only)
        return both.repartition(parts, "bucket").sortWithinPartitions("bucket", "kind")

    asked = beside(met.where("kind = 1"), base.where(F.octet_length("text") >= length)).mapInArrow(_fetch, _TEXTS)
    found = asked.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_index(parts, length), MARKS)
    marks = met.where("kind = 0").unionByName(materialize(found, "found"))
    return beside(marks, base).mapInArrow(_finish, _RESULT)


def op4_repeats(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs).drop("kept")
