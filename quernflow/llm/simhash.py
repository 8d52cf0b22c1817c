"""Near-duplicates by SimHash fingerprints and Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits. Where no segment differs in more than two bits, the first
two segments each have a Golay key in common (see ``golay.nearby``); where one segment takes all three errors, the other
two are equal. So the pairs of keys of segments 1 and 2 and the pairs of equal segments with the third miss no pair within three
bits. Rows of one key are compared with each other, in blocks when there are many, and only a spanning forest of the links
found is kept: its size is that of the bucket, not its square, and its components are those of all the links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernflow.llm import batches, golay
from quernflow.operators.components import components
from quernflow.scratch import materialize, settled

WIDTHS = (22, 21, 21)
SEED = 42
#: Links within three bits: a family of Golay keys (equal segments share them too) and two of equal segments.
WITHIN_3 = (("near", 0, 1), ("same", 0, 2), ("same", 1, 2))
#: Rows of one key compared in one piece; more are dealt into blocks, and each two blocks meet.
BLOCK = 200_000
#: Texts of one codeword, or of one shingle, that a task of the near-duplicate search has at a time.
GROUP = 20_000
#: Runs up to this size are compared by shifting, larger ones by a search.
SHIFTED = 32
#: Texts in the sample for frequent shingles and hot keys, about; shingles that are ordered by their frequency in it.
SAMPLE, MOST_FREQUENT = 8_000, 100_000
#: Prefix entries that a task holds at a time, about.
ENTRIES = 1 << 18
_SLICE = 1 << 16
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def shingles(text: bytes | None, n: int) -> list[bytes]:
    """The n-word shingles of a text in UTF-8, A-Z lower-cased, repeats included; the whole when it has fewer words."""
    words = (text or b"").lower().split()
    if not words:
        return []
    if len(words) <= n:
        return [b" ".join(words)]
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    joined = b" ".join(words)
    return [joined[a:b] for a, b in zip([0, *ends[: len(ends) - n]], [e - 1 for e in ends[n - 1 :]], strict=True)]


def fingerprint(text: bytes | None, n: int, seed: int = SEED, distinct: bool = False) -> int:
    """Majority of the bits of the shingles' XXH64 as an unsigned number; 0 without words."""
    hashed = xxhash.xxh64_intdigest
    parts = shingles(text, n)
    if not parts:
        return 0
    if distinct:
        parts = list(set(parts))
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(parts), _SLICE):
        h = np.array([hashed(s, seed) for s in parts[at : at + _SLICE]], dtype="<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(parts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, n: int, seed: int = SEED, distinct: bool = False, text: str = "text"):
    """A column with the fingerprint of ``text`` as a signed long."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, n, seed, distinct) for t in texts], dtype=np.uint64).view(np.int64))

    return of(docs[text].cast("binary"))


def segments(fps: np.ndarray) -> list[np.ndarray]:
    out, at = [], 0
    for width in WIDTHS:
        out.append((fps >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64))
        at += width
    return out


def keys_of(fps: np.ndarray, families=WITHIN_3) -> tuple[np.ndarray, np.ndarray]:
    """(key, index into fps) rows; the family is in the key's upper bits."""
    parts = segments(fps)
    near = {i: golay.nearby(parts[i], WIDTHS[i]) for kind, *of in families if kind == "near" for i in of}
    keys, rows = [], []
    for family, (kind, i, j) in enumerate(families):
        top = family << 56
        if kind == "same":
            keys.append(top | parts[i] << 22 | parts[j])
            rows.append(np.arange(len(fps)))
            continue
        a, b = near[i][:, :, None], near[j][:, None, :]
        row, x, y = np.nonzero((a >= 0) & (b >= 0))
        keys.append(top | near[i][row, x] << 12 | near[j][row, y])
        rows.append(row)
    return np.concatenate(keys), np.concatenate(rows)


def forest(fps: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges that span the links within ``radius`` bits among distinct fingerprints."""
    out, rest = [], fps
    while len(rest):
        queue, rest = [rest[:1]], rest[1:]
        while queue and len(rest):
            batch = queue.pop()
            for p in batch:
                close = np.bitwise_count(rest ^ p) <= radius
                if close.any():
                    hit = rest[close]
                    out.append((np.full(len(hit), p), hit))
                    queue.append(hit)
                    rest = rest[~close]
                    if not len(rest):
                        break
    return out


def run_edges(group: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links within runs of equal ``group`` (whole runs only)."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    small = np.repeat(sizes <= SHIFTED, sizes)
    for shift in range(1, int(sizes[sizes <= SHIFTED].max(initial=1))):
        i = np.flatnonzero((group[shift:] == group[:-shift]) & small[shift:])
        if not len(i):
            break
        i = i[np.bitwise_count(fps[i] ^ fps[i + shift]) <= radius]
        a.append(fps[i])
        b.append(fps[i + shift])
    for at in np.flatnonzero(sizes > SHIFTED):
        run = np.unique(fps[starts[at] : starts[at] + sizes[at]])
        for x, y in forest(run, radius):
            a.append(x)
            b.append(y)
    a, b = np.concatenate(a), np.concatenate(b)
    keep = a != b
    return a[keep], b[keep]


def _keyed(families):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(fps), 20_000):
                part = fps[at : at + 20_000]
                key, row = keys_of(part.view(np.uint64), families)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row])], names=["key", "fp"])

    return run


def _linked(radius):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []  # an open run; it has BLOCK rows or two blocks at most
        for batch in stream:
            if not batch.num_rows:
                continue
            key, lo, hi, fps = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            group = np.stack([key, lo, hi], axis=1)
            new = np.r_[True, (group[1:] != group[:-1]).any(axis=1)]
            if held and (held[-1][0][-1] == group[0]).all():
                new[0] = False
            cuts = np.flatnonzero(new)
            if not len(cuts):
                held.append((group, fps))
                continue
            last = cuts[-1]
            whole_g = np.concatenate([*(g for g, _ in held), group[:last]])
            whole_f = np.concatenate([*(f for _, f in held), fps[:last]])
            held = [(group[last:], fps[last:])]
            if len(whole_g):
                yield _edges(whole_g, whole_f, radius)
        if held:
            yield _edges(np.concatenate([g for g, _ in held]), np.concatenate([f for _, f in held]), radius)

    return run


def _edges(group: np.ndarray, fps: np.ndarray, radius: int) -> pa.RecordBatch:
    ids = np.cumsum(np.r_[0, (group[1:] != group[:-1]).any(axis=1)])
    a, b = run_edges(ids, fps.view(np.uint64), radius)
    a, b = a.view(np.int64), b.view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["src", "dst"])


def links(fps: DataFrame, radius: int = 3, families=WITHIN_3, block: int = BLOCK) -> DataFrame:
    """(src, dst): links that span those within ``radius`` bits among the distinct ``fp`` (long) of ``fps``.

    With ``WITHIN_3`` and a radius of 3 or less none is missed. A key with more than ``block`` rows is dealt into blocks of about that size and every two of them are
    compared in a task of their own.
    """
    keyed = fps.select("fp").mapInArrow(_keyed(families), "key long, fp long")
    hot = materialize(keyed.groupBy("key").count().where(F.col("count") > block), "hot")
    none = F.lit(0)
    if hot.isEmpty():
        keyed = keyed.select("key", none.alias("lo"), none.alias("hi"), "fp")
    else:
        n = F.ceil(F.col("count") / block).cast("int")
        keyed = keyed.join(hot, "key", "left").withColumn("n", F.coalesce(n, F.lit(1)))
        keyed = keyed.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
        keyed = keyed.select("key", "fp", "own", F.explode(F.sequence(none, F.col("n") - 1)).alias("other"))
        keyed = keyed.select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp")
    dealt = keyed.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "fp")
    return dealt.mapInArrow(_linked(radius), "src long, dst long").distinct()


def simhash_groups(docs: DataFrame, shingle: int = 3, radius: int = 3, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """(doc_id, fp, component_id): fingerprints of all rows of ``docs`` and the components of links within ``radius`` bits.

    A null or wordless text has fingerprint zero and is linked like any other. Equal fingerprints are one node, so copies
    cost one comparison. ``component_id`` is the smallest doc_id in reach, null where no row in reach has a doc_id.
    Repeated rows each come back; an empty table gives no rows. Only ``doc_id`` and ``text`` are read.
    """
    if not 0 <= radius <= 3:
        raise ValueError("the key families cover 0 to 3 bits")
    batches.bound(docs.sparkSession)
    narrow = docs.select("doc_id", fingerprints(docs, shingle, seed).alias("fp"))
    narrow = materialize(narrow, "fingerprints")
    nodes = narrow.groupBy("fp").agg(F.min("doc_id").alias("first"))
    found = components(links(nodes, radius, block=block)).select(F.col("node").alias("fp"), "root")
    nodes = nodes.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = nodes.groupBy("root").agg(F.min("first").alias("component_id"))
    labelled = nodes.select("fp", "root").join(smallest, "root").select("fp", "component_id")
    return narrow.join(labelled, "fp").select("doc_id", "fp", "component_id")


class _Words(dict):
    """XXH64 of words, taken once each."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return found


def _hashed(text: bytes | None, n: int, words: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a text, A-Z lower-cased, and the distinct hashes of its n-word shingles in order (of the whole
    when it has fewer words; a single 0 without words)."""
    parts = (text or b"").lower().split()
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(1, np.uint64)
    single = np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))
    with np.errstate(over="ignore"):
        span = min(n, len(parts))
        out = np.zeros(len(parts) - span + 1, np.uint64)
        for k in range(span):
            out = out * _STEP + single[k : k + len(out)]
        out ^= out >> np.uint64(32)
        out *= _MIX
        out ^= out >> np.uint64(29)
    return single, np.unique(out)


def _majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes, as a signed number; 0 without hashes."""
    if not len(hashes):
        return 0
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _SLICE):
        part = hashes[at : at + _SLICE]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def _lists(parts: list[np.ndarray], kind) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, parts[0].dtype if parts else np.int64), *parts]), kind))


#: ``words``: fingerprint of the set of words; ``shingles``: 32 bits of each hash; ``prefix``: hashes that stand first in the
#: common order; ``bits``: for each of ``_PLACES`` the parity of the hashes that fall on it.
DESCRIBED = "doc_id long, node long, words long, shingles array<int>, prefix array<long>, bits binary"
_PLACES = 512


def _describe(similarity: float, n: int, order):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, rank = order.value
        words = _Words()
        for batch in stream:
            if len(words) > 1 << 17:
                words.clear()
            prints, sets, prefixes, bits = [], [], [], []
            for text in batch.column(2).to_pylist():
                single, h = _hashed(text, n, words)
                prints.append(_majority(np.unique(single)))
                sets.append(np.unique(h.astype(np.uint32)).view(np.int32))
                places = np.bincount((h >> np.uint64(55)).astype(np.int64), minlength=_PLACES) & 1
                bits.append(np.packbits(places.astype(bool)).tobytes())
                first = len(h) - int(np.ceil(similarity * len(h) - 1e-6)) + 1
                signed = h.view(np.int64)
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, signed), len(frequent) - 1)
                    signed = signed[np.argsort(np.where(frequent[at] == signed, rank[at], 0), kind="stable")]
                prefixes.append(signed[:first])
            columns = [batch.column(0), batch.column(1), pa.array(prints, pa.int64()), _lists(sets, pa.int32()), _lists(prefixes, pa.int64()), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in DESCRIBED.split(", ")])

    return run


def _counted(n: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in stream:
            if len(words) > 1 << 17:
                words.clear()
            found = [_hashed(t, n, words)[1] for t in batch.column(0).to_pylist()]
            key, count = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(count)], names=["key", "n"])

    return run


def _frequent(docs: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several of about ``SAMPLE`` texts have, ``MOST_FREQUENT`` at most, in order, and how many have them."""
    every = docs.count() // SAMPLE + 1
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    sample = docs.where(F.pmod(key, F.lit(every)) == 0).select(F.col("text").cast("binary").alias("text"))
    seen = sample.mapInArrow(_counted(n), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where("n >= 4")
    top = sorted((r["key"], r["n"]) for r in seen.orderBy(F.desc("n"), "key").limit(MOST_FREQUENT).collect())
    return np.array([k for k, _ in top], dtype=np.int64), np.array([c for _, c in top], dtype=np.int64)


# ---------------------------------------------------------------- candidates by fingerprints of the set of words


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many parity bits rows of x and y differ; their sets differ in as many shingles at least."""
    return np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64)


def spanning(fps: np.ndarray, sizes: np.ndarray, bits: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A minimum spanning forest (a, b, weight by index) of rows within ``radius`` bits of each other's fingerprints; the
    weight is the share of their shingles in which two rows differ, going by the parity bits."""
    n = len(fps)
    at, near, best = np.arange(n), np.zeros(n, np.int64), np.full(n, np.inf)
    rest = [fps.copy(), sizes.copy(), bits.copy(), at, near, best]
    a, b, weight = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, np.inf)
    i = 0
    for k in range(n):
        a[k], b[k], weight[k] = near[i], at[i], best[i]
        row, f, s, p = at[i], rest[0][i], rest[1][i], rest[2][i].copy()
        left = n - 1 - k
        for column in rest:
            column[i] = column[left]
        if left:
            share = _apart(rest[2][:left], p) / (rest[1][:left] + s)
            share[np.bitwise_count(rest[0][:left] ^ f) > radius] = np.inf
            closer = share < best[:left]
            near[:left][closer] = row
            np.minimum(best[:left], share, out=best[:left])
            i = int(best[:left].argmin())
    found = np.isfinite(weight)
    return a[found], b[found], weight[found]


def joining(group: np.ndarray, fps: np.ndarray, roots: np.ndarray, sizes: np.ndarray, bits: np.ndarray, family: int, radius: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links (by index) between rows of one group that share a Golay key of a further segment, are within ``radius`` bits
    and differ in root: a minimum spanning forest of each group's roots. Pairs whose parity bits rule ``similarity`` out are
    no links."""
    held = []
    for j in range(family + 1, len(WIDTHS)):
        keys = golay.nearby(segments(fps)[j], WIDTHS[j])
        row, k = np.nonzero(keys >= 0)
        key = group[row] << 12 | keys[row, k]
        order = np.lexsort((fps[row], key))
        key, row = key[order], row[order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        runs = np.diff(np.r_[starts, len(key)])
        small = np.repeat(runs <= SHIFTED, runs)
        for shift in range(1, int(runs[runs <= SHIFTED].max(initial=1))):
            i = np.flatnonzero((key[shift:] == key[:-shift]) & small[shift:])
            x, y = row[i], row[i + shift]
            ok = (np.bitwise_count(fps[x] ^ fps[y]) <= radius) & (roots[x] != roots[y])
            x, y = x[ok], y[ok]
            held.append((x, y, _apart(bits[x], bits[y]) / (sizes[x] + sizes[y])))
        for at in np.flatnonzero(runs > SHIFTED):
            run = row[starts[at] : starts[at] + runs[at]]
            if (roots[run] != roots[run[0]]).any():
                x, y, share = spanning(fps[run], sizes[run], bits[run], radius)
                held.append((run[x], run[y], share))
    if not held:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x, y, share = (np.concatenate(c) for c in zip(*held, strict=True))
    ok = share <= (1 - similarity) / (1 + similarity) + 1e-9
    x, y, share = x[ok], y[ok], share[ok]
    order = np.lexsort((y, x, share))
    x, y = x[order], y[order]
    _, mark = np.unique(np.stack([group, roots], axis=1), axis=0, return_inverse=True)
    up = list(range(int(mark.max(initial=-1)) + 1))
    keep = []
    for i, (p, q) in enumerate(zip(mark[x].tolist(), mark[y].tolist(), strict=True)):
        while up[p] != p:
            up[p] = p = up[up[p]]
        while up[q] != q:
            up[q] = q = up[up[q]]
        if p != q:
            up[p] = q
            keep.append(i)
    return x[keep], y[keep]


def _codes(family: int):
    """How many rows of a batch decode to each codeword of a segment."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << 12, np.int64)
        for batch in stream:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            keys = golay.nearby(segments(fps)[family], WIDTHS[family])
            counts += np.bincount(keys[keys >= 0], minlength=len(counts))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["code", "n"])

    return run


GROUPED = "grp long, fp long, node long, root long, size int, bits binary"


def _dealt(family: int, hot: np.ndarray):
    """Rows (fp, node, root, size, bits) to the groups of their codewords; those of ``hot`` codewords to a group for each
    further key."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            parts = segments(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            keys = golay.nearby(parts[family], WIDTHS[family])
            row, k = np.nonzero(keys >= 0)
            code = keys[row, k]
            many = np.isin(code, hot)
            groups, rows = [code[~many] << 16], [row[~many]]
            for j in range(family + 1, len(WIDTHS)):
                more = golay.nearby(parts[j], WIDTHS[j])[row[many]]
                i, k = np.nonzero(more >= 0)
                groups.append(code[many][i] << 16 | j << 12 | more[i, k])
                rows.append(row[many][i])
            group, row = np.concatenate(groups), np.concatenate(rows)
            for at in range(0, len(row), _SLICE):
                part = pa.array(row[at : at + _SLICE])
                yield pa.RecordBatch.from_arrays([pa.array(group[at : at + _SLICE]), *(c.take(part) for c in batch.columns)], names=[x.split()[0] for x in GROUPED.split(", ")])

    return run


def _whole_groups(stream: Iterator[pa.RecordBatch], width: int, most: int) -> Iterator[list[np.ndarray]]:
    """Columns of whole groups (rows equal in the first ``width`` columns), some groups at a time; a group of over ``most``
    rows comes in pieces of that size."""
    held, rows = [], 0
    for batch in stream:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        held.append(columns)
        rows += batch.num_rows
        if rows < 1 << 14:
            continue
        columns = [np.concatenate(c) for c in zip(*held, strict=True)]
        new = np.zeros(rows - 1, dtype=bool)
        for c in columns[:width]:
            new |= c[1:] != c[:-1]
        cuts = np.flatnonzero(new)
        cut = int(cuts[-1]) + 1 if len(cuts) else rows if rows >= most else 0
        if cut:
            yield [c[:cut] for c in columns]
        held, rows = [[c[cut:] for c in columns]], rows - cut
    if rows:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def _unpacked(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches whose last column, the parity bits, is replaced by columns of numbers."""
    for batch in stream:
        bits = np.frombuffer(b"".join(batch.column(batch.num_columns - 1).to_pylist()), np.uint64).reshape(-1, _PLACES // 64)
        columns = [*batch.columns[:-1], *(pa.array(np.ascontiguousarray(c)) for c in bits.T)]
        yield pa.RecordBatch.from_arrays(columns, names=[str(i) for i in range(len(columns))])


def _joined(family: int, radius: int, similarity: float, block: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, fps, nodes, roots, sizes, *bits in _whole_groups(_unpacked(stream), 1, block):
            a, b = joining(group, fps.view(np.uint64), roots, sizes, np.stack(bits, axis=1), family, radius, similarity)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(nodes[a], nodes[b])), pa.array(np.maximum(nodes[a], nodes[b]))], names=["src", "dst"])

    return run


def _by_fingerprint(labels: DataFrame, family: int, radius: int, similarity: float, block: int) -> DataFrame:
    """(src, dst): pairs of nodes that join roots, candidates by one segment's Golay codewords and a further segment's."""
    counts = labels.select("words").mapInArrow(_codes(family), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    hot = np.array([r["code"] for r in counts.where(F.col("n") > block).collect()], dtype=np.int64)  # of 4096 codewords
    rows = labels.select(F.col("words").alias("fp"), "node", "root", "size", "bits")
    groups = rows.mapInArrow(_dealt(family, hot), GROUPED).repartition("grp").sortWithinPartitions("grp", "fp", "node")
    return groups.mapInArrow(_joined(family, radius, similarity, block), "src long, dst long").distinct()


# ---------------------------------------------------------------- the rest, exactly


def _entries(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Prefixes (node, prefix) as (key, node, place): the place in the prefix in 255ths of its length, rounded down."""
    for batch in stream:
        node, sizes = batch.column(0).to_numpy(zero_copy_only=False), pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        first = 0
        while first < len(node):
            start = int(ends[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(ends, start + ENTRIES // 2, "right")))
            count = sizes[first:last]
            keys = batch.column(1).slice(first, last - first).flatten().to_numpy(zero_copy_only=False)
            at = np.arange(len(keys)) - np.repeat(ends[first:last] - count - start, count)
            yield keys, np.repeat(node[first:last], count), (at * 255 // np.repeat(count, count)).astype(np.uint8)
            first = last


def _packed(order, parts: int):
    """Prefixes to rows (part, keys, nodes, places) of packed entries, without the frequent keys."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, _ = order.value
        for entries in _entries(stream):
            rare = ~np.isin(entries[0], frequent)
            entries = [c[rare] for c in entries]
            part = ((entries[0].view(np.uint64) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
            turn = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.r_[True, np.diff(part[turn]) > 0]) if len(turn) else np.zeros(0, np.int64)
            some = [turn[a:b] for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(turn)], strict=False)]
            columns = [pa.array([c[at].tobytes() for at in some], pa.binary()) for c in entries]
            yield pa.RecordBatch.from_arrays([pa.array([int(part[at[0]]) for at in some], pa.int32()), *columns], names=["part", "keys", "nodes", "places"])

    return run


def _shared(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed entries, sorted by part, to those whose key several nodes have."""

    def entries(held):
        keys, nodes, places = (np.frombuffer(b"".join(c), kind) for c, kind in zip(zip(*held, strict=True), (np.int64, np.int64, np.uint8), strict=True))
        turn = np.lexsort((nodes, keys))
        keys, nodes, places = keys[turn], nodes[turn], places[turn]
        again = np.r_[False, keys[1:] == keys[:-1]]
        new = np.r_[True, ~(again[1:] & (nodes[1:] == nodes[:-1]))]
        keys, nodes, places = keys[new], nodes[new], places[new]
        again = np.r_[False, keys[1:] == keys[:-1]]
        some = again | np.r_[again[1:], False]
        return _entry_batch(keys[some], nodes[some], places[some])

    last, held = None, []
    for batch in stream:
        for part, *packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if part != last and held:
                yield entries(held)
                held = []
            last = part
            held.append(packed)
    if held:
        yield entries(held)


ENTRY = "key long, node long, place short"


def _entry_batch(keys: np.ndarray, nodes: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(nodes), pa.array(places.astype(np.int16))], names=["key", "node", "place"])


def _known(order):
    """Entries of the frequent keys."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, _ = order.value
        for entries in _entries(stream):
            many = np.isin(entries[0], frequent)
            yield _entry_batch(*(c[many] for c in entries))

    return run


def _shared_keys(table: DataFrame, order) -> DataFrame:
    """(key, node, place): prefix entries whose key several nodes have, and those of the frequent keys.

    Most shingles stand in one text, so entries travel packed, 17 bytes each, and few come back. Keys of a part are held by
    one task; those that the sample shows to be frequent are not among them, as they need no such search.
    """
    rows = table.select("node", "prefix")
    total = rows.agg(F.sum(F.size("prefix"))).first()[0] or 0
    parts = total // ENTRIES + 1
    dealt = rows.mapInArrow(_packed(order, parts), "part int, keys binary, nodes binary, places binary").repartition(parts, "part").sortWithinPartitions("part")
    rare = dealt.mapInArrow(_shared, ENTRY)
    return materialize(rare.unionByName(rows.mapInArrow(_known(order), ENTRY).distinct()), "shared")


def _by_prefix(shared: DataFrame, labels: DataFrame, similarity: float, block: int) -> DataFrame:
    """(src, dst): pairs of nodes of different roots, among them every one whose shingle sets overlap by ``similarity``.

    In any one order of all shingles, of two such sets of sizes a and b the first a - ceil(similarity a) + 1 and the first
    b - ceil(similarity b) + 1 have a shingle in common; frequent ones stand last. Keys within one root are put aside by
    their least and greatest root, so a large family costs nothing once it is linked. Of the rest a pair must agree in size,
    in what the key's places leave of both sets, and in parity bits that bound from below in how many shingles the sets
    differ. A key of over ``block`` rows is dealt into blocks, and every two of them meet in a task of their own.
    """
    rows = shared.join(labels.select("node", "root"), "node")
    mixed = rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("rows")).where("low < high")
    mixed = materialize(mixed.select("key", F.ceil(F.col("rows") / F.lit(block)).cast("int").alias("blocks")), "mixed")
    rows = shared.join(mixed, "key").join(labels.select("node", "root", "size", "bits"), "node")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "node", "root", "size", "place", "bits")
    dealt = rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    return dealt.mapInArrow(_paired(similarity), "src long, dst long").distinct()


def _paired(similarity: float):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, lo, hi, node, root, size, place, *bits in _whole_groups(_unpacked(stream), 3, 1 << 62):
            group = np.cumsum(np.r_[0, (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])])
            for a, b in run_pairs(group, node, root, size.astype(np.int64), place, np.stack(bits, axis=1), similarity):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["src", "dst"])

    return run


def run_pairs(group: np.ndarray, node: np.ndarray, root: np.ndarray, size: np.ndarray, place: np.ndarray, bits: np.ndarray, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of nodes of equal ``group`` that differ in root and that neither sizes nor parity bits nor, were the
    key the first that they share, its ``place`` in either prefix keep below ``similarity``."""
    left = size - np.floor(place * (size - np.ceil(similarity * size - 1e-6)) / 255) + 1  # a collision of short hashes aside
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    held, waiting = [], 0

    def close(i, j):
        ok = root[i] != root[j]
        i, j = i[ok], j[ok]
        both = size[i] + size[j]
        ok = (np.minimum(size[i], size[j]) >= similarity * np.maximum(size[i], size[j]) - 1e-6) & (np.minimum(left[i], left[j]) >= similarity / (1 + similarity) * both - 1e-6)
        i, j, both = i[ok], j[ok], both[ok]
        ok = _apart(bits[i], bits[j]) <= (1 - similarity) / (1 + similarity) * both + 1e-6
        a, b = node[i[ok]], node[j[ok]]
        return np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)

    def all_pairs():
        small = np.repeat(sizes <= SHIFTED, sizes)
        for shift in range(1, int(sizes[sizes <= SHIFTED].max(initial=1))):
            i = np.flatnonzero((group[shift:] == group[:-shift]) & small[shift:])
            yield close(i, i + shift)
        for g in np.flatnonzero(sizes > SHIFTED):
            mine = np.arange(starts[g], starts[g] + sizes[g])
            mine = mine[np.argsort(size[mine], kind="stable")]
            upto = np.searchsorted(size[mine], size[mine] / similarity + 1e-6, "right")  # larger sets cannot be near
            for k in range(len(mine) - 1):
                yield close(np.full(upto[k] - k - 1, mine[k]), mine[k + 1 : upto[k]])

    def packed():
        found = np.unique(np.concatenate(held), axis=0)
        return found[:, 0], found[:, 1]

    for found in all_pairs():
        if len(found):
            held.append(found)
            waiting += len(found)
        if waiting > 1 << 20:
            yield packed()
            held, waiting = [], 0
    if held:
        yield packed()


# ---------------------------------------------------------------- classes


def _verified(table: DataFrame, labels: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """Those of ``pairs`` (src, dst) whose whole shingle sets overlap by ``similarity`` or more."""
    pairs = materialize(pairs, "pairs")
    ends = pairs.select(F.col("src").alias("node")).unionByName(pairs.select(F.col("dst").alias("node"))).distinct()
    wanted = materialize(labels.select("node", "row").join(ends, "node", "left_semi").select("row"), "ends")
    sets = materialize(table.join(wanted, "row", "left_semi").select("node", "shingles"), "sets")
    held = pairs.join(sets.select(F.col("node").alias("src"), F.col("shingles").alias("a")), "src")
    held = held.join(sets.select(F.col("node").alias("dst"), F.col("shingles").alias("b")), "dst")
    common = F.size(F.array_intersect("a", "b"))
    whole = F.size("a") + F.size("b") - common
    return materialize(held.where(common >= F.lit(similarity) * whole).select("src", "dst"), "same")


def _merged(labels: DataFrame, same: DataFrame) -> DataFrame:
    """``labels`` with roots that the links ``same`` join made one."""
    root = labels.select("node", "root")
    ends = same.join(root.select(F.col("node").alias("src"), F.col("root").alias("a")), "src").join(root.select(F.col("node").alias("dst"), F.col("root").alias("b")), "dst")
    found = components(ends.select(F.col("a").alias("src"), F.col("b").alias("dst")))
    named = labels.join(found.select(F.col("node").alias("root"), F.col("root").alias("joined")), "root", "left")
    return named.withColumn("root", F.coalesce("joined", "root")).drop("joined")


def near_duplicates(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, radius: int = 12, block: int = GROUP) -> DataFrame:
    """(doc_id, text_key, class_key, class_id) for the rows of ``docs``: classes of texts whose sets of ``shingle``-word
    shingles overlap by ``similarity`` or more (Jaccard), and of equal texts.

    Texts are the nodes, under the 64-bit hash of the text (``text_key``); equal texts are one. A similarity of 0.8 on
    five-word shingles lies far beyond three bits, so candidates come from fingerprints of the set of words within
    ``radius`` bits, by the Golay codewords of every two segments: a task has all texts of one segment's codeword and gives
    a minimum spanning forest of what the further segments' codewords bring together (nearest by parity bits of the shingle
    sets, 64 bytes a text), so candidates grow with the texts and not with the pairs. Whole shingle sets decide. The second segment's turn only joins classes that the first one left
    apart, and last all pairs across the classes found by then are looked for exactly (``_by_prefix``), so no link is lost.
    A codeword of over ``block`` texts is dealt out by the further codewords.

    Null and wordless texts are one class. ``class_id`` is the class's smallest doc_id, null where no row has one; a doc_id
    that stands on several texts counts for each of them. Repeated rows each come back; an empty table gives no rows; only
    ``doc_id`` and ``text`` are read, whole.
    """
    spark = docs.sparkSession
    batches.bound(spark)
    order = spark.sparkContext.broadcast(_frequent(docs, shingle))
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("node"), F.col("text").cast("binary").alias("text"))

    def classes() -> DataFrame:
        table = given.mapInArrow(_describe(similarity, shingle, order), DESCRIBED)
        table = materialize(table.withColumn("row", F.monotonically_increasing_id()), "described")
        first = F.min(F.struct("row", "words", F.size("shingles").alias("size"), "bits")).alias("t")
        labels = materialize(table.groupBy("node").agg(first).select("node", "t.*", F.col("node").alias("root")), "labels")

        def joined(pairs: Callable[[DataFrame], DataFrame]) -> DataFrame:
            return settled(lambda: _merged(labels, _verified(table, labels, pairs(labels), similarity)), "labels")

        for family in range(len(WIDTHS) - 1):
            labels = joined(lambda now, family=family: _by_fingerprint(now, family, radius, similarity, block))
        labels = joined(lambda now: _by_prefix(_shared_keys(table, order), now, similarity, block))
        return table.select("doc_id", "node").join(labels.select("node", "root"), "node")

    # the described texts and all that is made from them are far larger than the classes, and end with them
    rows = settled(classes, "classes")
    names = rows.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return rows.join(names, "root").select("doc_id", F.col("node").alias("text_key"), F.col("root").alias("class_key"), "class_id")


def drop_near_duplicates(docs: DataFrame, similarity: float = 0.8, shingle: int = 5) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each class one row of its smallest doc_id stays (of several texts
    under that doc_id, the one with the smallest key; a row without a doc_id only where the class has no other). All columns
    come back.
    """
    classes = near_duplicates(docs, similarity, shingle)
    missing, number = F.col("doc_id").isNull().alias("missing"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("number")
    best = classes.groupBy("class_key").agg(F.min(F.struct(missing, number, "text_key")).alias("b")).select("b.*")
    key = F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")
    rows = docs.select(F.struct(*docs.columns).alias("row"), missing, number, key)
    place = ["missing", "number", "text_key"]
    return rows.join(best, place, "left_semi").dropDuplicates(place).select("row.*")


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = simhash_groups(docs, shingle=3, radius=3)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return out.select("doc_id", digits.alias("fingerprint"), "component_id")
