import hashlib
import random

import numpy as np
import pytest

from quernflow.llm import repeats, rindex


def brute(rows, length):
    order = sorted({(i if i is not None else float("inf")) for i, _ in rows})
    first = {}
    for i, t in rows:
        place = i if i is not None else float("inf")
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            first[w] = min(first.get(w, place), place)
    out = []
    for i, t in rows:
        b, place = (t or "").encode(), i if i is not None else float("inf")
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < place:
                gone[p : p + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        n = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((i, len(b), int(gone.sum()), n, hashlib.sha256(kept).hexdigest()))
    assert order or not rows
    return sorted(map(repr, out))


def result(docs, **options):
    return sorted(repr(tuple(r)) for r in repeats.remove_repeats(docs, **options).drop("kept").collect())


def test_index_finds_all_repeats():
    rng = random.Random(2)
    for _ in range(150):
        strings = [bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 25))) for _ in range(rng.randint(1, 9))]
        strings += [strings[0][2:], strings[0]]
        index, starts = rindex.build(strings)
        values = np.repeat(np.arange(len(strings))[::-1], [len(s) + 1 for s in strings])
        length = rng.randint(1, 5)
        places = {}
        for k, s in enumerate(strings):
            for o in range(len(s) - length + 1):
                places.setdefault(s[o : o + length], []).append(int(starts[k] + o))
        want = {p: min(int(values[x]) for x in ps) for ps in places.values() if len(ps) > 1 for p in ps}
        nodes, low = rindex.least_over_matches(index, length, values)
        assert dict(zip(nodes.tolist(), low.tolist(), strict=True)) == want


def test_runs_are_few_in_repetitive_texts():
    unit = bytes(random.Random(1).choice(b"abcdefgh") for _ in range(200))
    index, _ = rindex.build([unit] * 50)
    assert index.n == 50 * 201 and len(index.heads) < 500


@pytest.mark.parametrize("part", [100, 10_000, repeats.PART])
def test_removal_against_brute_force(make_docs, part):
    rng = random.Random(part)
    alphabet = "ab cdé "
    passage = "".join(rng.choice(alphabet) for _ in range(130))
    rows = []
    for i in range(40):
        body = "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 20, 49, 50, 51, 300])))
        cut = rng.randrange(60)
        text = body + passage[cut : cut + rng.choice([0, 49, 50, 70])] + body[:60] * rng.choice([0, 0, 3])
        rows.append((rng.choice([i, i, i, 3, None]), text, "en", "s"))
    rows += rows[:4]
    assert result(make_docs(rows), part_bytes=part) == brute([r[:2] for r in rows], 50)


def test_edge_cases(edge_docs, empty_docs):
    from conftest import EDGE

    assert result(edge_docs) == brute([r[:2] for r in EDGE], 50)
    assert result(empty_docs) == []


def test_long_texts_are_cut_into_pieces(make_docs, monkeypatch):
    monkeypatch.setattr(repeats, "_PIECE", 100)
    rng = random.Random(4)
    texts = [bytes(rng.choice(b"abc ") for _ in range(700))]
    whole = list(repeats.stretches(texts))
    windows = sum(int(c.sum()) for _, _, c, _, _ in whole)
    assert windows == 700 - 49


@pytest.mark.parametrize(("sample", "seen"), [(10, 2), (50, 3), (8_000, 8)])
def test_whole_table_against_brute_force(spark, sf, monkeypatch, sample, seen):
    monkeypatch.setattr(repeats, "SAMPLE", sample)
    monkeypatch.setattr(repeats, "SEEN", seen)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    want = brute([tuple(r) for r in docs.collect()], 50)
    assert result(docs, part_bytes=50_000) == want


def test_frequent_stretches_do_not_gather_in_one_part(make_docs):
    line = "this very common line stands in each and every one of the documents here. "
    rows = [(i, f"{i * 7919} begins\n{line}\nends {i * 104729} with something of its own that nobody else has", "en", "s") for i in range(300)]
    docs = make_docs(rows)
    assert result(docs) == brute([r[:2] for r in rows], 50)
    from pyspark.sql import functions as F

    long = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("key"), F.col("text").cast("binary").alias("text"))
    found = repeats.frequent_stretches(long, 300, 50, 24)
    ids = np.arange(300)
    hot = int(np.argmax(found[2] == 0))
    told = repeats._told(found, np.repeat(found[0][hot], 300), np.repeat(found[1][hot], 300), ids)
    assert len(found[0]) and told.sum() == 299
