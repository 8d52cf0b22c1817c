"""Toxicity, ranked search and fill-in-middle against brute force, SQL and edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quernflow.llm import batches, infill, ranking, toxicity


EDGE = [
    (1, None, None, None), (2, "", "en", "s"), (3, " \t\n", "en", "s"), (4, "one", "en", None), (4, "one", "en", None), (None, "no id here at all", "en", "s"),
    (5, "word " * 3000, "de", "s"), (6, "long " + "x" * 100_000, "en", "t"), (7, "éİ 😀 \x85 mixed", "fr", "t"),
]
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def ranked(docs, items, k=10):
    """Every document scored for every item."""
    known = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    big_n, big_l = sum(n > 0 for *_, n in known), sum(n for *_, n in known)
    df = Counter(t for _, c, _ in known for t in c)
    out = []
    for item, text in items:
        asked = Counter(terms(text))
        scored = []
        for i, c, n in known:
            score = 0
            for t in asked.keys() & c.keys():
                w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                score += asked[t] * w * (10**9 * c[t] // (1000 * c[t] + 8 * (25 + 75 * n * big_n // big_l)))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def duck(sf, sql, *names):
    con = duckdb.connect()
    for t in names:
        con.sql(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    cursor = con.execute(sql)
    return [c[0] for c in cursor.description], cursor.fetchall()


def test_batches_bound_takes_units(spark):
    before = spark.conf.get(batches.BYTES)
    for given, want in (("64MB", batches.MOST), ("1m", "1m"), ("1000", "1000")):
        spark.conf.set(batches.BYTES, given)
        batches.bound(spark)
        assert spark.conf.get(batches.BYTES) == str(want)
    spark.conf.set(batches.BYTES, before)


# --- ranked search


def test_search_equals_sql(spark, sf):
    got = ranking.op12_search(spark, sf)
    columns, want = duck(sf, ranking.ORACLE, "documents", "benchmark")
    assert rows(got.select(*columns)) == sorted(want, key=repr)


@pytest.mark.parametrize("shard", [7, 300, 1 << 20])
def test_search_over_skewed_words_ties_and_edges(spark, make_docs, shard):
    draw = random.Random(4)
    vocabulary = [f"w{int(draw.paretovariate(0.6))}" for _ in range(400)]
    docs = [(i, " ".join(draw.choices(vocabulary, k=draw.choice([1, 5, 30, 200]))), "en", "s") for i in range(250)]
    docs += [(1000 - i, "same Text, same-text w1", "en", "s") for i in range(40)] + [(None, "no id w1 w2", None, None)] + EDGE
    items = [(1, "w1 w1 w2 SAME text"), (1, "w1 w1 w2 SAME text"), (2, " ".join(vocabulary[:60])), (3, None), (4, ""), (5, "nowhere"), (None, "one word éİ")]
    asked = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, key string, rank int")
    got = ranking.search(make_docs(docs).repartition(5), asked, shard=shard)
    assert rows(got) == ranked([d[:2] for d in docs], items)


def test_search_in_blocks_and_by_joins(spark, make_docs):
    draw = random.Random(5)
    words = [f"t{i}" for i in range(50)]
    docs = [(i, " ".join(draw.choices(words, k=draw.randint(1, 40))), "en", "s") for i in range(120)]
    items = [(i, " ".join(draw.choices(words, k=draw.choice([3, 9, 30])))) for i in range(9)]
    asked = spark.createDataFrame(items, "item_id long, text string")
    want = ranked([d[:2] for d in docs], items, 4)
    assert rows(ranking.search(make_docs(docs), asked, k=4, block_pairs=12)) == want  # the widest go by joins
    assert rows(ranking.search(make_docs(docs), asked, k=4, block_pairs=30)) == want


def test_search_on_empty_tables(spark, make_docs, empty_docs):
    asked = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert ranking.search(empty_docs, asked).count() == 0
    assert ranking.search(make_docs(EDGE), asked.limit(0)).count() == 0
    assert ranking.search(make_docs([(1, None, None, None), (2, "...", None, None)]), asked).count() == 0


def test_threshold_stops_before_the_lists_end():
    n = 5000
    draw = np.random.default_rng(1)
    tfs = draw.integers(1, 60, n)
    part = ranking._Shard(np.arange(n), draw.integers(60, 200, n), np.ones(n, np.int64), np.zeros(n, np.int32), tfs, np.array([3000]), n, 130 * n)
    looked = []
    scores = part.scores
    part.scores = lambda docs, asked: looked.append(len(docs)) or scores(docs, asked)
    nothing = np.zeros(0, np.int64)
    got = part.search(np.array([0]), np.array([1]), np.array([1]), (nothing, nothing), 10)
    assert sum(looked) < 100
    assert got[0].tolist() == sorted(part.impacts.tolist(), reverse=True)[:10]


def test_long_texts_are_counted_in_pieces(monkeypatch):
    monkeypatch.setattr(ranking, "_PIECE", 10)
    raw = ("abc  d-e " * 9 + "x" * 50 + "\x85é").encode().translate(ranking._TABLE)
    assert [w for p in ranking._pieces(raw) for w in p.split()] == raw.split()


# --- fill-in-middle


def test_infill_equals_sql(spark, sf):
    got = infill.op13_infill(spark, sf)
    columns, want = duck(sf, infill.ORACLE, "documents")
    assert rows(got.select(*columns)) == sorted(want, key=repr)


def cut(doc_id, text, plain=10, spm=20):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100 - plain:
        return doc_id, n, "plain", None, None, text, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm:
        return doc_id, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}", text
    return doc_id, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}", text


def test_infill_against_python(spark, make_docs, empty_docs):
    draw = random.Random(3)
    letters = "ab é\n\r ́😀<>PSM\x00/"
    docs = [(i, "".join(draw.choices(letters, k=draw.choice([1, 2, 63, 64, 65, 128, 500]))), "en", "s") for i in range(300)]
    docs += EDGE + [(900, "a<M>b", "en", "s"), (901, "<" * 200, "en", "s"), (902, "S>" * 40 + "<P", "en", "s"), (903, "é" * 3_000_000, "en", "s")]
    for plain, spm in ((10, 20), (0, 50)):
        got = infill.restore(infill.fill_in_middle(make_docs(docs).repartition(3), plain, spm))
        assert rows(got) == sorted((cut(i, t, plain, spm) for i, t, *_ in docs), key=repr)
    assert infill.op13_infill.__doc__ and infill.restore(infill.fill_in_middle(empty_docs)).count() == 0


def test_infill_slices_keep_all_rows(monkeypatch):
    monkeypatch.setattr(infill, "SLICE_BYTES", 10)
    batch = pa.RecordBatch.from_pydict({"text": ["abc", None, "x" * 30, "", "defghij", "klmnop"]})
    assert [t["text"].to_pylist() for t in infill._slices(batch, "text")] == [["abc", None], ["x" * 30], ["", "defghij"], ["klmnop"]]


# --- toxicity


def grams(text):
    """Distinct n-grams of the lower-cased text, and their buckets one at a time."""
    points = [ord(c) for c in (text or "").lower()]
    return {int(toxicity._buckets(np.array(points[i : i + n], np.uint64), n)[0]) for n in toxicity.GRAMS for i in range(len(points) - n + 1)}


@pytest.mark.parametrize("piece", [5, 1 << 20])
def test_features_equal_one_at_a_time(monkeypatch, piece):
    monkeypatch.setattr(toxicity, "_PIECE", piece)
    texts = ["Abc defabc", None, "", "ab", "é😀x\ny", "abcabcabcabc" * 5, "İstanbul"]
    at, buckets = toxicity._present(pa.array(texts))
    for i, t in enumerate(texts):
        assert buckets[at == i].tolist() == sorted(grams(t))
    wanted = np.zeros(1 << toxicity.BITS, bool)
    wanted[list(grams("abc"))] = True
    at, buckets = toxicity._present(pa.array(texts), wanted)
    assert at.tolist() == [0, 5]


def test_ratios_equal_counting(spark):
    texts = [("abcd", 1), ("abcx", 0), ("abcd abcd", 1), ("zzz", 0), (None, 0), ("ab", 1)]
    got = {r["bucket"]: (r["ratio"], r["docs"]) for r in toxicity.log_count_ratios(spark.createDataFrame(texts, "text string, toxic int"), 2.0, 2).collect()}
    bad, good = (Counter(b for t, y in texts if y == k for b in grams(t)) for k in (1, 0))
    width = len(bad.keys() | good.keys())
    want = {b: (math.log((bad[b] + 2) / (bad.total() + 2 * width)) - math.log((good[b] + 2) / (good.total() + 2 * width)), bad[b] + good[b]) for b in bad | good if bad[b] + good[b] >= 2}
    assert got.keys() == want.keys()
    assert all(got[b] == pytest.approx(want[b]) for b in want)


def test_logistic_reaches_the_optimum():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(200, 6)) * (draw.random((200, 6)) < 0.5)
    y = (draw.random(200) < 1 / (1 + np.exp(-(x @ [2, -1, 0, 0.5, 3, 0] - 1)))).astype(float)
    r, c = np.nonzero(x)
    b, w = toxicity._logistic(r, c, x[r, c], y, 6, 0.01, 3000)
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.abs(x.T @ (p - y) / 200 + 0.01 * w).max() < 1e-6
    assert abs((p - y).mean()) < 1e-6


def made(n, seed=1):
    """Texts of made words; toxic ones have an insult here and there, in any case of letters."""
    draw = random.Random(seed)
    syllables = "ba de ri mo la tu ne so vi ka or an ter lin".split()
    out = []
    for i in range(n):
        words = ["".join(draw.choices(syllables, k=draw.randint(1, 3))) for _ in range(draw.choice([20, 60, 300]))]
        toxic = int(i % 8 == 0)
        if toxic:
            for _ in range(max(2, len(words) // 40)):
                words[draw.randrange(len(words))] = draw.choice(["grumpfel", "Zwicklump", "knurzip"])
        out.append((i, " ".join(words), "en", "s", toxic))
    return out


def test_toxicity_on_held_out_documents(spark, make_docs):
    given = made(1500)
    docs = make_docs([g[:4] for g in given] + EDGE).repartition(4)
    labels = spark.createDataFrame([(g[0], g[4], "x") for g in given] + [(None, 1, "x"), (1, None, "x"), (99_999, 1, "x")], "doc_id long, toxic int, text string")
    model = toxicity.fit(docs, labels, most=600)
    assert 598 <= toxicity.labelled(docs, labels, 600).select("doc_id").distinct().count() <= 600
    scored = model.score(docs).withColumn("held_out", toxicity.held_out(F.col("doc_id"))).collect()
    assert len(scored) == len(given) + len(EDGE)
    kind = {g[0]: g[4] for g in given[10:]}
    held = [(r["score"] >= toxicity.THRESHOLD, kind[r["doc_id"]]) for r in scored if r["held_out"] and r["doc_id"] in kind]
    assert len(held) > 400 and np.mean([a == bool(b) for a, b in held]) > 0.98
    assert all((r["held_out"] is True) == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 3 == 1) for r in scored)
    assert all(0 <= r["score"] <= 1 for r in scored)
    again = toxicity.fit(docs.repartition(7), labels, most=600)
    assert again.bias == model.bias and (again.weights == model.weights).all()


def test_labels_of_held_out_documents_bear_on_nothing(spark, make_docs):
    given = made(300)
    docs = make_docs([g[:4] for g in given])
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, *_, y in given]
    one, two = (toxicity.fit(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in ([(g[0], g[4]) for g in given], flipped))
    assert one.bias == two.bias and (one.weights == two.weights).all() and one.weights.any()


def test_toxicity_without_both_kinds(spark, make_docs, empty_docs):
    labels = spark.createDataFrame([(1, 0), (7, 0)], "doc_id long, toxic int")
    scored = toxicity.fit(make_docs(EDGE), labels).score(make_docs(EDGE)).collect()
    assert {round(1 / r["score"], 6) for r in scored} == {4.0} and len(scored) == len(EDGE)
    model = toxicity.fit(empty_docs, labels.limit(0))
    assert model.score(empty_docs).count() == 0
    assert {r["score"] for r in model.score(make_docs(EDGE)).collect()} == {0.5}


def test_op11_columns(spark, sf):
    got = toxicity.op11_toxicity(spark, sf)
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
