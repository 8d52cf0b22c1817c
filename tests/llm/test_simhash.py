import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quernflow.llm import golay, simhash
from quernflow.operators.components import components


def brute(text, n):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    parts = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def brute_components(rows):
    ids, fps = zip(*rows, strict=True)
    label = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (fps[i] ^ fps[j]).bit_count() <= 3:
                    label[i] = label[j] = min(label[i], label[j])
    return [min((x for x, m in zip(ids, label, strict=True) if m == k and x is not None), default=None) for k in label]


def test_golay_is_perfect_and_near_words_share_a_key():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 300)
    check, _ = golay._tables()
    index = golay.decode(words)
    assert (np.bitwise_count(words ^ (index << 11 | check[index])) <= 3).all()
    for errors in (0, 1, 2):
        flips = np.array([sum(1 << b for b in random.Random(i).sample(range(23), errors)) for i in range(300)])
        a, b = golay.nearby(words), golay.nearby(words ^ flips)
        assert all(set(x[x >= 0]) & set(y[y >= 0]) for x, y in zip(a, b, strict=True))


def test_keys_miss_no_pair_within_three_bits():
    rng = random.Random(5)
    for _ in range(400):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 3)):
            b ^= 1 << bit
        key, row = simhash.keys_of(np.array([a, b], dtype=np.uint64))
        assert set(key[row == 0]) & set(key[row == 1])


@pytest.mark.parametrize("block", [simhash.BLOCK, 3])
def test_links_have_the_components_of_all_pairs(spark, block):
    rng = random.Random(7)
    fps = []
    for _ in range(12):
        fps.append(rng.getrandbits(64))
        for _ in range(rng.choice([0, 1, 50])):
            fps.append(fps[-rng.randint(1, min(3, len(fps)))] ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))))
    signed = [f - (1 << 64) if f >> 63 else f for f in dict.fromkeys(fps)]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = {r["node"]: r["root"] for r in components(simhash.links(nodes, block=block)).collect()}
    want = brute_components([(i, f & (1 << 64) - 1) for i, f in enumerate(signed)])
    groups = {}
    for f, w in zip(signed, want, strict=True):
        groups.setdefault(found.get(f, f), set()).add(w)
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want))


def test_groups_on_edge_cases_and_tables(spark, edge_docs, empty_docs, sf):
    assert simhash.simhash_groups(empty_docs).count() == 0
    for docs in (edge_docs, spark.read.parquet(f"{sf}/documents.parquet")):
        rows = [(r["doc_id"], brute(r["text"], 3)) for r in docs.collect()]
        want = sorted(map(repr, zip([r[0] for r in rows], [f"{f:016x}" for _, f in rows], brute_components(rows), strict=True)))
        out = simhash.simhash_groups(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id").collect()
        assert sorted(repr(tuple(r)) for r in out) == want


def test_near_duplicates_by_words(make_docs):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    base = [rng.choice(words) for _ in range(300)]
    copies = []
    for k in range(40):
        c = list(base)
        c[rng.randrange(5, 295)] = f"new{k}"
        copies.append(" ".join(c))
    rows = [(10, " ".join(base), "en", "s"), *((11 + i, c, "en", "s") for i, c in enumerate(copies)), (90, " ".join(base[:150] + [rng.choice(words) for _ in range(150)]), "en", "s"), (91, None, None, None), (92, "", None, None), (None, "left alone", None, None), (10, "another text under a known id", "en", "s")]
    kept = simhash.drop_near_duplicates(make_docs(rows))
    assert kept.columns == make_docs(rows).columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 10, 10, 90, 91]  # two texts under one doc_id are two


def jaccard(a, b, n=5):
    a, b = (set(simhash.shingles(t.encode(), n)) for t in (a, b))
    return len(a & b) / len(a | b)


def classes_of(docs, **more):
    found = {}
    for r in simhash.near_duplicates(docs, **more).select("doc_id", "class_id").distinct().collect():
        found.setdefault(r["class_id"], set()).add(r["doc_id"])
    return {frozenset(v) for v in found.values()}


def brute_classes(texts, least=0.8):
    label = {i: i for i in texts}
    sets = {i: set(simhash.shingles(t.encode(), 5)) for i, t in texts.items()}
    for i in texts:
        for j in texts:
            if i < j and label[i] != label[j] and len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                old, new = label[j], label[i]
                label = {k: new if v == old else v for k, v in label.items()}
    return {frozenset(k for k in label if label[k] == v) for v in label.values()}


def test_pairs_of_a_template_need_no_hub(make_docs):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(5000)]
    base = [rng.choice(words) for _ in range(200)]
    texts = {}
    for k in range(400):  # each changes the template in places of its own, its partner one word more
        own = list(base)
        for at in rng.sample(range(200), 8):
            own[at] = rng.choice(words)
        texts[2 * k] = " ".join(own)
        own[rng.randrange(5, 195)] = "partner"
        texts[2 * k + 1] = " ".join(own)
    assert all(jaccard(texts[2 * k], texts[2 * k + 1]) > 0.8 > jaccard(texts[2 * k], texts[2 * k - 2]) for k in range(1, 400))
    want = {frozenset((2 * k, 2 * k + 1)) for k in range(400)}
    docs = make_docs([(i, t, "en", "s") for i, t in texts.items()])
    assert classes_of(docs) == want
    assert classes_of(docs, block=50) == want


def test_texts_of_the_same_words_in_another_order(make_docs):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(150)]
    texts = {0: " ".join(words)}
    for k in range(1, 30, 2):  # one set of words and so one fingerprint
        own = rng.sample(words, len(words))
        texts[k] = " ".join(own)
        own[70], own[71] = own[71], own[70]
        texts[k + 1] = " ".join(own)
    assert jaccard(texts[1], texts[2]) > 0.8 > jaccard(texts[0], texts[1])
    assert classes_of(make_docs([(i, t, "en", "s") for i, t in texts.items()])) == brute_classes(texts)


def test_pairs_at_the_least_similarity_are_all_found(make_docs):
    rng = random.Random(13)
    words = [f"w{i}" for i in range(5000)]
    texts = {}
    for k in range(400):
        base = [rng.choice(words) for _ in range(rng.choice([60, 200]))]
        more = len(base) // 5 + 1
        while len(set(simhash.shingles(" ".join(base).encode(), 5))) < 0.8 * (len(base) + more - 4):
            more -= 1
        texts[2 * k] = " ".join(base)
        texts[2 * k + 1] = " ".join(base + [rng.choice(words) for _ in range(more)])
    assert all(0.8 <= jaccard(texts[2 * k], texts[2 * k + 1]) < 0.83 for k in range(400))
    want = {frozenset((2 * k, 2 * k + 1)) for k in range(400)}
    assert classes_of(make_docs([(i, t, "en", "s") for i, t in texts.items()])) == want


def test_large_families_of_many_kinds_equal_all_pairs(make_docs):
    rng = random.Random(17)
    words = [f"w{i}" for i in range(4000)]
    edited = lambda base, n: [rng.choice(words) if i in at else w for at in [set(rng.sample(range(len(base)), n))] for i, w in enumerate(base)]
    texts = []
    for size in (60, 120, 250):
        base = [rng.choice(words) for _ in range(size)]
        texts += [edited(base, rng.randint(1, max(2, size // 40))) for _ in range(80)]  # a star
        last = base
        for _ in range(60):  # a chain that drifts away
            last = edited(last, max(1, size // 60))
            texts.append(last)
    left, right = ([rng.choice(words) for _ in range(150)] for _ in range(2))
    texts += [edited(left, 2) for _ in range(40)] + [edited(right, 2) for _ in range(40)]
    for k in range(0, 151, 4):  # a bridge between two families
        texts.append(right[:k] + left[k:])
    texts += [[rng.choice(words) for _ in range(rng.randint(1, 200))] for _ in range(60)]
    texts = {i: " ".join(t) for i, t in enumerate(texts)}
    docs = make_docs([(i, t, "en", "s") for i, t in texts.items()])
    want = brute_classes(texts)
    assert max(map(len, want)) > 80
    assert classes_of(docs) == want
    assert classes_of(docs, block=40) == want
    kept = [r["doc_id"] for r in simhash.drop_near_duplicates(docs).select("doc_id").collect()]
    assert sorted(kept) == sorted(map(min, want))


def test_minimum_spanning_tree():
    rng = np.random.default_rng(3)
    fps, bits = np.sort(rng.integers(0, 1 << 20, 60, dtype=np.uint64)), rng.integers(0, 1 << 62, (60, 8), dtype=np.uint64)
    sizes = rng.integers(50, 99, 60)
    a, b, share = simhash.spanning(fps, sizes, bits, 64)
    whole = np.bitwise_count(bits[:, None] ^ bits[None]).sum(axis=2) / (sizes[:, None] + sizes[None])
    assert np.allclose(share, whole[a, b])
    reached, total = {0}, 0.0
    while len(reached) < len(fps):
        d, j = min((whole[i, j], j) for i in reached for j in range(len(fps)) if j not in reached)
        total += d
        reached.add(j)
    assert np.isclose(total, share.sum()) and len(a) == len(fps) - 1
    assert len(simhash.spanning(fps, sizes, bits, -1)[0]) == 0


def test_two_texts_of_one_doc_id_are_two_nodes(make_docs):
    rng = random.Random(19)
    one, two = (" ".join(f"w{rng.randrange(3000)}" for _ in range(100)) for _ in range(2))
    rows = [(3, one, "en", "s"), (3, two, "en", "s"), (3, one, "en", "s"), (4, one + " x", "en", "s"), (5, two + " y", "en", "s"), (None, two, "en", "s"), (None, "alone here", "en", "s"), (None, "alone here", "en", "s")]
    kept = simhash.drop_near_duplicates(make_docs(rows)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == sorted([(3, one), (3, two), (0, "alone here")])
    assert simhash.near_duplicates(make_docs(rows)).count() == len(rows)
    assert simhash.near_duplicates(make_docs([])).count() == 0
