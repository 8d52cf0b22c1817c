"""Results kept and recomputed where inputs or the policy changed; tables reconciled by digests."""

import os
import random

import pytest
from pyspark.sql import functions as F

from quernflow.operators import digests
from quernflow.operators.rebuild import Kept
from quernflow.plans import jobs


def tree(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def sums(inputs, asked):
    def of(keys):
        own = inputs.join(keys, ["a", "b"], "left_semi")
        asked.append(sorted(tuple(r) for r in keys.collect()))
        return own.where("n <> 13").groupBy("a", "b").agg(F.sum("n").alias("total"), F.count("*").alias("rows"))

    return of


def test_rebuild_equals_a_fresh_run(spark, tmp_path):
    draw = random.Random(2)
    schema = "a long, b string, n long, bucket string"
    data = [(draw.randrange(20), draw.choice("xyz"), draw.randrange(50), "c") for _ in range(200)] + [(99, "only13", 13, None)]
    kept = Kept(spark, f"{tmp_path}/kept", ["a", "b"], 8)
    assert kept.read() is None
    asked = []
    for step in range(5):
        if step == 1:
            data = data[5:] + [(3, "x", 1000, "c"), (77, "new", 1, None)]
        if step == 2:
            draw.shuffle(data)  # the same rows in another order: nothing changes
        if step == 4:
            data = []
        inputs = spark.createDataFrame(data, schema).repartition(3)
        known = {(a, b) for a, b, *_ in data}
        before = tree(f"{tmp_path}/kept")
        counts = kept.rebuild(inputs, sums(inputs, asked), "two" if step >= 3 else "one")
        assert counts["keys"] == len(known)
        if step == 2:
            assert counts == {"keys": len(known), "computed": 0, "removed": 0, "buckets": 0} and len(asked) == 2 and tree(f"{tmp_path}/kept") == before
            continue
        fresh = inputs.where("n <> 13").groupBy("a", "b").agg(F.sum("n").alias("total"), F.count("*").alias("rows"))
        done = kept.read()
        assert (rows(done.select("a", "b", "total", "rows")) if done is not None else []) == rows(fresh)
        assert all(before[p] == t for p, t in tree(f"{tmp_path}/kept").items() if p in before)  # no file is written twice
    assert (99, "only13") in asked[0] and (99, "only13") not in asked[1]  # a key without results is known, too
    assert (77, "new") in asked[1] and (3, "x") in asked[1] and len(asked[1]) <= 7
    assert kept.vacuum() > 0 and kept.read() is None


def test_failed_rebuild_changes_nothing(spark, tmp_path):
    kept = Kept(spark, f"{tmp_path}/kept", ["a"], 4)
    one = spark.createDataFrame([(i, str(i)) for i in range(30)], "a long, t string")
    kept.rebuild(one, lambda keys: one.join(keys, "a", "left_semi"), "p")
    two = one.withColumn("t", F.concat("t", F.lit("!")))
    with pytest.raises(Exception, match="broken"):
        kept.rebuild(two, lambda keys: two.join(keys, "a", "left_semi").withColumn("t", F.when(F.col("a") == 7, F.raise_error(F.lit("broken"))).otherwise(F.col("t"))), "p")
    assert rows(kept.read().select("a", "t")) == rows(one)
    other = Kept(spark, f"{tmp_path}/kept", ["a"], 4)
    assert other.rebuild(two, lambda keys: two.join(keys, "a", "left_semi"), "p")["computed"] == 30
    assert rows(kept.read().select("a", "t")) == rows(two)
    with pytest.raises(ValueError, match="no key"):
        kept.rebuild(spark.createDataFrame([(None, "x")], "a long, t string"), lambda keys: keys, "p")
    with pytest.raises(ValueError, match="buckets"):
        Kept(spark, f"{tmp_path}/kept", ["a"], 5).rebuild(one, lambda keys: keys, "p")


def test_rebuild_job(spark, tmp_path):
    store = jobs.Store(spark, str(tmp_path))
    schema = "bug_id long, summary string, target string, resolution string, component string, keywords array<string>, description string"
    reports = [(i, "LoongArch: ICE" if i % 2 else "x", "", "FIXED", "target", ["regression"], "loongarch64 fails, reduced") for i in range(1, 9)]
    store.write("reports", spark.createDataFrame(reports, schema))
    comments = [(i, 0, "```c\nint main(void) { return 1; }\n```") for i in range(1, 9)]
    store.write("comments", spark.createDataFrame(comments, "bug_id long, count long, text string"))
    first = jobs.rebuild(store)
    assert (first["computed"], first["removed"], first["reports"]) == (8, 0, 8)
    again = jobs.rebuild(store)
    assert (again["computed"], again["buckets"]) == (0, 0)
    store.write("comments", spark.createDataFrame([*comments[:7], (8, 0, "no code"), (5, 1, "more")], "bug_id long, count long, text string"))
    store.write("reports", spark.createDataFrame(reports[1:], schema))
    third = jobs.rebuild(store)
    assert (third["computed"], third["removed"], third["keys"]) == (2, 1, 7)
    jobs.classify(store)
    names = store.read("classified").columns
    assert rows(jobs.kept_reports(store).read().select(*names)) == rows(store.read("classified"))
    assert jobs.rebuild(store, "another policy")["computed"] == 7


def test_reconcile_nulls_repeats_and_order(spark):
    schema = "k long, v string, w double"
    left = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "a", None), (3, "x", 1.0), (3, "x", 1.0), (None, "n", 0.0), (5, None, 1.0)], schema)
    right = spark.createDataFrame([(1, "b", 2.0), (1, "a", 1.0), (2, "a", 0.0), (3, "x", 1.0), (4, "y", 1.0), (None, "n", 0.0), (5, "", 1.0)], schema)
    want = [(2, "differ", 1, 1), (3, "differ", 2, 1), (4, "right", 0, 1), (5, "differ", 1, 1)]
    for buckets in (1, 4, 1000):
        assert rows(digests.reconcile(left, right, ["k"], buckets=buckets)) == want
    assert rows(digests.reconcile(left, right, ["k"], ["v"])) == [(3, "differ", 2, 1), (4, "right", 0, 1), (5, "differ", 1, 1)]
    assert rows(digests.reconcile(left, left.repartition(5), ["k"])) == []
    assert rows(digests.reconcile(left.limit(0), right.where("k = 4"), ["k"])) == [(4, "right", 0, 1)]
