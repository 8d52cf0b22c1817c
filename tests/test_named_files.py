"""Files written by tasks with a manifest: lost attempts, repeats, later commits, damage."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from quernflow.plans import jobs
from quernflow.sources import named_files as N


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def files_of(root):
    return {os.path.relpath(os.path.join(d, f), root): open(os.path.join(d, f), "rb").read() for d, _, names in os.walk(root) for f in names if f"/{N.META}" not in d and not f.endswith(".crc")}


def test_files_and_manifest(spark, tmp_path):
    root = f"{tmp_path}/out put"
    rows = [(f"a/{i % 3}/f {i}+%.c", f"int x{i}; é") for i in range(50)] + [("empty.txt", None), ("a/0/f 0+%.c", "int x0; é")]
    df = spark.createDataFrame(rows, "path string, content string").withColumn("sha256", F.lit("mine")).repartition(4)
    got = {r["path"]: (r["bytes"], r["sha256"]) for r in N.write_files(df, root).collect()}
    want = {p: (c or "").encode() for p, c in rows}
    assert files_of(root) == want
    assert N.verify(spark, root).collect() == []
    assert got == {p: (len(c), hashlib.sha256(c).hexdigest()) for p, c in want.items()}
    assert N.verify(spark, root).count() == 0
    os.remove(f"{root}/empty.txt")
    open(f"{root}/a/0/f 0+%.c", "w").write("int y;")
    open(f"{root}/left.c.part", "w").write("int z;")
    assert sorted(map(tuple, N.verify(spark, root).collect())) == [("a/0/f 0+%.c", "changed"), ("empty.txt", "missing"), ("left.c.part", "unlisted")]
    assert N.clean(spark, root) == 1 and "left.c.part" not in files_of(root)
    later = N.write_files(spark.createDataFrame([("empty.txt", "now not")], "path string, content string"), root)
    assert later.where("path = 'empty.txt'").first()["sha256"] == sha("now not") and later.count() == len(want)


def test_a_task_that_fails_leaves_nothing_counted(spark, tmp_path):
    root = f"{tmp_path}/out"
    N.write_files(spark.createDataFrame([("kept.c", b"1")], "path string, content binary"), root)
    bad = spark.createDataFrame([(f"f{i}.c", str(i)) for i in range(20)] + [("../x", "up")], "path string, content string")
    with pytest.raises(Exception, match="not a path below"):
        N.write_files(bad.coalesce(1), root)
    assert [r["path"] for r in N.manifest(spark, root).collect()] == ["kept.c"]
    assert not os.path.exists(f"{tmp_path}/x")
    assert {r["fault"] for r in N.verify(spark, root).collect()} == {"unlisted"}
    assert N.clean(spark, root) == 20 and list(files_of(root)) == ["kept.c"]
    again = N.write_files(bad.where("path <> '../x'"), root)
    assert again.count() == 21 and N.verify(spark, root).count() == 0


def test_parts_of_doubled_attempts_count_once(spark, tmp_path, monkeypatch):
    """An attempt that was lost after it wrote has a part and the same files; the commit names the other attempt's part."""

    class Context:
        def __init__(self, attempt):
            self.attempt = attempt

        def partitionId(self):
            return 0

        def taskAttemptId(self):
            return self.attempt

    root = N.qualified(spark, f"{tmp_path}/out")
    writer = N._Writer(root, "job")
    told = []
    for attempt in (7, 8):
        monkeypatch.setattr(N.TaskContext, "get", classmethod(lambda cls, a=attempt: Context(a)))
        told.append(writer.write(iter([("a.c", "one"), ("b.c", "two")])))
    writer.commit([told[1], None])
    assert len(os.listdir(f"{tmp_path}/out/{N.META}/job")) == 2
    assert sorted(r["path"] for r in N.manifest(spark, root).collect()) == ["a.c", "b.c"]
    aborted = N._Writer(root, "other")
    aborted.write(iter([("c.c", "three")]))
    aborted.abort([None])
    assert not os.path.exists(f"{tmp_path}/out/{N.META}/other") and N.manifest(spark, root).count() == 2


def test_repeated_and_wrong_paths_stop_before_any_file(spark, tmp_path):
    root = f"{tmp_path}/out"
    for rows, message in (([("a", "1"), ("a", "2")], "several contents"), ([(None, "1")], "not a path"), ([("/etc/x", "1")], "not a path"), ([("a/", "1")], "not a path")):
        with pytest.raises(ValueError, match=message):
            N.write_files(spark.createDataFrame(rows, "path string, content string"), root)
    assert not os.path.exists(root)
    assert N.manifest(spark, root).count() == 0
    assert N.write_files(spark.createDataFrame([], "path string, content string"), root).count() == 0


def test_corpus_jobs(spark, tmp_path):
    store = jobs.Store(spark, f"{tmp_path}/store")
    done = [("i1", "c1", "g1", "ready", "C", "my prog.c", "int main;"), ("", "c2", "g2", "ready", "c++", None, "int x;\n"), ("i3", "c3", "g3", "ready", "c", None, "int z;")]
    store.write("instantiations", spark.createDataFrame(done, "instantiation_id string, candidate_id string, group_uid string, instantiation_status string, language string, file_name string, source_code string"))
    programs = jobs.write_programs(store, f"{tmp_path}/out")
    assert programs == {"files": 3, "bytes": sum(map(len, ("int main;\n", "int x;\n", "int z;\n")))}
    paths = {r["path"] for r in N.manifest(spark, f"{tmp_path}/out").collect()}
    assert "programs/i1.my_prog.c" in paths and "programs/i3.i3.c" in paths
    runs = [("covered", "i1", "c1", "g1", "c", "programs/i1.my_prog.c"), ("failed", "i3", "c3", "g3", "c", "programs/i3.i3.c"), ("covered", "i9", "c9", "g9", "c", "programs/none.c")]
    store.write("evaluations", spark.createDataFrame(runs, "evaluation_status string, instantiation_id string, candidate_id string, group_uid string, language string, source_path string"))
    assert jobs.build_corpus(store, f"{tmp_path}/out", f"{tmp_path}/corpus") == {"covered_evaluations": 2, "copied": 1}
    assert files_of(f"{tmp_path}/corpus") == {"i1.c": b"int main;\n"}
    store.write("candidates", spark.createDataFrame([("c1",), ("c9",)], "candidate_id string"))
    store.write("groups", spark.createDataFrame([(1, "g1", "c1", ["f1", "f2"])], "pos long, group_uid string, candidate_id string, source_feature_uids array<string>"))
    assert jobs.build_seeds(store, f"{tmp_path}/out", f"{tmp_path}/seeds", "c") == {"files": 1, "candidate": 1, "group": 1, "feature": 2}
    assert files_of(f"{tmp_path}/seeds") == {"i1.c": b"int main;\n"}
