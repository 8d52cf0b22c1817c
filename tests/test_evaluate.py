"""Programs run by a made command: statuses, limits, and that nothing runs twice."""

import os
import stat

import pytest
from pyspark.sql import functions as F

from quernflow.operators import evaluate as V
from quernflow.plans import jobs

#: Logs each call; what it does is said by the program.
SCRIPT = """#!/bin/bash
while [ "$1" != "--" ]; do case "$1" in --lang) lang="$2"; shift 2;; --output) out="$2"; shift 2;; --timeout) shift 2;; *) src="$1"; shift;; esac; done; shift
touch "{log}/$(head -c 20 "$src" | tr -dc 'a-z0-9')-$RANDOM$RANDOM"
echo "$lang $(basename "$src") $*"
grep -q crash "$src" && exit 4
grep -q wrong "$src" && exit 1
grep -q noisy "$src" && head -c 100000 /dev/zero | tr '\\0' 'z'
grep -q sleepy "$src" && sleep 60
grep -q silent "$src" && exit 0
printf '1:2\\n\\n7:1\\n1:9\\n' > "$out"
grep -q half "$src" && exit 1
exit 0
"""
SCHEMA = "instantiation_id string, candidate_id string, group_uid string, instantiation_status string, language string, file_name string, source_code string, compiler_options array<string>"


@pytest.fixture
def command(tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    script = tmp_path / "showmap.sh"
    script.write_text(SCRIPT.replace("{log}", str(log)))
    script.chmod(script.stat().st_mode | stat.S_IXUSR)
    return log, [str(script)]


def programs(spark, *extra):
    kinds = ["good", "crash", "wrong", "silent", "half", "noisy"]
    rows = [(f"i-{k}", "c", "g", "ready", "C", "p.c", f"// {k}", ["-O3", "-mlsx", "-o", "x"]) for k in kinds]
    rows += [("i-same", "c", "g", "ready", "c", "q.c", "// good", ["-mlsx"]), ("i-cpp", "c", "g", "ready", "cxx", None, "// good", None), ("i-rust", "c", "g", "ready", "rust", None, "// good", None)]
    rows += [("", "c", "g", "rejected", "c", None, None, None), *extra]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def calls(log):
    return sorted(n.rpartition("-")[0] for n in os.listdir(log))


def test_statuses_and_no_second_run(spark, tmp_path, command):
    log, run = command
    done = lambda: {r["instantiation_id"]: r for r in V.evaluate(programs(spark), f"{tmp_path}/state", run, most=1000, tasks=3).collect()}
    got = done()
    status = {k.removeprefix("i-"): r["evaluation_status"] for k, r in got.items()}
    rejected = next(k for k in status if k.startswith("c-"))
    assert status == {
        "good": "covered", "same": "covered", "cpp": "covered", "crash": "ice", "wrong": "compile_failed", "silent": "coverage_failed", "half": "coverage_failed", "noisy": "covered", "rust": "skipped_unsupported_language",
        rejected: "skipped_not_ready",
    }
    assert got["i-good"]["stdout"].startswith("c i-good.p.c -O2 -mlsx") or got["i-good"]["stdout"].startswith("c i-same.q.c -O2 -mlsx")
    assert got["i-good"]["digest"] == got["i-same"]["digest"] != got["i-cpp"]["digest"] and got["i-good"]["compiler_options"] == ["-O2", "-mlsx"]
    assert (got["i-good"]["edge_map_entries"], got["i-rust"]["digest"], got["i-silent"]["map_sha256"]) == (3, None, "")
    assert 1000 <= len(got["i-noisy"]["stdout"]) < 1100 and "bytes left out" in got["i-noisy"]["stdout"]
    assert calls(log) == ["crash", "good", "good", "half", "noisy", "silent", "wrong"]
    assert done() == got and len(calls(log)) == 7
    later = V.evaluate(programs(spark, ("i-new", "c", "g", "ready", "c", "p.c", "// new", None)), f"{tmp_path}/state", run, most=1000, tasks=2).collect()
    assert len(later) == 11 and calls(log).count("new") == 1 and len(calls(log)) == 8
    assert V.evaluate(programs(spark), f"{tmp_path}/state", run, optimization="-O1", most=1000).count() == 10 and len(calls(log)) == 8 + 7  # another policy is another run
    edges = V.edge_maps(V.evaluate(programs(spark), f"{tmp_path}/state", run, most=1000))
    assert sorted(r["edge_id"] for r in edges.where(F.col("map_id") == got["i-good"]["digest"]).collect()) == ["1", "7"]


def test_limits_and_commands_that_do_not_start(spark, tmp_path, command, monkeypatch):
    log, run = command
    late = V.run_command(["bash", "-c", "echo begun; sleep 50 & sleep 50"], 0.5, 100)
    assert late["timed_out"] and late["returncode"] is None and late["stdout"] == "begun\n" and late["seconds"] < 10
    none = V.evaluate(programs(spark), f"{tmp_path}/other", ["/no/such/command"]).collect()
    assert {r["evaluation_status"] for r in none} == {"not_run", "skipped_not_ready", "skipped_unsupported_language"}
    assert not os.path.exists(f"{tmp_path}/other/runs")
    bad = spark.createDataFrame([("", "c", "g", "ready", "c", None, "x", None)], SCHEMA)
    with pytest.raises(Exception, match="no instantiation_id"):
        V.evaluate(bad, f"{tmp_path}/other", run).collect()
    assert V.evaluate(bad.limit(0), f"{tmp_path}/other", run).count() == 0


def test_evaluation_job(spark, tmp_path, command):
    log, run = command
    store = jobs.Store(spark, f"{tmp_path}/store")
    store.write("instantiations", programs(spark))
    want = {"covered": 4, "ice": 1, "compile_failed": 1, "coverage_failed": 2, "skipped_not_ready": 1, "skipped_unsupported_language": 1}
    assert jobs.evaluate_programs(store, f"{tmp_path}/state", run) == want
    rows = store.read("evaluations").orderBy("evaluation_index").collect()
    assert [r["evaluation_index"] for r in rows] == list(range(1, 11)) and [r["instantiation_id"] for r in rows] == sorted(r["instantiation_id"] for r in rows)
    assert store.read("edge_maps").select("map_id").distinct().count() == len({r["map_id"] for r in rows if r["map_id"]})


def test_replay(spark, tmp_path):
    (tmp_path / "gcc" / "bin").mkdir(parents=True)
    for name in ("t-gcc", "t-g++"):
        path = tmp_path / "gcc" / "bin" / name
        path.write_text('#!/bin/bash\necho "$0 $*" >&2; for last; do :; done; grep -q wrong "$last" && exit 1; exit 0\n')
        path.chmod(path.stat().st_mode | stat.S_IXUSR)
    rows = [("a", "c1", "c", "a.c", ["-O3", "-x", "c", "-c"], "covered"), ("b", "c1", "cxx", "b.cc", None, "covered"), ("w", "c1", "c", "w.c", [], "covered"), ("gone", "c1", "c", "none.c", [], "covered"), ("f", "c1", "c", "a.c", [], "ice")]
    evaluations = spark.createDataFrame(rows, "instantiation_id string, candidate_id string, language string, source_path string, compiler_options array<string>, evaluation_status string")
    sources = spark.createDataFrame([("a.c", b"int a;"), ("b.cc", b"int b;"), ("w.c", b"// wrong")], "path string, content binary")
    got = {r["instantiation_id"]: r for r in V.replay(evaluations, sources, f"{tmp_path}/state", f"{tmp_path}/gcc", "t", tasks=2).collect()}
    assert {k: r["status"] for k, r in got.items()} == {"a": "ok", "b": "ok", "w": "failed", "gone": "not_run"}
    assert "/bin/t-gcc -O3 -S -w -o " in got["a"]["stderr"] and "/bin/t-g++ -O2 -S -w -o " in got["b"]["stderr"]
    assert {r["status"] for r in V.replay(evaluations, sources, f"{tmp_path}/other", "/none", "t").collect()} == {"not_run"}


def test_damaged_coverage_files_are_counted(spark, tmp_path):
    import gzip
    import json

    one = {"files": [{"file": "a/../b.c", "lines": [{"line_number": 1, "count": 2, "branches": [{"count": 0}, {"count": 1}]}, {"line_number": 2, "count": 0}], "functions": [{"name": "f", "execution_count": 1}]}, {"file": "/else/x.c", "lines": [], "functions": []}]}
    whole = gzip.compress(json.dumps(one).encode())
    for name, data in (("one", whole), ("two", whole), ("cut", whole[:-20]), ("text", gzip.compress(b"no json")), ("none", gzip.compress(b"[]"))):
        (tmp_path / f"{name} 1.gcov.json.gz").write_bytes(data)
    store = jobs.Store(spark, f"{tmp_path}/store")
    got = jobs.collect_coverage(store, f"{tmp_path}/*.gcov.json.gz", "/src")
    assert (got["read"], got["damaged"], got["files_total"], got["lines_total"], got["lines_covered"], got["branches_total"], got["branches_covered"]) == (2, 3, 1, 2, 1, 2, 1)
    assert store.read("source_coverage").first()["file"] == "/src/b.c"
    assert jobs.collect_coverage(store, f"{tmp_path}/nothing/*.json", "/src")["files_total"] == 0


def test_normal_paths(spark):
    import posixpath

    paths = ["/a/b/../c", "/a/./b//c/", "/../../x", "a/../../b", "/" + "d/" * 30 + "../" * 29 + "e", "../x/..", "/a/b/../../..", "x", "/", "/a..b/..c/...", "a/.."]
    from quernflow.functions.text import normal_path

    rows = spark.createDataFrame([(p,) for p in paths], "p string").select("p", normal_path(F.col("p")).alias("n")).collect()
    assert {r["p"]: r["n"] for r in rows} == {p: "" if posixpath.normpath(p) == "." else posixpath.normpath(p) for p in paths}
