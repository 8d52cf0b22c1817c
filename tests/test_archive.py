"""Constraint suites and the rules of archives, each rule broken once."""

import hashlib
import json

import pytest

from quernflow.operators import constraints as C
from quernflow.plans import archive, jobs


def test_each_kind_of_rule(spark):
    a = spark.createDataFrame([(1, "x", 5), (2, None, 7), (2, "y", 7), (3, "z", None), (None, "n", 1)], "id long, name string, n long")
    b = spark.createDataFrame([(1, "x"), (2, "other"), (4, "w"), (1, "w")], "id long, name string")
    figures = spark.createDataFrame([("rows", 5), ("sum", 1)], "name string, value long")
    rules = [
        C.Holds("positive", "a", "id", "n > 5"), C.Holds("named", "a", "id", "name IS NOT NULL"), C.Distinct("twice", "a", "id", ("n",)),
        C.SameKeys("same", ("a", "id", "n > 5"), ("b", "id", "true")), C.SameKeys("all", ("a", "id", "true"), ("a", "id", "id IS NOT NULL")),
        C.Link("found", "a", "id", ("id",), "b", ("id",)), C.Link("equal", "a", "name", ("id",), "b", ("id",), where="n IS NOT NULL", equal=("name", "name")),
        C.Figure("rows", "a", "count(*)", "rows"), C.Figure("sum", "a", "sum(n)", "sum"), C.Figure("none", "b", "count(*)", "unknown"),
    ]
    got = sorted((tuple(r) for r in C.violations({"a": a, "b": b, "figures": figures}, rules).collect()), key=repr)
    want = [
        ("positive", "1", ""), ("positive", "3", ""), ("positive", None, ""), ("named", "2", ""), ("twice", "2", "1"), ("same", "1", "b"), ("same", "4", "b"), ("all", None, "a"),
        ("found", "3", "3"), ("found", None, ""), ("equal", None, ""), ("equal", "x", ""), ("equal", "y", ""), ("sum", "sum", "is 20 not 1"), ("none", "unknown", "is 4 not null"),
    ]
    assert got == sorted(want, key=repr)
    assert C.violations({"a": a.limit(0), "b": b.limit(0), "figures": figures}, rules[:7]).count() == 0


def put(root, path, value):
    target = root / path
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(value if isinstance(value, str) else json.dumps(value))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def a_report(i, **more):
    case = {"path": f"testcases/{i}.c", "sha256": sha(f"int x{i};"), "kind": "comment_code_block", "provenance": {"source_url": f"{archive.WEB}show_bug.cgi?id={i}"}}
    return {
        "metadata": {"id": i}, "source_url": f"{archive.WEB}show_bug.cgi?id={i}", "description": f"text {i}", "comments": [{"text": f"text {i}"}], "relevance": {"tier": "architecture_specific"},
        "architecture_scope": {"scope": "loongarch64"}, "disposition": {"eligible_as_gcc_bug_report": True}, "llm_ready": True, "expanded_llm_ready": True, "general_llm_ready": True, "testcases": [case],
    } | more


def write_archive(root, n=3, **manifest):
    reports = [a_report(i) for i in range(1, n + 1)]
    lines = lambda rows: "".join(json.dumps(r) + "\n" for r in rows)
    for r in reports:
        i = r["metadata"]["id"]
        put(root, f"reports/bug-{i}/report.json", r)
        for name in ("report.md", "raw/bug.json", "raw/comments.json", "raw/attachments.json"):
            put(root, f"reports/bug-{i}/{name}", "{}")
        put(root, f"reports/bug-{i}/testcases/{i}.c", f"int x{i};")
    index = [{"bug_id": i, "report_path": f"reports/bug-{i}/report.json", "llm_ready": True, "expanded_llm_ready": True, "general_llm_ready": True} for i in range(1, n + 1)]
    dataset = [{"bug_id": i, "description": f"text {i}", "architecture_scope": {"scope": "loongarch64"}, "testcases": [{"source_path": f"reports/bug-{i}/testcases/{i}.c", "source_sha256": sha(f"int x{i};")}]} for i in range(1, n + 1)]
    put(root, "index.jsonl", lines(index))
    for name in archive.LISTS:
        put(root, f"{archive.LISTS[name]}.jsonl", lines(index))
        put(root, f"{archive.DATASETS[name]}.jsonl", lines(dataset))
    for name in ("index.csv", "SUMMARY.md", "raw/version.json", "raw/q.json"):
        put(root, name, "x")
    counts = {"candidate_reports": n, "testcase_artifacts": n} | dict.fromkeys([*archive.FIGURES.values(), *(f.replace("_ready_reports", "_dataset_records") for f in archive.FIGURES.values())], n)
    put(root, "manifest.json", {"errors": [], "base_url": archive.REST, "corpus_scope": "loongarch", "queries": [{"raw_file": "q.json"}], "counts": counts} | manifest)


def found(spark, root):
    return sorted((r["rule"], r["key"]) for r in archive.archive_violations(archive.archive_tables(spark, str(root))).collect())


def test_sound_archive_has_no_violation(spark, tmp_path):
    write_archive(tmp_path / "an archive")
    assert found(spark, tmp_path / "an archive") == []
    assert jobs.verify_archive(spark, str(tmp_path / "an archive")) == {"reports": 3, "testcases": 3, "ready": 3, "expanded": 3, "general": 3}


def test_faults_on_disk(spark, tmp_path):
    write_archive(tmp_path, base_url="https://example.org", errors=["timeout"], queries=[])
    report = a_report(2, description="edited", general_llm_ready=False, llm_ready=True, relevance={"tier": "not_loongarch"}, disposition=None)
    report["testcases"][0] |= {"kind": "gcc_testsuite_regression"}
    put(tmp_path, "reports/bug-2/report.json", report)
    put(tmp_path, "reports/bug-3/testcases/3.c", "int other;")
    put(tmp_path, "reports/bug-1/report.json", a_report(9))
    for gone in ("SUMMARY.md", "reports/bug-3/report.md", "reports/bug-2/raw/comments.json", "llm-general-dataset.jsonl"):
        (tmp_path / gone).unlink()
    put(tmp_path, "llm-ready.jsonl", '{"bug_id": 1}\n{"bug_id": 2}\n{"bug_id": 7}\n')
    got = found(spark, tmp_path)
    want = {
        ("manifest_errors", "manifest"), ("manifest_source", "manifest"), ("required_file", "SUMMARY.md"), *[("required_file", f"raw/{n}") for n in archive.RAW_SEARCHES], ("report_id", "1"), ("report_markdown", "3"),
        ("report_raw_comments", "2"), ("report_description", "2"), ("report_relevant", "2"), ("ready_tier", "2"), ("ready_disposition", "2"), ("expanded_tier", "2"), ("expanded_disposition", "2"), ("testcase_revision", "reports/bug-2/testcases/2.c"),
        ("testcase_checksum", "reports/bug-3/testcases/3.c"), ("testcase_file", "reports/bug-1/testcases/9.c"), ("ready_list", "3"), ("ready_list", "7"), ("ready_dataset", "3"), ("ready_dataset", "7"),
        *[(f"{d}_dataset_{what}", key) for d in ("ready", "expanded") for what, key in (("description", "2"), ("checksum", "reports/bug-3/testcases/3.c"))],
    }
    assert set(got) == want and len(got) == len(want)
    with pytest.raises(ValueError, match="rule"):
        jobs.verify_archive(spark, str(tmp_path))
