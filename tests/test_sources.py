"""Readers and writers on small files."""

import gzip
import json
import urllib.parse

import pytest
from pyspark.sql import functions as F

from quernflow.sources import files, sinks, tracker


def test_jsonl(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"a": 1}\n\n  \n{"a": 2, "x": 3}\n')
    assert sorted(r["a"] for r in files.read_jsonl(spark, str(p), "a long").collect()) == [1, 2]
    p.write_text('{"a": 1}\n[2]\nbad\n')
    with pytest.raises(Exception, match="invalid JSON object"):
        files.read_jsonl(spark, str(p), "a long").collect()
    assert files.read_jsonl(spark, str(p), "a long", strict=False).count() == 1
    assert files.read_jsonl(spark, str(tmp_path / "none"), "a long", optional=True).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_jsonl(spark, str(tmp_path / "none"), "a long")


def test_keyed_and_reports(spark, tmp_path):
    for n in (2, 10):
        d = tmp_path / "reports" / f"bug-{n}"
        d.mkdir(parents=True)
        (d / "report.json").write_text(json.dumps({"id": n}, indent=1))
    assert [r["bug_id"] for r in files.report_paths(spark, str(tmp_path)).collect()] == [2, 10]
    got = files.read_keyed(spark, f"{tmp_path}/reports/*/report.json", "id long").collect()
    assert sorted(r["id"] for r in got) == [2, 10] and got[0]["file_name"] == "report.json"
    with pytest.raises(FileNotFoundError):
        files.report_paths(spark, str(tmp_path / "nothing"))


def test_edge_maps(spark, tmp_path):
    (tmp_path / "m1.map").write_text("1:1\n2:7\n\n1:3\n 5 :2\n")
    assert sorted(r["edge_id"] for r in files.read_edge_maps(spark, str(tmp_path)).collect()) == ["1", "2", "5"]
    assert files.map_entries(spark, str(tmp_path)).first()["edge_map_entries"] == 4


def test_gcov(spark, tmp_path):
    doc = {"files": [
        {"file": "src/a.c", "lines": [{"line_number": 1, "count": 2, "branches": [{"count": 0}, {"count": 1}]}, {"line_number": 2, "count": 0}], "functions": [{"name": "f", "execution_count": 1}, {"name": "", "execution_count": 1}]},
        {"file": "/elsewhere/b.c", "lines": [{"line_number": 1, "count": 1}], "functions": []}, {"file": "x/../../out.c", "lines": [{"line_number": 1, "count": 1}], "functions": []}]}
    with gzip.open(tmp_path / "a.gcov.json.gz", "wt") as f:
        json.dump(doc, f)
    with gzip.open(tmp_path / "b.gcov.json.gz", "wt") as f:
        f.write("{broken")
    got = files.read_gcov(spark, f"{tmp_path}/*.gcov.json.gz", "/root/src")
    from quernflow.operators.coverage import coverage_totals, source_coverage

    per_file = source_coverage(got["lines"], got["functions"], got["branches"])
    row = per_file.first()
    assert per_file.count() == 1 and row["file"] == "/root/src/src/a.c"
    assert (row["lines_total"], row["lines_covered"], row["functions_total"], row["branches_total"], row["branches_covered"]) == (2, 1, 1, 2, 1)
    assert coverage_totals(per_file).first()["line_coverage_percent"] == 50.0


def test_stats_dotenv_listing(spark, tmp_path):
    (tmp_path / "stats").write_text("execs_done : 12\nbanner   : a:b\nnoise\n")
    assert {r["key"]: r["value"] for r in files.read_stats(spark, str(tmp_path / "stats")).collect()} == {"execs_done": "12", "banner": "a:b"}
    assert files.parse_dotenv("# c\nexport A='x y'\nB=1\n\n") == {"A": "x y", "B": "1"}
    with pytest.raises(ValueError, match="line 2"):
        files.parse_dotenv("A=1\nwhat")
    df = spark.createDataFrame([("q/id:1",), ("q/.state/id:2",), ("q/other",)], "path string")
    assert files.corpus_files(df, True).count() == 2 and files.corpus_files(df, False).count() == 2


def test_attachments_and_tests(spark):
    df = spark.createDataFrame([("aGVsbG8=",), ("???",), (None,)], "data string")
    got = files.decode_attachments(df, 4).collect()
    assert got[0]["content"] is None and got[0]["too_large"] and got[1]["content"] is None and not got[2]["too_large"]
    assert files.decode_attachments(df).first()["content"] == b"hello"
    odd = [("xpr12345.c", "PR tree_opt.x/77777"), ("pr-54321.c", ""), ("9pr33333.c", ""), ("pr44444_pr55555.c", "")]
    found = files.linked_tests(spark.createDataFrame(odd, "path string, text string"), True)
    assert sorted((r["bug_id"], r["path"]) for r in found.collect()) == [(12345, "xpr12345.c"), (44444, "pr44444_pr55555.c"), (77777, "xpr12345.c")]
    t = spark.createDataFrame([("dir/pr12345.c", ""), ("x.c", "/* PR target/54321 */"), ("pr12.c", "")], "path string, text string")
    assert [r["bug_id"] for r in files.linked_tests(t).collect()] == [12345]
    assert sorted(r["bug_id"] for r in files.linked_tests(t, True).collect()) == [12345, 54321]
    assert files.linked_tests(t, True, spark.createDataFrame([(54321,)], "bug_id long")).count() == 1


def test_lossy_text(spark, tmp_path):
    (tmp_path / "bad.txt").write_bytes(b"ok \xff end")
    row = files.read_text_lossy(spark, str(tmp_path)).first()
    assert row["utf8_replacement_used"] and "�" in row["text"]


def test_tracker(spark, tmp_path):
    body = {"bugs": {"7": {"comments": [{"count": 0, "text": "hi"}]}}}
    (tmp_path / (urllib.parse.quote("bug/7/comment", safe="") + ".json")).write_text(json.dumps(body))
    spark.dataSource.register(tracker.TrackerSource)
    rows = spark.read.format("tracker").option("folder", str(tmp_path)).option("queries", json.dumps(["bug/7/comment"])).load()
    got = tracker.unnest_comments(rows.select(F.lit(7).alias("bug_id"), "body")).first()
    assert (got["bug_id"], got["text"]) == (7, "hi")
    attached = spark.createDataFrame([(7, json.dumps({"bugs": {"7": [{"id": 1, "file_name": "a.c"}]}}))], "bug_id long, body string")
    assert tracker.unnest_attachments(attached).first()["file_name"] == "a.c"
    waits, answers = [], iter([(503, {}, ""), (429, {"Retry-After": "9"}, ""), (200, {}, "x")])
    assert tracker.fetch(lambda _: next(answers), "q", sleep=waits.append) == "x" and waits == [1.0, 9.0]
    with pytest.raises(OSError, match="404"):
        tracker.fetch(lambda _: (404, {}, ""), "q", sleep=waits.append)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"], None)], "z long, l array<string>, n string")
    sinks.write_jsonl(df, str(tmp_path / "j"))
    sinks.write_jsonl(df, str(tmp_path / "j"), "append")
    lines = [x for p in (tmp_path / "j").glob("part-*") for x in p.read_text().splitlines()]
    assert lines == ['{"l":["a","b"],"n":null,"z":1}'] * 2
    sinks.write_csv_index(df.drop("n"), str(tmp_path / "c"))
    assert "a;b" in next((tmp_path / "c").glob("part-*")).read_text()
    sinks.write_json(spark, str(tmp_path / "m.json"), {"b": 1, "a": "é"})
    sinks.write_json(spark, str(tmp_path / "m.json"), {"b": 2})
    assert json.loads((tmp_path / "m.json").read_text()) == {"b": 2}
    assert sinks.markdown_table(["a"], [[1]]) == "| a |\n| --- |\n| 1 |"
    assert "## x" in sinks.report("t", {"x": df.select("z")})
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), spark.createDataFrame([(2, "c")], "k long, v string")
    assert {r["k"]: r["v"] for r in sinks.upsert(old, new, "k").collect()} == {1: "a", 2: "c"}
