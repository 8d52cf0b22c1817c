"""Inputs, prompts within a budget, and rounds of asking."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from quernflow.functions.text import CLIP_MARKER
from quernflow.operators import inputs as N
from quernflow.operators.rounds import AGAIN, Rounds
from quernflow.plans import jobs
from quernflow.sources import named_files

REPORTS = "bug_id long, source_url string, description string, summary string, keywords array<string>"
COMMENTS = "bug_id long, count long, time string, attachment_id long, text string"
PROGRAMS = "bug_id long, index int, kind string, language string, path string, sha256 string, bytes long, content string"
ATTACHMENTS = "bug_id long, index int, id long, summary string, file_name string, is_patch boolean, downloaded boolean"


def tables(spark, comment="fixed by commit 0123456789abcdef"):
    reports = [(1, "u", "first", "s1", ["ice"]), (2, None, None, None, None), (3, "u3", "third", "s3", [])]
    comments = [(1, 2, "t2", None, comment), (1, 0, "t0", 7, "hello"), (1, 1, None, None, "  \n"), (3, 0, "t", None, "x" * 500 + " commit feedfacefeedface"), (9, 0, "t", None, "fixed")]
    programs = [(1, 2, "k", None, "b.c", "s2", 3, "int b;"), (1, 1, "k", "c", "a.c", "s1", 3, "y" * 300)]
    attachments = [(2, 1, 50, "proposed patch", "p.diff", None, True), (2, 2, 51, "log", "l.txt", False, None), (1, 1, 52, None, None, True, None)]
    return [spark.createDataFrame(r, s).repartition(3) for r, s in ((reports, REPORTS), (comments, COMMENTS), (programs, PROGRAMS), (attachments, ATTACHMENTS))]


def test_records(spark):
    got = {r["bug_id"]: r.asDict(True) for r in N.prepared_inputs(*tables(spark), comment_chars=200, program_chars=150).collect()}
    one, two, three = got[1], got[2], got[3]
    assert len(got) == 3
    assert [(c["count"], c["attachment_id"], c["text"]) for c in one["comments"]] == [(0, 7, "hello"), (2, None, "fixed by commit 0123456789abcdef")]
    assert [(p["program_id"], p["language"], p["truncated"], len(p["content"])) for p in one["programs"]] == [("bug-1-poc-001", "c", True, 150), ("bug-1-poc-002", "unknown", False, 6)]
    assert [(e["kind"], e["count"], e["attachment_id"]) for e in one["fix_history"]["evidence"]] == [("bugzilla_comment", 2, None), ("bugzilla_attachment", None, 52)]
    assert one["fix_history"]["commit_hashes"] == ["0123456789abcdef"] and one["evidence_gaps"] == [] and one["metadata"] == {"summary": "s1", "keywords": ["ice"]}
    assert two["comments"] == [] and two["description"] == "" and two["source_url"].endswith("id=2") and two["evidence_gaps"] == [N.NO_PROGRAM]
    assert [e["attachment_id"] for e in two["fix_history"]["evidence"]] == [50]
    assert three["comments"][0]["truncated"] and CLIP_MARKER in three["comments"][0]["text"] and three["fix_history"]["evidence_count"] == 1
    again = {r["bug_id"]: r["input_sha256"] for r in N.prepared_inputs(*tables(spark, "fixed by commit 1123456789abcdef"), comment_chars=200, program_chars=150).collect()}
    assert {i for i in got if got[i]["input_sha256"] != again[i]} == {1}
    counts = N.input_counts(N.prepared_inputs(*tables(spark))).first().asDict()
    assert counts == {"bug_reports": 3, "with_bug_triggering_program": 1, "with_explicit_fix_history": 3, "with_program_and_fix_history": 1, "without_bug_triggering_program": 2, "without_explicit_fix_history": 0}


def test_empty_tables_and_repeated_reports(spark):
    reports, comments, programs, attachments = tables(spark)
    assert N.prepared_inputs(reports.limit(0), comments, programs, attachments).count() == 0
    bare = N.prepared_inputs(reports, comments.limit(0), programs.limit(0), attachments.limit(0)).collect()
    assert len(bare) == 3 and all(r["evidence_gaps"] == [N.NO_PROGRAM, N.NO_FIX] for r in bare)
    with pytest.raises(Exception, match="a report repeats"):
        N.prepared_inputs(reports.unionByName(reports), comments, programs, attachments).collect()


def test_prompts_within_a_budget(spark):
    reports = spark.createDataFrame([(i, "u", "d", "s", None) for i in (1, 2, 3)], REPORTS)
    comments = [(1, i, "t", None, f"fixed {i}") for i in range(3)] + [(2, i, "t", None, f"{i} " + "z" * 9000) for i in range(40)] + [(3, 0, "t", None, "short")]
    programs = [(2, i, "k", "c", f"{i}.c", "s", 1, "p" * 60_000) for i in range(1, 4)] + [(3, i, "k", "c", f"{i}.c", "s", 1, "q" * 3000) for i in range(1, 9)]
    rows = N.prepared_inputs(reports, spark.createDataFrame(comments, COMMENTS), spark.createDataFrame(programs, PROGRAMS), spark.createDataFrame([], ATTACHMENTS))
    got = {r["bug_id"]: r for r in N.prompt_records(rows, 20_000).collect()}
    assert [got[i]["step"] for i in (1, 2, 3)] == [0, 5, 2] and [got[i]["over"] for i in (1, 2, 3)] == [False, False, False]
    assert got[2]["original_chars"] > 500_000
    record = json.loads(got[2]["record"])
    assert len(record["bug_report_comments"]) == 2 and len(record["bug_triggering_programs"]) == 2 and all(len(c["text"]) <= 1000 for c in record["bug_report_comments"])
    assert json.loads(got[1]["record"])["fix_history"]["evidence"][2]["text"] == "fixed 2"
    tight = {r["bug_id"]: (r["step"], r["over"]) for r in N.prompt_records(rows, 900).collect()}
    assert tight[2] == (5, True) and {r["step"] for r in N.prompt_records(rows, 0).collect()} == {0}
    prompt = N.chat(N.prompt_records(rows).where("bug_id = 1"), "be exact", "extract", {"a": ["é"]}).first()
    system, user = json.loads(prompt["prompt"])
    assert (prompt["id"], system) == ("1", {"role": "system", "content": "be exact"})
    assert user["content"].startswith('extract\n\nRequired output JSON shape:\n{\n  "a": [\n    "é"\n  ]\n}\n\nInput record:\n{"bug_id":1,')


def test_inputs_job(spark, tmp_path):
    store = jobs.Store(spark, f"{tmp_path}/store")
    for name, df in zip(("reports", "comments", "programs", "attachments"), tables(spark), strict=True):
        store.write(name, df)
    counts = jobs.prepare_inputs(store, f"{tmp_path}/out")
    assert (counts["bug_reports"], counts["files"]) == (3, 3)
    with open(f"{tmp_path}/out/inputs/bug-2.input.json") as f:
        assert json.load(f)["evidence_gaps"] == [N.NO_PROGRAM]
    assert named_files.verify(spark, f"{tmp_path}/out").count() == 0
    assert jobs.write_prompts(store, "s", "t", {}) == {"prompts": 3, "compacted": 0, "over": 0}


def logged_caller(log):
    """Answers right, wrong once, never parseable, never valid, or fails, by the id in the prompt; each call is logged."""

    def caller(prompt):
        messages = json.loads(prompt)
        kind = messages[1]["content"]
        with open(f"{log}/{kind}-{len(messages)}-{os.urandom(8).hex()}", "w") as f:
            f.write(prompt)
        if kind == "fails":
            raise TimeoutError("late sk-abcdefgh12345")
        content = "no json" if kind == "garbled" else json.dumps({"n": -1 if kind == "never" or kind == "once" and len(messages) == 2 else 1})
        return json.dumps({"choices": [{"message": {"content": content}}]})

    return caller


def test_rounds(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    kinds = ["right", "once", "garbled", "never", "fails"]
    prompts = spark.createDataFrame([(k, json.dumps([{"role": "system", "content": "s"}, {"role": "user", "content": k}])) for k in kinds] + [("null", None)], "id string, prompt string").repartition(3)
    check = lambda rows: rows.select("id", F.when(F.get_json_object("json", "$.n").cast("int") < 0, "n is negative").alias("problem"))
    run = lambda: {r["id"]: (r["status"], r["json"], r["problem"], r["rounds"]) for r in Rounds(spark, f"{tmp_path}/state", logged_caller(str(log)), check).run(prompts).collect()}
    got = run()
    assert got == {
        "right": ("ok", '{"n": 1}', None, 1), "once": ("ok", '{"n": 1}', None, 2), "garbled": ("parse_error", None, "the answer is not a JSON object", 3), "never": ("validation_error", None, "n is negative", 3),
        "fails": ("api_error", None, "TimeoutError: late <redacted-api-key>", 3), "null": ("api_error", None, "no prompt", 3),
    }
    calls = sorted(n.rpartition("-")[0] for n in os.listdir(log))
    assert calls == sorted(["right-2", "once-2", "once-3", "garbled-2", "garbled-3", "garbled-4", "never-2", "never-3", "never-4", "fails-2", "fails-2", "fails-2"])
    mended = next(n for n in os.listdir(log) if n.startswith("once-3"))
    assert json.loads((log / mended).read_text())[2] == {"role": "user", "content": f"{AGAIN[0]}n is negative{AGAIN[1]}"}
    assert run() == got and len(os.listdir(log)) == len(calls)  # a finished state asks nothing
    for d, _, names in os.walk(tmp_path / "state" / "answers-2"):  # as after a driver that was lost in the second round
        for n in names:
            os.remove(os.path.join(d, n))
    assert run() == got
    assert len(os.listdir(log)) == len(calls) + 1  # only what had no answer, the failing row, is asked again
    with pytest.raises(ValueError, match="repeats"):
        Rounds(spark, f"{tmp_path}/other", logged_caller(str(log)), check).run(prompts.unionByName(prompts))
    assert hashlib.sha256(b"").hexdigest() == named_files.EMPTY


def test_text_files_replace_each_other(spark, tmp_path):
    from quernflow.sources import sinks

    for text in ("one", "two é", ""):
        sinks.write_text(spark, f"{tmp_path}/a report.md", text)
        assert (tmp_path / "a report.md").read_text() == text
    assert [n for n in os.listdir(tmp_path) if not n.endswith(".crc")] == ["a report.md"]
    (tmp_path / "folder").mkdir()
    (tmp_path / "folder" / "x").write_text("x")
    with pytest.raises(Exception):  # noqa: B017  a folder is not replaced
        sinks.write_text(spark, f"{tmp_path}/folder", "text")
    assert sorted(n for n in os.listdir(tmp_path) if not n.endswith(".crc")) == ["a report.md", "folder"]


def test_command_line(spark, tmp_path, capsys):
    from quernflow.__main__ import main

    store = jobs.Store(spark, f"{tmp_path}/store")
    for name, df in zip(("reports", "comments", "programs", "attachments"), tables(spark), strict=True):
        store.write(name, df)
    assert main(["prepare-inputs", store.root, "--out", f"{tmp_path}/out"]) == 0
    assert json.loads(capsys.readouterr().out)["files"] == 3
    assert main(["verify-archive", f"{tmp_path}/none"]) == 1 and "error" in capsys.readouterr().err
