"""Inputs for a model: a report with its comments, programs and fix history as one nested record, and prompts of a bounded size."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernflow.functions import text as T
from quernflow.operators.corpus import LADDER, compact_comments, compact_programs
from quernflow.operators.digests import row_json

NO_PROGRAM, NO_FIX = "missing_bug_triggering_program", "missing_explicit_fix_history"  # fixed values
_PARTS = {
    "part": "int", "pos": "bigint", "number": "bigint", "time": "string", "attachment_id": "bigint", "text": "string", "truncated": "boolean", "fix": "boolean", "commit_hashes": "array<string>", "kind": "string",
    "language": "string", "path": "string", "sha256": "string", "bytes": "bigint", "summary": "string", "file_name": "string", "is_patch": "boolean", "downloaded": "boolean",
}
_COMMENT, _PROGRAM, _PATCH = 0, 1, 2


def _part(rows: DataFrame, part: int, **columns: Column) -> DataFrame:
    """Rows of one kind, as narrow as the record needs them, in the shape that all kinds share."""
    known = {"part": F.lit(part), **columns}
    return rows.select("bug_id", F.struct(*[known.get(n, F.lit(None)).cast(t).alias(n) for n, t in _PARTS.items()]).alias("p"))


def prepared_inputs(reports: DataFrame, comments: DataFrame, programs: DataFrame, attachments: DataFrame, comment_chars: int = 30_000, program_chars: int = 120_000) -> DataFrame:
    """A record a report: (bug_id, input_id, source_url, description, metadata, comments, programs, fix_history, evidence_gaps,
    input_sha256).

    reports (bug_id, source_url, description, others: the metadata), comments (bug_id, count, time, attachment_id, text), programs
    (bug_id, index, kind, language, path, sha256, bytes, content), attachments (bug_id, index, id, summary, file_name, is_patch,
    downloaded). Texts are clipped where they lie, and all kinds of parts meet in one shuffle by report, in which each is a
    narrow row; a record's size is that of its clipped parts. Parts of unknown reports count for nothing, reports without
    parts have empty lists, comments without a text are left out. A report that repeats is an error.
    """
    c = F.col
    clipped = T.clip(c("text"), comment_chars)
    spoken = comments.where(c("text").rlike(r"\S"))
    fix = T.is_fix_comment(c("text"))
    parts = [
        _part(spoken, _COMMENT, pos=c("count"), number=c("count"), time=c("time"), attachment_id=c("attachment_id"), text=clipped, truncated=T.is_clipped(c("text"), comment_chars), fix=fix, commit_hashes=F.when(fix, T.commit_hashes(clipped))),
        _part(
            programs, _PROGRAM, pos=c("index"), kind=c("kind"), language=F.coalesce("language", F.lit("unknown")), path=c("path"), sha256=c("sha256"), bytes=c("bytes"),
            text=T.clip(c("content"), program_chars), truncated=T.is_clipped(c("content"), program_chars),
        ),
        _part(attachments.where(T.attachment_is_fix_evidence(c("summary"), c("file_name"), c("is_patch"))), _PATCH, pos=c("index"), attachment_id=c("id"), summary=c("summary"), file_name=c("file_name"), is_patch=F.coalesce("is_patch", F.lit(False)), downloaded=F.coalesce("downloaded", F.lit(False))),
    ]
    gathered = reduce(DataFrame.unionByName, parts).groupBy("bug_id").agg(F.array_sort(F.collect_list("p")).alias("parts"))
    own = {"bug_id", "source_url", "description"}
    meta = [c(n) for n in reports.columns if n not in own] or [F.lit(None).cast("string").alias("none")]
    once = reports.groupBy("bug_id").agg(F.count("*").alias("n"), F.first(F.struct("source_url", F.coalesce("description", F.lit("")).alias("description"), F.struct(*meta).alias("metadata"))).alias("r"))
    once = once.withColumn("bug_id", F.when(c("n") == 1, c("bug_id")).otherwise(F.raise_error(F.concat(F.lit("a report repeats: "), c("bug_id")))))
    rows = once.join(gathered, "bug_id", "left").withColumn("parts", F.coalesce("parts", F.expr("cast(array() AS array<struct<" + ",".join(f"{n}:{t}" for n, t in _PARTS.items()) + ">>)")))
    of = lambda kind: F.filter("parts", lambda p: p["part"] == kind)
    said = F.transform(of(_COMMENT), lambda p: F.struct(p["number"].alias("count"), p["time"].alias("time"), p["attachment_id"].alias("attachment_id"), p["text"].alias("text"), p["truncated"].alias("truncated")))
    number = lambda i: F.lpad((i + 1).cast("string"), 3, "0")
    wide = lambda i: F.when(i < 999, number(i)).otherwise((i + 1).cast("string"))
    name = lambda i: F.concat(F.lit("bug-"), c("bug_id").cast("string"), F.lit("-poc-"), wide(i))
    made = F.transform(of(_PROGRAM), lambda p, i: F.struct(name(i).alias("program_id"), *[p[n].alias(n) for n in ("kind", "language", "path", "sha256", "bytes")], p["text"].alias("content"), p["truncated"].alias("truncated")))
    proof = F.transform(F.filter("parts", lambda p: (p["part"] == _PATCH) | p["fix"]), lambda p: F.struct(F.when(p["part"] == _PATCH, "bugzilla_attachment").otherwise("bugzilla_comment").alias("kind"), p["number"].alias("count"), *[p[n].alias(n) for n in ("time", "attachment_id", "text", "truncated", "commit_hashes", "summary", "file_name", "is_patch", "downloaded")]))
    rows = rows.select("bug_id", "r.*", said.alias("comments"), made.alias("programs"), proof.alias("evidence"))
    hashes = F.array_distinct(F.flatten(F.transform("evidence", lambda e: F.coalesce(e["commit_hashes"], F.array().cast("array<string>")))))
    rows = rows.withColumn("fix_history", F.struct((F.size("evidence") > 0).alias("available"), F.size("evidence").alias("evidence_count"), hashes.alias("commit_hashes"), c("evidence"))).drop("evidence")
    gaps = F.array_compact(F.array(F.when(F.size("programs") == 0, NO_PROGRAM), F.when(~c("fix_history.available"), NO_FIX)))
    digest = F.sha2(row_json("bug_id", "comments", "description", "fix_history", "programs"), 256)
    web = F.coalesce("source_url", F.concat(F.lit("https://gcc.gnu.org/bugzilla/show_bug.cgi?id="), "bug_id"))
    return rows.select("bug_id", F.concat(F.lit("bug-"), "bug_id").alias("input_id"), web.alias("source_url"), "description", "metadata", "comments", "programs", "fix_history", gaps.alias("evidence_gaps"), digest.alias("input_sha256"))


def input_counts(inputs: DataFrame) -> DataFrame:
    """One row of counts: reports with and without a program and a fix history."""
    program, fix = F.size("programs") > 0, F.col("fix_history.available")
    return inputs.agg(
        F.count("*").alias("bug_reports"), F.count_if(program).alias("with_bug_triggering_program"), F.count_if(fix).alias("with_explicit_fix_history"), F.count_if(program & fix).alias("with_program_and_fix_history"),
        F.count_if(~program).alias("without_bug_triggering_program"), F.count_if(~fix).alias("without_explicit_fix_history"),
    )


def _packed(comments: Column, programs: Column, fixes: Column) -> Column:
    history = F.struct(*[F.col(f"fix_history.{n}").alias(n) for n in ("available", "commit_hashes", "evidence_count")], fixes.alias("evidence"))
    record = F.struct("bug_id", comments.alias("bug_report_comments"), programs.alias("bug_triggering_programs"), "description", "evidence_gaps", history.alias("fix_history"), "input_id", "metadata", "source_url")
    return F.to_json(record)


def _shortened(most: int):
    """A function of a piece of evidence that clips its text, where it has one."""
    return lambda e: e.withField("truncated", e["truncated"] | T.is_clipped(e["text"], most)).withField("text", F.when(e["text"].isNotNull(), T.clip(e["text"], most)))


def prompt_records(inputs: DataFrame, most_chars: int = 120_000) -> DataFrame:
    """(bug_id, step, record, original_chars, over): the record as JSON by the first step of the ladder that fits.

    Step 0 is the whole record, taken if it fits or ``most_chars`` is 0; the others keep fewer and shorter comments, evidence and
    programs. ``over`` says that the last step is still too long; it is taken all the same.
    """
    whole = _packed(F.col("comments"), F.col("programs"), F.col("fix_history.evidence"))
    out = inputs.withColumn("p0", whole)
    counts = F.transform(F.filter("fix_history.evidence", lambda e: e["kind"] == "bugzilla_comment"), lambda e: e["count"])
    for i, (n_comments, comment, n_fixes, fix, n_programs, program, total) in enumerate(LADDER, 1):
        short = compact_programs(F.transform("programs", lambda p: p["content"]), n_programs, program, total)
        programs = F.zip_with(F.slice("programs", 1, n_programs), short, lambda p, s: p.withField("content", s).withField("truncated", p["truncated"] | (F.length(s) < F.length(p["content"]))))
        fixes = F.transform(F.slice("fix_history.evidence", 1, n_fixes), _shortened(fix))
        out = out.withColumn(f"p{i}", _packed(compact_comments(F.col("comments"), counts, n_comments, comment), programs, fixes))
    last = len(LADDER)
    fits = lambda i: F.lit(most_chars <= 0) | (F.length(f"p{i}") <= most_chars)
    told = lambda i: F.struct(F.lit(i).alias("step"), F.col(f"p{i}").alias("record"), (~fits(i)).alias("over"))
    choice = reduce(lambda a, i: a.when(fits(i), told(i)), range(1, last), F.when(fits(0), told(0))).otherwise(told(last))
    return out.select("bug_id", choice.alias("c"), F.length("p0").alias("original_chars")).select("bug_id", "c.step", "c.record", "original_chars", "c.over")


def chat(records: DataFrame, system: str, task: str, contract: object, key: str = "bug_id") -> DataFrame:
    """(id, prompt): the messages of a chat as JSON, with the task, the shape of the answer and the record in the user's."""
    shape = json.dumps(contract, ensure_ascii=False, indent=2)
    user = F.concat(F.lit(f"{task}\n\nRequired output JSON shape:\n{shape}\n\nInput record:\n"), "record")
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return records.select(F.col(key).cast("string").alias("id"), F.to_json(F.array(message("system", F.lit(system)), message("user", user))).alias("prompt"))
