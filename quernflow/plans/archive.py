"""Archives of reports: their tables, read from a folder, and the rules that a sound archive keeps."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from quernflow.functions.classify import EXPANDED_TIERS
from quernflow.operators.constraints import Distinct, Figure, Holds, Link, Rule, SameKeys, violations
from quernflow.sources.files import read_jsonl
from quernflow.sources.named_files import folder_files

# Where official reports come from, and the files that an archive must have.
REST = "https://gcc.gnu.org/bugzilla/rest.cgi"
WEB = "https://gcc.gnu.org/bugzilla/"
REQUIRED = ("manifest.json", "index.jsonl", "llm-ready.jsonl", "llm-dataset.jsonl", "llm-expanded-ready.jsonl", "llm-expanded-dataset.jsonl", "index.csv", "SUMMARY.md")
RAW_SEARCHES = ("search-summary-loongarch.json", "search-target-loongarch.json", "search-comments-loongarch.json", "search-testsuite-pr-ids.json")
RAW_OF_REPORT = ("bug", "comments", "attachments")
LISTS = {"ready": "llm-ready", "expanded": "llm-expanded-ready", "general": "llm-general-ready"}
DATASETS = {"ready": "llm-dataset", "expanded": "llm-expanded-dataset", "general": "llm-general-dataset"}
FLAGS = {"ready": "llm_ready", "expanded": "expanded_llm_ready", "general": "general_llm_ready"}
FIGURES = {"ready": "llm_ready_reports", "expanded": "expanded_llm_ready_reports", "general": "general_llm_ready_reports"}

_TESTCASE = "struct<path: string, sha256: string, kind: string, provenance: struct<source_url: string, gcc_git_revision: string>>"
_REPORT = (
    "metadata struct<id: long>, source_url string, description string, comments array<struct<text: string>>, relevance struct<tier: string>, "
    "architecture_scope struct<scope: string>, disposition struct<eligible_as_gcc_bug_report: boolean>, llm_ready boolean, expanded_llm_ready boolean, "
    f"general_llm_ready boolean, testcases array<{_TESTCASE}>"
)
_INDEX = "bug_id long, report_path string, llm_ready boolean, expanded_llm_ready boolean, general_llm_ready boolean"
_DATASET = "bug_id long, description string, architecture_scope struct<scope: string>, testcases array<struct<source_path: string, source_sha256: string>>"
_MANIFEST = "errors array<string>, base_url string, corpus_scope string, queries array<struct<raw_file: string>>, counts map<string, long>"


def archive_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of an archive folder. Lists of the general scope that the folder lacks are not among them.

    files (path, sha256), manifest, figures (name, value), index, reports, testcases, and for each list and dataset a table,
    datasets with their testcases in ``<name>_testcases``. Paths are relative to the folder. Files are read on executors, whole; an
    empty file counts as missing.
    """
    root = root.rstrip("/")
    files = folder_files(spark, root).select("path", F.sha2("content", 256).alias("sha256"))
    manifest = spark.read.schema(_MANIFEST).json(f"{root}/manifest.json", multiLine=True)
    tables = {"files": files, "manifest": manifest, "figures": manifest.select(F.explode("counts").alias("name", "value")), "index": read_jsonl(spark, f"{root}/index.jsonl", _INDEX)}
    try:
        reports = spark.read.schema(_REPORT).json(f"{root}/reports/bug-*/report.json", multiLine=True)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        reports = spark.createDataFrame([], _REPORT).withColumn("_metadata", F.struct(F.lit("").alias("file_path")))
    folder = F.concat(F.lit("reports/"), F.regexp_extract(F.col("_metadata.file_path"), r"/reports/([^/]+)/report\.json$", 1))
    reports = reports.withColumn("folder", folder)
    tables["reports"] = reports.select(
        F.col("metadata.id").alias("bug_id"), F.concat("folder", F.lit("/report.json")).alias("path"), "folder", "source_url", F.coalesce("description", F.lit("")).alias("description"),
        F.coalesce(F.get("comments", F.lit(0))["text"], F.lit("")).alias("first_comment"), F.col("relevance.tier").alias("tier"), F.col("architecture_scope.scope").alias("scope"),
        F.col("disposition.eligible_as_gcc_bug_report").alias("eligible"), F.coalesce(F.size("testcases"), F.lit(0)).alias("n_testcases"), *FLAGS.values(),
    )
    case = reports.select(F.col("metadata.id").alias("bug_id"), "folder", F.explode("testcases").alias("t"))
    tables["testcases"] = case.select("bug_id", F.concat_ws("/", "folder", "t.path").alias("path"), "t.sha256", "t.kind", F.col("t.provenance.source_url").alias("source_url"), F.col("t.provenance.gcc_git_revision").alias("revision"))
    known = {r["path"] for r in files.where(F.col("path").isin(*[f"{n}.jsonl" for n in (*LISTS.values(), *DATASETS.values())])).select("path").collect()}  # six at most
    for name in LISTS:
        if f"{LISTS[name]}.jsonl" in known:
            tables[f"{name}_list"] = read_jsonl(spark, f"{root}/{LISTS[name]}.jsonl", "bug_id long")
        if f"{DATASETS[name]}.jsonl" in known:
            rows = read_jsonl(spark, f"{root}/{DATASETS[name]}.jsonl", _DATASET)
            tables[f"{name}_dataset"] = rows.select("bug_id", "description", F.col("architecture_scope.scope").alias("scope"), F.coalesce(F.size("testcases"), F.lit(0)).alias("n_testcases"))
            tables[f"{name}_testcases"] = rows.select("bug_id", F.explode("testcases").alias("t")).select("bug_id", "t.source_path", "t.source_sha256")
    return tables


def _ready_rules() -> list[Rule]:
    """What a report that a flag calls ready must be."""
    say = lambda flag, condition: f"NOT coalesce({flag}, false) OR ({condition})"
    tiers = ", ".join(f"'{t}'" for t in EXPANDED_TIERS)
    wants = {"llm_ready": ("ready", "tier = 'architecture_specific'"), "expanded_llm_ready": ("expanded", f"tier IN ({tiers})")}
    rules: list[Rule] = []
    for flag, (name, tier) in wants.items():
        rules += [Holds(f"{name}_tier", "reports", "bug_id", say(flag, tier)), Holds(f"{name}_scope", "reports", "bug_id", say(flag, "scope = 'loongarch64'")), Holds(f"{name}_disposition", "reports", "bug_id", say(flag, "eligible"))]
        rules += [Holds(f"{name}_description", "reports", "bug_id", say(flag, r"description RLIKE '\\S'")), Holds(f"{name}_testcases", "reports", "bug_id", say(flag, "n_testcases > 0"))]
    return rules


def rules(scope: str = "loongarch", datasets: tuple[str, ...] = ("ready", "expanded", "general"), lists: tuple[str, ...] = ("ready", "expanded", "general")) -> list[Rule]:
    """The rules of an archive of a scope with these lists and datasets."""
    out: list[Rule] = [
        Holds("manifest_errors", "manifest", "'manifest'", "coalesce(size(errors), 0) <= 0"),
        Holds("manifest_source", "manifest", "'manifest'", f"base_url = '{REST}'"),
        Link("required_file", "required", "path", ("path",), "files", ("path",)),
        Link("report_file", "index", "bug_id", ("report_path",), "files", ("path",)),
        Link("report_row", "index", "bug_id", ("report_path",), "reports", ("path",)),
        Link("report_id", "index", "bug_id", ("report_path",), "reports", ("path",), equal=("bug_id", "bug_id")),
        Link("report_markdown", "reports", "bug_id", ("folder || '/report.md'",), "files", ("path",)),
        *[Link(f"report_raw_{n}", "reports", "bug_id", (f"folder || '/raw/{n}.json'",), "files", ("path",)) for n in RAW_OF_REPORT],
        Holds("report_source", "reports", "bug_id", f"source_url = '{WEB}show_bug.cgi?id=' || bug_id"),
        Holds("report_description", "reports", "bug_id", "description = first_comment"),
        *_ready_rules(),
        Link("testcase_file", "testcases", "path", ("path",), "files", ("path",)),
        Link("testcase_checksum", "testcases", "path", ("path",), "files", ("path",), equal=("sha256", "sha256")),
        Holds("testcase_provenance", "testcases", "path", f"coalesce(kind, '') NOT IN ('bugzilla_attachment', 'comment_code_block', 'comment_reproducer') OR startswith(source_url, '{WEB}')"),
        Holds("testcase_revision", "testcases", "path", "coalesce(kind, '') <> 'gcc_testsuite_regression' OR coalesce(revision, '') <> ''"),
        Figure("figure_reports", "index", "count(*)", "candidate_reports"),
        Figure("figure_testcases", "testcases", "count(*)", "testcase_artifacts"),
    ]
    if scope == "loongarch":
        out.append(Holds("report_relevant", "reports", "bug_id", "tier <> 'not_loongarch'"))
    for n in lists:
        out += [SameKeys(f"{n}_list", ("index", "bug_id", FLAGS[n]), (f"{n}_list", "bug_id", "true")), Figure(f"figure_{n}_list", f"{n}_list", "count(*)", FIGURES[n])]
    for n in datasets:
        d, t = f"{n}_dataset", f"{n}_testcases"
        if n in lists:
            out.append(SameKeys(d, (f"{n}_list", "bug_id", "true"), (d, "bug_id", "true")))
        out.append(Figure(f"figure_{d}", d, "count(*)", FIGURES[n].replace("_ready_reports", "_dataset_records")))
        out.append(Link(f"{d}_description", d, "bug_id", ("bug_id",), "reports", ("bug_id",), equal=("description", "description")))
        out.append(Holds(f"{d}_testcases", d, "bug_id", "n_testcases > 0"))
        out += [Link(f"{d}_source", t, "source_path", ("source_path",), "files", ("path",)), Link(f"{d}_checksum", t, "source_path", ("source_path",), "files", ("path",), equal=("source_sha256", "sha256"))]
        if n != "ready":
            out.append(Link(f"{d}_eligible", d, "bug_id", ("bug_id",), "reports", ("bug_id",), equal=("true", f"coalesce({FLAGS[n]}, false)")))
        if n != "general":
            out += [Holds(f"{d}_scope", d, "bug_id", "scope = 'loongarch64'"), Distinct(f"{d}_repeats", t, "bug_id", ("source_sha256",))]
    return out


def archive_violations(tables: Mapping[str, DataFrame], scope: str = "loongarch") -> DataFrame:
    """(rule, key, detail) of an archive's tables as ``archive_tables`` gives them; lists that are not there are not judged,
    but that the files of the first two scopes are missing is a violation itself."""
    manifest = tables["manifest"]
    names = F.filter(F.transform(F.coalesce("queries", F.array().cast("array<struct<raw_file:string>>")), lambda q: q["raw_file"]), lambda n: n != "")
    raw = manifest.select(F.explode(F.when(F.size(names) > 0, names).otherwise(F.array(*map(F.lit, RAW_SEARCHES)))).alias("name")).select(F.concat(F.lit("raw/"), "name").alias("path"))
    fixed = manifest.sparkSession.createDataFrame([(p,) for p in (*REQUIRED, "raw/version.json")], "path string")
    has = lambda kind: tuple(n for n in LISTS if f"{n}_{kind}" in tables)
    return violations({**tables, "required": fixed.unionByName(raw)}, rules(scope, has("dataset"), has("list")))
