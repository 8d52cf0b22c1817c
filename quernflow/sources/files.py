"""Readers of the file formats that the pipelines exchange."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from quernflow.functions.text import normal_path


def _missing(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(error)


def read_jsonl(spark: SparkSession, path: str, schema: str, strict: bool = True, optional: bool = False) -> DataFrame:
    """JSON objects, one a line; blank lines are skipped.

    ``strict``: a bad line, or one that is no object, is an error that names the line's text; else such lines are left out.
    ``optional``: a missing file is an empty table. Columns missing in a record are null.
    """
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if optional and _missing(error):
            return spark.createDataFrame([], schema)
        raise
    lines = lines.where(F.trim("value") != "")
    value = F.try_parse_json("value")
    good = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    if strict:
        checked = F.when(good, F.col("value")).otherwise(F.raise_error(F.concat(F.lit("invalid JSON object in a line: "), F.left("value", F.lit(200)))))
        lines = lines.select(checked.alias("value"))
    else:
        lines = lines.where(good)
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*")


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object a file; anything else is an error."""
    return spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST")


def read_keyed(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """A folder with a JSON file per key, with the file's name in ``file_name``; no file is an empty table."""
    try:
        rows = spark.read.schema(schema).json(pattern, multiLine=True)
    except AnalysisException as error:
        if _missing(error):
            return spark.createDataFrame([], schema + ", file_name string")
        raise
    return rows.select("*", F.col("_metadata.file_name").alias("file_name"))


def report_paths(spark: SparkSession, root: str) -> DataFrame:
    """(bug_id, path) of the report files of an archive in either layout, by number; no report folder is an error."""
    for base in (f"{root}/archive/reports", f"{root}/reports"):
        try:
            found = spark.read.format("binaryFile").option("pathGlobFilter", "report.json").option("recursiveFileLookup", "true").load(base)
        except AnalysisException as error:
            if _missing(error):
                continue
            raise
        number = F.regexp_extract("path", r"bug-(\d+)", 1)
        return found.select(F.when(number == "", F.lit(0)).otherwise(number).cast("long").alias("bug_id"), "path").orderBy("bug_id")
    raise FileNotFoundError(f"no reports below {root}")


def read_text_lossy(spark: SparkSession, path: str) -> DataFrame:
    """(path, text, utf8_replacement_used) of whole files, bytes that are no UTF-8 replaced."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    text = F.make_valid_utf8(F.col("content").cast("string"))
    return raw.select("path", text.alias("text"), (~F.is_valid_utf8(F.col("content").cast("string"))).alias("utf8_replacement_used"))


def edge_id(line: Column, first_word: bool = True) -> Column:
    """Edge id of a map line ``id:count``: its first word, or all before the colon."""
    before = F.trim(F.split(F.trim(line), ":")[0])
    return F.split(before, r"\s+")[0] if first_word else before


def read_edge_maps(spark: SparkSession, path: str, first_word: bool = True) -> DataFrame:
    """(map_id, edge_id) distinct, from text maps; ``map_id`` is the file's name."""
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("map_id"), "value").where(F.trim("value") != "")
    return lines.select("map_id", edge_id(F.col("value"), first_word).alias("edge_id")).where("edge_id <> ''").distinct()


def map_entries(spark: SparkSession, path: str) -> DataFrame:
    """(map_id, edge_map_entries): lines that are not blank, repeats counted."""
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("map_id"), "value").where(F.trim("value") != "")
    return lines.groupBy("map_id").agg(F.count("*").alias("edge_map_entries"))


GCOV = (
    "files array<struct<file: string, lines: array<struct<line_number: long, count: long, branches: array<struct<count: long>>>>, "
    "functions: array<struct<name: string, execution_count: long>>>>"
)


def read_gcov(spark: SparkSession, pattern: str, source_root: str, sources: DataFrame | None = None) -> dict[str, DataFrame]:
    """``lines``, ``functions``, ``branches`` and ``read`` of coverage files (JSON, gzipped where they are named so).

    Sources outside ``source_root``, or not in ``sources`` (path) where that is given, are left out; relative ones are below it.
    ``read`` has (path, status) of each file: ``ok``, or ``damaged`` for one that is cut off or no such JSON, which counts for
    nothing else. No file is four empty tables.
    """
    root = source_root.rstrip("/")
    try:
        found = spark.read.schema(GCOV).option("ignoreCorruptFiles", "true").json(pattern, multiLine=True, mode="PERMISSIVE")
        there = spark.read.format("binaryFile").load(pattern).select("path")
    except AnalysisException as error:
        if not _missing(error):
            raise
        found = spark.createDataFrame([], GCOV).withColumn("_metadata", F.struct(F.lit("").alias("file_path")))
        there = spark.createDataFrame([], "path string")
    found = found.where("files IS NOT NULL")
    plain = lambda c: F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/")
    good = found.select(plain(F.expr("url_decode(replace(_metadata.file_path, '+', '%2B'))")).alias("path")).distinct().withColumn("status", F.lit("ok"))
    read = there.select(plain(F.col("path")).alias("path")).join(good, "path", "left").fillna("damaged", ["status"])
    rows = found.select(F.explode("files").alias("f"))
    path = normal_path(F.when(F.col("f.file").startswith("/"), F.col("f.file")).otherwise(F.concat(F.lit(root + "/"), "f.file")))
    rows = rows.select(path.alias("file"), "f.lines", "f.functions").where(F.col("file").startswith(root + "/"))
    if sources is not None:
        rows = rows.join(sources.select(F.col("path").alias("file")), "file", "left_semi")
    lines = rows.select("file", F.explode("lines").alias("l")).where("l.line_number is not null")
    zero = F.lit(0)
    return {
        "read": read,
        "lines": lines.select("file", F.col("l.line_number").alias("line"), F.coalesce("l.count", zero).alias("count")),
        "branches": lines.select("file", F.col("l.line_number").alias("line"), F.posexplode("l.branches").alias("idx", "b")).select("file", "line", "idx", F.coalesce("b.count", zero).alias("count")),
        "functions": rows.select("file", F.explode("functions").alias("fn")).where("coalesce(fn.name, '') <> ''").select("file", F.col("fn.name").alias("name"), F.coalesce("fn.execution_count", zero).alias("count")),
    }


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of text lines ``key : value``."""
    lines = spark.read.text(path).where(F.contains("value", F.lit(":")))
    parts = F.split("value", r"\s*:\s*", 2)
    return lines.select(F.trim(parts[0]).alias("key"), F.trim(parts[1]).alias("value"))


def corpus_files(listing: DataFrame, queue: bool) -> DataFrame:
    """Paths (path) of a corpus: in a queue only ``id:`` files, else all but those in ``.state`` folders."""
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    return listing.where(name.startswith("id:") if queue else ~F.col("path").rlike(r"(^|/)\.state(/|$)"))


def decode_attachments(attachments: DataFrame, most_bytes: int = 5_000_000) -> DataFrame:
    """``attachments`` with ``content`` (binary) decoded from base64 ``data``; what is too large or does not decode is null."""
    raw = F.try_to_binary("data", F.lit("base64"))
    size = F.octet_length(raw)
    return attachments.withColumn("content", F.when(size <= most_bytes, raw)).withColumn("too_large", F.coalesce(size > most_bytes, F.lit(False)))


# How names and texts of tests tell their bug.
TEST_NAME = r"(?i)(?:^|[^0-9])pr([0-9]{4,})(?:[^0-9]|$)"
TEST_TEXT = r"(?i)\bPR\s+[a-z0-9_+.-]+/([0-9]{4,})"


def linked_tests(files: DataFrame, by_content: bool = False, wanted: DataFrame | None = None) -> DataFrame:
    """(bug_id, path) of test files (path, text) whose name has ``pr`` and a number of four digits or more with no digit around
    both, or, with ``by_content``, whose text names ``PR component/number`` too; restricted to the bugs of ``wanted``."""
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    ids = F.regexp_extract_all(name, F.lit(TEST_NAME), F.lit(1))
    if by_content:
        ids = F.concat(ids, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(TEST_TEXT), F.lit(1)))
    out = files.select(F.explode(F.transform(F.array_distinct(ids), lambda n: n.cast("long"))).alias("bug_id"), "path").distinct()
    return out if wanted is None else out.join(wanted.select("bug_id").distinct(), "bug_id", "left_semi")


def parse_dotenv(text: str) -> dict[str, str]:
    """Assignments of a dotenv file; comments and blank lines count for nothing, a bad line is an error with its number."""
    out = {}
    for number, line in enumerate(text.splitlines(), 1):
        line = line.strip().removeprefix("export ").strip()
        if not line or line.startswith("#"):
            continue
        found = re.fullmatch(r"([A-Za-z_][A-Za-z0-9_]*)\s*=\s*(.*)", line, re.S)
        if not found:
            raise ValueError(f"line {number} is no assignment")
        value = found[2].strip()
        out[found[1]] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"" else value
    return out
