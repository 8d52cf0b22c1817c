"""A sink of named files: rows (path, content) become files below a folder, written by the tasks, with a manifest of them.

A task writes each file beside its place and renames it into it, so a file is whole or not there, and an attempt that runs
again writes the same bytes under the same names. It lists what it wrote in a part of the manifest that belongs to its
attempt alone. The commit is one small file naming the parts of the attempts that counted; parts that no commit names, of
failed or doubled attempts, count for nothing, and an aborted write takes its parts away. The driver sees a name and two counts
for each task, never the list of files.

Files that an earlier commit wrote and a later one does not name stay, as in any appended folder: ``manifest`` gives the
latest entry of each path, ``clean`` removes what no commit names.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType

from quernflow.scratch import materialize

FORMAT = "named_files"
META = "_manifest"
EMPTY = hashlib.sha256(b"").hexdigest()
_ENTRY = "path string, bytes long, sha256 string"


def _store(root: str):
    """A file system and the folder's path in it; ``root`` is qualified."""
    return fs.FileSystem.from_uri(quote(root, safe=":/@"))


def safe(path: str | None) -> bool:
    """Whether a path stays below the folder: relative, without empty, ``.`` or ``..`` parts, and not the manifest's."""
    parts = (path or "").split("/")
    return all(p not in ("", ".", "..") for p in parts) and parts[0] != META and "\x00" not in (path or "")


def _put(store, folder: str, path: str, data: bytes) -> None:
    """Write a file beside its place and rename it into it."""
    target = f"{folder}/{path}"
    part = f"{target}.{uuid.uuid4().hex}.part"
    if "/" in path:
        store.create_dir(target.rpartition("/")[0], recursive=True)
    with store.open_output_stream(part) as out:
        out.write(data)
    store.move(part, target)


@dataclass
class Wrote(WriterCommitMessage):
    part: str
    files: int
    bytes: int


class _Writer(DataSourceWriter):
    def __init__(self, root: str, job: str):
        self.root, self.job = root, job

    def write(self, rows: Iterator[Row]) -> Wrote:
        store, folder = _store(self.root)
        context = TaskContext.get()
        part = f"{self.job}/{context.partitionId()}-{context.taskAttemptId()}.jsonl"
        store.create_dir(f"{folder}/{META}/{self.job}", recursive=True)
        files = total = 0
        with store.open_output_stream(f"{folder}/{META}/{part}") as listed:
            for path, content in rows:
                if not safe(path):
                    raise ValueError(f"not a path below the folder: {path!r}")
                data = content.encode() if isinstance(content, str) else bytes(content or b"")
                _put(store, folder, path, data)
                listed.write(json.dumps({"path": path, "bytes": len(data), "sha256": hashlib.sha256(data).hexdigest()}).encode() + b"\n")
                files, total = files + 1, total + len(data)
        return Wrote(part, files, total)

    def commit(self, messages: list[Wrote | None]) -> None:
        store, folder = _store(self.root)
        done = [m for m in messages if m is not None]
        order = 1 + max((int(n.rpartition("/")[2].split("-")[0]) for n in _commits(store, folder)), default=0)
        entry = {"order": order, "parts": [m.part for m in done if m.files], "files": sum(m.files for m in done), "bytes": sum(m.bytes for m in done)}
        store.create_dir(f"{folder}/{META}", recursive=True)
        _put(store, f"{folder}/{META}", f"{order:08d}-{self.job}.commit", json.dumps(entry).encode())

    def abort(self, messages: list[Wrote | None]) -> None:
        store, folder = _store(self.root)
        if store.get_file_info(f"{folder}/{META}/{self.job}").type.name == "Directory":
            store.delete_dir(f"{folder}/{META}/{self.job}")


def _commits(store, folder: str) -> list[str]:
    found = store.get_file_info(fs.FileSelector(f"{folder}/{META}", allow_not_found=True))
    return sorted(f.path for f in found if f.path.endswith(".commit"))


class NamedFiles(DataSource):
    """``df.write.format("named_files").mode("append").save(root)`` for rows (path string, content string or binary)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite or [f.name for f in schema] != ["path", "content"] or schema[1].dataType.typeName() not in ("string", "binary"):
            raise ValueError("named files take rows (path, content), and are appended to a folder")
        return _Writer(self.options["path"], uuid.uuid4().hex)


def qualified(spark: SparkSession, root: str) -> str:
    """The folder with its store, as Spark's default has it, so that tasks mean the same place."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root.rstrip("/"))
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return found.replace("file:/", "file:///", 1) if found.startswith("file:/") and not found.startswith("file://") else found


def write_files(files: DataFrame, root: str) -> DataFrame:
    """Write rows (path, content) as files and commit them; what was written, as ``manifest`` gives it.

    A null content is an empty file. Rows that repeat a path with the same content are one file; a path with several contents
    or one outside the folder is an error before anything is written. Other columns are not looked at.
    """
    spark = files.sparkSession
    rows = materialize(files.select("path", "content"), "files")
    content = F.coalesce(F.col("content").cast("binary"), F.lit(b""))
    kinds = rows.groupBy("path").agg(F.count("*").alias("rows"), F.min(F.sha2(content, 256)).alias("a"), F.max(F.sha2(content, 256)).alias("b"))
    wrong = kinds.where("a <> b").first()
    if wrong is not None:
        raise ValueError(f"several contents for {wrong['path']!r}")
    odd = kinds.where("path IS NULL OR path = '' OR startswith(path, '/') OR endswith(path, '/')").first()
    if odd is not None:
        raise ValueError(f"not a path below the folder: {odd['path']!r}")
    if not kinds.where("rows > 1").isEmpty():
        rows = rows.dropDuplicates(["path"])
    root = qualified(spark, root)
    spark.dataSource.register(NamedFiles)
    rows.write.format(FORMAT).mode("append").save(root)
    return manifest(spark, root)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """(path, bytes, sha256) of the committed files of a folder, of several commits of a path the last; none: an empty table."""
    root = qualified(spark, root)
    store, folder = _store(root)
    parts = []
    for name in _commits(store, folder):  # one small file a commit; they name one part a task
        with store.open_input_stream(name) as found:
            entry = json.loads(found.read())
        parts += [(entry["order"], f"{META}/{p}") for p in entry["parts"]]
    if not parts:
        return spark.createDataFrame([], _ENTRY)
    order = spark.createDataFrame(parts, "at long, part string")
    rows = spark.read.schema(_ENTRY).json([f"{root}/{p}" for _, p in parts])
    rows = rows.withColumn("part", F.concat_ws("/", F.lit(META), F.element_at(F.split("_metadata.file_path", "/"), -2), F.col("_metadata.file_name")))
    rows = rows.join(order, "part")
    return rows.groupBy("path").agg(F.max_by(F.struct("bytes", "sha256"), "at").alias("f")).select("path", "f.*")


def folder_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, content) of all files below a folder, manifests aside; paths are relative to it. Spark's reader has no rows
    for empty files."""
    root = qualified(spark, root)
    home = f"{root.split('://', 1)[-1]}/"
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    path = F.substr("path", F.locate(home, "path") + F.lit(len(home)))
    return found.select(path.alias("path"), "content").where(~F.col("path").startswith(f"{META}/"))


def verify(spark: SparkSession, root: str) -> DataFrame:
    """(path, fault) of committed files that are ``missing`` or ``changed``, and files that are ``unlisted``; empty if all is well.

    Empty files that nothing lists are not seen."""
    root = qualified(spark, root)
    found = folder_files(spark, root).select("path", F.sha2("content", 256).alias("now"))
    both = manifest(spark, root).select("path", F.col("sha256").alias("then")).join(found, "path", "full")
    fault = F.when(F.col("now").isNull(), "missing").when(F.col("then").isNull(), "unlisted").when(F.col("now") != F.col("then"), "changed")
    faults = both.select("path", fault.alias("fault"), (F.col("then") == EMPTY).alias("empty")).where("fault IS NOT NULL")

    def unseen(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Without the empty files that are there: the scan passes over those."""
        store, folder = _store(root)
        for batch in rows:
            there = [bool(e) and f == "missing" and store.get_file_info(f"{folder}/{p}").size == 0 for p, f, e in zip(*(batch.column(c).to_pylist() for c in ("path", "fault", "empty")), strict=True)]
            yield batch.filter(pa.array([not t for t in there], pa.bool_())).select(["path", "fault"])

    return faults.mapInArrow(unseen, "path string, fault string")


def clean(spark: SparkSession, root: str) -> int:
    """Remove files that no commit names, and parts of the manifest that none counts; how many files went."""
    root = qualified(spark, root)
    gone = verify(spark, root).where("fault = 'unlisted'").select("path")

    def remove(rows):
        store, folder = _store(root)
        n = 0
        for batch in rows:
            for path in batch.column("path").to_pylist():
                if store.get_file_info(f"{folder}/{path}").type.name != "NotFound":  # an attempt that runs again finds it gone
                    store.delete_file(f"{folder}/{path}")
                n += 1
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    removed = materialize(gone, "unlisted").mapInArrow(remove, "n long").agg(F.sum("n")).first()[0] or 0
    store, folder = _store(root)
    jobs = {n.rpartition("/")[2].split("-")[1].removesuffix(".commit") for n in _commits(store, folder)}
    for f in store.get_file_info(fs.FileSelector(f"{folder}/{META}", allow_not_found=True)):
        if f.type == fs.FileType.Directory and f.base_name not in jobs:
            store.delete_dir(f.path)
    return int(removed)
