"""Runs of programs by an outside command in the tasks: limited in time and output, and never twice for one input.

A run is known by the digest of all that it depends on. Programs with one digest run once; a result is kept in a file of its
own, named by the digest, as soon as it is there, so a task that runs again, a driver that starts again and a later evaluation
of the same program find it and run nothing.
"""

from __future__ import annotations

import json
import os
import signal
import subprocess
import tempfile
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernflow.functions import classify as K
from quernflow.functions import text as T
from quernflow.operators.digests import row_json
from quernflow.operators.instantiation import fallback_id, program_files
from quernflow.sources.named_files import _put, _store, qualified

_RESULT = "digest string, returncode int, timed_out boolean, seconds double, stdout string, stderr string, map string, error string"


def _captured(path: str, most: int) -> str:
    """A text of at most ``most`` characters of a file: its head and tail, the middle never read."""
    size = os.path.getsize(path)
    with open(path, "rb") as found:
        if size <= most:
            return found.read().decode(errors="replace")
        half = most // 2
        head = found.read(half).decode(errors="replace")
        found.seek(size - half)
        return f"{head}\n[... {size - 2 * half} bytes left out ...]\n{found.read().decode(errors='replace')}"


def run_command(command: Sequence[str], timeout: float, most: int) -> dict:
    """Run a command in a process group of its own, killed whole when its time is over; what it writes goes to files first."""
    with tempfile.TemporaryDirectory() as place:
        names = [os.path.join(place, n) for n in ("stdout", "stderr")]
        began = time.monotonic()
        with open(names[0], "wb") as out, open(names[1], "wb") as err:
            started = subprocess.Popen(list(command), stdin=subprocess.DEVNULL, stdout=out, stderr=err, start_new_session=True)
            try:
                code, late = started.wait(timeout), False
            except subprocess.TimeoutExpired:
                code, late = None, True
            finally:
                if started.poll() is None:
                    os.killpg(started.pid, signal.SIGKILL)
                    started.wait()
        return {"returncode": code, "timed_out": late, "seconds": round(time.monotonic() - began, 3), "stdout": _captured(names[0], most), "stderr": _captured(names[1], most)}


#: From (row of a run, source, output) to the command that runs it.
Arguments = Callable[[dict, str, str], list[str]]


def showmap(command: Sequence[str], timeout_ms: int) -> Arguments:
    """The command gets language, map, time limit, source and options."""
    return lambda row, source, output: [*command, "--lang", row["language"], "--output", output, "--timeout", str(timeout_ms), source, "--", *row["options"]]


def compiler(prefix: str, target: str) -> Arguments:
    """The target's compiler, by language, makes assembly of the source."""
    return lambda row, source, output: [f"{prefix}/bin/{target}-{'g++' if row['language'] == 'c++' else 'gcc'}", *row["options"], "-S", "-w", "-o", output, source]


def _run_one(arguments: Arguments, row: dict, timeout_ms: int, most: int) -> dict:
    """One program in a folder of the task's own, which goes with it."""
    with tempfile.TemporaryDirectory() as place:
        source, found = os.path.join(place, os.path.basename(row["path"])), os.path.join(place, "output")
        with open(source, "w", encoding="utf-8") as f:
            f.write(row["content"])
        result = run_command(arguments(row, source, found), max(5.0, timeout_ms / 1000 + 10), most)
        text = ""
        if os.path.exists(found):
            with open(found, encoding="utf-8", errors="replace") as f:
                text = f.read()
        return result | {"map": text}


def run_programs(runs: DataFrame, path: str, arguments: Arguments, timeout_ms: int = 5000, most: int = 20_000, tasks: int | None = None) -> DataFrame:
    """(digest, returncode, timed_out, seconds, stdout, stderr, map, error) for runs (digest, path, content, language, options).

    ``error`` says that the command could not be started; such a run is not kept and is tried again by the next call. ``tasks``
    is how many tasks share the runs: a program takes long, so that small tables are spread as well.
    """
    spark = runs.sparkSession
    root = qualified(spark, path)

    def run(found: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, folder = _store(root)
        for batch in found:
            out = []
            for row in batch.to_dict("records"):
                name = f"runs/{row['digest'][:2]}/{row['digest']}.json"
                if store.get_file_info(f"{folder}/{name}").type == fs.FileType.File:
                    with store.open_input_stream(f"{folder}/{name}") as kept:
                        result = json.loads(kept.read())
                else:
                    try:
                        result = _run_one(arguments, row, timeout_ms, most)
                        _put(store, folder, name, json.dumps(result).encode())
                    except OSError as problem:
                        result = {"error": f"{type(problem).__name__}: {problem}"}
                out.append([row["digest"], *[result.get(n) for n in ("returncode", "timed_out", "seconds", "stdout", "stderr", "map", "error")]])
            frame = pd.DataFrame(out, columns=["digest", "returncode", "timed_out", "seconds", "stdout", "stderr", "map", "error"])
            yield frame.astype({"returncode": "Int32", "timed_out": "boolean"})

    spread = runs.select("digest", "path", "content", "language", "options").dropDuplicates(["digest"]).repartition(tasks or 4 * spark.sparkContext.defaultParallelism, "digest")
    return spread.mapInPandas(run, _RESULT)


def map_entries(text: Column) -> Column:
    """The lines of a map that say something."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: F.trim(line) != "")


def evaluate(instantiations: DataFrame, path: str, command: Sequence[str], timeout_ms: int = 5000, least_edges: int = 1, optimization: str = "-O2", most: int = 20_000, tasks: int | None = None) -> DataFrame:
    """A row an instantiation: (instantiation_id, group_uid, candidate_id, language, source_path, source_sha256, compiler_options,
    evaluation_status, digest, edge_map_entries, map_sha256, returncode, timed_out, seconds, stdout, stderr, map, error).

    instantiations (instantiation_id, candidate_id, group_uid, instantiation_status, language, file_name, source_code,
    compiler_options). Those that are not ready, or in a language without a run, are not run. Equal programs share a run. A
    ready one without an id is an error; of programs that repeat an id that with the greatest digest counts. The result should be written before it is used twice.
    """
    c = F.col
    ready = F.coalesce(c("instantiation_status") == "ready", F.lit(False))
    named = F.when(ready & T.blank(c("instantiation_id")), F.raise_error(F.lit("a ready instantiation has no instantiation_id"))).otherwise(fallback_id(c("instantiation_id"), c("candidate_id"), c("group_uid"), c("instantiation_status")))
    rows = instantiations.withColumns({"instantiation_id": named, "language": T.canonical_language(c("language")), "ready": ready})
    files = program_files(rows).select("instantiation_id", "path", "content", c("sha256").alias("source_sha256"))
    spoken = ready & c("language").isin("c", "c++")
    options = T.sanitize_options(F.coalesce("compiler_options", F.array().cast("array<string>")), optimization)
    rows = rows.select("instantiation_id", "group_uid", "candidate_id", "language", "ready", spoken.alias("spoken"), options.alias("options"))
    files = files.groupBy("instantiation_id").agg(F.max(F.struct("source_sha256", "path", "content")).alias("f")).select("instantiation_id", "f.*")
    rows = rows.join(files, "instantiation_id")
    digest = F.sha2(row_json("language", "options", "content", F.element_at(F.split("path", r"\."), -1).alias("suffix"), F.lit(json.dumps([list(command), timeout_ms])).alias("command")), 256)
    rows = rows.withColumn("digest", F.when(c("spoken"), digest))
    results = run_programs(rows.where("spoken"), path, showmap(list(command), timeout_ms), timeout_ms, most, tasks)
    done = rows.join(results, "digest", "left")
    entries = F.size(map_entries(c("map")))
    status = K.evaluation_status(c("ready"), c("language"), F.coalesce("timed_out", F.lit(False)), c("returncode"), entries, least_edges)
    status = F.when(c("error").isNotNull(), "not_run").otherwise(status)
    return done.select(
        "instantiation_id", "group_uid", "candidate_id", "language", F.when(c("spoken"), c("path")).alias("source_path"), F.when(c("spoken"), c("source_sha256")).alias("source_sha256"), c("options").alias("compiler_options"),
        status.alias("evaluation_status"), "digest", entries.alias("edge_map_entries"), F.when(entries > 0, F.sha2("map", 256)).otherwise("").alias("map_sha256"), "returncode", "timed_out", "seconds", "stdout", "stderr", "map", "error",
    )


def edge_maps(evaluations: DataFrame) -> DataFrame:
    """(map_id, edge_id) of the maps of evaluations, a map for each run: what feedback reads."""
    runs = evaluations.where("digest IS NOT NULL").select("digest", "map").dropDuplicates(["digest"])
    edge = F.trim(F.substring_index(F.col("line"), ":", 1))
    return runs.select(F.col("digest").alias("map_id"), F.explode(map_entries(F.col("map"))).alias("line")).select("map_id", edge.alias("edge_id")).where("edge_id <> ''").distinct()


def replay(evaluations: DataFrame, sources: DataFrame, path: str, prefix: str, target: str, timeout_ms: int = 20_000, most: int = 4000, tasks: int | None = None) -> DataFrame:
    """(instantiation_id, candidate_id, language, source_path, status, returncode, stderr) of covered evaluations compiled again by an
    instrumented compiler: ``ok``, ``failed``, ``timeout``, or ``not_run`` where the compiler or the source is not there.

    evaluations (instantiation_id, candidate_id, language, source_path, compiler_options, evaluation_status), sources (path,
    content). Results are kept as for ``evaluate``; assembly is not, the compiler's own counters are what a replay is for.
    """
    c = F.col
    rows = evaluations.where("evaluation_status = 'covered'").select("instantiation_id", "candidate_id", T.canonical_language(c("language")).alias("language"), "source_path", T.replay_options(c("compiler_options")).alias("options"))
    texts = sources.select(c("path").alias("source_path"), c("content").cast("string").alias("content"))
    rows = rows.join(texts, "source_path", "left").withColumn("path", F.when(c("language") == "c++", "replay.cc").otherwise("replay.c"))
    policy = json.dumps([prefix, target, timeout_ms])
    rows = rows.withColumn("digest", F.when(c("content").isNotNull(), F.sha2(row_json("language", "options", "content", F.lit(policy).alias("policy")), 256)))
    results = run_programs(rows.where("digest IS NOT NULL"), path, compiler(prefix, target), timeout_ms, most, tasks)
    status = F.when(c("error").isNotNull() | c("timed_out").isNull(), "not_run").when(c("timed_out"), "timeout").when(c("returncode") == 0, "ok").otherwise("failed")
    return rows.join(results, "digest", "left").select("instantiation_id", "candidate_id", "language", "source_path", status.alias("status"), "returncode", "stderr")
