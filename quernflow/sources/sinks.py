"""Writers: JSON lines, single JSON objects, CSV indexes, Markdown tables, keyed tables. The committer makes them atomic."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """JSON lines with sorted keys; ``mode='append'`` adds to what is there. Nulls are kept. Gives the rows written, counted
    while they are."""
    seen = Observation()
    df.select(*sorted(df.columns)).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).option("ignoreNullFields", "false").json(path)
    return int(seen.get["rows"])


def write_csv_index(df: DataFrame, path: str) -> None:
    """An index as one CSV file with a header; lists are joined by semicolons. One task writes it, row by row; what comes
    before keeps its own tasks."""
    flat = [F.array_join(c, ";").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes]
    df.select(*flat).repartition(1).write.mode("overwrite").csv(path, header=True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file: written beside its place and renamed over what is there, in one step where the store has one."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(conf)
    target = files.makeQualified(target)
    part = target.suffix(f".{uuid.uuid4().hex}.tmp")
    stream = files.create(part, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    over = spark.sparkContext._gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(part, target, over)
    except Exception:
        files.delete(part, False)
        raise


def write_json(spark: SparkSession, path: str, value: object) -> None:
    write_text(spark, path, json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True) + "\n")


def markdown_table(headers: Sequence[str], rows: Iterable[Sequence[object]]) -> str:
    line = lambda cells: "| " + " | ".join("" if c is None else str(c) for c in cells) + " |"
    return "\n".join([line(headers), line(["---"] * len(headers)), *map(line, rows)])


def report(title: str, sections: dict[str, DataFrame], most_rows: int = 200) -> str:
    """A Markdown report of small aggregates; a table of more than ``most_rows`` rows is an error, not cut off."""
    out = [f"# {title}"]
    for name, df in sections.items():
        rows = df.take(most_rows + 1)
        if len(rows) > most_rows:
            raise ValueError(f"{name} is too large for a report")
        out += ["", f"## {name}", "", markdown_table(df.columns, rows)]
    return "\n".join(out) + "\n"


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those with their key."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)
