"""Rounds of asking a model: what is answered wrongly is asked again with the reason, up to a number of rounds.

The state is in a folder that the cluster shares. A task keeps each answer in a file of its own as soon as it has it, named by
the row and the round; a task that runs again, or a driver that starts again, finds it there and does not ask twice. A round's
answers are then a table, and what follows from them (verdicts, next prompts) is computed from tables alone.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernflow.functions.text import redact_secrets
from quernflow.operators.connectors import parsed
from quernflow.sources.named_files import _put, _store, qualified

_ANSWER = "id string, response string, error string"
#: The request to mend an answer, around the reason.
AGAIN = ("The previous response was invalid: ", ". Regenerate the entire JSON object and satisfy every contract constraint.")


def _kept(root: str, number: int, caller: Callable[[str], str]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def one(store, folder: str, key: str, prompt: str) -> tuple[str | None, str | None]:
        mark = hashlib.sha256(json.dumps([key, prompt]).encode()).hexdigest()
        name = f"round-{number}/{mark[:2]}/{mark}.json"
        if store.get_file_info(f"{folder}/{name}").type == fs.FileType.File:
            with store.open_input_stream(f"{folder}/{name}") as found:
                return json.loads(found.read())["response"], None
        try:
            answer = caller(prompt)
        except Exception as problem:  # noqa: BLE001  whatever the caller raises becomes the row's error
            return None, f"{type(problem).__name__}: {problem}"
        _put(store, folder, name, json.dumps({"id": key, "response": answer}).encode())
        return answer, None

    def run(found: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, folder = _store(root)
        for batch in found:
            rows = [(key, *one(store, folder, key, prompt)) for key, prompt in zip(batch["id"], batch["prompt"], strict=True)]
            yield pd.DataFrame(rows, columns=["id", "response", "error"])

    return run


class Rounds:
    """A conversation with a model below a folder.

    caller: gets a prompt (JSON messages) and gives the raw response. check: gets (id, json) and gives (id, problem) for answers
    that break the contract; rows without a problem, or that it leaves out, are sound.
    """

    def __init__(self, spark: SparkSession, path: str, caller: Callable[[str], str], check: Callable[[DataFrame], DataFrame], rounds: int = 3):
        self.spark, self.path, self.caller, self.check, self.rounds = spark, qualified(spark, path), caller, check, rounds
        self._hadoop = spark._jvm.org.apache.hadoop.fs.Path

    def _table(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A table of the state: as it was written, or made and written now."""
        place = f"{self.path}/{name}"
        files = self._hadoop(place).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(self._hadoop(f"{place}/_SUCCESS")):
            make().write.mode("overwrite").parquet(place)
        return self.spark.read.parquet(place)

    def run(self, prompts: DataFrame) -> DataFrame:
        """(id, status, json, problem, rounds) for prompts (id, prompt): ``ok``, or how the last round failed.

        ``parse_error`` and ``validation_error`` are asked again with the reason added to the messages, ``api_error`` as it was.
        The folder belongs to one set of prompts; with a finished state nothing is asked. A repeated id is an error; a null
        prompt is an ``api_error`` that is not asked.
        """
        if not prompts.groupBy("id").count().where("count > 1 OR id IS NULL").isEmpty():
            raise ValueError("an id repeats or is missing")
        todo = self._table("prompts-1", lambda: prompts.select(F.col("id").cast("string").alias("id"), "prompt"))
        settled: list[DataFrame] = []
        for number in range(1, self.rounds + 1):
            asked = todo.where("prompt IS NOT NULL")
            answers = self._table(f"answers-{number}", lambda n=number, a=asked: a.mapInPandas(_kept(f"{self.path}/kept", n, self.caller), _ANSWER))
            verdicts = self._table(f"verdicts-{number}", lambda t=todo, a=answers: self._judged(t, a))
            last = number == self.rounds
            settled.append((verdicts if last else verdicts.where("status = 'ok'")).withColumn("rounds", F.lit(number)))
            if last or verdicts.where("status <> 'ok'").isEmpty():
                break
            todo = self._table(f"prompts-{number + 1}", lambda t=todo, v=verdicts: self._mended(t, v))
        out = settled[0]
        for more in settled[1:]:
            out = out.unionByName(more)
        return out

    def _judged(self, todo: DataFrame, answers: DataFrame) -> DataFrame:
        read = parsed(answers).join(answers.select("id", "error"), "id")
        wrong = self.check(read.where("status = 'ok'").select("id", "json")).where("problem IS NOT NULL").groupBy("id").agg(F.min("problem").alias("broken"))
        rows = todo.select("id").join(read, "id", "left").join(wrong, "id", "left")
        status = F.when(F.col("status").isNull(), "api_error").when((F.col("status") == "ok") & F.col("broken").isNotNull(), "validation_error").otherwise(F.col("status"))
        problem = F.when(status == "api_error", F.coalesce("error", F.lit("no prompt"))).when(status == "parse_error", "the answer is not a JSON object").otherwise(F.col("broken"))
        return rows.select("id", status.alias("status"), F.when(status == "ok", F.col("json")).alias("json"), F.left(redact_secrets(problem), F.lit(1000)).alias("problem"))

    def _mended(self, todo: DataFrame, verdicts: DataFrame) -> DataFrame:
        rows = todo.join(verdicts.where("status <> 'ok'").select("id", "status", "problem"), "id")
        more = F.to_json(F.struct(F.lit("user").alias("role"), F.concat(F.lit(AGAIN[0]), "problem", F.lit(AGAIN[1])).alias("content")))
        longer = F.concat(F.regexp_replace("prompt", r"\]\s*$", ","), more, F.lit("]"))
        return rows.select("id", F.when(F.col("status") == "api_error", F.col("prompt")).otherwise(longer).alias("prompt"))
