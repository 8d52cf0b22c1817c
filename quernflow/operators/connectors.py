"""Model calls and program runs behind plain callables; recorded answers make every job run offline."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernflow.functions.text import model_content, parse_json_content


def call_model(prompts: DataFrame, caller: Callable[[str], str], retries: int = 2, delay: float = 0.0) -> DataFrame:
    """(id, response, error) for prompts (id, prompt): ``caller`` gets a prompt and gives the raw response.

    A failed call is tried again and then leaves its message in ``error``; secrets never reach the table. The result should
    be written before it is used twice, or the model is asked twice.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, prompt in zip(batch["id"], batch["prompt"], strict=True):
                error, answer = None, None
                for attempt in range(retries + 1):
                    try:
                        answer, error = caller(prompt), None
                        break
                    except Exception as problem:  # noqa: BLE001  whatever the caller raises becomes the row's error
                        error = f"{type(problem).__name__}: {problem}"
                        time.sleep(delay * (attempt + 1))
                rows.append((key, answer, error))
            yield pd.DataFrame(rows, columns=["id", "response", "error"])

    return prompts.select("id", "prompt").mapInPandas(run, "id string, response string, error string")


def replay(prompts: DataFrame, recorded: DataFrame) -> DataFrame:
    """The same from recorded responses (id, response); a missing one is an error in its row."""
    out = prompts.select("id").join(recorded.select("id", "response"), "id", "left")
    return out.withColumn("error", F.when(F.col("response").isNull(), F.lit("no recorded response")))


def parsed(responses: DataFrame, greedy: bool = True, also: Sequence[str] = ()) -> DataFrame:
    """(id, json, status): ``ok``, ``parse_error`` or ``api_error``; the columns ``also`` stay."""
    body = parse_json_content(model_content(F.col("response")), greedy)
    out = responses.withColumn("json", F.when(F.col("error").isNull(), body))
    return out.select("id", *also, "json", F.when(F.col("error").isNotNull(), "api_error").when(F.col("json").isNull(), "parse_error").otherwise("ok").alias("status"))


def token_usage(responses: DataFrame) -> DataFrame:
    """One row of summed token counts; what is no number counts nothing."""
    names = ("prompt_tokens", "completion_tokens", "total_tokens")
    return responses.agg(*[F.coalesce(F.sum(F.expr(f"try_cast(get_json_object(response, '$.usage.{n}') as bigint)")), F.lit(0)).alias(n) for n in names])


def pending(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of ``wanted`` without a sound result in ``done`` (key, violations)."""
    return wanted.join(done.where(F.size("violations") == 0).select(key), key, "left_anti")


def gate(df: DataFrame, message: str) -> None:
    """Raise when any row is left: the form of all checks that stop a job."""
    row = df.first()
    if row is not None:
        raise ValueError(f"{message}: {row.asDict()}")
