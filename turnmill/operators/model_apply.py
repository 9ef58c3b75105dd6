"""Calling a user's model on every row, in bounded batches on the executors."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from turnmill.functions.text import blank
from turnmill.workspace import Workspace

# In-flight calls per task and retries after a failed call.
CONCURRENCY = 4
RETRIES = 2


def _call(fn: Callable, value, retries: int, backoff: float):
    for attempt in range(1, retries + 2):
        try:
            return fn(value), None, attempt
        except Exception as err:  # noqa: BLE001 - any model failure is data
            if attempt > retries:
                return None, str(err), attempt
            time.sleep(backoff * 2 ** (attempt - 1))


def apply_model(
    df: DataFrame,
    fn: Callable,
    input_col: str,
    key: str = "id",
    batch_size: int = 16,
    retries: int = RETRIES,
    concurrency: int = CONCURRENCY,
    backoff: float = 1.0,
) -> DataFrame:
    """``key, response, error, attempts`` of ``fn(value)`` for every row.

    ``fn`` takes the input value (a string, or a list of message dicts) and returns a
    string. A task has ``concurrency`` calls in flight out of a window of ``batch_size`` rows,
    which moves on with each answer; a call is retried with doubling pauses and a row that keeps failing carries its
    error, so each stage can apply its own default.
    """
    key_type = df.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField(key, key_type),
            T.StructField("response", T.StringType()),
            T.StructField("error", T.StringType()),
            T.StructField("attempts", T.IntegerType()),
        ]
    )

    def table(done):
        keys, answers = zip(*done)
        response, error, attempts = zip(*answers)
        attempts = pd.array(attempts, dtype="int32")
        return pd.DataFrame({key: list(keys), "response": list(response), "error": list(error), "attempts": attempts})

    def run(frames):
        waiting, done = deque(), []
        with ThreadPoolExecutor(concurrency) as pool:
            for frame in frames:
                for name, value in zip(frame[key], frame[input_col]):
                    waiting.append((name, pool.submit(_call, fn, value, retries, backoff)))
                    # One slow call holds up the rows behind it, not the calls beside it.
                    if len(waiting) >= batch_size:
                        name, call = waiting.popleft()
                        done.append((name, call.result()))
                    if len(done) >= batch_size:
                        yield table(done)
                        done = []
            done += [(name, call.result()) for name, call in waiting]
        if done:
            yield table(done)

    return df.select(key, input_col).mapInPandas(run, schema)


def redact_with_model(
    df: DataFrame, fn: Callable, ws: Workspace, roles=("user", "assistant"), key: str = "id", **options
) -> tuple[DataFrame, DataFrame]:
    """Redact messages through a model: ``(redacted rows, quarantined keys)``.

    Fails closed: a row with any failed message is quarantined, never passed on
    with its original text. Blank messages are not sent. Answers are written once, so
    both results come from the same calls.
    """
    turns = df.select(key, F.posexplode("messages").alias("pos", "m")).select(
        F.concat_ws("|", key, "pos").alias("turn_id"), key, "pos", "m.role", "m.content"
    )
    wanted = F.col("role").isin(*roles) & ~blank(F.col("content"))
    answers = apply_model(turns.filter(wanted), fn, "content", key="turn_id", **options)
    joined = turns.join(ws.table(answers, "redactions"), "turn_id", "left")
    bad = joined.filter(F.col("error").isNotNull()).select(key).distinct()
    turn = F.struct("pos", "role", F.coalesce("response", "content").alias("content"))
    folded = joined.groupBy(key).agg(F.array_sort(F.collect_list(turn)).alias("_turns"))
    redacted = F.transform(
        "_turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))
    )
    out = (
        df.join(folded, key, "left")
        .withColumn("messages", F.coalesce(redacted, F.col("messages")))
        .drop("_turns")
        .join(bad, key, "left_anti")
    )
    if "text" in df.columns:
        out = out.withColumn("text", F.lit(None).cast("string"))
    return out, bad
