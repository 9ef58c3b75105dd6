"""A log of model answers: a prompt that was answered once is never sent again, by whatever run."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from turnmill.operators.model_apply import apply_model
from turnmill.operators.skew import skew_join
from turnmill.workspace import Workspace

LOG_SCHEMA = "prompt string, response string, error string, attempts int"


class AnswerLog:
    """Append-only answers keyed by model version and prompt, as Parquet below a shared folder.

    Prompts are sent in slices, and each slice is appended as soon as it is answered. A run that is cut keeps all slices
    that were written, and the next one sends only what is left. Failed calls are logged too, but count as unanswered.
    """

    def __init__(self, spark: SparkSession, path: str, version: str):
        if not version:
            raise ValueError("an answer log needs the version of its model")
        self.spark, self.version = spark, version
        self.path = f"{path.rstrip('/')}/{hashlib.sha256(version.encode()).hexdigest()[:16]}"

    def _prompt(self, value: Column, kind: str) -> Column:
        """The name of a prompt: texts as they are, messages as JSON."""
        text = value if kind == "string" else F.to_json(value)
        return F.sha2(F.coalesce(text, F.lit("")), 256)

    def _exists(self) -> bool:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def answers(self, run: str | None = None) -> DataFrame:
        """One row per prompt: its answer, or else the error that it got in ``run``."""
        if not self._exists():
            return self.spark.createDataFrame([], LOG_SCHEMA)
        log = self.spark.read.schema(LOG_SCHEMA + ", run string").option("basePath", self.path).parquet(self.path)
        log = log.filter(F.col("error").isNull() | (F.lit(False) if run is None else F.col("run") == run))
        best = F.min(F.struct(F.col("error").isNotNull().alias("failed"), "response", "error", "attempts")).alias("a")
        return log.groupBy("prompt").agg(best).select("prompt", "a.response", "a.error", "a.attempts")

    def ask(
        self, df: DataFrame, fn: Callable, input_col: str, ws: Workspace, key: str = "id", rows_per_slice: int = 10_000, **options
    ) -> DataFrame:
        """``key, response, error, attempts`` for every row, as ``apply_model`` gives, sending each new prompt once.

        Equal prompts of several rows are sent together. ``options`` are those of ``apply_model``.
        """
        run = uuid.uuid4().hex
        asked = ws.table(df.select(key, input_col, self._prompt(F.col(input_col), df.schema[input_col].dataType.simpleString()).alias("prompt")), "asked")
        new = asked.groupBy("prompt").agg(F.first(input_col).alias(input_col)).join(self.answers().select("prompt"), "prompt", "left_anti")
        new = ws.table(new, "unanswered")
        slices = -(-new.count() // rows_per_slice)
        number = F.pmod(F.conv(F.left("prompt", F.lit(15)), 16, 10).cast("long"), F.lit(max(1, slices)))
        for i in range(slices):
            part = new.filter(number == i).repartition(self.spark.sparkContext.defaultParallelism, "prompt")
            said = apply_model(part, fn, input_col, key="prompt", **options)
            said.write.mode("append").parquet(f"{self.path}/run={run}")
        found = ws.table(self.answers(run), "answers")
        rows = asked.select(key, "prompt")
        return skew_join(rows, found, "prompt", key).select(key, "response", "error", "attempts")
