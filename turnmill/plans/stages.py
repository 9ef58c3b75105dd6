"""Stage tables that are reused when neither input nor parameters changed."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from turnmill.workspace import checkpoint_root, write_observed


def source_fingerprint(df: DataFrame) -> str:
    """Hash of the names, sizes and modification times of the files behind a scan.

    Aggregated to one row: the listing never reaches the driver.
    """
    files = df.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    row = files.distinct().agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("*")).alias("x"),
        F.sum(F.xxhash64("*").cast("decimal(38,0)")).alias("s"),
    ).first()
    return hashlib.sha256(str(tuple(row)).encode()).hexdigest()[:16]


def content_fingerprint(df: DataFrame) -> str:
    """Hash of a table's rows as a multiset, and of its columns' names and types.

    Equal rows in other files, another order or another number of partitions give the same; a changed, added or
    repeated row gives another. One scan that combines to one row; maps and variants are hashed as JSON.
    """
    kinds = [(f.name, f.dataType.simpleString()) for f in df.schema]
    cells = [F.to_json(F.struct(F.col(f"`{n}`"))) if "map<" in k or "variant" in k else F.col(f"`{n}`") for n, k in kinds]
    # Nulls leave a hash as it was, so each cell also tells whether it is null.
    cells += [F.isnull(c) for c in cells]
    hashes = [F.xxhash64(F.lit(seed), *cells) for seed in (1, 2)]
    row = df.agg(
        F.count("*").alias("n"),
        *[F.sum(h.cast("decimal(38,0)")).alias(f"s{i}") for i, h in enumerate(hashes)],
        *[F.bit_xor(h).alias(f"x{i}") for i, h in enumerate(hashes)],
    ).first()
    return hashlib.sha256(json.dumps([kinds, *[str(v) for v in row]]).encode()).hexdigest()[:16]


@dataclass
class StageStore:
    """Runs named stages, each stored as Parquet under its fingerprint."""

    spark: SparkSession
    root: str | None = None
    force: bool = False
    ran: list[str] = field(default_factory=list)
    reused: list[str] = field(default_factory=list)
    metrics: dict[str, dict] = field(default_factory=dict)

    def __post_init__(self):
        self.root = (self.root or f"{checkpoint_root(self.spark)}/turnmill-stages").rstrip("/")

    def _exists(self, path: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        done = jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
        fs = done.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return fs.exists(done)

    def run(
        self, name: str, upstream: str, params: dict, build: Callable[[], DataFrame], metrics: Sequence[Column] = ()
    ) -> tuple[DataFrame, str]:
        """The stage's table and its fingerprint; ``build`` runs only when needed.

        ``upstream`` is the fingerprint of what the stage reads, so a changed input
        reaches every later stage. ``metrics`` are aggregates observed as the table is written and kept
        beside it; ``self.metrics[name]`` has their values.
        """
        body = json.dumps([name, upstream, params], sort_keys=True, default=str)
        mark = hashlib.sha256(body.encode()).hexdigest()[:16]
        path = f"{self.root}/{name}-{mark}"
        values: dict = {}
        if self.force or not self._exists(path):
            if metrics:
                values = write_observed(build(), path, metrics)
                kept = self.spark.createDataFrame([(json.dumps(values),)], "value string").coalesce(1)
                kept.write.mode("overwrite").text(f"{path}-metrics")
            else:
                build().write.mode("overwrite").parquet(path)
            self.ran.append(name)
        else:
            self.reused.append(name)
            if metrics and self._exists(f"{path}-metrics"):
                values = json.loads(self.spark.read.text(f"{path}-metrics").first()["value"])
        table = self.spark.read.parquet(path)
        if metrics:
            self.metrics[name] = values or table.agg(*metrics).first().asDict()
        return table, mark
