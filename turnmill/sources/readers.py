"""Readers for the accepted file formats.

Every reader keeps records as raw JSON text (or typed columns) plus ``_ordinal``, the
0-based position of the record in its input, counted per file block.
"""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from turnmill.functions.json import is_single, wrapped
from turnmill.functions.text import blank, strip
from turnmill.operators.ordering import block_positions

# File suffix to format.
FORMATS = {".jsonl": "jsonl", ".json": "json", ".csv": "csv", ".txt": "text", ".md": "text"}

_BLOCK = ["_file", "_start"]


def spread(df: DataFrame) -> DataFrame:
    """Give every core work when a scan has fewer splits than there are cores.

    One small or unsplittable file is read by one task, and so is everything up to the
    next shuffle. A scan with enough splits is returned unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    return df if splits >= cores else df.repartition(cores)


def format_of(path: Column) -> Column:
    """The format that a file's suffix names, null for a suffix without a reader."""
    suffix = F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)$", 1))
    return F.element_at(F.create_map(*[F.lit(x) for pair in FORMATS.items() for x in pair]), F.nullif(suffix, F.lit("")))


def detect_format(path: str) -> str:
    fmt = FORMATS.get(PurePosixPath(path).suffix.lower())
    if fmt is None:
        raise ValueError(f"no reader for {path}")
    return fmt


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(
        strip(F.col("value")).alias("raw"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
    )


def read_jsonl(spark: SparkSession, path: str, ordinals: bool = True) -> DataFrame:
    """Valid JSON lines; blank and malformed lines take no ordinal."""
    rows = _lines(spark, path).filter(is_single(wrapped(F.col("raw"))))
    if not ordinals:
        return rows.select("raw")
    rows = rows.withColumn("_seq", F.monotonically_increasing_id())
    return block_positions(rows, _BLOCK, {"_seq": "_ordinal"}).select("raw", "_ordinal")


def malformed_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """The non-blank lines :func:`read_jsonl` drops, for the warning count."""
    return _lines(spark, path).filter(
        (F.col("raw") != "") & ~is_single(wrapped(F.col("raw")))
    ).select("raw", "_file")


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    """The elements of a top-level JSON array, one file per task.

    A JSON array cannot be cut at byte offsets, so a file must fit in one task; write
    large inputs as JSON lines. Anything but an array at the top is an error.
    """
    files = spark.read.text(path, wholetext=True).select(
        "value", F.col("_metadata.file_path").alias("_file")
    )
    is_array = F.startswith(strip(F.col("value")), F.lit("["))
    items = F.from_json("value", "array<string>")
    checked = F.when(is_array & items.isNotNull(), items).otherwise(
        F.raise_error(F.concat("_file", F.lit(": expected a JSON array at the top"))).cast("array<string>")
    )
    rows = files.select("_file", F.posexplode(checked).alias("_pos", "raw"))
    # Positions are per file; earlier files come first.
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    length = F.coalesce(F.json_array_length("value"), F.lit(0))
    offsets = files.select("_file", length.alias("_n")).select(
        "_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")
    )
    placed = rows.join(offsets, "_file")
    return placed.select("raw", (F.col("_pos") + F.col("_off")).alias("_ordinal"))


def read_csv(spark: SparkSession, path: str, quoted_newlines: bool = True) -> DataFrame:
    """All columns as strings under their header names; an empty cell is ''.

    A file with newlines inside quotes is read by one task; pass
    ``quoted_newlines=False`` for inputs without them to split large files.
    """
    rows = spark.read.csv(
        path, header=True, inferSchema=False, multiLine=quoted_newlines, escape='"'
    )
    names = rows.columns
    meta = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start")]
    cells = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in names]
    rows = rows.select(*cells, *meta).withColumn("_seq", F.monotonically_increasing_id())
    return block_positions(rows, _BLOCK, {"_seq": "_ordinal"}).select(
        *[F.col(f"`{c}`") for c in names], "_ordinal"
    )


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank stripped lines with their 1-based line number and record ordinal."""
    rows = _lines(spark, path).withColumn("_line_seq", F.monotonically_increasing_id())
    # Blank lines are numbered but take no ordinal, so two sequences are kept.
    kept = rows.filter(~blank(F.col("raw"))).withColumn("_seq", F.monotonically_increasing_id())
    numbered = _number_lines(rows, kept)
    return numbered.select(F.col("raw").alias("text"), "_line", "_ordinal")


def _number_lines(all_rows: DataFrame, kept: DataFrame) -> DataFrame:
    """Number kept rows among themselves, and among all rows they came from."""
    blocks = all_rows.groupBy(*_BLOCK).agg(
        F.count("*").alias("_n"), F.min("_line_seq").alias("_min")
    )
    # Line numbers restart in each file.
    before = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        F.xxhash64(*_BLOCK).alias("_line_block"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_min") + 1).alias("_line_off"),
    )
    return (
        block_positions(kept, _BLOCK, {"_seq": "_ordinal"})
        .withColumn("_line_block", F.xxhash64(*_BLOCK))
        .join(starts, "_line_block")
        .withColumn("_line", F.col("_line_seq") + F.col("_line_off"))
    )


def explode_lines(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """The text-line scan over a column of whole texts: line number and content."""
    return (
        df.select(id_col, F.posexplode(F.split(F.col(text), r"\r\n|[\r\n]")).alias("_pos", "line"))
        .select(id_col, (F.col("_pos") + 1).cast("long").alias("line_no"), strip(F.col("line")).alias("text"))
        .filter(F.col("text") != "")
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Read any accepted format, chosen by suffix."""
    reader = {
        "jsonl": read_jsonl,
        "json": read_json_array,
        "csv": read_csv,
        "text": read_text_lines,
    }[detect_format(path)]
    return reader(spark, path)


def load_eval_set(spark: SparkSession, dataset: str | list[dict]) -> DataFrame:
    """All rows of an evaluation set, as raw JSON with ordinals; ``head_rows`` takes some.

    ``dataset`` is an inline list, or the path of a ``.json`` or ``.jsonl`` file.
    """
    if isinstance(dataset, list):
        import json

        rows = [(json.dumps(row), i) for i, row in enumerate(dataset)]
        data = spark.createDataFrame(rows, "raw string, _ordinal long")
    elif dataset.endswith(".jsonl"):
        data = read_jsonl(spark, dataset)
    elif dataset.endswith(".json"):
        data = read_json_array(spark, dataset)
    else:
        raise ValueError(f"no reader for dataset {dataset}")
    return data


def discover_specs(
    listing: DataFrame, slug: str, explicit: Sequence[str] = (), path: str = "path"
) -> DataFrame:
    """Which spec files apply to a client, ``path, priority, position``: explicit, then ``global-*``, then its own.

    ``listing`` has one row per file. A file is returned once, under the first rule that selects it; paths are
    compared without ``.``, ``..`` and doubled slashes. Names starting with EXAMPLE are skipped unless they are
    explicit. ``position`` is the place in ``explicit``, null for other files.
    """
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    usable = ~F.startswith(F.upper(name), F.lit("EXAMPLE")) & name.endswith(".yml")
    own = F.lit(f"client-{slug}-")
    rule = (
        F.when(usable & F.startswith(name, F.lit("global-")), F.lit(1))
        .when(usable & F.startswith(name, own), F.lit(2))
    )
    found = listing.select(F.col(path).alias("path"), rule.alias("priority"), F.lit(None).cast("int").alias("position"))
    if explicit:
        spark = listing.sparkSession
        given = spark.createDataFrame([(p, 0, i) for i, p in enumerate(explicit)], "path string, priority int, position int")
        found = found.unionByName(given)
    return (
        found.filter(F.col("priority").isNotNull())
        .groupBy(resolved(F.col("path")).alias("path"))
        .agg(F.min("priority").alias("priority"), F.min("position").alias("position"))
    )


def resolved(path: Column) -> Column:
    """A path without ``.``, ``..`` and doubled slashes; ``..`` above the start stays, and is dropped at a root."""
    rooted = F.startswith(path, F.lit("/"))

    def step(kept: Column, part: Column) -> Column:
        last = F.when(F.size(kept) > 0, F.element_at(kept, -1))
        up = F.when(F.coalesce(last != "..", F.lit(False)), F.slice(kept, F.lit(1), F.size(kept) - 1)).when(rooted, kept)
        return (
            F.when(part.isin("", "."), kept)
            .when(part == "..", F.coalesce(up, F.concat(kept, F.array(part))))
            .otherwise(F.concat(kept, F.array(part)))
        )

    parts = F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step)
    return F.concat(F.when(rooted, F.lit("/")).otherwise(F.lit("")), F.array_join(parts, "/"))
