"""JSON arrays and quoted CSV read by many tasks, however large a single file is.

Neither format says at a byte offset whether a quote is open or how deep brackets are nested. So files are scanned
twice. Spark's text reader cuts them into pieces at a separator (a comma, a line break) and into blocks at byte
offsets. The first scan sums up each block: how it changes an open quote, and the depth for either start. One row per
block then tells where every block begins, and the second scan joins pieces to whole records. Records that a block
border cuts, two parts a block, are put together by a small shuffle.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from turnmill.functions.text import strip
from turnmill.workspace import Workspace

_OPENS, _SHUTS = np.zeros(256, np.int8), np.zeros(256, np.int8)
_OPENS[[ord("["), ord("{")]] = 1
_SHUTS[[ord("]"), ord("}")]] = 1
STATES = "_file string, _start long, end0 int, depth0 long, end1 int, depth1 long"
PARTS = "_file string, _start long, local long, whole boolean, text string"


def _pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    return spark.read.option("lineSep", separator).text(path).select(
        F.col("value"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start")
    )


def _transitions(column: pa.Array, nested: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per piece: whether it flips an open quote, and its change of depth if it begins outside or inside of one."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    buf = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    at = at - at[0]

    def sums(values: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
        return total[at[1:]] - total[at[:-1]]

    quote = buf == ord('"')
    if nested:
        # A quote behind an odd run of backslashes is none; runs end at the start of a piece.
        place = np.flatnonzero(quote)
        other = np.maximum.accumulate(np.where(buf != ord("\\"), np.arange(len(buf)), -1))
        start = at[np.searchsorted(at, place, "right") - 1]
        run = np.where(place > start, place - 1 - np.maximum(other[np.maximum(place - 1, 0)], start - 1), 0)
        quote = quote.copy()
        quote[place[run % 2 == 1]] = False
    flips = sums(quote) & 1
    if not nested:
        return flips, np.zeros_like(flips), np.zeros_like(flips)
    before = np.concatenate(([0], np.cumsum(quote, dtype=np.int64)))
    inside = (before[:-1] - np.repeat(before[at[:-1]], np.diff(at))) & 1
    step = (_OPENS[buf] - _SHUTS[buf]).astype(np.int64)
    return flips, sums(step * (inside == 0)), sums(step * (inside == 1))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """Rows of a batch by file block; a block's rows follow each other."""
    starts = batch.column("_start").to_numpy()
    files = batch.column("_file").dictionary_encode()
    codes = files.indices.to_numpy()
    edge = np.flatnonzero((np.diff(starts, prepend=-1) != 0) | (np.diff(codes, prepend=-1) != 0))
    for a, b in zip(edge.tolist(), [*edge[1:].tolist(), batch.num_rows], strict=True):
        yield batch.column("_file")[a].as_py(), int(starts[a]), batch.slice(a, b - a)


def _scan_states(flips: np.ndarray, out_delta: np.ndarray, in_delta: np.ndarray, quoted: int, depth: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Open quote and depth before each piece, and after the last."""
    state = quoted ^ (np.concatenate(([0], np.cumsum(flips))) & 1)
    step = np.where(state[:-1] == 0, out_delta, in_delta)
    deep = depth + np.concatenate(([0], np.cumsum(step)))
    return state, deep, int(state[-1]), int(deep[-1])


def _block_states(pieces: DataFrame, nested: bool) -> dict[tuple[str, int], tuple[int, int, bool]]:
    """Open quote and depth at the start of each block, and whether it is its file's first.

    One row per block of the input (some hundred MB) reaches the driver, as a listing of the files does.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ends, done = None, {}, []
        for batch in batches:
            for file, start, part in _runs(batch):
                if (file, start) != at:
                    done += [(*at, *ends[0], *ends[1])] if at else []
                    at, ends = (file, start), {0: (0, 0), 1: (1, 0)}
                steps = _transitions(part.column("value"), nested)
                ends = {quoted: _scan_states(*steps, *end)[2:] for quoted, end in ends.items()}
        if at:
            yield _table([*done, (*at, *ends[0], *ends[1])], STATES)

    out, file, quoted, depth = {}, None, 0, 0
    for row in pieces.mapInArrow(run, STATES).orderBy("_file", "_start").collect():
        first = row["_file"] != file
        if first:
            file, quoted, depth = row["_file"], 0, 0
        out[file, row["_start"]] = (quoted, depth, first)
        quoted, depth = row[f"end{quoted}"], depth + row[f"depth{quoted}"]
    return out


def _records(pieces: DataFrame, separator: str, nested: bool, ws: Workspace) -> DataFrame:
    """Rows (_file, _nth, text): the whole records of each file in order, from 0."""
    states = pieces.sparkSession.sparkContext.broadcast(_block_states(pieces, nested))
    level = int(nested)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, quoted, depth, local, held = None, 0, 0, 0, []

        def flush(last: bool) -> list[tuple]:
            # What comes before a block's first record and its last record may go on in other blocks.
            return [(*at, local, 0 < local and not last, separator.join(held))] if held else []

        for batch in batches:
            rows = []
            for file, start, part in _runs(batch):
                fresh = (file, start) != at
                if fresh:
                    rows += flush(True)
                    quoted, depth, first = states.value[file, start]
                    at, local, held = (file, start), 0, []
                state, deep, *_ = _scan_states(*_transitions(part.column("value"), nested), quoted, depth)
                begins = (state[:-1] == 0) & (deep[:-1] == level)
                if fresh and first:
                    begins[0] = True
                texts = part.column("value").to_pylist()
                if not nested:
                    # A blank line between records is none.
                    filled = [not (new and not t.strip()) for new, t in zip(begins.tolist(), texts, strict=True)]
                    texts, begins = [t for t, f in zip(texts, filled, strict=True) if f], begins[filled]
                edges = np.flatnonzero(begins).tolist()
                for i, (a, b) in enumerate(zip([0, *edges], [*edges, len(texts)], strict=True)):
                    if i:
                        rows += flush(False)
                        local, held = local + 1, []
                    held += texts[a:b]
                quoted, depth = int(state[-1]), int(deep[-1])
            yield _table(rows, PARTS)
        if at:
            yield _table(flush(True), PARTS)

    parts = ws.table(pieces.mapInArrow(run, PARTS), "parts")
    # One row per block: how many records begin before it in its file.
    counts = parts.groupBy("_file", "_start").agg(F.max("local").alias("n"))
    before = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_file", "_start", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    placed = parts.join(offsets, ["_file", "_start"]).withColumn("_nth", F.col("before") + F.col("local") - 1)
    cut = placed.filter("not whole").groupBy("_file", "_nth").agg(F.array_sort(F.collect_list(F.struct("_start", "text"))).alias("p"))
    joined = cut.select("_file", "_nth", F.array_join(F.transform("p", lambda x: x["text"]), separator).alias("text"))
    return placed.filter("whole").select("_file", "_nth", "text").unionByName(joined)


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    columns = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(columns)], [c for c, _ in columns])


def _numbered(records: DataFrame, ws: Workspace) -> DataFrame:
    """Add ``_ordinal``: the position among the records of all files, by file and place."""
    counts = records.groupBy("_file").agg(F.count("*").alias("n"), F.min("_nth").alias("first"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_file", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("off"))
    return records.join(offsets, "_file").withColumn("_ordinal", F.col("_nth") + F.col("off"))


def read_json_array_split(spark: SparkSession, path: str, ws: Workspace) -> DataFrame:
    """``raw, _ordinal`` of the elements of top-level JSON arrays, as ``read_json_array`` gives, with many tasks per file.

    Anything but one well-formed array per file is an error.
    """
    pieces = _pieces(spark, path, ",")
    records = _records(pieces, ",", True, ws)
    records = records.join(records.groupBy("_file").agg(F.max("_nth").alias("last")), "_file")
    body = F.col("text")
    opened = F.when(F.col("_nth") == 0, F.regexp_replace(body, r"^\s*\[", "")).otherwise(body)
    shut = F.when(F.col("_nth") == F.col("last"), F.regexp_replace(opened, r"\]\s*$", "")).otherwise(opened)
    wrong = ((F.col("_nth") == 0) & ~body.rlike(r"^\s*\[")) | ((F.col("_nth") == F.col("last")) & ~body.rlike(r"\]\s*$"))
    records = records.select("_file", "_nth", shut.alias("element"), wrong.alias("wrong"), ((F.col("last") == 0) & (strip(shut) == "")).alias("none"))
    item = F.from_json(F.concat(F.lit("["), "element", F.lit("]")), "array<string>")
    fine = ~F.col("wrong") & item.isNotNull() & (F.size(item) == 1)
    raw = F.when(fine, item[0]).otherwise(F.raise_error(F.concat("_file", F.lit(": expected a JSON array at the top"))).cast("string"))
    kept = records.filter(F.col("wrong") | ~F.col("none"))
    return _numbered(kept.select("_file", "_nth", raw.alias("raw")), ws).select("raw", "_ordinal")


def read_csv_split(spark: SparkSession, path: str, ws: Workspace) -> DataFrame:
    """All columns as strings and ``_ordinal``, as ``read_csv`` gives, with many tasks per file.

    Quoted cells may hold line breaks and doubled quotes. Every file begins with the header.
    """
    records = ws.table(_records(_pieces(spark, path, "\n"), "\n", False, ws).withColumn("text", F.regexp_replace("text", "\r$", "")), "records")
    first = records.filter("_nth = 0").orderBy("_file").limit(1).collect()
    if not first:
        raise ValueError(f"{path}: no header")
    names = spark.read.csv(path, header=True, escape='"').columns
    if "\n" in first[0]["text"]:
        names = next(csv.reader(io.StringIO(first[0]["text"])))
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    parsed = F.from_csv("text", schema, {"escape": '"', "maxCharsPerColumn": "-1"})
    rows = records.filter("_nth > 0").select("_file", "_nth", parsed.alias("c"))
    cells = [F.coalesce(F.col("c").getField(n), F.lit("")).alias(n) for n in names]
    return _numbered(rows, ws).select(*cells, "_ordinal")
