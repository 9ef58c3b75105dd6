"""Substring dedup: passages that begin in an earlier document too, by prefix-partitioned suffix trees.

The suffixes of all texts' words are cut into groups by prefixes, so that each group's part of the
suffix tree fits into memory; a node as deep as a window, with more than one suffix, is a repeat.
Only suffixes that can repeat take part:

1. Of each window, the 8-word gram with the least hash is its anchor. Equal windows have equal
   anchors at equal places, so a window with an anchor that only one document has repeats nowhere.
   Anchors alone are counted over the corpus, one for some twenty words.
2. Windows whose anchor several documents have travel to the group of that 8-word prefix, as runs of
   words with a common anchor. A group's tree is built down to the depth of a window, at 8, 16, 32
   and all words: two suffixes share a node of depth 2 d if they share one of depth d, and so do the
   suffixes d words later. The least document of each deep node keeps its copy.
3. Where more windows have an anchor than a group may hold, the prefix is lengthened to the whole
   window: each suffix is then a group member by itself, and groups are pre-aggregated to their least
   document before they are shuffled.

Texts with equal words are one from the start: all but the first are repeats as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from turnmill.llm.text import mix, pieces, rolled, windows, words
from turnmill.operators.skew import skew_join
from turnmill.workspace import Workspace

GRAM = 8
#: Hash bits that choose an anchor; the others hold its place, so that the first of equals wins.
PLACE = np.uint64(24)
BLOCK = 1 << 23
#: Bytes of a word's hash that travel with a run.
KEPT = 5

RUNS = "anchor long, doc_id long, name long, start long, words binary"
SPANS = "doc_id long, name long, start long, end long"


def anchors(word: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Window starts, and for each the hash of its anchor."""
    _, starts = windows(word, first, window)
    place = np.zeros(len(starts), np.int64)
    grams = len(word) - GRAM + 1
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    gram = rolled(word, np.arange(grams), np.arange(grams) + GRAM, 0xC2B2AE3D27D4EB4F)
    reach = window - GRAM + 1
    for low in range(0, len(word), BLOCK):
        mine = slice(*np.searchsorted(starts, [low, low + BLOCK]))
        part = gram[low : low + BLOCK + reach]
        if mine.start == mine.stop:
            continue
        least = (part >> PLACE << PLACE) | np.arange(len(part), dtype=np.uint64)
        width = 1
        while 2 * width <= reach:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if reach > width:
            least = np.minimum(least[: len(part) - reach + 1], least[reach - width :])
        at = (least & np.uint64((1 << 24) - 1)).astype(np.int64) + low
        place[mine] = at[starts[mine] - low]
    return starts, gram[place]


def text_names(word: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name each text's sequence of words."""
    a = rolled(word, first[:-1], first[1:], 0xA3B195354A39B70D)
    b = rolled(mix(word ^ np.uint64(0x5BF03635)), first[:-1], first[1:], 0xE7037ED1A0B428DB)
    return a.view(np.int64), b.view(np.int64)


def signatures(docs: DataFrame, key: str, text: str, window: int) -> DataFrame:
    """Each text's number of words, name and distinct anchors with their numbers of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                w = words(piece.column(1))
                word = w.fingerprints()
                starts, chosen = anchors(word, w.first, window)
                name, check = text_names(word, w.first)
                at = np.searchsorted(starts, w.first)
                own = [np.unique(chosen[a:b], return_counts=True) for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(w.counts), pa.array(name), pa.array(check),
                     pa.array([x.view(np.int64) for x, _ in own], pa.list_(pa.int64())), pa.array([n for _, n in own], pa.list_(pa.int64()))],
                    ["doc_id", "n_words", "name", "check", "anchor", "windows"],
                )

    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, name long, check long, anchor array<long>, windows array<long>")


def runs(texts: DataFrame, window: int) -> DataFrame:
    """Runs of windows with a common anchor among a text's given anchors: texts (doc_id, name, live, text)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                names = piece.schema.names
                w = words(piece.column(names.index("text")))
                word = w.fingerprints()
                starts, chosen = anchors(word, w.first, window)
                name, _ = text_names(word, w.first)
                live = piece.column(names.index("live"))
                row = np.searchsorted(w.first, starts, "right") - 1
                mine = (name == piece.column(names.index("name")).to_numpy(zero_copy_only=False))[row]
                # Pairs of text and anchor: one lookup for the whole piece.
                size = np.diff(live.offsets.to_numpy())
                wanted = live.values.to_numpy()[live.offsets[0].as_py() : live.offsets[-1].as_py()].view(np.uint64)
                wanted = mix(wanted + np.repeat(np.arange(len(size), dtype=np.uint64), size) * np.uint64(0x9E3779B97F4A7C15))
                mine &= np.isin(mix(chosen + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), wanted)
                starts, row, chosen = starts[mine], row[mine], chosen[mine]
                fresh = np.append(True, (chosen[1:] != chosen[:-1]) | (np.diff(row) != 0) | (np.diff(starts) != 1))[: len(starts)]
                a = np.flatnonzero(fresh)
                b = np.append(a[1:], len(starts)) - 1 if len(a) else a
                bytes_of = np.ascontiguousarray(word.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEPT])
                body = [bytes_of[x:y].tobytes() for x, y in zip(starts[a].tolist(), (starts[b] + window).tolist(), strict=True)]
                doc = piece.column(names.index("doc_id")).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chosen[a].view(np.int64)), pa.array(doc[row[a]], pa.int64()), pa.array(name[row[a]]),
                     pa.array(starts[a] - w.first[row[a]]), pa.array(body, pa.binary())],
                    ["anchor", "doc_id", "name", "start", "words"],
                )

    return texts.select("doc_id", "name", "live", "text").mapInArrow(cut, RUNS)


def _values(body: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all runs in a row, and where each run's begin."""
    body = body.cast(pa.large_binary())
    _, offsets, data = body.buffers()
    at = np.frombuffer(offsets, np.int64, len(body) + 1, body.offset * 8)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]].reshape(-1, KEPT)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :KEPT] = raw
    return wide.view(np.uint64).ravel(), (at - at[0]) // KEPT


def deep_nodes(values: np.ndarray, first: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of runs of at least ``depth`` words, and the node of that depth on the path of each.

    Nodes of depth 8 are named by their words; deeper ones by pairs of nodes above, down to ``depth``.
    """
    node, at = windows(values, first, GRAM)
    place = np.full(len(values) + 1, -1, np.int64)
    place[at] = np.unique(node, return_inverse=True)[1]
    have = GRAM
    end = np.repeat(first[1:], np.diff(first))
    while have < depth:
        step = min(have, depth - have)
        at = at[at + have + step <= end[at]]
        pair = place[at] * (len(values) + 1) + place[at + step]
        place[at] = np.unique(pair, return_inverse=True)[1]
        have += step
    return at, place[at]


def group_spans(table: pa.Table, window: int) -> pa.RecordBatch:
    """Parts of runs whose windows begin in an earlier document of their group."""
    values, first = _values(table["words"].combine_chunks())
    doc, name, start = (table[c].to_numpy() for c in ("doc_id", "name", "start"))
    at, node = deep_nodes(values, first, window)
    run = np.searchsorted(first, at, "right") - 1
    least = np.full(int(node.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, node, doc[run])
    later = doc[run] > least[node]
    return _spans(doc, name, start - first[:-1], at[later], run[later], window)


def _spans(doc: np.ndarray, name: np.ndarray, shift: np.ndarray, at: np.ndarray, run: np.ndarray, window: int) -> pa.RecordBatch:
    """Unions of consecutive windows of runs."""
    fresh = np.append(True, (np.diff(at) != 1) | (np.diff(run) != 0))[: len(at)]
    a = np.flatnonzero(fresh)
    b = np.append(a[1:], len(at)) - 1 if len(a) else a
    of = run[a]
    columns = [doc[of], name[of], at[a] + shift[of], at[b] + shift[of] + window]
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["doc_id", "name", "start", "end"])


def _group_trees(window: int, most: int = 400_000):
    """Map over runs sorted by anchor: whole groups at a time, some together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.column(4).nbytes // KEPT
            if size >= most:
                table = pa.Table.from_batches(held)
                anchor = table["anchor"].to_numpy()
                # The last group may go on in the next batch.
                whole = int(np.searchsorted(anchor, anchor[-1]))
                if whole:
                    yield group_spans(table.slice(0, whole), window)
                held = table.slice(whole).combine_chunks().to_batches()
                size = sum(x.column(4).nbytes for x in held) // KEPT
        if held:
            yield group_spans(pa.Table.from_batches(held), window)

    return run


def _long_prefixes(window: int):
    """Map from runs to windows, each named by all its words; equal ones in a row are one with a length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values, first = _values(batch.column(4))
                prefix, at = windows(values, first, window)
                row = np.searchsorted(first, at, "right") - 1
                start = batch.column(3).to_numpy()[row] + at - first[row]
                fresh = np.append(True, (prefix[1:] != prefix[:-1]) | (np.diff(row) != 0))[: len(row)]
                a = np.flatnonzero(fresh)
                count = np.diff(np.append(a, len(row)))
                of = pa.array(row[a])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prefix[a].view(np.int64)), batch.column(1).take(of), batch.column(2).take(of), pa.array(start[a]), pa.array(count)],
                    ["prefix", "doc_id", "name", "start", "count"],
                )

    return run


def cut_spans(docs: DataFrame, key: str, text: str, window: int) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept_sha256) of docs with the column spans of its key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                w = words(piece.column(1))
                word = w.fingerprints()
                name, _ = text_names(word, w.first)
                spans = piece.column(2).to_pylist()
                data, removed, digests = w.buf.tobytes(), [], []
                for i in range(piece.num_rows):
                    a, b = int(w.first[i]), int(w.first[i + 1])
                    keep = np.ones(b - a, bool)
                    for s in spans[i] or ():
                        if s["name"] == name[i]:
                            keep[s["start"] : s["end"]] = False
                    own = data[w.starts[a] : w.ends[b - 1]].split() if b > a else []
                    if not keep.all():
                        own = [own[j] for j in np.flatnonzero(keep)]
                    removed.append(b - a - len(own))
                    digests.append(hashlib.sha256(b" ".join(own)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(w.counts), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                    ["doc_id", "n_words", "n_removed", "kept_sha256"],
                )

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), "spans")
    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def repeated_spans(docs: DataFrame, key: str, text: str, window: int, group: int, space: Workspace) -> DataFrame:
    """Rows (doc_id, name, start, end): word spans of each text that earlier documents hold."""
    own = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    signed = space.table(signatures(docs, key, text, window).filter("doc_id IS NOT NULL").filter(F.col("n_words") >= window), "signatures")
    firsts = signed.groupBy("name", "check").agg(F.min("doc_id").alias("rep"))
    same = signed.join(firsts, ["name", "check"])
    copies = same.filter("doc_id > rep").select("doc_id", "name", F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end"))
    posted = same.filter("doc_id = rep").select("doc_id", "name", F.inline(F.arrays_zip("anchor", "windows")))
    shared = posted.groupBy("anchor").agg(F.sum("windows").alias("windows"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    shared = shared.filter("lo < hi").select("anchor", (F.col("windows") > group).alias("long"))
    marked = space.table(
        posted.join(shared, "anchor").groupBy("doc_id", "name", "long").agg(F.collect_list("anchor").alias("live")), "marked"
    )
    few = runs(own.join(marked.filter("NOT long").drop("long"), "doc_id"), window)
    trees = few.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_group_trees(window), SPANS)
    many = runs(own.join(marked.filter("long").drop("long"), "doc_id"), window)
    alone = many.mapInArrow(_long_prefixes(window), "prefix long, doc_id long, name long, start long, count long")
    alone = space.table(alone, "prefixes")
    least = alone.groupBy("prefix").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").drop("hi")
    later = skew_join(alone, least, "prefix", "doc_id", limit=20_000).filter("doc_id > lo")
    later = later.select("doc_id", "name", "start", (F.col("start") + F.col("count") + (window - 1)).alias("end"))
    return copies.union(trees).union(later)


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 50, group: int = 50_000, space: Workspace | None = None
) -> DataFrame:
    """One row per row of ``docs``: n_words, n_removed and the digest of the kept words, joined by spaces.

    A word is removed if a window of ``window`` consecutive words that covers it begins in a row of a
    smaller key too. Texts of fewer words, null and empty texts lose nothing, nor do rows with a null
    key, which do not count as earlier either. Rows that repeat a key are judged each. Up to ``group``
    windows share a group of the tree; anchors of more are split by longer prefixes.
    """
    space = space or Workspace(docs.sparkSession)
    spans = repeated_spans(docs, key, text, window, group, space)
    spans = spans.groupBy(F.col("doc_id").alias("at")).agg(F.collect_list(F.struct("name", "start", "end")).alias("spans"))
    own = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    return cut_spans(own.join(spans, F.col("doc_id") == F.col("at"), "left"), "doc_id", "text", window)
