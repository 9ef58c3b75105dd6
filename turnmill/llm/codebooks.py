"""Product codes of vectors: codebooks per part by Lloyd's rounds over two trees.

A vector's components become integers and are cut into equal consecutive parts; each part position has a
codebook. The parts of a block of vectors are kept as trees: halved again and again along their widest
component, each node with its box and the sum of its parts. The entries of a codebook form a tree as well. A
round walks both together, level by level: a pair of nodes goes when another entry node is certainly nearer to
the whole box, a node that has a single entry left adds its cached sum to it, and only the parts of leaves that
keep several entries are compared one by one. All distances are integers, so results are exact and do not depend
on blocks or partitions; a round sends one row per part and entry to the driver.

Rows whose vector is null or empty, or holds null or non-finite components, are dropped; so are vectors whose
length is not that of the least kept vec_id or does not divide into the parts. Components are held to 2**27 in
size once they are integers, which keeps squared distances within 64 bits. Repeated ids stay rows of their own
(as first entries they go by their vectors); rows without an id are coded too and come last for the first entries.
With fewer kept vectors than entries the codebooks have fewer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from turnmill.operators.skew import skew_join
from turnmill.workspace import Workspace

#: Parts in a leaf at most, and rows of a block at most.
LEAF, BLOCK = 32, 10_000
LIMIT = 1 << 27
BLOCK_SCHEMA = "n long, keys binary, labels binary, points binary, place binary, low binary, high binary, total binary"


@dataclass
class Forest:
    """The trees of all part positions over one block: level l has 2**l nodes of equal size for each part.

    ``points`` (parts, rows, width) is in tree order and ``place`` names each one's row; rows past the block's own
    repeat the last one and weigh nothing. ``low``, ``high`` and ``total`` list the levels from the root.
    """

    n: int
    points: np.ndarray
    place: np.ndarray
    low: list[np.ndarray]
    high: list[np.ndarray]
    total: list[np.ndarray]

    @property
    def levels(self) -> int:
        return len(self.low)

    def counts(self, level: int) -> np.ndarray:
        """Own rows in each node (parts, nodes)."""
        own = self.place < self.n
        return own.reshape(len(own), 1 << level, -1).sum(2)


def plant(values: np.ndarray, leaf: int = LEAF) -> Forest:
    """The trees of integer vectors (rows, parts, width)."""
    n, parts, width = values.shape
    levels = 0
    while (leaf << levels) < n:
        levels += 1
    size = -(-n >> levels) << levels
    place = np.tile(np.arange(size), (parts, 1))
    points = values.transpose(1, 0, 2)[:, np.minimum(np.arange(size), n - 1)]
    for level in range(levels):
        nodes = points.reshape(parts << level, size >> level, width)
        widest = (nodes.max(1) - nodes.min(1)).argmax(1)
        # Halves of equal size; which of equal components falls where does not matter to the results.
        order = np.take_along_axis(nodes, widest[:, None, None], 2)[:, :, 0].argsort(1, kind="stable")
        points = np.take_along_axis(nodes, order[:, :, None], 1).reshape(parts, size, width)
        place = np.take_along_axis(place.reshape(parts << level, -1), order, 1).reshape(parts, size)
    nodes = points.reshape(parts, 1 << levels, -1, width)
    own = (place < n).reshape(parts, 1 << levels, -1, 1)
    low, high, total = [nodes.min(2)], [nodes.max(2)], [(nodes * own).sum(2)]
    for _ in range(levels):
        low.append(low[-1].reshape(parts, -1, 2, width).min(2))
        high.append(high[-1].reshape(parts, -1, 2, width).max(2))
        total.append(total[-1].reshape(parts, -1, 2, width).sum(2))
    return Forest(n, points, place, low[::-1], high[::-1], total[::-1])


def entry_tree(book: np.ndarray) -> list[np.ndarray]:
    """Entries of each node of a tree over a codebook (entries, width), level by level, halved along the widest component."""
    nodes, levels = [np.arange(len(book))], []
    while True:
        levels.append(nodes)
        if max(map(len, nodes)) <= 1:
            return levels
        below = []
        for node in nodes:
            if len(node) == 1:
                below.append(node)
                continue
            own = book[node]
            node = node[own[:, (own.max(0) - own.min(0)).argmax()].argsort(kind="stable")]
            below += [node[: len(node) // 2], node[len(node) // 2 :]]
        nodes = below


def _bounds(low: np.ndarray, high: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest squared distance between the boxes of nodes and of entry nodes, pair by pair."""
    gap = np.maximum(np.maximum(least - high, low - most), 0)
    reach = np.maximum(np.abs(high - least), np.abs(most - low))
    return (gap * gap).sum(1), (reach * reach).sum(1)


def walk(forest: Forest, part: int, book: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Where the parts of one position belong.

    Yields (level, nodes, entry of each): whole nodes; and last (-1, leaf of each, pairs (leaf, entry)) for the
    leaves that keep several entries. Both trees descend together until the entries are single.
    """
    tree = entry_tree(book)
    node, mine = np.zeros(1, np.int64), np.zeros(1, np.int64)
    for level in range(forest.levels):
        row = min(level, len(tree) - 1)
        groups = tree[row]
        least = np.array([book[g].min(0) for g in groups])
        most = np.array([book[g].max(0) for g in groups])
        low, high = forest.low[level][part][node], forest.high[level][part][node]
        near, far = _bounds(low, high, least[mine], most[mine])
        first = np.flatnonzero(np.diff(node, prepend=-1))
        span = np.diff(np.append(first, len(node)))
        keep = near <= np.repeat(np.minimum.reduceat(far, first), span)
        if row == len(tree) - 1:
            keep &= _not_dominated(low, high, far, book[[int(g[0]) for g in groups]][mine], first, span)
        node, mine = node[keep], mine[keep]
        first = np.flatnonzero(np.diff(node, prepend=-1))
        span = np.diff(np.append(first, len(node)))
        single = np.array([len(g) == 1 for g in groups])[mine[first]] & (span == 1)
        if single.any():
            yield level, node[first[single]], np.array([int(groups[i][0]) for i in mine[first[single]]])
            open_ = np.repeat(~single, span)
            node, mine = node[open_], mine[open_]
        if not len(node):
            return
        if level == forest.levels - 1:
            break
        if row < len(tree) - 1:
            node, mine = _descend(node, mine, groups)
        # Both children of every node, each with the node's entry nodes.
        node = np.stack([node * 2, node * 2 + 1], 1).ravel()
        mine = np.repeat(mine, 2)
        order = np.argsort(node, kind="stable")
        node, mine = node[order], mine[order]
    row = min(forest.levels - 1, len(tree) - 1)
    while row < len(tree) - 1:
        node, mine = _descend(node, mine, tree[row])
        row += 1
    entry = np.array([int(g[0]) for g in tree[row]])[mine]
    yield -1, node, entry


def _descend(node: np.ndarray, mine: np.ndarray, groups: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs with the children of their entry nodes; a single entry is its own child."""
    kids = np.array([1 if len(g) == 1 else 2 for g in groups])
    start = np.cumsum(kids) - kids
    times = kids[mine]
    offset = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    return np.repeat(node, times), np.repeat(start[mine], times) + offset


def _not_dominated(low: np.ndarray, high: np.ndarray, far: np.ndarray, entry: np.ndarray, first: np.ndarray, span: np.ndarray) -> np.ndarray:
    """Pairs whose entry is as near as the node's best one for some point of the box.

    The point that favours an entry most over the best is a corner of the box, found component by component.
    """
    order = np.lexsort((far, np.repeat(np.arange(len(first)), span)))
    best = np.repeat(entry[order[first]], span, axis=0)
    corner = np.where(entry > best, high, low)
    own, other = corner - entry, corner - best
    return (own * own).sum(1) <= (other * other).sum(1)


def leaves(forest: Forest, part: int, node: np.ndarray, entry: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (in tree order) of the leaves that keep several entries, and their entries by integer distances.

    Of equally near entries the first one counts. Pairs come sorted by leaf.
    """
    size = forest.points.shape[1] >> (forest.levels - 1)
    order = np.lexsort((entry, node))
    node, entry = node[order], entry[order]
    first = np.flatnonzero(np.diff(node, prepend=-1))
    away = forest.points[part].reshape(-1, size, book.shape[1])[node] - book[entry][:, None]
    square = np.einsum("nij,nij->ni", away, away)
    least = np.repeat(np.minimum.reduceat(square, first), np.diff(np.append(first, len(node))), axis=0)
    found = np.minimum.reduceat(np.where(square == least, entry[:, None], len(book)), first)
    return (node[first][:, None] * size + np.arange(size)).ravel(), found.ravel()


def assign(forest: Forest, books: np.ndarray) -> np.ndarray:
    """Entry of each row's parts (rows, parts)."""
    parts, size = forest.place.shape
    out = np.zeros((size, parts), np.int64)
    for part in range(parts):
        mine = np.zeros(size, np.int64)
        for level, node, entry in walk(forest, part, books[part]):
            if level >= 0:
                mine.reshape(1 << level, -1)[node] = entry[:, None]
            else:
                rows, found = leaves(forest, part, node, entry, books[part])
                mine[rows] = found
        out[forest.place[part], part] = mine
    return out[: forest.n]


def gather(forest: Forest, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and number of the parts that belong to each entry (parts, entries, width) and (parts, entries)."""
    parts = len(books)
    sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
    sizes = [forest.counts(level) for level in range(forest.levels)]
    for part in range(parts):
        own = forest.place[part] < forest.n
        for level, node, entry in walk(forest, part, books[part]):
            if level >= 0:
                np.add.at(sums[part], entry, forest.total[level][part][node])
                np.add.at(counts[part], entry, sizes[level][part][node])
            else:
                rows, found = leaves(forest, part, node, entry, books[part])
                rows, found = rows[own[rows]], found[own[rows]]
                np.add.at(sums[part], found, forest.points[part][rows])
                counts[part] += np.bincount(found, minlength=len(books[part]))
    return sums, counts


def integers(vectors: np.ndarray, scale: int) -> np.ndarray:
    return np.clip(np.floor(vectors.astype(np.float64) * scale), -LIMIT, LIMIT).astype(np.int64)


def _block(forest: Forest, keys: pa.Array, labels: pa.Array) -> pa.RecordBatch:
    flat = lambda x, kind: np.concatenate([np.asarray(y).ravel() for y in x]).astype(kind).tobytes()
    columns = [_packed(keys), _packed(labels), flat([forest.points], "<i4"), flat([forest.place], "<i4")]
    columns += [flat(forest.low, "<i4"), flat(forest.high, "<i4"), flat(forest.total, "<i8")]
    names = [c.split()[0] for c in BLOCK_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([forest.n], pa.int64()), *[pa.array([c], pa.binary()) for c in columns]], names)


def _packed(column: pa.Array) -> bytes:
    """An array as the bytes of an Arrow stream."""
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([column], ["x"])
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(body: bytes) -> pa.Array:
    with pa.ipc.open_stream(body) as stream:
        return stream.read_all().column(0).combine_chunks()


def _forest(row: dict, parts: int, width: int) -> Forest:
    points = np.frombuffer(row["points"], "<i4").reshape(parts, -1, width).astype(np.int64)
    place = np.frombuffer(row["place"], "<i4").reshape(parts, -1)
    nodes = len(row["low"]) // 4 // parts // width
    levels = (nodes + 1).bit_length() - 1
    cut = [0, *np.cumsum([parts * width << level for level in range(levels)]).tolist()]
    split = lambda body, kind: [
        np.frombuffer(body, kind)[a:b].astype(np.int64).reshape(parts, -1, width) for a, b in zip(cut, cut[1:], strict=False)
    ]
    return Forest(row["n"], points, place, split(row["low"], "<i4"), split(row["high"], "<i4"), split(row["total"], "<i8"))


def train_codebooks(blocks: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    """Lloyd's rounds over blocks of trees: each entry moves to the floored mean of its parts, unused ones stay."""
    parts, entries, width = books.shape
    for _ in range(rounds):
        held = books

        def run(batches: Iterator[pa.RecordBatch], books: np.ndarray = held) -> Iterator[pa.RecordBatch]:
            sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
            for batch in batches:
                for row in batch.to_pylist():
                    s, c = gather(_forest(row, parts, width), books)
                    sums, counts = sums + s, counts + c
            part, entry = np.nonzero(counts)
            columns = [pa.array(part), pa.array(entry), pa.array(counts[part, entry])]
            columns += [pa.array(sums[part, entry, i]) for i in range(width)]
            yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "n", *[f"s{i}" for i in range(width)]])

        schema = "part long, entry long, n long, " + ", ".join(f"s{i} long" for i in range(width))
        total = blocks.mapInArrow(run, schema).groupBy("part", "entry").agg(F.sum("n"), *[F.sum(f"s{i}") for i in range(width)])
        books = books.copy()
        for part, entry, n, *sums in total.collect():
            books[part, entry] = np.array(sums) // n
    return books


def compress(
    vectors: DataFrame,
    *,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> tuple[DataFrame, np.ndarray]:
    """Rows (key, label, codes, error) of all kept vectors, and the codebooks (parts, entries, width).

    ``codes`` holds one entry per part as bytes, ``error`` the sum of the squared distances to them. The vectors
    are written once as blocks of trees, which every round reads; the driver holds the codebooks alone.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    space = Workspace(vectors.sparkSession)
    x = F.col("vector")
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = vectors.select(vectors[key].alias("key"), vectors[label].alias("label"), vectors[vector].cast("array<double>").alias("vector"))
    rows = rows.filter(x.isNotNull() & (F.size(x) > 0) & F.coalesce(whole, F.lit(False)))
    first = rows.orderBy(F.col("key").asc_nulls_last(), "vector").limit(1).collect()
    dims = len(first[0]["vector"]) if first else 0
    fits = dims > 0 and dims % parts == 0
    rows = rows.filter((F.size(x) == dims) if fits else F.lit(False))
    width = dims // parts if fits else 1
    # One row for each entry reaches the driver.
    head = rows.orderBy(F.col("key").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    start = np.array([r["vector"] for r in head], np.float64).reshape(len(head), parts, width)
    books = integers(start, scale).transpose(1, 0, 2).copy()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                own = batch.slice(at, BLOCK)
                values = own.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, parts, width)
                yield _block(plant(integers(values, scale)), own.column(0), own.column(1))

    blocks = space.table(rows.mapInArrow(build, BLOCK_SCHEMA), "blocks")
    books = train_codebooks(blocks, books, rounds)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                forest = _forest(row, parts, width)
                found = assign(forest, books)
                values = np.empty((forest.n, parts, width), np.int64)
                for part in range(parts):
                    own = forest.place[part] < forest.n
                    values[forest.place[part][own], part] = forest.points[part][own]
                away = values - books[np.arange(parts)[None, :], found]
                codes = [bytes(r) for r in found.astype(np.uint8).tolist()]
                columns = [_unpacked(row["keys"]), _unpacked(row["labels"]), pa.array(codes, pa.binary()), pa.array((away * away).sum((1, 2)))]
                yield pa.RecordBatch.from_arrays(columns, ["key", "label", "codes", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    coded = space.table(blocks.mapInArrow(code, f"key {kinds['key']}, label {kinds['label']}, codes binary, error long"), "codes")
    return coded.withColumnsRenamed({"key": key, "label": label}), books


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components by part, entry and position, in decimal, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_error(coded: DataFrame, label: str = "label", spread: str = "vec_id") -> DataFrame:
    """Add ``label_error``, the error summed over equal labels, nulls together.

    Sums combine before they are shuffled, and a label that many rows share is joined over several tasks.
    """
    named = coded.withColumn("_label", F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit("")))
    total = named.groupBy("_label").agg(F.sum("error").alias("label_error"))
    return skew_join(named, total, "_label", spread).drop("_label")
