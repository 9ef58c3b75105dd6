"""N-gram Jaccard join: T-occurrence search over inverted lists, by DivideSkip.

Texts become sets of hashed word shingles; texts with equal sets are one class from then on. Partners
share a part of their sets, so three steps leave little to search, and none loses a link:

1. The least hashes of each set, some more than could all differ, are posted. A set of which too few
   posted hashes occur elsewhere has no partner.
2. The sets that are left are posted whole. Hashes without a second owner cannot be shared; a set
   with too few others has no partner.
3. Partners share one of each set's rarest hashes, those that could all differ and one more.
   The sets connected by such hashes form blocks; large blocks are cut into chunks, and pairs of
   chunks are searched apart from each other.

In a block, every set asks which others share T of its hashes: its short lists are merged by count,
and the long ones are probed for those that the short ones leave over, or merged too where that takes
fewer steps. Links are counted and tested exactly; only a forest that connects them leaves a block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import AtomicType, LongType, StructType

from turnmill.llm.graph import components
from turnmill.llm.text import mix, pieces, rolled, windows, words
from turnmill.workspace import Workspace

#: Any character of a word.
WORD = r"[^\x20\x09-\x0D]"
SIGNATURE = "doc_id long, mark long, n long, node long, check long, prefix array<int>"
NAME = StructType().add("node", LongType()).add("check", LongType())


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's k-word shingles, words in lower case.

    A text of fewer words has its whole sequence as one shingle; a text without words has none.
    """
    w = words(column)
    word = w.fingerprints(lower=True)
    shingle, starts = windows(word, w.first, k)
    first = np.searchsorted(starts, w.first)
    short = np.flatnonzero((w.counts > 0) & (w.counts < k))
    alone = rolled(word, w.first[short], w.first[short + 1], 0xA3B195354A39B70D)
    sets = [np.unique(shingle[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
    for i, x in zip(short.tolist(), alone, strict=True):
        sets[i] = np.array([x], np.uint64)
    return sets


class Threshold:
    """What a Jaccard similarity of at least percent / 100 asks of sets of n hashes."""

    def __init__(self, percent: int):
        self.percent = percent

    def least(self, n):
        """Hashes that a set of n shares with any partner."""
        return -(-self.percent * n // 100)

    def pair(self, n, m):
        """Hashes that sets of n and m share."""
        return -(-self.percent * (n + m) // (100 + self.percent))

    def spare(self, n):
        """Posted hashes of a set beyond those that could all differ."""
        return np.maximum(1, n // 20)

    def posted(self, n: int) -> int:
        return min(n, n - self.least(n) + int(self.spare(n)))

    def needed(self, n: Column) -> Column:
        """Posted hashes that a set of n must share: the fewest that its smallest partner asks for."""
        return F.greatest(F.lit(1), F.floor(F.ceil(n * self.percent / 100) / 20))

    def needed_whole(self, n: Column) -> Column:
        return F.ceil(n * self.percent / 100)

    def linkable(self, n: Column) -> Column:
        """Whether a set of n can link to a smaller set, or to a larger one that holds all of it."""
        return (self.needed_whole(n) < n) | (100 * n >= self.percent * (n + 1))


def set_names(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name each set; 0 for empty ones."""
    node = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64)
    check = np.array([(s * mix(s ^ np.uint64(0x5BF0))).sum(dtype=np.uint64) for s in sets], np.uint64)
    return node.view(np.int64), check.view(np.int64)


def signatures(docs: DataFrame, key: str, text: str, k: int, at: Threshold) -> DataFrame:
    """Size, 128-bit name and posted hashes (32 bits each) of each text's set; ``mark`` tells texts of one key apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                sets = shingle_sets(piece.column(1), k)
                node, check = set_names(sets)
                prefix = [(s[: at.posted(len(s))] >> np.uint64(32)).astype(np.uint32).view(np.int32) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(node), pa.array(check),
                     pa.array(prefix, pa.list_(pa.int32()))],
                    ["doc_id", "mark", "n", "node", "check", "prefix"],
                )

    return _marked(docs, key, text).mapInArrow(run, SIGNATURE)


def _marked(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"), F.xxhash64(docs[text]).alias("mark"))


def whole_sets(texts: DataFrame, k: int) -> DataFrame:
    """Rows (id, shingle) of texts (id, node, check, text); texts of another set than named are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                sets = shingle_sets(piece.column(piece.schema.get_field_index("text")), k)
                node, check = set_names(sets)
                same = (node == piece.column(1).to_numpy()) & (check == piece.column(2).to_numpy())
                sets = [s if x else s[:0] for s, x in zip(sets, same.tolist(), strict=True)]
                own = np.repeat(piece.column(0).to_numpy(), [len(s) for s in sets])
                shingle = np.concatenate(sets).view(np.int64) if len(own) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(shingle)], ["id", "shingle"])

    return texts.select("id", "node", "check", "text").mapInArrow(run, "id long, shingle long")


class Lists:
    """Inverted lists of sets: for each hash the owners in order."""

    def __init__(self, sets: list[np.ndarray], ids: np.ndarray | None = None):
        size = np.array([len(s) for s in sets], np.int64)
        every = np.concatenate(sets) if len(sets) else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(sets)), size)
        self.hashes = np.unique(every)
        list_of = np.searchsorted(self.hashes, every)
        order = np.lexsort((owner, list_of))
        self.owner = owner[order].astype(np.int64)
        self.first = np.searchsorted(list_of[order], np.arange(len(self.hashes) + 1))
        self.cells = list_of[order] * len(sets) + self.owner
        self.count = len(sets)
        self.begin = self.first[:-1].copy()  # owners before have been asked already

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """The lists of those hashes that have one."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at[self.hashes[at] == hashes] if len(self.hashes) else at[:0]

    def merged(self, lists: np.ndarray) -> np.ndarray:
        """How often each owner occurs in some lists."""
        size = self.first[lists + 1] - self.begin[lists]
        total = int(size.sum())
        at = np.arange(total) + np.repeat(self.begin[lists] - np.cumsum(size) + size, size)
        return np.bincount(self.owner[at], minlength=self.count)

    def probed(self, lists: np.ndarray, owners: np.ndarray) -> np.ndarray:
        """In how many of some lists each owner occurs, by binary search."""
        cells = (lists[:, None] * self.count + owners[None, :]).ravel()
        at = np.minimum(np.searchsorted(self.cells, cells), len(self.cells) - 1)
        return (self.cells[at] == cells).reshape(len(lists), len(owners)).sum(0)


def partners(lists: Lists, mine: np.ndarray, least: int, skew: float = 0.01, probe_cost: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Owners that share ``least`` hashes with those of the lists ``mine``, and how many.

    DivideSkip: with L long lists set aside, a partner occurs least - L times in the others.
    """
    size = lists.first[mine + 1] - lists.begin[mine]
    mine = mine[np.argsort(size, kind="stable")]
    longest = int(size.max(initial=1))
    aside = min(least - 1, int(least / (skew * math.log2(longest + 1) + 1)), len(mine))
    short, long = mine[: len(mine) - aside], mine[len(mine) - aside :]
    counts = lists.merged(short)
    found = np.flatnonzero(counts >= max(1, least - aside))
    if len(found) and len(long):
        if len(found) * len(long) * probe_cost < int((lists.first[long + 1] - lists.begin[long]).sum()):
            shared = counts[found] + lists.probed(long, found)
        else:
            shared = (counts + lists.merged(long))[found]
    else:
        shared = counts[found]
    full = shared >= least
    return found[full], shared[full]


def block_links(
    sets: list[np.ndarray], sizes: np.ndarray, copies: np.ndarray, side: np.ndarray | None, at: Threshold
) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """For each set the copies of its partners in the block, and links that connect what is linked.

    With sides, only links between sets of different sides count.
    """
    order = np.argsort(sizes, kind="stable")
    sets, n, weight = [sets[i] for i in order], sizes[order], copies[order]
    apart = side[order] if side is not None else None
    lists = Lists(sets)
    label = np.arange(len(sets))
    degree = np.zeros(len(sets), np.int64)
    links = []
    for x in range(len(sets)):
        mine = lists.of(sets[x])
        lists.begin[mine] += 1  # partners before x have met x
        found, shared = partners(lists, mine, int(at.pair(n[x], n[x])))
        true = shared >= at.pair(n[x], n[found])
        if apart is not None:
            true &= apart[found] != apart[x]
        found = found[true]
        if len(found):
            degree[x] += weight[found].sum()
            degree[found] += weight[x]
            roots = np.unique(label[found])
            for root in roots[roots != label[x]].tolist():
                links.append((int(order[x]), int(order[found[np.argmax(label[found] == root)]])))
            label[np.isin(label, np.append(roots, label[x]))] = min(int(roots[0]), int(label[x]))
    out = np.zeros(len(sets), np.int64)
    out[order] = degree
    return out, links


def jaccard_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 4, percent: int = 85, chunk: int = 1_000_000,
    space: Workspace | None = None, with_names: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id and n_links.

    Two rows link when their sets of ``k``-word shingles have a Jaccard similarity of ``percent`` / 100
    or more. ``component_id`` is the least key reachable, its own included; ``n_links`` the number of
    rows that it links to. Null and empty texts have no shingles and no links. Rows of equal sets are
    linked, also if they repeat a key; a null key links like others but names no component, so that of
    rows without any key is null. Blocks of over ``chunk`` posted hashes are searched in pairs of chunks.
    ``with_names`` adds the 128-bit name of each set, node and check, and component: the least id of its
    linked classes, which tells components apart whatever their keys, null without words. Empty input
    gives no rows.
    """
    space = space or Workspace(docs.sparkSession)
    at = Threshold(percent)
    sets = space.table(signatures(docs, key, text, k, at), "signatures")
    classes = space.table(_classes(sets.filter("n > 0")), "classes")
    links = _class_links(docs, sets, classes, key, text, k, at, chunk, space)
    linked = components(links.filter("b IS NOT NULL").select("a", "b"), space).withColumnRenamed("vertex", "id")
    degrees = links.filter("degree IS NOT NULL").groupBy(F.col("a").alias("id")).agg(F.sum("degree").alias("degree"))
    # Only linked classes meet by component; the others would share the null of a left join.
    members = linked.join(classes.select("id", "rep"), "id")
    least = members.groupBy("component").agg(F.min("rep").alias("component_id"))
    members = members.join(least, "component").select("id", "component", "component_id")
    classes = classes.drop("n").join(members, "id", "left").join(degrees, "id", "left")
    out = sets.drop("prefix", "mark").join(classes.drop("mark", "prefix"), ["node", "check"], "left")
    alone = F.col("n") == 0
    named = ["node", "check", F.coalesce("component", "id").alias("component")] if with_names else []
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.coalesce("component_id", "rep")).alias("component_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("copies") - 1 + F.coalesce("degree", F.lit(0))).cast("long").alias("n_links"),
        *named,
    )


def _classes(sets: DataFrame) -> DataFrame:
    """One row for each different set: its least key, its number of rows, its posted hashes, and an id of its own.

    The id is the least key, unless that is null or names another class too; then it is the node. ``mark``
    is that of a text with the least key, so that key and mark lead back to this set alone.
    """
    own_text = F.struct(F.col("doc_id").isNull(), "doc_id", "mark")
    classes = sets.groupBy("node", "check").agg(
        F.min("doc_id").alias("rep"), F.min_by("mark", own_text).alias("mark"), F.count("*").alias("copies"),
        F.first("n").alias("n"), F.first("prefix").alias("prefix"),
    )
    same_rep = Window.partitionBy("rep", F.when(F.col("rep").isNull(), F.col("node"))).orderBy("node", "check")
    leads = F.col("rep").isNotNull() & (F.row_number().over(same_rep) == 1)
    return classes.withColumn("id", F.when(leads, F.col("rep")).otherwise(F.col("node")))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 4, percent: int = 85, space: Workspace | None = None) -> DataFrame:
    """The rows of ``docs`` that are left when one row of each component stays, unchanged.

    The row of the component's least key stays; of several rows with that key and an equal set the one
    least by text and the other columns that can be ordered, of several sets the one least by name.
    Components are told apart by what links, not by key: unlinked rows that repeat a key or have none
    all stay. Rows without words are no copies of anything and stay. Columns of any name and type pass
    through.
    """
    space = space or Workspace(docs.sparkSession)
    worded = F.coalesce(docs[text].rlike(WORD), F.lit(False))
    rows = docs.filter(worded)
    groups = space.table(jaccard_components(rows, key, text, k, percent, space=space, with_names=True), "groups")
    own = F.col("doc_id").eqNullSafe(F.col("own_key"))
    first = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("component", "component_id")
    kept = first.agg(F.min(F.struct("node", "check")).alias("name")).select(F.col("component_id").alias("own_key"), "name.*")
    times = groups.groupBy("doc_id").agg((F.count("*") > 1).alias("repeated"))
    kept = space.table(kept.join(times, own).drop("doc_id"), "kept")
    again = space.table(kept.filter("repeated").drop("repeated"), "again")
    held = rows.select(rows[key].cast("long").alias("doc_id"), F.struct(*[rows[c] for c in docs.columns]).alias("row"))
    # A key of one row names its row; only among rows that repeat a key the set has to be looked at.
    alone = held.join(kept.filter("NOT repeated"), own).select("row.*")
    some = held.join(again.select("own_key").distinct(), own, "left_semi")
    some = some.select("doc_id", F.col("row")[text].alias("text"), "row")

    def add_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                node, check = set_names(shingle_sets(piece.column(1), k))
                names = [*piece.schema.names, "node", "check"]
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(node), pa.array(check)], names)

    plain = [x.name for x in docs.schema.fields if isinstance(x.dataType, AtomicType)]
    order = F.struct("text", *[F.col("row")[c] for c in plain])
    named = some.mapInArrow(add_names, StructType([*some.schema.fields, *NAME.fields]))
    # Joined by key and set: each row meets its own set only, however many share its key.
    chosen = named.join(again.withColumnsRenamed({"node": "own_node", "check": "own_check"}), own & F.expr("node = own_node AND check = own_check"))
    one = chosen.groupBy("doc_id", "node", "check").agg(F.min_by("row", order).alias("row"))
    return alone.union(one.select("row.*")).union(docs.filter(~worded))


def _shared(posted: DataFrame, hash_: str, space: Workspace, limit: int = 500_000) -> DataFrame:
    """The postings (id, hash) of hashes with a second owner, and their owners.

    Owners are counted before they are shuffled, and a hash of over ``limit`` owners is split over several
    salts, so no task holds all postings of a phrase that many texts share. ``posted`` is read twice.
    """
    owned = posted.groupBy(hash_).agg(F.count("*").alias("owners")).filter("owners > 1")
    owned = space.table(owned, "owners")
    hot = owned.filter(F.col("owners") > limit).select(hash_, F.ceil(F.col("owners") / limit).cast("int").alias("salts"))
    if hot.isEmpty():
        return posted.join(owned, hash_)
    # At most postings / limit hashes are that frequent, which bounds the broadcast table.
    own_salt, every_salt = F.pmod(F.xxhash64("id"), F.coalesce("salts", F.lit(1))), F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
    left = posted.join(F.broadcast(hot), hash_, "left").withColumn("salt", own_salt.cast("int")).drop("salts")
    right = owned.join(F.broadcast(hot), hash_, "left").withColumn("salt", F.explode(every_salt)).drop("salts")
    return left.join(right, [hash_, "salt"]).drop("salt")


def _class_links(
    docs: DataFrame, sets: DataFrame, classes: DataFrame, key: str, text: str, k: int, at: Threshold, chunk: int, space: Workspace
) -> DataFrame:
    """Rows (a, b, degree): links between the ids of classes, and the copies that each links to."""
    # Sets too small for any difference have no partners but their copies.
    linkable = classes.filter(at.linkable(F.col("n")))
    posted = linkable.select("id", F.explode("prefix").alias("hash"))
    hits = _shared(posted, "hash", space).groupBy("id").agg(F.count("*").alias("hits"))
    likely = linkable.join(hits, "id").filter(F.col("hits") >= at.needed(F.col("n")))
    # Rows that repeat key and text would post a set again for each of them.
    again = sets.groupBy("doc_id", "mark").agg((F.count("*") > 1).alias("again")).filter("again")
    again = again.select(F.col("doc_id").alias("again_key"), F.col("mark").alias("again_mark"), "again")
    repeats = F.col("rep").eqNullSafe(F.col("again_key")) & (F.col("own") == F.col("again_mark"))
    reps = likely.select("id", "rep", F.col("mark").alias("own"), "node", "check")
    reps = space.table(reps.join(again, repeats, "left").drop("again_key", "again_mark"), "likely")
    # By key and text: a null or repeated key leads each of its rows to no other set than its own.
    texts = _marked(docs, key, text).join(reps, F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("mark") == F.col("own")))
    if not reps.filter("again").isEmpty():
        texts = texts.filter("again IS NULL").unionByName(texts.filter("again").dropDuplicates(["id"]))
    owned = _shared(space.table(whole_sets(texts, k), "shingles"), "shingle", space)
    listed = owned.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("owners", "shingle"))).alias("rarest"))
    found = listed.join(classes.select("id", "n", "copies"), "id")
    least = at.needed_whole(F.col("n"))
    found = space.table(
        found.filter(F.size("rarest") >= least).select("id", "n", "copies", F.col("rarest.shingle").alias("shingles")), "sets"
    )
    # Hashes without a second owner come first, so this many of the others can differ, and one more.
    route = found.select("id", F.explode(F.slice("shingles", F.lit(1), (F.size("shingles") - least + 1).cast("int"))).alias("hash"))
    least_id = route.groupBy("hash").agg(F.min("id").alias("to"))
    edges = route.join(least_id, "hash").filter("id <> to").select(F.col("id").alias("a"), F.col("to").alias("b")).distinct()
    blocks = components(edges, space).withColumnsRenamed({"vertex": "id", "component": "block"})
    held = found.join(blocks, "id")
    chunks = held.groupBy("block").agg(F.ceil(F.sum(F.size("shingles")) / chunk).cast("int").alias("chunks"))
    held = held.join(chunks, "block").withColumn("side", F.pmod(F.xxhash64("id"), "chunks").cast("int"))
    # A set goes to every pair of chunks that has its own.
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    held = held.withColumn("other", other).select(
        "block", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "id", "n", "copies", "side", "shingles"
    )

    def search(table: pa.Table) -> pa.Table:
        own_id, n, copies, side = (table[c].to_numpy() for c in ("id", "n", "copies", "side"))
        order = np.argsort(own_id)
        own = table["shingles"].combine_chunks()
        ends, values = own.offsets.to_numpy(), own.values.to_numpy()
        body = [np.sort(values[ends[i] : ends[i + 1]]) for i in order]
        own_id, n, copies, side = own_id[order], n[order], copies[order], side[order]
        cross = table["low"][0].as_py() != table["high"][0].as_py()
        degree, links = block_links(body, n, copies, side if cross else None, at)
        some = np.flatnonzero(degree)
        a = np.concatenate((own_id[[x for x, _ in links]], own_id[some]))
        b = [*own_id[[y for _, y in links]].tolist(), *[None] * len(some)]
        d = [*[None] * len(links), *degree[some].tolist()]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "degree": pa.array(d, pa.int64())})

    # Dealt by chunk pair: else all of a block's pairs would follow its join into one task.
    held = held.repartition("block", "low", "high")
    return space.table(held.groupBy("block", "low", "high").applyInArrow(search, "a long, b long, degree long"), "links")
