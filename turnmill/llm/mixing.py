"""Mixing sources to target weights.

Word counts are summed per source; the small table of sources gets targets and repetition rates;
each document is then taken floor(rate) times, and once more if the hash of its key and text draws below the fraction.
All steps are SQL expressions. The sources are joined by value without a hint, so that their size
decides between a broadcast and a shuffle, and a hot source never meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import AtomicType, VariantType

from turnmill.workspace import Workspace

WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sources: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Targets for rows (source, source_size): ``share`` of all sizes, dealt by weight.

    Sources take the weights in turn, by code point, null last. No target is above ``most`` times
    its source's size; what is left over is dealt again by weight among the others, which ends at
    one level of target per weight. With caps in order of cap / weight, the level is that of the
    first source whose cap lies above what the rest then share.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    deal = F.array(*[F.lit(float(w)) for w in weights])
    by_need = Window.orderBy("need", "turn")
    rest = by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    ranked = (
        sources.withColumn("turn", turn)
        .withColumn("weight", F.element_at(deal, (F.col("turn") % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("need", F.col("cap") / F.col("weight"))
        .withColumn("whole", F.sum("source_size").over(everything) * F.lit(float(share)))
    )
    left = F.col("whole") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    leveled = ranked.withColumn("level", left / F.sum("weight").over(rest)).withColumn(
        "level", F.max(F.when(F.col("need") > F.col("level"), F.col("level"))).over(everything)
    )
    return leveled.select(
        "source", "source_size", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target")
    )


def draw(key: Column, seed: str, digest: Column, nth: Column) -> Column:
    """A number in [0, 1) from seed, key, the text's digest and which of several equal rows it is."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), digest, F.lit(":"), nth.cast("string"))
    return F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _sized(docs: DataFrame, key: str, text: str, source: str, *more: Column) -> DataFrame:
    return docs.select(
        docs[key].alias("doc_id"),
        docs[source].alias("source"),
        F.coalesce(F.regexp_count(docs[text], F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.coalesce(docs[text], F.lit("")).cast("binary")).alias("digest"),
        *more,
    )


def _numbered(rows: DataFrame, n: str, block: int = 65_536) -> DataFrame:
    """Each row ``n`` times, with ``nth`` from 0. Long runs are dealt over the tasks block by block."""
    last = F.floor((F.col(n) - 1) / block)
    blocks = rows.withColumn("from", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), last), lambda i: i * block)))
    return (
        blocks.repartition("doc_id", "digest", "from")
        .withColumn("nth", F.explode(F.sequence(F.col("from"), F.least(F.col("from") + block, F.col(n)) - 1)))
        .drop("from", n)
    )


def mix_plan(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix", **options) -> DataFrame:
    """One row per document: size, source_size, target, copies and the words taken.

    Null and empty texts have size 0; documents without a source form a source of their own. The draw
    depends on seed, key and text, and rows equal in all of these and their source are numbered, so rows
    that repeat a key or have none draw apart, and reruns agree. Empty input gives no rows.
    """
    # Equal rows combine before the shuffle and are told apart by number only.
    rows = _sized(docs, key, text, source).groupBy("doc_id", "source", "size", "digest").agg(F.count("*").alias("n"))
    rows = Workspace(docs.sparkSession).table(rows, "sized")
    sources = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    one = rows.filter("n = 1").drop("n").withColumn("nth", F.lit(0).cast("long"))
    return _copies(one.unionByName(_numbered(rows.filter("n > 1"), "n")), source_targets(sources, **options), seed).drop("digest", "nth")


def _copies(sized: DataFrame, targets: DataFrame, seed: str) -> DataFrame:
    targets = targets.withColumnRenamed("source", "target_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    once_more = draw(F.col("doc_id"), seed, F.col("digest"), F.col("nth")) < F.col("rate") - F.floor("rate")
    return (
        sized.join(targets, F.col("source").eqNullSafe(F.col("target_source")))
        .drop("target_source")
        .withColumn("rate", rate)
        .withColumn("copies", F.floor("rate") + once_more.cast("long"))
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def mix_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix", **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with their own columns.

    Rows that are equal throughout are numbered for their draws, as in :func:`mix_plan`; columns that cannot be
    compared (maps, variants) are left out of that comparison.
    """
    space = Workspace(docs.sparkSession)
    plain = [docs[f.name] for f in docs.schema.fields if isinstance(f.dataType, AtomicType) and not isinstance(f.dataType, VariantType)]
    look = F.xxhash64(*plain).alias("look")
    narrow = _sized(docs, key, text, source, look).groupBy("doc_id", "source", "size", "digest", "look").agg(F.count("*").alias("n"))
    narrow = space.table(narrow, "sized")
    sources = narrow.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    # Rows of one key, source and text are numbered through, equal ones next to each other.
    alike = Window.partitionBy("doc_id", "source", "digest")
    before = F.sum("n").over(alike.orderBy("look").rowsBetween(Window.unboundedPreceding, -1))
    again = narrow.withColumn("total", F.sum("n").over(alike)).withColumn("before", F.coalesce(before, F.lit(0))).filter("total > 1")
    again = space.table(again.select(F.col("doc_id").alias("own"), F.col("digest").alias("own_digest"), F.col("look").alias("own_look"), "before"), "again")
    held = _sized(docs, key, text, source, look, F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    first = F.lit(0).cast("long").alias("nth")
    columns = ["doc_id", "source", "size", "digest", "row"]
    if again.isEmpty():
        numbered = held.select(*columns, first)
    else:
        same = F.col("doc_id").eqNullSafe(F.col("own")) & (F.col("digest") == F.col("own_digest")) & (F.col("look") == F.col("own_look"))
        grouped = held.join(again, same).groupBy("doc_id", "source", "size", "digest", "look")
        often = grouped.agg(F.count("*").alias("n"), F.first("row").alias("row"), F.first("before").alias("before")).drop("look")
        often = _numbered(often, "n").withColumn("nth", F.col("nth") + F.col("before")).drop("before")
        numbered = held.join(again, same, "left_anti").select(*columns, first).unionByName(often)
    taken = _copies(numbered, source_targets(sources, **options), seed)
    return taken.select(F.col("row"), F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")
