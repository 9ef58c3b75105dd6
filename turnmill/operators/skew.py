"""Joins that stay spread out when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def skew_join(
    big: DataFrame, small: DataFrame, key: str, spread: str, limit: int = 500_000
) -> DataFrame:
    """Inner join where ``big`` may hold any number of rows per key.

    Keys with more than ``limit`` rows are split over several salts, and their
    ``small`` rows are repeated once per salt. At most rows / ``limit`` keys can be
    that frequent, which bounds the broadcast table. ``big`` is read more than once, so
    pass a written table.
    """
    if big.count() <= limit:
        return big.join(small, key)
    hot = (
        big.groupBy(key)
        .agg(F.count("*").alias("_n"))
        .filter(F.col("_n") > limit)
        .select(key, F.ceil(F.col("_n") / limit).cast("int").alias("_salts"))
    )
    hot = F.broadcast(hot)
    left = (
        big.join(hot, key, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(spread), F.coalesce("_salts", F.lit(1))).cast("int"))
        .drop("_salts")
    )
    right = (
        small.join(hot, key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
        .drop("_salts")
    )
    return left.join(right, [key, "_salt"]).drop("_salt")


def held_by(df: DataFrame, key: str, ids: DataFrame, n: int) -> DataFrame:
    """The rows of ``df`` whose key may be among ``n`` ids, and all whose key is: a filter before a join.

    The ids become a bitmap of their hashes, 16 bits an id and 8 MB at most, which tasks receive once.
    """
    return _marked(df, key, ids, n, "inner").filter("_hit").select(*df.columns)


def without(df: DataFrame, key: str, ids: DataFrame, n: int) -> DataFrame:
    """The rows of ``df`` whose key is not among ``n`` ids, where most are not: only what may be is shuffled.

    ``df`` is read twice, so pass what is cheap to read; keys are not null.
    """
    if not n:
        return df
    marked = _marked(df, key, ids, n, "left")
    # The key of the join reads the mark: one over the key alone would be moved before the filter, to all rows.
    of, gone = F.when(F.col("_hit"), F.col(key)), ids.select(F.col(ids.columns[0]).alias("_gone"))
    may_be = marked.filter("_hit").withColumn("_of", of).join(gone, F.col("_of") == F.col("_gone"), "left_anti")
    return marked.filter("_hit IS NULL OR NOT _hit").select(*df.columns).unionByName(may_be.select(*df.columns))


def _marked(df: DataFrame, key: str, ids: DataFrame, n: int, how: str) -> DataFrame:
    """Add ``_hit``: the bit of the key's hash in a bitmap of the ids, null or no row (by ``how``) where no id is near."""
    bits = 1 << min(26, max(15, (16 * n).bit_length()))

    def place(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(bits))

    at = place(ids.columns[0])
    held = ids.select(F.shiftright(at, 15).alias("_part"), at.bitwiseAND(32767).alias("_bit"))
    held = F.broadcast(held.groupBy("_part").agg(F.bitmap_construct_agg("_bit").alias("_bits")))
    bit = F.col("_at").bitwiseAND(32767).cast("int")
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
    set_ = F.expr("shiftright(_byte, cast(_at & 7 as int)) & 1") == 1
    placed = df.withColumn("_at", place(key)).withColumn("_part", F.shiftright("_at", 15))
    return placed.join(held, "_part", how).withColumn("_byte", byte).withColumn("_hit", set_)
