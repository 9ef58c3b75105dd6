"""Paraphrase augmentation: originals plus one row per variant."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from turnmill.functions.parsing import clean_variants


def augment_rows(
    rows: DataFrame,
    responses: DataFrame,
    variants_per_row: int = 2,
    target_role: str = "user",
    key: str = "id",
) -> DataFrame:
    """Union of the rows and their variants, ids ``{id}_aug{j}``.

    ``responses`` (``key, response``) holds the paraphrases of the first turn of
    ``target_role``, one per line. A row without such a turn, or without variants,
    passes through alone. Any rendered ``text`` of a variant is cleared: it would
    still show the original.
    """
    variants = responses.select(
        key, F.posexplode(clean_variants(F.col("response"), variants_per_row)).alias("_j", "_variant")
    )
    target = F.array_position(F.transform("messages", lambda m: m["role"]), F.lit(target_role))

    def with_content(content):
        """The messages with ``content`` as that of the target turn."""
        return F.transform(
            "messages",
            lambda m, i: F.struct(
                m["role"].alias("role"), F.when(i + 1 == F.col("_at"), content).otherwise(m["content"]).alias("content")
            ),
        )

    made = (
        rows.withColumn("_at", F.coalesce(target, F.lit(0)))
        .filter(F.col("_at") > 0)
        # The content that a variant replaces is not shuffled.
        .withColumn("messages", with_content(F.lit(None).cast("string")))
        .join(variants, key)
        .withColumn("_aug_source", F.col(key))
        .withColumn(key, F.concat(F.col(key), F.lit("_aug"), F.col("_j").cast("string")))
        .withColumn("messages", with_content(F.col("_variant")))
        .drop("_at", "_j", "_variant")
    )
    if "text" in rows.columns:
        made = made.withColumn("text", F.lit(None).cast("string"))
    return rows.withColumn("_aug_source", F.lit(None).cast("string")).unionByName(made)


def augment_stats(augmented: DataFrame, variants_per_row: int) -> DataFrame:
    return augmented.agg(
        F.count_if(F.col("_aug_source").isNull()).alias("input_rows"),
        F.count("*").alias("output_rows"),
        F.lit(variants_per_row).alias("variants_per_row"),
    )
