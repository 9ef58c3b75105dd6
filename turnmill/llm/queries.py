"""One query per operator over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from turnmill.llm.codebooks import books_digest, compress, with_label_error
from turnmill.llm.decontaminate import contaminated
from turnmill.llm.labelled import fold
from turnmill.llm.langid import identify_languages
from turnmill.llm.mixing import mix_plan
from turnmill.llm.ngram_join import jaccard_components
from turnmill.llm.packing import pack_documents
from turnmill.llm.piece_codec import encode_and_decode
from turnmill.llm.quality import classify_quality
from turnmill.llm.repetition import repetition_rules
from turnmill.llm.resample import resample
from turnmill.llm.secrets import find_secrets
from turnmill.llm.substrings import remove_repeats
from turnmill.llm.toxicity import classify_toxicity

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of documents whose four-word shingles have a Jaccard similarity of 0.85, and their components."""
    return jaccard_components(documents(spark, sf_dir))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the words of 50-word windows that an earlier document has."""
    return remove_repeats(documents(spark, sf_dir))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document; the third of the keys with crc32 remainder 1 is left out of the fit."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classify_toxicity(documents(spark, sf_dir), labels, fold(F.col("doc_id"), 3) == 1)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document; the quarter of the keys with crc32 remainder 2 is left out of the fit."""
    return identify_languages(documents(spark, sf_dir), PIECE_VOCABULARY, fold(F.col("doc_id"), 4) == 2)


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: 150 % of all words, weights 3, 1, 2, at most twice a source."""
    return mix_plan(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op6_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, words in repeated spans and verdict of each document."""
    return repetition_rules(documents(spark, sf_dir)).drop("longest_repeat")


def op7_pack_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids, packed best-fit-decreasing into rows of 2,048."""
    return pack_documents(documents(spark, sf_dir), BYTE_VOCABULARY)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of each document; the fifth of the keys with crc32 divisible by 5 is left out of the fit."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classify_quality(documents(spark, sf_dir), labels, fold(F.col("doc_id"), 5) == 0)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold passages of the benchmark, with up to 8 % of a passage edited."""
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of the fixed forms and random strings in each document."""
    return find_secrets(documents(spark, sf_dir), BYTE_VOCABULARY)


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn by the likeness of their words to the benchmark's."""
    drawn = resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the sentencepiece ids of each document and of the text they decode to."""
    coded = encode_and_decode(documents(spark, sf_dir), PIECE_VOCABULARY)
    return coded.select(
        "doc_id",
        F.floor(F.length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "agrees",
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight-part codes of each vector, their errors, and the digest of the codebooks."""
    coded, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return with_label_error(coded).select(
        "vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_language_id": op4_language_id,
    "op5_mix_sources": op5_mix_sources,
    "op6_repetition_rules": op6_repetition_rules,
    "op7_pack_tokens": op7_pack_tokens,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_decontaminate": op9_decontaminate,
    "op10_secret_scan": op10_secret_scan,
    "op11_resample": op11_resample,
    "op12_piece_codec": op12_piece_codec,
    "op13_vector_codes": op13_vector_codes,
}
