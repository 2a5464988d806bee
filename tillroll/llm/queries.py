"""One registered query per operator: the operator over its whole table,
reduced to the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import (
    context_mixing,
    exact_dedup,
    hyperminhash,
    license_scan,
    mil_quality,
    packing,
    phrases,
    piece_sampling,
    relative_parse,
    secret_scan,
    token_store,
    whitening,
    winnowing,
)
from tillroll.sources.tables import read_table


def vocabulary(name: str) -> str:
    """A public vocabulary's file; the package is installed on every node."""
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_digest(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), end_id=2)


def op2_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.score_texts(documents(spark, sf_dir))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir)).drop("detections")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), end_id=0)
    return packing.with_checksums(pieces)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), read_table(spark, sf_dir, "labels")
    model = mil_quality.learn(docs, labels, usable=~mil_quality.held_out())
    return mil_quality.quality_scores(docs, model).select(
        "doc_id", mil_quality.held_out().alias("held_out"), "score",
        (F.col("score") >= mil_quality.ACCEPT).cast("int").alias("predicted"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.secret_spans(documents(spark, sf_dir)))


def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edit_likeness(documents(spark, sf_dir))


def op8_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_groups(documents(spark, sf_dir), k=3, percent=85)


def op9_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("piece_bpe_32k.model")
    pieces = piece_sampling.sample_pieces(documents(spark, sf_dir), path)
    decoded_sha256 = F.sha2(F.col("text").cast("binary"), 256)
    return piece_sampling.decode_pieces(pieces, path).select(
        "doc_id", "n_pieces", "ids_crc32", decoded_sha256.alias("decoded_sha256"),
        (decoded_sha256 == F.col("text_sha256")).alias("lossless"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(read_table(spark, sf_dir, "embeddings"))


def op12_relative_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relative_parse.removal_digest(documents(spark, sf_dir))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_store": op1_token_store,
    "op2_context_mixing": op2_context_mixing,
    "op3_license_scan": op3_license_scan,
    "op4_packing": op4_packing,
    "op5_quality": op5_quality,
    "op6_secret_scan": op6_secret_scan,
    "op7_winnowing": op7_winnowing,
    "op8_hyperminhash": op8_hyperminhash,
    "op9_piece_sampling": op9_piece_sampling,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_whitening": op11_whitening,
    "op12_relative_parse": op12_relative_parse,
    "op13_phrases": op13_phrases,
}
