"""Queries of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, licenses, mixing, pii, quality, secrets, simhash, tiff, token_counts, toxicity
from .common import read, settle
from .oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = byte_bpe.encode(read(spark, sf_dir, "documents"), decoded=True)
    return out.select(F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


def op3_token_counts(spark: SparkSession, sf_dir: str, cache: str | None = None) -> DataFrame:
    """``cache``: a folder of counts that runs share; the registered query has one of its own and so encodes every content once."""
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), cache=cache).withColumnRenamed("id", "doc_id")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = pii.detect(docs, pii.fit(docs))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        F.col("id").alias("doc_id"),
        *map(count, pii.KINDS),
        F.sha2(pii.as_text(F.col("base")), 256).alias("base_sha256"),
        pii.as_text(pii.merged("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files of a tree: source / thousand / hundred / name; every seventh is named as a licence file."""
    part = lambda n: F.concat(F.lit("d"), F.floor(F.col("doc_id") / n))
    name = F.when(F.pmod("doc_id", F.lit(7)) == 0, F.concat(F.lit("LICENSE-"), "doc_id")).otherwise(F.concat(F.lit("doc-"), "doc_id", F.lit(".txt")))
    path = F.concat_ws("/", "source", part(1000), part(100), name)
    return licenses.scan(read(spark, sf_dir, "documents"), path).withColumnRenamed("id", "doc_id")


def op6_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tiff.text_media(read(spark, sf_dir, "documents"))
    out = tiff.pages(files, "media", ["id", "n_bytes", "media"])
    pixels = F.col("pixels")
    feature = F.concat_ws(";", F.concat_ws("x", "width", "height"), F.concat(F.lit("bits="), "bits"), F.concat(F.lit("scheme="), "scheme"), F.concat(F.lit("predictor="), "predictor"), F.concat_ws("..", "least", "greatest"), F.concat(F.lit("levels="), "levels"), F.concat(F.lit("total="), "total"), F.concat(F.lit("crc="), F.crc32(pixels)))
    return out.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        F.length(pixels).cast("long").alias("payload_bytes"),
        F.sha2(pixels, 256).alias("payload_sha256"),
        F.crc32(F.substr(pixels, F.length(pixels) - 15, F.lit(16))).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        feature.alias("feature"),
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    out = toxicity.score(docs, model, ["doc_id"])
    return out.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted", "toxic_spans")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = secrets.scan(docs, repository=F.concat_ws("/", "source", "lang"), owner=F.col("source"))
    base = F.filter("spans", lambda s: s["place"] < secrets.BASE)
    count = lambda place: F.size(F.filter("spans", lambda s: s["place"] == place)).cast("long")
    return found.select(
        F.col("id").alias("doc_id"),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.as_text(base), 256).alias("base_sha256"),
        secrets.as_text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = settle(mixing.sized(read(spark, sf_dir, "documents")))
    ends, sizes, targets = mixing.plan(docs)
    quota = F.broadcast(spark.createDataFrame([([s], int(sizes[s]), float(targets[s])) for s in targets], "pattern array<string>, source_size long, target double"))
    out = mixing.taken(docs, ends).join(quota, "pattern")
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), simhash.as_hex("fingerprint").alias("fingerprint"), "component_id", "n_others")


QUERIES = {"pipeline": pipeline, "op1_quality": op1_quality, "op2_byte_bpe": op2_byte_bpe, "op3_token_counts": op3_token_counts, "op4_pii": op4_pii, "op5_licenses": op5_licenses, "op6_tiff": op6_tiff, "op7_toxicity": op7_toxicity, "op8_secrets": op8_secrets, "op9_mixing": op9_mixing, "op10_simhash": op10_simhash}
