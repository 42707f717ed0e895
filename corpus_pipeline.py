"""A training corpus out of the documents table: five stages, each read from what the one before has written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuewright.llm import byte_bpe, mixing, secrets, simhash, toxicity
from cuewright.llm.common import drop, read, settle, shared_dir


def _numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The table with columns named by place, so that no column of it clashes with a stage's own; and the names by column."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from the labels of this stage's own input."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    rows, names = _numbered(docs)
    kept = toxicity.score(rows, model, rows.columns, names["text"], clean_only=True)
    return kept.select(rows.columns).toDF(*docs.columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row with the least id stays: those whose fingerprints are near, and those whose sets
    of five-word shingles are similar. Rows are told apart by id and content, so that ids may be null or repeated."""
    rows, names = _numbered(docs)
    own, key = rows.columns, F.col(names["doc_id"])
    content = F.xxhash64(*own, *(F.col(c).isNull() for c in own))  # xxhash64 passes over nulls
    rows = rows.withColumn("row", F.struct(key.isNull().alias("none"), key.alias("id"), content.alias("content")))
    found = simhash.near_duplicates(rows, "row", names["text"], similarity=0.8)
    first = found.filter(F.col("id") == F.col("component_id")).groupBy(F.col("id").alias("kept")).agg(F.count("*").alias("n"))
    kept = rows.join(first, F.col("row").eqNullSafe(F.col("kept")))
    # A row that occurs once needs no further choice; rows that are the same in all columns are reduced to one.
    alone = kept.filter("n = 1").select(own)
    several = kept.filter("n > 1").groupBy("row").agg(F.min(F.struct(*own)).alias("x"))
    return alone.unionByName(several.select("x.*")).toDF(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live secrets are blanked out of the texts; copied examples and all documents stay."""
    out = secrets.redact(docs, repository=F.concat_ws("/", "source", "lang"), owner=F.col("source"))
    return out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.char_length("text").cast(docs.schema["n_chars"].dataType))).select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    ends, _, _ = mixing.plan(settle(mixing.sized(docs)))
    rows, names = _numbered(docs)
    turn = mixing.seeded(names["doc_id"], names["text"], mixing.SEED)
    out = mixing.taken(rows.withColumns({"pattern": F.array(names["source"]), "turn": turn}), ends)
    copies = out.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return copies.select(rows.columns).toDF(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and the digest of what they decode to."""
    out = byte_bpe.encode(docs, decoded=True)
    return out.select(F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


STAGES = [("toxicity", clean), ("simhash", distinct), ("secrets", without_secrets), ("mixing", mixed), ("byte_bpe", encoded)]

#: SimHash components, the fitted model and the seeded hash can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each one's rows are written to the shared folder and read again. What a stage has read goes
    once it is through; the last one's table stays for the caller."""
    docs, at, before = read(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}", None
    for name, stage in STAGES:
        path = f"{at}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop(spark, before)
        before = path
    return docs
