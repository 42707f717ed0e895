"""Which frames still need annotation: anti-joins, batches, merges and progress."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KEY = ["video_id", "frame_key"]


def remaining(index: DataFrame, analysis: DataFrame) -> DataFrame:
    """Index rows without an annotation."""
    return index.join(analysis.select(*KEY), KEY, "left_anti")


def next_batch(left: DataFrame, size: int) -> DataFrame:
    """The first ``size`` remaining frames of one video, by key."""
    _positive(size)
    return left.orderBy("frame_key").limit(size)


def next_batch_per_video(left: DataFrame, size: int) -> DataFrame:
    """The first ``size`` remaining frames of each video, numbered from 1."""
    _positive(size)
    rank = F.row_number().over(Window.partitionBy("video_id").orderBy("frame_key"))
    return left.withColumn("rn", rank.cast("bigint")).filter(F.col("rn") <= size)


def _positive(size: int) -> None:
    if size < 1:
        raise ValueError("a batch has at least one frame")


def labels(batch: DataFrame) -> DataFrame:
    """First and last key, and the label and file names made of them, of each video's batch."""
    ends = batch.groupBy("video_id").agg(F.min("frame_key").alias("first_key"), F.max("frame_key").alias("last_key"), F.count("*").alias("n"))
    label = F.concat("first_key", F.lit("-"), "last_key")
    return ends.withColumn("batch_label", label).withColumns(
        {"prompt_file": F.concat(F.lit("dense_batch_prompt_"), "batch_label", F.lit(".txt")), "response_file": F.concat(F.lit("dense_batch_response_"), "batch_label", F.lit(".json"))}
    )


def previous_description(videos: DataFrame, analysis: DataFrame) -> DataFrame:
    """The description of each video's greatest annotated key; empty if there is none."""
    last = analysis.groupBy("video_id").agg(F.max_by(F.coalesce("description", F.lit("")), "frame_key").alias("d"))
    return videos.select("video_id").distinct().join(last, "video_id", "left").select("video_id", F.coalesce("d", F.lit("")).alias("previous_description"))


def merge(analysis: DataFrame, response: DataFrame) -> DataFrame:
    """Upsert: a response's whole entry takes the place of the stored one; other keys of either side stay."""
    old = analysis.select(*KEY, F.struct("description", "delta").alias("entry"), F.lit(0).alias("turn"))
    new = response.select(*KEY, F.struct("description", "delta").alias("entry"), F.lit(1).alias("turn"))
    return old.unionByName(new).groupBy(*KEY).agg(F.max_by("entry", "turn").alias("entry")).select(*KEY, "entry.*")


def progress(index: DataFrame, analysis: DataFrame) -> DataFrame:
    """Counts by video: total, done, left_by_count (total less done, as foreign keys distort it) and left (by anti-join)."""
    key = index.select(*KEY, F.lit(1).alias("i"))
    done = analysis.select(*KEY, F.lit(1).alias("a"))
    both = key.join(done, KEY, "full_outer")
    return both.groupBy("video_id").agg(
        F.count("i").alias("total"), F.count("a").alias("done"), (F.count("i") - F.count("a")).alias("left_by_count"), F.count(F.when(F.col("i").isNotNull() & F.col("a").isNull(), 1)).alias("left")
    )


def ready(requests: DataFrame, responses: DataFrame, on: list[str]) -> DataFrame:
    return requests.join(responses.select(*on), on, "left_semi")


def pending(requests: DataFrame, responses: DataFrame, on: list[str]) -> DataFrame:
    return requests.join(responses.select(*on), on, "left_anti")
