"""Timelines, transcripts and gaps derived from general tables, for queries over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.timecode import hms, key_of
from .readers import lines


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str, sparse: bool = False) -> DataFrame:
    """Annotated frames: a video a user; keys count a user's events, or (sparse) are the events' ids."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    key = F.col("event_id") if sparse else F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    kinds = {"view": "No change", "purchase": " NO CHANGE ", "click": "Added: click", "error": "Scene change: error", "signup": "Scene start"}
    delta = F.lit(None).cast("string")
    for kind, text in kinds.items():
        delta = F.when(F.col("event_type") == kind, text).otherwise(delta)
    return events.select(F.col("user_id").alias("video_id"), key_of(key).alias("frame_key"), F.concat(F.lit("d"), "event_id").alias("description"), delta.alias("delta"))


def transcript_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WebVTT texts: a video and file a conversation, a cue a turn; neighbouring cues share a second."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    times = F.concat(hms(F.col("turn") * 4), F.lit(".960 --> "), hms(F.col("turn") * 4 + 4), F.lit(".960\n"))
    cue = F.concat((F.col("turn") + 1).cast("string"), F.lit("\n"), times, F.coalesce("text", F.lit("")), F.lit("\n\n"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("turn", cue.alias("c")))), lambda x: x["c"])
    texts = turns.groupBy("conv_id").agg(F.concat(F.lit("WEBVTT\n\n"), F.array_join(ordered, "")).alias("value"))
    return texts.select(F.col("conv_id").alias("video_id"), F.concat(F.col("conv_id").cast("string"), F.lit(".vtt")).alias("file_name"), "value")


def vtt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(transcript_texts(spark, sf_dir))


def scene_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polished texts, in the order of the turns' lengths."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    pos = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.length("text"), "turn")) - 1
    return turns.select(F.col("conv_id").alias("video_id"), pos.cast("bigint").alias("pos"), hms(F.col("turn") * 3).alias("ts"), F.concat(F.lit("s"), "turn").alias("description"))


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps: three turns share a timestamp; odd ones have no hours; every fifth has no description, every seventh an empty one."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    third = F.floor(F.col("turn") / 3)
    ts = F.when(third % 2 == 1, F.substring(hms(third * 9), 4, 5)).otherwise(hms(third * 9))
    return turns.select(
        F.col("conv_id").alias("video_id"),
        F.concat(F.col("conv_id").cast("string"), F.lit(".vtt")).alias("file_name"),
        F.col("turn").alias("gap_idx"),
        ts.alias("exact_timestamp"),
        F.substring("text", 1, 80).alias("context_snippet"),
        F.when(F.col("turn") % 7 == 0, "").otherwise(F.concat(F.lit("g"), "turn")).alias("vlm_description"),
        (F.col("turn") % 5 != 4).alias("has_vlm_description"),
    )


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames to annotate: the documents; a video a source."""
    key = key_of("doc_id")
    return table(spark, sf_dir, "documents").select(F.col("source").alias("video_id"), key.alias("frame_key"), F.concat(F.lit("frames_dense/frame_"), key, F.lit(".jpg")).alias("frame_path"))


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored annotations: the labelled documents, and the labels' own keys as a foreign video."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    rows = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic").join(docs, "doc_id")
    text = F.concat(F.lit("q"), "quality", F.lit("t"), "toxic")
    return rows.select(F.col("source").alias("video_id"), key_of("doc_id").alias("frame_key"), text.alias("description"), F.when(F.col("toxic") == 1, "Scene change").otherwise("No change").alias("delta"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new response: documents with even ids, some of them annotated before."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source").filter("doc_id % 2 = 0")
    return rows.select(F.col("source").alias("video_id"), key_of("doc_id").alias("frame_key"), F.concat(F.lit("r"), "doc_id").alias("description"), F.when(F.col("doc_id") % 3 > 0, F.lit("Added: r")).alias("delta"))
