"""Texts for annotators and readers, as column expressions: prompts, per-frame texts and the commentary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col, or_falsy
from .scenes import capped, meaningful

BATCH_HEAD = (
    "Describe each video frame below in full, then say how it differs from the frame before it. "
    'Answer with one JSON object and nothing else: {"<frame key>": {"description": "<all that is visible>", "delta": "<what is new or gone>"}}, one entry a frame. '
    "delta is exactly No change where nothing is, and Scene start for the first frame of all."
)
#: Words around what a prompt shows.
BEFORE, FIRST, LISTED = "The frame before shows: ", "nothing, as none was described yet", "The frames of this batch:"
SCENE_HEAD = "Write one polished paragraph for each scene below, as JSON from its start time to the paragraph."
GAP_HEAD = "List the moments of this transcript that need the picture to be understood, as JSON {\"gaps\": [{\"exact_timestamp\", \"context_snippet\"}]}."
COMMENTARY_INTRO = "What is shown on screen, scene by scene.\n"


def ordered_text(pieces: str | Column, order: str | Column, separator: str) -> Column:
    """An aggregate that joins pieces by order."""
    items = F.array_sort(F.collect_list(F.struct(col(order).alias("o"), col(pieces).alias("p"))))
    return F.array_join(F.transform(items, lambda x: x["p"]), separator)


def frame_text(description: Column | str = "description", delta: Column | str = "delta") -> Column:
    return F.concat(F.lit("[Description]\n"), F.coalesce(col(description), F.lit("")), F.lit("\n\n[Delta]\n"), F.coalesce(col(delta), F.lit("")), F.lit("\n"))


def batch_prompt(batch: DataFrame, previous: DataFrame, root: str | None = None) -> DataFrame:
    """One prompt a video: the head, the previous description, and the batch's frames (frame_key, frame_path) by key; with the folder
    that holds the videos' folders (``root``) the paths are absolute."""
    path = F.col("frame_path") if root is None else F.concat_ws("/", F.lit(root), "video_id", "frame_path")
    line = F.concat(F.lit("- "), "frame_key", F.lit(": "), path)
    listed = batch.groupBy("video_id").agg(ordered_text(line, "frame_key", "\n").alias("frames"))
    said = or_falsy("previous_description", FIRST)
    return listed.join(previous, "video_id", "left").select(
        "video_id", F.concat(F.lit(f"{BATCH_HEAD}\n\n{BEFORE}"), said, F.lit(f"\n\n{LISTED}\n"), "frames").alias("prompt")
    )


def scene_lines(cap: int = 20) -> Column:
    """The part of a prompt for one scene (columns of ``scenes.with_times``)."""
    said = meaningful("deltas")
    first, more = capped(said, cap)
    items = F.transform(first, lambda d: F.concat(F.lit("\n  - "), d))
    rest = F.when(more > 0, F.concat(F.lit("\n  (further changes: "), more.cast("string"), F.lit(")"))).otherwise("")
    head = F.concat(F.lit("\n["), "start_ts", F.lit(" --> "), "end_ts", F.lit("]\nFirst frame: "), "first_description", F.lit("\nChanges ("), F.size(said).cast("string"), F.lit("):"))
    return F.concat(head, F.array_join(items, ""), rest)


def scene_prompt(scenes: DataFrame, cap: int = 20) -> DataFrame:
    """One prompt a video with all its scenes in order."""
    return scenes.withColumn("part", scene_lines(cap)).groupBy("video_id").agg(F.concat(F.lit(f"{SCENE_HEAD}\n"), ordered_text("part", "scene_no", "\n")).alias("prompt"))


def commentary(scenes: DataFrame) -> DataFrame:
    """One Markdown text a video of scenes with start_ts, duration_s and text (``scenes.polish``)."""
    part = F.concat(F.lit("## ["), "start_ts", F.lit("] Scene "), F.col("scene_no").cast("string"), F.lit(" ("), F.col("duration_s").cast("string"), F.lit("s)\n"), "text", F.lit("\n"))
    head = F.concat(F.lit("# Video Commentary: "), F.col("video_id").cast("string"), F.lit(f"\n\n{COMMENTARY_INTRO}\n"))
    body = scenes.withColumn("part", part).groupBy("video_id").agg(ordered_text("part", "scene_no", "\n").alias("body"))
    return body.select("video_id", F.concat(head, "body").alias("content"))


def gap_prompt(transcript: Column | str) -> Column:
    return F.concat(F.lit(f"{GAP_HEAD}\n\n"), col(transcript))


def vlm_prompt(frame_path: Column | str, context: Column | str) -> Column:
    """The image's line, a blank one, and what to say about it."""
    ask = F.concat(F.lit("Describe what this frame shows that the speaker does not say. Context: "), F.coalesce(col(context), F.lit("")))
    return F.concat(F.lit("Image: "), col(frame_path), F.lit("\n\n"), ask)
