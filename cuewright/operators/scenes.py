"""Change-point segmentation of frame annotations into scenes.

A frame whose delta isn't "no change" opens a scene; so does a video's first frame. One shuffle by video serves the window, the
groups and the ordinals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import col, or_default, strip, whole
from ..functions.timecode import key_to_timestamp

NO_CHANGE, SCENE_START = "no change", "scene start"
CAP = 20


def is_change(delta: Column | str) -> Column:
    """An absent delta is no change; an empty one is a change."""
    return F.lower(strip(or_default(delta, "No change"))) != NO_CHANGE


def flag_changes(frames: DataFrame) -> DataFrame:
    """Frames (video_id, frame_key, description, delta) with delta stripped, is_change and the running scene number."""
    order = Window.partitionBy("video_id").orderBy("frame_key").rowsBetween(Window.unboundedPreceding, 0)
    flagged = frames.withColumn("delta", strip(or_default("delta", "No change"))).withColumn("is_change", is_change("delta"))
    first = F.row_number().over(Window.partitionBy("video_id").orderBy("frame_key")) == 1
    return flagged.withColumn("scene_no", F.sum((F.col("is_change") | first).cast("bigint")).over(order))


def segment(frames: DataFrame) -> DataFrame:
    """Scenes: video_id, scene_no, start_key, end_key, frames, deltas, first_description."""
    members = F.array_sort(F.collect_list(F.struct("frame_key", "delta", "description")))
    grouped = flag_changes(frames).groupBy("video_id", "scene_no").agg(members.alias("m"))
    return grouped.select(
        "video_id",
        "scene_no",
        F.get("m", F.lit(0))["frame_key"].alias("start_key"),
        F.element_at("m", -1)["frame_key"].alias("end_key"),
        F.transform("m", lambda x: x["frame_key"]).alias("frames"),
        F.transform("m", lambda x: x["delta"]).alias("deltas"),
        F.coalesce(F.get("m", F.lit(0))["description"], F.lit("")).alias("first_description"),
    )


def with_times(scenes: DataFrame, offset: int = 0) -> DataFrame:
    """Start and end timecodes and the duration, which counts missing seconds."""
    return scenes.withColumns(
        {
            "start_ts": key_to_timestamp("start_key", offset),
            "end_ts": key_to_timestamp("end_key", offset),
            "duration_s": whole("end_key") - whole("start_key") + 1,
        }
    )


def meaningful(deltas: Column | str) -> Column:
    """The deltas of a list that say something."""
    return F.filter(col(deltas), lambda d: ~F.lower(d).isin(NO_CHANGE, SCENE_START))


def capped(deltas: Column | str, cap: int = CAP) -> tuple[Column, Column]:
    """The first ``cap`` of a list, and how many more there are."""
    return F.slice(col(deltas), 1, cap), F.greatest(F.size(col(deltas)) - cap, F.lit(0)).cast("bigint")


def polish(scenes: DataFrame, scene_map: DataFrame) -> DataFrame:
    """Scenes with ``text``: the polished description of their start time, else their first description."""
    polished = scene_map.groupBy("video_id", F.col("ts").alias("start_ts")).agg(F.max_by("description", "pos").alias("polished"))
    return scenes.join(polished, ["video_id", "start_ts"], "left").withColumn("text", F.coalesce("polished", "first_description")).drop("polished")
