"""Capturing frames: every second of a video, or the frames that gaps ask for."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import providers
from ..operators.providers import Status
from .dense import Step


def to_capture(videos: DataFrame, index: DataFrame, again: bool = False) -> DataFrame:
    """Videos without an index, or all of them."""
    return videos if again else videos.join(index.select("video_id").distinct(), "video_id", "left_anti")


def dense(videos: DataFrame, decoder: Callable[[bytes], Iterator[tuple[int, bytes]]]) -> Step:
    """Frames and index of videos (video_id, content); a video that can't be decoded is an error row."""
    frames = providers.decode_frames(videos, decoder)
    good = frames.filter("error IS NULL")
    return Step(Status.DONE, {"frames": good, "index": good.select("video_id", "frame_key", "frame_path"), "errors": frames.filter("error IS NOT NULL")})


def targeted(gaps: DataFrame, videos: DataFrame, existing: DataFrame, seek: Callable[[bytes, str], bytes]) -> Step:
    """Frames of gaps (video_id, exact_timestamp, frame_path) that aren't there yet, by ``seek(video, timestamp)``.

    The videos' bytes meet the gaps once a video, not once a gap; each gap has its own error.
    """
    open_ = gaps.join(existing.select("frame_path").distinct(), "frame_path", "left_anti").dropDuplicates(["video_id", "frame_path"])
    asked = open_.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("frame_path", "exact_timestamp"))).alias("asked"))

    def run(parts):
        for part in parts:
            for row in part.to_dict("records"):
                rows = []
                for one in row["asked"]:
                    try:
                        rows.append((row["video_id"], one["frame_path"], seek(row["content"], one["exact_timestamp"]), None))
                    except Exception as e:
                        rows.append((row["video_id"], one["frame_path"], None, f"{type(e).__name__}: {e}"))
                yield pd.DataFrame(rows, columns=["video_id", "frame_path", "content", "error"])

    kind = gaps.schema["video_id"].dataType.simpleString()
    frames = asked.join(videos.select("video_id", "content"), "video_id").mapInPandas(run, f"video_id {kind}, frame_path string, content binary, error string")
    return Step(Status.DONE, {"frames": frames.filter("error IS NULL"), "errors": frames.filter("error IS NOT NULL")})
