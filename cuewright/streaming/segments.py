"""Incremental forms: merging annotation batches as they arrive, and online segmentation."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.backlog import merge
from ..sources.readers import ANALYSIS

STATE = "scene_no long, last_key string"
ROWS = "video_id string, frame_key string, delta string, is_change boolean, scene_no long"


def merge_responses(responses: DataFrame, state_path: str, checkpoint: str) -> StreamingQuery:
    """Merge streamed annotations (columns of ANALYSIS) into a versioned state table; a repeated batch changes nothing.

    Each batch writes version ``batch id``; the state before is the version below, so a batch that is run again starts from the
    same state.
    """

    def upsert(batch: DataFrame, number: int) -> None:
        old = state(batch.sparkSession, state_path, number - 1)
        # The last of a batch holds, in the order in which it was read.
        read = batch.select("video_id", "frame_key", F.struct("description", "delta").alias("entry"), F.monotonically_increasing_id().alias("place"))
        last = read.groupBy("video_id", "frame_key").agg(F.max_by("entry", "place").alias("x"))
        merge(old, last.select("video_id", "frame_key", "x.*")).write.mode("overwrite").parquet(f"{state_path}/version={number}")

    return responses.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def state(spark: SparkSession, state_path: str, number: int) -> DataFrame:
    """A version of the state, empty before the first."""
    if number < 0:
        return spark.createDataFrame([], ANALYSIS)
    return spark.read.schema(ANALYSIS).parquet(f"{state_path}/version={number}")


def _online(key: tuple, parts: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
    scene, last = held.get if held.exists else (0, "")
    rows = pd.concat(list(parts)).sort_values("frame_key")
    rows = rows[rows["frame_key"] > last]  # late and repeated frames are for the batch form
    if len(rows):
        change = rows["delta"].fillna("No change").str.strip().str.lower() != "no change"
        opens = change.copy()
        if not scene:
            opens.iloc[0] = True
        numbers = opens.cumsum() + scene
        held.update((int(numbers.iloc[-1]), str(rows["frame_key"].iloc[-1])))
        yield pd.DataFrame({"video_id": key[0], "frame_key": rows["frame_key"], "delta": rows["delta"], "is_change": change, "scene_no": numbers.astype("int64")})


def segment_stream(frames: DataFrame) -> DataFrame:
    """Scene numbers of streamed frames (video_id, frame_key, delta) that arrive in order within a video."""
    keyed = frames.select(F.col("video_id").cast("string"), "frame_key", "delta")
    return keyed.groupBy("video_id").applyInPandasWithState(_online, ROWS, STATE, "append", GroupStateTimeout.NoTimeout)
