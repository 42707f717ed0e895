"""The dense plan: every second is annotated, segmented, polished and woven into the transcript."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import backlog, match, render, scenes, weave
from ..operators.providers import Status


@dataclass
class Step:
    """What a step leaves: its status, tables by name, and the requests that wait for an answer."""

    status: Status
    tables: dict[str, DataFrame]
    pending: DataFrame | None = None


def annotate(index: DataFrame, analysis: DataFrame, response: DataFrame | None, batch_size: int = 10, root: str | None = None) -> Step:
    """Ask for each video's next batch, or merge a response to it.

    The step is pending while frames are left, counted by anti-join; a response that covers none of its batch is a failure, as
    the same batch would come again for ever.
    """
    left = backlog.remaining(index, analysis)
    batch = backlog.next_batch_per_video(left, batch_size)
    if batch.isEmpty():
        return Step(Status.DONE, {"analysis": analysis})
    prompts = render.batch_prompt(batch, backlog.previous_description(index, analysis), root).join(backlog.labels(batch), "video_id")
    if response is None:
        return Step(Status.PENDING, {"analysis": analysis, "batch": batch}, prompts)
    merged = backlog.merge(analysis, response)
    texts = response.select("video_id", F.concat(F.lit("frames_dense/frame_"), "frame_key", F.lit(".txt")).alias("path"), render.frame_text().alias("content"))
    tables = {"analysis": merged, "frame_texts": texts, "progress": backlog.progress(index, merged)}
    if backlog.ready(batch, response, backlog.KEY).isEmpty():
        return Step(Status.FAILED, tables)
    return Step(Status.DONE if backlog.remaining(index, merged).isEmpty() else Status.PENDING, tables)


def enrich(analysis: DataFrame, lines: DataFrame, scene_map: DataFrame | None, compact: bool = False) -> Step:
    """Segment the annotations; ask for polished texts, or weave them into the transcripts and write the commentary."""
    found = scenes.with_times(scenes.segment(analysis))
    if scene_map is None:
        return Step(Status.PENDING, {"scenes": found}, render.scene_prompt(found))
    entries = match.entries_of(scene_map)
    matches = match.greedy_match(match.cues_of(lines), entries)
    woven = weave.document(weave.after_timing(lines, matches.join(entries, ["video_id", "pos"]), compact))
    return Step(
        Status.DONE,
        {"scenes": found, "matches": matches, "unmatched": match.unmatched(entries, matches), "transcripts": woven, "commentary": render.commentary(scenes.polish(found, scene_map))},
    )


def recapture(analysis: DataFrame, videos: DataFrame, keep_annotations: bool = False) -> DataFrame:
    """Annotations that stay when videos are captured anew: by default none of theirs, as their frames are gone."""
    return analysis if keep_annotations else analysis.join(videos.select("video_id").distinct(), "video_id", "left_anti")
