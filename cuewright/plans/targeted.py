"""The targeted plan: gaps of a transcript are found, illustrated, described and woven in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import gaps, match, render, weave
from ..operators.providers import Status
from .dense import Step


def detect(texts: DataFrame, responses: DataFrame | None) -> Step:
    """Ask for each transcript's gaps, or validate what was found (video_id, file_name, response)."""
    requests = texts.select("video_id", "file_name", render.gap_prompt("value").alias("prompt"))
    if responses is None:
        return Step(Status.PENDING, {}, requests)
    open_ = requests.join(responses.select(*gaps.KEYS), gaps.KEYS, "left_anti")
    if not open_.isEmpty():
        return Step(Status.PENDING, {}, open_)
    return Step(Status.DONE, {"gaps": gaps.validate(gaps.from_response(responses), strict=True)})


def illustrate(found: DataFrame, frames: DataFrame) -> Step:
    """Name each gap's frame; those that are there and those that are missing."""
    named = gaps.with_frames(found)
    return Step(Status.DONE, {"gaps": named, "ready": gaps.frames_ready(named, frames), "missing": gaps.frames_missing(named, frames)})


def describe(ready: DataFrame, provider) -> Step:
    """Describe what has no description yet; pending while answers are missing."""
    open_ = ready.filter(~F.col("has_vlm_description")).withColumn("prompt", render.vlm_prompt("frame_path", "context_snippet"))
    answered, waiting = provider.answer(open_.select("request_id", "prompt", "frame_path"))
    out = gaps.describe(ready, answered.filter("error IS NULL"))
    return Step(Status.DONE if waiting.isEmpty() else Status.PENDING, {"gaps": out, "errors": answered.filter("error IS NOT NULL")}, waiting)


def stitch(found: DataFrame, lines: DataFrame) -> Step:
    """Weave the descriptions before the blank line that ends their cue; files without any are left out."""
    entries = gaps.gap_map(found).withColumn("t", match.millis_strict("ts"))
    matches = match.greedy_match(match.cues_of(lines, strict=True), entries, gaps.KEYS, bucket=64_000)
    some = lines.join(entries.select(*gaps.KEYS).distinct(), gaps.KEYS, "left_semi")
    woven = weave.document(weave.before_blank(some, matches.join(entries, [*gaps.KEYS, "pos"])))
    return Step(Status.DONE, {"matches": matches, "transcripts": woven})
