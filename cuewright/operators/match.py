"""One-to-one matches of timed entries to cues, in the order of both.

Cues are taken in file order; each gets the first entry, in map order, that is still free and lies in its closed interval. The
candidates come from a join on the video (and, for whole seconds, on buckets of time); what depends on order is one fold over the
cues of a transcript that have candidates, inside the engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timecode import millis_strict, seconds_lenient

#: Seconds of a bucket of time, and buckets up to which a cue is dealt to each of its own.
BUCKET, BUCKETS = 64, 16
#: The place of longer cues; no time has this bucket.
LONG = -(1 << 62)


def cues_of(lines: DataFrame, strict: bool = False) -> DataFrame:
    """Timing lines with start and end as numbers (seconds, or milliseconds if strict) by video_id, file_name, line_no."""
    from ..functions.timecode import is_timing, timing_part

    unit = millis_strict if strict else seconds_lenient
    parts = lines.filter(is_timing("line")).select("video_id", "file_name", "line_no", timing_part("line", 1).alias("start_ts"), timing_part("line", 2).alias("end_ts"))
    return parts.select("video_id", "file_name", "line_no", unit("start_ts").alias("start_t"), unit("end_ts").alias("end_t"))


def entries_of(scene_map: DataFrame, strict: bool = False) -> DataFrame:
    """Map entries (video_id, pos, ts, description) with their time as a number; of equal keys the last value at the first place."""
    unit = millis_strict if strict else seconds_lenient
    once = scene_map.groupBy("video_id", "ts").agg(F.min("pos").alias("pos"), F.max_by("description", "pos").alias("description"))
    return once.withColumn("t", unit("ts"))


def interval_pairs(cues: DataFrame, entries: DataFrame, on: list[str] | None = None, bucket: int = BUCKET) -> DataFrame:
    """All pairs of a cue and an entry in its closed interval: an equi-join on the keys and a bucket of time, so long videos spread.

    A cue over more than ``BUCKETS`` buckets stands once, in a place (``LONG``) that every entry of its video is dealt to, too.
    """
    on = on or ["video_id"]
    spans = cues.filter(F.col("start_t") <= F.col("end_t"))
    first, last = F.floor(F.col("start_t") / bucket), F.floor(F.col("end_t") / bucket)
    usual = last - first < BUCKETS
    own = F.when(usual, F.sequence(first, F.when(usual, last).otherwise(first))).otherwise(F.array(F.lit(LONG)))
    wide = spans.withColumn("bucket", F.explode(own))
    points = entries.filter(F.col("t").isNotNull()).withColumn("bucket", F.explode(F.array(F.floor(F.col("t") / bucket), F.lit(LONG))))
    return wide.join(points, [*on, "bucket"]).filter(F.col("t").between(F.col("start_t"), F.col("end_t"))).drop("bucket")


def _fold(cues: Column) -> Column:
    """Assignments (line_no, pos) of cues [(line_no, candidates [pos])]: each takes its first candidate that isn't taken."""
    none = F.array().cast("array<struct<line_no:bigint,pos:bigint>>")

    def step(acc, cue):
        free = F.array_except(cue["candidates"], acc["used"])
        pos = F.get(free, F.lit(0))
        hit = pos.isNotNull()
        return F.struct(
            F.when(hit, F.array_append(acc["used"], pos)).otherwise(acc["used"]).alias("used"),
            F.when(hit, F.array_append(acc["out"], F.struct(cue["line_no"].alias("line_no"), pos.alias("pos")))).otherwise(acc["out"]).alias("out"),
        )

    start = F.struct(F.array().cast("array<bigint>").alias("used"), none.alias("out"))
    return F.aggregate(cues, start, step, lambda acc: acc["out"])


def greedy_match(cues: DataFrame, entries: DataFrame, on: list[str] | None = None, bucket: int = BUCKET) -> DataFrame:
    """video_id, file_name, line_no, pos of the matches; no cue and no entry of a file is used twice."""
    pairs = interval_pairs(cues, entries, on, bucket)
    by_cue = pairs.groupBy("video_id", "file_name", "line_no").agg(F.array_sort(F.collect_set("pos")).alias("candidates"))
    by_file = by_cue.groupBy("video_id", "file_name").agg(F.array_sort(F.collect_list(F.struct("line_no", "candidates"))).alias("cues"))
    return by_file.select("video_id", "file_name", F.explode(_fold(F.col("cues"))).alias("m")).select("video_id", "file_name", "m.*")


def unmatched(entries: DataFrame, matches: DataFrame) -> DataFrame:
    """Entries that no cue of their video took."""
    return entries.join(matches.select("video_id", "pos").distinct(), ["video_id", "pos"], "left_anti")
