"""Visual gaps: validated records, nested targets and their progressive enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import base_name, col
from ..functions.timecode import frame_file, millis_strict, with_hours

KEYS = ["video_id", "file_name"]
RESPONSE = "struct<gaps:array<struct<exact_timestamp:string,context_snippet:string>>>"
TARGETS = "map<string,array<map<string,string>>>"


def normalised(ts: Column | str) -> Column:
    """The timestamp as it is kept: MM:SS gets its hours; empty or absent ones stay."""
    ts = col(ts)
    return F.when(F.coalesce(ts, F.lit("")) == "", ts).otherwise(with_hours(ts))


def is_valid(ts: Column | str, snippet: Column | str) -> Column:
    """Both fields are there, and the timestamp is empty or a time."""
    return col(ts).isNotNull() & col(snippet).isNotNull() & ((col(ts) == "") | millis_strict(ts).isNotNull())


def validate(gaps: DataFrame, strict: bool = False) -> DataFrame:
    """Gaps with normalised timestamps and is_valid; ``strict`` fails the query on the first bad record."""
    ok = is_valid("exact_timestamp", "context_snippet")
    out = gaps.withColumn("is_valid", ok).withColumn("exact_timestamp", normalised("exact_timestamp"))
    if strict:
        bad = F.raise_error(F.concat(F.lit("Invalid gap: "), F.coalesce("exact_timestamp", F.lit("null"))))
        out = out.withColumn("is_valid", F.when(F.col("is_valid"), F.lit(True)).otherwise(bad.cast("boolean")))
    return out


def from_response(responses: DataFrame, json_col: str = "response") -> DataFrame:
    """Gaps of responses (video_id, file_name, response): one row a gap with its index; malformed JSON has none."""
    parsed = responses.select(*KEYS, F.from_json(json_col, RESPONSE)["gaps"].alias("gaps"))
    return parsed.select(*KEYS, F.posexplode("gaps").alias("gap_idx", "g")).select(*KEYS, F.col("gap_idx").cast("bigint"), "g.*")


def explode_targets(targets: DataFrame, json_col: str = "targets") -> DataFrame:
    """Rows of nested targets (video_id, targets JSON); presence of a key counts, even with a null value. A file without gaps has one
    row, with no gap_idx."""
    files = targets.select("video_id", F.posexplode(F.map_entries(F.from_json(json_col, TARGETS))).alias("file_pos", "e"))
    # Of equal file names the last value holds, at the first place.
    files = files.groupBy("video_id", F.col("e.key").alias("file_name")).agg(F.min("file_pos").alias("file_pos"), F.max_by("e.value", "file_pos").alias("gaps"))
    gap = files.select(*KEYS, "file_pos", F.posexplode_outer("gaps").alias("gap_idx", "g"))
    return gap.select(
        *KEYS,
        F.col("file_pos").cast("bigint"),
        F.col("gap_idx").cast("bigint"),
        F.col("g")["exact_timestamp"].alias("exact_timestamp"),
        F.col("g")["context_snippet"].alias("context_snippet"),
        F.col("g")["frame_path"].alias("frame_path"),
        F.col("g")["vlm_description"].alias("vlm_description"),
        F.map_contains_key("g", "vlm_description").alias("has_vlm_description"),
    )


def renest(gaps: DataFrame, fields: list[str]) -> DataFrame:
    """One JSON text a video: {file: [gap, ...]} with gaps by index and files by name. Null fields are left out, but a description that
    is there as a null stays one; a file whose only row has no gap_idx has an empty list."""
    gap = F.to_json(F.struct(*fields))
    if "vlm_description" in fields and "has_vlm_description" in gaps.columns:
        inner = F.substr(gap, F.lit(2), F.length(gap) - 2)
        named = F.concat(F.lit("{"), F.concat_ws(",", F.when(inner != "", inner), F.lit('"vlm_description":null')), F.lit("}"))
        gap = F.when(F.col("has_vlm_description") & F.col("vlm_description").isNull(), named).otherwise(gap)
    one = F.when(F.col("gap_idx").isNotNull(), F.struct("gap_idx", gap.alias("gap")))
    files = gaps.groupBy(*KEYS).agg(F.array_join(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["gap"]), ",").alias("gaps"))
    quoted = F.to_json(F.array("file_name"))
    entry = F.concat(F.substr(quoted, F.lit(2), F.length(quoted) - 2), F.lit(":["), "gaps", F.lit("]"))
    entries = F.transform(F.array_sort(F.collect_list(F.struct("file_name", entry.alias("entry")))), lambda x: x["entry"])
    return files.groupBy("video_id").agg(F.concat(F.lit("{"), F.array_join(entries, ","), F.lit("}")).alias("targets"))


def without_gaps(responses: DataFrame, json_col: str = "response") -> DataFrame:
    """The files of responses that list no gap, as ``renest`` takes them."""
    none = F.lit(None).cast("string")
    empty = responses.filter(F.size(F.from_json(json_col, RESPONSE)["gaps"]) == 0)
    return empty.select(*KEYS, F.lit(None).cast("bigint").alias("gap_idx"), none.alias("exact_timestamp"), none.alias("context_snippet"))


def gap_map(gaps: DataFrame) -> DataFrame:
    """{timestamp: description} of each file: the last description of a timestamp, at the place of its first."""
    some = gaps.filter("has_vlm_description").groupBy(*KEYS, F.col("exact_timestamp").alias("ts"))
    return some.agg(F.min("gap_idx").alias("pos"), F.max_by("vlm_description", "gap_idx").alias("description"))


def with_frames(gaps: DataFrame, directory: str = "frames") -> DataFrame:
    """frame_path, set for every gap whether or not the frame can be decoded, and the ids of its request."""
    return gaps.withColumns(
        {
            "frame_path": F.concat(F.lit(f"{directory}/"), frame_file("video_id", "exact_timestamp")),
            "gap_id": F.concat_ws("_", F.col("video_id").cast("string"), F.col("gap_idx").cast("string")),
            "request_id": F.concat_ws("_", F.col("video_id").cast("string"), base_name("file_name"), F.col("gap_idx").cast("string")),
        }
    )


def frames_ready(gaps: DataFrame, frames: DataFrame) -> DataFrame:
    """Gaps whose frame file is there (frames: frame_path)."""
    return gaps.join(frames.select("frame_path").distinct(), "frame_path", "left_semi")


def frames_missing(gaps: DataFrame, frames: DataFrame) -> DataFrame:
    return gaps.join(frames.select("frame_path").distinct(), "frame_path", "left_anti")


def describe(gaps: DataFrame, answers: DataFrame) -> DataFrame:
    """Gaps with the answers (request_id, response) filled in where they have none yet; answers are stripped."""
    from ..functions.text import strip

    given = answers.select("request_id", strip("response").alias("answer"))
    out = gaps.join(given, "request_id", "left")
    fresh = ~F.col("has_vlm_description") & F.col("answer").isNotNull()
    return out.withColumn("vlm_description", F.when(fresh, F.col("answer")).otherwise(F.col("vlm_description"))).withColumn("has_vlm_description", F.col("has_vlm_description") | fresh).drop("answer")
