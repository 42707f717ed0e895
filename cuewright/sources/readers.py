"""Readers of transcripts, JSON state, responses, images and videos."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import base_name, parent, strip
from ..functions.timecode import frame_key_of_name

ANALYSIS = T.StructType([T.StructField(c, T.StringType()) for c in ("video_id", "frame_key", "description", "delta")])
BREAKS = r"\r\n|\r|\n"


def texts(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Whole texts: path, file_name, video_id (the name of the folder) and value."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    raw = reader.text(path, wholetext=True)
    place = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return raw.select(place.alias("path"), base_name(place).alias("file_name"), base_name(parent(place)).alias("video_id"), "value")


def transcripts(spark: SparkSession, path: str, rule: str = "dense") -> DataFrame:
    """Transcripts that aren't outputs: by the dense rule no name holds _enriched or _final, by the targeted one none ends so."""
    return texts(spark, path, "*.vtt").filter(is_transcript("file_name", rule))


def is_transcript(name: Column | str, rule: str = "dense") -> Column:
    """The dense rule looks into the file's name only, so a folder's name can't hide its transcripts."""
    name = F.col(name) if isinstance(name, str) else name
    if rule == "dense":
        return F.endswith(name, F.lit(".vtt")) & ~F.contains(name, F.lit("_enriched")) & ~F.contains(name, F.lit("_final"))
    if rule == "targeted":
        return F.endswith(name, F.lit(".vtt")) & ~F.endswith(name, F.lit("_enriched.vtt"))
    raise ValueError(f"rule {rule!r}")


def lines(files: DataFrame, text_col: str = "value") -> DataFrame:
    """Lines in order, each with a final newline but for a last one that has none; line breaks of all kinds become newlines."""
    parts = F.split(text_col, BREAKS, -1)
    n = F.size(parts)
    ended = F.transform(parts, lambda x, i: F.when(i < n - 1, F.concat(x, F.lit("\n"))).otherwise(x))
    held = F.filter(ended, lambda x: x != "")
    return files.select("video_id", "file_name", F.posexplode(held).alias("line_no", "line")).select("video_id", "file_name", F.col("line_no").cast("bigint"), "line")


def map_entries(files: DataFrame, value_type: str = "string", text_col: str = "value") -> DataFrame:
    """Entries of one JSON object a file by place: video_id, pos, key, value. Of equal keys the last value, at the first place."""
    entries = F.map_entries(F.from_json(text_col, f"map<string,{value_type}>"))
    rows = files.select("video_id", F.posexplode(entries).alias("pos", "e")).select("video_id", F.col("pos").cast("bigint"), "e.key", "e.value")
    return rows.groupBy("video_id", "key").agg(F.min("pos").alias("pos"), F.max_by("value", "pos").alias("value"))


def frame_index(files: DataFrame) -> DataFrame:
    """video_id, frame_key, frame_path of JSON objects {key: path}."""
    return map_entries(files).select("video_id", F.col("key").alias("frame_key"), F.col("value").alias("frame_path"))


def analysis(files: DataFrame) -> DataFrame:
    """video_id, frame_key, description, delta of JSON objects {key: {description, delta}}."""
    rows = map_entries(files, "struct<description:string,delta:string>")
    return rows.select("video_id", F.col("key").alias("frame_key"), "value.description", "value.delta")


def analysis_or_empty(spark: SparkSession, path: str) -> DataFrame:
    """The stored annotations, or none where there is no such file."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], ANALYSIS)
    return analysis(texts(spark, path))


def scene_map(files: DataFrame) -> DataFrame:
    """video_id, pos, ts, description of JSON objects {HH:MM:SS: text}, in their order."""
    return map_entries(files).select("video_id", "pos", F.col("key").alias("ts"), F.col("value").alias("description"))


def responses(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """Text responses, stripped: request_id (the file's name without extension) and response."""
    from ..functions.text import stem

    return texts(spark, path, glob).select(stem("file_name").alias("request_id"), strip("value").alias("response"))


def images(spark: SparkSession, path: str, glob: str = "*.jpg") -> DataFrame:
    """Frames of folders: video_id is the folder's folder; frame_path, frame_key, content."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    at = F.col("path")
    return raw.select(base_name(parent(parent(at))).alias("video_id"), at.alias("frame_path"), frame_key_of_name(base_name(at)).alias("frame_key"), "content")


def videos(spark: SparkSession, path: str, rule: str = "dense") -> DataFrame:
    """The first video of each folder by name: video_id, path, content.

    By the dense rule an .mp4 that isn't hidden; by the targeted one a file named after its folder that is no text or state.
    """
    raw = spark.read.format("binaryFile").load(path)
    name, folder = base_name("path"), base_name(parent("path"))
    if rule == "dense":
        fit = F.endswith(name, F.lit(".mp4")) & ~F.startswith(name, F.lit("."))
    elif rule == "targeted":
        fit = F.startswith(name, folder) & ~name.rlike(r"\.(json|vtt|txt)$")
    else:
        raise ValueError(f"rule {rule!r}")
    files = raw.filter(fit).select(folder.alias("video_id"), "path", "content")
    first = files.groupBy("video_id").agg(F.min("path").alias("path"))
    return files.join(first, ["video_id", "path"], "left_semi")
