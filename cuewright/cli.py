"""Command line: the same steps over folders of one or more videos.

    python -m cuewright.cli run DATA --url URL | --video-id ID    the dense steps in turn: download, capture, analyze, enrich
    python -m cuewright.cli download DATA --url URL
    python -m cuewright.cli capture DATA [--recapture]
    python -m cuewright.cli analyze DATA --batch-size 10
    python -m cuewright.cli enrich DATA
    python -m cuewright.cli gaps DATA [--provider table|openai|gemini]
    python -m cuewright.cli frames DATA
    python -m cuewright.cli describe DATA [--provider table|openai|gemini]
    python -m cuewright.cli stitch DATA

Exit codes: 0 done, 1 failed, 10 an answer is needed.

DATA holds a folder a video, each with dense_index.json, transcripts and the state files named below.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import gaps as gap_ops
from .operators import providers, remote
from .operators.providers import Settings, Status
from .plans import capture as capture_plan
from .plans import dense, targeted
from .sources import readers, sinks


def capture(spark: SparkSession, data: str, again: bool = False, decoder=None) -> Status:
    """Frames and index of videos that have none; captured anew, a video loses its annotations too."""
    found = _files(spark, data, "dense_index.json")
    index = readers.frame_index(found) if found is not None else spark.createDataFrame([], "video_id string, frame_key string, frame_path string")
    todo = capture_plan.to_capture(readers.videos(spark, f"{data}/*"), index, again)
    if todo.isEmpty():
        return Status.DONE
    step = capture_plan.dense(todo, decoder or providers.ffmpeg_decoder())
    sinks.clear(todo.select(F.concat_ws("/", "video_id", F.lit("frames_dense")).alias("path")), data)
    path = F.concat_ws("/", "video_id", "frame_path")
    sinks.write_files(step.tables["frames"].select(path.alias("path"), "content"), data)
    if again:
        state = _files(spark, data, "dense_analysis.json")
        if state is not None:
            sinks.write_files(todo.join(state, "video_id", "left_semi").select(F.concat_ws("/", "video_id", F.lit("dense_analysis.json")).alias("path"), F.lit("{}").alias("content")), data)
    listed = readers.images(spark, f"{data}/*/frames_dense").join(todo, "video_id", "left_semi")
    named = listed.select("video_id", "frame_key", F.concat(F.lit("frames_dense/frame_"), "frame_key", F.lit(".jpg")).alias("frame_path"))
    index = sinks.json_map(named, "frame_key", "frame_path")
    sinks.write_files(index.select(F.concat_ws("/", "video_id", F.lit("dense_index.json")).alias("path"), "content"), data)
    return Status.DONE if step.tables["errors"].isEmpty() else Status.FAILED


def analyze(spark: SparkSession, data: str, batch_size: int) -> Status:
    """Merge each video's answered batches, then ask for the next."""
    index = readers.frame_index(readers.texts(spark, f"{data}/*/dense_index.json"))
    state = _files(spark, data, "dense_analysis.json")
    analysis = readers.analysis(state) if state is not None else spark.createDataFrame([], readers.ANALYSIS)
    step = dense.annotate(index, analysis, None, batch_size, os.path.abspath(data.removeprefix("file://")))
    if step.status is Status.DONE:
        return step.status
    # The prompt is written on every run, also where its answer is there already.
    sinks.write_files(step.pending.select(F.concat_ws("/", "video_id", "prompt_file").alias("path"), F.col("prompt").alias("content")), data)
    files = _files(spark, data, "dense_batch_response_*.json")
    labels = step.pending.select("video_id", F.col("response_file").alias("file_name"))
    answers = files.join(labels, ["video_id", "file_name"], "left_semi") if files is not None else None
    if answers is None or answers.isEmpty():
        return Status.PENDING
    done = dense.annotate(index, analysis, readers.analysis(answers), batch_size)
    texts = done.tables["frame_texts"]
    sinks.write_files(texts.select(F.concat_ws("/", "video_id", "path").alias("path"), "content"), data)
    merged = done.tables["analysis"]
    out = sinks.json_map(merged, "frame_key", F.struct("description", "delta"))
    sinks.write_files(out.select(F.concat_ws("/", "video_id", F.lit("dense_analysis.json")).alias("path"), "content"), data)
    return done.status


def enrich(spark: SparkSession, data: str) -> Status:
    analysis = readers.analysis(readers.texts(spark, f"{data}/*/dense_analysis.json"))
    lines = readers.lines(readers.transcripts(spark, f"{data}/*"))
    answer = _files(spark, data, "dedup_response.json")
    step = dense.enrich(analysis, lines, readers.scene_map(answer) if answer is not None else None)
    if step.status is Status.PENDING:
        sinks.write_files(step.pending.select(F.concat_ws("/", "video_id", F.lit("dedup_prompt.txt")).alias("path"), F.col("prompt").alias("content")), data)
        return step.status
    _write_transcripts(step.tables["transcripts"], data)
    sinks.write_files(step.tables["commentary"].select(F.concat_ws("/", "video_id", F.lit("video_commentary.md")).alias("path"), "content"), data)
    return step.status


def find_gaps(spark: SparkSession, data: str, settings: Settings | None = None) -> Status:
    texts = readers.transcripts(spark, f"{data}/*", "targeted")
    answer, response = _files(spark, data, "gaps_response_*.json"), None
    if settings and settings.provider != "table":
        asked = targeted.detect(texts, None).pending
        response, _ = providers.Callback(remote.gaps(settings)).answer(asked)
        if not response.filter("error IS NOT NULL").isEmpty():
            return Status.FAILED
    elif answer is not None:
        name = F.concat(F.regexp_extract("file_name", r"^gaps_response_(.*)\.json$", 1), F.lit(".vtt"))
        response = answer.select("video_id", name.alias("file_name"), F.col("value").alias("response"))
    step = targeted.detect(texts, response)
    if step.status is Status.PENDING:
        name = F.concat(F.lit("gaps_prompt_"), F.regexp_replace("file_name", r"\.vtt$", ""), F.lit(".txt"))
        sinks.write_files(step.pending.select(F.concat_ws("/", "video_id", name).alias("path"), F.col("prompt").alias("content")), data)
        return step.status
    fields = ["exact_timestamp", "context_snippet"]
    out = gap_ops.renest(step.tables["gaps"].select(*gap_ops.KEYS, "gap_idx", *fields).unionByName(gap_ops.without_gaps(response)), fields)
    sinks.write_files(out.select(F.concat_ws("/", "video_id", F.lit("targets.json")).alias("path"), F.col("targets").alias("content")), data)
    return step.status


def _targets(spark: SparkSession, data: str):
    return gap_ops.explode_targets(readers.texts(spark, f"{data}/*/targets.json").select("video_id", F.col("value").alias("targets")))


_FIELDS = ["exact_timestamp", "context_snippet", "frame_path", "vlm_description"]


def _write_targets(found, data: str) -> None:
    out = gap_ops.renest(found, _FIELDS)
    sinks.write_files(out.select(F.concat_ws("/", "video_id", F.lit("targets.json")).alias("path"), F.col("targets").alias("content")), data)


def extract(spark: SparkSession, data: str, seek=None) -> Status:
    """Frames of the gaps; a gap keeps its frame's path even where decoding failed, and only readiness looks at the file."""
    named = gap_ops.with_frames(_targets(spark, data), "frames")
    there = _files_of(spark, f"{data}/*/frames", "*.jpg")
    step = capture_plan.targeted(named.filter("gap_idx IS NOT NULL"), readers.videos(spark, f"{data}/*", "targeted"), there, seek or providers.ffmpeg_seek())
    sinks.write_files(step.tables["frames"].select(F.concat_ws("/", "video_id", "frame_path").alias("path"), "content"), data)
    _write_targets(named, data)
    return Status.DONE


def describe(spark: SparkSession, data: str, settings: Settings | None = None) -> Status:
    """Descriptions of the gaps whose frame is there; what was answered is kept while others wait."""
    named = gap_ops.with_frames(_targets(spark, data), "frames")
    there = _files_of(spark, f"{data}/*/frames", "*.jpg")
    ready = gap_ops.frames_ready(named, there)
    if settings and settings.provider != "table":
        images = readers.images(spark, f"{data}/*/frames").select(F.concat(F.lit("frames/"), F.substring_index("frame_path", "/", -1)).alias("frame_path"), "content")
        provider = _WithImages(providers.Callback(remote.describe(settings), content_col="content"), images)
    else:
        empty = spark.createDataFrame([], "request_id string, response string")
        given = _files(spark, data, "vlm_response_*.txt")
        provider = providers.ResponseTable(empty if given is None else given.select(F.regexp_extract("file_name", r"^vlm_response_(.*)\.txt$", 1).alias("request_id"), F.col("value").alias("response")))
    step = targeted.describe(ready, provider)
    if step.status is Status.PENDING:
        waiting = step.pending.join(ready.select("request_id", "video_id"), "request_id")
        sinks.write_files(waiting.select(F.concat(F.col("video_id"), F.lit("/vlm_prompt_"), "request_id", F.lit(".txt")).alias("path"), F.col("prompt").alias("content")), data)
    missing = gap_ops.frames_missing(named, there)
    _write_targets(step.tables["gaps"].unionByName(missing), data)
    return step.status


class _WithImages:
    def __init__(self, provider, images):
        self.provider, self.images = provider, images

    def answer(self, requests):
        return self.provider.answer(requests.join(self.images, "frame_path"))


def fetch(data: str, url: str | None) -> Status:
    """A video and its captions into the folder of its id."""
    video = remote.remote_video_id(url) if url else None
    return Status.DONE if video and remote.download(url, os.path.join(data, video)) else Status.FAILED


def run(spark: SparkSession, data: str, url: str | None, batch_size: int, again: bool) -> Status:
    """The dense steps in turn; stops where one fails or waits."""
    if url and fetch(data, url) is not Status.DONE:
        return Status.FAILED
    for step in (lambda: capture(spark, data, again), lambda: analyze(spark, data, batch_size), lambda: enrich(spark, data)):
        status = step()
        if status is not Status.DONE:
            return status
    return Status.DONE


def stitch(spark: SparkSession, data: str) -> Status:
    targets = readers.texts(spark, f"{data}/*/targets.json").select("video_id", F.col("value").alias("targets"))
    lines = readers.lines(readers.transcripts(spark, f"{data}/*", "targeted"))
    step = targeted.stitch(gap_ops.explode_targets(targets), lines)
    _write_transcripts(step.tables["transcripts"], data)
    return step.status


def _files(spark: SparkSession, data: str, glob: str):
    """Texts of a kind in the videos' folders, or None if there are none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{data}/*/{glob}")
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return readers.texts(spark, f"{data}/*/{glob}") if found else None


def _files_of(spark: SparkSession, path: str, glob: str):
    """Paths of files as they stand in targets: folder and name."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{glob}")
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at):
        return spark.createDataFrame([], "frame_path string")
    listed = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path")
    return listed.select(F.concat_ws("/", F.element_at(F.split("path", "/"), -2), F.element_at(F.split("path", "/"), -1)).alias("frame_path"))


def _write_transcripts(woven, data: str) -> None:
    path = F.concat_ws("/", "video_id", sinks.output_name("file_name"))
    sinks.write_files(woven.select(path.alias("path"), "content"), data)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="cuewright")
    parser.add_argument("step", choices=["run", "download", "capture", "analyze", "enrich", "gaps", "frames", "describe", "stitch"])
    parser.add_argument("data")
    source = parser.add_mutually_exclusive_group()
    source.add_argument("--url")
    source.add_argument("--video-id")
    parser.add_argument("--provider", choices=["table", "openai", "gemini"], default=None)
    parser.add_argument("--batch-size", type=int, default=10)
    parser.add_argument("--recapture", action="store_true")
    args = parser.parse_args(argv)
    if args.batch_size < 1:
        parser.error("a batch has at least one frame")
    if args.step == "run" and not (args.url or args.video_id):
        parser.error("run needs --url or --video-id")
    if not os.path.isdir(os.path.join(args.data.removeprefix("file://"), args.video_id or "")):
        print(f"no folder {args.data}", file=sys.stderr)
        return Status.FAILED
    if args.step == "download":
        return int(fetch(args.data, args.url))
    spark = spark or SparkSession.builder.appName("cuewright").getOrCreate()
    settings = Settings.from_env({**providers.read_env(), **os.environ, **({"LLM_PROVIDER": args.provider} if args.provider else {})})
    steps = {
        "run": lambda: run(spark, args.data, args.url, args.batch_size, args.recapture),
        "capture": lambda: capture(spark, args.data, args.recapture),
        "analyze": lambda: analyze(spark, args.data, args.batch_size),
        "enrich": lambda: enrich(spark, args.data),
        "gaps": lambda: find_gaps(spark, args.data, settings),
        "frames": lambda: extract(spark, args.data),
        "describe": lambda: describe(spark, args.data, settings),
        "stitch": lambda: stitch(spark, args.data),
    }
    return int(steps[args.step]())


def command() -> None:
    sys.exit(main())


if __name__ == "__main__":
    command()
