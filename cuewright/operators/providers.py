"""Annotators and decoders: answers come from a table of responses or from a Python callable run on the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from enum import IntEnum

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import backlog


class Status(IntEnum):
    """How a step ended; the values are the exit codes of the command line."""

    DONE = 0
    FAILED = 1
    PENDING = 10


@dataclass
class Settings:
    """What providers need to know; taken from the environment by the caller and never part of a plan."""

    provider: str = "table"
    model: str | None = None
    keys: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_env(cls, env: dict[str, str]) -> Settings:
        held = {k: v for k in ("OPENAI_API_KEY", "GEMINI_API_KEY") if (v := env.get(k))}
        return cls(env.get("LLM_PROVIDER", "table"), env.get("MODEL_NAME"), held)


def read_env(path: str = ".env") -> dict[str, str]:
    """The settings of a file of lines NAME=value, if it is there; comments and quotes around values fall off."""
    import os

    out: dict[str, str] = {}
    if os.path.isfile(path):
        with open(path, encoding="utf-8") as file:
            for line in file:
                name, sign, value = line.strip().removeprefix("export ").partition("=")
                if sign and not name.startswith("#"):
                    out[name.strip()] = value.strip().strip("\"'")
    return out


class ResponseTable:
    """Answers that are already there: (request_id, response). Without an answer a request is pending."""

    def __init__(self, responses: DataFrame):
        self.responses = responses

    def answer(self, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Answered requests with ``response`` and ``error``, and the pending ones."""
        done = requests.join(self.responses.groupBy("request_id").agg(F.max("response").alias("response")), "request_id")
        return done.withColumn("error", F.lit(None).cast("string")), backlog.pending(requests, self.responses, ["request_id"])


class Callback:
    """Answers by a function of a prompt and optional bytes; an exception becomes the row's error, not the job's."""

    def __init__(self, function: Callable[..., str], prompt_col: str = "prompt", content_col: str | None = None):
        self.function, self.prompt_col, self.content_col = function, prompt_col, content_col

    def answer(self, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
        function, prompt, content = self.function, self.prompt_col, self.content_col

        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in parts:
                said, wrong = [], []
                for row in part.to_dict("records"):
                    try:
                        said.append(function(row[prompt], row[content]) if content else function(row[prompt]))
                        wrong.append(None)
                    except Exception as e:
                        said.append(None)
                        wrong.append(f"{type(e).__name__}: {e}")
                yield part.assign(response=pd.Series(said, dtype=object, index=part.index), error=pd.Series(wrong, dtype=object, index=part.index))

        schema = requests.schema.simpleString()[len("struct<") : -1]
        out = requests.mapInPandas(run, f"{schema},response:string,error:string")
        return out, requests.limit(0)


def decode_frames(videos: DataFrame, decoder: Callable[[bytes], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """Frames (video_id, frame_key, frame_path, content, error) of videos (video_id, content) by a decoder of (second, JPEG)."""

    def run(parts):
        for part in parts:
            for row in part.to_dict("records"):
                rows = []
                try:
                    for second, image in decoder(row["content"]):
                        key = f"{second:06d}"
                        rows.append((row["video_id"], key, f"frames_dense/frame_{key}.jpg", image, None))
                except Exception as e:
                    rows.append((row["video_id"], None, None, None, f"{type(e).__name__}: {e}"))
                yield pd.DataFrame(rows, columns=["video_id", "frame_key", "frame_path", "content", "error"])

    kind = videos.schema["video_id"].dataType.simpleString()
    return videos.select("video_id", "content").mapInPandas(run, f"video_id {kind}, frame_key string, frame_path string, content binary, error string")


def ffmpeg_decoder(width: int = 1280, quality: int = 2, fps: int = 1) -> Callable[[bytes], Iterator[tuple[int, bytes]]]:
    """A decoder by the ffmpeg program, where it is installed: one frame a second, numbered from 1."""

    def decode(content: bytes):
        import pathlib
        import subprocess
        import tempfile

        with tempfile.TemporaryDirectory() as at:
            video = pathlib.Path(at, "video.mp4")
            video.write_bytes(content)
            subprocess.run(["ffmpeg", "-v", "error", "-i", video, "-vf", f"fps={fps},scale={width}:-1", "-q:v", str(quality), f"{at}/%06d.jpg"], check=True)
            for image in sorted(pathlib.Path(at).glob("*.jpg")):
                yield int(image.stem), image.read_bytes()

    return decode


def ffmpeg_seek(width: int = 1280, quality: int = 2) -> Callable[[bytes, str], bytes]:
    """The frame at a timestamp by the ffmpeg program, where it is installed."""

    def seek(content: bytes, timestamp: str) -> bytes:
        import pathlib
        import subprocess
        import tempfile

        with tempfile.TemporaryDirectory() as at:
            video = pathlib.Path(at, "video.mp4")
            video.write_bytes(content)
            image = pathlib.Path(at, "frame.jpg")
            subprocess.run(["ffmpeg", "-v", "error", "-ss", timestamp, "-i", video, "-frames:v", "1", "-vf", f"scale={width}:-1", "-q:v", str(quality), image], check=True)
            return image.read_bytes()

    return seek
