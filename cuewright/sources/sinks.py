"""Named files and state tables."""

from __future__ import annotations

import os
import shutil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import extension, stem


def output_name(name: Column | str) -> Column:
    """x.vtt -> x_enriched.vtt."""
    return F.concat(stem(name), F.lit("_enriched"), extension(name))


def write_files(rows: DataFrame, root: str, path_col: str = "path", content_col: str = "content") -> None:
    """One file a row under a root on a file system that all executors share; a file is replaced as a whole."""
    root = root.removeprefix("file://")

    def put(part):
        for row in part:
            at = _below(root, row[path_col])
            os.makedirs(os.path.dirname(at), exist_ok=True)
            data = row[content_col]
            with open(f"{at}.part", "wb") as file:
                file.write(data if isinstance(data, (bytes, bytearray)) else (data or "").encode("utf-8"))
            os.replace(f"{at}.part", at)

    rows.select(path_col, content_col).foreachPartition(put)


def _below(root: str, path: str) -> str:
    """A path under the root; names come from responses, so one that leads out of it is an error."""
    at = os.path.normpath(os.path.join(root, path))
    if not at.startswith(os.path.normpath(root) + os.sep):
        raise ValueError(f"{path!r} isn't below {root!r}")
    return at


def clear(folders: DataFrame, root: str, path_col: str = "path") -> None:
    """Remove folders under a root, so that what is written next is all there is in them."""
    root = root.removeprefix("file://")

    def remove(part):
        for row in part:
            shutil.rmtree(_below(root, row[path_col]), ignore_errors=True)

    folders.select(path_col).foreachPartition(remove)


def json_map(df: DataFrame, key: str, value: Column | str, keep_nulls: bool = True) -> DataFrame:
    """One JSON object a video, keys in order."""
    value = F.col(value) if isinstance(value, str) else value
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), value.alias("v")))))
    options = {"ignoreNullFields": "false"} if keep_nulls else {}
    return df.groupBy("video_id").agg(F.to_json(entries, options).alias("content"))


def write_state(df: DataFrame, path: str) -> None:
    """A state table by video; only the videos at hand are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("video_id").parquet(path)
