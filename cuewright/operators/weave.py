"""Weaving matched text into the lines of a transcript."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import strip
from ..functions.timecode import is_timing

KEYS = ["video_id", "file_name"]


def after_timing(lines: DataFrame, matched: DataFrame, compact: bool = False) -> DataFrame:
    """Lines and inserted chunks as (video_id, file_name, line_no, slot, chunk): the chunk follows its timing line.

    ``matched``: video_id, file_name, line_no, description. ``compact`` leaves out the blank line before the chunk.
    """
    text = F.concat(F.lit("" if compact else "\n"), F.lit("[Visual: "), F.coalesce("description", F.lit("None")), F.lit("]\n"))
    own = lines.select(*KEYS, "line_no", F.lit(0).cast("bigint").alias("slot"), F.col("line").alias("chunk"))
    new = matched.select(*KEYS, "line_no", F.lit(1).cast("bigint").alias("slot"), text.alias("chunk"))
    return own.unionByName(new)


def before_blank(lines: DataFrame, matched: DataFrame) -> DataFrame:
    """As ``after_timing``, but a chunk waits for the next blank line and stands before it.

    There is one waiting place: a later match takes the place of one that still waits, even if its text is empty, which then
    emits nothing. What waits at the end follows the last line.
    """
    marked = lines.join(matched.select(*KEYS, "line_no", F.coalesce("description", F.lit("")).alias("text"), F.lit(True).alias("hit")), [*KEYS, "line_no"], "left")
    order = Window.partitionBy(*KEYS).orderBy("line_no")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    marked = marked.withColumn("blank", ~is_timing("line") & (strip("line") == "")).withColumn("place", F.sum(F.coalesce("hit", F.lit(False)).cast("bigint")).over(upto))
    waits = marked.filter("place > 0").groupBy(*KEYS, "place").agg(
        F.max(F.when(F.col("hit"), F.col("text"))).alias("text"), F.min(F.when(F.col("blank"), F.col("line_no"))).alias("at"), F.max("line_no").alias("end")
    )
    last = F.max("place").over(Window.partitionBy(*KEYS))
    waits = waits.withColumn("last", last == F.col("place")).filter((F.col("text") != "") & (F.col("at").isNotNull() | F.col("last")))
    chunk = F.concat(F.lit("\n[Visual Chart Description: "), F.col("text"), F.lit("]\n"))
    slot = F.when(F.col("at").isNotNull(), -1).otherwise(1).cast("bigint")
    new = waits.select(*KEYS, F.coalesce("at", "end").alias("line_no"), slot.alias("slot"), chunk.alias("chunk"))
    return lines.select(*KEYS, "line_no", F.lit(0).cast("bigint").alias("slot"), F.col("line").alias("chunk")).unionByName(new)


def document(chunks: DataFrame) -> DataFrame:
    """One text a transcript: video_id, file_name, content."""
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "slot", "chunk")))
    return chunks.groupBy(*KEYS).agg(F.array_join(F.transform(ordered, lambda x: x["chunk"]), "").alias("content"))
