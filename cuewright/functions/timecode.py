"""Timecodes as columns: frame keys, seconds, HH:MM:SS and cue timing lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, count_of, strip, whole

ARROW = "-->"


def key_of(seconds: Column | str) -> Column:
    """A frame key: seconds as at least six digits."""
    return F.format_string("%06d", col(seconds).cast("bigint"))


def frame_key_of_name(name: Column | str) -> Column:
    """frame_000001.jpg -> 000001."""
    return F.replace(F.replace(col(name), F.lit("frame_"), F.lit("")), F.lit(".jpg"), F.lit(""))


def hms(seconds: Column | str) -> Column:
    """HH:MM:SS; hours grow beyond two digits."""
    s = col(seconds).cast("bigint")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)


def key_to_timestamp(key: Column | str, offset: int = 0) -> Column:
    """The timecode of a frame key; null for a key that isn't a number."""
    s = whole(key)
    return F.when(s.isNotNull(), hms(s + offset))


def seconds_lenient(ts: Column | str) -> Column:
    """Whole seconds of H:M:S[.fraction] with point or comma; any numbers; further parts are ignored; else null."""
    parts = F.split(F.replace(col(ts), F.lit(","), F.lit(".")), ":")
    last = F.substring_index(F.get(parts, F.lit(2)), ".", 1)
    hours, minutes = (F.try_multiply(whole(F.get(parts, F.lit(i))), F.lit(unit)) for i, unit in ((0, 3600), (1, 60)))
    return F.try_add(F.try_add(hours, minutes), whole(last))  # what no number holds is no time


def with_hours(ts: Column | str) -> Column:
    """MM:SS becomes 00:MM:SS."""
    ts = col(ts)
    return F.when(count_of(ts, ":") == 1, F.concat(F.lit("00:"), ts)).otherwise(ts)


def millis_strict(ts: Column | str) -> Column:
    """Milliseconds of [HH:]MM:SS[.fraction] within a day, else null."""
    pattern = r"^(?:([01][0-9]|2[0-3]):)?([0-5][0-9]):([0-5][0-9])(?:[.,]([0-9]{1,9}))?$"

    def read(t: Column) -> Column:
        parts = F.split(F.split(t, "[.,]")[0], ":")
        of_day = F.aggregate(parts, F.lit(0).cast("bigint"), lambda acc, x: acc * 60 + x.cast("bigint"))
        fraction = F.rpad(F.coalesce(F.get(F.split(t, "[.,]"), F.lit(1)), F.lit("")), 3, "0")
        return F.when(t.rlike(pattern), of_day * 1000 + fraction.cast("bigint"))

    return F.transform(F.array(col(ts)), read)[0]  # bound once, so nested uses don't multiply


def is_timing(line: Column | str) -> Column:
    return F.contains(col(line), F.lit(ARROW))


def timing_part(line: Column | str, n: int) -> Column:
    """Start (1) or end (2) of a timing line, cut at its first point; null for other lines."""
    line = col(line)
    return F.when(is_timing(line), F.substring_index(strip(F.split_part(line, F.lit(ARROW), F.lit(n))), ".", 1))


def in_block_lenient(ts: Column | str, start: Column | str, end: Column | str) -> Column:
    """Whether whole seconds lie in the closed interval; false where any part can't be read."""
    return F.coalesce(seconds_lenient(ts).between(seconds_lenient(start), seconds_lenient(end)), F.lit(False))


def in_block_strict(ts: Column | str, start: Column | str, end: Column | str) -> Column:
    """Whether a time lies in the closed interval, its fraction kept; false where any part can't be read."""
    return F.coalesce(millis_strict(ts).between(millis_strict(start), millis_strict(end)), F.lit(False))


def frame_file(video_id: Column | str, ts: Column | str) -> Column:
    """<id>_frame_HH-MM-SS.jpg for a timestamp."""
    s = F.floor(millis_strict(ts) / 1000)
    name = F.transform(F.array(s), lambda x: F.replace(hms(x), F.lit(":"), F.lit("-")))[0]
    return F.concat(col(video_id).cast("string"), F.lit("_frame_"), name, F.lit(".jpg"))
