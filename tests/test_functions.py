import pytest
from pyspark.sql import functions as F

from cuewright.functions import text, timecode


def one(spark, expr, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return row.select(expr.alias("x")).head().x


def test_strip_knows_29_kinds(spark):
    assert len(text.WS29) == 29 and all(c.isspace() for c in text.WS29)
    rows = spark.createDataFrame([(f"{c}a b{c}",) for c in text.WS29], "s string")
    assert {r.x for r in rows.select(text.strip("s").alias("x")).collect()} == {"a b"}


@pytest.mark.parametrize(("s", "n"), [(" 12 ", 12), ("-3", -3), ("+4", 4), ("4.7", None), ("1e1", None), ("", None), ("x", None), ("000061", 61)])
def test_whole(spark, s, n):
    assert one(spark, text.whole("s"), s=s) == n


@pytest.mark.parametrize(("key", "ts"), [("000000", "00:00:00"), ("000001", "00:00:01"), ("003661", "01:01:01"), ("360000", "100:00:00"), ("x", None)])
def test_key_to_timestamp(spark, key, ts):
    assert one(spark, timecode.key_to_timestamp("k"), k=key) == ts


LENIENT = [
    ("00:00:09", "00:00:04", "00:00:09", True),
    ("00:00:10", "00:00:04", "00:00:09", False),
    ("00:00:04", "00:00:04,960", "00:00:09", True),
    ("00:04", "00:00:00", "00:10:00", False),
    ("00:75:00", "01:00:00", "01:30:00", True),
    ("00:00:05", "00:00:04", "00:00:09 align:start", False),
    (None, "00:00:04", "00:00:09", False),
]


@pytest.mark.parametrize(("t", "a", "b", "hit"), LENIENT)
def test_in_block_lenient(spark, t, a, b, hit):
    assert one(spark, timecode.in_block_lenient("t", "a", "b"), t=t, a=a, b=b) is hit


@pytest.mark.parametrize(("t", "a", "b", "hit"), [("00:09", "00:00:04", "00:00:09", True), ("00:00:09.5", "00:00:04", "00:00:09", False), ("00:75:00", "00:00:00", "02:00:00", False), ("24:00:00", "00:00:00", "23:59:59", False)])
def test_in_block_strict(spark, t, a, b, hit):
    assert one(spark, timecode.in_block_strict("t", "a", "b"), t=t, a=a, b=b) is hit


def test_timing_line_parts(spark):
    line = "00:01.500 --> 00:02.000 --> 00:03 align:start\n"
    assert one(spark, timecode.timing_part("s", 1), s=line) == "00:01"
    assert one(spark, timecode.timing_part("s", 2), s=line) == "00:02"
    assert one(spark, timecode.timing_part("s", 1), s="text") is None


def test_names(spark):
    assert one(spark, text.stem("p"), p="a/b.c/d.en.vtt") == "d.en"
    assert one(spark, text.extension("p"), p="a/.hidden") == ""
    assert one(spark, timecode.frame_file("v", "t"), v="id", t="01:02") == "id_frame_00-01-02.jpg"
    assert one(spark, text.data_url(F.col("b").cast("binary")), b="ab" * 60).startswith("data:image/jpeg;base64,YWJh")
    assert "\n" not in one(spark, text.data_url(F.col("b").cast("binary")), b="ab" * 90)


@pytest.mark.parametrize(("url", "v"), [("https://www.youtube.com/watch?v=abc_-1&t=2", "abc_-1"), ("https://youtu.be/xyz?si=1", "xyz"), ("https://youtube.com/shorts/q1", "q1"), ("https://example.com/", None)])
def test_video_id_of(spark, url, v):
    assert one(spark, text.video_id_of("u"), u=url) == v


def test_numbers_beyond_all_bounds_are_no_times(spark):
    for ts in ("9999999999999999:00:00", "9223372036854775807:59:59", "00:999999999999999999:00"):
        assert one(spark, timecode.in_block_lenient("t", "a", "b"), t=ts, a="00:00:00", b="00:00:09") is False
        assert one(spark, timecode.seconds_lenient("t"), t=ts) is None
