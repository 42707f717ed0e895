import json

import pytest
from pyspark.sql import functions as F

from cuewright.operators import backlog, gaps, match, providers, render, scenes, weave
from cuewright.sources import readers

FRAMES = [("000001", "No change"), ("000002", " no CHANGE "), ("000003", "Added: line"), ("000004", None), ("000006", ""), ("000007", "Scene start")]


def frames(spark, rows=FRAMES, video="v"):
    return spark.createDataFrame([(video, k, f"d{k}", d) for k, d in rows], "video_id string, frame_key string, description string, delta string")


def lines(spark, value, name="a.vtt"):
    return readers.lines(spark.createDataFrame([("v", name, value)], "video_id string, file_name string, value string"))


def entries(spark, rows):
    return match.entries_of(spark.createDataFrame([("v", i, ts, d) for i, (ts, d) in enumerate(rows)], "video_id string, pos long, ts string, description string"))


def test_segmentation_vector(spark):
    got = scenes.with_times(scenes.segment(frames(spark))).orderBy("scene_no").collect()
    assert [(r.start_key, r.end_key, len(r.frames), r.deltas, r.duration_s) for r in got] == [
        ("000001", "000002", 2, ["No change", "no CHANGE"], 2),
        ("000003", "000004", 2, ["Added: line", "No change"], 2),
        ("000006", "000006", 1, [""], 1),
        ("000007", "000007", 1, ["Scene start"], 1),
    ]
    assert [r.first_description for r in got] == ["d000001", "d000003", "d000006", "d000007"]


def test_missing_seconds_count_in_durations(spark):
    rows = [(k, "No change" if k == "000006" else d) for k, d in FRAMES]
    got = scenes.with_times(scenes.segment(frames(spark, rows))).orderBy("scene_no").collect()
    assert (got[1].start_key, got[1].end_key, len(got[1].frames), got[1].duration_s) == ("000003", "000006", 3, 4)


def test_cap_of_deltas(spark):
    rows = spark.createDataFrame([([f"c{i}" for i in range(25)] + ["No change", "Scene start"],)], "d array<string>")
    shown, more = scenes.capped(scenes.meaningful("d"))
    got = rows.select(shown.alias("s"), more.alias("m")).head()
    assert len(got.s) == 20 and got.m == 5


VTT = "WEBVTT\n\n1\n00:00:04.960 --> 00:00:09.360\nA\n\n2\n00:00:09.360 --> 00:00:12.840\nB\n"


@pytest.mark.parametrize(
    ("order", "got"),
    [([("00:00:09", "s9"), ("00:00:05", "s5"), ("00:00:30", "s30")], {3: "s9"}), ([("00:00:05", "s5"), ("00:00:09", "s9"), ("00:00:30", "s30")], {3: "s5", 7: "s9"})],
)
def test_greedy_match_follows_both_orders(spark, order, got):
    e = entries(spark, order)
    m = match.greedy_match(match.cues_of(lines(spark, VTT)), e)
    assert {r.line_no: r.description for r in m.join(e, ["video_id", "pos"]).collect()} == got
    assert match.unmatched(e, m).count() == 3 - len(got)


def test_weave_after_timing(spark):
    matched = spark.createDataFrame([("v", "a.vtt", 3, "s9")], "video_id string, file_name string, line_no long, description string")
    got = weave.document(weave.after_timing(lines(spark, VTT), matched)).head().content
    assert got == VTT.replace("--> 00:00:09.360\n", "--> 00:00:09.360\n\n[Visual: s9]\n")
    assert "\n\n[Visual" not in weave.document(weave.after_timing(lines(spark, VTT), matched, compact=True)).head().content


def _carry(rows, matched):
    out, held = [], None
    for i, line in enumerate(rows):
        out.append(line)
        if "-->" in line:
            held = matched.get(i, held)
        elif not line.strip() and held:
            out.insert(-1, f"\n[Visual Chart Description: {held}]\n")
            held = None
    return "".join(out + ([f"\n[Visual Chart Description: {held}]\n"] if held else []))


@pytest.mark.parametrize("matched", [{3: "a"}, {3: "a", 5: "b"}, {8: "end"}, {3: "a", 5: ""}, {3: "a", 5: "b", 8: "c"}, {}])
def test_weave_before_blank(spark, matched):
    value = "WEBVTT\n\n1\n0 --> 1\nA\n1 --> 2\nB\n \n2 --> 3\nC"
    rows = value.splitlines(keepends=True)
    m = spark.createDataFrame([("v", "a.vtt", i, d) for i, d in matched.items()], "video_id string, file_name string, line_no long, description string")
    got = weave.document(weave.before_blank(lines(spark, value), m)).head().content
    assert got == _carry(rows, matched)


@pytest.mark.parametrize("value", ["a\r\nb\rc\nd", "a\n", "﻿WEBVTT\n\n", "", "a\n\n", "Привет\n"])
def test_lines_keep_everything(spark, value):
    got = [r.line for r in lines(spark, value).orderBy("line_no").collect()]
    assert "".join(got) == value.replace("\r\n", "\n").replace("\r", "\n")
    assert all(x.endswith("\n") for x in got[:-1])


def test_json_maps_keep_the_last_value_at_the_first_place(spark):
    files = spark.createDataFrame([("v", '{"a": "1", "b": "2", "a": "3"}'), ("w", "{broken")], "video_id string, value string")
    assert [(r.key, r.value) for r in readers.map_entries(files).orderBy("pos").collect()] == [("a", "3"), ("b", "2")]


def test_backlog(spark):
    index = spark.createDataFrame([("v", f"{i:06d}", f"p{i}") for i in range(6)], "video_id string, frame_key string, frame_path string")
    old = spark.createDataFrame([("v", "000001", "old", "x"), ("v", "999999", "foreign", "x")], "video_id string, frame_key string, description string, delta string")
    new = spark.createDataFrame([("v", "000001", None, "y"), ("v", "000002", "new", None)], "video_id string, frame_key string, description string, delta string")
    left = backlog.remaining(index, old)
    assert [r.frame_key for r in backlog.next_batch(left, 2).collect()] == ["000000", "000002"]
    assert backlog.labels(backlog.next_batch_per_video(left, 2)).head().batch_label == "000000-000002"
    assert backlog.previous_description(index, old).head().previous_description == "foreign"
    merged = backlog.merge(old, new)
    assert {(r.frame_key, r.description, r.delta) for r in merged.collect()} == {("000001", None, "y"), ("000002", "new", None), ("999999", "foreign", "x")}
    assert backlog.merge(merged, new).exceptAll(merged).isEmpty()
    got = backlog.progress(index, merged).head()
    assert (got.total, got.done, got.left_by_count, got["left"]) == (6, 3, 3, 4)
    with pytest.raises(ValueError):
        backlog.next_batch(left, 0)


def test_gaps(spark):
    responses = spark.createDataFrame([("v", "a.vtt", '{"gaps": [{"exact_timestamp": "00:05", "context_snippet": "x"}, {"exact_timestamp": "99", "context_snippet": "y"}]}')], "video_id string, file_name string, response string")
    got = gaps.validate(gaps.from_response(responses)).orderBy("gap_idx").collect()
    assert [(r.exact_timestamp, r.is_valid) for r in got] == [("00:00:05", True), ("99", False)]
    with pytest.raises(Exception, match="Invalid gap"):
        gaps.validate(gaps.from_response(responses), strict=True).collect()
    nested = {"a.vtt": [{"exact_timestamp": "00:00:05", "context_snippet": "a", "vlm_description": "a"}, {"exact_timestamp": "00:00:09", "context_snippet": "b", "vlm_description": "b"}, {"exact_timestamp": "00:00:05", "context_snippet": "c", "vlm_description": "c"}, {"exact_timestamp": "00:00:07", "context_snippet": "d", "vlm_description": None}, {"exact_timestamp": "00:00:08", "context_snippet": "e"}]}
    rows = gaps.explode_targets(spark.createDataFrame([("v", json.dumps(nested))], "video_id string, targets string"))
    assert [r.has_vlm_description for r in rows.orderBy("gap_idx").collect()] == [True, True, True, True, False]
    assert [(r.ts, r.description) for r in gaps.gap_map(rows).orderBy("pos").collect()] == [("00:00:05", "c"), ("00:00:09", "b"), ("00:00:07", None)]
    back = json.loads(gaps.renest(rows, ["exact_timestamp", "context_snippet", "vlm_description"]).head().targets)
    assert [g["context_snippet"] for g in back["a.vtt"]] == list("abcde") and "vlm_description" not in back["a.vtt"][4]


def test_texts(spark):
    rows = spark.createDataFrame([("D", None)], "description string, delta string")
    assert rows.select(render.frame_text().alias("x")).head().x == "[Description]\nD\n\n[Delta]\n\n"
    s = scenes.with_times(scenes.segment(frames(spark)))
    polished = spark.createDataFrame([("v", 0, "00:00:03", "P")], "video_id string, pos long, ts string, description string")
    got = render.commentary(scenes.polish(s, polished)).head().content
    assert got.startswith("# Video Commentary: v\n\n") and "## [00:00:03] Scene 2 (2s)\nP\n" in got and got.endswith("Scene 4 (1s)\nd000007\n")


def test_providers(spark):
    requests = spark.createDataFrame([("a", "x"), ("b", "boom")], "request_id string, prompt string")

    def answer(prompt):
        if prompt == "boom":
            raise RuntimeError("no")
        return prompt.upper()

    got = {r.request_id: (r.response, r.error) for r in providers.Callback(answer).answer(requests)[0].collect()}
    assert got == {"a": ("X", None), "b": (None, "RuntimeError: no")}
    done, waiting = providers.ResponseTable(spark.createDataFrame([("a", "A")], "request_id string, response string")).answer(requests)
    assert done.head().response == "A" and waiting.head().request_id == "b"
    images = spark.createDataFrame([("v", bytearray(b"ab")), ("w", bytearray(b""))], "video_id string, content binary")

    def decode(content):
        if not content:
            raise ValueError("empty")
        yield from ((i + 1, bytes([c])) for i, c in enumerate(content))

    rows = providers.decode_frames(images, decode).orderBy("video_id", "frame_key").collect()
    assert [(r.frame_key, r.error) for r in rows] == [("000001", None), ("000002", None), (None, "ValueError: empty")]


def test_partition_of_frames(spark):
    got = scenes.segment(frames(spark)).select(F.explode("frames").alias("k")).collect()
    assert sorted(r.k for r in got) == [k for k, _ in FRAMES]


def test_long_cues_stand_once(spark):
    """A cue of very many hours is neither an error nor millions of rows, and pairs are those of a comparison of all."""
    from cuewright.operators import match

    cues = [("v", "f", 1, 0, 10**11), ("v", "f", 2, 50, 70), ("v", "f", 3, 9, 4), ("w", "f", 1, 0, 5_000), ("v", "f", 4, None, 3)]
    entries = [("v", p, t) for p, t in enumerate((0, 63, 64, 70, 71, 4_000, 10**11, None))] + [("w", 0, 5_000), ("w", 1, 5_001)]
    a = spark.createDataFrame(cues, "video_id string, file_name string, line_no long, start_t long, end_t long")
    b = spark.createDataFrame(entries, "video_id string, pos long, t long")
    got = sorted((r.video_id, r.line_no, r.pos) for r in match.interval_pairs(a, b).collect())
    assert got == sorted((v, n, p) for v, _, n, s, e in cues for w, p, t in entries if v == w and None not in (s, t) and s <= t <= e)
