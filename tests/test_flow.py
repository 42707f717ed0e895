import json
import pathlib

import duckdb
import pytest

from cuewright import catalogue, cli
from cuewright.operators import remote
from cuewright.operators.providers import Status
from cuewright.streaming.segments import merge_responses, state

SF = pathlib.Path("/root/testdata/sf0.001")


def test_command_line(spark, tmp_path):
    video = tmp_path / "vid"
    video.mkdir()
    (video / "dense_index.json").write_text(json.dumps({f"{i:06d}": f"frames_dense/frame_{i:06d}.jpg" for i in range(1, 5)}))
    (video / "vid.en.vtt").write_text("WEBVTT\n\n1\n00:00:01.000 --> 00:00:02.500\nHi\n\n")
    run = lambda step, *more: cli.main([step, str(tmp_path), *more], spark)
    assert run("analyze", "--batch-size", "2") == Status.PENDING
    assert (video / "dense_batch_prompt_000001-000002.txt").read_text().endswith(f"000002: {tmp_path}/vid/frames_dense/frame_000002.jpg")
    (video / "dense_batch_response_000001-000002.json").write_text(json.dumps({"000001": {"description": "é", "delta": "Scene start"}, "000002": {"description": "b", "delta": "No change"}}))
    assert run("analyze", "--batch-size", "2") == Status.PENDING
    assert (video / "frames_dense/frame_000001.txt").read_text() == "[Description]\né\n\n[Delta]\nScene start\n"
    assert "é" in (video / "dense_analysis.json").read_text()
    assert run("analyze", "--batch-size", "2") == Status.PENDING
    (video / "dense_batch_response_000003-000004.json").write_text(json.dumps({"000003": {"description": "c", "delta": "Added: c"}, "000004": {"description": "d", "delta": "No change"}}))
    assert run("analyze", "--batch-size", "2") == Status.DONE
    assert run("enrich") == Status.PENDING
    (video / "dedup_response.json").write_text(json.dumps({"00:00:01": "first", "00:00:03": "second"}))
    assert run("enrich") == Status.DONE
    assert (video / "vid.en_enriched.vtt").read_text() == "WEBVTT\n\n1\n00:00:01.000 --> 00:00:02.500\n\n[Visual: first]\nHi\n\n"
    assert "## [00:00:03] Scene 2 (2s)\nsecond\n" in (video / "video_commentary.md").read_text()
    assert run("gaps") == Status.PENDING
    (video / "gaps_response_vid.en.json").write_text(json.dumps({"gaps": [{"exact_timestamp": "00:02", "context_snippet": "look"}]}))
    assert run("gaps") == Status.DONE
    targets = json.loads((video / "targets.json").read_text())
    assert targets == {"vid.en.vtt": [{"exact_timestamp": "00:00:02", "context_snippet": "look"}]}
    targets["vid.en.vtt"][0]["vlm_description"] = "chart"
    (video / "targets.json").write_text(json.dumps(targets))
    assert run("stitch") == Status.DONE
    assert (video / "vid.en_enriched.vtt").read_text() == "WEBVTT\n\n1\n00:00:01.000 --> 00:00:02.500\nHi\n\n[Visual Chart Description: chart]\n\n"
    assert cli.main(["enrich", str(tmp_path / "none")], spark) == Status.FAILED


def test_capture_and_describe(spark, tmp_path):
    video = tmp_path / "vid"
    video.mkdir()
    (video / "vid.mp4").write_bytes(b"abc")
    (video / ".hidden.mp4").write_bytes(b"zz")
    (video / "vid.vtt").write_text("WEBVTT\n")

    def decode(content):
        yield from ((i + 1, bytes([c])) for i, c in enumerate(content))

    def seek(content, timestamp):
        if timestamp.startswith("00:09"):
            raise ValueError("past the end")
        return content + timestamp.encode()

    data = str(tmp_path)
    assert cli.capture(spark, data, decoder=decode) == Status.DONE
    assert json.loads((video / "dense_index.json").read_text()) == {f"{i:06d}": f"frames_dense/frame_{i:06d}.jpg" for i in (1, 2, 3)}
    (video / "dense_index.json").write_text("{}")
    assert (video / "frames_dense/frame_000002.jpg").read_bytes() == b"b"
    (video / "dense_analysis.json").write_text('{"000001": {"description": "old", "delta": "x"}}')
    assert cli.capture(spark, data, again=True, decoder=decode) == Status.DONE
    assert json.loads((video / "dense_analysis.json").read_text()) == {}
    (video / "targets.json").write_text(json.dumps({"vid.vtt": [{"exact_timestamp": "00:00:02", "context_snippet": "a"}, {"exact_timestamp": "00:09:00", "context_snippet": "b"}]}))
    assert cli.extract(spark, data, seek) == Status.DONE
    assert (video / "frames/vid_frame_00-00-02.jpg").read_bytes() == b"abc00:00:02"
    got = json.loads((video / "targets.json").read_text())["vid.vtt"]
    assert [g["frame_path"] for g in got] == ["frames/vid_frame_00-00-02.jpg", "frames/vid_frame_00-09-00.jpg"]
    assert cli.describe(spark, data) == Status.PENDING
    assert (video / "vlm_prompt_vid_vid.vtt_0.txt").read_text().startswith("Image: frames/vid_frame_00-00-02.jpg\n\n")
    (video / "vlm_response_vid_vid.vtt_0.txt").write_text(" a chart \n")
    assert cli.describe(spark, data) == Status.DONE
    got = json.loads((video / "targets.json").read_text())["vid.vtt"]
    assert got[0]["vlm_description"] == "a chart" and "vlm_description" not in got[1]


def test_remote_pieces_are_optional():
    settings = remote.Settings.from_env({"LLM_PROVIDER": "openai", "OPENAI_API_KEY": "k"})
    with pytest.raises(RuntimeError, match="not installed"):
        remote.gaps(settings)("prompt")
    with pytest.raises(ValueError, match="provider"):
        remote.describe(remote.Settings("none"))
    assert remote.remote_video_id("https://example.com") is None and remote.download("https://example.com", "/nowhere") is False


def test_streamed_merge_is_idempotent(spark, tmp_path):
    rows = [("v", "000001", "a", "x"), ("v", "000001", "a", "x"), ("v", "000002", "b", None)]
    src = str(tmp_path / "in")
    spark.createDataFrame(rows, "video_id string, frame_key string, description string, delta string").write.parquet(src)
    for _ in range(2):
        stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
        merge_responses(stream, str(tmp_path / "state"), str(tmp_path / "check")).awaitTermination()
    assert sorted((r.frame_key, r.description) for r in state(spark, str(tmp_path / "state"), 0).collect()) == [("000001", "a"), ("000002", "b")]


@pytest.mark.skipif(not SF.exists(), reason="needs the test tables")
@pytest.mark.parametrize("name", ["scene_segments", "greedy_match_dense", "weave_before_blank", "merge_upsert", "gap_explode", "stream_segments"])
def test_against_duckdb(spark, name):
    db = duckdb.connect()
    for p in SF.glob("*.parquet"):
        db.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    want = db.sql(catalogue.ORACLES[name])
    got = catalogue.QUERIES[name](spark, str(SF))
    names = sorted(want.columns)
    assert sorted(got.columns) == names
    order = [want.columns.index(c) for c in names]
    assert sorted(map(repr, (tuple(r) for r in got.select(names).collect()))) == sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())
