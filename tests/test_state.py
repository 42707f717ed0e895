"""State files, readers and providers: what stays, what goes, what is refused."""

import json

import pytest
from pyspark.sql import functions as F

from cuewright import cli
from cuewright.operators import gaps, providers, remote, render
from cuewright.operators.providers import Settings, Status
from cuewright.sources import readers, sinks
from cuewright.streaming import segments


def test_null_descriptions_and_files_without_gaps_stay(spark):
    text = '{"a.vtt": [{"exact_timestamp": "00:00:01", "context_snippet": "c", "vlm_description": null}, {"exact_timestamp": "00:00:02"}], "b\\"x.vtt": []}'
    rows = gaps.explode_targets(spark.createDataFrame([("v", text)], "video_id string, targets string"))
    back = gaps.renest(rows, ["exact_timestamp", "context_snippet", "vlm_description"]).head().targets
    assert json.loads(back) == json.loads(text)
    answers = spark.createDataFrame([("v", "a.vtt", '{"gaps": []}'), ("v", "b.vtt", '{"gaps": [{"exact_timestamp": "", "context_snippet": ""}]}')], "video_id string, file_name string, response string")
    assert [r.file_name for r in gaps.without_gaps(answers).collect()] == ["a.vtt"]


def test_recapture_leaves_no_old_frames(spark, tmp_path):
    at = tmp_path / "v"
    at.mkdir()
    (at / "v.mp4").write_bytes(b"abc")
    decode = lambda content: ((i + 1, bytes([c])) for i, c in enumerate(content))
    assert cli.capture(spark, str(tmp_path), decoder=decode) is Status.DONE
    assert sorted(json.loads((at / "dense_index.json").read_text())) == ["000001", "000002", "000003"]
    (at / "v.mp4").write_bytes(b"z")
    assert cli.capture(spark, str(tmp_path), again=True, decoder=decode) is Status.DONE
    assert list(json.loads((at / "dense_index.json").read_text())) == ["000001"] and [p.name for p in (at / "frames_dense").glob("*.jpg")] == ["frame_000001.jpg"]


def test_prompts_name_absolute_paths_and_are_written_every_run(spark, tmp_path):
    at = tmp_path / "v"
    at.mkdir()
    (at / "dense_index.json").write_text('{"000001": "frames_dense/frame_000001.jpg"}')
    assert cli.analyze(spark, str(tmp_path), 10) is Status.PENDING
    (prompt,) = at.glob("dense_batch_prompt_*.txt")
    assert f"{tmp_path}/v/frames_dense/frame_000001.jpg" in prompt.read_text() and '"delta"' in prompt.read_text()
    prompt.unlink()
    (at / "dense_batch_response_000001-000001.json").write_text('{"000001": {"description": "d", "delta": "Scene start"}}')
    assert cli.analyze(spark, str(tmp_path), 10) is Status.DONE and prompt.exists()


def test_the_last_of_a_batch_holds(spark, tmp_path):
    rows = [("v", "1", "z first", "a"), ("v", "1", "a last", "b"), ("v", "2", "x", None)]
    spark.createDataFrame(rows, "video_id string, frame_key string, description string, delta string").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(readers.ANALYSIS).parquet(str(tmp_path / "in"))
    segments.merge_responses(stream, str(tmp_path / "state"), str(tmp_path / "check")).awaitTermination()
    got = {r.frame_key: r.description for r in segments.state(spark, str(tmp_path / "state"), 0).collect()}
    assert got == {"1": "a last", "2": "x"}


def test_files_stay_below_their_root(spark, tmp_path):
    with pytest.raises(Exception, match="isn't below"):
        sinks.write_files(spark.createDataFrame([("../x", "c")], "path string, content string"), str(tmp_path / "root"))
    assert not (tmp_path / "x").exists()


def test_optional_state_and_text_responses(spark, tmp_path):
    assert readers.analysis_or_empty(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "a.json").write_text('{"1": {"description": "d"}, "1": {"description": "e", "delta": "x"}}')
    assert [(r.description, r.delta) for r in readers.analysis_or_empty(spark, str(tmp_path / "a.json")).collect()] == [("e", "x")]
    (tmp_path / "r_1.txt").write_text("\n said \t")
    assert [tuple(r) for r in readers.responses(spark, str(tmp_path)).collect()] == [("r_1", "said")]


def test_settings_of_a_file(tmp_path):
    (tmp_path / ".env").write_text("# c\nLLM_PROVIDER=gemini\nexport MODEL_NAME='m'\nnothing\n")
    assert Settings.from_env(providers.read_env(str(tmp_path / ".env"))) == Settings("gemini", "m", {})
    assert providers.read_env(str(tmp_path / "none")) == {} and remote.GAP_MODELS["openai"]
    assert cli.fetch(str(tmp_path), None) is Status.FAILED


def test_first_batch_says_so(spark):
    batch = spark.createDataFrame([("v", "000001", "f.jpg")], "video_id string, frame_key string, frame_path string")
    previous = batch.select("video_id", F.lit("").alias("previous_description"))
    assert render.FIRST in render.batch_prompt(batch, previous).head().prompt
