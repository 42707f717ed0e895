"""Registered queries and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .functions import text, timecode
from .operators import backlog, match, providers, render, scenes, weave
from .operators import gaps as gap_ops
from .sources import fixtures as fx
from .sources import readers, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# ---- SQL pieces shared by the oracles -------------------------------------------------------------------------------------

_WS = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||' '||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)"
_HMS = "printf('%02d:%02d:%02d', ({0}) // 3600, (({0}) % 3600) // 60, ({0}) % 60)"
_DELTA = "CASE event_type WHEN 'view' THEN 'No change' WHEN 'purchase' THEN ' NO CHANGE ' WHEN 'click' THEN 'Added: click' WHEN 'error' THEN 'Scene change: error' WHEN 'signup' THEN 'Scene start' END"


def _frames(key: str) -> str:
    return f"fx AS (SELECT user_id AS video_id, printf('%06d', {key}) AS frame_key, 'd' || event_id AS description, {_DELTA} AS delta FROM events)"


_DENSE = _frames("row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)")
_SPARSE = _frames("event_id")
_FLAGS = f"""fl AS (SELECT video_id, frame_key, description, trim(coalesce(delta, 'No change'), {_WS}) AS delta, lower(trim(coalesce(delta, 'No change'), {_WS})) <> 'no change' AS is_change FROM fx),
nu AS (SELECT *, sum(CASE WHEN is_change OR rn = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY video_id ORDER BY frame_key ROWS UNBOUNDED PRECEDING)::BIGINT AS scene_no
       FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY frame_key) AS rn FROM fl))"""
_SCENES = f"""sc AS (SELECT video_id, scene_no, min(frame_key) AS start_key, max(frame_key) AS end_key, count(*)::BIGINT AS n_frames,
  list(delta ORDER BY frame_key) AS deltas, arg_min(description, frame_key) AS first_description FROM nu GROUP BY video_id, scene_no),
st AS (SELECT *, {_HMS.format('start_key::BIGINT')} AS start_ts, {_HMS.format('end_key::BIGINT')} AS end_ts, end_key::BIGINT - start_key::BIGINT + 1 AS duration_s FROM sc)"""
_LINES = f"""tx AS (SELECT conv_id AS video_id, conv_id || '.vtt' AS file_name, 'WEBVTT' || chr(10) || chr(10) || string_agg((turn + 1) || chr(10) || {_HMS.format('4 * turn')} || '.960 --> ' || {_HMS.format('4 * turn + 4')} || '.960' || chr(10) || coalesce(text, '') || chr(10) || chr(10), '' ORDER BY turn) AS value FROM conversations GROUP BY conv_id),
pt AS (SELECT video_id, file_name, string_split_regex(value, '\\r\\n|\\r|\\n') AS p FROM tx),
ix AS (SELECT video_id, file_name, unnest(p) AS piece, unnest(range(len(p)))::BIGINT AS line_no, len(p) AS n FROM pt),
ln AS (SELECT video_id, file_name, line_no, piece || CASE WHEN line_no < n - 1 THEN chr(10) ELSE '' END AS line FROM ix WHERE NOT (line_no = n - 1 AND piece = ''))"""
_CUES = f"""tm AS (SELECT video_id, file_name, line_no, split_part(trim(split_part(line, '-->', 1), {_WS}), '.', 1) AS start_ts, split_part(trim(split_part(line, '-->', 2), {_WS}), '.', 1) AS end_ts FROM ln WHERE contains(line, '-->')),
cu AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY line_no)::BIGINT AS cue_no,
  split_part(start_ts, ':', 1)::BIGINT * 3600 + split_part(start_ts, ':', 2)::BIGINT * 60 + split_part(start_ts, ':', 3)::BIGINT AS s,
  split_part(end_ts, ':', 1)::BIGINT * 3600 + split_part(end_ts, ':', 2)::BIGINT * 60 + split_part(end_ts, ':', 3)::BIGINT AS e FROM tm)"""
_MAP = f"sm AS (SELECT conv_id AS video_id, row_number() OVER (PARTITION BY conv_id ORDER BY length(text), turn)::BIGINT - 1 AS pos, 3 * turn AS t, {_HMS.format('3 * turn')} AS ts, 's' || turn AS description FROM conversations)"
_GAPS = f"""gp AS (SELECT conv_id AS video_id, conv_id || '.vtt' AS file_name, turn AS gap_idx, CASE WHEN (turn // 3) % 2 = 1 THEN substr({_HMS.format('(turn // 3) * 9')}, 4, 5) ELSE {_HMS.format('(turn // 3) * 9')} END AS exact_timestamp,
  substr(text, 1, 80) AS context_snippet, CASE WHEN turn % 7 = 0 THEN '' ELSE 'g' || turn END AS vlm_description, turn % 5 <> 4 AS has_vlm_description, (turn // 3) * 9 AS t FROM conversations)"""
_GAPMAP = "gm AS (SELECT video_id, exact_timestamp AS ts, min(gap_idx) AS pos, arg_max(vlm_description, gap_idx) AS description, min(t) AS t FROM gp WHERE has_vlm_description GROUP BY video_id, exact_timestamp)"


def _walk(entries: str) -> str:
    return f"""wk(video_id, cue_no, used, pos) AS (
  SELECT DISTINCT video_id, 0::BIGINT, []::BIGINT[], NULL::BIGINT FROM cu
  UNION ALL
  SELECT w.video_id, c.cue_no, CASE WHEN p.pos IS NULL THEN w.used ELSE list_append(w.used, p.pos) END, p.pos
  FROM wk w JOIN cu c ON c.video_id = w.video_id AND c.cue_no = w.cue_no + 1
  LEFT JOIN LATERAL (SELECT min(m.pos) AS pos FROM {entries} m WHERE m.video_id = w.video_id AND m.t BETWEEN c.s AND c.e AND NOT list_contains(w.used, m.pos)) p ON true),
mt AS (SELECT c.video_id, c.file_name, c.line_no, c.cue_no, m.pos, m.ts, m.description FROM wk w JOIN cu c ON c.video_id = w.video_id AND c.cue_no = w.cue_no JOIN {entries} m ON m.video_id = w.video_id AND m.pos = w.pos)"""


_INDEX = "ix AS (SELECT source AS video_id, printf('%06d', doc_id) AS frame_key, 'frames_dense/frame_' || printf('%06d', doc_id) || '.jpg' AS frame_path FROM documents)"
_ANALYSIS = "an AS (SELECT d.source AS video_id, printf('%06d', d.doc_id) AS frame_key, 'q' || quality || 't' || toxic AS description, CASE WHEN toxic = 1 THEN 'Scene change' ELSE 'No change' END AS delta FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"
_RESPONSE = "rs AS (SELECT source AS video_id, printf('%06d', doc_id) AS frame_key, 'r' || doc_id AS description, CASE WHEN doc_id % 3 > 0 THEN 'Added: r' END AS delta FROM documents WHERE doc_id % 2 = 0)"
_LEFT = "lf AS (SELECT ix.* FROM ix WHERE NOT EXISTS (SELECT 1 FROM an WHERE an.video_id = ix.video_id AND an.frame_key = ix.frame_key))"
_BATCH = "bt AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY frame_key)::BIGINT AS rn FROM lf) WHERE rn <= 10)"
_LAST = "pd AS (SELECT v.video_id, coalesce(a.d, '') AS previous_description FROM (SELECT DISTINCT video_id FROM ix) v LEFT JOIN (SELECT video_id, arg_max(coalesce(description, ''), frame_key) AS d FROM an GROUP BY video_id) a ON a.video_id = v.video_id)"


def register(name: str, sql: str | None = None):
    def add(query):
        QUERIES[name] = query
        if sql:
            ORACLES[name] = sql
        return query

    return add


def _with(*parts: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n"


# ---- scenes ---------------------------------------------------------------------------------------------------------------

_SEGMENTS = "SELECT video_id, scene_no, start_key, end_key, start_ts, end_ts, duration_s, n_frames, first_description FROM st"


def _segments(frames: DataFrame) -> DataFrame:
    out = scenes.with_times(scenes.segment(frames))
    return out.select("video_id", "scene_no", "start_key", "end_key", "start_ts", "end_ts", "duration_s", F.size("frames").cast("bigint").alias("n_frames"), "first_description")


@register("scene_segments", _with(_DENSE, _FLAGS, _SCENES) + _SEGMENTS)
def scene_segments(spark, sf_dir):
    return _segments(fx.frames(spark, sf_dir))


@register("scene_segments_sparse", _with(_SPARSE, _FLAGS, _SCENES) + _SEGMENTS)
def scene_segments_sparse(spark, sf_dir):
    return _segments(fx.frames(spark, sf_dir, sparse=True))


@register("scene_change_flags", _with(_DENSE, _FLAGS) + "SELECT video_id, frame_key, delta, is_change, scene_no FROM nu")
def scene_change_flags(spark, sf_dir):
    return scenes.flag_changes(fx.frames(spark, sf_dir)).select("video_id", "frame_key", "delta", "is_change", "scene_no")


@register("scene_delta_lists", _with(_DENSE, _FLAGS, _SCENES) + "SELECT video_id, scene_no, array_to_string(deltas, '|') AS deltas FROM st")
def scene_delta_lists(spark, sf_dir):
    return scenes.segment(fx.frames(spark, sf_dir)).select("video_id", "scene_no", F.array_join("deltas", "|").alias("deltas"))


@register(
    "meaningful_deltas_capped",
    _with(_DENSE, f"li AS (SELECT video_id, list_filter(list(trim(delta, {_WS}) ORDER BY frame_key), lambda x: lower(x) NOT IN ('no change', 'scene start')) AS m FROM fx GROUP BY video_id)")
    + "SELECT video_id, array_to_string(m[1:20], '|') AS shown, greatest(len(m) - 20, 0)::BIGINT AS more FROM li",
)
def meaningful_deltas_capped(spark, sf_dir):
    rows = fx.frames(spark, sf_dir).withColumn("delta", text.strip("delta"))
    lists = rows.groupBy("video_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("frame_key", "delta"))), lambda x: x["delta"]).alias("deltas"))
    shown, more = scenes.capped(scenes.meaningful("deltas"))
    return lists.select("video_id", F.array_join(shown, "|").alias("shown"), more.alias("more"))


_POLISH = f"""mp AS (SELECT user_id AS video_id, {_HMS.format('n')} AS ts, max('polished ' || n) AS description FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) WHERE n % 3 = 0 GROUP BY 1, 2),
po AS (SELECT st.*, coalesce(mp.description, st.first_description) AS text FROM st LEFT JOIN mp ON mp.video_id = st.video_id AND mp.ts = st.start_ts)"""


def _polished(spark, sf_dir):
    frames = fx.frames(spark, sf_dir)
    n = F.col("frame_key").cast("bigint")
    polished = frames.filter(n % 3 == 0).select("video_id", n.alias("pos"), timecode.hms(n).alias("ts"), F.concat(F.lit("polished "), n).alias("description"))
    return scenes.polish(scenes.with_times(scenes.segment(frames)), polished)


@register("scene_polish", _with(_DENSE, _FLAGS, _SCENES, _POLISH) + "SELECT video_id, scene_no, start_ts, text FROM po")
def scene_polish(spark, sf_dir):
    return _polished(spark, sf_dir).select("video_id", "scene_no", "start_ts", "text")


@register("frame_timestamps", _with(_DENSE) + f"SELECT video_id, frame_key, 'frames_dense/frame_' || frame_key || '.jpg' AS frame_path, {_HMS.format('frame_key::BIGINT')} AS ts FROM fx")
def frame_timestamps(spark, sf_dir):
    names = fx.frames(spark, sf_dir).select("video_id", F.concat(F.lit("frame_"), "frame_key", F.lit(".jpg")).alias("name"))
    key = timecode.frame_key_of_name("name")
    return names.select("video_id", key.alias("frame_key"), F.concat(F.lit("frames_dense/"), "name").alias("frame_path"), timecode.key_to_timestamp(key).alias("ts"))


# ---- timecodes and transcripts --------------------------------------------------------------------------------------------

_VARIANTS = f"""ts AS (SELECT conv_id AS video_id, turn, CASE turn % 8 WHEN 0 THEN {_HMS.format('turn * 7')} WHEN 1 THEN substr({_HMS.format('turn * 7')}, 4, 5) WHEN 2 THEN {_HMS.format('turn * 7')} || '.500'
  WHEN 3 THEN {_HMS.format('turn * 7')} || ',250' WHEN 4 THEN '00:75:' || turn WHEN 5 THEN 'x:' || turn || ':00' WHEN 6 THEN {_HMS.format('turn * 7')} || ' align:start' ELSE {_HMS.format('turn * 7')} || ':9' END AS t FROM conversations)"""


def _variants(spark, sf_dir):
    turn = F.col("turn")
    plain = timecode.hms(turn * 7)
    forms = [plain, F.substring(plain, 4, 5), F.concat(plain, F.lit(".500")), F.concat(plain, F.lit(",250")), F.concat(F.lit("00:75:"), turn), F.concat(F.lit("x:"), turn, F.lit(":00")), F.concat(plain, F.lit(" align:start")), F.concat(plain, F.lit(":9"))]
    return fx.table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("video_id"), "turn", F.element_at(F.array(*forms), (turn % 8 + 1).cast("int")).alias("t"))


_INT = "regexp_matches({0}, '^[+-]?[0-9]+$')"
_LEN_PART = f"trim(split_part(replace(t, ',', '.'), ':', {{0}}), {_WS})"


@register(
    "timecode_parse_lenient",
    _with(_VARIANTS, f"pa AS (SELECT video_id, turn, t, {_LEN_PART.format(1)} AS h, {_LEN_PART.format(2)} AS m, trim(split_part(split_part(replace(t, ',', '.'), ':', 3), '.', 1), {_WS}) AS s FROM ts)")
    + f"SELECT video_id, turn, t, coalesce(CASE WHEN {_INT.format('h')} AND {_INT.format('m')} AND {_INT.format('s')} THEN try_cast(h AS BIGINT) * 3600 + try_cast(m AS BIGINT) * 60 + try_cast(s AS BIGINT) END, -1)::BIGINT AS seconds FROM pa",
)
def timecode_parse_lenient(spark, sf_dir):
    return _variants(spark, sf_dir).withColumn("seconds", F.coalesce(timecode.seconds_lenient("t"), F.lit(-1).cast("bigint")))


@register(
    "timecode_parse_strict",
    _with(_VARIANTS, "pa AS (SELECT *, CASE WHEN length(t) - length(replace(t, ':', '')) = 1 THEN '00:' || t ELSE t END AS f FROM ts)")
    + r"SELECT video_id, turn, t, coalesce(CASE WHEN regexp_matches(f, '^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]([.,][0-9]{1,9})?$') THEN (substr(f, 1, 2)::BIGINT * 3600 + substr(f, 4, 2)::BIGINT * 60 + substr(f, 7, 2)::BIGINT) * 1000 + rpad(substr(f, 10), 3, '0')::BIGINT END, -1)::BIGINT AS millis FROM pa",
)
def timecode_parse_strict(spark, sf_dir):
    return _variants(spark, sf_dir).withColumn("millis", F.coalesce(timecode.millis_strict("t"), F.lit(-1).cast("bigint")))


@register("vtt_lines", _with(_LINES) + "SELECT video_id, file_name, line_no, line FROM ln")
def vtt_lines(spark, sf_dir):
    return fx.vtt_lines(spark, sf_dir)


@register("vtt_texts", _with(_LINES) + "SELECT video_id, file_name, value FROM tx")
def vtt_texts(spark, sf_dir):
    return fx.transcript_texts(spark, sf_dir)


@register("timing_lines", _with(_LINES) + f"SELECT video_id, line_no, contains(line, '-->') AS is_timing, NOT contains(line, '-->') AND trim(line, {_WS}) = '' AS is_blank FROM ln")
def timing_lines(spark, sf_dir):
    timing = timecode.is_timing("line")
    return fx.vtt_lines(spark, sf_dir).select("video_id", "line_no", timing.alias("is_timing"), (~timing & (text.strip("line") == "")).alias("is_blank"))


@register("cues", _with(_LINES, _CUES) + "SELECT video_id, file_name, line_no, start_ts, end_ts, s AS start_s, e AS end_s FROM cu")
def cues(spark, sf_dir):
    timing = fx.vtt_lines(spark, sf_dir).filter(timecode.is_timing("line"))
    timing = timing.select("video_id", "file_name", "line_no", timecode.timing_part("line", 1).alias("start_ts"), timecode.timing_part("line", 2).alias("end_ts"))
    return timing.withColumns({"start_s": timecode.seconds_lenient("start_ts"), "end_s": timecode.seconds_lenient("end_ts")})


@register("interval_pairs", _with(_LINES, _CUES, _MAP) + "SELECT cu.video_id, cu.line_no, sm.pos FROM cu JOIN sm ON sm.video_id = cu.video_id AND sm.t BETWEEN cu.s AND cu.e")
def interval_pairs(spark, sf_dir):
    return match.interval_pairs(match.cues_of(fx.vtt_lines(spark, sf_dir)), match.entries_of(fx.scene_map(spark, sf_dir))).select("video_id", "line_no", "pos")


def _matches(spark, sf_dir):
    entries = match.entries_of(fx.scene_map(spark, sf_dir))
    return match.greedy_match(match.cues_of(fx.vtt_lines(spark, sf_dir)), entries), entries


@register("greedy_match_dense", _with(_LINES, _CUES, _MAP, _walk("sm"), recursive=True) + "SELECT video_id, file_name, line_no, pos FROM mt")
def greedy_match_dense(spark, sf_dir):
    return _matches(spark, sf_dir)[0]


@register("match_unmatched", _with(_LINES, _CUES, _MAP, _walk("sm"), recursive=True) + "SELECT video_id, pos, ts FROM sm WHERE NOT EXISTS (SELECT 1 FROM mt WHERE mt.video_id = sm.video_id AND mt.pos = sm.pos)")
def match_unmatched(spark, sf_dir):
    matches, entries = _matches(spark, sf_dir)
    return match.unmatched(entries, matches).select("video_id", "pos", "ts")


def _gap_matches(spark, sf_dir):
    entries = gap_ops.gap_map(fx.gaps(spark, sf_dir)).withColumn("t", timecode.millis_strict("ts"))
    return match.greedy_match(match.cues_of(fx.vtt_lines(spark, sf_dir), strict=True), entries, gap_ops.KEYS, bucket=64_000), entries


@register("greedy_match_gap", _with(_LINES, _CUES, _GAPS, _GAPMAP, _walk("gm"), recursive=True) + "SELECT video_id, file_name, line_no, pos FROM mt")
def greedy_match_gap(spark, sf_dir):
    return _gap_matches(spark, sf_dir)[0]


@register(
    "weave_dense",
    _with(_LINES, _CUES, _MAP, _walk("sm"), "ch AS (SELECT video_id, file_name, line_no, 0 AS slot, line AS chunk FROM ln UNION ALL SELECT video_id, file_name, line_no, 1, chr(10) || '[Visual: ' || description || ']' || chr(10) FROM mt)", recursive=True)
    + "SELECT video_id, file_name, string_agg(chunk, '' ORDER BY line_no, slot) AS content FROM ch GROUP BY video_id, file_name",
)
def weave_dense(spark, sf_dir):
    matches, entries = _matches(spark, sf_dir)
    return weave.document(weave.after_timing(fx.vtt_lines(spark, sf_dir), matches.join(entries, ["video_id", "pos"])))


@register(
    "weave_before_blank",
    _with(
        _LINES,
        _CUES,
        _GAPS,
        _GAPMAP,
        _walk("gm"),
        f"mk AS (SELECT ln.*, mt.description IS NOT NULL AS hit, mt.description AS d, NOT contains(line, '-->') AND trim(line, {_WS}) = '' AS blank, count(mt.pos) OVER (PARTITION BY ln.video_id ORDER BY ln.line_no) AS place FROM ln LEFT JOIN mt ON mt.video_id = ln.video_id AND mt.line_no = ln.line_no)",
        "wt AS (SELECT video_id, file_name, place, max(d) FILTER (hit) AS d, min(line_no) FILTER (blank) AS bl, max(line_no) AS fin FROM mk WHERE place > 0 GROUP BY 1, 2, 3)",
        "wl AS (SELECT *, place = max(place) OVER (PARTITION BY video_id) AS is_last FROM wt)",
        "ch AS (SELECT video_id, file_name, line_no, 0 AS slot, line AS chunk FROM ln UNION ALL SELECT video_id, file_name, coalesce(bl, fin), CASE WHEN bl IS NULL THEN 1 ELSE -1 END, chr(10) || '[Visual Chart Description: ' || d || ']' || chr(10) FROM wl WHERE d <> '' AND (bl IS NOT NULL OR is_last))",
        recursive=True,
    )
    + "SELECT video_id, file_name, string_agg(chunk, '' ORDER BY line_no, slot) AS content FROM ch GROUP BY video_id, file_name",
)
def weave_before_blank(spark, sf_dir):
    matches, entries = _gap_matches(spark, sf_dir)
    return weave.document(weave.before_blank(fx.vtt_lines(spark, sf_dir), matches.join(entries, [*gap_ops.KEYS, "pos"])))


# ---- backlog --------------------------------------------------------------------------------------------------------------


@register("backlog_remaining", _with(_INDEX, _ANALYSIS, _LEFT) + "SELECT video_id, frame_key, frame_path FROM lf")
def backlog_remaining(spark, sf_dir):
    return backlog.remaining(fx.index(spark, sf_dir), fx.annotations(spark, sf_dir)).select("video_id", "frame_key", "frame_path")


@register("next_batch", _with(_INDEX, _ANALYSIS, _LEFT) + "SELECT video_id, frame_key FROM lf ORDER BY frame_key LIMIT 10")
def next_batch(spark, sf_dir):
    return backlog.next_batch(backlog.remaining(fx.index(spark, sf_dir), fx.annotations(spark, sf_dir)), 10).select("video_id", "frame_key")


def _batch(spark, sf_dir):
    return backlog.next_batch_per_video(backlog.remaining(fx.index(spark, sf_dir), fx.annotations(spark, sf_dir)), 10)


@register("next_batch_per_group", _with(_INDEX, _ANALYSIS, _LEFT, _BATCH) + "SELECT video_id, frame_key, rn FROM bt")
def next_batch_per_group(spark, sf_dir):
    return _batch(spark, sf_dir).select("video_id", "frame_key", "rn")


_LABELS = "SELECT video_id, min(frame_key) AS first_key, max(frame_key) AS last_key, count(*)::BIGINT AS n, min(frame_key) || '-' || max(frame_key) AS batch_label, 'dense_batch_prompt_' || min(frame_key) || '-' || max(frame_key) || '.txt' AS prompt_file, 'dense_batch_response_' || min(frame_key) || '-' || max(frame_key) || '.json' AS response_file FROM bt GROUP BY video_id"


@register("batch_labels", _with(_INDEX, _ANALYSIS, _LEFT, _BATCH) + _LABELS)
def batch_labels(spark, sf_dir):
    return backlog.labels(_batch(spark, sf_dir))


@register("previous_description", _with(_INDEX, _ANALYSIS, _LAST) + "SELECT video_id, previous_description FROM pd")
def previous_description(spark, sf_dir):
    return backlog.previous_description(fx.index(spark, sf_dir), fx.annotations(spark, sf_dir))


@register(
    "merge_upsert",
    _with(_ANALYSIS, _RESPONSE)
    + "SELECT coalesce(rs.video_id, an.video_id) AS video_id, coalesce(rs.frame_key, an.frame_key) AS frame_key, CASE WHEN rs.frame_key IS NOT NULL THEN rs.description ELSE an.description END AS description, CASE WHEN rs.frame_key IS NOT NULL THEN rs.delta ELSE an.delta END AS delta FROM an FULL OUTER JOIN rs ON rs.video_id = an.video_id AND rs.frame_key = an.frame_key",
)
def merge_upsert(spark, sf_dir):
    return backlog.merge(fx.annotations(spark, sf_dir), fx.responses(spark, sf_dir))


@register(
    "progress_counts",
    _with(_INDEX, _ANALYSIS)
    + 'SELECT coalesce(ix.video_id, an.video_id) AS video_id, count(ix.frame_key)::BIGINT AS total, count(an.frame_key)::BIGINT AS done, (count(ix.frame_key) - count(an.frame_key))::BIGINT AS left_by_count, count(*) FILTER (ix.frame_key IS NOT NULL AND an.frame_key IS NULL)::BIGINT AS "left" FROM ix FULL OUTER JOIN an ON an.video_id = ix.video_id AND an.frame_key = ix.frame_key GROUP BY 1',
)
def progress_counts(spark, sf_dir):
    return backlog.progress(fx.index(spark, sf_dir), fx.annotations(spark, sf_dir))


@register("responses_ready", _with(_INDEX, _RESPONSE) + "SELECT video_id, frame_key FROM ix WHERE EXISTS (SELECT 1 FROM rs WHERE rs.video_id = ix.video_id AND rs.frame_key = ix.frame_key)")
def responses_ready(spark, sf_dir):
    return backlog.ready(fx.index(spark, sf_dir), fx.responses(spark, sf_dir), backlog.KEY).select("video_id", "frame_key")


@register("responses_pending", _with(_INDEX, _RESPONSE) + "SELECT video_id, frame_key FROM ix WHERE NOT EXISTS (SELECT 1 FROM rs WHERE rs.video_id = ix.video_id AND rs.frame_key = ix.frame_key)")
def responses_pending(spark, sf_dir):
    return backlog.pending(fx.index(spark, sf_dir), fx.responses(spark, sf_dir), backlog.KEY).select("video_id", "frame_key")


# ---- gaps -----------------------------------------------------------------------------------------------------------------


@register(
    "gap_validate",
    _with(_VARIANTS, "pa AS (SELECT *, CASE WHEN length(t) - length(replace(t, ':', '')) = 1 THEN '00:' || t ELSE t END AS f FROM ts)")
    + "SELECT video_id, turn, f AS exact_timestamp, regexp_matches(f, '^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]([.,][0-9]{1,9})?$') AS is_valid FROM pa",
)
def gap_validate(spark, sf_dir):
    rows = _variants(spark, sf_dir).select("video_id", "turn", F.col("t").alias("exact_timestamp"), F.lit("c").alias("context_snippet"))
    return gap_ops.validate(rows).select("video_id", "turn", "exact_timestamp", "is_valid")


@register("gap_map_last_wins", _with(_GAPS, _GAPMAP) + "SELECT video_id, ts, pos, description FROM gm")
def gap_map_last_wins(spark, sf_dir):
    return gap_ops.gap_map(fx.gaps(spark, sf_dir)).select("video_id", "ts", "pos", "description")


def _targets(spark, sf_dir):
    """Nested targets as text; a missing description has no key."""
    one = F.when(F.col("has_vlm_description"), F.to_json(F.struct("exact_timestamp", "context_snippet", "vlm_description"))).otherwise(F.to_json(F.struct("exact_timestamp", "context_snippet")))
    files = fx.gaps(spark, sf_dir).withColumn("one", one).groupBy("video_id", "file_name").agg(render.ordered_text("one", "gap_idx", ",").alias("all"))
    return files.select("video_id", F.concat(F.lit('{"'), "file_name", F.lit('":['), "all", F.lit("]}")).alias("targets"))


@register("gap_explode", _with(_GAPS) + "SELECT video_id, file_name, gap_idx, exact_timestamp, context_snippet, CASE WHEN has_vlm_description THEN vlm_description END AS vlm_description, has_vlm_description FROM gp")
def gap_explode(spark, sf_dir):
    return gap_ops.explode_targets(_targets(spark, sf_dir)).select("video_id", "file_name", "gap_idx", "exact_timestamp", "context_snippet", "vlm_description", "has_vlm_description")


_NAMES = f"fn AS (SELECT *, 'frames/' || video_id || '_frame_' || replace({_HMS.format('t')}, ':', '-') || '.jpg' AS frame_path, video_id || '_' || gap_idx AS gap_id, video_id || '_' || file_name || '_' || gap_idx AS request_id FROM gp)"


@register("gap_ids", _with(_GAPS, _NAMES) + "SELECT video_id, gap_idx, gap_id, request_id FROM fn")
def gap_ids(spark, sf_dir):
    return gap_ops.with_frames(fx.gaps(spark, sf_dir)).select("video_id", "gap_idx", "gap_id", "request_id")


@register("frame_names", _with(_GAPS, _NAMES) + "SELECT video_id, gap_idx, frame_path FROM fn")
def frame_names(spark, sf_dir):
    return gap_ops.with_frames(fx.gaps(spark, sf_dir)).select("video_id", "gap_idx", "frame_path")


_THERE = f"th AS (SELECT DISTINCT 'frames/' || user_id || '_frame_' || replace({_HMS.format('(event_id % 20) * 9')}, ':', '-') || '.jpg' AS frame_path FROM events)"


def _there(spark, sf_dir):
    at = F.replace(timecode.hms(F.col("event_id") % 20 * 9), F.lit(":"), F.lit("-"))
    return fx.table(spark, sf_dir, "events").select(F.concat(F.lit("frames/"), "user_id", F.lit("_frame_"), at, F.lit(".jpg")).alias("frame_path"))


@register("gap_frame_ready", _with(_GAPS, _NAMES, _THERE) + "SELECT video_id, gap_idx, frame_path FROM fn WHERE frame_path IN (SELECT frame_path FROM th)")
def gap_frame_ready(spark, sf_dir):
    return gap_ops.frames_ready(gap_ops.with_frames(fx.gaps(spark, sf_dir)), _there(spark, sf_dir)).select("video_id", "gap_idx", "frame_path")


@register("gap_frame_missing", _with(_GAPS, _NAMES, _THERE) + "SELECT video_id, gap_idx, frame_path FROM fn WHERE frame_path NOT IN (SELECT frame_path FROM th)")
def gap_frame_missing(spark, sf_dir):
    return gap_ops.frames_missing(gap_ops.with_frames(fx.gaps(spark, sf_dir)), _there(spark, sf_dir)).select("video_id", "gap_idx", "frame_path")


@register("targets_renest", _with(_GAPS) + """SELECT video_id, '{"' || file_name || '":[' || string_agg('{"exact_timestamp":"' || exact_timestamp || '","gap_idx":' || gap_idx || '}', ',' ORDER BY gap_idx) || ']}' AS targets FROM gp GROUP BY video_id, file_name""")
def targets_renest(spark, sf_dir):
    return gap_ops.renest(fx.gaps(spark, sf_dir), ["exact_timestamp", "gap_idx"])


# ---- JSON, names, media ---------------------------------------------------------------------------------------------------


@register("json_map_rows", "SELECT user_id::VARCHAR AS video_id, 'e' || (event_id % 7) AS key, min(rn) - 1 AS pos, arg_max('p' || event_id, rn) AS value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id)::BIGINT AS rn FROM events) GROUP BY 1, 2")
def json_map_rows(spark, sf_dir):
    """A JSON object a user with repeated keys: the last value at the first place."""
    events = fx.table(spark, sf_dir, "events")
    entry = F.concat(F.lit('"e'), F.col("event_id") % 7, F.lit('":"p'), "event_id", F.lit('"'))
    files = events.withColumn("entry", entry).groupBy(F.col("user_id").cast("string").alias("video_id")).agg(F.concat(F.lit("{"), render.ordered_text("entry", "event_id", ","), F.lit("}")).alias("value"))
    return readers.map_entries(files).select("video_id", "key", "pos", "value")


@register("json_field_default", "SELECT event_id, coalesce(json_extract_string(props, '$.k'), 'none') AS k, coalesce(json_extract_string(props, '$.absent'), 'No change') AS delta FROM events")
def json_field_default(spark, sf_dir):
    parsed = fx.table(spark, sf_dir, "events").select("event_id", F.from_json("props", "map<string,string>").alias("m"))
    return parsed.select("event_id", text.or_default(F.try_element_at("m", F.lit("k")), "none").alias("k"), text.or_default(F.try_element_at("m", F.lit("absent")), "No change").alias("delta"))


@register("output_names", r"SELECT page_id, regexp_replace(n, '^(.+)\.[^.]*$', '\1') || '_enriched' || regexp_extract(n, '^.+(\.[^.]*)$', 1) AS output_name FROM (SELECT page_id, split_part(url, '/', -1) || CASE WHEN page_id % 2 = 0 THEN '.vtt' ELSE '' END AS n FROM pages)")
def output_names(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages")
    name = F.concat(text.base_name("url"), F.when(F.col("page_id") % 2 == 0, ".vtt").otherwise(""))
    return pages.select("page_id", sinks.output_name(name).alias("output_name"))


@register("transcript_filter", "SELECT page_id, contains(n, '_enriched') = false AND contains(n, '_final') = false AS dense, NOT ends_with(n, '_enriched.vtt') AS targeted FROM (SELECT page_id, split_part(url, '/', -1) || CASE page_id % 4 WHEN 0 THEN '_enriched' WHEN 1 THEN '_final' WHEN 2 THEN '_enriched_2' ELSE '' END || '.vtt' AS n FROM pages)")
def transcript_filter(spark, sf_dir):
    ends = F.element_at(F.array(*map(F.lit, ("_enriched", "_final", "_enriched_2", ""))), (F.col("page_id") % 4 + 1).cast("int"))
    pages = fx.table(spark, sf_dir, "pages").select("page_id", F.concat(text.base_name("url"), ends, F.lit(".vtt")).alias("n"))
    return pages.select("page_id", readers.is_transcript("n", "dense").alias("dense"), readers.is_transcript("n", "targeted").alias("targeted"))


@register("url_video_id", r"SELECT page_id, nullif(regexp_extract(CASE page_id % 3 WHEN 0 THEN 'https://www.youtube.com/watch?v=id_' || page_id || '&t=3' WHEN 1 THEN 'https://youtu.be/id_' || page_id ELSE url END, '(?:[?&]v=|/(?:shorts|embed|live|v)/|^(?:https?://)?youtu\.be/)([A-Za-z0-9_-]+)', 1), '') AS video_id FROM pages")
def url_video_id(spark, sf_dir):
    forms = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("https://www.youtube.com/watch?v=id_"), "page_id", F.lit("&t=3"))).when(F.col("page_id") % 3 == 1, F.concat(F.lit("https://youtu.be/id_"), "page_id")).otherwise(F.col("url"))
    return fx.table(spark, sf_dir, "pages").select("page_id", text.video_id_of(forms).alias("video_id"))


@register("data_url", "SELECT doc_id, 'data:image/jpeg;base64,' || to_base64(encode(text)) AS url FROM documents")
def data_url(spark, sf_dir):
    return fx.table(spark, sf_dir, "documents").select("doc_id", text.data_url(F.col("text").cast("binary")).alias("url"))


# ---- texts for annotators -------------------------------------------------------------------------------------------------


@register("frame_text", _with(_RESPONSE) + "SELECT video_id, frame_key, '[Description]' || chr(10) || coalesce(description, '') || chr(10) || chr(10) || '[Delta]' || chr(10) || coalesce(delta, '') || chr(10) AS content FROM rs")
def frame_text(spark, sf_dir):
    return fx.responses(spark, sf_dir).select("video_id", "frame_key", render.frame_text().alias("content"))


@register(
    "batch_prompt_text",
    _with(_INDEX, _ANALYSIS, _LEFT, _BATCH, _LAST)
    + f"SELECT b.video_id, '{render.BATCH_HEAD}' || chr(10) || chr(10) || '{render.BEFORE}' || coalesce(nullif(any_value(p.previous_description), ''), '{render.FIRST}') || chr(10) || chr(10) || '{render.LISTED}' || chr(10) || string_agg('- ' || b.frame_key || ': ' || b.frame_path, chr(10) ORDER BY b.frame_key) AS prompt FROM bt b LEFT JOIN pd p ON p.video_id = b.video_id GROUP BY b.video_id",
)
def batch_prompt_text(spark, sf_dir):
    return render.batch_prompt(_batch(spark, sf_dir), backlog.previous_description(fx.index(spark, sf_dir), fx.annotations(spark, sf_dir)))


@register(
    "scene_prompt_text",
    _with(
        _DENSE,
        _FLAGS,
        _SCENES,
        "sp AS (SELECT *, list_filter(deltas, lambda x: lower(x) NOT IN ('no change', 'scene start')) AS m FROM st)",
        "pp AS (SELECT video_id, scene_no, chr(10) || '[' || start_ts || ' --> ' || end_ts || ']' || chr(10) || 'First frame: ' || first_description || chr(10) || 'Changes (' || len(m) || '):' || coalesce(array_to_string(list_transform(m[1:20], lambda x: chr(10) || '  - ' || x), ''), '') || CASE WHEN len(m) > 20 THEN chr(10) || '  (further changes: ' || (len(m) - 20) || ')' ELSE '' END AS part FROM sp)",
    )
    + f"SELECT video_id, '{render.SCENE_HEAD}' || chr(10) || string_agg(part, chr(10) ORDER BY scene_no) AS prompt FROM pp GROUP BY video_id",
)
def scene_prompt_text(spark, sf_dir):
    return render.scene_prompt(scenes.with_times(scenes.segment(fx.frames(spark, sf_dir))))


@register(
    "commentary_text",
    _with(_DENSE, _FLAGS, _SCENES, _POLISH)
    + "SELECT video_id, '# Video Commentary: ' || video_id || chr(10) || chr(10) || 'What is shown on screen, scene by scene.' || chr(10) || chr(10) || string_agg('## [' || start_ts || '] Scene ' || scene_no || ' (' || duration_s || 's)' || chr(10) || text || chr(10), chr(10) ORDER BY scene_no) AS content FROM po GROUP BY video_id",
)
def commentary_text(spark, sf_dir):
    return render.commentary(_polished(spark, sf_dir))


@register("gap_prompt_text", _with(_LINES) + f"SELECT video_id, file_name, '{render.GAP_HEAD}' || chr(10) || chr(10) || value AS prompt FROM tx")
def gap_prompt_text(spark, sf_dir):
    return fx.transcript_texts(spark, sf_dir).select("video_id", "file_name", render.gap_prompt("value").alias("prompt"))


@register("vlm_prompt_text", _with(_GAPS, _NAMES) + "SELECT video_id, gap_idx, 'Image: ' || frame_path || chr(10) || chr(10) || 'Describe what this frame shows that the speaker does not say. Context: ' || coalesce(context_snippet, '') AS prompt FROM fn")
def vlm_prompt_text(spark, sf_dir):
    named = gap_ops.with_frames(fx.gaps(spark, sf_dir))
    return named.select("video_id", "gap_idx", render.vlm_prompt("frame_path", "context_snippet").alias("prompt"))


# ---- state, providers, streams --------------------------------------------------------------------------------------------


@register("analysis_json", _with(_RESPONSE) + """SELECT video_id, '{' || string_agg('"' || frame_key || '":{"description":"' || description || '","delta":' || coalesce('"' || delta || '"', 'null') || '}', ',' ORDER BY frame_key) || '}' AS content FROM rs GROUP BY video_id""")
def analysis_json(spark, sf_dir):
    return sinks.json_map(fx.responses(spark, sf_dir), "frame_key", F.struct("description", "delta"))


@register("provider_describe", "SELECT doc_id AS request_id, 'about ' || lang AS response, NULL::VARCHAR AS error FROM documents")
def provider_describe(spark, sf_dir):
    requests = fx.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("request_id"), F.col("lang").alias("prompt"))
    answered, _ = providers.Callback("about {}".format).answer(requests)
    return answered.select("request_id", "response", "error")


@register("stream_segments", _with(_DENSE, _FLAGS) + "SELECT video_id::VARCHAR AS video_id, frame_key, is_change, scene_no FROM nu")
def stream_segments(spark, sf_dir):
    """Online segmentation of the frames, streamed from a written table in one trigger."""
    import tempfile
    import uuid

    from .streaming.segments import segment_stream

    context = spark.sparkContext
    shared = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir") or tempfile.mkdtemp(prefix="stream-")
    at = f"{shared}/stream-{uuid.uuid4().hex}"
    fx.frames(spark, sf_dir).write.parquet(f"{at}/frames")
    streamed = spark.readStream.schema(spark.read.parquet(f"{at}/frames").schema).parquet(f"{at}/frames")
    query = segment_stream(streamed).writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(f"{at}/out").select("video_id", "frame_key", "is_change", "scene_no")


@register("session_order", _with(_DENSE) + "SELECT video_id, frame_key, lag(description) OVER (PARTITION BY video_id ORDER BY frame_key) AS before FROM fx")
def session_order(spark, sf_dir):
    """The description before each frame, the per-row form of the previous description."""
    return fx.frames(spark, sf_dir).select("video_id", "frame_key", F.lag("description").over(Window.partitionBy("video_id").orderBy("frame_key")).alias("before"))
