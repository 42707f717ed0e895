"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from .quality import DELTA, DUP_LINES, FEWEST, LONGER, NORMAL, PATH, REPEATS, RISK, SHORTER, SYMBOLS
from .secrets import BASE, INFORMATION, KINDS, OWNERS, REPOSITORIES

_WORDS = "greatest(n_words, 1)"
_RULES = {
    "symbols": f"n_symbols / greatest(word_chars, 1) / {SYMBOLS}::DOUBLE",
    "dup_lines": f"n_dup_lines / greatest(n_lines, 1) / {DUP_LINES}::DOUBLE",
    "repeats": f"n_repeat_words / {_WORDS} / {REPEATS}::DOUBLE",
    "long_words": f"greatest(0::DOUBLE, (word_chars / {_WORDS} - {NORMAL}::DOUBLE) / {LONGER}::DOUBLE)",
    "short_words": f"greatest(0::DOUBLE, ({NORMAL}::DOUBLE - word_chars / {_WORDS}) / {SHORTER}::DOUBLE)",
    "brevity": f"{FEWEST}::DOUBLE / {_WORDS}",
}

QUALITY = rf"""WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, lang, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
wi AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) > 5),
rp AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(ws[i:i + 4], ' ')) AS c FROM wi) WHERE c > 1),
cv AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM rp, range(5) r(j) GROUP BY doc_id),
st AS (SELECT w.doc_id, w.lang, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars, (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(cv.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN cv ON cv.doc_id = w.doc_id),
bf AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, greatest({", ".join(_RULES.values())}) AS severity FROM st),
lb AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
gd AS (SELECT bf.lang, bf.doc_id, max(severity) AS severity FROM bf JOIN lb ON lb.doc_id = bf.doc_id WHERE quality = 1 AND NOT base_failed GROUP BY bf.lang, bf.doc_id),
cu AS (SELECT unnest(range({len(PATH)})) AS j, unnest({list(PATH)}::DOUBLE[]) AS cutoff),
ct AS (SELECT lang, j, cutoff, count(*) AS n, count(*) FILTER (severity > cutoff) AS k FROM gd, cu GROUP BY lang, j, cutoff),
pv AS (SELECT lang, j, cutoff, CASE WHEN k < n * {RISK!r}::DOUBLE THEN list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({RISK!r}) + (n - i) * ln(1 - {RISK!r})))) ELSE 1 END AS p FROM ct),
wo AS (SELECT lang, j, cutoff, max(p) OVER (PARTITION BY lang ORDER BY j) AS p FROM pv),
fi AS (SELECT p, row_number() OVER (ORDER BY p) - 1 AS place, count(*) OVER () AS strata FROM wo WHERE j = {len(PATH) - 1}),
lv AS (SELECT {DELTA!r}::DOUBLE / greatest(1, max(strata) - coalesce(min(place) FILTER (p > {DELTA!r}::DOUBLE / (strata - place)), max(strata))) AS level FROM fi),
ok AS (SELECT lang, min(cutoff) AS cutoff FROM wo, lv WHERE p <= level GROUP BY lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(severity > cutoff, false) AS kept FROM bf LEFT JOIN ok ON ok.lang IS NOT DISTINCT FROM bf.lang"""


def _candidates(place: int) -> str:
    _, pattern, group, least = KINDS[place]
    quoted = pattern.replace("'", "''")
    return f"""SELECT doc_id, source, lang, {place} AS place, value,
  (list_sum(list_transform(gaps[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(whole[:i - 1], lambda x: length(x))), 0))::BIGINT AS s, length(whole[i]) AS n
  FROM (SELECT *, unnest(range(1, len(whole) + 1)) AS i, unnest(vals) AS value FROM (SELECT doc_id, source, lang, string_split_regex(t, '{quoted}') AS gaps, regexp_extract_all(t, '{quoted}', 0) AS whole, regexp_extract_all(t, '{quoted}', {group}) AS vals FROM d WHERE regexp_matches(t, '{quoted}')))
  WHERE length(value) >= {least}"""


_CHARACTERS = "string_split(ca.value, '')"
_HELD = f"length(ca.value) * log2(length(ca.value)) - list_sum(list_transform(list_transform(list_distinct({_CHARACTERS}), lambda c: len(list_filter({_CHARACTERS}, lambda x: x = c))), lambda n: n * log2(n)))"
_RANDOM = f"regexp_matches(ca.value, '[A-Za-z]') AND regexp_matches(ca.value, '[0-9]') AND {_HELD} >= {INFORMATION}"
_NAMED = "CASE place " + " ".join(f"WHEN {i} THEN '{k[0]}'" for i, k in enumerate(KINDS)) + " END || ':' || s || ':' || (s + n)"

SECRETS = f"""WITH d AS (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents),
ca AS ({" UNION ALL ".join(_candidates(i) for i in range(len(KINDS)))}),
ow AS (SELECT value, count(DISTINCT source || '/' || lang) AS repositories, count(DISTINCT source) AS owners FROM ca GROUP BY value),
ju AS (SELECT ca.*, owners <= {OWNERS} AND repositories <= {REPOSITORIES} AND {_RANDOM} AS live FROM ca JOIN ow ON ow.value = ca.value)
SELECT d.doc_id, count(*) FILTER (place = 0)::BIGINT AS n_assign, count(*) FILTER (place = 1)::BIGINT AS n_access, count(*) FILTER (place = 2)::BIGINT AS n_hex,
  sha256(coalesce(string_agg({_NAMED}, ',' ORDER BY s, place) FILTER (place < {BASE}), '')) AS base_sha256,
  coalesce(string_agg({_NAMED}, ',' ORDER BY s, place) FILTER (place < {BASE} OR live), '') AS spans, count(*) FILTER (live)::BIGINT AS n_live
FROM d LEFT JOIN ju ON ju.doc_id = d.doc_id GROUP BY d.doc_id"""

ORACLES = {"op1_quality": QUALITY, "op8_secrets": SECRETS}
