"""Column expressions with the exact string rules that transcripts and annotations need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the 29 white space characters that stripping removes.
WS29 = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0                　"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without white space (all 29 kinds) at both ends."""
    return F.btrim(col(c), F.lit(WS29))


def whole(c: Column | str) -> Column:
    """A decimal integer with optional sign and surrounding white space, else null."""
    s = strip(c)
    return F.when(s.rlike("^[+-]?[0-9]+$"), s.try_cast("bigint"))


def base_name(c: Column | str) -> Column:
    return F.substring_index(col(c), "/", -1)


def stem(c: Column | str) -> Column:
    """The name without its last extension; a leading dot is no extension."""
    return F.regexp_replace(base_name(c), r"(?<!^)\.[^.]*$", "")


def extension(c: Column | str) -> Column:
    return F.regexp_extract(base_name(c), r"(?<!^)(\.[^.]*)$", 1)


def parent(c: Column | str) -> Column:
    return F.regexp_extract(col(c), r"^(.*)/", 1)


def count_of(c: Column | str, piece: str) -> Column:
    c = col(c)
    return ((F.length(c) - F.length(F.replace(c, F.lit(piece), F.lit("")))) / len(piece)).cast("bigint")


def or_default(c: Column | str, default: str) -> Column:
    """The value, or a default where it is absent."""
    return F.coalesce(col(c), F.lit(default))


def or_falsy(c: Column | str, default: str) -> Column:
    """The value, or a default where it is absent or empty."""
    return F.coalesce(F.nullif(col(c), F.lit("")), F.lit(default))


def data_url(content: Column | str, mime: str = "image/jpeg") -> Column:
    return F.concat(F.lit(f"data:{mime};base64,"), F.replace(F.base64(col(content)), F.lit("\r\n"), F.lit("")))


def video_id_of(url: Column | str) -> Column:
    """The video id in the usual forms of a URL: ?v=, /shorts/, /embed/, /live/, /v/ or a short host's path; null if there is none."""
    url = col(url)
    known = F.coalesce(
        F.nullif(F.regexp_extract(url, r"[?&]v=([A-Za-z0-9_-]+)", 1), F.lit("")),
        F.nullif(F.regexp_extract(url, r"/(?:shorts|embed|live|v)/([A-Za-z0-9_-]+)", 1), F.lit("")),
        F.nullif(F.regexp_extract(url, r"^(?:https?://)?youtu\.be/([A-Za-z0-9_-]+)", 1), F.lit("")),
    )
    return known
