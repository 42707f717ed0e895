"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Candidates are found by pattern in every text. Their digests are counted over the corpus by distinct repositories and owners: a
value in many owners' repositories is an example that was copied, one that few owners have and that looks random is a live
credential. Base kinds always give spans; wider kinds give spans only where the value looks live.

Null texts have no spans; null repositories and owners count as one each; repeated rows are kept and count once for ownership; an
empty table gives an empty result; other columns are ignored. Positions are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle

#: Owners and repositories up to which a value is one owner's own, and bits that a live value holds at least.
OWNERS, REPOSITORIES, INFORMATION = 2, 3, 20.5

# Fixed patterns: kind, pattern, group that is the value, least length of the value. The first three are the base.
KINDS = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 20),
    ("bearer", r"Bearer\x20+([A-Za-z0-9+/_.=-]{16,})", 1, 16),
)
BASE = 3
#: Matches whose lengths are summed as one.
CHUNK = 128


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it stands in it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _spans(text: Column, place: int) -> Column:
    """Spans of one kind, leftmost and non-overlapping: an array of (start, place, end, value).

    Matches and the gaps between them alternate, so a match starts after all before it. These sums go by chunks: those of whole
    chunks, then those within one, so the work stays far from quadratic in texts with very many matches.
    """
    _, pattern, group, least = KINDS[place]
    found, whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(whole)), lambda x: F.char_length(x))
    rows = F.arrays_zip(gaps.alias("gap"), F.transform(whole, lambda x: F.char_length(x)).alias("n"), found.alias("value"))
    total = lambda a: F.aggregate(a, F.lit(0), lambda acc, x: acc + x)
    chunk = lambda i: F.floor(i / CHUNK).cast("int")

    def placed(rows: Column, steps: Column, before: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            first = chunk(i) * CHUNK
            start = F.get(before, chunk(i)) + total(F.slice(steps, first + 1, i - first)) + x["gap"]
            return F.struct(start.alias("start"), F.lit(place).alias("place"), (start + x["n"]).alias("end"), x["value"].alias("value"))

        return F.filter(F.transform(rows, one), lambda s: F.char_length(s["value"]) >= least)

    def summed(rows: Column, steps: Column) -> Column:
        sums = F.transform(F.sequence(F.lit(0), chunk(F.size(steps))), lambda c: total(F.slice(steps, c * CHUNK + 1, F.lit(CHUNK))))
        return _bound(sums, lambda s: _bound(F.transform(s, lambda _, c: total(F.slice(s, F.lit(1), c))), lambda before: placed(rows, steps, before)))

    spans = _bound(rows, lambda r: _bound(F.transform(r, lambda x: x["gap"] + x["n"]), lambda steps: summed(r, steps)))
    none = F.array().cast("array<struct<start:int,place:int,end:int,value:string>>")
    return F.when(text.rlike(pattern), spans).otherwise(none)


def candidates(text_col: str = "text") -> Column:
    """All spans of a text by start, then kind as listed."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.array_sort(F.flatten(F.array(*(_spans(text, i) for i in range(len(KINDS))))))


def as_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    kinds = F.array(*(F.lit(k[0]) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["place"]), s["start"], s["end"])), ",")


def looks_random(value: str = "value") -> Column:
    def bits(own: Column) -> Column:
        often = F.transform(F.array_distinct(own), lambda c: F.size(F.filter(own, lambda x: x == c)).cast("double"))
        return F.size(own) * F.log2(F.size(own)) - F.aggregate(often, F.lit(0.0), lambda acc, n: acc + n * F.log2(n))

    mixed = F.col(value).rlike("[A-Za-z]") & F.col(value).rlike("[0-9]")
    return mixed & (_bound(F.split(F.col(value), ""), bits) >= INFORMATION)


def ownership(occurrences: DataFrame, owners: int = OWNERS, repositories: int = REPOSITORIES) -> DataFrame:
    """Of occurrences (digest, repository, owner): digest, n_repositories, n_owners, and owned, whether few have it.

    Both counts first collapse a value's copies within a repository and owner in each task, so a hot value costs little.
    """
    pairs = occurrences.select("digest", "repository", "owner").distinct()
    some = lambda c: F.struct(F.col(c).isNull(), F.coalesce(c, F.lit("")))
    counts = pairs.groupBy("digest").agg(F.count_distinct(some("repository")).alias("n_repositories"), F.count_distinct(some("owner")).alias("n_owners"))
    return counts.withColumn("owned", (F.col("n_owners") <= owners) & (F.col("n_repositories") <= repositories))


def _judged(found: DataFrame, keys: list[str]) -> DataFrame:
    """For each row with candidates (column ``found``): keys and judged, its spans with ``live``."""
    each = found.select(*keys, "repository", "owner", F.explode("found").alias("s")).select(*keys, "repository", "owner", "s.*")
    each = each.withColumn("digest", F.sha2("value", 256))
    # Settled, so that the join stands on plain shuffles and the rows of a value that very many have can be split between tasks.
    judged = each.join(settle(ownership(each)), "digest", "left")
    live = F.coalesce("owned", F.lit(False)) & looks_random()
    span = F.struct("start", "place", "end", "value", live.alias("live"), "n_repositories", "n_owners")
    return judged.groupBy(*keys).agg(F.array_sort(F.collect_list(span)).alias("judged"))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", repository: Column | None = None, owner: Column | None = None) -> DataFrame:
    """id and spans of each row: an array of (start, place, end, value, live, n_repositories, n_owners), by start and place.

    Base spans are all there; spans of wider kinds only where they are live.
    """
    repository = F.col("source") if repository is None else repository
    owner = F.col("source") if owner is None else owner
    rows = df.select(F.col(id_col).alias("id"), repository.cast("string").alias("repository"), owner.cast("string").alias("owner"), candidates(text_col).alias("found"))
    rows = settle(rows.withColumn("row", F.monotonically_increasing_id()))
    judged = _judged(rows.filter(F.size("found") > 0), ["row", "id"])
    spans = F.filter("judged", lambda s: (s["place"] < BASE) | s["live"])
    with_some = judged.select("id", spans.alias("spans"))
    none = rows.filter(F.size("found") == 0).select("id", F.array().cast(with_some.schema["spans"].dataType).alias("spans"))
    return none.unionByName(with_some)


def redact(df: DataFrame, text_col: str = "text", repository: Column | None = None, owner: Column | None = None, mark: str = "[secret]") -> DataFrame:
    """The rows with the values of live spans replaced by a mark; values that overlap by one mark; all else stays as it is."""
    repository = F.col("source") if repository is None else repository
    owner = F.col("source") if owner is None else owner
    any_of = F.lit(False)
    for _, pattern, _, _ in KINDS:
        any_of = any_of | F.coalesce(F.col(text_col).rlike(pattern), F.lit(False))
    own = F.struct(*df.columns)
    found = df.filter(any_of).select(own.alias("own"), repository.cast("string").alias("repository"), owner.cast("string").alias("owner"), candidates(text_col).alias("found"))
    found = settle(found.withColumn("row", F.monotonically_increasing_id()))
    judged = _judged(found.filter(F.size("found") > 0), ["row"])
    rows = found.select("row", "own").join(judged, "row", "left")
    text = F.col("own")[text_col]
    live = F.transform(F.filter("judged", lambda s: s["live"]), lambda s: F.struct((s["end"] - F.char_length(s["value"])).alias("start"), s["end"].alias("end")))  # a value ends its match

    def step(acc, s):
        new = F.concat(acc["out"], F.substr(text, acc["upto"] + 1, s["start"] - acc["upto"]), F.lit(mark))
        return F.struct(F.when(s["start"] >= acc["upto"], new).otherwise(acc["out"]).alias("out"), F.greatest(acc["upto"], s["end"]).alias("upto"))

    cut = F.aggregate(F.array_sort(live), F.struct(F.lit("").alias("out"), F.lit(0).alias("upto")), step, lambda acc: F.concat(acc["out"], F.substr(text, acc["upto"] + 1, F.char_length(text))))
    new = F.when(F.size(live) > 0, cut).otherwise(text)
    changed = rows.select(*(new.alias(c) if c == text_col else F.col("own")[c].alias(c) for c in df.columns))
    return df.filter(~any_of).unionByName(changed)
