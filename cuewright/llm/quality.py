"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Each rule gives a severity: a statistic over a level that is fixed for it. A document's severity is the greatest of its rules'; it
is rejected where that exceeds its stratum's cutoff. Cutoffs are tried in a fixed order, the loosest first. At each step the exact
binomial tail of the labelled good documents that the step rejects is the p-value of "it rejects more than ``risk`` of the good
ones"; a stratum stops at the first step that isn't significant, so the steps need no correction among themselves. Strata share the
error level by Holm's rule: one whose last step is significant gives its part to the others. So with probability 1 - ``delta`` no
stratum loses more than ``risk`` of its good documents that pass the base verdict. Where labels are too few for any step, nothing is
rejected beyond the base verdict.

Null texts count as empty; a null stratum is a stratum of its own; documents without an id or a label don't take part in choosing
cutoffs; of several labels for one id the least counts, and of several rows with one id in a stratum the most severe, once;
repeated rows are kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACE, settle

RISK, DELTA = 0.05, 0.05
#: Windows of words whose repeats count.
REPEAT = 5
#: Cutoffs of severity in the order in which they are tried.
PATH = (4.0, 3.0, 2.5, 2.0, 1.75, 1.5, 1.25, 1.0, 0.9, 0.8, 0.7, 0.6, 0.55, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1)
#: Levels at which a rule's severity is 1: symbols a word character, shares of repeated lines and words, words in a text, and the mean
#: length of words: NORMAL is no fault, one longer or shorter by these much is.
SYMBOLS, DUP_LINES, REPEATS, FEWEST, NORMAL, LONGER, SHORTER = 0.1, 0.3, 0.2, 10.0, 5.0, 5.0, 2.0
#: Terms of a binomial tail that are added one by one; what is left of it is bounded by a geometric series.
TERMS = 2_000
#: A table of cutoffs up to so many strata is sent to every task.
SENT = 20_000


def statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang") -> DataFrame:
    """Word and line counts of each row: id, stratum, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    stratum = F.col(stratum_col).cast("string") if stratum_col else F.lit(None).cast("string")
    docs = df.select(F.col(id_col).alias("id"), stratum.alias("stratum"), text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    docs = docs.select(
        "id",
        "stratum",
        F.array_remove(F.split("text", SPACE + "+"), "").alias("words"),
        (F.char_length("text") - F.char_length(F.regexp_replace("text", r"[#*$%&|<>]", ""))).alias("n_symbols"),
        F.when(F.contains("text", F.lit("\n")), lines).alias("lines"),
    )
    docs = docs.withColumn("n_words", F.size("words").cast("long"))
    at = F.sequence(F.lit(1), (F.col("n_words") - (REPEAT - 1)).cast("int"))
    docs = docs.withColumn("hashes", F.when(F.col("n_words") > REPEAT, F.transform("words", lambda w: F.xxhash64(w))))
    windows = F.transform(F.slice("hashes", F.lit(1), F.greatest(F.col("n_words") - (REPEAT - 1), F.lit(0)).cast("int")), lambda h, i: F.xxhash64(h, *(F.get("hashes", i + k) for k in range(1, REPEAT))))
    docs = docs.select(
        "id",
        "stratum",
        "n_words",
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long"),
        F.coalesce(F.size("lines"), F.when(F.col("n_words") > 0, 1).otherwise(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("lines") - F.size(F.array_distinct("lines")), F.lit(0)).cast("long").alias("n_dup_lines"),
        "words",
        windows.alias("windows"),
    )
    # Only where digests repeat can windows repeat; there the windows themselves are compared.
    some = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = F.array_sort(F.transform(at, lambda i: F.struct(F.array_join(F.slice("words", i, REPEAT), " ").alias("w"), i.alias("i"))))
    docs = docs.withColumn("ordered", F.when(some, ordered)).drop("words", "windows")
    beside = lambda k: F.coalesce(F.get("ordered", k)["w"], F.lit(" "))  # noqa: E731  a blank alone is no window
    twice = F.filter(F.transform("ordered", lambda x, k: F.when((x["w"] == beside(k - 1)) | (x["w"] == beside(k + 1)), x["i"])), lambda i: i.isNotNull())
    docs = docs.withColumn("twice", F.array_sort(twice)).drop("ordered")
    step = lambda acc, i: F.struct((acc["n"] + F.least(F.lit(REPEAT), i + REPEAT - acc["end"])).alias("n"), (i + REPEAT).alias("end"))
    covered = F.aggregate("twice", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), step, lambda acc: acc["n"])
    return docs.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("twice")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def rules() -> dict[str, Column]:
    """The severity of each rule: 0 is no fault."""
    words, none = F.greatest("n_words", F.lit(1)), F.lit(0.0)
    mean = F.col("word_chars") / words
    return {
        "symbols": F.col("n_symbols") / F.greatest("word_chars", F.lit(1)) / SYMBOLS,
        "dup_lines": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)) / DUP_LINES,
        "repeats": F.col("n_repeat_words") / words / REPEATS,
        "long_words": F.greatest(none, (mean - NORMAL) / LONGER),
        "short_words": F.greatest(none, (NORMAL - mean) / SHORTER),
        "brevity": FEWEST / words,
    }


def severity() -> Column:
    return F.greatest(*rules().values())


def _log_gamma(x: Column) -> Column:
    """log of the gamma function for x >= 1, by Stirling's series at x + 8."""
    y = x + 8
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, F.lit(5)))
    return series - sum((F.log(x + k) for k in range(1, 8)), F.log(x))


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """An upper bound of P(Binomial(n, p) <= k) for k < n p, exact but for the rounding and a geometric rest; 1 for greater k."""
    n, k = n.cast("double"), k.cast("double")
    log_term = _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    ratio = lambda i: i * ((1 - p) / p) / (n - i + 1)  # noqa: E731  of the term before to that of i
    down = F.sequence(F.lit(0), (F.least(k, F.lit(float(TERMS))) - 1).cast("int"))
    down = F.when(k >= 1, down).otherwise(F.array().cast("array<int>"))

    def step(acc, j):
        term = acc["term"] * ratio(k - j)
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    rest = ratio(F.greatest(k - TERMS, F.lit(0.0)))
    total = F.aggregate(down, F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")), step, lambda acc: acc["sum"] + acc["term"] * rest / (1 - rest))
    return F.when((k < n * p) & (n > 0), F.least(F.lit(1.0), F.exp(log_term) * total)).otherwise(F.lit(1.0))


def cutoffs(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", risk: float = RISK, delta: float = DELTA, path: tuple = PATH) -> DataFrame:
    """A row a stratum that has a safe cutoff: stratum, cutoff, and the labels that show it (good, rejected)."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("label"))
    # A document's base verdict isn't the rules' doing, so risk is measured among good documents that pass it.
    good = stats.join(known.filter("label = 1").select("id"), "id").filter(~base_failed())
    once = good.groupBy("stratum", "id").agg(F.max(severity()).alias("worst"))
    step = F.size(F.filter(F.array(*map(F.lit, path)), lambda c: c >= F.col("worst")))  # the first that rejects it
    bins = once.groupBy("stratum", step.alias("step")).count()
    grid = bins.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("step", "count"))).alias("by_step"), F.sum("count").alias("good"))
    tried = grid.select("stratum", "good", "by_step", F.posexplode(F.array(*map(F.lit, path))).alias("k", "cutoff"))
    rejected = F.aggregate(F.map_entries("by_step"), F.lit(0).cast("long"), lambda acc, e: acc + F.when(e["key"] <= F.col("k"), e["value"]).otherwise(0))
    tried = tried.withColumn("rejected", rejected).drop("by_step").withColumn("p", binomial_tail(F.col("good"), F.col("rejected"), risk))
    order = Window.partitionBy("stratum").orderBy("k")
    tried = settle(tried.withColumn("p", F.max("p").over(order)))
    return tried.filter(F.col("p") <= _level(tried, delta, len(path))).groupBy("stratum").agg(F.min_by(F.struct("cutoff", "good", "rejected"), "cutoff").alias("x")).select("stratum", "x.*")


def _level(tried: DataFrame, delta: float, steps: int) -> float:
    """The level of strata that aren't through: ``delta`` over their number, by Holm's step-down over the p-values of last steps."""
    last = tried.filter(F.col("k") == steps - 1)
    n = last.count()
    ranked = last.select("p", (F.row_number().over(Window.orderBy("p")) - 1).alias("at"))  # a row a stratum
    through = ranked.filter(F.col("p") > delta / (n - F.col("at"))).agg(F.min("at")).head()[0]
    return delta / max(1, n - (n if through is None else through))


def verdicts(stats: DataFrame, chosen: DataFrame) -> DataFrame:
    """``statistics`` with base_failed, cutoff, failed_rules and kept."""
    by = settle(chosen.select(F.coalesce("stratum", F.lit("\0")).alias("of"), "cutoff"))
    if by.count() <= SENT:
        by = F.broadcast(by)
    out = stats.withColumn("of", F.coalesce("stratum", F.lit("\0"))).join(by, "of", "left").drop("of")
    failed = F.array_compact(F.array(*(F.when(v > F.col("cutoff"), F.lit(r)) for r, v in rules().items())))
    out = out.withColumn("failed_rules", failed).withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def judge(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """Statistics and verdict of each row, with cutoffs chosen on the labels."""
    stats = settle(statistics(df, id_col, text_col, stratum_col))
    return verdicts(stats, cutoffs(stats, labels, id_col, risk=risk, delta=delta))
