"""Mixing sources to target weights by a min-cost flow over membership patterns.

Documents are aggregated by the set of sources they belong to. A flow routes each pattern's words to the quotas of its
sources; a pattern's second pass costs more than its first, and so on, so words repeat only where quotas ask for it. The
flow fixes how many passes a pattern makes and what rest it adds; the documents of that rest are the first in an order
given by a seeded hash, found by histograms, so no task ever holds a whole pattern.

Null texts have size 0; a null source is a source of its own, last in order; equal rows (same id and text) fall together;
an empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict, deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import settle, word_count

#: Patterns and sources are planned on the driver; more of them than this is an error (they are aggregates, not rows).
MAX_PATTERNS = 200_000
#: Patterns that shared sources link into one flow: paths are searched one by one, so more than this is an error, too.
MAX_LINKED = 3_000
BINS = 10
#: Rounds of bins; what shares all their bits (a billionth of a pattern's documents) is taken or left together.
LEVELS = 3
SEED = 17


def source_targets(sizes: dict[str | None, int], share: float = 1.5, weights=(3, 1, 2), cap: float = 2.0) -> dict:
    """Quotas by source: ``share`` of all words dealt by weight, none above ``cap`` times its source, the rest dealt anew."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out: dict = {}
    left, active = share * sum(sizes.values()), list(order)
    while active:
        unit = left / sum(weight[s] for s in active)
        over = [s for s in active if unit * weight[s] > cap * sizes[s]]
        if not over:
            out |= {s: unit * weight[s] for s in active}
            break
        for s in over:
            out[s] = float(cap * sizes[s])
            left -= out[s]
        active = [s for s in active if s not in out]
    return out


def route(patterns: dict[tuple, int], targets: dict, passes: int = 2) -> dict[tuple, dict]:
    """Words that each pattern gives to each of its sources: a maximal flow of least cost, pass k of a pattern costing 2k + 1.

    Successive cheapest paths, one group of sources that patterns connect at a time; ties by order, so reruns agree.
    """
    parent = {s: s for s in targets}

    def root(s):
        while parent[s] != s:
            parent[s] = s = parent[parent[s]]
        return s

    for p in patterns:
        for s in p[1:]:
            parent[root(s)] = root(p[0])
    groups: dict = defaultdict(list)
    for p in patterns:
        groups[root(p[0])].append(p)
    flow: dict[tuple, dict] = {p: {} for p in patterns}
    for group in groups.values():
        if len(group) > MAX_LINKED:
            raise ValueError(f"more than {MAX_LINKED} linked membership patterns")
        _cheapest(group, patterns, targets, passes, flow)
    return flow


def _cheapest(group, size, targets, passes, flow) -> None:
    arcs: list[list] = []  # to, capacity left, cost; the arc back is at the index with its last bit flipped
    at: dict = defaultdict(list)

    def arc(a, b, capacity, cost):
        for x, y, c, k in ((a, b, capacity, cost), (b, a, 0, -cost)):
            at[x].append(len(arcs))
            arcs.append([y, c, k])

    sources = list(dict.fromkeys(s for p in group for s in p))
    for i, p in enumerate(group):
        for k in range(passes):
            arc("in", ("p", i), size[p], 2 * k + 1)
        for s in p:
            arc(("p", i), ("s", s), passes * size[p], 0)
    for s in sources:
        arc(("s", s), "out", round(targets[s]), 0)
    while True:
        best, by, queue, inside = {"in": 0}, {}, deque(["in"]), {"in"}
        while queue:
            x = queue.popleft()
            inside.discard(x)
            for e in at[x]:
                y, left, cost = arcs[e]
                if left > 0 and best[x] + cost < best.get(y, 1 << 60):
                    best[y], by[y] = best[x] + cost, e
                    if y not in inside:
                        inside.add(y)
                        queue.append(y)
        if "out" not in best:
            break
        path, y = [], "out"
        while y != "in":
            path.append(by[y])
            y = arcs[by[y] ^ 1][0]
        push = min(arcs[e][1] for e in path)
        for e in path:
            arcs[e][1] -= push
            arcs[e ^ 1][1] += push
    for i, p in enumerate(group):
        for e in at[("p", i)]:
            if not e & 1 and arcs[e][0] != "in" and (n := arcs[e ^ 1][1]):
                flow[p][arcs[e][0][1]] = n


def sized(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", member_col: str = "source", seed: int = SEED) -> DataFrame:
    """id, pattern (sorted distinct sources; one null source: an array holding null), size in words, seeded order."""
    kind = df.schema[member_col].dataType.typeName()
    members = F.array(member_col) if kind != "array" else F.array_sort(F.array_distinct(member_col))
    members = F.when(F.coalesce(F.size(members), F.lit(0)) <= 0, F.array(F.lit(None).cast("string"))).otherwise(members)
    return df.select(F.col(id_col).alias("id"), members.alias("pattern"), word_count(text_col).alias("size"), seeded(id_col, text_col, seed).alias("turn"))


def seeded(id_col: str, text_col: str, seed: int) -> F.Column:
    return F.xxhash64(F.lit(seed), F.col(id_col), F.xxhash64(text_col)).bitwiseAND(F.lit((1 << 60) - 1))


def plan(docs: DataFrame, share: float = 1.5, weights=(3, 1, 2), cap: int = 2, targets: dict | None = None) -> tuple[DataFrame, dict, dict]:
    """Passes and last turn by pattern, from rows of ``sized``; also the sizes and targets by source.

    The result has a row a pattern: whole passes, and the last turn (inclusive) of the documents that get one more.
    """
    spark = docs.sparkSession
    totals = {tuple(r.pattern): r.size for r in docs.groupBy("pattern").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()}
    if len(totals) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    totals = dict(sorted(totals.items(), key=lambda x: [(s is None, s or "") for s in x[0]]))
    of: dict = defaultdict(int)
    for p, n in totals.items():
        for s in p:
            of[s] += n
    targets = targets or source_targets(of, share, weights, cap)
    flow = route(totals, targets, cap)
    rest = []
    for p, n in totals.items():
        take = sum(flow[p].values())
        passes = take // n if n else 0
        rest.append((list(p), int(passes), int(take - passes * n)))
    schema = "pattern array<string>, passes long, rest long"
    ends = F.broadcast(spark.createDataFrame(rest, schema))
    found = ends.filter("rest > 0").select("pattern", "rest", F.lit(0).cast("long").alias("low"))
    # The turn of the last documents: each round looks into one of 2^BINS bins of the part that holds them.
    for step in range(1, LEVELS + 1):
        shift = 60 - BINS * step
        inside = docs.join(F.broadcast(found), "pattern").filter(F.shiftright("turn", shift + BINS) == F.shiftright("low", shift + BINS))
        bins = inside.groupBy("pattern", F.shiftright("turn", shift).alias("bin")).agg(F.sum("size").alias("n"), F.max("rest").alias("rest"))
        upto = F.sum("n").over(Window.partitionBy("pattern").orderBy("bin"))
        last = bins.withColumn("upto", upto).filter("upto >= rest").groupBy("pattern").agg(F.min_by(F.struct("bin", "n", "upto", "rest"), "bin").alias("x"))
        found = settle(last.select("pattern", (F.col("x.rest") - (F.col("x.upto") - F.col("x.n"))).alias("rest"), F.shiftleft("x.bin", shift).alias("low"), F.col("x.n").alias("n")))
    span = (1 << shift) - 1
    last = F.when(F.col("n") - F.col("rest") <= F.col("rest"), F.col("low") + span).otherwise(F.col("low") - 1)  # the nearer
    found = found.select("pattern", last.alias("last"))
    return ends.join(F.broadcast(found), "pattern", "left").select("pattern", "passes", F.coalesce("last", F.lit(-1)).alias("last")), dict(of), targets


def taken(docs: DataFrame, ends: DataFrame) -> DataFrame:
    """How often the mix takes each row (of ``sized``, or any with its pattern and turn): copies."""
    return docs.join(F.broadcast(ends), "pattern").withColumn("copies", F.col("passes") + F.when(F.col("turn") <= F.col("last"), 1).otherwise(0))
