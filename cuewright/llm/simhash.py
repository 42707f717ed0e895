"""SimHash near-duplicates with BK-trees.

Fingerprints that differ in at most ``RADIUS`` = 2 bits agree on at least one of three blocks of bits. So the distinct
fingerprints are dealt by block and its value, each such shard is one BK-tree (children keyed by their integer Hamming
distance to the parent), and a search follows only edges within the radius. Shards above ``SHARD`` members are dealt again
by three blocks of the bits that are still free, which loses no link; so a shard is bounded whatever the data. A shard's tree
lives in the task that its members are dealt to: a tree broadcast to every task would grow with the corpus.

A shard gives links that connect what its searches connect, fewer than its members, never all pairs. Components then come
from rounds of hooking each fingerprint to its least neighbour and contracting, with the links in checkpoints.

Null and empty texts have fingerprint zero and link like any other; texts of fewer than three words have one shingle, the
whole sequence; repeated rows and exact copies share a fingerprint and so a component; null ids are kept and never are a
component's id, unless all its ids are null; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ROWS, append_columns, settle, tidy

RADIUS = 2
BITS = 64
SEED = 42
#: Members that a shard may have before it is dealt again, and how often that can happen (2^13 members at most after the last).
SHARD = 4_000
LEVELS = 4
#: Shingles hashed at once.
SLICE = 50_000
#: Words of the shingles that similarity is measured on.
WORDS = 5
#: Least shingles that a text is keyed by, and those of them that the first round uses, whose large shards it searches in blocks.
KEYS, USED, MEMBERS = 24, 4, 300
#: Components from which a shingle is common, the share of common ones from which a text is keyed by its whole prefix, and members of a block.
COMMON, SHARE, BLOCK = 500, 1 / 3, 2_000
#: Bits of the widest bitmap of a set.
WIDEST = 8_192
#: Rows (a document's place in a shard, a shingle) up to which a table is sent to every task; larger ones are joined by a shuffle.
SENT = 50_000
#: Shingles that a worker gathers before it adds them up.
COUNTED = 1 << 20
#: Hashes of ids up to which they are sent to every task, so that only the texts that are wanted are shuffled.
HASHES = 1_000_000


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64 bits; a bit is 1 if set in over half the XXH64 of the word shingles, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, and only ASCII white space splits
    n = max(1, len(words) - shingle + 1) if words else 0
    if not n:
        return 0
    ones = np.zeros(BITS, dtype=np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for at in range(0, n, SLICE):
        hashes = [digest(join(words[i : i + shingle]), SEED) for i in range(at, min(n, at + SLICE))]
        ones += np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """id and fingerprint (the 64 bits as a signed long) of each row."""

    def make():
        return lambda texts: [[x - (1 << 64) if x >> 63 else x for x in (fingerprint(t, shingle) for t in texts)]]

    return append_columns(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), ["text"], ["id"], [("fingerprint", T.LongType())], make)


def as_hex(fingerprint_col: str) -> F.Column:
    return F.lower(F.lpad(F.hex(fingerprint_col), 16, "0"))


class BKTree:
    """Integers under the Hamming distance; a node's children are keyed by their distance to it."""

    def __init__(self):
        self.root = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        node = self.root
        while d := (node[0] ^ value).bit_count():
            child = node[1].get(d)
            if child is None:
                node[1][d] = (value, {})
                return
            node = child

    def within(self, value: int, radius: int) -> list[int]:
        found, todo = [], [self.root] if self.root else []
        while todo:
            own, children = todo.pop()
            d = (own ^ value).bit_count()
            if d <= radius:
                found.append(own)
            todo += [c for k, c in children.items() if d - radius <= k <= d + radius]
        return found


def spanning_links(values: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links (value, least value that it is connected to) that connect exactly what pairs within the radius connect."""
    tree, parent = BKTree(), {}

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for v in values:
        parent[v] = v
        for other in tree.within(v, radius):
            a, b = root(v), root(other)
            parent[max(a, b)] = min(a, b)
        tree.add(v)
    return [(v, r) for v in values if (r := root(v)) != v]


def _masks(level: int) -> dict[int, int]:
    """Bits that are fixed on each path of blocks, 3^level of them."""
    out = {0: 0}
    for _ in range(level):
        grown = {}
        for path, mask in out.items():
            free = [i for i in range(BITS) if not mask >> i & 1]
            cut = [len(free) * k // (RADIUS + 1) for k in range(RADIUS + 2)]
            for k in range(RADIUS + 1):
                grown[path * (RADIUS + 1) + k] = mask | sum(1 << i for i in free[cut[k] : cut[k + 1]])
        out = grown
    return out


def _deal(members: DataFrame, level: int) -> DataFrame:
    """Rows of (fingerprint, path) dealt to the three blocks below their path."""
    masks = {p: m - (1 << 64) if m >> 63 else m for p, m in _masks(level).items()}
    k = RADIUS + 1
    shard = lambda path: F.struct(path.alias("path"), F.col("fingerprint").bitwiseAND(F.element_at(F.create_map(*[F.lit(x) for pm in masks.items() for x in pm]), path)).alias("key"))
    return members.select("fingerprint", F.explode(F.array(*[shard((F.col("path") * k + j).cast("int")) for j in range(k)])).alias("s")).select("fingerprint", "s.path", "s.key")


def links(distinct: DataFrame, radius: int = RADIUS, most: int = SHARD) -> DataFrame:
    """Links (a, b) between distinct fingerprints, b the lesser, that connect all within the radius."""
    if radius > RADIUS:
        raise ValueError(f"blocks are made for a radius of {RADIUS}")

    def search(batches):
        for batch in batches:
            pairs = [x for values in batch.column("values").to_pylist() for x in spanning_links([v & (1 << 64) - 1 for v in values], radius)]
            a = np.array(pairs, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], names=["a", "b"])

    rows, out = distinct.select("fingerprint", F.lit(0).alias("path")), None
    for level in range(1, LEVELS + 1):
        rows = _deal(rows, level)
        hot = None
        if level < LEVELS:
            hot = settle(rows.groupBy("path", "key").count().filter(F.col("count") > most).select("path", "key"))
            hot = None if hot.isEmpty() else hot
        cool = rows if hot is None else rows.join(hot, ["path", "key"], "left_anti")
        shards = cool.groupBy("path", "key").agg(F.collect_list("fingerprint").alias("values")).filter(F.size("values") > 1).select("values")
        found = shards.mapInArrow(search, "a long, b long")
        out = found if out is None else out.unionByName(found)
        if hot is None:
            break
        rows = settle(rows.join(hot, ["path", "key"], "left_semi").select("fingerprint", "path"))
    return settle(out.distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the links (a, b); equal roots, equal components.

    Every round hooks each node to the least of itself and its neighbours in a scrambled order, follows that once more, and
    contracts; nodes with links at least halve.
    """
    rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
    total = None
    while not edges.isEmpty():
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(F.col("a").alias("node")).agg(F.min(rank("b")).alias("least"))
        hook = settle(near.select("node", F.least(rank("node"), F.col("least"))["v"].alias("up")))
        again = hook.select(F.col("node").alias("up"), F.col("up").alias("top"))
        hook = settle(hook.join(again, "up", "left").select("node", F.coalesce("top", "up").alias("up")))
        if total is None:
            total = hook.select("node", F.col("up").alias("root"))
        else:
            step = hook.select(F.col("node").alias("root"), F.col("up").alias("to"))
            total = total.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        total = settle(total)
        new = lambda c: hook.select(F.col("node").alias(c), F.col("up").alias(f"{c}_up"))
        edges = settle(edges.join(new("a"), "a").join(new("b"), "b").select(F.col("a_up").alias("a"), F.col("b_up").alias("b")).filter("a <> b").distinct())
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")) if total is None else total


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct XXH64 of the word shingles (fewer words: the whole sequence; none: empty)."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    return np.unique(np.fromiter((digest(join(found[i : i + words]), SEED) for i in range(max(1, len(found) - words + 1))), dtype=np.uint64))


def bitmap(hashes: np.ndarray) -> bytes:
    """Each shingle flips one of about two bits a shingle, so two sets differ in at least as many shingles as their bitmaps in bits."""
    width = min(WIDEST, max(BITS, 1 << (2 * len(hashes) - 1).bit_length() if len(hashes) else BITS))
    flips = np.bincount((hashes & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").tobytes()


def prefix(size: int, similarity: float) -> int:
    """Shingles by any one order of which two similar sets have one in common among the first: those that a similar set may lack, and one."""
    return size - math.ceil(similarity * size - 1e-9) + 1 if size else 0


def _signed(values) -> list[int]:
    return [int(v) - (1 << 64) if int(v) >> 63 else int(v) for v in values]


def near_pairs(maps: list[bytes], sizes: list[int], roots: list[int], similarity: float):
    """(place, places) of pairs of different roots whose sizes and bitmaps allow the similarity; each pair once, none that is similar left out."""
    order = sorted(range(len(maps)), key=sizes.__getitem__)
    size, root = np.array([sizes[i] for i in order], dtype=np.int64), np.array([roots[i] for i in order], dtype=np.int64)
    wide = np.array([len(maps[i]) // 8 for i in order], dtype=np.int64)  # grows with the size
    begin = np.searchsorted(size, np.ceil(similarity * size - 1e-9), side="left")
    slack = (1 - similarity) / (1 + similarity)
    table = {w: np.frombuffer(b"".join(maps[order[k]] for k in np.flatnonzero(wide == w)), dtype=np.uint64).reshape(-1, w) for w in set(wide.tolist())}
    first = {w: int(np.searchsorted(wide, w)) for w in table}
    for i in range(1, len(order)):
        if (root[begin[i] : i] == root[i]).all():
            continue
        own = np.frombuffer(maps[order[i]], dtype=np.uint64)
        for w in set(wide[begin[i] : i].tolist()):
            a, b = max(int(begin[i]), first[w]), min(i, first[w] + len(table[w]))
            folded = np.bitwise_xor.reduce(own.reshape(-1, w), axis=0)
            apart = np.bitwise_count(table[w][a - first[w] : b - first[w]] ^ folded).sum(axis=1, dtype=np.int64)
            fit = a + np.flatnonzero((apart <= slack * (size[a:b] + size[i]) + 1e-9) & (root[a:b] != root[i]))
            if len(fit):
                yield order[i], [order[j] for j in fit.tolist()]


def similar_links(members: list[tuple[int, int, np.ndarray]], similarity: float) -> list[tuple[int, int]]:
    """Links between the nodes of members (node, root, shingles) of different roots that connect all whose Jaccard similarity is at least ``similarity``."""
    first: dict = {}
    parent, out = [first.setdefault(m[1], i) for i, m in enumerate(members)], []

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for i, near in near_pairs([bitmap(m[2]) for m in members], [len(m[2]) for m in members], [m[1] for m in members], similarity):
        own = members[i][2]
        for j in near:
            a, b = root(i), root(j)
            if a == b:
                continue
            other = members[j][2]
            both = len(np.intersect1d(own, other, assume_unique=True))
            if both >= similarity * (len(own) + len(other) - both) - 1e-9:
                parent[max(a, b)] = min(a, b)
                if members[i][0] != members[j][0]:
                    out.append((members[i][0], members[j][0]))
    return out


def sketches(df: DataFrame, id_col: str, text_col: str, shingle: int, similarity: float, words: int = WORDS, keys: int | None = KEYS) -> DataFrame:
    """id, fingerprint, and of the set of word shingles: digest, size, bitmap, and the least hashes, ``keys`` or the whole prefix."""

    def make():
        def run(texts):
            own = [shingle_set(t, words) for t in texts]
            kept = [min(n, keys or n) for n in (prefix(len(m), similarity) for m in own)]
            return [
                _signed(fingerprint(t, shingle) for t in texts),
                _signed(xxhash.xxh64_intdigest(m.tobytes(), SEED) for m in own),
                [len(m) for m in own],
                [bitmap(m) for m in own],
                [m[:n].view(np.int64) for m, n in zip(own, kept, strict=True)],
            ]

        return run

    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    fields = [("fingerprint", T.LongType()), ("digest", T.LongType()), ("size", T.LongType()), ("map", T.BinaryType()), ("keys", T.ArrayType(T.LongType()))]
    return append_columns(docs, ["text"], ["id"], fields, make)


def similar(docs: DataFrame, rows: DataFrame, similarity: float, known_links: DataFrame, words: int = WORDS, keys: int | None = KEYS) -> DataFrame:
    """Links (a, b) between fingerprints of documents (id, text; ``rows``: their sketches) whose sets of word shingles are similar.

    By any one order of the shingles, two similar sets have one in common among the first few (``prefix``). A first round deals the
    distinct sets by their four least hashes and connects most of what is similar. A second one looks at what is left: shingles of
    documents that aren't connected yet, where those that many components have stand last in the order, so that documents which
    share passages don't meet for that. A text with many common shingles is keyed by its whole prefix, any other by what isn't
    common of its 24 least: two sets of similarity 0.8 or more then share none with a chance of 10^-8 or less, if rare and common
    shingles are alike in both. ``keys=None`` takes whole prefixes, which leaves nothing to chance. Shards of common shingles are
    compared in pairs of blocks, but none that lies in one component. A pair is compared under its first shared key only;
    comparisons rule out by size and bitmap what can't be similar, and are exact on the rest.
    """
    rest = F.struct(F.col("id").isNull().alias("none"), "id", "size", "map", "keys")
    rows = rows.withColumnRenamed("fingerprint", "node")
    one = settle(rows.filter("size > 0").groupBy("digest").agg(F.min("node").alias("node"), F.min(rest).alias("x")).select("digest", "node", "x.id", "x.size", "x.map", "x.keys"))
    nodes = rows.filter("size > 0").select("digest", F.col("node").alias("a")).distinct()
    same = nodes.join(one.select("digest", F.col("node").alias("b")), "digest").filter("a <> b").select("a", "b")

    least = one.select("digest", F.posexplode(F.slice("keys", 1, USED)).alias("place", "key"))
    counts = settle(least.groupBy("key").count().filter("count > 1"))
    met = settle(least.join(counts, "key"))
    whole = F.col("count") <= MEMBERS
    order = F.array_sort(F.collect_list(F.when(whole, F.struct("place", "key"))))
    lists = met.groupBy("digest").agg(F.transform(order, lambda x: x["key"]).alias("keys"))
    block = F.when(whole, 0).otherwise(F.pmod(F.xxhash64("digest", "key"), F.ceil(F.col("count") / MEMBERS)))
    met = met.select("digest", "key", block.cast("long").alias("block")).join(lists, "digest").join(one.select("digest", F.col("node").alias("root"), "size", "map"), "digest")
    links = settle(_compared(docs, one, met, similarity, words).unionByName(same))

    roots = components(links.unionByName(known_links))
    base = settle(one.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    lists = base.select("digest", "root", "keys")
    shared = _shared(lists)
    hot = _common(lists, shared)
    if not hot.isEmpty():
        lists = _rare_first(docs, base, hot, similarity, words, keys)
        shared = _shared(lists)
    met = _blocks(_each(lists).join(shared, "key"))
    return links.unionByName(_compared(docs, one, met.join(lists.select("digest", "keys"), "digest").join(base.select("digest", "size", "map"), "digest"), similarity, words))


def _each(lists: DataFrame) -> DataFrame:
    return lists.select("digest", "root", F.explode("keys").alias("key"))


def _shared(lists: DataFrame) -> DataFrame:
    """The keys that documents of several components have, with the number n of those documents."""
    return settle(_each(lists).groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("key", "n"))


def _common(lists: DataFrame, shared: DataFrame) -> DataFrame:
    """The keys that more than ``COMMON`` components have."""
    some = settle(shared.filter(F.col("n") > COMMON).select("key"))
    roots = _each(lists).join(_sent(some, some.count()), "key").select("key", "root").distinct()
    return settle(roots.groupBy("key").count().filter(F.col("count") > COMMON).select("key"))


def _sent(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= SENT else df


def _fetched(docs: DataFrame, wanted: DataFrame, rows: int) -> DataFrame:
    """The documents that are wanted (by their id, ``of``), with what is wanted of them."""
    if SENT < rows <= HASHES:
        hashes = settle(wanted.select(F.xxhash64("of").alias("hash")).distinct())
        docs = docs.withColumn("hash", F.xxhash64("id")).join(F.broadcast(hashes), "hash", "left_semi").drop("hash")
    return docs.join(_sent(wanted, rows), F.col("id").eqNullSafe(F.col("of")))


def _rare_first(docs: DataFrame, base: DataFrame, hot: DataFrame, similarity: float, words: int, keys: int | None) -> DataFrame:
    """Keys of each digest (digest, root, keys) by the order that has common shingles last.

    Common is what is hot among the keys, and then what more than ``COMMON`` of those texts have that have much in common, until no
    more texts have. Of those texts the sets are fetched; any other keeps what isn't common of its least shingles, in their order.
    """
    held, counted, each = None, None, _each(base)
    while True:
        gone = each.join(_sent(hot, hot.count()), "key").groupBy("digest").agg(F.collect_set("key").alias("gone"))
        gone = settle(gone.join(base.select("digest", "id", "root", "size", "keys"), "digest"))
        much = (F.size("gone") > SHARE * F.size("keys")) if keys else F.lit(True)
        much |= F.size("keys") < (keys or 0)  # a whole prefix, which has to stay one
        some = gone.filter(much).select("id", "digest", "root", "size")
        some = settle(some if held is None else some.join(held, "digest", "left_anti"))
        if some.isEmpty():
            break
        new = settle(_sets(docs, some, words))
        held = new if held is None else settle(held.unionByName(new))
        counted = settle(_counted(new, counted))
        hot = settle(hot.unionByName(counted.select(F.explode("often").alias("key"))).distinct())
    left = base.join(gone.select("digest", "gone"), "digest", "left")
    left = left.select("digest", "root", F.when(F.col("gone").isNull(), F.col("keys")).otherwise(F.array_except("keys", "gone")).alias("keys"))
    if held is None:
        return settle(left)
    placed = _placed(held, hot, similarity, keys)
    return settle(left.join(held.select("digest"), "digest", "left_anti").unionByName(placed))


def _counted(sets: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Of each bucket of shingles: the keys, the numbers of sets that have them, and which more than ``COMMON`` have (``often``).

    Adds the sets of (set) to what was counted ``before``. Workers add up their shingles and deal them as arrays, a row a bucket, so
    that no set is counted in two rounds and what many texts of a task have in common is dealt once.
    """
    buckets, most = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), COMMON

    def added(parts):
        keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(at, weights=np.concatenate([n for _, n in parts])).astype(np.int64)

    def dealt(parts):
        keys, numbers = added(parts)
        bucket = (keys.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        own, first = np.unique(bucket[order], return_index=True)
        offsets = pa.array(np.append(first, len(order)), pa.int32())
        columns = [pa.array(own), *(pa.ListArray.from_arrays(offsets, pa.array(x[order])) for x in (keys, numbers))]
        return pa.RecordBatch.from_arrays(columns, names=["bucket", "keys", "numbers"])

    def deal(batches):
        parts, n = [], 0
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                own = whole.column("set").slice(at, ROWS).flatten().to_numpy()
                parts.append((own, np.ones(len(own), dtype=np.int64)))
                n += len(own)
                if n > COUNTED:
                    yield dealt(parts)
                    parts, n = [], 0
        if n:
            yield dealt(parts)
        tidy()

    def gather(batches):
        parts, n, limit = {}, 0, COUNTED
        for batch in batches:
            for bucket, keys, numbers in zip(*(batch.column(c) for c in ("bucket", "keys", "numbers")), strict=True):
                parts.setdefault(bucket.as_py(), []).append((keys.values.to_numpy().copy(), numbers.values.to_numpy().copy()))
                n += len(keys)
                if n > limit:
                    parts = {b: [added(p)] for b, p in parts.items()}
                    n = sum(len(p[0][0]) for p in parts.values())
                    limit = max(COUNTED, 2 * n)
        for bucket in sorted(parts):
            keys, numbers = added(parts.pop(bucket))
            columns = [pa.array([bucket]), *(pa.array([x], pa.list_(pa.int64())) for x in (keys, numbers, keys[numbers > most]))]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "keys", "numbers", "often"])
        tidy()

    rows = sets.select("set").mapInArrow(deal, "bucket long, keys array<long>, numbers array<long>")
    if before is not None:
        rows = rows.unionByName(before.drop("often"))
    return rows.repartition("bucket").mapInArrow(gather, "bucket long, keys array<long>, numbers array<long>, often array<long>")


def _placed(held: DataFrame, hot: DataFrame, similarity: float, keys: int | None) -> DataFrame:
    """The first keys of each set, what isn't common first; up to ``HASHES`` common shingles go to every task, more are joined."""
    if hot.count() <= HASHES:
        common = np.sort(np.array([r.key for r in hot.collect()], dtype=np.int64))
        sent = held.sparkSession.sparkContext.broadcast(common)

        def run(sets):
            out = []
            for own in sets:
                own = np.array(own, dtype=np.int64)
                is_common = np.isin(own, sent.value, assume_unique=True)
                whole = prefix(len(own), similarity)
                few = whole if keys is None or is_common.sum() >= SHARE * len(own) else min(whole, keys)
                out.append(np.concatenate((np.sort(own[~is_common]), np.sort(own[is_common])))[:few])
            return [out]

        return append_columns(held, ["set"], ["digest", "root"], [("keys", T.ArrayType(T.LongType()))], lambda: run)
    # Dealt by digest while it is one row, not a row a shingle.
    marked = held.repartition("digest").select("digest", "root", "size", F.explode("set").alias("key")).join(hot.withColumn("common", F.lit(True)), "key", "left")
    order = F.array_sort(F.collect_list(F.struct(F.coalesce("common", F.lit(False)).alias("common"), "key")))
    whole = (F.col("size") - F.ceil(similarity * F.col("size") - 1e-9) + 1).cast("int")
    few = whole if keys is None else F.when(F.col("n") >= SHARE * F.col("size"), whole).otherwise(F.least(whole, F.lit(keys)))
    placed = marked.groupBy("digest", "root", "size").agg(order.alias("all"), F.count("common").alias("n"))
    return placed.select("digest", "root", F.transform(F.slice("all", F.lit(1), few), lambda x: x["key"]).alias("keys"))


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """The columns of ``wanted`` but for the id, and the set of each digest, from the texts of their ids."""

    def make():
        def run(texts):
            made = [shingle_set(t, words) for t in texts]
            return [_signed(xxhash.xxh64_intdigest(m.tobytes(), SEED) for m in made), [m.view(np.int64) for m in made]]

        return run

    texts = _fetched(docs, wanted.withColumnRenamed("id", "of"), wanted.count())
    full = append_columns(texts, ["text"], ["digest", "root", "size"], [("own", T.LongType()), ("set", T.ArrayType(T.LongType()))], make)
    return full.filter("own = digest").drop("own").dropDuplicates(["digest"])


def _blocks(rows: DataFrame) -> DataFrame:
    """(digest, root, key, block) of rows with the number n of their key's; a large shard goes in pairs of blocks, except pairs that lie in one component."""
    whole = rows.filter(F.col("n") <= BLOCK).select("digest", "root", "key", F.lit(0).cast("long").alias("block"))
    large = rows.filter(F.col("n") > BLOCK)
    crowds = settle(large.groupBy("key", "root").count())
    if crowds.isEmpty():
        return whole
    large = large.join(crowds, ["key", "root"])
    crowd = F.col("count") > BLOCK
    own = F.when(crowd, F.xxhash64("root", F.pmod(F.xxhash64("digest"), F.ceil(F.col("count") / BLOCK)))).otherwise(F.pmod(F.xxhash64("root"), F.ceil(F.col("n") / BLOCK)))
    large = large.select("digest", "root", "key", own.alias("own"), F.when(crowd, F.col("root")).alias("of"))
    labels = settle(large.select("key", F.col("own").alias("other"), F.col("of").alias("other_of")).distinct())
    apart = F.coalesce(F.col("of") != F.col("other_of"), F.lit(True)) & ((F.col("own") != F.col("other")) | F.col("of").isNull())
    block = F.xxhash64(F.least("own", "other"), F.greatest("own", "other"))
    return whole.unionByName(large.join(labels, "key").filter(apart).select("digest", "root", "key", block.alias("block")))


def _groups(batches, keys: list[str], values: list[str]):
    """(key, rows) of each group of neighbouring rows with equal keys."""
    now, held = None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (*keys, *values)]
        for row in zip(*columns, strict=True):
            if row[: len(keys)] != now:
                if held:
                    yield now, held
                now, held = row[: len(keys)], []
            held.append(row[len(keys) :])
    if held:
        yield now, held


def _compared(docs: DataFrame, one: DataFrame, members: DataFrame, similarity: float, words: int) -> DataFrame:
    """Links that connect what is similar of different roots among members (digest, root, size, map, keys) of a block of a key.

    ``keys``: a member's keys, in the order of all, whose shards are compared whole; a pair that has one in common before this one has
    met there. Shards are gathered as sorted rows, not as lists in a row. Sets are fetched of those only that a bitmap doesn't rule out.
    """
    sort = lambda df: df.repartition("key", "block").sortWithinPartitions("key", "block")

    def near(batches):
        out = []

        def packed():
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 4)], names=["key", "block", "digest", "root"])

        for key, rows in _groups(batches, ["key", "block"], ["digest", "root", "size", "map", "keys"]):
            if len(rows) < 2:
                continue
            hit, before = set(), {}

            def earlier(i):
                if i not in before:
                    own = rows[i][4]  # noqa: B023
                    before[i] = frozenset(own[: own.index(key[0])] if key[0] in own else own)  # noqa: B023
                return before[i]

            for i, others in near_pairs([r[3] for r in rows], [r[2] for r in rows], [r[1] for r in rows], similarity):
                new = [j for j in others if earlier(i).isdisjoint(earlier(j))]
                if new:
                    hit |= {i, *new}
            out += [(*key, *rows[i][:2]) for i in sorted(hit)]
            if len(out) > 10_000:
                yield packed()
                out.clear()
        yield packed()
        tidy()

    found = sort(members.select("key", "block", "digest", "root", "size", "map", "keys")).mapInArrow(near, "key long, block long, digest long, root long")
    found = settle(found).join(one.select("digest", F.col("id").alias("of"), "node"), "digest")
    wanted = settle(found.groupBy("of").agg(F.collect_set(F.struct("key", "block", "node", "digest", "root")).alias("shards")))
    places = wanted.agg(F.sum(F.size("shards"))).head()[0] or 0

    def sets():
        def run(texts):
            made = [shingle_set(t, words) for t in texts]
            return [_signed(xxhash.xxh64_intdigest(m.tobytes(), SEED) for m in made), [m.tobytes() for m in made]]

        return run

    texts = _fetched(docs, wanted, places)
    full = append_columns(texts, ["text"], ["shards"], [("own", T.LongType()), ("set", T.BinaryType())], sets)
    each = full.select("own", "set", F.explode("shards").alias("s")).filter("own = s.digest").select("s.key", "s.block", "s.node", "s.root", "set")

    def search(batches):
        for _, rows in _groups((whole.slice(at, 64) for whole in batches for at in range(0, whole.num_rows, 64)), ["key", "block"], ["node", "root", "set"]):
            pairs = similar_links([(n, r, np.frombuffer(s, dtype=np.uint64)) for n, r, s in rows], similarity)
            a = np.array(pairs, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], names=["a", "b"])

    return settle(sort(each).mapInArrow(search, "a long, b long").distinct())


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = RADIUS, most: int = SHARD, similarity: float | None = None, keys: int | None = KEYS) -> DataFrame:
    """id, fingerprint, component_id (least id that links reach) and n_others (fingerprints of the component besides its own).

    With a ``similarity``, documents whose sets of five-word shingles have at least that Jaccard similarity are linked, too.
    """
    if similarity is None:
        docs = settle(fingerprints(df, id_col, text_col, shingle))
    else:
        docs = settle(sketches(df, id_col, text_col, shingle, similarity, keys=keys))
    distinct = settle(docs.groupBy("fingerprint").agg(F.min("id").alias("least")))
    edges = links(distinct, radius, most)
    if similarity is not None:
        texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        edges = edges.unionByName(similar(texts, docs, similarity, edges, keys=keys)).distinct()
    roots = components(edges)
    joined = distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    # Settled, so that the join stands on plain shuffles and a large component's rows can be split between tasks.
    groups = settle(joined.groupBy("root").agg(F.min("least").alias("component_id"), (F.count("*") - 1).alias("n_others")))
    of = settle(joined.select("fingerprint", "root").join(groups, "root").select("fingerprint", "component_id", "n_others"))
    return docs.select("id", "fingerprint").join(of, "fingerprint").select("id", "fingerprint", "component_id", "n_others")
