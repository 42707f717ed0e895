"""Personal data by patterns and a semi-Markov conditional random field.

Patterns give base spans. A semi-Markov chain adds spans that patterns miss. Islands are runs of words with a digit or an at sign, and
addresses that are spelt out ("name at mail dot example dot com"). Every stretch of up to ``LONGEST`` words of an island is a
candidate segment, described as a whole (its digits, separators, checksum, brackets, spelling, words), and a dynamic programme over
segments and types chooses boundaries and types jointly; it describes a segment when it gets to it, so what it holds of an island
is a few numbers a word. Words outside islands are in no candidate, so islands are independent. The weights are fitted by gradient
ascent on the conditional likelihood of islands of a bounded sample. Gold segments are the base spans, and the same islands with
phone numbers that have lost their plus sign, with addresses spelt out, and with a lone entity twice in a row, so that whole-span
evidence counts without those marks.

Null and empty texts have no spans; null ids and repeated rows are kept; an empty table gives an empty result and an untrained
model that adds nothing; other columns are ignored. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import json
import math
import re
from bisect import bisect_left
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns

KINDS = ("email", "ip", "card", "phone")
#: Words of a segment at most.
LONGEST = 7
#: The sample to learn from: documents (chosen by a hash of the text), distinct islands (the most frequent), and words of one, at most.
#: All islands of all documents are decoded.
TRAIN_DOCS, TRAIN_ISLANDS, ISLAND = 20_000, 2_000, 12

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SOME = re.compile("[0-9@]")
_WORD = re.compile(r"\S+")
_AT, _DOT = r"(?:at|[(\[]at[)\]])", r"(?:dot|[(\[]dot[)\]])"
_SPELT = re.compile(rf"(?i)(?<!\S)\S+\s+{_AT}\s+\S+(?:\s+{_DOT}\s+\S+)+")
_WHOLE_SPELT = re.compile(rf"(?i)[A-Z0-9._%+-]+\s+{_AT}\s+[A-Z0-9-]+(?:\s+{_DOT}\s+[A-Z0-9-]+)+")
_MAYBE_SPELT = re.compile(r"(?i)\bdot\b")
_EDGES = ".,;:!?\"'|<>[]{}"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if not i & 1 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start: leftmost and non-overlapping per kind; matches that fail a check are dropped."""
    out: list[tuple[int, int, int]] = []
    if "@" in text:
        done, place = 0, text.find("@")
        while place >= 0:
            begin = place
            while begin > done and text[begin - 1] in _LOCAL:
                begin -= 1
            m = _DOMAIN.match(text, place + 1) if begin < place else None
            if m:
                out.append((0, begin, m.end()))
                done = m.end()
            else:
                done = max(done, place)  # what precedes this sign can't be part of a later local part
            place = text.find("@", max(place + 1, done))
    if _SOME.search(text):
        for m in _IP.finditer(text):
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
                out.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13 and 13 <= len(d := _only_digits(m[0])) <= 19 and luhn(d):
                out.append((2, m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_only_digits(m[0])) <= 15:
                    out.append((3, m.start(), m.end()))
    return out


def islands(text: str) -> list[list[tuple[int, int]]]:
    """Runs of neighbouring words that have a digit or an at sign, or stand in an address that is spelt out, as the places of their words."""
    spelt = [m.span() for m in _SPELT.finditer(text)] if _MAYBE_SPELT.search(text) else []
    if not spelt and not _SOME.search(text):
        return []
    out: list[list[tuple[int, int]]] = []
    neighbour, at = False, 0
    for m in _WORD.finditer(text):
        while at < len(spelt) and spelt[at][1] <= m.start():
            at += 1
        if at < len(spelt) and spelt[at][0] <= m.start() or _SOME.search(m[0]):
            if neighbour:
                out[-1].append(m.span())
            else:
                out.append([m.span()])
            neighbour = True
        else:
            neighbour = False
    return out


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start] in _EDGES:
        start += 1
    while start < end and text[end - 1] in _EDGES:
        end -= 1
    return start, end


def features(span: str, words: int) -> list[str]:
    """Whole-span features."""
    digits = _only_digits(span)
    n, letters = len(digits), sum(c.isalpha() for c in span)
    bin_of = next(str(b) for b in (0, 4, 6, 8, 9, 10, 11, 12, 15, 19, 10**9) if n <= b)
    out = [f"digits<={bin_of}", f"words={words}", f"letters={0 if not letters else 1 if letters < n else 2}"]
    if span.count("@") == 1 and "." in span.rpartition("@")[2]:
        out.append("at domain")
    elif "@" in span:
        out.append("at")
    parts = span.split(".")
    if len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts):
        out.append("quad")
    if 13 <= n <= 19 and not letters:
        out.append("checksum" if luhn(digits) else "no checksum")
    if span.startswith("+"):
        out.append("plus")
    if re.search(r"\([0-9]{2,4}\)", span):
        out.append("bracketed code")
    if re.search(r"[0-9]{3}[ .-][0-9]{4}$", span):
        out.append("line number")
    if not letters and re.fullmatch(r"[0-9 ().+-]+", span):
        out.append("number")
    if words >= 5 and _WHOLE_SPELT.fullmatch(span):
        out.append("spelt")
    return out


class Model:
    """Weights by (kind, feature), of each kind's bias, and of a segment that follows another entity."""

    def __init__(self, weight: dict[tuple[int, str], float], bias: list[float], adjoin: float):
        self.weight, self.bias, self.adjoin = weight, bias, adjoin
        self.known: dict[tuple[str, ...], tuple[float, int]] = {}

    def scores(self, own: list[str]) -> list[float]:
        """Of a segment with these features as each kind."""
        return [self.bias[kind] + sum(self.weight.get((kind, f), 0.0) for f in own) for kind in range(len(KINDS))]

    def best(self, own: list[str]) -> tuple[float, int]:
        """The best kind's score and the kind; different sets of features are few."""
        key = tuple(own)
        if key not in self.known:
            scores = self.scores(own)
            self.known[key] = max((s, -kind) for kind, s in enumerate(scores))
        score, kind = self.known[key]
        return score, -kind


UNTRAINED = Model({}, [-20.0] * len(KINDS), -1.0)


def _candidates(text: str, words: list[tuple[int, int]]):
    """For each word the features of the segments that end with it, by their number of words; one word's at a time."""
    for i in range(len(words)):
        row = []
        for k in range(1, min(LONGEST, i + 1) + 1):
            start, end = trimmed(text, words[i - k + 1][0], words[i][1])
            row.append(features(text[start:end], k))
        yield row


def decode(model: Model, candidates) -> list[tuple[int, int, int]]:
    """The best segments (first word, words, kind) of an island, of rows as ``_candidates`` gives them."""
    # best[i]: scores of the first i words where the last of them is outside (0) or ends an entity (1).
    best, back = [(0.0, -math.inf)], [(0, None)]
    for i, row in enumerate(candidates, 1):
        prior = best[i - 1]
        top, how = -math.inf, None
        for k, own in enumerate(row, 1):
            before = best[i - k]
            e = int(before[1] + model.adjoin > before[0])
            score, kind = model.best(own)
            s = before[e] + (model.adjoin if e else 0.0) + score
            if s > top:
                top, how = s, (k, kind, e)
        best.append((max(prior), top))
        back.append((int(prior[1] > prior[0]), how))
    found, i = [], len(best) - 1
    e = int(best[i][1] > best[i][0])
    while i:
        if e:
            k, kind, e = back[i][1]
            found.append((i - k, k, kind))
            i -= k
        else:
            i, e = i - 1, back[i][0]
    return found[::-1]


def find(text: str | None, model: Model) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and those that the model adds beside them."""
    text = text or ""
    base = base_spans(text)
    if not model.weight:
        return base, []
    taken = _Spans(base)
    added = []
    for words in islands(text):
        for first, k, kind in decode(model, _candidates(text, words)):
            start, end = trimmed(text, words[first][0], words[first + k - 1][1])
            if start < end and not taken.within(start, end):
                added.append((kind, start, end))
    return base, added


class _Spans:
    """Spans by kind, each kind's disjoint and in order, so that those in a stretch are found by bisection."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.of = [[(s, e) for k, s, e in spans if k == kind] for kind in range(len(KINDS))]

    def within(self, start: int, end: int) -> list[tuple[int, int, int]]:
        """(kind, start, end) of those that overlap a stretch."""
        out = []
        for kind, own in enumerate(self.of):
            i = bisect_left(own, (end, 0)) - 1
            while i >= 0 and own[i][1] > start:
                out.append((kind, *own[i]))
                i -= 1
        return out


def _spelt(address: str) -> str:
    """An address in words; bracketed ones where its length is even."""
    local, _, domain = address.partition("@")
    at, dot = (" [at] ", " [dot] ") if len(address) % 2 == 0 else (" at ", " dot ")
    return local + at + domain.replace(".", dot)


def _examples(text: str):
    """Islands to learn from: candidate features, and the gold segments that base spans make, with and without what patterns ask for."""
    base = _Spans(base_spans(text))
    whole = lambda words: [[0, len(words), 0]]
    for words in islands(text):
        if len(words) > ISLAND:
            continue
        gold = []
        for kind, s, e in base.within(words[0][0], words[-1][1]):
            held = [i for i, (a, b) in enumerate(words) if a < e and s < b]
            if held and len(held) <= LONGEST:
                gold.append([held[0], len(held), kind])
        gold.sort()
        if any(a[0] + a[1] > b[0] for a, b in zip(gold, gold[1:], strict=False)):
            continue
        yield {"c": list(_candidates(text, words)), "g": gold}
        if len(gold) == 1 and gold[0][1] == len(words) and 2 * len(words) <= ISLAND:
            own = " ".join(text[a:b] for a, b in words)
            twice = islands(f"{own} {own}")
            if len(twice) == 1 and len(twice[0]) == 2 * len(words):
                yield {"c": list(_candidates(f"{own} {own}", twice[0])), "g": [gold[0], [len(words), *gold[0][1:]]]}
        if any(g[2] == 3 for g in gold):
            plain = "".join(text[a:b].replace("+1", "").replace("+", "") + " " for a, b in words)
            moved = islands(plain)
            if len(moved) == 1 and len(words) - len(moved[0]) in (0, 1) and len(gold) == 1:
                yield {"c": list(_candidates(plain, moved[0])), "g": [[0, len(moved[0]), 3]]}
        if len(words) == 1 and len(gold) == 1 and gold[0][2] == 0:
            plain = _spelt(text[slice(*trimmed(text, *words[0]))])
            moved = islands(plain)
            if len(moved) == 1 and 5 <= len(moved[0]) <= LONGEST:
                yield {"c": list(_candidates(plain, moved[0])), "g": whole(moved[0])}


def fit(df: DataFrame, text_col: str = "text", most: int = TRAIN_DOCS) -> Model:
    """Learn the weights from a bounded sample of the texts."""
    some = df.select(F.col(text_col).alias("text")).filter(F.col("text").rlike("[0-9@]"))  # base spans have one of these
    n = some.count()
    if n > most:
        some = some.filter(F.pmod(F.xxhash64("text", F.lit("train")), F.lit(1 << 40)) < int((1 << 40) * most / n))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([json.dumps(x) for t in batch.column("text").to_pylist() for x in _examples(t)], pa.string())], names=["island"])

    rows = some.mapInArrow(run, "island string").groupBy("island").count().orderBy(F.desc("count"), "island").limit(TRAIN_ISLANDS).collect()
    return _fit([(json.loads(r["island"]), r["count"]) for r in rows])


def expectations(scores: list[list[np.ndarray]], adjoin: float) -> tuple[float, list[list[np.ndarray]], float]:
    """Over all segmentations of an island: the log of the sum of their weights, the probability of each segment and kind, and the
    expected number of segments that follow another. scores[i][k - 1]: those of the kinds of the k words that end with i."""
    n = len(scores)
    ahead = np.full((n + 1, 2), -np.inf)
    ahead[0, 0] = 0
    for i in range(1, n + 1):
        ahead[i, 0] = np.logaddexp(*ahead[i - 1])
        ends = [np.logaddexp(ahead[i - k, 0], ahead[i - k, 1] + adjoin) + np.logaddexp.reduce(s) for k, s in enumerate(scores[i - 1], 1)]
        ahead[i, 1] = np.logaddexp.reduce(ends)
    back = np.full((n + 1, 2), -np.inf)
    back[n] = 0
    for i in range(n - 1, -1, -1):
        go = [np.logaddexp.reduce(scores[i + k - 1][k - 1]) + back[i + k, 1] for k in range(1, n - i + 1) if len(scores[i + k - 1]) >= k]
        start = np.logaddexp.reduce(go)
        back[i] = np.logaddexp(back[i + 1, 0], start), np.logaddexp(back[i + 1, 0], start + adjoin)
    z, joins, out = np.logaddexp(*ahead[n]), 0.0, []
    for i in range(1, n + 1):
        out.append([])
        for k, own in enumerate(scores[i - 1], 1):
            before = np.logaddexp(ahead[i - k, 0], ahead[i - k, 1] + adjoin)
            p = np.exp(np.minimum(0.0, before + own + back[i, 1] - z))
            out[-1].append(p)
            joins += p.sum() * np.exp(min(0.0, ahead[i - k, 1] + adjoin - before))
    return float(z), out, float(joins)


def _fit(rows: list[tuple[dict, int]], steps: int = 80, rate: float = 0.3, decay: float = 0.02) -> Model:
    """Adam on the conditional log likelihood; sums over segmentations by the forward-backward recursion over segments."""
    if not any(x["g"] for x, _ in rows):
        return UNTRAINED
    names = sorted({f for x, _ in rows for row in x["c"] for own in row for f in own})
    place, kinds = {f: i for i, f in enumerate(names)}, len(KINDS)
    w = np.zeros((kinds, len(names) + 1))  # the last: the bias
    w[:, -1] = -2.0
    adjoin = np.zeros(1)
    data = []
    for x, count in rows:
        ids = [[np.array([*(place[f] for f in own), len(names)]) for own in row] for row in x["c"]]
        data.append((ids, [tuple(g) for g in x["g"]], math.log1p(count)))
    total = sum(c for *_, c in data)
    m, v = [np.zeros_like(w), np.zeros(1)], [np.zeros_like(w), np.zeros(1)]
    for step in range(1, steps + 1):
        grad, grad_adjoin = -decay * w, -decay * adjoin
        for ids, gold, count in data:
            weight = count / total
            _, expected, joins = expectations([[w[:, own].sum(axis=1) for own in row] for row in ids], adjoin[0])
            for row, p_of in zip(ids, expected, strict=True):
                for own, p in zip(row, p_of, strict=True):
                    grad[:, own] -= weight * p[:, None]
            for first, k, kind in gold:
                grad[kind, ids[first + k - 1][k - 1]] += weight
            grad_adjoin += weight * (sum(a[0] + a[1] == b[0] for a, b in zip(gold, gold[1:], strict=False)) - joins)
        for j, (value, g) in enumerate(((w, grad), (adjoin, grad_adjoin))):
            m[j] = 0.9 * m[j] + 0.1 * g
            v[j] = 0.99 * v[j] + 0.01 * g * g
            value += rate * (m[j] / (1 - 0.9**step)) / (np.sqrt(v[j] / (1 - 0.99**step)) + 1e-8)
    weight: dict = defaultdict(float)
    for kind in range(kinds):
        for f, i in place.items():
            weight[kind, f] = float(w[kind, i])
    return Model(dict(weight), w[:, -1].tolist(), float(adjoin[0]))


_SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def detect(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, base and added: arrays of (kind, start, end) by kind as listed, then start."""
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    named = lambda spans: [{"kind": KINDS[k], "start": s, "end": e} for k, s, e in sorted(spans)]

    def run(texts):
        made = [find(t, model) for t in texts]
        return [[named(b) for b, _ in made], [named(a) for _, a in made]]

    return append_columns(docs, ["text"], ["id"], [("base", _SPAN), ("added", _SPAN)], lambda: run)


def as_text(spans: F.Column) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def merged(*spans: str) -> F.Column:
    """All spans of the columns by kind as listed, then start."""
    order = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    keyed = F.transform(F.concat(*spans), lambda s: F.struct(F.element_at(order, s["kind"]).alias("at"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
