"""Toxicity by a linear-chain conditional random field.

Labels are given to documents. From a sample of labelled documents, forms and prefixes of words are counted by label; those that
mark toxic documents significantly become evidence. Tokens of toxic documents with strong evidence are labelled toxic, all others
not, and a chain of two states is fitted to these labels (emission weights by evidence, transition weights) by gradient ascent
on its likelihood. A text's score comes from the forward-backward marginals: a logistic function of the expected number of toxic
tokens and of the largest marginal, fitted to the documents' labels. Tokens whose marginal is at least one half are the
offending spans. Runs of tokens without evidence are bridged by powers of their transition matrix, which is exact.

Null and empty texts get the score of a text without evidence; no usable labels (none, or of one kind) give a model that scores
the share of toxic labels; labels without an id or a value are ignored, and of several for one id the greatest counts; null ids
and repeated rows are scored as they are; an empty table gives an empty result; new columns take the place of clashing ones.
"""

from __future__ import annotations

import hashlib
import math
import pickle
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, held, settle, tidy

#: Labelled documents that the model is fitted to, at most (chosen by a hash of the id).
TRAIN_DOCS = 10_000
#: Forms and prefixes that are evidence, at most, and what makes one: toxic documents with it, their log odds, the total of it.
EVIDENCE, LEAST_DOCS, LEAST_ODDS, LEAST_GAIN = 4_096, 3, math.log(6), 12.0
PREFIXES = (4, 5, 6)
#: Share of toxic documents among those with a form from which its tokens count as toxic in them.
STRONG = 0.8
#: Words that a worker remembers.
REMEMBERED = 150_000

_TOKEN = re.compile(r"[^\W\d_]+")


def forms(token: str) -> list[str]:
    """A token's lower-case form, and its prefixes, marked by an asterisk."""
    low = token.lower()
    return [low, *(f"{low[:n]}*" for n in PREFIXES if len(low) > n)]


class Model:
    """Weights of evidence, of the bias, of transitions (from, to), and of the document's score."""

    def __init__(self, weight: dict[str, float], bias: float, moves: list[list[float]], document: list[float]):
        self.weight, self.bias, self.moves, self.document = weight, bias, moves, document
        self.key = hashlib.sha256(pickle.dumps((sorted(weight.items()), bias, moves, document))).hexdigest()


class Tagger:
    """Marginals, spans and scores of texts under a model."""

    def __init__(self, model: Model):
        self.model = model
        outer = self

        class Memory(dict):
            def __missing__(self, token):
                found = [w for f in forms(token) if (w := outer.model.weight.get(f)) is not None]
                if len(self) >= REMEMBERED:
                    self.clear()
                self[token] = value = sum(found) + outer.model.bias if found else None
                return value

        self.memory = Memory()
        e = np.exp(np.clip(model.moves, -15, 15))
        self.neutral = e * np.array([1.0, math.exp(max(-30.0, min(30.0, model.bias)))])
        self.moves = e
        self.bridge = lru_cache(4_096)(self._bridge)

    def _bridge(self, n: int) -> tuple:
        out, square = np.eye(2), self.neutral / self.neutral.max()
        while n:  # scaled at every step, so that nothing underflows
            if n & 1:
                out = out @ square
                out /= out.max()
            square = square @ square
            square /= square.max()
            n >>= 1
        return tuple(out.ravel().tolist())

    def marginals(self, at: list[int], values: list[float], n: int) -> list[float]:
        """P(toxic) of the tokens at the given places, of n; the others have no evidence."""
        (a, b), (c, d) = self.moves.tolist()
        gaps = [at[0], *(y - x - 1 for x, y in zip(at, at[1:], strict=False)), n - at[-1] - 1]
        emit = [math.exp(max(-30.0, min(30.0, v))) for v in values]
        ahead, x, y = [], 1.0, 0.0  # a chain begins as after a token that isn't toxic
        for gap, e in zip(gaps, emit, strict=False):
            if gap:
                p, q, r, s = self.bridge(gap)
                x, y = x * p + y * r, x * q + y * s
            x, y = x * a + y * c, (x * b + y * d) * e
            x, y = x / (x + y), y / (x + y)
            ahead.append((x, y))
        out, x, y = [0.0] * len(at), 1.0, 1.0
        for i in range(len(at) - 1, -1, -1):
            if gaps[i + 1]:
                p, q, r, s = self.bridge(gaps[i + 1])
                x, y = p * x + q * y, r * x + s * y
            u, v = ahead[i][0] * x, ahead[i][1] * y
            out[i] = v / (u + v)
            y *= emit[i]
            x, y = a * x + b * y, c * x + d * y
            x, y = x / (x + y), y / (x + y)
        return out

    def evidence(self, text: str | None) -> tuple[list[int], list[float], int]:
        values = list(map(self.memory.__getitem__, _TOKEN.findall(text or "")))
        at = [i for i, v in enumerate(values) if v is not None]
        return at, [values[i] for i in at], len(values)

    def aggregate(self, p: list[float]) -> float:
        w0, w1, w2 = self.model.document
        z = w0 + w1 * math.log1p(sum(p)) + w2 * max(p, default=0.0)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

    def score(self, text: str | None) -> tuple[float, str]:
        """The score, and the offending spans as start:end in code points."""
        at, values, n = self.evidence(text)
        if not at:
            return self.aggregate([]), ""
        p = self.marginals(at, values, n)
        bad = {i for i, x in zip(at, p, strict=True) if x >= 0.5}
        spans = [f"{m.start()}:{m.end()}" for i, m in enumerate(_TOKEN.finditer(text)) if i in bad] if bad else []
        return self.aggregate(p), ",".join(spans)


def tagger(model: Model) -> Tagger:
    """The model's tagger, made once a worker."""
    return held(("tagger", model.key), lambda: Tagger(model))


def labelled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most: int = TRAIN_DOCS) -> DataFrame:
    """text and label of the documents to learn from: those with a label, besides held-out ids, at most about ``most``."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("id")).agg((F.max(label_col) > 0).cast("int").alias("label"))
    n = known.count()
    if n > most:
        known = known.filter(F.pmod(F.xxhash64("id", F.lit("train")), F.lit(1 << 40)) < int((1 << 40) * most / n))
    # The rows are at most about ``most``, so they can be sent to every task.
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known), "id").select("text", "label")


def held_out(id_col: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _document_counts(batches):
    """Documents by form and label, summed for each task."""
    toxic, clean, docs = Counter(), Counter(), [0, 0]
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            seen = {f for token in set(_TOKEN.findall(text or "")) for f in forms(token)}
            docs[label] += 1
            (toxic if label else clean).update(seen)
    keys = list(toxic.keys() | clean.keys())
    yield pa.RecordBatch.from_arrays(
        [pa.array(["", *keys]), pa.array([docs[1], *(toxic[k] for k in keys)], pa.int64()), pa.array([docs[0], *(clean[k] for k in keys)], pa.int64())],
        names=["form", "toxic", "clean"],
    )


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most: int = TRAIN_DOCS) -> Model:
    """Learn a model from labelled documents."""
    sample = settle(labelled(docs, labels, id_col, text_col, label_col, most))
    counts = settle(sample.mapInArrow(_document_counts, "form string, toxic long, clean long").groupBy("form").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    total = counts.filter("form = ''").head()
    n_toxic, n_clean = (total.toxic, total.clean) if total else (0, 0)
    moves = [[0.0, -2.0], [0.0, 0.0]]
    if not n_toxic or not n_clean:
        share = (n_toxic + 0.5) / (n_toxic + n_clean + 1) if total else 0.0
        return Model({}, -5.0, moves, [math.log(max(share, 1e-6) / max(1 - share, 1e-6)), 0.0, 0.0])
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    chosen = counts.filter("form <> ''").withColumn("odds", odds).withColumn("gain", F.col("toxic") * F.col("odds"))
    chosen = chosen.filter((F.col("toxic") >= LEAST_DOCS) & (F.col("odds") >= LEAST_ODDS) & (F.col("gain") >= LEAST_GAIN))
    chosen = chosen.orderBy(F.desc("gain"), "form").limit(EVIDENCE).collect()
    forms_of = {r.form: i for i, r in enumerate(chosen)}
    strong = {r.form for r in chosen if r.toxic >= STRONG * (r.toxic + r.clean)}
    if not forms_of:
        return Model({}, -5.0, moves, [math.log(n_toxic / n_clean), 0.0, 0.0])

    def events(batches):
        for batch in batches:
            at, own, n = [], [], []
            for text in batch.column("text").to_pylist():
                tokens = _TOKEN.findall(text or "")
                held = [(i, x) for i, t in enumerate(tokens) if (x := [forms_of[f] for f in forms(t) if f in forms_of])]
                at.append([i for i, _ in held])
                own.append([x for _, x in held])
                n.append(len(tokens))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(at, pa.list_(pa.int32())), pa.array(own, pa.list_(pa.list_(pa.int32()))), pa.array(n, pa.int32())], names=["label", "at", "own", "n"])

    # Bounded: a sample of documents, and of each the tokens with evidence.
    rows = sample.mapInArrow(events, "label int, at array<int>, own array<array<int>>, n int").collect()
    names = list(forms_of)
    model = _fit_chain(rows, names, {forms_of[f] for f in strong})
    tidy()
    return model


def _fit_chain(rows, names: list[str], strong: set[int], steps: int = 150, rate: float = 0.15, decay: float = 1e-2, around: int = 2) -> Model:
    """Fit the chain by Adam on windows around evidence (``around`` tokens without on each side), then the document's score."""
    chains: list[tuple[list[list[int]], list[int]]] = []
    for r in rows:
        begin = None
        for i, (place, own) in enumerate(zip(r.at, r.own, strict=True)):
            if begin is None or place - r.at[i - 1] > 2 * around or len(chains[-1][0]) > 60:
                chains.append(([[] for _ in range(min(around, place))], []))
                begin = place
            else:
                chains[-1][0].extend([] for _ in range(place - r.at[i - 1] - 1))
            chains[-1][0].append(own)
            chains[-1][1].extend([0] * (len(chains[-1][0]) - 1 - len(chains[-1][1])) + [int(bool(r.label) and any(f in strong for f in own))])
            if i + 1 == len(r.at) or r.at[i + 1] - place > 2 * around:
                tail = min(around, r.n - place - 1)
                chains[-1][0].extend([] for _ in range(tail))
                chains[-1][1].extend([0] * tail)
    total = len(chains)
    # Equal windows are held once, with their number.
    often = Counter((tuple(map(tuple, tokens)), (*truth, *[0] * (len(tokens) - len(truth)))) for tokens, truth in chains)
    chains, times = [(tokens, list(truth)) for tokens, truth in often], np.array(list(often.values()), dtype=np.float64)
    n, longest = len(chains), max(len(c[0]) for c in chains)
    label, mask = np.zeros((n, longest), dtype=np.int8), np.zeros((n, longest))
    hit_c, hit_t, hit_f = [], [], []
    for c, (tokens, truth) in enumerate(chains):
        label[c, : len(tokens)], mask[c, : len(tokens)] = truth, 1
        for t, own in enumerate(tokens):
            hit_c += [c] * len(own)
            hit_t += [t] * len(own)
            hit_f += own
    hit_c, hit_t, hit_f = np.array(hit_c), np.array(hit_t), np.array(hit_f)
    k = len(names)
    w = np.zeros(k + 5)  # evidence, bias, moves (from, to)
    w[k] = -3.0
    state = np.zeros((2, k + 5))
    before = np.concatenate((np.zeros((n, 1), dtype=np.int8), label[:, :-1]), axis=1)
    seen = np.zeros(k + 5)
    np.add.at(seen, hit_f, label[hit_c, hit_t] * times[hit_c])
    seen[k] = (label * mask * times[:, None]).sum()
    for i in (0, 1):
        for j in (0, 1):
            seen[k + 1 + 2 * i + j] = (((before == i) & (label == j) & (mask > 0)) * times[:, None]).sum()
    for step in range(1, steps + 1):
        emit = np.full((n, longest), w[k])
        np.add.at(emit, (hit_c, hit_t), w[hit_f])
        emit = np.exp(np.clip(emit, -30, 30))
        move = np.exp(np.clip(w[k + 1 :].reshape(2, 2), -15, 15))
        ahead = np.zeros((longest, n, 2))
        now = np.tile([1.0, 0.0], (n, 1))
        for t in range(longest):
            new = now @ move
            new[:, 1] *= emit[:, t]
            new /= new.sum(axis=1, keepdims=True)
            now = np.where(mask[:, t : t + 1] > 0, new, now)
            ahead[t] = now
        back, want, grad = np.ones((n, 2)), np.zeros((n, longest)), np.zeros(k + 5)
        for t in range(longest - 1, -1, -1):
            live = mask[:, t] > 0
            prior = ahead[t - 1] if t else np.tile([1.0, 0.0], (n, 1))
            out = back * np.stack((np.ones(n), emit[:, t]), axis=1)
            pair = prior[:, :, None] * move[None] * out[:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            pair *= (live * times)[:, None, None]
            want[:, t] = pair[:, :, 1].sum(axis=1)
            grad[k + 1 :] -= pair.sum(axis=0).ravel()
            new = out @ move.T
            back = np.where(live[:, None], new / new.sum(axis=1, keepdims=True), back)
        np.add.at(grad, hit_f, -want[hit_c, hit_t])
        grad[k] -= want.sum()
        grad += seen - decay * total**0.5 * w
        grad /= total
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.99 * state[1] + 0.01 * grad * grad
        w += rate * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-8)
    model = Model(dict(zip(names, w[:k].tolist(), strict=True)), float(w[k]), w[k + 1 :].reshape(2, 2).tolist(), [0.0, 0.0, 0.0])
    work = Tagger(model)
    x, y = np.zeros((len(rows), 3)), np.array([float(r.label) for r in rows])
    x[:, 0] = 1
    for i, r in enumerate(rows):
        if r.at:
            p = work.marginals(list(r.at), [sum(w[f] for f in own) + w[k] for own in r.own], r.n)
            x[i, 1:] = math.log1p(sum(p)), max(p)
    v = np.zeros(3)
    for _ in range(30):  # Newton's steps, with a little shrinkage
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
        v += np.clip(np.linalg.solve(h, x.T @ (y - p) - 0.1 * v), -3, 3)
    return Model(model.weight, model.bias, model.moves, v.tolist())


def score(df: DataFrame, model: Model, keep: list[str], text_col: str = "text", clean_only: bool = False) -> DataFrame:
    """The kept columns, score, predicted (1 from one half) and toxic_spans; ``clean_only`` leaves out what is predicted toxic."""

    def make():
        work = tagger(model).score

        def run(texts):
            made = [work(t) for t in texts]
            return [[s for s, _ in made], [int(s >= 0.5) for s, _ in made], [x for _, x in made]]

        return run

    fields = [("score", T.DoubleType()), ("predicted", T.IntegerType()), ("toxic_spans", T.StringType())]
    return append_columns(df, [text_col], keep, fields, make, (lambda made: [not x for x in made[1]]) if clean_only else None)
