"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Fitting uses a bounded sample of labelled documents (``per_class`` rows of label 1, twice as many of label 0). Labels stand on documents, so words
are labelled first: a regularized document-level regression over word and word-beginning features tells which of them carry the
label, and in toxic documents the words it blames are the toxic tokens. The field is then fitted to these labelled tokens by its
exact likelihood (forward-backward), and a small regression turns the expected number and the largest marginal of toxic tokens
into a document score.

Scoring runs over every word of every text: chains of similar length advance side by side through forward and backward
recursions; words whose marginal is at least one half form the offending spans.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import lean, ship

ship(__name__)

WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (3, 4, 5, 6)
#: Padded cells that chains of one group may take.
CELLS = 500_000


def word_features(word: str) -> list[str]:
    w = word.lower()
    return ["=" + w, *(f"{k}{w[:k]}" for k in BEGINNINGS if len(w) > k)]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Field:
    """Weights of a two-label chain: features and bias speak for label 1 against 0, ``moves`` [from, to] for transitions."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -8.0
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    document: np.ndarray = field(default_factory=lambda: np.array([-3.0, 0.0, 0.0]))

    def emission(self, word: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in word_features(word))

    def score(self, total: np.ndarray, most: np.ndarray) -> np.ndarray:
        return sigmoid(self.document[0] + self.document[1] * np.log1p(total) + self.document[2] * most)


def groups_of(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Positions of chains, longest first, in groups whose padded matrix has at most CELLS cells (or is one chain)."""
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    at = 0
    while at < len(order):
        n = max(1, CELLS // int(lengths[order[at]]))
        yield order[at : at + n]
        at += n


def recursions(emit: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ratios label 1 : label 0 of the forward and backward messages, for chains in columns, longest first."""
    steps, n = emit.shape
    odds, t = np.exp(np.clip(emit, -30, 30)), np.exp(moves)
    active = np.searchsorted(-lengths, -np.arange(steps), "left")
    ahead, back = np.zeros((steps, n)), np.ones((steps, n))
    ahead[0] = odds[0]
    for i in range(1, steps):
        r = ahead[i - 1, : active[i]]
        ahead[i, : active[i]] = odds[i, : active[i]] * (t[0, 1] + t[1, 1] * r) / (t[0, 0] + t[1, 0] * r)
    for i in range(steps - 1, 0, -1):
        q = odds[i, : active[i]] * back[i, : active[i]]
        back[i - 1, : active[i]] = (t[1, 0] + t[1, 1] * q) / (t[0, 0] + t[0, 1] * q)
    return ahead, back


def marginals(chains: list[np.ndarray], moves: np.ndarray) -> list[np.ndarray]:
    """Probability of label 1 at every place of every chain of emissions."""
    lengths = np.array([len(c) for c in chains], np.int64)
    out = [np.empty(0)] * len(chains)
    for group in groups_of(lengths):
        own = lengths[group]
        emit = np.zeros((own[0], len(group)))
        for j, g in enumerate(group):
            emit[: own[j], j] = chains[g]
        ahead, back = recursions(emit, own, moves)
        odds = ahead * back
        p = odds / (1 + odds)
        for j, g in enumerate(group):
            out[g] = p[: own[j], j].copy()
    return out


def blame(docs: list[np.ndarray], features: list[tuple[str, ...]], labels: np.ndarray, max_features: int, least: int) -> dict[str, float]:
    """Features that carry a document's label, with weights of a regularized logistic regression on their presence.

    ``docs`` hold word numbers, ``features`` those of each word.
    """
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for own in (d for d, y in zip(docs, labels, strict=True) if y):
        seen[1].update({f for w in np.unique(own) for f in features[w]})
    # Clean documents are counted for features that toxic ones have often enough.
    some = {f for f, c in seen[1].items() if c >= least}
    for own in (d for d, y in zip(docs, labels, strict=True) if not y):
        seen[0].update({f for w in np.unique(own) for f in features[w] if f in some})
    n0, n1 = max(1, int((labels == 0).sum())), max(1, int((labels == 1).sum()))
    ratio = {f: (seen[1][f] / n1) / ((seen[0][f] + 0.5) / n0) for f in some}
    chosen = sorted((f for f, r in ratio.items() if r >= 4), key=lambda f: (-seen[1][f] * np.log(ratio[f]), f))[:max_features]
    if not chosen:
        return {}
    where = {f: i for i, f in enumerate(chosen)}
    x = np.zeros((len(docs), len(chosen)), np.float32)
    for i, own in enumerate(docs):
        x[i, [where[f] for w in np.unique(own) for f in features[w] if f in where]] = 1
    y = labels.astype(np.float32)
    w, b = np.zeros(len(chosen), np.float32), float(np.log(n1 / n0))
    sizes_w, size_b = np.full(len(chosen), 1e-6, np.float32), 1e-6
    for _ in range(150):  # adaptive gradient steps on the mean log-likelihood
        d = (sigmoid(x @ w + b) - y).astype(np.float32) / len(y)
        g, gb = x.T @ d + 2e-4 * w, float(d.sum())
        sizes_w += g * g
        size_b += gb * gb
        w -= 0.3 * g / np.sqrt(sizes_w)
        b -= 0.3 * gb / np.sqrt(size_b)
    return {f: float(v) for f, v in zip(chosen, w, strict=True)}


def fit_field(
    chains: list[np.ndarray], features: list[tuple[int, ...]], toxic: np.ndarray, labels: np.ndarray, n_features: int, rounds: int = 40
) -> tuple[np.ndarray, float, np.ndarray]:
    """Feature weights, bias and transitions of the largest penalized likelihood of labelled chains.

    A token is labelled 1 where its word is ``toxic`` and its document's label is 1.
    """
    lengths = np.array([len(c) for c in chains], np.int64)
    counts = np.array([len(f) for f in features], np.int32)
    blocks = []
    for group in groups_of(lengths):
        own = lengths[group]
        y = np.zeros((own[0], len(group)))
        there = np.zeros((own[0], len(group)), bool)
        cells, ids = [], []
        for j, g in enumerate(group):
            y[: own[j], j] = toxic[chains[g]] * labels[g]
            there[: own[j], j] = True
            for i in np.flatnonzero(counts[chains[g]]):
                f = features[chains[g][i]]
                cells += [i * len(group) + j] * len(f)
                ids += f
        blocks.append((own, y, there, np.array(cells, np.int64), np.array(ids, np.int64)))
    total = max(1, int(lengths.sum()))
    w, rest = np.zeros(n_features), np.array([-4.0, 0, 0, 0, 0])
    m, v = np.zeros(n_features + 5), np.zeros(n_features + 5)
    for step in range(1, rounds + 1):
        gw, gr = 1e-1 * w, 1e-1 * rest * (0, 1, 1, 1, 1)
        for own, y, there, cells, ids in blocks:
            emit = np.full(y.size, rest[0])
            np.add.at(emit, cells, w[ids])
            moves = rest[1:].reshape(2, 2)
            ahead, back = recursions(emit.reshape(y.shape), own, moves)
            odds = ahead * back
            d = np.where(there, odds / (1 + odds) - y, 0)
            gw += np.bincount(ids, d.ravel()[cells], n_features)
            gr[0] += d.sum()
            # Expected transitions against those of the labels.
            t, r = np.exp(moves), ahead[:-1]
            q = np.exp(np.clip(emit.reshape(y.shape)[1:], -30, 30)) * back[1:]
            z = t[0, 0] + t[0, 1] * q + r * (t[1, 0] + t[1, 1] * q)
            on, a, b = there[1:], y[:-1], y[1:]
            for k, (e, o) in enumerate(((t[0, 0], (1 - a) * (1 - b)), (t[0, 1] * q, (1 - a) * b), (t[1, 0] * r, a * (1 - b)), (t[1, 1] * q * r, a * b))):
                gr[1 + k] += ((e / z - o) * on).sum()
        g = np.concatenate([gw, gr]) / total
        m, v = 0.9 * m + 0.1 * g, 0.98 * v + 0.02 * g * g
        move = 0.4 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.98**step)) + 1e-9)
        w, rest = w - move[:n_features], rest - move[n_features:]
    return w, float(rest[0]), rest[1:].reshape(2, 2)


def fit(texts: list[str], labels: list[int], max_features: int = 2000) -> Field:
    """A field from documents and their labels; without both labels, one that scores every text alike."""
    y = np.array(labels, np.int64)
    model = Field()
    if not len(y) or y.min() == y.max():
        model.document = np.array([-3.0 if not len(y) or not y.max() else 3.0, 0.0, 0.0])
        return model
    numbers: dict[str, int] = {}
    docs = [np.array([numbers.setdefault(w, len(numbers)) for w in WORD.findall(t or "")], np.int32) for t in texts]
    features = [tuple(word_features(w)) for w in numbers]
    weights = blame(docs, features, y, max_features, max(3, int(0.01 * (y == 1).sum())))
    if weights:
        top = sorted(weights.values())[-max(1, len(weights) // 200)]
        where = {f: i for i, f in enumerate(weights)}
        toxic = np.array([sum(weights.get(x, 0.0) for x in f) >= top for f in features], float)
        features = [tuple(where[x] for x in f if x in where) for f in features]
        # Chains of two thirds of the documents fit the field; all of them, whole, fit the document scores.
        fit_on = [i for i in range(len(docs)) if zlib.crc32((texts[i] or "").encode()) % 3]
        w, model.bias, model.moves = fit_field([docs[i] for i in fit_on], features, toxic, y[fit_on], len(weights))
        model.weights = {f: float(w[i]) for f, i in where.items()}
    emit = np.array([model.emission(w) for w in numbers])
    p = marginals([emit[d] for d in docs], model.moves)
    total, most = np.array([x.sum() for x in p]), np.array([x.max(initial=0) for x in p])
    x = np.stack([np.ones(len(y)), np.log1p(total), most], 1)
    share = np.where(y == 1, 0.5 / (y == 1).mean(), 0.5 / (y == 0).mean()) / len(y)
    c = np.zeros(3)
    for _ in range(30):  # Newton steps, ridge of 1e-3
        s = sigmoid(x @ c)
        h = (x * (share * s * (1 - s))[:, None]).T @ x + 1e-3 * np.eye(3)
        c -= np.linalg.solve(h, x.T @ (share * (s - y)) + 1e-3 * c)
    model.document = c
    return model


def training_rows(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """At most ``per_class`` documents of label 1 and twice as many of label 0, those with the smallest hash of their id.

    Ids whose crc32, as text, is divisible by 5 are held out. A document with several labels takes the highest. Of rows that share an
    id the one with the smallest hash of its text counts, so the bound holds for rows as well.
    """
    ids = docs.select(F.col("doc_id").cast("long")).distinct()
    marked = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("y")).where("doc_id IS NOT NULL")
    marked = marked.join(ids, "doc_id", "left_semi").where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 0)
    marked = marked.groupBy("doc_id").agg(F.max("y").alias("y")).withColumn("_h", F.xxhash64("doc_id"))
    chosen = [marked.where(F.col("y") == y).orderBy("_h", "doc_id").limit(per_class * (2 - y)) for y in (0, 1)]
    # At most 3 * per_class integers are broadcast.
    some = F.broadcast(chosen[0].union(chosen[1]).select("doc_id", "y"))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text")).where("text IS NOT NULL").join(some, "doc_id")
    # One row per id is left by each task, before the shuffle.
    return rows.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("y").alias("y")).select("text", "y")


def fit_labelled(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = 800) -> Field:
    """Fit on the bounded sample of ``training_rows``; only it reaches the driver."""
    rows = sorted(training_rows(docs, labels, label, per_class).collect())
    return fit([r[0] for r in rows], [r[1] for r in rows])


def judge(texts: list[str], model: Field, known: dict[str, float]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Score of each text, and for each of its words whether it is toxic. ``known`` keeps emissions of words between calls."""
    chains = []
    for t in texts:
        words = WORD.findall(t)
        if len(known) > 400_000:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = model.emission(w)
        chains.append(np.fromiter(map(known.__getitem__, words), float, len(words)))
    p = marginals(chains, model.moves)
    s = model.score(np.array([x.sum() for x in p]), np.array([x.max(initial=0) for x in p]))
    return s, [x >= 0.5 for x in p]


def spans_of(text: str, toxic: np.ndarray) -> str:
    """start:end of runs of toxic words, comma-joined."""
    out: list[list[int]] = []
    for i, m in enumerate(WORD.finditer(text)):
        if toxic[i]:
            if i and toxic[i - 1]:
                out[-1][1] = m.end()
            else:
                out.append([m.start(), m.end()])
    return ",".join(f"{a}:{b}" for a, b in out)


def score(docs: DataFrame, model: Field) -> DataFrame:
    """doc_id, score (0 to 1), n_toxic (words with a marginal of at least 0.5), spans (start:end in code points, comma-joined).

    Neighbouring toxic words are one span. Null and empty texts get the score of a text without words. Rows are scored each for
    itself, so repeated rows score alike; other columns are ignored. An empty table gives no rows.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("n_toxic", pa.int64()), ("spans", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            s, hits = judge(texts, model, known)
            spans = [spans_of(t, h) if h.any() else "" for t, h in zip(texts, hits, strict=True)]
            counts = pa.array([int(h.sum()) for h in hits], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), counts, pa.array(spans, pa.string())], schema=schema)

    ids = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    return ids.mapInArrow(lean(run), "doc_id long, score double, n_toxic long, spans string")


def drop_toxic(docs: DataFrame, model: Field, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose score is below ``threshold``."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for whole in batches:
            # A few hundred texts at a time: their words and chains are all that is held.
            for batch in (whole.slice(i, 500) for i in range(0, whole.num_rows, 500)):
                s, _ = judge([t or "" for t in batch.column(at).to_pylist()], model, known)
                yield batch.filter(pa.array(s < threshold))

    return docs.mapInArrow(lean(run), docs.schema)
