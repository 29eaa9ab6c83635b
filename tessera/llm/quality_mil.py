"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages (windows of ``PASSAGE`` code points). Each passage is
encoded from its character-class transitions and word statistics, embedded by one layer,
and weighted by gated attention; a logistic unit scores the weighted sum. Only document
labels are known: the attention weights are learnt from them.

Training draws at most ``sample`` labelled documents of each class (smallest hash of the
id first) of at most ``sample_passages`` passages, and weighs them back to the classes'
shares among all labelled rows, so scores are probabilities under the real shares. Only
these features reach the driver: at most 2 * sample * sample_passages rows of ``WIDTH``
half floats, in practice some tens of MB. Everything scored is scored over whole texts.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASSAGE = 512
CLASSES = 16
WIDTH = CLASSES * CLASSES + 4


@lru_cache(1)
def _class_table() -> np.ndarray:
    """Character class of each code point up to 0xFFFF; the last entry is for the rest."""
    marks = {" ": 4, "\t": 4, "\n": 5, "\r": 5, ".": 6, ",": 7, ";": 8, ":": 8, "!": 9, "?": 10,
             "|": 13, "/": 13, "\\": 13, "_": 13, "-": 13}
    kinds = {"Lu": 1, "Ll": 2, "Lt": 1, "Lm": 2, "Lo": 2, "Mn": 2, "Mc": 2, "Nd": 3, "Nl": 3, "No": 3, "Zs": 4,
             "Ps": 12, "Pe": 12, "Pi": 11, "Pf": 11, "Sm": 14, "Sc": 14, "Sk": 14, "So": 14, "Po": 14, "Pd": 13}
    table = np.full(0x10000, 15, np.uint8)
    for code in range(0xFFFF):
        c = chr(code)
        table[code] = (marks.get(c) if c in marks else 0 if "a" <= c <= "z" else 11 if c in "'\"`"
                       else kinds.get(unicodedata.category(c), 15))
    return table


def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Passage features ``(n, WIDTH)`` of all texts in turn, and each text's number of
    passages (an empty text is one passage of zeros)."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    count = np.maximum(1, -(-size // PASSAGE))
    first = np.cumsum(count) - count
    x = np.zeros((int(count.sum()), WIDTH), np.float32)
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(code):
        return x, count
    inside = np.arange(len(code)) - np.repeat(np.cumsum(size) - size, size)
    passage = np.repeat(first, size) + inside // PASSAGE
    kind = _class_table()[np.minimum(code, 0xFFFF)].astype(np.int64)
    same = passage[1:] == passage[:-1]
    cell = (passage[:-1] * (CLASSES * CLASSES) + kind[:-1] * CLASSES + kind[1:])[same]
    pairs = np.bincount(cell, minlength=len(x) * CLASSES * CLASSES).reshape(len(x), -1)
    chars = np.bincount(passage, minlength=len(x))
    x[:, :-4] = np.sqrt(pairs / np.maximum(1, chars - 1)[:, None])
    word = (kind != 4) & (kind != 5)
    start = word.copy()
    start[1:] &= ~word[:-1] | ~same
    at = np.flatnonzero(start)
    if len(at):
        owner = passage[at]
        words = np.bincount(owner, minlength=len(x))
        step = np.arange(len(code)) - np.repeat(at, np.diff(np.append(at, len(code)))) if at[0] == 0 else \
            np.arange(len(code)) - np.concatenate([np.zeros(at[0], np.int64), np.repeat(at, np.diff(np.append(at, len(code))))])
        mixed = (code.astype(np.uint64) + (step.astype(np.uint64) << np.uint64(21)) + np.uint64(1)) \
            * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed[~word] = 0
        key = np.add.reduceat(mixed, at) ^ (owner.astype(np.uint64) * np.uint64(0x94D049BB133111EB))
        different = np.bincount(owner[np.unique(key, return_index=True)[1]], minlength=len(x))
        x[:, -4] = np.bincount(passage[word], minlength=len(x)) / np.maximum(1, words) / 10
        x[:, -3] = different / np.maximum(1, words)
        x[:, -2] = np.log1p(words) / 5
    x[:, -1] = np.log1p(chars) / 7
    return x, count


@dataclass
class Model:
    """Weights; ``prior`` is the score where nothing could be learnt."""
    prior: float
    weights: dict[str, np.ndarray] | None = None

    def scores(self, x: np.ndarray, count: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(count), self.prior)
        return 1 / (1 + np.exp(-np.clip(_forward(self.weights, x, count)["logit"], -40, 40)))


def _forward(w: dict[str, np.ndarray], x: np.ndarray, count: np.ndarray) -> dict[str, np.ndarray]:
    first = np.cumsum(count) - count
    n = (x - w["mean"]) * w["scale"]
    h = np.tanh(n @ w["W"] + w["b"])
    v, u = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
    e = (v * u) @ w["a"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, first), count))
    att = e / np.repeat(np.add.reduceat(e, first), count)
    z = np.add.reduceat(att[:, None] * h, first, axis=0)
    return {"n": n, "h": h, "v": v, "u": u, "att": att, "z": z, "logit": z @ w["c"] + w["d"]}


def train(x: np.ndarray, count: np.ndarray, y: np.ndarray, weight: np.ndarray, hidden: int = 24, gate: int = 16,
          epochs: int = 16, batch: int = 256, rate: float = 0.01, decay: float = 1e-4, seed: int = 7) -> dict:
    """Gated-attention weights by Adam on the weighted logistic loss of the bags."""
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(0), 1 / (x.std(0) + 0.02)
    w = {"W": rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), "b": np.zeros(hidden),
         "V": rng.normal(0, 0.3, (hidden, gate)), "U": rng.normal(0, 0.3, (hidden, gate)),
         "a": rng.normal(0, 0.3, gate), "c": rng.normal(0, 0.3, hidden), "d": np.zeros(1)}
    w = {k: v.astype(np.float32) for k, v in w.items()}
    fixed = {"mean": mean, "scale": scale}
    m, s, t = {k: 0.0 for k in w}, {k: 0.0 for k in w}, 0
    first = np.cumsum(count) - count
    for _ in range(epochs):
        order = rng.permutation(len(count))
        for k in range(0, len(order), batch):
            bag = order[k:k + batch]
            rows = np.concatenate([np.arange(first[b], first[b] + count[b]) for b in bag])
            c = count[bag]
            f = _forward(w | fixed, x[rows], c)
            start = np.cumsum(c) - c
            dl = ((1 / (1 + np.exp(-f["logit"])) - y[bag]) * weight[bag] / weight[bag].sum()).astype(np.float32)
            dz = np.repeat(dl[:, None] * w["c"], c, axis=0)
            datt = (dz * f["h"]).sum(1)
            de = f["att"] * (datt - np.repeat(np.add.reduceat(f["att"] * datt, start), c))
            dg = de[:, None] * w["a"]
            dv, du = dg * f["u"] * (1 - f["v"] ** 2), dg * f["v"] * f["u"] * (1 - f["u"])
            dh = (f["att"][:, None] * dz + dv @ w["V"].T + du @ w["U"].T) * (1 - f["h"] ** 2)
            grad = {"W": f["n"].T @ dh, "b": dh.sum(0), "V": f["h"].T @ dv, "U": f["h"].T @ du,
                    "a": (f["v"] * f["u"]).T @ de, "c": f["z"].T @ dl, "d": dl.sum(keepdims=True)}
            t += 1
            for p, g in grad.items():
                g = g + decay * w[p]
                m[p] = 0.9 * m[p] + 0.1 * g
                s[p] = 0.999 * s[p] + 0.001 * g * g
                w[p] = w[p] - (rate * (m[p] / (1 - 0.9 ** t)) / (np.sqrt(s[p] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
    return w | fixed


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = 1500, sample_passages: int = 256) -> Model:
    """Train on documents that are not held out. ``labels (doc_id, quality)``; null ids and
    labels other than 0 and 1 are ignored, of several labels of one id the smallest
    counts. Without labels every score is 0.5; with one class only, that class."""
    known = (labels.where("quality in (0, 1) and doc_id is not null").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    total = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(total) < 2:
        return Model(float(next(iter(total), 0.5)))
    drawn = [r for q in (0, 1) for r in known.where(F.col("quality") == q)
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()]
    ids = docs.sparkSession.createDataFrame([(r["doc_id"], r["quality"]) for r in drawn], "__id long, __quality int")

    def features(batches):
        import pyarrow as pa
        for b in batches:
            for i, t in enumerate(b.column(1).to_pylist()):
                x, _ = encode([t.decode("utf-8", "replace")])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, 1), pa.array([x.astype(np.float16).tobytes()])],
                                                 ["quality", "x"])

    rows = (docs.select("doc_id", "text").where(F.length("text") <= sample_passages * PASSAGE)
            .join(F.broadcast(ids), F.col("doc_id").cast("long") == F.col("__id"))
            .groupBy("__id", "__quality").agg(F.min("text").alias("text"))
            .select("__quality", F.col("text").cast("binary").alias("text"))
            .mapInArrow(features, "quality int, x binary")
            .orderBy(F.xxhash64("x")).collect())
    y = np.array([r["quality"] for r in rows], np.float32)
    if len(set(y.tolist())) < 2:
        return Model(total.get(1, 0) / sum(total.values()))
    bags = [np.frombuffer(r["x"], np.float16).reshape(-1, WIDTH) for r in rows]
    share = np.array([total[0], total[1]], float) / sum(total.values())
    weight = np.where(y > 0, share[1] / (y > 0).mean(), share[0] / (y == 0).mean()).astype(np.float32)
    w = train(np.concatenate(bags).astype(np.float32), np.array([len(b) for b in bags]), y, weight)
    return Model(float(share[1]), w)


def score(text: Column, model: Model) -> Column:
    """Probability of label 1 of a text column (null: empty)."""

    def run(texts: pd.Series) -> pd.Series:
        out, todo, size = [], [], 0
        for t in [*texts, None]:
            if todo and (t is None or size > 1 << 19):
                out.append(model.scores(*encode(todo)))
                todo, size = [], 0
            if t is not None:
                todo.append(bytes(t).decode("utf-8", "replace"))
                size += len(todo[-1])
        return pd.Series(np.concatenate(out) if out else [], dtype=float)

    return F.pandas_udf(run, "double")(F.coalesce(text, F.lit("")).cast("binary"))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, model: Model | None = None,
             score_col: str = "score", predicted_col: str = "predicted") -> DataFrame:
    """``docs`` (needs ``doc_id`` and ``text``) with ``score`` (0 to 1) and ``predicted`` (1
    where the score reaches the threshold). Only the text enters a score: equal texts
    score alike, a null text like an empty one. Each row comes back once; a column of the
    input that has one of the two names is replaced. Empty input: empty result."""
    model = model or fit(docs, labels)
    scored = docs.withColumn(score_col, score(F.col("text"), model))
    return scored.withColumn(predicted_col, (F.col(score_col) >= threshold).cast("int"))
