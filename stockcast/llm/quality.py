"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages (runs of ``PASSAGE`` words, all of the text).
Each passage is described by shares of character classes, word shapes and
repetition and encoded by a small layer; gated attention, learned from document
labels alone, weighs the passages; the weighted representation is scored.

The model is fitted on a bounded sample: at most ``SAMPLE`` labelled rows, in
the order of a hash of their id, of at most ``SAMPLE_BYTES`` bytes each. Every
document is scored whole, in a scan without a shuffle. Labels, language,
source and id are no inputs of a score.

Edge cases: null or empty texts and texts without words are one blank passage
and get its score. Ids labelled both 0 and 1 are not learned from. If only one
label (or none) was seen, the score is that share of label 1 (0.5). Repeated rows are
scored each for itself. An empty table gives an empty result. Extra columns
are ignored by ``score`` and kept by ``keep_good``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast.llm.common import give_back, word_runs

PASSAGE = 64
SAMPLE, SAMPLE_BYTES = 4000, 1 << 18
GOOD = 0.7
HIDDEN, GATE, EPOCHS = 16, 8, 400

_CLASS = np.zeros(256, np.int64)
for _k, _chars in enumerate([b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" ", b"\t\r\v\f", b"\n", b".,;:", b"!?", b"|", b"#$%&*@^~+=_", b"<>{}[]()/\\", b"'\"`-", bytes(range(128, 256))], 1):
    _CLASS[list(_chars)] = _k
N_CLASS = 14
N_FEATURES = N_CLASS + 8


def passages(column: pa.Array):
    """(text index of each passage, features) a run of texts at a time."""
    for a, b, words in word_runs(column):
        size = np.diff(words.first)
        per = np.maximum(1, -(-size // PASSAGE))
        bag = np.repeat(np.arange(b - a), per)
        first = np.concatenate([[0], np.cumsum(per)])  # first passage of each text
        of_word = first[words.doc] + (np.arange(len(words.start)) - words.first[words.doc]) // PASSAGE
        n = len(bag)
        # bytes belong to the passage of the last word that began, or to a text's first
        at = np.zeros(len(words.data) + 1, np.int64)
        begins = np.flatnonzero(np.r_[True, of_word[1:] != of_word[:-1]]) if len(of_word) else np.zeros(0, int)
        edge = np.zeros(n, np.int64)
        edge[of_word[begins]] = words.start[begins]
        lead = first[:-1]
        edge[lead] = words.offsets[:-1]
        np.add.at(at, edge, 1)
        of_byte = np.cumsum(at[:-1]) - 1
        shares = np.bincount(of_byte * N_CLASS + _CLASS[words.data], minlength=n * N_CLASS).reshape(n, N_CLASS).astype(float)
        shares /= np.maximum(1, shares.sum(1, keepdims=True))
        count = np.bincount(of_word, minlength=n)
        known = np.maximum(1, count)
        length = (words.end - words.start).astype(float)
        h = words.hashes(lower=False)
        mean = np.bincount(of_word, length, n) / known
        spread = np.sqrt(np.maximum(0, np.bincount(of_word, length**2, n) / known - mean**2))
        order = np.lexsort((h, words.doc))
        again = np.zeros(len(h), bool)  # words that stood earlier in the text
        if len(h):
            again[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (words.doc[order[1:]] == words.doc[order[:-1]])
        twice = np.zeros(len(h), bool)
        twice[1:] = (h[1:] == h[:-1]) & (words.doc[1:] == words.doc[:-1])
        head = _CLASS[words.data[words.start]] == 1
        tail = np.isin(_CLASS[words.data[words.end - 1]], (8, 9, 10)) if len(h) else np.zeros(0, bool)
        share = lambda flag: np.bincount(of_word, flag.astype(float), n) / known
        own = np.stack([mean / 10, spread / 10, share(again), share(twice), share(head), share(tail), share(length <= 1), np.log1p(count) / 5], 1)
        yield a + bag, np.concatenate([shares, own], 1)


class Model:
    """Passage encoder, gated attention and scorer; plain numpy."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        draw = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
        self.p = {"W": draw(N_FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "V": draw(HIDDEN, GATE), "U": draw(HIDDEN, GATE), "w": np.zeros(GATE), "c": draw(HIDDEN), "d": np.zeros(1)}
        self.mean, self.scale, self.flat = np.zeros(N_FEATURES), np.ones(N_FEATURES), None

    def forward(self, x: np.ndarray, bag: np.ndarray, n: int):
        p = self.p
        H = np.tanh(x @ p["W"] + p["b"])
        T, S = np.tanh(H @ p["V"]), 1 / (1 + np.exp(-(H @ p["U"])))
        e = (T * S) @ p["w"]
        top = np.full(n, -np.inf)
        np.maximum.at(top, bag, e)
        a = np.exp(e - top[bag])
        a /= np.bincount(bag, a, n)[bag]
        Z = np.stack([np.bincount(bag, a * H[:, k], n) for k in range(HIDDEN)], 1)
        return H, T, S, a, Z, 1 / (1 + np.exp(-(Z @ p["c"] + p["d"])))

    def scores(self, x: np.ndarray, bag: np.ndarray, n: int) -> np.ndarray:
        if self.flat is not None:
            return np.full(n, self.flat)
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        return self.forward(x, bag, n)[-1]

    def fit(self, x: np.ndarray, bag: np.ndarray, y: np.ndarray) -> "Model":
        n = len(y)
        if n == 0 or y.min() == y.max():
            self.flat = float(y.mean()) if n else 0.5
            return self
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (n - y.sum()))
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        for t in range(1, EPOCHS + 1):
            p = self.p
            H, T, S, a, Z, out = self.forward(x, bag, n)
            d = weight * (out - y)
            dZ = d[:, None] * p["c"]
            dH = a[:, None] * dZ[bag]
            da = (H * dZ[bag]).sum(1)
            de = a * (da - np.bincount(bag, a * da, n)[bag])
            dA = de[:, None] * p["w"]
            dT, dS = dA * S * (1 - T**2), dA * T * S * (1 - S)
            dH = (dH + dT @ p["V"].T + dS @ p["U"].T) * (1 - H**2)
            g = {"W": x.T @ dH, "b": dH.sum(0), "V": H.T @ dT, "U": H.T @ dS, "w": (T * S).T @ de, "c": Z.T @ d, "d": d.sum(keepdims=True)}
            for k in p:
                grad = g[k] + 1e-4 * p[k]
                m[k] = 0.9 * m[k] + 0.1 * grad
                s[k] = 0.999 * s[k] + 0.001 * grad**2
                p[k] = p[k] - 0.02 * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)
        return self


def fold(id_col) -> F.Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 4


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", held: int = 2) -> Model:
    """Learns from labelled rows outside the held-out fold; the driver gets the
    passage features of the bounded sample alone."""
    known = labels.where((fold("doc_id") != held) & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("_most"))
    # a few more than SAMPLE ids, as labels may lack a document or its text be too long
    known = known.where("y = _most").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).select(F.col("doc_id").alias("_id"), "y")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(F.octet_length(F.coalesce("text", F.lit(""))) <= SAMPLE_BYTES)
    sample = texts.join(F.broadcast(known), F.col("doc_id") == F.col("_id")).select("doc_id", "y", "text")

    def described(batches):
        for batch in batches:
            for bag, x in passages(batch.column(2)):
                at = pa.array(bag)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(list(x.astype(np.float32)), pa.list_(pa.float32()))], ["doc_id", "y", "x"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    rows = sample.dropDuplicates(["doc_id"]).mapInArrow(described, f"doc_id {kind}, y int, x array<float>").toArrow()
    if not rows.num_rows:
        return Model().fit(np.zeros((0, N_FEATURES)), np.zeros(0, int), np.zeros(0))
    x = np.stack(rows["x"].to_numpy()).astype(float)
    ids, first, bag = np.unique(rows["doc_id"].to_numpy(), return_index=True, return_inverse=True)
    order = np.lexsort((*x.T[::-1], bag))  # the order rows arrive in doesn't count
    return Model().fit(x[order], bag[order], rows["y"].to_numpy()[first].astype(float))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` as (doc_id, held_out, score, predicted)."""

    def run(batches):
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for bag, x in passages(batch.column(2)):
                low = bag[0]
                n = bag[-1] - low + 1
                out[low : low + n] = model.scores(x, bag - low, n)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out), pa.array((out >= GOOD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    docs = docs.select(F.col(id_col).alias("doc_id"), (fold(id_col) == 2).alias("held_out"), F.col(text_col).alias("text"))
    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, all their columns."""
    model = fit(docs, labels, id_col, text_col)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for bag, x in passages(batch.column(at)):
                low = bag[0]
                n = bag[-1] - low + 1
                good[low : low + n] = model.scores(x, bag - low, n) >= GOOD
            yield batch.filter(pa.array(good))
        give_back()

    return docs.mapInArrow(run, docs.schema)
