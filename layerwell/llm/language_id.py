"""Language identification with a convolutional network over bytes.

A window of ``WINDOW`` UTF-8 bytes goes through filters of several widths, the
maximum of each filter over the window, and a softmax layer. On one-hot bytes a
filter of width w is a sum of w table look-ups, so no embedding is multiplied
out. The network is trained here, in numpy, on windows of labelled documents;
a text is predicted from all of its windows, weighted by the bytes they hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from layerwell.llm.common import batch_of, columns, hash_below, in_batches

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
TRAIN_DOCS = 400  # labelled documents per language, at most
TRAIN_WINDOWS = 4  # windows of each, spread over its text
EPOCHS = 8
SEED = 7
UNKNOWN = "und"
_AT_ONCE = 64  # windows; their activations stay in the cache

_LETTER = regex.compile(r"\p{L}")


def windows_of(text: str) -> np.ndarray:
    """All bytes of a text in lower case, in rows of ``WINDOW``, padded with spaces."""
    data = text.lower().encode()
    data += b" " * (-len(data) % WINDOW)
    return np.frombuffer(data, np.uint8).reshape(-1, WINDOW)


@dataclass
class Network:
    languages: list[str]
    tables: list[np.ndarray]  # per width: (width, 256, FILTERS)
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def start(cls, languages: list[str], rng: np.random.Generator) -> Network:
        size, n = FILTERS * len(WIDTHS), len(languages)
        tables = [rng.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        out = rng.normal(0, 0.1, (size, n)).astype(np.float32)
        return cls(languages, tables, np.zeros(size, np.float32), out, np.zeros(n, np.float32))

    def pooled(self, x: np.ndarray, where: bool = False):
        """Maximum of every filter over each window, and where it lies."""
        tops, places = [], []
        for table in self.tables:
            width = len(table)
            length = WINDOW - width + 1
            scores = table[0].take(x[:, :length], axis=0, mode="clip")
            for j in range(1, width):
                scores += table[j].take(x[:, j : j + length], axis=0, mode="clip")
            tops.append(scores.max(1))
            if where:
                places.append(scores.argmax(1))
        return np.concatenate(tops, 1) + self.bias, places

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.languages)), np.float32)
        for i in range(0, len(x), _AT_ONCE):
            hidden = np.maximum(self.pooled(x[i : i + _AT_ONCE])[0], 0)
            out[i : i + _AT_ONCE] = softmax(hidden @ self.out + self.out_bias)
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0
        x = windows_of(text)
        weight = np.full(len(x), float(WINDOW))
        weight[-1] -= len(x) * WINDOW - len(text.lower().encode())
        mean = weight @ self.probabilities(x) / weight.sum()
        best = int(mean.argmax())
        return self.languages[best], float(min(1.0, mean[best]))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, languages: list[str], epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """Adam on the cross-entropy. A filter's gradient reaches only the bytes at
    its maximum."""
    rng = np.random.default_rng(seed)
    net = Network.start(languages, rng)
    if not len(x):
        return net
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (*net.tables, net.bias, net.out, net.out_bias)]
    weight = len(y) / (len(languages) * np.bincount(y, minlength=len(languages)).clip(1))
    t = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(order), _AT_ONCE):
            rows = order[i : i + _AT_ONCE]
            xb, yb = x[rows], y[rows]
            raw, places = net.pooled(xb, where=True)
            hidden = np.maximum(raw, 0)
            error = softmax(hidden @ net.out + net.out_bias)
            error[np.arange(len(yb)), yb] -= 1
            error *= (weight[yb] / len(yb)).astype(np.float32)[:, None]
            back = (error @ net.out.T) * (raw > 0)
            grads = []
            for k, (table, place) in enumerate(zip(net.tables, places)):
                g = np.zeros_like(table)
                own = back[:, k * FILTERS : (k + 1) * FILTERS]
                for j in range(len(table)):
                    np.add.at(g[j], (xb[np.arange(len(xb))[:, None], place + j], np.arange(FILTERS)[None]), own)
                grads.append(g)
            grads += [back.sum(0), hidden.T @ error, error.sum(0)]
            t += 1
            for p, g, (m, v) in zip((*net.tables, net.bias, net.out, net.out_bias), grads, state):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.01 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return net


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, per_language: int = TRAIN_DOCS) -> Network:
    """Train on at most ``per_language`` labelled documents of each language,
    chosen by a hash of id and text, none of them held out and each with a letter
    in its text. Equal documents count once, whatever their number.

    A bound on the hash, from the number of documents of each language, leaves
    some four times as many as are wanted; only windows of these are ranked.
    """
    labelled = (
        columns(docs, "doc_id", "text", "lang").where("doc_id is not null and lang is not null").where(~held_out())
        .where(F.col("text").rlike(r"\p{L}"))
        .select(F.col("doc_id").cast("long"), "text", "lang", F.xxhash64("doc_id", "text").alias("key"))
    )
    # One row a language; the network has a class for each.
    found = labelled.groupBy("lang").agg(F.approx_count_distinct("key").alias("n")).collect()
    if not found:
        return train(np.empty((0, WINDOW), np.uint8), np.empty(0, np.int64), [])
    near = reduce(
        Column.__or__,
        ((F.col("lang") == r["lang"]) & hash_below(F.col("key"), r["n"], 4 * per_language) for r in found),
    )

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids, langs, rows = [], [], [], []
            for doc_id, text, lang, key in zip(*(c.to_pylist() for c in batch.columns)):
                x = windows_of(text)
                for i in np.unique(np.linspace(0, len(x) - 1, TRAIN_WINDOWS).astype(int)):
                    keys.append(key), ids.append(doc_id), langs.append(lang), rows.append(x[i].tobytes())
            types = [pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield batch_of(["key", "doc_id", "lang", "bytes"], [keys, ids, langs, rows], types)

    windows = in_batches(labelled.where(near).distinct(), spread, "key long, doc_id long, lang string, bytes binary")
    order = Window.partitionBy("lang").orderBy("key", "doc_id")
    ranked = windows.distinct().withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= per_language)
    rows = sorted(tuple(r) for r in ranked.select("doc_id", "lang", "bytes").collect())
    languages = sorted({lang for _, lang, _ in rows})
    numbers = {lang: i for i, lang in enumerate(languages)}
    x = np.frombuffer(b"".join(b for _, _, b in rows), np.uint8).reshape(-1, WINDOW)
    return train(x, np.array([numbers[lang] for _, lang, _ in rows], np.int64), languages)


def identify(docs: DataFrame, network: Network | None = None) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score (the mean probability).

    A null text, one without a letter (Unicode category L), and every text where there is nothing to
    learn from gets ``und`` with the score 0. A null doc_id is not held out and
    not learned from. Rows may repeat; an empty table gives no rows; columns
    other than doc_id, text and lang are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network or fit(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            made = [net.predict(t) for t in batch.column("text").to_pylist()]
            langs, scores = zip(*made) if made else ((), ())
            yield batch_of(
                ["doc_id", "held_out", "lang_pred", "score"],
                [batch.column("doc_id"), batch.column("held_out"), list(langs), list(scores)],
                [None, None, pa.string(), pa.float64()],
            )

    rows = columns(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text"
    )
    return in_batches(rows, run, "doc_id long, held_out boolean, lang_pred string, score double")
