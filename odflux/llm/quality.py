"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

Each word of a text gives two streams: the word itself, and its shape (case,
digits, length, the marks that follow it, whether it repeats the word before).
N-grams of both are hashed into a fixed number of weights. A text's vector is the
share of each slot among its n-grams, so a score is one sparse dot product and
needs no state but the weights.

Training runs the per-coordinate FTRL-proximal update over shards of a bounded
sample of labelled rows and averages the shards' weights.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflux.llm.common import crc_bucket, cut_lineage, ship_package, slices
from odflux.llm.labelled import TRAINING_ROWS, training_rows
from odflux.llm.word_arrays import SPACE, mix, split_words

SLOTS_BITS = 18
SHARDS, EPOCHS = 4, 6
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
#: Shares are small; scaled so that a slot with a few hundredths of a text moves the score.
SCALE = 30.0

_UPPER, _LOWER, _DIGIT = (np.zeros(256, dtype=bool) for _ in range(3))
_UPPER[0x41:0x5B], _LOWER[0x61:0x7B], _DIGIT[0x30:0x3A] = True, True, True
_MARK = np.zeros(256, dtype=bool)
_MARK[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True
_STEP = np.uint64(0xD6E8FEB86659FD93)


def ngram_slots(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(slot of each n-gram, number of n-grams of each text); the n-grams of a text stand together."""
    words = split_words(texts, lower=False, gap=SPACE)
    n, first = len(words.starts), words.first
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    buffer = words.buffer

    def inside(table: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(table[buffer])])
        return total[words.ends] - total[words.starts]

    exact = words.hashes()
    upper, lower, digits, marks = inside(_UPPER), inside(_LOWER), inside(_DIGIT), inside(_MARK)
    size = words.ends - words.starts
    new_text = np.zeros(n, dtype=bool)
    new_text[first[:-1][np.diff(first) > 0]] = True
    again = np.zeros(n, dtype=bool)
    again[1:] = (exact[1:] == exact[:-1]) & ~new_text[1:]
    case = np.where(upper == 0, 0, np.where(lower > 0, 1, np.where(upper > 1, 2, 3)))
    last = buffer[words.ends - 1].astype(np.int64)
    tail = np.where(_MARK[buffer[words.ends - 1]], last, 0)
    before = np.where(size > 1, buffer[np.maximum(words.ends - 2, words.starts)].astype(np.int64), 0)
    tail = tail * 256 + np.where((tail > 0) & _MARK[before], before, 0)
    shape = (((case * 2 + again) * 2 + (digits > 0)) * 5 + np.minimum(marks, 4)) * 8 + np.minimum(np.log2(size + 1).astype(np.int64), 7)
    shapes = mix((shape * 65_536 + tail).astype(np.uint64))
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)  # words to the end of the text
    columns = []
    for stream, (tokens, longest) in enumerate(((exact, 2), (shapes, 3))):
        rolled = np.zeros(n, dtype=np.uint64)
        for k in range(longest):
            moved = np.zeros(n, dtype=np.uint64)
            moved[:n - k] = tokens[k:]
            rolled = rolled * _STEP + moved
            slot = (mix(rolled + np.uint64(stream * 8 + k)) >> np.uint64(64 - SLOTS_BITS)).astype(np.int64)
            columns.append(np.where(left > k, slot, -1))
    flat = np.stack(columns, axis=1).ravel()
    per_word = (np.stack(columns, axis=1) >= 0).sum(axis=1)
    total = np.concatenate([[0], np.cumsum(per_word)])
    return flat[flat >= 0], total[first[1:]] - total[first[:-1]]


def sparse_rows(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct slots and their scaled shares, for each text."""
    out = []
    for a, b in slices(texts):
        slots, counts = ngram_slots(texts[a:b])
        ends = np.cumsum(counts)
        for begin, end in zip((ends - counts).tolist(), ends.tolist()):
            own, times = np.unique(slots[begin:end], return_counts=True)
            out.append((own.astype(np.int32), (SCALE * times / max(1, end - begin)).astype(np.float32)))
    return out


def follow_the_leader(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS) -> np.ndarray:
    """Weights after FTRL-proximal updates over the rows; the last weight is the bias, which is not regularised."""
    z, n = np.zeros((1 << SLOTS_BITS) + 1), np.zeros((1 << SLOTS_BITS) + 1)

    def weights(at: np.ndarray, l1: float, l2: float) -> np.ndarray:
        own = z[at]
        return np.where(np.abs(own) <= l1, 0.0, -(own - np.sign(own) * l1) / ((BETA + np.sqrt(n[at])) / ALPHA + l2))

    def update(at, w, gradient):
        sigma = (np.sqrt(n[at] + gradient * gradient) - np.sqrt(n[at])) / ALPHA
        z[at] += gradient - sigma * w
        n[at] += gradient * gradient

    bias = np.array([1 << SLOTS_BITS])
    for _ in range(epochs):
        for (at, x), label in zip(rows, labels):
            w, b = weights(at, L1, L2), weights(bias, 0.0, 0.0)
            error = 1 / (1 + np.exp(-np.clip(w @ x + b[0], -35, 35))) - label
            update(at, w, error * x)
            update(bias, b, np.array([error]))
    out = weights(np.arange(len(z)), L1, L2)
    out[-1] = weights(bias, 0.0, 0.0)[0]
    return out


@dataclass
class QualityModel:
    """``weights`` has one value a slot and the bias at its end; its size does not depend on the data."""

    weights: np.ndarray

    def score_texts(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros(len(texts))
        for a, b in slices(texts):
            slots, counts = ngram_slots(texts[a:b])
            total = np.concatenate([[0.0], np.cumsum(self.weights[slots])])
            ends = np.cumsum(counts)
            dot = SCALE * (total[ends] - total[ends - counts]) / np.maximum(counts, 1)
            out[a:b] = 1 / (1 + np.exp(-np.clip(dot + self.weights[-1], -35, 35)))
        return out

    def score(self, text: Column | str) -> Column:
        """Probability of label 1; a null or empty text has the score of the bias alone."""
        return F.arrow_udf(lambda column: pa.array(self.score_texts(column.to_pylist())), "double")(text)


def fit(docs: DataFrame, labels: DataFrame, bound: int = TRAINING_ROWS) -> QualityModel:
    """Learn from labelled rows outside the held-out bucket, about ``bound`` of them.

    Rows are dealt to shards by a hash of their id and each shard's updates run in one
    task, so a task holds a bounded number of rows. Without labelled rows every
    weight is 0 and every score one half.
    """
    rows = training_rows(docs, labels, "quality", 4, 2, bound)
    shard = rows.select("text", "label", F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS)).alias("shard"),
                        F.xxhash64("doc_id", F.lit("order")).alias("turn"))

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("turn")
        found = follow_the_leader(sparse_rows(frame["text"].tolist()), frame["label"].to_numpy())
        at = np.flatnonzero(found)
        return pd.DataFrame({"slot": at.astype(np.int32), "weight": found[at]})

    parts = cut_lineage(shard.groupBy("shard").applyInPandas(learn, "slot int, weight double"))
    shards = max(1, shard.select("shard").distinct().count())
    weights = np.zeros((1 << SLOTS_BITS) + 1)
    for row in parts.groupBy("slot").agg((F.sum("weight") / shards).alias("weight")).collect():
        weights[row.slot] = row.weight
    return QualityModel(weights)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for every row of ``docs``.

    Only ``doc_id`` and ``text`` are read, and ``doc_id`` and ``quality`` of the
    labels. A null id is in the bucket of the text 'null'.
    """
    ship_package(docs.sparkSession)
    model = fit(docs, labels)
    scored = docs.select("doc_id", model.score(F.col("text").cast("string")).alias("score"))
    return scored.select("doc_id", (crc_bucket(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
