"""Quality classifier: positive-unlabelled learning with a non-negative unbiased risk."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quire.session import small, stored

#: Rows to learn from, at most: trusted positives, and unlabelled texts. They bound what reaches the driver.
POSITIVES = 2_000
UNLABELLED = 4_000
#: Byte classes, hashed words, and figures of a whole text.
CLASSES, WORDS, FIGURES = 64, 1 << 12, 6
SIZE = CLASSES * CLASSES + WORDS + FIGURES
#: Texts are read in pieces of so many bytes, to bound the arrays.
PIECE = 1 << 22

_class = np.full(256, 1, np.uint16)  # byte to class: letters beyond ASCII and rare bytes 1, space 0, marks one each
_class[[9, 10, 11, 12, 13, 32]] = 0
_class[ord("a") : ord("z") + 1], _class[ord("A") : ord("Z") + 1], _class[ord("0") : ord("9") + 1] = 2, 3, 4
_class[[b for b in range(33, 127) if not chr(b).isalnum()]] = np.arange(5, 37)
_POWER = np.cumprod(np.concatenate(([1], np.full(63, 1099511628211))).astype(np.uint64), dtype=np.uint64)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Sparse (index, value) of one text: its byte-class pairs, its words, and the share of repeats.

    Every byte and word of the text counts. A null or empty text has no features.
    """
    data = (text or "").encode()
    pairs = np.zeros(CLASSES * CLASSES)
    for at in range(0, len(data), PIECE):
        piece = np.frombuffer(data, np.uint8)[at : at + PIECE + 1]
        c = _class[piece]
        pairs += np.bincount(c[:-1] * CLASSES + c[1:], minlength=CLASSES * CLASSES)
    split = data.split()
    words, n_words = Counter(split), len(split)
    if not n_words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    line = np.frombuffer(b" ".join((*words, b"")), np.uint8)  # each word once, with a space behind it
    first = np.concatenate(([0], np.flatnonzero(line == 32)[:-1] + 1))
    place = np.arange(len(line)) - np.repeat(first, np.diff(np.append(first, len(line))))
    hashed = np.add.reduceat((line | np.uint8(32)).astype(np.uint64) * _POWER[place % 64], first)
    slot = (hashed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - WORDS.bit_length() + 1)
    times = np.fromiter(words.values(), np.float64, len(words))
    bag = np.bincount(slot.astype(np.int64), times, WORDS)
    p, w = np.flatnonzero(pairs), np.flatnonzero(bag)
    share = pairs.reshape(CLASSES, CLASSES).sum(1) / max(1.0, pairs.sum())
    figures = 1 - len(words) / n_words, times.max() / n_words, share[3], share[5:].sum(), min(1, np.log1p(n_words) / 10), share[4]
    index = np.concatenate((p, CLASSES * CLASSES + w, CLASSES * CLASSES + WORDS + np.arange(FIGURES)))
    value = np.concatenate((np.sqrt(pairs[p] / max(1.0, pairs.sum())), np.sqrt(bag[w] / n_words), figures))
    return index.astype(np.int32), value.astype(np.float32)


@dataclass(frozen=True)
class Model:
    """Linear scores of features, and the class prior that they were learnt with."""

    weight: np.ndarray
    bias: float
    prior: float

    def score(self, texts: Iterable[str | None]) -> np.ndarray:
        """Probability of good quality for each text."""
        out = []
        for text in texts:
            i, v = features(text)
            out.append(self.bias + float(self.weight[i] @ v))
        return 1 / (1 + np.exp(-np.clip(np.array(out, np.float64), -35, 35)))


class _Rows:
    """Sparse rows that can be multiplied from either side."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]]):
        self.n = len(rows)
        self.row = np.repeat(np.arange(self.n), [len(i) for i, _ in rows])
        self.col = np.concatenate([i for i, _ in rows] or [np.zeros(0, np.int32)])
        self.value = np.concatenate([v for _, v in rows] or [np.zeros(0, np.float32)])

    def times(self, weight: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * weight[self.col], self.n)

    def back(self, each: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, self.value * each[self.row], SIZE)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _descend(pos: _Rows, unl: _Rows, prior: float | None, steps: int, rate: float = 0.1, decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Adam on the sigmoid loss. With a prior: the non-negative PU risk; without: positives against unlabelled."""
    w, b = np.zeros(SIZE), 0.0
    m, v = np.zeros(SIZE + 1), np.zeros(SIZE + 1)
    for t in range(1, steps + 1):
        sp, su = _sigmoid(pos.times(w) + b), _sigmoid(unl.times(w) + b)
        slope_p, slope_u = sp * (1 - sp) / pos.n, su * (1 - su) / unl.n
        if prior is None:
            ep, eu = -slope_p, slope_u
        elif su.mean() - prior * sp.mean() >= 0:
            ep, eu = -2 * prior * slope_p, slope_u
        else:  # a negative estimate of the negatives' risk comes from overfitting: step back up along it
            ep, eu = prior * slope_p, -slope_u
        g = np.append(pos.back(ep) + unl.back(eu) + decay * w, ep.sum() + eu.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, b


def _prior(pos: np.ndarray, unl: np.ndarray, delta: float = 0.1) -> float:
    """Share of positives among unlabelled scores, from the best bin of top scores.

    Above any cutoff, unlabelled mass is at least the prior times the positives' mass; the cutoff whose ratio has
    the least upper confidence bound (Dvoretzky-Kiefer-Wolfowitz) gives the estimate.
    """
    cuts = np.unique(np.quantile(pos, np.linspace(0, 0.95, 96)))
    q_p, q_u = ((s[:, None] >= cuts).mean(0) for s in (pos, unl))
    slack = np.sqrt(np.log(4 / delta) / 2 / len(unl)) + np.sqrt(np.log(4 / delta) / 2 / len(pos))
    best = int(np.argmin((q_u + slack) / q_p))
    return float(np.clip(q_u[best] / q_p[best], 0.05, 0.98))


def fit(pos: list[tuple[np.ndarray, np.ndarray]], unl: list[tuple[np.ndarray, np.ndarray]], steps: int = 150) -> Model:
    """Learn from features of trusted positives and of unlabelled texts; no negative label is used.

    One half of each side separates positives from unlabelled texts, the other half's scores give the prior; then
    all rows minimise the non-negative risk with it. Without positives or unlabelled texts every score is the 0.5
    prior.
    """
    if len(pos) < 2 or len(unl) < 2:
        return Model(np.zeros(SIZE), 0.0, 0.5)
    w, b = _descend(_Rows(pos[::2]), _Rows(unl[::2]), None, steps // 3)
    prior = _prior(_Rows(pos[1::2]).times(w) + b, _Rows(unl[1::2]).times(w) + b)
    return Model(*_descend(_Rows(pos), _Rows(unl), prior, steps), prior)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from learning; a null doc_id counts as the empty string."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """Fit on samples of at most the given sizes, drawn by a hash of doc_id and text from all rows that are not held out.

    Trusted positives are documents with a label of quality 1; unlabelled texts are any web text, whatever its label. Rows alike
    in doc_id and text count once, so repeated or null doc_ids bring no more rows than others; a null doc_id has no
    label. The hash draws somewhat more than the sizes, and of those the first by its order stay.
    """
    labels = labels.filter("quality = 1").select("doc_id").filter(~held_out()).distinct()
    n_pos, n_unl = labels.count(), docs.select("doc_id").filter(~held_out()).count()
    few = lambda h, n, of: F.pmod(h, F.lit(1 << 30)) < int((1 << 30) * min(1.0, 1.2 * n / max(1, of)))
    labelled = few(F.xxhash64("doc_id", F.lit("p")), positives, n_pos)
    trusted = stored(labels.filter(labelled).withColumn("trusted", F.lit(True)), "trusted")
    own = docs.select("doc_id", "text").filter(~held_out()).withColumn("h", F.xxhash64("doc_id", "text", F.lit("u")))
    own = own.withColumn("web", few(F.col("h"), unlabelled, n_unl)).filter(F.col("web") | labelled).join(small(trusted), "doc_id", "left")
    own = own.withColumn("trusted", F.coalesce("trusted", F.lit(False))).filter("web or trusted").select("h", "web", "trusted", "text")

    def encoded(batches):
        for batch in batches:
            both = [features(t) for t in batch["text"]]
            yield pd.DataFrame({"h": batch["h"], "web": batch["web"], "trusted": batch["trusted"], "i": [i.tobytes() for i, _ in both], "v": [v.tobytes() for _, v in both]})

    rows = stored(own.mapInPandas(encoded, "h long, web boolean, trusted boolean, i binary, v binary"), "sample")
    last = lambda role, n: F.lit(rows.filter(role).select("h").distinct().orderBy("h").limit(n).agg(F.max("h")).first()[0]).cast("long")
    for role, n in (("web", unlabelled), ("trusted", positives)):
        rows = rows.withColumn(role, F.col(role) & F.coalesce(F.col("h") <= last(role, n), F.lit(False)))
    rows = rows.filter("web or trusted").dropDuplicates(["h"]).orderBy("h").collect()  # positives + unlabelled at most
    read = lambda r: (np.frombuffer(r.i, np.int32), np.frombuffer(r.v, np.float32))
    return fit([read(r) for r in rows if r.trusted], [read(r) for r in rows if r.web])


def scores(model: Model, text: Column) -> Column:
    """Score of a text column as a double; null and empty texts get the score of no features."""

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts))

    return of(text)


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose whole text scores 0.5 or more, with their columns; learns from `docs` and `labels` as train() does.

    Rows stay as often as they come; null and empty texts are judged by the score of no features; a score of exactly 0.5 stays, as
    all do when nothing can be learnt; an empty table stays empty. Any column but score__ may be there.
    """
    model = train(docs, labels)
    return docs.withColumn("score__", scores(model, F.col("text"))).filter("score__ >= 0.5").drop("score__")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; one row for each input row, null doc_ids and texts included."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = docs.select("doc_id", held_out().alias("held_out"), scores(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
