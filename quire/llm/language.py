"""Language identification: each document is a mixture of languages, inferred by expectation-maximisation over n-grams."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quire.session import small, stored

#: Bytes of an n-gram, and buckets that n-grams are hashed to.
GRAM, BUCKETS = 4, 1 << 15
#: Documents of each language to learn from, about; and the added count of every bucket.
SAMPLE, SMOOTHING = 2_500, 0.1
#: Turns of expectation-maximisation, and times the Bayesian information criterion that a further language costs.
TURNS, PENALTY = 12, 2.0
UNKNOWN = "und"

_plain = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def has_letter(text: str) -> bool:
    """Whether a character of a letter category is there; numbers such as one half or a superscript two are none."""
    return any(map(str.isalpha, text))



def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of a whole text in lower case, and their counts; all but letters are space."""
    line = b" ".join(text.lower().encode().translate(_plain).split())
    a = np.frombuffer(b" " + line + b" ", np.uint8).astype(np.uint32)
    if len(a) < GRAM:
        a = np.append(a, np.full(GRAM - len(a), 32, np.uint32))
    code = a[: len(a) - 3] | a[1 : len(a) - 2] << 8 | a[2 : len(a) - 1] << 16 | a[3:] << 24
    slot = (code * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
    return np.unique(slot, return_counts=True)


@dataclass(frozen=True)
class Model:
    """Languages in order, and the probability of each bucket (rows) in each of them (columns)."""

    langs: list[str]
    table: np.ndarray

    def mixture(self, text: str | None) -> dict[str, float]:
        """Proportions of the languages chosen for a text; none if it is null, has no letter, or nothing was learnt."""
        if text is None or not self.langs or not has_letter(text):
            return {}
        slot, count = grams(text)
        own, n = self.table[slot], float(count.sum())
        alone = count @ np.log(own)
        chosen, share, best = [int(np.argmax(alone))], np.ones(1), float(alone.max())
        cost = PENALTY * GRAM * 0.5 * math.log(max(n, 2.0))  # n-grams overlap: GRAM of them tell as much as one
        while len(chosen) < len(self.langs):
            mixed = own[:, chosen] @ share
            # the likelihood is concave, so a language adds to it only if the slope towards it is upward
            slope = (count / mixed) @ own - n
            tried = [self._fit(own, count, n, [*chosen, k], share) for k in range(len(self.langs)) if k not in chosen and slope[k] > cost]
            if not tried or (top := max(tried, key=lambda x: x[0]))[0] - best <= cost:
                break
            best, share, chosen = top[0], top[1], top[2]
        return {self.langs[k]: float(s) for k, s in sorted(zip(chosen, share, strict=True), key=lambda x: (-x[1], x[0]))}

    @staticmethod
    def _fit(own: np.ndarray, count: np.ndarray, n: float, langs: list[int], share: np.ndarray) -> tuple[float, np.ndarray, list[int]]:
        """Log likelihood and proportions of a set of languages."""
        part, share = own[:, langs], np.append(share * 0.8, 0.2)
        for _ in range(TURNS):
            share = share * ((count / (part @ share)) @ part) / n
        return float(count @ np.log(part @ share)), share / share.sum(), langs


def held_out() -> Column:
    """Whether a document is kept from learning; a null doc_id counts as the empty string."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """n-gram probabilities of every language, from about `sample` of its documents, drawn by a hash of doc_id and text, so that
    repeated or null doc_ids are drawn like others; rows alike are drawn together.

    Uses text and lang of documents that are not held out and have a language. Counts are made and summed on the
    executors; languages times BUCKETS numbers reach the driver. Without such documents there are no languages.
    """
    known = docs.filter("lang is not null and text is not null").filter(~held_out()).select("doc_id", "lang", "text")
    sizes = stored(known.groupBy("lang").count(), "langs")
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < (1 << 30) * F.least(F.lit(1.0), sample / F.col("count"))
    rows = known.join(small(sizes), "lang").filter(F.coalesce(part, F.lit(True))).select("lang", "text")

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                if has_letter(text):
                    slot, count = grams(text)
                    np.add.at(sums.setdefault(lang, np.zeros(BUCKETS, np.int64)), slot, count)
        for lang, own in sums.items():
            some = np.flatnonzero(own)
            yield pd.DataFrame({"lang": lang, "slot": some, "n": own[some]})

    sums = rows.mapInPandas(counted, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(set(sums["lang"]))
    table = np.full((BUCKETS, len(langs)), SMOOTHING)
    table[sums["slot"].to_numpy(int), sums["lang"].map({x: k for k, x in enumerate(langs)}).to_numpy(int)] += sums["n"].to_numpy(float)
    return Model(langs, table / table.sum(0) if langs else table)


def languages(model: Model, text: Column) -> Column:
    """struct(lang_pred, score, proportions) of a text column; `und` with score 0 where there is none."""

    @F.pandas_udf("lang_pred string, score double, proportions string")
    def of(texts: pd.Series) -> pd.DataFrame:
        found = [model.mixture(t) for t in texts]
        first = [next(iter(m.items()), (UNKNOWN, 0.0)) for m in found]
        shown = [",".join(f"{k}:{v:.4f}" for k, v in m.items()) for m in found]
        return pd.DataFrame({"lang_pred": [k for k, _ in first], "score": [min(1.0, v) for _, v in first], "proportions": shown})

    return of(text)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score and proportions of every document; languages of equal proportion go by name."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs)
    return docs.select("doc_id", held_out().alias("held_out"), languages(model, F.col("text")).alias("x")).select("doc_id", "held_out", "x.*")
