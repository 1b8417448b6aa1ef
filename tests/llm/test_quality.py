import zlib
from collections import Counter

import numpy as np
import pytest

from quire.llm import quality
from quire.llm.quality import Model, features, fit, op1_quality_classifier, scores, train

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("text", [None, "", " \n\t"])
def test_no_words_no_features(text):
    assert len(features(text)[0]) == 0


def test_features_use_the_whole_text():
    long = "good words here " * 400_000
    head, tail = features(long), features(long + "###$$$ " * 400_000)
    assert set(head[0]) < set(tail[0])
    assert np.isfinite(tail[1]).all() and (tail[0] < quality.SIZE).all() and len(set(tail[0])) == len(tail[0])


def test_prior_and_risk_on_separable_texts():
    rng = np.random.default_rng(5)
    good = lambda: " ".join(rng.choice(["calm", "river", "stone", "light", "tree"], 30))
    bad = lambda: " ".join(rng.choice(["WIN!!", "$$$", "CLICK", "###"], 30))
    web = [good() if k < 420 else bad() for k in range(600)]
    model = fit([features(good()) for _ in range(300)], [features(t) for t in web])
    assert 0.6 < model.prior < 0.85
    got = model.score([good() for _ in range(50)] + [bad() for _ in range(50)] + [None, ""])
    assert (got[:50] > 0.5).all() and (got[50:100] < 0.5).all() and got[100] == got[101]


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (None, None)], "doc_id long, text string")
    model = train(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert [r.s for r in docs.select(scores(model, docs.text).alias("s")).collect()] == [0.5, 0.5]
    assert train(docs.limit(0), spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")).prior == 0.5


def test_held_out_accuracy(spark):
    got = op1_quality_classifier(spark, SF)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id", "left").collect()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.quality is not None]
    good = np.mean([r.predicted for r in held if r.quality == 1])
    bad = np.mean([1 - r.predicted for r in held if r.quality == 0])
    assert good > 0.97 and bad > 0.8, (good, bad)


def test_scores_are_pure(spark):
    model = Model(np.ones(quality.SIZE) * 0.01, 0.1, 0.5)
    docs = spark.createDataFrame([(1, "x y", "en"), (2, "x y", None)], "doc_id long, text string, lang string")
    a, b = (r.s for r in docs.select(scores(model, docs.text).alias("s")).collect())
    assert a == b


def plain_features(text):
    """The same features by plain loops: dict of index to value."""
    kind = {**{b: 1 for b in range(256)}, **{b: 0 for b in (9, 10, 11, 12, 13, 32)}}
    kind |= {b: 2 for b in range(97, 123)} | {b: 3 for b in range(65, 91)} | {b: 4 for b in range(48, 58)}
    kind |= {b: 5 + k for k, b in enumerate(b for b in range(33, 127) if not chr(b).isalnum())}
    data = (text or "").encode()
    words = data.split()
    if not words:
        return {}
    pairs = Counter((kind[a], kind[b]) for a, b in zip(data, data[1:], strict=False))
    bag = Counter()
    for w in words:
        h = sum(((b | 32) * pow(1099511628211, i % 64, 1 << 64)) for i, b in enumerate(w + b" ")) % (1 << 64)
        bag[h * 0x9E3779B97F4A7C15 % (1 << 64) >> 52] += 1
    n, first = max(1, len(data) - 1), Counter(a for a, _ in pairs.elements())
    out = {a * 64 + b: (c / n) ** 0.5 for (a, b), c in pairs.items()} | {64 * 64 + k: (c / len(words)) ** 0.5 for k, c in bag.items()}
    times = Counter(words)
    figures = 1 - len(times) / len(words), max(times.values()) / len(words), first[3] / n, sum(c for k, c in first.items() if k >= 5) / n, min(1, np.log1p(len(words)) / 10), first[4] / n
    return out | dict(enumerate(map(float, figures), 64 * 64 + 4096))


def test_query_against_plain_scores(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = train(docs.select("doc_id", "text"), labels)
    got = {r.doc_id: r for r in op1_quality_classifier(spark, SF).collect()}
    for r in docs.select("doc_id", "text").collect():
        z = model.bias + sum(model.weight[k] * v for k, v in plain_features(r.text).items())
        assert got[r.doc_id].score == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-4)


def test_repeated_and_null_ids_bring_no_more_than_the_bound(spark, monkeypatch):
    docs = spark.range(6_000).selectExpr("if(id % 2 = 0, 7, if(id % 5 = 0, null, id)) AS doc_id", "concat('text ', if(id % 4 = 0, 0, id), ' of words') AS text", "id AS h", "true AS web")
    labels = spark.range(6_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic").unionByName(spark.sql("SELECT cast(null AS bigint) AS doc_id, 1 AS quality, 0 AS toxic"))
    seen = {}
    monkeypatch.setattr(quality, "fit", lambda pos, unl: seen.update(pos=len(pos), unl=len(unl)) or Model(np.zeros(quality.SIZE), 0.0, 0.5))
    train(docs, labels, 100, 150)
    assert 0 < seen["pos"] <= 100 and 50 < seen["unl"] <= 150
    train(docs, labels, 10_000, 10_000)
    distinct = docs.filter(~quality.held_out()).select("doc_id", "text").distinct().count()
    assert seen["unl"] == distinct and seen["pos"] <= distinct


def test_accepted_keeps_rows_and_columns(spark):
    rows = [(1, "a calm river", "x", 1), (1, "a calm river", "x", 1), (None, None, None, None), (2, "", "y", 2), (3, "long " * 200_000, "z", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, held_out long")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = quality.accepted(docs, labels)  # nothing learnt: every score is 0.5, and all stay
    assert out.columns == docs.columns and sorted(map(repr, out.collect())) == sorted(map(repr, docs.collect()))
    assert quality.accepted(docs.limit(0), labels).count() == 0
