import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from quire.llm import token_counts
from quire.llm.token_counts import _encoder, counted, op8_token_counts

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def library(texts):
    own = Tokenizer.from_file(PATH)
    return [len(own.encode(t or "", add_special_tokens=False)) for t in texts]


def test_pieces_against_the_library(monkeypatch):
    rnd = random.Random(6)
    latin = [chr(c) for c in range(256)]
    texts = ["", " ", "it's I'LL  two   spaces\n\n x", "a<|endoftext|>b", "<|endoftext|>", "œuvre naïve 漢字 🙂", "x" * 5000, "tab\there nbsp\x85nel\x1cfs"]
    texts += ["".join(rnd.choices(latin, k=60)) for _ in range(400)] + ["".join(rnd.choices(" 'abstrevldm1\n\t.é\xa0\x85\x1c", k=40)) for _ in range(400)]
    assert _encoder(PATH)(texts) == library(texts)
    monkeypatch.setattr(token_counts, "PIECES", 50)
    assert _encoder(PATH)(texts) == library(texts)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers(name):
    path, texts = public_tokenizers.path(name), ["Hello there", "", "É à b"]
    if name.endswith("json"):
        want = [len(Tokenizer.from_file(path).encode(t, add_special_tokens=False)) for t in texts]
    else:
        want = [len(x) for x in SentencePieceProcessor(model_file=path).encode(texts)]
    assert _encoder(path)(texts) == want


def test_cache_encodes_each_content_once(spark, tmp_path):
    cache = str(tmp_path / "cache")
    docs = [(1, "one two"), (1, "one two"), (2, "one two"), (None, None), (3, ""), (None, "new"), (4, "long " * 200_000)]
    docs = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, digest string")
    rows = sorted(((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in counted(docs, PATH, cache).collect()))
    assert rows == sorted([(1, 7, 2), (1, 7, 2), (2, 7, 2), (0, 0, 0), (3, 0, 0), (0, 3, 1), (4, 1_000_000, library(["long " * 200_000])[0])])
    assert spark.read.parquet(cache).count() <= 5  # a repeated row may be encoded twice within one run
    before = spark.read.parquet(cache).count()
    assert counted(docs, PATH, cache).count() == 7 and spark.read.parquet(cache).count() == before
    more = docs.unionByName(spark.createDataFrame([(9, "fresh words", "y")], docs.schema))
    assert counted(more, PATH, cache).count() == 8 and spark.read.parquet(cache).count() == before + 1
    other = counted(more, public_tokenizers.path("word_bpe_49k.json"), cache)
    assert other.count() == 8 and spark.read.parquet(cache).select("tokenizer").distinct().count() == 2
    assert counted(docs.limit(0), PATH, cache).count() == 0


def test_query_against_the_library(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = dict(zip(texts, library(texts.values()), strict=True))
    rows = op8_token_counts(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), want[r.doc_id], want[r.doc_id] > 1024)
