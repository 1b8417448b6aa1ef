"""Token counts behind a cache of digests: only content that was never counted is encoded."""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import regex
import sentencepiece
import tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from quire.session import shared_dir, small, stored

#: A document with more tokens than this is over the limit of the query.
LIMIT = 1024
#: Texts are handed to the tokenizer in groups of so many characters, to bound its buffers.
GROUP_CHARS = 1 << 20
CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens bigint"


#: Pieces that a worker remembers before it forgets them all.
PIECES = 400_000
#: How a byte-level tokenizer cuts a text before it merges bytes; fixed by the tokenizer's file.
CUT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class _ByteLevel:
    """Counts of a byte-level BPE file by the tokenizers library.

    Bytes merge within pieces of a text only, so a piece is given to the library once and its count is
    remembered. Texts for which the cut might differ (added tokens, or characters beyond Latin-1, whose classes depend
    on the Unicode version) go to the library whole.
    """

    def __init__(self, own):
        self.own, self.cut, self.known = own, regex.compile(CUT), {}
        self.added = [t.content for t in own.get_added_tokens_decoder().values()]

    def __call__(self, texts: list[str]) -> list[int]:
        return [self.pieces(t) if self.plain(t) else len(self.own.encode(t, add_special_tokens=False)) for t in texts]

    def plain(self, text: str) -> bool:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return not any(t in text for t in self.added)

    def pieces(self, text: str) -> int:
        cut = self.cut.findall(text)
        if new := [w for w in set(cut) if w not in self.known]:
            if len(self.known) + len(new) > PIECES:
                self.known.clear()
                new = [*set(cut)]
            words = [w for w in new if w[0] == " " and w[1:].isalpha()]  # in a row, these are cut as they stand here
            if words:
                own = np.array(self.own.encode("".join(words), add_special_tokens=False).word_ids)
                self.known.update(zip(words, np.bincount(own, minlength=len(words)).tolist(), strict=True))
            rest = [w for w in new if w not in self.known]
            self.known.update(zip(rest, map(len, self.own.encode_batch_fast(rest, add_special_tokens=False)), strict=True))
        return sum(map(self.known.__getitem__, cut))


@lru_cache(maxsize=2)
def _encoder(path: str):
    """Function from texts to counts for a tokenizer file, loaded once in each worker."""
    if path.endswith(".json"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        own = Tokenizer.from_file(path)
        own.no_truncation()
        own.no_padding()
        cut = (json.loads(own.pre_tokenizer.__getstate__()) if own.pre_tokenizer else {}) == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        if cut and own.normalizer is None:
            return _ByteLevel(own)
        return lambda texts: [len(e) for e in own.encode_batch_fast(texts, add_special_tokens=False)]
    own = SentencePieceProcessor(model_file=path)
    return lambda texts: [len(e) for e in own.encode(texts, num_threads=1)]


def version(path: str) -> str:
    """Digest that names a tokenizer: of its file, and of the version of the library that reads it."""
    library = tokenizers.__version__ if path.endswith(".json") else sentencepiece.__version__
    return hashlib.sha256(Path(path).read_bytes() + f"\n{Path(path).suffix} {library}".encode()).hexdigest()


def content(text: Column) -> Column:
    """Normalised content: null is empty. Nothing else may change, as every byte can change the tokens."""
    return F.coalesce(text, F.lit(""))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(content(text).cast("binary"), 256))


def encoded(texts: DataFrame, path: str) -> DataFrame:
    """(digest, again, text) -> (digest, n_tokens), in groups of bounded size; of rows alike with `again`, a task encodes one."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, seen = _encoder(path), set()
        for batch in batches:
            own, counts, group, chars = [], [], [], 0
            for digest_, again, text in zip(batch["digest"], batch["again"], batch["text"], strict=True):
                if again and digest_ in seen:
                    continue
                if again:
                    seen.add(digest_)
                own.append(digest_)
                group.append(text)
                chars += len(text)
                if chars >= GROUP_CHARS:
                    counts += encode(group)
                    group, chars = [], 0
            yield pd.DataFrame({"digest": own, "n_tokens": counts + encode(group)})

    return texts.select("digest", "again", "text").mapInPandas(count, "digest binary, n_tokens bigint")


def misses(docs: DataFrame, prints: DataFrame, missing: DataFrame) -> DataFrame:
    """(digest, again, text) of one document of each missing digest (wanted, first_id, times); prints has the digests of all documents.

    Texts stay where they are as long as one of two lists is small enough to be broadcast: the missing digests, as when the
    cache is warm; or the digests that are cached or repeated, as when it is cold. Only where both are large, missing texts are
    shuffled by digest.
    """
    own = docs.select("doc_id", content(F.col("text")).alias("text")).withColumn("digest", digest(F.col("text")))
    first = F.col("digest") == F.col("wanted")
    few = small(missing)
    if few is missing:
        cached = prints.select(F.col("digest").alias("wanted")).distinct().join(missing, "wanted", "left_anti")
        kind = missing.schema["first_id"].dataType
        listed = missing.filter("times > 1").unionByName(cached.select("wanted", F.lit(None).cast(kind).alias("first_id"), F.lit(0).cast("long").alias("times")))
        listed = stored(listed, "listed")
        if (rest := small(listed)) is not listed:
            rows = own.join(rest, first, "left").filter(F.col("times").isNull() | ((F.col("times") > 1) & own["doc_id"].eqNullSafe(F.col("first_id"))))
            return rows.select("digest", F.col("times").isNotNull().alias("again"), "text")
    return own.join(few, first & own["doc_id"].eqNullSafe(F.col("first_id"))).select("digest", (F.col("times") > 1).alias("again"), "text")


def counted(docs: DataFrame, path: str, cache: str) -> DataFrame:
    """`docs` (doc_id, text) -> doc_id, n_bytes, n_tokens; one row for each input row.

    The cache is a Parquet folder of (tokenizer, digest, n_tokens). Content digests of all documents are joined to
    the counts that it holds for this tokenizer; of what is missing, one document of each digest is encoded, and the new counts
    are appended to the cache. Documents alike are encoded once (once a task, if doc_id is the same too), and not at all in a
    later run. Null text counts as empty, which has 0 tokens; an empty table leaves the cache as it is. Null and repeated
    doc_ids are counted row by row, and other columns are left behind.
    """
    spark = docs.sparkSession
    name = version(path)
    held = lambda: spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("tokenizer") == name).select("digest", "n_tokens").dropDuplicates(["digest"])
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache)  # so that there is one to read
    prints = stored(docs.select("doc_id", digest(F.col("text")).alias("digest"), F.octet_length(content(F.col("text"))).cast("long").alias("n_bytes")), "digests")
    missing = prints.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("times")).join(held(), "digest", "left_anti")
    missing = stored(missing.withColumnRenamed("digest", "wanted"), "missing")
    if missing.count():
        encoded(misses(docs, prints, missing), path).select(F.lit(name).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache)
    # stored, so that both sides of the join are plain shuffles, of which a hot digest's can be split
    return prints.join(stored(held(), "counts"), "digest").select("doc_id", "n_bytes", "n_tokens")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document: a first pass fills the cache, the rows come from a second one that only hits it."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    path, cache = public_tokenizers.path("byte_bpe_50k.json"), f"{shared_dir(spark)}/token-cache-{uuid.uuid4().hex}"
    counted(docs, path, cache)
    return counted(docs, path, cache).withColumn("over_limit", F.col("n_tokens") > LIMIT)
