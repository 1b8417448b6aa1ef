"""Cross-tokenizer alignment: byte labels tell where tokens of two tokenizers end together, and a regex cuts them into groups."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from quire.llm.pieces import grouped
from quire.session import bounded_batches, small, stored

#: Labels of a byte: no token ends with it, one of A, one of B, one of both.
NONE, ENDS_A, ENDS_B, BOTH = b"nabc"
SPAN = re.compile(rb"[nab]*+c")
#: A text is cut before a space between two characters that neither library takes for white space: no token of either crosses it.
CUT = re.compile(r" (?<=[^\s▁] )(?=[^\s▁])")
PLAIN = re.compile(r"(?s)[^\s▁](?:.*[^\s▁])?\Z")
#: Segments that a worker remembers, about; then it forgets those that it has met once only.
SEGMENTS = 200_000
#: Segments that are encoded together, and characters of texts that are taken together.
CHUNK, GROUP = 10_000, 1 << 20
#: A link is kept as id of A * PAIR + id of B. Pairs linked most often, HOT of them at most, are broadcast to be looked up.
PAIR, HOT = 1 << 32, 200_000

_LINKED = "n_a long, n_b long, groups string, pairs array<long>, times array<int>"


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, others from U+0100 on in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class _Pair:
    """Two tokenizers, the bytes of their tokens, and the alignments of segments that were met."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        byte = _byte_of()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = dict.fromkeys(range(self.a.get_vocab_size()), b"") | {i: bytes(map(byte.__getitem__, t)) for t, i in vocabulary.items() if byte.keys() >= set(t)}
        piece = lambda i: bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
        self.bytes_b = {i: piece(i) for i in range(self.b.get_piece_size())}
        self.size_a, self.size_b = (np.array([len(known[i]) for i in range(len(known))]) for known in (self.bytes_a, self.bytes_b))
        self.index: dict[str, int] = {}
        self.forget([])

    def forget(self, kept: list[int]) -> None:
        """Only segments of these numbers stay."""
        shown = [*self.index] if kept else []
        self.index = {shown[k]: n for n, k in enumerate(kept)}
        if kept:
            first, count = self.first[kept], self.count[kept]
            self.links = self.links[np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())]
            self.first, self.count, self.sizes, self.groups = np.cumsum(count) - count, count, self.sizes[kept], [self.groups[k] for k in kept]
        else:
            self.links, self.first, self.count, self.groups = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), []
            self.sizes = np.empty((0, 2), np.int64)  # tokens of A and B; -1 where their bytes differ from the segment's
        self.met = np.zeros(len(kept), bool)

    def learn(self, segments: list[str], alone: bool = False) -> None:
        """Aligns segments, each without the space before it. Those that both begin and end with a visible character are encoded
        as one text, as no token crosses the space between two of them; others, and all if the bytes differ, one by one."""
        if not alone:
            joins = [s for s in segments if PLAIN.match(s)]
            if len(joins) < len(segments):
                self.learn(joins)
                self.learn([s for s in segments if not PLAIN.match(s)], True)
                return
        if not segments:
            return
        wanted = [f" {s}" for s in segments]
        joined = "".join(wanted)
        if alone:
            ids_a = [e.ids for e in self.a.encode_batch_fast(wanted, add_special_tokens=False)]
            ids_b = self.b.encode(segments, num_threads=1)
            good = [self.text(self.bytes_a, a) == self.text(self.bytes_b, b) == w.encode() for a, b, w in zip(ids_a, ids_b, wanted, strict=True)]
            for s in (s for s, g in zip(segments, good, strict=True) if not g):
                self.add([s], np.full((1, 2), -1), np.zeros(1, np.int64), np.empty(0, np.int64), [""])
            segments, ids_a, ids_b, wanted = ([x for x, g in zip(xs, good, strict=True) if g] for xs in (segments, ids_a, ids_b, wanted))
            if not segments:
                return
            joined, flat_a, flat_b = "".join(wanted), [*chain.from_iterable(ids_a)], [*chain.from_iterable(ids_b)]
        else:
            flat_a, flat_b = self.a.encode(joined, add_special_tokens=False).ids, self.b.encode(joined[1:])
            if not self.text(self.bytes_a, flat_a) == self.text(self.bytes_b, flat_b) == joined.encode():
                self.learn(segments, True)
                return
        flat = np.array(flat_a, np.int64), np.array(flat_b, np.int64)
        ends = np.cumsum(self.size_a[flat[0]]), np.cumsum(self.size_b[flat[1]])
        labels = np.full(ends[0][-1], NONE, np.uint8)
        labels[ends[0] - 1] = ENDS_A
        labels[ends[1] - 1] = np.where(labels[ends[1] - 1] == ENDS_A, BOTH, ENDS_B)
        spans = SPAN.findall(labels.tobytes())
        of_a, of_b = (np.cumsum([span.count(c) + 1 for span in spans]) for c in (b"a", b"b"))
        links = flat[0][of_a - 1] * PAIR + flat[1][of_b - 1]
        shown_a, shown_b, last_a, last_b = [*map(str, flat_a)], [*map(str, flat_b)], of_a.tolist(), of_b.tolist()
        groups = [f"{shown_a[n - 1] if n - i == 1 else ','.join(shown_a[i:n])}|{shown_b[m - 1] if m - j == 1 else ','.join(shown_b[j:m])}" for i, n, j, m in zip([0, *last_a], last_a, [0, *last_b], last_b, strict=False)]
        # a segment ends with a span, as the tokens of both do
        whole = np.cumsum([len(w.encode()) for w in wanted])
        own_a, own_b = (np.searchsorted(e, whole, "right") for e in ends)
        own = np.searchsorted(of_a, own_a, "right")
        low = [0, *own.tolist()]
        self.add(segments, np.stack([np.diff(own_a, prepend=0), np.diff(own_b, prepend=0)], 1), np.diff(own, prepend=0), links, [";".join(groups[i:j]) for i, j in zip(low, low[1:], strict=False)])

    def add(self, segments: list[str], sizes: np.ndarray, count: np.ndarray, links: np.ndarray, groups: list[str]) -> None:
        self.index.update(zip(segments, range(len(self.index), len(self.index) + len(segments)), strict=True))
        self.first = np.append(self.first, len(self.links) + np.cumsum(count) - count)
        self.links, self.count, self.sizes = np.append(self.links, links), np.append(self.count, count), np.concatenate([self.sizes, sizes])
        self.groups += groups
        self.met = np.append(self.met, np.zeros(len(segments), bool))

    @staticmethod
    def text(known: dict[int, bytes], ids: list[int]) -> bytes:
        return b"".join(map(known.__getitem__, ids))

    def align(self, texts: list[str | None]) -> Iterator[tuple[int, int, str, np.ndarray, np.ndarray]]:
        """n_a, n_b, groups, distinct links and how often each occurs, of each text."""
        cut = [CUT.split(t) if t else () for t in texts]
        wanted = set(chain.from_iterable(cut))
        if len(self.index) > SEGMENTS:
            kept = np.flatnonzero(self.met)
            self.forget(kept.tolist() if 2 * len(kept) < SEGMENTS else [])
        self.met[[self.index[s] for s in wanted if s in self.index]] = True
        new = [s for s in wanted if s not in self.index]
        for k in range(0, len(new), CHUNK):
            self.learn(new[k : k + CHUNK])
        for parts in cut:
            own = np.fromiter(map(self.index.__getitem__, parts), np.int64, len(parts))
            sizes, count = self.sizes[own], self.count[own]
            if not len(own) or sizes.min() < 0:
                yield 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int32)
                continue
            links = self.links[np.repeat(self.first[own] - np.cumsum(count) + count, count) + np.arange(count.sum())]
            pairs, often = np.unique(links, return_counts=True)
            n_a, n_b = sizes.sum(0).tolist()
            yield n_a, n_b, ";".join(map(self.groups.__getitem__, own.tolist())), pairs, often.astype(np.int32)


@lru_cache(maxsize=1)
def _pair(path_a: str, path_b: str) -> _Pair:
    return _Pair(path_a, path_b)


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, text -> doc_id, n_a, n_b, groups, pairs, times: the tokens of both tokenizers in groups that end at the same byte.

    A (a byte-level .json file) encodes a space and the text, B (a SentencePiece .model file) the text, to which it adds the space
    itself; strings of special tokens are plain text. Every byte gets a label: no token ends there, one of A, one of B, or both; a regex
    scans spans up to each both-label, and the labels in a span count its tokens. `groups` has them as `a1,a2|b1;a3|b2,b3`; `pairs`
    has the distinct links (id of A * 2**32 + id of B) of tokens that end together, `times` how often each occurs.
    Texts that are null, empty, or whose tokens of A or B do not join to the space and the text have no tokens: zeros, '' and
    empty arrays. Segments between plain spaces are labelled once and remembered in each worker; texts of any length. Rows stay
    rows, with null and repeated doc_ids; other columns are left behind.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(path_a, path_b)
        for batch in batches:
            found = [x for group in grouped(batch.column("text").to_pylist(), GROUP) for x in pair.align(group)]
            n_a, n_b, groups, pairs, times = zip(*found, strict=True) if found else ((),) * 5
            ends = pa.array(np.cumsum([0, *map(len, pairs)]), pa.int32())
            links, often = pa.array(np.concatenate([*pairs, np.empty(0, np.int64)])), pa.array(np.concatenate([*times, np.empty(0, np.int32)]))
            columns = [batch.column("doc_id"), pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()), pa.array(groups, pa.string()), pa.ListArray.from_arrays(ends, links), pa.ListArray.from_arrays(ends, often)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_a", "n_b", "groups", "pairs", "times"])

    bounded_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(make, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {_LINKED}")


def pair_counts(rows: DataFrame) -> DataFrame:
    """pairs, times -> pair, n, best: how often each pair of ids is linked in all rows, and whether no pair of the same B id is linked more often."""
    counts = stored(rows.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("n")), "pair_counts")
    b = F.col("pair") % PAIR
    highest = stored(counts.groupBy(b.alias("b")).agg(F.max("n").alias("highest")), "highest")  # a row for each id of B at most
    return stored(counts.join(small(highest), b == F.col("b")).select("pair", "n", (F.col("n") == F.col("highest")).alias("best")), "pairs")


def _least(counts: DataFrame, hot: int) -> int:
    """The least n so that `hot` pairs at most are linked as often; from a histogram with 16 bins for each doubling."""
    bins = counts.groupBy(F.floor(F.log2("n") * 16).cast("int").alias("bin")).agg(F.count("*").alias("many"), F.min("n").alias("least")).collect()  # 1,024 bins at most
    total, least = 0, 1 << 62
    for x in sorted(bins, key=lambda x: -x.bin):
        if (total := total + x.many) > hot:
            break
        least = x.least
    return least


def scored(rows: DataFrame, hot: int = HOT) -> DataFrame:
    """Stored rows (row, pairs, times) -> row, n_links, n_best, count_sum, by the counts over all rows; rows without links are left out.

    The pairs linked most often, `hot` at most, are broadcast, so that no frequent pair is ever a hot key; the others, if there are
    any, are rare by that and joined by a shuffle. Every pair goes one of the two ways.
    """
    counts = pair_counts(rows)
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").cast("long").alias("times"))
    least = _least(counts, hot)
    often = F.broadcast(counts.filter(F.col("n") >= least))
    found, rare = links.join(often, "pair"), counts.filter(F.col("n") < least)
    sums = lambda found: found.groupBy("row").agg(F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    if rare.isEmpty():
        return sums(found)
    return sums(found.unionByName(links.join(often.select("pair"), "pair", "left_anti").join(rare, "pair").select(found.columns)))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of tokens, groups and links of every document, and the digest of its groups."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = aligned(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    shown = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    n_groups = F.when(F.col("groups") == "", 0).otherwise(F.length("groups") - F.length(F.replace("groups", F.lit(";"))) + 1).cast("long")
    rows = stored(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_a", "n_b", n_groups.alias("n_groups"), shown.alias("groups_sha256"), "pairs", "times"), "aligned")
    sums = scored(rows)
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return rows.join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", zero("n_links"), zero("n_best"), zero("count_sum"), "groups_sha256")
