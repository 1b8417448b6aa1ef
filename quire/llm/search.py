"""Ranked lexical search by block-max pruning: blocks are taken in the order of their bounds, until no bound can reach the best found."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from quire.session import bounded_batches, removed, small, stored

#: Results of an item.
TOP = 10
#: Documents of a block, in the order in which they are read, and postings beyond which a block is closed.
DOCS, POSTINGS = 64, 1 << 17
#: Blocks that a reader decodes at once: by calculation some 0.5 MB each in memory, 7 MB at most unless a single document has more postings.
READ = 16
#: Blocks with the highest bounds that are scored first, to find a threshold for each item.
FIRST = 4
#: Items and terms of a set of queries, about; the sets are searched one after the other.
ITEMS, TERMS = 1_000, 500_000
#: Distinct terms whose hashes a worker remembers.
KNOWN = 400_000

#: Bytes of terms stay, A-Z in lower case; all others become spaces.
_KEEP = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a whole text in order: runs of ASCII letters and digits and of all characters beyond ASCII; null has none."""
    return (text or "").encode().translate(_KEEP).split()


class _Hashes(dict):
    """64-bit hashes of terms, as signed numbers, made once; forgets all before it holds too many."""

    def __missing__(self, term: bytes) -> int:
        if len(self) >= KNOWN:
            self.clear()
        value = self[term] = int(np.uint64(xxhash.xxh64_intdigest(term)).astype(np.int64))
        return value


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, values)]), pa.int32()), pa.array(np.concatenate([*values, np.empty(0, np.int64)]).astype(kind.to_pandas_dtype()), kind))


@dataclass(frozen=True)
class Index:
    """Stored tables of an index, and the figures of the whole corpus.

    `blocks`: a row for each block with its documents, their sizes, its distinct terms (64-bit hashes, sorted), how many of its documents
    hold each, and the postings term by term: place of the document in the block, and occurrences. `maxima`: the blocks' terms with
    their highest impact and number of documents.
    """

    blocks: DataFrame
    maxima: DataFrame
    documents: int
    size: int


def _impact(often: np.ndarray, sizes: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What an occurrence count is worth in a document of so many terms, before the term's weight; 64-bit integers."""
    m = 25 + (75 * sizes * documents) // total
    return (1_000_000_000 * often) // (1_000 * often + 8 * m)


def build(docs: DataFrame, block_docs: int = DOCS) -> Index:
    """The index of all whole texts of `docs` (doc_id, text).

    Blocks are runs of documents as they are stored, so building moves no text. Impacts depend on figures of the whole
    corpus, so maxima are made in a second pass, over the blocks. Texts without a term are in no block. Terms are told
    apart by 64-bit hashes: that one of a million query terms shares its hash with one of a billion others has a chance of 5e-5.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, number, held, size = _Hashes(), TaskContext.get().partitionId() << 40, [], 0

        def block() -> pa.RecordBatch:
            nonlocal number
            number += 1
            term = np.concatenate([x[2] for x in held])
            order = np.argsort(term, kind="stable")
            distinct, holds = np.unique(term, return_counts=True)
            at = np.repeat(np.arange(len(held)), [len(x[2]) for x in held])[order]
            often = np.concatenate([x[3] for x in held])[order]
            columns = [pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), pa.array([x[0] for x in held], id_type))]
            columns += [_lists([np.array([x[1] for x in held])], pa.int64()), _lists([distinct], pa.int64()), *(_lists([x], pa.int32()) for x in (holds, at, often))]
            return pa.RecordBatch.from_arrays(columns, ["block", "docs", "sizes", "terms", "holds", "at", "often"])

        for batch in batches:
            id_type = batch.column("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if not (found := terms(text)):
                    continue
                times = Counter(found)
                held.append((doc_id, len(found), np.fromiter(map(hashes.__getitem__, times), np.int64), np.fromiter(times.values(), np.int64)))
                size += len(times)
                if len(held) == block_docs or size >= POSTINGS:
                    yield block()
                    held, size = [], 0
        if held:
            yield block()

    bounded_batches(docs.sparkSession)
    schema = f"block long, docs array<{kind}>, sizes array<long>, terms array<long>, holds array<int>, at array<int>, often array<int>"
    blocks = stored(docs.select("doc_id", "text").mapInArrow(cut, schema), "blocks", group_rows=READ)
    documents, total = (x or 0 for x in blocks.agg(F.sum(F.size("docs")), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, n: a + n))).first())

    def highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sizes, holds, at, often in zip(*map(batch.column, ("sizes", "holds", "at", "often")), strict=True):
                sizes, holds, at, often = (x.values.to_numpy() for x in (sizes, holds, at, often))
                starts = np.cumsum(holds) - holds
                most.append(np.maximum.reduceat(_impact(often.astype(np.int64), sizes[at], documents, total), starts))
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("terms"), batch.column("holds"), _lists(most, pa.int32())], ["block", "terms", "holds", "most"])
            most.clear()

    most: list[np.ndarray] = []
    maxima = blocks.select("block", "sizes", "terms", "holds", "at", "often").mapInArrow(highest, "block long, terms array<long>, holds array<int>, most array<int>")
    return Index(blocks, stored(maxima, "maxima", group_rows=READ), documents, total)


def _queries(items: DataFrame) -> DataFrame:
    """item, item_id, term, times: a row for each distinct term of each row of `items` (item_id, text); rows are items of their own."""
    kind = items.schema["item_id"].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            counts = [Counter(terms(t)) for t in batch.column("text").to_pylist()]
            found, often = [np.fromiter(map(hashes.__getitem__, c), np.int64) for c in counts], [np.fromiter(c.values(), np.int64) for c in counts]
            yield pa.RecordBatch.from_arrays([batch.column("item"), batch.column("item_id"), _lists(found, pa.int64()), _lists(often, pa.int64())], ["item", "item_id", "terms", "times"])

    rows = items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text").mapInArrow(split, f"item long, item_id {kind}, terms array<long>, times array<long>")
    return rows.select("item", "item_id", F.explode(F.arrays_zip("terms", "times")).alias("x")).select("item", "item_id", F.col("x.terms").alias("term"), F.col("x.times").alias("times"))


def _best(rows: DataFrame, top: int) -> DataFrame:
    """The `top` rows of each item with the highest score, then the smallest doc_id, with their rank; each task cuts its rows first."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _scored(index: Index, wanted: DataFrame, weights, top: int) -> DataFrame:
    """wanted(block, item, bound, least) -> (item, doc_id, score): what may be among the `top` documents of each item, by blocks.

    In a task and for each item, the blocks at hand are sorted by bound and scored until a bound is below the threshold: the `top`th
    score found so far in the task, or `least` at first. Equal scores count too, as a smaller doc_id may win.
    """
    kind = index.blocks.schema["docs"].dataType.elementType.simpleString()
    lists = stored(wanted.groupBy("block").agg(F.collect_list(F.struct("bound", "item", "least")).alias("items")), "wanted")  # ITEMS of one block, about
    documents, total = index.documents, index.size

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, best, least, id_type = weights.value, {}, {}, None
        for batch in batches:
            id_type = batch.column("docs").type.value_type
            turns: dict[int, list[tuple[int, int]]] = {}
            for row, items in enumerate(batch.column("items").to_pylist()):
                for x in items:
                    turns.setdefault(x["item"], []).append((x["bound"], row))
                    least.setdefault(x["item"], x["least"])
            opened: dict[int, tuple] = {}
            for item, blocks in turns.items():
                term, weight = own[item]
                for bound, row in sorted(blocks, reverse=True):
                    if bound < least[item]:
                        break
                    if row not in opened:
                        docs = batch.column("docs")[row].as_py()
                        sizes, distinct, holds, at, often = (batch.column(c)[row].values.to_numpy() for c in ("sizes", "terms", "holds", "at", "often"))
                        opened[row] = docs, distinct, np.append(0, np.cumsum(holds)), at, _impact(often.astype(np.int64), sizes[at], documents, total)
                    docs, distinct, starts, at, impact = opened[row]
                    where = np.minimum(np.searchsorted(distinct, term), len(distinct) - 1)
                    there = distinct[where] == term
                    score = np.zeros(len(docs), np.int64)
                    for k, w in zip(where[there].tolist(), weight[there].tolist(), strict=True):
                        a, b = starts[k], starts[k + 1]
                        score[at[a:b]] += w * impact[a:b]  # a document is there once for each term
                    good = np.flatnonzero((score > 0) & (score >= least[item])).tolist()
                    kept = sorted(best.get(item, []) + [(-int(score[i]), docs[i] is None, docs[i]) for i in good], key=lambda x: x[:2] if x[1] else x)[:top]
                    best[item] = kept
                    if len(kept) == top:
                        least[item] = max(least[item], -kept[-1][0])
        rows = [(item, x[2], -x[0]) for item, kept in best.items() for x in kept]
        if rows:
            found = [*zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], id_type), pa.array(found[2], pa.int64())], ["item", "doc_id", "score"])

    rows = index.blocks.join(small(lists, size=64 << 20), "block").select("items", "docs", "sizes", "terms", "holds", "at", "often")
    return rows.mapInArrow(prune, f"item long, doc_id {kind}, score long")


def search(index: Index, items: DataFrame, top: int = TOP, first: int = FIRST) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` documents of each row of `items` (item_id, text) by the contract's score, above 0.

    A block's bound for an item is the sum of its maxima, weighted as the terms are. The `first` blocks by bound of each item are
    scored to find a threshold, the `top`th score in them; then all other blocks whose bound reaches it, in the order of their bounds
    within each task. No block with a lower bound can hold a result, so none is lost. Items come in sets of a bounded number, whose
    weights are all that a task holds besides blocks. Null or wordless items, and an empty index, give no rows; repeated rows of either
    side are rows of their own; null doc_ids come last among equals.
    """
    spark = items.sparkSession
    bounded_batches(spark)
    queries = stored(_queries(items), "queries")
    rows, many = queries.count(), queries.select("item").distinct().count()
    sets = max(1, -(-many // ITEMS), -(-rows // TERMS))
    found = [_found(index, queries.filter(F.pmod(F.xxhash64("item"), F.lit(sets)) == k) if sets > 1 else queries, top, first) for k in range(sets if rows and index.documents else 0)]
    names = queries.select("item", "item_id").distinct()
    if not found:
        kind = index.blocks.schema["docs"].dataType.elementType
        return names.limit(0).select("item_id", F.lit(0).alias("rank"), F.lit(None).cast(kind).alias("doc_id"), F.lit(0).cast("long").alias("score"))
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out.join(small(stored(names, "names")), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _found(index: Index, queries: DataFrame, top: int, first: int) -> DataFrame:
    """item, rank, doc_id, score of one set of queries."""
    spark = queries.sparkSession
    terms_ = stored(queries.select("term").distinct(), "terms")
    entries = index.maxima.select("block", F.explode(F.arrays_zip("terms", "holds", "most")).alias("x")).select("block", F.col("x.terms").alias("term"), F.col("x.holds").alias("holds"), F.col("x.most").alias("most"))
    seen = stored(entries.join(small(terms_), "term"), "seen")
    rarity = seen.groupBy("term").agg(F.sum("holds").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * index.documents + 2) / (2 * F.col("df") + 1))).cast("long")
    weights = stored(queries.join(rarity, "term").select("item", "term", (F.col("times") * weight).alias("weight")).filter("weight > 0"), "weights")
    bounds = seen.join(small(weights), "term").groupBy("item", "block").agg(F.sum(F.col("weight") * F.col("most")).alias("bound"))
    bounds = stored(bounds, "bounds")
    own: dict[int, tuple[list, list]] = {}
    for r in weights.toLocalIterator():  # of one set of items, whose number is bounded
        for values, x in zip(own.setdefault(r.item, ([], [])), (r.term, r.weight), strict=True):
            values.append(x)
    sent = spark.sparkContext.broadcast({k: (np.array(t, np.int64), np.array(w, np.int64)) for k, (t, w) in own.items()})
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "block")
    ahead = stored(bounds.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= first).drop("nth").withColumn("least", F.lit(1).cast("long")), "ahead")
    early = stored(_scored(index, ahead, sent, top), "early")
    # each task keeps its best, so rows of an item are few
    least = stored(_best(early, top).groupBy("item").agg(F.when(F.count("*") == top, F.min("score")).otherwise(1).cast("long").alias("least")), "least")
    rest = bounds.join(small(ahead.select("item", "block")), ["item", "block"], "left_anti").join(small(least), "item", "left").withColumn("least", F.coalesce("least", F.lit(1).cast("long")))
    late = stored(_scored(index, rest.filter(F.col("bound") >= F.col("least")), sent, top), "late")
    removed(spark, seen)
    return _best(early.unionByName(late), top)


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item, by an index of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return search(build(docs), items)


OP13_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
corpus AS (SELECT count(*) AS documents, sum(n)::BIGINT AS total FROM sizes),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), times AS (SELECT item_id, term, count(*) AS times FROM asked GROUP BY ALL),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * c + 2) / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df, any_value(documents) AS c FROM tf, corpus GROUP BY term)),
impact AS (
  SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * documents) // total)) AS q FROM tf JOIN sizes USING (doc_id), corpus
), scores AS (
  SELECT item_id, doc_id, sum(times * w * q)::BIGINT AS score FROM times JOIN w USING (term) JOIN impact USING (term) GROUP BY item_id, doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0
) WHERE rank <= 10
"""
