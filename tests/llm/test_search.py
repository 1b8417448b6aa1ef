import math
import random
import re
from collections import Counter

import pyarrow.parquet as pq
import pytest

from quire.llm import search
from quire.llm.search import OP13_SQL, build, op13_search, terms
from tests.llm.oracle import same

SF = "/root/testdata/sf0.001"


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, top=10):
    """(item_id, rank, doc_id, score) by scoring every document."""
    counts = [(k, Counter(plain_terms(t))) for k, t in docs]
    sizes = [c.total() for _, c in counts]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    rows = []
    for item, text in items:
        asked, found = plain_terms(text), []
        for (k, c), size in zip(counts, sizes, strict=True):
            m = 25 + (75 * size * n) // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in asked if c[t])
            if score > 0:
                found.append((-score, k is None, k or 0, k))
        rows += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(found, key=lambda x: x[:3])[:top], 1)]
    return sorted(rows, key=repr)


def got(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.mark.parametrize("text", [None, "", " .,-", "Ab-c ÄÖ é1_2", "\x00a\x7fb{c}[d]@e`f:g/h", "\u0080x\xa0y　z", "x" * 70_000 + " y"])
def test_terms(text):
    assert [t.decode() for t in terms(text)] == plain_terms(text)


def corpus(seed, n):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(40)] + ["the"] * 30 + ["Éa", "ça"]
    docs = [(k, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 3, 10, 60])))) for k in range(n)]
    docs += [(k, docs[3 * k % n][1]) for k in range(n, n + 25)]  # copies, so that scores tie
    items = [(k, " ".join(rnd.choice(words) for _ in range(rnd.choice([1, 2, 5, 12])))) for k in range(12)]
    return docs, items


@pytest.mark.parametrize(("block_docs", "first", "top"), [(1, 1, 10), (4, 1, 3), (64, 4, 10), (7, 2, 500)])
def test_against_every_score(spark, block_docs, first, top):
    docs, items = corpus(block_docs, 160)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    frame = search.search(build(table, block_docs), spark.createDataFrame(items, "item_id long, text string"), top, first)
    assert got(frame) == plain_search(docs, items, top)


def test_blocks_below_the_threshold_are_not_scored(spark, monkeypatch):
    docs = [(k, f"common filler{k} word{k % 7} " * 4) for k in range(400)] + [(1000 + k, "rare answer to the question common") for k in range(12)]
    items = [(1, "rare answer"), (2, "rare common question")]
    asked, plain = [], search._scored
    monkeypatch.setattr(search, "_scored", lambda index, wanted, weights, top: (asked.append(wanted.count()), plain(index, wanted, weights, top))[1])
    index = build(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), 4)
    assert got(search.search(index, spark.createDataFrame(items, "item_id long, text string"))) == plain_search(docs, items)
    assert index.blocks.count() == 103 and sum(asked) < 20  # of 2 * 103 pairs of an item and a block


def test_items_in_sets(spark, monkeypatch):
    monkeypatch.setattr(search, "ITEMS", 5)
    docs, items = corpus(3, 60)
    frame = search.search(build(spark.createDataFrame(docs, "doc_id long, text string"), 8), spark.createDataFrame(items, "item_id long, text string"))
    assert got(frame) == plain_search(docs, items)


def test_large_documents_close_a_block(spark, monkeypatch):
    docs = [(k, " ".join(f"t{k * j % 1013}" for j in range(500))) for k in range(20)]
    monkeypatch.setattr(search, "POSTINGS", 900)
    index = build(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1))
    assert index.blocks.count() > 5
    assert got(search.search(index, spark.createDataFrame([(1, "t5 t7 t12")], "item_id long, text string"))) == plain_search(docs, [(1, "t5 t7 t12")])


def test_few_blocks_are_decoded_at_once(spark):
    """A block is some 0.5 MB in memory, so what a reader holds is bounded by row groups."""
    index = build(spark.createDataFrame([(k, f"a b{k}") for k in range(50)], "doc_id long, text string").coalesce(1), 1)
    for df in (index.blocks, index.maxima):
        found = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in df.inputFiles()]
        groups = [m.row_group(k).num_rows for m in found for k in range(m.num_row_groups)]
        assert sum(groups) == df.count() == 50 and max(groups) <= search.READ


def test_nulls_repeats_and_other_columns(spark):
    docs = [(None, "a b"), (1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "a c c"), (4, "b")]
    items = [(7, "a"), (7, "a"), (8, None), (9, "..."), (None, "b"), (10, "zzz")]
    table = spark.createDataFrame([(*d, 5, "x") for d in docs], "doc_id long, text string, score int, block string")
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, rank int")
    assert got(search.search(build(table, 2), asked)) == plain_search(docs, items)


def test_empty_tables(spark):
    docs, items = (spark.createDataFrame([], f"{c} long, text string") for c in ("doc_id", "item_id"))
    some = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    asked = some.withColumnRenamed("doc_id", "item_id")
    for d, i in ((docs, asked), (some, items), (docs, items)):
        found = search.search(build(d), i)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


def test_query_against_sql(spark):
    assert same(op13_search(spark, SF), OP13_SQL, SF) > 0
