import random
from collections import Counter

import pytest

from quire.llm.decontaminate import OP4_SQL, clean, op4_decontamination, overlaps
from tests.llm.oracle import same

SF = "/root/testdata/sf0.001"


def frames(spark, docs, items):
    return (
        spark.createDataFrame(docs, "doc_id long, text string, item_id string, words string"),
        spark.createDataFrame(items, "item_id long, text string, pos long"),
    )


def test_query_against_sql(spark):
    assert same(op4_decontamination(spark, "/root/testdata/sf0.01"), OP4_SQL, "/root/testdata/sf0.01") > 0


@pytest.mark.parametrize("block_windows", [500_000, 7])
def test_substitutions_and_odd_rows(spark, block_windows):
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(24)]
    swapped = [w if k not in (5, 17) else "swap" for k, w in enumerate(passage)]
    filler = lambda n: " ".join(word() for _ in range(n))
    short = [word() for _ in range(7)]
    docs = [
        (1, f"{filler(30)} {' '.join(passage).upper()}. {filler(9)}", None, None),
        (2, f"{filler(3)}\n{', '.join(swapped)}", None, None),
        (2, f"{filler(3)}\n{', '.join(swapped)}", None, None),
        (3, filler(200), "7", "x"),
        (4, " ".join(passage[:6]), None, None),
        (5, f"{filler(5)} {' '.join(short[:3])} other {' '.join(short[4:])} {filler(5)}", None, None),
        (6, " ".join(rnd.sample(passage, 24)), None, None),
        (7, None, None, None),
        (8, "", None, None),
        (None, " ".join(passage), None, None),
        (9, f"{filler(150_000)} {' '.join(passage)}", None, None),
        (11, f"{filler(9)} {' '.join(passage[5:18])} {filler(9)}", None, None),  # 13 tokens in a row
        (12, f"{filler(9)} {' '.join(passage[5:17])} {filler(9)}", None, None),  # 12
        (13, f"{filler(9)} zig zag {filler(9)}", None, None),
    ]
    items = [(10, " ".join(passage), 1), (10, " ".join(passage), 1), (11, " ".join(short), 2), (12, "zig zag", 3), (13, None, None), (14, "?!", None), (None, filler(20), 1)]
    d, i = frames(spark, docs, items)
    rows = overlaps(d, i, ["doc_id"], block_windows=block_windows).collect()
    got = {(r.doc_id, r.item_id): r.matched for r in rows}
    assert got == {(1, 10): 24, (2, 10): 22, (5, 11): 6, (None, 10): 24, (9, 10): 24, (11, 10): 13, (13, 12): 2}
    hits = {(r.doc_id, r.item_id): r.hits for r in rows}
    assert hits[1, 10] == hits[9, 10] and hits[2, 10] % 2 == 0
    left = clean(d, i)
    assert left.columns == d.columns and sorted(r.doc_id for r in left.collect()) == [3, 4, 6, 7, 8, 12]
    assert {r.doc_id for r in overlaps(d, i, ["doc_id"], block_windows=block_windows, shortest=3).collect()} == {1, 2, 5, 9, 11, None}


@pytest.mark.parametrize("block_windows", [500_000, 1_000])
def test_long_item(spark, block_windows):
    """100,000 tokens in one item, of which a document holds 400 in the middle and another all."""
    rnd = random.Random(8)
    words = [f"w{rnd.randrange(50_000)}" for _ in range(100_000)]
    d, i = frames(spark, [(1, " ".join(words[50_000:50_400]), None, None), (2, " ".join(words), None, None), (3, "other words stand here", None, None)], [(1, " ".join(words), 1)])
    got = {r.doc_id: r.matched for r in overlaps(d, i, ["doc_id"], block_windows=block_windows).collect()}
    assert got.keys() == {1, 2} and got[1] >= 400 and got[2] == 100_000


def exhaustive(words, item):
    """Whether any diagonal of the item has a share of 0.8 of all its tokens."""
    at = {}
    for k, w in enumerate(words):
        at.setdefault(w, []).append(k)
    same = Counter(k - j for j, w in enumerate(item) for k in at.get(w, ()))
    return max(same.values(), default=0) >= 0.8 * len(item)


def test_recall_against_all_diagonals(spark):
    """Items of 5 to 60 tokens with 5, 10 and 20 % of them swapped, inside other text, against a scan of every diagonal."""
    rnd = random.Random(5)
    word = lambda: f"w{rnd.randrange(3_000)}"
    items = [[word() for _ in range(n)] for n in (5, 6, 8, 9, 10, 11, 12, 15, 18, 20, 25, 30, 45, 60) for _ in range(8)]
    docs, truth = [], set()
    for k, item in enumerate(items):
        for rate in (0.0, 0.05, 0.1, 0.2):
            new = list(item)
            for j in rnd.sample(range(len(item)), int(rate * len(item))):
                new[j] = "swapped"
            docs.append([word() for _ in range(30)] + new + [word() for _ in range(30)])
            assert exhaustive(docs[-1], item)
            truth.add((len(docs) - 1, k))
    d, i = frames(spark, [(k, " ".join(t), None, None) for k, t in enumerate(docs)], [(k, " ".join(t), None) for k, t in enumerate(items)])
    found = {(r.doc_id, r.item_id) for r in overlaps(d, i, ["doc_id"]).collect()}
    assert len(found & truth) >= 0.99 * len(truth) and len(found - truth) <= 0.01 * len(truth)


def test_empty_tables(spark):
    d, i = frames(spark, [(1, "a b c d e f g h i j k", None, None)], [(1, "a b c d e f g h i j k", 1)])
    assert overlaps(d, i, ["doc_id"]).count() == 1
    assert overlaps(d.limit(0), i, ["doc_id"]).count() == 0
    assert overlaps(d, i.limit(0), ["doc_id"]).count() == 0
    assert clean(d, i.limit(0)).count() == 1
