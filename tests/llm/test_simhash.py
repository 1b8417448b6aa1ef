import random
import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from quire.llm.components import components
from quire.llm.simhash import BITS, _Trie, deduplicated, fingerprint, links, near_groups, op9_simhash

SF = "/root/testdata/sf0.001"


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(prints, budget=4):
    prints = sorted(set(prints))
    root = {p: p for p in prints}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= budget:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {p: top(p) for p in prints}


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "a b c", "A B C D", "ÄB ä x\x1c y z\x0b w", "w " * 70_000])
def test_fingerprint(text):
    assert fingerprint(text) == plain_print(text)


def test_components_of_a_long_chain(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 101), (100, 101)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("hot_node", [1_000_000, 50, 1])
def test_links_against_all_pairs(spark, hot_node):
    rnd = random.Random(3)
    seeds = [rnd.getrandbits(64) for _ in range(40)]
    prints = [0, 2**64 - 1, *(rnd.getrandbits(64) for _ in range(300))]
    for s in seeds:
        for _ in range(20):
            for b in rnd.sample(range(64), rnd.randint(0, 6)):
                s ^= 1 << b
            prints.append(s)
    centre = rnd.getrandbits(64)
    for _ in range(300):  # a ball around one fingerprint: a hot node in every order
        s = centre
        for b in rnd.sample(range(64), rnd.randint(0, 5)):
            s ^= 1 << b
        prints.append(s)
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in set(prints)]
    found = components(links(spark.createDataFrame(signed, "fp long"), hot_node=hot_node)).collect()
    group = {r.node: r.root for r in found}
    mine, plain = {}, {}
    for p, r in plain_roots(prints).items():
        s = p - 2**64 if p >= 2**63 else p
        mine.setdefault(group.get(s, s), set()).add(p)
        plain.setdefault(r, set()).add(p)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, plain.values()))


def walked(keys, shift=0, width=0, budget=4):
    """Roots of all keys by walks from the nodes below the first `width` bits of an order; and the walks' trie."""
    turned = sorted({(k << shift | k >> (BITS - shift)) & (2**64 - 1) for k in keys} if shift else set(keys))
    trie = _Trie(np.array(turned, np.uint64))
    node = trie.keys >> np.uint64(BITS - width) if width else np.zeros(len(turned), np.uint64)
    low = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
    high = np.append(low[1:], len(turned))
    low, high = low[high - low > 1], high[high - low > 1]
    trie.walk([(width, (low, high, low, high, np.zeros(len(low), np.int64)))], budget)
    return trie


def test_walk_from_the_root_splits_and_prunes():
    docs = pd.read_parquet("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"]
    prints = {plain_print(t) for t in docs}
    trie = walked(prints)
    plain = plain_roots(prints)
    keys = trie.keys.tolist()
    assert {k: keys[r] for k, r in zip(keys, trie.root.tolist(), strict=True)} == plain
    assert trie.split_pairs > 1_000 and trie.pruned > 1_000 and trie.met < len(keys) * (len(keys) - 1) / 8
    pairs = sum(1 for a in keys for b in keys if a < b and (a ^ b).bit_count() <= 4)
    below = [walked(prints, s, w) for s, w in ((0, 12), (12, 13), (25, 13), (38, 13), (51, 13))]
    assert pairs and all(t.split_pairs > 0 for t in below) and sum(t.met for t in below) < len(keys) * 5
    dense = walked({*range(4096)}, width=0, budget=2)  # every fingerprint has neighbours: the budget prunes, links spare walks
    assert dense.pruned > 0 and len(set(dense.root.tolist())) == 1


def test_near_groups_odd_rows(spark):
    rows = [(5, "a b c d e", "x"), (5, "a b c d e", "x"), (3, "A b c d e", None), (None, "a b c d e", None), (7, None, "y"), (9, " ", "y"), (None, "zz", "y")]
    got = sorted((str(r.doc_id), r.fp != 0, str(r.component_id)) for r in near_groups(spark.createDataFrame(rows, "doc_id long, text string, fp string")).collect())
    assert got == [("3", True, "3"), ("5", True, "3"), ("5", True, "3"), ("7", False, "7"), ("9", False, "7"), ("None", True, "3"), ("None", True, "None")]
    assert near_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_one_document_of_each_group_stays(spark):
    rows = [(5, "a b c d e", "x", 1), (5, "a b c d e", "z", 2), (3, "A b c d e", None, 3), (3, "A b c d e", None, 3), (None, "a b c d e", None, 4), (7, None, "y", 5), (9, " ", "y", 6), (None, "zz", "y", 7), (None, "zz", "y", 7), (8, "other words stand in this text", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, many long")
    out = deduplicated(docs)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(3, "A b c d e", None, 3), (7, None, "y", 5), (None, "zz", "y", 7), rows[-1]], key=repr)
    assert deduplicated(docs.limit(0)).count() == 0


def test_query_against_all_pairs(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = {d: plain_print(t) for d, t in docs.items()}
    root = plain_roots(prints.values())
    least = {}
    for d in sorted(docs):
        least.setdefault(root[prints[d]], d)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op9_simhash(spark, SF).collect()}
    assert got == {d: (f"{prints[d]:016x}", least[root[prints[d]]]) for d in docs}
