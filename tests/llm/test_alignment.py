import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from quire.llm import alignment
from quire.llm.alignment import PAIR, aligned, op12_alignment, pair_counts, scored
from quire.session import stored

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "\n", "x <|endoftext|> y </s><s>", "a▁b", "  two", "a \n b", "q 's don't", "tab\tnul\x00\x1c\x85 x", "é 🙃🙃 漢字かな Яд ٣​ 　z", "word " * 5_000, "longword" * 3_000]


@pytest.fixture(scope="module")
def pair():
    return alignment._Pair(A, B)


@pytest.fixture(scope="module")
def plain():
    """n_a, n_b, groups, links of a text, token by token."""
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(c): c for c in shown} | {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in shown)}

    def of(text):
        if not text:
            return 0, 0, [], []
        ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)]
        shapes = [[bytes(table[c] for c in a.id_to_token(i)) for i in ids[0]], [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]]]
        if any(b"".join(s) != (" " + text).encode() for s in shapes):
            return 0, 0, [], []
        ends = []
        for s in shapes:
            total, own = 0, {}
            for k, x in enumerate(s):
                total += len(x)
                own[total] = k
            ends.append(own)
        groups, links, i, j = [], [], 0, 0
        for end in sorted(ends[0].keys() & ends[1].keys()):
            n, m = ends[0][end] + 1, ends[1][end] + 1
            groups.append((ids[0][i:n], ids[1][j:m]))
            links.append((ids[0][n - 1], ids[1][m - 1]))
            i, j = n, m
        return len(ids[0]), len(ids[1]), groups, links

    return of


def written(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def check(got, want):
    assert (got[0], got[1], got[2]) == (want[0], want[1], written(want[2]))
    assert dict(zip(map(int, got[3]), map(int, got[4]), strict=True)) == dict(Counter(a * PAIR + b for a, b in want[3]))


def test_odd_texts(pair, plain):
    for text, got in zip(ODD, pair.align(ODD), strict=True):
        check(got, plain(text))


def test_random_texts(pair, plain):
    rnd = random.Random(7)
    letters = "ab c  's <|endoftext|></s>\n\t\x00\x1c\x85\xa0　 é€🙃漢字Яд٣​▁ 012.,!!  the ing"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(3_000)]
    for text, got in zip(texts, pair.align(texts), strict=True):
        check(got, plain(text))


def test_segments_may_be_forgotten(plain, monkeypatch):
    monkeypatch.setattr(alignment, "SEGMENTS", 3)
    own, texts = alignment._Pair(A, B), ["one two three four five", "five six", "two two"]
    for _ in range(2):
        for text in texts:
            check(next(own.align([text])), plain(text))


@pytest.mark.parametrize("hot", [0, 1, 2, 100])
def test_counts_by_broadcast_and_by_shuffle(spark, hot):
    rows = [(0, [1 * PAIR + 5, 2 * PAIR + 5], [3, 1]), (1, [2 * PAIR + 5, 3 * PAIR + 6], [2, 4]), (2, [], []), (3, [4 * PAIR + 6], [4])]
    rows = stored(spark.createDataFrame(rows, "row long, pairs array<long>, times array<int>"))
    counts = {(r.pair // PAIR, r.pair % PAIR): (r.n, r.best) for r in pair_counts(rows).collect()}
    assert counts == {(1, 5): (3, True), (2, 5): (3, True), (3, 6): (4, True), (4, 6): (4, True)}
    got = {r.row: tuple(r)[1:] for r in scored(rows, hot).collect()}
    assert got == {0: (4, 4, 3 * 3 + 3), 1: (6, 6, 2 * 3 + 4 * 4), 3: (4, 4, 16)}


def test_rows_with_nulls_repeats_and_other_columns(spark, plain):
    rows = spark.createDataFrame([(1, None, "g"), (None, "b c", "g"), (1, "b c", "g"), (1, "b c", "g")], "doc_id long, text string, groups string")
    got = aligned(rows, A, B).collect()
    assert [r.doc_id for r in got] == [1, None, 1, 1]
    for r in got:
        check(tuple(r)[1:], plain(None if not r.n_a else "b c"))
    assert aligned(rows.limit(0), A, B).count() == 0
    none = stored(aligned(rows.limit(0), A, B).selectExpr("doc_id as row", "pairs", "times"))
    assert scored(none).count() == 0


def test_query_against_plain(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    found = {d.doc_id: plain(d.text) for d in docs}
    counts = Counter(x for f in found.values() for x in f[3])
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(n, highest.get(b, 0))
    got = {r.doc_id: r for r in op12_alignment(spark, SF).collect()}
    assert got.keys() == found.keys() and len(got) == len(docs)
    for k, (n_a, n_b, groups, links) in found.items():
        want = (k, n_a, n_b, len(groups), len(links), sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links))
        assert tuple(got[k])[:7] == want
        assert got[k].groups_sha256 == (hashlib.sha256(written(groups).encode()).hexdigest() if groups else "")
