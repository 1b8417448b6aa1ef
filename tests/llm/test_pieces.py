import hashlib
import random
import re

import public_tokenizers
import pytest
import sentencepiece

from quire.llm import pieces
from quire.llm.pieces import PieceModel, decoded, encoded, op11_pieces

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "   ", "a", "</s> <s> <unk> <0x41>", "▁x ▁▁", "\n\n\t \x00 \x1c", "é 🙃🙃 漢字かな한글 Яд ٣", "don't  STOP   the 1234567", "ab" * 40_000, "﻿​ 　\xa0x"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    return PieceModel(PATH)


def test_ids_and_texts_of_odd_texts(own, library):
    for text in ODD:
        want = library.encode(text, add_eos=True)
        assert own.encode(text).tolist() == want
        assert own.decode(want) == library.decode(want)
    assert own.encode(None).tolist() == [2] and own.encode("x", end=False).tolist() == library.encode("x")


def test_random_texts_of_pieces_and_characters(own, library):
    rnd = random.Random(5)
    shown, letters = [*own.piece.values()], "abtheing  \n.,0€🙃漢é ▁<s>"
    texts = []
    for _ in range(4_000):
        text = "".join(rnd.choice(shown) if rnd.random() < 0.5 else rnd.choice(letters) for _ in range(rnd.randint(1, 12)))
        texts.append(text)
    for text, ids in zip(texts, own.encode_all(texts), strict=True):
        assert ids.tolist() == library.encode(text, add_eos=True), text


def test_random_ids_decode_as_in_the_library(own, library):
    rnd = random.Random(6)
    for _ in range(2_000):
        ids = [rnd.choice([rnd.randrange(32_000), rnd.randrange(259)]) for _ in range(rnd.randint(0, 8))]
        assert own.decode(ids) == library.decode(ids), ids


def test_each_prefix_has_the_last_token_of_its_own_encoding(own, library):
    for word in ("▁internationalisation", "▁▁▁unbelievable", "▁xyzzy"):
        last = own._last(word)
        assert last[2:] == [library.encode(word[1:n].replace("▁", " "))[-1] for n in range(2, len(word) + 1)]


def test_words_do_not_depend_on_the_cut(own):
    whole = PieceModel(PATH)
    whole.cut = re.compile(r"(?s).+")
    for text in (*ODD[:9], "The quick  brown fox, jumps over 12 dogs.\n  Twice "):
        assert whole.encode(text).tolist() == own.encode(text).tolist()


def test_words_together_and_one_by_one(own, library):
    rnd = random.Random(3)
    texts = [" ".join("".join(rnd.choice("theingaou🙃漢x0.") for _ in range(rnd.choice([1, 3, 9, 20, 63, 64, 90]))) for _ in range(30)) for _ in range(40)]
    got = PieceModel(PATH).encode_all([*texts, None, ""])
    assert [x.tolist() for x in got] == [*library.encode(texts, add_eos=True), [2], [2]]
    assert all(own._ids("▁" + w) == library.encode(w) for t in texts[:5] for w in t.split(" "))


def test_memory_of_words_and_pairs_may_be_forgotten(library, monkeypatch):
    monkeypatch.setattr(pieces, "WORDS", 4)
    monkeypatch.setattr(pieces, "TABLE", 2)
    small = PieceModel(PATH)
    small.fits.most = 3
    for text in ("one two three four five six seven one two three", "two nine", "one two"):
        assert small.encode(text).tolist() == library.encode(text, add_eos=True)


def test_rows_with_nulls_repeats_and_clashing_columns(spark, library):
    rows = spark.createDataFrame([(1, None, "x", [7]), (None, "b c", "y", None), (1, "b c", "z", []), (1, "b c", "z", [])], "doc_id long, text string, decoded string, ids array<int>")
    got = decoded(encoded(rows, PATH), PATH).collect()
    assert [r.doc_id for r in got] == [1, None, 1, 1]
    assert [r.ids for r in got] == [[2], *[library.encode("b c", add_eos=True)] * 3]
    assert [r.decoded for r in got] == ["", "b c", "b c", "b c"]
    assert decoded(encoded(rows.limit(0), PATH), PATH).count() == 0


def test_query_against_the_library(spark, library):
    got = {r.doc_id: r for r in op11_pieces(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for d in docs:
        ids = library.encode(d.text or "", add_eos=True)
        want = (d.doc_id, len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids)))
        assert tuple(got[d.doc_id]) == want
