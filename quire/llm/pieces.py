"""SentencePiece encoding and decoding: the last token of every prefix, found by automaton matches and tests of token pairs."""

from __future__ import annotations

import codecs
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from sentencepiece import SentencePieceProcessor

from quire.session import bounded_batches

#: The mark that stands for a space in pieces; fixed by the library.
SPACE = "▁"
#: Words that a worker remembers before it forgets all but those at hand, and token pairs (a power of two for the table, the rest for long words).
WORDS, TABLE, PAIRS = 500_000, 1 << 20, 100_000
#: Longer words are read one by one, others position by position together; characters of texts that are taken together.
LONG, GROUP = 64, 1 << 21
#: Codes of what is before the first token, and of a character that no piece holds.
START, STRANGE = -1, -2
_NEVER = float("-inf")

codecs.register_error("quire-each-byte", lambda e: ("�", e.start + 1))


class _Bounded(dict):
    """Values of `make` by key, made once; forgets all before it would hold more than `most`."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value


class PieceModel:
    """A merge-type (BPE) SentencePiece model with byte fallback, whose normaliser leaves characters as they are.

    Encoding merges the neighbours whose joined piece has the best score, the leftmost of equals, until none joins. Merges inside
    a run of tokens do not depend on what is beside it, so a row of tokens is an encoding exactly if each two neighbours are the
    encoding of their own text, and each prefix of a text has one last token: the one match ending there that is compatible with the
    last token of the prefix before it. Other models raise an error.
    """

    def __init__(self, path: str):
        own = SentencePieceProcessor(model_file=path)
        kinds = range(own.get_piece_size())
        plain = [i for i in kinds if not (own.is_control(i) or own.is_unknown(i) or own.is_byte(i))]
        probe = "ﬁ  Å Å"
        if own.normalize(probe) != SPACE + probe.replace(" ", SPACE) or any(map(own.is_unused, kinds)) or sum(map(own.is_byte, kinds)) != 256:
            raise ValueError(f"{path}: only models with byte fallback, a dummy prefix and no rules of normalisation")
        self.end, self.pieces = own.eos_id(), own.get_piece_size()
        self.byte = {int(own.id_to_piece(i)[3:5], 16): i for i in kinds if own.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.piece = {i: own.id_to_piece(i) for i in plain}
        self.score = {p: own.get_score(i) for i, p in self.piece.items()}
        code = {p: i for i, p in self.piece.items()}
        # characters that are no pieces themselves may still join into one
        for c in sorted(set("".join(code)) - code.keys()):
            code[c] = self.pieces + len(code)
        self.text = {i: p for p, i in code.items()}
        self.shown = {i: "" for i in kinds} | {own.unk_id(): " ⁇ "} | {i: p.replace(SPACE, " ") for i, p in self.piece.items()}
        self.size_of = np.ones(max(code.values()) + 1, np.int64)
        self.size_of[[*self.text]] = [*map(len, self.text.values())]
        self._automaton(code)
        # no piece goes on behind a space mark, so a text may be cut before each one that follows another character
        self.cut = re.compile(f"{SPACE}+[^{SPACE}]*") if not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in code) else re.compile(r"(?s).+")
        self.merges = _Bounded(self._merges, 1 << 30)
        self.fits = _Bounded(self._fits, PAIRS)
        self.seen, self.fit = np.full(TABLE, -1, np.int64), np.zeros(TABLE, bool)
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.first, self.count = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _automaton(self, code: dict[str, int]) -> None:
        """A trie of the pieces read backwards: from any place of a text it finds all pieces that end there."""
        letters = sorted(set("".join(code)))
        self.letter = np.zeros(0x110000, np.int64)  # 0: in no piece
        self.letter[[*map(ord, letters)]] = np.arange(1, len(letters) + 1)
        self.apart = next(c for c in map(chr, range(1 << 16)) if not self.letter[ord(c)])
        self.letters, edges, ends = len(letters) + 1, {}, [-1]
        for p, i in code.items():
            node = 0
            for c in self.letter[[*map(ord, reversed(p))]].tolist():
                node = edges.setdefault(node * self.letters + c, len(ends))
                if node == len(ends):
                    ends.append(-1)
            ends[node] = i
        keys = sorted(edges)
        self.edges, self.nodes, self.ends = np.array(keys), np.array([edges[k] for k in keys]), np.array(ends)

    def _matches(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of the last character, token and length of all matches in a text whose first character is in no piece."""
        letters = self.letter[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        at = np.flatnonzero(letters)
        node, found, size = np.zeros(len(at), np.int64), [], 0
        while len(at):
            key = node * self.letters + letters[at - size]
            edge = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            there = self.edges[edge] == key
            at, node, size = at[there], self.nodes[edge[there]], size + 1
            token = self.ends[node]
            own = token >= 0
            found.append((at[own], token[own], np.full(own.sum(), size)))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 3

    def _merges(self, token: int) -> tuple[list[float], list[str], list[str]] | None:
        """Scores of a token's merges in their order, and its first and last symbol before and after each; None if it is not its own encoding."""
        parts = list(self.text[token])
        scores, firsts, lasts = [], [parts[0]], [parts[-1]]
        while len(parts) > 1:
            joined = [self.score.get(a + b, _NEVER) for a, b in zip(parts, parts[1:], strict=False)]
            best = max(joined)
            if best == _NEVER:
                return None
            k = joined.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            scores.append(best)
            firsts.append(parts[0])
            lasts.append(parts[-1])
        return scores, firsts, lasts

    def _fits(self, pair: tuple[int, int]) -> bool:
        """Whether two tokens beside each other are the encoding of their joined text: no merge across their border comes first."""
        left, right = pair
        if right != STRANGE and self.merges[right] is None:
            return False
        if left < 0 or right < 0:
            return True
        (a, _, last), (b, first, _) = self.merges[left], self.merges[right]
        i = j = 0
        while True:
            own, other, across = a[i] if i < len(a) else _NEVER, b[j] if j < len(b) else _NEVER, self.score.get(last[i] + first[j], _NEVER)
            if own == other == across == _NEVER:
                return True
            if own >= other and own >= across:
                i += 1
            elif across >= other:
                return False
            else:
                j += 1

    def _last(self, word: str) -> list[int]:
        """The last token of each prefix of a word; that of the empty one is START."""
        last = [START] + [STRANGE] * len(word)
        at, token, size = self._matches(self.apart + word)
        order = np.argsort(at, kind="stable")
        for end, t, n in zip(at[order].tolist(), token[order].tolist(), size[order].tolist(), strict=True):
            if last[end] == STRANGE and self.fits[last[end - n], t]:
                last[end] = t
        return last

    def _bytes(self, token: int, text: str) -> list[int]:
        """Ids of a token that was found for a text: those of its bytes, if it is no piece."""
        return [token] if token in self.piece else [self.byte[b] for b in text.encode()]

    def _ids(self, word: str) -> list[int]:
        """Ids of a word, from its end backwards by the last token of each prefix."""
        last, at, ids = self._last(word), len(word), []
        while at:
            size = int(self.size_of[last[at]]) if last[at] >= 0 else 1
            ids.append(self._bytes(last[at], word[at - size : at]))
            at -= size
        return [*chain.from_iterable(reversed(ids))]

    def _fit_all(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """fits[before, token] of arrays, by a table in which a pair has one place."""
        key = ((before + 2) << 32) + token
        place = (key * 0x9E3779B1 ^ key >> 29) & (TABLE - 1)
        for k in np.unique(key[self.seen[place] != key]).tolist():
            at = (k * 0x9E3779B1 ^ k >> 29) & (TABLE - 1)
            self.seen[at], self.fit[at] = k, self._fits(((k >> 32) - 2, k & 0xFFFFFFFF))
        good = self.fit[place]
        for i in np.flatnonzero(self.seen[place] != key).tolist():  # two new pairs had one place
            good[i] = self.fits[int(before[i]), int(token[i])]
        return good

    def _all_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many words, end to end, and their numbers: the prefix tables of all words are filled together, place by place, and read backwards."""
        sizes = np.array([*map(len, words)])
        starts = np.cumsum(sizes + 1) - sizes - 1
        joined = self.apart + self.apart.join(words)
        slot, token, size = self._matches(joined)  # each word has a slot before it, for its empty prefix
        place = slot - np.repeat(starts, sizes + 1)[slot]
        order = np.argsort(place, kind="stable")
        ends = np.searchsorted(place[order], np.arange(1, sizes.max() + 2))
        last = np.full(len(joined), STRANGE, np.int64)
        last[starts] = START
        for low, high in zip(ends, ends[1:], strict=False):
            own = order[low:high]
            own = own[self._fit_all(last[slot[own] - size[own]], token[own])]
            last[slot[own]] = token[own]
        steps, at, open_ = [], starts + sizes, np.arange(len(words))
        while len(open_):
            made = last[at]
            steps.append((open_, made, at))
            at = at - np.where(made < 0, 1, self.size_of[made])
            more = at > starts[open_]
            open_, at = open_[more], at[more]
        count = np.bincount(np.concatenate([w for w, _, _ in steps]), minlength=len(words))
        first = np.cumsum(count) - count
        flat, where = np.empty(count.sum(), np.int64), np.empty(count.sum(), np.int64)
        for k, (own, made, at) in enumerate(steps):
            flat[first[own] + count[own] - 1 - k], where[first[own] + count[own] - 1 - k] = made, at
        odd = np.flatnonzero((flat < 0) | (flat >= self.pieces))
        if not len(odd):
            return flat.astype(np.int32), count
        parts = [self._bytes(-1, joined[i]) for i in where[odd].tolist()]  # a character that is no piece becomes its bytes
        many = np.ones(len(flat), np.int64)
        many[odd] = [*map(len, parts)]
        out, ends = np.repeat(flat, many), np.cumsum(many)
        out[np.repeat(ends[odd] - many[odd], many[odd]) + np.concatenate([np.arange(len(x)) for x in parts])] = [*chain.from_iterable(parts)]
        return out.astype(np.int32), np.diff(np.append(0, ends[np.cumsum(count) - 1]))

    def learn(self, words: list[str]) -> None:
        """Adds words, each without the space mark before it, to the ones that are known."""
        for long in (False, True):
            if not (own := [w for w in words if (len(w) >= LONG) == long]):
                continue
            if long:
                ids = [np.array(self._ids(SPACE + w), np.int32) for w in own]
                flat, count = np.concatenate(ids), np.array([*map(len, ids)])
            else:
                flat, count = self._all_ids([SPACE + w for w in own])
            self.index.update(zip(own, range(len(self.index), len(self.index) + len(own)), strict=True))
            self.first = np.append(self.first, len(self.flat) + np.cumsum(count) - count)
            self.flat, self.count = np.append(self.flat, flat), np.append(self.count, count)

    def words(self, text: str) -> list[str]:
        """A text cut into words, each without the space mark before it."""
        if self.cut.pattern[0] == SPACE and "  " not in text and SPACE not in text and text[0] != " ":
            return text.split(" ")
        return [w[1:] for w in self.cut.findall(SPACE + text.replace(" ", SPACE))]

    def encode_all(self, texts: list[str | None], end: bool = True) -> list[np.ndarray]:
        """Ids of texts as the library gives them; null is empty."""
        cut = [self.words(t) if t else [] for t in texts]
        wanted = set(chain.from_iterable(cut))
        new = [w for w in wanted if w not in self.index]
        if len(self.index) + len(new) > WORDS:
            self.forget()
            new = [*wanted]
        if new:
            self.learn(new)
        last, out = np.array([self.end] if end else [], np.int32), []
        for words in cut:
            own = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
            count = self.count[own]
            at = np.repeat(self.first[own] - np.cumsum(count) + count, count) + np.arange(count.sum())
            out.append(np.append(self.flat[at], last))
        return out

    def encode(self, text: str | None, end: bool = True) -> np.ndarray:
        return self.encode_all([text], end)[0]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces joined, runs of bytes read as UTF-8, without the space that encoding puts in front."""
        if self.byte_of.keys().isdisjoint(ids):
            text = "".join(map(self.shown.__getitem__, ids))
        else:
            parts = ((k, [*run]) for k, run in groupby(ids, self.byte_of.__contains__))
            text = "".join(bytes(map(self.byte_of.__getitem__, run)).decode(errors="quire-each-byte") if k else "".join(map(self.shown.__getitem__, run)) for k, run in parts)
        first = next((self.piece.get(i, "") for i in ids if self.shown[i] or i in self.byte_of), "")
        return text[1:] if first.startswith(SPACE) else text


@lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    """The model of a file, loaded once in each worker."""
    return PieceModel(path)


def _with(rows: DataFrame, new: dict[str, str], made: Callable[[pa.RecordBatch], list[pa.Array]]) -> DataFrame:
    """`rows` with new columns (name: type), made of Arrow batches; columns of these names are replaced."""
    own = [c for c in rows.columns if c not in new]
    kinds = [*rows.select([F.col(f"`{c}`") for c in own]).dtypes, *new.items()]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *made(batch)], [*own, *new])

    bounded_batches(rows.sparkSession)
    return rows.mapInArrow(add, ", ".join(f"`{c}` {t}" for c, t in kinds))


def grouped(texts: list[str | None], size: int) -> Iterator[list[str | None]]:
    """Runs of texts of about `size` characters."""
    held, chars = [], 0
    for t in texts:
        held.append(t)
        chars += len(t or "")
        if chars >= size:
            yield held
            held, chars = [], 0
    if held:
        yield held


def encoded(docs: DataFrame, path: str, end: bool = True, back: bool = False) -> DataFrame:
    """`docs` with `ids` (array<int>), the ids of the column `text` by the model of `path`, with its end id if asked for.

    Whole texts of any length, in batches of bounded bytes, without a shuffle; words are encoded once for each worker, which
    remembers a bounded number. With `back`, the text decoded from those ids is added as `decoded`. Null text is empty. Other
    columns, null or repeated ids stay; columns of the new names are replaced.
    """

    def made(batch: pa.RecordBatch) -> list[pa.Array]:
        own = model(path)
        found = [ids for group in grouped(batch.column("text").to_pylist(), GROUP) for ids in own.encode_all(group, end)]
        ends = np.cumsum([0, *map(len, found)])
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*found, np.empty(0, np.int32)]), pa.int32()))
        return [ids, pa.array([own.decode(x.tolist()) for x in found], pa.string())] if back else [ids]

    return _with(docs, {"ids": "array<int>"} | ({"decoded": "string"} if back else {}), made)


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """`rows` with `decoded`, the text of the column `ids`; null ids give the empty text. A column `decoded` is replaced."""
    return _with(rows, {"decoded": "string"}, lambda batch: [pa.array([model(path).decode(ids or []) for ids in batch.column("ids").to_pylist()], pa.string())])


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the text decoded from them, of every document."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = encoded(docs, path, back=True)
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest(ids).alias("ids_sha256"), digest(F.col("decoded")).alias("decoded_sha256"))
