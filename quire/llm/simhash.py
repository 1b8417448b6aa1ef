"""SimHash fingerprints, linked by a self-join of their binary trie."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quire.llm.components import components
from quire.session import small, stored

BITS = 64
SEED = 42
#: Sets of more fingerprints than this are walked with small budgets first: near links join groups, whose pairs then need no walk.
LARGE = 32
#: Node pairs that wait on the stack of a task are cut into pieces of so many.
PIECE = 1 << 18
#: Trie nodes with more distinct fingerprints are dealt out as pairs of their children HOT_BITS below; those with over 2 ** HOT_BITS times as many,
#: of their children twice as far below.
HOT_NODE = 50_000
HOT_BITS = 4
#: A pair of children is kept as smaller * PAIR + larger.
PAIR = 256


def fingerprint(text: str | None, words: int = 4) -> int:
    """Unsigned SimHash of one text; no words: zero."""
    split = (text or "").encode().lower().split()
    if not split:
        return 0
    line = b" ".join(split)
    if len(split) < words:
        return xxhash.xxh64_intdigest(line, SEED)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    first = np.concatenate(([0], gaps + 1))[: len(split) - words + 1]
    last = np.append(gaps, len(line))[words - 1 :]
    count = np.zeros(BITS, np.int64)
    for at in range(0, len(first), 1 << 16):
        ends = zip(first[at : at + (1 << 16)].tolist(), last[at : at + (1 << 16)].tolist(), strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in ends], "<u8")
        count += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << int(b) for b in np.flatnonzero(2 * count > len(first)))


def fingerprints(text: Column, words: int = 4) -> Column:
    """Fingerprint of a text column as a signed bigint; null and wordless texts give 0."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words) for t in texts], dtype="uint64").astype("int64")

    return of(text)


def _blocks(budget: int) -> list[tuple[int, int]]:
    """(shift, width) of budget + 1 blocks that share the bits out."""
    cuts = [BITS * k // (budget + 1) for k in range(budget + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


class _Trie:
    """Traversal of one set of sorted, distinct fingerprints; a node is an interval of them.

    `split_pairs`, `pruned` and `met` count node pairs that were split, that went over the budget, and pairs of single fingerprints reached.
    """

    def __init__(self, keys: np.ndarray):
        self.keys, self.root = keys, np.arange(len(keys))
        self.ones: dict[int, np.ndarray] = {}
        self.split_pairs = self.pruned = self.met = 0

    def split(self, low: np.ndarray, high: np.ndarray, depth: int) -> np.ndarray:
        if depth not in self.ones:
            bit = (self.keys >> np.uint64(BITS - 1 - depth)) & np.uint64(1)
            self.ones[depth] = np.concatenate(([0], np.cumsum(bit, dtype=np.int64)))
        return high - (self.ones[depth][high] - self.ones[depth][low])

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join the sets of a[i] and b[i]; roots are the smallest members."""
        while len(a):
            x, y = self.root[a], self.root[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while (jump := self.root[self.root]).tobytes() != self.root.tobytes():
                self.root = jump

    def apart(self, x: tuple[np.ndarray, ...]) -> np.ndarray:
        """Which node pairs still have leaves of different sets below them."""
        low, high, low2, high2 = x[:4]
        turns = np.concatenate(([0], np.cumsum(self.root[1:] != self.root[:-1])))
        return (turns[high - 1] != turns[low]) | (turns[high2 - 1] != turns[low2]) | (self.root[low] != self.root[low2])

    def meet(self, x: tuple[np.ndarray, ...], budget: int) -> None:
        """Pairs of single fingerprints: their one path below is taken in one step, as nothing branches off it."""
        i, j = x[0], x[2]
        self.met += len(i)
        near = np.bitwise_count(self.keys[i] ^ self.keys[j]) <= budget
        self.link(i[near], j[near])

    def walk(self, starts: list[tuple[int, tuple[np.ndarray, ...]]], budget: int) -> None:
        """Node pairs together, depth first: children add their differing bit; a pair over the budget is pruned."""
        stack = list(starts)
        while stack:
            depth, x = stack.pop()
            if len(x[0]) > PIECE:
                stack += [(depth, tuple(c[k : k + PIECE] for c in x)) for k in range(0, len(x[0]), PIECE)]
                continue
            open_ = self.apart(x)
            x = tuple(c[open_] for c in x)
            single = (x[1] - x[0] == 1) & (x[3] - x[2] == 1)
            if single.any():
                self.meet(tuple(c[single] for c in x), budget)
            low, high, low2, high2, bits = (c[~single] for c in x)
            if not len(low):
                continue
            self.split_pairs += len(low)
            mid, mid2 = self.split(low, high, depth), self.split(low2, high2, depth)
            same = low == low2
            parts = [(low, mid, low2, mid2, bits), (mid, high, mid2, high2, bits), (low, mid, mid2, high2, bits + 1)]
            parts.append(tuple(c[~same] for c in (mid, high, low2, mid2, bits + 1)))
            y = tuple(np.concatenate(c) for c in zip(*parts, strict=True))
            there = (y[1] > y[0]) & (y[3] > y[2])
            live = there & (y[4] <= budget)
            self.pruned += int(there.sum() - live.sum())
            live &= (y[0] != y[2]) | (y[1] - y[0] > 1)  # a single fingerprint has no pair with itself
            stack.append((depth + 1, tuple(c[live] for c in y)))


def _spanning(keys: np.ndarray, node: np.ndarray, pair: np.ndarray, depth: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (root, member) that span the linked groups of each node; rows come sorted by (node, pair, key)."""
    low = np.flatnonzero(np.concatenate(([True], (node[1:] != node[:-1]) | (pair[1:] != pair[:-1]))))
    high = np.append(low[1:], len(keys))
    trie, few, many = _Trie(keys), [], []
    for d in np.unique(depth[low]).tolist():
        own = (high - low > 1) & (depth[low] == d)
        itself = own & (pair[low] // PAIR == pair[low] % PAIR)
        large = high - low > LARGE
        for into, some in ((few, itself & ~large), (many, itself & large)):
            into.append((d, (low[some], high[some], low[some], high[some], np.zeros(some.sum(), np.int64))))
        for at in np.flatnonzero(own & ~itself).tolist():  # two children of a hot node
            top = keys[low[at] : high[at]] >> np.uint64(BITS - d)
            mid = low[at] + int(np.searchsorted(top, top[0], "right"))
            if mid < high[at]:
                bits = int(pair[low[at]] // PAIR ^ pair[low[at]] % PAIR).bit_count()
                many.append((d, tuple(np.array([v]) for v in (low[at], mid, mid, high[at], bits))))
    trie.walk(few, budget)
    for step in sorted({1, 2, budget} & set(range(budget + 1))):  # near links first: they prune what follows
        trie.walk(many, step)
    member = np.flatnonzero(trie.root != np.arange(len(keys)))
    return trie.root[member], member


def links(prints: DataFrame, budget: int = 4, hot_node: int = HOT_NODE) -> DataFrame:
    """Spanning links (u, v) of distinct fingerprints `fp` (bigint) that differ in at most `budget` bits.

    The trie is laid down in budget + 1 bit orders. Two fingerprints within the budget agree on one whole
    block of bits, so in the order that begins with this block they share the node below it: only pairs of a
    node with itself need be walked from there, and each fingerprint is shuffled budget + 1 times whatever the
    size of the input. Below such a node, pairs of nodes are walked together, differing bits add up, and a pair
    over the budget is pruned; so is one whose leaves are all linked already, as the links returned have to
    span every group, not to list its pairs. A node with over `hot_node` fingerprints is dealt out as pairs of
    nodes below it, four bits or, for a larger one, eight bits further down. Null fingerprints are ignored; an empty table gives no links.
    """
    blocks = _blocks(budget)
    turned = [
        F.struct(F.lit(k).alias("k"), F.lit(w).alias("w"), (F.shiftleft("fp", s).bitwiseOR(F.shiftrightunsigned("fp", BITS - s)) if s else F.col("fp")).alias("key"))
        for k, (s, w) in enumerate(blocks)
    ]
    rows = prints.filter("fp is not null").select(F.explode(F.array(*turned)).alias("x")).select("x.*")
    rows = rows.withColumn("node", F.expr(f"k * {1 << 32}L + shiftrightunsigned(key, {BITS} - w)"))
    many = F.col("count")
    hot = rows.groupBy("node").count().filter(many > hot_node).select("node", F.when(many > (hot_node << HOT_BITS), 2 * HOT_BITS).otherwise(HOT_BITS).alias("bits"))
    hot = stored(hot, "hot")
    rows = rows.join(small(hot), "node", "left").withColumn("bits", F.coalesce("bits", F.lit(0)))
    rows = rows.withColumn("child", F.expr(f"cast(shiftrightunsigned(key, {BITS} - w - bits) % shiftleft(1, bits) as int)"))
    pairs = F.expr(f"""transform(filter(sequence(0, shiftleft(1, bits) - 1), o -> bit_count(o ^ child) <= {budget}),
                       o -> least(o, child) * {PAIR} + greatest(o, child))""")
    rows = rows.select("k", "node", "key", F.expr("w + bits").alias("depth"), F.explode(pairs).alias("pair"))
    shift = np.array([s for s, _ in blocks], np.uint64)

    def spanning(rows: pd.DataFrame) -> pd.DataFrame:
        keys = rows["key"].to_numpy().view(np.uint64)
        ends = _spanning(keys, rows["node"].to_numpy(), rows["pair"].to_numpy(), rows["depth"].to_numpy(), budget)
        back = shift[rows["k"].to_numpy()]
        own = np.where(back > 0, (keys >> back) | (keys << (np.uint64(BITS) - np.maximum(back, np.uint64(1)))), keys).view(np.int64)
        return pd.DataFrame({"u": own[ends[0]], "v": own[ends[1]]})

    def by_node(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # of the last node, which the next batch may go on with
        for batch in filter(len, batches):
            last = ((batch["node"] == batch["node"].iloc[-1]) & (batch["pair"] == batch["pair"].iloc[-1])).to_numpy()
            if not last.all():
                yield spanning(pd.concat([*held, batch[~last]]))
                held = []
            elif held and (held[-1]["node"].iloc[-1], held[-1]["pair"].iloc[-1]) != (batch["node"].iloc[-1], batch["pair"].iloc[-1]):
                yield spanning(pd.concat(held))
                held = []
            held.append(batch[last])
        if held:
            yield spanning(pd.concat(held))

    dealt = rows.repartition("node", "pair").sortWithinPartitions("node", "pair", F.expr("key ^ (-9223372036854775807L - 1L)"))
    return dealt.select("k", "node", "pair", "depth", "key").mapInPandas(by_node, "u long, v long")


def grouped(prints: DataFrame, budget: int = 4, hot_node: int = HOT_NODE, linked: DataFrame | None = None) -> DataFrame:
    """prints(doc_id, fp, ...), a stored table -> with group (bigint, one of the group's fingerprints) and component_id.

    `linked` has links (u, v) of fp to take in place of those within the budget.
    """
    leaves = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "leaves")
    roots = components(links(leaves.select("fp"), budget, hot_node) if linked is None else linked)
    member = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    member = stored(member.join(leaves, F.col("node") == F.col("fp")).select("fp", "root", "least"), "member")
    named = member.groupBy("root").agg(F.min("least").alias("component"))
    linked = stored(member.join(named, "root").select("fp", "root", "component"), "linked")
    own = leaves.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("group"), F.coalesce("component", "least").alias("component_id"))
    return prints.join(own, "fp")


def near_groups(docs: DataFrame, words: int = 4, budget: int = 4, hot_node: int = HOT_NODE) -> DataFrame:
    """Fingerprint and group of every row of `docs`, which needs doc_id and text.

    Returns doc_id, fp (signed bigint) and component_id, the smallest doc_id reachable over links of at most
    `budget` bits; one row for each input row, repeated rows included. Null and wordless texts have fingerprint
    zero and link like any other. Null doc_ids take part but name no group unless its members are all null.
    Equal texts share a fingerprint and are one leaf of the trie, however many they are.
    """
    prints = stored(docs.select("doc_id", fingerprints(F.col("text"), words).alias("fp")), "prints")
    return grouped(prints, budget, hot_node).select("doc_id", "fp", "component_id")


def deduplicated(docs: DataFrame, words: int = 4, budget: int = 4) -> DataFrame:
    """One document of each group of near_groups(), with its columns: that of the smallest doc_id.

    Among rows of that doc_id the fingerprint's and then the text's hash decide; of rows alike in doc_id and text
    one stays. A group whose doc_ids are all null keeps one row too. Documents move once, by doc_id, and
    not at all while the kept documents' table is small enough to be broadcast.
    """
    keyed = docs.withColumn("text__", F.xxhash64("text"))
    prints = stored(keyed.select("doc_id", "text__", fingerprints(F.col("text"), words).alias("fp")), "prints")
    return one_of_each(docs, prints, grouped(prints, budget))


def one_of_each(docs: DataFrame, prints: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of `docs` that deduplicated() keeps, by the groups of their prints (doc_id, text__, fp)."""
    keyed = docs.withColumn("text__", F.xxhash64("text"))
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("fp").alias("c"), F.col("text__").alias("d"))
    best = groups.groupBy("group").agg(F.min(order).alias("x")).select(F.col("x.b").alias("kept_id__"), F.col("x.d").alias("kept_text__"), F.col("x.c").alias("kept_fp__"))
    many = prints.groupBy("doc_id", "text__").count().toDF("many_id__", "many_text__", "many__")
    same = best["kept_id__"].eqNullSafe(many["many_id__"]) & best["kept_text__"].eqNullSafe(many["many_text__"])
    kept = stored(best.join(many, same).select("kept_id__", "kept_text__", "many__"), "kept")
    kept_on = keyed["doc_id"].eqNullSafe(kept["kept_id__"]) & keyed["text__"].eqNullSafe(kept["kept_text__"])
    rows = keyed.join(small(kept), kept_on)
    names = [F.col(f"`{c}`") for c in docs.columns]
    once = rows.filter("many__ = 1").select(names)
    repeated = rows.filter("many__ > 1").dropDuplicates(["doc_id", "text__"]).select(names)
    return once.unionByName(repeated)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint and component_id of every document."""
    found = near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
