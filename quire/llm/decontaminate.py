"""Benchmark decontamination by spaced seeds: hashes of chosen token positions, then a check of the overlap."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quire.session import small, stored

#: Masks over consecutive tokens: 1 counts, 0 is ignored. The short ones serve items too short for the long; with them, any
#: five tokens of which one is another have a hit. Still shorter items count as they are.
MASKS = ("110111", "1101011", "1110011")
SHORT_MASKS = ("1111", "11101", "11011", "10111")
TINY_MASKS = ("1", "11", "111", "1111")
#: Items from which on a set of masks serves, and the sets.
CLASSES = ((10, MASKS), (5, SHORT_MASKS), (1, TINY_MASKS))
#: Tokens of an item around a hit that are compared, the share of them that must agree, and the tokens in a row that do without.
STRETCH, IDENTITY, RUN = 18, 0.8, 13
#: Items of at most so many tokens also match by that share of the whole.
WHOLE = 64
#: Texts are cut into pieces of so many tokens, each with so many of its neighbours on either side: no row holds a long text, and all
#: that a hit is compared with is in its piece.
CORE, MARGIN = 512, 64
#: Seeds of benchmark windows that are broadcast, at four numbers each; more are joined by a shuffle.
BLOCK_WINDOWS = 500_000


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits; null: none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def _masks(n: Column) -> Column:
    """Numbers of the masks for an item of n tokens."""
    out = F.array().cast("array<int>")
    for least, masks in reversed(CLASSES):
        one = F.filter(F.array(*[F.lit(_ALL.index(m)) for m in masks]), lambda k: F.get(F.array(*[F.lit(len(m)) for m in _ALL]), k) == n) if masks is TINY_MASKS else F.array(*[F.lit(_ALL.index(m)) for m in masks])
        out = F.when(n >= least, one).otherwise(out)
    return out


#: Every mask once; its place is its number.
_ALL = tuple(dict.fromkeys(m for _, masks in CLASSES for m in masks))


def _seed(number: int, words: Column, pos: Column) -> Column:
    """Hash of the counting positions of one mask at pos; null where the window passes the end."""
    mask = _ALL[number]
    return F.when(pos + len(mask) <= F.size(words), F.xxhash64(F.lit(mask), *[F.get(words, pos + i) for i, c in enumerate(mask) if c == "1"]))


def _pieces(rows: DataFrame, kept: list[str]) -> DataFrame:
    """(*kept, words) -> *kept, piece, base (place of the piece's first token in the text), words, own (places in the piece that are its own).

    explode_outer, as a filter on the array's size would be inferred from explode and tokenise twice.
    """

    def piece(k: Column) -> Column:
        base = F.greatest(F.lit(0), k * CORE - MARGIN)
        first = k * CORE - base
        words = F.slice("words", base + 1, first + CORE + MARGIN)
        own = F.sequence(first, first + F.least(F.lit(CORE), F.size("words") - k * CORE) - 1)
        return F.struct(k.alias("piece"), base.alias("base"), words.alias("words"), own.alias("own"))

    numbers = F.when(F.size("words") > 0, F.sequence(F.lit(0), F.floor((F.size("words") - 1) / CORE).cast("int")))
    return rows.select(*kept, F.explode_outer(F.transform(numbers, piece)).alias("p")).select(*kept, "p.*")


def _windows(pieces: DataFrame, numbers: list[int], kept: list[str]) -> DataFrame:
    """A row (*kept, pos, seed) for each window and mask that begins at an own place of a piece; pos is the place in the piece."""
    at = pieces.select("*", F.explode_outer("own").alias("pos"))
    seeds = F.array(*[_seed(k, F.col("words"), F.col("pos")) for k in numbers])
    return at.select(*kept, "pos", F.explode(seeds).alias("seed")).filter("seed is not null")


def _bench(pieces: DataFrame) -> DataFrame:
    """Pieces of items, with n -> (seed, item, item_piece, item_pos) by the masks of the item's size; item_pos is the place in the item."""
    at = pieces.select("item", "piece", "base", "words", _masks(F.col("n")).alias("masks"), F.explode("own").alias("pos"))
    seeds = [F.when(F.array_contains("masks", k), _seed(k, F.col("words"), F.col("pos"))) for k in range(len(_ALL))]
    rows = at.select("item", F.col("piece").alias("item_piece"), (F.col("base") + F.col("pos")).alias("item_pos"), F.explode(F.array(*seeds)).alias("seed"))
    return rows.filter("seed is not null")


def _holds(identity: float) -> Column:
    """Whether a hit holds, and where: the item's places near it whose tokens are equal, or null.

    Reads words and pos of the document's piece, and item_words, item_base, item_pos and item_tokens of the item's. Compared are
    RUN - 1 tokens of the item on either side of the hit, and its window. It holds if they have RUN equal tokens in a
    row, or if of the STRETCH tokens around the hit (of the whole item, if it is shorter) a share of `identity` is equal, or, for
    items of at most WHOLE tokens, of all. Tokens beyond an end of the document are unequal.
    """
    n, at = F.col("item_tokens"), F.col("item_pos")
    shift = F.col("pos") - at

    def same(low: Column, high: Column) -> Column:
        equal = lambda j: F.get(F.col("item_words"), j - F.col("item_base")) == F.get(F.col("words"), F.when(j + shift >= 0, j + shift))
        return F.filter(F.sequence(low, high - 1), equal)

    size = F.least(F.lit(STRETCH), n)
    low, high = F.greatest(F.lit(0), at - RUN + 1), F.least(n, at + RUN + max(map(len, _ALL)) - 1)
    first = F.greatest(F.lit(0), F.least(at - F.floor((size - 6) / 2).cast("int"), n - size))

    def verdict(near: Column) -> Column:
        stretch = F.size(F.filter(near, lambda j: (j >= first) & (j < first + size)))
        # an equal place with RUN - 1 more behind it, the last of them as far away as they are many, begins a run
        runs = F.exists(near, lambda j: F.get(near, F.array_position(near, j).cast("int") + RUN - 2) == j + RUN - 1)
        whole = (n <= WHOLE) & (F.size(same(F.lit(0), n)) >= identity * n)
        return F.when((stretch >= identity * size) | runs | whole, near)

    return _let(same(low, high), verdict)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def overlaps(docs: DataFrame, items: DataFrame, keys: list[str], identity: float = IDENTITY, block_windows: int = BLOCK_WINDOWS, shortest: int = 1) -> DataFrame:
    """Pairs of documents and benchmark items that share a passage, tolerant of substituted tokens.

    `docs` needs text and the columns `keys`; `items` needs item_id and text. Every window of every text is
    hashed at the counting positions of each fixed mask and joined to the same hashes of the items. A hit is verified on its
    diagonal, see _holds(). Returns keys, item_id, hits (verified seed hits), matched (the item's tokens that are equal near a
    verified hit) and item_tokens.

    Items of 5 to 9 tokens have masks of their own, and shorter ones are found where their tokens stand in a row; `shortest` leaves
    out items of fewer tokens, as a benchmark of bare answers would match nearly everything. Items without a token never match.
    Items with equal item_id and text count once; an empty table on either side gives no pairs. Null keys are kept as
    keys; rows alike add their hits up.

    A benchmark of up to `block_windows` seeds is broadcast, its tokens once and its seeds as four numbers each, both linear in its
    length: windows are made, joined and verified in one scan of the documents, without a shuffle. A larger one is joined by a
    shuffle of seeds and places; only its hits meet their texts again.
    """
    own = items.filter("text is not null").select("item_id", tokens(F.col("text")).alias("words")).distinct()
    own = own.withColumn("n", F.size("words")).filter(F.col("n") >= max(1, shortest)).withColumn("item", F.xxhash64("item_id", "words"))
    own = stored(_pieces(own, ["item", "item_id", "n"]), "items")
    bench = stored(_bench(own), "seeds")
    used = own.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(_masks(F.col("n"))))))).first()[0] or [0]
    named = [f"key_{k}" for k in range(len(keys))]
    train = docs.select(*[F.col(k).alias(n) for k, n in zip(keys, named, strict=True)], tokens(F.col("text")).alias("words"))
    texts = own.select("item", F.col("piece").alias("item_piece"), F.col("base").alias("item_base"), F.col("words").alias("item_words"), "item_id", F.col("n").alias("item_tokens"))
    if bench.count() <= block_windows:
        hits = _windows(_pieces(train, named), used, [*named, "words"]).join(F.broadcast(bench), "seed").join(F.broadcast(texts), ["item", "item_piece"])
    else:
        key = [*named, "row", "piece"]
        pieces = _pieces(train.withColumn("row", F.xxhash64("words")), [*named, "row"])
        at = _windows(pieces, used, [*key]).join(bench, "seed").groupBy(*key, "pos", "item", "item_piece", "item_pos").agg(F.count("*").cast("int").alias("times"))
        at = stored(at, "places")
        where = small(stored(at.select("row", "piece").distinct(), "where"))
        again = pieces.select(*key, "words").join(where, ["row", "piece"], "left_semi").dropDuplicates(key)
        again = again.select(*[F.col(c).alias(f"t_{c}") for c in key], "words")
        hits = at.join(again, [F.col(c).eqNullSafe(F.col(f"t_{c}")) for c in key]).join(small(texts), ["item", "item_piece"])
        hits = hits.withColumn("time", F.explode(F.array_repeat(F.lit(1), F.col("times"))))
    # an explode of one row stands between join and check: joined to it, the check would have every window's words
    # copied out of generated code, not those of hits alone
    found = hits.select(*named, "item_id", "item_tokens", F.explode(F.array(_holds(identity))).alias("near")).filter("near is not null")
    each = found.select(*named, "item_id", "item_tokens", F.posexplode("near").alias("k", "at"))
    once = each.groupBy(*named, "item_id", "item_tokens", "at").agg(F.count_if(F.col("k") == 0).alias("hits"))
    sums = once.groupBy(*named, "item_id").agg(F.sum("hits").alias("hits"), F.count("*").alias("matched"), F.max("item_tokens").cast("long").alias("item_tokens"))
    return sums.toDF(*keys, "item_id", "hits", "matched", "item_tokens")


def clean(docs: DataFrame, items: DataFrame, shortest: int = 1) -> DataFrame:
    """The documents that share no passage with the benchmark, with their columns; repeated rows stay repeated.

    Raise `shortest` for benchmarks with bare answers among their items: each removes every document that holds it.
    Documents are told apart by doc_id and a hash of the text, so null and repeated doc_ids are each judged by
    their own text.
    """
    keyed = docs.withColumn("text_key__", F.xxhash64("text"))
    found = stored(overlaps(keyed, items, ["doc_id", "text_key__"], shortest=shortest).select("doc_id", "text_key__").distinct(), "leaks")
    found = found.toDF("leak_id__", "leak_key__")
    return keyed.join(small(found), keyed["doc_id"].eqNullSafe(found["leak_id__"]) & (keyed["text_key__"] == found["leak_key__"]), "left_anti").drop("text_key__")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, hits, matched and item_tokens of every document that overlaps a benchmark item."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return overlaps(docs.select("doc_id", "text"), items, ["doc_id"])


OP4_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
b AS (SELECT DISTINCT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark WHERE text IS NOT NULL),
masks(mask, ones, span, low_n, high_n) AS (VALUES
  (1, [0, 1, 3, 4, 5], 6, 10, 1000000000), (2, [0, 1, 3, 5, 6], 7, 10, 1000000000), (3, [0, 1, 2, 5, 6], 7, 10, 1000000000),
  (4, [0, 1, 2, 3], 4, 5, 9), (5, [0, 1, 2, 4], 5, 5, 9), (6, [0, 1, 3, 4], 5, 5, 9), (7, [0, 2, 3, 4], 5, 5, 9),
  (8, [0], 1, 1, 1), (9, [0, 1], 2, 2, 2), (10, [0, 1, 2], 3, 3, 3), (11, [0, 1, 2, 3], 4, 4, 4)),
bw AS (SELECT item_id, w, mask, p, list_transform(ones, lambda i: w[p + i + 1]) AS seed
  FROM (SELECT item_id, w, mask, ones, span, unnest(range(0, len(w) - span + 1)) AS p FROM b, masks WHERE len(w) BETWEEN low_n AND high_n)),
dw AS (SELECT doc_id, w, mask, p, list_transform(ones, lambda i: w[p + i + 1]) AS seed
  FROM (SELECT doc_id, w, mask, ones, unnest(range(0, len(w) - span + 1)) AS p FROM d, (SELECT * FROM masks WHERE mask IN (SELECT mask FROM bw)))),
hit AS (SELECT doc_id, item_id, dw.w AS dt, bw.w AS bt, bw.p AS o, dw.p - bw.p AS shift, len(bw.w) AS n, least(18, len(bw.w)) AS size
  FROM dw JOIN bw USING (mask, seed)),
cmp AS (SELECT *, list_filter(range(greatest(0, o - 12), least(n, o + 19)), lambda j: j + shift >= 0 AND bt[j + 1] = dt[j + 1 + shift]) AS near,
    greatest(0, least(o - CAST(floor((size - 6) / 2.0) AS BIGINT), n - size)) AS first FROM hit),
held AS (SELECT doc_id, item_id, near, n FROM cmp
  WHERE len(list_filter(near, lambda j: j >= first AND j < first + size)) >= 0.8::DOUBLE * size
    OR len(list_filter(near, lambda j: list_has_all(near, range(j, j + 13)))) > 0
    OR (n <= 64 AND len(list_filter(range(0, n), lambda j: j + shift >= 0 AND bt[j + 1] = dt[j + 1 + shift])) >= 0.8::DOUBLE * n)),
u AS (SELECT doc_id, item_id, count(DISTINCT place) AS matched FROM (SELECT doc_id, item_id, unnest(near) AS place FROM held) GROUP BY ALL)
SELECT h.doc_id, h.item_id, count(*) AS hits, any_value(matched) AS matched, CAST(max(n) AS BIGINT) AS item_tokens
FROM held h JOIN u ON h.doc_id IS NOT DISTINCT FROM u.doc_id AND h.item_id IS NOT DISTINCT FROM u.item_id GROUP BY ALL
"""
