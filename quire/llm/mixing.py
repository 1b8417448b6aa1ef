"""Mixing sources to target weights: cube-method balanced sampling, in buckets that merge until little is left to land."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from quire.session import small, stored

#: Weights of the sources in code-point order, repeated; null comes last.
WEIGHTS = (3, 1, 2)
#: Share of all words that the mix takes, and times a source's words that it may take.
SHARE, MOST = 1.5, 2.0
#: Rows of one bucket of the flight phase, and its seed.
BUCKET_ROWS = 20_000
SEED = 11
#: Units of each size class, a power of two of words, that the last flight leaves to the landing.
LADDER = 32
#: Units that are landed together, by a linear programme over all of their ends.
LAST = 12
#: A row that is repeated more often than this is repeated by several tasks.
BLOCK = 10_000
_TINY = 1e-9


def n_words(text: Column) -> Column:
    """Words of a text as a bigint; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """`sources` with place, from 0 on, in code-point order of source, null last. Sources are sorted in ranges, none of which needs one task for all."""
    order = (F.col("source").isNull(), F.col("source"))
    dealt = stored(sources.repartitionByRange(*order).withColumn("range__", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("range__").count()
    # this window has a row for each range, that is for each shuffle partition
    before = sizes.select("range__", (F.sum("count").over(Window.orderBy("range__")) - F.col("count")).alias("before__"))
    within = F.row_number().over(Window.partitionBy("range__").orderBy(*order))
    return dealt.withColumn("within__", within).join(F.broadcast(before), "range__").select(*sources.columns, (F.col("before__") + F.col("within__") - 1).alias("place"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size) of every source -> with target, the words that the mix takes of it.

    Weights go to the sources in code-point order, null last, and repeat. `share` of all words is dealt out by
    weight; a source gets `most` times its words at most, and what is over goes to the others by weight, until
    none is above. Each turn is one aggregation over the table of sources, which has a row for each source.
    """
    weight = F.get(F.array(*map(F.lit, weights)), F.col("place") % len(weights)).cast("double")
    sources = _ranked(sources)
    rows = stored(sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most), "sources")
    rate, cap, w = 0.0, F.col("cap"), F.col("weight")
    while True:  # the rate a unit of weight gets grows as sources reach their caps
        full = w * rate >= cap
        total, used, free = rows.agg(F.sum("source_size"), F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(w))).first()
        new = max(0.0, share * (total or 0) - used) / free if free else rate
        if not free or new <= rate * (1 + 1e-15):
            break
        rate = new
    return rows.select("source", "source_size", F.when(w * rate >= cap, cap).otherwise(w * rate).alias("target"))


def _fly(p: np.ndarray, size: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Flight phase: move probabilities inside [0, 1] along the null space of (1, size) until at most two are fractional.

    Three fractional units span one direction that leaves both the sum of probabilities and the sum of
    probability times size as they are; the move goes to the nearest wall, or to the opposite one, with chances that
    keep each unit's expectation.
    """
    p = p.copy()
    chance = draw.random(len(p) + 1).tolist()
    held: list[int] = []
    values, sizes = p.tolist(), size.astype(float).tolist()
    for k, v in enumerate(values):
        if not _TINY < v < 1 - _TINY:
            continue
        held.append(k)
        if len(held) < 3:
            continue
        a, b, c = held
        u = (sizes[b] - sizes[c], sizes[c] - sizes[a], sizes[a] - sizes[b])
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = min((1 - values[i]) / d if d > 0 else values[i] / -d for i, d in zip(held, u, strict=True) if d)
        down = min(values[i] / d if d > 0 else (1 - values[i]) / -d for i, d in zip(held, u, strict=True) if d)
        move = up if chance[k] < down / (up + down) else -down
        for i, d in zip(held, u, strict=True):
            x = values[i] + move * d
            values[i] = 0.0 if x < _TINY else 1.0 if x > 1 - _TINY else x
        held = [i for i in held if 0.0 < values[i] < 1.0]
        if len(held) == 3:  # rounding kept all three inside: the nearest to a wall goes to it
            i = min(held, key=lambda i: min(values[i], 1 - values[i]))
            values[i] = float(round(values[i]))
            held.remove(i)
    return np.array(values)


def _ends(p: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends (rows of 0 and 1) and their chances, so that each unit keeps its expectation and the expected miss of words is the least there is.

    A linear programme over all ends of a few units, by the simplex method. It starts from ends that contain one another, from none to all
    units in the order of their chances, whose chances are the steps from one to the next.
    """
    n = len(p)
    ends = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1
    rows = np.vstack([ends.T, np.ones(1 << n)]).astype(float)
    cost, wanted = np.abs((ends - p) @ size) / max(1.0, size.sum()), np.append(p, 1.0)
    order = np.argsort(-p, kind="stable")
    basis = np.append(0, np.cumsum(1 << order))
    for turn in range(5_000):
        chances = np.linalg.solve(rows[:, basis], wanted)
        less = cost - np.linalg.solve(rows[:, basis].T, cost[basis]) @ rows
        # the steepest first; later the first of all, which cannot go round in circles
        new = int(np.argmin(less)) if turn < 500 else int(np.argmax(less < -1e-9))
        if less[new] >= -1e-9:
            break
        step = np.linalg.solve(rows[:, basis], rows[:, new])
        room = np.where(step > 1e-9, np.maximum(chances, 0.0) / np.where(step > 1e-9, step, 1.0), np.inf)
        basis[np.lexsort((basis, room))[0]] = new
    chances = np.maximum(np.linalg.solve(rows[:, basis], wanted), 0.0)
    return ends[basis], chances / chances.sum()


def _land(p: np.ndarray, size: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Landing of the few fractional units left: the total of documents is given up, that of words kept as long as it can be.

    The largest unit moves against all others, each in proportion to its variance, along a line that keeps the words, until one of
    them is whole; smaller units take up what larger ones need. The LAST units end together, as _ends() says. Each unit keeps its
    expectation, whatever the source's size.
    """
    out = p.copy()
    while len(left := np.flatnonzero((out > 0) & (out < 1))) > LAST:
        big = left[np.argmax(size[left])]
        rest = left[left != big]
        spread = out[rest] * (1 - out[rest]) * (0.5 + draw.random(len(rest)))  # at random, lest units of equal chances end together
        if not size[big]:
            rest, u = rest[:1], np.array([1.0, -1.0])
        elif spread @ size[rest] > 0:
            u = np.append(1.0, -size[big] * spread / (spread @ size[rest]))
        else:  # the others have no words
            rest, u = rest[:0], np.array([1.0])
        moved = np.append(big, rest)
        room_up, room_down = np.where(u > 0, 1 - out[moved], out[moved]), np.where(u > 0, out[moved], 1 - out[moved])
        some = u != 0
        up, down = (room_up[some] / np.abs(u[some])).min(), (room_down[some] / np.abs(u[some])).min()
        x = out[moved] + (up if draw.random() < down / (up + down) else -down) * u
        x[x < _TINY], x[x > 1 - _TINY] = 0.0, 1.0
        if ((x > 0) & (x < 1)).all():  # rounding kept all inside: the nearest to a wall goes to it
            k = int(np.argmin(np.minimum(x, 1 - x)))
            x[k] = round(x[k])
        out[moved] = x
    if len(left):
        ends, chances = _ends(out[left], size[left].astype(float))
        out[left] = ends[int(np.searchsorted(np.cumsum(chances), draw.random() * (1 - 1e-12), "right"))]
    return out


def _flight(units: DataFrame, buckets: Column, last: bool, seed: int) -> DataFrame:
    """One round: the fractional units of each (source, bucket) are flown; in the last, each source has one bucket and lands."""
    kinds = dict(units.dtypes)

    def fly(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values(["order__", "size__"], kind="stable")
        draw = np.random.default_rng([seed, int(batch["bucket__"].iloc[0]), len(batch)])
        size = batch["size__"].to_numpy(float)
        p = batch["part__"].to_numpy(float)
        kept = batch.groupby(np.log2(size + 1).astype(int)).cumcount().to_numpy() < (LADDER if last else 0)
        p[~kept] = _fly(p[~kept], size[~kept], draw)
        if last:
            p = _land(p, size, draw)
        return batch.assign(part__=p).drop(columns="bucket__")

    dealt = units.withColumn("bucket__", F.pmod(F.xxhash64("order__", F.lit(seed)), buckets))
    return dealt.groupBy("source__", "bucket__").applyInPandas(fly, ", ".join(f"`{c}` {t}" for c, t in kinds.items()))


def copies(units: DataFrame, rates: DataFrame, keys: list[str], bucket_rows: int = BUCKET_ROWS, seed: int = SEED) -> DataFrame:
    """units(source__, keys, size__, many__) -> with copies__, so that each source's words come near its target.

    `rates` has source__ and rate__ (target over size). A unit of m rows at rate r takes floor(m r) copies at
    least; the rest, a fraction, is its inclusion probability. Buckets of about `bucket_rows` units fly on
    their own and leave two fractional units at most, with the bucket's sums of probabilities and of words as they were; what
    is left of all buckets flies again in fewer buckets, until each source has one, where the last units land.
    Units keep their inclusion probabilities, see _land(). Hot sources are dealt over many buckets. The result depends on the rows alone, not on how they are partitioned.
    """
    exact = F.col("many__") * F.col("rate__")
    rows = units.join(small(rates), "source__").withColumn("whole__", F.floor(exact + _TINY)).withColumn("part__", exact - F.col("whole__"))
    rows = rows.withColumn("part__", F.when(F.col("part__") < _TINY, 0.0).otherwise(F.col("part__"))).withColumn("order__", F.xxhash64(*keys, "size__", F.lit(seed))).drop("rate__")
    done, left, turn = rows.filter("part__ = 0"), rows.filter("part__ > 0"), 0
    while True:
        wanted = left.groupBy("source__").agg(F.ceil(F.count("*") / bucket_rows).alias("buckets__"))
        wanted = stored(wanted, "buckets")
        last = (wanted.agg(F.max("buckets__")).first()[0] or 1) <= 1
        flown = stored(_flight(left.join(small(wanted), "source__"), F.col("buckets__"), last, seed + turn).drop("buckets__"), "flown")
        done = done.unionByName(flown.filter("part__ = 0 or part__ = 1"))
        if last:
            return done.withColumn("copies__", F.col("whole__") + F.col("part__").cast("long")).drop("whole__", "part__", "order__")
        left, turn = flown.filter("part__ > 0 and part__ < 1"), turn + 1


def mixed(docs: DataFrame, keys: list[str], size: Column, **settings) -> tuple[DataFrame, DataFrame]:
    """(units, shares): units(source__, keys, size__, many__, copies__), shares(source, source_size, target, source__).

    `docs` needs source and the columns `keys`. Rows alike in keys, source and size are one unit of many__ rows, so
    what repeats is aggregated before it is shuffled. An empty table gives no units and no shares.
    """
    rows = docs.select(_named(F.col("source")).alias("source__"), *keys, size.alias("size__"))
    units = stored(rows.groupBy("source__", *keys, "size__").agg(F.count("*").alias("many__")), "units")
    sizes = units.groupBy("source__").agg(F.sum(F.col("size__") * F.col("many__")).alias("source_size"))
    shares = stored(targets(sizes.select(F.when(F.col("source__") != "-", F.substr("source__", F.lit(2))).alias("source"), "source_size")), "shares")
    shares = shares.withColumn("source__", _named(F.col("source")))
    rates = shares.select("source__", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate__"))
    return copies(units, rates, keys, **settings), shares


def _named(source: Column) -> Column:
    """A key that tells a null source from every string."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("-"))


def repeated(rows: DataFrame, times: Column, name: str) -> DataFrame:
    """Each row `times` times, with its number from 1 on in `name`; a row with more than BLOCK of them is repeated by several tasks."""
    rows = rows.withColumn("times__", times.cast("long")).filter("times__ > 0")
    few = rows.filter(F.col("times__") <= BLOCK).withColumn(name, F.explode(F.sequence(F.lit(1).cast("long"), "times__")))
    many = rows.filter(F.col("times__") > BLOCK).withColumn("first__", F.explode(F.sequence(F.lit(1).cast("long"), "times__", F.lit(BLOCK).cast("long"))))
    many = many.repartition("first__", "times__").withColumn(name, F.explode(F.sequence("first__", F.least(F.col("times__"), F.col("first__") + BLOCK - 1))))
    return few.drop("times__").unionByName(many.drop("times__", "first__"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document; repeated rows of a document share its copies out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", n_words(F.col("text")).alias("size"))
    units, shares = mixed(docs, ["doc_id"], F.col("size"))
    rows = repeated(units.join(small(shares), "source__"), F.col("many__"), "nth")
    own = F.expr("copies__ div many__ + if(nth <= copies__ % many__, 1, 0)")
    return rows.select("doc_id", F.col("size__").alias("size"), "source_size", "target", (own * F.col("size__")).alias("taken"))


def mixture(docs: DataFrame) -> DataFrame:
    """`docs` with each row as often as the mix takes it (0, 1 or 2 times), and its copy number in `copy`, which replaces a column of that name.

    Null texts have no words and null sources are one source. Rows alike in every column are one unit, which comes as often as all
    of them are taken, numbered through; rows that differ in any column are units of their own. An empty table stays empty. The same
    rows give the same mix however they are partitioned.
    """
    own = [c for c in docs.columns if c != "copy"]
    rest = [F.to_json(f"`{c}`") if kind.startswith(("map", "variant")) else F.col(f"`{c}`") for c, kind in docs.dtypes if c in own]
    null = [F.col(f"`{c}`").isNull() for c in own]  # a hash passes nulls over
    keyed = docs.withColumn("row__", F.xxhash64(*rest, *null)).withColumn("text__", F.xxhash64("text", F.lit(1))).withColumn("words__", n_words(F.col("text"))).withColumn("from__", _named(F.col("source")))
    units, _ = mixed(keyed, ["row__", "text__"], F.col("words__"))
    units = units.select(*[F.col(c).alias(f"unit_{c}") for c in ("source__", "row__", "text__", "many__", "copies__")]).filter("unit_copies__ > 0")
    on = (keyed["from__"] == units["unit_source__"]) & (keyed["row__"] == units["unit_row__"]) & keyed["text__"].eqNullSafe(units["unit_text__"])
    rows = keyed.join(units, on)
    once = rows.filter("unit_many__ = 1").withColumn("copy__", F.explode(F.sequence(F.lit(1).cast("long"), "unit_copies__")))
    many = repeated(rows.filter("unit_many__ > 1").dropDuplicates(["row__", "text__"]), F.col("unit_copies__"), "copy__")
    return once.unionByName(many).select(*[F.col(f"`{c}`") for c in own], F.col("copy__").alias("copy"))
