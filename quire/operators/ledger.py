"""S7: conservation of primitives, coverage and verification."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from quire.functions.geometry import area
from quire.session import small, stored


def conservation(prims: DataFrame, consumption: DataFrame, keys: list[str]) -> DataFrame:
    """Every primitive with its number of consumers and a state: once, orphan or duplicate.

    Consumers are counted by key before the join, so a primitive that is consumed often stays one row. A null in a key is a value like
    any other; a column `uses` is replaced.
    """
    used = consumption.groupBy(*[F.col(k).alias(f"{k}__") for k in keys]).agg(F.count("*").alias("uses__"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"{k}__")) for k in keys])
    rows = prims.join(used, same, "left").withColumn("uses", F.coalesce("uses__", F.lit(0))).drop("uses__", *[f"{k}__" for k in keys])
    return rows.withColumn("state", F.when(F.col("uses") == 1, "once").when(F.col("uses") == 0, "orphan").otherwise("duplicate"))


def _content(keys: list[str]) -> Column:
    """Two 64-bit digests of a row's keys, which tell nulls from values."""
    own = [x for k in keys for x in (F.col(k), F.col(k).isNull())]
    return F.struct(F.xxhash64(*own).alias("a"), F.xxhash64(*own, F.lit(1)).alias("b"))


def digests(rows: DataFrame, by: list[str], keys: list[str]) -> DataFrame:
    """by, n, a, b: the size and the digest of the multiset of keys of each group, which can be merged by adding.

    A digest is the sum of the rows' hashes modulo 2**64, taken twice, so the order of rows plays no part, and a row that is there twice
    counts twice; sums of parts are the sum of the whole. Groups are combined before the shuffle, so a row of three numbers travels for each.
    """
    halves = lambda h: [F.sum(F.col(f"h.{h}").bitwiseAND(0xFFFFFFFF)).alias(f"{h}_low"), F.sum(F.shiftrightunsigned(f"h.{h}", 32)).alias(f"{h}_high")]
    sums = rows.select(*by, _content(keys).alias("h")).groupBy(*by).agg(F.count("*").alias("n"), *halves("a"), *halves("b"))
    return sums.select(*by, "n", *[F.struct(f"{h}_low", f"{h}_high").alias(h) for h in "ab"])


def unequal(prims: DataFrame, consumption: DataFrame, by: list[str], keys: list[str]) -> DataFrame:
    """Groups (by) whose primitives and consumed primitives are not the same multiset: all others balance, and need no join of rows.

    Two different multisets of one size have equal digests with a chance of about 2**-128.
    """
    return _unequal(digests(prims, by, keys), digests(consumption, by, keys), by)


def _unequal(mine: DataFrame, other: DataFrame, by: list[str]) -> DataFrame:
    other = other.select(*[F.col(c).alias(f"{c}__") for c in other.columns])
    on = reduce(and_, [F.col(c).eqNullSafe(F.col(f"{c}__")) for c in by])
    same = F.col("n").eqNullSafe(F.col("n__")) & F.col("a").eqNullSafe(F.col("a__")) & F.col("b").eqNullSafe(F.col("b__"))
    # a group that only one side has is found by its null count on the other
    return mine.join(other, on, "full").filter(~same).select(*[F.when(F.col("n").isNotNull(), F.col(c)).otherwise(F.col(f"{c}__")).alias(c) for c in by])


def unbalanced(prims: DataFrame, consumption: DataFrame, levels: list[str], keys: list[str]) -> DataFrame:
    """Rows of conservation() that are not consumed exactly once, found from the whole to the part.

    `levels`, from the outermost (doc_id, then page_no, ...), are columns of both sides and keys of a primitive; keys are unique among primitives. Digests are made for the
    outermost groups first, combined before their shuffle; only outer groups that differ have digests of their inner ones made, and only
    rows of inner groups that differ are joined by primitive. Both sides are read once for each level. Clean documents shuffle one row of digests each and no primitive.
    Consumption of what is no primitive is returned too, with state `unknown`. Groups of a null level are groups like any other.
    """
    for depth in range(1, len(levels) + 1):
        by = levels[:depth]
        odd = stored(unequal(prims, consumption, by, keys), "unequal")
        prims, consumption = (_of(side, odd, by) for side in (prims, consumption))
    rows = conservation(prims, consumption, keys).filter("state <> 'once'")
    known = prims.select(*[F.col(k).alias(f"{k}__") for k in keys])
    strange = consumption.join(known, reduce(and_, [F.col(k).eqNullSafe(F.col(f"{k}__")) for k in keys]), "left_anti").groupBy(*keys).agg(F.count("*").alias("uses")).withColumn("state", F.lit("unknown"))
    return rows.unionByName(strange, allowMissingColumns=True)


def _of(rows: DataFrame, odd: DataFrame, by: list[str]) -> DataFrame:
    """Rows of the groups in `odd`, which is broadcast if it is small."""
    named = odd.select(*[F.col(c).alias(f"{c}__") for c in by])
    return rows.join(small(named), reduce(and_, [F.col(c).eqNullSafe(F.col(f"{c}__")) for c in by]), "left_semi")


def broken(ledger: DataFrame, node: str) -> DataFrame:
    """Nodes with a primitive that is not consumed exactly once: what goes to escalation."""
    return ledger.groupBy(node).agg(F.count_if(F.col("state") == "orphan").alias("orphans"), F.count_if(F.col("state") == "duplicate").alias("duplicates")).filter("orphans + duplicates > 0")


def coverage(boxes: DataFrame, pages: DataFrame) -> DataFrame:
    """Share of each page that the union of its boxes covers; boxes without an area count nothing, nor do pages without boxes.

    The sides of a page's boxes cut it into upright strips; in each, the boxes that span it are merged from top to
    bottom. A page's boxes meet in one row, and the sweep is a fold over arrays.
    """
    page = ["doc_id", "page_no"]
    real = boxes.filter("x1 > x0 and bottom > top")
    rows = real.groupBy(*page).agg(F.array_sort(F.collect_list(F.struct("top", "bottom", "x0", "x1"))).alias("own"))
    rows = rows.withColumn("sides", F.array_sort(F.array_distinct(F.flatten(F.transform("own", lambda r: F.array(r["x0"], r["x1"]))))))

    def height(left: Column, right: Column) -> Column:
        inside = F.filter("own", lambda r: (r["x0"] <= left) & (r["x1"] >= right))
        start = F.struct(F.lit(float("-inf")).alias("end"), F.lit(0.0).alias("sum"))
        step = lambda a, r: F.struct(F.greatest(a["end"], r["bottom"]).alias("end"), (a["sum"] + F.greatest(F.lit(0.0), r["bottom"] - F.greatest(a["end"], r["top"]))).alias("sum"))
        return F.aggregate(inside, start, step, lambda a: a["sum"])

    strips = F.transform(F.slice("sides", F.lit(2), F.size("sides")), lambda right, i: (right - F.get("sides", i)) * height(F.get("sides", i), right))
    found = rows.select(*page, F.aggregate(strips, F.lit(0.0), lambda a, v: a + v).alias("covered"))
    whole = area(F.lit(0.0), F.lit(0.0), F.col("width"), F.col("height"))
    return pages.join(found, page, "left").select(*page, F.coalesce(F.try_divide("covered", whole), F.lit(0.0)).alias("coverage"))


def round_trip(formulas: DataFrame, chars: DataFrame, render: Callable[[list[str]], list[list[tuple]]], tolerance: float = 0.9) -> DataFrame:
    """Formulas (zone_id, latex) set again by `render` and held against their source characters (zone_id, ch, box), one to one.

    `render` gives (ch, x0, top, x1, bottom) lists, relative to the zone. In a zone, a source and a set glyph of one sign whose boxes
    overlap may be partners; pairs are taken from the largest share of their union down, each glyph once (what rounds of mutual best pairs
    give, as equal shares are told apart by the glyphs' places). Returns zone_id, n_pairs, n_missing (source glyphs without a partner),
    n_shared (those of them whose every candidate is another's partner), n_extra (set glyphs without a partner), least_iou, and ok: every
    glyph has its partner and no pair overlaps by less than `tolerance`. A zone with glyphs on neither side passes, with a null least_iou;
    zones of either side are kept, each row of both is a glyph of its own, and so is one with a null sign or box, which has no partner.
    One shuffle of each side by zone; a zone is part of a page, and its matching is a fold in one row.
    """
    glyph = "array<struct<ch:string,x0:double,top:double,x1:double,bottom:double>>"

    def set_again(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            shown = [render([t])[0] if t is not None else [] for t in batch["latex"]] if batch["latex"].isna().any() else render(batch["latex"].tolist())
            yield pd.DataFrame({"zone_id": batch["zone_id"], "made": [[dict(zip(("ch", "x0", "top", "x1", "bottom"), g, strict=True)) for g in made] for made in shown]})

    kind = dict(formulas.dtypes)["zone_id"]
    made = formulas.select("zone_id", "latex").mapInPandas(set_again, f"zone_id {kind}, made {glyph}").groupBy("zone_id").agg(F.array_sort(F.flatten(F.collect_list("made"))).alias("made"))
    own = chars.groupBy(F.col("zone_id").alias("zone__")).agg(F.array_sort(F.collect_list(F.struct("ch", *[F.col(c).cast("double").alias(c) for c in ("x0", "top", "x1", "bottom")]))).alias("own"))
    rows = made.join(own, F.col("zone_id").eqNullSafe(F.col("zone__")), "full").select(F.coalesce("zone_id", "zone__").alias("zone_id"), *[F.coalesce(c, F.array().cast(glyph)).alias(c) for c in ("own", "made")])

    def iou(s: Column, t: Column) -> Column:
        inner = area(F.greatest(s["x0"], t["x0"]), F.greatest(s["top"], t["top"]), F.least(s["x1"], t["x1"]), F.least(s["bottom"], t["bottom"]))
        return F.try_divide(inner, area(s["x0"], s["top"], s["x1"], s["bottom"]) + area(t["x0"], t["top"], t["x1"], t["bottom"]) - inner)

    pairs = F.flatten(F.transform("own", lambda s, i: F.transform(F.filter(F.transform("made", lambda t, j: F.struct((-iou(s, t)).alias("less"), i.alias("s"), j.alias("t"), (s["ch"] == t["ch"]).alias("same"))), lambda p: p["same"] & (p["less"] < 0)), lambda p: F.struct(p["less"], p["s"], p["t"]))))
    free = lambda a, p: ~F.exists(a, lambda q: (q["s"] == p["s"]) | (q["t"] == p["t"]))
    none = F.array().cast("array<struct<less:double,s:int,t:int>>")
    rows = rows.withColumn("pairs", F.array_sort(pairs)).withColumn("taken", F.aggregate("pairs", none, lambda a, p: F.when(free(a, p), F.concat(a, F.array(p))).otherwise(a)))
    missing = F.filter(F.sequence(F.lit(0), F.size("own")), lambda i: (i < F.size("own")) & ~F.exists("taken", lambda q: q["s"] == i))
    rows = rows.withColumn("missing", missing).select(
        "zone_id", F.size("taken").alias("n_pairs"), F.size("missing").alias("n_missing"), F.size(F.filter("missing", lambda i: F.exists("pairs", lambda p: p["s"] == i))).alias("n_shared"),
        (F.size("made") - F.size("taken")).alias("n_extra"), (-F.array_max(F.transform("taken", lambda q: q["less"]))).alias("least_iou"),
    )
    return rows.withColumn("ok", (F.col("n_missing") == 0) & (F.col("n_extra") == 0) & F.coalesce(F.col("least_iou") >= tolerance, F.lit(True)))
