"""S5: figures by reference, and tables from ruling lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def figure_refs(images: DataFrame) -> DataFrame:
    """A reference for each image: its box locates it only; the stream stays at its native size."""
    return images.select("doc_id", F.struct(F.col("prim_id").alias("figure_id"), "page_no", F.struct("x0", "top", "x1", "bottom").alias("bbox")).alias("figure_ref"), "px_w", "px_h", "stream")


KEY = ["doc_id", "page_no", "table_id"]
_BOX = ("x0", "top", "x1", "bottom")


def by_table(rules: DataFrame) -> DataFrame:
    """Rules as tables (doc_id, page_no, table_id, rules: an array of orientation and box), dealt out once; tables stay as they are."""
    if "rules" in rules.columns:
        return rules
    return rules.repartition(*KEY).groupBy(*KEY).agg(F.collect_set(F.struct("orientation", *_BOX)).alias("rules"))


def _spans(of: Column, n: str, low: str, high: str) -> Column:
    return F.transform(F.slice(of, F.lit(2), F.size(of)), lambda v, i: F.struct(i.cast("int").alias(n), F.get(of, i).alias(low), v.alias(high)))


def grid(rules: DataFrame, snap: float = 2.0) -> DataFrame:
    """Cells of each table (doc_id, page_no, table_id, r, c, x0, top, x1, bottom) between neighbouring rules.

    `rules` has table_id, or is by_table(); nothing is shuffled then. Places within `snap` are one. A table's places are collected as two
    sets, combined before the one shuffle, by table; its cells are the pairs of neighbours of either, as many as a page holds.
    """
    if "rules" in rules.columns:
        # exploded as an expression: of a named array Spark would make a filter on its size, push it down and make the array twice
        own = F.transform("cells", lambda x: F.struct(*[x[c].alias(c) for c in ("r", "top", "bottom", "c", "x0", "x1")]))
        return laid_out(rules, snap).select(*KEY, F.explode(own).alias("x")).select(*KEY, "x.*")
    at = lambda kind, c: F.array_sort(F.collect_set(F.when(F.col("orientation") == kind, F.round(F.col(c) / snap) * snap)))
    places = rules.groupBy(*KEY).agg(at("horizontal", "top").alias("hs"), at("vertical", "x0").alias("vs"))
    rows = places.select(*KEY, F.explode(_spans(F.col("hs"), "r", "top", "bottom")).alias("h"), "vs").select(*KEY, "h", F.explode(_spans(F.col("vs"), "c", "x0", "x1")).alias("v"))
    return rows.select(*KEY, "h.r", "h.top", "h.bottom", "v.c", "v.x0", "v.x1")


def laid_out(rules: DataFrame, snap: float = 2.0) -> DataFrame:
    """Tables with cells, as grid() gives them, and gaps, as gaps() does, each as an array: a table is one row, and its rules meet by one shuffle at most."""
    rows = by_table(rules)
    at = lambda kind, c: F.sort_array(F.array_distinct(F.transform(F.filter("rules", lambda b: (b["orientation"] == kind) & b[c].isNotNull()), lambda b: F.round(b[c] / snap) * snap)))
    rows = rows.select(*KEY, "rules", at("horizontal", "top").alias("hs"), at("vertical", "x0").alias("vs"))
    rows = rows.select(*KEY, "rules", _spans(F.col("hs"), "r", "top", "bottom").alias("hs"), _spans(F.col("vs"), "c", "x0", "x1").alias("vs"))
    cell = lambda h, v: F.struct(h["r"].alias("r"), v["c"].alias("c"), v["x0"].alias("x0"), h["top"].alias("top"), v["x1"].alias("x1"), h["bottom"].alias("bottom"))
    rows = rows.select(*KEY, "rules", F.flatten(F.transform("hs", lambda h: F.transform("vs", lambda v: cell(h, v)))).alias("cells"))
    return rows.withColumn("gaps", _open(snap)).drop("rules")


def _open(snap: float) -> Column:
    """Inner sides of `cells` that none of `rules` covers."""
    own = lambda kind: F.filter("rules", lambda b: b["orientation"] == kind)
    v = lambda x: F.exists(own("vertical"), lambda b: (F.abs(x["x1"] - b["x0"]) <= snap) & (b["top"] <= x["top"] + snap) & (b["bottom"] >= x["bottom"] - snap))
    h = lambda x: F.exists(own("horizontal"), lambda b: (F.abs(x["bottom"] - b["top"]) <= snap) & (b["x0"] <= x["x0"] + snap) & (b["x1"] >= x["x1"] - snap))
    side = lambda x, name: F.struct(x["r"].alias("r"), x["c"].alias("c"), F.lit(name).alias("side"))
    right = F.transform(F.filter("cells", lambda x: (x["c"] < F.array_max("cells.c")) & ~v(x)), lambda x: side(x, "right"))
    below = F.transform(F.filter("cells", lambda x: (x["r"] < F.array_max("cells.r")) & ~h(x)), lambda x: side(x, "bottom"))
    return F.concat(right, below)


def gaps(cells: DataFrame, rules: DataFrame, snap: float = 2.0) -> DataFrame:
    """Sides of cells that no rule covers: (table key, r, c, side), side right or bottom.

    The cells and rules of a table meet in one row, by one shuffle, and each inner side is looked for among the rules. Cells that grid() makes of
    the same rules need not be made apart: see laid_out().
    """
    cell = F.struct("r", "c", *_BOX)
    rule = F.struct("orientation", *_BOX)
    both = cells.select(*KEY, cell.alias("cell"), F.lit(None).cast("struct<orientation:string,x0:double,top:double,x1:double,bottom:double>").alias("rule")).unionByName(rules.select(*KEY, rule.alias("rule")), allowMissingColumns=True)
    rows = both.groupBy(*KEY).agg(F.collect_list("cell").alias("cells"), F.collect_set("rule").alias("rules"))
    return rows.select(*KEY, F.explode(_open(snap)).alias("g")).select(*KEY, "g.*")


def merged(cells: DataFrame, gaps: DataFrame) -> DataFrame:
    """Cells with row and column spans: cells without a rule between them are one, as long as they fill a rectangle; others stay apart.

    A table's cells and gaps meet in one row, bounded by its page: see spans().
    """
    kept = cells.select(*KEY, "r", "c", F.lit(None).cast("string").alias("side")).unionByName(gaps.select(*KEY, "r", "c", "side"))
    rows = kept.groupBy(*KEY).agg(
        F.collect_set(F.when(F.col("side").isNull(), F.struct("r", "c"))).alias("cells"),
        F.collect_set(F.when(F.col("side").isNotNull(), F.struct("r", "c", "side"))).alias("gaps"),
    )
    return spans(rows)


def spans(tables: DataFrame) -> DataFrame:
    """merged() of tables that hold their cells and gaps (see laid_out()), each in its row.

    Groups are a fold over the gaps, each of which gives the cells on its far side the smaller number of the two.
    """
    place = lambda x: F.struct(x["r"].cast("int").alias("r"), x["c"].cast("int").alias("c"))
    rows = tables.select(*KEY, F.array_distinct(F.sort_array(F.transform("cells", place))).alias("own"), "gaps")
    number = lambda r, c: F.array_position("own", F.struct(r.cast("int").alias("r"), c.cast("int").alias("c"))).cast("int")  # noqa: E731  0: no such cell
    edges = F.transform("gaps", lambda g: F.struct(number(g["r"], g["c"]).alias("a"), number(g["r"] + (g["side"] == "bottom").cast("int"), g["c"] + (g["side"] == "right").cast("int")).alias("b")))
    rows = rows.withColumn("edges", F.filter(edges, lambda e: (e["a"] > 0) & (e["b"] > 0)))

    def joined(roots: Column, e: Column) -> Column:
        pair = F.array(F.struct(F.get(roots, e["a"] - 1).alias("x"), F.get(roots, e["b"] - 1).alias("y")))
        return F.get(F.transform(pair, lambda p: F.transform(roots, lambda v: F.when(v == F.greatest(p["x"], p["y"]), F.least(p["x"], p["y"])).otherwise(v))), 0)

    rows = rows.withColumn("roots", F.aggregate("edges", F.transform("own", lambda _, i: (i + 1).cast("int")), joined))
    groups = F.transform(F.array_distinct("roots"), lambda v: F.filter("own", lambda x, i: F.get("roots", i) == v))
    rows = rows.withColumn("groups", groups)

    def one(own: Column) -> Column:
        low = lambda c: F.array_min(F.transform(own, lambda x: x[c]))
        size = lambda c: F.array_max(F.transform(own, lambda x: x[c])) - low(c) + 1
        cell = lambda r, c, height, width: F.struct(r.alias("r"), c.alias("c"), height.alias("rowspan"), width.alias("colspan"))
        whole = cell(low("r"), low("c"), size("r"), size("c"))
        return F.when(size("r") * size("c") == F.size(own), F.array(whole)).otherwise(F.transform(own, lambda x: cell(x["r"], x["c"], F.lit(1), F.lit(1))))

    return rows.select(*KEY, F.explode(F.flatten(F.transform("groups", one))).alias("x")).select(*KEY, "x.*")


def members(chars: DataFrame, cells: DataFrame) -> DataFrame:
    """Characters with the cell that holds their middle: page equi-join, then a range."""
    page = ["doc_id", "page_no"]
    x, y = (F.col("a.x0") + F.col("a.x1")) / 2, (F.col("a.top") + F.col("a.bottom")) / 2
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in page] + [x >= F.col("b.x0"), x < F.col("b.x1"), y >= F.col("b.top"), y < F.col("b.bottom")]
    return chars.alias("a").join(cells.alias("b"), on).select("a.*", "b.table_id", "b.r", "b.c")
