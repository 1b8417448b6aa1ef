"""S2 and part of S4: math zones, lines and columns from geometry alone."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from quire.functions.geometry import overlap
from quire.functions.glyphs import line_runs, strings
from quire.functions.xycut import xy_cut
from quire.operators.primitives import by_page, grid
from quire.session import bounded_batches

# Fonts and signs of mathematics.
MATH_FONTS = r"(?i)cmmi|cmsy|cmex|msam|msbm|cambria ?math|stix|mtextra|mt-?extra|euclid|symbol"
BIG_OPERATORS = ("∑", "∏", "∫", "∮", "⋃", "⋂", "√")


def line_clusters(chars: DataFrame, gap: float = 0.5, gutter: float | None = None) -> DataFrame:
    """chars (doc_id, page_no, prim_id, ch, size, x0, top, x1, bottom) -> lines with number, box and text.

    Characters of a page are taken in order of their middle; a middle that lies more than `gap` sizes below the one
    before starts a line. The order of the text layer plays no part, so a line broken after every character
    is whole again. Text runs from left to right; a space wider than `gutter` sizes cuts a line in pieces, so that columns beside each
    other are not one line (reading_order() puts the pieces in order). Characters may come as pages (doc_id, page_no, glyphs: see by_page());
    nothing is shuffled then. Otherwise pages are dealt out once. A page is one row: its characters are sorted and cut into lines there.
    Texts (doc_id, texts: see texts_of()) are laid out in the grid and cut in numpy, some pages at once, so that a glyph is never an object.
    """
    page = ["doc_id", "page_no"]
    if "texts" in chars.columns:
        return _lines_of_texts(chars, gap, gutter)
    sign = lambda c: F.struct(((c["top"] + c["bottom"]) / 2).alias("middle"), *[c[x].alias(x) for x in ("x0", "prim_id", "ch", "size", "x1", "top", "bottom")])
    rows = by_page(chars).select(*page, F.sort_array(F.transform("glyphs", sign)).alias("signs"))
    # a level's size is that of its first character
    below = lambda p, c: F.when(c["middle"].eqNullSafe(p["middle"]), False).otherwise(F.coalesce(c["middle"] - p["middle"] > gap * c["size"], F.lit(True)))
    starts = F.filter(F.sequence(F.lit(0), F.size("signs") - 1), lambda i: (i == 0) | below(F.get("signs", i - 1), F.get("signs", i)))
    own = F.transform("starts", lambda s, i: F.slice("signs", s + 1, F.coalesce(F.get("starts", i + 1), F.size("signs")) - s))
    lines = rows.withColumn("starts", F.when(F.size("signs") > 0, starts)).select(*page, F.posexplode(own).alias("at", "own"))
    # a line of several levels is sorted again as one
    first = F.get("own", F.lit(0))
    level = lambda c: F.struct(first["middle"].alias("middle"), *[c[x].alias(x) for x in ("x0", "prim_id", "ch", "size", "x1", "top", "bottom")])
    signs = F.when(first["middle"].eqNullSafe(F.element_at("own", -1)["middle"]), F.col("own")).otherwise(F.sort_array(F.transform("own", level)))
    lines = lines.select(*page, (F.col("at") + 1).cast("long").alias("line_no"), first["size"].alias("size"), signs.alias("signs"))
    lines = lines.select(
        *page, "line_no", "size", "signs", F.size("signs").cast("long").alias("n_chars"), F.array_min("signs.x0").alias("x0"), F.array_min("signs.top").alias("top"), F.array_max("signs.x1").alias("x1"), F.array_max("signs.bottom").alias("bottom"),
    )
    if gutter is None:
        return lines.select(*page, "line_no", "n_chars", "x0", "top", "x1", "bottom", F.array_join("signs.ch", "").alias("text"))
    far = lambda i: F.get("signs", i)["x0"] - F.array_max(F.transform(F.slice("signs", F.lit(1), i), lambda c: c["x1"])) > gutter * F.col("size")
    at = F.sequence(F.lit(1), F.size("signs"))
    cuts = F.concat(F.array(F.lit(0)), F.filter(at, lambda i: (i < F.size("signs")) & far(i)), F.array(F.size("signs")))
    pieces = F.transform(F.slice("cuts", F.lit(2), F.size("cuts") - 1), lambda end, i: F.slice("signs", F.get("cuts", i) + 1, end - F.get("cuts", i)))
    rows = lines.withColumn("cuts", cuts).select(*page, "line_no", F.posexplode(pieces).alias("at", "own"))
    each = lambda c: F.transform("own", lambda x: x[c])
    rows = rows.select(
        *page, "line_no", "at", F.size("own").cast("long").alias("n_chars"), F.array_min(each("x0")).alias("x0"), F.array_min(each("top")).alias("top"), F.array_max(each("x1")).alias("x1"), F.array_max(each("bottom")).alias("bottom"),
        F.array_join(each("ch"), "").alias("text"),
    )
    # pieces are numbered through their page, line by line
    number = F.row_number().over(Window.partitionBy(*page).orderBy("line_no", "at")).cast("long")
    return rows.withColumn("line_no", number).drop("at")


def _lines_of_texts(texts: DataFrame, gap: float, gutter: float | None) -> DataFrame:
    bounded_batches(texts.sparkSession)
    kind = texts.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for glyphs in grid(batch.column("texts")):
                page, line_no, n, *box, ch = line_runs(glyphs, gap, gutter)
                columns = [batch.column("doc_id").take(pa.array(glyphs.row[page])), pa.array(glyphs.page_no[page], pa.int32()), *map(pa.array, (line_no, n, *box)), strings(ch, n)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "page_no", "line_no", "n_chars", "x0", "top", "x1", "bottom", "text"])

    schema = f"doc_id {kind}, page_no int, line_no long, n_chars long, x0 double, top double, x1 double, bottom double, text string"
    return texts.select("doc_id", "texts").mapInArrow(cut, schema)


def reading_order(boxes: DataFrame, gutter: float = 12.0, slack: float = 1.0, depth: int = 4) -> DataFrame:
    """Boxes (doc_id, page_no, line_no, x0, top, x1, bottom) with region_no and order_no, both from 1 on: a recursive XY-cut of each page.

    A region is cut into strips, where no box crosses (boxes may overlap by `slack`). Strips from the top down share a region as long as one
    gap of `gutter` or more runs through all of them, or none has any: a heading across two columns stays apart, and a short column
    beside a longer one does not. A region with gaps between its boxes falls into columns, from left to right, each of which is cut
    again, `depth` times at most. Inside a region boxes go by top, x0 and number. Boxes may come as pages (see by_page()); nothing is shuffled
    then. Otherwise pages are dealt out once. A page is one row, and only its boxes' sides and numbers go through Python (xy_cut()); boxes
    with a null side come last. Repeated boxes stay rows.
    """
    page = ["doc_id", "page_no"]
    bounded_batches(boxes.sparkSession)
    rows = by_page(boxes).select(*page, F.col("glyphs").alias("own"))
    kept = [*page, *rows.schema["own"].dataType.elementType.names] if "glyphs" in boxes.columns else boxes.columns
    lost = lambda r: (r["x0"] + r["x1"] + r["top"] + r["bottom"]).isNull()
    sides = {c: "bigint" if c == "line_no" else "double" for c in ("top", "x0", "x1", "bottom", "line_no")}
    ordered = lambda a: F.array_sort(a, lambda p, q: F.coalesce(*[F.when(p[c].cast(sides[c]) < q[c].cast(sides[c]), -1).when(p[c].cast(sides[c]) > q[c].cast(sides[c]), 1) for c in ("top", "x0", "line_no")], F.lit(0)))
    last = F.concat(F.filter("own", lambda r: ~lost(r)), ordered(F.filter("own", lost)))
    rows = rows.select(*page, F.when(F.exists("own", lost), last).otherwise(F.col("own")).alias("own"))
    placed = xy_cut(gutter, slack, depth)(*[F.col(f"own.{c}").cast(f"array<{t}>") for c, t in sides.items()])
    rows = rows.select(*page, "own", F.posexplode(placed).alias("order_no", "x"))
    box = F.get("own", F.col("x.at"))
    return rows.select(*[F.col(c) if c in page else box[c].alias(c) for c in kept], F.col("x.region_no").alias("region_no"), (F.col("order_no") + 1).alias("order_no"))


def bands(boxes: DataFrame, bin_width: float = 6.0, min_gap: int = 2) -> DataFrame:
    """Columns of each page: runs of x bins that boxes fill, apart by `min_gap` empty bins or more.

    Boxes may come as pages (see by_page()); nothing is shuffled then. Otherwise they are counted by bin before they are dealt out. A
    page's bins are sorted in one row and cut where they lie apart.
    """
    page = ["doc_id", "page_no"]
    low = lambda x0: F.floor(x0 / bin_width)
    high = lambda x0, x1: F.greatest(low(x0), F.ceil(x1 / bin_width) - 1)
    if "glyphs" in boxes.columns:
        wide = F.filter("glyphs", lambda c: high(c["x0"], c["x1"]) > low(c["x0"]))
        whole = F.filter("glyphs", lambda c: c["x0"].isNotNull() & c["x1"].isNotNull())
        each = F.concat(F.transform(whole, lambda c: low(c["x0"])), F.flatten(F.transform(wide, lambda c: F.sequence(low(c["x0"]) + 1, high(c["x0"], c["x1"])))))
        counted = boxes.select(*page, F.sort_array(each).alias("bins"))
    else:
        filled = boxes.select(*page, F.explode(F.sequence(low(F.col("x0")), high(F.col("x0"), F.col("x1")))).alias("bin")).groupBy(*page, "bin").agg(F.count("*").alias("n"))
        counted = filled.groupBy(*page).agg(F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("own")).select(*page, F.col("own.bin").alias("bins"), F.col("own.n").alias("ns"))
    starts = F.filter(F.sequence(F.lit(0), F.size("bins") - 1), lambda i: (i == 0) | (F.get("bins", i) - F.get("bins", i - 1) > min_gap))
    total = lambda s, n: n if "ns" not in counted.columns else F.aggregate(F.slice("ns", s + 1, n.cast("int")), F.lit(0).cast("long"), lambda a, v: a + v)

    def band(s: Column, i: Column) -> Column:
        after = F.coalesce(F.get("starts", i + 1), F.size("bins"))
        return F.struct((i + 1).cast("long").alias("band_no"), (F.get("bins", s) * bin_width).alias("x0"), ((F.get("bins", after - 1) + 1) * bin_width).alias("x1"), total(s, (after - s).cast("long")).alias("n"))

    rows = counted.withColumn("starts", F.when(F.size("bins") > 0, starts))
    return rows.select(*page, F.explode(F.transform("starts", band)).alias("b")).select(*page, "b.*")


def column_of(lines: DataFrame, bands: DataFrame) -> DataFrame:
    """Each line with the band that holds most of it: a range join inside the page key."""
    page = ["doc_id", "page_no"]
    own = bands.select(*page, F.col("band_no"), F.col("x0").alias("b0"), F.col("x1").alias("b1"))
    rows = lines.join(own, page).withColumn("shared", overlap(F.col("x0"), F.col("x1"), F.col("b0"), F.col("b1"))).filter("shared > 0")
    best = Window.partitionBy(*page, "line_no").orderBy(F.col("shared").desc(), "band_no")
    return rows.withColumn("rank", F.row_number().over(best)).filter("rank = 1").drop("rank", "shared", "b0", "b1")


def math_seeds(chars: DataFrame, rules: DataFrame, reach: float = 1.5) -> DataFrame:
    """Seeds of math zones: (doc_id, page_no, prim_id, reason), reason font, operator or fraction.

    A fraction bar is a horizontal rule with a character above and one below it, each within `reach` sizes: two existence
    checks inside the page key.
    """
    fonts = chars.filter(F.col("fontname").rlike(MATH_FONTS)).select("doc_id", "page_no", "prim_id", F.lit("font").alias("reason"))
    signs = chars.filter(F.col("ch").isin(*BIG_OPERATORS)).select("doc_id", "page_no", "prim_id", F.lit("operator").alias("reason"))
    r, c = rules.filter("orientation = 'horizontal'").alias("r"), chars.alias("c")
    page = (F.col("r.doc_id") == F.col("c.doc_id")) & (F.col("r.page_no") == F.col("c.page_no"))
    across = overlap(F.col("r.x0"), F.col("r.x1"), F.col("c.x0"), F.col("c.x1")) > 0
    above = F.col("r.top") - F.col("c.bottom")
    below = F.col("c.top") - F.col("r.bottom")
    near = lambda d: (d > -0.2 * F.col("c.size")) & (d <= reach * F.col("c.size"))
    bars = r.join(c, page & across & near(above), "left_semi").alias("r").join(c, page & across & near(below), "left_semi")
    return fonts.unionByName(signs).unionByName(bars.select("doc_id", "page_no", "prim_id", F.lit("fraction").alias("reason")))


def zones(seeds: DataFrame, prims: DataFrame, reach: float = 12.0, cell: float = 60.0) -> DataFrame:
    """Zones of each page: seeds whose boxes lie within `reach` of one another in both directions, directly or through others.

    Boxes are widened by half of `reach` and written to the cells of a grid of `cell` points that they touch; boxes that overlap in a
    cell are joined there, so a seed meets its neighbours only, however many a page has. The components of these links are found in
    one row for each page, by handing on the smallest number among neighbours and then that of its holder, until nothing changes.
    Returns doc_id, page_no, zone_id (from 1 on, by top, then x0), box and reasons. Seeds without a box are left out; equal ones count once.
    """
    page = ["doc_id", "page_no"]
    box = ["x0", "top", "x1", "bottom"]
    rows = seeds.join(prims.select(*page, "prim_id", *box).dropDuplicates([*page, "prim_id"]), [*page, "prim_id"]).dropna(subset=[*page, *box])
    rows = rows.groupBy(*page).agg(F.array_sort(F.collect_set(F.struct("top", "x0", "x1", "bottom", "prim_id", "reason"))).alias("own"))
    each = rows.select(*page, F.posexplode("own").alias("n", "r")).select(*page, "n", *[(F.col(f"r.{c}") + (reach / 2 if c in ("x1", "bottom") else -reach / 2)).alias(c) for c in box])
    span = lambda low, high: F.sequence(F.floor(F.col(low) / cell), F.floor(F.col(high) / cell))
    dealt = each.withColumn("cx", F.explode(span("x0", "x1"))).withColumn("cy", F.explode(span("top", "bottom")))
    a, b = dealt.alias("a"), dealt.alias("b")
    near = (F.col("a.n") < F.col("b.n")) & (F.col("a.x0") <= F.col("b.x1")) & (F.col("b.x0") <= F.col("a.x1")) & (F.col("a.top") <= F.col("b.bottom")) & (F.col("b.top") <= F.col("a.bottom"))
    on = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in (*page, "cx", "cy")]
    links = a.join(b, on + [near]).select(*[F.col(f"a.{c}").alias(c) for c in page], F.col("a.n").alias("u"), F.col("b.n").alias("v")).distinct()
    both = links.unionByName(links.select(*page, F.col("v").alias("u"), F.col("u").alias("v"))).groupBy(*page, "u").agg(F.collect_list("v").alias("v"))
    tied = both.groupBy(*page).agg(F.map_from_entries(F.collect_list(F.struct("u", "v"))).alias("near"))
    rows = rows.join(tied, page, "left").withColumn("near", F.coalesce("near", F.create_map().cast("map<int,array<int>>")))
    start = F.struct(F.transform("own", lambda _, i: i).alias("label"), F.lit(True).alias("moves"))

    def turn(s: Column, _: Column) -> Column:
        least = F.transform(s["label"], lambda v, i: F.array_min(F.transform(F.concat(F.array(i), F.coalesce(F.try_element_at("near", i), F.array().cast("array<int>"))), lambda j: F.get(s["label"], j))))
        new = F.transform(F.array(least), lambda x: F.transform(x, lambda v: F.get(x, v)))[0]
        return F.when(s["moves"], F.struct(new.alias("label"), (new != s["label"]).alias("moves"))).otherwise(s)

    label = F.aggregate(F.sequence(F.lit(0), F.size("own")), start, turn, lambda s: s["label"])
    rows = rows.withColumn("label", label).select(*page, F.explode(F.arrays_zip("own", F.transform("label", lambda v: F.size(F.filter(F.array_distinct("label"), lambda w: w <= v))).alias("zone_id"))).alias("x"))
    return rows.groupBy(*page, F.col("x.zone_id").alias("zone_id")).agg(
        F.min("x.own.x0").alias("x0"), F.min("x.own.top").alias("top"), F.max("x.own.x1").alias("x1"), F.max("x.own.bottom").alias("bottom"), F.array_sort(F.collect_set("x.own.reason")).alias("seeds")
    )
