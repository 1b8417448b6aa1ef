"""S3: formula trees, LaTeX and confidence from the geometry of a zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quire.operators.lines import BIG_OPERATORS

# LaTeX of signs.
SIGNS = {"∑": r"\sum", "∏": r"\prod", "∫": r"\int", "×": r"\times ", "÷": r"\div ", "≤": r"\le ", "≥": r"\ge ", "≠": r"\ne ", "∞": r"\infty ", "·": r"\cdot ", "π": r"\pi ", "α": r"\alpha ", "β": r"\beta ", "θ": r"\theta ", "{": r"\{", "}": r"\}"}
ACCENTS = {"^": "hat", "ˆ": "hat", "~": "tilde", "˜": "tilde", "→": "vec", "¯": "bar"}
PAIRS = {"(": ")", "[": "]", "{": "}"}
#: Size of a script against its base, and how far its middle is off the base's, in sizes of the base.
SCRIPT, OFF = 0.85, 0.15


def script_edges(chars: DataFrame) -> DataFrame:
    """Edges (zone_id, base_id, script_id, slot) from each smaller character to the nearest larger one on its left.

    A range join inside the zone's key; the nearest base is chosen by distance, then by id.
    """
    a, b = chars.alias("a"), chars.alias("b")
    smaller = F.col("b.size") <= SCRIPT * F.col("a.size")
    on = (F.col("a.zone_id") == F.col("b.zone_id")) & smaller & (F.col("b.x0") >= F.col("a.x1") - 0.3 * F.col("a.size")) & (F.col("b.x0") - F.col("a.x1") <= F.col("a.size"))
    middle = lambda t: (F.col(f"{t}.top") + F.col(f"{t}.bottom")) / 2
    slot = F.when(middle("b") < middle("a") - 0.15 * F.col("a.size"), "sup").when(middle("b") > middle("a") + 0.15 * F.col("a.size"), "sub")
    rows = a.join(b, on).select("a.zone_id", F.col("a.prim_id").alias("base_id"), F.col("b.prim_id").alias("script_id"), slot.alias("slot"), (F.col("b.x0") - F.col("a.x1")).alias("away")).filter("slot is not null")
    nearest = Window.partitionBy("zone_id", "script_id").orderBy(F.abs("away"), "base_id")
    return rows.withColumn("place", F.row_number().over(nearest)).filter("place = 1").drop("place", "away")


def _numbers(of: Column) -> Column:
    return F.when(F.size(of) > 0, F.sequence(F.lit(0), F.size(of) - 1)).otherwise(F.array().cast("array<int>"))


def _first(found: Column) -> Column:
    return F.get(found, 0)


def _p(i: Column) -> Column:
    """A primitive of the zone by its number."""
    return F.get(F.col("prims"), i)


def _middle(i: Column) -> Column:
    return (_p(i)["x0"] + _p(i)["x1"]) / 2


def _height(i: Column) -> Column:
    return (_p(i)["top"] + _p(i)["bottom"]) / 2


def _covers(r: Column, i: Column) -> Column:
    return (_p(r)["x0"] - 1 <= _middle(i)) & (_middle(i) <= _p(r)["x1"] + 1)


def _wider(q: Column, r: Column) -> Column:
    """A total order of rules: the wider first, of equal ones the one with the smaller number."""
    wide = lambda i: _p(i)["x1"] - _p(i)["x0"]
    return (wide(q) > wide(r)) | ((wide(q) == wide(r)) & (q < r))


def _above(i: Column, j: Column) -> Column:
    return _p(i)["bottom"] <= _p(j)["top"] + 1


def _grouped(prims: DataFrame) -> DataFrame:
    """zone_id, prims: the primitives of each zone from left to right, and nums, their numbers. A zone is a part of a line or a few."""
    each = F.struct("x0", "top", "prim_id", "kind", "ch", "size", "x1", "bottom")
    rows = prims.groupBy("zone_id").agg(F.array_sort(F.collect_list(each)).alias("prims"))
    return rows.withColumn("nums", _numbers(F.col("prims")))


def _lined(zones: DataFrame) -> DataFrame:
    """With brace, the number of a tall brace that several lines stand behind, and line of every primitive (0 without one)."""
    found = _first(F.filter("nums", lambda i: (_p(i)["kind"] == "char") & (_p(i)["ch"] == "{")))
    rows = zones.withColumn("brace", found)
    others = F.filter("nums", lambda i: F.col("brace").isNull() | (i != F.col("brace")))
    tall = _p(F.col("brace"))["bottom"] - _p(F.col("brace"))["top"] > 1.6 * F.array_max(F.transform(others, lambda i: _p(i)["size"]))
    down = F.array_sort(F.transform(others, lambda i: F.struct(_height(i).alias("y"), i.alias("i"))))
    start = F.struct(F.lit(None).cast("double").alias("y"), F.lit(0).alias("line"), F.array().cast("array<struct<i:int,line:int>>").alias("out"))

    def step(a: Column, e: Column) -> Column:
        line = a["line"] + F.when(e["y"] - a["y"] > 0.6 * _p(e["i"])["size"], 1).otherwise(0)
        return F.struct(e["y"].alias("y"), line.alias("line"), F.array_append(a["out"], F.struct(e["i"].alias("i"), line.alias("line"))).alias("out"))

    rows = rows.withColumn("lines", F.aggregate(down, start, step))
    rows = rows.withColumn("brace", F.when(tall & (F.col("lines.line") > 0), F.col("brace")))
    line = lambda i: F.coalesce(_first(F.filter(F.col("lines.out"), lambda e: e["i"] == i))["line"], F.lit(0))
    return rows.withColumn("line", F.when(F.col("brace").isNull(), F.transform("nums", lambda i: F.lit(0))).otherwise(F.transform("nums", line))).drop("lines")


def _barred(zones: DataFrame) -> DataFrame:
    """With bars: number, radical sign and kind (sqrt, frac, bar; null: it fits nowhere) of every rule; and barred: of every primitive the
    innermost bar that it is over or under, as (at, slot).

    Between a bar and what it holds there is no wider bar; a rule is held by wider ones only.
    """
    same = lambda i, j: F.get("line", i) == F.get("line", j)
    rules = F.filter("nums", lambda i: _p(i)["kind"] == "rule")
    rows = zones.withColumn("rules", rules)

    def held(r: Column, i: Column, over: bool) -> Column:
        between = lambda q: _above(i, q) & _above(q, r) if over else _above(r, q) & _above(q, i)
        blocked = F.exists("rules", lambda q: (q != r) & (q != i) & _wider(q, r) & _covers(q, i) & between(q))
        return (i != r) & same(i, r) & _covers(r, i) & (_above(i, r) if over else _above(r, i)) & ((_p(i)["kind"] != "rule") | _wider(r, i)) & ~blocked

    root = lambda r: _first(F.filter("nums", lambda i: (_p(i)["ch"] == "√") & same(i, r) & (F.abs(_p(i)["x1"] - _p(r)["x0"]) <= 2) & (F.abs(_p(i)["top"] - _p(r)["top"]) <= 3)))
    rows = rows.withColumn("bars", F.transform("rules", lambda r: F.struct(r.alias("r"), root(r).alias("root"), F.filter("nums", lambda i: held(r, i, True)).alias("over"), F.filter("nums", lambda i: held(r, i, False)).alias("under"))))
    kind = lambda b: F.when(F.size(b["under"]) > 0, F.when(b["root"].isNotNull(), "sqrt").when(F.size(b["over"]) > 0, "frac").otherwise("bar"))
    rows = rows.withColumn("bars", F.transform("bars", lambda b: F.struct(b["r"].alias("r"), b["root"].alias("root"), b["over"].alias("over"), b["under"].alias("under"), kind(b).alias("kind"))))

    def owner(i: Column) -> Column:
        slot = lambda b: F.when(b["root"] == i, None).when(F.array_contains(b["under"], i), F.element_at(F.create_map(*map(F.lit, ("sqrt", "radicand", "frac", "den", "bar", "base"))), b["kind"])).when((b["kind"] == "frac") & F.array_contains(b["over"], i), "num")
        found = F.transform("bars", lambda b: F.struct((_p(b["r"])["x1"] - _p(b["r"])["x0"]).alias("wide"), (-b["r"]).alias("order"), F.when(b["kind"] == "sqrt", b["root"]).otherwise(b["r"]).alias("at"), slot(b).alias("slot")))
        return F.array_min(F.filter(found, lambda x: x["slot"].isNotNull()))

    return rows.withColumn("barred", F.transform("nums", lambda i: F.struct(owner(i)["at"].alias("at"), owner(i)["slot"].alias("slot")))).drop("rules")


def _placed(zones: DataFrame) -> DataFrame:
    """With nodes: number, parent, slot and line of every primitive that is one, and kind; limits and accents take their places first.

    The rule of a radical is part of its sign's node; a rule that fits nowhere is none.
    """
    together = lambda i, j: F.get("barred", i).eqNullSafe(F.get("barred", j)) & (F.get("line", i) == F.get("line", j)) & (i != j)
    big = lambda i: (_p(i)["kind"] == "char") & _p(i)["ch"].isin(*BIG_OPERATORS) & (_p(i)["ch"] != "√")
    near = lambda s, i: big(s) & together(s, i) & (_p(i)["size"] <= SCRIPT * _p(s)["size"]) & (_p(s)["x0"] - 4 <= _middle(i)) & (_middle(i) <= _p(s)["x1"] + 4) & (_above(i, s) | _above(s, i))
    rows = zones.withColumn("limit", F.transform("nums", lambda i: _first(F.filter("nums", lambda s: near(s, i)))))
    free = lambda i: (_p(i)["kind"] == "char") & F.get("limit", i).isNull()
    gap = lambda m, b: _p(b)["top"] - _p(m)["bottom"] + 2
    marks = F.filter("nums", lambda m: free(m) & _p(m)["ch"].isin(*ACCENTS))
    base = lambda m: _first(F.filter("nums", lambda b: free(b) & together(m, b) & _covers(b, m) & gap(m, b).between(0, _p(b)["size"])))
    rows = rows.withColumn("accents", F.filter(F.transform(marks, lambda m: F.struct(m.alias("m"), base(m).alias("b"))), lambda x: x["b"].isNotNull()))
    mark = lambda i: _first(F.filter("accents", lambda x: x["b"] == i))["m"]
    bar = lambda i: _first(F.filter("bars", lambda b: F.when(b["kind"] == "sqrt", b["root"]).otherwise(b["r"]) == i))["kind"]

    def node(i: Column) -> Column:
        limit, accent, own = F.get("limit", i), mark(i), F.get("barred", i)
        behind = F.col("brace").isNotNull() & (F.col("brace") != i)
        parent = F.coalesce(limit, accent, own["at"], F.when(behind, F.col("brace")))
        slot = F.when(limit.isNotNull(), F.when(_above(i, limit), "upper").otherwise("lower")).when(accent.isNotNull(), "base").when(own["at"].isNotNull(), own["slot"]).when(behind, "line").otherwise("root")
        accented = F.exists("accents", lambda x: (x["m"] == i) & mark(x["b"]).eqNullSafe(i))
        kind = F.coalesce(F.when(F.col("brace") == i, "cases"), bar(i), F.when(accented, "accent"), F.when(big(i), "operator"), F.when(_p(i)["kind"] == "char", "sign"))
        return F.struct(i.alias("i"), F.coalesce(parent, F.lit(-1)).alias("parent"), slot.alias("slot"), F.when(slot == "line", F.get("line", i)).otherwise(0).alias("line"), kind.alias("kind"))

    rows = rows.withColumn("nodes", F.filter(F.transform("nums", node), lambda n: n["kind"].isNotNull()))
    lone = F.size(F.filter("bars", lambda b: b["kind"].isNull()))
    return rows.select("zone_id", "prims", "nodes", lone.alias("odd"))


def _scripted(zones: DataFrame) -> DataFrame:
    """The same with scripts under their bases: a smaller, moved node belongs to the nearest node on its left that is larger than it and all between."""
    child = lambda n: F.filter("nodes", lambda c: c["parent"] == n["i"])
    size = lambda n: F.when(n["kind"].isin("frac", "bar", "accent"), F.greatest(_p(n["i"])["size"], F.array_max(F.transform(child(n), lambda c: _p(c["i"])["size"])))).otherwise(_p(n["i"])["size"])
    rows = zones.withColumn("nodes", F.transform("nodes", lambda n: F.struct(n["i"].alias("i"), n["parent"].alias("parent"), n["slot"].alias("slot"), n["line"].alias("line"), n["kind"].alias("kind"), size(n).alias("size"))))

    def moved(n: Column) -> Column:
        left = F.filter("nodes", lambda j: (j["parent"] == n["parent"]) & (j["slot"] == n["slot"]) & (j["line"] == n["line"]) & (j["i"] < n["i"]))

        def base(j: Column) -> Column:
            smaller = F.forall(left, lambda k: (k["i"] <= j["i"]) | (k["size"] <= SCRIPT * j["size"]))
            return (n["size"] <= SCRIPT * j["size"]) & smaller & (F.abs(_height(n["i"]) - _height(j["i"])) >= OFF * j["size"])

        found = F.element_at(F.filter(left, base), F.when(F.size(F.filter(left, base)) > 0, -1).otherwise(1))
        return F.when(F.size(F.filter(left, base)) > 0, found)

    def under(n: Column) -> Column:
        def at(bases: Column) -> Column:
            b = _first(bases)
            slot = F.when(b.isNull(), n["slot"]).when(_height(n["i"]) < _height(b["i"]), "sup").otherwise("sub")
            return F.struct(n["i"].alias("i"), F.coalesce(b["i"], n["parent"]).alias("parent"), slot.alias("slot"), F.when(b.isNull(), n["line"]).otherwise(0).alias("line"), n["kind"].alias("kind"))

        return _first(F.transform(F.array(F.array(moved(n))), at))

    return rows.withColumn("nodes", F.array_sort(F.transform("nodes", under)))


def _delimited(zones: DataFrame) -> DataFrame:
    """With pairs, the numbers of delimiters that open or close a group, and those never closed counted in odd: a stack for each row of nodes."""
    row = F.array_sort(F.transform("nodes", lambda n: F.struct(n["parent"].alias("parent"), n["slot"].alias("slot"), n["line"].alias("line"), n["i"].alias("i"), n["kind"].alias("kind"))))
    none = F.array().cast("array<int>")
    start = F.struct(F.lit("").alias("row"), none.alias("stack"), none.alias("pairs"), F.lit(0).alias("odd"))
    closing = F.create_map(*[F.lit(x) for kv in PAIRS.items() for x in kv])

    def step(a: Column, e: Column) -> Column:
        own = F.concat_ws(":", e["parent"].cast("string"), e["slot"], e["line"].cast("string"))
        stack = F.when(a["row"] == own, a["stack"]).otherwise(none)
        lost = F.when(a["row"] == own, 0).otherwise(F.size(a["stack"]))
        ch = F.when(e["kind"] == "sign", _p(e["i"])["ch"])
        top = F.get(stack, F.size(stack) - 1)
        closes = F.coalesce((F.size(stack) > 0) & (F.element_at(closing, _p(top)["ch"]) == ch), F.lit(False))
        new = F.when(ch.isin(*PAIRS), F.array_append(stack, e["i"])).when(closes, F.slice(stack, F.lit(1), F.greatest(F.lit(0), F.size(stack) - 1))).otherwise(stack)
        return F.struct(own.alias("row"), new.alias("stack"), F.when(closes, F.concat(a["pairs"], F.array(top, e["i"]))).otherwise(a["pairs"]).alias("pairs"), (a["odd"] + lost).alias("odd"))

    rows = zones.withColumn("folded", F.aggregate(row, start, step))
    return rows.withColumn("pairs", F.col("folded.pairs")).withColumn("odd", F.col("odd") + F.col("folded.odd") + F.size("folded.stack")).drop("folded")


def _trees(prims: DataFrame) -> DataFrame:
    """zone_id, prims, nodes, pairs, odd of every zone. All is array work inside a row: one shuffle, by zone, and no Python."""
    return _delimited(_scripted(_placed(_barred(_lined(_grouped(prims))))))


def formulas(prims: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Primitives of zones (zone_id, prim_id, kind char or rule, ch, size, box) -> zone_id, latex, confidence, needs_escalation.

    The LaTeX of all nodes is written from those of their children, again and again until the roots are complete: as often as
    there are nodes with children, and once more. Confidence is the share of primitives that fit somewhere.
    """
    signs = F.create_map(*[F.lit(x) for kv in SIGNS.items() for x in kv])
    accents = F.create_map(*[F.lit(x) for kv in ACCENTS.items() for x in kv])

    def written(latex: Column) -> Column:
        def slot(n: Column, name: str, line: Column | None = None) -> Column:
            own = F.filter(latex, lambda x: (x["parent"] == n["i"]) & (x["slot"] == name) & (F.lit(True) if line is None else x["line"] == line))
            return F.trim(F.array_join(F.transform(own, lambda x: x["latex"]), ""))

        def marked(n: Column, name: str, mark: str) -> Column:
            return F.when(F.exists(latex, lambda x: (x["parent"] == n["i"]) & (x["slot"] == name)), F.concat(F.lit(mark + "{"), slot(n, name), F.lit("}"))).otherwise("")

        def node(n: Column) -> Column:
            ch = _p(n["i"])["ch"]
            wrap = lambda head, *parts: F.concat(F.lit(head), *[x for p in parts for x in (F.lit("{"), p, F.lit("}"))])
            numbers = F.array_sort(F.array_distinct(F.transform(F.filter(latex, lambda x: (x["parent"] == n["i"]) & (x["slot"] == "line")), lambda x: x["line"])))
            lines = F.array_join(F.transform(numbers, lambda k: slot(n, "line", k)), r" \\ ")
            sign = F.coalesce(F.element_at(signs, ch), ch)
            sided = F.concat(F.when(ch.isin(*PAIRS), r"\left").otherwise(r"\right"), sign)
            scripts = F.concat(marked(n, "sub", "_"), marked(n, "sup", "^"))
            limits = F.concat(sign, marked(n, "lower", "_"), marked(n, "upper", "^"))
            text = (
                F.when(n["kind"] == "frac", wrap(r"\frac", slot(n, "num"), slot(n, "den")))
                .when(n["kind"] == "sqrt", wrap(r"\sqrt", slot(n, "radicand")))
                .when(n["kind"] == "bar", wrap(r"\bar", slot(n, "base")))
                .when(n["kind"] == "accent", F.concat(F.lit("\\"), F.element_at(accents, ch), F.lit("{"), slot(n, "base"), F.lit("}")))
                .when(n["kind"] == "operator", limits)
                .when(n["kind"] == "cases", F.concat(F.lit(r"\begin{cases}"), lines, F.lit(r"\end{cases}")))
                .when(F.array_contains("pairs", n["i"]), sided)
                .otherwise(sign)
            )
            after = F.when(n["kind"] == "operator", F.concat(text, scripts, F.lit(" "))).otherwise(F.concat(text, scripts))
            return F.struct(n["i"].alias("i"), n["parent"].alias("parent"), n["slot"].alias("slot"), n["line"].alias("line"), n["kind"].alias("kind"), after.alias("latex"))

        return F.transform(latex, node)

    rows = _trees(prims)
    blank = F.transform("nodes", lambda n: F.struct(n["i"].alias("i"), n["parent"].alias("parent"), n["slot"].alias("slot"), n["line"].alias("line"), n["kind"].alias("kind"), F.lit("").alias("latex")))
    turns = F.sequence(F.lit(0), F.size(F.array_distinct(F.transform("nodes", lambda n: n["parent"]))))
    rows = rows.withColumn("done", F.aggregate(turns, blank, lambda a, _: written(a)))
    whole = F.trim(F.array_join(F.transform(F.filter("done", lambda x: x["parent"] == -1), lambda x: x["latex"]), ""))
    sure = F.greatest(F.lit(0.0), 1 - F.col("odd") / F.size("prims"))
    return rows.select("zone_id", whole.alias("latex"), sure.alias("confidence")).withColumn("needs_escalation", F.col("confidence") < threshold)


def formula_nodes(prims: DataFrame) -> DataFrame:
    """The same trees as adjacency rows: zone_id, node_id, parent_id, slot, ord, kind, prim_id; slot is root at the top, ord counts in a slot."""
    nodes = F.transform("nodes", lambda n: F.struct(n["i"].alias("node_id"), F.when(n["parent"] >= 0, n["parent"]).alias("parent_id"), n["slot"].alias("slot"), F.size(F.filter("nodes", lambda m: (m["parent"] == n["parent"]) & (m["slot"] == n["slot"]) & (m["i"] < n["i"]))).alias("ord"), n["kind"].alias("kind"), _p(n["i"])["prim_id"].alias("prim_id")))
    return _trees(prims).select("zone_id", F.explode(nodes).alias("n")).select("zone_id", "n.*")
