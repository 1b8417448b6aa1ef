"""S7.5 and S7.6: formulas that have to fail do, and glyphs are paired one to one."""

import random

import pytest
from pyspark.sql import functions as F

from quire.operators import formula, ledger
from quire.operators.latex import ENVIRONMENTS, ONE, SYMBOLS, TWO, parse_error, parses
from tests.test_operators import ZONE, ZONES

GOOD = [
    r"\frac{a}{b}", r"\frac ab", r"\frac12", "x_{a}^{b}", "x^{b}_a", r"\sqrt[3]{x}", r"\sqrt{x}^2", "[1,2)", r"\left[1\right)", r"\begin{cases}x=1 \\ y=2\end{cases}", r"\begin{array}{cc}1&2\\3&4\end{array}", r"\{a\}", "",
    r"\sum_{i}^{n} x", r"x^\frac{a}{b}", r"\rightarrow", r"\left\{a\right.", r"x_{a_{b}^{c}}^{d}", "(a", "x'^2", "^2", r"\text{if } x", r"\left(x\right)^{2}_1",
]
BAD = {
    r"\frac{a}": "end", r"\left(a": "end", r"\begin{cases}a": "end", "a^^b": "3 ^", r"\end{cases}\begin{cases}": r"1 \end{cases}", "x_{a}_{b}": "6 _", "x^a^b": "4 ^", r"\sqrt[3]": "end", r"\right)": r"1 \right)", r"a \\ b": "3 \\\\", "a & b": "3 &",
    r"\begin{matrix}a\end{cases}": r"3 \end{cases}", r"\boom": r"1 \boom", "{": "end", "}{": "1 }", r"\frac\sqrt{a}{b}": r"2 \sqrt", r"\frac^ab": "2 ^", "x_": "end", "{x_}": "4 }", "a#": "2 #", "\\": "1 \\", r"\sqrt{a}_b^c_d": "9 _",
    r"\begin{foo}\end{foo}": r"1 \begin{foo}", r"\left x": r"1 \left",
}


def test_formulas_that_parse_and_that_do_not(spark):
    texts = [*GOOD, *BAD, None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parses(F.col("t")).alias("ok"), parse_error(F.col("t")).alias("e")).collect()
    assert {r.t: r.ok for r in got} == dict.fromkeys(GOOD, True) | dict.fromkeys(BAD, False) | {None: None}
    assert {r.t: r.e for r in got if r.t in BAD} == BAD


def plain_parse(tokens):
    """A recursive descent reader of the same grammar; raises ValueError where a formula does not parse."""
    at = 0

    def peek():
        while at < len(tokens) and tokens[at].strip() in ("", "~", "'"):
            step()
        return tokens[at] if at < len(tokens) else None

    def step():
        nonlocal at
        at += 1
        return tokens[at - 1]

    def need(token):
        if peek() != token:
            raise ValueError
        step()

    def argument():
        t = peek()
        if t is None or t in ("}", "^", "_", "&", "\\\\") or t.startswith(("\\right", "\\left", "\\begin", "\\end")) or t[1:] in (*ONE, *TWO):
            raise ValueError
        atom()

    def atom(script=False):
        t = peek()
        if t is None or t in ("}", "^", "_", "&", "\\\\") or t.startswith(("\\right", "\\end")):
            raise ValueError
        step()
        if t == "{":
            row("}")
            need("}")
        elif t.startswith("\\left") and t != "\\leftarrow":
            row("right")
            if not (peek() or "").startswith("\\right"):
                raise ValueError
            step()
        elif t.startswith("\\begin"):
            name = t[6:].split("}")[0][1:]
            if name not in ENVIRONMENTS:
                raise ValueError
            row("end", True)
            need(f"\\end{{{name}}}")
        elif t[1:] in ONE and t[0] == "\\":
            if t == "\\sqrt" and peek() == "[":
                step()
                row("]")
                need("]")
            argument()
        elif t[1:] in TWO and t[0] == "\\":
            argument()
            argument()
        elif t[0] == "\\" and t[1:] not in SYMBOLS and t[1:] not in tuple("{}|%$&#_"):
            raise ValueError
        elif t in ("#", "$", "%"):
            raise ValueError

    def row(stop, lines=False):
        while (t := peek()) is not None and t != stop and not t.startswith(f"\\{stop}"):
            if lines and t in ("&", "\\\\"):
                step()
                continue
            if t not in ("^", "_"):
                atom()
            seen = set()
            while peek() in ("^", "_"):
                mark = step()
                if mark in seen:
                    raise ValueError
                seen.add(mark)
                atom(True)

    row("nothing")
    if peek() is not None:
        raise ValueError


def test_random_tokens_against_recursive_descent(spark):
    rnd = random.Random(8)
    kinds = ["a", "1", "{", "}", "{", "}", "^", "_", r"\frac ", r"\sqrt ", r"\hat ", "[", "]", r"\left(", r"\right)", r"\begin{cases}", r"\end{cases}", "&", r"\\", r"\pi ", "{a}", "{b}", r"\boom "]
    rows = [[rnd.choice(kinds) for _ in range(rnd.randint(1, 9))] for _ in range(3_000)]
    rows += [[r"\frac ", "{", *x, "}", "{b}"] for x in rows[:500]]
    got = spark.createDataFrame([(k, "".join(r)) for k, r in enumerate(rows)], "k int, t string").select("k", "t", parses(F.col("t")).alias("ok")).collect()
    for r in got:
        tokens = [t.strip() for t in rows[r.k]]
        flat = [y for t in tokens for y in (["{", t[1], "}"] if t in ("{a}", "{b}") else [t])]
        try:
            plain_parse(flat)
            want = True
        except ValueError:
            want = False
        assert r.ok == want, r.t
    assert 200 < sum(r.ok for r in got) < 3_000


def test_formulas_of_the_tree_parse(spark):
    prims = spark.createDataFrame([(k, *p) for k, parts in enumerate(ZONES.values()) for p in parts], ZONE)
    assert all(r.ok for r in formula.formulas(prims).select(parses(F.col("latex")).alias("ok")).collect())


GLYPH = "zone_id long, prim_id long, ch string, x0 double, top double, x1 double, bottom double"


def fake(latex):
    return [[(c, 10.0 * k, 0.0, 10.0 * k + 10, 10.0) for k, c in enumerate(t)] for t in latex]


def square(zone, i, ch, x):
    return (zone, i, ch, float(x), 0.0, float(x) + 10, 10.0)


def test_round_trip_counts_every_glyph(spark):
    formulas = [(1, "ab"), (2, "xyzzz"), (3, "aa"), (4, "ab"), (5, "a"), (6, ""), (7, "ab"), (9, None)]
    chars = [square(1, 1, "a", 0), square(1, 2, "b", 10), square(2, 1, "x", 0), square(2, 2, "y", 10), square(3, 1, "a", 0), square(3, 2, "a", 0), square(4, 1, "a", 0), square(4, 2, "b", 12), square(5, 1, "c", 0), square(7, 1, "a", 0), square(7, 2, None, 10), square(8, 1, "a", 0)]
    got = ledger.round_trip(spark.createDataFrame(formulas, "zone_id long, latex string"), spark.createDataFrame(chars, GLYPH), fake).collect()
    rows = {r.zone_id: (r.n_pairs, r.n_missing, r.n_shared, r.n_extra, r.ok) for r in got}
    assert rows == {
        1: (2, 0, 0, 0, True), 2: (2, 0, 0, 3, False), 3: (1, 1, 1, 1, False), 4: (2, 0, 0, 0, False), 5: (0, 1, 0, 1, False), 6: (0, 0, 0, 0, True), 7: (1, 1, 0, 1, False), 8: (0, 1, 0, 0, False), 9: (0, 0, 0, 0, True),
    }
    assert {r.zone_id: r.least_iou for r in got}[4] == pytest.approx(8 / 12)
    none = ledger.round_trip(spark.createDataFrame([], "zone_id long, latex string"), spark.createDataFrame([], GLYPH), fake)
    assert none.count() == 0


def plain_pairs(own, made):
    """Rounds of mutual best pairs."""
    def iou(s, t):
        inner = max(0.0, min(s[3], t[3]) - max(s[1], t[1])) * max(0.0, min(s[4], t[4]) - max(s[2], t[2]))
        return inner / (100 + 100 - inner) if s[0] == t[0] else 0.0

    own, made = sorted(own), sorted(made)
    pairs = {(i, j): (-iou(s, t), i, j) for i, s in enumerate(own) for j, t in enumerate(made) if iou(s, t) > 0}
    left, taken = dict(pairs), []
    while left:
        best_s, best_t = {}, {}
        for (i, j), v in left.items():
            best_s[i] = min(best_s.get(i, v), v)
            best_t[j] = min(best_t.get(j, v), v)
        now = [(i, j) for (i, j), v in left.items() if best_s[i] == v == best_t[j]]
        taken += now
        left = {(i, j): v for (i, j), v in left.items() if i not in {a for a, _ in now} and j not in {b for _, b in now}}
    return len(taken), len(own) - len(taken), len(made) - len(taken)


def test_round_trip_against_rounds_of_mutual_best_pairs(spark):
    rnd = random.Random(9)
    zones = [("".join(rnd.choice("aab") for _ in range(rnd.randint(0, 6))), [(rnd.choice("aab"), float(rnd.randint(0, 60)), 0.0) for _ in range(rnd.randint(0, 6))]) for _ in range(120)]
    chars = [square(z, i, c, x) for z, (_, glyphs) in enumerate(zones) for i, (c, x, _) in enumerate(glyphs)]
    got = ledger.round_trip(spark.createDataFrame([(z, t) for z, (t, _) in enumerate(zones)], "zone_id long, latex string"), spark.createDataFrame(chars, GLYPH), fake)
    for r in got.collect():
        text, glyphs = zones[r.zone_id]
        want = plain_pairs([(c, x, y, x + 10, y + 10) for c, x, y in glyphs], fake([text])[0])
        assert (r.n_pairs, r.n_missing, r.n_extra) == want
