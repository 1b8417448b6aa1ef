"""A recursive XY-cut of pages: all pages of an Arrow batch are cut at once, in numpy."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F


def _less(a: np.ndarray, b: np.ndarray | float) -> np.ndarray:
    """a < b as Spark has it: NaN is the largest number."""
    return (a < b) | (np.isnan(b) & ~np.isnan(a))


def _highest(values: np.ndarray, run: np.ndarray) -> np.ndarray:
    """The running maximum inside each run; runs are numbered in ascending order. Ranks are added to them, not values, so nothing is rounded."""
    order = np.argsort(values)
    rank = np.empty(len(values), np.int64)
    rank[order] = np.arange(len(values))
    base = run * len(values)
    return values[order[np.maximum.accumulate(base + rank) - base]]


def _spread(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the n places from `first` on: the row and the place of each."""
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(len(row)) - (np.cumsum(n) - n - first)[row]


def _shared(first: np.ndarray, n: np.ndarray, gaps: tuple[np.ndarray, np.ndarray, np.ndarray], gutter: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Strips of each region from the top down: whether one goes on with the part above, and the gaps of each part with its last strip.

    Regions take turns strip by strip, those with most strips first, so that a turn's cost is that of the regions which still have one.
    """
    strip, low, high = gaps
    per = np.bincount(strip, minlength=int(n.sum()))
    at = np.cumsum(per) - per
    most = np.argsort(-n, kind="stable")
    first, n = first[most], n[most]
    joins = np.zeros(len(per), bool)
    held = per[first]
    own, g = _spread(at[first], held)
    a, b = low[g], high[g]
    out = []
    for k in range(1, int(n[0])):
        live = int(np.searchsorted(-n, -k))
        over = own >= live
        out.append(((first + n - 1)[own[over]], a[over], b[over]))
        own, a, b = own[~over], a[~over], b[~over]
        s = first[:live] + k
        row, g = _spread(at[s[own]], per[s[own]])
        lo, hi = np.maximum(a[row], low[g]), np.fmin(b[row], high[g])
        wide = ~_less(hi - lo, gutter)
        both = own[row[wide]]
        n_both = np.bincount(both, minlength=live)
        same = (n_both > 0) | ((held[:live] == 0) & (per[s] == 0))
        joins[s[same]] = True
        ends = ~same[own]
        out.append((s[own[ends]] - 1, a[ends], b[ends]))
        new = np.flatnonzero(~same)
        row, g = _spread(at[s[new]], per[s[new]])
        own, a, b = np.concatenate((both, new[row])), np.concatenate((lo[wide], low[g])), np.concatenate((hi[wide], high[g]))
        held = np.where(same, n_both, per[s])
    out.append(((first + n - 1)[own], a, b))
    return joins, *(np.concatenate(x) for x in zip(*out, strict=True))


def _cut(region: np.ndarray, top: np.ndarray, x0: np.ndarray, x1: np.ndarray, bottom: np.ndarray, gutter: float, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """Boxes by region (0, 1, ...) and top -> the column of each, numbered through all regions, and the first column of each region, with their number at the end."""
    begin = np.flatnonzero(np.diff(region, prepend=-1))
    left, right = np.fmin.reduceat(x0, begin), np.maximum.reduceat(x1, begin)
    # strips: no box begins above the lowest end before it
    opens = ~_less(top, np.roll(_highest(bottom, region), 1) - slack)
    opens[begin] = True
    first, strip = np.flatnonzero(opens), np.cumsum(opens) - 1
    home = region[first]
    # gaps of each strip, from side to side
    by_x = np.lexsort((x1, x0, strip))
    end = _highest(np.maximum(x1[by_x], left[region]), strip)
    before = np.roll(end, 1)
    before[first] = left[home]
    last = end[np.append(first[1:], len(strip)) - 1]
    inside, tail = np.flatnonzero(~_less(x0[by_x] - before, gutter)), np.flatnonzero(~_less(right[home] - last, gutter))
    gaps = np.concatenate((strip[inside], tail)), np.concatenate((before[inside], last[tail])), np.concatenate((x0[by_x][inside], right[home][tail]))
    by_strip = np.argsort(gaps[0], kind="stable")
    joins, ends, a, b = _shared(strip[begin], np.bincount(home), tuple(x[by_strip] for x in gaps), gutter)
    # parts: a gap counts that has boxes on both sides
    part, head = (np.cumsum(~joins) - 1)[strip], first[~joins]
    own = part[first][ends]
    inner = ~_less(a, np.fmin.reduceat(x1, head)[own]) & ~_less(np.maximum.reduceat(x0, head)[own], b)
    own, b = own[inner], b[inner]
    n = np.bincount(own, minlength=len(head))
    # parts of one column each, one below the other, are one
    one, of = n == 0, region[head]
    again = np.append(False, one[1:] & one[:-1] & (of[1:] == of[:-1]))
    total = np.cumsum(np.where(again, 0, n + 1))
    column = (total - n - 1)[part]
    starts = np.append(column[begin], total[-1])
    b = b[np.argsort(own, kind="stable")]
    split = np.flatnonzero(n[part] > 0)
    row, g = _spread((np.cumsum(n) - n)[part[split]], n[part[split]])
    column[split] += np.bincount(row[~_less(x0[split][row], b[g])], minlength=len(split))
    return column, starts


def _regions(page: np.ndarray, sides: list[np.ndarray], gutter: float, slack: float, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Boxes by page and top -> the region of each, from 1 on in its page, and the number of regions by page. Pages that a turn leaves as they are are done."""
    number, regions = np.ones(len(page), np.int64), np.zeros(int(page[-1]) + 1, np.int64)
    regions[page] = 1
    left = np.arange(len(page))
    region = np.cumsum(np.diff(page, prepend=page[0]) > 0)
    for _ in range(depth):
        column, starts = _cut(region, *(x[left] for x in sides), gutter, slack)
        of = page[left][np.flatnonzero(np.diff(region, prepend=-1))]
        turn = np.flatnonzero(np.diff(of, prepend=-1))
        base, n = starts[turn], np.diff(starts[np.append(turn, len(of))])
        own = np.repeat(np.arange(len(turn)), np.bincount(page[left])[of[turn]])
        number[left], regions[of[turn]] = column - base[own] + 1, n
        more = np.flatnonzero((n > np.diff(np.append(turn, len(of))))[own])
        if not len(more):
            break
        more = more[np.argsort(column[more], kind="stable")]
        left, region = left[more], np.cumsum(np.diff(column[more], prepend=column[more[0]]) > 0)
    return number, regions


def xy_cut(gutter: float, slack: float, depth: int) -> Callable[..., Column]:
    """A function of arrays top, x0, x1, bottom and line_no of a page: (at, region_no) of its boxes in reading order; boxes with a null side follow as they are."""

    @F.arrow_udf("array<struct<at:int,region_no:int>>")
    def cut(top: pa.Array, x0: pa.Array, x1: pa.Array, bottom: pa.Array, line_no: pa.Array) -> pa.Array:
        sizes = top.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        page, at = _spread(np.zeros(len(sizes), np.int64), sizes)
        flat = [x.flatten() for x in (top, x0, x1, bottom)]
        lost = np.logical_or.reduce([x.is_null().to_numpy(zero_copy_only=False) for x in flat])
        sides = [x.to_numpy(zero_copy_only=False) for x in flat]
        line = line_no.flatten().fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
        region = np.ones(len(page), np.int64)
        whole = np.flatnonzero(~lost)
        whole = whole[np.lexsort((line[whole], sides[1][whole], sides[0][whole], page[whole]))]
        regions = np.zeros(len(sizes), np.int64)
        if len(whole):
            with np.errstate(invalid="ignore"):
                region[whole], found = _regions(page[whole], [x[whole] for x in sides], gutter, slack, depth)
            regions[: len(found)] = found
        rest = np.flatnonzero(lost)
        region[rest] = regions[page[rest]] + 1
        order = np.concatenate((whole, rest))
        order = order[np.lexsort((region[order], page[order]))]
        made = pa.StructArray.from_arrays([pa.array(x[order].astype(np.int32)) for x in (at, region)], ["at", "region_no"])
        return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), made)

    return cut
