"""Glyphs of whole pages as flat numpy arrays: plain texts in a fixed grid, and what lines and counts of pages are made of."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from quire.functions.xycut import _highest, _spread

#: Bytes of the pages that are laid out at once; a larger page is laid out alone.
BYTES = 1 << 17


@dataclass(frozen=True)
class Glyphs:
    """Characters of pages: the page of each (ascending from 0), its code point, number, size and box; and of each page its row in the batch and its number."""

    page: np.ndarray
    ch: np.ndarray
    prim_id: np.ndarray
    size: np.ndarray
    x0: np.ndarray
    top: np.ndarray
    x1: np.ndarray
    bottom: np.ndarray
    row: np.ndarray
    page_no: np.ndarray

    def place(self) -> tuple[np.ndarray, ...]:
        """What glyphs are sorted by inside a level, the first first."""
        return self.x0, self.prim_id, self.ch, self.size, self.x1, self.top, self.bottom


def _text_lines(texts: pa.ListArray) -> tuple[np.ndarray, ...]:
    """All bytes of the texts, and of each line that is not empty: row, number, first byte and end."""
    values = texts.flatten().fill_null("").cast(pa.large_string())
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(data or b"", np.uint8)
    breaks = np.flatnonzero(data[offsets[0] : offsets[-1]] == 10) + offsets[0]
    text = np.searchsorted(offsets[1:], breaks, side="right")  # of each break
    n = 1 + np.bincount(text, minlength=len(values))
    first = np.cumsum(n) - n
    starts, ends = np.empty(int(n.sum()), np.int64), np.empty(int(n.sum()), np.int64)
    after = np.arange(len(breaks)) + text + 1
    starts[first], ends[first + n - 1] = offsets[:-1], offsets[1:]
    starts[after], ends[after - 1] = breaks + 1, breaks
    row = np.repeat(np.repeat(np.arange(len(texts)), texts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)), n)
    own, line_no = _spread(np.zeros(len(n), np.int64), n)
    full = np.flatnonzero(ends > starts)
    return data, row[full], line_no[full], starts[full], ends[full]


def laid_out(texts: pa.ListArray, step: float, leading: float, page_lines: int, most: int = BYTES) -> Iterator[Glyphs]:
    """The texts of each row in a fixed grid from its first page on, so texts of one row lie on each other; some pages at a time.

    Line feeds end lines and are no glyphs; pages without a glyph are left out. A glyph's number is that of its line times a million, plus its column.
    """
    if not len(texts.flatten()):
        return
    data, row, line_no, starts, ends = _text_lines(texts)
    page_no = line_no // page_lines
    order = np.lexsort((page_no, row))
    row, page_no, line_no, starts, ends = (x[order] for x in (row, page_no, line_no, starts, ends))
    turn = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (page_no[1:] != page_no[:-1])))[: len(row)])
    bytes_ = np.append(0, np.cumsum(ends - starts))
    before, turns = bytes_[np.append(turn, len(row))], np.append(turn, len(row))
    p = 0
    while p < len(turn):
        q = max(p + 1, int(np.searchsorted(before, before[p] + most, side="right")) - 1)
        lines = slice(turns[p], turns[q])
        n = ends[lines] - starts[lines]
        flat = data[_spread(starts[lines], n)[1]]
        if flat.max() < 0x80:
            ch = flat.astype(np.uint32)
        else:
            n = np.add.reduceat((flat & 0xC0) != 0x80, np.cumsum(n) - n, dtype=np.int64)
            ch = np.frombuffer(flat.tobytes().decode().encode("utf-32-le"), np.uint32)
        line, col = _spread(np.zeros(len(n), np.int64), n)
        page = np.repeat(np.arange(q - p), np.diff(turns[p : q + 1]))
        high = line_no[lines] % page_lines * leading
        x0 = col * step
        yield Glyphs(page[line], ch, (line_no[lines] * 1_000_000)[line] + col, np.full(len(ch), leading), x0, high[line], x0 + step, (high + leading)[line], row[turn[p:q]], page_no[turn[p:q]])
        p = q


def _sorted(keys: tuple[np.ndarray, ...]) -> bool:
    """Whether rows are in ascending order of the keys, the first first."""
    tied = np.ones(max(0, len(keys[0]) - 1), bool)
    for key in keys:
        if (tied & (key[1:] < key[:-1])).any():
            return False
        tied &= key[1:] == key[:-1]
        if not tied.any():
            break
    return True


def line_runs(glyphs: Glyphs, gap: float, gutter: float | None) -> tuple[np.ndarray, ...]:
    """Lines of all pages, as line_clusters() has them: page, number in the page, characters, x0, top, x1, bottom, code points (flat)."""
    page, middle, place = glyphs.page, (glyphs.top + glyphs.bottom) / 2, glyphs.place()
    if not _sorted((page, middle, *place)):
        order = np.lexsort((*reversed(place), middle, page))
        page, middle, place = page[order], middle[order], tuple(x[order] for x in place)
    below = (middle[1:] != middle[:-1]) & (middle[1:] - middle[:-1] > gap * place[3][1:])  # a level's size is that of its first character
    at = np.flatnonzero(np.concatenate(([True], below | (page[1:] != page[:-1]))))
    n = np.diff(np.append(at, len(page)))
    sizes = place[3][at]
    several = np.flatnonzero(middle[at] != middle[at + n - 1])
    if len(several):  # a line of several levels is sorted again as one
        line, where = _spread(at[several], n[several])
        own = where[np.lexsort((*(x[where] for x in reversed(place)), line))]
        place = tuple(x.copy() for x in place)
        for x in place:
            x[where] = x[own]
    x0, _, ch, _, x1, top, bottom = place
    if gutter is not None:
        line = np.repeat(np.arange(len(at)), n)
        far = x0[1:] - _highest(x1, line)[:-1] > gutter * sizes[line[1:]]
        starts = np.concatenate(([True], far | (line[1:] != line[:-1])))
        at = np.flatnonzero(starts)
        n = np.diff(np.append(at, len(page)))
    of = page[at]
    turn = np.flatnonzero(np.diff(of, prepend=-1))
    number = np.arange(len(at)) - np.repeat(turn, np.diff(np.append(turn, len(at)))) + 1
    return of, number, n, np.minimum.reduceat(x0, at), np.minimum.reduceat(top, at), np.maximum.reduceat(x1, at), np.maximum.reduceat(bottom, at), ch


def strings(ch: np.ndarray, n: np.ndarray) -> pa.StringArray:
    """Strings of n code points each."""
    width = 1 + (ch >= 0x80).astype(np.int64) + (ch >= 0x800) + (ch >= 0x10000)
    offsets = np.append(0, np.cumsum(np.add.reduceat(width, np.cumsum(n) - n)))
    return pa.StringArray.from_buffers(len(n), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(ch.astype("<u4").tobytes().decode("utf-32-le").encode()))


def _away(values: np.ndarray) -> np.ndarray:
    """Rounded to whole numbers as Spark does it, halves away from zero; no negative zero."""
    return np.copysign(np.floor(np.abs(values) + 0.5), values) + 0.0


def repeats(glyphs: Glyphs, epsilon: float) -> np.ndarray:
    """Of each page the glyphs that have the character and place (to `epsilon`) of another, but one of each."""
    keys = [glyphs.ch, _away(glyphs.x0 / epsilon), _away(glyphs.top / epsilon)]
    mixed = glyphs.page.astype(np.uint64)
    for key in keys:
        mixed = (mixed ^ key.astype(np.float64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    mixed.sort()
    pages = len(glyphs.row)
    if not (mixed[1:] == mixed[:-1]).any():  # equal glyphs have equal hashes
        return np.zeros(pages, np.int64)
    keys = [glyphs.page, *keys]
    order = np.lexsort(keys[::-1])
    same = np.logical_and.reduce([k[order][1:] == k[order][:-1] for k in keys])
    return np.bincount(glyphs.page[order][1:][same], minlength=pages)
