"""Anchors of long windows: which suffixes of a text its sparse suffix array holds.

Of the ``GRAM``-byte strings inside a window of ``LENGTH`` bytes, the one with the smallest
hash (the first of equal ones) is the window's anchor. It depends on the window's bytes
alone, so equal windows have equal anchors at equal distance wherever they stand, and only
suffixes that start at anchors need to be sorted and compared. Neighbouring windows mostly
share their anchor and make a run.
"""

from __future__ import annotations

import numpy as np

from linkstats.llm import wordhash as wh

LENGTH, GRAM = 200, 64
_PLACE_BITS = np.uint64(31)
BLOCK_BYTES = 1 << 20


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """min(x[i:i + n]) for every i, from running minima within stretches of n."""
    size = -(-len(x) // n) * n
    padded = np.full(size, ~np.uint64(0))
    padded[:len(x)] = x
    grid = padded.reshape(-1, n)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:len(x) - n + 1], left[n - 1:len(x)])


def runs_of(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(row, first window, last window, anchor, sums) of rows laid end to end; places are
    within ``data``, and every window lies in one row."""
    sums = wh.running_sums(data)
    none = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return none, none, none, none, sums
    h = wh.gram_hashes(sums, gram)
    keyed = ((h >> _PLACE_BITS) << _PLACE_BITS) | np.arange(len(h), dtype=np.uint64)
    anchor = (sliding_min(keyed, length - gram + 1) & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
    windows = len(data) - length + 1
    change = np.zeros(windows + 1, dtype=np.int64)  # windows that cross the end of a row are out
    ends = offsets[1:-1]
    np.add.at(change, np.clip(ends - length + 1, 0, windows), 1)
    np.add.at(change, np.clip(ends, 0, windows), -1)
    inside = np.cumsum(change[:-1]) == 0
    at = np.flatnonzero(inside)
    if not len(at):
        return none, none, none, none, sums
    row = np.searchsorted(offsets, at, side="right") - 1
    first = np.flatnonzero(np.concatenate([[True], (anchor[at[1:]] != anchor[at[:-1]]) | (row[1:] != row[:-1])]))
    last = np.append(first[1:], len(at)) - 1
    return row[first], at[first], at[last], anchor[at[first]], sums
