"""Pairs of individuals with close times, found batch by batch within a cell of individuals.

A cell holds the points (individual, time) of two groups of individuals, or of one group with itself.
"""

from __future__ import annotations

import itertools
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# The functions travel to the workers with the job, so the workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# About so many pairs of points are held at once.
HELD_PAIRS = 1_000_000


def pairs_of_cells(delta: int, groups: int):
    """For ``mapInArrow`` on rows sorted by ``cell``: each pair ``x``, ``y`` once, with the number ``n`` of
    time columns ``var`` in which a gap of at most ``delta`` occurs."""

    def run(batches):
        held, at = [], None
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(cells)) + 1), len(cells)]
            for low, high in itertools.pairwise(cuts):
                if high > low and cells[low] != at:
                    yield from close_pairs(held, delta, at, groups)
                    held, at = [], cells[low]
                held.append(batch.slice(low, high - low))
        yield from close_pairs(held, delta, at, groups)

    return run


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values in order, each once, and how often it came."""
    values = np.sort(values)
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1])[: len(values)])
    return values[starts], np.diff(np.append(starts, len(values)))


def close_pairs(batches: list, delta: int, cell: int | None, groups: int):
    """The pairs of one cell, made for a stretch of its first group's individuals at a time."""
    if not batches:
        return
    table = pa.Table.from_batches(batches)
    who = table["who"].combine_chunks().dictionary_encode()
    names, codes = who.dictionary, who.indices.to_numpy().astype(np.int64)
    times, var, second = (table[c].to_numpy() for c in ("t", "var", "second"))
    alone = cell // groups == cell % groups
    mine, others = np.flatnonzero(~second), np.flatnonzero(second | alone)
    mine = mine[np.argsort(codes[mine], kind="stable")]
    others = others[np.lexsort((times[others], var[others]))]
    # Each row of the first group is close to the rows from low to high of the other.
    low, high = np.zeros(len(mine), np.int64), np.zeros(len(mine), np.int64)
    seen = np.unique(var)
    for v in seen:
        start, end = np.searchsorted(var[others], [v, v + 1])
        rows, there = var[mine] == v, times[others[start:end]]
        low[rows] = start + np.searchsorted(there, times[mine[rows]] - delta, "left")
        high[rows] = start + np.searchsorted(there, times[mine[rows]] + delta, "right")
    own, theirs = codes[mine] * len(names), codes[others]
    met = np.concatenate([[0], np.cumsum(np.maximum(high - low, 0))])
    last = np.append(np.flatnonzero(np.diff(codes[mine])) + 1, len(mine))  # ends of individuals
    begin = 0
    while begin < len(mine):
        fits = np.searchsorted(met[last], met[begin] + HELD_PAIRS, "right")
        end = last[max(fits - 1, np.searchsorted(last, begin, "right"))]
        sizes = np.diff(met[begin : end + 1])
        place = np.arange(met[begin], met[end]) + np.repeat(low[begin:end] - met[begin:end], sizes)
        right = theirs[place]
        pairs = np.repeat(own[begin:end], sizes) + right
        kept = pairs // len(names) < right if alone else slice(None)
        pairs = pairs[kept]
        if len(seen) > 1:
            which = np.repeat(var[mine[begin:end]], sizes)[kept]
            pairs = np.concatenate([_distinct(pairs[which == v])[0] for v in seen])
        found, n = _distinct(pairs)
        if len(seen) == 1:
            n = np.ones(len(found), np.int64)
        if len(found):
            x, y = names.take(pa.array(found // len(names))), names.take(pa.array(found % len(names)))
            yield pa.RecordBatch.from_arrays([x, y, pa.array(n, pa.int64())], names=["x", "y", "n"])
        begin = end
