"""Periodic runs in sequences of words, found with longest common extensions.

A run is a stretch of smallest period q and at least four periods (and six words) that neither
neighbour extends. Words of several texts are laid in a row, each text between marks of its own, and
all steps work on whole rows at once.

1. A difference cover holds, for any two places, an equal shift to places that are both in it. Only
   the suffixes at covered places are sorted: by as many words as the cover's period, then by
   doubling. The names of the doubled lengths give the common prefixes of neighbours.
2. The common extension of two places compares the few words up to the synchronised places, and
   then asks a sparse table for the smallest common prefix between their ranks.
3. A run of period q holds a place of the grid 0, 3q, 6q, ... together with the place q later, so
   all periods take n/3 + n/6 + n/9 + ... pairs. Extensions to both sides give the whole run.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, table, text_slices

#: A difference cover of 31: every difference of residues occurs.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
#: Characters of texts in a row, and pairs of the grid at once.
AT_ONCE, PAIRS = 2_000_000, 2_000_000
#: Periods in a run, words in a run, and the grid's step in periods.
TIMES, LEAST, STEP = 4, 6, 3
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


@functools.lru_cache(maxsize=1)
def _cover() -> tuple[np.ndarray, np.ndarray]:
    """The rank of a residue among the covered ones (or -1), and the least shift of two residues to covered ones."""
    rank = np.full(PERIOD, -1, np.int64)
    rank[list(COVER)] = np.arange(len(COVER))
    shift = np.full((PERIOD, PERIOD), -1, np.int64)
    for k in reversed(range(PERIOD)):
        there = rank[(np.arange(PERIOD) + k) % PERIOD] >= 0
        shift[np.ix_(there, there)] = k
    assert (shift >= 0).all()
    return rank, shift


def _groups(rank: np.ndarray, key: np.ndarray, active: np.ndarray) -> np.ndarray:
    """Orders the active places within their ranks by key; returns the places that are still tied."""
    sort = np.lexsort((key, rank[active]))
    order, by = active[sort], key[sort]
    old = rank[order]
    first = np.ones(len(order), bool)
    first[1:] = old[1:] != old[:-1]
    at = np.arange(len(order))
    begin = np.maximum.accumulate(np.where(first, at, 0))
    fresh = first.copy()
    fresh[1:] |= by[1:] != by[:-1]
    new = np.maximum.accumulate(np.where(fresh, at, 0))
    rank[order] = old + new - begin
    single = fresh & np.concatenate([fresh[1:], [True]])
    return order[~single]


class Extensions:
    """Longest common extensions to the right in an array of positive numbers.

    Two places are only asked for if a number that occurs once stands behind the later one.
    """

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.words = np.concatenate([words, np.zeros(2 * PERIOD, words.dtype)])
        rank, self.shift = _cover()
        self.row = rank
        places = np.arange(n)
        places = places[rank[places % PERIOD] >= 0]
        self.names: list[np.ndarray] = []
        self._sort(places, n)
        self._prefixes(places)

    def _sample(self, place: np.ndarray) -> np.ndarray:
        """The number of a covered place among all covered ones."""
        return place // PERIOD * len(COVER) + self.row[place % PERIOD]

    def _sort(self, places: np.ndarray, n: int) -> None:
        m = len(places)
        bits = int(self.words.max(initial=1)).bit_length()
        together = 62 // bits
        rank, active = np.zeros(m, np.int64), np.arange(m)
        for at in range(0, PERIOD, together):
            if not len(active):
                break
            key = np.zeros(len(active), np.int64)
            for k in range(at, min(at + together, PERIOD)):
                key = key << bits | self.words[places[active] + k]
            active = _groups(rank, key, active)
        self.names.append(rank.copy())
        length = PERIOD
        while len(active):
            ahead = places[active] + length
            inside = ahead < n
            key = np.full(len(active), -1, np.int64)
            key[inside] = self.names[-1][self._sample(ahead[inside])]
            active = _groups(rank, key, active)
            self.names.append(rank.copy())
            length *= 2
        self.rank = rank

    def _prefixes(self, places: np.ndarray) -> None:
        """The sparse table of the common prefixes of neighbours in the order of suffixes."""
        m, n = len(places), len(self.words) - 2 * PERIOD
        order = np.empty(m, np.int64)
        order[self.rank] = places
        x, y = order[:-1].copy(), order[1:].copy()
        done = np.zeros(max(m - 1, 0), np.int64)
        for k in reversed(range(len(self.names))):
            a, b = x + done, y + done
            inside = np.flatnonzero((a < n) & (b < n))
            name = self.names[k]
            same = inside[name[self._sample(a[inside])] == name[self._sample(b[inside])]]
            done[same] += PERIOD << k
        done += self._compared(x + done, y + done, np.full(len(done), PERIOD))
        self.least = [done]
        while 2 << (len(self.least) - 1) <= len(done):
            last, half = self.least[-1], 1 << (len(self.least) - 1)
            self.least.append(np.minimum(last[:-half], last[half:]))
        del self.names

    def _compared(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from x and y on, up to ``most``, word by word."""
        out = np.minimum(most, PERIOD)
        active = np.flatnonzero(most > 0)
        for k in range(int(most.max(initial=0))):
            active = active[most[active] > k]
            if not len(active):
                break
            same = self.words[x[active] + k] == self.words[y[active] + k]
            out[active[~same]] = k
            active = active[same]
        return out

    def of(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words from x on equal those from y on; x < y everywhere or y < x everywhere."""
        shift = self.shift[x % PERIOD, y % PERIOD]
        out = self._compared(x, y, shift)
        on = np.flatnonzero(out == shift)
        a, b = (self.rank[self._sample(z[on] + shift[on])] for z in (x, y))
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            out[on[at]] += np.minimum(self.least[k][low[at]], self.least[k][high[at] - (1 << k)])
        return out


def runs(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, start, length, period) of every run, by sequence, start and period; numbers are positive."""
    n = np.array([len(s) for s in sequences], np.int64)
    top = max((int(s.max(initial=0)) for s in sequences), default=0)
    marks = top + 1 + np.arange(len(sequences) + 1)
    words = np.concatenate([np.array([marks[0]]), *(x for s, m in zip(sequences, marks[1:]) for x in (s, np.array([m])))]).astype(np.int64)
    offset = 1 + np.cumsum(n + 1) - (n + 1)
    none = (np.zeros(0, np.int64),) * 4
    most = np.where(n >= LEAST, n // TIMES, 0)
    if not most.sum():
        return none
    right, left = Extensions(words), Extensions(words[::-1].copy())
    # Every pair of a sequence and a period, and the number of its places on the grid.
    of = np.repeat(np.arange(len(n)), most)
    q = np.arange(len(of)) - np.repeat(np.cumsum(most) - most, most) + 1
    size = -(-(n[of] - q) // (STEP * q))
    done = np.concatenate([[0], np.cumsum(size)])
    found, at = [], 0
    while at < len(of):
        stop = max(at + 1, int(np.searchsorted(done, done[at] + PAIRS, side="right")) - 1)
        each = np.repeat(np.arange(at, stop), size[at:stop])
        i = offset[of[each]] + (np.arange(done[at], done[stop]) - done[each]) * STEP * q[each]
        hit = np.flatnonzero(words[i] == words[i + q[each]])
        i, each = i[hit], each[hit]
        period = q[each]
        ahead = right.of(i, i + period)
        last = len(words) - 1
        behind = left.of(last - (i - 1), last - (i + period - 1))
        length = ahead + behind + period
        good = length >= np.maximum(LEAST, TIMES * period)
        found.append(np.stack([of[each], i - behind, length, period])[:, good])
        at = stop
    doc, start, length, period = np.concatenate(found, axis=1)
    # A stretch is found for every multiple of its smallest period too.
    order = np.lexsort((period, length, start))
    doc, start, length, period = (x[order] for x in (doc, start, length, period))
    first = np.ones(len(doc), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    doc, start, length, period = (x[first] for x in (doc, start, length, period))
    order = np.lexsort((period, start))
    return doc[order], (start - offset[doc])[order], length[order], period[order]


def find_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_runs``, ``start``, ``length``, ``period`` of the longest run, ``runs`` and ``collapsed``.

    Words are parted by spaces and the characters from tab to carriage return. ``runs`` lists every
    run (start, length, period) by start, then period; the longest is the first of the greatest length,
    then of the smallest start, then period; without a run it has three nulls. ``collapsed`` joins by
    single spaces the words that no run contains behind its first period. Null and empty texts have
    no words: no runs and an empty text. Repeated rows each get their result, an empty table gives an
    empty one; columns of the input that bear one of the new names give way.
    """
    new = [T.StructField("n_runs", T.LongType()), *RUN.fields, T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]
    kept = [c for c in docs.columns if c not in {f.name for f in new}]
    schema = T.StructType([docs.schema[c] for c in kept] + new)
    given = docs.select(*(F.col(f"`{c}`") for c in kept), *([] if text in kept else [F.col(f"`{text}`")]))
    at = given.columns.index(text)

    def run(batches):
        for part in text_slices(batches, at, AT_ONCE):
            columns = _found([(t or "").encode().split() for t in part.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *columns], names=[f.name for f in schema.fields])

    return given.mapInArrow(run, schema)


def _found(texts: list[list[bytes]]) -> list[pa.Array]:
    """The new columns for texts as lists of words."""
    n = np.array([len(t) for t in texts], np.int64)
    flat = [w for t in texts for w in t]
    names = dict(zip(dict.fromkeys(flat), range(1, len(flat) + 1)))
    ids = np.array(list(map(names.__getitem__, flat)), np.int64)
    offset = np.cumsum(n) - n
    doc, start, length, period = runs(np.split(ids, offset[1:]) if len(n) else [])
    change = np.zeros(len(ids) + 1, np.int64)
    np.add.at(change, offset[doc] + start + period, 1)
    np.add.at(change, offset[doc] + start + length, -1)
    gone = np.cumsum(change)[:-1] > 0
    edges = np.searchsorted(doc, np.arange(len(n) + 1))
    longest = np.full(len(n), -1, np.int64)
    order = np.lexsort((period, start, -length, doc))
    longest[doc[order[::-1]]] = order[::-1]
    has = longest >= 0
    first = [pa.array(np.where(has, x[longest] if len(x) else 0, 0), mask=~has) for x in (start, length, period)]
    listed = pa.ListArray.from_arrays(
        pa.array(edges.astype(np.int32)), pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], names=list(RUN.names))
    )
    touched = set(np.unique(doc).tolist())
    lost = gone.tolist() if touched else []
    collapsed = [
        b" ".join(w for w, x in zip(t, lost[o : o + len(t)]) if not x) if k in touched else b" ".join(t)
        for k, (t, o) in enumerate(zip(texts, offset.tolist()))
    ]
    return [pa.array(np.diff(edges).astype(np.int64)), *first, listed, pa.array([c.decode() for c in collapsed], pa.string())]


def _planted(ids, texts):
    """The texts with a stretch made periodic where the checksum of the id says so."""
    out = []
    for i, t in zip(ids.to_pylist(), texts.to_pylist()):
        h = zlib.crc32(str(i).encode())
        if i is not None and t and h % 10 == 0 and (words := t.encode().split()):
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            t = b" ".join(words[k] if k < a else words[a + (k - a) % p] for k in range(n)).decode()
        out.append(t)
    return [pa.array(out, pa.string())]


def op12_periodic_runs(spark, sf_dir) -> DataFrame:
    """Periodic runs of all ``documents``, a tenth of which is made periodic first."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = add_columns(docs, ["doc_id", "text"], [T.StructField("text", T.StringType())], _planted)
    found = find_runs(docs)
    line = F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in RUN.names)))
    return found.select(
        "doc_id", "n_runs", "start", "length", "period",
        F.expr("1000 * length div period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
