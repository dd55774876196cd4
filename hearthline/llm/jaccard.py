"""Exact n-gram Jaccard join in the metric space of shingle sets.

The Jaccard distance is a metric, so distances to pivots bound distances between documents. Two
facts of this space shape the join. Unrelated documents are all at distance 1 from one another and
from any pivot, so pivots alone cannot part them: seed regions are found first. And documents
within the radius of a pivot are linked to it, so they need not be compared with each other.

1. Seed regions. With all shingles in one order (those of few documents first, then by hash), two
   sets of the wanted similarity share a shingle in short prefixes. The documents that hold a
   shingle in their prefix are a seed region; every link lies within one.
2. A region takes its most central document as pivot; later rounds take several. Members within the
   radius of a pivot, its ball, are linked to it. The cell of a pivot is its ball and what lies within
   two radii; the members outside all balls share a cell. By the triangle inequality no link runs
   between members that share no cell. Cells whose members the links found so far connect are done,
   pivots have met all and leave, and the other cells are joined again, around new pivots.
3. Regions of few open pairs are compared in blocks of members: a task holds two blocks and gives only the pairs
   that their histograms allow. So is what is left once the cells of a round are no smaller than its regions.
4. Components of the links give the groups.

Distances are measured exactly, on the sets of hashes, unless the sizes of two sets or their counts
by cell of the hash space already keep them from linking.

Every document takes part whole and no region is capped: a common shingle is only placed late in
the order. The shingles move between tasks as packed arrays.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .common import discard, table, written
from .shingles import digest, mixed, shingle_set

#: A shingle of more documents than this is placed late in the order; where that are too many, twice as many, and so on.
COMMON = 2
#: The list of common shingles is broadcast; it is kept to so many by raising the bar.
MAX_COMMON = 2_000_000
#: Packed records that a task holds before it hands them on.
FLUSH = 1_000_000
#: Rows of an Arrow batch, as they hold whole texts or sets.
BATCH = 1_000
#: Rows of an Arrow batch that hold two sets each.
SET_PAIRS = 128
#: Pivots of a region after the first round.
PIVOTS = 2
#: Open pairs of a region that are few, as its blocks are compared in less time than a round takes.
SMALL = 1_000_000
#: Sets of more hashes have histograms that tell little: few open pairs are then that many fewer.
LONG, FEWER = 4_096, 50
#: Rounds after which what is left is compared in blocks of members, the members of a block, and rows that hold two blocks.
ROUNDS, BLOCK, BLOCK_PAIRS = 6, 512, 16
#: Cells of a set's histogram; a power of two.
CELLS = 256
_U = np.uint64


def _parts(spark) -> int:
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def _placed(h: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Part of every hash, and its 32-bit place in the part; both grow with the hash."""
    scaled = (h >> _U(32)) * _U(parts)
    return (scaled >> _U(32)).astype(np.int64), (scaled & _U(0xFFFFFFFF)).astype(np.uint32)


def _planes(*columns: np.ndarray) -> bytes:
    """Bytes of little-endian columns, plane by plane: the shuffle's compression takes the slow-changing ones away."""
    return b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns)


def _columns(blob: bytes, *kinds) -> list[np.ndarray]:
    width, out, at = sum(np.dtype(k).itemsize for k in kinds), [], 0
    n = len(blob) // width
    for kind in kinds:
        size = np.dtype(kind).itemsize
        planes = np.frombuffer(blob, np.uint8, size * n, at).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += size * n
    return out


def _nodes(docs: DataFrame, key: str, text: str, seed: int) -> DataFrame:
    """A row for every document: its key, set size, and the two numbers of its set; null for no set."""

    def run(batches):
        for batch in batches:
            sizes, nodes, checks = [], [], []
            for t in batch.column(2).to_pylist():
                h = shingle_set(t, seed)
                sizes.append(len(h))
                nodes.append(digest(h) if len(h) else None)
                # From independent hashes of the words, so that words of one hash come to light.
                checks.append(digest(shingle_set(t, seed, 1)) if len(h) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(checks, pa.int64())],
                names=["key", "th", "n_shingles", "node", "check"],
            )

    kind = docs.schema[key].dataType.simpleString()
    given = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    return given.mapInArrow(run, f"key {kind}, th long, n_shingles long, node long, check long")


def _common(docs: DataFrame, text: str, seed: int) -> tuple[int, np.ndarray]:
    """Parts, and sorted codes (part and 24 bits of the place in it) of the shingles of over ``COMMON`` documents.

    Shingles that share a code are counted together, which at most places a rare one late.
    """
    spark = docs.sparkSession
    parts = _parts(spark)

    def send(batches):
        held, count = [], 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                h = shingle_set(t, seed)
                held.append(h)
                count += len(h)
                if count >= FLUSH:
                    yield from packed(held)
                    held, count = [], 0
        if count:
            yield from packed(held)

    def packed(held):
        part, place = _placed(np.sort(np.concatenate(held)), parts)
        edges = np.searchsorted(part, np.arange(parts + 1))
        full = [p for p in range(parts) if edges[p] < edges[p + 1]]
        bytes_ = (place >> np.uint32(8)).view(np.uint8).reshape(-1, 4)[:, :3]
        blobs = [bytes_[edges[p] : edges[p + 1]].T.tobytes() for p in full]
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(blobs, pa.binary())], names=["part", "blob"])

    def count(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for p, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(p, []).append(blob)
        for p in sorted(held):
            planes = [np.frombuffer(x, np.uint8).reshape(3, -1).astype(np.uint32) for x in held.pop(p)]
            places = np.sort(np.concatenate([x[0] | x[1] << np.uint32(8) | x[2] << np.uint32(16) for x in planes]))
            starts = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
            n = np.diff(np.concatenate([starts, [len(places)]]))
            hot = n > COMMON
            codes = (np.int64(p) << np.int64(24)) | places[starts[hot]].astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n[hot].astype(np.int64))], names=["code", "n"])

    blobs = docs.select(F.col(text).alias("text")).mapInArrow(send, "part int, blob binary").repartition(parts // 4, "part")
    counts = written(blobs.mapInArrow(count, "code long, n long"), "jaccard-common", BATCH)
    bar = COMMON
    while counts.filter(F.col("n") > bar).count() > MAX_COMMON:
        bar *= 2
    codes = np.asarray(counts.filter(F.col("n") > bar).select("code").toArrow().column(0), np.int64)
    discard(counts)
    return parts, np.sort(codes)


def _seed_regions(docs: DataFrame, text: str, seed: int, percent: int, parts: int, common: np.ndarray) -> DataFrame:
    """(g, node, n, held): every document in the regions of its prefix's shingles, regions of two or more only.

    ``n`` is the set's size, ``held`` the number of documents in the region. Many shingles make the
    same region; one of each is kept. Its members are told by two sums of hashes.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(common)
    cells = 1 << 22

    def common_mask(h, codes, table):
        part, place = _placed(h, parts)
        code = (part << np.int64(24)) | (place >> np.uint32(8)).astype(np.int64)
        maybe = np.flatnonzero(table[code & (cells - 1)])
        out = np.zeros(len(h), bool)
        if len(maybe):
            at = np.minimum(np.searchsorted(codes, code[maybe]), len(codes) - 1)
            out[maybe] = codes[at] == code[maybe]
        return out

    def send(batches):
        codes = shared.value
        table = np.zeros(cells, bool)
        table[codes & (cells - 1)] = True
        held, nodes, count = [], [], 0
        seen: set[int] = set()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                h = shingle_set(t, seed)
                if not len(h) or (node := digest(h)) in seen:
                    continue
                seen.add(node)
                late = common_mask(h, codes, table)
                prefix = np.concatenate([h[~late], h[late]])[: len(h) - (percent * len(h) + 99) // 100 + 1]
                held.append(prefix)
                nodes.append((node, len(h)))
                count += len(prefix)
                if count >= FLUSH:
                    yield packed(held, nodes)
                    held, nodes, count = [], [], 0
                    seen.clear()
        if nodes:
            yield packed(held, nodes)

    kinds = (np.uint32, np.int64, np.int32)

    def packed(held, nodes):
        h = np.concatenate(held)
        at = np.repeat(np.arange(len(held)), [len(x) for x in held])
        order = np.argsort(h, kind="stable")
        part, place = _placed(h[order], parts)
        node, n = (np.array(x)[at[order]] for x in zip(*nodes))
        edges = np.searchsorted(part, np.arange(parts + 1))
        full = [p for p in range(parts) if edges[p] < edges[p + 1]]
        blobs = [_planes(*(c[edges[p] : edges[p + 1]] for c in (place, node, n.astype(np.int32)))) for p in full]
        return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(blobs, pa.binary())], names=["part", "blob"])

    def group(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for p, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(p, []).append(blob)
        for p in sorted(held):
            place, node, n = (np.concatenate(x) for x in zip(*(_columns(b, *kinds) for b in held.pop(p))))
            rows = np.zeros(len(place), [("g", np.uint64), ("node", np.int64), ("n", np.int32)])
            rows["g"], rows["node"], rows["n"] = place.astype(np.uint64) | _U(p) << _U(32), node, n
            rows = rows[np.lexsort((rows["node"], rows["g"]))]
            fresh = np.ones(len(rows), bool)
            fresh[1:] = (rows["g"][1:] != rows["g"][:-1]) | (rows["node"][1:] != rows["node"][:-1])
            rows = rows[fresh]
            # A region falls apart where the next larger set is too large for any link across.
            rows = rows[np.lexsort((rows["n"], rows["g"]))]
            first = np.ones(len(rows), bool)
            first[1:] = (rows["g"][1:] != rows["g"][:-1]) | (100 * rows["n"][:-1].astype(np.int64) < percent * rows["n"][1:].astype(np.int64))
            rows["g"] = mixed(mixed(rows["g"]) + rows["n"][np.flatnonzero(first)][np.cumsum(first) - 1].astype(np.uint64))
            starts = np.flatnonzero(first)
            size = np.diff(np.concatenate([starts, [len(rows)]]))
            of = np.repeat(size, size)
            told = []
            for key in (1, 2):
                sums = np.concatenate([[_U(0)], np.cumsum(mixed(rows["node"].astype(np.uint64) + _U(key)))])
                told.append(np.repeat(sums[starts + size] - sums[starts], size).astype(np.int64))
            columns = [rows["g"].astype(np.int64), rows["node"], rows["n"], of.astype(np.int64), *told]
            columns = [c[of > 1] for c in columns]
            for at in range(0, len(columns[0]), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[at : at + 50_000]) for c in columns], names=["g", "node", "n", "held", "h0", "h1"])

    blobs = docs.select(F.col(text).alias("text")).mapInArrow(send, "part int, blob binary").repartition(parts // 4, "part")
    every = written(blobs.mapInArrow(group, "g long, node long, n int, held long, h0 long, h1 long"), "jaccard-seeds", BATCH)
    shared.destroy()
    once = every.groupBy("held", "h0", "h1").agg(F.min("g").alias("g")).select("g")
    regions = written(every.join(once, "g", "left_semi").select("g", "node", "n", "held"), "jaccard-regions")
    discard(every)
    return regions


def _sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, text: str, seed: int) -> DataFrame:
    """(node, n, hist, hashes) of the wanted nodes, from one text of each; ``hist`` counts the hashes by cell.

    A count that does not fit leaves the histogram null.
    """
    one = nodes.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("th").alias("th"))
    texts = docs.select(F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    texts = texts.join(one.select("th").distinct(), "th", "left_semi").dropDuplicates(["th"])

    def run(batches):
        for batch in batches:
            sets = [shingle_set(t, seed) for t in batch.column(1).to_pylist()]
            counts = [np.bincount((h & _U(CELLS - 1)).astype(np.int64), minlength=CELLS) for h in sets]
            hists = [c.astype(np.uint8).tobytes() if c.max(initial=0) < 1 << 8 else None for c in counts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([digest(h) for h in sets], pa.int64()), pa.array([len(h) for h in sets], pa.int64()),
                    pa.array(hists, pa.binary()), pa.array([h.tobytes() for h in sets], pa.binary()),
                ],
                names=["node", "n", "hist", "hashes"],
            )

    return written(texts.mapInArrow(run, "node long, n long, hist binary, hashes binary"), "jaccard-sets", BATCH)


def _bounded(pairs: DataFrame, sets: DataFrame, percent: int, least: int) -> DataFrame:
    """(a, b, hope): the pairs whose histograms allow a similarity of ``least``; ``hope`` tells if they allow a link.

    Cell by cell, the smaller count bounds what is common.
    """

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                known = np.array([x.is_valid and y.is_valid for x, y in zip(part.column(2), part.column(3))], bool)
                keep, hope = np.ones(part.num_rows, bool), np.ones(part.num_rows, bool)
                if known.any():
                    x, y = (
                        np.frombuffer(b"".join(v.as_py() for v, k in zip(part.column(c), known) if k), np.uint8).reshape(-1, CELLS)
                        for c in (2, 3)
                    )
                    most = np.minimum(x, y).sum(axis=1, dtype=np.int64)
                    either = x.sum(axis=1, dtype=np.int64) + y.sum(axis=1, dtype=np.int64) - most
                    keep[known], hope[known] = 100 * most >= least * either, 100 * most >= percent * either
                keep = pa.array(keep)
                yield pa.RecordBatch.from_arrays([c.filter(keep) for c in (part.column(0), part.column(1), pa.array(hope))], names=["a", "b", "hope"])

    left = sets.select(F.col("node").alias("a"), F.col("hist").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("hist").alias("y"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return written(rows.mapInArrow(run, "a long, b long, hope boolean"), "jaccard-bounded", BATCH)


def _measured(hopeful: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, inter, either): exact sizes of intersection and union of the sets of the pairs (a, b)."""

    def run(batches):
        last, held = None, None
        for batch in batches:
            inter, either = [], []
            for b, x, y in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                if b != last:
                    last, held = b, np.frombuffer(y.as_py(), np.uint64)
                x = np.frombuffer(x.as_py(), np.uint64)
                at = np.minimum(np.searchsorted(held, x), len(held) - 1)
                both = int((held[at] == x).sum())
                inter.append(both)
                either.append(len(x) + len(held) - both)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(inter, pa.int64()), pa.array(either, pa.int64())], names=["a", "b", "inter", "either"]
            )

    # Only the sets that are needed travel.
    met = hopeful.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = written(sets.join(met, "node", "left_semi").select("node", "hashes"), "jaccard-wanted")
    left = wanted.select(F.col("node").alias("a"), F.col("hashes").alias("x"))
    right = wanted.select(F.col("node").alias("b"), F.col("hashes").alias("y"))
    rows = hopeful.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    found = written(rows.mapInArrow(run, "a long, b long, inter long, either long"), "jaccard-measured", SET_PAIRS)
    discard(wanted)
    return found


def _open_pairs(state: DataFrame, every: bool) -> DataFrame:
    """(g, m, open, major, most): members, pairs not known to be connected, the class of most members, the largest set, by region."""
    classes = state.groupBy("g", "cls").agg(F.count("*").alias("k"), F.max("n").alias("n"))
    same = F.lit(0) if every else F.when(F.col("cls").isNull(), 0).otherwise(F.expr("k * (k - 1) div 2"))
    sums = classes.groupBy("g").agg(
        F.sum("k").alias("m"), F.sum(same).alias("same"), F.expr("max_by(cls, IF(cls IS NULL, 0, k))").alias("major"), F.max("n").alias("most")
    )
    major = F.lit(None).cast("long").alias("major") if every else "major"
    return sums.select("g", "m", F.expr("m * (m - 1) div 2 - same").alias("open"), major, "most")


def _hopeful(state: DataFrame, regions: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): distinct pairs of members of a region that may link and are not known to be connected.

    Members outside the largest class meet all others. Both are dealt into blocks of bounded size and
    packed, so that a row of the join holds two blocks and not a pair. Pairs are dropped whose sizes
    or histograms keep them from linking; a set without a histogram is not judged by it.
    """
    hists = sets.select("node", "hist")
    rows = state.join(regions, "g").join(hists, "node").withColumn("minor", F.coalesce(F.col("cls") != F.col("major"), F.lit(True)))
    rows = rows.withColumn("k", F.expr(f"int(ceil(m / {BLOCK}))")).withColumn("at", F.pmod(F.xxhash64("node"), F.col("k")))
    packed = F.collect_list(F.struct("node", "n", "cls", "minor", "hist"))
    two = written(rows.groupBy("g", "at").agg(packed.alias("y"), F.max("minor").alias("any")), "jaccard-blocks")
    # A block meets itself, the minor members of every other block meet it.
    one = two.filter("any").select("g", F.expr("filter(y, r -> r.minor)").alias("x"))
    pairs = one.join(two.select("g", "y"), "g").select("x", "y")

    def unpacked(column, row):
        held = column.slice(row, 1).flatten()
        node, n, cls, minor, hist = (held.field(i) for i in range(5))
        known = hist.is_valid().to_numpy(zero_copy_only=False)
        cells = np.zeros((len(held), CELLS), np.uint8)
        if known.any():
            cells[known] = np.frombuffer(b"".join(hist.drop_null().to_pylist()), np.uint8).reshape(-1, CELLS)
        # A member of no class is of a class of its own.
        classed = cls.is_valid().to_numpy(zero_copy_only=False)
        cls = cls.fill_null(0).to_numpy()
        return node.to_numpy(), n.to_numpy().astype(np.int64), cls, classed, minor.to_numpy(zero_copy_only=False), known, cells

    def run(batches):
        for batch in batches:
            a, b = [], []
            for row in range(batch.num_rows):
                node, n, cls, classed, _, known, cells = unpacked(batch.column(0), row)
                node2, n2, cls2, classed2, minor2, known2, cells2 = unpacked(batch.column(1), row)
                for i in range(len(node)):
                    # Of two minor members each meets the other; one order is enough.
                    open_ = (node2 != node[i]) & (~minor2 | (node2 > node[i])) & (100 * np.minimum(n2, n[i]) >= percent * np.maximum(n2, n[i]))
                    if classed[i]:
                        open_ &= ~classed2 | (cls2 != cls[i])
                    at = np.flatnonzero(open_)
                    if known[i] and len(at):
                        most = np.minimum(cells2[at], cells[i]).sum(axis=1, dtype=np.int64)
                        at = at[~known2[at] | (100 * most >= percent * (n2[at] + n[i] - most))]
                    if len(at):
                        a.append(np.minimum(node2[at], node[i]))
                        b.append(np.maximum(node2[at], node[i]))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    # The same pair may come from many regions.
    found = written(pairs.mapInArrow(run, "a long, b long"), "jaccard-hopeful", BLOCK_PAIRS)
    once = written(found.distinct(), "jaccard-hopeful")
    discard(two, found)
    return once


def _links(regions: DataFrame, sets: DataFrame, percent: int, every: bool = False) -> DataFrame:
    """(a, b): links that connect all that the regions connect; ``regions`` has g, node, n and held.

    ``cls`` names the component of the links found so far; members of one need no comparison. With
    ``every`` all links between distinct sets are given, and no two members count as connected.
    """
    eps = 1 - percent / 100
    linked = F.expr(f"100 * inter >= {percent} * either")
    # The similarity at two radii from a pivot.
    reach = max(0, int(100 * (1 - 2 * eps) + 1e-6))
    none = F.lit(None).cast("long")
    central = regions.groupBy("node").agg(F.sum("held").alias("weight"))
    state = written(regions.join(central, "node").select("g", "node", "n", "weight", none.alias("cls")), "jaccard-state")
    links, turn = [sets.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)], 0
    union = lambda: functools.reduce(DataFrame.unionByName, links).distinct()
    rows = None
    while not state.isEmpty():
        if turn:
            sizes = written(_open_pairs(state, every), "jaccard-sizes")
            # Cells that overlap so much that a round gains nothing would only grow from round to round.
            before, rows = rows, state.count()
            last = turn == ROUNDS or (before is not None and rows >= before)
            few = sizes if last else sizes.filter(F.col("open") <= F.when(F.col("most") > LONG, SMALL // FEWER).otherwise(SMALL))
            hopeful = _hopeful(state, few, sets, percent)
            links.append(_measured(hopeful, sets).filter(linked).select("a", "b"))
            discard(hopeful)
            if last:
                break
            larger = written(state.join(few, "g", "left_anti"), "jaccard-state")
            discard(state, sizes)
            state = larger
            rows = state.count()
            if not rows:
                break
        # The most central member of each of a few hash classes: never a whole region in one array.
        each = F.pmod(F.xxhash64("node"), F.lit(PIVOTS if turn else 1))
        best = state.groupBy("g", each.alias("e")).agg(F.max(F.struct("weight", "node", "n")).alias("p"))
        pivots = best.groupBy("g").agg(F.collect_list("p").alias("ps"))
        met = state.join(pivots, "g").filter(~F.array_contains("ps.node", F.col("node")))
        members = met.select("g", "node", "n", "weight")
        met = met.select("g", "node", "n", "weight", F.explode("ps").alias("p")).select("g", "node", "n", "weight", F.col("p.node").alias("b"), F.col("p.n").alias("nb"))
        between = pivots.select(F.explode("ps").alias("p"), "ps").select(F.col("p.node").alias("a"), F.col("p.n").alias("n"), F.explode("ps").alias("q"))
        between = between.select("a", F.col("q.node").alias("b"), "n", F.col("q.n").alias("nb")).filter("a < b")
        # The first round asks for links only; later ones for what lies within two radii of a pivot.
        least = reach if turn else percent
        sized = F.expr(f"100 * least(n, nb) >= {least} * greatest(n, nb)")
        met = met.filter(sized)
        pairs = met.select(F.col("node").alias("a"), "b").unionByName(between.filter(sized).select("a", "b")).distinct()
        bounded = _bounded(pairs, sets, percent, least)
        found = _measured(bounded.filter("hope").select("a", "b"), sets)
        links.append(found.filter(linked).select("a", "b"))
        if turn:
            # What the histograms put out of reach is out of the cell. The members outside all balls share a cell.
            near = found.filter(linked).select(F.col("a").alias("node"), "b", F.lit(True).alias("near"))
            within = met.join(bounded.select(F.col("a").alias("node"), "b"), ["node", "b"]).join(near, ["node", "b"], "left")
            within = written(within, "jaccard-within")
            inside = within.select(F.xxhash64("g", "b").alias("g"), "node", "n", "weight")
            balls = within.filter("near").select("g", "node").distinct()
            rest = members.join(balls, ["g", "node"], "left_anti").withColumn("g", F.xxhash64("g"))
            cells = written(inside.unionByName(rest), "jaccard-cells")
            discard(within)
        else:
            cells = written(members, "jaccard-cells")
        if every:
            classed = cells.withColumn("cls", none)
        else:
            roots = connected_components(union().select(F.col("a").alias("u"), F.col("b").alias("v")))
            classed = written(cells.join(roots.select("node", F.col("root").alias("cls")), "node", "left"), "jaccard-classed")
        unsettled = F.expr("count(*) > 1" + " and (count(cls) < count(*) or min(cls) <> max(cls))" * (not every))
        # Many shingles make the same region; one of each is enough. Its members are told by two sums of hashes.
        told = [F.sum(F.xxhash64(F.lit(i), "node").cast("decimal(38,0)")).alias(f"h{i}") for i in (0, 1)]
        regions_left = classed.groupBy("g").agg(F.count("*").alias("m"), *told, unsettled.alias("more")).filter("more")
        work = regions_left.groupBy("m", "h0", "h1").agg(F.min("g").alias("g")).select("g")
        left = written(classed.join(work, "g"), "jaccard-state")
        discard(state, cells, bounded, *([] if every else [classed]))
        state, turn = left, turn + 1
    return union()


def similarity_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80, count_links: bool = False) -> DataFrame:
    """(key, th, n_shingles, component_id, stays[, n_links]) for every row of ``docs``; ``th`` is the hash of its text.

    Two documents link when their sets of distinct five-word shingles have a Jaccard similarity of
    ``percent`` per cent or more. ``component_id`` is the smallest key reachable by links, the own
    included. Null texts and texts without words have no set, link with nothing and keep their own
    key. A text of under five words is one shingle. A null key takes part, but names a component
    only if all keys in it are null. Repeated rows have one set and share a component. ``stays`` is
    true for one (key, th) of each component, the smallest. An empty table gives an empty result.

    With ``count_links`` comes ``n_links``: the number of other rows that the row links with, copies
    included. Every link between distinct sets is then measured, which costs as many comparisons as
    there are links at least; without it members of a pivot's ball are not compared.
    """
    for seed in range(10):
        nodes = written(_nodes(docs, key, text, seed), "jaccard-nodes", BATCH)
        clash = nodes.groupBy("node").agg(F.min("check").alias("x"), F.max("check").alias("y")).filter("x <> y")
        if clash.isEmpty():
            break
    else:
        raise RuntimeError("set digests clash for every seed")
    regions = _seed_regions(docs, text, seed, percent, *_common(docs, text, seed))
    sets = _sets(docs, nodes, regions.select("node").distinct(), text, seed)
    links = _links(regions, sets, percent, count_links)
    components = connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    if count_links:
        rows = nodes.filter("node is not null").groupBy("node").agg(F.count("*").alias("k"))
        # A pair of two regions may come in both orders.
        ends = links.select(F.col("a").alias("node"), F.col("b").alias("to")).unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("to")))
        others = ends.distinct().join(rows.withColumnRenamed("node", "to"), "to").groupBy("node").agg(F.sum("k").alias("m"))
        # Rows of one set link with each other, and with every row of a linked set.
        linked = rows.join(others, "node", "left").select("node", (F.col("k") - 1 + F.coalesce("m", F.lit(0))).alias("n_links"))
        nodes = written(nodes.join(linked, "node", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0)).cast("long")), "jaccard-counted", BATCH)
    rooted = nodes.join(components, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = written(rooted, "jaccard-rooted")
    first = F.min(F.struct(F.col("key").isNull().alias("z"), "key", "th"))
    named = rooted.filter("root is not null").groupBy("root").agg(F.min("key").alias("component_id"), first.alias("first"))
    return rooted.join(named, "root", "left").select(
        "key", "th", "n_shingles", F.when(F.col("root").isNull(), F.col("key")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce(F.col("key").eqNullSafe(F.col("first.key")) & (F.col("th") == F.col("first.th")), F.lit(True)).alias("stays"),
        *(["n_links"] if count_links else []),
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group, the one of the smallest key; columns unchanged."""
    groups = similarity_groups(docs, key, text, percent).filter("stays and n_shingles > 0").groupBy("key", "th").agg(F.count("*").alias("k"))
    groups = written(groups, "jaccard-stays")
    th = F.xxhash64(F.col(text))
    marked = docs.withColumn("__th", th)
    single, several = (
        marked.join(groups.filter(c).select(F.col("key").alias("__key"), F.col("th").alias("__th2")),
                    marked[key].eqNullSafe(F.col("__key")) & (F.col("__th") == F.col("__th2")), "left_semi").drop("__th")
        for c in ("k = 1", "k > 1")
    )
    has_word = F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return single.unionByName(several.dropDuplicates([key, text])).unionByName(docs.filter(~has_word))


def op10_jaccard_join(spark, sf_dir) -> DataFrame:
    """Groups of near-duplicates among all ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return similarity_groups(docs).select(F.col("key").alias("doc_id"), "n_shingles", "component_id")
