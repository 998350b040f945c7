"""Exact n-gram Jaccard join in the metric space of shingle sets.

Distances. Jaccard distance is a metric, and two documents link when theirs is
at most ``1 - threshold / 100``. Three triangle-inequality steps cut the space:

1. *Size rings.* Distances to the empty set (by symmetric difference) are the
   set sizes; linked sets differ in size by at most a quarter, so a run of
   sizes ends where the next size is more than 5/4 of the one before.
2. *Pivot cells.* The first pivots are single shingles. All shingles of a
   document are equally near to it, so a document lies in the cell of its
   first shingle in a global order, and its window reaches over the next
   cells: a partner within the radius lacks at most a fifth of the document's
   shingles, so ``n - ceil(0.8 n) + 1`` cells hold every partner. (Whole
   documents as first pivots leave nearly all documents at distance 1 from
   each pivot, and then the windows hold everything.) The order puts rare
   shingles first, by a merged count sketch over all documents; it decides
   only the cost, not the result.
3. *Document pivots.* The members of a cell's size run form the region of its
   smallest set. A region too heavy for one task takes several of its
   documents as pivots; each member goes to the Voronoi cell of its nearest
   pivot and, by its window ``d(x, p) <= d(x, nearest) + 2 r``, to the cells it
   may have partners in. Members within the radius of the same pivot are linked
   at once and need no comparison with each other; all others, window members
   too, recur with the members they can reach. What no longer shrinks is compared
   exactly, block against block.

Most members of a region only share a phrase. Before whole sets move, the
members' *quarters* (a fixed quarter of the shingle space) are compared: where
these alone differ by more than linked sets may, the pair is out, and a member
without any partner left leaves the region.

Links go to connected components by alternating star contraction, all in
Spark. Equal sets are one point of the space from the start, so groups of
copies never become pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epistar.llm.common import bounded_batches, free_name, key_groups, merge_sketches, sketch_rows, table
from epistar.llm.tokens import distinct, mix, ranges, shingle_sets, signed
from epistar.session import cut_lineage

SHINGLE_WORDS = 5
THRESHOLD = 80  # per cent
SKETCH_SLOTS = 1 << 20  # fixed size of the order's count sketch
SKETCH_BLOCKS = 32
BLOOM_BITS = 1 << 23  # fixed size of the filter on candidate sets
REGION_SHINGLES = 400_000  # largest region that one task joins directly
REGION_PIVOTS = 8
MAX_DEPTH = 3


def set_id(shingles: np.ndarray) -> int:
    """Identity of a set: 64 bits over all its shingles (0 for the empty set)."""
    if not len(shingles):
        return 0
    a, b = mix(shingles).sum(dtype=np.uint64), mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    both = np.array([a, b], dtype=np.uint64) * np.array([1, 3], dtype=np.uint64)
    return int(mix(both[:1] ^ both[1:] ^ np.uint64(len(shingles))).view(np.int64)[0]) or 1


def linked(inter, n_a, n_b, threshold: int):
    """100 * intersection >= threshold * union."""
    return 100 * inter >= threshold * (n_a + n_b - inter)


def _profile(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """One row per document (id, n, sid) and, by partition, the rows of its shingle count sketch."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SKETCH_SLOTS, dtype=np.int32)
        for batch in batches:
            n, sid, held = [], [], []
            for s in shingle_sets(batch.column("text"), size):
                n.append(len(s))
                sid.append(set_id(s))
                held.append(s)
            every = np.concatenate(held) if held else np.zeros(0, np.uint64)
            counts += np.bincount((every % np.uint64(SKETCH_SLOTS)).astype(np.int64), minlength=SKETCH_SLOTS).astype(np.int32)
            k = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(sid, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())],
                names=["id", "n", "sid", "block", "cells"],
            )
        rows = sketch_rows(counts, SKETCH_BLOCKS)
        k = rows.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), rows.column(0), rows.column(1)],
            names=["id", "n", "sid", "block", "cells"],
        )

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        scan, "id long, n long, sid long, block int, cells binary"
    )


def _order(profile: DataFrame) -> np.ndarray:
    """Rank of each sketch slot by estimated count, on a logarithmic scale."""
    rank = merge_sketches(
        profile.where(F.col("block").isNotNull()), SKETCH_BLOCKS, "int32",
        lambda a, b: a.astype(np.int64) + b,
        lambda c: np.minimum(255, 12 * np.log2(1.0 + c)).astype(np.uint8),
    )
    return rank if len(rank) else np.zeros(SKETCH_SLOTS, np.uint8)


def _cells(docs: DataFrame, id_col: str, text_col: str, size: int, threshold: int, rank: np.ndarray) -> DataFrame:
    """(cell, sid, n): each distinct set in the cells of its window."""
    shared = docs.sparkSession.sparkContext.broadcast(rank)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        seen: set[int] = set()
        for batch in batches:
            cells, sids, sizes, widths = [], [], [], []
            for s in shingle_sets(batch.column("text"), size):
                n, sid = len(s), set_id(s)
                if not n or sid in seen:
                    continue
                seen.add(sid)
                width = n - (threshold * n + 99) // 100 + 1
                key = order[(s % np.uint64(SKETCH_SLOTS)).astype(np.int64)].astype(np.uint64) << np.uint64(56) | s >> np.uint64(8)
                cells.append(np.partition(key, width - 1)[:width] if width < n else key)
                sids.append(sid)
                sizes.append(n)
                widths.append(width)
            if cells:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(np.concatenate(cells))),
                        pa.array(np.repeat(np.array(sids, np.int64), widths)),
                        pa.array(np.repeat(np.array(sizes, np.int32), widths)),
                    ],
                    names=["cell", "sid", "n"],
                )

    return docs.select(F.col(text_col).alias("text")).mapInArrow(scan, "cell long, sid long, n int")


def _regions(cells: DataFrame, threshold: int) -> DataFrame:
    """(region, sid, n): the members of every cell's size run, under the run's first set.

    A task streams over its sorted cells and keeps one row, however many
    members a cell has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, lead, lead_n, prev, prev_n, told = None, 0, 0, 0, 0, True
        for batch in batches:
            c, s, n = (np.asarray(batch.column(k)) for k in range(3))
            # rows that stand alone in their cell are most; only the others are walked
            same = np.zeros(len(c), dtype=bool)
            same[1:] = c[1:] == c[:-1]
            near = same.copy()
            near[:-1] |= same[1:]
            near[:1], near[-1:] = True, True
            out = []
            for i in np.flatnonzero(near).tolist():
                ci, si, ni = int(c[i]), int(s[i]), int(n[i])
                if ci != cell or threshold * ni > 100 * prev_n:
                    cell, lead, lead_n, told = ci, si, ni, False
                elif si != prev:
                    if not told:
                        out.append((lead, lead, lead_n))
                        told = True
                    out.append((lead, si, ni))
                prev, prev_n = si, ni
            if out:
                r, m, k = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r, pa.int64()), pa.array(m, pa.int64()), pa.array(k, pa.int32())], names=["region", "sid", "n"]
                )

    return (
        cells.repartition("cell").sortWithinPartitions("cell", "n", "sid")
        .mapInArrow(run, "region long, sid long, n int").distinct()
    )


def quarter(s: np.ndarray) -> np.ndarray:
    """The part of a set in a fixed quarter of the shingle space, its values cut to 32 bits.

    Two sets differ by at least as many shingles as their quarters do.
    """
    return distinct((s[(s & np.uint64(3)) == 0] >> np.uint64(32)).astype(np.uint32))


def _sets_of(docs: DataFrame, text_col: str, size: int, members: DataFrame, form=lambda s: s) -> DataFrame:
    """(sid, shingles) of the sets that lie in a region: a fixed-size filter first, then an exact join."""
    spark = docs.sparkSession

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(BLOOM_BITS, dtype=bool)
        for batch in batches:
            bits[np.asarray(batch.column(0)).view(np.uint64) % np.uint64(BLOOM_BITS)] = True
        yield sketch_rows(np.packbits(bits), SKETCH_BLOCKS)

    wanted = members.select("sid").distinct()
    bits = merge_sketches(wanted.mapInArrow(mark, "block int, cells binary"), SKETCH_BLOCKS, "uint8", np.bitwise_or, lambda x: x)
    shared = spark.sparkContext.broadcast(np.unpackbits(bits).astype(bool) if len(bits) else np.zeros(BLOOM_BITS, bool))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hit, seen = shared.value, set()
        for batch in batches:
            sids, sets = [], []
            for s in shingle_sets(batch.column("text"), size):
                sid = set_id(s)
                if sid not in seen and hit[(sid & 0xFFFFFFFFFFFFFFFF) % BLOOM_BITS]:
                    seen.add(sid)
                    sids.append(sid)
                    sets.append(form(s).tobytes())
            if sids:
                yield pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), pa.array(sets, pa.binary())], names=["sid", "shingles"])

    sets = docs.select(F.col(text_col).alias("text")).mapInArrow(scan, "sid long, shingles binary")
    return sets.join(wanted, "sid", "left_semi").dropDuplicates(["sid"])


class Region:
    """Intersection sizes inside one region, by its inverted lists."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        every = np.concatenate(sets)
        by = np.argsort(every, kind="stable")
        ranked = every[by]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.zeros(0, np.int64)
        self.counts = np.diff(np.concatenate([first, [len(ranked)]]))
        self.first = first
        self.owners = np.repeat(np.arange(len(sets)), self.sizes)[by]
        self.list_of = np.empty(len(every), dtype=np.int64)
        self.list_of[by] = np.repeat(np.arange(len(first)), self.counts)
        self.begin = np.concatenate([[0], np.cumsum(self.sizes)])

    def shared_with(self, i: int) -> np.ndarray:
        """Shingles that each member shares with member i (0 for itself)."""
        g = self.list_of[self.begin[i] : self.begin[i + 1]]
        g = g[self.counts[g] > 1]
        if not len(g):
            return np.zeros(len(self.sizes), np.int64)
        inter = np.bincount(self.owners[ranges(self.first[g], self.counts[g])], minlength=len(self.sizes))
        inter[i] = 0
        return inter


def _prune(regions: DataFrame, quarters: DataFrame, threshold: int) -> DataFrame:
    """Regions of bounded size without the members whose quarters differ too much from all others'."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in key_groups(batches, ["region"]):
            if group.num_rows < 2:
                continue
            n = group.column("n").to_numpy().astype(np.int64)
            region = Region([np.frombuffer(s.as_buffer(), dtype=np.uint32) for s in group.column("shingles")])
            keep = np.zeros(len(n), dtype=bool)
            for i in range(len(n)):
                differ = region.sizes[i] + region.sizes - 2 * region.shared_with(i)
                may = differ * (100 + threshold) <= (n[i] + n) * (100 - threshold)
                may[i] = False
                keep[i] = may.any()
            if keep.any():
                yield pa.RecordBatch.from_arrays(
                    [group.column(c).combine_chunks().filter(pa.array(keep)) for c in ("region", "sid", "n")], names=["region", "sid", "n"]
                )

    light = regions.join(_weights(regions), "region").where(F.col("weight") <= 4 * REGION_SHINGLES).drop("weight")
    heavy = regions.join(_weights(regions), "region").where(F.col("weight") > 4 * REGION_SHINGLES).drop("weight")
    judged = (
        light.join(quarters, "sid").repartition("region").sortWithinPartitions("region").select("region", "sid", "n", "shingles")
        .mapInArrow(judge, "region long, sid long, n int")
    )
    return judged.unionByName(heavy)


def region_links(sids: np.ndarray, sets: list[np.ndarray], inner: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Links that connect all linked sets of one region (exact; inner sets are known to be linked with each other)."""
    m = len(sets)
    region = Region(sets)
    sizes = region.sizes
    root = np.arange(m)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []
    for i in np.flatnonzero(~inner).tolist():
        inter = region.shared_with(i)
        for j in np.flatnonzero((inter > 0) & linked(inter, sizes[i], sizes, threshold)).tolist():
            a, b = find(i), find(j)
            if a != b:
                root[a] = b
                links.append((int(sids[i]), int(sids[j])))
    return links


def _join_small(regions: DataFrame, keys: list[str], threshold: int) -> DataFrame:
    """Exact links of regions of bounded size; rows (keys, sid, inner, shingles)."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for group in key_groups(batches, keys):
            if group.num_rows < 2:
                continue
            sids = np.asarray(group.column("sid").combine_chunks())
            inner = group.column("inner").to_numpy()
            sets = [np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in group.column("shingles")]
            out += region_links(sids, sets, inner, threshold)
            if len(out) > 50_000:
                yield _pairs(out)
                out = []
        if out:
            yield _pairs(out)

    return regions.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(join, "a long, b long")


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _weights(regions: DataFrame) -> DataFrame:
    return regions.groupBy("region").agg(F.sum("n").alias("weight"))


def _split_by_pivots(regions: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Voronoi cells of heavy regions: (region, sid, n, pivot, d, home, weight) for homes and windows.

    ``regions`` has (region, sid, n, weight). Each region is dealt over parts of
    bounded weight; the pivots go to every part.
    """
    radius = (100 - threshold) / 100
    by_hash = Window.partitionBy("region").orderBy(F.xxhash64("sid", "region"), "sid")
    parts = (F.col("weight") / F.lit(REGION_SHINGLES // 2)).cast("int") + 1
    pivots = regions.withColumn("rn", F.row_number().over(by_hash)).where(F.col("rn") <= REGION_PIVOTS).drop("rn")
    dealt = regions.select("*", F.pmod(F.xxhash64("sid"), parts).cast("int").alias("part"), F.lit(False).alias("is_pivot")).unionByName(
        pivots.select("*", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.lit(True).alias("is_pivot"))
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in key_groups(batches, ["region", "part"]):
            is_pivot = group.column("is_pivot").to_numpy()
            sids, n = group.column("sid").to_numpy(), group.column("n").to_numpy()
            sets = [np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in group.column("shingles")]
            at = np.flatnonzero(is_pivot)
            out: list[tuple] = []
            for i in np.flatnonzero(~is_pivot).tolist():
                inter = np.array([np.isin(sets[p], sets[i], assume_unique=True).sum() for p in at])
                d = 1 - inter / (n[at] + n[i] - inter)
                close = linked(inter, n[at], n[i], threshold)
                nearest = int(np.argmin(d))
                for k in np.flatnonzero(d <= d[nearest] + 2 * radius + 1e-9).tolist():
                    out.append((int(sids[i]), int(n[i]), int(sids[at[k]]), float(d[k]), k == nearest, bool(close[k])))
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(out), group.column("region")[0].as_py(), np.int64)), pa.array(cols[0], pa.int64()),
                        pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.float64()),
                        pa.array(cols[4]), pa.array(cols[5]), pa.array(np.full(len(out), group.column("weight")[0].as_py(), np.int64)),
                    ],
                    names=["region", "sid", "n", "pivot", "d", "home", "inner", "parent"],
                )

    return (
        dealt.join(sets, "sid").repartition("region", "part").sortWithinPartitions("region", "part")
        .select("region", "part", "sid", "n", "weight", "is_pivot", "shingles")
        .mapInArrow(measure, "region long, sid long, n int, pivot long, d double, home boolean, inner boolean, parent long")
    )


def _blocks(regions: DataFrame) -> DataFrame:
    """Block pairs of regions that no longer shrink: (region, i, j, sid, inner)."""
    count = (F.col("weight") / F.lit(REGION_SHINGLES // 2)).cast("int") + 1
    block = F.pmod(F.xxhash64("sid", F.lit(7)), count).cast("int")
    return (
        regions.withColumn("_count", count).withColumn("_block", block)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_count") - 1)))
        .select(
            "region", F.least("_block", "_other").alias("i"), F.greatest("_block", "_other").alias("j"), "sid", "n", "inner"
        )
    )


def _links(regions: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """All links needed to connect what is linked, from regions (region, sid, n), by recursion."""
    todo = regions.withColumn("inner", F.lit(False)).join(_weights(regions), "region")
    heavy_at = F.col("weight") > REGION_SHINGLES
    found = []
    for depth in range(MAX_DEPTH + 1):
        found.append(_join_small(todo.where(~heavy_at).join(sets, "sid"), ["region"], threshold))
        heavy = todo.where(heavy_at)
        if heavy.isEmpty():
            break
        if depth == MAX_DEPTH:
            found.append(_join_small(_blocks(heavy).join(sets, "sid"), ["region", "i", "j"], threshold))
            break
        cells = cut_lineage(_split_by_pivots(heavy, sets, threshold))
        found.append(cells.where("inner").select(F.col("sid").alias("a"), F.col("pivot").alias("b")))
        cells = cells.withColumn("region", F.xxhash64("region", "pivot"))
        # a linked pair shares the home cells of both its sets and is compared there, unless both lie within the radius;
        # its distances to a pivot differ by at most the radius, so a set stays where some partner of that kind can be
        reach = (100 - threshold) / 100 + 1e-9
        bounds = cells.groupBy("region").agg(
            F.min(F.when(~F.col("inner"), F.col("d"))).alias("least"),
            F.min(F.when(F.col("home") & ~F.col("inner"), F.col("d"))).alias("least_home"),
            F.max(F.when(F.col("home"), F.col("d"))).alias("most_home"),
        )
        partner = (
            F.when(F.col("home"), ~F.col("inner") | (F.col("d") >= F.col("least") - reach))
            .when(F.col("inner"), F.col("d") >= F.col("least_home") - reach)
            .otherwise(F.col("d") <= F.col("most_home") + reach)
        )
        near = cells.join(bounds, "region").where(partner)
        todo = near.select("region", "sid", "n", "inner", "parent")
        weights = _weights(todo)
        todo = cut_lineage(todo.join(weights, "region").select("region", "sid", "n", "inner", "weight", "parent"))
        stuck = heavy_at & (F.col("weight") > 0.8 * F.col("parent"))
        still = todo.where(stuck)
        if not still.isEmpty():
            found.append(_join_small(_blocks(still).join(sets, "sid"), ["region", "i", "j"], threshold))
            todo = todo.where(~stuck)
        todo = todo.drop("parent")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _is_star_forest(edges: DataFrame) -> bool:
    """Every vertex has one parent, or is one, and never both."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(sid, root): connected components of links (a, b), by alternating large and small stars.

    Each round is two shuffles of the links; their number falls to one per
    vertex and the rounds grow with the logarithm of the longest path.
    """
    edges = cut_lineage(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while not _is_star_forest(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        edges = cut_lineage(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        )
    return edges.select(F.col("u").alias("sid"), F.col("v").alias("root"))


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE_WORDS, threshold: int = THRESHOLD
) -> DataFrame:
    """One row per document: (id, n_shingles, component_id).

    ``component_id`` is the smallest id reachable over links, the document's
    own included. Null and blank texts have no shingle and link with nothing.
    Documents with equal ids are rows of their own; a null id takes part in
    links but never names a component (its component may be null). Other
    columns of ``docs`` are not looked at.
    """
    bounded_batches(docs.sparkSession)
    profile = cut_lineage(_profile(docs, id_col, text_col, size))
    rank = _order(profile)
    regions = cut_lineage(_regions(_cells(docs, id_col, text_col, size, threshold, rank), threshold))
    points = profile.where("block is null").select("id", "n", "sid")
    if regions.isEmpty():
        roots = docs.sparkSession.createDataFrame([], "sid long, root long")
    else:
        regions = cut_lineage(_prune(regions, _sets_of(docs, text_col, size, regions, quarter), threshold))
        sets = cut_lineage(_sets_of(docs, text_col, size, regions))
        roots = components(_links(regions, sets, threshold))
    # the smallest id of each set, then of each component
    least = points.where("n > 0").groupBy("sid").agg(F.min("id").alias("low"))
    rooted = least.join(roots, "sid", "left").select("sid", F.coalesce("root", "sid").alias("root"), "low")
    named = rooted.join(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "root").select("sid", "component_id")
    return points.join(named, "sid", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document with the smallest id of each component (all columns; rows without a text class stay).

    Rows with equal ids share one verdict: they stay if one of them names its
    component. Rows with a null id stay, as nothing tells them apart. An empty
    table stays empty; other columns may have any names.
    """
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    keep = free_name(docs, "_keep")
    kept = jaccard_components(slim, "id", "text").where("id = component_id").select(F.col("id").alias(keep)).distinct()
    picked = docs.join(kept, F.col(id_col) == F.col(keep), "left_semi")
    return picked.unionByName(docs.where(F.col(id_col).isNull()))


def op1_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Shingle count and component of every document; null and empty texts are linked with nothing, an empty table gives no rows."""
    return jaccard_components(table(spark, sf_dir, "documents"))
