"""All points of one set within a distance of the points of another, on the sphere.

Partitioning: a quadtree over (right ascension, declination) is grown from a bounded sample of the
base points until no leaf holds more than its share of it; the leaves (a few thousand at most) go to the
tasks. Each *base* point lies in exactly one leaf. Each *probe* point is repeated into every leaf its
search cap touches (boundary replication); the right-ascension reach of a cap is exact,
asin(sin r / cos dec), and the full circle where the cap holds a pole.

Inside a leaf an R-tree is bulk-loaded over the base points (sort-tile-recursive) and probed with all
caps at once, level by level; survivors are refined by their exact chord. A pair is reported only by
the leaf that holds its reference point, the base point, so replication yields no duplicates.

The sample bounds the number of leaves, so with very many points a leaf gets more than its share: it is then cut into
a grid of equal parts by its count (second pass), which takes no more from the driver than a number per leaf.
A part that stays full because its points coincide is split into batches of base points, with the
probes repeated per batch.

Defined results: points with NULL, NaN or infinite coordinates or a declination outside -90..90 have
no place; right ascensions are taken modulo 360; repeated points of one id count once; either side
empty gives no rows; the limit is inclusive.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweave.functions.geometry import chord_of_arcsec
from starweave.functions.numeric import finite
from starweave.operators.skew import batch_count
from starweave.session import materialise

#: The quadtree is grown on the driver from at most about this many sampled positions.
SAMPLE_ROWS = 50_000
MAX_DEPTH = 20
NODE = 16


def sky_points(df: DataFrame, id_col, ra, dec) -> DataFrame:
    """(id, ra, dec), one row per id that has a place."""
    ok = finite(ra) & finite(dec) & (F.abs(dec) <= 90) & id_col.isNotNull()
    return df.where(ok).select(id_col.alias("id"), F.pmod(ra, F.lit(360.0)).alias("ra"), dec.alias("dec")).groupBy("id").agg(F.min(F.struct("dec", "ra")).alias("p")).select("id", "p.ra", "p.dec")


def grow_quadtree(sample: np.ndarray, leaf_rows: int) -> np.ndarray:
    """Leaves (ra0, ra1, dec0, dec1) covering the sphere; sample: rows of (ra, dec)."""
    leaves, todo = [], [(0.0, 360.0, -90.0, 90.0, sample, 0)]
    while todo:
        a0, a1, d0, d1, pts, depth = todo.pop()
        if len(pts) <= leaf_rows or depth == MAX_DEPTH or (np.ptp(pts, axis=0) == 0).all():
            leaves.append((a0, a1, d0, d1))
            continue
        am, dm = (a0 + a1) / 2, (d0 + d1) / 2
        east, north = pts[:, 0] >= am, pts[:, 1] >= dm
        for e, (x0, x1) in ((False, (a0, am)), (True, (am, a1))):
            for n, (y0, y1) in ((False, (d0, dm)), (True, (dm, d1))):
                todo.append((x0, x1, y0, y1, pts[(east == e) & (north == n)], depth + 1))
    return np.array(leaves)


def cap_reach(dec: np.ndarray, radius_deg: float) -> np.ndarray:
    """Half width in right ascension of a cap; 180 where it holds a pole."""
    d, r = np.radians(np.abs(dec)), np.radians(radius_deg)
    with np.errstate(divide="ignore", invalid="ignore"):
        reach = np.degrees(np.arcsin(np.minimum(np.sin(r) / np.cos(d), 1.0)))
    return np.where(np.abs(dec) + radius_deg >= 90, 180.0, reach * (1 + 1e-9) + 1e-9)


#: Parts of a leaf along one side at most, and bits of a part's number.
MOST_CUTS, CUT_BITS = 1 << 16, 17


def _part(leaves: np.ndarray, cuts: np.ndarray, leaf: np.ndarray, ra: np.ndarray, dec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Column and row, in the grid of their leaf, of points; points beside the leaf go to its edge."""
    a0, a1, d0, d1 = leaves[leaf].T
    n = cuts[leaf]
    return tuple(np.clip(np.floor((v - lo) / (hi - lo) * n).astype(np.int64), 0, n - 1) for v, lo, hi in ((ra, a0, a1), (dec, d0, d1)))


def _number(leaf: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (leaf.astype(np.int64) << (2 * CUT_BITS)) | (x << CUT_BITS) | y


def _home_leaf(leaves: np.ndarray, cuts: np.ndarray):
    """Base points: the one part of the one leaf each lies in."""

    def assign(batches):
        for b in batches:
            ra, dec = b.column(1).to_numpy(), b.column(2).to_numpy()
            home = _locate(leaves, ra, dec)
            part = _number(home, *_part(leaves, cuts, home, ra, dec))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(part)], [*b.schema.names, "leaf"])

    return assign


def _locate(leaves: np.ndarray, ra: np.ndarray, dec: np.ndarray) -> np.ndarray:
    """The one leaf of each point: half-open boxes, closed at ra 360 and dec 90."""
    tree = StrTree(leaves[:, [0, 2]], leaves[:, [1, 3]])
    p = np.c_[ra, dec]
    q, leaf = tree.overlaps(p, p)
    a0, a1, d0, d1 = leaves[leaf].T
    x, y = ra[q], dec[q]
    inside = (x >= a0) & ((x < a1) | (a1 == 360)) & (y >= d0) & ((y < d1) | (d1 == 90))
    home = np.full(len(ra), -1, np.int32)
    home[q[inside]] = leaf[inside]
    return home


def _touched_leaves(leaves: np.ndarray, cuts: np.ndarray, radius_deg: float):
    """Probe points: one copy for every part of a leaf that the search cap touches."""

    def assign(batches):
        tree = StrTree(leaves[:, [0, 2]], leaves[:, [1, 3]])
        pad = radius_deg * (1 + 1e-9) + 1e-9
        for b in batches:
            ra, dec = b.column(1).to_numpy(), b.column(2).to_numpy()
            row, low, high = _boxes(ra, dec, pad)
            q, leaf = tree.overlaps(low, high)
            x0, y0 = _part(leaves, cuts, leaf, low[q, 0], low[q, 1])
            x1, y1 = _part(leaves, cuts, leaf, high[q, 0], high[q, 1])
            wide, tall = x1 - x0 + 1, y1 - y0 + 1
            k = np.repeat(np.arange(len(q)), wide * tall)
            step = np.arange(len(k)) - np.repeat(np.cumsum(wide * tall) - wide * tall, wide * tall)
            parts = _number(leaf[k], x0[k] + step // tall[k], y0[k] + step % tall[k])
            pairs = np.unique(np.c_[row[q[k]], parts], axis=0) if len(k) else np.empty((0, 2), np.int64)
            out = b.take(pa.array(pairs[:, 0]))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(pairs[:, 1])], [*b.schema.names, "leaf"])

    return assign


def _boxes(ra: np.ndarray, dec: np.ndarray, pad: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Search boxes with the row each is of; a cap over the 0/360 seam has two."""
    reach = cap_reach(dec, pad)
    n = np.arange(len(ra))
    west, east = ra - reach, ra + reach
    over, under = east > 360, west < 0
    row = np.concatenate([n, n[over], n[under]])
    x0 = np.concatenate([west, west[over] - 360, west[under] + 360])
    x1 = np.concatenate([east, east[over] - 360, east[under] + 360])
    return row, np.c_[x0, dec[row] - pad], np.c_[x1, dec[row] + pad]


class StrTree:
    """A bulk-loaded R-tree over boxes (sort-tile-recursive packing), probed by arrays of boxes."""

    def __init__(self, low: np.ndarray, high: np.ndarray):
        n = len(low)
        mid = (low + high) / 2
        slabs = max(1, int(np.ceil(np.sqrt(np.ceil(n / NODE)))))
        by_x = np.argsort(mid[:, 0], kind="stable")
        slab = np.empty(n, np.int64)
        slab[by_x] = np.arange(n) * slabs // max(n, 1)
        self.order = np.lexsort((mid[:, 1], slab))
        self.levels = [(low[self.order], high[self.order])]
        while len(self.levels[-1][0]) > NODE:
            lo, hi = self.levels[-1]
            starts = np.arange(0, len(lo), NODE)
            self.levels.append((np.minimum.reduceat(lo, starts), np.maximum.reduceat(hi, starts)))

    def overlaps(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, item) whose boxes touch."""
        if not len(self.order) or not len(low):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        top = len(self.levels[-1][0])
        q = np.repeat(np.arange(len(low)), top)
        node = np.tile(np.arange(top), len(low))
        for depth in range(len(self.levels) - 1, -1, -1):
            lo, hi = self.levels[depth]
            hit = (lo[node, 0] <= high[q, 0]) & (hi[node, 0] >= low[q, 0]) & (lo[node, 1] <= high[q, 1]) & (hi[node, 1] >= low[q, 1])
            q, node = q[hit], node[hit]
            if depth:
                size = len(self.levels[depth - 1][0])
                q = np.repeat(q, NODE)
                node = (node[:, None] * NODE + np.arange(NODE)).ravel()
                q, node = q[node < size], node[node < size]
        return q, self.order[node]


def _unit(ra: np.ndarray, dec: np.ndarray) -> np.ndarray:
    a, d = np.radians(ra), np.radians(dec)
    return np.c_[np.cos(d) * np.cos(a), np.cos(d) * np.sin(a), np.sin(d)]


PROBE_BLOCK = 20_000
#: A table of full parts is broadcast up to so many rows; their number is at most that of the points, or of the copies of probes, by the size of a full part.
MOST_BROADCAST = 1_000_000


def _match_leaf(radius_arcsec: float):
    limit2, pad = chord_of_arcsec(radius_arcsec) ** 2, radius_arcsec / 3600 * (1 + 1e-9) + 1e-9

    def match(probe: pa.Table, base: pa.Table) -> pa.Table:
        if not probe.num_rows or not base.num_rows:
            return pa.table({"probe_id": pa.array([], pa.int64()), "base_id": pa.array([], pa.int64()), "sep_arcsec": pa.array([], pa.float64())})
        pid, pra, pdec = (probe.column(c).to_numpy() for c in ("id", "ra", "dec"))
        bid, bra, bdec = (base.column(c).to_numpy() for c in ("id", "ra", "dec"))
        spot = np.c_[bra, bdec]
        tree, buv = StrTree(spot, spot), _unit(bra, bdec)
        found = []
        for at in range(0, len(pid), PROBE_BLOCK):
            part = slice(at, at + PROBE_BLOCK)
            row, low, high = _boxes(pra[part], pdec[part], pad)
            q, item = tree.overlaps(low, high)
            q = row[q]
            d2 = ((_unit(pra[part], pdec[part])[q] - buv[item]) ** 2).sum(axis=1)
            ok = d2 <= limit2
            q, item, d2 = q[ok], item[ok], d2[ok]
            keep = np.unique(np.c_[q, item], axis=0, return_index=True)[1]  # a cap that closes on itself at a pole
            q, item, d2 = q[keep], item[keep], d2[keep]
            found.append((pid[part][q], bid[item], np.degrees(2 * np.arcsin(np.minimum(np.sqrt(d2) / 2, 1))) * 3600))
        cols = [np.concatenate([f[i] for f in found]) if found else np.empty(0, t) for i, t in enumerate((np.int64, np.int64, np.float64))]
        return pa.table(dict(zip(("probe_id", "base_id", "sep_arcsec"), map(pa.array, cols), strict=True)))

    return match


def near_points(probe: DataFrame, base: DataFrame, radius_arcsec: float, leaf_rows: int = 20_000, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(probe_id, base_id, sep_arcsec) of all pairs at most ``radius_arcsec`` apart.

    Both sides: (id bigint, ra, dec) as ``sky_points`` gives them. ``leaf_rows`` is the number of
    base points a leaf should hold; the tree is grown from a sample, so it holds about that."""
    base, probe = materialise(base.select("id", "ra", "dec")), materialise(probe.select("id", "ra", "dec"))  # both are read for the tree, the counts and the search
    n, n_probes = base.count(), probe.count()
    share = min(1.0, sample_rows / max(n, 1))
    picked = base if share == 1.0 else base.where(F.xxhash64("id") < F.lit(int(-(2**63) + share * 2**64)))
    sample = np.array([(r.ra, r.dec) for r in picked.select("ra", "dec").collect()]).reshape(-1, 2)
    leaves = grow_quadtree(sample, max(8, int(leaf_rows * share)))
    radius_deg = radius_arcsec / 3600
    schema = "id bigint, ra double, dec double, leaf bigint"
    cuts = np.ones(len(leaves), np.int64)
    if share < 1.0:
        held = base.mapInArrow(_home_leaf(leaves, cuts), schema).groupBy((F.shiftright("leaf", 2 * CUT_BITS)).alias("leaf")).agg(F.count(F.lit(1)).alias("n"))
        for r in held.collect():  # a row per leaf
            cuts[r["leaf"]] = min(MOST_CUTS, max(1, round((r["n"] / (2 * leaf_rows)) ** 0.5)))
    homed = base.mapInArrow(_home_leaf(leaves, cuts), schema)
    touched = probe.mapInArrow(_touched_leaves(leaves, cuts, radius_deg), schema)
    full = 4 * leaf_rows
    sizes, probes = (df.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > full).select("leaf", batch_count(F.col("n"), full).alias(name)) for df, name in ((homed, "batches"), (touched, "probe_batches")))
    plan = sizes.join(probes, "leaf", "full")  # a row per part with more than ``full`` points or probes, hence few of them
    if (n + 9 * n_probes) // full <= MOST_BROADCAST:
        plan = F.broadcast(plan)
    batches, probe_batches = F.coalesce("batches", F.lit(1)), F.coalesce("probe_batches", F.lit(1))
    left = touched.join(plan, "leaf", "left").withColumn("probe_batch", F.pmod(F.xxhash64("id"), probe_batches).cast("int")).withColumn("batch", F.explode(F.sequence(F.lit(0), batches - 1)))
    right = homed.join(plan, "leaf", "left").withColumn("batch", F.pmod(F.xxhash64("id"), batches).cast("int")).withColumn("probe_batch", F.explode(F.sequence(F.lit(0), probe_batches - 1)))
    group, cols = ["leaf", "batch", "probe_batch"], ["id", "ra", "dec", "leaf", "batch", "probe_batch"]
    return left.select(cols).groupBy(*group).cogroup(right.select(cols).groupBy(*group)).applyInArrow(_match_leaf(radius_arcsec), "probe_id bigint, base_id bigint, sep_arcsec double")
