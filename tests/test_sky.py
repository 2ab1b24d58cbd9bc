import numpy as np
import pytest
from pyspark.sql import functions as F

from starweave.functions.geometry import propagated, separation_arcsec
from starweave.functions.healpix import nested_cell
from starweave.operators.cone_join import cone_pairs, with_unit_vector
from starweave.operators.sky_quadtree import StrTree, grow_quadtree, near_points, sky_points

RADIUS = 8.0


def sky(rng, n):
    ra, dec = rng.uniform(0, 360, n), np.degrees(np.arcsin(rng.uniform(-1, 1, n)))
    ra[:40], dec[:40] = rng.uniform(0, 360, 40), 90 - rng.uniform(0, 0.004, 40)
    ra[40:80], dec[40:80] = rng.uniform(0, 360, 40), -90 + rng.uniform(0, 0.004, 40)
    ra[80:120], dec[80:120] = rng.uniform(-0.002, 0.002, 40) % 360, rng.uniform(-0.003, 0.003, 40)
    ra[120:200], dec[120:200] = 10 + rng.uniform(0, 0.004, 80), 60 + rng.uniform(0, 0.004, 80)
    return ra, dec


def unit(ra, dec):
    a, d = np.radians(ra), np.radians(dec)
    return np.c_[np.cos(d) * np.cos(a), np.cos(d) * np.sin(a), np.sin(d)]


def brute(p, b, radius=RADIUS):
    d = np.linalg.norm(unit(*p)[:, None] - unit(*b)[None], axis=2)
    return set(zip(*np.nonzero(d <= 2 * np.sin(np.radians(radius / 3600) / 2)), strict=True))


def frame(spark, ra, dec):
    return spark.createDataFrame([(i, float(a), float(d)) for i, (a, d) in enumerate(zip(ra, dec, strict=True))], "id long, ra double, dec double")


@pytest.fixture(scope="module")
def skies():
    return sky(np.random.default_rng(1), 700), sky(np.random.default_rng(900), 900)


def test_near_points_equals_brute_force(spark, skies):
    p, b = skies
    found = near_points(frame(spark, *p), frame(spark, *b), RADIUS, leaf_rows=30).collect()
    assert len(found) == len({(r.probe_id, r.base_id) for r in found})
    assert {(r.probe_id, r.base_id) for r in found} == brute(p, b)


def test_near_points_splits_a_full_leaf(spark):
    """All points at one place: the leaf cannot be split, its batches are."""
    same = (np.full(150, 33.0), np.full(150, -12.0))
    assert near_points(frame(spark, *same), frame(spark, *same), RADIUS, leaf_rows=10).count() == 150 * 150


def test_near_points_cuts_leaves_that_the_sample_left_full(spark, skies):
    """A sample too small for the leaves: they are cut by their counts, seam, poles and clusters included."""
    p, b = skies
    for sample_rows in (1, 20, 60):
        found = near_points(frame(spark, *p), frame(spark, *b), RADIUS, leaf_rows=15, sample_rows=sample_rows).collect()
        assert len(found) == len({(r.probe_id, r.base_id) for r in found})
        assert {(r.probe_id, r.base_id) for r in found} == brute(p, b)


def test_near_points_empty_and_unplaced(spark, skies):
    some = frame(spark, *skies[0])
    assert near_points(some, some.limit(0), RADIUS).count() == 0
    assert near_points(some.limit(0), some, RADIUS).count() == 0
    rows = [(1, 370.0, 5.0), (1, 10.0, 5.0), (2, None, 1.0), (3, float("nan"), 1.0), (4, 1.0, 95.0), (None, 1.0, 1.0), (5, float("inf"), 0.0)]
    df = spark.createDataFrame(rows, "a long, b double, c double").withColumn("dec", F.lit("x"))
    assert [r.id for r in sky_points(df, F.col("a"), F.col("b"), F.col("c")).collect()] == [1]


def test_tree_and_quadtree():
    rng = np.random.default_rng(3)
    low = rng.uniform(0, 100, (500, 2))
    high = low + rng.uniform(0, 3, (500, 2))
    qlow = rng.uniform(0, 100, (60, 2))
    qhigh = qlow + 4
    q, item = StrTree(low, high).overlaps(qlow, qhigh)
    want = {(i, j) for i in range(60) for j in range(500) if (low[j] <= qhigh[i]).all() and (high[j] >= qlow[i]).all()}
    assert set(zip(q.tolist(), item.tolist(), strict=True)) == want and len(q) == len(want)
    leaves = grow_quadtree(rng.uniform([0, -90], [360, 90], (1000, 2)), 50)
    assert np.isclose(((leaves[:, 1] - leaves[:, 0]) * (leaves[:, 3] - leaves[:, 2])).sum(), 360 * 180)


def test_cone_join_equals_brute_force(spark, skies):
    p, b = skies
    left = with_unit_vector(frame(spark, *b), "ra", "dec").select("id", "x", "y", "z")
    right = with_unit_vector(frame(spark, *p), "ra", "dec").select(F.col("id").alias("id2"), "x", "y", "z")
    found = cone_pairs(left, right, RADIUS).collect()
    assert {(r.id2, r.id) for r in found} == brute(p, b) and len(found) == len(brute(p, b))
    assert cone_pairs(left, right.limit(0), RADIUS).count() == 0


def test_propagation_and_separation(spark):
    lit = lambda x: F.lit(float(x))
    ra, dec = propagated(lit(0), lit(0), lit(1000), lit(0), 24.75)
    r = spark.range(1).select(ra.alias("ra"), dec.alias("dec"), separation_arcsec(lit(10), lit(0), lit(10 + 0.001 / 3600), lit(0)).alias("sep")).first()
    assert abs(r.ra - 24.75 / 3600) < 1e-6 and abs(r.dec) < 1e-9
    assert abs(r["sep"] - 0.001) < 1e-8


def test_healpix_cells_nest_and_are_even(spark):
    ra, dec = (x[200:] for x in sky(np.random.default_rng(5), 20_200))
    df = frame(spark, ra, dec).select(*[nested_cell(F.col("ra"), F.col("dec"), k).alias(f"c{k}") for k in (0, 1, 3)])
    rows = df.toPandas()
    assert sorted(rows.c0.unique()) == list(range(12)) and rows.c1.nunique() == 48
    assert (rows.c1 // 4 == rows.c0).all() and (rows.c3 // 16 == rows.c1).all()
    assert rows.c0.value_counts().min() > 20_000 / 12 * 0.85
