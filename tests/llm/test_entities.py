import numpy as np
import pytest
from pyspark.sql import functions as F

from starweave.llm import entity_match as em
from starweave.llm.entity_match import fit_evidence, match_entities
from starweave.session import materialise

GAIA = "source_id long, ra_deg double, dec_deg double, phot_g_mean_mag double, phot_bp_mean_mag double, phot_rp_mean_mag double, parallax double, parallax_error double, loaded_at timestamp_ntz, id string"
HIP = "hip long, rarad double, derad double, pmra double, pmde double, hpmag double, plx double, e_plx double, sn int, b_v double, loaded_at timestamp_ntz, mag string"


def sky(n, shift, slope, ratio, seed=12):
    """(survey rows, catalogue rows, true pairs); the magnitudes and colours of both differ by the given relation."""
    rng = np.random.default_rng(seed)
    gaia, hip, want = [], [], set()
    for i in range(n):
        ra, dec = rng.uniform(0, 360), rng.uniform(-80, 80)
        color, mag, plx = rng.uniform(0.2, 1.8), rng.uniform(5, 11), rng.uniform(1, 30)
        off = rng.normal(0, 0.05 if i % 5 else 0.6, 2) / 3600
        hip.append((i + 1, ra, dec, 0.0, 0.0, mag, plx + rng.normal(0, 0.8), 0.8, 5, ratio * color + 0.05 + rng.normal(0, 0.04), None, "m"))
        g = mag - shift - slope * color + rng.normal(0, 0.04)
        if i % 7:
            gaia.append((10**15 + i, ra + off[0] / np.cos(np.radians(dec)), dec + off[1], g, g + color / 2, g - color / 2, plx, 0.03, None, "z"))
            want.add((10**15 + i, i + 1))
        if i % 2:
            near = rng.uniform(0.5, 2.5) / 3600
            gaia.append((2 * 10**15 + i, ra, dec + near, g + rng.uniform(1.5, 4), g + 3, g + 1.5, plx if i % 4 == 1 else rng.uniform(0.3, 2), 0.03, None, "z"))
    gaia += [(3 * 10**15 + k, float(rng.uniform(0, 360)), float(rng.uniform(-80, 80)), 12.0, 12.5, 11.5, 1.0, 0.1, None, "z") for k in range(n)]
    clean = lambda rows: [tuple(float(v) if isinstance(v, np.floating) else v for v in r) for r in rows]
    return clean(gaia), clean(hip), want


@pytest.mark.parametrize("relation", [(0.3, 0.4, 0.6), (-0.5, -0.2, 1.2)])
def test_held_out_accuracy(spark, relation):
    """The relation of magnitudes and colours is found in the rows, whatever it is."""
    gaia, hip, want = sky(500, *relation)
    rows = match_entities(spark.createDataFrame(gaia + gaia[:20], GAIA), spark.createDataFrame(hip + hip[:20], HIP)).collect()
    assert len(rows) == len({(r.id, r.id2) for r in rows})
    got = {(r.id, r.id2) for r in rows if r.confidence >= 0.5}
    assert len(got & want) / len(want) > 0.97 and len(got & want) / len(got) > 0.97
    assert len({(r.id, r.id2) for r in rows} & want) / len(want) > 0.98  # blocking against all true pairs


def test_relation_is_fitted(spark):
    rng = np.random.default_rng(4)
    rows = []
    for k in range(400):
        color = float(rng.uniform(0, 2))
        wrong = float(rng.uniform(1, 4)) if k % 10 == 0 else 0.0
        rows.append((0.2, 8.0, 8.0 + 0.3 + 0.4 * color + float(rng.normal(0, 0.03)) - wrong, color, 0.7 * color - 0.1))
    lines = em.fit_lines(spark.createDataFrame(rows, "sep double, mag double, mag2 double, colour double, colour2 double"))
    assert np.allclose(lines["mag"], (0.3, 0.4), atol=0.05) and np.allclose(lines["colour"], (-0.1, 0.7), atol=1e-6)
    few = em.fit_lines(spark.createDataFrame(rows[1:4], "sep double, mag double, mag2 double, colour double, colour2 double"))
    assert few["mag"][1] == 0.0


def sources(spark, gaia, hip):
    second = materialise(em.second_source(spark.createDataFrame(hip, HIP)))
    first = materialise(em.first_source(spark.createDataFrame(gaia, GAIA), em.cells_within_reach(second)))
    return first, second, materialise(em.shared_tokens(first, second))


def blocked(rows, vectors, bits, tables):
    return {(r.id, r.id2) for r in em.bucket_pairs(rows, em.vector_tables(vectors), bits, tables).collect()}


def test_training_decides_what_is_found(spark):
    """Hyperplanes over vectors that were not trained lose pairs that those over trained ones keep."""
    gaia, hip, want = sky(4_000, 0.3, 0.4, 0.6)
    first, second, rows = sources(spark, gaia, hip)
    vectors = em.train_vectors(rows, rows.count())
    trained, not_trained = (len(blocked(rows, v, 14, 6) & want) / len(want) for v in (vectors, {}))
    assert trained > not_trained + 0.1, (trained, not_trained)
    planned = blocked(rows, vectors, *em.table_plan(4_000, 4_000))
    assert len(planned & want) / len(want) > 0.99


def many_records(spark, n_cells):
    """One record of either source in each cell; every 400th cell has magnitudes that no other record has."""
    m = F.when(F.col("id") % 400 == 0, 100 + F.col("id") / 400).otherwise(F.col("id") % 20)
    rows = spark.range(n_cells).select(F.explode(F.array(F.lit(0), F.lit(1))).alias("src"), "id", F.xxhash64("id").alias("cell"), m.cast("smallint").alias("m"))
    bins = (F.when(F.col("id") % 7 > 0, F.col("id") % 5).cast("smallint").alias("c"), (F.col("id") % 3).cast("smallint").alias("p"))
    return materialise(rows.select("*", *bins, F.lit(2).cast("bigint").alias("n")))


def test_vectors_are_trained_on_every_record(spark):
    """More records than any sample held: words that a single record has are trained, and partitions change nothing."""
    rows = many_records(spark, 16_000)
    vectors = em.train_vectors(rows, 32_000)
    assert {f"m{src}_{100 + k}" for src in (0, 1) for k in range(40)} <= vectors.keys()
    names = rows.select(*[F.pmod(F.xxhash64("cell", F.lit(k)), F.lit(em.LOCATION_NAMES)).alias(kind) for k, kind in enumerate("kl")]).collect()
    assert {f"{kind}{r[kind]}" for r in names for kind in "kl"} == {w for w in vectors if w[0] in "kl"}
    again = em.train_vectors(rows.repartition(7), 32_000)
    assert vectors.keys() == again.keys() and all(np.allclose(vectors[w], again[w], atol=1e-5) for w in vectors)


def test_walks_start_at_every_record_and_follow_tokens(spark):
    rows = many_records(spark, 1_000)
    nodes, tokens = em.graph(rows)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(em, "SALT_ROWS", 20)
        seats = em.seated(nodes, tokens).groupBy("token").agg(F.sort_array(F.collect_list("seat")).alias("seats")).collect()
        found = [r.path for r in em.walks(nodes, tokens).collect()]
    assert all(r.seats == list(range(len(r.seats))) for r in seats) and max(len(r.seats) for r in seats) > 300
    assert len(found) == em.WALKS * 2_000 and all(len(p) == 2 * (em.STEPS + 1) for p in found)
    codes = lambda b: {(((b >> 51) + 2 * k) << 17) | ((b >> (17 * (2 - k))) & 0x1FFFF) for k in range(3)}
    steps = [(p[k : k + 2], p[k + 2 : k + 4]) for p in found for k in (0, 2, 4)]
    assert all(a[0] == b[0] or codes(a[1]) & codes(b[1]) for a, b in steps)
    stays = sum(a[0] == b[0] for a, b in steps) / len(steps)
    assert 0.47 < stays < 0.56, stays


def test_pairs_of_a_crowded_field_are_found(spark):
    """20,000 survey records in one cell, some of which are catalogue stars."""
    gaia, hip, want = sky(300, 0.3, 0.4, 0.6)
    rng = np.random.default_rng(5)
    ra, dec = 40.0, 10.0
    for k in range(20_000):
        x, y = rng.uniform(-8, 8, 2) / 3600
        mag, color = float(rng.uniform(5, 15)), float(rng.uniform(0.2, 1.8))
        gaia.append((5 * 10**15 + k, float(ra + x / np.cos(np.radians(dec))), float(dec + y), mag, mag + color / 2, mag - color / 2, 2.0, 0.1, None, "z"))
        if k % 100 == 0:
            hip.append((10_000 + k, gaia[-1][1], gaia[-1][2], 0.0, 0.0, mag + 0.3 + 0.4 * color, 2.0, 0.8, 5, 0.6 * color + 0.05, None, "m"))
            want.add((5 * 10**15 + k, 10_000 + k))
    first, second, rows = sources(spark, gaia, hip)
    total, n_second = rows.count(), rows.where("src = 1").count()
    assert rows.agg({"n": "max"}).first()[0] > 5_000
    for salt_rows in (em.SALT_ROWS, 500):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(em, "SALT_ROWS", salt_rows)
            got = blocked(rows, em.train_vectors(rows, total), *em.table_plan(total - n_second, n_second))
        assert len(got & want) / len(want) > 0.99


def test_unrecorded_motion_widens_the_reach(spark):
    gaia, hip, _ = sky(300, 0.3, 0.4, 0.6)
    moved = 25.0 / 3600
    for k, motion in enumerate((None, 0.0)):
        hip.append((9_000 + k, 100.0 + k, 20.0, motion, motion, 7.0, 40.0, 0.5, 5, 0.6, None, "m"))
        gaia.append((9 * 10**15 + k, 100.0 + k, 20.0 + moved, 6.5, 7.0, 6.0, 40.0, 0.05, None, "z"))
    got = {(r.id, r.id2): r.sep for r in match_entities(spark.createDataFrame(gaia, GAIA), spark.createDataFrame(hip, HIP)).collect()}
    assert abs(got[9 * 10**15, 9_000] - 25.0) < 0.01 and (9 * 10**15 + 1, 9_001) not in got
    assert all(s <= em.REACH for (_, b), s in got.items() if b != 9_000)


def test_missing_values_and_empty_sides(spark):
    gaia, hip, _ = sky(20, 0.3, 0.4, 0.6)
    odd = [(1, None, 5.0, None, None, None, None, None, None, "z"), (None, 1.0, 1.0, 5.0, 5.0, 5.0, 1.0, 1.0, None, "z"), (2, 1.0, 200.0, 5.0, float("nan"), 5.0, -1.0, float("inf"), None, "z")]
    assert match_entities(spark.createDataFrame(odd, GAIA), spark.createDataFrame(hip[:5], HIP)).count() == 0
    assert match_entities(spark.createDataFrame([], GAIA), spark.createDataFrame(hip[:5], HIP)).count() == 0
    assert match_entities(spark.createDataFrame(gaia[:5], GAIA), spark.createDataFrame([], HIP)).count() == 0
    bare = [(7, 30.0, 10.0, None, None, None, None, None, None, "z")], [(8, 30.0, 10.0, 1.0, 1.0, None, None, None, 5, None, None, "m")]
    assert match_entities(spark.createDataFrame(bare[0], GAIA), spark.createDataFrame(bare[1], HIP)).count() == 1


def test_evidence_fit_without_patterns():
    prior, evidence = fit_evidence(np.empty((0, 5), np.int64), np.empty(0))
    assert np.isfinite(prior) and all(np.isfinite(v).all() for v in evidence.values())


def test_tables_grow_with_the_bits():
    small, large = em.table_plan(10**4, 10**4), em.table_plan(10**9, 10**9)
    assert small[0] < large[0] < em.MOST_BITS and small[1] < large[1] < 50
    for bits, tables in (small, large):
        assert (1 - em.AGREE**bits) ** tables <= em.MISS


def test_packed_places(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(500, 3))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([tuple(map(float, r)) for r in v], "x double, y double, z double")
    rows = df.select("x", "y", "z", em._packed().alias("place")).select("x", "y", "z", *[(c - 1.0).alias(f"p{k}") for k, c in enumerate(em._unpacked("place"))]).select(F.max(F.greatest(*[F.abs(F.col(a) - F.col(b)) for a, b in (("x", "p0"), ("y", "p1"), ("z", "p2"))])))
    assert rows.first()[0] < 2.0 / em.PACK


def test_strips_change_no_pair(spark):
    """Records of one bucket meet by strips, narrow ones that wide reaches span too; the pairs are those within reach."""
    gaia, hip, _ = sky(400, 0.3, 0.4, 0.6)
    hip += [(20_000 + k, g[1] + 0.002, g[2] + 0.008, None, None, g[3], 2.0, 0.8, 5, 0.6, None, "m") for k, g in enumerate(gaia[:300])]
    first, second, rows = sources(spark, gaia, hip)
    a, b = ([(r.id, r.x, r.y, r.z, r.wide) for r in df.collect()] for df in (first, second))
    pa, pb = (np.array([r[1:4] for r in side]) for side in (a, b))
    reach = np.array([em.WIDE_RADIUS if r[4] else em.RADIUS for r in b])
    want = {(a[i][0], b[j][0]) for i, j in zip(*np.nonzero(((pa[:, None] - pb[None]) ** 2).sum(axis=2) <= reach**2), strict=True)}
    assert sum(j >= 20_000 for _, j in want) > 200
    for bits in (4, em.STRIP_BITS):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(em, "STRIP_BITS", bits)
            got = blocked(rows, {}, 1, 60)
        assert want <= got and len(got) < 1.05 * len(want)


def test_members_of_tokens_are_shuffled_once_for_all_steps(spark):
    nodes, tokens = em.graph(many_records(spark, 1_000))
    df = em.walks(nodes, tokens)
    assert len(df.collect()) == em.WALKS * 2_000
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Window [row_number()") == 1, plan


def test_attribute_words_have_one_vector_each():
    known = {"m0_3": np.ones(em.DIMENSIONS, np.float32)}
    bins = [em.pa.array(v, em.pa.int16()) for v in ([3, None, 3, -2], [None] * 4, [1, 1, 1, 1])]
    got = em.attribute_part(known, np.array([0, 0, 1, 1]), *bins)
    want = [sum(em.ATTRIBUTE_WEIGHT * known[w] for w in words.split()) for words in ("m0_3 c0_none p0_1", "m0_none c0_none p0_1", "m1_3 c1_none p1_1", "m1_-2 c1_none p1_1")]
    assert np.allclose(got, want, atol=1e-6) and len(known) == 8
