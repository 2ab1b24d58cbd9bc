from datetime import datetime

from pyspark.sql import functions as F

from starweave.operators.latest import latest_values
from starweave.operators.rules import Rule, decide
from starweave.operators.skew import batch_count, hot_salts, join_hot
from starweave.session import _written, discard, materialise, shared_folder, spread


def test_hot_keys_get_salts_by_their_rows(spark):
    counts = spark.createDataFrame([(k, {1: 90_000, 2: 500_000}.get(k, 50_000)) for k in range(100)], "k long, n long")
    assert sorted(map(tuple, hot_salts(counts, "k", "n").collect())) == [(1, 2), (2, 10)]
    assert hot_salts(counts.where("k > 2"), "k", "n").isEmpty() and hot_salts(counts.limit(0), "k", "n").isEmpty()


def test_salted_join_equals_plain_join(spark):
    big = spark.range(3000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    small = spark.createDataFrame([(k, f"x{k}") for k in range(5)], "k long, t string")
    plain = sorted(map(tuple, big.join(small, "k").collect()))
    counts = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    for rows in (60, 400, 1_000):
        assert sorted(map(tuple, join_hot(big, small, "k", hot_salts(counts, "k", "n", rows), salt_by="v").select("k", "v", "t").collect())) == plain
    assert [r.b for r in spark.createDataFrame([(0,), (10,), (11,)], "n long").select(batch_count(F.col("n"), 10).alias("b")).collect()] == [1, 1, 2]


def test_latest_values(spark):
    t = lambda d: datetime(2025, 1, d)
    rows = [(1, 5.0, None, t(1)), (1, None, 7.0, t(2)), (1, 6.0, 8.0, t(1)), (1, 6.0, 8.0, t(1)), (None, 1.0, 1.0, t(1)), (2, None, None, None), (3, 4.0, None, None)]
    df = spark.createDataFrame(rows, "k long, a double, b double, at timestamp_ntz").withColumn("id", F.lit("clash"))
    got = {r.id: (r.a, r.b) for r in latest_values(df, "k", {"a": F.col("a"), "b": F.col("b")}, "at").collect()}
    assert got == {1: (6.0, 7.0), 2: (None, None), 3: (4.0, None)}


def test_materialise_cuts_and_discards(spark):
    df = materialise(spark.range(10).withColumn("x", F.col("id") * 2))
    assert df.count() == 10 and df.inputFiles()[0].split("///")[-1].startswith(shared_folder(spark).split("///")[-1].lstrip("/"))
    assert "Range" not in df._jdf.queryExecution().toString()
    discard(df)
    discard(spark.range(1))
    kept = {*_written(spark)}
    left = materialise(spark.range(3))
    assert len(_written(spark) - kept) == 1
    discard(left)
    assert _written(spark) == kept
    assert spread(spark.range(10).coalesce(1)).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_first_rule_decides(spark):
    rules = [Rule(F.col("id") > 2, "a", "x", "high", ("big",)), Rule(F.col("id") > 0, "b", "y", "low", ("some", "more"))]
    found = decide(rules, [F.lit("always"), F.when(F.col("id") == 1, "one")])
    rows = spark.range(4).withColumns(found).orderBy("id").collect()
    assert [(r.decision, r.severity, r.reasons) for r in rows] == [(None, None, None), ("b", "low", "always;one;some;more"), ("b", "low", "always;some;more"), ("a", "high", "always;big")]
