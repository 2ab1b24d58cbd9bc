import random

from pyspark.sql import functions as F

from starweave.llm.components import connected_components


def union_find(pairs):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in list(parent)}


def run(spark, pairs, **how):
    df = spark.createDataFrame(pairs, "a long, b long").withColumn("node", F.lit("x")).withColumn("u", F.lit(1))
    rows = connected_components(df, "a", "b", **how).collect()
    assert len(rows) == len({r.node for r in rows})
    return {r.node: r.component for r in rows}


def test_random_graph_chain_and_hub(spark):
    rng = random.Random(2)
    pairs = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(250)]
    pairs += [(1000 + i, 1001 + i) for i in range(60)]
    pairs += [(5000, 6000 + i) for i in range(200)]
    pairs += [(9, 9), (7777, 7777), (None, 3), (4, None), (-5, 2**62)] + pairs[:30] + [(b, a) for a, b in pairs[:30]]
    assert run(spark, pairs) == union_find(pairs)
    assert run(spark, pairs, salt_rows=20) == union_find(pairs)


def test_no_edges(spark):
    assert run(spark, []) == {}
    assert run(spark, [(None, 1)]) == {}
