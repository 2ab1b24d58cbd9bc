import random
from datetime import datetime, timedelta

from starweave.operators.orphan_references import orphan_references, orphan_report, parent_keys

T0 = datetime(2025, 1, 1)
REFS = "from_table string, record_id long, target string, key long, ref_time timestamp_ntz"


def brute(refs, parents, decisions):
    first, last, out = {}, {}, set()
    for name, rows in parents.items():
        for k, t in rows:
            if k is not None:
                first.setdefault((name, k), []).append(t)
    for k, a, t in decisions:
        if k is not None and t is not None and (k not in last or (t, a) > last[k]):
            last[k] = (t, a)
    for f, r, target, k, t in refs:
        if k is None:
            continue
        times = [x for x in first.get((target, k), []) if x is not None]
        if (target, k) not in first:
            out.add((f, r, target, k, "missing"))
        elif k in last and last[k][1].strip().lower() == "drop":
            out.add((f, r, target, k, "deleted"))
        elif times and t is not None and min(times) > t:
            out.add((f, r, target, k, "late"))
    return out


def run(spark, refs, parents, decisions, **kw):
    tables = {n: spark.createDataFrame(r, "key long, loaded_at timestamp_ntz") for n, r in parents.items()}
    keys = parent_keys(tables, spark.createDataFrame(decisions, "key long, action string, decided_at timestamp_ntz"))
    return orphan_references(spark.createDataFrame(refs, REFS), keys, **kw)


def test_against_brute_force_with_hot_key(spark):
    rng = random.Random(4)
    when = lambda: rng.choice([None, *[T0 + timedelta(days=rng.randint(0, 90)) for _ in range(9)]])
    parents = {n: [(rng.choice([None, *range(300)]), when()) for _ in range(500)] for n in ("a", "b")}
    decisions = [(rng.randint(0, 300), rng.choice(["drop", " DROP ", "keep"]), when()) for _ in range(150)]
    refs = [("r", i, rng.choice("ab"), 7 if i % 3 == 0 else rng.choice([None, *range(-5, 320), 2**60]), when()) for i in range(2000)]
    refs += refs[:50]
    got = run(spark, refs, parents, decisions, keys_per_range=40, batch_rows=100)
    assert {(r.from_table, r.record_id, r.target_table, r.key, r.status) for r in got.collect()} == brute(refs, parents, decisions)
    assert orphan_report(got).count() > 0


def test_empty_sides(spark):
    refs = [("r", 1, "a", 5, T0)]
    assert [r.status for r in run(spark, refs, {"a": []}, []).collect()] == ["missing"]
    assert run(spark, [], {"a": [(1, T0)]}, []).count() == 0
