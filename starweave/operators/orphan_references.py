"""References to records that are missing, deleted or came later.

Parent keys are range-partitioned; each range holds its keys as one sorted array, and a batch of
references is probed against it by binary search (``numpy.searchsorted``). The ranges come from
quantiles of the distinct parent keys, so they hold about ``keys_per_range`` keys each.

References to one hot key would all meet in one range: each range's references are therefore spread
over batches of about ``batch_rows`` rows, and the range's key array is repeated per batch. No group
is larger than one range plus one batch.

Defined results: NULL keys are no references; a repeated reference row counts once; a NULL
``loaded_at`` of a parent never makes it late; a NULL reference time can be missing or deleted, not
late; equal decision times: the greater action word counts; without parents every reference is missing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweave.functions.numeric import plain_word
from starweave.operators.skew import batch_count
from starweave.session import materialise

#: The driver holds at most this many range borders (8 bytes each): enough for 65 billion keys in ranges of a million.
MAX_RANGES = 1 << 16

MISSING, DELETED, LATE = 1, 2, 3


def parent_keys(tables: dict[str, DataFrame], decisions: DataFrame, dropped: str = "drop") -> DataFrame:
    """One row per (target, key): the first arrival and whether the latest decision drops the key.

    ``tables``: target name to (key, loaded_at). ``decisions``: (key, action, decided_at)."""
    arrivals = None
    for name, df in tables.items():
        one = df.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("loaded_at").alias("first_loaded")).select(F.lit(name).alias("target"), "key", "first_loaded")
        arrivals = one if arrivals is None else arrivals.unionByName(one)
    latest = (
        decisions.where(F.col("key").isNotNull() & F.col("decided_at").isNotNull())
        .groupBy("key")
        .agg(F.max(F.struct("decided_at", plain_word("action").alias("action"))).alias("last"))
        .select("key", (F.coalesce(F.col("last.action"), F.lit("")) == dropped).alias("is_dropped"))
    )
    return arrivals.join(latest, "key", "left").withColumn("is_dropped", F.coalesce("is_dropped", F.lit(False)))


def range_borders(keys: DataFrame, keys_per_range: int) -> np.ndarray:
    """Ascending borders between ranges of about ``keys_per_range`` distinct keys."""
    n = keys.count()
    ranges = min(MAX_RANGES, max(1, -(-n // keys_per_range)))
    if ranges == 1:
        return np.empty(0, np.int64)
    found = keys.agg(F.percentile_approx("key", [i / ranges for i in range(1, ranges)], max(10_000, 4 * ranges)).alias("q")).first()["q"]
    return np.unique(np.array(found, np.int64))


def _with_range(borders: np.ndarray, at: int):
    def assign(batches):
        for b in batches:
            which = np.searchsorted(borders, b.column(at).to_numpy(zero_copy_only=False), side="right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(which)], [*b.schema.names, "range_id"])

    return assign


def _probe(refs: pa.Table, parents: pa.Table) -> pa.Table:
    keys = parents.column("key").to_numpy()
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    far = np.iinfo(np.int64).max
    loaded = parents.column("first_loaded_us").fill_null(-far).to_numpy()[order]
    dropped = parents.column("is_dropped").to_numpy()[order]
    want = refs.column("key").to_numpy()
    at = np.minimum(np.searchsorted(keys, want), max(len(keys) - 1, 0))
    if len(keys):
        there = keys[at] == want
        late = loaded[at] > refs.column("ref_us").fill_null(far).to_numpy()
        code = np.where(~there, MISSING, np.where(dropped[at], DELETED, np.where(late, LATE, 0)))
    else:
        code = np.full(len(want), MISSING)
    return refs.append_column("code", pa.array(code.astype(np.int32))).select(["from_table", "record_id", "target", "key", "ref_us", "code"]).filter(pa.array(code > 0))


def orphan_references(refs: DataFrame, parents: DataFrame, keys_per_range: int = 65_536, batch_rows: int = 200_000) -> DataFrame:
    """References with a status: from_table, record_id, target_table, key, ref_time, status.

    ``refs``: (from_table, record_id, target, key, ref_time). ``parents``: see ``parent_keys``."""
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    parents = materialise(parents)
    borders = range_borders(parents.select("key").distinct(), keys_per_range)
    refs = refs.where(F.col("key").isNotNull()).select("from_table", "record_id", "target", "key", us("ref_time").alias("ref_us")).distinct()
    ranged = refs.mapInArrow(_with_range(borders, 3), "from_table string, record_id bigint, target string, key bigint, ref_us bigint, range_id int")
    held = parents.select("target", "key", us("first_loaded").alias("first_loaded_us"), "is_dropped").mapInArrow(_with_range(borders, 1), "target string, key bigint, first_loaded_us bigint, is_dropped boolean, range_id int")
    sizes = ranged.groupBy("target", "range_id").agg(F.count(F.lit(1)).alias("n")).select("target", "range_id", batch_count(F.col("n"), batch_rows).alias("batches"))
    sizes = F.broadcast(sizes)  # one small row per range and target: at most MAX_RANGES of them per target
    left = ranged.join(sizes, ["target", "range_id"]).withColumn("batch", F.pmod(F.xxhash64("from_table", "record_id", "key"), F.col("batches")).cast("int")).drop("batches")
    right = held.join(sizes, ["target", "range_id"]).withColumn("batch", F.explode(F.sequence(F.lit(0), F.col("batches") - 1))).drop("batches")
    group = ["target", "range_id", "batch"]
    found = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(_probe, "from_table string, record_id bigint, target string, key bigint, ref_us bigint, code int")
    words = F.array(F.lit("missing"), F.lit("deleted"), F.lit("late"))
    return found.select("from_table", "record_id", F.col("target").alias("target_table"), "key", F.timestamp_micros("ref_us").alias("ref_time"), words[F.col("code") - 1].alias("status"))


def orphan_report(found: DataFrame) -> DataFrame:
    """Orphans per referring table, target and month."""
    month = F.date_format("ref_time", "yyyy-MM").alias("ref_month")
    return found.groupBy("from_table", "target_table", month, "status").agg(F.count(F.lit(1)).alias("n_references"), F.countDistinct("key").alias("n_keys"))
