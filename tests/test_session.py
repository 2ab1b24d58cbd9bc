import time

from pyspark.sql import functions as F

from starweave.session import discard, free_shuffles, hash_joins, materialise


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (files.apply(k).getName() for k in range(files.size())) if f.startswith("shuffle_")}


def test_shuffle_files_of_the_last_plan_are_freed(spark):
    before = shuffle_files(spark)
    df = materialise(spark.range(10_000).repartition(3, "id"))
    assert shuffle_files(spark) - before
    free_shuffles(spark)
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    discard(df)


def test_small_parts_are_joined_by_hash(spark):
    key = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    before = spark.conf.get(key), spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")

    def joins():
        df = spark.range(20_000).withColumn("k", F.col("id") % 5_000).join(spark.range(5_000).withColumnRenamed("id", "k"), "k")
        assert len(df.collect()) == 20_000
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        return [name for name in ("ShuffledHashJoin", "SortMergeJoin", "BroadcastHashJoin") if name in plan]

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with hash_joins(spark):
            assert joins() == ["ShuffledHashJoin"]
        assert joins() == ["SortMergeJoin"] and spark.conf.get(key) == before[0]
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
        with hash_joins(spark):
            assert joins() == ["SortMergeJoin"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[1])
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before[2])
