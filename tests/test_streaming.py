from datetime import datetime

from starweave.operators import match_evidence as me
from starweave.streaming.new_deliveries import append_pairs, delivery_stream, stream_pairs
from tests.test_match import AS, GAIA, hip

SCHEMA = GAIA.replace("timestamp_ntz", "timestamp")


def test_new_files_give_new_pairs_once(spark, tmp_path):
    t = datetime(2025, 1, 1)
    row = lambda i, ra: (i, ra, 0.0, 9.0, 9.0, 9.0, 1.0, 0.1, t)
    source, out, mark = (str(tmp_path / p) for p in ("in", "out", "mark"))
    h = hip(spark, [(10, 10.0, 9.0, 1.0), (20, 20.0, 9.0, 1.0)])

    def run():
        append_pairs(stream_pairs(delivery_stream(spark, source, SCHEMA), h, me.MAX_SEP_ARCSEC), out, mark).awaitTermination()
        return sorted((r.gaia_source_id, r.hip_source_id) for r in spark.read.parquet(out).collect())

    spark.createDataFrame([row(1, 10 + AS), row(1, 10 + AS), row(2, 50.0)], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    assert run() == [(1, 10)]
    spark.createDataFrame([row(3, 20 + AS), row(1, 10 + AS), (4, None, 0.0, 9.0, 9.0, 9.0, 1.0, 0.1, t)], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    assert run() == [(1, 10), (3, 20)]
