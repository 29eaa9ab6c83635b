"""Streaming invariants: batch result = stream result; a restart adds nothing."""

import os

from tessera import schemas
from tessera import testviews as tv
from tessera.plans import taxi
from tessera.streaming import taxi as st

SF = "/root/testdata/sf0.001"


def test_multi_batch_stream_equals_batch_and_restart_adds_nothing(spark, tmp_dir):
    # land the trips as several files so the stream really runs several batches
    src = os.path.join(tmp_dir, "landing")
    tv.trips(spark, SF).repartition(4).write.parquet(src)
    base = os.path.join(tmp_dir, "out")
    stream = st.read_stream(spark, src, schemas.TRIPS, max_files=1)
    q = st.ingest_stream(spark, stream, f"{base}/bronze", f"{base}/_ck_b")
    assert len(q.recentProgress) >= 4
    dropped = sum(p["observedMetrics"]["valid_distance"]["valid_distance_dropped"]
                  for p in q.recentProgress if "valid_distance" in p.get("observedMetrics", {}))
    st.flag_stream(spark, f"{base}/bronze", schemas.TRIPS, f"{base}/flagged", f"{base}/_ck_f")
    batch = taxi.run(tv.trips(spark, SF), exact_scale=6)
    bronze = spark.read.schema(schemas.TRIPS).parquet(f"{base}/bronze")
    assert bronze.count() == batch["bronze"].count()
    assert dropped == tv.trips(spark, SF).count() - bronze.count()
    flagged = spark.read.parquet(f"{base}/flagged")
    assert sorted(flagged.collect()) == sorted(batch["flagged"].collect())
    # restart both streams from their checkpoints: nothing new is written
    st.ingest_stream(spark, st.read_stream(spark, src, schemas.TRIPS, max_files=1),
                     f"{base}/bronze", f"{base}/_ck_b")
    st.flag_stream(spark, f"{base}/bronze", schemas.TRIPS, f"{base}/flagged", f"{base}/_ck_f")
    assert spark.read.schema(schemas.TRIPS).parquet(f"{base}/bronze").count() == bronze.count()
    assert spark.read.parquet(f"{base}/flagged").count() == flagged.count()
    st.refresh_weekly(spark, f"{base}/bronze", schemas.TRIPS, f"{base}/weekly", exact_scale=6)
    top = st.refresh_top_n(spark, f"{base}/flagged", f"{base}/weekly", f"{base}/top")
    assert sorted(top.collect()) == sorted(batch["top_n"].collect())


def test_weekly_stream_event_time(spark, tmp_dir):
    src = os.path.join(tmp_dir, "landing")
    tv.trips(spark, SF).where("tpep_pickup_datetime IS NOT NULL").write.parquet(src)
    b = taxi.bronze(st.read_stream(spark, src, schemas.TRIPS))
    q = (st.weekly_stream(b, delay="3650 days").writeStream.format("memory")
         .queryName("weekly_ev").outputMode("complete").start())
    q.processAllAvailable()
    q.stop()
    got = {r["week"]: (r["avg_amount"], r["avg_distance"]) for r in spark.table("weekly_ev").collect()}
    want = {r["week"]: (r["avg_amount"], r["avg_distance"])
            for r in taxi.weekly_stats(taxi.bronze(spark.read.parquet(src)), exact_scale=None).collect()}
    assert set(got) == set(want)
    for k in want:
        assert abs(got[k][0] - want[k][0]) < 1e-9 and abs(got[k][1] - want[k][1]) < 1e-9
    assert all(k.weekday() == 0 for k in got)  # Monday-aligned windows


def test_new_files_are_processed_once(spark, tmp_dir):
    src = os.path.join(tmp_dir, "landing")
    trips = tv.trips(spark, SF)
    trips.where("pickup_zip < 5").write.parquet(src)
    base = os.path.join(tmp_dir, "out")

    def run():
        st.ingest_stream(spark, st.read_stream(spark, src, schemas.TRIPS),
                         f"{base}/bronze", f"{base}/_ck")
        return spark.read.schema(schemas.TRIPS).parquet(f"{base}/bronze").count()

    first = run()
    # a new landing file arrives: only it is processed by the next run
    trips.where("pickup_zip >= 5").write.mode("append").parquet(src)
    second = run()
    assert first == taxi.bronze(trips.where("pickup_zip < 5")).count()
    assert second == taxi.bronze(trips).count()
    assert run() == second


def test_stateful_weekly_stream_keeps_state_across_restart(spark, tmp_dir):
    src = os.path.join(tmp_dir, "bronze")
    trips = taxi.bronze(tv.trips(spark, SF))
    trips.where("pickup_zip < 5").write.parquet(src)
    out, ck = os.path.join(tmp_dir, "weekly"), os.path.join(tmp_dir, "_ck")
    st.weekly_state_stream(spark, src, schemas.TRIPS, out, ck, exact_scale=6)
    trips.where("pickup_zip >= 5").write.mode("append").parquet(src)
    st.weekly_state_stream(spark, src, schemas.TRIPS, out, ck, exact_scale=6)   # restart: new file only
    got = sorted(spark.read.parquet(out).collect())
    want = sorted(taxi.weekly_stats(trips, 6).collect())
    assert got == want


def test_expectation_counts_are_exact_over_many_batches_and_a_restart(spark, tmp_dir):
    src, base = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    trips = tv.trips(spark, SF).limit(260)

    def land(part, n):
        part.repartition(n).write.mode("append").parquet(src)
        st.ingest_stream(spark, st.read_stream(spark, src, schemas.TRIPS, max_files=1), f"{base}/bronze",
                         f"{base}/_ck", metrics=f"{base}/metrics")

    land(trips, 105)
    land(trips, 4)
    got = st.total_counts(spark, f"{base}/metrics").first()
    kept = trips.where(taxi.distance_ok()).count()
    assert (got["rows_seen"], got["rows_kept"], got["rows_dropped"]) == (520, 2 * kept, 520 - 2 * kept)
    assert len([d for d in os.listdir(f"{base}/metrics") if d.startswith("batch=")]) > 100
    # a repeated batch replaces its own row
    first = spark.read.schema(schemas.TRIPS).parquet(src).limit(0)
    st.expectation_counts(first, taxi.VALID_DISTANCE, taxi.distance_ok()).write.mode("overwrite").parquet(
        f"{base}/metrics/batch=0")
    assert st.total_counts(spark, f"{base}/metrics").first()["rows_seen"] < 520
