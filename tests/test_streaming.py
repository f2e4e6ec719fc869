"""Streaming jobs: batch equivalence, restart and replay without duplicates,
late rows kept, folds that survive a crash, records landed by outcome."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from portolan.streaming import jobs
from portolan.streaming.sinks import UpsertSink, read_latest

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def _write(spark, folder, name, rows):
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def _events_stream(spark, folder):
    schema = spark.createDataFrame([], EVENTS).schema
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(folder)


def _weekly(spark, src, out, **options):
    job = jobs.WeeklyRates(f"{out}/t", **options)
    job.start(jobs.rate_events(_events_stream(spark, src)), f"{out}/c").awaitTermination()
    return job


def test_weekly_windows_start_monday_and_restart_is_idempotent(spark):
    src, out = tempfile.mkdtemp(prefix="src-"), tempfile.mkdtemp(prefix="out-")
    _write(spark, src, "b1", [(1, dt.datetime(2024, 1, 3, 12), 1, "E", 4.0, '{"k": 1}'),
                               (2, dt.datetime(2024, 1, 9, 12), 1, "E", 5.0, '{"k": 2}')])
    first = {(r.currency, r.week_start): r for r in _weekly(spark, src, out).weeks(spark).collect()}
    assert first[("E", dt.date(2024, 1, 1))].week_end == dt.date(2024, 1, 8)
    assert first[("E", dt.date(2024, 1, 1))].n_rates == 1
    # restart with the same checkpoint and one more file: no duplicates, week updated
    _write(spark, src, "b2", [(3, dt.datetime(2024, 1, 10, 8), 1, "E", 7.0, '{"k": 3}')])
    latest = _weekly(spark, src, out).weeks(spark).collect()
    assert len(latest) == 2
    wk2 = [r for r in latest if r.week_start == dt.date(2024, 1, 8)][0]
    assert (wk2.n_rates, wk2.min_rate, wk2.max_rate, wk2.avg_rate) == (2, 5.0, 7.0, 6.0)


def test_files_out_of_order_leave_late_rows_and_lose_none(spark):
    src, out = tempfile.mkdtemp(prefix="src-"), tempfile.mkdtemp(prefix="out-")
    batches = [[(1, dt.datetime(2024, 1, 10), 1, "E", 4.0, None)],
               [(2, dt.datetime(2024, 1, 2), 1, "E", 9.0, None),    # its week ended before 01-09: late
                (3, dt.datetime(2024, 1, 8, 1), 1, "E", 8.0, None)],  # old, but its week is open
               [(4, None, 1, "E", 1.0, None), (5, dt.datetime(2024, 1, 30), 1, None, None, None)],
               [(6, dt.datetime(2024, 1, 20), 1, "E", 3.0, None), (7, dt.datetime(2024, 1, 29), 1, "E", 2.0, None)]]
    for i, rows in enumerate(batches):
        _write(spark, src, f"b{i}", rows)
        job = _weekly(spark, src, out)
    late = job.late_rows(spark)
    assert sorted((str(r.event_time), r.rate) for r in late.collect()) == [
        ("2024-01-02 00:00:00", 9.0), ("2024-01-20 00:00:00", 3.0), ("None", 1.0)]
    weeks = {(r.currency, str(r.week_start)): (r.n_rates, r.avg_rate) for r in job.weeks(spark).collect()}
    assert weeks == {("E", "2024-01-08"): (2, 6.0), ("E", "2024-01-29"): (1, 2.0), (None, "2024-01-29"): (1, None)}
    assert tuple(job.account(spark).first()) == (7, 4, 3)


def test_a_replayed_batch_changes_nothing(spark):
    out = tempfile.mkdtemp(prefix="out-")
    job = jobs.WeeklyRates(f"{out}/t", fold_every=2)
    schema = "currency string, rate double, ts timestamp_ntz, event_time timestamp"
    days = [10, 2, 17, 9, 31, 18]
    frames = [spark.createDataFrame([("E", float(d), None, dt.datetime(2024, 1, d)), ("F", 1.0, None, dt.datetime(2024, 1, d))],
                                    schema) for d in days]
    for i, frame in enumerate(frames):
        job(frame, i)
        before = (sorted(job.weeks(spark).collect()), sorted(job.late_rows(spark).collect()), job.account(spark).first())
        job(frame, i)  # the batch runs again after a failure: same id, same rows
        assert before == (sorted(job.weeks(spark).collect()), sorted(job.late_rows(spark).collect()), job.account(spark).first())
    assert job.account(spark).first().rows_in == 12
    assert job.account(spark).first().rows_late == 6


def _folders(path):
    return [n for n in os.listdir(path) if n.startswith("batch_id=")], os.listdir(f"{path}/_folds")


def test_many_batches_leave_few_folders(spark):
    path = tempfile.mkdtemp(prefix="fold-")
    sink = UpsertSink(path, ["k"], fold_every=8)
    for i in range(100):
        sink(spark.range(i % 3, i % 3 + 2).selectExpr("id as k", f"{i} as v"), i)
    batches, folds = _folders(path)
    assert len(batches) <= 16 and len(folds) <= 2
    assert sorted(tuple(r) for r in read_latest(spark, path, ["k"]).collect()) == [(0, 99), (1, 99), (2, 98), (3, 98)]


def test_a_crash_between_fold_and_switch_leaves_the_table(spark):
    path = tempfile.mkdtemp(prefix="fold-")
    sink, keys = UpsertSink(path, ["k"], fold_every=3), ["k"]

    def frame(i):
        return spark.createDataFrame([(i % 2, i), (9, i)], "k int, v int")
    for i in range(3):
        sink(frame(i), i)
    state = sorted(map(tuple, read_latest(spark, path, keys).collect()))
    assert state == [(0, 2), (1, 1), (9, 2)]
    # killed while the snapshot is written: no _SUCCESS, half a table
    sink.table.write(frame(3), 3)
    sink.table.write(frame(4), 4)
    sink.table.write(frame(5), 5)
    frame(77).write.parquet(f"{path}/_folds/upto=5")
    os.remove(f"{path}/_folds/upto=5/_SUCCESS")
    want = [(0, 4), (1, 5), (9, 5)]
    assert sorted(map(tuple, read_latest(spark, path, keys).collect())) == want
    sink(frame(5), 5)  # replayed: the snapshot is written again, whole
    assert sorted(map(tuple, read_latest(spark, path, keys).collect())) == want
    # killed behind the snapshot, before the batches went: they count once
    sink.table.write(frame(4), 4)
    sink.table.write(frame(5), 5)
    assert sorted(map(tuple, read_latest(spark, path, keys).collect())) == want
    sink(frame(5), 5)
    assert sorted(_folders(path)[0]) == ["batch_id=3", "batch_id=4", "batch_id=5"]  # behind the snapshot before
    assert sorted(map(tuple, read_latest(spark, path, keys).collect())) == want


def test_landing_keeps_every_record_with_its_outcome(spark):
    src, out = tempfile.mkdtemp(prefix="src-"), tempfile.mkdtemp(prefix="out-")
    day = dt.datetime(2024, 1, 3)
    _write(spark, src, "b1", [(1, day, 1, "E", 1.0, '{"k": 5}'), (1, day, 1, "E", 1.0, '{"k": 5}'),
                               (2, day, 1, "E", 1.0, "not json"), (3, day, 1, "E", 1.0, '{"other": 1}'),
                               (4, day, 1, "E", 1.0, '{"k": null}'), (5, day, 1, "E", 1.0, '{"k": "x"}'),
                               (6, day, 1, "E", 1.0, None), (None, day, 1, "E", 1.0, None), (None, day, 1, "E", 1.0, None)])
    job = jobs.EventLanding(f"{out}/t")

    def run():
        stream = _events_stream(spark, src)
        job.start(stream, f"{out}/c").awaitTermination()
        return {r.outcome: r.n_rows for r in job.outcomes(spark, stream).collect()}, stream
    got, stream = run()
    assert got == {"landed": 6, "repeated": 1, "broken_json": 1, "type_mismatch": 1}
    assert sorted((r.event_id or 0, r.k) for r in job.outcome(spark, stream).collect()) == sorted(
        [(0, None), (0, None), (1, 5), (3, None), (4, None), (6, None)], key=str)
    # later batches: a known id, a new one, one behind the watermark
    _write(spark, src, "b2", [(6, day, 1, "E", 1.0, None), (7, day + dt.timedelta(minutes=50), 1, "E", 1.0, None),
                               (8, day - dt.timedelta(hours=2), 1, "E", 1.0, None)])
    got, stream = run()
    assert got == {"landed": 7, "repeated": 2, "broken_json": 1, "type_mismatch": 1, "late": 1}
    assert [r.event_id for r in job.outcome(spark, stream, "late").collect()] == [8]


def test_landing_takes_another_payload(spark):
    out = tempfile.mkdtemp(prefix="out-")
    job = jobs.EventLanding(f"{out}/t", payload="a STRING, b ARRAY<INT>")
    rows = spark.createDataFrame([(1, dt.datetime(2024, 1, 3), 1, "E", 1.0, '{"a": "x", "b": [1, 2]}')] * 50
                                 + [(2, dt.datetime(2024, 1, 3), 1, "E", 1.0, "[")] * 50, EVENTS)
    for _ in range(2):  # the second time as a replay
        job(rows.repartition(4), 0)
        assert {r.outcome: r.n_rows for r in job.outcomes(spark, rows).collect()} == {
            "landed": 1, "repeated": 49, "broken_json": 50}
    assert job.outcome(spark, rows).first().b == [1, 2]


def test_monthly_rates_match_batch(spark):
    src, out = tempfile.mkdtemp(prefix="src-"), tempfile.mkdtemp(prefix="out-")
    rows = [(i, dt.datetime(2024, 1 + i % 3, 1 + i % 27, 5), 1, "EU"[i % 2], 1.0 + i / 10, None)
            for i in range(40)]
    _write(spark, src, "b1", rows)
    table, ckpt = f"{out}/t", f"{out}/c"
    jobs.run_upsert(jobs.monthly_rates(jobs.rate_events(_events_stream(spark, src))), table, ckpt,
                    ["currency", "month_start"]).awaitTermination()
    got = sorted(tuple(r) for r in read_latest(spark, table, ["currency", "month_start"])
                 .select("currency", "month_start", "n_rates", "min_rate", "max_rate").collect())
    batch = (spark.createDataFrame(rows, EVENTS)
             .groupBy(F.col("event_type").alias("currency"),
                      F.trunc(F.col("ts").cast("date"), "month").alias("month_start"))
             .agg(F.count(F.lit(1)).alias("n"), F.min("value"), F.max("value")))
    assert got == sorted(tuple(r) for r in batch.collect())


def test_weeks_are_utc_in_any_session_time_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        src, out = tempfile.mkdtemp(prefix="src-"), tempfile.mkdtemp(prefix="out-")
        _write(spark, src, "b1", [(1, dt.datetime(2024, 1, 1, 1), 1, "E", 4.0, None),
                                   (2, dt.datetime(2024, 1, 7, 23), 1, "E", 6.0, None),
                                   (3, dt.datetime(2024, 2, 1, 2), 1, "E", 8.0, None)])
        got = {(r.week_start, r.week_end, r.n_rates) for r in _weekly(spark, src, out).weeks(spark).collect()}
        assert got == {(dt.date(2024, 1, 1), dt.date(2024, 1, 8), 2),
                       (dt.date(2024, 1, 29), dt.date(2024, 2, 5), 1)}
        table2, ckpt2 = f"{out}/t2", f"{out}/c2"
        jobs.run_upsert(jobs.monthly_rates(jobs.rate_events(_events_stream(spark, src))), table2, ckpt2,
                        ["currency", "month_start"]).awaitTermination()
        months = {(r.month_start, r.n_rates)
                  for r in read_latest(spark, table2, ["currency", "month_start"]).collect()}
        assert months == {(dt.date(2024, 1, 1), 2), (dt.date(2024, 2, 1), 1)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_stream_over_no_files_reads_as_empty_table(spark):
    src, out = tempfile.mkdtemp(prefix="src-"), tempfile.mkdtemp(prefix="out-")
    job = _weekly(spark, src, out)
    assert job.weeks(spark).count() == 0 and "avg_rate" in job.weeks(spark).columns
    stream = jobs.rate_events(_events_stream(spark, src))
    assert tuple(job.account(spark, stream.schema).first()) == (0, 0, 0)
    agg = jobs.monthly_rates(stream)
    jobs.run_upsert(agg, f"{out}/m", f"{out}/mc", ["currency", "month_start"]).awaitTermination()
    got = read_latest(spark, f"{out}/m", ["currency", "month_start"], agg.schema)
    assert got.count() == 0 and "avg_rate" in got.columns
