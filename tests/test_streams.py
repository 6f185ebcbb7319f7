"""Streams give what the batch gives, and re-running a batch changes nothing."""

import time
from datetime import datetime, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabwarden.catalog import streams
from tabwarden.functions import sizing
from tabwarden.operators import profile, trigger
from tabwarden.operators.clean import CleanSpec
from tabwarden.operators.contract import from_dict
from tabwarden.sources import readers
from tabwarden.streaming import jobs, windows


def test_closed_windows_equal_batch(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    batch = windows.windowed_stats(events, "ts", ["event_type"], ["value"], "7 days", "1 day")
    end = events.agg(F.max("ts") - F.expr("INTERVAL 1 HOUR")).scalar()
    first = events.where("ts < timestamp_ntz'2024-01-16 00:00:00'")
    shares, means = profile.value_distribution(first, ["event_type"]), profile.numeric_summary(first, ["value"])
    want = windows.drift_against(batch.where(F.col("window_end") <= end), shares, means)
    got = streams.stream_drift(spark, sf)
    key = lambda d: sorted(map(tuple, d.select(F.col("window_start").cast("string"), "feature", "score", "is_drifted").collect()))
    assert key(got) == key(want) and key(got)


def test_session_zone_does_not_move_windows(spark, sf):
    key = lambda: sorted(map(str, streams.stream_windows(spark, sf).collect()))
    want = key()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert key() == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_panes_equal_plain_windows(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    panes = windows.windowed_stats(events, "ts", ["event_type"], ["value"], "7 days", "1 day")
    plain = windows.windowed_stats(events, "ts", ["event_type"], ["value"], "7 days", "1 day", watermark="100 days")
    key = lambda d: sorted(map(str, d.withColumn("total", F.round("total", 6)).collect()))
    assert key(panes) == key(plain)


def test_late_verdicts_are_decided_in_order(spark):
    """A verdict that comes a micro-batch late, before the watermark, is decided as the batch decides it."""
    base = sizing.run_dir(spark, "cooldown-test")
    schema = "monitor string, at timestamp, drifted boolean"
    begin = datetime(2024, 1, 1)
    make = lambda rows: spark.createDataFrame([(m, begin + timedelta(hours=h), d) for m, h, d in rows], schema)
    batches = [
        [("m", 0, True), ("m", 12, True), (None, 3, True)], [("m", 30, True), ("m", 31, False)], [("m", 25, True), ("m", 1, True), (None, 29, None)],
        [("m", 49, True), ("m", 60, True)], [("m", 52, True), (None, 100, False)],
    ]
    for rows in batches:
        make(rows).coalesce(1).write.mode("append").parquet(f"{base}/in")
        actions = jobs.cooldown_actions(spark.readStream.schema(schema).parquet(f"{base}/in"), "monitor", "at", "drifted", "10 hours")
        jobs.run_to_end(jobs.append_job(actions, f"{base}/out", f"{base}/checkpoint", rocksdb=True))
    got = sorted((str(r["monitor"]), r["at"], r["action"]) for r in spark.read.parquet(f"{base}/out/batch=*").collect())
    kept = [r for b in batches for r in b if r != ("m", 1, True)]  # 1 came after the watermark had reached 20
    want = trigger.replay(make(kept), ["monitor"]).collect()
    assert got == sorted((str(r["monitor"]), r["at"], r["action"]) for r in want)
    assert [x[2] for x in got if x[0] == "m"] == ["fire", "suppressed", "fire", "suppressed", "healthy", "fire", "suppressed", "suppressed"]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != jobs._ROCKSDB


def test_scoring_batches_are_idempotent(spark, sf):
    assert streams.stream_score_dlq(spark, sf).count() == spark.read.parquet(f"{sf}/events.parquet").count()
    path = sizing.run_dir(spark, "again")
    for _ in range(2):
        spark.range(3).write.mode("overwrite").parquet(jobs.batch_path(path, 0))
    assert spark.read.parquet(f"{path}/batch=*").count() == 3


def test_csv_batches_land_once(spark, tmp_path):
    contract = from_dict({"columns": {"k": {"required": True, "nullable": False}, "x": {"nullable": False, "min": 0}}})
    landing, base = tmp_path / "in", sizing.run_dir(spark, "landing")
    landing.mkdir()

    def run():
        stream = readers.stream_batches(spark, str(landing), "k string, x string", max_files=1)
        jobs.run_to_end(
            jobs.scoring_job(
                stream, contract, CleanSpec(numeric_text=("x",)), lambda df: df.withColumn("p", F.col("x") / 10),
                f"{base}/scored", f"{base}/dead", f"{base}/checkpoint",
            )
        )

    (landing / "a.csv").write_text("k,x\na,1\nb,na\n")
    (landing / "b.csv").write_text("k,x\nc,-1\nd,5\n")
    run()
    (landing / "c.csv").write_text("k,x\ne,7\n")
    run()
    assert sorted(r["k"] for r in spark.read.parquet(f"{base}/scored/batch=*").collect()) == ["a", "d", "e"]
    assert sorted(r["k"] for r in spark.read.parquet(f"{base}/dead/batch=*").collect()) == ["b", "c"]


def parts_in_order(spark, sf, n=6):
    """The events as ``n`` files in order of time, each with a few rows that belong to the file before it."""
    path = sizing.run_dir(spark, "parts")
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("r", F.ntile(n).over(Window.orderBy(F.col("ts") + F.when(F.col("event_id") % 9 == 0, F.expr("INTERVAL 2 HOURS")).otherwise(F.expr("INTERVAL 0 HOURS")))))
    for k in range(1, n + 1):
        events.where(F.col("r") == k).drop("r").coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.02)  # files are read in order of their time
    return path


def stream_of(spark, path):
    return spark.readStream.schema(streams.EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def test_window_drift_over_many_batches(spark, sf):
    path = parts_in_order(spark, sf)
    out, checkpoint = jobs.folders(spark.range(1), "drift-test")
    jobs.run_to_end(jobs.window_drift_job(stream_of(spark, path), "ts", ["event_type"], ["value"], "2 days", "1 day", "2 DAYS", "3 hours", out, f"{checkpoint}-state", checkpoint))
    events = spark.read.parquet(path)
    end = events.agg(F.max("ts") - F.expr("INTERVAL 3 HOURS")).scalar()
    batch = windows.drift_against_previous(windows.windowed_stats(events, "ts", ["event_type"], ["value"], "2 days", "1 day"), "2 DAYS")
    want = batch.where(F.col("window_start") + F.expr("INTERVAL 2 DAYS") <= end)
    got = spark.read.option("basePath", out).parquet(f"{out}/batch=*")
    key = lambda d: sorted(map(tuple, d.select(F.col("window_start").cast("string"), "feature", "score", "is_drifted").collect()))
    assert key(got) == key(want) and len(key(want)) > 20 and got.select("batch").distinct().count() > 2


def test_late_labels_over_many_batches(spark, sf):
    path = parts_in_order(spark, sf)
    wide = stream_of(spark, path).withColumn("user_id", F.when(F.col("event_id") % 7 > 0, F.col("user_id") % 5))
    facts = wide.where("event_type IN ('purchase', 'error')").select("user_id", "ts", "event_id")
    views = wide.where("event_type = 'view'").select("user_id", "ts", F.when(F.col("event_id") % 4 > 0, F.col("value")).alias("p"))
    out, checkpoint = jobs.folders(spark.range(1), "labels-test")
    joined = jobs.labelled_predictions(facts, views, ["user_id"], "ts", "p", "5 HOURS", "3 hours")
    jobs.run_to_end(jobs.append_job(joined, out, checkpoint))
    got = {r["event_id"]: (r["ts"], r["p"], r["matched"]) for r in spark.read.parquet(f"{out}/batch=*").collect()}
    rows = [(r["event_id"], r["event_type"], r["ts"], None if r["event_id"] % 7 == 0 else r["user_id"] % 5, r["value"] if r["event_id"] % 4 else None) for r in spark.read.parquet(path).collect()]
    end = min(max(t for _, kind, t, *_ in rows if kind in kinds) for kinds in (("purchase", "error"), ("view",))) - timedelta(hours=8)
    want = {}
    for i, kind, at, user, _ in rows:
        if kind in ("purchase", "error") and at <= end:
            near = [(t, p) for _, k, t, u, p in rows if k == "view" and u is not None and u == user and at - timedelta(hours=5) <= t <= at]
            want[i] = (at, max(near, key=lambda x: x[0])[1] if near else None, bool(near))
    assert got == want and len({x[2] for x in want.values()}) == 2 and any(x[2] and x[1] is None for x in want.values())


def test_landing_files_go_by_their_own_header(spark, tmp_path):
    landing, seen = tmp_path / "in", []
    landing.mkdir()
    (landing / "a.csv").write_text("k,x\na,1\n")
    (landing / "b.csv").write_text("x,note,k\n2,\"q,r\",b\n3,,c\n")
    (landing / "c.csv").write_text("x\n4\n")
    (landing / "d.csv").write_text("")

    def each(rows, refused, batch_id):
        seen.append(([tuple(r) for r in rows.collect()], [(r["file"].rsplit("/", 1)[1], r["missing"]) for r in refused.collect()]))

    def run():
        jobs.run_to_end(jobs.landing_job(spark, str(landing), "k string, x double, note string", each, sizing.run_dir(spark, "landing"), required=["k"]))

    run()
    assert sorted(seen[0][0]) == [("a", 1.0, None), ("b", 2.0, "q,r"), ("c", 3.0, None)] and seen[0][1] == [("c.csv", ["k"])]
    rows = readers.read_csv(spark, str(landing), "k string, x double, y int")
    assert rows.columns == ["k", "x"] and sorted(map(str, rows.collect())) == sorted(["Row(k='a', x=1.0)", "Row(k='b', x=2.0)", "Row(k='c', x=3.0)", "Row(k=None, x=4.0)"])
