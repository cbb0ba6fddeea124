"""Streams whose state is bounded: partials, sustained breaches, suppression and sessions."""

import datetime as dt
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tessera.streaming import alerts, metrics, partials
from tessera.streaming.partials import FirstRows, Measure, PartialStore, WindowPartials, absorb_available

T0 = dt.datetime(2024, 1, 1)
EVENT = "id long, ts timestamp, kind string, value double"


def write_file(spark, folder, name, rows, schema):
    """One file of a stream; names say in which order they are written."""
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(folder / f"_{name}"))
    part = next((folder / f"_{name}").glob("*.parquet"))
    part.rename(folder / f"{name}.parquet")


def stream(spark, folder, schema):
    return metrics.file_stream(spark, str(folder), spark.createDataFrame([], schema).schema, "*.parquet", files_per_trigger=1)


def made(n, days, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = T0 + dt.timedelta(days=rng.choice(days), seconds=rng.randint(0, 86_399))
        rows.append((i, None if i % 97 == 0 else at, rng.choice(["a", "b", None]), None if i % 13 == 0 else rng.random() * 10))
    return rows


SPEC = WindowPartials("ts", "1 hour", ["kind"], [Measure("n", "count"), Measure("seen", "count", "value"), Measure("mean", "mean", "value"), Measure("top", "max", "value"), Measure("low", "min", "value"), Measure("total", "sum", "value"), Measure("big", "count_if", "value > 5")])


def same(got, want):
    def rows(df):
        return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=repr)

    assert got.columns == want.columns and rows(got) == rows(want)


def test_three_files_out_of_order_count_every_row(spark, tmp_path):
    """The newest file first: late partials still count, and what a batch reads is bounded by the retention."""
    folder = tmp_path / "in"
    folder.mkdir()
    files = [made(300, [40, 41], 1), made(300, [1, 2, 41], 2), made(300, [20, 3], 3)]
    for i, rows in enumerate(files):
        write_file(spark, folder, f"f{i}", rows, EVENT)
    src = stream(spark, folder, EVENT)
    store = absorb_available(src, PartialStore(spark, str(tmp_path / "store"), SPEC, "6 hours"))
    whole = spark.createDataFrame([r for f in files for r in f], EVENT)
    same(store.read(), metrics.at_once(whole, SPEC))
    assert 0 < store.open().count() <= 3 * 7  # three keys, windows of the last six hours
    # goes on where it ended
    write_file(spark, folder, "f3", more := made(100, [2, 45], 4), EVENT)
    absorb_available(src, store)
    same(store.read(), metrics.at_once(whole.union(spark.createDataFrame(more, EVENT)), SPEC))


def test_operator_holds_no_state(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(3):
        write_file(spark, folder, f"f{i}", made(100, [i], i), EVENT)
    store = PartialStore(spark, str(tmp_path / "store"), SPEC, "1 hour")
    query = stream(spark, folder, EVENT).writeStream.foreachBatch(store.absorb).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert len(query.recentProgress) >= 3 and all(not p["stateOperators"] for p in query.recentProgress)


def test_retried_and_many_batches(spark, tmp_path, monkeypatch):
    """A batch that is run again changes nothing; sealed folders are put together."""
    monkeypatch.setattr(partials, "FAN", 3)
    store = PartialStore(spark, str(tmp_path / "s"), SPEC, "2 hours")
    rows = [made(30, [(7 * i) % 40], i) for i in range(8)]
    for i, own in enumerate(rows):
        frame = spark.createDataFrame(own, EVENT)
        store.absorb(frame, i)
        if i % 3 == 0:
            store.absorb(frame, i)
    same(store.read(), metrics.at_once(spark.createDataFrame([r for f in rows for r in f], EVENT), SPEC))
    assert len(store.runs()) >= 1 and len(store.batches()) < 9


def test_keys_come_through_once(spark, tmp_path):
    spec = FirstRows(["id"], "ts")
    store = PartialStore(spark, str(tmp_path / "s"), spec, "1 day")
    files = [made(50, [30], 1), made(50, [1], 2), [(7, T0, "a", 1.0), (7, T0, "a", 1.0), (None, T0, "x", None), (None, T0, "x", None)]]
    for i, rows in enumerate(files):
        store.absorb(spark.createDataFrame(rows, EVENT), i)
    got = {r.id: r for r in store.read().collect()}
    assert set(got) == {*range(50), None} and got[7].ts == T0 and got[None].kind == "x"
    assert store.open().count() < 50 + 10  # ids without a time or of the newest day


def test_empty_batches(spark, tmp_path):
    store = PartialStore(spark, str(tmp_path / "s"), SPEC, "1 day")
    assert store.read() is None
    store.absorb(spark.createDataFrame([], EVENT), 0)
    assert store.read().count() == 0
    store.absorb(spark.createDataFrame([(1, None, "a", 1.0)], EVENT), 1)
    assert store.read().count() == 0  # a row without a time has no window


def test_windowed_stream_needs_a_bound(spark, tmp_path):
    with pytest.raises(ValueError):
        metrics.windowed(stream(spark, tmp_path, EVENT), "ts", "1 hour", [], [F.count("*")])


# -- breaches ---------------------------------------------------------------------------------------


def test_breaches_leave_a_stream_of_several_triggers(spark, tmp_path):
    """Runs go on across triggers, by key; a missing window and a quiet one both end a run."""
    folder = tmp_path / "in"
    folder.mkdir()
    hot = {"a": [0, 1, 2, 3, 4, 7, 8, 10, 11, 12], "b": [1, 2, 3], None: [5, 6, 7, 8]}
    rows = []
    for k, minutes in hot.items():
        for m in range(20):
            rows.append((m, T0 + dt.timedelta(minutes=m, seconds=5), k, 9.0 if m in minutes else 1.0))
            rows.append((m, T0 + dt.timedelta(minutes=m, seconds=50), k, None))
    rows.sort(key=lambda r: r[1])
    for i in range(4):
        write_file(spark, folder, f"f{i}", rows[i * 30 : (i + 1) * 30], EVENT)
        time.sleep(0.05)
    fired = alerts.sustained(stream(spark, folder, EVENT), "ts", "value", 5.0, run=3, seconds=60, late="1 minute", keys=["kind"])
    got = {(r.kind, r.window_start.minute) for r in metrics.run_available(fired, "breach", None, mode="append").collect()}
    want = {(k, m) for k, ms in hot.items() for m in ms if {m - 1, m - 2} <= set(ms) and m <= 17}
    assert got == want and len(want) >= 7


def test_breach_state_is_removed(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write_file(spark, folder, "f0", [(0, T0, "old", 9.0)], EVENT)
    for i in range(1, 4):
        time.sleep(0.05)
        write_file(spark, folder, f"f{i}", [(i, T0 + dt.timedelta(hours=i), "new", 1.0)], EVENT)
    fired = alerts.sustained(stream(spark, folder, EVENT), "ts", "value", 5.0, run=2, seconds=60, late="1 minute", keys=["kind"])
    query = fired.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    rows = [[s["numRowsTotal"] for s in p["stateOperators"]] for p in query.recentProgress]
    assert max(max(r) for r in rows) > 0
    state = spark.read.format("statestore").option("operatorId", 0).option("stateVarName", "run").load(str(tmp_path / "c"))
    assert state.count() == 0


# -- suppression ------------------------------------------------------------------------------------

ALERT = "alert_key string, alert_id long, ts timestamp"


def brute(rows, cooldown, per_hour):
    last, count, sent = None, 0, []
    for i, ts in sorted(rows, key=lambda r: (r[1], r[0])):
        if last is not None:
            gap = (ts - last).total_seconds()
            if gap < cooldown * 60 or (gap < 3600 and count >= per_hour):
                continue
            count = 1 if gap > 3600 else count + 1
        else:
            count = 1
        last = ts
        sent.append(i)
    return sent


@pytest.mark.parametrize("cooldown,per_hour,chunk", [(15, 3, 8192), (15, 3, 7), (0, 2, 5), (90, 10, 16), (1, 1, 50)])
def test_suppression_in_chunks(spark, tmp_path, monkeypatch, cooldown, per_hour, chunk):
    monkeypatch.setattr(alerts, "CHUNK", chunk)
    rng = random.Random(chunk)
    folder = tmp_path / "in"
    folder.mkdir()
    keys = {k: [(i, T0 + dt.timedelta(seconds=rng.randint(0, 40_000))) for i in range(n)] for k, n in (("hot", 300), ("b", 20), (None, 5))}
    rows = [(k, i, t) for k, own in keys.items() for i, t in own] + [("b", None, T0), ("b", 999, None)]
    rng.shuffle(rows)
    write_file(spark, folder, "f0", rows, ALERT)
    out = metrics.run_available(alerts.suppress(stream(spark, folder, ALERT), cooldown, per_hour), "s", None, mode="append")
    got = {}
    for r in out.collect():
        got.setdefault(r.alert_key, set()).add(r.alert_id)
    assert got == {k: set(brute(own, cooldown, per_hour)) for k, own in keys.items()}


def test_chunks_bound_what_is_in_memory(spark, tmp_path):
    """Five keys with many alerts each: a processor holds a chunk at a time, whatever a key has."""
    n = 40_000
    folder = tmp_path / "in"
    rows = spark.range(5 * n).select((F.col("id") % 5).cast("string").alias("alert_key"), F.col("id").alias("alert_id"), F.timestamp_micros(F.pmod(F.xxhash64("id"), F.lit(6 * 3_600_000_000)) + F.lit(1_704_067_200_000_000)).alias("ts"))
    rows.coalesce(1).write.parquet(str(folder))
    src = stream(spark, folder, ALERT)
    got = metrics.run_available(alerts.suppress(src, 30, 3), "many", None, mode="append").toPandas()
    for k, own in rows.toPandas().groupby("alert_key"):
        assert sorted(got[got.alert_key == k].alert_id) == sorted(brute(list(zip(own.alert_id, own.ts)), 30, 3))


def test_state_expires(spark, tmp_path):
    """After its time to live a key's state is gone: the next alert is sent though the cooldown isn't over."""
    folder = tmp_path / "in"
    folder.mkdir()
    write_file(spark, folder, "f0", [("k", 1, T0), ("k", 2, T0 + dt.timedelta(minutes=1))], ALERT)
    fired = alerts.suppress(stream(spark, folder, ALERT), 15, 10, ttl_hours=3 / 3600)
    sent = []
    query = fired.writeStream.foreachBatch(lambda b, n: sent.extend(r.alert_id for r in b.collect())).option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="1 second").start()
    try:
        end = time.time() + 60
        while not sent and time.time() < end:
            time.sleep(0.2)
        time.sleep(5)
        write_file(spark, folder, "f1", [("k", 3, T0 + dt.timedelta(minutes=2))], ALERT)
        while len(sent) < 2 and time.time() < end:
            time.sleep(0.2)
    finally:
        query.stop()
    assert sent == [1, 3]


def test_sessions_are_trimmed_and_odd_rows_kept(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    schema = "conv_id long, turn long, role string, text string"
    write_file(spark, folder, "f0", [(1, i, "user", f"t{i}") for i in range(10)] + [(2, None, "user", None), (None, 1, None, "x")], schema)
    time.sleep(0.05)
    write_file(spark, folder, "f1", [(1, 10, "user", "t10"), (2, 0, "assistant", "y")], schema)
    got = metrics.session_rows(metrics.run_available(alerts.session_history(stream(spark, folder, schema), 2), "h", ["conv_id"]))
    rows = {}
    for r in got.collect():
        rows.setdefault(r.conv_id, []).append(r.turn)
    assert rows == {1: [7, 8, 9, 10], 2: [None, 0], None: [1]}


def test_ingest_of_the_events(spark, tmp_path):
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    ev.union(ev.limit(50)).repartition(3).write.parquet(str(tmp_path / "in"))
    src = metrics.file_stream(spark, str(tmp_path / "in"), ev.schema, "*.parquet", files_per_trigger=1)
    got = metrics.replayed(src, metrics.new_rows(["event_id"], "ts"), "ingest", "1 day")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ev.collect()))
    assert pd.Series([r.event_id for r in got.select("event_id").collect()]).is_unique
