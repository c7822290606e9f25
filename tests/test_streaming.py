"""Finite runs of the streaming jobs on hand-made event tables."""

import datetime as dt
import os
from pathlib import Path

from hourloom.streaming import jobs

T0 = dt.datetime(2024, 1, 1)
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def write_events(spark, d, rows, name="events"):
    """rows: (event_id, minutes after T0, event type, value)."""
    data = [(i, None if m is None else T0 + dt.timedelta(minutes=m), i, c, float(v), None) for i, m, c, v in rows]
    spark.createDataFrame(data, EVENTS).coalesce(1).write.parquet(f"{d}/{name}.parquet")


def touch_in_order(d, *names):
    """The file source takes older files first."""
    for i, name in enumerate(names):
        for f in Path(d, f"{name}.parquet").iterdir():
            os.utime(f, (1_700_000_000 + i * 60,) * 2)


def test_open_sessions_come_out(spark, tmp_path):
    write_events(spark, tmp_path, [(0, 0, "a", 1), (1, 90, "a", 1), (2, 181, "a", 1), (3, 170, "b", 1)])
    got = sorted(tuple(r) for r in jobs.batch_check_sessions(spark, str(tmp_path)).collect())
    at = lambda m: T0 + dt.timedelta(minutes=m)
    assert got == [("a", at(0), at(180), 2), ("a", at(181), at(271), 1), ("b", at(170), at(260), 1)]


def test_late_rows_do_not_count_and_existing_keys_win(spark, tmp_path):
    d = str(tmp_path)
    write_events(spark, d, [(5, 10, "a", 1), (3, 20, "a", 2), (6, 600, "a", 3)])
    write_events(spark, d, [(8, 615, "a", 7)], "events_2")  # Spark holds a batch against the watermark before the last batch
    write_events(spark, d, [(1, 610, "a", 4), (2, 70, "a", 5), (7, 660, "a", 6), (6, 600, "a", 3)], "events_3")
    touch_in_order(d, "events", "events_2", "events_3")
    got = sorted((r.timestamp.hour, r.ingest_seq) for r in jobs.batch_check_append(spark, d, 1).collect())
    assert got == [(0, 3), (10, 6), (11, 7)]


def test_repeated_batch_adds_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("a", T0, 4), ("a", T0, 2), ("b", T0, 9)], "city string, timestamp timestamp_ntz, ingest_seq long")
    write = jobs.append_once(str(tmp_path / "t"), jobs.KEYS)
    for n in (0, 0, 1):
        write(rows, n)
    assert sorted((r.city, r.ingest_seq) for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [("a", 2), ("b", 9)]


def test_rows_without_a_key_go_to_quarantine(spark, tmp_path):
    write_events(spark, str(tmp_path), [(0, 0, "a", 1), (1, None, "a", 1), (2, 5, None, 1)])
    assert sorted(r.event_id for r in jobs.batch_check_quarantine(spark, str(tmp_path)).collect()) == [1, 2]


def test_a_corrected_table_keeps_the_last_write(spark, tmp_path):
    path, target = str(tmp_path / "t"), jobs.KEYS | {"aqi": "double"}
    day = lambda d, h: T0 + dt.timedelta(days=d, hours=h)
    batch = lambda *rows: spark.createDataFrame(list(rows), "city string, timestamp timestamp_ntz, ingest_seq long, aqi double, more int")
    first = batch(("a", day(0, 1), 5, 1.0, 0), ("a", day(0, 1), 7, 2.0, 0), ("a", day(1, 1), 1, 3.0, 0), ("b", day(0, 1), None, 4.0, 0), (None, day(0, 1), 1, 9.0, 0), ("a", None, 1, 9.0, 0))
    later = batch(("a", day(0, 1), 2, 5.0, 0), ("c", day(5, 0), 1, 6.0, 0))
    want = [("a", day(0, 1), 2, 5.0), ("a", day(1, 1), 1, 3.0), ("b", day(0, 1), None, 4.0), ("c", day(5, 0), 1, 6.0)]
    write = jobs.write_latest(path, target)
    read = lambda: sorted(tuple(r) for r in spark.read.parquet(path).select(*target).collect())
    write(first, 0)
    old = {f: f.stat().st_mtime_ns for f in Path(path, "event_date=2024-01-02").glob("*.parquet")}
    write(later, 1)
    assert read() == want
    assert old == {f: f.stat().st_mtime_ns for f in Path(path, "event_date=2024-01-02").glob("*.parquet")}  # a day that no batch touched is as it was
    for n, b in ((1, later), (0, first), (0, first)):  # replays, even of an older batch
        write(b, n)
        assert read() == want


def test_corrections_over_batches_of_a_stream(spark, tmp_path):
    d = str(tmp_path)
    write_events(spark, d, [(5, 10, "a", 1), (9, 70, "a", 2)])
    write_events(spark, d, [(3, 20, "a", 7), (10, 130, "a", 3), (None, 30, "b", 3)], "events_2")
    touch_in_order(d, "events", "events_2")
    got = sorted((r.city, r.timestamp.hour, r.ingest_seq, r.aqi) for r in jobs.batch_check_corrections(spark, d, 1).collect())
    assert got == [("a", 0, 3, 7.0), ("a", 1, 9, 2.0), ("a", 2, 10, 3.0), ("b", 0, None, 3.0)]


def test_a_replayed_batch_of_the_monitor_counts_once(spark, tmp_path):
    write = jobs.degradation_monitor(str(tmp_path / "m"))
    rows = lambda bad: spark.createDataFrame([(i, i < bad) for i in range(10)], "ingest_seq long, degraded boolean")
    for n, b in ((0, 3), (1, 1), (0, 3), (1, 1)):
        write(rows(b), n)
    got = sorted((r.batch, r.n, r.ratio, r.alert) for r in spark.read.schema("n bigint, ratio double, alert boolean, batch bigint").json(str(tmp_path / "m")).collect())
    assert got == [(0, 10, 0.3, True), (1, 10, 0.1, False)]


def test_online_features_look_back_over_batches(spark, tmp_path):
    from hourloom.config import Columns
    from hourloom.operators import windows

    d = str(tmp_path)
    write_events(spark, d, [(i, 60 * i, c, i * i % 97) for i in range(200) for c in "ab"])
    write_events(spark, d, [(i, 60 * i, "a", i) for i in range(200, 205)] + [(300, 199 * 60, "a", 7), (400, 203 * 60 + 5, "a", 8)], "events_2")
    touch_in_order(d, "events", "events_2")
    got = jobs.batch_check_features(spark, d, 1)
    rows = {(r.city, r.ingest_seq): r for r in got.collect()}
    assert {*rows} == {("a", i) for i in range(205)} | {("b", i) for i in range(200)}  # hours that came before win
    cfg, t = jobs.FeatureConfig(), got.select("city", "timestamp", "aqi", "ingest_seq")
    batch = windows.ema(windows.rolling(windows.lags(t, {"aqi": cfg.target_lags}), ["aqi"], cfg.windows, ("mean",)), "aqi", cfg.windows, Columns())
    for r in batch.collect():
        for c in batch.columns:
            a, b = r[c], rows[r.city, r.ingest_seq][c]
            assert a == b or abs(a - b) < 1e-9, (c, r.ingest_seq)


def test_state_is_bounded_and_idle_entities_are_forgotten():
    from hourloom.streaming.online import Online

    class Value:
        held = None
        exists = lambda self: self.held is not None
        get = lambda self: self.held
        update = lambda self, v: setattr(self, "held", v)
        clear = lambda self: setattr(self, "held", None)

    class Handle:
        def __init__(self):
            self.value, self.timers = Value(), set()

        getValueState = lambda self, *_: self.value
        listTimers = lambda self: iter(self.timers)
        registerTimer = lambda self, t: self.timers.add(t)
        deleteTimer = lambda self, t: self.timers.discard(t)

    from pyspark.sql import Row

    p, h = Online((1, 3), (2, 5), (3,), 1000), Handle()
    p.init(h)
    out = [r for k in range(50) for r in p.handleInputRows(("a",), iter([Row(_s=3600 * k, _o=1, _v=None if k in (0, 7) else float(k))]), None)]
    assert len(out) == 50 and len(h.value.held[0]) == 5 and h.timers == {3600 * 49 * 1000 + 1000}
    assert out[0][6] == [None] and out[1][6] == [1.0] and out[7][6] == out[6][6] and out[2][4] == [1.0, None]
    assert list(p.handleInputRows(("a",), iter([Row(_s=3600, _o=1, _v=5.0)]), None)) == []  # late
    assert list(p.handleExpiredTimer(("a",), None, None)) == [] and not h.value.exists()
