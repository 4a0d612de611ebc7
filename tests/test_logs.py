"""Log lines to readings to polls, on streams and in batch."""

from __future__ import annotations

from tempora.streaming import logs

SENSORS = {
    "event_camera_0": {"health_required": True}, "ir": {"log_pattern": "serial 777001"}, "ir2": {"log_pattern": "serial 777001 too"},
    "front": {"log_pattern": "cam_sync"}, "lidar": {"query_topic": "points"}, "silent": {},
}
T0 = 1_700_000_000


def line(s, kind, value):
    text = {"event_camera_0": "[event_camera_0]: bw in: {} MB/s", "ir": "[777001]: rate [Hz] in {}", "front": "[cam_sync]: ------ frequency: {} Hz", "lidar": "average rate: {}"}[kind]
    return f"[node] [INFO] [{T0 + s:.3f}] " + text.format(value)


def put(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_readings(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    put(tmp_path / "log", "launch.txt", [line(1.5, "event_camera_0", 3.5), "", "   ", "no rate", line(2, "ir", 30), line(3, "front", 20), line(4, "lidar", 9), line(4, "event_camera_0", 1).replace("camera_0", "camera_9")])
    put(tmp_path / "log", "points.log", [line(5, "lidar", 10), "average rate: 11"])
    found = logs.readings(logs.log_lines(spark, str(tmp_path / "log"), streaming=False), SENSORS).selectExpr("sensor", "unix_micros(ts) / 1e6 AS t", "value").collect()
    dated = {(r.sensor, r.t - T0, r.value) for r in found if r.t < T0 + 100}
    assert dated == {("event_camera_0", 1.5, 3.5), ("ir", 2.0, 30.0), ("front", 3.0, 20.0), ("lidar", 5.0, 10.0)}
    assert [(r.sensor, r.value) for r in found if r.t >= T0 + 100] == [("lidar", 11.0)]
    alone = logs.readings(logs.log_lines(spark, str(tmp_path / "log"), streaming=False), {"cam0": {}, "cam1": {}})
    assert sorted(r.sensor for r in alone.collect()) == ["cam0", "cam1"]


def loop(start, until, required, values):
    """Polls one after another."""
    times = [start + 2 * i for i in range(1, 6)]
    while times[-1] + 15 <= until:
        times.append(times[-1] + 15)
    out, kept, before = [], None, start - 1e-9
    for i, t in enumerate(times):
        if t > until:
            break
        seen = [v for at, v in sorted(values) if before < at <= t]
        kept = seen[-1] if seen else kept if required else 0.0
        if kept is not None:
            out.append((i + 1, t, kept, bool(seen)))
        before = t
    return out


def test_polls_on_a_stream_and_in_batch(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    early = [line(s, "event_camera_0", v) for s, v in ((3.5, 3), (1, 1), (3.9, 4), (10, 10))] + [line(2, "ir", 30), line(0, "lidar", 8)]
    later = [line(26, "ir", 31), line(24, "ir", 29), line(90, "event_camera_0", 90), line(3, "event_camera_0", 77)]  # the last is too late
    starts, log = tmp_path / "starts", tmp_path / "log"
    put(starts, "a.json", [f'{{"sensor": "{n}", "ts": "{"2023-11-14T22:13:20.000Z"}", "required": {str(n != "ir" and n != "silent").lower()}}}' for n in SENSORS])

    def run():
        found = logs.readings(logs.log_lines(spark, str(log)), SENSORS)
        begun = spark.readStream.schema("sensor string, ts timestamp, required boolean").json(str(starts))
        out = logs.poll_stream(begun, found).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
        out.trigger(availableNow=True).start().awaitTermination(120)
        rows = spark.read.parquet(str(tmp_path / "out")).selectExpr("sensor", "poll", "unix_micros(ts) / 1e6 AS t", "measured", "fresh").collect()
        return {n: sorted((r.poll, r.t - T0, r.measured, r.fresh) for r in rows if r.sensor == n) for n in SENSORS}

    put(log, "a.log", early + [line(20, "ir", 5)])
    first = run()  # the watermark is 10 s behind 20
    camera = [(1.0, 1.0), (3.5, 3.0), (3.9, 4.0), (10.0, 10.0), (90.0, 90.0)]
    assert first["event_camera_0"] == loop(0, 10, True, camera) and first["silent"] == loop(0, 10, False, [])
    put(log, "b.log", later)
    put(log, "points.log", [line(30, "lidar", 12)])
    second = run()  # from the checkpoint; now the watermark is 80
    ir = [(2.0, 30.0), (20.0, 5.0), (24.0, 29.0), (26.0, 31.0)]
    assert second["event_camera_0"] == loop(0, 80, True, camera) and second["ir"] == loop(0, 80, False, ir)
    assert second["silent"] == loop(0, 80, False, []) and second["front"] == [] and second["lidar"] == loop(0, 80, True, [(30.0, 12.0)])

    df = spark.createDataFrame([("event_camera_0", int((T0 + s) * 1e6), v) for s, v in camera] + [("ir", int((T0 + s) * 1e6), v) for s, v in ir] + [("ir", T0 * 10**6 + 1, None), ("ir", T0 * 10**6 - 1, 5.0), ("gone", 1, 1.0)], "sensor string, us long, value double")
    known = spark.createDataFrame([(n, T0 * 10**6, (T0 + 80) * 10**6, r) for n, r in (("event_camera_0", True), ("ir", False), ("silent", False), ("front", True))], "sensor string, start_us long, until_us long, required boolean")
    batch = logs.poll_replay(df, known).collect()
    for n in ("event_camera_0", "ir", "silent", "front"):
        assert sorted((r.poll, r.us / 1e6 - T0, r.measured, r.fresh) for r in batch if r.sensor == n) == second[n]
    assert logs.poll_replay(df.limit(0), known.limit(0)).count() == 0
