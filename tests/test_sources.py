"""Configuration, files, providers, the landmark plan, streams and the command line."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom import cli
from trackloom.config import Config, Landmarks, parse_args
from trackloom.operators import clips, gaps, rate
from trackloom.plans.landmarks import landmark_dataset
from trackloom.providers import detect, estimate_poses, listen, probe_media, transcribe
from trackloom.sources import files
from trackloom.sources.frames import CameraSource, ChannelSource, FrameSource
from trackloom.streaming import tracks


def test_config(spark, tmp_path):
    (tmp_path / "c.yaml").write_text("sources:\n- {name: a, subs: true, extra: 1}\n- {name: b, url: u}\noptions:\n  bounding_boxes: {fps: 4.0}\n  landmarks: {fps: 12.5, unknown: 1}\n")
    c = Config.from_yaml(tmp_path / "c.yaml")
    assert (c.options.bounding_boxes.fps, c.options.landmarks.fps, c.options.landmarks.min_clip_duration_frames, c.options.whisper.language) == (4, 12.5, 36, "es")
    assert [tuple(r) for r in c.sources_frame(spark).collect()] == [("a", None, None, True, False, False), ("b", "u", None, False, False, False)]
    with pytest.raises(ValueError, match="name"):
        Config.from_dict({"sources": [{}]})
    assert parse_args(["--config", "x", "stats"]).step == "stats" and Config.from_dict({}).sources == ()


def test_files(spark, tmp_path):
    video = tmp_path / "videos" / "s" / "labeled" / "video"
    other = tmp_path / "videos" / "s" / "audio" / "x"
    for d in (video, other):
        d.mkdir(parents=True)
    for p in (video / "a.b.mp4", video / "c.MKV", video / "d.txt", other / "e.mp4"):
        p.write_bytes(b"x")
    assert sorted(r.stem for r in files.list_files(spark, str(video), "*.mp4").collect()) == ["a"] and files.list_files(spark, str(tmp_path / "none")).count() == 0
    found = files.find_media(spark, [str(tmp_path / "videos"), str(video / "d.txt"), str(video)])
    assert sorted(r.path.rsplit("/", 1)[1] for r in found.collect()) == ["a.b.mp4", "c.MKV", "d.txt", "e.mp4"]
    assert sorted((r.name, r.source, r.category) for r in files.media_catalog(spark, str(tmp_path / "videos")).collect()) == [("a.b.mp4", "s", "labeled"), ("c.MKV", "s", "labeled")]
    (tmp_path / "urls.txt").write_text("u1\n\n u2 \n")
    assert [r.url for r in files.read_url_list(spark, str(tmp_path / "urls.txt")).collect()] == ["u1", "u2"]
    assert files.read_manifest(spark, str(tmp_path / "m")).count() == 0 and files.read_captions(spark, str(tmp_path / "m")).count() == 0
    (video / "a.es.vtt").write_text("WEBVTT\n\n")
    text = files.captions_of(spark.createDataFrame([("s", "a", True), ("s", "z", True), ("s", "a", False)], "source string, stem string, labeled boolean"), files.read_captions(spark, str(video / "*.vtt")))
    assert sorted(r.subtitles for r in text.collect()) == ["", "", "WEBVTT\n\n"]
    got = spark.createDataFrame([("file:///in/s/a.mkv",)], "p string").select(files.output_path(F.col("p"), "file:///in", "file:///out").alias("o")).first().o
    assert got == "file:///out/s/a.mp4"


def test_detections_json(spark, tmp_path):
    at = tmp_path / "s" / "labeled" / "boxes"
    at.mkdir(parents=True)
    (at / "v.x.json").write_text('[{"timestamp": 0.5, "boxes": {"1.0": [1, 2, 3, 4], "2.0": [1, NaN, 3, 4], "1.0": [9, 9, 10, 10]}}, {"timestamp": 1.0, "boxes": {}}]')
    rows = files.read_detections(spark, str(at))
    got = {(r.source, r.video, r.person_id, r.ts): (r.x1, r.y2) for r in rows.collect()}
    assert got == {("s", "v.x", "1.0", 0.5): (9.0, 10.0), ("s", "v.x", "2.0", 0.5): (1.0, 4.0)}
    plain = rows.where("person_id = '1.0'")
    text = files.frames_json(plain).first().value
    assert json.loads(text) == [{"timestamp": 0.5, "boxes": {"1.0": [9, 9, 10, 10]}}]
    assert files.parse_frames(files.frames_json(plain)).collect() == plain.select("source", "video", "person_id", "ts", "x1", "y1", "x2", "y2").collect()
    heights = files.heights_json(spark.createDataFrame([("b", 2), ("a", None)], "video string, height int")).first().value
    assert json.loads(heights) in ({"b": 2}, {"a": None, "b": 2})


def test_frame_source_and_providers(spark):
    spark.dataSource.register(FrameSource)
    spark.dataSource.register(ChannelSource)
    rows = spark.read.format("frames").option("videos", "p/a\np/b").option("start", "1").option("end", "2").load()
    assert sorted(r.frame_no for r in rows.where("path = 'p/a'").collect()) == [25, 29, 33, 37, 41, 45, 49]
    assert spark.read.format("channel").option("urls", "u\nw").load().count() >= 2
    found = detect(rows.withColumn("source", F.lit("s")).withColumnRenamed("path", "video"))
    assert found.columns[:4] == ["source", "video", "person_id", "ts"] and found.where("ts = 37 / 25.0").count() == 0 and found.count() > 0
    posed = estimate_poses(rows.limit(2).withColumn("box", F.when(F.col("frame_no") > 28, F.array(*map(F.lit, (0.0, 0.0, 1.0, 1.0))))))
    assert {None if r.keypoints is None else len(r.keypoints) for r in posed.collect()} <= {None, 133}
    videos = spark.createDataFrame([("s", f"v{i}", f"p{i}") for i in range(12)], "source string, video string, path string")
    probed = probe_media(videos).collect()
    assert all(r.duration_s >= 0 and r.fps == 25.0 for r in probed) and len({r.height for r in probed}) > 1
    assert {len(r.speech) for r in listen(videos).collect()} == {0, 1} and transcribe(videos).count() >= 12


def test_landmark_dataset(spark):
    still = [("s", "v", "1.0", t / 5, 10.0, 10.0, 60.0, 110.0) for t in range(60)]
    late = [("s", "v", "2.0", 20 + t / 5, 10.0 + t, 10.0, 60.0 + t, 110.0) for t in range(60)]
    short = [("s", "v", "3.0", t / 5, 0.0, 0.0, 5.0, 5.0) for t in range(3)]
    d = spark.createDataFrame(still + late + short, "source string, video string, person_id string, ts double, x1 double, y1 double, x2 double, y2 double")
    v = spark.createDataFrame([("s", "v", 25.0, 2000)], "source string, video string, fps double, n_frames long")
    got = landmark_dataset(d, v, Landmarks()).collect()
    per = {p: sorted(r.frame_no for r in got if r.person_id == p) for p in ("1.0", "2.0", "3.0")}
    want = lambda start, end: [n for n in range(int(start * 25), int(end * 25)) if n % 4 == 0]
    assert per["1.0"] == want(0, 11.8) and per["2.0"] == want(20, 31.8) and per["3.0"] == []
    assert all((len(r.body), len(r.left_hand), len(r.right_hand), len(r.face)) == (17, 21, 21, 68) for r in got)
    assert landmark_dataset(d, v, Landmarks(moving_threshold=100.0)).count() == 0


def test_landmark_dataset_with_more_frames_a_second_than_the_minimum(spark):
    d = spark.createDataFrame([("s", "v", "1.0", t / 5, 10.0 + t, 10.0, 60.0 + t, 110.0) for t in range(16)], "source string, video string, person_id string, ts double, x1 double, y1 double, x2 double, y2 double")
    v = spark.createDataFrame([("s", "v", 25.0, 2000)], "source string, video string, fps double, n_frames long")
    got = landmark_dataset(d, v, Landmarks(fps=25.0, min_clip_duration_frames=4, moving_threshold=0.0)).collect()
    assert sorted(r.frame_no for r in got) == list(range(75))


def stream(spark, tmp_path, rows, schema, plan, name):
    for i, part in enumerate(rows):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        del i
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))
    q = plan(source).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / f"{name}-at")).trigger(availableNow=True).start()
    q.awaitTermination(240)
    return spark.sql(f"SELECT * FROM {name}").collect()


def test_camera_stream_keeps_the_rate(spark, tmp_path):
    spark.dataSource.register(CameraSource)
    live = spark.readStream.format("camera").option("fps", "4").option("batch", "7").load()
    query = live.writeStream.format("memory").queryName("camera_out").option("checkpointLocation", str(tmp_path / "c")).start()
    query.processAllAvailable()
    query.stop()
    got = sorted(map(tuple, spark.sql("SELECT frame_no, ts, data FROM camera_out").collect()))
    assert [(n, t, bytes(x)) for n, t, x in got] == [(n, n / 10, n.to_bytes(4, "little")) for n in range(0, 50, 3)]


def test_neutral_hand(spark, tmp_path):
    hand = np.arange(63, dtype=np.float32).reshape(21, 3)
    np.save(tmp_path / "hand.npy", hand)
    np.save(tmp_path / "short.npy", hand[:5])
    assert files.read_neutral_hand(spark, str(tmp_path / "hand.npy")) == hand.tolist()
    with pytest.raises(ValueError, match="21 points"):
        files.read_neutral_hand(spark, str(tmp_path / "short.npy"))


def test_streams_agree_with_batches(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    import random

    r = random.Random(4)
    times = sorted({(r.choice("ab"), r.randrange(300) / 4) for _ in range(120)}, key=lambda x: x[1])
    both = [times[:60], times[60:]]
    got = stream(spark, tmp_path, both, "k string, ts double", lambda s: tracks.stream_clips(s, ["k"], 1.0), "clips_out")
    want = clips.sessionize(spark.createDataFrame(times, "k string, ts double"), 1.0, ["k"]).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    got = stream(spark, tmp_path, both, "k string, ts double", lambda s: tracks.stream_rate_limit(s, ["k"], 2.0), "rate_out")
    want = rate.rate_limit(spark.createDataFrame(times, "k string, ts double"), ["k"], "ts", 2.0).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    frames = [("k", i, float(i * i) if i % 7 not in (2, 3) and not 20 <= i < 30 else None) for i in range(1, 60)]
    got = stream(spark, tmp_path, [frames[:25], frames[25:]], "k string, i long, v double", lambda s: tracks.stream_fill_gaps(s, ["k"], "i", "v", 3), "gaps_out")
    filled = gaps.interpolate(spark.createDataFrame(frames, "k string, i long, v double"), ["k"], "i", "v", 3).where("v is not null")
    want = {(x.i, x.v, x.filled, x.jumped) for x in gaps.jumps(filled, ["k"], "i").collect()}
    assert {(x.i, x.v, x.filled, x.jumped) for x in got} == want


def test_streams_of_poses(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    schema = "k string, i long, v array<array<double>>"
    frames = [("k", i, [[float(i * i), 1.0], [0.5 * i, -float(i)]] if i % 7 not in (2, 3) and not 20 <= i < 30 else None) for i in range(1, 60)]
    got = stream(spark, tmp_path, [frames[:25], frames[25:]], schema, lambda s: tracks.stream_fill_gaps(s, ["k"], "i", "v", 3), "poses_out")
    filled = gaps.interpolate(spark.createDataFrame(frames, schema), ["k"], "i", "v", 3, points=True).where("v is not null")
    want = {(x.i, str(x.v), x.filled, x.jumped) for x in gaps.jumps(filled, ["k"], "i").collect()}
    assert {(x.i, str(x.v), x.filled, x.jumped) for x in got} == want


def test_stream_forgets_keys_that_end(spark, tmp_path):
    import time

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    for part in ([("a", 0.0), ("a", 5.0)], [("a", 10.0), ("a", 10.5)]):
        spark.createDataFrame(part, "k string, ts double").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("k string, ts double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = tracks.stream_clips(source, ["k"], 1.0, ttl_ms=1).writeStream.format("memory").queryName("ended_out").outputMode("append").option("checkpointLocation", str(tmp_path / "at")).start()
    try:
        until = time.time() + 60
        while time.time() < until and q.isActive and spark.table("ended_out").count() < 4:
            time.sleep(0.5)
        assert sorted((x.ts, x.clip_index) for x in spark.table("ended_out").collect()) == [(0.0, 0), (5.0, 1), (10.0, 0), (10.5, 0)]
    finally:
        q.stop()


FAKES = {"worker": "trackloom.sources.media:FakeWorker"} | {k: f"trackloom.providers:{v}" for k, v in {"lister": "FakeLister", "probe": "FakeProbe", "decoder": "FakeDecoder", "detector": "FakeDetector", "pose": "FakePose", "speech": "FakeSpeech", "transcriber": "FakeTranscriber"}.items()}


def test_command_line(spark, tmp_path, capsys):
    video = tmp_path / "videos" / "a"
    video.mkdir(parents=True)
    for i in range(3):
        (video / f"v{i}.mp4").write_bytes(b"x")
    (video / "v0.es.vtt").write_text("WEBVTT\n\n")
    config = Config.from_dict({"sources": [{"name": "a", "subs": True}], "options": {"landmarks": {"min_clip_duration_frames": 8}}, "providers": FAKES})
    with pytest.raises(ValueError):
        cli.run(spark, Config.from_dict({"sources": [{"name": "a"}]}), str(tmp_path), "sort")
    for _ in range(2):
        cli.run(spark, config, str(tmp_path))
    status = {r.video: r.status for r in spark.read.parquet(str(tmp_path / "tables" / "videos")).collect()}
    assert status == {"v0": "labeled", "v1": "unlabeled", "v2": "unlabeled"}
    marks = files.read_landmarks(spark, str(tmp_path / "tables" / "landmarks"))
    assert marks.count() == marks.dropDuplicates(["source", "video", "person_id", "clip_index", "frame_no"]).count() > 0
    assert spark.read.parquet(str(tmp_path / "tables" / "manifest")).count() == 3
    assert "TOTAL" in capsys.readouterr().out
    # Videos that wait for captions are left alone until they have them.
    config = Config.from_dict({"sources": [{"name": "a", "generate_subs": True}], "options": {"landmarks": {"min_clip_duration_frames": 8}}, "providers": FAKES})
    other = tmp_path / "other"
    (other / "videos" / "a").mkdir(parents=True)
    for i in range(4):
        (other / "videos" / "a" / f"w{i}.mp4").write_bytes(b"x")
    for step in ("sort", "boxes", "landmarks"):
        cli.run(spark, config, str(other), step)
    rows = {r.video: (r.sorted_status, r.status) for r in spark.read.parquet(str(other / "tables" / "videos")).collect()}
    waiting = {v for v, s in rows.items() if s == ("pending", "labeled")}
    done = lambda: {r.video for r in spark.read.parquet(str(other / "tables" / "manifest")).collect()}
    assert waiting and done() == set(rows) - waiting
    for step in ("transcribe", "boxes", "landmarks"):
        cli.run(spark, config, str(other), step)
    assert done() == set(rows) and spark.read.parquet(str(other / "tables" / "manifest")).count() == len(rows)
