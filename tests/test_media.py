"""Actions on media files, and progress of streams."""

import time

from trackloom.operators.stats import outcome
from trackloom.sources import media
from trackloom.streaming.tracks import Progress


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_fetching(spark):
    items = frame(spark, [("a", "ta"), ("b", "tb"), ("bad1", "tx"), ("b", "tb")], "item string, target string")
    archive = frame(spark, [("a",)], "item string")
    got = media.fetch(items, archive)
    assert {(r.target, r.ok) for r in got.collect()} == {("tb", True), ("tx", False)} and got.count() == 2
    assert [r.item for r in media.archive_of(items, got).collect()] == ["b"]
    assert [r.message for r in media.failures(got, got).collect()] == ["cannot read bad1"] * 2


def test_separating_and_resizing(spark):
    videos = frame(spark, [("p1", "t1", 360), ("p2", "t2", 144), ("bad", "t3", None), ("p4", "t4", 720)], "path string, target string, height int")
    existing = frame(spark, [("t4",), ("t4",)], "target string")
    assert {r.target for r in media.separate(videos, existing, "audio").collect()} == {"t1", "t2", "t3"}
    got = {r.target: (r.ok, r.message) for r in media.resize(videos, existing).collect()}
    assert got == {"t1": (True, ""), "t2": (True, "already 144p"), "t3": (False, "cannot read bad"), "t4": (True, "exists")}
    assert tuple(outcome(media.resize(videos, existing)).first()) == (3, 1)
    assert media.discard_files(videos).where("not ok").count() == 1


def test_numbered_order(spark):
    files = frame(spark, [("v-10.mp4",), ("v-2.mp4",), ("v.mp4",)], "name string")
    assert [r.name for r in media.numbered(files).orderBy("number").collect()] == ["v.mp4", "v-2.mp4", "v-10.mp4"]


def test_progress(spark, tmp_path):
    spark.range(7).write.parquet(str(tmp_path / "in"))
    seen = Progress()
    spark.streams.addListener(seen)
    try:
        q = spark.readStream.schema("id long").parquet(str(tmp_path / "in")).writeStream.format("noop").queryName("counted").option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        for _ in range(100):
            if seen.rows.get("counted") == 7 and seen.ended:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(seen)
    assert seen.rows["counted"] == 7 and seen.ended
