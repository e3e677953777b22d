"""Hand-computed edge cases of every operator, and folds in plain Python on random rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from trackloom.functions import text as X
from trackloom.functions import vectors as V
from trackloom.operators import asof, boxes, captions, clips, curation, frames, gaps, hands, landmarks, merge, motion, rate, stats


def values(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


def lit(points):
    return F.array(*[F.array(*map(F.lit, map(float, p))) for p in points])


def test_clips(spark):
    rows = spark.createDataFrame([("v", "1", t, 0.0, 0.0, 10.0 + t, 5.0) for t in (0.0, 0.5, 1.5, 1.75)], "video string, person_id string, ts double, x1 double, y1 double, x2 double, y2 double")
    cut = clips.sessionize(rows, 1.0, ("video", "person_id"))
    assert [r.clip_index for r in cut.orderBy("ts").collect()] == [0, 0, 1, 1]
    got = {r.clip_index: (r.start, r.end, r.max_w, r.n_boxes) for r in clips.summarize(cut, ("video", "person_id")).collect()}
    assert got == {0: (0.0, 0.5, 10.5, 2), 1: (1.5, 1.75, 11.75, 2)}
    one = clips.assemble(cut, ("video", "person_id")).where("clip_index = 1").first()
    assert [b.ts for b in one.boxes] == [1.5, 1.75]
    twice = rows.withColumn("n", F.lit(1)).unionByName(rows.withColumn("n", F.lit(2)).withColumn("x2", F.lit(99.0)))
    kept = clips.latest_per_timestamp(twice, ("video", "person_id"), order="n").collect()
    assert len(kept) == 4 and {r.x2 for r in kept} == {99.0}


@pytest.mark.parametrize("bucket", [None, 0.7, 100.0])
def test_asof_edges(spark, bucket):
    b = spark.createDataFrame([("k", 1.0, "A"), ("k", 2.0, "B")], "k string, ts double, box string")
    f = spark.createDataFrame([("k", t) for t in (0.5, 1.0, 1.5, 2.0, 2.1)] + [("none", 1.0)], "k string, ts double")
    got = {(r.k, r.ts): r.box for r in asof.backward(f, b, ["k"], ["box"], bucket=bucket).collect()}
    assert got == {("k", 0.5): "A", ("k", 1.0): "A", ("k", 1.5): "A", ("k", 2.0): "A", ("k", 2.1): "B", ("none", 1.0): None}
    got = {(r.k, r.ts): r.box for r in asof.backward(f, b, ["k"], ["box"], strict=False, first_if_none=False, bucket=bucket).collect()}
    assert got == {("k", 0.5): None, ("k", 1.0): "A", ("k", 1.5): "A", ("k", 2.0): "B", ("k", 2.1): "B", ("none", 1.0): None}
    near = spark.createDataFrame([("k", 1.5), ("k", 9.0), ("k", -3.0)], "k string, ts double")
    assert {r.ts: r.box for r in asof.nearest(near, b, ["k"], ["box"]).collect()} == {1.5: "A", 9.0: "B", -3.0: "A"}


def test_asof_buckets_agree(spark):
    r = random.Random(2)
    b = spark.createDataFrame([(r.choice("ab"), i * 0.25, i) for i in r.sample(range(400), 60)], "k string, ts double, box long")
    f = spark.createDataFrame([(r.choice("abc"), r.randrange(500) * 0.25 - 5) for _ in range(200)], "k string, ts double").distinct()
    one = {(x.k, x.ts): x.box for x in asof.backward(f, b, ["k"], ["box"]).collect()}
    for width in (0.25, 3.0, 50.0):
        assert {(x.k, x.ts): x.box for x in asof.backward(f, b, ["k"], ["box"], bucket=width).collect()} == one


def test_frame_grid(spark):
    skips = {23.976: 4, 24: 4, 25: 4, 29.97: 5, 30: 5, 50: 8, 60: 10, 15: 2, 9: 2, 21: 4, 27: 4, 33: 6, 3: 1, 2: 1}
    for fps, skip in skips.items():
        assert values(spark, frames.frame_skip(F.lit(float(fps)), F.lit(6.0))) == skip
    c = spark.createDataFrame([(1, 1.0, 2.0, 25.0, 1000), (2, 1.0, 1.0, 25.0, 1000), (3, 1.0, 2.0, 25.0, 41)], "id int, start double, end double, fps double, n_frames long")
    got = frames.frame_grid(c, 6.0, total="n_frames").collect()
    assert sorted(r.frame_no for r in got if r.id == 1) == [28, 32, 36, 40, 44, 48] and sorted(r.frame_no for r in got if r.id == 3) == [28, 32, 36, 40]
    assert {r.id for r in got} == {1, 3} and all(r.ts == r.frame_no / 25 for r in got)


def test_in_interval(spark):
    r = random.Random(5)
    spans = [(r.choice("ab"), i, a, a + r.choice([0, 1, 7, 30])) for i, a in enumerate(r.choices(range(100), k=40))]
    pts = [(r.choice("ab"), r.randrange(-5, 140)) for _ in range(80)]
    s, p = spark.createDataFrame(spans, "k string, i int, start long, end long"), spark.createDataFrame(pts, "k string, at long")
    for closed in (True, False):
        want = sorted((k, t, i) for k, t in pts for q, i, a, b in spans if k == q and a <= t and (t <= b if closed else t < b))
        assert sorted((x.k, x.at, x.i) for x in frames.in_interval(p, s, ["k"], "at", "start", "end", 8, closed).collect()) == want


@pytest.mark.parametrize(("n", "moves", "still", "keep"), [(36, (), False, True), (37, (), True, False), (37, (36,), False, True), (60, tuple(range(37, 60)), True, False), (5, tuple(range(1, 5)), False, False)])
def test_motion_verdicts(spark, n, moves, still, keep):
    changes = spark.createDataFrame([("c", i, None if i == 0 else 0.25 if i in moves else 0.0) for i in range(n)], "clip string, i long, change double")
    got = motion.verdicts(changes, ["clip"], 6.0).first()
    assert (got.still, got.keep) == (still, keep)
    nan = changes.withColumn("change", F.when(F.col("i") == 3, F.lit(float("nan"))).otherwise(F.col("change")))
    assert motion.verdicts(nan, ["clip"], 6.0).first().still == still


def test_motion_skips_missing_bodies(spark):
    body = lambda x: [[x, 1.0, 0.0]] * 17
    rows = spark.createDataFrame([("c", 0, body(0.0)), ("c", 1, None), ("c", 2, body(1.0)), ("c", 3, [[0.0, 0.0, 0.0]] * 17)], "clip string, ts long, body array<array<double>>")
    got = {r.ts: (r.i, r.change) for r in motion.frame_changes(rows, ["clip"]).collect()}
    side = math.sqrt(0.5)
    assert set(got) == {0, 2, 3} and got[0] == (0, None) and got[2][1] == pytest.approx(math.sqrt(12 * (side**2 + (1 - side) ** 2))) and got[3][1] == pytest.approx(math.sqrt(12))


def test_interpolation(spark):
    def fill(vs, most, **options):
        rows = spark.createDataFrame([("k", i, v) for i, v in enumerate(vs)], "k string, i long, v double")
        return [r.v for r in gaps.interpolate(rows, ["k"], "i", "v", most, **options).orderBy("i").collect()]

    assert fill([2.0, None, None, None, 8.0], 3) == [2.0, 4.0, 6.0, 8.0, 8.0]
    assert fill([2.0, None, None, None, 8.0], 2) == [2.0, None, None, None, 8.0]
    assert fill([None, 1.0, None], 5) == [None, 1.0, None]
    assert fill([2.0, None, None, None, 10.0], 3, divide_by_length_plus_one=True) == [2.0, 4.0, 6.0, 8.0, 10.0]
    rows = spark.createDataFrame([(0, [[1.0, 2.0]]), (1, None), (2, [[3.0, 6.0]])], "i long, v array<array<double>>")
    got = gaps.interpolate(rows.withColumn("k", F.lit(1)), ["k"], "i", "v", 1, points=True).orderBy("i").collect()
    assert got[1].v == [[3.0, 6.0]] and [g.filled for g in got] == [False, True, False]


def test_islands(spark):
    def runs(ns):
        df = spark.createDataFrame([("k", n) for n in ns], "k string, frame long")
        return df, gaps.islands(df, ["k"])

    assert sorted((r.start, r.end) for r in runs([3, 4, 5, 9, 4])[1].collect()) == [(3, 5), (9, 9)]
    df, got = runs([3, 4, 5, 9, 6, 7, 8])
    assert [(r.start, r.end) for r in got.collect()] == [(3, 9)]
    points = spark.createDataFrame([("k", 2), ("k", 9), ("k", 10)], "k string, frame long")
    assert {r.frame: (r.start, r.end) for r in gaps.covering(points, got, ["k"]).collect()} == {2: (None, None), 9: (3, 9), 10: (None, None)}
    assert [r.jumped for r in gaps.jumps(runs([0, 1, 5])[0], ["k"], "frame").orderBy("frame").collect()] == [False, False, True]


def test_boxes(spark):
    box = lambda *v: F.array(*map(F.lit, map(float, v)))
    r = values(spark, boxes.crop_region(*map(F.lit, (10.0, 20.0, 50.0, 120.0, 60.0, 100.0))))
    assert tuple(r) == (10, 130, 0, 66)
    p = values(spark, boxes.preview_region(*map(F.lit, (10.0, 20.0, 50.0, 120.0, 60.0, 100.0))))
    assert tuple(p) == (0, 10, 72, 120)
    size = F.lit(1280), F.lit(720)
    assert values(spark, boxes.rescale_box(box(0.5, 1.5, 300, 100), F.lit(5.0), *size)) == [2, 8, 1279, 500]
    assert values(spark, boxes.rescale_box(box(1, 1, 10, 10), F.lit(2.5), *size)) == [2, 2, 25, 25]
    assert values(spark, boxes.rescale_box(box(10, 9, 2, 3, 7), F.lit(2.5), *size)) == [5, 8, 25, 22]
    assert values(spark, boxes.rescale_box(box(1, 2), F.lit(2.5), *size)) == [1, 2]
    both = values(spark, boxes.rescale_boxes(F.create_map(F.lit("1.0"), box(1, 1, 2, 2), F.lit("2.0"), box(1)), boxes.box_scale(F.lit(288)), *size))
    assert both == {"1.0": [2, 2, 4, 4], "2.0": [1]}
    fixed = boxes.frame_number_to_seconds(spark.createDataFrame([(50.0, 25.0), (1.0, 0.0)], "ts double, fps double"), F.col("fps"))
    assert [x.ts for x in fixed.collect()] == [2.0, None]


def test_timestamps_and_names(spark):
    for s, t in ((1.001, "00:00:01.000"), (0.29, "00:00:00.290"), (2.3, "00:00:02.299"), (3599.9999, "00:59:59.999"), (359999.5, "99:59:59.500"), (360000.0, "100:00:00.000")):
        assert values(spark, X.format_timestamp(F.lit(s))) == t
    assert values(spark, X.parse_timestamp(F.lit("01:02:03.500"))) == 3723.5 and values(spark, X.parse_timestamp(F.lit("02:03.500"))) == 123.5 and values(spark, X.parse_timestamp(F.lit("x"))) is None
    assert values(spark, X.stem_first_dot(F.lit("a.b.mp4"))) == "a" and values(spark, X.stem_last_dot(F.lit("a.b.mp4"))) == "a.b" and values(spark, X.stem_last_dot(F.lit(".hidden"))) == ".hidden"
    assert values(spark, X.extension(F.lit("A.MP4"))) == ".mp4" and values(spark, X.swap_extension(F.lit("a.mp4.mp4"), ".mp4", "")) == "a"
    assert values(spark, X.strip(F.lit("  a b\t\n"))) == "a b" and values(spark, X.source_of(F.lit("w/s/labeled/video/a.mp4"))) == "s" and values(spark, X.source_of(F.lit("a"))) is None
    assert [values(spark, X.path_category(F.lit(p))) for p in ("a/labeled/b", "a/unlabeled/b", "a/relabeled/b", "unlabeled/labeled")] == ["labeled", "unlabeled", "other", "labeled"]
    assert values(spark, X.person_of(F.lit("person_7"))) == "7" and values(spark, X.is_number(F.lit("12"))) and not values(spark, X.is_number(F.lit("1a")))
    assert values(spark, X.falsy_default(F.lit(0.0), 25.0)) == 25.0 and values(spark, X.cyclic(F.lit(0), -1, F.lit(5))) == 4 and values(spark, X.seconds_to_millis(F.lit(1.9999))) == 1999
    assert tuple(values(spark, X.minutes_and_seconds(F.lit(125.7)))) == (2, 5) and values(spark, X.format_hours(F.lit(5400.0))) == "  1.50h"


def test_rotations(spark):
    axis = {"x": (1.0, 0, 0), "-x": (-1.0, 0, 0), "y": (0, 1.0, 0), "-y": (0, -1.0, 0)}
    col = lambda p: F.array(*map(F.lit, map(float, p)))
    turn = lambda v, a, b: values(spark, landmarks.rotate(col(v), col(axis[a]), col(axis[b])))
    assert turn((2, 3, 5), "x", "y") == pytest.approx([-3, 2, 5]) and turn((2, 3, 5), "x", "-x") == pytest.approx([-2, -3, 5])
    assert turn((2, 3, 5), "y", "-y") == pytest.approx([-2, -3, 5]) and turn((2, 3, 5), "x", "x") == [2, 3, 5]
    r = random.Random(1)
    for _ in range(5):
        a, b = ([r.uniform(-1, 1) for _ in range(3)] for _ in range(2))
        got = values(spark, V.unit(landmarks.rotate(col(a), col(a), col(b))))
        assert got == pytest.approx([x / math.dist(b, (0, 0, 0)) for x in b])


def test_hand_example(spark):
    pose = lambda elbow, wrist: [list(map(float, elbow)) if i == 13 else list(map(float, wrist)) if i == 15 else [0.0, 0.0, 0.0] for i in range(25)]
    hand = [[1.0, 1.0, 0.0], [2.0, 1.0, 0.0], *[[1.0, 1.0, 0.0]] * 7, [1.0, 2.0, 0.0], *[[1.0, 1.0, 0.0]] * 11]
    neutral = [[0.1 * i, 0.2 * i, 0.0] for i in range(21)]
    rows = [("k", 0, pose((0, 2, 0), (0, 4, 0)), hand), ("k", 1, None, None), ("k", 2, pose((7, 5, 0), (5, 5, 0)), None), ("n", 0, pose((0, 0, 0), (0, 6.1, 0)), None)]
    df = spark.createDataFrame(rows, "k string, ts long, pose array<array<double>>, left_hand array<array<double>>")
    got = {(r.k, r.ts): r.left_hand for r in hands.complete_hand(df, ["k"], "ts", "left", neutral).collect()}
    assert got["k", 0] == hand and got["k", 1] is None
    made = got["k", 2]
    for i, p in ((0, (5, 5, 0)), (1, (5, 6, 0)), (9, (4, 5, 0))):
        assert made[i] == pytest.approx(p)
    assert got["n", 0][0] == pytest.approx([0, 6.1, 0]) and math.dist(got["n", 0][0], got["n", 0][9]) == pytest.approx(1.0)


def test_landmark_parts(spark):
    k = lit([[i, i + 0.5, i + 0.25] for i in range(133)])
    got = values(spark, landmarks.split_keypoints(landmarks.merge_keypoints(k, k)))
    assert [(p[0][0], len(p)) for p in (got.body, got.face, got.left_hand, got.right_hand)] == [(0, 17), (23, 68), (91, 21), (112, 21)]
    pose, hand = lit([[i, 2 * i, 0] for i in range(25)]), lit([[i, 1, 1] for i in range(21)])
    v = values(spark, landmarks.feature_vector(pose, hand, hand, F.lit(None).cast("array<array<double>>")))
    assert len(v) == 1578 and v[:3] == [11 - 23.5, 22 - 47.0, 0.0] and v[18:24] == [-23.5, -46.0, 1.0, 1.0, 0.0, 0.0] and v[-1] == math.inf
    assert values(spark, landmarks.hip_centre(pose)) == [23.5, 47.0, 0.0] and values(spark, landmarks.make_hip_centric(pose))[24] == [0.5, 1.0, 0.0]
    assert values(spark, F.size(landmarks.trim_pose(lit([[i, 0, 0] for i in range(33)])))) == 25 and values(spark, landmarks.trim_pose(F.array().cast("array<array<double>>"))) is None
    nan = float("nan")
    moved = values(spark, landmarks.to_frame(lit([[0.5, 0.25, 7]]), F.lit(10), F.lit(20), F.lit(100), F.lit(80)))
    assert moved == [[60.0, 40.0, 7.0]] and values(spark, landmarks.to_frame(lit([[nan, nan, nan]]), F.lit(1), F.lit(1), F.lit(1), F.lit(1))) is None
    assert values(spark, landmarks.exported(F.lit(None).cast("array<array<double>>"), 2, 0.0)) == [[0.0] * 3] * 2
    seen = F.array(*[F.struct(F.lit(s).alias("side"), lit([[i, 0, 0]]).alias("points")) for i, s in enumerate(("Right", "Left", "Right", "?"))])
    loose, strict = values(spark, landmarks.pick_hands(seen)), values(spark, landmarks.pick_hands(seen, strict=True))
    assert loose.right[0][0] == 2 and loose.left[0][0] == 3 and strict.left[0][0] == 1
    assert values(spark, landmarks.arm_hand_ratio(*(F.array(*map(F.lit, p)) for p in ((0.0, 3.0, 0.0), (0.0, 0.0, 0.0))), lit([[0, 0, 0]] * 21))) is None


def test_curation_states(spark):
    table = [
        (True, False, False, True, None, "labeled", "labeled"), (True, False, False, False, None, "unlabeled", "unlabeled"), (False, True, False, False, False, "unlabeled", "unlabeled"),
        (True, False, True, False, False, "unlabeled", "unlabeled"), (False, True, False, False, True, "pending", "pending"), (True, False, True, False, True, "pending", "labeled"),
        (False, False, True, True, False, "unlabeled", "unlabeled"), (False, False, True, False, True, "pending", "labeled"), (False, False, False, True, None, "unlabeled", "unlabeled"),
    ]
    sources = spark.createDataFrame([(f"s{i}", *r[:3]) for i, r in enumerate(table)], "name string, subs boolean, auto_subs boolean, generate_subs boolean")
    videos = spark.createDataFrame([(f"s{i}", "v", None if r[4] is None else [0] * r[4]) for i, r in enumerate(table)] + [("other", "v", [])], "source string, stem string, speech array<int>")
    subs = curation.one_subtitle_per_stem(spark.createDataFrame([(f"s{i}", n) for i, r in enumerate(table) if r[3] for n in ("v.es.vtt", "v.es-419.vtt")], "source string, name string"))
    assert {r.name for r in subs.collect()} == {"v.vtt"} and {r.original for r in subs.collect()} == {"v.es-419.vtt"}
    got = {r.source: (r.sorted_status, r.status) for r in curation.curate(videos, sources, subs).collect()}
    assert got == {f"s{i}": r[5:] for i, r in enumerate(table)}
    counts = curation.speech_counts(videos).where("source = 's4'").first()
    assert (counts.with_speech, counts.silent) == (1, 0)
    assert curation.labeled(videos, subs).count() + curation.unlabeled(videos, subs).count() == videos.count()


def test_captions_round_trip(spark):
    cues = spark.createDataFrame([("v", 1, 2.5, 3.0, " b\nc "), ("v", 0, 0.0, 1.0, "a"), ("w", 0, 1.0, 2.0, "")], "video string, seq int, start double, end double, text string")
    made = captions.write_vtt(cues, ["video"])
    assert made.where("video = 'v'").first().vtt == "WEBVTT\n\n00:00:00.000 --> 00:00:01.000\na\n\n00:00:02.500 --> 00:00:03.000\nb\nc\n\n"
    got = {(r.video, r.seq): (r.start, r.end, r.text) for r in captions.read_vtt(made, ["video"]).collect()}
    assert got == {("v", 0): (0.0, 1.0, "a"), ("v", 1): (2.5, 3.0, "b\nc"), ("w", 0): (1.0, 2.0, "")}
    other = spark.createDataFrame([("x", "WEBVTT - t\r\n\r\nNOTE none\r\n\r\nid 7\r\n00:01.000 --> 00:02.000 align:left\r\nhi\r\n")], "video string, vtt string")
    assert [(r.start, r.text) for r in captions.read_vtt(other, ["video"]).collect()] == [(1.0, "hi")]


def test_merge_and_stats(spark):
    old, new = (spark.createDataFrame(r, "video string, value int") for r in ([("a", 1)], [("a", 2), ("b", 3), ("b", 4)]))
    once = merge.first_wins(old, new, ["video"], "value")
    assert sorted(map(tuple, once.collect())) == [("a", 1), ("b", 3)] == sorted(map(tuple, merge.first_wins(once, new, ["video"], "value").collect()))
    manifest = spark.createDataFrame([("s", "a", True), ("s", "b", None)], "source string, video string, done boolean")
    wanted = spark.createDataFrame([("s", v) for v in "abc"], "source string, video string")
    assert sorted(r.video for r in merge.todo(wanted, manifest).collect()) == ["b", "c"]
    assert merge.unite(old, new).where("labeled").count() == 1
    rows = spark.createDataFrame([("s", "labeled", 3600.0), ("s", "other", 1800.0), ("t", "unlabeled", None)], "source string, category string, seconds double")
    got = {r.source: tuple(r)[1:] for r in stats.report(rows).collect()}
    assert got == {"s": (1, 1, 2, 3600.0, 1800.0, 5400.0), "t": (0, 1, 1, 0.0, 0.0, 0.0), "TOTAL": (1, 2, 3, 3600.0, 1800.0, 5400.0)}
    assert {(r.source, r.category, r.videos, r.seconds) for r in stats.by_category(rows).collect()} == {("s", "labeled", 1, 3600.0), ("s", "other", 1, 1800.0), ("t", "unlabeled", 1, 0.0)}
    assert "1.00h   0.50h   1.50h" in stats.report_lines(stats.report(rows)).where("is_total").first().line
    assert tuple(stats.outcome(spark.createDataFrame([(True,), (False,), (True,)], "ok boolean")).first()) == (2, 1)
    assert tuple(stats.download_progress(old, 0).first()) == (1, 0)


def test_rate_limit(spark):
    r = random.Random(8)
    rows = [(r.choice("abc"), r.randrange(1000)) for _ in range(400)] + [("a", None)]
    got = rate.rate_limit(spark.createDataFrame(rows, "k string, t long"), ["k"], "t", 17).collect()
    want = []
    for k in "abc":
        last = None
        for t in sorted(t for q, t in rows if q == k and t is not None):
            if last is None or t - last >= 17:
                want.append((k, t))
                last = t
    assert sorted(map(tuple, got)) == sorted(want)
