"""The registered queries, and DuckDB SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions import text as X
from ..functions.vectors import points
from ..operators import asof, boxes, captions, clips, curation, frames, gaps, hands, landmarks, merge, motion, rate, stats
from ..sources import files
from ..sources import media as media_files
from .fixtures import DETECTIONS_SQL, MEDIA_SQL, cues, cyclic_points, detections, frames_with_body, media, table

QUERIES: dict = {}
ORACLES: dict = {}
TRACK = ("video", "person_id")
GAP_US = 21_600_000_000


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


CLIPS_SQL = f"""WITH {DETECTIONS_SQL},
marked AS (
  SELECT *, CASE WHEN lag(us) OVER t IS NULL OR NOT (lag(us) OVER t + {GAP_US} > us) THEN 1 ELSE 0 END AS starts
  FROM detections WINDOW t AS (PARTITION BY video, person_id ORDER BY us, event_id)),
clips AS (
  SELECT *, CAST(sum(starts) OVER (PARTITION BY video, person_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) - 1 AS INTEGER) AS clip_index
  FROM marked)
"""


def _clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clips.sessionize(detections(spark, sf_dir), GAP_US, TRACK, "us", ("event_id",))


@query(CLIPS_SQL + "SELECT event_id, video, person_id, clip_index FROM clips")
def q01_clip_sessionize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clips(spark, sf_dir).select("event_id", "video", "person_id", "clip_index")


@query(CLIPS_SQL + 'SELECT video, person_id, clip_index, min(us) AS start, max(us) AS "end", max(x2 - x1) AS max_w, max(y2 - y1) AS max_h, count(*) AS n_boxes FROM clips GROUP BY ALL')
def q02_clip_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clips.summarize(_clips(spark, sf_dir), TRACK, "us")


SIDES_SQL = f"""WITH {DETECTIONS_SQL},
frames AS (SELECT event_id, video, person_id, us FROM detections WHERE event_id % 3 = 0),
boxes AS (SELECT video, person_id, us, max(event_id) AS box FROM detections WHERE event_id % 3 <> 0 GROUP BY ALL)
"""


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = detections(spark, sf_dir).select("event_id", *TRACK, "us")
    return rows.where("event_id % 3 = 0"), rows.where("event_id % 3 <> 0").groupBy(*TRACK, "us").agg(F.max("event_id").alias("box"))


@query(
    SIDES_SQL
    + """, hit AS (SELECT f.*, b.box FROM frames f ASOF LEFT JOIN boxes b ON f.video = b.video AND f.person_id = b.person_id AND f.us > b.us),
one AS (SELECT video, person_id, arg_min(box, us) AS box FROM boxes GROUP BY ALL)
SELECT h.event_id, h.video, h.person_id, h.us, coalesce(h.box, o.box) AS box FROM hit h LEFT JOIN one o USING (video, person_id)"""
)
def q03_asof_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.backward(*_sides(spark, sf_dir), TRACK, ["box"], "us", bucket=86_400_000_000.0 * 7)


@query(SIDES_SQL + "SELECT f.*, b.box FROM frames f ASOF LEFT JOIN boxes b ON f.video = b.video AND f.person_id = b.person_id AND f.us >= b.us")
def q04_asof_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.backward(*_sides(spark, sf_dir), TRACK, ["box"], "us", strict=False, first_if_none=False)


@query(SIDES_SQL + "SELECT f.event_id, f.video, f.person_id, f.us, arg_min(b.box, (abs(b.us - f.us), b.us)) AS box FROM frames f LEFT JOIN boxes b USING (video, person_id) GROUP BY ALL")
def q05_asof_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.nearest(*_sides(spark, sf_dir), TRACK, ["box"], "us")


GRID_SQL = f"""WITH {MEDIA_SQL},
bounds AS (SELECT *, greatest(1, CAST(round_even(CAST(fps / 6 AS DOUBLE), 0) AS BIGINT)) AS skip FROM media),
grid AS (SELECT source, video, fps, unnest(range(CAST(ceil(CAST(trunc(start * fps) AS BIGINT) / skip) AS BIGINT) * skip, CAST(trunc("end" * fps) AS BIGINT), skip)) AS frame_no FROM bounds)
"""


@query(GRID_SQL + "SELECT source, video, frame_no, frame_no / fps AS ts FROM grid")
def q06_frame_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.frame_grid(media(spark, sf_dir), 6.0).select("source", "video", "frame_no", "ts")


@query(
    CLIPS_SQL
    + """, spans AS (SELECT video, person_id, clip_index, min(us) AS start, max(us) AS "end" FROM clips GROUP BY ALL)
SELECT d.event_id, s.video, s.person_id, s.clip_index FROM detections d JOIN spans s ON d.video = s.video AND d.person_id = s.person_id AND d.us + 3600000000 BETWEEN s.start AND s."end" """
)
def q07_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = clips.summarize(_clips(spark, sf_dir), TRACK, "us").select(*TRACK, "clip_index", "start", "end")
    moved = detections(spark, sf_dir).select("event_id", *TRACK, (F.col("us") + 3_600_000_000).alias("at"))
    return frames.in_interval(moved, spans, TRACK, "at", "start", "end", 4.0 * GAP_US).select("event_id", *TRACK, "clip_index")


MOTION_SQL = """WITH bodies AS (
  SELECT label AS clip, vec_id AS ts, [[CAST(embedding[3 * p + c + 1] AS DOUBLE) FOR c IN range(3)] FOR p IN range(5, 17)] AS pts FROM embeddings),
features AS (
  SELECT clip, ts, flatten([[x / CASE WHEN sqrt(p[1] * p[1] + p[2] * p[2] + p[3] * p[3]) = 0 THEN 1.0::DOUBLE ELSE sqrt(p[1] * p[1] + p[2] * p[2] + p[3] * p[3]) END FOR x IN p] FOR p IN pts]) AS f FROM bodies),
pairs AS (SELECT clip, ts, f, row_number() OVER w - 1 AS i, lag(f) OVER w AS g FROM features WINDOW w AS (PARTITION BY clip ORDER BY ts)),
changes AS (SELECT clip, ts, i, sqrt(list_sum([(f[k] - g[k]) * (f[k] - g[k]) FOR k IN range(1, 37)])) AS change FROM pairs)
"""


@query(MOTION_SQL + "SELECT clip, ts, i, round(CASE WHEN i > 0 THEN change END, 5) AS change FROM changes")
def q08_motion_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return motion.frame_changes(frames_with_body(spark, sf_dir), ["clip"]).select("clip", "ts", "i", F.round("change", 5).alias("change"))


@query(
    MOTION_SQL
    + """, per AS (SELECT clip, count(*) AS n, greatest(0, coalesce(max(change) FILTER (i BETWEEN 1 AND 36), 0)) AS most FROM changes GROUP BY clip)
SELECT clip, n, round(most, 5) AS max_change, n >= 37 AND most < 5.65 AS still, NOT (n >= 37 AND most < 5.65) AND n >= 6 AS keep FROM per"""
)
def q09_motion_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = motion.verdicts(motion.frame_changes(frames_with_body(spark, sf_dir), ["clip"]), ["clip"], 6.0, 36, 5.65)
    return out.withColumn("max_change", F.round("max_change", 5))


@query(
    """WITH numbers AS (SELECT DISTINCT event_type AS video, event_id AS frame FROM events WHERE event_id % 5 < 3 OR event_id % 7 = 0),
runs AS (SELECT *, frame - row_number() OVER (PARTITION BY video ORDER BY frame) AS run FROM numbers)
SELECT video, min(frame) AS start, max(frame) AS "end" FROM runs GROUP BY video, run"""
)
def q10_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = detections(spark, sf_dir).where("event_id % 5 < 3 or event_id % 7 = 0").select("video", F.col("event_id").alias("frame"))
    return gaps.islands(missing, ["video"])


@query(
    """WITH rows_ AS (SELECT label AS clip, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i, vec_id, CAST(embedding[1] AS DOUBLE) AS v FROM embeddings),
holes AS (SELECT clip, i, CASE WHEN vec_id % 7 IN (1, 2) OR vec_id % 11 < 4 THEN NULL ELSE v END AS value FROM rows_),
sides AS (
  SELECT *, last_value(CASE WHEN value IS NULL THEN NULL ELSE i END IGNORE NULLS) OVER l AS li, last_value(value IGNORE NULLS) OVER l AS lv,
         first_value(CASE WHEN value IS NULL THEN NULL ELSE i END IGNORE NULLS) OVER r AS ri, first_value(value IGNORE NULLS) OVER r AS rv
  FROM holes WINDOW l AS (PARTITION BY clip ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), r AS (PARTITION BY clip ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
SELECT clip, i, coalesce(value, CASE WHEN ri - li - 1 <= 2 THEN lv + (rv - lv) / (ri - li - 1) * (i - li) END) AS value,
       coalesce(value IS NULL AND ri - li - 1 <= 2, false) AS filled FROM sides"""
)
def q11_interpolate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("label").alias("clip"), (F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1).cast("bigint").alias("i"), "vec_id", F.element_at("embedding", 1).cast("double").alias("v"))
    holes = rows.select("clip", "i", F.when(~(F.col("vec_id") % 7).isin(1, 2) & (F.col("vec_id") % 11 >= 4), F.col("v")).alias("value"))
    return gaps.interpolate(holes, ["clip"], "i", "value", 2).select("clip", "i", "value", "filled")


@query(
    f"""WITH {DETECTIONS_SQL},
most AS (SELECT video, person_id, max(x2 - x1) AS w, max(y2 - y1) AS h FROM detections GROUP BY ALL)
SELECT event_id,
       CAST(trunc(greatest(0.0::DOUBLE, y1 + (y2 - y1) / 2 - h * 1.2::DOUBLE / 2)) AS INTEGER) AS y_start, CAST(trunc(y1 + (y2 - y1) / 2 + h * 1.2::DOUBLE / 2) AS INTEGER) AS y_end,
       CAST(trunc(greatest(0.0::DOUBLE, x1 + (x2 - x1) / 2 - w * 1.2::DOUBLE / 2)) AS INTEGER) AS x_start, CAST(trunc(x1 + (x2 - x1) / 2 + w * 1.2::DOUBLE / 2) AS INTEGER) AS x_end
FROM detections JOIN most USING (video, person_id)"""
)
def q12_crop_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = detections(spark, sf_dir)
    most = rows.groupBy(*TRACK).agg(F.max(F.col("x2") - F.col("x1")).alias("w"), F.max(F.col("y2") - F.col("y1")).alias("h"))
    return rows.join(most, [*TRACK]).select("event_id", boxes.crop_region(*map(F.col, ("x1", "y1", "x2", "y2", "w", "h"))).alias("r")).select("event_id", "r.*")


@query(
    f"""WITH {DETECTIONS_SQL},
scaled AS (SELECT event_id, [greatest(0, least(CAST(round_even(v * 2.5::DOUBLE, 0) AS INTEGER), m - 1)) FOR v, m IN list_zip([x2, y1, x1, y2], [1280, 720, 1280, 720])] AS b FROM detections)
SELECT event_id, CAST(least(b[1], b[3]) AS DOUBLE) AS x1, CAST(least(b[2], b[4]) AS DOUBLE) AS y1, CAST(greatest(b[1], b[3]) AS DOUBLE) AS x2, CAST(greatest(b[2], b[4]) AS DOUBLE) AS y2 FROM scaled""".replace(
        "[greatest(0, least(CAST(round_even(v * 2.5::DOUBLE, 0) AS INTEGER), m - 1)) FOR v, m IN list_zip([x2, y1, x1, y2], [1280, 720, 1280, 720])]",
        "[" + ", ".join(f"greatest(0, least(CAST(round_even({v} * 2.5::DOUBLE, 0) AS INTEGER), {m - 1}))" for v, m in (("x2", 1280), ("y1", 720), ("x1", 1280), ("y2", 720))) + "]",
    )
)
def q13_rescale_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = boxes.rescale_box(F.array("x2", "y1", "x1", "y2"), F.lit(2.5), F.lit(1280), F.lit(720))
    return detections(spark, sf_dir).select("event_id", scaled.alias("b")).select("event_id", *(F.element_at("b", i + 1).alias(c) for i, c in enumerate(("x1", "y1", "x2", "y2"))))


@query(
    """WITH k AS (SELECT vec_id, [[CAST(embedding[(i * 3) % 64 + 1] AS DOUBLE), CAST(embedding[(i * 3 + 1) % 64 + 1] AS DOUBLE), CAST(embedding[(i * 3 + 2) % 64 + 1] AS DOUBLE)] FOR i IN range(133)] AS p FROM embeddings),
parts AS (SELECT vec_id, p[1:17] AS body, p[24:91] AS face, p[92:112] AS lh, p[113:133] AS rh FROM k)
SELECT vec_id, len(body) AS n_body, len(face) AS n_face, len(lh) AS n_left, len(rh) AS n_right, body[17][1] AS body_last, face[1][2] AS face_first, lh[1][3] AS left_first, rh[21][1] AS right_last FROM parts"""
)
def q14_split_keypoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = cyclic_points(F.col("embedding"), 133)
    rows = table(spark, sf_dir, "embeddings").select("vec_id", landmarks.split_keypoints(landmarks.merge_keypoints(p, p)).alias("s")).select("vec_id", "s.*")
    at = lambda c, i, j: F.element_at(F.element_at(c, i), j)
    n = lambda c: F.size(c).cast("bigint")
    return rows.select("vec_id", n("body").alias("n_body"), n("face").alias("n_face"), n("left_hand").alias("n_left"), n("right_hand").alias("n_right"), at("body", 17, 1).alias("body_last"), at("face", 1, 2).alias("face_first"), at("left_hand", 1, 3).alias("left_first"), at("right_hand", 21, 1).alias("right_last"))


@query(
    """WITH k AS (SELECT vec_id, [[CAST(embedding[(i * 3) % 64 + 1] AS DOUBLE), CAST(embedding[(i * 3 + 1) % 64 + 1] AS DOUBLE), CAST(embedding[(i * 3 + 2) % 64 + 1] AS DOUBLE)] FOR i IN range(60)] AS p FROM embeddings),
c AS (SELECT vec_id, p, [p[25][j] - (p[25][j] - p[24][j]) / 2 FOR j IN range(1, 4)] AS h FROM k),
m AS (SELECT vec_id, p, h, [[p[i][j] - h[j] FOR j IN range(1, 4)] FOR i IN range(1, 61)] AS q FROM c),
v AS (SELECT vec_id, flatten(list_concat(list_concat([q[i] FOR i IN [12, 13, 14, 15, 24, 25]],
        [CASE WHEN i = 1 THEN q[1] ELSE [q[i][j] - q[1][j] FOR j IN range(1, 4)] END FOR i IN range(1, 22)]),
        list_concat([CASE WHEN i = 40 THEN q[40] ELSE [q[i][j] - q[40][j] FOR j IN range(1, 4)] END FOR i IN range(40, 61)], p[1:10]))) AS f FROM m)
SELECT vec_id, len(f) AS n, round(list_sum(f), 5) AS total, f[1] AS first, f[22] AS left_finger, f[174] AS face_last FROM v"""
)
def q15_feature_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p")
    rows = table(spark, sf_dir, "embeddings").select("vec_id", cyclic_points(F.col("embedding"), 60).alias("p"))
    f = landmarks.feature_vector(landmarks.trim_pose(p), F.slice(p, 1, 21), F.slice(p, 40, 21), F.slice(p, 1, 10))
    total = F.aggregate("f", F.lit(0.0), lambda s, x: s + x)
    return rows.select("vec_id", f.alias("f")).select("vec_id", F.size("f").cast("bigint").alias("n"), F.round(total, 5).alias("total"), *(F.element_at("f", i).alias(c) for c, i in (("first", 1), ("left_finger", 22), ("face_last", 174))))


@query("SELECT doc_id, source, doc_id IN (SELECT doc_id FROM labels) AS labeled FROM documents")
def q16_labeled_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.with_label(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels").select("doc_id"), ("doc_id",))


@query(
    """WITH v AS (SELECT source, n_chars AS s, doc_id IN (SELECT doc_id FROM labels) AS labeled FROM documents)
SELECT CASE WHEN grouping(source) = 1 THEN 'TOTAL' ELSE source END AS source, CAST(sum(labeled::INT) AS BIGINT) AS labeled, CAST(sum((NOT labeled)::INT) AS BIGINT) AS unlabeled, count(*) AS videos,
       CAST(sum(CASE WHEN labeled THEN s ELSE 0 END) AS DOUBLE) AS labeled_s, CAST(sum(CASE WHEN labeled THEN 0 ELSE s END) AS DOUBLE) AS unlabeled_s, CAST(sum(s) AS DOUBLE) AS total_s
FROM v GROUP BY ROLLUP (source)"""
)
def q17_source_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = curation.with_label(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), table(spark, sf_dir, "labels").select("doc_id"), ("doc_id",))
    return stats.report(rows.select("source", F.when(F.col("labeled"), "labeled").otherwise("unlabeled").alias("category"), F.col("n_chars").alias("seconds")))


STAMP_SQL = "printf('%02d:%02d:%02d.%03d', CAST(floor({0} / 3600) AS BIGINT), CAST(floor(({0} % 3600) / 60) AS BIGINT), CAST(floor({0} % 60) AS BIGINT), CAST(trunc(({0} % 1) * 1000) AS BIGINT))"
CUES_SQL = r"""WITH cues AS (SELECT conv_id AS video, turn AS seq, turn * 2.3::DOUBLE AS s, turn * 2.3::DOUBLE + 1.7::DOUBLE AS e, regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g') AS text FROM conversations)
"""


@query(CUES_SQL + f"SELECT video, 'WEBVTT' || chr(10) || chr(10) || string_agg({STAMP_SQL.format('s')} || ' --> ' || {STAMP_SQL.format('e')} || chr(10) || text || chr(10) || chr(10), '' ORDER BY seq) AS vtt FROM cues GROUP BY video")
def q18_vtt_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captions.write_vtt(cues(spark, sf_dir), ["video"])


@query(
    CUES_SQL
    + """SELECT video, CAST(row_number() OVER (PARTITION BY video ORDER BY seq) - 1 AS INTEGER) AS seq,
       round(floor(s) + trunc((s % 1) * 1000) / 1000, 3) AS start, round(floor(e) + trunc((e % 1) * 1000) / 1000, 3) AS "end", text FROM cues"""
)
def q19_vtt_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = captions.read_vtt(captions.write_vtt(cues(spark, sf_dir), ["video"]), ["video"])
    return rows.select("video", "seq", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"), "text")


@query(
    """WITH existing AS (SELECT o_custkey AS video, max(o_orderkey) AS value FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1),
incoming AS (SELECT o_custkey AS video, min(o_orderkey) AS value FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1)
SELECT * FROM existing UNION ALL SELECT * FROM incoming WHERE video NOT IN (SELECT video FROM existing)"""
)
def q20_merge_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("video"), F.col("o_orderkey").alias("value"))
    existing = rows.where("value % 3 = 0").groupBy("video").agg(F.max("value").alias("value"))
    return merge.first_wins(existing, rows.where("value % 3 <> 0").withColumn("at", F.col("value")), ["video"], "at")


@query(
    r"""WITH n AS (SELECT page_id, split_part(url, '?', 1) AS path, string_split(split_part(url, '?', 1), '/') AS parts FROM pages),
b AS (SELECT page_id, path, parts, parts[len(parts)] AS name FROM n)
SELECT page_id, name, split_part(name, '.', 1) AS stem, regexp_replace(name, '(.)\.[^.]*$', '\1') AS last_stem, lower(regexp_extract(name, '.(\.[^./]*)$', 1)) AS ext,
       replace(name, '.html', '.txt') AS swapped, CASE WHEN list_contains(parts, 'en') THEN 'labeled' WHEN list_contains(parts, 'de') THEN 'unlabeled' ELSE 'other' END AS category,
       parts[len(parts) - 3] AS source FROM b"""
)
def q21_path_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.split_part(F.col("url"), F.lit("?"), F.lit(1))
    rows = table(spark, sf_dir, "pages").select("page_id", path.alias("path"), X.base_name(path).alias("name"))
    as_status = F.concat(F.regexp_replace(F.regexp_replace(F.col("path"), "/en(?=/|$)", "/labeled"), "/de(?=/|$)", "/unlabeled"), F.lit(""))
    return rows.select("page_id", "name", X.stem_first_dot(F.col("name")).alias("stem"), X.stem_last_dot(F.col("name")).alias("last_stem"), X.extension(F.col("name")).alias("ext"), X.swap_extension(F.col("name"), ".html", ".txt").alias("swapped"), X.path_category(as_status).alias("category"), X.source_of(F.col("path")).alias("source"))


@query(f"WITH {DETECTIONS_SQL} SELECT event_id, video, CAST(floor((row_number() OVER (PARTITION BY video ORDER BY us, event_id) - 1) / 32) AS BIGINT) AS batch FROM detections")
def q22_batching(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clips.in_batches(detections(spark, sf_dir), 32, ["video"], ["us", "event_id"]).select("event_id", "video", "batch")


@query(
    """WITH d AS (SELECT vec_id, [CAST(embedding[i] AS DOUBLE) FOR i IN [1, 2, 3]] AS v, [CAST(embedding[i] AS DOUBLE) FOR i IN [4, 5, 6]] AS a, [CAST(embedding[i] AS DOUBLE) FOR i IN [7, 8, 9]] AS b FROM embeddings),
u AS (SELECT vec_id, v, [x / sqrt(list_sum([y * y FOR y IN a])) FOR x IN a] AS a, [x / sqrt(list_sum([y * y FOR y IN b])) FOR x IN b] AS b FROM d),
k AS (SELECT *, a[1] * b[1] + a[2] * b[2] + a[3] * b[3] AS c, [a[2] * b[3] - a[3] * b[2], a[3] * b[1] - a[1] * b[3], a[1] * b[2] - a[2] * b[1]] AS n FROM u),
r AS (SELECT vec_id, v, c, sqrt(1 - c * c) AS s, [x / sqrt(list_sum([y * y FOR y IN n])) FOR x IN n] AS k FROM k),
t AS (SELECT vec_id, [v[1] * c + (k[2] * v[3] - k[3] * v[2]) * s + k[1] * (k[1] * v[1] + k[2] * v[2] + k[3] * v[3]) * (1 - c),
  v[2] * c + (k[3] * v[1] - k[1] * v[3]) * s + k[2] * (k[1] * v[1] + k[2] * v[2] + k[3] * v[3]) * (1 - c),
  v[3] * c + (k[1] * v[2] - k[2] * v[1]) * s + k[3] * (k[1] * v[1] + k[2] * v[2] + k[3] * v[3]) * (1 - c)] AS w FROM r)
SELECT vec_id, round(w[1], 5) AS x, round(w[2], 5) AS y, round(w[3], 5) AS z FROM t"""
)
def q23_rodrigues(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = points(F.col("embedding"), 3)
    rows = table(spark, sf_dir, "embeddings").select("vec_id", p.alias("p"))
    w = landmarks.rotate(*(F.element_at("p", i) for i in (1, 2, 3)))
    return rows.select("vec_id", w.alias("w")).select("vec_id", *(F.round(F.element_at("w", i + 1), 5).alias(c) for i, c in enumerate("xyz")))


#: A made-up neutral hand for the query: 21 points on a slanted line.
NEUTRAL = [[0.05 * i, 0.1 * i, 0.01 * i] for i in range(21)]


HAND_SQL = f"""WITH neutral AS (SELECT [{", ".join(f"[{float(x)!r}::DOUBLE, {float(y)!r}::DOUBLE, {float(z)!r}::DOUBLE]" for x, y, z in NEUTRAL)}] AS hand),
d AS (
  SELECT label AS clip, vec_id AS ts,
         CASE WHEN vec_id % 11 <> 5 THEN [[CAST(embedding[(i * 3 + c) % 64 + 1] AS DOUBLE) FOR c IN range(3)] FOR i IN range(25)] END AS pose,
         CASE WHEN vec_id % 3 = 0 THEN [[CAST(embedding[i * 3 + c + 1] AS DOUBLE) FOR c IN range(3)] FOR i IN range(21)] END AS hand FROM embeddings),
f AS (
  SELECT *, CASE WHEN pose IS NOT NULL THEN [pose[14][c] - pose[16][c] FOR c IN range(1, 4)] END AS arm FROM d),
g AS (
  SELECT *, CASE WHEN hand IS NOT NULL AND arm IS NOT NULL THEN sqrt(list_sum([a * a FOR a IN arm])) / sqrt(pow(hand[1][1] - hand[10][1], 2) + pow(hand[1][2] - hand[10][2], 2) + pow(hand[1][3] - hand[10][3], 2)) END AS own FROM f),
w AS (
  SELECT *, last_value(hand IGNORE NULLS) OVER t AS seen, last_value(CASE WHEN hand IS NOT NULL THEN {{'arm': arm}} END IGNORE NULLS) OVER t AS seen_arm, first_value(own IGNORE NULLS) OVER t AS ratio
  FROM g WINDOW t AS (PARTITION BY clip ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
s AS (SELECT clip, ts, w.hand AS hand, pose, arm, ratio, seen_arm, coalesce(seen, n.hand) AS base FROM w, neutral n),
c AS (SELECT *, [[p[k] - base[1][k] FOR k IN range(1, 4)] FOR p IN base] AS still FROM s),
v AS (SELECT *, coalesce(seen_arm.arm, [still[1][k] - still[10][k] FOR k IN range(1, 4)]) AS v1 FROM c),
u AS (SELECT *, [x / sqrt(list_sum([y * y FOR y IN v1])) FOR x IN v1] AS a, [x / sqrt(list_sum([y * y FOR y IN arm])) FOR x IN arm] AS b FROM v),
r AS (SELECT *, a[1] * b[1] + a[2] * b[2] + a[3] * b[3] AS co, [a[2] * b[3] - a[3] * b[2], a[3] * b[1] - a[1] * b[3], a[1] * b[2] - a[2] * b[1]] AS n FROM u),
k AS (SELECT *, sqrt(greatest(0, 1 - co * co)) AS si, [x / sqrt(list_sum([y * y FOR y IN n])) FOR x IN n] AS ax,
        sqrt(list_sum([y * y FOR y IN arm])) / coalesce(ratio, 6.1::DOUBLE) / sqrt(list_sum([pow(still[1][k] - still[10][k], 2) FOR k IN range(1, 4)])) AS size FROM r),
m AS (SELECT *, still[10] AS p, ax[1] * still[10][1] + ax[2] * still[10][2] + ax[3] * still[10][3] AS along FROM k),
made AS (
  SELECT clip, ts, hand, pose, pose[16] AS wrist,
         pose[16][2] + size * CASE WHEN co > 0.999999 THEN p[2] ELSE p[2] * co + (ax[3] * p[1] - ax[1] * p[3]) * si + ax[2] * along * (1 - co) END AS y FROM m)
SELECT clip, ts, hand IS NOT NULL OR pose IS NOT NULL AS present,
       round(CASE WHEN hand IS NOT NULL THEN hand[1][1] ELSE wrist[1] END, 5) AS wrist_x, round(CASE WHEN hand IS NOT NULL THEN hand[10][2] ELSE y END, 5) AS knuckle_y FROM made"""


@query(HAND_SQL)
def q24_hand_synthesis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing left hands of the clips, made from the last seen one."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("label").alias("clip"), F.col("vec_id").alias("ts"), cyclic_points(F.col("embedding"), 25).alias("pose"), points(F.col("embedding"), 21).alias("seen"))
    rows = rows.select("clip", "ts", F.when(F.col("ts") % 11 != 5, F.col("pose")).alias("pose"), F.when(F.col("ts") % 3 == 0, F.col("seen")).alias("left_hand"))
    out = hands.complete_hand(rows, ["clip"], "ts", "left", NEUTRAL)
    at = lambda i, j: F.round(F.element_at(F.element_at("left_hand", i), j), 5)
    return out.select("clip", "ts", F.col("left_hand").isNotNull().alias("present"), at(1, 1).alias("wrist_x"), at(10, 2).alias("knuckle_y"))


EDGES_SQL = ", ".join(f"({a}, {b})" for a, b in [(0 if j == 0 else 4 * f + j, 4 * f + j + 1) for f in range(5) for j in range(4)] + [(4 * f + 1, 4 * f + 5) for f in range(1, 4)])


@query(
    f"""WITH edges(a, b) AS (VALUES {EDGES_SQL}),
pts AS (SELECT vec_id, i AS point, CAST(embedding[3 * i + 1] AS DOUBLE) AS x, CAST(embedding[3 * i + 2] AS DOUBLE) AS y FROM embeddings, range(21) t(i) WHERE (vec_id + i) % 6 <> 0)
SELECT p.vec_id, CAST(a AS INTEGER) AS a, CAST(b AS INTEGER) AS b, p.x AS x1, p.y AS y1, q.x AS x2, q.y AS y2 FROM edges JOIN pts p ON p.point = a JOIN pts q ON q.point = b AND q.vec_id = p.vec_id"""
)
def q25_bones(spark: SparkSession, sf_dir: str) -> DataFrame:
    hand = F.transform(points(F.col("embedding"), 21), lambda p, i: F.when((F.col("vec_id") + i) % 6 != 0, p).otherwise(F.array_repeat(F.lit(float("nan")), 3)))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", hand.alias("hand"))
    return landmarks.bones(landmarks.valid_points(rows, "hand", ["vec_id"]), landmarks.hand_edges(spark), ["vec_id"])


@query(
    """WITH RECURSIVE e AS (SELECT user_id, epoch_us(ts) AS us FROM events),
kept(user_id, us) AS (
  SELECT user_id, min(us) FROM e GROUP BY user_id
  UNION ALL
  SELECT e.user_id, min(e.us) FROM kept k JOIN e ON e.user_id = k.user_id AND e.us >= k.us + 86400000000 GROUP BY e.user_id, k.us)
SELECT user_id, us FROM kept"""
)
def q26_rate_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = detections(spark, sf_dir).select(F.col("person_id").alias("user_id"), "us")
    return rate.rate_limit(rows, ["user_id"], "us", 86_400_000_000)


@query("SELECT DISTINCT source, lang FROM documents ORDER BY source, lang LIMIT 10")
def q27_dedupe_sort_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten of the distinct pairs: the report shows ten."""
    return table(spark, sf_dir, "documents").select("source", "lang").distinct().orderBy("source", "lang").limit(10)


@query(
    """WITH v AS (SELECT doc_id, doc_id % 2 = 1 AS subs, doc_id % 3 = 1 AS auto, doc_id % 5 < 2 AS gen, doc_id IN (SELECT doc_id FROM labels) AS vtt, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE doc_id % 7 > 2 END AS speech FROM documents),
s AS (SELECT *, CASE WHEN (subs OR auto) AND vtt THEN 'labeled' WHEN auto OR gen THEN CASE WHEN speech IS NOT NULL AND NOT speech THEN 'unlabeled' ELSE 'pending' END ELSE 'unlabeled' END AS sorted_status FROM v)
SELECT doc_id, sorted_status, CASE WHEN sorted_status = 'pending' AND gen THEN 'labeled' ELSE sorted_status END AS status FROM s"""
)
def q28_curation_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    rows = curation.with_label(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id"), ("doc_id",))
    status = curation.status_after_sorting(i % 2 == 1, i % 3 == 1, i % 5 < 2, F.col("labeled"), F.when(i % 11 != 0, i % 7 > 2))
    return rows.select("doc_id", status.alias("sorted_status")).withColumn("status", curation.status_after_transcribing(F.col("sorted_status"), i % 5 < 2))


@query(
    """WITH k AS (SELECT vec_id, [CAST(trunc(CAST(embedding[3 * i + 1] AS DOUBLE) * 640) AS INTEGER) FOR i IN range(21)] AS xs, [CAST(trunc(CAST(embedding[3 * i + 2] AS DOUBLE) * 360) AS INTEGER) FOR i IN range(21)] AS ys FROM embeddings)
SELECT vec_id, greatest(0, -list_min(xs)) AS "left", greatest(0, -list_min(ys)) AS top, greatest(0, list_max(xs) - 640 + 1) AS "right", greatest(0, list_max(ys) - 360 + 1) AS bottom FROM k"""
)
def q29_padding_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = landmarks.to_pixels(points(F.col("embedding"), 21), F.lit(640), F.lit(360))
    return table(spark, sf_dir, "embeddings").select("vec_id", landmarks.needed_padding(pixels, F.lit(640), F.lit(360)).alias("p")).select("vec_id", "p.*")


@query(
    f"""SELECT o_orderkey, {STAMP_SQL.format('o_totalprice')} AS stamp, CAST(trunc(o_totalprice * 1000) AS BIGINT) AS millis, round(o_totalprice / 3600, 6) AS hours,
       CAST(floor(o_totalprice / 60) AS BIGINT) AS minutes, CAST(floor(o_totalprice) AS BIGINT) % 60 AS seconds, (o_orderkey + 1) % 7 AS next_index FROM orders"""
)
def q30_scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("o_totalprice")
    rows = table(spark, sf_dir, "orders").withColumn("m", X.minutes_and_seconds(s))
    return rows.select("o_orderkey", X.format_timestamp(s).alias("stamp"), X.seconds_to_millis(s).alias("millis"), F.round(X.hours(s), 6).alias("hours"), "m.minutes", "m.seconds", X.cyclic(F.col("o_orderkey"), 1, F.lit(7)).cast("bigint").alias("next_index"))


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def q31_todo(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("done"))
    return merge.todo(table(spark, sf_dir, "documents").select("doc_id", "source"), manifest, ["doc_id"])


@query(
    f"""WITH {DETECTIONS_SQL},
missing AS (SELECT DISTINCT video, event_id AS frame FROM detections WHERE event_id % 5 < 3),
runs AS (SELECT video, min(frame) AS start, max(frame) AS "end" FROM (SELECT *, frame - row_number() OVER (PARTITION BY video ORDER BY frame) AS run FROM missing) GROUP BY video, run)
SELECT d.event_id AS frame, d.video, r.start, r."end" FROM detections d LEFT JOIN runs r ON d.video = r.video AND d.event_id BETWEEN r.start AND r."end" """
)
def q32_island_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = detections(spark, sf_dir).select(F.col("event_id").alias("frame"), "video")
    return gaps.covering(rows, gaps.islands(rows.where("frame % 5 < 3"), ["video"]), ["video"])


@query(
    """WITH rows_ AS (SELECT label AS clip, vec_id AS frame FROM embeddings),
p AS (SELECT *, lag(frame) OVER (PARTITION BY clip ORDER BY frame) AS before FROM rows_)
SELECT clip, frame, coalesce(frame - before > 1, frame > 0) AS jumped FROM p"""
)
def q33_jumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.jumps(table(spark, sf_dir, "embeddings").select(F.col("label").alias("clip"), F.col("vec_id").alias("frame")), ["clip"], "frame")


@query(
    """WITH k AS (SELECT vec_id, [CAST(embedding[i] AS DOUBLE) FOR i IN range(1, 64)] AS e FROM embeddings),
d AS (SELECT vec_id, sqrt(pow(e[1] - e[4], 2) + pow(e[2] - e[5], 2) + pow(e[3] - e[6], 2)) AS arm, sqrt(pow(e[1] - e[28], 2) + pow(e[2] - e[29], 2) + pow(e[3] - e[30], 2)) AS hand FROM k)
SELECT vec_id, round(CASE WHEN hand <> 0 THEN arm / hand END, 5) AS ratio FROM d"""
)
def q34_arm_hand_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = points(F.col("embedding"), 21)
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(landmarks.arm_hand_ratio(F.element_at(p, 1), F.element_at(p, 2), p), 5).alias("ratio"))


@query(CLIPS_SQL + """SELECT video, person_id, clip_index, min(us) AS start, max(us) AS "end", string_agg(CAST(us AS VARCHAR) || ':' || CAST(CAST(x1 AS BIGINT) AS VARCHAR), ',' ORDER BY us, x1, y1, x2, y2) AS boxes FROM clips GROUP BY ALL""")
def q35_clip_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips with their boxes in time order, written as ``time:x1``."""
    shown = F.transform("boxes", lambda b: F.concat_ws(":", b["ts"].cast("string"), F.element_at(b["box"], 1).cast("bigint").cast("string")))
    return clips.assemble(_clips(spark, sf_dir), TRACK, "us").select(*TRACK, "clip_index", "start", "end", F.array_join(shown, ",").alias("boxes"))


def _holes(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Frames (clip, frame) of ``n`` points, of which two in five are missing."""
    frame = F.row_number().over(Window.partitionBy("label").orderBy("vec_id")).cast("bigint")
    rows = table(spark, sf_dir, "embeddings").select(F.col("label").alias("clip"), frame.alias("frame"), cyclic_points(F.col("embedding"), n).alias("all"))
    return rows.select("clip", "frame", F.when(F.col("frame") % 5 > 1, F.col("all")).alias("points"))


def _filled_sql(most: int) -> str:
    return f"""WITH f AS (SELECT label AS clip, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS frame, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[5] AS DOUBLE) AS y FROM embeddings),
h AS (SELECT clip, frame, CASE WHEN frame % 5 > 1 THEN {{'i': frame, 'x': x, 'y': y}} END AS p FROM f),
k AS (SELECT *, last_value(p IGNORE NULLS) OVER (PARTITION BY clip ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l,
        first_value(p IGNORE NULLS) OVER (PARTITION BY clip ORDER BY frame ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r FROM h),
g AS (SELECT *, p IS NULL AND l IS NOT NULL AND r IS NOT NULL AND r.i - l.i - 1 <= {most} AS filled FROM k)
"""


@query(_filled_sql(2) + "SELECT clip, frame, filled, round(CASE WHEN filled THEN l.x + (r.x - l.x) / (r.i - l.i - 1) * (frame - l.i) ELSE p.x END, 5) AS x, round(CASE WHEN filled THEN l.y + (r.y - l.y) / (r.i - l.i - 1) * (frame - l.i) ELSE p.y END, 5) AS y FROM g")
def q36_interpolate_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gaps.interpolate(_holes(spark, sf_dir, 21), ["clip"], "frame", "points", 2, points=True)
    return rows.select("clip", "frame", "filled", F.round(F.col("points")[0][0], 5).alias("x"), F.round(F.col("points")[1][1], 5).alias("y"))


@query(
    _filled_sql(1)
    + "SELECT clip, frame, CASE WHEN p IS NULL AND NOT filled THEN 'missing' WHEN filled THEN 'made' ELSE 'seen' END AS face, round(CASE WHEN filled THEN l.x + (r.x - l.x) / (r.i - l.i) * (frame - l.i) ELSE p.x END, 5) AS x FROM g"
)
def q37_face_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faces whose gaps of one frame are filled; what is still missing is infinite in the feature vector."""
    rows = gaps.interpolate(_holes(spark, sf_dir, 68), ["clip"], "frame", "points", 1, points=True, divide_by_length_plus_one=True)
    at = F.coalesce(F.col("points"), F.array_repeat(F.array_repeat(F.lit(float("inf")), 3), 68))[0][0]
    missing = at == F.lit(float("inf"))
    return rows.select("clip", "frame", F.when(missing, "missing").when(F.col("filled"), "made").otherwise("seen").alias("face"), F.round(F.when(~missing, at), 5).alias("x"))


BOXES_SQL = f"""WITH {DETECTIONS_SQL},
one AS (SELECT video, person_id, us, max(event_id) AS event_id FROM detections GROUP BY ALL),
boxes AS (SELECT d.* FROM detections d JOIN one USING (event_id))
"""


@query(BOXES_SQL + "SELECT video, CAST(person_id AS VARCHAR) || '.0' AS person_id, us, x1, y1, x2, y2 FROM boxes")
def q38_detections_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections as one JSON text a video, read back as rows."""
    rows = clips.latest_per_timestamp(detections(spark, sf_dir), TRACK, "us", "event_id")
    rows = rows.select("video", F.concat(F.col("person_id").cast("string"), F.lit(".0")).alias("person_id"), F.col("us").cast("double").alias("ts"), "x1", "y1", "x2", "y2")
    back = files.parse_frames(files.frames_json(rows, ("video",)), "value", ("video",))
    return back.select("video", "person_id", F.col("ts").cast("bigint").alias("us"), "x1", "y1", "x2", "y2")


@query(
    """SELECT vec_id, CASE WHEN vec_id % 4 <> 1 THEN round(CAST(embedding[1] AS DOUBLE) * 60 + vec_id % 100, 5) END AS x, CASE WHEN vec_id % 4 <> 1 THEN round(CAST(embedding[5] AS DOUBLE) * 80 + 7, 5) END AS y,
       CASE WHEN vec_id % 4 <> 1 THEN round(CAST(embedding[9] AS DOUBLE), 5) END AS z FROM embeddings"""
)
def q39_crop_to_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("vec_id")
    moved = landmarks.to_frame(points(F.col("embedding"), 21), F.when(i % 4 != 1, (i % 100).cast("double")), F.lit(7.0), F.lit(60.0), F.lit(80.0))
    return table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("p")).select("vec_id", *(F.round(F.col("p")[k][k], 5).alias(c) for k, c in enumerate("xyz")))


@query("SELECT o_orderkey, printf('%6.2fh', (o_totalprice + 0.001) / 3600.0) AS hours, o_orderstatus || '_' || CAST(o_custkey AS VARCHAR) AS person, CAST(o_custkey AS VARCHAR) AS id, o_custkey % 3 = 0 AS digits, CASE WHEN o_orderkey % 4 = 0 THEN 25.0::DOUBLE ELSE CAST(o_orderkey % 4 AS DOUBLE) END AS fps FROM orders")
def q40_formats_and_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours as text, ids in keys like ``person_7``, keys of digits, and defaults for what is null or zero."""
    key = F.concat_ws("_", "o_orderstatus", F.col("o_custkey").cast("string"))
    name = F.when(F.col("o_custkey") % 3 == 0, F.col("o_custkey").cast("string")).otherwise(key)
    rows = table(spark, sf_dir, "orders")
    return rows.select("o_orderkey", X.format_hours(F.col("o_totalprice") + 0.001).alias("hours"), key.alias("person"), X.person_of(key).alias("id"), X.is_number(name).alias("digits"), X.falsy_default((F.col("o_orderkey") % 4).cast("double"), 25.0).alias("fps"))


@query(
    """WITH h AS (SELECT event_id, event_id % 3 AS a, event_id % 5 AS b FROM events)
SELECT event_id, CASE WHEN b IN (1, 2, 3) THEN event_id + 1 WHEN a IN (1, 2) THEN event_id END AS "left", CASE WHEN b = 0 THEN event_id + 1 WHEN a = 0 THEN event_id END AS "right",
       CASE WHEN b IN (1, 2) THEN event_id + 1 WHEN a = 1 THEN event_id END AS strict_left FROM h"""
)
def q41_pick_hands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two found hands a frame (the second may be none): of each side the last; a side that is neither counts as left unless it must be said."""
    i = F.col("event_id")
    none = F.lit(None).cast("struct<side:string,points:bigint>")
    one = F.struct(F.when(i % 3 == 0, "Right").when(i % 3 == 1, "Left").otherwise("?").alias("side"), i.alias("points"))
    two = F.when(i % 5 < 4, F.struct(F.when(i % 5 == 0, "Right").when(i % 5 < 3, "Left").otherwise("?").alias("side"), (i + 1).alias("points"))).otherwise(none)
    hands_ = F.filter(F.array(one, two), lambda h: h.isNotNull())
    rows = table(spark, sf_dir, "events").select("event_id", landmarks.pick_hands(hands_).alias("p"), landmarks.pick_hands(hands_, strict=True).alias("s"))
    return rows.select("event_id", "p.left", "p.right", F.col("s.left").alias("strict_left"))


@query(
    """WITH v AS (SELECT doc_id, source, 'v' || doc_id AS stem, doc_id % 3 <> 0 AS labeled FROM documents),
c AS (SELECT 'v' || conv_id AS stem, string_agg(coalesce(text, ''), ' ' ORDER BY turn) AS vtt FROM conversations GROUP BY 1)
SELECT v.doc_id, v.labeled, CASE WHEN v.labeled THEN coalesce(c.vtt, '') ELSE '' END AS subtitles FROM v LEFT JOIN c USING (stem)"""
)
def q42_captions_of_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labeled and unlabeled videos in one table, with the caption text of the labeled ones."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("v"), F.col("doc_id").cast("string")).alias("stem"), F.lit("s").alias("source"))
    videos = merge.unite(rows.where("doc_id % 3 <> 0"), rows.where("doc_id % 3 = 0"))
    said = F.array_sort(F.collect_list(F.struct("turn", F.coalesce("text", F.lit("")).alias("t"))))
    texts = table(spark, sf_dir, "conversations").groupBy(F.concat(F.lit("v"), F.col("conv_id").cast("string")).alias("stem")).agg(F.array_join(F.transform(said, lambda x: x["t"]), " ").alias("vtt"))
    return files.captions_of(videos, texts.withColumn("source", F.lit("s"))).select("doc_id", "labeled", "subtitles")


@query(
    f"""WITH {DETECTIONS_SQL},
s AS (SELECT event_id, event_id % 7 > 1 AS whole, x1, y1, least(greatest(round_even((x1 + 0.1) * 5, 0), 0), 1279) AS a, least(greatest(round_even(y1 * 5, 0), 0), 719) AS b, least(greatest(round_even(x2 * 5, 0), 0), 1279) AS c, least(greatest(round_even(y2 * 5, 0), 0), 719) AS d FROM detections)
SELECT event_id, CASE WHEN whole THEN 4 ELSE 2 END AS n, CASE WHEN whole THEN least(a, c) ELSE x1 + 0.1 END AS first, CASE WHEN whole THEN least(b, d) ELSE y1 END AS second FROM s"""
)
def q43_malformed_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps of boxes rescaled to 1280 x 720; a box of two values stays as it is."""
    box = F.when(F.col("event_id") % 7 > 1, F.array(F.col("x1") + 0.1, F.col("y1"), F.col("x2"), F.col("y2"))).otherwise(F.array(F.col("x1") + 0.1, F.col("y1")))
    scaled = boxes.rescale_boxes(F.create_map(F.lit("1.0"), box), F.lit(5.0), F.lit(1280), F.lit(720))["1.0"]
    return detections(spark, sf_dir).select("event_id", scaled.alias("b")).select("event_id", F.size("b").alias("n"), F.col("b")[0].alias("first"), F.col("b")[1].alias("second"))


@query(
    GRID_SQL
    + """, s AS (SELECT video, start, "end", fps FROM media)
SELECT video, round(CASE WHEN fps <> 50 THEN CAST(video % 1000 AS DOUBLE) / fps END, 6) AS seconds, CAST(trunc((start + 1.25) * fps) AS BIGINT) AS frame, start >= 1.0 AND start < 3.0 AS inside, start >= 1.0 AS after FROM s"""
)
def q44_frame_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame numbers as seconds (none where the rate is 0), the frame shown at a time, and half-open ranges."""
    rate = F.when(F.col("fps") == 50, F.lit(0.0)).otherwise(F.col("fps"))
    rows = boxes.frame_number_to_seconds(media(spark, sf_dir).withColumn("ts", (F.col("video") % 1000).cast("double")), rate)
    at = F.col("start")
    return rows.select("video", F.round("ts", 6).alias("seconds"), frames.frame_at(at + 1.25, F.col("fps")).alias("frame"), frames.in_range(at, F.lit(1.0), F.lit(3.0)).alias("inside"), frames.in_range(at, F.lit(1.0), None).alias("after"))


@query("SELECT vec_id, round(CAST(embedding[4] AS DOUBLE), 5) AS x, round(CAST(embedding[5] AS DOUBLE), 5) AS y, round(CAST(embedding[6] AS DOUBLE), 5) AS z, 21 AS n, 21 AS exported, vec_id % 3 = 0 AS blank FROM embeddings")
def q45_landmark_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landmark structs as arrays, and an export in which a missing part is points of NaN."""
    structs = F.transform(points(F.col("embedding"), 21), lambda p: F.struct(p[0].alias("x"), p[1].alias("y"), p[2].alias("z")))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", landmarks.to_arrays(structs).alias("p"))
    out = landmarks.exported(F.when(F.col("vec_id") % 3 != 0, F.col("p")), 21)
    return rows.select("vec_id", *(F.round(F.col("p")[1][k], 5).alias(c) for k, c in enumerate("xyz")), F.size("p").alias("n"), F.size(out).alias("exported"), F.isnan(out[0][0]).alias("blank"))


@query(
    f"""WITH {DETECTIONS_SQL}
SELECT event_id, CAST(trunc(greatest(0.0, x1 + (x2 - x1) / 2 - 80.0 * 1.2 / 2)) AS INTEGER) AS x_start, CAST(trunc(greatest(0.0, y1 + (y2 - y1) / 2 - 120.0 * 1.2 / 2)) AS INTEGER) AS y_start, 96 AS x_size, 144 AS y_size FROM detections"""
)
def q46_preview_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = boxes.preview_region(*(F.col(c) for c in ("x1", "y1", "x2", "y2")), F.lit(80.0), F.lit(120.0))
    return detections(spark, sf_dir).select("event_id", region.alias("r")).select("event_id", "r.*")


VIDEOS_SQL = "WITH v AS (SELECT doc_id, source, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'labeled' ELSE 'unlabeled' END AS category, CASE WHEN doc_id % 9 <> 4 THEN CAST(n_chars AS DOUBLE) / 4 END AS seconds FROM documents)\n"


def _videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = curation.with_label(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), table(spark, sf_dir, "labels").select("doc_id"), ("doc_id",))
    return rows.select("doc_id", "source", F.when(F.col("labeled"), "labeled").otherwise("unlabeled").alias("category"), F.when(F.col("doc_id") % 9 != 4, F.col("n_chars").cast("double") / 4).alias("seconds"))


@query(VIDEOS_SQL + "SELECT source, category, count(*) AS videos, sum(coalesce(seconds, 0.0)) AS seconds FROM v GROUP BY ALL")
def q47_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.by_category(_videos(spark, sf_dir))


@query(
    VIDEOS_SQL
    + """, r AS (SELECT coalesce(source, 'TOTAL') AS source, grouping(source) = 1 AS is_total, sum(CASE WHEN category = 'labeled' THEN coalesce(seconds, 0.0) ELSE 0.0 END) AS l, sum(CASE WHEN category <> 'labeled' THEN coalesce(seconds, 0.0) ELSE 0.0 END) AS u, sum(coalesce(seconds, 0.0)) AS t FROM v GROUP BY ROLLUP (source))
SELECT is_total, source, printf('%-24s %s %s %s', source, printf('%6.2fh', l / 3600.0), printf('%6.2fh', u / 3600.0), printf('%6.2fh', t / 3600.0)) AS line FROM r"""
)
def q48_report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.report_lines(stats.report(_videos(spark, sf_dir)))


@query("SELECT source, count(*) FILTER (doc_id % 4 > 1) AS with_speech, count(*) FILTER (doc_id % 4 = 1) AS silent FROM documents GROUP BY 1")
def q49_speech_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    heard = F.when(F.col("doc_id") % 4 == 0, F.lit(None)).when(F.col("doc_id") % 4 == 1, F.array()).otherwise(F.array(F.lit(1)))
    return curation.speech_counts(table(spark, sf_dir, "documents").select("source", heard.alias("speech")))


@query(
    """WITH d AS (SELECT doc_id, doc_id % 6 = 0 AS done, doc_id % 4 = 1 AS bad FROM documents),
r AS (SELECT CAST(doc_id AS VARCHAR) || '.mp4' AS target, NOT bad AS ok FROM d WHERE NOT done)
SELECT target, (SELECT count(*) FROM r WHERE ok) AS success, (SELECT count(*) FROM r WHERE NOT ok) AS failed, (SELECT count(*) FROM d WHERE done) AS completed, (SELECT least(count(*), 50) FROM d WHERE done) AS already FROM r WHERE NOT ok"""
)
def q50_fetch_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an archive does not list is fetched by a worker that fails for bad names; the failures, with the run's counters."""
    items = table(spark, sf_dir, "documents").select(F.concat(F.when(F.col("doc_id") % 4 == 1, "bad").otherwise("good"), F.col("doc_id").cast("string")).alias("item"), F.concat(F.col("doc_id").cast("string"), F.lit(".mp4")).alias("target"), "doc_id")
    archive = items.where("doc_id % 6 = 0").select("item")
    results = media_files.fetch(items.select("item", "target").unionByName(items.select("item", "target")), archive)
    return media_files.failures(results).select("target").join(stats.outcome(results)).join(stats.download_progress(archive, 50))


@query(
    """WITH d AS (SELECT doc_id, CAST(doc_id AS VARCHAR) || '.mp4' AS target, list_extract([144, 360, NULL], doc_id % 3 + 1) AS height FROM documents)
SELECT target, doc_id % 5 = 0 OR coalesce(height = 144, false) OR doc_id % 4 <> 1 AS ok,
       CASE WHEN doc_id % 5 = 0 THEN 'exists' WHEN height = 144 THEN 'already 144p' WHEN doc_id % 4 = 1 THEN 'cannot read bad' || doc_id ELSE '' END AS message FROM d"""
)
def q51_resize_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Videos that are there or have the height already are left out; an unknown height is worked on."""
    i = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.when(i % 4 == 1, "bad").otherwise("good"), i.cast("string")).alias("path"), F.concat(i.cast("string"), F.lit(".mp4")).alias("target"), F.when(i % 3 == 0, 144).when(i % 3 == 1, 360).alias("height"))
    return media_files.resize(rows.select("path", "target", "height"), rows.where("doc_id % 5 = 0").select("target"))


@query(
    r"""WITH n AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'clip' ELSE 'part-' || (page_id % 40) END || '.mkv' AS name FROM pages)
SELECT page_id, try_cast(nullif(regexp_extract(split_part(name, '.', 1), '-(\d+)$', 1), '') AS INTEGER) AS number, '/out/s' || (page_id % 2) || '/' || split_part(name, '.', 1) || '.mp4' AS target FROM n"""
)
def q52_numbered_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers at the end of file names, and where a converted file goes."""
    i = F.col("page_id")
    name = F.concat(F.when(i % 3 == 0, "clip").otherwise(F.concat(F.lit("part-"), (i % 40).cast("string"))), F.lit(".mkv"))
    rows = media_files.numbered(table(spark, sf_dir, "pages").select("page_id", name.alias("name")))
    path = F.concat(F.lit("/in/s"), (i % 2).cast("string"), F.lit("/"), F.col("name"))
    return rows.select("page_id", "number", files.output_path(path, "/in", "/out/").alias("target"))


@query(
    """WITH c(source, subs, auto_subs, generate_subs) AS (VALUES ('src0', true, false, false), ('src1', false, true, false), ('src2', false, false, true)),
v AS (SELECT doc_id, source, doc_id IN (SELECT doc_id FROM labels) AS vtt, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE doc_id % 7 > 2 END AS speech FROM documents),
s AS (SELECT v.doc_id, c.*, CASE WHEN (subs OR auto_subs) AND vtt THEN 'labeled' WHEN auto_subs OR generate_subs THEN CASE WHEN speech IS NOT NULL AND NOT speech THEN 'unlabeled' ELSE 'pending' END ELSE 'unlabeled' END AS sorted_status FROM v JOIN c USING (source))
SELECT doc_id, source, sorted_status, CASE WHEN sorted_status = 'pending' AND generate_subs THEN 'labeled' ELSE sorted_status END AS status FROM s"""
)
def q53_curate_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Videos of the configured sources with their status; a source that is not configured has none."""
    config = Config.from_dict({"sources": [{"name": "src0", "subs": True}, {"name": "src1", "auto_subs": True}, {"name": "src2", "generate_subs": True}]})
    i = F.col("doc_id")
    heard = F.when(i % 11 == 0, F.lit(None)).when(i % 7 > 2, F.array(F.lit(1))).otherwise(F.array())
    videos = table(spark, sf_dir, "documents").select("doc_id", "source", i.cast("string").alias("stem"), heard.alias("speech"))
    subtitles = table(spark, sf_dir, "labels").join(videos.select("doc_id", "source"), "doc_id").select("source", F.col("doc_id").cast("string").alias("stem"))
    return curation.curate(videos, config.sources_frame(spark), subtitles).select("doc_id", "source", "sorted_status", "status")


@query(
    """WITH a AS (SELECT source, 'v' || (doc_id // 2) AS stem, '/audio/' || doc_id || '.mp3' AS path FROM documents WHERE doc_id % 3 <> 1)
SELECT v.doc_id, v.source, a.audio FROM documents v LEFT JOIN (SELECT source, stem, min(path) AS audio FROM a GROUP BY 1, 2) a ON a.source = v.source AND a.stem = 'v' || v.doc_id"""
)
def q54_audio_of_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each video with its sound file; some have none, some two."""
    i = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select("doc_id", "source")
    stem = lambda n: F.concat(F.lit("v"), n.cast("string")).alias("stem")
    audio = rows.where(i % 3 != 1).select("source", stem(F.floor(i / 2)), F.concat(F.lit("/audio/"), i.cast("string"), F.lit(".mp3")).alias("path"))
    return files.with_audio(rows.select("doc_id", "source", stem(i)), audio).select("doc_id", "source", "audio")


@query("SELECT '/' || page_id || '.mp4' AS target, 'cannot read ' || url AS message FROM pages WHERE page_id % 4 = 1 ORDER BY target LIMIT 10")
def q55_failure_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten first failures of a run over all pages."""
    rows = table(spark, sf_dir, "pages").select(F.concat(F.lit("/"), F.col("page_id").cast("string"), F.lit(".mp4")).alias("target"), (F.col("page_id") % 4 != 1).alias("ok"), F.concat(F.lit("cannot read "), F.col("url")).alias("message"))
    return stats.examples(rows).select("target", "message")
