"""Explicit schemas of the library's tables."""

from __future__ import annotations

#: Boxes stay text at first, because a track may occur twice in a frame.
FRAMES_JSON = "array<struct<timestamp: double, boxes: string>>"
DETECTIONS = "source string, video string, person_id string, ts double, x1 double, y1 double, x2 double, y2 double"
CLIPS = "source string, video string, person_id string, clip_index int, start double, end double, max_w double, max_h double, n_boxes bigint"
FRAMES = "source string, video string, person_id string, clip_index int, frame_no bigint, ts double"
VIDEOS = "source string, video string, stem string, status string, duration_s double, fps double, height int, n_frames bigint"
CUES = "source string, video string, seq int, start double, end double, text string"
MANIFEST = "source string, video string, labeled boolean, fps double, done boolean"
SOURCES = "name string, url string, path string, subs boolean, auto_subs boolean, generate_subs boolean"
LANDMARKS = FRAMES + ", body array<array<double>>, left_hand array<array<double>>, right_hand array<array<double>>, face array<array<double>>"
