"""Edit logs in one batch and as a stream, and the review job."""

from __future__ import annotations

import os
import random
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from boxmill.jobs import review_labels
from boxmill.operators import review
from boxmill.streaming.replay import LOG, class_in_force_stream, label_stream, replay_edits_stream

EDITS = "session long, image_id long, seq long, action string, class_id long, x double, y double"
START = "image_id long, object_index long, class_id long, source string, confidence double, corners array<struct<x:double,y:double>>"


def square(x, y, r):
    return [(float(a), float(b)) for a, b in ((x - r, y - r), (x + r, y - r), (x + r, y + r), (x - r, y + r))]


def replay(spark, start, edits):
    return [tuple(r)[:4] for r in review.replay_edits(spark.createDataFrame(start, START), spark.createDataFrame(edits, EDITS)).orderBy("image_id", "object_index").collect()]


def test_only_the_last_save_counts(spark):
    edits = [(1, 7, 1, "add", 4, 50.0, 50.0), (1, 7, 2, "save", None, None, None), (1, 7, 3, "add", None, 300.0, 300.0)]
    assert replay(spark, [], edits) == [(7, 0, 4, "manual_obb")]


def test_clicks_select_and_delete_the_smallest_hit(spark):
    start = [(7, 0, 1, "file", 1.0, square(50, 50, 40)), (7, 1, 2, "file", 1.0, square(50, 50, 10)), (7, 2, 3, "file", 1.0, square(200, 200, 10))]
    click = lambda seq, action, x, y: (1, 7, seq, action, None, x, y)
    edits = [click(1, "left_click", 50.0, 50.0), click(2, "delete_selected", None, None), click(3, "save", None, None)]
    assert [r[2] for r in replay(spark, start, edits)] == [1, 3]
    edits = [click(1, "middle_click", 200.0, 205.0), click(2, "middle_click", 500.0, 5.0), click(3, "undo", None, None), click(4, "next", None, None)]
    assert [r[2] for r in replay(spark, start, edits)] == [1]
    edits = [click(1, "undo", None, None), click(2, "undo", None, None), click(3, "undo", None, None), click(4, "undo", None, None), click(5, "reset", None, None), click(6, "save", None, None)]
    assert [r[2] for r in replay(spark, start, edits)] == [1, 2, 3]


def test_class_in_force_is_carried_across_images_of_a_session(spark):
    edits = [(1, 7, 1, "save", 5, None, None), (1, 8, 2, "add", None, 10.0, 10.0), (1, 8, 3, "save", None, None, None), (2, 9, 4, "add", None, 10.0, 10.0), (2, 9, 5, "save", None, None, None)]
    assert replay(spark, [], edits) == [(8, 0, 5, "manual_obb"), (9, 0, 0, "manual_obb")]


def test_class_in_force_does_not_depend_on_the_span(spark):
    df = spark.createDataFrame(random_edits(), EDITS).withColumn("class_id", F.when(F.col("seq") % 7 == 3, F.col("class_id")))
    key = lambda span: sorted((r.seq, r.current_class) for r in review.class_in_force(df, 9, span).collect())
    assert key(3) == key(10_000) == key(1) and len(key(3)) == 120


def random_edits(n=120, images=4, seed=2):
    r = random.Random(seed)
    actions = ["add", "left_click", "middle_click", "undo", "delete_selected", "save"]
    return [(1, r.randrange(images), i, r.choice(actions), r.randrange(6), float(r.randrange(80)), float(r.randrange(80))) for i in range(n)]


def in_order(edits, folder, files):
    """edits as Parquet files whose times are in order of seq, so that a stream reads them so."""
    step = -(-len(edits) // files)
    for i in range(files):
        table = pa.Table.from_pylist([dict(zip((c.split()[0] for c in EDITS.split(", ")), e, strict=True)) for e in edits[i * step : (i + 1) * step]], schema=pa.schema([("session", pa.int64()), ("image_id", pa.int64()), ("seq", pa.int64()), ("action", pa.string()), ("class_id", pa.int64()), ("x", pa.float64()), ("y", pa.float64())]))
        folder.mkdir(exist_ok=True)
        pq.write_table(table, folder / f"{i}.parquet")
        os.utime(folder / f"{i}.parquet", (1_000_000 + 60 * i,) * 2)


def run(stream, folder, name):
    """Run a stream over all that is there, into folder/name."""
    query = stream.coalesce(1).writeStream.format("parquet").option("checkpointLocation", str(folder / f"{name}-state")).option("path", str(folder / name)).trigger(availableNow=True).start()
    assert query.awaitTermination(400) and query.exception() is None and len(query.recentProgress) > 3


def test_stream_in_many_triggers_equals_one_batch(spark, tmp_path):
    """With objects and proposals at the start, classes that are carried over, and choices outside the scheme."""
    r = random.Random(4)
    actions = ["add", "left_click", "middle_click", "undo", "delete_selected", "save", "reset", "load"]
    edits = [(i % 2, 2 * r.randrange(2) + i % 2, i, r.choice(actions), r.choice([None, None, 0, 3, 77]), float(r.randrange(80)), float(r.randrange(80))) for i in range(120)]
    in_order(edits, tmp_path / "in", 6)
    start = spark.createDataFrame([(i, k, k, "file", 1.0, square(20 + 9 * k, 30, 8)) for i in range(3) for k in range(4)], START)
    proposals = spark.createDataFrame([(0, 0, 5, "sam2_amg", 99.0, square(40, 40, 15))], START)
    classes = spark.createDataFrame([(k, str(k)) for k in range(6)], "class_id long, label string")
    source = spark.readStream.schema(EDITS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run(class_in_force_stream(source, 2, classes), tmp_path, "log")
    log = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log"))
    run(replay_edits_stream(log, 2, start, proposals), tmp_path, "out")
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [x for x in out if x.kind == "late"] == []
    last = {}
    for row in sorted(out, key=lambda x: x.seq):
        last.setdefault(row.image_id, {}).setdefault(row.seq, []).append(row)
    got = sorted(tuple(x)[2:] for rows in last.values() for x in rows[max(rows)] if x.kind == "object")
    batch = review.replay_edits(start, spark.createDataFrame(edits, EDITS), 2, proposals, classes).collect()
    assert got == sorted(map(tuple, batch)) and len(got) >= 3
    assert {row.image_id for row in out} == {0, 1, 2, 3}


def test_a_closed_image_leaves_the_state_and_late_edits_are_named(spark, tmp_path):
    edits = [(1, 7, 1, "add", 4, 50.0, 50.0), (1, 7, 3, "save", None, None, None), (1, 7, 2, "undo", None, None, None), (1, 7, 4, "close", None, None, None), (1, 7, 5, "save", None, None, None)]
    in_order(edits, tmp_path / "in", 5)
    source = spark.readStream.schema(EDITS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run(replay_edits_stream(source), tmp_path, "out")
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("seq").collect()
    assert [(x.kind, x.seq) for x in rows] == [("late", 2), ("object", 3), ("empty", 5)]


def test_load_and_reset(spark):
    start = [(7, 0, 1, "file", 1.0, square(50, 50, 40)), (7, 1, 2, "file", 1.0, square(50, 50, 10))]
    step = lambda seq, action: (1, 7, seq, action, None, 10.0, 10.0)
    assert [r[2] for r in replay(spark, start, [step(1, "undo"), step(2, "load"), step(3, "save")])] == [1, 2]  # nothing saved yet
    assert [r[2] for r in replay(spark, start, [step(1, "undo"), step(2, "save"), step(3, "undo"), step(4, "load"), step(5, "save")])] == [1]
    objects, edits = spark.createDataFrame(start, START), spark.createDataFrame([step(1, "reset"), step(2, "save")], EDITS)
    proposals = spark.createDataFrame([(7, 0, 5, "sam2_amg", 9.0, square(5, 5, 2))], START)
    assert [(r.class_id, r.source) for r in review.replay_edits(objects, edits, proposals=proposals).collect()] == [(5, "sam2_amg")]
    assert review.replay_edits(objects, edits, proposals=proposals.limit(0)).collect() == []


def test_choices_outside_the_scheme_count_as_none(spark):
    classes = spark.createDataFrame([(0, "a"), (1, "b")], "class_id long, label string")
    edits = spark.createDataFrame([(1, 7, 1, "add", 1, 5.0, 5.0), (1, 7, 2, "add", 77, 5.0, 5.0), (1, 7, 3, "save", None, None, None)], EDITS)
    assert [r.class_id for r in review.replay_edits(spark.createDataFrame([], START), edits, classes=classes).orderBy("object_index").collect()] == [1, 1]


def test_an_image_saved_empty_has_an_empty_text(spark):
    images = spark.createDataFrame([(7, 100, 100), (8, 100, 100)], "image_id long, width int, height int")
    edits = spark.createDataFrame([(1, 7, 1, "undo", None, None, None), (1, 7, 2, "save", None, None, None), (1, 8, 3, "undo", None, None, None)], EDITS)
    objects = spark.createDataFrame([(i, 0, 1, "file", 1.0, square(50, 50, 10)) for i in (7, 8)], START)
    assert review.replay_edits(objects, edits).collect() == []
    assert [tuple(r) for r in review_labels.reviewed_texts(objects, edits, images).collect()] == [(7, "")]


def plain_replay(start, log):
    """The rules of the edits, action by action, on lists."""
    objects, selected, saved = list(start), 0, None
    for _, _, _, action, class_id, x, y in log:
        holds = [i for i, (_, (cx, cy, r)) in enumerate(objects) if abs(x - cx) <= r[0] and abs(y - cy) <= r[1]]
        hit = min(holds, key=lambda i: (objects[i][1][2][0] * objects[i][1][2][1], i), default=None)
        if action == "add":
            objects.append((class_id, (x, y, (30, 10))))
            selected = len(objects) - 1
        elif action == "left_click" and hit is not None:
            selected = hit
        elif action == "middle_click" and hit is not None:
            objects.pop(hit)
            selected = max(0, min(hit, len(objects) - 1))
        elif action == "delete_selected" and objects:
            objects.pop(selected)
            selected = min(selected, max(0, len(objects) - 1))
        elif action == "undo" and objects:
            objects.pop()
            selected = min(selected, max(0, len(objects) - 1))
        elif action == "save":
            saved = list(objects)
    return saved


def test_replay_against_a_plain_loop(spark):
    edits = random_edits(400, 5, 8)
    start = {i: [(k, (15.0 * k, 40.0, (9, 9))) for k in range(5)] for i in range(5)}
    rows = [(i, k, c, "file", 1.0, square(x, y, 9)) for i, objects in start.items() for k, (c, (x, y, _)) in enumerate(objects)]
    got = review.replay_edits(spark.createDataFrame(rows, START), spark.createDataFrame(edits, EDITS)).collect()
    for i in range(5):
        mine = sorted((r for r in got if r.image_id == i), key=lambda r: r.object_index)
        expected = plain_replay(start[i], [e for e in edits if e[1] == i])
        assert [(r.class_id, (r.corners[0].x + r.corners[2].x) / 2, (r.corners[0].y + r.corners[2].y) / 2) for r in mine] == [(c, x, y) for c, (x, y, _) in expected or []]


BOXED = EDITS + ", confidence double, corners array<struct<x:double,y:double>>, ts timestamp"
ALL = ["add", "accept", "accept", "manual", "left_click", "left_click", "left_click", "right_click", "middle_click", "backspace", "escape", "clear", "undo", "delete_selected", "reset", "load", "save"]


def boxed_edits(n, images, seed):
    """Edits of all kinds: upright boxes, flat ones, none; and four clicks that make an upright box by hand in one go."""
    r = random.Random(seed)
    out, at = [], {}
    for i in range(n):
        image = r.randrange(images)
        action = r.choice(ALL)
        x, y = float(r.randrange(80)), float(r.randrange(80))
        if at.get(image):
            action, (x, y) = "left_click", at[image].pop()
        elif action == "manual" and r.random() < 0.7:
            w, h = r.choice([0.0, 7.0, 20.0]), r.choice([5.0, 9.0])
            at[image] = [(x - w, y), (x, y - h), (x - w, y - h), (x, y)]
        corners = r.choice([None, square(x, y, 6), square(x, y, 9), [(x, y), (x + 5, y), (x + 9, y), (x + 2, y)], [(x, y)] * 3]) if action in ("add", "accept") else None
        out.append((1, image, i, action, r.randrange(6), x, y, r.random() if action == "accept" else None, corners, datetime(2024, 1, 1) + timedelta(minutes=i)))
    return out


def plain_boxes(start, log):
    """The rules of all edits on lists; boxes are upright: (class, source, confidence, (x0, y0, x1, y1))."""
    objects, selected, saved, prompts, hand = list(start), 0, None, 0, None
    upright = lambda ps: (min(x for x, _ in ps), min(y for _, y in ps), max(x for x, _ in ps), max(y for _, y in ps))
    for _, _, _, action, class_id, x, y, confidence, corners, _ in log:
        box = None
        if corners is not None and len(corners) == 4:
            box = upright(corners)
            box = None if box[0] == box[2] or box[1] == box[3] else box
        new = None
        if "click" in action and hand is not None:
            if action == "left_click":
                hand.append((x, y))
            if len(hand) == 4:
                box, hand = upright(hand), None
                new = None if box[0] == box[2] or box[1] == box[3] else (class_id, "manual_obb", 1.0, box)
        elif "click" in action:
            area = lambda b: (b[2] - b[0]) * (b[3] - b[1])
            hit = min((i for i, (_, _, _, b) in enumerate(objects) if b[0] <= x <= b[2] and b[1] <= y <= b[3]), key=lambda i: (area(objects[i][3]), i), default=None)
            if hit is None:
                prompts += action != "middle_click"
            elif action == "middle_click":
                objects.pop(hit)
                selected = max(0, min(hit, len(objects) - 1))
            else:
                selected = hit
        elif action == "add":
            box = (x - 30, y - 10, x + 30, y + 10) if corners is None else box
            new = box and (class_id, "manual_obb", 1.0, box)
        elif action == "accept" and hand is None and prompts and box:
            new, prompts = (class_id, "sam2", confidence, box), 0
        elif action == "manual":
            hand, prompts = [], 0
        elif action == "backspace" and hand:
            hand.pop()
        elif action == "escape":
            hand = None
        elif action == "clear":
            prompts = 0
        elif action == "undo" and objects:
            objects.pop()
            selected = min(selected, max(0, len(objects) - 1))
        elif action == "delete_selected" and objects:
            objects.pop(selected)
            selected = min(selected, max(0, len(objects) - 1))
        elif action in ("reset", "load"):
            objects = list(start) if action == "reset" or saved is None else [(c, "file", 1.0, b) for c, _, _, b in saved]
            selected, prompts, hand = 0, 0, None
        elif action == "save":
            saved = list(objects)
        if new:
            objects.append(new)
            selected = len(objects) - 1
    return saved


def upright_rows(rows):
    key = lambda r: (r.class_id, r.source, r.confidence, tuple(round(f(p[k] for p in r.corners), 6) for f, k in ((min, 0), (min, 1), (max, 0), (max, 1))))
    return [key(r) for r in sorted(rows, key=lambda r: r.object_index)]


def test_boxes_of_edits_against_a_plain_loop(spark):
    edits = boxed_edits(1500, 5, 3)
    start = {i: [(k, "file", 1.0, (15.0 * k, 31.0, 15.0 * k + 18, 49.0)) for k in range(5)] for i in range(5)}
    rows = [(i, k, c, s, f, square((x0 + x1) / 2, 40, 9)) for i, objects in start.items() for k, (c, s, f, (x0, _, x1, _)) in enumerate(objects)]
    got = review.replay_edits(spark.createDataFrame(rows, START), spark.createDataFrame(edits, BOXED)).collect()
    expected = {i: plain_boxes(start[i], [e for e in edits if e[1] == i]) for i in range(5)}
    for i in range(5):
        assert upright_rows([r for r in got if r.image_id == i]) == (expected[i] or [])
    made = {}
    for k in range(20, 1500):  # every kind of object is there at some save
        for i in range(5):
            for _, source, _, box in plain_boxes(start[i], [e for e in edits[:k] if e[1] == i]) or []:
                made.setdefault(source, set()).add(box[2] - box[0])
    assert made["sam2"] >= {12} and {7, 12, 18, 20, 60} <= made["manual_obb"]


def as_files(spark, edits, folder, files):
    step = -(-len(edits) // files)
    for i in range(files):
        spark.createDataFrame(edits[i * step : (i + 1) * step], BOXED).coalesce(1).write.parquet(str(folder / "made" / str(i)))
        part = next((folder / "made" / str(i)).glob("*.parquet"))
        (folder / "in").mkdir(exist_ok=True)
        part.rename(folder / "in" / f"{i}.parquet")
        os.utime(folder / "in" / f"{i}.parquet", (1_000_000 + 60 * i,) * 2)


def test_boxes_of_edits_in_a_stream(spark, tmp_path):
    edits = boxed_edits(240, 4, 9)
    as_files(spark, edits, tmp_path, 6)
    source = lambda schema, name: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))
    run(class_in_force_stream(source(BOXED, "in")), tmp_path, "log")
    run(replay_edits_stream(source(LOG, "log")), tmp_path, "out")
    out = [r for r in spark.read.parquet(str(tmp_path / "out")).collect() if r.kind != "late"]
    last = {}
    for r in out:
        last[r.image_id] = max(last.get(r.image_id, -1), r.seq)
    got = sorted(tuple(r)[2:] for r in out if r.kind == "object" and r.seq == last[r.image_id])
    assert got == sorted(map(tuple, review.replay_edits(spark.createDataFrame([], START), spark.createDataFrame(edits, BOXED)).collect())) and got


def test_idle_images_leave_the_state(spark, tmp_path):
    """Image 1 ends early, image 2 goes on; two hours later 1 is closed, a late edit of it is named, and a new one begins anew."""
    at = lambda minute: datetime(2024, 1, 1) + timedelta(minutes=minute)
    edit = lambda image, seq, minute, action="add": (1, image, seq, action, 3, 10.0 * seq, 10.0, None, None, at(minute))
    log = [
        [edit(1, 1, 0), edit(2, 2, 1), edit(1, 3, 2, "save")],
        [edit(1, 4, 3), edit(2, 5, 100)],
        [edit(2, 6, 130, "save")],  # the watermark passes 3 + 60
        [edit(1, 7, 20), edit(2, 8, 140, "save")],  # 20 + 60 is over: late
        [edit(1, 9, 150, "save"), edit(2, 10, 151, "save")],
    ]
    for i, rows in enumerate(log):
        spark.createDataFrame(rows, BOXED).coalesce(1).write.parquet(str(tmp_path / "made" / str(i)))
        (tmp_path / "in").mkdir(exist_ok=True)
        next((tmp_path / "made" / str(i)).glob("*.parquet")).rename(tmp_path / "in" / f"{i}.parquet")
        os.utime(tmp_path / "in" / f"{i}.parquet", (1_000_000 + 60 * i,) * 2)
    source = spark.readStream.schema(BOXED).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    stream = replay_edits_stream(source, idle="1 hour")
    query = stream.coalesce(1).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
    assert query.awaitTermination(400) and query.exception() is None
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(sizes) == 2 and any(b < a for a, b in zip(sizes, sizes[1:], strict=False))
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("seq", "image_id", "object_index").collect()
    found = [(r.kind, r.image_id, r.seq) for r in rows]
    assert ("closed", 1, 4) in found and ("late", 1, 7) in found and ("empty", 1, 9) in found
    assert [f for f in found if f[:2] == ("object", 1)] == [("object", 1, 3)]
    assert [f for f in found if f[:2] == ("object", 2)] == [("object", 2, k) for k in (6, 6, 8, 8, 10, 10)]
    assert [f for f in found if f[0] == "closed" and f[1] == 2] == [] and len(found) == 10


def test_labels_are_made_once_per_arriving_file(spark, tmp_path):
    for i in range(3):
        spark.createDataFrame([(i, k) for k in range(4)], "image_id long, det_id long").coalesce(1).write.parquet(str(tmp_path / "in" / f"{i}"))
    source = spark.readStream.schema("image_id long, det_id long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    for _ in range(2):  # the second run finds nothing new
        label_stream(source, lambda rows: rows.groupBy("image_id").count(), str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination(240)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.image_id, r["count"]) for r in got.collect()) == [(0, 4), (1, 4), (2, 4)]


def test_an_empty_label_file_keeps_proposals_out(spark):
    images = spark.createDataFrame([(1, 100, 100), (2, 100, 100), (3, 100, 100)], "image_id long, width int, height int")
    label_files = spark.createDataFrame([(1,), (2,)], "image_id long")
    labels = spark.createDataFrame([(1, 0, 4, square(0.5, 0.5, 0.1))], "image_id long, line_no long, class_id long, corners array<struct<x:double,y:double>>")
    proposals = spark.createDataFrame(
        [(i, 0, 2000.0, 2000.0, 100.0, 30.0, 3.3, 0.7, square(50, 50, 20)) for i in (1, 2, 3)],
        "image_id long, mask_idx long, area double, obb_area double, w double, h double, aspect double, rectangularity double, corners array<struct<x:double,y:double>>",
    )
    got = review_labels.starting_objects(images, label_files, labels, proposals).collect()
    assert sorted((r.image_id, r.source) for r in got) == [(1, "file"), (3, "sam2_amg")]
    edits = spark.createDataFrame([(1, 1, 1, "save", None, None, None)], EDITS)
    lines = review_labels.reviewed_lines(review_labels.starting_objects(images, label_files, labels, proposals), edits, images).collect()
    assert [(r.image_id, r.line) for r in lines] == [(1, "4 0.400000 0.400000 0.600000 0.400000 0.600000 0.600000 0.400000 0.600000")]


@pytest.mark.parametrize("points", [[(5.0, 5.0)], [(500.0, 5.0)]])
def test_hit_test_keeps_points_without_a_hit(spark, points):
    objects = spark.createDataFrame([(1, 0, square(5, 5, 3), 36.0)], "image_id long, object_index long, corners array<struct<x:double,y:double>>, area double")
    df = spark.createDataFrame([(1, i, x, y) for i, (x, y) in enumerate(points)], "image_id long, point_id long, x double, y double")
    got = review.hit_test(df, objects).collect()
    assert [r.object_index for r in got] == [0 if x < 9 else None for x, _ in points]
