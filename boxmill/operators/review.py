"""Review of labels: starting objects, hit tests, best masks, proposals and edit logs."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import atan2, cos, degrees, fmod, radians, sin

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import FLAT, candidate_score, min_area_rect, order_corners, point_in_obb, point_in_rect, polygon_area, rect_corners
from .detections import shape_filter, small

NO_AREA = 1e9


def initial_objects(images: DataFrame, label_files: DataFrame, labels: DataFrame, proposals: DataFrame) -> DataFrame:
    """Labels of images that have a label file, even an empty one; proposals of the others."""
    known = label_files.select("image_id").distinct()
    from_files = labels.join(images.select("image_id"), "image_id", "left_semi").join(known, "image_id", "left_semi")
    proposed = proposals.join(images.select("image_id"), "image_id", "left_semi").join(known, "image_id", "left_anti")
    return from_files.unionByName(proposed, allowMissingColumns=True)


def smallest_hit(hits: DataFrame) -> DataFrame:
    """One row per point: the object of the least area, then of the lowest index."""
    order = Window.partitionBy("image_id", "point_id").orderBy(F.coalesce("area", F.lit(NO_AREA)), "object_index")
    return hits.withColumn("rank", F.row_number().over(order)).filter("rank = 1").drop("rank")


def holding(points: DataFrame, objects: DataFrame) -> DataFrame:
    """Pairs of points and the objects of their image that hold them.

    objects: image_id, object_index, area and the rectangle cx, cy, w, h, deg; or, where
    there is none, corners (ordered). Points on an edge count; only a rectangle tells
    them exactly.
    """
    shape = ["cx", "cy", "w", "h", "deg"]
    if set(shape) <= set(objects.columns):
        inside = point_in_rect(F.col("x"), F.col("y"), *map(F.col, shape))
    else:
        shape, inside = ["corners"], point_in_obb(F.col("x"), F.col("y"), F.col("corners"))
    return points.join(objects.select("image_id", "object_index", "area", *shape), "image_id").filter(inside)


def hit_test(points: DataFrame, objects: DataFrame) -> DataFrame:
    """points with the object_index of the smallest box that holds them, or null.

    points: image_id, point_id, x, y; objects: see holding().
    """
    hits = holding(points, objects).select("image_id", "point_id", "object_index", "area")
    return points.join(smallest_hit(hits).drop("area"), ["image_id", "point_id"], "left")


def best_mask(candidates: DataFrame) -> DataFrame:
    """Per request the candidate of the highest score, the first on ties."""
    order = Window.partitionBy("image_id", "request_id").orderBy(F.desc_nulls_last("score"), "mask_idx")
    return candidates.withColumn("rank", F.row_number().over(order)).filter("rank = 1").drop("rank")


def proposal_quality_filter(candidates: DataFrame, min_iou: float = 0.8, min_stability: float = 0.92) -> DataFrame:
    """Proposals whose predicted overlap and stability are high enough."""
    return candidates.filter((F.col("predicted_iou") >= min_iou) & (F.col("stability") >= min_stability))


def largest_candidates(candidates: DataFrame, k: int = 120) -> DataFrame:
    """Per image the k largest masks with their place; ties in model order. The mask itself need not be there."""
    order = Window.partitionBy("image_id").orderBy(F.desc("area"), "mask_idx")
    return candidates.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def best_proposal(candidates: DataFrame, k: int = 120, min_area: float = 1500.0, **shape) -> DataFrame:
    """At most one object per image: the best-scored of the k largest candidates with a fitting box.

    candidates: image_id, mask_idx, area (pixels), obb_area, w, h, aspect,
    rectangularity. class 0, source sam2_amg, confidence the score; the earlier place
    wins ties. min_area holds for the box's area and is 1 at least.
    """
    large = largest_candidates(candidates, k).filter(F.col("obb_area") >= max(1.0, min_area))
    scored = shape_filter(large, **shape).withColumn("confidence", candidate_score(F.col("obb_area"), F.col("aspect"), F.col("rectangularity")))
    order = Window.partitionBy("image_id").orderBy(F.desc("confidence"), "place")
    best = scored.withColumn("rank", F.row_number().over(order)).filter("rank = 1").drop("rank", "place")
    return best.withColumns({"class_id": F.lit(0).cast("long"), "source": F.lit("sam2_amg")})


def latest_labels(revisions: DataFrame) -> DataFrame:
    """All rows of each stem's last revision."""
    newest = F.max("revision").over(Window.partitionBy("stem"))
    return revisions.withColumn("newest", newest).filter("revision = newest").drop("newest")


def class_in_force(edits: DataFrame, default: int = 0, span: int = 10_000, classes: DataFrame | None = None) -> DataFrame:
    """edits with the class last chosen in their session, or the default.

    classes: a class table; choices that it lacks count as none. A session may hold any
    share of the log, so it is cut into spans of seq: the last choice of each span is
    carried to the later ones, and windows run inside a span.
    """
    if classes is not None:
        known = small(classes.select(F.col("class_id").alias("class_id"), F.lit(True).alias("known")).distinct())
        edits = edits.join(known, "class_id", "left").withColumn("class_id", F.when(F.col("known"), F.col("class_id"))).select(edits.columns)
    spanned = edits.withColumn("span", F.floor(F.col("seq") / span))
    last = spanned.groupBy("session", "span").agg(F.max_by("class_id", F.when(F.col("class_id").isNotNull(), F.col("seq"))).alias("chosen"))
    earlier = Window.partitionBy("session").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("session", "span", F.last("chosen", ignorenulls=True).over(earlier).alias("carried"))
    inside = Window.partitionBy("session", "span").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    current = F.coalesce(F.last("class_id", ignorenulls=True).over(inside), "carried", F.lit(default))
    return spanned.join(carried, ["session", "span"]).withColumn("current_class", current).drop("span", "carried")


# ---- replay of one image's edits ------------------------------------------------------

EDITED = "image_id long, object_index int, class_id long, source string, confidence double, corners array<struct<x:double,y:double>>"
ADD_W, ADD_H = 60.0, 20.0


def _inside(x: float, y: float, corners: list[list[float]]) -> bool:
    signs = [(bx - ax) * (y - ay) - (by - ay) * (x - ax) for (ax, ay), (bx, by) in zip(corners, corners[1:] + corners[:1], strict=True)]
    return all(s >= 0 for s in signs) or all(s <= 0 for s in signs)


def _area(corners: list[list[float]]) -> float:
    """Shoelace area; rounded, so that equal boxes tie whatever their corners' last digits."""
    return round(abs(sum(ax * by - bx * ay for (ax, ay), (bx, by) in zip(corners, corners[1:] + corners[:1], strict=True))) / 2, 6)


def box_of_four(points: list[list[float]]) -> list[list[float]] | None:
    """Ordered corners of the smallest rectangle round four clicked points; None if it is flat."""
    angles = set()
    for i, (ax, ay) in enumerate(points):
        for bx, by in points[i + 1 :]:
            if ax != bx or ay != by:
                turn = fmod(fmod(degrees(atan2(by - ay, bx - ax)), 90) + 90, 90)
                angles.add(0.0 if turn > 90 - FLAT else turn)
    fits = []
    for angle in angles:
        c, s = cos(radians(angle)), sin(radians(angle))
        u, v = [x * c + y * s for x, y in points], [y * c - x * s for x, y in points]
        fits.append((round((max(u) - min(u)) * (max(v) - min(v)), 6), angle, min(u), max(u), min(v), max(v), c, s))
    if not fits:
        return None
    _, _, u0, u1, v0, v1, c, s = min(fits)
    if not (u1 - u0 > FLAT and v1 - v0 > FLAT):
        return None
    # From the ends themselves and not from middle and size: clicks may come again on these very points.
    corners = [[a * c - b * s, a * s + b * c] for a, b in ((u0, v0), (u1, v0), (u1, v1), (u0, v1))]
    mx, my = sum(p[0] for p in corners) / 4, sum(p[1] for p in corners) / 4
    corners.sort(key=lambda p: atan2(p[1] - my, p[0] - mx))
    first = min(range(4), key=lambda i: round(corners[i][0] + corners[i][1], 9))
    return corners[first:] + corners[:first]


SAVES = ("save", "next", "previous")
CLICKS = ("left_click", "right_click", "middle_click")


@dataclass
class Board:
    """Objects of one image under edit; saved holds them as of the last save, or None.

    start: the objects at the beginning, those of the label file or the proposals.
    proposals: what `reset` puts in. prompts: open clicks for the prompted model, each x,
    y and 1 (part of the object) or 0. quad: the corners clicked so far while a box is
    made by hand, None at other times. until: the event time, in milliseconds, up to
    which a stream keeps the board.
    """

    objects: list[dict] = field(default_factory=list)
    selected: int = 0
    saved: list[dict] | None = None
    start: list[dict] = field(default_factory=list)
    proposals: list[dict] = field(default_factory=list)
    last_seq: int = -1
    prompts: list[list[float]] = field(default_factory=list)
    quad: list[list[float]] | None = None
    until: int = 0

    @classmethod
    def of(cls, start: list[dict], proposals: list[dict] | None = None) -> Board:
        """A board at the beginning; without proposals of its own, the start objects are them."""
        return cls(objects=[dict(o) for o in start], start=start, proposals=start if proposals is None else proposals)

    def hit(self, x: float, y: float) -> int | None:
        """The smallest object that holds the point, the first on ties."""
        found = [(_area(o["corners"]), i) for i, o in enumerate(self.objects) if _inside(x, y, o["corners"])]
        return min(found)[1] if found else None

    def _clamp(self) -> None:
        self.selected = min(self.selected, max(0, len(self.objects) - 1))

    def _add(self, corners: list[list[float]] | None, class_id: int, source: str, confidence: float) -> bool:
        """A new object, selected; nothing without a box."""
        if corners is None:
            return False
        self.objects.append({"class_id": class_id, "source": source, "confidence": confidence, "corners": corners})
        self.selected = len(self.objects) - 1
        return True

    def _click(self, action: str, x: float, y: float, class_id: int) -> None:
        if self.quad is not None:
            # Four left clicks make a box by hand; other clicks count for nothing meanwhile.
            if action == "left_click":
                self.quad.append([x, y])
            if len(self.quad) == 4:
                self._add(box_of_four(self.quad), class_id, "manual_obb", 1.0)
                self.quad = None
            return
        at = self.hit(x, y)
        if action == "middle_click":
            if at is not None:
                del self.objects[at]
                self.selected = max(0, min(at, len(self.objects) - 1))
        elif at is not None:
            self.selected = at
        else:
            self.prompts.append([x, y, 1 if action == "left_click" else 0])

    def _begin(self, objects: list[dict]) -> None:
        self.objects, self.selected, self.prompts, self.quad = [dict(o) for o in objects], 0, [], None

    def apply(self, action: str, x: float | None, y: float | None, class_id: int, corners: list[list[float]] | None = None, confidence: float | None = None) -> None:
        """One edit. Unknown actions change nothing; so do clicks without a place.

        add: a box with these corners; without corners an upright one of fixed size round
        (x, y), if they are given. accept: the box of the mask that the open prompts gave,
        with its confidence; without prompts, without a box or while a box is made by
        hand nothing happens, and the prompts stay. manual begins a box by hand, which
        backspace takes a corner from and escape ends; clear drops the prompts.
        """
        if action in CLICKS:
            if x is not None and y is not None:
                self._click(action, x, y, class_id)
        elif action == "add":
            if corners is None and x is not None and y is not None:
                corners = [[x - ADD_W / 2, y - ADD_H / 2], [x + ADD_W / 2, y - ADD_H / 2], [x + ADD_W / 2, y + ADD_H / 2], [x - ADD_W / 2, y + ADD_H / 2]]
            self._add(corners, class_id, "manual_obb", 1.0)
        elif action == "accept":
            if self.quad is None and self.prompts and self._add(corners, class_id, "sam2", 1.0 if confidence is None else confidence):
                self.prompts = []
        elif action == "manual":
            self.quad, self.prompts = [], []
        elif action == "backspace":
            if self.quad:
                self.quad.pop()
        elif action == "escape":
            self.quad = None
        elif action == "clear":
            self.prompts = []
        elif action == "delete_selected":
            if self.objects:
                del self.objects[self.selected]
            self._clamp()
        elif action == "undo":
            if self.objects:
                self.objects.pop()
            self._clamp()
        elif action == "reset":
            self._begin(self.proposals)
        elif action in SAVES:
            self.saved = [dict(o) for o in self.objects]
        elif action in ("load", "close"):
            # The label file as last written; before the first save, what the image began with.
            self._begin(self.start if self.saved is None else [dict(o, source="file", confidence=1.0, corners=[[round(a, 6), round(b, 6)] for a, b in o["corners"]]) for o in self.saved])

    def dump(self) -> str:
        return json.dumps(self.__dict__)

    @classmethod
    def load(cls, text: str) -> Board:
        return cls(**json.loads(text))


def board_rows(image_id: int, objects: list[dict] | None) -> list[tuple]:
    """EDITED rows of a list of objects."""
    return [(image_id, i, o["class_id"], o["source"], o["confidence"], [{"x": a, "y": b} for a, b in o["corners"]]) for i, o in enumerate(objects or [])]


def edited_frame(rows: list[tuple]) -> pd.DataFrame:
    """A pandas frame of board_rows()."""
    frame = pd.DataFrame(rows, columns=["image_id", "object_index", "class_id", "source", "confidence", "corners"])
    return frame.astype({"object_index": "Int32", "class_id": "Int64", "confidence": "Float64"})


# Phases of an image's rows in a replay.
START, PROPOSAL, EDIT = 0, 1, 2
STEPS = ("image_id", "phase", "place", "action", "class_id", "x", "y", "confidence", "corners")


def _numbers(corners: Column) -> Column:
    """Corners as eight numbers."""
    return F.flatten(F.transform(corners, lambda p: F.array(p["x"], p["y"])))


def _objects(rows: DataFrame, phase: int) -> DataFrame:
    """Objects as rows of STEPS; corners as eight numbers."""
    none = F.lit(None).cast("double")
    return rows.select("image_id", F.lit(phase).alias("phase"), F.col("object_index").cast("long").alias("place"), F.col("source").alias("action"), "class_id", none.alias("x"), none.alias("y"), "confidence", _numbers(F.col("corners")).alias("corners"))


def with_boxes(edits: DataFrame) -> DataFrame:
    """edits with x, y, confidence and box (eight numbers, or null) of what each adds.

    corners, if edits has them, are those of the accepted mask's box, or four points of
    a box to add, of which the smallest rectangle is taken. Flat ones are no box, and
    adding one adds nothing.
    """
    if "box" in edits.columns:
        return edits
    none, x, y = F.lit(None), F.col("x").cast("double"), F.col("y").cast("double")
    confidence = F.col("confidence") if "confidence" in edits.columns else none
    if "corners" not in edits.columns:
        return edits.withColumns({"x": x, "y": y, "confidence": confidence.cast("double"), "box": none.cast("array<double>")})
    given = edits.withColumns({"confidence": confidence.cast("double"), "_rect": F.when(F.size("corners") == 4, min_area_rect(F.col("corners")))})
    round_it = rect_corners(*[F.col(f"_rect.{c}") for c in ("cx", "cy", "w", "h", "angle")])
    # What fills its rectangle is one, and keeps its own corners to the last digit.
    fills = polygon_area(F.col("corners")) >= F.col("_rect.w") * F.col("_rect.h") * (1 - 1e-12)
    box = F.when(F.col("_rect").isNotNull(), F.when((F.col("action") == "add") & ~fills, round_it).otherwise(order_corners(F.col("corners"))))
    flat = (F.col("action") == "add") & F.col("corners").isNotNull()  # never the box of fixed size
    return given.withColumns({"x": F.when(~flat, x), "y": F.when(~flat, y), "box": _numbers(box)}).drop("_rect", "corners")


def corners_of(box: np.ndarray | list | None) -> list[list[float]] | None:
    """Eight numbers as corners."""
    return None if box is None or isinstance(box, float) else np.asarray(box, float).reshape(-1, 2).tolist()


def replay_edits(objects: DataFrame, edits: DataFrame, default_class: int = 0, proposals: DataFrame | None = None, classes: DataFrame | None = None, empty: bool = False) -> DataFrame:
    """Objects of each edited image as of its last save; images that were never saved have no rows.

    objects: EDITED columns, the state at the start. proposals: EDITED columns, what
    `reset` puts in; None: the start objects. classes: the scheme that a choice of class
    must be in. edits: session, image_id, seq, action, class_id (a choice of class, or
    null), x, y, and, where there are any, corners and confidence of what an edit adds
    (see with_boxes() and Board.apply()); the order is that of seq. empty: images that were saved without objects
    get one row with a null object_index.

    Rows are dealt out by image and come sorted, so a task holds one board at a time and
    no image's log.
    """
    log = with_boxes(class_in_force(edits, default_class, classes=classes)).select(
        "image_id",
        F.lit(EDIT).alias("phase"),
        F.col("seq").cast("long").alias("place"),
        "action",
        F.col("current_class").cast("long").alias("class_id"),
        F.col("x").cast("double").alias("x"),
        F.col("y").cast("double").alias("y"),
        "confidence",
        F.col("box").alias("corners"),
    )
    steps = _objects(objects, START).unionByName(log)
    if proposals is not None:
        steps = steps.unionByName(_objects(proposals, PROPOSAL))
    given = proposals is not None

    def replay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        image: int | None = None
        start: list[dict] = []
        proposed: list[dict] = []
        board: Board | None = None
        done: list[tuple] = []

        def finish() -> None:
            if board is not None and board.saved is not None:
                done.extend(board_rows(image, board.saved))
                if empty and not board.saved:
                    done.append((image, None, None, None, None, None))

        for batch in batches:
            for image_id, phase, _, action, class_id, x, y, confidence, corners in zip(*(batch[c].tolist() for c in STEPS), strict=True):
                if image_id != image:
                    finish()
                    image, start, proposed, board = image_id, [], [], None
                if phase == EDIT:
                    board = board or Board.of(start, proposed if given else None)
                    x, y, confidence = (None if v is None or v != v else v for v in (x, y, confidence))
                    board.apply(action, x, y, int(class_id), corners_of(corners), confidence)
                else:
                    box = corners_of(corners)
                    (start if phase == START else proposed).append({"class_id": int(class_id), "source": action, "confidence": float(confidence), "corners": box})
            yield edited_frame(done)
            done.clear()
        finish()
        yield edited_frame(done)

    dealt = steps.select(*STEPS).filter("image_id is not null").repartition("image_id").sortWithinPartitions("image_id", "phase", "place")
    return dealt.mapInPandas(replay, EDITED)
