"""Greedy non-maximum suppression."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import clip_polygons


def greedy_keep(boxes: np.ndarray, order: np.ndarray, iou: float) -> list[int]:
    """Places of the kept boxes: each in order that overlaps no kept one over iou.

    boxes: n x 4 (x1 y1 x2 y2), or n x 4 x 2 corners. A pass over the rest for each
    kept box; memory is that of the group.
    """
    left, kept = order, []
    bounds = _bounds(boxes)
    while len(left):
        best, left = left[0], left[1:]
        kept.append(int(best))
        near = ((bounds[left, :2] <= bounds[best, 2:]) & (bounds[left, 2:] >= bounds[best, :2])).all(axis=1)
        others = boxes[left[near]]
        over = np.zeros(len(left), bool)
        over[near] = _overlaps(np.broadcast_to(boxes[best], others.shape), others) > iou
        left = left[~over]
    return kept


class Kept:
    """The boxes of a group that are kept so far, for looking up which of them reach others.

    They lie in classes by their width (powers of two), each sorted by the left edge, so
    that one search gives those that may touch a box; what else lies there is passed
    over in pieces of bounded size.
    """

    #: Pairs that are held at once.
    PIECE = 2_000_000

    def __init__(self) -> None:
        self.classes: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # bounds (n x 4) and boxes, by the left edge

    def add(self, boxes: np.ndarray) -> None:
        bounds = _bounds(boxes)
        kind = np.frexp(np.maximum(bounds[:, 2] - bounds[:, 0], 0))[1]
        for k in np.unique(kind).tolist():
            own = kind == k
            old = self.classes.get(k)
            all_bounds, all_boxes = (bounds[own], boxes[own]) if old is None else (np.concatenate([old[0], bounds[own]]), np.concatenate([old[1], boxes[own]]))
            order = np.argsort(all_bounds[:, 0], kind="stable")
            self.classes[k] = all_bounds[order], all_boxes[order]

    def reaches(self, boxes: np.ndarray, iou: float) -> np.ndarray:
        """Which boxes overlap a kept one over iou."""
        bounds = _bounds(boxes)
        hit = np.zeros(len(boxes), bool)
        for k, (kept_bounds, kept) in self.classes.items():
            low = np.searchsorted(kept_bounds[:, 0], bounds[:, 0] - np.ldexp(1.0, k), side="left")
            counts = np.maximum(np.searchsorted(kept_bounds[:, 0], bounds[:, 2], side="right") - low, 0)
            at = 0
            while at < len(boxes):
                # As many boxes as give a piece; one with more than that is a piece by itself.
                end = max(at + 1, int(np.searchsorted(np.cumsum(counts[at:]), self.PIECE, side="right")) + at)
                mine = np.repeat(np.arange(at, end), counts[at:end])
                other = np.arange(len(mine)) + np.repeat(low[at:end] - (np.cumsum(counts[at:end]) - counts[at:end]), counts[at:end])
                near = (kept_bounds[other, 1] <= bounds[mine, 3]) & (kept_bounds[other, 3] >= bounds[mine, 1]) & ~hit[mine]
                mine, other = mine[near], other[near]
                if len(mine):
                    hit[mine[_overlaps(boxes[mine], kept[other]) > iou]] = True
                at = end
        return hit


def _bounds(boxes: np.ndarray) -> np.ndarray:
    """x1 y1 x2 y2 of boxes or polygons."""
    return boxes if boxes.ndim == 2 else np.concatenate([boxes.min(axis=1), boxes.max(axis=1)], axis=1)


def _overlaps(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """IoU of pairs of boxes or polygons."""
    if one.ndim == 2:
        w = np.minimum(one[:, 2], other[:, 2]) - np.maximum(one[:, 0], other[:, 0])
        h = np.minimum(one[:, 3], other[:, 3]) - np.maximum(one[:, 1], other[:, 1])
        shared = np.maximum(w, 0) * np.maximum(h, 0)
        area = lambda b: (b[:, 2] - b[:, 0]) * (b[:, 3] - b[:, 1])
    else:
        shared = clip_polygons(one, other)
        area = lambda p: np.abs((p[:, :, 0] * np.roll(p[:, :, 1], -1, 1) - np.roll(p[:, :, 0], -1, 1) * p[:, :, 1]).sum(axis=1)) / 2
    union = area(one) + area(other) - shared
    return np.where(union > 0, shared / np.where(union > 0, union, 1), 0.0)


def keep_side_by_side(boxes: np.ndarray, place: np.ndarray, size: np.ndarray, iou: float) -> np.ndarray:
    """Which boxes greedy suppression keeps, for many small groups in one pass.

    boxes lie group by group, the best of a group first; place is a box's place in its
    group and size the group's. All pairs that may touch are clipped together; a box is
    settled when all places before its own are.
    """
    counts = size - 1 - place
    mine = np.repeat(np.arange(len(boxes)), counts)
    other = mine + 1 + np.arange(len(mine)) - np.repeat(np.cumsum(counts) - counts, counts)
    bounds = _bounds(boxes)
    near = ((bounds[other, :2] <= bounds[mine, 2:]) & (bounds[other, 2:] >= bounds[mine, :2])).all(axis=1)
    mine, other = mine[near], other[near]
    over = _overlaps(boxes[mine], boxes[other]) > iou
    mine, other = mine[over], other[over]
    kept = np.ones(len(boxes), bool)
    for k in np.unique(place[mine]).tolist():
        at = place[mine] == k
        kept[other[at][kept[mine[at]]]] = False
    return kept


#: Boxes of a group that are compared with each other at once.
BLOCK = 1024
#: Groups of at most so many boxes are taken side by side.
SMALL = 32


def nms(detections: DataFrame, iou: float = 0.45, by: tuple[str, ...] = ("image_id", "class_id"), id_col: str = "det_id", corners_col: str | None = None) -> DataFrame:
    """The `by` columns and ids of the detections that greedy suppression keeps.

    Best score first, then the lowest id. Boxes are the columns x1, y1, x2, y2, or
    polygons if corners_col is given. Groups do not touch each other; they are dealt out
    by a hash and come sorted. The small groups that a batch holds whole are taken side by
    side. Any other group passes by in blocks: those of a block that a kept box reaches
    go, the others are compared with each other, and only what is kept is held. So a
    crowded group takes the memory of its kept boxes, and each box is compared with the
    kept ones near it.
    """
    if corners_col is None:
        numbers = [F.col(c).cast("double").alias(f"_{c}") for c in ("x1", "y1", "x2", "y2")]
    else:
        numbers = [F.col(corners_col)[i][k].alias(f"_{k}{i}") for i in range(4) for k in ("x", "y")]

    def suppress(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before, kept = None, Kept()
        for batch in batches:
            boxes = batch[[c for c in batch.columns if c.startswith("_") and c != "_score"]].to_numpy(float)
            boxes = boxes if corners_col is None else boxes.reshape(-1, 4, 2)
            keys = batch[list(by)] if before is None else pd.concat([before, batch[list(by)]], ignore_index=True)
            group = keys.groupby(list(by), dropna=False, sort=False).ngroup().to_numpy()
            goes_on = before is not None and len(group) > 1 and group[0] == group[1]
            group = group if before is None else group[1:]
            ends = np.append(np.flatnonzero(np.diff(group)) + 1, len(group)) if len(group) else np.array([], int)
            places: list[int] = []
            sizes = np.diff(ends, prepend=0)
            # The first may have begun in an earlier batch, the last may go on in a later one.
            whole = sizes <= SMALL
            whole[-1:] = False
            if goes_on:
                whole[:1] = False
            rows = np.flatnonzero(np.repeat(whole, sizes))
            if len(rows):
                size = sizes[whole]
                each = np.repeat(size, size)
                places += rows[keep_side_by_side(boxes[rows], np.arange(len(rows)) - np.repeat(np.cumsum(size) - size, size), each, iou)].tolist()
            for start, end in zip((ends - sizes)[~whole].tolist(), ends[~whole].tolist(), strict=True):
                if start or not goes_on:
                    kept = Kept()
                last = end == len(group)
                for low in range(start, end, BLOCK):
                    at = np.arange(low, min(low + BLOCK, end))
                    at = at[~kept.reaches(boxes[at], iou)] if kept.classes else at
                    own = at if len(at) < 2 else at[greedy_keep(boxes[at], np.arange(len(at)), iou)]
                    places += own.tolist()
                    if len(own) and (last or low + BLOCK < end):  # more of the group may come
                        kept.add(boxes[own])
            before = batch[list(by)].tail(1) if len(batch) else before
            yield batch.iloc[places][[*by, id_col]]

    types = dict(detections.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in [*by, id_col])
    rows = detections.select(*by, id_col, F.col("score").cast("double").alias("_score"), *numbers)
    dealt = rows.repartition(*by).sortWithinPartitions(*by, F.desc("_score"), id_col)
    return dealt.mapInPandas(suppress, schema)
