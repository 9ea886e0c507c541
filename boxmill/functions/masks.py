"""Binary masks as packed words, and their way to oriented boxes.

A mask is struct<h:int,w:int,words:array<bigint>>: 64 row-major pixels a word, lowest
bit first, padding bits 0.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

MASK = "struct<h:int,w:int,words:array<bigint>>"
OBB = "struct<cx:double,cy:double,w:double,h:double,angle:double,area:double,aspect:double,rectangularity:double>"


def _bits(words: Column) -> Column:
    return F.aggregate(F.transform(words, lambda x: F.bit_count(x).cast("long")), F.lit(0).cast("long"), lambda s, n: s + n)


def mask_area(mask: Column) -> Column:
    """Number of set pixels."""
    return _bits(mask["words"])


def mask_iou(a: Column, b: Column) -> Column:
    """Intersection over union of two masks; 0 if both are empty, null for different sizes (resize them first)."""
    shared = _bits(F.zip_with(a["words"], b["words"], lambda x, y: x.bitwiseAND(y)))
    either = _bits(F.zip_with(a["words"], b["words"], lambda x, y: x.bitwiseOR(y)))
    alike = (a["h"] == b["h"]) & (a["w"] == b["w"])
    return F.when(alike, F.when(either == 0, 0.0).otherwise(F.try_divide(shared, either)))


def mask_union(a: Column, b: Column) -> Column:
    """Pixels set in either of two masks of one size."""
    words = F.zip_with(a["words"], b["words"], lambda x, y: x.bitwiseOR(y))
    return F.struct(a["h"].alias("h"), a["w"].alias("w"), words.alias("words"))


def union_all(masks: Column) -> Column:
    """Pixels set in any mask of an array of masks of one size; null for no mask."""
    rest = F.slice(masks, 2, F.greatest(F.size(masks) - 1, F.lit(0)))
    return F.aggregate(rest, F.get(masks, F.lit(0)), mask_union)


def pack(pixels: np.ndarray) -> np.ndarray:
    """Words of a 2-D array of booleans."""
    bits = np.packbits(pixels.ravel(), bitorder="little")
    return np.frombuffer(bits.tobytes() + b"\0" * (-len(bits) % 8), "<i8")


def unpack(mask: dict) -> np.ndarray:
    """The 2-D array of a mask; missing words are empty pixels."""
    h, w = mask["h"] or 0, mask["w"] or 0
    raw = np.asarray(mask["words"] if mask["words"] is not None else [], "<i8").tobytes()
    bits = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")[: h * w]
    return np.concatenate([bits, np.zeros(h * w - len(bits), np.uint8)]).reshape(h, w).astype(bool)


def pack_rows(pixels: np.ndarray) -> np.ndarray:
    """Words of many masks of one size: rows of booleans to rows of words."""
    bits = np.packbits(pixels, axis=1, bitorder="little")
    return np.ascontiguousarray(np.pad(bits, ((0, 0), (0, -bits.shape[1] % 8)))).view("<i8")


def unpack_rows(words: list[np.ndarray], size: int) -> np.ndarray:
    """Rows of `size` booleans of masks of one size; missing words are empty pixels."""
    n = -(-size // 64)
    full = np.zeros((len(words), n), "<i8")
    for row, given in zip(full, words, strict=True):
        row[: min(n, len(given))] = given[:n]
    return np.unpackbits(full.view(np.uint8), axis=1, bitorder="little")[:, :size].astype(bool)


def _by_size(*sizes: pd.Series) -> dict[tuple[int, ...], np.ndarray]:
    """Places of the rows of every combination of sizes; rows with a missing one are in none."""
    frame = pd.concat([s.reset_index(drop=True) for s in sizes], axis=1).dropna()
    if not len(frame):
        return {}
    return {tuple(map(int, key)): at.to_numpy() for key, at in frame.groupby(list(frame.columns), sort=False).groups.items()}


def _masks(n: int, made: dict[tuple[int, ...], tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
    """n masks: size to (places, rows of words); places that are in none are missing masks."""
    h, w = np.zeros(n, np.int64), np.zeros(n, np.int64)
    words: list[np.ndarray | None] = [None] * n
    for size, (at, rows) in made.items():
        h[at], w[at] = size[-2:]
        for i, row in zip(at, rows, strict=True):
            words[i] = row
    missing = np.array([x is None for x in words], bool)
    return pd.DataFrame({"h": pd.Series(h, dtype="Int32").mask(missing), "w": pd.Series(w, dtype="Int32").mask(missing), "words": pd.Series(words, dtype=object)})


#: Tiles of a mask along each side.
TILES = 8


def tile_counts(mask: Column) -> Column:
    """array<int>: the set pixels of each of TILES x TILES parts of a mask.

    A part holds whole words, those whose first pixel lies in the tile, so masks of one
    size are cut alike and only words are counted. Null for a null mask.
    """

    @F.pandas_udf("array<int>")
    def counts(masks: pd.DataFrame) -> pd.Series:
        out: list[np.ndarray | None] = []
        for h, w, words in zip(masks["h"], masks["w"], masks["words"], strict=True):
            if words is None or pd.isna(h) or pd.isna(w):
                out.append(None)
                continue
            pixel = np.arange(len(words)) * 64
            tile = pixel // max(w, 1) * TILES // max(h, 1) * TILES + pixel % max(w, 1) * TILES // max(w, 1)
            bits = np.bitwise_count(np.asarray(words, np.int64).view(np.uint64))
            out.append(np.bincount(np.minimum(tile, TILES * TILES - 1).astype(np.int64), weights=bits, minlength=TILES * TILES).astype(np.int32))
        return pd.Series(out, index=masks.index, dtype=object)

    return counts(mask)


def shared_at_most(tiles_a: Column, tiles_b: Column) -> Column:
    """A bound of the pixels that two masks of one size share, from their tile counts."""
    return F.aggregate(F.zip_with(tiles_a, tiles_b, lambda x, y: F.least(x, y).cast("long")), F.lit(0).cast("long"), lambda s, n: s + n)


def binarize_mask(values: Column, h: Column, w: Column, threshold: float = 0.5) -> Column:
    """A mask of the values (row-major array) over a threshold; null or NaN values are empty pixels."""

    @F.pandas_udf(MASK)
    def binarize(rows: pd.Series, height: pd.Series, width: pd.Series) -> pd.DataFrame:
        rows, made = rows.reset_index(drop=True), {}
        given = rows.notna().to_numpy()
        for (h, w), at in _by_size(height.rename("h"), width.rename("w")).items():
            at = at[given[at]]
            full = np.zeros((len(at), h * w), bool)
            for k, i in enumerate(at):
                values = np.asarray(rows[i], float)[: h * w]
                np.greater(values, threshold, out=full[k, : len(values)])
            made[h, w] = at, pack_rows(full)
        return _masks(len(rows), made)

    return binarize(values, h.cast("int"), w.cast("int"))


def resize_mask(mask: Column, h: Column, w: Column) -> Column:
    """The mask at another size: pixel (y, x) is the old one at floor(y * old h / h), floor(x * old w / w)."""

    @F.pandas_udf(MASK)
    def resize(masks: pd.DataFrame, height: pd.Series, width: pd.Series) -> pd.DataFrame:
        masks, made = masks.reset_index(drop=True), {}
        given = masks["words"].notna().to_numpy()
        for (old_h, old_w, new_h, new_w), at in _by_size(masks["h"], masks["w"], height.rename("new_h"), width.rename("new_w")).items():
            at = at[given[at]]
            new = np.zeros((len(at), new_h * new_w), bool)
            if old_h and old_w and new_h and new_w:
                old = unpack_rows([masks["words"][i] for i in at], old_h * old_w)
                rows, columns = np.arange(new_h) * old_h // new_h, np.arange(new_w) * old_w // new_w
                new = old[:, (rows[:, None] * old_w + columns[None, :]).ravel()]
            made[old_h, old_w, new_h, new_w] = at, pack_rows(new)
        return _masks(len(masks), made)

    return resize(mask, h.cast("int"), w.cast("int"))


def fit_mask(mask: Column, h: Column, w: Column) -> Column:
    """The mask at the size h x w; one that has it already stays in the JVM."""
    fits = (mask["h"] == h) & (mask["w"] == w)
    return F.when(fits, mask).otherwise(resize_mask(F.when(~fits, mask), h, w))


def label_components(pixels: np.ndarray, diagonal: bool) -> tuple[np.ndarray, int]:
    """Component number of every set pixel (0: not set), numbered by their first pixel in row order.

    Runs of neighbouring rows that touch are found by search, and joined by union-find,
    so the time is that of the runs.
    """
    h, w = pixels.shape
    edges = np.diff(np.pad(pixels.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    rows, starts = np.nonzero(edges == 1)
    ends = np.nonzero(edges == -1)[1]
    n = len(rows)
    if not n:
        return np.zeros((h, w), np.int64), 0
    # In one number, runs are in row order: a run touches those of the row above that end after its start and start before its end.
    reach, wide = (1 if diagonal else 0), w + 2
    above = (rows - 1) * wide
    low = np.searchsorted(rows * wide + ends, above + starts - reach, side="right")
    high = np.searchsorted(rows * wide + starts, above + ends + reach, side="left")
    touched = np.maximum(high - low, 0)
    below = np.repeat(np.arange(n), touched)
    upper = np.repeat(low - (np.cumsum(touched) - touched), touched) + np.arange(len(below))
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(below.tolist(), upper.tolist(), strict=True):
        a, b = find(x), find(y)
        if a != b:
            parent[max(a, b)] = min(a, b)
    roots = np.array([find(x) for x in range(n)])
    numbers = np.cumsum(roots == np.arange(n))[roots]  # a root is its component's first run
    out = np.zeros(h * w, np.int64)
    sizes = ends - starts
    at = np.repeat(rows * w + starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    out[at] = np.repeat(numbers, sizes)
    return out.reshape(h, w), int(numbers.max())


def outer_areas(labels: np.ndarray, n: int) -> np.ndarray:
    """For components without holes, 1 to n, the areas of the polygons through their boundary pixels' centres.

    A square of four pixels counts one if all are set and a half if three are; set
    pixels of a square are of one component.
    """
    cells = np.stack([labels[:-1, :-1], labels[1:, :-1], labels[:-1, 1:], labels[1:, 1:]])
    inside = (cells > 0).sum(axis=0)
    whole = inside >= 3
    return np.bincount(cells.max(axis=0)[whole], weights=np.where(inside[whole] == 4, 1.0, 0.5), minlength=n + 1)[1:]


def hull(points: np.ndarray) -> np.ndarray:
    """Convex hull of integer points by monotone chains."""
    points = points[np.lexsort((points[:, 1], points[:, 0]))]
    if len(points) < 3:
        return points

    def chain(order: np.ndarray) -> list:
        out: list = []
        for p in order.tolist():
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out[:-1]

    return np.array(chain(points) + chain(points[::-1]), float)


def smallest_rectangle(points: np.ndarray) -> tuple[float, float, float, float, float] | None:
    """(cx, cy, w, h, angle in [0, 90)) along one of the hull's edges; None if flat."""
    if len(points) < 3:
        return None
    side = np.roll(points, -1, axis=0) - points
    angle = np.degrees(np.arctan2(side[:, 1], side[:, 0])) % 90
    angle = np.unique(np.where(angle > 90 - 1e-9, 0.0, angle))
    c, s = np.cos(np.radians(angle))[:, None], np.sin(np.radians(angle))[:, None]
    u, v = points[:, 0] * c + points[:, 1] * s, points[:, 1] * c - points[:, 0] * s
    w, h = np.ptp(u, axis=1), np.ptp(v, axis=1)
    k = int(np.argmin(np.round(w * h, 9)))
    if w[k] <= 1e-9 or h[k] <= 1e-9:
        return None
    mu, mv = (u[k].min() + u[k].max()) / 2, (v[k].min() + v[k].max()) / 2
    return float(mu * c[k, 0] - mv * s[k, 0]), float(mu * s[k, 0] + mv * c[k, 0]), float(w[k]), float(h[k]), float(angle[k])


def obb_of(pixels: np.ndarray, min_area: float) -> tuple | None:
    """An OBB row of the component of the largest contour area; ties go to the topmost, then leftmost."""
    if not pixels.any():
        return None
    # A component inside a hole of another has the smaller contour, so holes are filled with all that is in them, for all
    # components at once: what the outside does not reach.
    padded = np.pad(pixels, 1)
    outside, _ = label_components(~padded, diagonal=False)
    labels, n = label_components((outside != outside[0, 0])[1:-1, 1:-1], diagonal=True)
    areas = outer_areas(labels, n)
    best_area = float(areas.max())
    if best_area < min_area:
        return None
    best = labels == int(areas.argmax()) + 1
    ys = np.flatnonzero(best.any(axis=1))
    left, right = best[ys].argmax(axis=1), best.shape[1] - 1 - best[ys][:, ::-1].argmax(axis=1)
    rect = smallest_rectangle(hull(np.unique(np.concatenate([np.column_stack([left, ys]), np.column_stack([right, ys])]), axis=0)))
    if rect is None:
        return None
    w, h = rect[2], rect[3]
    return (*rect, best_area, max(w, h) / (min(w, h) + 1e-6), best_area / (w * h + 1e-6))


def mask_to_obb(mask: Column, min_area: float = 20.0) -> Column:
    """The oriented box of a mask's largest outer contour, with area and shape.

    Null for a null or empty mask, a contour area under min_area, or a flat one. The
    contour runs through pixel centres, so a filled a x b block has (a-1)(b-1).
    """

    @F.pandas_udf(OBB)
    def boxes(masks: pd.DataFrame) -> pd.DataFrame:
        out = []
        for m in masks.to_dict("records"):
            missing = pd.isna(m["h"]) or pd.isna(m["w"]) or m["words"] is None
            m = None if missing else {"h": int(m["h"]), "w": int(m["w"]), "words": m["words"]}
            found = obb_of(unpack(m), min_area) if m and m["h"] and m["w"] else None
            out.append(found or (None,) * 8)
        return pd.DataFrame(out, columns=["cx", "cy", "w", "h", "angle", "area", "aspect", "rectangularity"], dtype="float64")

    return let_null(boxes(mask))


def let_null(obb: Column) -> Column:
    """Null instead of a struct of nulls."""
    return F.when(obb["w"].isNotNull(), obb)
