"""Longer pieces of DuckDB SQL that the registered queries are held against.

Each continues a WITH clause. They take other ways than the library where there are
some: polygons meet in the points they share, and smallest rectangles are looked for
along all lines through two points.
"""

from __future__ import annotations


def _inside(px: str, py: str, x: str, y: str) -> str:
    """Whether a point lies in a polygon of four corners in ascending order of angle."""
    return f"list_min(list_transform(range(1, 5), lambda k: ({px}[k % 4 + 1] - {px}[k]) * ({y} - {py}[k]) - ({py}[k % 4 + 1] - {py}[k]) * ({x} - {px}[k]))) >= -1e-9"


_RX, _RY, _SX, _SY = "(fx[(t // 4 + 1) % 4 + 1] - fx[t // 4 + 1])", "(fy[(t // 4 + 1) % 4 + 1] - fy[t // 4 + 1])", "(gx[(t % 4 + 1) % 4 + 1] - gx[t % 4 + 1])", "(gy[(t % 4 + 1) % 4 + 1] - gy[t % 4 + 1])"
_DX, _DY = "(gx[t % 4 + 1] - fx[t // 4 + 1])", "(gy[t % 4 + 1] - fy[t // 4 + 1])"

# Edges that run along each other cross nowhere; the corners inside stand for them.
_DEN = f"CASE WHEN abs({_RX} * {_SY} - {_RY} * {_SX}) > 1e-6 THEN {_RX} * {_SY} - {_RY} * {_SX} END"

#: overlap(image_id, first_id, second_id, iou) of the pairs pr(image_id, first_id, second_id, area_a, area_b, fx, fy, gx, gy).
OVERLAPS = f""",
 cr AS (SELECT *, list_filter(list_transform(range(0, 16), lambda t: struct_pack(t := ({_DX} * {_SY} - {_DY} * {_SX}) / ({_DEN}), u := ({_DX} * {_RY} - {_DY} * {_RX}) / ({_DEN}), i := t // 4 + 1)), lambda c: c.t BETWEEN 0 AND 1 AND c.u BETWEEN 0 AND 1) AS cs FROM pr),
 pt AS (SELECT *, list_concat(list_concat(
   list_filter(list_transform(range(1, 5), lambda i: struct_pack(x := fx[i], y := fy[i])), lambda p: {_inside('gx', 'gy', 'p.x', 'p.y')}),
   list_filter(list_transform(range(1, 5), lambda i: struct_pack(x := gx[i], y := gy[i])), lambda p: {_inside('fx', 'fy', 'p.x', 'p.y')})),
   list_transform(cs, lambda c: struct_pack(x := fx[c.i] + c.t * (fx[c.i % 4 + 1] - fx[c.i]), y := fy[c.i] + c.t * (fy[c.i % 4 + 1] - fy[c.i])))) AS q FROM cr),
 ce AS (SELECT *, list_avg(list_transform(q, lambda p: p.x)) AS mx, list_avg(list_transform(q, lambda p: p.y)) AS my FROM pt),
 rd AS (SELECT *, list_sort(list_transform(q, lambda p: struct_pack(a := atan2(p.y - my, p.x - mx), x := p.x, y := p.y))) AS o FROM ce),
 ia AS (SELECT *, coalesce(abs(list_sum(list_transform(range(1, len(o) + 1), lambda i: o[i].x * o[i % len(o) + 1].y - o[i % len(o) + 1].x * o[i].y))) / 2, 0) AS shared FROM rd),
 overlap AS (SELECT image_id, first_id, second_id, shared / (area_a + area_b - shared) AS iou FROM ia)"""

_SIGNS = "list_transform(range(1, 5), lambda k: (o.px[k % 4 + 1] - o.px[k]) * (y - o.py[k]) - (o.py[k % 4 + 1] - o.py[k]) * (x - o.px[k]))"
_HITS = f"list_sort(list_transform(list_filter(range(1, len(objs) + 1), lambda i: [objs[i]].list_transform(lambda o: list_min({_SIGNS}) >= 0 OR list_max({_SIGNS}) <= 0)[1]), lambda i: struct_pack(a := objs[i].a, i := i)))[1].i"
_NEW = "struct_pack(c := c, s := 'manual_obb', f := CAST(1 AS DOUBLE), px := [x - 30, x + 30, x + 30, x - 30], py := [y - 10, y - 10, y + 10, y + 10], a := CAST(1200 AS DOUBLE))"

#: edited(image_id, object_index, class_id, source, confidence, px, py) from edits and start(image_id, place, class_id, source, confidence, px, py).
#: One step for each edit of an image; rows of images saved empty have a null object_index.
REPLAY = f""",
 lg AS (SELECT image_id, action, x, y, coalesce(last_value(CASE WHEN class_id BETWEEN 0 AND 5 THEN class_id END IGNORE NULLS) OVER (PARTITION BY session ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS c, row_number() OVER (PARTITION BY image_id ORDER BY seq) AS n FROM edits),
 bg AS (SELECT e.image_id, coalesce(list(struct_pack(c := class_id, s := source, f := confidence, px := px, py := py, a := round(abs(list_sum(list_transform(range(1, 5), lambda k: px[k] * py[k % 4 + 1] - px[k % 4 + 1] * py[k]))) / 2, 6)) ORDER BY place) FILTER (WHERE class_id IS NOT NULL), []) AS objs
  FROM (SELECT DISTINCT image_id FROM edits) e LEFT JOIN start s ON e.image_id = s.image_id GROUP BY 1),
 bo AS (SELECT image_id, CAST(0 AS BIGINT) AS n, objs, CAST(0 AS BIGINT) AS sel, CASE WHEN false THEN objs END AS saved FROM bg
  UNION ALL SELECT image_id, n,
   CASE WHEN action = 'add' THEN list_append(objs, {_NEW}) WHEN action = 'middle_click' AND hit IS NOT NULL THEN list_concat(objs[1:hit - 1], objs[hit + 1:])
    WHEN action = 'undo' THEN objs[1:len(objs) - 1] WHEN action = 'delete_selected' THEN list_concat(objs[1:sel], objs[sel + 2:]) ELSE objs END,
   CASE WHEN action = 'add' THEN len(objs) WHEN action IN ('left_click', 'right_click') AND hit IS NOT NULL THEN hit - 1 WHEN action = 'middle_click' AND hit IS NOT NULL THEN greatest(0, least(hit - 1, len(objs) - 2))
    WHEN action IN ('undo', 'delete_selected') THEN least(sel, greatest(0, len(objs) - 2)) ELSE sel END,
   CASE WHEN action = 'save' THEN objs ELSE saved END
  FROM (SELECT bo.image_id, lg.n, action, c, x, y, objs, sel, saved, CASE WHEN action LIKE '%click' THEN {_HITS} END AS hit FROM bo JOIN lg ON bo.image_id = lg.image_id AND lg.n = bo.n + 1)),
 ed AS (SELECT image_id, saved FROM bo WHERE saved IS NOT NULL QUALIFY n = max(n) OVER (PARTITION BY image_id)),
 edited AS (SELECT image_id, CAST(i - 1 AS INTEGER) AS object_index, saved[i].c AS class_id, saved[i].s AS source, saved[i].f AS confidence, saved[i].px AS px, saved[i].py AS py FROM ed, range(1, len(saved) + 1) r(i)
  UNION ALL SELECT image_id, NULL, NULL, NULL, NULL, NULL, NULL FROM ed WHERE len(saved) = 0)"""


_NEWER = "struct_pack(c := c, s := {0}, f := {1}, px := px, py := py, a := a)"
_ADDS = "(nw IS NOT NULL AND (act <> 'accept' OR np > 0))"

#: Four clicks that make a box by hand, from box_edits. lg: the log; mm: the mode and its corners after each edit (it depends on no object);
#: ef: the log with what each edit does then; qp: the corners of finished boxes (image_id, det_id, i, x, y), det_id being the edit's place.
HAND_BOXES = """,
 lg AS (SELECT *, coalesce(last_value(CASE WHEN class_id BETWEEN 0 AND 5 THEN class_id END IGNORE NULLS) OVER (PARTITION BY session ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS c, row_number() OVER (PARTITION BY image_id ORDER BY seq) AS n FROM box_edits),
 mm AS (SELECT DISTINCT image_id, CAST(0 AS BIGINT) AS n, false AS open, CAST([] AS STRUCT(x DOUBLE, y DOUBLE)[]) AS pts, CAST(NULL AS STRUCT(x DOUBLE, y DOUBLE)[]) AS quad, false AS was FROM box_edits
  UNION ALL SELECT mm.image_id, lg.n, CASE WHEN action = 'manual' THEN true WHEN action = 'escape' THEN false ELSE open AND (action <> 'left_click' OR len(pts) < 3) END,
   CASE WHEN action IN ('manual', 'escape') OR NOT open THEN [] WHEN action = 'left_click' THEN CASE WHEN len(pts) = 3 THEN [] ELSE list_append(pts, struct_pack(x := x, y := y)) END WHEN action = 'backspace' THEN pts[1:len(pts) - 1] ELSE pts END,
   CASE WHEN open AND action = 'left_click' AND len(pts) = 3 THEN list_append(pts, struct_pack(x := x, y := y)) END, open
  FROM mm JOIN lg ON mm.image_id = lg.image_id AND lg.n = mm.n + 1),
 ef AS (SELECT lg.*, CASE WHEN was AND (action LIKE '%click' OR action = 'accept') THEN CASE WHEN quad IS NULL THEN 'nothing' ELSE 'quad' END WHEN action = 'manual' THEN 'clear' ELSE action END AS act, quad FROM lg JOIN mm ON lg.image_id = mm.image_id AND lg.n = mm.n),
 qp AS (SELECT image_id, n AS det_id, i, quad[i].x AS x, quad[i].y AS y FROM ef, range(1, 5) r(i) WHERE quad IS NOT NULL)"""

#: edited as REPLAY gives it, from ef, from the boxes bl(image_id, n, px, py) of edits and from start. np counts the open prompts.
REPLAY_BOXES = f""",
 ba AS (SELECT *, round(abs(list_sum(list_transform(range(1, 5), lambda k: px[k] * py[k % 4 + 1] - px[k % 4 + 1] * py[k]))) / 2, 6) AS a FROM bl),
 st AS (SELECT ef.image_id, ef.n, act, x, y, c, CASE WHEN act = 'add' AND NOT boxed THEN {_NEW} WHEN px IS NULL THEN NULL WHEN act IN ('add', 'quad') THEN {_NEWER.format("'manual_obb'", 'CAST(1 AS DOUBLE)')} WHEN act = 'accept' THEN {_NEWER.format("'sam2'", 'confidence')} END AS nw FROM ef LEFT JOIN ba ON ef.image_id = ba.image_id AND ef.n = ba.n),
 bg AS (SELECT e.image_id, coalesce(list(struct_pack(c := class_id, s := source, f := confidence, px := px, py := py, a := round(abs(list_sum(list_transform(range(1, 5), lambda k: px[k] * py[k % 4 + 1] - px[k % 4 + 1] * py[k]))) / 2, 6)) ORDER BY place) FILTER (WHERE class_id IS NOT NULL), []) AS objs
  FROM (SELECT DISTINCT image_id FROM ef) e LEFT JOIN start s ON e.image_id = s.image_id GROUP BY 1),
 bo AS (SELECT image_id, CAST(0 AS BIGINT) AS n, objs, CAST(0 AS BIGINT) AS sel, CASE WHEN false THEN objs END AS saved, CAST(0 AS BIGINT) AS np FROM bg
  UNION ALL SELECT image_id, n,
   CASE WHEN {_ADDS} THEN list_append(objs, nw) WHEN act = 'middle_click' AND hit IS NOT NULL THEN list_concat(objs[1:hit - 1], objs[hit + 1:])
    WHEN act = 'undo' THEN objs[1:len(objs) - 1] WHEN act = 'delete_selected' THEN list_concat(objs[1:sel], objs[sel + 2:]) ELSE objs END,
   CASE WHEN {_ADDS} THEN len(objs) WHEN act IN ('left_click', 'right_click') AND hit IS NOT NULL THEN hit - 1 WHEN act = 'middle_click' AND hit IS NOT NULL THEN greatest(0, least(hit - 1, len(objs) - 2))
    WHEN act IN ('undo', 'delete_selected') THEN least(sel, greatest(0, len(objs) - 2)) ELSE sel END,
   CASE WHEN act = 'save' THEN objs ELSE saved END,
   CASE WHEN act = 'clear' OR act = 'accept' AND {_ADDS} THEN 0 WHEN act IN ('left_click', 'right_click') AND hit IS NULL THEN np + 1 ELSE np END
  FROM (SELECT bo.image_id, st.n, act, nw, x, y, objs, sel, saved, np, CASE WHEN act LIKE '%click' THEN {_HITS} END AS hit FROM bo JOIN st ON bo.image_id = st.image_id AND st.n = bo.n + 1)),
{REPLAY[REPLAY.index(' ed AS'):]}"""


def half_even(value: str) -> str:
    """The number with six decimals, halves to even, as written in a label line. Ten decimals tell a half."""
    whole = f"CAST(round(abs({value}) * 1e10) AS BIGINT)"
    return f"sign({value}) * ({whole} // 10000 + CASE WHEN {whole} % 10000 > 5000 OR ({whole} % 10000 = 5000 AND {whole} // 10000 % 2 = 1) THEN 1 ELSE 0 END) / 1e6"


EDITED_CORNERS = ", ".join(f"round(p{k}[{i}], 4) AS {k}{i}" for i in range(1, 5) for k in ("x", "y"))

#: obb(key, area, box): contour area and smallest rectangle of the largest outer contour of the pixels px(key, pos, h, w), pos = y * w + x.
#: Components spread by the greatest number; a component's outside spreads over the pixels that are not its own, from beyond the border.
OUTLINES = """,
 gr AS (SELECT key, h, w, list_transform(range(0, h * w), lambda i: CASE WHEN list_contains(ats, i) THEN i + 1 ELSE 0 END) AS l FROM (SELECT key, h, w, list(pos) AS ats FROM px GROUP BY 1, 2, 3)),
 lb AS (SELECT key, h, w, l, true AS going FROM gr
  UNION ALL SELECT key, h, w, nl, nl <> l FROM (SELECT *, list_transform(range(0, h * w), lambda i: CASE WHEN l[i + 1] = 0 THEN 0 ELSE list_max(list_transform(range(0, 9), lambda k:
   CASE WHEN i % w + k % 3 - 1 BETWEEN 0 AND w - 1 AND i // w + k // 3 - 1 BETWEEN 0 AND h - 1 THEN l[i + (k // 3 - 1) * w + k % 3] ELSE 0 END)) END) AS nl FROM lb WHERE going)),
 cm AS (SELECT key, h, w, c, l FROM (SELECT key, h, w, l, unnest(list_distinct(l)) AS c FROM lb WHERE NOT going) WHERE c > 0),
 og AS (SELECT key, c, h + 2 AS h, w + 2 AS w, list_transform(range(0, (h + 2) * (w + 2)), lambda i: CASE WHEN i % (w + 2) IN (0, w + 1) OR i // (w + 2) IN (0, h + 1) THEN 2 WHEN l[(i // (w + 2) - 1) * w + i % (w + 2)] = c THEN 0 ELSE 1 END) AS o FROM cm),
 ot AS (SELECT key, c, h, w, o, true AS going FROM og
  UNION ALL SELECT key, c, h, w, n, n <> o FROM (SELECT *, list_transform(range(0, h * w), lambda i: CASE WHEN o[i + 1] = 1 AND (o[i] = 2 OR o[i + 2] = 2 OR o[i + 1 - w] = 2 OR o[i + 1 + w] = 2) THEN 2 ELSE o[i + 1] END) AS n FROM ot WHERE going)),
 fi AS (SELECT key, c, h, w, list_transform(o, lambda v: CASE WHEN v = 2 THEN 0 ELSE 1 END) AS f FROM ot WHERE NOT going),
 ca AS (SELECT *, list_sum(list_transform(range(0, h * w - w - 1), lambda i: CASE WHEN i % w = w - 1 THEN 0 WHEN f[i + 1] + f[i + 2] + f[i + 1 + w] + f[i + 2 + w] = 4 THEN 1 WHEN f[i + 1] + f[i + 2] + f[i + 1 + w] + f[i + 2 + w] = 3 THEN 0.5 ELSE 0 END)) AS area,
  list_min(list_transform(range(0, h * w), lambda i: CASE WHEN f[i + 1] = 1 THEN i END)) AS first FROM fi),
 bc AS (SELECT * FROM ca QUALIFY row_number() OVER (PARTITION BY key ORDER BY area DESC, first) = 1),
 pp AS (SELECT key, i // w - 1 AS y, i % w - 1 AS x FROM (SELECT key, w, f, unnest(range(0, h * w)) AS i FROM bc WHERE area >= {min_area}) WHERE f[i + 1] = 1),
 ex AS (SELECT DISTINCT key, y, x FROM (SELECT key, y, unnest([min(x), max(x)]) AS x FROM pp GROUP BY key, y)),
 an AS (SELECT DISTINCT key, CASE WHEN d > 90 - 1e-9 THEN 0 ELSE d END AS angle FROM (SELECT a.key, ((degrees(atan2(b.y - a.y, b.x - a.x)) % 90) + 90) % 90 AS d FROM ex a JOIN ex b ON a.key = b.key AND (a.y, a.x) < (b.y, b.x))),
 rc AS (SELECT key, angle, min(u) AS u0, max(u) AS u1, min(v) AS v0, max(v) AS v1 FROM (SELECT ex.key, angle, x * cos(radians(angle)) + y * sin(radians(angle)) AS u, y * cos(radians(angle)) - x * sin(radians(angle)) AS v FROM ex JOIN an ON ex.key = an.key) GROUP BY 1, 2),
 rb AS (SELECT * FROM rc QUALIFY row_number() OVER (PARTITION BY key ORDER BY round((u1 - u0) * (v1 - v0), 9), angle) = 1),
 obb AS (SELECT rb.key, area, (u1 - u0) * (v1 - v0) AS box, angle, (u0 + u1) / 2 * cos(radians(angle)) - (v0 + v1) / 2 * sin(radians(angle)) AS cx, (u0 + u1) / 2 * sin(radians(angle)) + (v0 + v1) / 2 * cos(radians(angle)) AS cy, u1 - u0 AS w, v1 - v0 AS h
  FROM rb JOIN bc ON rb.key = bc.key WHERE u1 - u0 > 1e-9 AND v1 - v0 > 1e-9)"""
