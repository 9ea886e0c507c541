"""Detection tables derived from the star-schema tables, by SQL that Spark and DuckDB share."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = {
    "files": """SELECT concat('images/', split, '/', stem, '.', ext) AS path, stem, ext, split FROM (
  SELECT concat('frame_', CAST(doc_id % 83 AS STRING)) AS stem,
         CASE doc_id % 7 WHEN 0 THEN 'jpg' WHEN 1 THEN 'jpeg' WHEN 2 THEN 'png'
              WHEN 3 THEN 'bmp' WHEN 4 THEN 'webp' WHEN 5 THEN 'JPG' ELSE 'txt' END AS ext,
         CASE WHEN doc_id % 10 < 7 THEN 'train' WHEN doc_id % 10 < 9 THEN 'val' ELSE 'test' END AS split
  FROM {documents}) t""",
    "images": """SELECT o_orderkey AS image_id, 640 + 320 * (o_orderkey % 3) AS width,
       480 + 240 * (o_orderkey % 2) AS height,
       CASE WHEN o_orderkey % 10 < 7 THEN 'train' WHEN o_orderkey % 10 < 9 THEN 'val' ELSE 'test' END AS split,
       CASE o_orderstatus WHEN 'P' THEN 'sim' ELSE 'real' END AS domain
FROM {orders}""",
    "classes": """SELECT CAST(0 AS BIGINT) AS class_id, 'sam' AS label UNION ALL SELECT 1, 'buoy' UNION ALL SELECT 2, 'lolo'
UNION ALL SELECT 3, 'catamaran' UNION ALL SELECT 4, 'boat' UNION ALL SELECT 5, 'person'""",
    "detections": """SELECT image_id, det_id,
       CASE det_id % 3 WHEN 0 THEN 'yolo11_obb' WHEN 1 THEN 'yolo26_seg' ELSE 'sam3' END AS source,
       CASE l_partkey % 7 WHEN 0 THEN 'sam' WHEN 1 THEN ' Buoy' WHEN 2 THEN 'LOLO ' WHEN 3 THEN 'catamaran'
            WHEN 4 THEN 'Boat' WHEN 5 THEN 'person' ELSE 'kite' END AS label,
       CAST((l_partkey * 7919 + l_suppkey * 10473 + l_linenumber * 31) % 1000 AS DOUBLE) / 1000 AS score,
       CAST(20 + l_partkey * 37 % 601 AS DOUBLE) AS cx, CAST(20 + l_suppkey * 53 % 441 AS DOUBLE) AS cy,
       CAST(10 + l_partkey * 13 % 90 AS DOUBLE) AS w, CAST(8 + l_suppkey * 17 % 40 AS DOUBLE) AS h,
       CAST((l_partkey + l_suppkey * 7) % 180 AS DOUBLE) AS deg
FROM (SELECT DISTINCT l_orderkey AS image_id, l_partkey, l_suppkey, l_linenumber,
             l_partkey * 100000 + l_suppkey * 10 + l_linenumber AS det_id FROM {lineitem}) t""",
    "truth": """SELECT image_id, det_id AS gt_id, CAST(det_id % 6 AS BIGINT) AS class_id,
       cx + det_id % 7 - 3 AS cx, cy + det_id % 5 - 2 AS cy, w, h, deg
FROM {detections} WHERE det_id % 4 <> 0""",
    "predictions": """SELECT image_id, det_id AS pred_id, CAST(det_id % 6 AS BIGINT) AS class_id, score, cx, cy, w, h, deg
FROM {detections} WHERE det_id % 5 <> 0""",
    "mask_dets": """SELECT CAST((vec_id - vec_id % 10) / 10 AS BIGINT) AS image_id, vec_id AS det_id,
       CASE vec_id % 2 WHEN 0 THEN 'yolo26_seg' ELSE 'sam3' END AS source,
       CAST(4 + label % 2 AS BIGINT) AS class_id,
       CAST(vec_id * 37 % 100 AS DOUBLE) / 100 AS score, embedding AS pixels
FROM {embeddings}""",
    "candidates": """SELECT image_id, det_id AS mask_idx, w * h * (50 + det_id % 60) / 100 AS area, w, h, score FROM {detections}""",
    "label_lines": """SELECT image_id, det_id AS line_no,
       CASE det_id % 11 WHEN 0 THEN '' WHEN 1 THEN '0 0.5 0.5' WHEN 2 THEN 'x 0.1 0.1 0.2 0.1 0.2 0.2 0.1 0.2' ELSE
       concat(CAST(det_id % 6 AS STRING), CASE det_id % 2 WHEN 0 THEN '.0 ' ELSE '  ' END,
              x1, ' ', y1, ' ', x2, ' ', y1, ' ', x2, ' ', y2, ' ', x1, ' ', y2) END AS line
FROM (SELECT image_id, det_id,
             concat('0.', lpad(CAST(CAST(cx AS BIGINT) % 500 AS STRING), 3, '0')) AS x1,
             concat('0.', lpad(CAST(CAST(cx AS BIGINT) % 500 + CAST(w AS BIGINT) AS STRING), 3, '0')) AS x2,
             concat('0.', lpad(CAST(CAST(cy AS BIGINT) AS STRING), 3, '0')) AS y1,
             concat('0.', lpad(CAST(CAST(cy AS BIGINT) + CAST(h AS BIGINT) AS STRING), 3, '0')) AS y2
      FROM {detections}) t""",
    "edits": """SELECT user_id % 10 AS session, user_id AS image_id, event_id AS seq, ts,
       CASE event_type WHEN 'purchase' THEN 'add' WHEN 'view' THEN 'left_click' WHEN 'click' THEN 'middle_click'
            WHEN 'error' THEN CASE event_id % 2 WHEN 0 THEN 'undo' ELSE 'delete_selected' END ELSE 'save' END AS action,
       CASE WHEN event_id % 4 = 0 THEN event_id % 6 END AS class_id,
       CAST(event_id * 37 % 640 AS DOUBLE) AS x, CAST(event_id * 53 % 480 AS DOUBLE) AS y
FROM {events}""",
    "box_edits": """SELECT user_id % 10 AS session, user_id AS image_id, event_id AS seq, ts,
       CASE event_type WHEN 'purchase' THEN CASE event_id % 6 WHEN 0 THEN 'manual' WHEN 1 THEN 'add' ELSE 'accept' END
            WHEN 'view' THEN CASE event_id % 8 WHEN 7 THEN 'right_click' ELSE 'left_click' END
            WHEN 'click' THEN CASE event_id % 4 WHEN 0 THEN 'middle_click' WHEN 1 THEN 'right_click' ELSE 'left_click' END
            WHEN 'error' THEN CASE event_id % 6 WHEN 0 THEN 'undo' WHEN 1 THEN 'delete_selected' WHEN 2 THEN 'backspace'
                                                WHEN 3 THEN 'escape' WHEN 4 THEN 'clear' ELSE 'manual' END
            ELSE 'save' END AS action,
       CASE WHEN event_id % 4 = 0 THEN event_id % 6 END AS class_id,
       CAST(event_id * 37 % 640 AS DOUBLE) AS x, CAST(event_id * 53 % 480 AS DOUBLE) AS y, event_id % 7 > 0 AS boxed,
       CAST(20 + event_id % 70 AS DOUBLE) AS w, CAST(CASE event_id % 9 WHEN 0 THEN 0 ELSE 10 + event_id % 31 END AS DOUBLE) AS h,
       CAST(event_id % 180 AS DOUBLE) AS deg, CAST(event_id % 100 AS DOUBLE) / 100 AS confidence
FROM {events}""",
}

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table, or a base table of the folder."""
    if name in BASE:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = TABLES[name]
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in set(re.findall(r"\{(\w+)\}", sql))})


def derived(spark: SparkSession, names: tuple[str, ...], **given: DataFrame) -> tuple[DataFrame, ...]:
    """Derived tables over given ones, such as detections that have been written."""
    return tuple(spark.sql(TABLES[n], **given) for n in names)


def with_tables(*names: str) -> str:
    """A WITH clause that derives the tables, and what they need, over base views."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in TABLES and name not in order:
            for needed in re.findall(r"\{(\w+)\}", TABLES[name]):
                add(needed)
            order.append(name)

    for name in names:
        add(name)
    return "WITH " + ", ".join(f"{n} AS ({re.sub(r'[{}]', '', TABLES[n])})" for n in order)
