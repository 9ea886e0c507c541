"""Edit logs and detection files as streams."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.detections import small
from ..operators.review import EDITED, SAVES, Board, board_rows, corners_of, edited_frame, with_boxes

BOARD = "board string"
CHOICE = "class_id long, last_seq long"
LOG = "image_id long, seq long, action string, class_id long, x double, y double, confidence double, box array<double>, ts timestamp"
#: kind 'object' rows are the image's objects at a save; 'empty' says that there are none; 'late' names an edit that came after its turn; 'closed' an image that was idle for too long.
EMITTED = f"kind string, seq long, {EDITED}"


def _emit(rows: list[tuple], kind: str, seq: int) -> pd.DataFrame:
    out = edited_frame(rows)
    out.insert(0, "seq", seq)
    out.insert(0, "kind", kind)
    return out


def _columns(edits: DataFrame, class_id: Column) -> DataFrame:
    """edits (and session, if it is there) with the columns of LOG; a missing ts is null."""
    rows = with_boxes(edits if "ts" in edits.columns else edits.withColumn("ts", F.lit(None)))
    kept = ["session"] if "session" in edits.columns else []
    return rows.select(*kept, "image_id", "seq", "action", class_id.alias("class_id"), *[F.col(c).cast("double").alias(c) for c in ("x", "y", "confidence")], "box", F.col("ts").cast("timestamp").alias("ts"))


def class_in_force_stream(edits: DataFrame, default_class: int = 0, classes: DataFrame | None = None) -> DataFrame:
    """LOG rows with the class last chosen in their session, from a stream of edits.

    Spark takes one such operator a query, so write the rows to a folder, and let
    replay_edits_stream() read that as a stream.

    edits: session, image_id, seq, action, class_id (a choice, or null), x, y, and, where
    there are any, corners, confidence (as in replay_edits()) and ts. A session's state is its class and last seq. Edits are ordered by seq inside a
    trigger, so a trigger's edits of one session must fit a task. classes: as in
    class_in_force().
    """
    if classes is not None:
        known = small(classes.select(F.col("class_id").alias("known")).distinct())
        edits = edits.join(known, F.col("class_id") == F.col("known"), "left").withColumn("class_id", F.col("known"))

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        chosen, _ = state.get if state.exists else (default_class, -1)
        steps = pd.concat(list(batches)).sort_values("seq", kind="stable")
        current = steps["class_id"].astype("Int64").ffill().fillna(chosen)
        state.update((int(current.iloc[-1]), int(steps["seq"].iloc[-1])))
        yield steps.assign(class_id=current)[[c.split()[0] for c in LOG.split(", ")]]

    columns = _columns(edits, F.col("class_id").cast("long"))
    return columns.groupBy("session").applyInPandasWithState(step, LOG, CHOICE, "append", GroupStateTimeout.NoTimeout)


def _per_image(objects: DataFrame, name: str) -> DataFrame:
    """image_id and its objects as a JSON text, in order."""
    rows = F.array_sort(F.collect_list(F.struct("object_index", "class_id", "source", "confidence", "corners")))
    return objects.groupBy("image_id").agg(F.to_json(rows).alias(name))


def _read(text: str | None) -> list[dict] | None:
    if not isinstance(text, str):
        return None
    return [{"class_id": o["class_id"], "source": o["source"], "confidence": o["confidence"], "corners": [[p["x"], p["y"]] for p in o["corners"]]} for o in json.loads(text)]


def replay_edits_stream(
    edits: DataFrame, default_class: int = 0, objects: DataFrame | None = None, proposals: DataFrame | None = None, idle: str | None = None, delay: str = "0 seconds"
) -> DataFrame:
    """Objects of an image after each save, from a stream of its edits.

    edits: image_id, seq, action, class_id (the class in force, as class_in_force_stream()
    gives it; null: default_class), x, y, and, where there are any, corners, confidence
    (or box) and ts. objects, proposals: tables as in replay_edits(), joined with every
    trigger; an image's are read when its first edit comes. Edits are ordered by seq
    inside a trigger; one whose seq is below the last applied one changes nothing and
    comes out as a 'late' row, so nothing is lost silently. The action `close` drops an
    image's board; from then on the image begins with what `objects` says.

    idle: an interval of event time. An image without an edit for so long, as told by
    the watermark (the greatest ts of the stream less `delay`), is closed too: it gives a
    'closed' row, and what was not saved is lost. An edit so old that its image's time
    had run out before it came is 'late'. Without idle, boards stay until `close`.

    Rows: kind, seq, then the objects' columns; a save of no objects gives one 'empty'
    row. Append mode. On logs that come in order the last save of every image is that
    of replay_edits().
    """
    rows = _columns(edits, F.coalesce(F.col("class_id").cast("long"), F.lit(default_class)))
    given = proposals is not None
    for table, name in ((objects, "start"), (proposals, "proposed")):
        rows = rows.withColumn(name, F.lit(None).cast("string")) if table is None else rows.join(_per_image(table, name), "image_id", "left")
    wait = None
    if idle is not None:
        wait = int(edits.sparkSession.sql(f"SELECT unix_millis(timestamp'1970-01-01 00:00:00Z' + INTERVAL '{idle}')").first()[0])
        # Spark drops rows behind the watermark before it calls step(). So each edit comes without a clock, next to a row
        # that has nothing but one: that may be dropped.
        both = F.array(F.struct(F.lit(False).alias("ticks"), F.lit(None).cast("timestamp").alias("clock")), F.struct(F.lit(True).alias("ticks"), F.col("ts").alias("clock")))
        rows = rows.withColumns({"_t": F.explode(both), "ms": F.unix_millis("ts")}).select(*rows.columns, "ms", "_t.ticks", F.col("_t.clock").alias("clock")).withWatermark("clock", delay)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        image_id = int(key[0])
        if state.hasTimedOut:
            yield _emit([(image_id, None, None, None, None, None)], "closed", Board.load(state.get[0]).last_seq)
            state.remove()
            return
        steps = pd.concat(list(batches))
        now = state.getCurrentWatermarkMs() if wait is not None else 0
        if wait is not None:
            steps = steps[~steps["ticks"]]
            if not len(steps):
                if state.exists:
                    _wait_on(state, json.loads(state.get[0])["until"], now)
                return
        steps = steps.sort_values("seq", kind="stable")
        fresh = lambda: Board.of(_read(steps["start"].iloc[0]) or [], (_read(steps["proposed"].iloc[0]) or []) if given else None)
        board = Board.load(state.get[0]) if state.exists else fresh()
        for s in steps.itertuples():
            seq = int(s.seq)
            until = None if wait is None or pd.isna(s.ms) else int(s.ms) + wait
            if seq <= board.last_seq or until is not None and until <= now:
                yield _emit([(image_id, None, None, s.action, None, None)], "late", seq)
                continue
            board.last_seq = seq
            if until is not None:
                board.until = max(board.until, until)
            if s.action == "close":
                board, until = fresh(), board.until
                board.last_seq, board.until = seq, until
                continue
            x, y, confidence = (None if pd.isna(v) else v for v in (s.x, s.y, s.confidence))
            board.apply(s.action, x, y, int(s.class_id), corners_of(s.box), confidence)
            if s.action in SAVES:
                saved = board_rows(image_id, board.saved)
                yield _emit(saved, "object", seq) if saved else _emit([(image_id, None, None, s.action, None, None)], "empty", seq)
        if board.last_seq < 0:  # all were late
            return
        if steps["action"].iloc[-1] == "close" and int(steps["seq"].iloc[-1]) == board.last_seq:
            if state.exists:
                state.remove()
            return
        state.update((board.dump(),))
        if wait is not None:
            _wait_on(state, board.until, now)

    timeout = GroupStateTimeout.NoTimeout if wait is None else GroupStateTimeout.EventTimeTimeout
    return rows.groupBy("image_id").applyInPandasWithState(step, EMITTED, BOARD, "append", timeout)


def _wait_on(state: GroupState, until: int, now: int) -> None:
    """Time out when the watermark has passed `until`; Spark asks for a time after the watermark."""
    state.setTimeoutTimestamp(max(until, now + 1))


def label_stream(detections: DataFrame, job: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Run a batch job on each batch of arriving detection files, each image once.

    An image's rows must come in one file. Results are Parquet under
    path/batch_id=<n>; a batch that is run again overwrites its own folder only.
    """

    def one_batch(rows: DataFrame, batch_id: int) -> None:
        job(rows).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return detections.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
