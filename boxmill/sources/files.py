"""Image files, label files, class tables and result files."""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import parse_label_line
from .stores import LabelTexts, LazyFile, file_system, files_under, is_known, spread

EXTENSIONS = ("jpg", "jpeg", "png", "bmp", "webp")
NAME = r"([^/\\]+)\.([^./\\]+)$"


def path_parts(path: Column) -> dict[str, Column]:
    """stem, ext and split Columns of a path."""
    return {
        "stem": F.regexp_extract(path, NAME, 1),
        "ext": F.regexp_extract(path, NAME, 2),
        "split": F.nullif(F.regexp_extract(path, r"/?(?:images|labels)/(train|val|test)/", 1), F.lit("")),
    }


def images_among(files: DataFrame) -> DataFrame:
    """The rows of files (path, ...) that are images by their extension, in any case, each path once."""
    parts = path_parts(F.col("path"))
    return files.select("path", *[c.alias(n) for n, c in parts.items()]).filter(F.lower("ext").isin(*EXTENSIONS)).dropDuplicates(["path"])


def _files(spark: SparkSession, root: str) -> DataFrame:
    """path of all files under root: listed by tasks, or by Spark's reader (without empty files) in stores that only Spark knows."""
    if is_known(root):
        return files_under(spark, root).select("path")
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")


def list_images(spark: SparkSession, root: str) -> DataFrame:
    """path, stem, ext, split of the image files under root, in order of path. No content is read.

    Names reach the driver in stores that only Spark's readers know, and nowhere else.
    """
    return images_among(_files(spark, root)).orderBy("path")


#: EXIF orientations that turn an image on its side.
SIDEWAYS = (5, 6, 7, 8)
TAIL = 64


def _orientation(exif: bytes) -> int:
    """The orientation tag (0x0112) of a TIFF block, 1 if there is none."""
    order = {b"II": "<", b"MM": ">"}.get(exif[:2])
    if order is None:
        return 1
    try:
        at = struct.unpack(order + "I", exif[4:8])[0]
        for i in range(struct.unpack(order + "H", exif[at : at + 2])[0]):
            tag, kind, _, value = struct.unpack(order + "HHIH", exif[at + 2 + 12 * i : at + 12 + 12 * i])
            if tag == 0x0112 and kind == 3:
                return value
    except struct.error:
        pass
    return 1


def _jpeg_size(b: bytes | LazyFile) -> tuple[int, int] | None:
    """(height, width) as shown: turned if the first EXIF block says so. IndexError if b ends before the frame header.

    Of the segments before the frame header only the beginnings are looked at.
    """
    at, turned = 2, None
    while True:
        if b[at] != 0xFF:
            return None
        while b[at + 1] == 0xFF:  # fill bytes
            at += 1
        kind = b[at + 1]
        if kind == 0x01 or 0xD0 <= kind <= 0xD8:
            at += 2
            continue
        size = b[at + 2] << 8 | b[at + 3]
        if turned is None and kind == 0xE1 and b[at + 4 : at + 10] == b"Exif\0\0":
            turned = _orientation(b[at + 10 : at + 2 + size]) in SIDEWAYS
        if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            h, w = b[at + 5] << 8 | b[at + 6], b[at + 7] << 8 | b[at + 8]
            return (w, h) if turned else (h, w)
        if kind in (0xD9, 0xDA) or size < 2:
            return None
        at += 2 + size


def header_size(content: bytes | LazyFile | None) -> tuple[int, int] | None:
    """(height, width) of a PNG, JPEG, BMP or WebP file, or None."""
    b = content or b""
    try:
        if b[:8] == b"\x89PNG\r\n\x1a\n":
            w, h = struct.unpack(">II", b[16:24])
        elif b[:2] == b"BM":
            w, h = struct.unpack("<ii", b[18:26])
            h = abs(h)
        elif b[:4] == b"RIFF" and b[8:12] == b"WEBP":
            kind = b[12:16]
            if kind == b"VP8X":
                w, h = int.from_bytes(b[24:27], "little") + 1, int.from_bytes(b[27:30], "little") + 1
            elif kind == b"VP8L":
                bits = int.from_bytes(b[21:25], "little")
                w, h = (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
            else:
                w, h = (x & 0x3FFF for x in struct.unpack("<HH", b[26:30]))
        elif b[:2] == b"\xff\xd8":
            h, w = _jpeg_size(b) or (0, 0)
        else:
            return None
    except (struct.error, IndexError):
        return None
    return (h, w) if h > 0 and w > 0 else None


def is_whole(head: bytes, tail: bytes, length: int) -> bool:
    """Whether a file of a known kind is not cut off: its end mark is there, or its stated size is."""
    if head[:4] == b"\x89PNG":
        return b"IEND" in tail
    if head[:2] == b"\xff\xd8":
        return tail.rstrip(b"\0").endswith(b"\xff\xd9")
    if head[:2] == b"BM":
        return int.from_bytes(head[2:6], "little") <= length
    return int.from_bytes(head[4:8], "little") + 8 <= length


def size_of(b: bytes | LazyFile) -> tuple[int, int] | None:
    """(height, width) as shown of a whole image file, None for others and for files that are cut off."""
    n = len(b)
    return header_size(b) if n and is_whole(b[:16], b[max(0, n - TAIL) :], n) else None


def image_sizes(spark: SparkSession, root: str) -> DataFrame:
    """path, stem, height, width as shown (JPEG's EXIF turn applied); unreadable and cut-off files are left out.

    No pixels are decoded: a task opens a file and reads the ranges of bytes that it
    needs, the beginning of each segment before the size, and the end. In stores that
    only Spark's readers know, files are read whole.
    """
    columns = ["path", "height", "width"]

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            found = []
            for i, path in enumerate(paths):
                try:
                    if "content" in batch.schema.names:
                        found.append(size_of(batch.column("content")[i].as_py() or b""))
                    else:
                        system, name = file_system(path)
                        with system.open_input_file(name) as file:
                            found.append(size_of(LazyFile(file, file.size())))
                except OSError:  # gone, or not to be read
                    found.append(None)
            known = [(p, *x) for p, x in zip(paths, found, strict=True) if x]
            yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in known], kind) for i, kind in enumerate((pa.string(), pa.int32(), pa.int32()))], names=columns)

    if is_known(root):
        files = spread(images_among(files_under(spark, root)).select("path"))
    else:
        read = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        files = read.filter(F.lower(F.regexp_extract("path", NAME, 2)).isin(*EXTENSIONS)).select("path", "content")
    sized = files.mapInArrow(sizes, "path string, height int, width int")
    return sized.select("path", F.regexp_extract("path", NAME, 1).alias("stem"), "height", "width")


#: Bytes of label files in a frame, about.
FRAME_BYTES = 4_000_000


def _texts(files: DataFrame) -> DataFrame:
    """path, value: the whole content of files (path), those that are gone left out."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for path in batch.column("path").to_pylist():
                system, name = file_system(path)
                try:
                    with system.open_input_stream(name) as file:
                        rows.append((path, file.read().decode("utf-8", "replace")))
                except FileNotFoundError:
                    continue
                held += len(rows[-1][1])
                if held > FRAME_BYTES:
                    yield frame(rows)
                    rows, held = [], 0
            yield frame(rows)

    def frame(rows: list[tuple[str, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], names=["path", "value"])

    return files.mapInArrow(read, "path string, value string")


def read_labels(spark: SparkSession, root: str) -> DataFrame:
    """path, stem, split, line_no, line of all lines of the .txt files under root; zero-length files have none."""
    if is_known(root):
        text = _texts(spread(files_under(spark, root).filter(F.col("path").endswith(".txt") & (F.col("length") > 0)).select("path")))
    else:
        text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(root, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    lines = text.select("path", F.posexplode(F.split("value", "\n")).alias("line_no", "line"))
    parts = path_parts(F.col("path"))
    return lines.select("path", parts["stem"].alias("stem"), parts["split"].alias("split"), F.col("line_no").cast("long").alias("line_no"), F.regexp_replace("line", "\r$", "").alias("line"))


def list_label_files(spark: SparkSession, root: str) -> DataFrame:
    """path, stem, split of the .txt files under root, empty ones too.

    Spark's readers leave out zero-length files, so tasks list the folders themselves;
    only names of folders reach the driver. A store that only Spark's readers know is an
    error, as its empty files could not be seen.
    """
    if not is_known(root):
        raise ValueError(f"tasks cannot list {root}, and Spark's readers leave out empty files")
    parts = path_parts(F.col("path"))
    return files_under(spark, root).filter(F.col("path").endswith(".txt")).select("path", parts["stem"].alias("stem"), parts["split"].alias("split"))


def parse_label_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(labels, rejects) of rows with a `line`.

    Blank lines and lines without nine tokens are dropped; nine tokens that are not all
    numbers are rejects; the class is truncated to a whole number.
    """
    parsed = lines.withColumn("parsed", parse_label_line(F.col("line")))
    good = parsed.filter("parsed.ok").select(*lines.columns, "parsed.class_id", "parsed.corners")
    return good, parsed.filter("not parsed.ok and not parsed.blank").select(*lines.columns)


def label_texts(labels: DataFrame, images: DataFrame) -> DataFrame:
    """stem, content: the lines of every image in order; empty for images without objects.

    labels: stem, line_no, line. Where images have a split, labels have one too, and a
    text is that of a split and a stem: split, stem, content. Labels of no image are left
    out; a null split is a split of its own.
    """
    key = ["split", "stem"] if "split" in images.columns else ["stem"]
    grouped = labels.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("rows"))
    same = [F.col(f"i.{k}").eqNullSafe(F.col(f"l.{k}")) for k in key]
    joined = images.select(key).distinct().alias("i").join(grouped.alias("l"), same, "left")
    return joined.select(*[F.col(f"i.{k}").alias(k) for k in key], F.coalesce(F.array_join(F.transform("rows", lambda r: r["line"]), "\n"), F.lit("")).alias("content"))


def write_labels(labels: DataFrame, images: DataFrame, path: str, per_file: bool = False) -> None:
    """Label texts as Parquet rows, one folder a split, or as one .txt file per image, path/<split>/<stem>.txt.

    Without splits the rows and files lie in path itself. Files are written by tasks
    under temporary names and appear when all are there; a job that fails leaves none.
    """
    texts = label_texts(labels, images)
    if per_file:
        texts.sparkSession.dataSource.register(LabelTexts)
        split = F.col("split") if "split" in texts.columns else F.lit(None).cast("string")
        texts.select(split.alias("split"), "stem", "content").write.format("label_texts").mode("append").save(path)
    elif "split" in texts.columns:
        texts.write.mode("overwrite").partitionBy("split").parquet(path)
    else:
        texts.write.mode("overwrite").parquet(path)


def load_class_map(spark: SparkSession, source: str | dict | list) -> DataFrame:
    """class_id, label of names given as a list, as a dict of ids, or as a JSON or YAML-like file of either.

    Dict keys become whole numbers; places in a list are ids.
    """
    names = source
    if isinstance(source, str):
        text = "\n".join(r[0] for r in spark.read.text(source).collect())  # a class file is a few lines
        names = _names_in(text)
    pairs = enumerate(names) if isinstance(names, list) else ((int(k), v) for k, v in names.items())
    return spark.createDataFrame([(int(k), str(v)) for k, v in pairs], "class_id long, label string")


def _names_in(text: str) -> dict | list:
    """The names of a JSON file, or of the `names:` block of a simple YAML file."""
    try:
        found = json.loads(text)
        return found["names"] if isinstance(found, dict) and "names" in found else found
    except ValueError:
        pass
    lines = [line.split("#")[0].rstrip() for line in text.splitlines()]
    at = next(i for i, line in enumerate(lines) if line.strip().startswith("names:"))
    inline = lines[at].split(":", 1)[1].strip()
    if inline.startswith("["):
        return [w.strip().strip("'\"") for w in inline.strip("[]").split(",") if w.strip()]
    block = []
    for line in lines[at + 1 :]:
        if line and not line.startswith((" ", "-", "\t")):
            break
        if line.strip():
            block.append(line.strip())
    if all(b.startswith("-") for b in block):
        return [b[1:].strip().strip("'\"") for b in block]
    return {b.split(":", 1)[0].strip(): b.split(":", 1)[1].strip().strip("'\"") for b in block}


def resolve_class_names(*sources: list | dict | None) -> list | dict:
    """The first non-empty list or dict of names."""
    return next((s for s in sources if s), [])


def read_dataset(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(images, label files, label lines) under root/images and root/labels, with their split."""
    return list_images(spark, f"{root}/images"), list_label_files(spark, f"{root}/labels"), read_labels(spark, f"{root}/labels")


def write_metrics_json(metrics: DataFrame, path: str) -> None:
    """The one row of metrics as a JSON object."""
    metrics.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_per_class_csv(per_class: DataFrame, path: str) -> bool:
    """Rows per class with a header; nothing is written when there are none."""
    if per_class.isEmpty():
        return False
    per_class.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return True


def report_rows(per_class: DataFrame, overall: DataFrame) -> DataFrame:
    """line_no, line: `name & AP50 & AP` per class, then the means; missing numbers are `--`.

    overall: one row with map50 and map.
    """
    shown = lambda c: F.when(F.col(c).isNull(), "--").otherwise(F.format_string("%.3f", F.col(c)))
    rows = per_class.select("class_id", F.concat_ws(" & ", "class_name", shown("ap50"), shown("ap")).alias("line"))
    total = overall.select(F.lit(None).cast("long").alias("class_id"), F.concat_ws(" & ", F.lit("mean"), shown("map50"), shown("map")).alias("line"))
    # A row per class: one partition is enough.
    order = Window.orderBy(F.asc_nulls_last("class_id"))
    return rows.unionByName(total).select((F.row_number().over(order) - 1).cast("long").alias("line_no"), "line")


def write_predictions_json(predictions: DataFrame, path: str) -> None:
    """Predictions as JSON lines."""
    predictions.write.mode("overwrite").json(path)
