"""Readers and writers on small files."""

from __future__ import annotations

import json
import struct
import time
import zlib

import pytest
from pyspark.sql import functions as F

from boxmill.functions.text import clean_label, format_label_line
from boxmill.jobs import assemble_dataset, label_folder
from boxmill.operators import datasets
from boxmill.sources import files, stores


def png(w, h):
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    pixels = b"".join(b"\0" + b"\x10\x20\x30" * w for _ in range(h))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(pixels)) + chunk(b"IEND", b"")


LINE = "1 0.1 0.1 0.2 0.1 0.2 0.2 0.1 0.2"


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    top = tmp_path_factory.mktemp("set")
    for split, stems in {"train": ["a", "b", "c"], "val": ["a", "d"]}.items():
        (top / "images" / split).mkdir(parents=True)
        (top / "labels" / split).mkdir(parents=True)
        for s in stems:
            (top / "images" / split / f"{s}.png").write_bytes(png(7, 5))
    (top / "images/train/junk.jpg").write_bytes(b"not an image")
    (top / "images/train/B.WEBP").write_bytes(b"RIFF\0\0\0\0WEBPVP8X" + b"\0" * 8 + (8).to_bytes(3, "little") + (3).to_bytes(3, "little"))
    (top / "images/train/notes.txt").write_text("no")
    (top / "labels/train/a.txt").write_text(f"{LINE}\n\n1 2 3\n3.7 0 0 1 0 1 1 0 1\nx 0 0 1 0 1 1 0 1\n1e30 0 0 1 0 1 1 0 1\n\u00a0\u20032 0 0 1 0 1 1 0\u00a01\u3000\n")
    (top / "labels/train/b.txt").write_text("")
    (top / "labels/val/e.txt").write_text(LINE)
    return str(top)


def test_images_are_listed_by_extension(spark, root):
    got = files.list_images(spark, f"{root}/images").collect()
    assert [(r.split, r.stem, r.ext) for r in got] == [("train", "B", "WEBP"), ("train", "a", "png"), ("train", "b", "png"), ("train", "c", "png"), ("train", "junk", "jpg"), ("val", "a", "png"), ("val", "d", "png")]


def test_sizes_come_from_headers_and_junk_is_left_out(spark, root):
    got = {(r.stem, r.height, r.width) for r in files.image_sizes(spark, f"{root}/images").collect()}
    assert got == {("a", 5, 7), ("b", 5, 7), ("c", 5, 7), ("d", 5, 7), ("B", 4, 9)}


def test_header_size_of_other_formats():
    bmp = b"BM" + b"\0" * 16 + struct.pack("<ii", 6, -4)
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08" + struct.pack(">HH", 3, 8) + b"\0" * 8
    assert files.header_size(bmp) == (4, 6) and files.header_size(jpeg) == (3, 8)
    assert files.header_size(None) is None and files.header_size(b"\xff\xd8\xff") is None


def segment(kind, body):
    return b"\xff" + bytes([kind]) + struct.pack(">H", len(body) + 2) + body


def jpeg(h, w, before=b"", end=b"\xff\xd9"):
    return b"\xff\xd8" + before + segment(0xC0, b"\x08" + struct.pack(">HH", h, w) + b"\x03" * 10) + segment(0xDA, b"\0" * 10) + b"\x12" * 50 + end


def exif(orientation, order="<"):
    mark = b"II*\0" if order == "<" else b"MM\0*"
    return segment(0xE1, b"Exif\0\0" + mark + struct.pack(order + "I", 8) + struct.pack(order + "H", 1) + struct.pack(order + "HHIHH", 0x112, 3, 1, orientation, 0) + b"\0" * 4)


def test_sizes_of_long_turned_and_cut_files(spark, tmp_path):
    """Headers of over 1 MB, fill bytes, EXIF turns, and files that end too early."""
    cases = {
        "long": (jpeg(30, 40, segment(0xE2, b"x" * 65_000) * 17), (30, 40)),
        "fill": (jpeg(30, 40, b"\xff\xff\xff" + segment(0xE0, b"JFIF\0")), (30, 40)),
        "turned": (jpeg(30, 40, exif(6)), (40, 30)),
        "turned_be": (jpeg(30, 40, segment(0xE0, b"JFIF\0") + exif(8, ">")), (40, 30)),
        "upside": (jpeg(30, 40, exif(3)), (30, 40)),
        "cut": (jpeg(30, 40)[:-20], None),
        "cut_long": (jpeg(30, 40, segment(0xE2, b"x" * 65_000) * 17)[:900_000], None),
        "none": (b"\xff\xd8\xff\xd9", None),
        "padded": (jpeg(30, 40) + b"\0\0\0", (30, 40)),
    }
    for name, (content, _) in cases.items():
        (tmp_path / f"{name}.jpg").write_bytes(content)
    (tmp_path / "cut_png.png").write_bytes(png(7, 5)[:-20])
    (tmp_path / "empty.png").write_bytes(b"")
    (tmp_path / "cut_bmp.bmp").write_bytes(b"BM" + struct.pack("<I", 500) + b"\0" * 12 + struct.pack("<ii", 6, -4) + b"\0" * 20)
    got = {r.stem: (r.height, r.width) for r in files.image_sizes(spark, str(tmp_path)).collect()}
    assert got == {name: size for name, (_, size) in cases.items() if size}


def test_label_files_of_many_folders(spark, tmp_path):
    """10,000 files in 100 folders of two levels, every third one empty."""
    for i in range(100):
        folder = tmp_path / ("train" if i % 2 else "val") / f"part{i}"
        folder.mkdir(parents=True)
        for k in range(100):
            (folder / f"{i}_{k}.txt").write_text("" if k % 3 == 0 else LINE)
        (folder / "notes.md").write_text("no")
    listed = files.list_label_files(spark, str(tmp_path))
    assert listed.count() == 10_000 and listed.select("stem").distinct().count() == 10_000


def test_a_flat_folder_comes_in_frames(spark, tmp_path):
    """A million names of one folder, of which no more than a frame is held; and 25,000 real ones through Spark."""
    held, most = 0, 0

    def names(folder):
        nonlocal held, most
        for i in range(1_000_000):
            held += 1
            most = max(most, held)
            yield f"{i}.txt", False, 0

    total = 0
    for page in stores.pages_of("/labels", 10_000, names):
        held = 0
        total += page.num_rows
        assert page.num_rows == 10_000
    assert (total, most) == (1_000_000, 10_000)
    for i in range(25_000):
        (tmp_path / f"{i}.txt").touch()
    (tmp_path / "_temporary-x").mkdir()
    (tmp_path / "_temporary-x" / "no.txt").touch()
    assert files.list_label_files(spark, str(tmp_path)).count() == 25_000
    assert files.list_label_files(spark, f"file://{tmp_path}").filter("path like 'file:%'").count() == 25_000
    assert [p.num_rows for p in stores.pages_of(str(tmp_path), 10_000)] == [10_000, 10_000, 5_000]
    assert list(stores.pages_of(str(tmp_path / "_temporary-x"), 1))[0].column("length").to_pylist() == [0]


class Counted:
    """A file in memory that counts what is read of it."""

    def __init__(self, content):
        self.content, self.taken = content, 0

    def read_at(self, count, offset):
        got = self.content[offset : offset + count]
        self.taken += len(got)
        return got


def test_sizes_take_few_bytes():
    big = {
        "png": (png(7, 5)[:-12] + b"\0" * 3_000_000 + png(7, 5)[-12:], (5, 7)),
        "jpeg": (jpeg(30, 40, exif(6) + segment(0xE2, b"x" * 65_000) * 40) + b"", (40, 30)),
        "late": (jpeg(30, 40, segment(0xE2, b"x" * 65_000) * 40 + exif(6)), (40, 30)),
        "bmp": (b"BM" + struct.pack("<I", 2_000_000) + b"\0" * 12 + struct.pack("<ii", 6, -4) + b"\0" * 2_000_000, (4, 6)),
        "webp": (b"RIFF" + struct.pack("<I", 1_000_000) + b"WEBPVP8X" + b"\0" * 8 + (8).to_bytes(3, "little") + (3).to_bytes(3, "little") + b"\0" * 1_000_000, (4, 9)),
        "cut": (jpeg(30, 40, segment(0xE2, b"x" * 65_000) * 40)[:-2], None),
        "other": (b"no image" * 100_000, None),
        "empty": (b"", None),
    }
    for content, size in big.values():
        file = Counted(content)
        assert files.size_of(stores.LazyFile(file, len(content))) == size == files.size_of(content)
        assert file.taken < 100_000


def test_lazy_files_are_like_bytes():
    content = bytes(range(256)) * 20
    lazy = stores.LazyFile(Counted(content), len(content))
    for low, high in ((0, 0), (0, 10), (1000, 1100), (1023, 1025), (-64, None), (5000, 99_999), (6000, 7000), (0, 5120)):
        assert lazy[low:high] == content[low:high]
    assert lazy[1024] == content[1024]
    with pytest.raises(IndexError):
        lazy[len(content)]


def test_labels_of_one_stem_in_two_splits(spark, tmp_path):
    images = spark.createDataFrame([("train", "a"), ("val", "a"), ("val", "none"), (None, "free")], "split string, stem string")
    lines = spark.createDataFrame([("train", "a", 1, "T2"), ("train", "a", 0, "T1"), ("val", "a", 0, "V"), ("test", "a", 0, "of no image"), (None, "free", 0, "F")], "split string, stem string, line_no long, line string")
    files.write_labels(lines, images, str(tmp_path / "labels"), per_file=True)
    found = {str(p.relative_to(tmp_path / "labels")): p.read_text() for p in (tmp_path / "labels").rglob("*") if p.is_file()}
    assert found == {"train/a.txt": "T1\nT2\n", "val/a.txt": "V\n", "val/none.txt": "", "free.txt": "F\n"}
    assert sorted(p.name for p in (tmp_path / "labels").iterdir()) == ["free.txt", "train", "val"]
    # Written again, files are replaced.
    files.write_labels(lines.withColumn("line", F.upper("stem")), images.filter("split = 'val'"), str(tmp_path / "labels"), per_file=True)
    assert (tmp_path / "labels/val/a.txt").read_text() == "A\n" and (tmp_path / "labels/train/a.txt").read_text() == "T1\nT2\n"
    files.write_labels(lines, images, str(tmp_path / "table"))
    assert spark.read.parquet(str(tmp_path / "table")).filter("stem = 'a'").select("split", "content").orderBy("split").collect() == [("train", "T1\nT2"), ("val", "V")]


def test_a_sink_that_fails_leaves_no_file(spark, tmp_path):
    spark.dataSource.register(stores.LabelTexts)

    @F.udf("string")
    def content(k):
        if k == 77:
            raise ValueError("half-way")
        return "x"

    rows = spark.range(100).repartition(4, "id").select(F.lit("train").alias("split"), F.col("id").cast("string").alias("stem"), content("id").alias("content"))
    (tmp_path / "labels").mkdir()
    (tmp_path / "labels/old.txt").write_text("stays")
    with pytest.raises(Exception, match="half-way"):
        rows.write.format("label_texts").mode("append").save(str(tmp_path / "labels"))
    assert [r.stem for r in files.list_label_files(spark, str(tmp_path)).collect()] == ["old"]
    time.sleep(1)  # tasks that were still at work
    assert [p.name for p in (tmp_path / "labels").rglob("*.txt")] == ["old.txt"]
    # Files of an attempt that Spark does not accept stay out as well.
    writer = stores.LabelWriter(str(tmp_path / "labels"))
    first, second = (writer.write(iter([("val", s, "y")])) for s in ("lost", "kept"))
    writer.commit([second, None])
    assert first != second and sorted(p.name for p in (tmp_path / "labels").rglob("*.txt")) == ["kept.txt", "old.txt"]


def test_empty_label_files_are_listed_but_have_no_lines(spark, root):
    listed = {(r.split, r.stem) for r in files.list_label_files(spark, f"{root}/labels").collect()}
    assert listed == {("train", "a"), ("train", "b"), ("val", "e")}
    assert {r.stem for r in files.read_labels(spark, f"{root}/labels").collect()} == {"a", "e"}


def test_lines_are_parsed_dropped_or_rejected(spark, root):
    good, bad = files.parse_label_lines(files.read_labels(spark, f"{root}/labels"))
    assert sorted((r.stem, r.line_no, r.class_id) for r in good.collect()) == [("a", 0, 1), ("a", 3, 3), ("a", 6, 2), ("e", 0, 1)]
    assert sorted((r.stem, r.line_no) for r in bad.collect()) == [("a", 4), ("a", 5)]


def test_labels_round_trip(spark, root, tmp_path):
    good, _ = files.parse_label_lines(files.read_labels(spark, f"{root}/labels").filter("stem = 'a'"))
    lines = good.select("stem", "line_no", format_label_line(F.col("class_id"), F.col("corners")).alias("line"))
    images = spark.createDataFrame([("a",), ("none",)], "stem string")
    files.write_labels(lines, images, str(tmp_path / "labels/train"), per_file=True)
    assert (tmp_path / "labels/train/none.txt").read_text() == ""
    again, _ = files.parse_label_lines(files.read_labels(spark, str(tmp_path / "labels")))
    key = lambda df: [(r.class_id, [(p.x, p.y) for p in r.corners]) for r in df.orderBy("line_no").collect()]
    assert key(again) == key(good)
    files.write_labels(lines, images, str(tmp_path / "table"))
    assert spark.read.parquet(str(tmp_path / "table")).filter("content = ''").count() == 1


def test_half_way_numbers_are_rounded_to_even(spark):
    df = spark.createDataFrame([(2, [(0.0078125, 0.5)] * 4), (None, [(0.0, 0.0)] * 4)], "k long, c array<struct<x:double,y:double>>")
    got = [r[0] for r in df.select(format_label_line(F.col("k"), F.col("c"))).collect()]
    assert got == ["2" + " 0.007812 0.500000" * 4, None]


def test_labels_lose_all_that_strip_takes(spark):
    odd = [" a\t", "\u00a0A b\u3000", "\x1cX\x85", "\u200ba", "", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(odd)], "i int, x string")
    assert [r[0] for r in df.orderBy("i").select(clean_label(F.col("x"))).collect()] == [None if x is None else x.strip().lower() for x in odd]


def test_class_maps(spark, tmp_path):
    (tmp_path / "c.yaml").write_text("path: x\nnames:\n  0: sam\n  2: 'buoy'\nother: 1\n")
    (tmp_path / "d.yaml").write_text("names: [sam, buoy]\n")
    (tmp_path / "e.json").write_text(json.dumps({"names": ["sam", "buoy"]}))
    pairs = lambda s: sorted(tuple(r) for r in files.load_class_map(spark, s).collect())
    assert pairs(str(tmp_path / "c.yaml")) == [(0, "sam"), (2, "buoy")]
    assert pairs(str(tmp_path / "d.yaml")) == pairs(str(tmp_path / "e.json")) == pairs(["sam", "buoy"]) == [(0, "sam"), (1, "buoy")]
    assert pairs({"3": "x"}) == [(3, "x")]
    assert files.resolve_class_names(None, [], {0: "a"}, ["b"]) == {0: "a"}


def test_reports(spark, tmp_path):
    per = spark.createDataFrame([(0, "sam", 0.5, 0.25), (1, "buoy", None, None)], "class_id long, class_name string, ap50 double, ap double")
    overall = spark.createDataFrame([(0.5, 0.4, 0.5, 0.25)], "mp double, mr double, map50 double, map double")
    got = [r.line for r in files.report_rows(per, overall).orderBy("line_no").collect()]
    assert got == ["sam & 0.500 & 0.250", "buoy & -- & --", "mean & 0.500 & 0.250"]
    files.write_metrics_json(overall, str(tmp_path / "m"))
    assert json.loads(spark.read.text(str(tmp_path / "m")).first()[0]) == {"mp": 0.5, "mr": 0.4, "map50": 0.5, "map": 0.25}
    assert files.write_per_class_csv(per, str(tmp_path / "p")) and not files.write_per_class_csv(per.limit(0), str(tmp_path / "q"))
    assert spark.read.option("header", True).csv(str(tmp_path / "p")).count() == 2
    files.write_predictions_json(per, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2


def test_augmented_labels(spark):
    """No change without any reach; a sure flip mirrors; one map for each copy of an image; draws repeat."""
    square = [(0.25, 0.25), (0.5, 0.25), (0.5, 0.5), (0.25, 0.5)]
    df = spark.createDataFrame([(i, k, square) for i in (1, 2) for k in (0, 1)], "image_id long, k long, corners array<struct<x:double,y:double>>")
    still = {"degrees": 0.0, "translate": 0.0, "scale": 0.0, "shear": 0.0}
    points = lambda rows: {(r.image_id, r.k, r.copy): [(round(p.x, 9), round(p.y, 9)) for p in r.corners] for r in rows.collect()}
    same = points(datasets.augment_labels(df, 3, **still, flip=0.0))
    assert len(same) == 12 and all(v == square for v in same.values())
    flipped = points(datasets.augment_labels(df, 1, **still, flip=1.0))
    assert all(v == [(0.5, 0.25), (0.75, 0.25), (0.75, 0.5), (0.5, 0.5)] for v in flipped.values())
    moved = points(datasets.augment_labels(df, 2, seed=3))
    assert moved == points(datasets.augment_labels(df.repartition(3), 2, seed=3))
    assert all(moved[i, 0, c] == moved[i, 1, c] for i in (1, 2) for c in (1, 2)) and moved[1, 0, 1] != moved[1, 0, 2] != moved[2, 0, 2]
    assert all(0 <= v <= 1 for c in moved.values() for p in c for v in p)
    # Boxes pushed out of the image go, and a threshold takes slivers.
    edge = spark.createDataFrame([(i, 0, [(0.0, 0.4), (0.04, 0.4), (0.04, 0.6), (0.0, 0.6)]) for i in range(50)], df.schema)
    rest = datasets.augment_labels(edge, 1, **(still | {"translate": 0.2}), flip=0.0)
    areas = [(max(x for x, _ in c) - min(x for x, _ in c)) * (max(y for _, y in c) - min(y for _, y in c)) for c in points(rest).values()]
    assert 10 < len(areas) < 45 and min(areas) > 1e-9
    assert datasets.augment_labels(edge, 1, **(still | {"translate": 0.2}), flip=0.0, min_area=0.005).count() == sum(a > 0.005 for a in areas) > 5


def test_stem_keys_do_not_depend_on_the_path(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "stem string")
    keys = [r[0] for r in df.select(datasets.stem_key(F.col("stem"), 5)).collect()]
    assert keys[0] == keys[2] != keys[1] and keys != [r[0] for r in df.select(datasets.stem_key(F.col("stem"), 6)).collect()]


def test_training_set_is_written(spark, tmp_path):
    square = [(0.25, 0.25), (0.5, 0.25), (0.5, 0.5), (0.25, 0.5)]
    images = spark.range(40).withColumnRenamed("id", "image_id")
    labels = images.select("image_id", (F.col("image_id") % 3).alias("class_id"), F.lit(0).alias("k")).withColumn("corners", F.from_json(F.lit(json.dumps([{"x": x, "y": y} for x, y in square])), "array<struct<x:double,y:double>>"))
    mapping = spark.createDataFrame([(0, 1), (2, 0)], "class_id long, new_id long")
    made = assemble_dataset.build_training_set({"sim": (images, labels), "real": (images, labels)}, mapping, {"train": 0.5, "test": 0.5}, copies=2)
    made.write(str(tmp_path / "set"))
    found = spark.read.parquet(str(tmp_path / "set" / "labels"))
    splits = {r.image_id: r.split for r in spark.read.parquet(str(tmp_path / "set" / "images")).collect()}
    assert len(splits) == 80 and set(splits.values()) == {"train", "test"}
    rows = found.collect()
    assert {r.class_id for r in rows} == {0, 1} and all(splits[r.image_id] == r.split for r in rows)
    assert all((r.copy == 0) or r.split == "train" for r in rows)
    train = [r for r in rows if r.split == "train"]
    assert len(train) == 3 * len([r for r in train if r.copy == 0])


def upper_half():
    """A model that finds a class by the image's stem: a mask of the upper half."""
    import numpy as np
    import pandas as pd

    from boxmill.functions import masks

    def detect(batch):
        rows = []
        for x in batch.itertuples():
            if x.stem == "a":
                p = np.zeros((x.height, x.width), bool)
                p[: x.height // 2] = True
                rows.append((x.image_id, 1, "yolo26_seg", " Sam", 0.9, {"h": x.height, "w": x.width, "words": masks.pack(p).tolist()}))
        return pd.DataFrame(rows, columns=["image_id", "det_id", "source", "label", "score", "mask"])

    return detect


def whole_image():
    """A prompted model that finds its prompt `buoy` everywhere."""
    import numpy as np
    import pandas as pd

    from boxmill.functions import masks

    def detect(batch):
        rows = [(x.image_id, 7, "sam3", "buoy", 0.8, {"h": x.height, "w": x.width, "words": masks.pack(np.ones((x.height, x.width), bool)).tolist()}) for x in batch.itertuples() if "buoy" in list(x.prompts) and "kite" not in list(x.prompts) and x.stem != "c"]
        return pd.DataFrame(rows, columns=["image_id", "det_id", "source", "label", "score", "mask"])

    return detect


def test_a_folder_is_labeled(spark, root, tmp_path):
    """From image files to label files by split: fused masks, known prompts only, empty texts, nothing for junk."""
    classes = spark.createDataFrame([(0, "sam"), (1, "buoy")], "class_id long, label string")
    prompts = spark.createDataFrame([("buoy",), ("kite",)], "prompt string")
    label_folder.label_folder(spark, f"{root}/images", str(tmp_path / "labels"), classes, segment=upper_half, prompted=whole_image, prompts=prompts, min_area=1)
    got = {str(p.relative_to(tmp_path / "labels")): p.read_text().splitlines() for p in (tmp_path / "labels").rglob("*.txt")}
    full = "1 0.000000 0.000000 0.857143 0.000000 0.857143 0.800000 0.000000 0.800000"
    half = "0 0.000000 0.000000 0.857143 0.000000 0.857143 0.200000 0.000000 0.200000"
    large = "1 0.000000 0.000000 0.888889 0.000000 0.888889 0.750000 0.000000 0.750000"
    assert got == {"train/a.txt": [half, full], "val/a.txt": [half, full], "train/b.txt": [full], "train/B.txt": [large], "train/c.txt": [], "val/d.txt": [full]}


def test_assembled_dataset_reports_what_is_wrong(spark, root):
    classes = spark.createDataFrame([(0, "sam"), (1, "buoy")], "class_id long, label string")
    found = assemble_dataset.assemble(spark, root, classes)
    assert {(r.split, r.stem, r.reason) for r in found.orphans.collect()} >= {("train", "c", "image without label"), ("val", "e", "label without image")}
    assert ("train", "b") not in {(r.split, r.stem) for r in found.orphans.collect()}
    assert [r.stem for r in found.leaks.collect()] == ["a"]
    assert sorted((r.stem, r.class_id) for r in found.invalid.collect()) == [("a", 2), ("a", 3)]
    parts = assemble_dataset.split_by_stem(found.images.drop("split"), {"train": 0.5, "val": 0.5})
    assert parts.groupBy("stem").agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0
