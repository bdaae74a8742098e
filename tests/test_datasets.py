"""Detection datasets as folders."""

import pytest
from pyspark.sql import functions as F

from vistaframe.sources import sfm
from vistaframe.sources.datasets import write_detection_dataset

LABEL = "split string, label_key string, ordinal long, class_id int, xc double, yc double, w double, h double"


def test_labels_images_and_descriptor(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, data in (("a.jpg", b"A" * 3_000_000), ("b.PNG", b"B"), ("none", b"N")):
        (tmp_path / "in" / name).write_bytes(data)
    rows = spark.createDataFrame([("train", "k a", 1, 2, 0.5, 0.25, 0.125, 1.0), ("train", "k a", 0, 0, 0.5, 0.5, 0.5, 0.5), ("val", "b", 0, None, None, None, None, None), ("val", "c", 0, 1, 0.1, 0.1, 0.1, 0.1), ("val", "d.x", 0, 1, 0.1, 0.1, 0.1, 0.1)], LABEL)
    images = spark.createDataFrame([("k a", f"file:{tmp_path}/in/a.jpg"), ("b", f"{tmp_path}/in/b.PNG"), ("d.x", f"{tmp_path}/in/none"), ("other", "/nowhere")], "label_key string, path string")
    out = tmp_path / "out"
    write_detection_dataset(rows, ["chair", "it's: a \"table\"", "#3"], str(out), images)
    files = {str(p.relative_to(out)): p for p in out.rglob("*") if p.is_file() and not p.name.endswith(".crc")}
    assert set(files) == {"data.yaml", "labels/train/k a.txt", "labels/val/b.txt", "labels/val/c.txt", "labels/val/d.x.txt", "images/train/k a.jpg", "images/val/b.PNG", "images/val/d.x"}
    assert files["labels/train/k a.txt"].read_text() == "0 0.500000 0.500000 0.500000 0.500000\n2 0.500000 0.250000 0.125000 1.000000\n"
    assert files["labels/val/b.txt"].read_text() == "" and files["images/train/k a.jpg"].read_bytes() == b"A" * 3_000_000
    assert files["data.yaml"].read_text() == f'path: "{out}"\ntrain: images/train\nval: images/val\nnames:\n  0: "chair"\n  1: "it\'s: a \\"table\\""\n  2: "#3"\nnc: 3\n'
    assert sorted((r["label_key"], r["class_id"]) for r in sfm.read_labels2d(spark, f"{out}/labels").collect()) == [("c", 1), ("d.x", 1), ("k a", 0), ("k a", 2)]
    # A writer that fails leaves the old files; one that ends clears both splits.
    torn = rows.withColumn("xc", F.when(F.col("label_key") == "c", F.raise_error(F.lit("torn")).cast("double")).otherwise(0.5))
    for wrong, broken in (("torn", torn), ("no file can be named", rows.withColumn("label_key", F.lit("a/b")))):
        with pytest.raises(Exception, match=wrong):
            write_detection_dataset(broken, ["x"], str(out))
        assert len([p for p in out.rglob("*") if p.is_file()]) == len(files) and not list(out.glob("_*"))
    write_detection_dataset(rows.where("label_key = 'c'"), [], str(out))
    assert [str(p.relative_to(out)) for p in sorted(out.rglob("*")) if p.is_file()] == ["data.yaml", "labels/val/c.txt"]
    write_detection_dataset(rows.limit(0), ["x"], str(out))
    assert (out / "images" / "train").is_dir() and not list(out.rglob("*.txt"))
