import os

import numpy as np

from imlens.plans import batch
from png_images import png_bytes
from imlens.streaming import score_new_images


def _png(path, value, shape=(8, 8, 3)):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    rng = np.random.default_rng(int(value))
    with open(path, "wb") as fh:
        fh.write(png_bytes(np.clip(rng.normal(value, 30, size=shape), 0, 255).astype(np.uint8)))


def test_stream_applies_fitted_model(spark, tmp_path):
    root = tmp_path / "images"
    for i in range(6):
        for name, v in (("Kiwi", 40), ("Lime", 200)):
            _png(str(root / "train" / name / f"{i}.png"), v + i)
    out = str(tmp_path / "out")
    res = batch.run(spark, {"train": str(root / "train")}, out, size=(16, 16), glob="*.png")
    model = batch.load_model(out)

    new = root / "new"
    for i in range(3):
        _png(str(new / "Kiwi" / f"n{i}.png"), 50 + i)
    os.makedirs(new / "Lime", exist_ok=True)
    with open(new / "Lime" / "bad.png", "wb") as fh:
        fh.write(b"broken")
    stream_out = str(tmp_path / "stream")
    q = score_new_images(
        spark, model, str(new) + "/*/*", stream_out, str(tmp_path / "ckpt"), size=(16, 16), max_files_per_trigger=2
    )
    q.awaitTermination(240)
    reduced = spark.read.parquet(f"{stream_out}/reduced")
    assert reduced.count() == 3
    assert {r.label for r in reduced.collect()} == {"Kiwi"}
    assert len(reduced.first().pca_features) == res.k
    quarantine = spark.read.parquet(f"{stream_out}/quarantine").collect()
    assert [r.path.rsplit("/", 1)[-1] for r in quarantine] == ["bad.png"]

    # a restarted query only sees files that arrived since
    _png(str(new / "Lime" / "late.png"), 210)
    q = score_new_images(spark, model, str(new) + "/*/*", stream_out, str(tmp_path / "ckpt"), size=(16, 16))
    q.awaitTermination(240)
    assert spark.read.parquet(f"{stream_out}/reduced").count() == 4


def test_replayed_micro_batch_does_not_duplicate(spark, tmp_path):
    from imlens.operators.reduce import Reducer
    from imlens.streaming.score import batch_writer

    rows = [(f"p{i}", "a" if i % 2 else None, [float(i), float(i * i % 7)], None if i != 3 else "boom") for i in range(8)]
    batch = spark.createDataFrame(rows, "path string, label string, features array<float>, error string")
    model = Reducer("features", "pca_features", threshold=0.9).fit(batch.filter("error is null"))
    write = batch_writer(model, str(tmp_path / "s"))
    write(batch, 0)
    write(batch, 0)  # the same micro-batch replayed after a failure
    write(batch, 1)
    reduced = spark.read.parquet(str(tmp_path / "s" / "reduced"))
    assert reduced.count() == 2 * 3  # batches 0 and 1, three labelled good rows each
    assert spark.read.parquet(str(tmp_path / "s" / "quarantine")).filter("batch = 0").count() == 5
