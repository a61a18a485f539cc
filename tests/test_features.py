import os

import numpy as np
import pytest

from imlens.operators.features import featurize, grid_histogram_model, image_tensor, nearest_resize, split_quarantine
from imlens.plans import batch
from png_images import png_bytes


def _fail_on_negative_first():
    def predict(x):
        if (x[:, 0] < 0).any():
            raise ValueError("negative first value")
        return x * 2

    return predict


def test_featurize_isolates_failing_rows(spark):
    rows = [(i, [float(i - 3), 1.0]) for i in range(10)] + [(99, None)]
    df = spark.createDataFrame(rows, "id int, v array<float>")
    scored = featurize(df, "v", _fail_on_negative_first, batch_size=4)
    good, bad = split_quarantine(scored)
    assert sorted(r.id for r in good.collect()) == list(range(3, 10))
    errs = {r.id: r.error for r in bad.collect()}
    assert sorted(errs) == [0, 1, 2, 99]
    assert "negative" in errs[0] and "null input" in errs[99]
    got = {r.id: list(r.features) for r in good.collect()}
    assert got[5] == [4.0, 2.0]


def test_featurize_zero_fallback(spark):
    df = spark.createDataFrame([(0, [-1.0, 1.0]), (1, [1.0, 1.0])], "id int, v array<float>")
    out = featurize(df, "v", _fail_on_negative_first, on_error="zero", zero_dim=2).orderBy("id").collect()
    assert list(out[0].features) == [0.0, 0.0] and out[0].error is not None
    assert list(out[1].features) == [2.0, 2.0] and out[1].error is None


def test_image_tensor_channels_and_resize():
    bgr = np.zeros((2, 2, 3), dtype=np.uint8)
    bgr[..., 0] = 255  # blue in BGR
    t = image_tensor(2, 2, 3, bgr.tobytes(), size=(4, 4))
    assert t.shape == (4, 4, 3)
    assert np.allclose(t[..., 2], 1.0) and np.allclose(t[..., 0], -1.0)  # RGB: blue is last
    grey = image_tensor(1, 1, 1, bytes([255]), size=(2, 2))
    assert grey.shape == (2, 2, 3) and np.allclose(grey, 1.0)
    with pytest.raises(ValueError):
        image_tensor(-1, -1, 0, b"", size=(2, 2))
    a = np.arange(16).reshape(4, 4, 1)
    assert nearest_resize(a, (2, 2))[:, :, 0].tolist() == [[5, 7], [13, 15]]


def test_default_model_is_deterministic():
    x = np.random.default_rng(0).uniform(-1, 1, size=(3, 8, 8, 3)).astype(np.float32)
    f = grid_histogram_model(grid=2, bins=4)()
    out = f(x)
    assert out.shape == (3, 3 * (4 + 4))
    assert np.allclose(out, f(x))
    assert np.allclose(out[:, 12:].reshape(3, 3, 4).sum(axis=2), 1.0)


def _write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(data)


@pytest.fixture()
def image_tree(tmp_path):
    rng = np.random.default_rng(42)
    root = tmp_path / "data" / "images"
    classes = {"Banana": 200, "Apple Braeburn 1": 60, "C+D 50%": 120, "Été": 30}
    for split, n in (("train", 6), ("test", 3)):
        for name, base in classes.items():
            for i in range(n):
                img = np.clip(rng.normal(base, 25, size=(12, 10, 3)), 0, 255).astype(np.uint8)
                _write(str(root / split / name / f"{i} x.png"), png_bytes(img))
    grey = np.full((9, 9), 180, dtype=np.uint8)
    _write(str(root / "train" / "Banana" / "gray.png"), png_bytes(grey))
    _write(str(root / "train" / "Banana" / "broken.png"), b"\x00not an image" * 10)
    _write(str(root / "train" / "Banana" / "readme.txt"), b"notes")
    _write(str(root / "train" / "A" / "B" / "deep.png"), png_bytes(grey))
    _write(str(root / "test" / "Kiwi" / "0.png"), png_bytes(grey))
    return root


def test_batch_job_end_to_end(spark, image_tree, tmp_path):
    out = str(tmp_path / "out")
    sets = {"train": str(image_tree / "train"), "test": str(image_tree / "test")}
    res = batch.run(spark, sets, out, glob="*.png", threshold=0.9, size=(32, 32), batch_size=8)
    assert 1 <= res.k <= res.dim == 3 * (16 + 16)
    feats = spark.read.parquet(res.paths["features"])
    # every png is scored once: 4 classes * 6 + gray + broken + deep (train), 4 * 3 + kiwi (test)
    assert feats.filter("split = 'train'").count() == 27
    assert feats.filter("split = 'test'").count() == 13
    q = {(r.path.rsplit("/", 2)[-2], r.path.rsplit("/", 1)[-1]): r.error for r in spark.read.parquet(res.paths["quarantine"]).collect()}
    assert ("Banana", "broken.png") in q and "undecodable" in q[("Banana", "broken.png")]
    assert ("B", "deep.png") in q  # layout rule gives no label
    reduced = spark.read.parquet(res.paths["reduced"])
    labels = {r.label for r in reduced.filter("split = 'train'").select("label").distinct().collect()}
    assert labels == {"Banana", "Apple Braeburn 1", "C+D 50%", "Été"}
    paths = [r.path for r in reduced.collect()]
    assert any(" x.png" in p for p in paths) and not any("%20" in p for p in paths)
    assert reduced.count() == 25 + 13
    balance = {r.label: (r.train, r.test) for r in spark.read.parquet(res.paths["balance"]).collect()}
    assert balance["Kiwi"] == (0, 1) and balance["Banana"] == (7, 3)
    model = batch.load_model(out)
    assert model.k == res.k


def test_batch_job_refuses_overlapping_output(spark, image_tree):
    with pytest.raises(ValueError, match="overlaps"):
        batch.run(spark, {"train": str(image_tree / "train")}, str(image_tree / "train" / "out"))


def test_broadcast_linear_projection(spark):
    from imlens.operators.models import linear_projection

    w = np.arange(6, dtype=np.float32).reshape(3, 2)
    df = spark.createDataFrame([(0, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 1.0])], "id int, v array<float>")
    out = featurize(df, "v", linear_projection(spark, w, bias=np.array([1.0, 1.0]))).orderBy("id").collect()
    assert [list(r.features) for r in out] == [[1.0, 2.0], [7.0, 9.0]]


def _times(k):
    def make():
        return lambda x: x * k

    return make


def test_each_featurize_call_uses_its_own_model(spark):
    df = spark.createDataFrame([(i, [1.0]) for i in range(16)], "id int, v array<float>").repartition(4)
    for k in (2.0, 3.0, 5.0, 2.0):
        vals = {r.features[0] for r in featurize(df, "v", _times(k)).collect()}
        assert vals == {k}


def _jpeg(spark, path, rgb, size=(6, 5)):
    """Write a JPEG with the JVM's ImageIO (no Python imaging library needed)."""
    jvm = spark._jvm
    w, h = size
    img = jvm.java.awt.image.BufferedImage(w, h, jvm.java.awt.image.BufferedImage.TYPE_INT_RGB)
    value = (rgb[0] << 16) | (rgb[1] << 8) | rgb[2]
    for y in range(h):
        for x in range(w):
            img.setRGB(x, y, value)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    jvm.javax.imageio.ImageIO.write(img, "jpg", jvm.java.io.File(path))


def test_jpeg_and_non_image_files(spark, tmp_path):
    from imlens.sources.files import image_items, scan_images

    root = tmp_path / "images" / "train"
    _jpeg(spark, str(root / "Apple Braeburn 1" / "0 x.jpg"), (200, 40, 10))
    _write(str(root / "Banana" / "readme.txt"), b"notes")
    items = image_items(scan_images(spark, str(root)), rule="set", set_label="train")
    scored = featurize(items, "image", size=(4, 4), make_predict_fn=_flat_model).collect()
    by_name = {r.path.rsplit("/", 1)[-1]: r for r in scored}
    jpg = by_name["0 x.jpg"]
    assert jpg.label == "Apple Braeburn 1" and jpg.error is None
    rgb = np.array(jpg.features).reshape(4, 4, 3)
    assert rgb[..., 0].mean() > 0.3 and rgb[..., 2].mean() < -0.5  # red stays red after BGR -> RGB
    assert by_name["readme.txt"].features is None and "undecodable" in by_name["readme.txt"].error


def _flat_model():
    return lambda x: x.reshape(x.shape[0], -1)


def test_binary_items_use_decoded_path(spark, tmp_path):
    from imlens.sources.files import binary_items, scan_binary

    _write(str(tmp_path / "C+D 50%" / "a b.png"), png_bytes(np.zeros((2, 2), dtype=np.uint8)))
    rows = binary_items(scan_binary(spark, str(tmp_path), glob="*.png")).collect()
    assert [(r.label, r.path.rsplit("/", 1)[-1]) for r in rows] == [("C+D 50%", "a b.png")]


def test_onnx_scorer_runs_broadcast_model(spark):
    pytest.importorskip("onnxruntime")
    from imlens.operators.models import onnx_model
    from onnx_fixture import scale_model

    imgs = spark.createDataFrame(
        [(i, {"origin": f"file:/x/{i}.png", "height": 2, "width": 2, "nChannels": 1, "mode": 0, "data": bytes([255] * 4)}) for i in range(3)],
        "id int, image struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>",
    )
    out = featurize(imgs, "image", onnx_model(spark, scale_model(3.0)), size=(2, 2)).collect()
    assert all(r.error is None and list(r.features) == [3.0] * 12 for r in out)


def test_raw_bytes_are_refused_with_a_hint(spark):
    df = spark.createDataFrame([(b"\x89PNG",)], "content binary")
    with pytest.raises(TypeError, match="scan_images"):
        featurize(df, "content")


def test_a_scorer_too_large_to_broadcast_is_refused(spark, monkeypatch):
    from imlens.operators import models

    monkeypatch.setattr(models, "MAX_BYTES", 10)
    with pytest.raises(ValueError, match="exceed"):
        models.linear_projection(spark, np.eye(4))


def test_memory_errors_fail_the_task(spark):
    """They are the machine's, not the row's: nothing reaches quarantine."""
    df = spark.createDataFrame([(1, [1.0])], "id int, v array<double>")
    with pytest.raises(Exception, match="MemoryError"):
        featurize(df, "v", _out_of_memory).collect()


def _out_of_memory():
    def predict(x):
        raise MemoryError("MemoryError of this test")

    return predict
