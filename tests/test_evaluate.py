import os

import numpy as np
import pytest

from imlens.plans import batch
from imlens.sources.files import scan_images
from imlens.plans.evaluate import classify_and_evaluate, explore, weak_class_points
from png_images import png_bytes


@pytest.fixture()
def colour_tree(tmp_path):
    rng = np.random.default_rng(5)
    root = tmp_path / "images"
    colours = {"Red": (220, 30, 30), "Green": (30, 200, 40), "Blue": (20, 40, 210)}
    for split, n in (("train", 8), ("test", 4)):
        for name, rgb in colours.items():
            for i in range(n):
                img = np.clip(np.array(rgb) + rng.normal(0, 20, size=(10, 10, 3)), 0, 255).astype(np.uint8)
                path = root / split / name / f"{i}.png"
                os.makedirs(path.parent, exist_ok=True)
                path.write_bytes(png_bytes(img))
    return root


def test_explore_counts_without_pixels(spark, colour_tree):
    res = explore(spark, str(colour_tree / "train"), glob="*.png")
    s = res["summary"].first()
    assert (s.n_rows, s.n_labels) == (24, 3)
    assert {r.label: r["count"] for r in res["counts"].collect()} == {"Red": 8, "Green": 8, "Blue": 8}
    plan = res["items"]._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1].split("\n")[0]
    sample = explore(spark, str(colour_tree / "train"), glob="*.png", fraction=0.5)
    assert 0 < sample["summary"].first().n_rows < 24


def test_classify_and_evaluate_job_output(spark, colour_tree, tmp_path):
    out = str(tmp_path / "out")
    batch.run(spark, {"train": str(colour_tree / "train"), "test": str(colour_tree / "test")}, out, size=(16, 16), glob="*.png")
    res = classify_and_evaluate(spark, f"{out}/reduced", kind="lr")
    acc = res["summary"].filter("label = 'accuracy'").first().precision
    assert acc == pytest.approx(1.0)
    assert res["ari"].first().ari == pytest.approx(1.0)
    assert res["js"].first().js_distance == pytest.approx(0.0, abs=1e-12)
    assert res["js_train_labels"].first().js_distance == pytest.approx(0.0, abs=1e-12)
    assert {r.label: (r.train, r.test) for r in res["balance"].collect()} == {
        "Red": (8, 4), "Green": (8, 4), "Blue": (8, 4)
    }
    assert res["weak"].count() == 0
    pts = weak_class_points(spark.read.parquet(f"{out}/reduced"), res["predictions"], res["report"].select("label"))
    assert pts.count() == 12 and set(pts.columns) >= {"x", "y"}


def test_command_line_job(spark, colour_tree, tmp_path):
    from imlens.plans.job import main

    out = str(tmp_path / "job")
    summary = main(
        ["--set", f"train={colour_tree / 'train'}", "--set", f"test={colour_tree / 'test'}", "--out", out,
         "--glob", "*.png", "--size", "16", "--classify", "lr", "--legacy-format"],
        spark,
    )
    assert summary["counts"] == {"train/ok": 24, "test/ok": 12}
    rep = spark.read.parquet(f"{out}/evaluation/summary").filter("label = 'accuracy'").first()
    assert rep.precision == pytest.approx(1.0)


def test_trial_paths_are_stable_and_bounded(spark, colour_tree):
    a, b = (batch.trial_paths(spark, str(colour_tree / "train"), glob="*.png", fraction=0.8, cap=10) for _ in range(2))
    assert a == b and len(a) == 10 and scan_images(spark, a).count() == 10


def test_sets_of_any_name(spark, colour_tree, tmp_path):
    out = str(tmp_path / "names")
    batch.run(spark, {"fit": str(colour_tree / "train"), "hold": str(colour_tree / "test")}, out, fit_set="fit", size=(8, 8), glob="*.png", rule="parent")
    assert {(r.label, r.train, r.test, r.eval_set) for r in spark.read.parquet(f"{out}/balance").collect()} == {(c, 8, 4, "hold") for c in ("Red", "Green", "Blue")}
    res = classify_and_evaluate(spark, f"{out}/reduced", kind="lr", fit_set="fit", eval_set="hold")
    assert res["predictions"].count() == 12


def test_the_evaluation_scores_once(spark, colour_tree, tmp_path):
    out = str(tmp_path / "once")
    batch.run(spark, {"train": str(colour_tree / "train"), "test": str(colour_tree / "test")}, out, size=(8, 8), glob="*.png")
    res = classify_and_evaluate(spark, f"{out}/reduced", kind="lr", predictions=f"{out}/p")
    for name in ("report", "summary", "ari", "js", "js_train_labels", "report_train_labels", "summary_train_labels", "confused_with"):
        plan = res[name]._jdf.queryExecution().executedPlan().toString()
        assert "reduced" not in plan or "train" in name, name
        assert "_imlens_pred_idx" not in plan, name


def test_many_failures_stop_the_job(spark, colour_tree, tmp_path):
    (colour_tree / "train" / "Red" / "broken.png").write_bytes(b"no image")
    with pytest.raises(ValueError, match="1 of 25 images failed"):
        batch.run(spark, {"train": str(colour_tree / "train")}, str(tmp_path / "f"), size=(8, 8), glob="*.png", max_failed_share=0.01)
    res = batch.run(spark, {"train": str(colour_tree / "train")}, str(tmp_path / "g"), size=(8, 8), glob="*.png", max_failed_share=0.1)
    assert res.counts["train", False] == 1


def _never_called():
    raise AssertionError("scorer must not be built when features are reused")


def test_job_restart_reuses_written_features(spark, colour_tree, tmp_path):
    out = str(tmp_path / "restart")
    sets = {"train": str(colour_tree / "train")}
    first = batch.run(spark, sets, out, size=(8, 8), glob="*.png")
    again = batch.run(spark, sets, out, size=(8, 8), glob="*.png", make_predict_fn=_never_called, scorer_id="default", reuse_features=True)
    assert again.k == first.k and again.counts == first.counts
    for odd in ({"size": (9, 9)}, {"scorer_id": "other"}, {"rule": "parent"}):
        with pytest.raises(ValueError, match="other settings"):
            batch.run(spark, sets, out, glob="*.png", reuse_features=True, **{"size": (8, 8), **odd})
    with pytest.raises(ValueError, match="sets"):
        batch.run(spark, sets | {"test": str(colour_tree / "test")}, out, size=(8, 8), glob="*.png", reuse_features=True)


def test_evaluate_from_separate_folders(spark, colour_tree, tmp_path):
    out = str(tmp_path / "sep")
    batch.run(spark, {"train": str(colour_tree / "train"), "test": str(colour_tree / "test")}, out, size=(8, 8), glob="*.png")
    res = classify_and_evaluate(
        spark, {"train": f"{out}/reduced/split=train", "test": f"{out}/reduced/split=test"}, kind="lr"
    )
    assert res["predictions"].count() == 12
    per = {r.split: (r.n_rows, r.n_labels) for r in res["classes_per_split"].collect()}
    assert per == {"train": (24, 3), "test": (12, 3)}
    assert res["summary"].filter("label = 'accuracy'").first().precision == pytest.approx(1.0)
