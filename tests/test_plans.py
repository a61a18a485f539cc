"""Plan-shape checks: pruning, pushdown, one shuffle per metric, no Python outside the scorer."""

import os

import numpy as np
from pyspark.sql import functions as F

from imlens.operators import metrics
from imlens.plans import queries as Q
from png_images import png_bytes

from conftest import SF001


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_prediction_view_never_reads_document_text(spark):
    plan = plan_of(Q.q_class_report(spark, SF001))
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan
    assert "text" not in plan


def test_metrics_shuffle_once_over_rows(spark):
    p = Q.predictions(spark, SF001)
    for df in (metrics.class_stats(p), metrics.confusion_cells(p)):
        plan = plan_of(df)
        assert plan.count("Exchange hashpartitioning") == 1
        assert "partial_" in plan  # map-side combine before the shuffle


def test_sql_only_queries_stay_in_the_jvm(spark):
    for name in ("class_counts", "split_class_balance", "label_from_parent", "path_decode", "uri_parts",
                 "stable_sample", "vector_lengths", "adjusted_rand", "js_distance", "standardize_long"):
        plan = plan_of(Q.QUERIES[name](spark, SF001))
        assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan, name


def test_feature_table_reads_are_pruned(spark, tmp_path):
    root = tmp_path / "images"
    for split in ("train", "test"):
        for i in range(3):
            p = root / split / "A" / f"{i}.png"
            os.makedirs(p.parent, exist_ok=True)
            p.write_bytes(png_bytes(np.full((4, 4), 40 * i, dtype=np.uint8)))
    out = tmp_path / "out"
    from imlens.plans import batch

    batch.run(spark, {"train": str(root / "train"), "test": str(root / "test")}, str(out), size=(8, 8), threshold=1.0)
    t = spark.read.parquet(str(out / "features"))
    q = t.filter((F.col("split") == "train") & F.col("error").isNull()).select("features")
    plan = plan_of(q)
    assert "PartitionFilters: [isnotnull(split" in plan and "(split#" in plan
    assert "IsNull(error)" in plan
    assert "ReadSchema: struct<features:array<float>>" in plan or "ReadSchema: struct<features:array<float>,error:string>" in plan


def test_scorer_runs_once_per_row(spark):
    for df in (Q.q_image_tensor(spark, SF001), Q.q_featurize_batch(spark, SF001)):
        df.write.format("noop").mode("overwrite").save()
        final = plan_of(df).split("== Initial Plan ==")[0]
        assert final.count("ArrowEvalPython") == 1


def test_scratch_folders_can_be_deleted(spark):
    from imlens import session
    from imlens.session import clean_scratch

    assert Q.q_roundtrip_parquet(spark, SF001).count() == 500
    paths = [p for ps in session._SCRATCH.values() for p in ps if "roundtrip" in p]
    assert paths and all(os.path.exists(p.removeprefix("file:")) for p in paths)
    assert clean_scratch(spark) >= 1 and not any(os.path.exists(p.removeprefix("file:")) for p in paths)
