"""Command-line batch job: ``spark-submit imlens/plans/job.py --set train=<dir> --set test=<dir> --out <dir>``.

The session comes from ``spark-submit`` (cluster, resources and ``spark.checkpoint.dir`` are set
there); this script never picks a master. With ``--classify`` the classification step runs on
the written output and its tables are written under ``<out>/evaluation``.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import SparkSession  # noqa: E402

from imlens.operators.classify import save_classifier  # noqa: E402
from imlens.plans import batch  # noqa: E402
from imlens.plans.evaluate import classify_and_evaluate  # noqa: E402
from imlens.sources.sinks import write_parquet  # noqa: E402


def parse(argv: list[str]) -> argparse.Namespace:
    ap = argparse.ArgumentParser(description="image folders -> features -> standardise + PCA -> Parquet")
    ap.add_argument("--set", action="append", required=True, metavar="NAME=DIR", help="data set folder, repeatable")
    ap.add_argument("--out", required=True)
    ap.add_argument("--fit-set", default="train")
    ap.add_argument("--eval-set", default="test", help="set that the classifier predicts")
    ap.add_argument("--threshold", type=float, default=0.9)
    ap.add_argument("--rule", choices=["set", "parent"], default="set")
    ap.add_argument("--glob", default=None)
    ap.add_argument("--size", type=int, default=224)
    ap.add_argument("--batch-size", type=int, default=32)
    ap.add_argument("--partitions", type=int, default=None)
    ap.add_argument("--reuse-features", action="store_true", help="restart without re-scoring a complete features table")
    ap.add_argument("--legacy-format", action="store_true", help="legacy Parquet layout for the reduced output")
    ap.add_argument("--classify", choices=["lr", "rf", "gbt", "hgb"], default=None)
    return ap.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = parse(sys.argv[1:] if argv is None else argv)
    sets = dict(item.split("=", 1) for item in args.set)
    spark = spark or SparkSession.builder.appName("imlens-job").getOrCreate()
    res = batch.run(
        spark,
        sets,
        args.out,
        fit_set=args.fit_set,
        threshold=args.threshold,
        rule=args.rule,
        glob=args.glob,
        size=(args.size, args.size),
        batch_size=args.batch_size,
        partitions=args.partitions,
        reuse_features=args.reuse_features,
        legacy_format=args.legacy_format,
    )
    summary = {"k": res.k, "dim": res.dim, "counts": {f"{s}/{'ok' if ok else 'failed'}": n for (s, ok), n in res.counts.items()}}
    if args.classify:
        base = f"{args.out.rstrip('/')}/evaluation"
        ev = classify_and_evaluate(
            spark, res.paths["reduced"], kind=args.classify, fit_set=args.fit_set, eval_set=args.eval_set, predictions=f"{base}/predictions"
        )
        for name in ("cells", "report", "summary", "confused_with", "ari", "js"):
            write_parquet(ev[name], f"{base}/{name}")
        save_classifier(ev["model"], f"{base}/classifier")
        summary["fit_seconds"] = round(ev["fit_seconds"], 3)
    print(json.dumps(summary))
    return summary


if __name__ == "__main__":
    main()
