"""Row-level joins with a label set: Spark picks the strategy, and a hot label is split where it shuffles."""

from pyspark.sql import functions as F

from imlens.operators import metrics
from imlens.session import session_conf


def _hot(spark):
    # one label holds more than a third of the rows
    rows = spark.range(60_000).select("id", F.when((F.col("id") % 3 == 0) | (F.col("id") % 7 == 0), "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 11)).alias("label"))
    return rows.withColumn("text", F.repeat(F.md5(F.col("id").cast("string")), 4))


def test_weak_rows_build_runs_nothing_and_broadcasts_small_sets(spark):
    weak = spark.createDataFrame([("hot",), ("k1",)], "label string")
    out = metrics.weak_rows(_hot(spark), weak)
    assert len(out.collect()) == _hot(spark).filter("label IN ('hot', 'k1')").count()
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()  # found at run time


def test_a_hot_label_is_split_in_a_shuffle_join(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    with session_conf(spark, settings):
        weak = spark.createDataFrame([("hot",), ("k1",)], "label string")
        out = metrics.weak_rows(_hot(spark).repartition(16), weak)
        assert len(out.collect()) == _hot(spark).filter("label IN ('hot', 'k1')").count()
        plan = out._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
