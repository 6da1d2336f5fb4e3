"""Rows meet their group's statistics where they are read: no shuffle by a few hot keys."""

from pyspark.sql import functions as F

from opsanalytics.operators import diagnostics as dg
from opsanalytics.operators import summaries as sm


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(spark):
    # Wide rows, so that the size Spark expects of the statistics is no reason to broadcast them.
    return spark.range(20_000).select(
        F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 3)).alias("g"), (F.col("id") % 401).cast("double").alias("v"))


def _without_auto_broadcast(spark, build):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = build()
        return _plan(df), df.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_histogram_rows_stay_where_they_are_read(spark):
    plan, rows = _without_auto_broadcast(spark, lambda: sm.histogram(_rows(spark), "v", 40, by=["g"]))
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert sum(r["n"] for r in rows) == 20_000 and sum(r["n"] for r in rows if r["g"] == "hot") == 16_000


def test_box_stats_rows_stay_where_they_are_read(spark):
    q = sm.join_groups(_rows(spark), _rows(spark).groupBy("g").agg(F.max("v").alias("m")), ["g"])
    plan, rows = _without_auto_broadcast(spark, lambda: q.agg(F.max(F.col("m") - F.col("v")).alias("d")))
    assert "SortMergeJoin" not in plan and rows[0]["d"] == 400.0


def test_many_groups_meet_their_rows_in_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(sm, "FEW_GROUPS", 3)
    plan, rows = _without_auto_broadcast(spark, lambda: sm.histogram(_rows(spark), "v", 40, by=["g"]))
    assert "SortMergeJoin" in plan and sum(r["n"] for r in rows) == 20_000


def test_kernel_density_and_zscore_rows_stay_where_they_are_read(spark):
    plan, rows = _without_auto_broadcast(spark, lambda: dg.binned_kde(_rows(spark), "v", by=["g"], grid=8))
    assert "SortMergeJoin" not in plan and len(rows) == 4 * 8
    plan, rows = _without_auto_broadcast(spark, lambda: dg.group_zscore(_rows(spark), ["g"], "v"))
    assert "SortMergeJoin" not in plan and len(rows) == 20_000
