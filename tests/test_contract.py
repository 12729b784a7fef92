"""The registry, the smallest tables, and checked snapshots."""

import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from roadlens.operators import compare, overlay
from roadlens.operators.quality import QualityError
from roadlens.sources import sinks, tables

SMALL = "/root/testdata/sf0.001"


def test_registry_is_consistent():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 60


def test_entry(spark):
    assert entry.entry(spark).where("time_period = 'overall'").count() == 1


@pytest.mark.parametrize("name", ["scenario_diff", "qvdf_override", "speed_class_stats", "od_remap", "speed_volume_conservation"])
def test_small_queries(spark, name):
    frame = entry.queries()[name](spark, SMALL)
    assert (frame.count() == 0) == (name == "speed_volume_conservation") and len(set(frame.columns)) == len(frame.columns)


def test_snapshot_guard(spark):
    root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    old = spark.range(100).select("id", (F.col("id") * 2).alias("v"), F.lit(1.0).alias("speed"))
    new = old.withColumn("speed", F.lit(2.0))
    sinks.publish_snapshot(new, old, root, ["id"], ["speed"])
    assert sinks.current_snapshot(spark, root).agg(F.sum("speed")).first()[0] == 200.0
    with pytest.raises(QualityError):
        sinks.publish_snapshot(new.withColumn("v", F.col("v") + 1), old, root, ["id"], ["speed"])
    assert sinks.current_snapshot(spark, root).agg(F.sum("v")).first()[0] == 9900


def test_period_layouts(spark):
    root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    import os
    os.makedirs(f"{root}/am")
    for path, text in ((f"{root}/am/link.csv", "a,b\n1,2\n"), (f"{root}/link_am.csv", "a,b\n9,9\n"), (f"{root}/link_md.csv", "a,c\n3,4\n")):
        with open(path, "w") as f:
            f.write(text)
    rows = {(r.time_period, r.a, r.b, r.c) for r in tables.read_period_tables(spark, root, ["AM", "md"], "link.csv").collect()}
    assert rows == {("am", "1", "2", None), ("md", "3", None, "4")}
    with pytest.raises(FileNotFoundError):
        tables.resolve_period_file(spark, root, "pm", "link.csv")


def test_overlay_errors(spark):
    names = ", ".join(f"0.5D AS vdf_{p}" for p in overlay.PARAMETERS)
    links = spark.sql(f"SELECT 'am' AS time_period, 1L AS from_node_id, 2L AS to_node_id, 2 AS vdf_type, 2 AS qvdf_profile_mode, {names}")
    entry_ = spark.sql("SELECT 'am' AS time_period, 1L AS from_node_id, 2L AS to_node_id, " + ", ".join(f"{i}D AS new_{p}" for i, p in enumerate(overlay.PARAMETERS)))
    assert overlay.overlay_parameters(links, entry_).first().changed_cells == 8
    with pytest.raises(Exception, match="pair missing"):
        overlay.overlay_parameters(links.withColumn("to_node_id", F.lit(3).cast("bigint")), entry_).count()
    with pytest.raises(Exception, match="vdf_type"):
        overlay.overlay_parameters(links.withColumn("vdf_type", F.lit(1)), entry_).count()


def test_daily_speed(spark):
    from roadlens.functions.timeofday import periods_from

    perf = spark.createDataFrame([("am", 1, 2, 100.0, 10.0), ("md", 1, 2, 200.0, 20.0), ("md", 5, 6, 1.0, 1.0)],
                                 "time_period STRING, from_node_id BIGINT, to_node_id BIGINT, volume DOUBLE, speed_mph DOUBLE")
    rows = compare.daily_aggregate(perf, periods_from({"am": "0600_0900", "md": "0900_1500"})).collect()
    assert [(r.volume, r.speed) for r in rows] == [(300.0, pytest.approx((10 * 3 + 20 * 6) / 9))]
