"""Storage of raw tables and of intermediate results."""

import os
from types import SimpleNamespace

import pytest

from ledgerlane.functions.durable import drop_durable, durable, shared_folder
from ledgerlane.plans.ride import RideModels
from ledgerlane.sources.ride_projection import ProjectedRideTables
from ledgerlane.sources.tables import RIDE_KEYS, RIDE_SCHEMAS, load_tables, save_bucketed_tables


def test_trip_fact_over_bucketed_tables_needs_no_shuffle(spark, data, tmp_path):
    projected = ProjectedRideTables(spark, data)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS bucketed LOCATION '{tmp_path}/bucketed'")
    save_bucketed_tables(projected, RIDE_SCHEMAS, RIDE_KEYS, "bucketed", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = RideModels(load_tables(spark, RIDE_SCHEMAS, "bucketed"))
        plan = stored.int_trips_enriched._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    from_files = RideModels(projected).mart_reconciliation.collect()
    assert stored.mart_reconciliation.collect() == from_files


def test_durable_tables_go_to_the_folder_the_session_names(spark):
    folder = shared_folder(spark)
    written = durable(spark.range(5), "numbers")
    assert written.count() == 5
    assert f"{folder}/ledgerlane/" in written.inputFiles()[0]


def session_with(settings, checkpoint_dir=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)),
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: checkpoint_dir),
    )


@pytest.mark.parametrize("master", ["yarn", "local[2]"])
def test_a_session_without_a_shared_folder_is_an_error(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session_with({"spark.master": master}))
    named = {"spark.master": master, "spark.checkpoint.dir": "hdfs:///tmp/work/"}
    assert shared_folder(session_with(named)) == "hdfs:///tmp/work"
    assert shared_folder(session_with({"spark.master": master}, "hdfs:///tmp/given")) == "hdfs:///tmp/given"


def test_durable_tables_can_be_dropped(spark, tmp_path):
    kept, dropped = durable(spark.range(3), "kept"), durable(spark.range(3), "dropped")
    path = dropped.inputFiles()[0].removeprefix("file:")
    assert os.path.exists(path)
    drop_durable(dropped)
    assert not os.path.exists(path)
    assert kept.count() == 3
