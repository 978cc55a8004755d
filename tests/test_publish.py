"""Publishing is repeatable, and a failed error check leaves what was published untouched."""

from datetime import datetime, timedelta

import pytest
from fixtures import ride, workforce
from pyspark.sql import functions as F

from ledgerlane.operators.quarantine import Partner, RowRules, set_aside_rows, sound_rows, write_broken, write_split
from ledgerlane.plans import publish, workforce_checks
from ledgerlane.plans.publish import BlockedByChecks, Keeping, StaleSources, publish_ride, publish_workforce, published
from ledgerlane.sources.ride_projection import ProjectedRideTables
from ledgerlane.sources.tables import RIDE_SCHEMAS, read_ride_tables, write_raw_tables
from ledgerlane.sources.workforce_projection import ProjectedWorkforceTables


def rows(spark, path):
    return sorted(map(str, spark.read.parquet(path).collect()))


def test_ride_marts_publish_from_loaded_tables_and_repeat(spark, data, tmp_path):
    write_raw_tables(ProjectedRideTables(spark, data), RIDE_SCHEMAS, f"{tmp_path}/raw")
    raw, out = read_ride_tables(spark, f"{tmp_path}/raw"), f"{tmp_path}/out"
    report = publish_ride(raw, out)
    assert len(report) == 48
    assert not [r for r in report if r.status == "error"]
    marts = ["mart_drivers", "mart_riders", "mart_marketplace_kpis", "mart_reconciliation"]
    before = {name: rows(spark, f"{published(spark, out)}/{name}") for name in marts}
    publish_ride(raw, out)
    assert {name: rows(spark, f"{published(spark, out)}/{name}") for name in marts} == before

    broken = ride(spark, data, riders=raw.riders.where("rider_id <> 0")).raw
    at = published(spark, out)
    with pytest.raises(BlockedByChecks) as blocked:
        publish_ride(broken, out)
    assert [r.test for r in blocked.value.failed] == ["orphan_trips"]
    assert {name: rows(spark, f"{published(spark, out)}/{name}") for name in marts} == before
    assert published(spark, out) == at


def test_a_run_that_breaks_half_way_leaves_the_old_marts(spark, data, tmp_path, monkeypatch):
    raw, out = ProjectedRideTables(spark, data), f"{tmp_path}/out"
    publish_ride(raw, out)
    at = published(spark, out)
    before = rows(spark, f"{at}/mart_riders")
    written = []

    def breaking(mart):
        written.append(mart)
        if len(written) == 3:
            raise OSError("the store went away")
        return mart

    monkeypatch.setattr(publish, "present", breaking)
    with pytest.raises(OSError):
        publish_ride(raw, out)
    assert published(spark, out) == at
    assert rows(spark, f"{at}/mart_riders") == before


def test_workforce_marts_publish(spark, data, tmp_path):
    report = publish_workforce(ProjectedWorkforceTables(spark, data), f"{tmp_path}/out")
    assert len(report) == 29
    assert {r.test for r in report if r.status != "pass"} == {"transfer_chain", "attrition_no_transfers"}
    assert spark.read.parquet(f"{published(spark, f'{tmp_path}/out')}/fct_workforce").count() == 150


def folders(path):
    return sorted(p.name for p in path.iterdir() if p.is_dir())


def test_a_reader_of_the_run_before_keeps_its_files_until_they_are_old(spark, data, tmp_path):
    raw, out = ProjectedRideTables(spark, data), f"{tmp_path}/out"
    publish_ride(raw, out)
    reading = spark.read.parquet(f"{published(spark, out)}/mart_riders")
    first, count = published(spark, out), reading.count()
    publish_ride(raw, out)
    assert published(spark, out) != first and reading.count() == count
    publish_ride(raw, out, keeping=Keeping(runs=2, age=timedelta(hours=1)))
    assert reading.count() == count  # beyond the last two, but young
    publish_ride(raw, out, keeping=Keeping(runs=2, age=timedelta(0)))
    runs = [name for name in folders(tmp_path / "out") if name.startswith("run-")]
    assert len(runs) == 2 and first.split("/")[-1] not in runs and published(spark, out).split("/")[-1] in runs


def test_rows_that_break_rules_lie_beside_the_marts_and_are_counted_alike(spark, data, tmp_path):
    out = f"{tmp_path}/out"
    report = {r.test: r.failures for r in publish_workforce(ProjectedWorkforceTables(spark, data), out)}
    aside = spark.read.parquet(f"{published(spark, out)}/set_aside/stg_employees")
    assert aside.where("array_contains(rules, 'transfer_chain')").count() == report["transfer_chain"] > 0
    assert "full_name" in aside.columns
    models = workforce(spark, data)
    for df, rules in workforce_checks.row_rules(models):
        if rules.names:
            counts = write_broken(df, rules, f"{tmp_path}/broken/{rules.model}")
            assert {name: n for name, n in counts.items() if name in report} == {n: report[n] for n in counts if n in report}


def test_a_blocked_run_leaves_the_rows_that_blocked_it(spark, data, tmp_path):
    raw, out = ProjectedRideTables(spark, data), f"{tmp_path}/out"
    broken = ride(spark, data, riders=raw.riders.where("rider_id <> 0")).raw
    with pytest.raises(BlockedByChecks) as blocked:
        publish_ride(broken, out)
    (stopped,) = (tmp_path / "out" / "stopped").iterdir()
    aside = spark.read.parquet(f"{stopped}/set_aside/stg_trips").where("array_contains(rules, 'orphan_trips')")
    assert aside.count() == blocked.value.failed[0].failures
    assert aside.where("rider_id <> 0").count() == 0 and published(spark, out) is None


def test_stale_sources_stop_a_run_before_anything_is_built(spark, data, tmp_path, monkeypatch):
    raw, out = ProjectedRideTables(spark, data), f"{tmp_path}/out"
    monkeypatch.setattr(publish, "_settle_layer", lambda *_: pytest.fail("a layer was built"))
    with pytest.raises(StaleSources) as stopped:
        publish_ride(raw, out, fresh_at=datetime(2026, 6, 1))
    assert {r.source for r in stopped.value.stale} >= {"raw_trips", "raw_payments"}
    assert not (tmp_path / "out").exists()


def test_a_stopped_run_goes_on_where_it_ended(spark, data, tmp_path, monkeypatch):
    write_raw_tables(ProjectedRideTables(spark, data), RIDE_SCHEMAS, f"{tmp_path}/raw")
    raw, out = read_ride_tables(spark, f"{tmp_path}/raw"), f"{tmp_path}/out"
    written, settle = [], publish._settle_layer

    def counting(models, names, folder):
        done = settle(models, names, folder)
        written.append(done)
        return done

    monkeypatch.setattr(publish, "_settle_layer", counting)
    with monkeypatch.context() as patched:
        patched.setattr(publish, "present", lambda mart: (_ for _ in ()).throw(OSError("the store went away")))
        with pytest.raises(OSError):
            publish_ride(raw, out)
    staging = ["stg_drivers", "stg_payments"]
    assert written[0] == staging and "int_trips_enriched" in written[1]
    assert not [name for name in folders(tmp_path / "out") if name.startswith("run-")]
    publish_ride(raw, out)
    assert written[2:] == [[], []] and published(spark, out)
    assert "layers" not in folders(tmp_path / "out")
    # Other input is another fingerprint.
    publish_ride(ride(spark, data, riders=raw.riders.where("rider_id >= 0")).raw, out)
    assert written[4] == staging


def test_one_write_splits_sound_rows_from_others(spark, tmp_path):
    rows = spark.createDataFrame([(1, 5, 1), (2, None, 2), (3, -1, 9), (4, -2, None), (4, 3, 1)], "id long, amount int, home int")
    homes = spark.createDataFrame([(1,), (1,), (2,), (None,)], "home int")
    rules = RowRules(
        "rows", "id", {"missing": F.col("amount").isNull(), "negative": F.col("amount") < 0}, {"homeless": Partner("home", homes, "home")}
    )
    path = f"{tmp_path}/split"
    assert write_split(rows, rules, path) == {"missing": 1, "negative": 2, "homeless": 1}
    assert sorted(r.id for r in sound_rows(rows, path).collect()) == [1, 4]
    aside = {r.id: r.rules for r in set_aside_rows(rows, rules, path).collect()}
    assert aside == {2: ["missing"], 3: ["negative", "homeless"], 4: ["negative"]}
    none = rows.limit(0)
    assert write_split(none, rules, f"{tmp_path}/none") == {"missing": 0, "negative": 0, "homeless": 0}
    assert sound_rows(rows, f"{tmp_path}/none").count() == 0
