import pytest
from pyspark.sql import functions as F

from hourloom.operators import clean, joins, reports
from hourloom.plans import build, training


def _rows(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


def test_unknown_entity_and_strategy_are_errors(spark):
    t = _rows(spark, [(" LAHORE ",), ("Oslo",)], "city string")
    assert clean.canonical_entity(t.limit(1), ["Lahore"]).first().city == "Lahore"
    with pytest.raises(Exception, match="unknown entity: oslo"):
        clean.canonical_entity(t, ["Lahore"]).collect()
    with pytest.raises(ValueError, match="unknown strategy"):
        clean.batch_missing(t, ["city"], "best")


def test_failed_pairs_are_told_or_raised(spark):
    w = _rows(spark, [("a", 1, 20.0), ("a", 2, None), ("a", 3, 21.0)], "city string, timestamp int, temperature double")
    a = _rows(spark, [("a", 1, 50.0), ("a", 2, 60.0), ("a", 4, 70.0)], "city string, timestamp int, aqi double")
    pairs, failed = joins.merge_batch(w, a, ["temperature"])
    assert [(r.timestamp, r.aqi) for r in pairs.collect()] == [(1, 50.0)]
    assert {r.timestamp: r.error for r in failed.collect()} == {2: "temperature: missing", 3: "air missing", 4: "weather missing"}
    with pytest.raises(ValueError):
        joins.merge_batch(w, a, ["temperature"], skip_errors=False)


def test_valid_and_invalid_rows_part(spark):
    t = clean.errors(_rows(spark, [("a", 20.0), (None, 20.0), ("b", 99.0)], "city string, temperature double"), ["city"])
    good, bad = clean.split_valid(t)
    assert [r.city for r in good.collect()] == ["a"] and {tuple(r.errors) for r in bad.collect()} == {("city: missing",), ("temperature: out of range",)}


def test_strict_build_stops_before_writing(spark, tmp_path):
    t = _rows(spark, [("a", "2024-01-01 00:00:00", 1.0, 1), ("a", "2024-01-01 05:00:00", 2.0, 2)], "city string, timestamp string, aqi double, ingest_seq long").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    t.write.parquet(f"{tmp_path}/v/version=1")
    t.where("ingest_seq = 2").withColumn("aqi", F.lit(9.0)).write.parquet(f"{tmp_path}/v/version=10")
    assert sorted(r.aqi for r in build.stored_versions(spark, f"{tmp_path}/v").collect()) == [1.0, 9.0]
    (tmp_path / "none").mkdir()
    t.write.parquet(f"{tmp_path}/none/flat")
    with pytest.raises(ValueError, match="no versions"):
        build.stored_versions(spark, f"{tmp_path}/none/flat")


def test_hooks_run_around_each_batch_and_errors_stay_apart():
    seen = []

    def job(b):
        if b == 2:
            raise ValueError("bad")
        seen.append(b)

    out = build.run_batches([1, 2, 3], job, lambda b: seen.append(f"<{b}"), lambda b, e: seen.append(f"{b}>{e or ''}"))
    assert out == [(1, None), (2, "ValueError: bad"), (3, None)]
    assert seen == ["<1", 1, "1>", "<2", "2>ValueError: bad", "<3", 3, "3>"]


def test_horizons_bundles_versions_and_grades(spark):
    assert training.allowed_horizons(48) == [24, 48]
    with pytest.raises(ValueError):
        training.allowed_horizons(25)
    assert training.bundle_problems(["a", "b"], 24, ["a", "b"]) == []
    assert training.bundle_problems(["a", "a"], 25, []) != []
    assert training.next_version(_rows(spark, [], "version string")) == "1.0.0"
    assert training.next_version(_rows(spark, [("1.0.9",), ("1.0.10",)], "version string")) == "1.0.11"
    assert reports.readiness({"a": 1.0, "b": 0.5}, {"a": 1, "b": 1}) == (75.0, "B")


def test_a_lacking_feature_or_label_is_an_error(spark):
    t = _rows(spark, [(1.0,)], "x double")
    with pytest.raises(ValueError, match="missing features"):
        training.predictions(None, t, ["y"], "1")
    with pytest.raises(ValueError, match="missing label"):
        training.residuals(None, t, ["x"], "aqi")
