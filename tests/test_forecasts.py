"""The forecasts' champion is chosen among all candidates, over all fitted features."""

import datetime as dt

from hourloom import queries as core
from hourloom.plans import dataset, training
from hourloom import report_queries  # noqa: F401

T0 = dt.datetime(2024, 1, 1)


def test_a_tree_wins_where_the_target_is_a_step(spark):
    def row(i):
        x = float(i * 37 % 60)
        return "a", T0 + dt.timedelta(hours=i), "train" if i < 180 else "validation" if i < 240 else "test", x, x, 100.0 if 20 <= x < 40 else 10.0

    df = spark.createDataFrame([row(i) for i in range(300)], "city string, timestamp timestamp_ntz, split string, aqi double, x double, target_aqi_t_24 double")
    got = training.forecasts(df, ["x"], (24,)).collect()
    assert len(got) == 1 and got[0].model in ("forest", "boosted")
    assert abs(got[0].predicted_aqi - row(299)[-1]) < 5


def test_the_query_uses_all_fitted_features(spark, monkeypatch):
    seen, states, build = [], [], dataset.build

    def built(*a, **k):
        out = build(*a, **k)
        states.append(out[1])
        return out

    monkeypatch.setattr(dataset, "build", built)
    monkeypatch.setattr(training, "candidates", lambda train, trees=False: seen.append((train.columns, trees)) or {"ridge": training.ridge(train)})
    core.QUERIES["m05_m11_forecasts"](spark, "/root/testdata/sf0.001")
    assert len(seen) == 3
    for columns, trees in seen:
        assert trees and {*states[0].features} <= {*columns}
