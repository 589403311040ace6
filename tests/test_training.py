"""Staged training: what a stage costs and learns depends on its batch, not on the layout of the whole input."""

import threading

import pytest
from pyspark.ml.regression import GBTRegressor

from zonecast.ml import model as M

COLUMNS = (
    "rn long, pu_location_id int, hour int, day_of_week int, is_weekend int, avg_trip_distance double,"
    " avg_duration_min double, avg_speed_mph double, trip_count int, avg_tip_amount double"
)


@pytest.fixture()
def rows(spark):
    data = [
        (i, i * 7 % 5, i % 24, i % 7, int(i % 7 >= 5), i * 37 % 101 / 10, float(i * 13 % 50), 20.0, 1, (i * 37 % 101 + i % 24) / 10)
        for i in range(1, 301)
    ]
    return spark.createDataFrame(data, COLUMNS)


def trained(rows, parts, monkeypatch):
    """History, predictions by position, and the partitions that each stage was fitted on."""
    seen = []
    fit = GBTRegressor.fit

    def watched(self, frame):
        seen.append(frame.rdd.getNumPartitions())
        return fit(self, frame)

    with monkeypatch.context() as m:
        m.setattr(GBTRegressor, "fit", watched)
        core = rows.filter("rn <= 250").repartition(parts, "hour")
        model, history = M.train_staged(core, rows.filter("rn > 250"), rows_per_batch=100, init_trees=3, trees_per_batch=2)
    return history, dict(model.predict(rows, "p").select("rn", "p").collect()), seen


def test_stages_do_not_depend_on_the_layout_of_the_input(spark, rows, monkeypatch):
    monkeypatch.setattr(M, "SLICE_ROWS", 60, raising=False)
    narrow, wide = (trained(rows, parts, monkeypatch) for parts in (1, 20))
    assert narrow[2] == wide[2] == [2, 2, 1]  # of 100, 100 and 50 rows
    assert narrow[1] == wide[1]
    assert [h["rows"] for h in wide[0]] == [100, 100, 50] and [h["trees"] for h in wide[0]] == [3, 2, 2]


def test_stored_margins_are_those_of_all_stages(spark, rows, monkeypatch):
    history, predictions, _ = trained(rows, 3, monkeypatch)
    monkeypatch.setattr(M, "GROUP_BATCHES", 1)
    again, same, _ = trained(rows, 3, monkeypatch)
    assert same == predictions
    errors = [[h[c] for h in run for c in ("val_mae", "val_mape")] for run in (history, again)]
    assert errors[0] == pytest.approx(errors[1], rel=1e-12)


def test_a_batch_waits_for_few_stages_however_many_there_are(spark, rows, monkeypatch):
    core, val = rows.filter("rn <= 250"), rows.filter("rn > 250")

    def run(batches_per_group):
        waited = []
        add = M.add_margin

        def watched(df, stages, margin="__f"):
            if threading.current_thread() is threading.main_thread() and "__batch" in df.columns:
                waited.append(len(stages))
            return add(df, stages, margin)

        with monkeypatch.context() as m:
            m.setattr(M, "GROUP_BATCHES", batches_per_group)
            m.setattr(M, "add_margin", watched)
            model, history = M.train_staged(core, val, rows_per_batch=40, init_trees=2, trees_per_batch=1)
        return waited, history, dict(model.predict(rows, "p").select("rn", "p").collect())

    waited, history, predictions = run(1)
    assert len(history) == 7 and max(waited) == 1
    _, whole, same = run(7)
    assert predictions == same
    assert [h["rows"] for h in history] == [h["rows"] for h in whole]
    assert [h["val_mae"] for h in history] == pytest.approx([h["val_mae"] for h in whole], rel=1e-12)
