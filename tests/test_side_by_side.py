"""Steps that run at the same time, and settings that stay with those who need them."""

from threading import Barrier

import pytest
from pyspark.sql import SparkSession

from farelens.registry import base, scenario
from farelens.session import apart, side_by_side

CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


def test_steps_run_at_the_same_time_and_errors_come_out(spark):
    met = Barrier(2, timeout=20)

    def step(n):
        met.wait()
        return spark.range(n).count()

    assert side_by_side(spark, lambda: step(3), lambda: step(5)) == [3, 5]
    with pytest.raises(ZeroDivisionError):
        side_by_side(spark, lambda: 1, lambda: 1 // 0)


def test_the_two_models_of_the_report_are_fitted_side_by_side(spark, monkeypatch):
    met = Barrier(2, timeout=20)

    def fitted(*_):
        met.wait()
        raise InterruptedError

    monkeypatch.setattr(scenario, "tickets", lambda s, d: s.range(1))
    monkeypatch.setattr(scenario, "_classified", fitted)
    monkeypatch.setattr(scenario, "quotes", fitted)
    with pytest.raises(InterruptedError):
        scenario.scenario_report(spark, "nowhere")


def test_stored_tickets_are_read_without_changing_settings(spark, monkeypatch):
    def refused(_):
        raise AssertionError("steps that run side by side would see this setting")

    monkeypatch.setattr(base, "is_stored", lambda *_: True)
    monkeypatch.setattr(base, "stored", lambda *_, **__: spark.range(1))
    monkeypatch.setattr(base, "co_located", refused)
    assert base.tickets(spark, "nowhere").count() == 1


def test_a_session_apart_keeps_its_settings_to_itself(spark):
    before = spark.conf.get(CO_PARTITION, "true")
    other = apart(spark, {CO_PARTITION: "false"})
    assert isinstance(other, SparkSession) and other.conf.get(CO_PARTITION) == "false"
    assert spark.conf.get(CO_PARTITION, "true") == before
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        assert other.conf.get(name) == spark.conf.get(name)
