"""Alarms raised by the stream itself."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vigil.operators import governance
from vigil.streaming import alarms, ingest

SCHEMA = "ts timestamp, `a key` string, k0 int, n int"
START = datetime(2025, 3, 30)


def at(minutes):
    return START + timedelta(minutes=minutes)


def add(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark, root, keys, periods=2, threshold=5, **options):
    stream = ingest.new_files(spark, f"{root}/in", spark.createDataFrame([], SCHEMA).schema, **options)
    return alarms.windowed_alarms(stream, "ts", keys, F.col("n"), threshold, f"{root}/out", f"{root}/state", periods)


def seen(frame):
    return Counter((*r[:-2], r.alarm_start, r.metric) for r in frame.collect())


def test_a_run_goes_on_after_a_restart(spark, tmp_path):
    key = ("x", 1)
    # Windows 0 and 1 are above the threshold; 1 stays open until later events come.
    add(spark, f"{tmp_path}/in", [(at(1), *key, 9), (at(6), *key, 8), (at(66), *key, 1)])
    assert seen(run(spark, tmp_path, ["a key"])) == Counter()
    add(spark, f"{tmp_path}/in", [(at(11), *key, 7), (at(66), *key, 1), (at(200), *key, 1)])
    two = Counter({("x", at(5), 8.0): 1, ("x", at(10), 7.0): 1})
    assert seen(run(spark, tmp_path, ["a key"])) == two
    assert seen(run(spark, tmp_path, ["a key"])) == two  # nothing new, nothing twice
    # 10 and 205 are no neighbours: the state of the first run is gone.
    add(spark, f"{tmp_path}/in", [(at(206), *key, 9), (at(211), *key, 6), (at(900), *key, 1)])
    assert seen(run(spark, tmp_path, ["a key"])) == two + Counter({("x", at(210), 6.0): 1})


@pytest.mark.parametrize("keys, threshold", [(["a key"], 5), (["a key", "k0"], 2), ([], 9)])
def test_equal_to_the_batch_form(spark, tmp_path, keys, threshold):
    """Random events in many files, with late ones, null keys and null values; restarts between."""
    random.seed(3)
    events = [(at(random.randint(0, 400) - random.choice([0, 0, 9])), random.choice(["x", "y", None]),
               random.choice([1, None]), random.choice([None, 0, 2, 3, 4])) for _ in range(700)]
    events.sort(key=lambda e: e[0] + timedelta(minutes=random.randint(0, 20)))
    for a in range(0, 600, 300):
        for b in range(a, a + 300, 100):
            add(spark, f"{tmp_path}/in", events[b:b + 100])
        found = run(spark, tmp_path, keys, 3, threshold, maxFilesPerTrigger=2)
    expected = governance.alarms(spark.read.parquet(f"{tmp_path}/out/windows"), keys, threshold, 3)
    assert found.columns == [*keys, "alarm_start", "metric"]
    assert seen(found) == seen(expected) and found.count() > 3


def test_no_events(spark, tmp_path):
    add(spark, f"{tmp_path}/in", [])
    assert run(spark, tmp_path, []).count() == 0
