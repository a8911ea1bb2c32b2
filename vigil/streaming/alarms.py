"""Metric windows over an event stream, and alarms with keyed state."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from vigil.operators.governance import metric_windows
from vigil.schemas import quoted

#: Of each key: the last window above the threshold, in microseconds, and how many
#: windows without a gap end with it.
STATE = "last bigint, run bigint"


def closed_windows(events: DataFrame, time_column: str, group_by: list[str], value: Column,
                   sink: str, checkpoint: str, statistic: str = "sum",
                   period: str = "5 minutes", lateness: str = "1 hour") -> DataFrame:
    """Append each window to the sink once no more events can reach it.

    Events later than `lateness` are dropped by the watermark. Returns the
    windows written so far; governance.alarms finds the alarms among them.
    """
    windows = metric_windows(_timed(events, time_column, lateness), time_column, group_by, value,
                             statistic, period)
    return _append(windows, sink, checkpoint)


def windowed_alarms(events: DataFrame, time_column: str, group_by: list[str], value: Column,
                    threshold: float, sink: str, checkpoint: str, periods: int = 2,
                    statistic: str = "sum", period_seconds: int = 300,
                    lateness: str = "1 hour") -> DataFrame:
    """Append an alarm to sink/alarms for each window that ends a run above the threshold.

    Two streams, each with its checkpoint: the first appends closed windows to
    sink/windows, the second reads them as they come and holds, per key, the end of
    the present run of windows above the threshold, whatever number of batches or
    restarts it spans. A timer drops the state once the next window has come and gone.
    The alarms are those of governance.alarms over closed_windows. A restart goes on
    where either stream stood and emits no alarm twice. Null keys are a key; windows
    without events, and null metrics, are below the threshold. Returns the alarms
    written so far: group_by, alarm_start, metric.
    """
    spark = events.sparkSession
    windows = closed_windows(events, time_column, group_by, value, f"{sink}/windows", f"{checkpoint}/windows",
                             statistic, f"{period_seconds} seconds", lateness)
    names = [f"k{i}" for i in range(len(group_by))] or ["k0"]
    # Windows of a later batch are all younger: whatever is still to come is after the youngest seen.
    closing = spark.readStream.schema(windows.schema).parquet(f"{sink}/windows") \
        .withWatermark("window_start", "0 seconds")
    above = closing.where(F.col("metric") > threshold).select(
        "window_start", *[quoted(g).alias(n) for g, n in zip(group_by, names)],
        *([] if group_by else [F.lit(0).alias("k0")]),
        F.unix_micros("window_start").alias("start"), "metric")
    found = StructType([above.schema[n] for n in [*names, "start", "metric"]])
    raised = above.groupBy(*names).applyInPandasWithState(
        _runs(periods, period_seconds * 1_000_000), found, STATE, "append",
        GroupStateTimeout.EventTimeTimeout)
    return _append(raised.select(
        *[F.col(n).alias(g) for n, g in zip(names, group_by)],
        F.timestamp_micros("start").alias("alarm_start"), "metric"), f"{sink}/alarms", f"{checkpoint}/alarms")


def _runs(periods: int, period: int):
    """Follow the runs of one key; the windows of a batch may come in any order."""

    def follow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last, run = state.get if state.exists else (None, 0)
        raised = []
        rows = [row for batch in batches for row in zip(batch["start"].tolist(), batch["metric"].tolist())]
        for start, metric in sorted(rows):
            run = run + 1 if last is not None and start == last + period else 1
            last = start
            if run >= periods:
                raised.append((*key, start, metric))
        state.update((last, run))
        state.setTimeoutTimestamp((last + period) // 1000)
        if raised:
            yield pd.DataFrame(raised, columns=[*[f"k{i}" for i in range(len(key))], "start", "metric"])

    return follow


def _timed(events: DataFrame, time_column: str, lateness: str) -> DataFrame:
    return events.withColumn(time_column, F.col(time_column).cast("timestamp")) \
        .withWatermark(time_column, lateness)


def _append(rows: DataFrame, sink: str, checkpoint: str) -> DataFrame:
    query = (
        rows.writeStream.outputMode("append").format("parquet")
        .option("path", sink).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return rows.sparkSession.read.schema(rows.schema).parquet(sink)
