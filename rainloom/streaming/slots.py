"""Regular slots of station readings as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rainloom.operators.regular import is_reading


def slot_means(readings: DataFrame, hours: int, late: str = "2 days") -> DataFrame:
    """(station, slot, value, n) of a stream of (station, time, prcp): means of the slots of `hours` hours from 00:00 UTC.

    A slot is complete once the watermark has passed it; readings later than `late` are left out of the stream and belong to the batch operator.
    """
    known = readings.filter(is_reading(F.col("prcp")) & F.col("time").isNotNull()).select("station", F.col("time").cast("timestamp").alias("time"), "prcp")
    windows = known.withWatermark("time", late).groupBy("station", F.window("time", f"{hours} hours"))
    return windows.agg(F.avg("prcp").alias("value"), F.count("*").alias("n")).select("station", F.col("window.start").alias("slot"), "value", "n")
