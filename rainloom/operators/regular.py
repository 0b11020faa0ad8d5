"""Irregular readings onto a regular grid (problem 4).

Readings fall into the slots of their station (`cadence_h` hours wide, from 00:00 UTC of each day). In every calendar month
in which a station has a reading, each slot comes out: `observed` with the mean of its readings, `filled` from a low-rank
factorisation of the station-by-slot matrix, or `unsupported` where no station of that cadence has a reading in the slot.
"""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, Window, functions as F

from rainloom.functions.expr import hour_text, naive_hours
from rainloom.sources.tables import staged

MISSING_MARKS = (-999.0, -99.0, -9999.0)
#: Cadences up to a day; slot numbers of all cadences share one range of integers.
MAX_CADENCE_H = 24
RANK, ROUNDS, PENALTY = 3, 4, 0.15


def is_reading(prcp: Column) -> Column:
    """Neither null, NaN nor one of the missing marks."""
    return prcp.isNotNull() & ~F.isnan(prcp) & ~prcp.isin(*MISSING_MARKS)


def observed_slots(obs: DataFrame, stations: DataFrame) -> DataFrame:
    """(station, cadence_h, slot, value, n) of the slots with a reading, `slot` being its start in hours since 1970-01-01 00:00.

    Times have no zone and are read by their fields, so the zone of the session doesn't matter. Readings of unknown or null
    stations, with a null time, or of stations without a cadence of 1 to 24 hours have no slots. Repeated readings count once per row.
    """
    cadence = stations.filter(F.col("cadence_h").between(1, MAX_CADENCE_H)).groupBy("station").agg(F.min("cadence_h").alias("cadence_h"))
    hours = (
        obs.filter(is_reading(F.col("prcp")) & F.col("time").isNotNull())
        .groupBy("station", naive_hours(F.col("time")).alias("hour"))
        .agg(F.sum("prcp").alias("total"), F.count("*").alias("n"))
    )
    of_day = F.pmod("hour", F.lit(24))
    start = F.col("hour") - of_day + F.floor(of_day / F.col("cadence_h")) * F.col("cadence_h")
    return (
        hours.join(cadence, "station")
        .groupBy("station", "cadence_h", start.cast("long").alias("slot"))
        .agg((F.sum("total") / F.sum("n")).alias("value"), F.sum("n").alias("n"))
    )


def _amount(value: Column) -> Column:
    """log(1 + mm) of a slot, for the factors; infinite and impossible values are held within 0 and 1,900 mm."""
    return F.log1p(F.greatest(F.lit(0.0), F.least(F.lit(1900.0), value)))


def _item(slot: Column, cadence: Column) -> Column:
    return (slot * 32 + cadence).cast("int")


def _numbered(slots: DataFrame) -> DataFrame:
    """(station, user, mean): stations numbered from 0 on, partition by partition, with their mean amount; only the sizes of the partitions are gathered."""
    names = staged(slots.groupBy("station").agg(F.avg(_amount(F.col("value"))).alias("mean")).withColumn("part", F.spark_partition_id()))
    sizes = names.groupBy("part").count().withColumn("before", F.sum("count").over(Window.orderBy("part")) - F.col("count"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("station")) - 1
    # one row per partition
    return names.withColumn("i", within).join(F.broadcast(sizes), "part").select("station", (F.col("before") + F.col("i")).cast("int").alias("user"), "mean")


def factorise(slots: DataFrame, numbers: DataFrame) -> ALSModel:
    """Alternating least squares over the amounts less the mean of their station, stations by slots; slots of one cadence share factors."""
    rating = (_amount(F.col("value")) - F.col("mean")).cast("float")
    ratings = slots.join(numbers, "station").select("user", _item(F.col("slot"), F.col("cadence_h")).alias("item"), rating.alias("rating"))
    return ALS(rank=RANK, maxIter=ROUNDS, regParam=PENALTY, seed=1, userCol="user", itemCol="item", ratingCol="rating").fit(ratings)


def _fills(gaps: DataFrame, model: ALSModel, numbers: DataFrame) -> DataFrame:
    """`gaps` with `fill`, what the factors give for (station, cadence_h, slot); null where the slot has no factors."""
    by_station = numbers.join(model.userFactors.withColumnsRenamed({"id": "user", "features": "a"}), "user").select("station", "mean", "a")
    by_slot = model.itemFactors.withColumnsRenamed({"id": "item", "features": "b"})
    dot = F.aggregate(F.zip_with("a", "b", lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    rows = gaps.withColumn("item", _item(F.col("slot"), F.col("cadence_h"))).join(by_slot, "item", "left").join(by_station, "station", "left")
    return rows.withColumn("fill", F.when(F.col("b").isNotNull(), F.greatest(F.lit(0.0), F.expm1(F.col("mean") + dot)))).drop("mean", "a", "b", "item")


def grid(slots: DataFrame) -> DataFrame:
    """(station, cadence_h, slot, value, n): all slots of the months with a reading; `value` null where there is none.

    A month of a station holds at most 744 slots, so its readings are gathered in one row.
    """
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("slot") / 24).cast("int"))
    months = slots.groupBy("station", "cadence_h", F.trunc(day, "month").alias("month")).agg(F.map_from_entries(F.collect_list(F.struct("slot", F.struct("value", "n")))).alias("seen"))
    days = F.sequence(F.datediff("month", F.lit("1970-01-01")).cast("long"), F.datediff(F.last_day("month"), F.lit("1970-01-01")).cast("long"))
    starts = F.sequence(F.lit(0), F.lit(23), F.col("cadence_h"))
    every = F.flatten(F.transform(days, lambda d: F.transform(starts, lambda h: d * 24 + h)))
    return months.select("station", "cadence_h", "seen", F.explode(every).alias("slot")).select("station", "cadence_h", "slot", F.col("seen")[F.col("slot")]["value"].alias("value"), F.col("seen")[F.col("slot")]["n"].alias("n"))


def _regular(obs: DataFrame, stations: DataFrame) -> DataFrame:
    """As `regularise`, with `slot` in hours since 1970-01-01 00:00."""
    slots = staged(observed_slots(obs, stations))
    if slots.isEmpty():
        return slots.select("station", "slot", "value", F.lit("observed").alias("status"), "n")
    numbers = staged(_numbered(slots))
    model = factorise(slots, numbers)
    all_slots = grid(slots)
    seen = all_slots.filter("value is not null").select("station", "slot", "value", F.lit("observed").alias("status"), "n")
    gaps = _fills(all_slots.filter("value is null").drop("value", "n"), model, numbers).select(
        "station", "slot", F.col("fill").alias("value"), F.when(F.col("fill").isNull(), "unsupported").otherwise("filled").alias("status"), F.lit(0).cast("long").alias("n")
    )
    return seen.unionByName(gaps)


def regularise(obs: DataFrame, stations: DataFrame) -> DataFrame:
    """(station, slot, value, status, n) with `slot` its start without zone and `status` observed, filled or unsupported; observed values are exact means."""
    return _regular(obs, stations).withColumn("slot", F.timestamp_add("HOUR", F.col("slot").cast("int"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")))


def hidden_error(obs: DataFrame, stations: DataFrame, one_in: int = 20) -> DataFrame:
    """(cadence_h, n, error, error_of_mean): root mean square error, in log(1 + mm), of the fills of observed slots that were kept from the
    factorisation (every `one_in`-th by a hash), and that of the mean of their station. No rows where nothing is hidden or left."""
    slots = staged(observed_slots(obs, stations).withColumn("hidden", F.pmod(F.xxhash64("station", "slot"), F.lit(one_in)) == 0))
    kept = slots.filter("not hidden")
    truth = _amount(F.col("value"))
    if kept.isEmpty():
        return slots.limit(0).select("cadence_h", "n", F.lit(0.0).alias("error"), F.lit(0.0).alias("error_of_mean"))
    numbers = staged(_numbered(kept))
    rows = _fills(slots.filter("hidden"), factorise(kept, numbers), numbers).filter("fill is not null").join(numbers, "station")
    rms = lambda x: F.sqrt(F.avg((x - truth) * (x - truth)))
    return rows.groupBy("cadence_h").agg(F.count("*").alias("n"), rms(F.log1p("fill")).alias("error"), rms(F.col("mean")).alias("error_of_mean"))


def empty_slots(obs: DataFrame, stations: DataFrame) -> DataFrame:
    """(station, slot): the slots without a reading, as `yyyy-MM-dd HH:mm`."""
    return _regular(obs, stations).filter("status <> 'observed'").select("station", hour_text(F.col("slot")).alias("slot"))
