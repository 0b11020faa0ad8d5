"""Implausible spikes in measurements (problem 1): impossible values, spikes and stuck values per source.

Readings are grouped into blocks of about BLOCK_ROWS of one source: a stretch of time of a station, some files of a model
and cell; a source with more readings has more blocks. In each block robust principal components part the profile matrix
(days by times of day; members by steps) into normal behaviour and sparse deviations; ranges and constant runs are tested
separately. Deviations are then held against all readings of their source: those that lie beyond a gap of more than a
factor of two are spikes. Only flagged rows, block maxima and the runs at the ends of blocks leave the blocks, so no
source is ever gathered in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rainloom.functions import profile
from rainloom.functions.expr import naive_micros
from rainloom.operators.regular import is_reading
from rainloom.operators.unify import convert_forecast
from rainloom.sources.tables import broadcast_if_small, staged

HIGHEST_MM = 1900.0
LOWEST_MM = {"station_obs": 0.0, "fcst_daily": -0.1}
STUCK = 6
#: Stands for a member without a number; beyond all numbers of 32 bits.
NO_NUMBER = -(1 << 40)
GAP = 2.0
#: Readings of a block aimed at; it sets the size of tasks, not what is found.
BLOCK_ROWS = 20_000
DAY_US = 86_400_000_000
# kind: F found, C deviates from normal, O in a run at the end of a block, E such a run, M largest ordinary reading of a block
_RECORD = "tbl string, src string, block long, kind string, pos int, equal double, n long, row_id long, value double"


def station_readings(obs: DataFrame) -> DataFrame:
    """(tbl, src, block, file, number, ord, value, row_id) of the readings of `station_obs` with an id, a station and a time; missing values are no readings.

    A block is a stretch of time, as long as BLOCK_ROWS readings of the station take on average; whole days unless a day holds more.
    """
    known = obs.filter(is_reading(F.col("prcp")) & F.col("time").isNotNull() & F.col("station").isNotNull() & F.col("obs_id").isNotNull())
    known = known.select(F.col("station").alias("src"), naive_micros(F.col("time")).alias("ord"), F.col("prcp").alias("value"), F.col("obs_id").alias("row_id"))
    spans = known.groupBy("src").agg(F.min("ord").alias("begin"), ((F.max("ord") - F.min("ord") + 1.0) * BLOCK_ROWS / F.count("*")).alias("length"))
    spans = spans.select("src", F.floor(F.col("begin") / DAY_US).cast("long").alias("day0"), F.when(F.col("length") > DAY_US, F.ceil(F.col("length") / DAY_US) * DAY_US).otherwise(F.ceil("length")).cast("long").alias("length"))
    return known.join(broadcast_if_small(staged(spans)), "src").select(
        F.lit("station_obs").alias("tbl"), "src", F.floor((F.col("ord") - F.col("day0") * DAY_US) / F.col("length")).cast("long").alias("block"), F.lit(0).cast("long").alias("file"), F.lit(0).cast("long").alias("number"), "ord", "value", "row_id"
    )


def forecast_readings(fcst: DataFrame, attrs: DataFrame) -> DataFrame:
    """The same of `fcst_daily.tp_daily` in mm; a series is one (file_id, number, cell_id) and lies in one block, which holds some of the files of its source.

    Rows without an id or a file are no readings; those without a number form one series of their file, those without a step stand before its first step.
    """
    source = F.concat_ws("|", "model", "cell_id")
    parts = fcst.filter("tp_daily is not null").groupBy(source.alias("src")).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("long").alias("parts"))
    known = convert_forecast(fcst, attrs).filter(F.col("tp_daily_mm").isNotNull() & ~F.isnan("tp_daily_mm") & F.col("fcst_id").isNotNull()).withColumn("src", source)
    return known.join(broadcast_if_small(staged(parts)), "src").select(
        F.lit("fcst_daily").alias("tbl"),
        "src",
        F.pmod(F.xxhash64("file_id"), "parts").cast("long").alias("block"),
        F.col("file_id").cast("long").alias("file"),
        F.coalesce(F.col("number").cast("long"), F.lit(NO_NUMBER)).alias("number"),
        F.coalesce(F.col("step_h").cast("long"), F.lit(-1)).alias("ord"),
        F.col("tp_daily_mm").alias("value"),
        F.col("fcst_id").alias("row_id"),
    )


def _series(file: np.ndarray, number: np.ndarray) -> np.ndarray:
    """A number for each different (file, number)."""
    (_, a), (few, b) = (np.unique(x, return_inverse=True) for x in (file, number))
    return a * len(few) + b


def _block(table: pa.Table) -> pa.Table:
    tbl, src, block = (table.column(c)[0].as_py() for c in ("tbl", "src", "block"))
    order, value, ids = (table.column(c).to_numpy() for c in ("ord", "value", "row_id"))
    series = _series(table.column("file").to_numpy(), table.column("number").to_numpy())
    spans_blocks = tbl == "station_obs"
    found = (value < LOWEST_MM[tbl]) | (value > HIGHEST_MM)
    run, length, equal = profile.runs(series, order, value)
    stuck = (length[run] >= STUCK) & (equal != 0)
    end_run = np.zeros(len(value), np.int8)  # 1 first, 2 last, 3 both
    if spans_blocks:
        end_run[run == 0] = 1
        end_run[run == len(length) - 1] += 2
    edge = (end_run > 0) & (equal != 0) & ~stuck
    plain = ~found & ~stuck & ~edge
    deviates = np.zeros(len(value), bool)
    if plain.any():
        if spans_blocks:
            day = order // DAY_US
            days, row = np.unique(day, return_inverse=True)
            # about one reading in a cell, so that the largest of a cell tells of single readings
            width = max(1, round(len(value) / len(days)))
            col = np.unique((order % DAY_US) * width // DAY_US, return_inverse=True)[1]
        else:
            row, col = np.unique(series, return_inverse=True)[1], np.unique(order, return_inverse=True)[1]
        deviates[plain] = profile.sparse_part(row[plain], col[plain], value[plain])
    parts: list[tuple[str, np.ndarray, np.ndarray, np.ndarray]] = []

    def put(kind: str, rows: np.ndarray, pos: np.ndarray | None = None, n: np.ndarray | None = None) -> None:
        zero = np.zeros(len(rows), np.int64)
        parts.append((kind, rows, zero if pos is None else pos[rows], zero if n is None else n[rows]))

    place = np.where(end_run == 2, 1, 0)
    put("F", np.flatnonzero(found | stuck))
    put("C", np.flatnonzero(deviates))
    put("O", np.flatnonzero(edge & ~found), place)
    if spans_blocks:
        ends = [0] if len(length) == 1 else [0, len(length) - 1]
        put("E", np.array([int(np.flatnonzero(run == r)[0]) for r in ends]), place, length[run])
    rest = np.flatnonzero(plain & ~deviates)
    if len(rest):
        put("M", rest[[int(value[rest].argmax())]])
    rows = np.concatenate([p[1] for p in parts])
    size = len(rows)
    columns = {
        "tbl": pa.array([tbl] * size, pa.string()),
        "src": pa.array([src] * size, pa.string()),
        "block": pa.array([block] * size, pa.int64()),
        "kind": pa.array([k for k, at, _, _ in parts for _ in range(len(at))], pa.string()),
        "pos": pa.array(np.concatenate([p[2] for p in parts]).astype(np.int32)),
        "equal": pa.array(equal[rows]),
        "n": pa.array(np.concatenate([p[3] for p in parts]).astype(np.int64)),
        "row_id": pa.array(ids[rows]),
        "value": pa.array(value[rows]),
    }
    return pa.table(columns)


def _cuts(normal: DataFrame, pool: DataFrame) -> DataFrame:
    """(tbl, src, cut): the largest ordinary reading of each source that has spikes.

    Starting from the largest reading within normal behaviour, larger ones are ordinary as long as none is more than GAP
    times the one below it. Readings are taken in bins of a factor of two, whose bounds tell all gaps.
    """
    key = ["tbl", "src"]
    base = pool.groupBy(*key).agg(F.percentile_approx(F.when(F.col("value") > 0, F.col("value")), 0.5).alias("middle")).join(normal, key, "left")
    base = base.select(*key, F.greatest(F.lit(0.0), F.coalesce("most", "middle", F.lit(0.0))).alias("base"))
    bins = pool.join(base, key).filter("value > base").groupBy(*key, F.floor(F.log2("value")).alias("bin")).agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.first("base").alias("base"))
    below = F.coalesce(F.lag("hi").over(Window.partitionBy(*key).orderBy("bin")), F.col("base"))
    return bins.withColumn("below", below).filter(F.col("lo") > GAP * F.col("below")).groupBy(*key).agg(F.min("below").alias("cut"))


def implausible(readings: DataFrame) -> DataFrame:
    """(tbl, row_id, why) of the readings that can't be rain of their source: `range`, `stuck` or `spike`; infinite values are out of range.

    An empty table gives no rows. Rows repeated with ids of their own all come out.
    """
    key = ["tbl", "src"]
    records = staged(readings.groupBy("tbl", "src", "block").applyInArrow(_block, _RECORD))
    of = lambda kind: records.filter(F.col("kind") == kind)
    order = Window.partitionBy(*key).orderBy("block", "pos")
    island = F.sum(F.when((F.col("equal") == F.lag("equal").over(order)) & (F.col("block") != F.lag("block").over(order)), 0).otherwise(1)).over(order)
    whole = Window.partitionBy(*key, "island")
    joined = of("E").withColumn("island", island).withColumn("total", F.sum("n").over(whole)).filter((F.col("total") >= STUCK) & (F.col("equal") != 0))
    long_runs = joined.select(*key, "block", "pos", F.lit(True).alias("long"))
    edges = of("O").join(long_runs, [*key, "block", "pos"], "left")
    pool = of("C").select(*key, "row_id", "value").unionByName(edges.filter("long is null").select(*key, "row_id", "value"))
    cuts = _cuts(of("M").groupBy(*key).agg(F.max("value").alias("most")), pool)
    spikes = pool.join(cuts, key).filter(F.col("value") > GAP * F.col("cut"))
    why = F.when((F.col("value") < F.when(F.col("tbl") == "station_obs", LOWEST_MM["station_obs"]).otherwise(LOWEST_MM["fcst_daily"])) | (F.col("value") > HIGHEST_MM), "range").otherwise("stuck")
    return (
        of("F").select("tbl", "row_id", why.alias("why"))
        .unionByName(edges.filter("long").select("tbl", "row_id", F.lit("stuck").alias("why")))
        .unionByName(spikes.select("tbl", "row_id", F.lit("spike").alias("why")))
    )


def implausible_readings(obs: DataFrame, fcst: DataFrame, attrs: DataFrame) -> DataFrame:
    """`implausible` over both tables."""
    return implausible(station_readings(obs).unionByName(forecast_readings(fcst, attrs)))
