"""Registered queries of the forecast and verification operators.

Verification needs many members, years and models per cell. Queries marked (cube) take them from the order lines, mapped to
a forecast cube: model = return flag and line status, cell = nation of the supplier, member = line number modulo 5, daily
amount = quantity shipped; observations are the order totals by nation of the customer. The cube holds all rows and is there
for load; the same operators run on the rainfall tables in `plans/runs.py`. The other queries read the rainfall tables,
converted to millimetres. Values are rounded to six digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rainloom import config
from rainloom.functions import labels, requests
from rainloom.functions.expr import decode_months, known, level_bin
from rainloom.models import NonParametric
from rainloom.operators import forecast as fc, periods as pd_, spatial, unify, verify as vf
from rainloom.plans import sql
from rainloom.sources import stations as st
from rainloom.sources.tables import read, staged

MEMBERS, MONTHS = list(range(5)), list(range(1, 13))
SEASONS = {"DJF": (1201, 228), "MAM": (301, 531), "JJA": (601, 831), "SON": (901, 1130), "NDJF": (1101, 229)}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = sql.ORACLE


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def r6(*names: str) -> list[Column]:
    return [F.round(F.col(n).cast("double"), 6).alias(n) for n in names]


def t6(*names: str) -> list[Column]:
    """Six digits of values that may lie halfway between two; a billionth settles those alike whatever the order of a sum."""
    return [F.round(F.col(n).cast("double") + 1e-9, 6).alias(n) for n in names]


# --- the cube ---------------------------------------------------------------------------------------------------------


def cube(spark: SparkSession, d: str) -> DataFrame:
    lines = read(spark, d, "lineitem").select("l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity", "l_shipdate")
    day = F.to_date("l_shipdate")
    kept = lines.join(read(spark, d, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    return kept.groupBy(
        F.concat("l_returnflag", "l_linestatus").alias("model"), F.col("s_nationkey").alias("cell_id"), (F.col("l_linenumber") % 5).cast("int").alias("number"), F.year(day).alias("year"), day.alias("day")
    ).agg(F.sum("l_quantity").alias("tp_daily"))


def last_year(spark: SparkSession, d: str) -> tuple[int, int]:
    """First and last year of the cube; the last one is forecast, those before are hindcasts."""
    r = read(spark, d, "lineitem").agg(F.min(F.year("l_shipdate")), F.max(F.year("l_shipdate"))).first()
    return r[0] or 0, r[1] or 0


def acc(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Hindcast and forecast amounts by month, written once for all branches of a query."""
    first, last = last_year(spark, d)
    c = staged(fc.dense(cube(spark, d).withColumn("period_id", F.month("day")), MEMBERS, list(range(first, last + 1)), MONTHS))
    return c.filter(F.col("year") < last), c.filter(F.col("year") == last)


def observed(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").join(read(spark, d, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    o = o.withColumns({"year": F.year("o_orderdate"), "period_id": F.month("o_orderdate")}).filter(F.col("year") < last_year(spark, d)[1])
    return o.groupBy(F.col("c_nationkey").alias("cell_id"), "period_id", "year").agg((F.sum("o_totalprice") / 1000.0).alias("acc_mm"))


def cube_zone(spark: SparkSession, d: str) -> DataFrame:
    """(cell_id, in_zone) of the cells of the cube, which lie on a lattice of five by five; the zones are the true ones."""
    k = F.col("s_nationkey")
    cells = read(spark, d, "supplier").select(k.alias("cell_id"), (4.0 + 8.0 * (k % 5)).alias("longitude"), (-21.0 + 11.5 * F.floor(k / 5)).alias("latitude")).distinct()
    return spatial.grid_mask(cells, read(spark, d, "zone_edges"))


def verification(spark: SparkSession, d: str) -> DataFrame:
    return staged(vf.pairs(acc(spark, d)[0], observed(spark, d)))


def limits(spark: SparkSession, d: str) -> DataFrame:
    return fc.thresholds(acc(spark, d)[0])


def probs(spark: SparkSession, d: str) -> DataFrame:
    h, f = acc(spark, d)
    return fc.probabilities(f, fc.thresholds(h))


def probs_and_limits(spark: SparkSession, d: str) -> DataFrame:
    h, f = acc(spark, d)
    limits = fc.thresholds(h)
    return fc.probabilities(f, limits).join(limits.select(*fc.CELL, "dry_mask"), fc.CELL)


def light(spark: SparkSession, d: str) -> DataFrame:
    h, f = acc(spark, d)
    return fc.light_products(f, h)


# --- the rainfall tables ----------------------------------------------------------------------------------------------


def forecasts(spark: SparkSession, d: str, columns: tuple[str, ...] = ("tp", "tp_daily")) -> DataFrame:
    """`fcst_daily` with the last delivery of each repeated row, `tp` in metres and `tp_daily` in millimetres whatever the unit of the file."""
    keys = ["file_id", "model", "kind", "number", "init_time", "step_h", "valid_time", "cell_id"]
    same = {"tp": "tp_m", "tp_daily": "tp_daily_mm"}
    mm = unify.convert_forecast(read(spark, d, "fcst_daily"), read(spark, d, "file_attrs")).select(*keys, *[F.col(same[c]).alias(c) for c in columns], "received", "fcst_id")
    return fc.latest(mm, keys, ["received", "fcst_id"])


def finite(c: str) -> Column:
    return F.when(F.abs(known(F.col(c))) <= 1900.0, F.col(c))


def observations(spark: SparkSession, d: str) -> DataFrame:
    """`obs_daily` in millimetres on the cells of the grid, the last of repeated rows."""
    mm = unify.convert_observations(read(spark, d, "obs_daily"), read(spark, d, "file_attrs")).select("file_id", "time", "latitude", "longitude", F.col("precip_mm").alias("precip"), "row_id")
    o = fc.latest(mm, ["file_id", "time", "latitude", "longitude"], ["row_id"])
    return o.join(read(spark, d, "grid").select("cell_id", "latitude", "longitude"), ["latitude", "longitude"])


def spans(spark: SparkSession, d: str) -> DataFrame:
    return pd_.spans_of(read(spark, d, "fcst_daily").select("file_id", "valid_time"), ["file_id"])


@query
def decumulate(spark: SparkSession, d: str) -> DataFrame:
    x = forecasts(spark, d, ("tp",))
    return fc.decumulate(x, ["file_id", "number", "cell_id"]).select("fcst_id", *t6("tp_daily"))


@query
def periods_month(spark: SparkSession, d: str) -> DataFrame:
    return pd_.months(spans(spark, d), ["file_id"])


@query
def periods_decade(spark: SparkSession, d: str) -> DataFrame:
    return pd_.decades(spans(spark, d), ["file_id"])


@query
def periods_season(spark: SparkSession, d: str) -> DataFrame:
    return pd_.seasons(spans(spark, d), ["file_id"], window=1)


@query
def periods_partial(spark: SparkSession, d: str) -> DataFrame:
    """Decades with the unfinished last one, no later than a fixed day."""
    return pd_.decades(pd_.spans_of(read(spark, d, "fcst_daily").select("file_id", "valid_time"), ["file_id"], "2023-06-15"), ["file_id"], partial_last=True)


@query
def period_custom(spark: SparkSession, d: str) -> DataFrame:
    return pd_.custom(spans(spark, d), ["file_id"])


@query
def accumulate_forecast(spark: SparkSession, d: str) -> DataFrame:
    x = forecasts(spark, d, ("tp_daily",)).filter("kind = 'forecast'").withColumns({"day": F.to_date("valid_time"), "tp_daily": finite("tp_daily")})
    days = pd_.days(pd_.decades(spans(spark, d), ["file_id"])).select("file_id", "label", "day")
    return fc.accumulate(x, days, ["file_id", "number", "cell_id"], ["file_id"]).select("file_id", "number", "cell_id", "label", *t6("acc_mm"))


@query
def accumulate_hindcast(spark: SparkSession, d: str) -> DataFrame:
    x = forecasts(spark, d, ("tp_daily",)).filter("kind = 'hindcast'").withColumns({"day": F.to_date("valid_time"), "tp_daily": finite("tp_daily"), "init_year": F.year("init_time")})
    return fc.accumulate_seasons(x, {k: v for k, v in SEASONS.items() if v[0] <= v[1]}, ["model", "number", "init_year", "cell_id"]).select("model", "number", "init_year", "cell_id", "season", *t6("acc_mm"))


@query
def monthday_wraparound(spark: SparkSession, d: str) -> DataFrame:
    x = observations(spark, d).withColumns({"year": F.year("time"), "precip": finite("precip")})
    return fc.accumulate_seasons(x, {k: v for k, v in SEASONS.items() if v[0] > v[1]}, ["cell_id", "year"], "precip", "time").select("cell_id", "year", "season", *t6("acc_mm"))


@query
def obs_accumulate(spark: SparkSession, d: str) -> DataFrame:
    x = observations(spark, d).withColumns({"year": F.year("time"), "month": F.month("time")})
    return fc.accumulate_observed(x, ["file_id", "cell_id", "year", "month"]).select("file_id", "cell_id", "year", "month", *t6("acc_mm"))


@query
def ens_mean_daily(spark: SparkSession, d: str) -> DataFrame:
    x = forecasts(spark, d, ("tp_daily",)).withColumn("tp_daily", finite("tp_daily"))
    return fc.ensemble_mean(x, "tp_daily", ["file_id", "cell_id", "step_h"]).select("file_id", "cell_id", "step_h", *t6("ens_mean"))


@query
def dispersion(spark: SparkSession, d: str) -> DataFrame:
    x = forecasts(spark, d, ("tp_daily",)).withColumn("tp_daily", finite("tp_daily"))
    return fc.dispersion(x, "tp_daily", ["file_id", "cell_id", "step_h"]).select("fcst_id", *t6("deviation"))


@query
def exceedance_daily(spark: SparkSession, d: str) -> DataFrame:
    x = forecasts(spark, d, ("tp_daily",)).select("file_id", "cell_id", "step_h", finite("tp_daily").alias("acc_mm"))
    return fc.exceedance(x, (1, 5, 10, 20), ["file_id", "cell_id", "step_h"]).select("file_id", "cell_id", "step_h", "threshold_mm", *t6("prob"))


# --- thresholds and probabilities (cube) ------------------------------------------------------------------------------


@query
def climatology_anomaly(spark: SparkSession, d: str) -> DataFrame:
    h, f = acc(spark, d)
    return fc.anomalies(f, h).select("model", "cell_id", "period_id", "number", *r6("clim_mean", "anomaly"))


@query
def quantile_thresholds(spark: SparkSession, d: str) -> DataFrame:
    return limits(spark, d).select(*fc.CELL, *r6(*fc.QUANTILES, "clim_mean"), "dry_mask")


@query
def tercile_probs(spark: SparkSession, d: str) -> DataFrame:
    return probs(spark, d).select(*fc.CELL, *r6(*config.PROBABILITIES))


@query
def model_contract(spark: SparkSession, d: str) -> DataFrame:
    """The probabilities by way of a fitted model (cube)."""
    h, f = acc(spark, d)
    return NonParametric().fit(h).transform(f).select(*fc.CELL, *r6(*config.PROBABILITIES))


@query
def coherence(spark: SparkSession, d: str) -> DataFrame:
    return fc.coherence(probs(spark, d)).select("model", *r6("worst"))


@query
def exceedance(spark: SparkSession, d: str) -> DataFrame:
    return fc.exceedance(acc(spark, d)[1]).select(*fc.CELL, "threshold_mm", *r6("prob"))


@query
def light_products(spark: SparkSession, d: str) -> DataFrame:
    return light(spark, d).select(*fc.CELL, *[F.round(F.col(c).cast("double"), 4).alias(c) for c in ("ens_mean_anomaly", *config.PROBABILITIES, "clim_mean")], F.col("dry_mask").cast("int").alias("dry_mask"))


def _multi(spark: SparkSession, d: str) -> DataFrame:
    products = light(spark, d)
    return fc.multimodel(products, products.select("model").distinct().count())


def _r4(*names: str) -> list[Column]:
    return [F.round(n, 4).alias(n) for n in names]


@query
def multimodel_mean(spark: SparkSession, d: str) -> DataFrame:
    return _multi(spark, d).select("cell_id", "period_id", *_r4("ens_mean_anomaly", *config.PROBABILITIES))


@query
def multimodel_tercile(spark: SparkSession, d: str) -> DataFrame:
    return _multi(spark, d).select("cell_id", "period_id", *_r4("norm_BN", "norm_NN", "norm_AN"))


@query
def multimodel_dry_vote(spark: SparkSession, d: str) -> DataFrame:
    return _multi(spark, d).select("cell_id", "period_id", "dry")


@query
def tercile_summary_class(spark: SparkSession, d: str) -> DataFrame:
    p = probs_and_limits(spark, d)
    c = fc.summary_class(F.col("prob_BN"), F.col("prob_NN"), F.col("prob_AN"))
    return p.select(*fc.CELL, F.when(F.col("dry_mask"), "D").otherwise(c).alias("class"))


# --- verification (cube) ----------------------------------------------------------------------------------------------


@query
def loo_terciles_model(spark: SparkSession, d: str) -> DataFrame:
    return vf.loo_terciles(acc(spark, d)[0], fc.CELL).select(*fc.CELL, "year", *r6("lower", "upper"))


@query
def loo_terciles_obs(spark: SparkSession, d: str) -> DataFrame:
    return vf.loo_terciles(observed(spark, d), ["cell_id", "period_id"]).select("cell_id", "period_id", "year", *r6("lower", "upper"))


@query
def loo_probs(spark: SparkSession, d: str) -> DataFrame:
    return vf.loo_probabilities(acc(spark, d)[0]).select(*fc.CELL, "year", *r6("pBN", "pNN", "pAN"))


@query
def obs_category(spark: SparkSession, d: str) -> DataFrame:
    return vf.observed_category(observed(spark, d)).withColumn("obs_cat", F.col("obs_cat").cast("int"))


@query
def rpss(spark: SparkSession, d: str) -> DataFrame:
    return vf.skill_scores(verification(spark, d)).select(*fc.CELL, *r6("rpss"))


@query
def bss(spark: SparkSession, d: str) -> DataFrame:
    return vf.skill_scores(verification(spark, d)).select(*fc.CELL, *r6("bss_BN", "bss_NN", "bss_AN"))


@query
def roc_area(spark: SparkSession, d: str) -> DataFrame:
    return vf.roc_areas(verification(spark, d)).select(*fc.CELL, *r6("roc_BN", "roc_AN"))


@query
def ens_skill(spark: SparkSession, d: str) -> DataFrame:
    return vf.ensemble_skill(acc(spark, d)[0], observed(spark, d)).select(*fc.CELL, *r6("corr_ens", "rmse_ens"))


@query
def reliability(spark: SparkSession, d: str) -> DataFrame:
    zone = cube_zone(spark, d).filter("in_zone").select("cell_id")
    joined = verification(spark, d).join(zone, "cell_id", "left_semi")
    return vf.reliability(joined, ["model", "period_id"]).select("model", "period_id", "category", "bin", "n", *r6("mean_fcst", "obs_freq"))


@query
def domain_stats(spark: SparkSession, d: str) -> DataFrame:
    zone = cube_zone(spark, d).filter("in_zone").select("cell_id")
    scores = vf.skill_scores(verification(spark, d)).join(zone, "cell_id", "left_semi").withColumn("rpss", F.round("rpss", 9))
    return vf.domain_stats(scores, "rpss", ["model", "period_id"]).select("model", "period_id", *r6("mean", "positive"))


@query
def summary_text(spark: SparkSession, d: str) -> DataFrame:
    v = verification(spark, d)
    scores = vf.skill_scores(v).join(vf.roc_areas(v), fc.CELL).join(vf.ensemble_skill(acc(spark, d)[0], observed(spark, d)), fc.CELL)
    scores = scores.join(cube_zone(spark, d).filter("in_zone"), "cell_id", "left_semi")
    # a billionth settles means that lie halfway between two of the printed digits
    mean = lambda c: F.avg(c) + 1e-9
    stats = scores.groupBy("model", "period_id").agg(mean("rpss").alias("rpss"), mean(F.when(F.round("rpss", 9) > 0, 1.0).otherwise(0.0)).alias("positive"), mean("roc_BN").alias("roc_bn"), mean("roc_AN").alias("roc_an"), mean("corr_ens").alias("corr"))
    return vf.summary_lines(stats.withColumn("label", F.concat_ws(" ", "model", F.col("period_id").cast("string"))))


@query
def multimodel_verification(spark: SparkSession, d: str) -> DataFrame:
    joined = verification(spark, d)
    pairs = vf.multimodel_pairs(joined, joined.select("model").distinct().count())
    keys = ["cell_id", "period_id"]
    return vf.skill_scores(pairs, keys).join(vf.roc_areas(pairs, keys), keys).select(*keys, *r6("rpss", "bss_BN", "bss_NN", "bss_AN", "roc_BN", "roc_AN"))


# --- space ------------------------------------------------------------------------------------------------------------


@query
def polygon_mask(spark: SparkSession, d: str) -> DataFrame:
    return spatial.grid_mask(read(spark, d, "grid"), read(spark, d, "zone_edges"))


@query
def mask_census(spark: SparkSession, d: str) -> DataFrame:
    """Observed cells inside and outside the zones."""
    m = spatial.grid_mask(read(spark, d, "grid"), read(spark, d, "zone_edges"))
    return observations(spark, d).join(m, "cell_id").groupBy("file_id").agg(F.count_if("in_zone").alias("inside"), F.count("*").alias("total"))


@query
def bilinear_regrid(spark: SparkSession, d: str) -> DataFrame:
    """The mean observed amount at each station, between the four cells around it; null where one of them was never observed."""
    mean = observations(spark, d).groupBy("cell_id").agg(F.avg(finite("precip")).alias("m"))
    source = read(spark, d, "grid").join(mean, "cell_id", "left").select("latitude", "longitude", F.col("m").alias("precip"))
    targets = read(spark, d, "stations").groupBy("station").agg(F.min("longitude").alias("longitude"), F.min("latitude").alias("latitude"))
    return spatial.bilinear(source, targets, "station", "precip").select("station", *t6("precip"))


@query
def area_subset(spark: SparkSession, d: str) -> DataFrame:
    """The sites within the area of the forecasts."""
    return spatial.in_box(read(spark, d, "sites"), config.AREA).select("site_id", "longitude", "latitude")


# --- stations ---------------------------------------------------------------------------------------------------------


@query
def station_detect(spark: SparkSession, d: str) -> DataFrame:
    return st.formats(st.fields_of(read(spark, d, "station_lines")))


@query
def station_cdt(spark: SparkSession, d: str) -> DataFrame:
    return st.station_rows(read(spark, d, "station_lines"), "cdt").withColumns({c: F.round(c, 7) for c in ("longitude", "latitude")})


@query
def station_cpt(spark: SparkSession, d: str) -> DataFrame:
    """Yearly amounts of each station written as a CPT file and parsed again."""
    v = F.when(F.col("prcp") >= 0, finite("prcp"))
    years = read(spark, d, "station_obs").filter("station is not null and time is not null").groupBy("station", F.year("time").alias("year")).agg(F.round(F.sum(v) + 1e-9, 2).alias("total"))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    where = read(spark, d, "stations").filter("station is not null").groupBy("station").agg(F.min("longitude").alias("longitude"), F.min("latitude").alias("latitude"))
    heads = where.select("station", F.posexplode(F.array(F.concat(F.lit('STATION,"'), "station", F.lit('"')), F.concat(F.lit("LAT,"), text("latitude")), F.concat(F.lit("LON,"), text("longitude")))).alias("i", "raw"))
    rows = years.join(where, "station", "left_semi").select("station", (F.col("year") + 4).alias("line_no"), F.concat(F.col("year").cast("string"), F.lit(","), text("total")).alias("raw"))
    lines = heads.select("station", (F.col("i") + 1).alias("line_no"), "raw").unionByName(rows)
    return st.station_rows(lines.select(F.col("station").alias("file_name"), "line_no", F.col("line_no").cast("long").alias("line_id"), "raw"), "cpt").select("station", "longitude", "latitude", "time", "prcp")


@query
def station_nudge(spark: SparkSession, d: str) -> DataFrame:
    s = read(spark, d, "stations").select("station", "cadence_h", "longitude", "latitude")
    return st.nudged(st.nudged(s, "longitude", "station", ["cadence_h"]), "latitude", "station", ["cadence_h"]).select("station", *[F.round(c, 7).alias(c) for c in ("longitude", "latitude")])


@query
def station_missing(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "station_obs").withColumn("v", st.not_missing(F.col("prcp")))
    return o.groupBy("station").agg(F.count("*").alias("n"), F.count("v").alias("known"))


# --- time, addresses, labels ------------------------------------------------------------------------------------------


@query
def decode_months_since(spark: SparkSession, d: str) -> DataFrame:
    """Months since 1960 of each day, with the day of the month as a fraction, back to a month."""
    t = F.to_date("time")
    months = (F.year(t) - 1960) * 12 + F.month(t) - 1 + (F.dayofmonth(t) - 1) / F.lit(32.0)
    return read(spark, d, "obs_daily").select("row_id", decode_months(months, F.lit("1960-01-01").cast("date")).alias("month"))


@query
def nmme_valid_time(spark: SparkSession, d: str) -> DataFrame:
    """The month of each step, with leads in half months."""
    lead = F.floor(F.col("step_h") / 720) + 0.5
    return read(spark, d, "fcst_daily").select("fcst_id", F.add_months(F.trunc("init_time", "month"), F.bround(lead - 0.5).cast("int")).alias("valid_month"))


@query
def nmme_url(spark: SparkSession, d: str) -> DataFrame:
    runs = read(spark, d, "fcst_daily").select("model", "init_time", "kind").distinct()
    return runs.select("model", "init_time", "kind", requests.nmme_url_column(F.col("model"), "PRCP", F.col("init_time"), F.upper("kind")).alias("url"))


def _years(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "obs_daily").groupBy("file_id").agg(F.min(F.year("time")).alias("a"), F.max(F.year("time")).alias("b"))


@query
def chirps_url(spark: SparkSession, d: str) -> DataFrame:
    return _years(spark, d).select("file_id", requests.monthly_url_column(config.CHIRPS_SOURCE, F.col("a"), F.col("b")).alias("url"))


@query
def tamsat_url(spark: SparkSession, d: str) -> DataFrame:
    return _years(spark, d).select("file_id", requests.monthly_url_column(config.TAMSAT_SOURCE, F.col("a"), F.col("b")).alias("url"))


@query
def c3s_request(spark: SparkSession, d: str) -> DataFrame:
    """One request per model, kind and initial month."""
    runs = read(spark, d, "fcst_daily").groupBy("model", "kind", F.lpad(F.month("init_time").cast("string"), 2, "0").alias("month")).agg(
        F.concat_ws(",", F.array_sort(F.collect_set(F.year("init_time").cast("string")))).alias("years"), F.concat_ws(",", F.transform(F.array_sort(F.collect_set("step_h")), lambda h: h.cast("string"))).alias("leadtime_hour")
    )
    area = ",".join(str(x) for x in requests.cds_area(config.AREA))
    system = F.create_map(*[F.lit(x) for kv in config.C3S_SYSTEMS.items() for x in kv])[F.col("model")]
    return runs.select(F.col("model").alias("originating_centre"), system.alias("system"), "kind", "month", F.lit("01").alias("day"), "years", "leadtime_hour", F.lit(config.C3S_VARIABLES["PRCP"]).alias("variable"), F.lit("grib").alias("data_format"), F.lit(area).alias("area"))


@query
def era5_request(spark: SparkSession, d: str) -> DataFrame:
    """One request per observed year."""
    area = ",".join(str(x) for x in requests.cds_area(config.AREA))
    months = F.concat_ws(",", F.array_sort(F.collect_set(F.lpad(F.month("time").cast("string"), 2, "0"))))
    return read(spark, d, "obs_daily").groupBy(F.year("time").cast("string").alias("year")).agg(months.alias("months"), F.lit(config.ERA5_VARIABLES["PRCP"]).alias("variable"), F.lit(area).alias("area"))


def _all_periods(spark: SparkSession, d: str) -> DataFrame:
    s = spans(spark, d)
    return pd_.months(s, ["file_id"]).unionByName(pd_.decades(s, ["file_id"])).unionByName(pd_.seasons(s, ["file_id"], window=1)).unionByName(pd_.custom(s, ["file_id"]))


@query
def period_label(spark: SparkSession, d: str) -> DataFrame:
    return _all_periods(spark, d).select("file_id", "type", "start", "end", labels.period_label(F.col("type"), F.col("start"), F.col("end")).alias("title"))


@query
def model_titles(spark: SparkSession, d: str) -> DataFrame:
    """Display name, rows and members of each model."""
    m = read(spark, d, "fcst_daily").groupBy("model").agg(F.count("*").alias("n"), (F.max("number") - F.min("number") + 1).alias("members"))
    return m.select("model", labels.model_title(F.col("model")).alias("title"), "n", "members")


@query
def output_names(spark: SparkSession, d: str) -> DataFrame:
    """Subfolder and safe name of each period."""
    return _all_periods(spark, d).select("file_id", "type", "label", labels.subfolder(F.col("type")).alias("subfolder"), labels.safe_name(F.concat_ws("/", "type", F.concat(F.col("label"), F.lit(" x")))).alias("name"))


@query
def contour_level_bin(spark: SparkSession, d: str) -> DataFrame:
    """Level of the ensemble-mean anomaly (cube)."""
    h, f = acc(spark, d)
    mean = fc.ensemble_mean(fc.anomalies(f, h), "anomaly", fc.CELL)
    return mean.select(*fc.CELL, level_bin(F.round("ens_mean", 6), config.LEVELS["month"]).alias("level"))


def _zoned(df: DataFrame, spark: SparkSession, d: str) -> DataFrame:
    return df.join(cube_zone(spark, d), "cell_id", "left")


@query
def map_layers_probability(spark: SparkSession, d: str) -> DataFrame:
    """Percent of each probability inside the zones where it isn't dry, with its ten-percent bin; null elsewhere (cube)."""
    p = _zoned(probs_and_limits(spark, d), spark, d)
    long = p.select(*fc.CELL, "in_zone", "dry_mask", F.inline(F.array(*[F.struct(F.lit(c).alias("layer"), F.col(c).alias("p")) for c in config.PROBABILITIES])))
    percent = F.when(F.coalesce("in_zone", F.lit(False)) & ~F.col("dry_mask"), F.round(F.col("p") * 100, 6))
    return long.select(*fc.CELL, "layer", percent.alias("percent"), F.when(percent.isNotNull(), F.floor(F.least(percent, F.lit(99.0)) / 10)).cast("double").alias("bin"))


@query
def map_layers_exceedance(spark: SparkSession, d: str) -> DataFrame:
    """Percent at or above each limit inside the zones, dry or not (cube)."""
    e = _zoned(fc.exceedance(acc(spark, d)[1]), spark, d)
    return e.select(*fc.CELL, "threshold_mm", F.when(F.coalesce("in_zone", F.lit(False)), F.round(F.col("prob") * 100, 6)).alias("percent"))


@query
def map_layers_skill(spark: SparkSession, d: str) -> DataFrame:
    s = vf.skill_scores(verification(spark, d))
    return s.select(*fc.CELL, level_bin(F.round("rpss", 6), config.SKILL_LEVELS).alias("level"))


@query
def map_layers_anomaly(spark: SparkSession, d: str) -> DataFrame:
    """Anomaly of each member inside the zones, with its level (cube)."""
    h, f = acc(spark, d)
    a = _zoned(fc.anomalies(f, h), spark, d).withColumn("anomaly", F.when(F.col("in_zone"), F.round("anomaly", 6)))
    return a.select(*fc.CELL, "number", "anomaly", level_bin(F.col("anomaly"), config.LEVELS["month"]).cast("double").alias("level"))


@query
def map_layers_mean(spark: SparkSession, d: str) -> DataFrame:
    """Ensemble-mean anomaly inside the zones, with its level (cube)."""
    m = _zoned(light(spark, d), spark, d).withColumn("mean", F.when(F.col("in_zone"), F.round(F.col("ens_mean_anomaly").cast("double"), 4)))
    return m.select(*fc.CELL, "mean", level_bin(F.col("mean"), config.LEVELS["month"]).cast("double").alias("level"))


@query
def map_layers_dispersion(spark: SparkSession, d: str) -> DataFrame:
    """Members less their ensemble mean inside the zones, with the limit of the colours of each model and period (cube)."""
    h, f = acc(spark, d)
    x = _zoned(fc.dispersion(f, "acc_mm", fc.CELL), spark, d)
    limit = F.greatest(F.lit(1.0), 0.8 * F.max(F.abs("deviation")))
    x = x.join(x.groupBy("model", "period_id").agg(limit.alias("colour_limit")), ["model", "period_id"])
    return x.select(*fc.CELL, "number", F.when(F.col("in_zone"), F.round("deviation", 6)).alias("deviation"), *r6("colour_limit"))


@query
def map_layers_terciles(spark: SparkSession, d: str) -> DataFrame:
    """Outstanding tercile inside the zones, D where it is dry (cube)."""
    p = _zoned(probs_and_limits(spark, d), spark, d)
    c = F.when(F.col("dry_mask"), "D").otherwise(fc.summary_class(F.col("prob_BN"), F.col("prob_NN"), F.col("prob_AN")))
    return p.select(*fc.CELL, F.when(F.col("in_zone"), c).alias("class"))


@query
def multimodel_tercile_panel(spark: SparkSession, d: str) -> DataFrame:
    """Outstanding tercile of each model with that of all models beside it (cube)."""
    named = lambda df, model, p, dry: df.select(model.alias("model"), "cell_id", "period_id", *[F.round(F.col(f"{p}_{k}").cast("double"), 6).alias(k) for k in ("BN", "NN", "AN")], dry.alias("dry"))
    each = named(light(spark, d), F.col("model"), "prob", F.col("dry_mask") == 1)
    both = each.unionByName(named(_multi(spark, d), F.lit("multi_model"), "norm", F.col("dry")))
    return both.select("model", "cell_id", "period_id", F.when(F.coalesce("dry", F.lit(False)), "D").otherwise(fc.summary_class(F.col("BN"), F.col("NN"), F.col("AN"))).alias("class"))


@query
def reliability_diagram(spark: SparkSession, d: str) -> DataFrame:
    """Points of the reliability curves: the bins that hold forecasts, with their share of all (cube)."""
    zone = cube_zone(spark, d).filter("in_zone").select("cell_id")
    bins = vf.reliability(verification(spark, d).join(zone, "cell_id", "left_semi"), ["period_id"]).filter("n > 0")
    whole = bins.groupBy("period_id", "category").agg(F.sum("n").alias("all"))
    return bins.join(whole, ["period_id", "category"]).select("period_id", "category", "bin", "n", *r6("mean_fcst", "obs_freq"), F.round(F.col("n") / F.col("all"), 6).alias("share"))


@query
def multimodel_panel(spark: SparkSession, d: str) -> DataFrame:
    """Ensemble-mean anomalies of the models with that of all models beside them (cube)."""
    each = light(spark, d).select("model", "cell_id", "period_id", F.col("ens_mean_anomaly").cast("double").alias("ens_mean_anomaly"))
    both = each.unionByName(_multi(spark, d).select(F.lit("multi_model").alias("model"), "cell_id", "period_id", "ens_mean_anomaly"))
    return both.select("model", "cell_id", "period_id", *_r4("ens_mean_anomaly"))
