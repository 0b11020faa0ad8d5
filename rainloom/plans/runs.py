"""The forecast run and the verification run, from raw tables to written products.

Raw forecasts are converted to metres, parted into daily amounts and averaged over regions; the periods of each run come from
its own span; hindcasts of the same model, region, initial month and period give the climatology. Products are written by
model and period type, and the combination of models is built from what was written.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from rainloom.functions.expr import known
from rainloom.operators import forecast as fc, nearby, periods as pd_, unify, verify as vf
from rainloom.plans import sql
from rainloom.sources.tables import read, shared_folder, staged, write_partitioned

RUN = ["model", "kind", "init_time", "cell_id"]
ROW = ["file_id", "model", "kind", "number", "init_time", "step_h", "valid_time", "cell_id"]


def region_of_cells(grid: DataFrame, edges: DataFrame) -> DataFrame:
    """(cell_id, region): the zones that hold the centre of each cell; cells in no zone have none."""
    points = grid.select(F.col("cell_id").cast("long").alias("site_id"), "longitude", "latitude")
    return nearby.zones_of(points, edges).select(F.col("site_id").cast("int").alias("cell_id"), F.col("adm0_a3").alias("region"))


def daily_amounts(fcst: DataFrame, attrs: DataFrame) -> DataFrame:
    """(ROW, day, tp_daily): millimetres of each day from the accumulated amounts, whatever their unit; of repeated rows the last received counts."""
    rows = fc.latest(unify.convert_forecast(fcst, attrs).select(*ROW, "tp_m", "received", "fcst_id"), ROW, ["received", "fcst_id"])
    return fc.decumulate(rows, ["file_id", "number", "cell_id"], value="tp_m").select(*ROW, F.to_date("valid_time").alias("day"), "tp_daily")


def over_regions(daily: DataFrame, regions: DataFrame) -> DataFrame:
    """Daily amounts averaged over the cells of each region, which takes the place of the cell."""
    return daily.join(regions, "cell_id").groupBy("model", "kind", "init_time", "number", "day", F.col("region").alias("cell_id")).agg(F.avg(known(F.col("tp_daily"))).alias("tp_daily"))


def run_periods(daily: DataFrame) -> DataFrame:
    """(RUN, type, label, start, end, period_id): the whole months and decades in the span of each run.

    `period_id` holds the type, the initial month and the month-days, 29 February as the 28th, so that runs of all years share it.
    """
    spans = daily.groupBy(*RUN).agg(F.min("day").alias("first"), F.max("day").alias("last"))
    both = pd_.months(spans, RUN).unionByName(pd_.decades(spans, RUN))
    md = lambda c: F.when(F.col(c) == 229, 228).otherwise(F.col(c)).cast("string")
    return both.withColumn("period_id", F.concat_ws("-", "type", F.month("init_time").cast("string"), md("start_md"), md("end_md")))


def accumulated(daily: DataFrame, periods: DataFrame) -> DataFrame:
    """(RUN, number, year, period_id, acc_mm): the amount of each member in each period of its run; missing days count as zero. `year` is that of the start."""
    return fc.accumulate(daily, pd_.days(periods.select(*RUN, "period_id", "start", "end")).select(*RUN, "period_id", "day"), [*RUN, "number"], RUN).withColumn("year", F.year("init_time"))


def forecast_run(acc: DataFrame) -> DataFrame:
    """(model, cell_id, period_id, year, products): each forecast held against the hindcasts of its model, region and period; without hindcasts there is no product."""
    hindcast, forecast = acc.filter("kind = 'hindcast'"), acc.filter("kind = 'forecast'")
    return fc.light_products(forecast, hindcast, ["year"]).withColumn("period_type", F.substring_index("period_id", "-", 1))


def save_products(products: DataFrame, path: str) -> None:
    """Writes products or scores by model and period type."""
    write_partitioned(products, path, ["model", "period_type"])


def load_products(spark: SparkSession, path: str, period_types: Sequence[str] = (), schema: StructType | None = None) -> DataFrame:
    """Saved products, of the given period types only (all if none is given); other folders aren't read. An empty save has no files, so it needs `schema`."""
    saved = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    return saved.filter(F.col("period_type").isin(list(period_types))) if period_types else saved


def multimodel_run(products: DataFrame) -> DataFrame:
    """Equal-weight means over the models that have a product; dry where at least half of the models with products of that period type say so."""
    models = products.groupBy("period_type").agg(F.count_distinct("model").alias("models"))
    # one row per period type
    return fc.multimodel(products.join(F.broadcast(models), "period_type"), F.max("models"), ["year"])


def first_available(fcst: DataFrame, models: Sequence[str]) -> DataFrame:
    """(init_time, model): for each start the first of `models` that has a run; models beyond the list come last, by name."""
    place = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, models)), F.col("model")), F.lit(0)), F.lit(len(models) + 1))
    return fcst.filter("model is not null").groupBy("init_time").agg(F.min_by("model", F.struct(place, "model")).alias("model"))


def observed_periods(obs: DataFrame, attrs: DataFrame, grid: DataFrame, regions: DataFrame, periods: DataFrame) -> DataFrame:
    """(cell_id, period_id, year, acc_mm): observed amounts, averaged over each region, in the periods of the hindcasts; null as soon as a day is missing that was reported."""
    mm = unify.convert_observations(obs, attrs).select("file_id", "time", "latitude", "longitude", "precip_mm", "row_id")
    last = fc.latest(mm, ["file_id", "time", "latitude", "longitude"], ["row_id"]).join(grid.select("cell_id", "latitude", "longitude"), ["latitude", "longitude"]).join(regions, "cell_id")
    daily = last.groupBy(F.col("region").alias("cell_id"), F.to_date("time").alias("day")).agg(F.avg(known(F.col("precip_mm"))).alias("v"))
    wanted = pd_.days(periods.filter("kind = 'hindcast'").select("cell_id", "period_id", F.year("init_time").alias("year"), "start", "end").distinct())
    return fc.accumulate_observed(wanted.join(daily, ["cell_id", "day"]), ["cell_id", "period_id", "year"], "v")


def verification_run(acc: DataFrame, observed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs, scores): leave-one-out probabilities with the observed category of each year, and the scores per model, region and period."""
    hindcast = acc.filter("kind = 'hindcast'")
    pairs = vf.pairs(hindcast, observed)
    scores = vf.skill_scores(pairs).join(vf.roc_areas(pairs), fc.CELL).join(vf.ensemble_skill(hindcast, observed), fc.CELL)
    return pairs, scores


# --- registered queries -----------------------------------------------------------------------------------------------


def _regions(spark: SparkSession, d: str) -> DataFrame:
    return region_of_cells(read(spark, d, "grid"), read(spark, d, "zone_edges"))


def _daily(spark: SparkSession, d: str) -> DataFrame:
    return staged(over_regions(daily_amounts(read(spark, d, "fcst_daily"), read(spark, d, "file_attrs")), _regions(spark, d)))


def _acc(spark: SparkSession, d: str) -> DataFrame:
    daily = _daily(spark, d)
    return staged(accumulated(daily, run_periods(daily)))


def _verified(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    daily = _daily(spark, d)
    periods = run_periods(daily)
    observed = observed_periods(read(spark, d, "obs_daily"), read(spark, d, "file_attrs"), read(spark, d, "grid"), _regions(spark, d), periods)
    return verification_run(staged(accumulated(daily, periods)), staged(observed))


def _digits(*names: str) -> list[Column]:
    return [F.round(F.col(n).cast("double") + 1e-9, 4).alias(n) for n in names]


def run_daily(spark: SparkSession, d: str) -> DataFrame:
    """Daily millimetres of every forecast row."""
    return daily_amounts(read(spark, d, "fcst_daily"), read(spark, d, "file_attrs")).select(*[c for c in ROW if c != "valid_time"], "day", *_digits("tp_daily"))


def run_accumulated(spark: SparkSession, d: str) -> DataFrame:
    return _acc(spark, d).select(*RUN, "number", "period_id", *_digits("acc_mm"))


def run_forecast(spark: SparkSession, d: str) -> DataFrame:
    return forecast_run(_acc(spark, d)).select(*fc.CELL, "year", *_digits("ens_mean_anomaly", *fc.PROBABILITIES, "clim_mean"), F.col("dry_mask").cast("int").alias("dry_mask"))


def run_multimodel(spark: SparkSession, d: str) -> DataFrame:
    """The combination of models from products that were written and read again."""
    path = f"{shared_folder(spark)}/products-{uuid.uuid4().hex}"
    products = forecast_run(_acc(spark, d))
    save_products(products, path)
    return multimodel_run(load_products(spark, path, ("month", "decade"), products.schema)).select("cell_id", "period_id", "year", *_digits("ens_mean_anomaly", "norm_BN", "norm_NN", "norm_AN"), "dry")


def run_pairs(spark: SparkSession, d: str) -> DataFrame:
    return _verified(spark, d)[0].select(*fc.CELL, "year", *_digits("pBN", "pNN", "pAN"), F.col("obs_cat").cast("int").alias("obs_cat"))


def run_scores(spark: SparkSession, d: str) -> DataFrame:
    return _verified(spark, d)[1].select(*fc.CELL, *_digits("rpss", "bss_BN", "bss_NN", "bss_AN", "roc_BN", "roc_AN", "corr_ens", "rmse_ens"))


def run_reliability(spark: SparkSession, d: str) -> DataFrame:
    """Reliability over all regions, by model."""
    return vf.reliability(_verified(spark, d)[0], ["model"]).select("model", "category", "bin", "n", *_digits("mean_fcst", "obs_freq"))


def run_sample(spark: SparkSession, d: str) -> DataFrame:
    """The model that gives the grid and the periods of each start: the first of the list that has a run."""
    return first_available(read(spark, d, "fcst_daily"), ("gavotte", "fentis"))


def zone_outline(spark: SparkSession, d: str) -> DataFrame:
    """The edges of the union of all zones: those that only one polygon has."""
    return dissolved(read(spark, d, "zone_edges"))


def dissolved(edges: DataFrame) -> DataFrame:
    """(x1, y1, x2, y2): the outline of the union of polygons that share whole edges; an edge that two of them have lies inside. Each edge runs from its lesser end; edges with nulls count for nothing."""
    a, b = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))
    ends = edges.dropna(subset=["x1", "y1", "x2", "y2"]).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    return ends.groupBy("a", "b").count().filter("count = 1").select(F.col("a.x").alias("x1"), F.col("a.y").alias("y1"), F.col("b.x").alias("x2"), F.col("b.y").alias("y2"))


QUERIES = {f.__name__: f for f in (run_daily, run_accumulated, run_forecast, run_multimodel, run_pairs, run_scores, run_reliability, run_sample, zone_outline)}
_RUNS = f"""{sql._FC}, {sql._DECUMULATED},
zr as (select distinct cell_id, adm0_a3 region from (select g.cell_id, e.adm0_a3, e.poly_id from grid g join zone_edges e on {sql._INSIDE.format(x='g.longitude', y='g.latitude')} group by all having count(*) % 2 = 1)),
zd as (select model, kind, init_time, number, region cell_id, cast(valid_time as date) as day, avg(tp_daily) v from dd join zr using (cell_id) group by all),
spans as (select model || '|' || kind || '|' || strftime(init_time, '%Y%m%d%H') || '|' || cell_id as file_id, model, kind, init_time, cell_id, min(day) as first, max(day) as last from zd group by all),
{sql._MONTHS}, per as ({sql._M} union all {sql._D}),
ruled as (select s.model, s.kind, s.init_time, s.cell_id, "start", "end", type || '-' || month(init_time) || '-' || case when start_md = 229 then 228 else start_md end || '-' || case when end_md = 229 then 228 else end_md end period_id from per join spans s using (file_id)),
members as (select distinct model, kind, init_time, cell_id, number from zd),
acc as (select m.model, m.kind, m.init_time, m.cell_id, m.number, cast(year(m.init_time) as int) as year, p.period_id, coalesce(sum(z.v), 0.0e0) acc_mm from members m join ruled p on p.model = m.model and p.kind = m.kind and p.init_time = m.init_time and p.cell_id = m.cell_id
  left join zd z on z.model = m.model and z.kind = m.kind and z.init_time = m.init_time and z.cell_id = m.cell_id and z.number = m.number and z.day between p."start" and p."end" group by all),
h as (select * exclude (kind, init_time) from acc where kind = 'hindcast'), f as (select * exclude (kind, init_time) from acc where kind = 'forecast')"""
_SEEN = f"""{_RUNS}, {sql._OB_ROWS},
od as (select region cell_id, cast(time as date) as day, avg(case when not isnan(precip) then precip end) v from ob join zr using (cell_id) group by all),
o as (select w.cell_id, period_id, year, case when count(*) = count(v) then sum(v) end acc_mm from (select distinct cell_id, period_id, cast(year(init_time) as int) as year, "start", "end" from ruled where kind = 'hindcast') w join od on od.cell_id = w.cell_id and day between "start" and "end" group by all)"""
_K = sql._KEYS
_R4 = lambda *names: ", ".join(f'round(cast("{n}" as double) + 1e-9, 4) "{n}"' for n in names)
_PAIRS, _ALL = sql._loo(_SEEN), sql._skill(sql._loo(_SEEN))

ORACLE: dict[str, str] = {
    "run_daily": f"with {sql._FC}, {sql._DECUMULATED} select file_id, model, kind, number, init_time, step_h, cell_id, cast(valid_time as date) as day, {_R4('tp_daily')} from dd",
    "run_accumulated": f"with {_RUNS} select model, kind, init_time, cell_id, number, period_id, {_R4('acc_mm')} from acc",
    "run_forecast": f"with {sql._light(_RUNS, ', year')} select {_K}, year, {_R4('ens_mean_anomaly', *fc.PROBABILITIES, 'clim_mean')}, dry_mask from light",
    "run_multimodel": f"""with {sql._light(_RUNS, ', year')}, n as (select *, "prob_BN"+"prob_NN"+"prob_AN" w from multi), s as (select *, {', '.join(f'"prob_{k}"/case when w = 0 then 1 else w end "norm_{k}"' for k in ('BN', 'NN', 'AN'))} from n)
select cell_id, period_id, year, {_R4('ens_mean_anomaly', 'norm_BN', 'norm_NN', 'norm_AN')}, dry from s""",
    "run_pairs": f'with {_PAIRS} select {_K}, year, round(p0 + 1e-9, 4) "pBN", round(p1 + 1e-9, 4) "pNN", round(p2 + 1e-9, 4) "pAN", obs_cat from pairs',
    "run_scores": f"with {_ALL}, s as ({sql._scores('pairs', _K)}), r as ({sql._roc('pairs', _K)}) select {_K}, {_R4('rpss', 'bss_BN', 'bss_NN', 'bss_AN', 'roc_BN', 'roc_AN', 'corr_ens', 'rmse_ens')} from s join r using ({_K}) join skill using ({_K})",
    "run_reliability": f"""with {_PAIRS}, l as (select model, 'BN' category, p0 p, case when obs_cat=0 then 1.0e0 else 0.0e0 end e from pairs union all select model, 'NN', p1, case when obs_cat=1 then 1.0e0 else 0.0e0 end from pairs union all select model, 'AN', p2, case when obs_cat=2 then 1.0e0 else 0.0e0 end from pairs),
b as (select cast(i as int) bin, i*0.1e0 lo, (i+1)*0.1e0 hi from range(0,10) r(i)), k as (select distinct model, category from l)
select k.model, k.category, b.bin, count(l.p) n, round(avg(l.p) + 1e-9, 4) mean_fcst, round(avg(l.e) + 1e-9, 4) obs_freq from k cross join b left join l on l.model = k.model and l.category = k.category and l.p >= b.lo and (l.p < b.hi or (b.bin = 9 and l.p <= 1.0e0)) group by all""",
    "run_sample": "select init_time, arg_min(model, (case model when 'gavotte' then 1 when 'fentis' then 2 else 3 end) || model) as model from fcst_daily group by 1",
    "zone_outline": """with e as (select case when (x1, y1) < (x2, y2) then (x1, y1, x2, y2) else (x2, y2, x1, y1) end r from zone_edges), u as (select r from e group by r having count(*) = 1) select r[1] x1, r[2] y1, r[3] x2, r[4] y2 from u""",
}
