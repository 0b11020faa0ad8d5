"""Daily amounts, accumulation over periods, climatology, thresholds, probabilities and their combination over models.

Tables are tidy: one row per coordinate tuple. `acc` tables have (model, cell_id, period_id, number, year, acc_mm) and are
dense: a missing amount counts as zero, and every member counts in a denominator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rainloom.config import DRY_MM, EXCEEDANCE_MM, PROBABILITIES
from rainloom.functions.expr import flag, in_season, known, quantile, strict_total, total

CELL = ["model", "cell_id", "period_id"]
QUANTILES = {"tercile_lower": (1, 3), "tercile_upper": (2, 3), "quintile_lower": (1, 5), "quintile_upper": (4, 5), "median": (1, 2)}


def latest(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """The last of repeated rows, by the order of `by`."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*by)).alias("r")).select(*keys, "r.*")


def decumulate(df: DataFrame, series: list[str], step: str = "step_h", value: str = "tp", out: str = "tp_daily", width: int = 24, scale: float = 1000.0, clip: bool = True) -> DataFrame:
    """`out`: the difference of `value` (times `scale`) from one step to the next.

    The first step keeps its amount, or is 0 at step 0. After an absent or missing step the difference is missing. Negative
    differences become 0 if `clip`; missing ones stay null, NaN counts as null.
    """
    w = Window.partitionBy(*series).orderBy(step)
    x = known(F.col(value)) * scale
    gap = F.col(step) - F.lag(step).over(w)
    diff = F.when(F.row_number().over(w) == 1, F.when(F.col(step) == 0, 0.0).otherwise(x)).when(gap == width, x - F.lag(x).over(w))
    result = df.withColumn(out, diff)
    return result.withColumn(out, F.when(F.col(out) < 0, 0.0).otherwise(F.col(out))) if clip else result


def accumulate(daily: DataFrame, period_days: DataFrame, keys: list[str], on: list[str], value: str = "tp_daily", day: str = "day") -> DataFrame:
    """Sum of `value` per `keys` and period, 0 where there is nothing, and `n_known`, how many values it holds; `period_days` has one row per period and day."""
    ids = [c for c in period_days.columns if c not in (*on, "day")]
    frame = daily.select(*keys).distinct().join(period_days.select(*on, *ids).distinct(), on)
    sums = daily.join(period_days.withColumnRenamed("day", day), [*on, day]).groupBy(*keys, *ids).agg(F.sum(known(F.col(value))).alias("s"), F.count(known(F.col(value))).alias("n"))
    return frame.join(sums, [*dict.fromkeys([*keys, *ids])], "left").select(*frame.columns, F.coalesce("s", F.lit(0.0)).alias("acc_mm"), F.coalesce("n", F.lit(0)).alias("n_known"))


def accumulate_seasons(daily: DataFrame, seasons: dict[str, tuple[int, int]], keys: list[str], value: str = "tp_daily", day: str = "day") -> DataFrame:
    """Sum of `value` per `keys` and season, given as month-days (start, end); a start after the end runs over the turn of the year."""
    every = F.explode(F.array(*[F.struct(F.lit(n).alias("season"), F.lit(a).alias("a"), F.lit(b).alias("b")) for n, (a, b) in seasons.items()])).alias("p")
    hit = F.when(in_season(F.col(day), F.col("p.a"), F.col("p.b")), known(F.col(value)))
    return daily.select(*keys, day, value, every).groupBy(*keys, "p.season").agg(total(hit).alias("acc_mm"))


def accumulate_observed(obs: DataFrame, keys: list[str], value: str = "precip") -> DataFrame:
    """Sum per `keys`, null as soon as a value is missing."""
    return obs.withColumn("v", known(F.col(value))).groupBy(*keys).agg(strict_total(F.col("v")).alias("acc_mm"))


def dense(daily: DataFrame, members: list[int], years: list[int], periods: list[int]) -> DataFrame:
    """`acc` from (model, cell_id, number, year, period_id, tp_daily): every member, year and period of each model and cell."""
    lit = lambda xs: F.explode(F.array(*[F.lit(x) for x in xs]))
    frame = daily.select("model", "cell_id").distinct().withColumn("number", lit(members)).withColumn("year", lit(years)).withColumn("period_id", lit(periods))
    keys = ["model", "cell_id", "number", "year", "period_id"]
    sums = daily.groupBy(*keys).agg(F.sum(known(F.col("tp_daily"))).alias("s"))
    return frame.join(sums, keys, "left").select(*keys, F.coalesce("s", F.lit(0.0)).alias("acc_mm"))


def climatology(hindcast: DataFrame) -> DataFrame:
    return hindcast.groupBy(*CELL).agg(F.avg(known(F.col("acc_mm"))).alias("clim_mean"))


def anomalies(forecast: DataFrame, hindcast: DataFrame) -> DataFrame:
    """Each member less the mean over all members and years."""
    return forecast.join(climatology(hindcast), CELL).withColumn("anomaly", F.col("acc_mm") - F.col("clim_mean"))


def thresholds(hindcast: DataFrame) -> DataFrame:
    """Exact linear quantiles of the pooled members and years, the mean, and whether it is dry. A group holds years times members."""
    pooled = hindcast.groupBy(*CELL).agg(F.array_sort(F.collect_list(known(F.col("acc_mm")))).alias("v"), F.avg(known(F.col("acc_mm"))).alias("clim_mean"))
    p = lambda a, b: F.lit(a / b)
    return pooled.select(*CELL, *[quantile(F.col("v"), p(*q)).alias(n) for n, q in QUANTILES.items()], "clim_mean", F.coalesce(F.col("clim_mean") < DRY_MM, F.lit(False)).alias("dry_mask"))


def probabilities(forecast: DataFrame, limits: DataFrame, also: list[str] | None = None) -> DataFrame:
    """Shares of members below, within and above the thresholds; missing members count in the denominator only. `also` parts forecasts beyond CELL."""
    return forecast.join(limits, CELL).groupBy(*CELL, *(also or [])).agg(*_shares())


def _shares() -> list[Column]:
    v, n = known(F.col("acc_mm")), F.count("*")
    share = lambda c: F.sum(flag(c)) / n
    return [
        share(v < F.col("tercile_lower")).alias("prob_BN"),
        share((v >= F.col("tercile_lower")) & (v <= F.col("tercile_upper"))).alias("prob_NN"),
        share(v > F.col("tercile_upper")).alias("prob_AN"),
        share(v < F.col("quintile_lower")).alias("prob_low20"),
        share(v > F.col("quintile_upper")).alias("prob_high20"),
        share(v > F.col("median")).alias("prob_exceed_median"),
    ]


def coherence(probs: DataFrame) -> DataFrame:
    """The largest departure of the three tercile probabilities from a sum of 1, per model."""
    return probs.groupBy("model").agg(F.max(F.abs(F.col("prob_BN") + F.col("prob_NN") + F.col("prob_AN") - 1)).alias("worst"))


def exceedance(forecast: DataFrame, limits_mm: tuple[int, ...] = EXCEEDANCE_MM, keys: list[str] = CELL) -> DataFrame:
    """Share of members at or above each limit; the limits are unfolded after the aggregation."""
    shares = forecast.groupBy(*keys).agg(F.array(*[F.struct(F.lit(t).alias("threshold_mm"), (F.sum(flag(known(F.col("acc_mm")) >= t)) / F.count("*")).alias("prob")) for t in sorted(limits_mm)]).alias("e"))
    return shares.select(*keys, F.inline("e"))


def ensemble_mean(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(known(F.col(value))).alias("ens_mean"))


def dispersion(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Each member less the mean of its ensemble."""
    return df.withColumn("deviation", known(F.col(value)) - F.avg(known(F.col(value))).over(Window.partitionBy(*keys)))


def light_products(forecast: DataFrame, hindcast: DataFrame, also: list[str] | None = None) -> DataFrame:
    """Ensemble-mean anomaly, the six probabilities, the climatology and the dry mask in single precision, in one pass over the forecasts."""
    keys, limits = [*CELL, *(also or [])], thresholds(hindcast)
    joined = forecast.join(limits, CELL)
    anomaly = F.avg(F.col("acc_mm") - F.col("clim_mean")).alias("ens_mean_anomaly")
    joined = joined.groupBy(*keys, "clim_mean", "dry_mask").agg(anomaly, *_shares())
    return joined.select(*keys, *[F.col(c).cast("float").alias(c) for c in ("ens_mean_anomaly", *PROBABILITIES, "clim_mean")], F.col("dry_mask").cast("tinyint").alias("dry_mask"))


def summary_class(below: Column, near: Column, above: Column) -> Column:
    """A, B or N where that tercile stands out, W (white) elsewhere."""
    strong = lambda p: F.coalesce(p, F.lit(False))
    return (
        F.when(strong((above > 0.38) & ((below < 0.33) | (near > 0.33))), "A")
        .when(strong((below > 0.38) & ((above < 0.33) | (near > 0.33))), "B")
        .when(strong((near > 0.38) & (above < 0.33) & (below < 0.33)), "N")
        .otherwise("W")
    )


def multimodel(light: DataFrame, models: int | Column, also: list[str] | None = None) -> DataFrame:
    """Equal-weight means over models that skip missing ones, terciles renormalised to 1, and a majority vote on dryness among `models`, a number or an aggregate (ties are dry)."""
    keys = ["cell_id", "period_id", *(also or [])]
    models = models if isinstance(models, Column) else F.lit(models)
    means = light.groupBy(*keys).agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in ("ens_mean_anomaly", *PROBABILITIES)], (F.sum(F.col("dry_mask").cast("int")) >= models / 2).alias("dry"))
    whole = F.col("prob_BN") + F.col("prob_NN") + F.col("prob_AN")
    scale = F.when(whole == 0, 1.0).otherwise(whole)
    return means.withColumns({f"norm_{k}": F.col(f"prob_{k}") / scale for k in ("BN", "NN", "AN")})
