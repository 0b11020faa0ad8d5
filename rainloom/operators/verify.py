"""Leave-one-out verification of hindcasts against observations.

`hindcast` is a dense `acc` table, `observed` has (cell_id, period_id, year, acc_mm) with null or NaN for missing sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rainloom.functions.expr import flag, known, quantile

CELL = ["model", "cell_id", "period_id"]
BINS = 10


def loo_terciles(acc: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, year, lower, upper): terciles of the values of all other years.

    A group (years times members) stays one row; the terciles of all its years are taken there from its sorted array, so nothing is joined.
    """
    entry = F.struct(known(F.col("acc_mm")).alias("v"), "year")
    pooled = acc.groupBy(*keys).agg(F.collect_list(entry).alias("all"))
    held = pooled.select(*keys, F.array_distinct(F.col("all.year")).alias("years"), F.array_sort(F.filter("all", lambda x: x["v"].isNotNull())).alias("known"))
    others = F.transform("years", lambda y: F.struct(y.alias("year"), F.transform(F.filter("known", lambda x: x["year"] != y), lambda x: x["v"]).alias("o")))
    limits = F.transform(others, lambda z: F.struct(z["year"].alias("year"), quantile(z["o"], F.lit(1 / 3)).alias("lower"), quantile(z["o"], F.lit(2 / 3)).alias("upper")))
    return held.select(*keys, F.inline(limits))


def loo_probabilities(hindcast: DataFrame) -> DataFrame:
    """(keys, year, pBN, pNN, pAN); what is neither below nor above counts as near normal."""
    joined = hindcast.join(loo_terciles(hindcast, CELL), [*CELL, "year"])
    p = joined.groupBy(*CELL, "year").agg(F.avg(flag(known(F.col("acc_mm")) < F.col("lower"))).alias("pBN"), F.avg(flag(known(F.col("acc_mm")) > F.col("upper"))).alias("pAN"))
    return p.select(*CELL, "year", "pBN", (F.lit(1.0) - F.col("pBN") - F.col("pAN")).alias("pNN"), "pAN")


def observed_category(observed: DataFrame) -> DataFrame:
    """(cell_id, period_id, year, obs_cat): 0 below, 1 near, 2 above normal by the terciles of the other years; missing counts as 1."""
    keys = ["cell_id", "period_id"]
    limits = observed.select(*keys, "year", "acc_mm").join(loo_terciles(observed, keys), [*keys, "year"], "left")
    cat = F.when(known(F.col("acc_mm")) < F.col("lower"), 0).when(known(F.col("acc_mm")) > F.col("upper"), 2).otherwise(1)
    return limits.select(*keys, "year", cat.cast("tinyint").alias("obs_cat"))


def pairs(hindcast: DataFrame, observed: DataFrame) -> DataFrame:
    """`loo_probabilities` with the observed category of the year."""
    return loo_probabilities(hindcast).join(observed_category(observed), ["cell_id", "period_id", "year"])


def _brier(p: Column, e: Column) -> Column:
    return 1 - F.avg((p - e) * (p - e)) / F.avg((F.lit(1 / 3) - e) * (F.lit(1 / 3) - e))


def skill_scores(joined: DataFrame, keys: list[str] = CELL) -> DataFrame:
    """RPSS and the three Brier skill scores against a constant climatology, in one aggregate."""
    c1, c2 = flag(F.col("obs_cat") <= 0), flag(F.col("obs_cat") <= 1)
    f1, f2 = F.col("pBN"), F.col("pBN") + F.col("pNN")
    rps = lambda a, b: F.avg(((a - c1) * (a - c1) + (b - c2) * (b - c2)) / 2)
    return joined.groupBy(*keys).agg(
        (1 - rps(f1, f2) / rps(F.lit(1 / 3), F.lit(2 / 3))).alias("rpss"),
        *[_brier(F.col(f"p{k}"), flag(F.col("obs_cat") == i)).alias(f"bss_{k}") for i, k in enumerate(("BN", "NN", "AN"))],
    )


def roc_areas(joined: DataFrame, keys: list[str] = CELL) -> DataFrame:
    """ROC area of below and above normal; equal probabilities stay in the order of years, null unless both classes occur."""

    def area(k: str, category: int) -> tuple[Column, Column, Column]:
        w = Window.partitionBy(*keys).orderBy(F.desc(f"p{k}"), "year").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        e = flag(F.col("obs_cat") == category)
        return e.alias(f"e{k}"), F.sum(e).over(w).alias(f"c{k}"), F.col(f"p{k}")

    cols = [c for k, i in (("BN", 0), ("AN", 2)) for c in area(k, i)[:2]]
    out = [
        F.when((F.sum(f"e{k}") > 0) & (F.sum(f"e{k}") < F.count("*")), F.sum(F.when(F.col(f"e{k}") == 0, F.col(f"c{k}")).otherwise(0.0)) / (F.sum(f"e{k}") * (F.count("*") - F.sum(f"e{k}")))).alias(f"roc_{k}")
        for k in ("BN", "AN")
    ]
    return joined.select(*keys, *cols).groupBy(*keys).agg(*out)


def ensemble_skill(hindcast: DataFrame, observed: DataFrame) -> DataFrame:
    """Correlation of anomalies from each series' own mean and RMSE of the ensemble mean; null for a constant series."""
    ens = hindcast.groupBy(*CELL, "year").agg(F.avg(known(F.col("acc_mm"))).alias("e"))
    w = Window.partitionBy(*CELL)
    x = ens.join(observed.select("cell_id", "period_id", "year", known(F.col("acc_mm")).alias("o")), ["cell_id", "period_id", "year"])
    x = x.withColumns({"ea": F.col("e") - F.avg("e").over(w), "oa": F.col("o") - F.avg("o").over(w)})
    den = F.sqrt(F.sum(F.col("ea") * F.col("ea")) * F.sum(F.col("oa") * F.col("oa")))
    return x.groupBy(*CELL).agg(F.try_divide(F.sum(F.col("ea") * F.col("oa")), den).alias("corr_ens"), F.sqrt(F.avg((F.col("e") - F.col("o")) * (F.col("e") - F.col("o")))).alias("rmse_ens"))


def reliability(joined: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, category, bin, mean_fcst, obs_freq, n): ten bins [lo, hi) with the last one closed; empty bins have n = 0.

    Bin edges are i * 0.1 in floating point; a probability below 0 is in no bin.
    """
    long = joined.select(*keys, F.inline(F.array(*[F.struct(F.lit(k).alias("category"), F.col(f"p{k}").alias("p"), flag(F.col("obs_cat") == i).alias("e")) for i, k in enumerate(("BN", "NN", "AN"))])))
    place = F.lit(None).cast("int")
    for i in range(BINS):
        inside = (F.col("p") >= i * 0.1) & ((F.col("p") <= 1.0) if i == BINS - 1 else (F.col("p") < (i + 1) * 0.1))
        place = F.when(inside, i).otherwise(place)
    sums = long.withColumn("bin", place).groupBy(*keys, "category", "bin").agg(F.avg("p").alias("mean_fcst"), F.avg("e").alias("obs_freq"), F.count("*").alias("n"))
    frame = long.select(*keys, "category").distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(BINS - 1))))
    return frame.join(sums, [*keys, "category", "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def domain_stats(scores: DataFrame, score: str, keys: list[str]) -> DataFrame:
    """Unweighted mean of the known values of a score and the share above zero."""
    return scores.groupBy(*keys).agg(F.avg(score).alias("mean"), F.avg(F.when(F.col(score).isNotNull(), flag(F.col(score) > 0))).alias("positive"))


def multimodel_pairs(joined: DataFrame, models: int) -> DataFrame:
    """Mean probabilities of all models, renormalised; a year and cell counts only if every model has it. Rounded to 12 digits, so that equal means stay equal whatever the order of their sums."""
    keys = ["cell_id", "period_id", "year"]
    means = joined.groupBy(*keys).agg(F.count("*").alias("n"), F.min("obs_cat").alias("obs_cat"), *[F.avg(f"p{k}").alias(f"m{k}") for k in ("BN", "NN", "AN")]).filter(F.col("n") == models)
    whole = F.col("mBN") + F.col("mNN") + F.col("mAN")
    scale = F.when(whole == 0, 1.0).otherwise(whole)
    return means.select(*keys, "obs_cat", *[F.round(F.col(f"m{k}") / scale, 12).alias(f"p{k}") for k in ("BN", "NN", "AN")])


def summary_lines(stats: DataFrame) -> DataFrame:
    """One text line per row of (label, rpss, positive, roc_bn, roc_an, corr)."""
    return stats.select("label", F.format_string("%-40s  %8.3f  %7.1f%%  %9.3f  %9.3f  %8.3f", "label", "rpss", F.col("positive") * 100, "roc_bn", "roc_an", "corr").alias("line"))
