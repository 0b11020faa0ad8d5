"""Quantities recorded in different units: the unit of each value and its conversion to one unit per field (problem 3).

The unit of a value is, in this order: what the remark of its row states, what the texts of its file state (units
attribute, then note, then long name), and the unit that agrees with the size of the file's values. Texts are read by the
grammar in `functions.units`, which represents a unit as an exponent vector with a scale.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from rainloom.functions import units

COMMON = {"tp": "m", "tp_daily": "mm", "precip": "mm"}
#: Median size in mm of positive values per field, used only where no file of the field states a unit.
TYPICAL_MM = {"tp": 48.0, "tp_daily": 2.5, "precip": 2.5}


def _attribute(text: pd.Series) -> pd.Series:
    return text.map(units.attribute, na_action="ignore")


def _statement(text: pd.Series) -> pd.Series:
    return text.map(units.statement, na_action="ignore")


def unit_of_attribute(column: str) -> Column:
    return F.pandas_udf(_attribute, "string")(column)


def unit_of_statement(column: str) -> Column:
    return F.pandas_udf(_statement, "string")(column)


def factor_column(unit: Column) -> Column:
    """Millimetres in one `unit`; null for an unknown name."""
    return F.create_map(*[x for u in units.CANONICAL for x in (F.lit(u), F.lit(units.factor(u)))])[unit]


def stated_units(attrs: DataFrame) -> DataFrame:
    """(file_id, field, stated): the unit that a file's texts state, null where they state none.

    Repeated attribute rows agree as a rule; otherwise the first name in alphabetical order holds. Null and empty texts state nothing.
    """
    return (
        attrs.select("file_id", "field", unit_of_attribute("units").alias("u"), unit_of_statement("note").alias("n"), unit_of_statement("long_name").alias("t"))
        .groupBy("file_id", "field")
        .agg(F.coalesce(F.min("u"), F.min("n"), F.min("t")).alias("stated"))
    )


def file_units(sizes: DataFrame, attrs: DataFrame) -> DataFrame:
    """(file_id, field, unit) for each (file_id, field, size), `size` being the median of the file's positive values or null.

    Where no text tells the unit, it is the one that brings `size` nearest to the usual size of the field over the files
    that state theirs; a file without texts and positive values is taken to be in the common unit.
    """
    known = sizes.join(stated_units(attrs), ["file_id", "field"], "left").withColumn("log_mm", F.log10(F.col("size") * factor_column(F.col("stated"))))
    usual = known.filter("log_mm is not null").groupBy("field").agg(F.percentile_approx("log_mm", 0.5, 1000).alias("usual"))
    default = F.create_map(*[x for f, v in TYPICAL_MM.items() for x in (F.lit(f), F.lit(math.log10(v)))])
    guess = F.array_min(
        F.array(*[F.struct(F.abs(F.log10("size") + math.log10(units.factor(u)) - F.coalesce("usual", default[F.col("field")])).alias("d"), F.lit(u).alias("u")) for u in units.CANONICAL])
    )["u"]
    common = F.create_map(*[F.lit(x) for p in COMMON.items() for x in p])
    # one row per field, at most as many as there are fields
    return known.join(F.broadcast(usual), "field", "left").select("file_id", "field", F.coalesce("stated", F.when(F.col("size").isNotNull(), guess), common[F.col("field")]).alias("unit"))


def _positive(c: str) -> Column:
    return F.when((F.col(c) > 0) & (F.col(c) < math.inf), F.col(c))


def forecast_units(fcst: DataFrame, attrs: DataFrame) -> DataFrame:
    """(file_id, tp_unit, tp_daily_unit)."""
    sizes = fcst.groupBy("file_id").agg(F.percentile_approx(_positive("tp"), 0.5, 200).alias("tp"), F.percentile_approx(_positive("tp_daily"), 0.5, 200).alias("tp_daily"))
    long = sizes.select("file_id", F.expr("stack(2, 'tp', tp, 'tp_daily', tp_daily) as (field, size)"))
    found = file_units(long, attrs)
    pick = lambda f: F.min(F.when(F.col("field") == f, F.col("unit"))).alias(f"{f}_unit")
    return found.groupBy("file_id").agg(pick("tp"), pick("tp_daily"))


def convert_forecast(fcst: DataFrame, attrs: DataFrame) -> DataFrame:
    """`fcst` with `tp_unit`, `tp_daily_unit`, `tp_m` and `tp_daily_mm`, in place of columns of these names. Nulls and NaN stay; every row is kept."""
    mm = lambda c: F.col(c) * factor_column(F.col(f"{c}_unit"))
    return fcst.drop("tp_unit", "tp_daily_unit").join(forecast_units(fcst, attrs), "file_id", "left").withColumns({"tp_m": mm("tp") / 1000.0, "tp_daily_mm": mm("tp_daily")})


def convert_observations(obs: DataFrame, attrs: DataFrame) -> DataFrame:
    """`obs` with `precip_unit` and `precip_mm`, in place of columns of these names; a remark on the unit of its value outranks the file."""
    noted = obs.drop("precip_unit", "precip_mm").withColumn("_noted_unit", F.when(F.col("remark").isNotNull(), unit_of_statement("remark")))
    # remarks about other things don't tell against the value
    sizes = noted.filter("_noted_unit is null").groupBy("file_id").agg(F.percentile_approx(_positive("precip"), 0.5, 200).alias("size"))
    known = file_units(obs.select("file_id").distinct().join(sizes, "file_id", "left").select("file_id", F.lit("precip").alias("field"), "size"), attrs).select("file_id", F.col("unit").alias("_file_unit"))
    return (
        noted.join(known, "file_id", "left")
        .withColumn("precip_unit", F.coalesce("_noted_unit", "_file_unit"))
        .withColumn("precip_mm", F.col("precip") * factor_column(F.col("precip_unit")))
        .drop("_noted_unit", "_file_unit")
    )


def other_units(fcst: DataFrame, obs: DataFrame, attrs: DataFrame) -> DataFrame:
    """(tbl, field, row_id, unit) of each value, neither null nor NaN, recorded in another unit than the common one."""
    f = convert_forecast(fcst, attrs).select(
        F.lit("fcst_daily").alias("tbl"), F.expr("stack(2, 'tp', tp, tp_unit, 'tp_daily', tp_daily, tp_daily_unit) as (field, value, unit)"), F.col("fcst_id").alias("row_id")
    )
    o = convert_observations(obs, attrs).select(F.lit("obs_daily").alias("tbl"), F.lit("precip").alias("field"), F.col("precip").alias("value"), F.col("precip_unit").alias("unit"), F.col("row_id"))
    common = F.create_map(*[F.lit(x) for p in COMMON.items() for x in p])
    return f.unionByName(o).filter(F.col("value").isNotNull() & ~F.isnan("value") & (F.col("unit") != common[F.col("field")])).select("tbl", "field", F.col("row_id").cast("long").alias("row_id"), "unit")
