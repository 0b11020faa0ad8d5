"""Calendar periods: months, decades (ten days), rolling seasons and custom periods."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rainloom.config import SEASON_MONTHS

COLUMNS = ["type", "label", "start", "end", "start_md", "end_md", "n_days"]


def _rows(df: DataFrame, keys: list[str], kind: str) -> DataFrame:
    md = lambda c: F.month(c) * 100 + F.dayofmonth(c)
    return df.filter("start <= end").select(*keys, F.lit(kind).alias("type"), "label", "start", "end", md("start").alias("start_md"), md("end").alias("end_md"), (F.datediff("end", "start") + 1).alias("n_days"))


def _months(spans: DataFrame) -> DataFrame:
    return spans.filter("first <= last").withColumn("m", F.explode(F.expr("sequence(trunc(first, 'MM'), last, interval 1 month)")))


def _ended(df: DataFrame, partial_last: bool) -> DataFrame:
    return df.withColumn("end", F.least("end", "last")) if partial_last else df.filter("end <= last")


def months(spans: DataFrame, keys: list[str], partial_last: bool = False) -> DataFrame:
    """Calendar months of each span (`first`, `last`); the first starts with the span, an unfinished last is left out unless wanted."""
    m = _months(spans).select(*keys, "last", F.date_format("m", "yyyy-MM").alias("label"), F.greatest("m", "first").alias("start"), F.last_day("m").alias("end"))
    return _rows(_ended(m, partial_last), keys, "month")


def decades(spans: DataFrame, keys: list[str], partial_last: bool = False) -> DataFrame:
    """Days 1-10, 11-20 and 21-end of each month."""
    m = _months(spans).withColumn("d", F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(f"D{i}").alias("tag")) for i, (a, b) in enumerate(((1, 10), (11, 20), (21, 0)), 1)])))
    start = F.date_add("m", F.col("d.a") - 1)
    end = F.when(F.col("d.b") == 0, F.last_day("m")).otherwise(F.date_add("m", F.col("d.b") - 1))
    m = m.select(*keys, "last", F.concat(F.date_format("m", "yyyy-MM-"), "d.tag").alias("label"), F.greatest(start, F.col("first")).alias("start"), end.alias("end"))
    return _rows(_ended(m, partial_last), keys, "decade")


def seasons(spans: DataFrame, keys: list[str], window: int = SEASON_MONTHS, partial_last: bool = False) -> DataFrame:
    """Periods of `window` months from the start of the span and from each later month."""
    m = _months(spans).select(*keys, "last", F.greatest("m", "first").alias("start"), F.last_day(F.add_months("m", window - 1)).alias("end"))
    m = _ended(m, partial_last)
    return _rows(m.withColumn("label", F.concat_ws("_to_", F.col("start").cast("string"), F.col("end").cast("string"))), keys, "season")


def custom(spans: DataFrame, keys: list[str]) -> DataFrame:
    """One period per span; a span that ends before it starts raises when it is evaluated."""
    checked = spans.withColumn("last", F.when(F.col("last") >= F.col("first"), F.col("last")).otherwise(F.raise_error("a custom period must not end before it starts").cast("date")))
    return _rows(checked.select(*keys, F.concat_ws("_to_", F.col("first").cast("string"), F.col("last").cast("string")).alias("label"), F.col("first").alias("start"), F.col("last").alias("end")), keys, "custom")


def spans_of(forecasts: DataFrame, keys: list[str], max_end: str | None = None) -> DataFrame:
    """(keys, first, last): the span of valid days, cut at `max_end`."""
    last = F.max(F.to_date("valid_time"))
    return forecasts.groupBy(*keys).agg(F.min(F.to_date("valid_time")).alias("first"), (F.least(last, F.lit(max_end).cast("date")) if max_end else last).alias("last"))


def days(periods: DataFrame) -> DataFrame:
    """Each period once per day it holds (at most a few hundred)."""
    return periods.withColumn("day", F.explode(F.sequence("start", "end")))
