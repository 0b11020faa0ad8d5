"""Station files (CDT and CPT tables): detection, parsing and loading of folders."""

from __future__ import annotations

import glob
import os
import warnings
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rainloom.functions import automaton
from rainloom.operators.rawlines import _DELIM
from rainloom.sources.tables import broadcast_if_small, staged

MISSING_MARKS = (-999.0, -99.0, -9999.0)
NUDGE = 1e-6


def not_missing(value: Column) -> Column:
    """`value`, or null within rounding of a missing mark or for NaN."""
    near = [F.abs(value - m) <= 1e-8 + 1e-5 * abs(m) for m in MISSING_MARKS]
    return F.when(~(near[0] | near[1] | near[2] | F.isnan(value)), value)


def nudged(df: DataFrame, column: str, order: str, within: list[str]) -> DataFrame:
    """The k-th repeat of a coordinate, in the order of `order`, moved by k millionths; nulls stay."""
    w = Window.partitionBy(*within, column).orderBy(order)
    return df.withColumn(column, F.when(F.col(column).isNotNull(), F.col(column) + NUDGE * (F.row_number().over(w) - 1)))


def fields_of(lines: DataFrame) -> DataFrame:
    """(file_name, line_no, fields) of each line that isn't blank; lines with broken quoting are left out."""
    head = lines.filter("line_no = 1").groupBy("file_name").agg(F.min_by("raw", "line_id").alias("h"))
    delim = head.select("file_name", F.regexp_extract(F.regexp_replace("h", "^\ufeff", ""), _DELIM, 1).alias("delim"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf[pdf["raw"].map(lambda x: isinstance(x, str) and bool(x.strip(" \t\r\n\ufeff")))]
            for d, part in pdf.groupby(pdf["delim"].where(pdf["delim"] != "", ",").fillna(",")):
                split = automaton.split([automaton.clean(x) for x in part["raw"]], d)
                ok = [f is not None for f, _ in split]
                yield pd.DataFrame({"file_name": part["file_name"][ok], "line_no": part["line_no"][ok], "fields": [f for f, _ in split if f is not None]})

    return lines.join(delim, "file_name", "left").select("file_name", "line_no", "raw", "delim").mapInPandas(run, "file_name string, line_no int, fields array<string>")


def formats(fields: DataFrame) -> DataFrame:
    """(file_name, fmt): cdt or cpt by the labels of the first column, null where they tell neither."""
    label = F.upper(F.get("fields", F.lit(0)))
    top = fields.filter("line_no <= 3").groupBy("file_name").agg(F.max(F.when(F.col("line_no") == 1, label)).alias("a"), F.max(F.when(F.col("line_no") == 2, label)).alias("b"))
    fmt = F.when(F.col("a") == "ID", "cdt").when(F.col("a").isin("STATION", "STN"), "cpt").when(F.col("b").startswith("LON"), "cdt").when(F.col("b").startswith("LAT"), "cpt")
    return top.select("file_name", fmt.alias("fmt"))


def station_rows(lines: DataFrame, fmt: str | None = None, month_day: str = "08-01") -> DataFrame:
    """(file_name, station, longitude, latitude, elevation, time, prcp) of station tables, one row per date and station.

    Values that are no numbers and missing marks become null, rows without a date are dropped, repeated coordinates are nudged per axis and file.
    """
    fields = fields_of(lines)
    known = formats(fields) if fmt is None else fields.select("file_name").distinct().withColumn("fmt", F.lit(fmt))
    rows = fields.join(known, "file_name").filter("fmt is not null")
    label = F.upper(F.get("fields", F.lit(0)))
    header = F.when(F.col("line_no") == 1, "station").when((F.col("line_no") <= 3) & label.startswith("LON"), "longitude").when((F.col("line_no") <= 3) & label.startswith("LAT"), "latitude")
    header = header.when((F.col("line_no") == 4) & (F.col("fmt") == "cdt") & label.rlike("ELEV|DAILY|DEKAD|MONTH"), "elevation")
    cells = rows.withColumn("role", header).select("file_name", "line_no", "fmt", "role", F.get("fields", F.lit(0)).alias("key"), F.posexplode(F.slice("fields", F.lit(2), F.greatest(F.size("fields") - 1, F.lit(0)))).alias("pos", "cell"))
    pick = lambda r: F.max(F.when(F.col("role") == r, F.col("cell")))
    heads = cells.filter("role is not null").groupBy("file_name", "pos").agg(pick("station").alias("station"), *[pick(r).try_cast("double").alias(r) for r in ("longitude", "latitude", "elevation")]).filter("station is not null")
    heads = nudged(nudged(heads, "longitude", "pos", ["file_name"]), "latitude", "pos", ["file_name"])
    day = F.when(F.col("fmt") == "cdt", F.try_to_timestamp("key", F.lit("yyyyMMdd"))).otherwise(F.try_to_timestamp(F.concat(F.regexp_extract("key", r"^\s*(\d{4})(?:\.0*)?\s*$", 1), F.lit(f"-{month_day}")), F.lit("yyyy-MM-dd"))).cast("date")
    data = cells.filter("role is null").withColumn("time", day).filter("time is not null")
    return data.join(heads, ["file_name", "pos"]).select("file_name", "station", "longitude", "latitude", "elevation", "time", not_missing(F.col("cell").try_cast("double")).alias("prcp"))


def file_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(line_id, file_name, line_no, raw) of text files, `line_id` and `line_no` counting from 1 in each file.

    Large files are read in blocks by several tasks: lines are counted per block, and the blocks of a file before each one give the number of its first line.
    """
    where = [F.col("_metadata.file_path").alias("file_name"), F.col("_metadata.file_block_start").alias("block")]
    lines = staged(spark.read.option("lineSep", "\n").text(paths).select(*where, F.monotonically_increasing_id().alias("id"), F.col("value").alias("raw")))
    blocks = lines.groupBy("file_name", "block").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("file_name").orderBy("block")) - F.col("n")
    number = F.col("before") + F.col("id") - F.col("first") + 1
    # one row per block
    return lines.join(broadcast_if_small(blocks.withColumn("before", before)), ["file_name", "block"]).select(number.alias("line_id"), "file_name", number.cast("int").alias("line_no"), "raw")


def read_station_file(spark: SparkSession, path: str, fmt: str | None = None, month_day: str = "08-01") -> DataFrame:
    """One station file; ValueError for an unknown format."""
    if fmt not in (None, "cdt", "cpt"):
        raise ValueError(f"unknown station format: {fmt}")
    lines = file_lines(spark, [path])
    if fmt is None and formats(fields_of(lines)).filter("fmt is not null").isEmpty():
        raise ValueError(f"can't tell the station format of {path}")
    return station_rows(lines, fmt, month_day)


def load_stations(spark: SparkSession, folder: str, pattern: str | tuple[str, ...] = "*.csv", fmt: str | None = None, month_day: str = "08-01") -> DataFrame | None:
    """All station files of a folder; warns and gives None where there are none, warns and skips files that can't be read."""
    if not os.path.isdir(folder):
        warnings.warn(f"Station directory not found: {folder}", stacklevel=2)
        return None
    patterns = (pattern,) if isinstance(pattern, str) else pattern
    paths = sorted({p for x in patterns for p in glob.glob(os.path.join(folder, x))})
    if not paths:
        warnings.warn(f"No station files matching {pattern} in {folder}", stacklevel=2)
        return None
    lines = file_lines(spark, paths)
    if fmt is None:
        bad = [r[0] for r in lines.select("file_name").distinct().join(formats(fields_of(lines)).filter("fmt is not null"), "file_name", "left_anti").collect()]
        for p in sorted(bad):
            warnings.warn(f"Skipped station file {p}: unknown format", stacklevel=2)
        if len(bad) == len(paths):
            return None
    return station_rows(lines, fmt, month_day)
