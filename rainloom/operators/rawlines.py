"""Rows that fail to parse: lines of CDT station files into typed rows or reasons (problem 2).

The ID line of a file gives its delimiter and its number of fields. Lines are split by the automaton of
`functions.automaton`; fields are then typed. Nothing is dropped: each line comes out as `ok`, `blank`, `header` or with its reason.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from rainloom.functions import automaton

HEADER_LINES = 4
_NUMBER = re.compile(r"\+?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|-(?:0+\.?0*|\.0+)(?:[eE][+-]?[0-9]+)?")
_MISSING = re.compile(r"(?i:na|nan)?|-(?:999|99|9999)(?:\.0*)?")
_DATE = re.compile(r"[0-9]{8}")
#: The delimiter follows the first field (`ID`, perhaps quoted) of the ID line.
_DELIM = r'^\s*(?:"[^"]*"|[^",;\t]*?)\s*([,;\t])'
_TYPED = "line_id long, file_name string, line_no int, status string, at int, time date, prcp array<double>, names array<string>"


def _date(s: str) -> dt.date | None:
    if not _DATE.fullmatch(s):
        return None
    try:
        return dt.date(int(s[:4]), int(s[4:6]), int(s[6:]))
    except ValueError:
        return None


@lru_cache(1 << 16)
def _value(field: str) -> float | None | bool:
    """The amount in a field, None for a missing mark, False where it is neither."""
    if _MISSING.fullmatch(field):
        return None
    return abs(float(field)) if _NUMBER.fullmatch(field) else False


def _typed(fields: list[str], begins: list[int], end: int, n_fields: int | None) -> tuple[str, int, dt.date | None, list[float | None] | None]:
    """(status, offset, day, values): the offset is that of the field that fails; of the first one too many, or of the end of a line with too few."""
    if n_fields is not None and len(fields) != n_fields:
        return "columns", begins[n_fields] if len(fields) > n_fields else end, None, None
    day = _date(fields[0])
    if day is None:
        return "time", begins[0], None, None
    values = [_value(f) for f in fields[1:]]
    if False in values:
        wrong = next((i for i, v in enumerate(values, 1) if v is False), None)
        if wrong is not None:  # 0.0 equals False
            return "prcp", begins[wrong], None, None
    return "ok", -1, day, values


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        n = len(pdf)
        status, at, days, values, names = ["blank"] * n, [-1] * n, [None] * n, [None] * n, [None] * n
        raw = [x if isinstance(x, str) else "" for x in pdf["raw"]]
        cleaned = [automaton.clean(x) for x in raw]
        numbers, line_no = pdf["n_fields"].tolist(), pdf["line_no"].tolist()
        by_delim: dict[str, list[int]] = {}
        for i, (line, delim) in enumerate(zip(cleaned, pdf["delim"])):
            if line.strip(" \t\u00a0\r\n"):
                by_delim.setdefault(delim if isinstance(delim, str) and delim else ",", []).append(i)
        for delim, rows in by_delim.items():
            for i, (fields, begins) in zip(rows, automaton.split([cleaned[i] for i in rows], delim)):
                mark = len(raw[i]) - len(raw[i].lstrip("\ufeff"))
                if line_no[i] <= HEADER_LINES:
                    status[i], names[i] = "header", fields
                elif fields is None:
                    status[i], at[i] = "quoting", begins[0] + mark
                else:
                    status[i], place, days[i], values[i] = _typed(fields, begins, len(cleaned[i]), None if pd.isna(numbers[i]) else int(numbers[i]))
                    at[i] = place + mark if place >= 0 else -1
        yield pd.DataFrame({"line_id": pdf["line_id"].to_numpy(), "file_name": pdf["file_name"].to_numpy(), "line_no": pdf["line_no"].to_numpy(), "status": status, "at": at, "time": days, "prcp": values, "names": names})


def _run(lines: DataFrame) -> DataFrame:
    return lines.select("line_id", "file_name", "line_no", "raw", "delim", "n_fields").mapInPandas(_parse, _TYPED)


def headers(lines: DataFrame) -> DataFrame:
    """(file_name, delim, n_fields, names) of each file that has an ID line; of repeated ones the smallest line_id counts."""
    heads = lines.filter("line_no = 1").groupBy("file_name").agg(F.min_by("raw", "line_id").alias("raw"), F.min("line_id").alias("line_id"))
    heads = heads.withColumn("line_no", F.lit(1)).withColumn("delim", F.regexp_extract(F.regexp_replace("raw", "^\ufeff", ""), _DELIM, 1)).withColumn("n_fields", F.lit(None).cast("int"))
    delim = heads.select("file_name", F.col("delim"))
    return _run(heads).select("file_name", "names", F.size("names").alias("n_fields")).join(delim, "file_name")


def parse_lines(lines: DataFrame) -> DataFrame:
    """One row per line with `status`: `ok` (then `time` and `prcp` hold), `header`, `blank`, or the first reason of
    `quoting`, `columns`, `time`, `prcp`; `at` is the offset in `raw` of the character or field that fails (the end of a line with too few fields), -1 where none does.

    Null and blank lines are `blank`. The number of fields of a line in a file without a readable ID line isn't checked. Repeated lines each get their own row.
    """
    known = headers(lines).select("file_name", "delim", F.when(F.col("n_fields") > 0, F.col("n_fields")).alias("n_fields"))
    return _run(lines.join(known, "file_name", "left"))


def failed_lines(lines: DataFrame) -> DataFrame:
    """(line_id, reason) of each line that fails."""
    return parse_lines(lines).filter(F.col("status").isin("quoting", "columns", "time", "prcp")).select("line_id", F.col("status").alias("reason"))


def loaded_readings(lines: DataFrame) -> DataFrame:
    """(line_id, file_name, time, station, prcp): one row per value of each valid line, missing values as null."""
    names = headers(lines).select("file_name", "names")
    rows = parse_lines(lines).filter("status = 'ok'").select("line_id", "file_name", "time", "prcp").join(names, "file_name")
    return rows.select("line_id", "file_name", "time", F.posexplode("prcp").alias("pos", "prcp"), "names").select("line_id", "file_name", "time", F.get("names", F.col("pos") + 1).alias("station"), "prcp")
