"""Addresses and requests for the data services, as values and as column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from rainloom import config


def degrees(v: float, positive: str, negative: str) -> str:
    return f"({abs(v):g}{positive if v >= 0 else negative})"


def box(area: tuple[float, float, float, float]) -> str:
    """The part of an address that cuts out (west, east, south, north)."""
    west, east, south, north = area
    return f"/X/{degrees(west, 'E', 'W')}/{degrees(east, 'E', 'W')}/RANGEEDGES/Y/{degrees(south, 'N', 'S')}/{degrees(north, 'N', 'S')}/RANGEEDGES"


def cds_area(area: tuple[float, float, float, float]) -> list[float]:
    """North, west, south, east."""
    west, east, south, north = area
    return [north, west, south, east]


def _suffix(fmt: str) -> str:
    return "/dods" if fmt == "dods" else "/data.nc"


def nmme_url(model: str, variable: str, start: dt.date, area: tuple, dataset: str = "HINDCAST", leads: tuple | None = None, fmt: str = "data.nc") -> str:
    """KeyError for an unknown variable; an unknown model is taken as a token."""
    lead = f"/L/({leads[0]})/({leads[1]})/RANGEEDGES" if leads else ""
    head = f"{config.IRIDL}{config.NMME_SOURCE}/.{config.NMME_MODELS.get(model, model)}/.{dataset}/.MONTHLY/.{config.NMME_VARIABLES[variable]}"
    return f"{head}{box(area)}{lead}/S/(0000 {start.day} {start:%b %Y})/VALUES{_suffix(fmt)}".replace(" ", "%20")


def monthly_url(source: str, area: tuple, first_year: int, last_year: int, fmt: str = "data.nc") -> str:
    """Monthly fields of the years from January of the first to December of the last."""
    return f"{config.IRIDL}{source}{box(area)}/T/(Jan {first_year})/(Dec {last_year})/RANGEEDGES{_suffix(fmt)}".replace(" ", "%20")


def c3s_request(centre: str, variable: str, years: list, init_month: int | str, area: tuple, system: str | None = None, init_day: str = "01", leadtime_hours: list | None = None) -> tuple[str, dict]:
    """Dataset and request; KeyError for an unknown variable, or for an unknown centre without a system."""
    return "seasonal-original-single-levels", {
        "originating_centre": centre,
        "system": str(system if system is not None else config.C3S_SYSTEMS[centre]),
        "variable": [config.C3S_VARIABLES[variable]],
        "year": [str(y) for y in years],
        "month": [f"{int(init_month):02d}"],
        "day": [str(init_day)],
        "leadtime_hour": [str(h) for h in leadtime_hours or config.LEAD_HOURS],
        "data_format": "grib",
        "area": cds_area(area),
    }


def era5_request(variables: list[str], years: list, months: list[int], area: tuple, level_type: str = "single", pressure_level: str | None = None) -> tuple[str, dict]:
    """Dataset and request of monthly means; unknown variables pass through, pressure fields need a level (ValueError)."""
    pressure = level_type == "pressure"
    if pressure and pressure_level is None:
        raise ValueError("fields on pressure levels need a pressure_level")
    request = {
        "product_type": ["monthly_averaged_reanalysis"],
        "variable": [config.ERA5_VARIABLES.get(v, v) for v in variables],
        "year": [str(y) for y in years],
        "month": [f"{int(m):02d}" for m in months],
        "time": ["00:00"],
        "data_format": "netcdf",
        "area": cds_area(area),
    }
    if pressure:
        request["pressure_level"] = [str(pressure_level)]
    return f"reanalysis-era5-{'pressure' if pressure else 'single'}-levels-monthly-means", request


def nmme_url_column(model: Column, variable: str, start: Column, dataset: Column, area: tuple = config.AREA) -> Column:
    tokens = F.create_map(*[F.lit(x) for kv in config.NMME_MODELS.items() for x in kv])
    text = F.concat(F.lit(f"{config.IRIDL}{config.NMME_SOURCE}/."), F.coalesce(tokens[model], model), F.lit("/."), dataset, F.lit(f"/.MONTHLY/.{config.NMME_VARIABLES[variable]}{box(area)}/S/(0000 "), F.date_format(start, "d MMM yyyy"), F.lit(")/VALUES/data.nc"))
    return F.replace(text, F.lit(" "), F.lit("%20"))


def monthly_url_column(source: str, first_year: Column, last_year: Column, area: tuple = config.AREA) -> Column:
    text = F.concat(F.lit(f"{config.IRIDL}{source}{box(area)}/T/(Jan "), first_year.cast("string"), F.lit(")/(Dec "), last_year.cast("string"), F.lit(")/RANGEEDGES/data.nc"))
    return F.replace(text, F.lit(" "), F.lit("%20"))
