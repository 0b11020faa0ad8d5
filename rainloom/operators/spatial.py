"""Zone masks on a grid and bilinear interpolation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rainloom.functions.expr import known
from rainloom.operators.nearby import zones_of

MAX_AXIS = 100_000


def grid_mask(grid: DataFrame, edges: DataFrame) -> DataFrame:
    """(cell_id, in_zone): whether the centre of each cell lies in a zone."""
    points = grid.select(F.col("cell_id").cast("long").alias("site_id"), "longitude", "latitude")
    inside = zones_of(points, edges).select(F.col("site_id").cast("int").alias("cell_id")).distinct().withColumn("in_zone", F.lit(True))
    return grid.select("cell_id").join(inside, "cell_id", "left").withColumn("in_zone", F.coalesce("in_zone", F.lit(False)))


def in_box(df: DataFrame, area: tuple[float, float, float, float]) -> DataFrame:
    """The rows within an area (west, east, south, north), its bounds included; rows without coordinates are outside."""
    west, east, south, north = area
    return df.filter(F.col("longitude").between(west, east) & F.col("latitude").between(south, north))


def edges_of_shapes(shapes: DataFrame, wkt: str = "wkt") -> DataFrame:
    """The columns of `shapes` but `wkt`, with (ring_id, edge_no, x1, y1, x2, y2): one row per edge of each ring of POLYGON and MULTIPOLYGON texts.

    Rings are closed where they aren't; texts that are null or hold no ring have no edges. Coordinates are taken as degrees.
    """
    rest = [c for c in shapes.columns if c != wkt]
    rings = shapes.select(*rest, F.posexplode(F.regexp_extract_all(wkt, F.lit(r"\(([^()]+)\)"), 1)).alias("ring_id", "_ring"))
    point = F.transform(F.split(F.trim("_ring"), r"\s*,\s*"), lambda p: F.transform(F.slice(F.split(p, r"\s+"), 1, 2), lambda v: v.try_cast("double")))
    following = F.concat(F.slice("_p", F.lit(2), F.size("_p") - 1), F.slice("_p", 1, 1))
    edges = rings.withColumn("_p", point).select(*rest, "ring_id", F.posexplode(F.arrays_zip(F.col("_p").alias("a"), following.alias("b"))).alias("edge_no", "_e"))
    ends = [F.get(f"_e.{e}", F.lit(i)).alias(f"{c}{n}") for n, e in ((1, "a"), (2, "b")) for i, c in enumerate("xy")]
    return edges.select(*rest, "ring_id", "edge_no", *ends).filter("x1 <> x2 or y1 <> y2")


def _axis(source: DataFrame, name: str) -> list[float]:
    values = [r[0] for r in source.select(name).filter(known(F.col(name)).isNotNull()).distinct().orderBy(name).limit(MAX_AXIS + 1).collect()]
    if len(values) > MAX_AXIS:
        raise ValueError(f"{name} isn't the axis of a grid")
    return values


def _bracket(x: Column, axis: list[float]) -> Column:
    """(lo, hi, weight of hi); null outside the axis. Its last value belongs to the last interval."""
    every = F.array(*[F.lit(float(a)) for a in axis])
    lo = F.array_max(F.filter(F.slice(every, 1, max(1, len(axis) - 1)), lambda a: a <= x))
    hi = F.array_min(F.filter(every, lambda a: a > lo))
    return F.when((x >= axis[0]) & (x <= axis[-1]), F.struct(lo.alias("lo"), hi.alias("hi"), ((x - lo) / (hi - lo)).alias("w")))


def bilinear(source: DataFrame, targets: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) at (longitude, latitude) of each target; null outside the grid and where one of the four corners is missing.

    `source` has one row per (latitude, longitude); the axes of its grid are at most MAX_AXIS values. Source rows
    without coordinates count for nothing; targets without coordinates get null.
    """
    lats, lons = _axis(source, "latitude"), _axis(source, "longitude")
    if len(lats) < 2 or len(lons) < 2:
        return targets.select(key, F.lit(None).cast("double").alias(value))
    t = targets.select(key, _bracket(F.col("longitude"), lons).alias("x"), _bracket(F.col("latitude"), lats).alias("y"))
    corner = lambda a, b: F.struct(F.col(f"x.{a}").alias("longitude"), F.col(f"y.{b}").alias("latitude"), ((F.col("x.w") if a == "hi" else 1 - F.col("x.w")) * (F.col("y.w") if b == "hi" else 1 - F.col("y.w"))).alias("weight"))
    corners = t.select(key, F.inline(F.array(*[corner(a, b) for a in ("lo", "hi") for b in ("lo", "hi")])))
    joined = corners.join(source.select("latitude", "longitude", known(F.col(value)).alias("v")), ["latitude", "longitude"], "left")
    return joined.groupBy(key).agg(F.when(F.count("v") == 4, F.sum(F.col("weight") * F.col("v"))).alias(value))
