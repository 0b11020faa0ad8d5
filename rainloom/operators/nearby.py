"""Points near other points or inside regions (problem 5).

Radius join: places are parted by their nearest pivot (a Voronoi partition of the sphere); a place is also copied to each
cell whose pivot is at most twice the radius farther away than its own (triangle inequality), so that each place meets all
its neighbours in its home cell. Cells with too many places are parted again around pivots of their own by the same rule,
until none is left. Inside a cell a vantage-point tree with the great-circle metric gives the exact pairs. Points at one
place are one place to the partition; their ids are joined afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from rainloom.functions import sphere
from rainloom.sources.tables import broadcast_if_small, staged

#: Places per cell aimed at; pivots of the first partition, and of each cell that is parted again (24 bytes each in every task).
CELL_POINTS, FIRST_PIVOTS, NEXT_PIVOTS = 1500, 4096, 64
#: Cells with more home places are parted again; where they lie so close that this doesn't part them, one task takes on so many probes.
PROBES = 20_000
BAND_DEGREES, LONGITUDE_BAND_DEGREES = 0.25, 1.0
PLACE = ["longitude", "latitude"]
_CELLS = "cell long, home boolean, longitude double, latitude double"


def located(sites: DataFrame, lon: tuple[float, float] = (4.0, 36.0), lat: tuple[float, float] = (-21.0, 25.0)) -> DataFrame:
    """(site_id, longitude, latitude) of the sites with both coordinates in the area; null and NaN are outside."""
    return sites.select("site_id", "longitude", "latitude").filter(F.col("longitude").between(*lon) & F.col("latitude").between(*lat) & F.col("site_id").isNotNull())


def _first_pivots(places: DataFrame) -> dict[int, np.ndarray]:
    """Unit vectors of the first places by a hash, so that dense regions get more of them; all are of one cell, -1."""
    k = int(min(FIRST_PIVOTS, max(1, places.count() // CELL_POINTS)))
    rows = places.orderBy(F.xxhash64(*PLACE), *PLACE).limit(k).collect()
    return {-1: sphere.unit_vectors(np.array([r[0] for r in rows]), np.array([r[1] for r in rows]))} if rows else {}


def _next_pivots(cells: DataFrame, crowded: dict[int, int]) -> dict[int, np.ndarray]:
    """About n / CELL_POINTS, at most NEXT_PIVOTS home places of each crowded cell, drawn by a hash; `crowded` has the home places of each."""
    spark = cells.sparkSession
    sizes = spark.createDataFrame([(c, n, min(NEXT_PIVOTS, max(2, n // CELL_POINTS))) for c, n in crowded.items()], "cell long, n long, k long")
    # one row per crowded cell, at most as many as there were pivots before
    drawn = cells.filter("home").join(F.broadcast(sizes), "cell").filter(F.pmod(F.xxhash64(*PLACE, F.lit(7)), "n") < F.col("k"))
    out: dict[int, list[tuple[float, float]]] = {}
    for r in drawn.select("cell", *PLACE).collect():
        out.setdefault(r[0], []).append((r[1], r[2]))
    return {c: sphere.unit_vectors(*np.array(xy).T) for c, xy in out.items() if len(xy) > 1}


def _assigned(cells: DataFrame, pivots: dict[int, np.ndarray], first: int, reach: float) -> DataFrame:
    """`cells` with each row in the cells around `pivots`, numbered from `first` on: home in the nearest, copies wherever a neighbour of a home place may be."""
    base, at = {}, first
    for c, vectors in pivots.items():
        base[c], at = at, at + len(vectors)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for c, part in pdf.groupby("cell"):
                for i in range(0, len(part), 2048):
                    p = part.iloc[i : i + 2048]
                    lon, lat, home = p["longitude"].to_numpy(), p["latitude"].to_numpy(), p["home"].to_numpy()
                    angle = np.arccos(np.clip(sphere.unit_vectors(lon, lat) @ pivots[c].T, -1.0, 1.0))
                    nearest = angle.argmin(axis=1)
                    row, cell = np.nonzero(angle <= angle[np.arange(len(p)), nearest][:, None] + reach)
                    yield pd.DataFrame({"cell": cell + base[c], "home": home[row] & (nearest[row] == cell), "longitude": lon[row], "latitude": lat[row]})

    return cells.select("cell", "home", *PLACE).mapInPandas(run, _CELLS)


def _cells(places: DataFrame, reach: float) -> DataFrame | None:
    """(cell, home, longitude, latitude, parts): the cells of all places, with the number of tasks that share the probes of each; None for no places."""
    pivots, number = _first_pivots(places), 0
    if not pivots:
        return None
    todo, out = places.select(F.lit(-1).cast("long").alias("cell"), F.lit(True).alias("home"), *PLACE), None
    while pivots:
        here = staged(_assigned(todo, pivots, number, reach))
        number += sum(map(len, pivots.values()))
        homes = here.groupBy("cell").agg(F.count_if("home").alias("n"), F.count("*").alias("rows"))
        large = {r[0]: (r[1], r[2]) for r in homes.filter(F.col("n") > PROBES).collect()}
        # a cell that is mostly copies isn't parted further: its places lie within the reach of each other
        pivots = _next_pivots(here, {c: n for c, (n, rows) in large.items() if rows < 2 * n})
        parts = {c: -(-n // PROBES) for c, (n, _) in large.items() if c not in pivots}
        kept = here.filter(~F.col("cell").isin(list(pivots))) if pivots else here
        share = F.create_map(*[F.lit(x) for kv in parts.items() for x in kv])[F.col("cell")] if parts else F.lit(None)
        kept = kept.withColumn("parts", F.coalesce(share, F.lit(1)).cast("int"))
        out = kept if out is None else out.unionByName(kept)
        todo = here.filter(F.col("cell").isin(list(pivots)))
    return out


def near_pairs(points: DataFrame, radius_km: float) -> DataFrame:
    """(a, b) with a < b: the ids of each two points at most `radius_km` apart.

    Points at one place are pairs too. An empty table gives none. Needs (site_id, longitude, latitude) within their ranges.
    """
    spark = points.sparkSession
    cells = _cells(staged(points.select(*PLACE).distinct()), 2 * radius_km / sphere.RADIUS_KM + 1e-6)
    if cells is None:
        return spark.createDataFrame([], "a long, b long")
    spread = cells.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(PLACE, ignore_index=True)
        lon, lat = pdf["longitude"].to_numpy(), pdf["latitude"].to_numpy()
        mine = np.flatnonzero(pdf["home"].to_numpy())
        mine = mine[pdf["part"].iloc[0] :: pdf["parts"].iloc[0]]
        found = list(sphere.VantageTree(lon, lat).pairs(mine, radius_km))
        p, q = (np.concatenate([x[i] for x in found]) if found else np.empty(0, np.int64) for i in (0, 1))
        keep = p < q  # by place; the home cell of the first holds the other, at home or as a copy
        p, q = p[keep], q[keep]
        return pd.DataFrame({"x": lon[p], "y": lat[p], "u": lon[q], "v": lat[q]})

    near = spread.groupBy("cell", "part").applyInPandas(join, "x double, y double, u double, v double")
    ids = points.select("site_id", *PLACE)
    first, second = (ids.select(F.col("site_id").alias(c), F.col("longitude").alias(x), F.col("latitude").alias(y)) for c, x, y in (("a", "x", "y"), ("b", "u", "v")))
    apart = near.join(first, ["x", "y"]).join(second, ["u", "v"]).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    together = first.join(second.withColumnsRenamed({"u": "x", "v": "y"}), ["x", "y"]).filter("a < b").select("a", "b")
    return apart.unionByName(together)


def zones_of(points: DataFrame, edges: DataFrame) -> DataFrame:
    """(site_id, adm0_a3): the zone that contains each point, by counting the polygon edges to its east.

    Inner rings are no part of their polygon (even-odd rule). Edges are met by bands of latitude and, from the
    west of their polygon on, of longitude. Points in no zone give no row; edges with nulls count for nothing.
    """
    clean = edges.dropna(subset=["poly_id", "x1", "y1", "x2", "y2"]).select("adm0_a3", "poly_id", "x1", "y1", "x2", "y2")
    bounds = clean.groupBy("adm0_a3", "poly_id").agg(F.min(F.least("x1", "x2")).alias("west"), F.max(F.greatest("x1", "x2")).alias("east"))
    band = lambda c: F.floor(c / BAND_DEGREES).cast("int")
    meridian = lambda c: F.floor(c / LONGITUDE_BAND_DEGREES).cast("int")
    banded = (
        clean.filter("y1 <> y2")
        .join(bounds, ["adm0_a3", "poly_id"])
        .withColumn("band", F.explode(F.sequence(band(F.least("y1", "y2")), band(F.greatest("y1", "y2")))))
        .withColumn("meridian", F.explode(F.sequence(meridian(F.col("west")), meridian(F.greatest("x1", "x2")))))
    )
    crosses = ((F.col("y1") > F.col("latitude")) != (F.col("y2") > F.col("latitude"))) & (
        F.col("longitude") < (F.col("x2") - F.col("x1")) * (F.col("latitude") - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1")
    )
    return (
        points.withColumns({"band": band(F.col("latitude")), "meridian": meridian(F.col("longitude"))})
        .join(broadcast_if_small(banded), ["band", "meridian"])
        .filter(F.col("longitude").between(F.col("west"), F.col("east")) & crosses)
        .groupBy("site_id", "adm0_a3", "poly_id")
        .count()
        .filter("count % 2 = 1")
        .select("site_id", "adm0_a3")
        .distinct()
    )


def near_and_within(sites: DataFrame, edges: DataFrame, radius_km: float = 0.5) -> DataFrame:
    """(kind, key_a, key_b): pairs of near sites and the zone of each site."""
    points = located(sites)
    near = near_pairs(points, radius_km).select(F.lit("near").alias("kind"), F.col("a").alias("key_a"), F.col("b").cast("string").alias("key_b"))
    zone = zones_of(points, edges).select(F.lit("zone").alias("kind"), F.col("site_id").alias("key_a"), F.col("adm0_a3").alias("key_b"))
    return near.unionByName(zone)
