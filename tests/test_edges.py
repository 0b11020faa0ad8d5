"""Nulls, NaN and clashing names in the operators; each case has the result that its docstring states."""

import json
import datetime as dt
import math

import pytest

from rainloom.operators import drift, forecast as fc, rawlines, regular, spatial, spikes, unify, verify as vf
from rainloom.sources import stations

T0 = dt.datetime(2024, 1, 1)
OBS = "obs_id long, station string, time timestamp_ntz, prcp double, received timestamp_ntz, observer_note string"
FCST = "fcst_id long, file_id long, model string, kind string, number int, init_time timestamp_ntz, step_h int, valid_time timestamp_ntz, cell_id int, tp double, tp_daily double, received timestamp_ntz"
ATTRS = "file_id long, file_name string, field string, units string, long_name string, note string"


def test_readings_without_ids_numbers_or_steps(spark):
    obs = spark.createDataFrame([(None, "s", T0, -5.0, T0, None), (1, "s", T0, -5.0, T0, None), (2, "s", T0, 1.0, T0, None)], OBS)
    rows = [(i, 1, "a", "forecast", None, T0, 24 * i, T0, 1, 0.1, 3.21, T0) for i in range(1, 8)]
    rows += [(20, 1, "a", "forecast", 0, T0, None, T0, 1, 0.1, 5000.0, T0), (None, 1, "a", "forecast", 0, T0, 24, T0, 1, 0.1, 5000.0, T0), (21, 1, None, None, None, None, None, None, None, None, -9.0, None)]
    attrs = spark.createDataFrame([(1, "x", "tp_daily", "mm", None, None)], ATTRS)
    out = {(r.tbl, r.row_id): r.why for r in spikes.implausible_readings(obs, spark.createDataFrame(rows, FCST), attrs).collect()}
    assert out == {("station_obs", 1): "range", **{("fcst_daily", i): "stuck" for i in range(1, 8)}, ("fcst_daily", 20): "range", ("fcst_daily", 21): "range"}


def test_units_with_clashing_names(spark):
    attrs = spark.createDataFrame([(9, "x", "precip", "cm", None, None), (9, "x", "tp", "mm", None, None), (9, "x", "tp_daily", "mm", None, None)], ATTRS)
    obs = spark.createDataFrame([(1, 9, 3.0, None, "u", "n", "p", "q")], "row_id long, file_id long, precip double, remark string, unit string, noted string, precip_unit string, precip_mm string")
    got = unify.convert_observations(obs, attrs).first()
    assert (got.precip_mm, got.precip_unit, got.unit, got.noted) == (30.0, "cm", "u", "n")
    fcst = spark.createDataFrame([(1, 9, 40.0, 2.0, "a", "b")], "fcst_id long, file_id long, tp double, tp_daily double, tp_unit string, tp_daily_unit string")
    got = unify.convert_forecast(fcst, attrs).first()
    assert (got.tp_unit, got.tp_m, got.tp_daily_mm) == ("mm", 0.04, 2.0)


def test_bilinear_without_coordinates(spark):
    source = spark.createDataFrame([(float(y), float(x), 1.0 * x + 10 * y, 0) for x in (0, 1) for y in (0, 1)] + [(None, 0.0, 5.0, 0), (0.0, math.nan, 5.0, 0)], "latitude double, longitude double, v double, weight int")
    targets = spark.createDataFrame([("a", 0.5, 0.5), ("b", None, 0.5), ("c", 0.5, math.nan)], "k string, longitude double, latitude double")
    assert {r.k: r.v for r in spatial.bilinear(source, targets, "k", "v").collect()} == {"a": 5.5, "b": None, "c": None}


def test_nan_is_missing_in_forecasts(spark):
    rows = [("m", 1, 1, n, 2000, math.nan if n == 0 else float(n)) for n in range(4)]
    acc = spark.createDataFrame(rows, "model string, cell_id int, period_id int, number int, year int, acc_mm double")
    limits = fc.thresholds(acc).first()
    assert limits.clim_mean == 2.0 and limits.median == 2.0
    p = fc.probabilities(acc, fc.thresholds(acc)).first()
    assert (p.prob_BN, p.prob_AN) == (0.25, 0.25)
    assert {r.threshold_mm: r.prob for r in fc.exceedance(acc, (1, 3)).collect()} == {1: 0.75, 3: 0.25}
    assert sorted(r.deviation for r in fc.dispersion(acc, "acc_mm", fc.CELL).collect() if r.deviation is not None) == [-1.0, 0.0, 1.0]
    two = acc.unionByName(acc.selectExpr("model", "cell_id", "period_id", "number", "2001 as year", "acc_mm + 10 as acc_mm"))
    loo = {r.year: (r.pBN, r.pAN) for r in vf.loo_probabilities(two).collect()}
    assert loo == {2000: (0.75, 0.0), 2001: (0.0, 0.75)}


def test_sums_tell_how_many_values_they_hold(spark):
    daily = spark.createDataFrame([(1, dt.date(2024, 1, 1), 2.0), (1, dt.date(2024, 1, 2), math.nan), (2, dt.date(2024, 3, 1), 1.0)], "k int, day date, tp_daily double")
    days = spark.createDataFrame([(k, "P", dt.date(2024, 1, i)) for k in (1, 2) for i in (1, 2, 3)], "k int, label string, day date")
    out = {r.k: (r.acc_mm, r.n_known) for r in fc.accumulate(daily, days, ["k"], ["k"]).collect()}
    assert out == {1: (2.0, 1), 2: (0.0, 0)}


def test_wide_station_lines(spark):
    n = 120_000
    raw = ["ID," + ",".join(map(str, range(n))), "20240101," + ",".join(["1"] * n)]
    lines = spark.createDataFrame([(i, "f", i, r) for i, r in enumerate(raw, 1)], "line_id long, file_name string, line_no int, raw string")
    assert stations.station_rows(lines, "cdt").count() == n


def test_drift_of_a_feed_with_many_files(spark):
    key = lambda i: ("lon", "LON", "longitude")[i // 20 % 3]
    rows = [(i * 10 + j, "f", i, f'{{"station":"s{j}","{key(i)}":{10.5 + j},"lat":{1.5 + j}}}') for i in range(1, 61) for j in range(3)]
    rows += [(9000, None, 1, '{"lon":1}'), (9001, "f", None, '{"lon":1}'), (9002, None, 2, '{"lat":1}')]
    catalog = spark.createDataFrame(rows, "record_id long, feed string, file_seq int, payload string")
    assert {tuple(r) for r in drift.field_changes(catalog).collect()} == {("f", 20, "longitude", "renamed"), ("f", 40, "longitude", "renamed"), ("f", 60, "longitude", "renamed")}


def test_drift_keeps_a_field_under_an_unknown_key_and_with_a_wrong_value(spark):
    def payload(i, k):
        x, y = ("breitengradferne", "ns") if 2 <= i < 6 else ("lon", "lat")
        height = {} if i == 3 else {"hoehe" if i == 4 else "elev": 300 + 9 * k}
        return json.dumps({"station": f"s{k}", x: 999.0 if (i, k) == (7, 2) else 10.0 + k, y: 40.0 + 3 * k, **height})

    docs = [(9 * i + k, "f", i, payload(i, k)) for i in range(9) for k in range(9)]
    catalog = spark.createDataFrame(docs, "record_id long, feed string, file_seq int, payload string")
    assert {tuple(r) for r in drift.field_changes(catalog).collect()} == {
        *[("f", i, f, "renamed") for i in (2, 6) for f in ("longitude", "latitude")], ("f", 3, "elevation", "removed"), ("f", 4, "elevation", "added"), ("f", 5, "elevation", "renamed"),
    }
    for r in drift.unified(catalog).collect():
        i, k = divmod(r.record_id, 9)
        assert (r.longitude, r.latitude, r.elevation) == (999.0 if (i, k) == (7, 2) else 10.0 + k, 40.0 + 3 * k, None if i == 3 else 300.0 + 9 * k)


def test_the_size_of_a_file_counts_values_with_remarks_about_other_things(spark):
    size = [2.0, 2.4, 2.5, 2.6, 3.0]
    rows = [(i, 1, v, None) for i, v in enumerate(size)] + [(10 + i, 2, v / 1000, "gauge cleaned") for i, v in enumerate(size)] + [(20, 2, 7.0, "in mm"), (21, 2, 8.0, "in mm"), (22, 2, 0.0, None)]
    obs = spark.createDataFrame(rows, "row_id long, file_id long, precip double, remark string")
    attrs = spark.createDataFrame([(1, "precip", "mm", None, None)], "file_id long, field string, units string, note string, long_name string")
    got = {r.row_id: (r.precip_unit, r.precip_mm) for r in unify.convert_observations(obs, attrs).collect()}
    assert [got[10 + i] for i in range(5)] == [("m", pytest.approx(v)) for v in size] and got[20] == ("mm", 7.0)


def test_the_zone_of_the_session_does_not_matter(spark):
    times = [dt.datetime(2024, 3, 31, h, 30) for h in range(24)] + [dt.datetime(2024, 10, 27, 2, 15)]
    obs = spark.createDataFrame([(i, "s", t, 1.0 + i, T0, None) for i, t in enumerate(times) if i != 5], OBS)
    where = spark.createDataFrame([("s", 3)], "station string, cadence_h int")
    runs = spark.createDataFrame([(i, "s", T0 + dt.timedelta(hours=i), 7.77 if i < 7 else 1.0 * i, T0, None) for i in range(30)], OBS)
    out = []
    try:
        for zone in ("UTC", "Europe/Paris"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            out.append((sorted(map(tuple, regular.regularise(obs, where).select("station", "slot", "status", "n").collect())), sorted(map(tuple, regular.empty_slots(obs, where).collect())), sorted(map(tuple, spikes.implausible(spikes.station_readings(runs)).collect()))))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert out[0] == out[1] and len(out[0][0]) == 62 * 8 and ("station_obs", 3, "stuck") in out[0][2]


def test_spikes_in_many_cells_of_a_dense_station_and_colliding_numbers(spark):
    rows = [(i, "hot", T0 + dt.timedelta(minutes=i), 200.0 + i % 7 if i % 9 == 0 else 0.5 + (i * 37 % 100) / 25, T0, None) for i in range(6000)]
    found = {r.row_id for r in spikes.implausible(spikes.station_readings(spark.createDataFrame(rows, OBS))).collect()}
    assert found == {i for i in range(6000) if i % 9 == 0}
    # a member without a number and one beyond 1,023 are series of their own, so neither has six equal readings
    fcst = [(10 * k + i, 1, "a", "forecast", n, T0, 24 * (i + 1), T0, 1, 0.1, 3.21, T0) for k, n in enumerate((None, 1023, 2047)) for i in range(4)]
    attrs = spark.createDataFrame([(1, "x", "tp_daily", "mm", None, None)], ATTRS)
    assert spikes.implausible(spikes.forecast_readings(spark.createDataFrame(fcst, FCST), attrs)).count() == 0


def test_staged_tables_need_a_shared_folder_and_can_be_removed(spark):
    import os

    from rainloom.sources import tables

    tables.clear_staged(spark)
    folder = tables.shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    kept = tables.staged(spark.range(3))
    assert kept.count() == 3 and len(set(os.listdir(folder)) - before) == 1
    tables.clear_staged(spark)
    assert set(os.listdir(folder)) == before


@pytest.mark.parametrize("name", ["station_cpt", "bilinear_regrid", "map_layers_anomaly", "p1_found", "p5_found", "p6_found", "run_scores", "run_multimodel"])
def test_registered_queries_on_empty_tables(spark, tmp_path, name):
    import __spark_entry__ as entry

    for t in ("station_obs", "stations", "obs_daily", "grid", "lineitem", "supplier", "station_catalog", "file_attrs", "zone_edges", "fcst_daily", "sites"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert entry.queries()[name](spark, str(tmp_path)).count() == 0


def test_drift_of_unknown_names_from_the_first_file_on(spark):
    def payload(feed, i, k):
        keys = {"known": ("lon", "lat", "elev"), "odd": (("aa", "bb", "cc"), ("aa", "bb", "cc"), ("AA", "qq", "cc"), ("AA", "qq", "kk"), ("aa", "bb", "kk"))[i], "late": (("u", "v", "w"), ("u", "v", "w"), ("u", "lat", "w"), ("lon", "lat", "w"), ("lon", "lat", "elev"))[i]}[feed]
        return json.dumps({"station": f"s{k}", "n": 1, keys[0]: 10.0 + k, keys[1]: 40.0 + 3 * k, keys[2]: 300 + 9 * k})

    docs = [(100 * f + 10 * i + k, feed, i, payload(feed, i, k)) for f, feed in enumerate(("known", "odd", "late")) for i in range(5) for k in range(9)]
    catalog = spark.createDataFrame(docs, "record_id long, feed string, file_seq int, payload string")
    assert {tuple(r) for r in drift.field_changes(catalog).collect()} == {
        *[("odd", i, f, "renamed") for i in (2, 4) for f in ("longitude", "latitude")], ("odd", 3, "elevation", "renamed"),
        ("late", 2, "latitude", "renamed"), ("late", 3, "longitude", "renamed"), ("late", 4, "elevation", "renamed"),
    }
    for r in drift.unified(catalog).collect():
        k = r.record_id % 10
        assert (r.longitude, r.latitude, r.elevation) == (10.0 + k, 40.0 + 3 * k, 300.0 + 9 * k)


def test_drift_follows_a_column_through_chunks_of_files(spark):
    key = lambda i: ("lon", "aa", "bb")[i // 200 % 3]
    rows = [(i * 10 + j, "f", i, f'{{"station":"s{j}","{key(i)}":{10.5 + j},"other":{i % 7}}}') for i in range(600) for j in range(3)]
    catalog = spark.createDataFrame(rows, "record_id long, feed string, file_seq int, payload string")
    assert {tuple(r) for r in drift.field_changes(catalog).collect()} == {("f", 200, "longitude", "renamed"), ("f", 400, "longitude", "renamed")}
    assert drift.unified(catalog).filter("longitude is null").count() == 0


def test_a_crowded_cell_is_parted_again_and_loses_no_pair(spark, monkeypatch):
    import numpy as np

    from rainloom.functions import sphere
    from rainloom.operators import nearby

    monkeypatch.setattr(nearby, "FIRST_PIVOTS", 1)
    monkeypatch.setattr(nearby, "PROBES", 2000)
    monkeypatch.setattr(nearby, "CELL_POINTS", 200)
    rng = np.random.default_rng(3)
    lon, lat = np.round(np.concatenate([10 + rng.random(20_000) * 0.5, np.full(40, 10.1), 10.2 + rng.random(3000) * 0.001]), 6), np.round(np.concatenate([5 + rng.random(20_000) * 0.5, np.full(40, 5.1), 5.2 + rng.random(3000) * 0.001]), 6)
    points = spark.createDataFrame(list(zip(range(len(lon)), lon.tolist(), lat.tolist())), "site_id long, longitude double, latitude double")
    cells = nearby._cells(points.select("longitude", "latitude").distinct(), 2 * 0.5 / sphere.RADIUS_KM + 1e-6).groupBy("cell").agg({"home": "count", "parts": "max"}).collect()
    assert len(cells) > 20 and sum(r[1] > 6000 for r in cells) == 0
    got = {tuple(r) for r in nearby.near_pairs(points, 0.5).collect()}
    want = set()
    by_cell = {}
    for i, (x, y) in enumerate(zip(lon, lat)):
        by_cell.setdefault((int(x / 0.005), int(y / 0.005)), []).append(i)
    for (cx, cy), mine in by_cell.items():
        other = np.array([j for dx in (-1, 0, 1) for dy in (-1, 0, 1) for j in by_cell.get((cx + dx, cy + dy), ())])
        for i in mine:
            close = other[(other > i) & (sphere.distance_km(lon[i], lat[i], lon[other], lat[other]) <= 0.5)]
            want |= {(i, int(j)) for j in close}
    assert got == want


def test_offsets_of_all_failures(spark):
    raw = ["ID;A;B", "LON;1;2", "LAT;1;2", "DAILY/ELEV;1;2", "20240101;1;2;3", "20240101;1", "﻿20240230;1;2", "20240101; 1;abc", '20240101;"1"x;2', '20240101;1;"2', "20240101;0;2"]
    lines = spark.createDataFrame([(i, "f", i, r) for i, r in enumerate(raw, 1)], "line_id long, file_name string, line_no int, raw string")
    out = {r.line_id: (r.status, r["at"]) for r in rawlines.parse_lines(lines).collect()}
    assert [out[i] for i in range(5, 12)] == [("columns", 13), ("columns", 10), ("time", 1), ("prcp", 12), ("quoting", 12), ("quoting", 11), ("ok", -1)]


def test_the_runs_on_hand_made_rows(spark):
    from rainloom.plans import runs

    def rows(file_id, kind, year, daily, n):
        start = dt.datetime(year, 6, 1)
        return [(1000 * file_id + 100 * n + i, file_id, "a", kind, n, start, 24 * i, start + dt.timedelta(days=i), 1, 10.0 * daily * i, None, start) for i in range(1, 41)]

    made = [r for f, (kind, year, daily) in enumerate([("hindcast", 2000, 1.0), ("hindcast", 2001, 2.0), ("hindcast", 2002, 3.0), ("forecast", 2020, 4.0)], 1) for n in range(2) for r in rows(f, kind, year, daily + n / 10, n)]
    attrs = spark.createDataFrame([(f, "x", "tp", "tenths of mm", None, None) for f in range(1, 5)], ATTRS)
    daily = runs.daily_amounts(spark.createDataFrame(made, FCST), attrs)
    assert {r.tp_daily for r in daily.filter("file_id = 1 and number = 0").select(fc.F.round("tp_daily", 6).alias("tp_daily")).collect()} == {1.0}
    regions = spark.createDataFrame([(1, "Z")], "cell_id int, region string")
    over = runs.over_regions(daily, regions)
    acc = runs.accumulated(over, runs.run_periods(over))
    sums = {(r.year, r.number, r.period_id): round(r.acc_mm, 6) for r in acc.collect()}
    assert sums[2000, 0, "month-6-602-630"] == 29.0 and sums[2020, 1, "decade-6-611-620"] == 41.0 and len({k[2] for k in sums}) == 5
    product = {r.period_id: r for r in runs.forecast_run(acc).collect()}["decade-6-611-620"]
    assert (product.model, product.cell_id, product.year, product.prob_AN) == ("a", "Z", 2020, 1.0) and product.ens_mean_anomaly == pytest.approx(20.0)
    multi = {r.period_id: r for r in runs.multimodel_run(runs.forecast_run(acc)).collect()}
    assert multi["month-6-602-630"].norm_AN == 1.0 and not multi["month-6-602-630"].dry
    observed = spark.createDataFrame([("Z", "decade-6-611-620", y, v) for y, v in ((2000, 5.0), (2001, 6.0), (2002, 7.0))], "cell_id string, period_id string, year int, acc_mm double")
    pairs, scores = runs.verification_run(acc, observed)
    assert {r.year: r.obs_cat for r in pairs.collect()} == {2000: 0, 2001: 1, 2002: 2} and scores.first().corr_ens == pytest.approx(1.0)
    assert runs.forecast_run(acc.limit(0)).count() == 0


def test_the_outline_of_zones_that_share_an_edge(spark):
    from rainloom.plans import runs

    square = lambda x: [(x, 0.0, x + 1, 0.0), (x + 1, 0.0, x + 1, 1.0), (x + 1, 1.0, x, 1.0), (x, 1.0, x, 0.0)]
    edges = spark.createDataFrame([*square(0.0), *square(1.0), (None, 0.0, 1.0, 1.0)], "x1 double, y1 double, x2 double, y2 double")
    assert runs.dissolved(edges).count() == 6


def test_lines_of_a_file_read_in_blocks(spark, tmp_path):
    for name, n in (("a.csv", 3000), ("b.csv", 7)):
        (tmp_path / name).write_text("".join(f"{name},{i},{'x' * (i % 40)}\r\n" for i in range(1, n + 1)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        out = stations.file_lines(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(out) == 3007 and all(r.raw.split(",")[1] == str(r.line_no) for r in out)


def test_edges_of_shapes(spark):
    rows = [("A", "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))"), ("B", "MULTIPOLYGON(((5 5,6 5,6 6)),((7 7,8 7,8 8,7 7)))"), ("C", None), ("D", "POINT EMPTY")]
    edges = spatial.edges_of_shapes(spark.createDataFrame(rows, "adm0_a3 string, wkt string"))
    assert {(r.adm0_a3, r.ring_id): r["count"] for r in edges.groupBy("adm0_a3", "ring_id").count().collect()} == {("A", 0): 4, ("A", 1): 4, ("B", 0): 3, ("B", 1): 3}
    from rainloom.operators import nearby

    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.5, 1.5), (3, 5.9, 5.5), (4, 7.5, 5.5)], "site_id long, longitude double, latitude double")
    inside = nearby.zones_of(points, edges.withColumn("poly_id", fc.F.xxhash64("adm0_a3")))
    assert {tuple(r) for r in inside.collect()} == {(1, "A"), (3, "B")}
    box = spatial.in_box(points.unionByName(spark.createDataFrame([(5, None, 1.0)], points.schema)), (0, 2, 0, 2))
    assert {r.site_id for r in box.collect()} == {1, 2}
