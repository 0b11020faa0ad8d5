"""The cleaning operators on small hand-made tables: the definitions, nulls, ties, repeated rows, empty tables, extra columns."""

import datetime as dt
import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from rainloom.functions import automaton, matching, sphere
from rainloom.functions.units import attribute, statement
from rainloom.operators import drift, nearby, rawlines, regular, spikes, unify

OBS = "obs_id long, station string, time timestamp_ntz, prcp double, received timestamp_ntz, observer_note string, src string, block string"
FCST = "fcst_id long, file_id long, model string, kind string, number int, init_time timestamp_ntz, step_h int, valid_time timestamp_ntz, cell_id int, tp double, tp_daily double, received timestamp_ntz"
ATTRS = "file_id long, file_name string, field string, units string, long_name string, note string"
T0 = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize(
    ("text", "unit"),
    [("kg m**-2", "mm"), ("kg m-2 s-1", "mm_per_s"), ("IN.", "inch"), ("1e-4 m", "tenth_mm"), ("mm/10", "tenth_mm"), ("m of water equivalent", "m"), ("cm d-1", "cm"), ("m s**-1", "m_per_s"), ("kg/(m2 s)", "mm_per_s"), ("dixièmes de mm", "tenth_mm"), ("1", None), ("", None), (None, None), ("K", None), ("kg", None)],
)
def test_attribute(text, unit):
    assert attribute(text) == unit


@pytest.mark.parametrize(
    ("text", "unit"),
    [("read in inches", "inch"), ("funnel of 8 inches", None), ("0.1 mm buckets replaced", None), ("cm not mm", "cm"), ("compté en 1/10 mm", "tenth_mm"), ("value entered in in.", "inch"), ("tree 3 m away cut", None), ("site moved 40 m", None), ("Pluie estimée, flux moyen en mm par seconde", "mm_per_s"), ("as mean rate, kg per square metre and second", "mm_per_s"), (None, None)],
)
def test_statement(text, unit):
    assert statement(text) == unit


def _forecast(rows):
    return [(i, f, "a", "forecast", 0, T0, 24 * (i + 1), T0, 1, tp, d, T0) for i, (f, tp, d) in enumerate(rows)]


def test_units(spark):
    fcst = spark.createDataFrame(_forecast([(1, 0.04, 2.0), (2, 40.0, 0.002), (2, None, math.nan), (3, 0.05, 3.0)]), FCST)
    attrs = spark.createDataFrame([(1, "x", "tp", "m", None, None), (1, "x", "tp_daily", "mm", None, None), (2, "x", "tp", None, None, None), (2, "x", "tp_daily", "?", "Pluie (depth of water, m)", None)], ATTRS)
    obs = spark.createDataFrame([(1, 9, 3.0, "read in inches"), (2, 9, 2.0, None), (3, 9, None, "read in inches")], "row_id long, file_id long, precip double, remark string")
    attrs = attrs.unionByName(spark.createDataFrame([(9, "x", "precip", "mm", None, None)], ATTRS))
    found = {tuple(r) for r in unify.other_units(fcst, obs, attrs).collect()}
    assert found == {("fcst_daily", "tp", 1, "mm"), ("fcst_daily", "tp_daily", 1, "m"), ("obs_daily", "precip", 1, "inch")}
    mm = {r.row_id: r.precip_mm for r in unify.convert_observations(obs, attrs).collect()}
    assert mm[1] == pytest.approx(76.2) and mm[2] == 2.0 and mm[3] is None
    assert unify.other_units(fcst.limit(0), obs.limit(0), attrs.limit(0)).count() == 0


def test_lines(spark):
    raw = ['﻿ID,"A, x",B', "LON,1,2", "LAT,1,2", "DAILY/ELEV,1,2", "20240101,1.5,-99\r", "20240102,1", '20240103,1"2,3', "20240230,1,2", "20240104,abc,1", "", None, '20240105," 2 ","NA"', '20240106,"1,2', "20240107,-1,2", "20240108,1e1,+.5", '"20240109","1"x,2']
    lines = spark.createDataFrame([(i, "f", i, r) for i, r in enumerate(raw, 1)] + [(99, "g", 7, "20240101,1")], "line_id long, file_name string, line_no int, raw string")
    assert {tuple(r) for r in rawlines.failed_lines(lines).collect()} == {(6, "columns"), (7, "quoting"), (8, "time"), (9, "prcp"), (13, "quoting"), (14, "prcp"), (16, "quoting")}
    loaded = {(r.line_id, r.station): r.prcp for r in rawlines.loaded_readings(lines).collect()}
    assert loaded == {(5, "A, x"): 1.5, (5, "B"): None, (12, "A, x"): 2.0, (12, "B"): None, (15, "A, x"): 10.0, (15, "B"): 0.5}
    assert rawlines.failed_lines(lines.limit(0)).count() == 0


def _split_plainly(line, delim):
    """One character at a time."""
    fields, state, field = [], "start", ""
    for c in line:
        if state == "quoted":
            state = "quote" if c == '"' else "quoted"
        elif state == "quote" and c == '"':
            state = "quoted"
        elif c == delim:
            fields.append(field)
            field, state = "", "start"
            continue
        elif state in ("quote", "closed"):
            if c not in " \t ":
                return None
            state = "closed"
        elif c == '"':
            if state == "plain":
                return None
            state = "quoted"
        elif c not in " \t ":
            state = "plain"
        field += c
    return None if state == "quoted" else [automaton.unquote(f) for f in [*fields, field]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text('a",; \t', max_size=200), min_size=1, max_size=5))
def test_automaton_over_chunks(lines):
    for delim in ",;\t":
        assert [f for f, _ in automaton.split(lines, delim)] == [_split_plainly(x, delim) for x in lines]


def test_regular(spark):
    rows = [(1, "s", T0 + dt.timedelta(hours=1), 2.0), (2, "s", T0 + dt.timedelta(hours=2), 4.0), (3, "s", T0 + dt.timedelta(hours=7), -99.0), (4, "s", None, 1.0), (5, "t", T0, 1.0), (6, None, T0, 1.0), (7, "u", T0 + dt.timedelta(hours=13), math.inf)]
    obs = spark.createDataFrame([(*r, T0, None, None, None) for r in rows], OBS)
    stations = spark.createDataFrame([("s", 6), ("u", 6), ("v", 24), ("t", None)], "station string, cadence_h int")
    out = {(r.station, r.slot): (r.status, r.value) for r in regular.regularise(obs, stations).collect()}
    assert len(out) == 2 * 31 * 4 and out["s", T0] == ("observed", 3.0)
    assert out["s", T0 + dt.timedelta(hours=12)][0] == "filled" and out["s", T0 + dt.timedelta(hours=6)] == ("unsupported", None)
    empty = {(r.station, r.slot) for r in regular.empty_slots(obs, stations).collect()}
    assert ("s", "2024-01-01 06:00") in empty and ("s", "2024-01-01 00:00") not in empty and len(empty) == 2 * 31 * 4 - 2
    assert regular.empty_slots(obs.limit(0), stations).count() == 0


def test_near_and_within(spark):
    rng = np.random.default_rng(3)
    xy = [(float(x), float(y)) for x, y in np.round(np.concatenate([rng.normal((20, 5), 0.004, (150, 2)), rng.uniform((5, -20), (35, 24), (50, 2))]), 4)] + [(20.0, 5.0)] * 4
    rows = [(i, x, y, "n") for i, (x, y) in enumerate(xy)] + [(900, None, 5.0, "n"), (901, math.nan, 5.0, "n"), (902, 214.0, 5.0, "n")]
    sites = spark.createDataFrame(rows, "site_id long, longitude double, latitude double, cell string")
    square = lambda z, p, r, a, b: [(z, z, p, r, i, *c) for i, c in enumerate([(a, a, b, a), (b, a, b, b), (b, b, a, b), (a, b, a, a)])]
    edges = spark.createDataFrame(square("Q", 1, 0, 4.5, 21.5) + square("Q", 1, 1, 4.9, 5.05), "adm0_a3 string, name string, poly_id int, ring_id int, edge_no int, x1 double, y1 double, x2 double, y2 double")
    nearby.CELL_POINTS = 20
    out = {tuple(r) for r in nearby.near_and_within(sites, edges).collect()}
    near = {("near", i, str(j)) for i in range(len(xy)) for j in range(i + 1, len(xy)) if sphere.distance_km(*xy[i], *xy[j]) <= 0.5}
    inside = {("zone", i, "Q") for i, (x, y) in enumerate(xy) if 4.5 < x < 21.5 and 4.5 < y < 21.5 and not (4.9 < x < 5.05 and 4.9 < y < 5.05)}
    assert out == near | inside and nearby.near_and_within(sites.limit(0), edges).count() == 0


def test_drift(spark):
    docs = [
        (1, "f", 1, '{"station":"a","lon":10.5,"lat":1.5,"elev":100,"long_name":"x"}'), (2, "f", 1, '{"station":"b","lon":11.5,"lat":2.5,"elev":null}'),
        (3, "f", 3, '{"station":"a","LON":"10.5E","pos":{"lat":"1°30.0\'N"},"x_ref":10}'), (4, "f", 3, "broken"), (5, "f", 3, None),
        (6, "f", 4, '{"station":"a","LON":"10.5E","pos":{"lat":[1.5]},"elev_ft":328,"breite":1}'), (7, "g", 1, "{}"),
    ]
    catalog = spark.createDataFrame(docs, "record_id long, feed string, file_seq int, payload string")
    assert {tuple(r) for r in drift.field_changes(catalog).collect()} == {
        ("f", 3, "longitude", "renamed"), ("f", 3, "longitude", "retyped"), ("f", 3, "latitude", "renamed"), ("f", 3, "latitude", "retyped"), ("f", 3, "elevation", "removed"), ("f", 4, "latitude", "retyped"), ("f", 4, "elevation", "added"),
    }
    u = {r.record_id: r for r in drift.unified(catalog).collect()}
    assert len(u) == 7 and (u[3].longitude, u[3].latitude) == (10.5, 1.5) and u[6].elevation == pytest.approx(99.97, abs=0.01) and u[5].longitude is None
    assert drift.field_changes(catalog.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 4).flatmap(lambda n: st.lists(st.lists(st.integers(0, 9), min_size=5, max_size=5), min_size=n, max_size=n)))
def test_assignment(weights):
    from itertools import permutations

    best = max(sum(weights[i][j] for i, j in enumerate(p)) for p in permutations(range(5), len(weights)))
    chosen = matching.assign(weights)
    assert len(set(chosen)) == len(weights) and sum(weights[i][j] for i, j in enumerate(chosen)) == best


def test_spikes(spark):
    rng = np.random.default_rng(1)
    values = np.round(np.minimum(rng.gamma(0.7, 4.0, 900), 20.0) + 0.01 * (np.arange(900) % 7), 2)
    values[::3] = 0.0
    values[100], values[400] = 90.0, 5000.0
    values[450] = -3.0
    values[600:607] = 7.77
    rows = [[i, "s", T0 + dt.timedelta(hours=6 * i), float(v)] for i, v in enumerate(values)]
    rows += [[1000, "s", rows[603][2], 7.77], [1001, "s", T0, None], [1002, "s", T0, math.nan], [1003, "s", T0, -99.0], [1004, None, T0, 5000.0]]
    obs = spark.createDataFrame([(*r, T0, None, None, None) for r in rows], OBS)
    none = spark.createDataFrame([], FCST), spark.createDataFrame([], ATTRS)
    out = {r.row_id: r.why for r in spikes.implausible_readings(obs, *none).collect()}
    assert out == {100: "spike", 400: "range", 450: "range", **{i: "stuck" for i in range(600, 607)}, 1000: "stuck"}
    assert spikes.implausible_readings(obs.limit(0), *none).count() == 0


def test_stuck_over_the_end_of_a_block(spark):
    end = dt.datetime(1970, 1, 1) + dt.timedelta(days=92 * 215)
    rows = [(i, "s", end + dt.timedelta(hours=i - 4), 3.21 if 1 <= i <= 6 else float(i % 3)) for i in range(12)]
    obs = spark.createDataFrame([(*r, T0, None, None, None) for r in rows], OBS)
    out = spikes.implausible_readings(obs, spark.createDataFrame([], FCST), spark.createDataFrame([], ATTRS)).filter("why = 'stuck'").collect()
    assert {r.row_id for r in out} == set(range(1, 7))


def test_nulls_in_any_column(spark):
    full = (1, 1, "a", "forecast", 0, T0, 24, T0, 1, 0.04, 5000.0, T0)
    fcst = spark.createDataFrame([full] + [tuple(None if i == k else (v if i else 10 + k) for i, v in enumerate(full)) for k in range(1, 12)], FCST)
    attrs = spark.createDataFrame([(1, "x", "tp_daily", "mm", None, None), (None, None, None, None, None, None)], ATTRS)
    obs = spark.createDataFrame([(1, "s", T0, -5.0, T0, None, None, None), (2, None, None, None, None, None, None, None), (3, "s", None, 1.0, None, None, None, None)], OBS)
    out = {(r.tbl, r.row_id) for r in spikes.implausible_readings(obs, fcst, attrs).collect()}
    assert ("station_obs", 1) in out and ("fcst_daily", 1) in out and ("station_obs", 2) not in out and ("fcst_daily", 20) not in out
    daily = spark.createDataFrame([(1, 1, 3.0, "mm"), (None, None, None, None)], "row_id long, file_id long, precip double, remark string")
    assert unify.other_units(fcst, daily, attrs).count() >= 0
    catalog = spark.createDataFrame([(None, None, None, '{"lon":1}'), (1, "f", 1, None)], "record_id long, feed string, file_seq int, payload string")
    assert drift.field_changes(catalog).count() == 0
    lines = spark.createDataFrame([(None, None, None, None), (1, "f", None, "x"), (2, None, 7, "20240101,1")], "line_id long, file_name string, line_no int, raw string")
    assert rawlines.parse_lines(lines).count() == 3
