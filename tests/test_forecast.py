"""Facts of the forecast operators on small tables."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rainloom import config
from rainloom.functions import requests
from rainloom.functions.expr import decode_months, quantile
from rainloom.functions.labels import levels, period_label, safe_name, subfolder
from rainloom.operators import forecast as fc, periods, spatial, verify as vf
from rainloom.sources import stations as st

AREA = (4, 36, -21, 25)


def test_decumulate(spark):
    df = spark.createDataFrame([(1, 24, 0.002), (1, 48, 0.005), (1, 72, 0.009), (2, 0, 5.0), (2, 24, 0.001), (3, 24, 0.003), (3, 72, 0.001), (3, 96, math.nan), (4, 24, 0.002), (4, 48, 0.001)], "s int, step_h int, tp double")
    out = {(r.s, r.step_h): r.tp_daily for r in fc.decumulate(df, ["s"]).collect()}
    assert [out[1, h] for h in (24, 48, 72)] == pytest.approx([2.0, 3.0, 4.0])
    assert out[2, 0] == 0.0 and out[3, 72] is None and out[3, 96] is None and out[4, 48] == 0.0


def test_exceedance(spark):
    df = spark.createDataFrame([(1, float(v)) for v in (10, 20, 30, 40, 50)] + [(2, None), (2, 30.0)], "c int, acc_mm double")
    out = {(r.c, r.threshold_mm): r.prob for r in fc.exceedance(df, (25, 50), ["c"]).collect()}
    assert out == {(1, 25): 0.6, (1, 50): 0.2, (2, 25): 0.5, (2, 50): 0.0}


def test_terciles_add_up(spark):
    rng = np.random.default_rng(0)
    h = spark.createDataFrame([("m", c, 6, n, y, float(rng.gamma(2, 40))) for c in range(4) for n in range(6) for y in range(8)], "model string, cell_id int, period_id int, number int, year int, acc_mm double")
    f = spark.createDataFrame([("m", c, 6, n, 9, float(rng.gamma(2, 40)) if n else None) for c in range(4) for n in range(6)], h.schema)
    limits = fc.thresholds(h)
    for r in fc.probabilities(f, limits).collect():
        assert r.prob_BN + r.prob_NN + r.prob_AN == pytest.approx(5 / 6)
    assert not limits.filter("dry_mask").count() and fc.probabilities(f.limit(0), limits).count() == 0


def test_quantile_matches_numpy_to_the_bit(spark):
    rng = np.random.default_rng(5)
    rows = [(i, sorted(float(x) for x in rng.gamma(1, 30, int(rng.integers(1, 40))))) for i in range(200)]
    df = spark.createDataFrame(rows, "i int, v array<double>")
    for p in (1 / 3, 2 / 3, 0.2, 0.8, 0.5):
        out = dict(df.select("i", quantile(F.col("v"), F.lit(p))).collect())
        assert all(out[i] == float(np.quantile(v, p)) for i, v in rows)


def test_periods(spark):
    d = dt.date
    spans = spark.createDataFrame([(d(2026, 6, 2), d(2026, 11, 30))], "first date, last date")
    m, t, s = (f(spans, []).collect() for f in (periods.months, periods.decades, periods.seasons))
    assert len(m) == 6 and len(t) == 18 and len(s) == 4
    assert (m[0].start, m[0].end, m[0].n_days) == (d(2026, 6, 2), d(2026, 6, 30), 29) and (s[0].start, s[0].end) == (d(2026, 6, 2), d(2026, 8, 31))
    part = spark.createDataFrame([(d(2024, 2, 5), d(2024, 2, 25))], "first date, last date")
    assert periods.months(part, []).count() == 0 and [r.label for r in periods.decades(part, [], True).collect()] == ["2024-02-D1", "2024-02-D2", "2024-02-D3"]
    with pytest.raises(Exception, match="custom period"):
        periods.custom(spark.createDataFrame([(d(2024, 2, 5), d(2024, 2, 4))], "first date, last date"), []).collect()


def test_seasons_over_the_turn_of_the_year(spark):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 5), 1.0), (1, dt.date(2020, 6, 1), 2.0), (1, dt.date(2020, 12, 31), 4.0), (1, dt.date(2020, 2, 29), None), (2, dt.date(2020, 7, 1), 8.0)], "c int, day date, tp_daily double")
    out = dict(fc.accumulate_seasons(df, {"NDJF": (1101, 229)}, ["c"]).select("c", "acc_mm").collect())
    assert out == {1: 5.0, 2: 0.0}


def test_observed_sums_keep_missing(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 1.0), (2, math.nan), (3, None)], "c int, precip double")
    assert dict(fc.accumulate_observed(df, ["c"]).collect()) == {1: 3.0, 2: None, 3: None}


def test_summary_class(spark):
    df = spark.createDataFrame([(0.3, 0.3, 0.4), (0.5, 0.2, 0.3), (0.3, 0.4, 0.3), (0.34, 0.33, 0.33), (None, None, None)], "b double, n double, a double")
    assert [r[0] for r in df.select(fc.summary_class(F.col("b"), F.col("n"), F.col("a"))).collect()] == ["A", "B", "N", "W", "W"]


def _roc(p, e):
    order = sorted(range(len(p)), key=lambda i: -p[i])
    pos = area = 0
    for i in order:
        if e[i]:
            pos += 1
        else:
            area += pos
    n = sum(e)
    return area / (n * (len(e) - n)) if 0 < n < len(e) else None


def test_verification_against_plain_loops(spark):
    rng = np.random.default_rng(2)
    years, members = range(2000, 2007), range(3)
    h = {(y, n): float(np.round(rng.gamma(1, 20))) for y in years for n in members}
    o = {y: float(np.round(rng.gamma(1, 20))) for y in years}
    o[2003] = None
    hind = spark.createDataFrame([("m", 1, 6, n, y, v) for (y, n), v in h.items()], "model string, cell_id int, period_id int, number int, year int, acc_mm double")
    obs = spark.createDataFrame([(1, 6, y, v) for y, v in o.items()], "cell_id int, period_id int, year int, acc_mm double")
    rows = {r.year: r for r in vf.pairs(hind, obs).collect()}
    p, cat = [], []
    for y in years:
        lo, up = np.quantile([v for (z, _), v in h.items() if z != y], [1 / 3, 2 / 3])
        bn, an = np.mean([h[y, n] < lo for n in members]), np.mean([h[y, n] > up for n in members])
        rest = [v for z, v in o.items() if z != y and v is not None]
        lo, up = np.quantile(rest, [1 / 3, 2 / 3])
        c = 1 if o[y] is None else 0 if o[y] < lo else 2 if o[y] > up else 1
        p.append((bn, 1 - bn - an, an))
        cat.append(c)
        assert (rows[y].pBN, rows[y].pNN, rows[y].pAN, rows[y].obs_cat) == pytest.approx((bn, 1 - bn - an, an, c))
    s = vf.skill_scores(vf.pairs(hind, obs)).collect()[0]
    rps = np.mean([((b - (c <= 0)) ** 2 + (b + n - (c <= 1)) ** 2) / 2 for (b, n, _), c in zip(p, cat)])
    clim = np.mean([((1 / 3 - (c <= 0)) ** 2 + (2 / 3 - (c <= 1)) ** 2) / 2 for c in cat])
    assert s.rpss == pytest.approx(1 - rps / clim)
    roc = vf.roc_areas(vf.pairs(hind, obs)).collect()[0]
    for got, k, c in ((roc.roc_BN, 0, 0), (roc.roc_AN, 2, 2)):
        want = _roc([x[k] for x in p], [x == c for x in cat])
        assert got == (want if want is None else pytest.approx(want))
    rel = vf.reliability(vf.pairs(hind, obs), ["model"]).collect()
    assert len(rel) == 30 and sum(r.n for r in rel if r.category == "BN") == len(years) and any(r.n == 0 and r.mean_fcst is None for r in rel)


def test_constant_series_have_no_correlation(spark):
    hind = spark.createDataFrame([("m", 1, 6, 0, y, 5.0) for y in range(4)], "model string, cell_id int, period_id int, number int, year int, acc_mm double")
    obs = spark.createDataFrame([(1, 6, y, float(y)) for y in range(4)], "cell_id int, period_id int, year int, acc_mm double")
    r = vf.ensemble_skill(hind, obs).collect()[0]
    assert r.corr_ens is None and r.rmse_ens == pytest.approx(math.sqrt(np.mean([(5 - y) ** 2 for y in range(4)])))


def test_bilinear(spark):
    grid = spark.createDataFrame([(float(y), float(x), 2.0 * x + 3.0 * y + x * y) for x in (0, 10, 20) for y in (0, 5)], "latitude double, longitude double, v double")
    to = spark.createDataFrame([(1, 3.0, 2.0), (2, 20.0, 5.0), (3, 21.0, 2.0), (4, 0.0, 0.0), (5, None, 1.0)], "id int, longitude double, latitude double")
    out = dict(spatial.bilinear(grid, to, "id", "v").collect())
    assert out[1] == pytest.approx(18.0) and out[2] == pytest.approx(155.0) and out[3] is None and out[4] == 0.0 and out[5] is None


def test_addresses():
    assert requests.nmme_url("ncep_cfsv2", "PRCP", dt.date(2000, 6, 1), AREA, leads=(0.5, 2.5)) == (
        "https://iridl.ldeo.columbia.edu/SOURCES/.Models/.NMME/.NCEP-CFSv2/.HINDCAST/.MONTHLY/.prec/X/(4E)/(36E)/RANGEEDGES/Y/(21S)/(25N)/RANGEEDGES/L/(0.5)/(2.5)/RANGEEDGES/S/(0000%201%20Jun%202000)/VALUES/data.nc"
    )
    assert requests.nmme_url("X", "TEMP", dt.date(2000, 6, 1), (-10, 5, -1, 1), fmt="dods").endswith("/dods") and "(10W)" in requests.box((-10, 5, -1, 1))
    with pytest.raises(KeyError):
        requests.nmme_url("X", "WIND", dt.date(2000, 6, 1), AREA)
    assert requests.cds_area(AREA) == [25, 4, -21, 36]
    name, r = requests.c3s_request("ecmwf", "PRCP", [2026], 6, AREA)
    assert name == "seasonal-original-single-levels" and r["system"] == "51" and r["leadtime_hour"][0] == "24" and len(r["leadtime_hour"]) == 215 and r["month"] == ["06"]
    with pytest.raises(KeyError):
        requests.c3s_request("nobody", "PRCP", [2026], 6, AREA)
    assert requests.era5_request(["U"], [2020], [6], AREA, "pressure", "850")[1]["pressure_level"] == ["850"]
    with pytest.raises(ValueError):
        requests.era5_request(["U"], [2020], [6], AREA, "pressure")
    assert "/T/(Jan%201991)/(Dec%202020)/" in requests.monthly_url(config.CHIRPS_SOURCE, AREA, 1991, 2020)


def test_months_and_labels(spark):
    df = spark.createDataFrame([(485.0, "1960-01-01"), (0.0, "1991-01-01"), (12.5, "1991-01-01"), (13.5, "1991-01-01")], "m double, e string")
    assert [str(r[0]) for r in df.select(decode_months(F.col("m"), F.col("e").cast("date"))).collect()] == ["2000-06-01", "1991-01-01", "1992-01-01", "1992-03-01"]
    x = spark.createDataFrame([("decade", dt.date(2026, 6, 11), dt.date(2026, 6, 20)), ("odd", dt.date(2026, 6, 11), dt.date(2026, 6, 20))], "k string, a date, b date")
    out = x.select(period_label(F.col("k"), F.col("a"), F.col("b")).alias("t"), levels(F.col("k")).alias("l"), subfolder(F.col("k")).alias("s"), safe_name(F.lit("a/b c")).alias("n")).collect()
    assert out[0].t == "Décade 2 - June 2026\n(11 Jun - 20 Jun 2026)" and out[0].s == "decades" and out[1].s == "odd" and out[1].l == list(config.LEVELS["month"]) and out[0].n == "a-b_c"


def test_station_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ID,A,B\nLON,15.05,18.38\nLAT,12.11,9.15\nDAILY/ELEV,295,365\n20200601,0.0,1.2\n20200602,3.5,-999\n20200603,0.0,10.0\nbad,1,1\n")
    (tmp_path / "b.csv").write_text("STATION,C,D\nLAT,5,5\nLON,10,10\n1991,850,1200\n1992,910,x\n")
    (tmp_path / "c.csv").write_text("what,is\nthis,file\n")
    with pytest.warns(UserWarning, match="Skipped station file"):
        rows = st.load_stations(spark, str(tmp_path)).collect()
    by = {(r.station, str(r.time)): r for r in rows}
    assert len(rows) == 10 and by["B", "2020-06-02"].prcp is None and by["A", "2020-06-02"].prcp == 3.5 and by["A", "2020-06-01"].elevation == 295.0
    assert by["C", "1991-08-01"].prcp == 850.0 and by["D", "1992-08-01"].prcp is None and by["C", "1991-08-01"].longitude != by["D", "1991-08-01"].longitude
    assert st.read_station_file(spark, str(tmp_path / "a.csv")).count() == 6
    with pytest.raises(ValueError):
        st.read_station_file(spark, str(tmp_path / "c.csv"))
    with pytest.raises(ValueError):
        st.read_station_file(spark, str(tmp_path / "a.csv"), "xyz")
    with pytest.warns(UserWarning, match="Station directory not found"):
        assert st.load_stations(spark, str(tmp_path / "none")) is None
    with pytest.warns(UserWarning, match="No station files"):
        assert st.load_stations(spark, str(tmp_path), "*.txt") is None


def test_the_entry_point_registers_sql_only_for_queries():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 60
