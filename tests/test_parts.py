"""Streaming slots, models, sinks and column names."""

import datetime as dt

import pytest

from rainloom.models import NonParametric
from rainloom.sources.gridded import standardise
from rainloom.sources.tables import broadcast_if_small, file_census, staged, write_partitioned
from rainloom.streaming.slots import slot_means

T0 = dt.datetime(2024, 1, 1)


def test_stream_agrees_with_batch(spark, tmp_path):
    rows = [("s", T0 + dt.timedelta(hours=h), float(h)) for h in range(12)] + [("s", T0, -99.0), ("s", T0, None)]
    schema = "station string, time timestamp_ntz, prcp double"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    stream = slot_means(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), 6)
    q = stream.writeStream.outputMode("complete").format("memory").queryName("slots").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start()
    q.awaitTermination(120)
    assert sorted(tuple(r) for r in spark.sql("select station, slot, value, n from slots").collect()) == [("s", T0, 2.5, 6), ("s", T0 + dt.timedelta(hours=6), 8.5, 6)]


def test_model_contract(spark):
    schema = "model string, cell_id int, period_id int, number int, year int, acc_mm double"
    h = spark.createDataFrame([("m", 1, 6, n, 2000, float(n)) for n in range(9)], schema)
    r = NonParametric().fit(h).transform(h).collect()[0]
    assert r.prob_BN + r.prob_NN + r.prob_AN == pytest.approx(1.0)
    with pytest.raises(ValueError):
        NonParametric().transform(h)


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, k string")
    assert sorted(staged(df).collect()) == sorted(df.collect()) and staged(df.limit(0)).count() == 0
    write_partitioned(df, str(tmp_path / "t"), ["k"])
    assert spark.read.parquet(str(tmp_path / "t")).filter("k = 'b'").collect()[0].x == 2
    assert file_census(spark, str(tmp_path), "*.parquet") == 2 and file_census(spark, str(tmp_path)) == 0
    assert "broadcast" in broadcast_if_small(df)._jdf.queryExecution().logical().toString().lower() and broadcast_if_small(df, 1) is df


def test_standard_names(spark):
    assert standardise(spark.createDataFrame([(1, 2)], "lon int, lat int")).columns == ["longitude", "latitude"]
    assert standardise(spark.createDataFrame([(1, 2)], "lon int, longitude int")).columns == ["lon", "longitude"]
    with pytest.raises(ValueError):
        standardise(spark.createDataFrame([(1, 2)], "lon int, X int"))
