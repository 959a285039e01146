import datetime as dt
import os
import tempfile
import time

from pyspark.sql import functions as F

from urbanlens.sources import io


def test_read_stations_bom_crlf_quotes(spark):
    d = tempfile.mkdtemp(prefix="ul-st-")
    path = os.path.join(d, "stations.csv")
    body = ("﻿Latitude,Longitude,Station,Zone\r\n51.5,-0.1,Bank,1\r\n"
            "51.47,-0.45,\"Heathrow Terminals 1, 2 & 3\",6\r\n51.52,-0.16,Baker Street,1\r\n"
            "51.5,-0.2,Earl's Court,1.5\r\n51.6,0.2,St. Paul's (East),2")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(body)
    df = io.read_stations(spark, path)
    assert df.columns == ["Latitude", "Longitude", "Station"]
    names = [r.Station for r in df.collect()]
    assert names == ["Bank", "Heathrow Terminals 1, 2 & 3", "Baker Street", "Earl's Court", "St. Paul's (East)"]


def test_read_latest_batch_whole(spark):
    base = tempfile.mkdtemp(prefix="ul-snap-")
    for b, n in (("b1", 1), ("b2", 2)):
        spark.range(5).withColumn("b", F.lit(b)).repartition(n).write.parquet(f"{base}/{b}")
        time.sleep(1.1)
    spark.range(3).withColumn("b", F.lit("b3")).repartition(3).write.parquet(f"{base}/b3")
    got = io.read_latest(spark, base)
    assert got.count() == 3 and {r.b for r in got.collect()} == {"b3"}


def test_tables_append_and_lineage(spark):
    wh = tempfile.mkdtemp(prefix="ul-wh-")
    io.ensure_tables(spark, "ul_test", location=wh)
    io.ensure_tables(spark, "ul_test", location=wh)          # repeatable
    now = dt.datetime(2024, 1, 8, 12, 30, 15, 999)
    io.append_table(io.lineage_row(spark, 2, "all_spark_jobs", "a", "b", now), "ul_test.data_lineage")
    rows = spark.table("ul_test.data_lineage").collect()
    assert len(rows) == 1 and rows[0].batch_nr == 20240108 and rows[0].timestamp == dt.datetime(2024, 1, 8, 12, 30, 15)


def test_listings_csv_roundtrip(spark):
    from urbanlens.sources.schemas import LISTINGS
    out = tempfile.mkdtemp(prefix="ul-csv-") + "/l"
    df = spark.createDataFrame([("1", "l", 1.0, None, 2, None, "a, b", 0.3, "Bank")], LISTINGS)
    io.write_listings_csv(df, out)
    back = io.read_listings(spark, out).first()
    assert back.bedrooms is None and back.bathrooms == 2 and back.address == "a, b"
