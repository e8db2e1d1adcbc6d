import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from driftglass import schema
from driftglass.functions import geo, text
from driftglass.functions.dimensions import with_airline


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_distances(spark):
    lit = F.lit
    r = one(spark, geo.haversine_m(lit(0.0), lit(0.0), lit(0.0), lit(1.0)), geo.haversine_m(lit(37.0), lit(127.0), lit(37.0), lit(127.0)), geo.haversine_m(lit(None).cast("double"), lit(0.0), lit(0.0), lit(1.0)))
    assert r[0] == pytest.approx(6_371_000 * math.pi / 180) and r[1] == 0 and r[2] is None


@pytest.mark.parametrize(("a", "b", "want"), [(350.0, 10.0, 20), (10.0, 350.0, -20), (0.0, 180.0, -180), (90.0, 90.0, 0), (180.0, 0.0, -180)])
def test_heading_fold(spark, a, b, want):
    assert one(spark, geo.fold_degrees(F.lit(b) - F.lit(a)))[0] == want


def test_speed_and_outlier(spark):
    r = one(spark, geo.speed_mps(F.lit(10.0), F.lit(0)), geo.outlier(F.lit(340.0)), geo.outlier(F.lit(340.1)), geo.outlier(F.lit(None).cast("double")))
    assert r[0] is None and list(r[1:]) == [False, True, False]


def test_extrapolation(spark):
    def at(**k):
        v = {"lat": 37.0, "lon": 127.0, "velocity": 100.0, "track": 0.0, "ground": False, "event": 1000, "snap": 1100, "now": 1010} | k
        c = [F.lit(v[x]).cast(t) for x, t in (("lat", "double"), ("lon", "double"), ("velocity", "double"), ("track", "double"), ("ground", "boolean"), ("event", "long"), ("snap", "long"), ("now", "long"))]
        return one(spark, *geo.extrapolated(*c))

    assert at()[0] == pytest.approx(37 + 1000 / 111_320)
    assert at(now=5000)[0] == pytest.approx(37 + 3000 / 111_320)  # held to 30 s
    assert at(now=900)[0] == 37 and at(ground=True)[0] == 37 and at(track=None)[0] == 37
    assert at(event=None, now=1110)[0] == pytest.approx(37 + 1000 / 111_320)


def test_bands(spark):
    band = lambda a, g: one(spark, geo.altitude_band(F.lit(a).cast("double"), F.lit(g).cast("boolean")))[0]
    assert [band(5.0, True), band(None, None), band(3000.0, False), band(9000.0, None)] == ["ground", "low", "mid", "high"]


def test_callsign_and_vector(spark):
    vector = F.array(*[F.lit(x) for x in ("abc123", "KAL123  ", "Nowhere", "1700000000")])
    r = one(spark, *schema.record_from_vector(vector, F.lit(1700000001), F.lit(2.5)))
    assert r.callsign == "KAL123" and r.time_position == 1700000000 and r.latitude is None and r.timestamp == 1700000001
    blank = one(spark, schema.clean_callsign(F.lit("  ")), schema.clean_callsign(F.lit(None).cast("string")))
    assert list(blank) == ["N/A", "N/A"]


@pytest.mark.parametrize(("message", "valid"), [("garbage", False), ('{"icao24":"a","latitude":1.0,"longitude":2.0,"timestamp":5}', True), ('{"icao24":"a","latitude":1.0,"longitude":2.0}', False), ('{"latitude":1.0,"longitude":2.0,"timestamp":5,"more":1}', True), ('{"latitude":"north","longitude":2.0,"timestamp":5}', False)])
def test_parsing_never_fails(spark, message, valid):
    row = schema.parse_messages(spark.createDataFrame([(message,)], "value string")).first()
    assert row._valid is valid


def test_cold_keeps_null_keys(spark):
    df = schema.flag_valid(spark.createDataFrame([(None, 1.0, 2.0, 3), ("a", 1.0, 2.0, 3), ("b", None, 2.0, 3)], "icao24 string, latitude double, longitude double, timestamp long"))
    assert schema.cold_rows(df).count() == 2 and schema.hot_rows(df).count() == 1


def test_airline_falls_back(spark):
    df = spark.createDataFrame([(" kal12 ", "X"), ("HL7000", "Japan"), (None, None), ("N/A", "")], "callsign string, origin_country string")
    got = [tuple(r) for r in with_airline(df).select("airline", "country", "country_source", "country_code").collect()]
    assert sorted(got, key=str) == sorted([("Korean Air", "Republic of Korea", "airline", "kr"), (None, "Japan", "registration", "jp"), (None, None, "registration", None), (None, None, "registration", None)], key=str)


def test_texts(spark):
    assert text.strict_date("2024-02-29") == date(2024, 2, 29)
    for bad in ("2024-2-29", "2023-02-29", "x", "2024-01-01 "):
        with pytest.raises(ValueError):
            text.strict_date(bad)
    body = F.lit("rows=1\nstatus=EXCLUDED (by hand)\ncode_version=0123456789ab")
    r = one(spark, text.excluded_marker(body), text.marker_version(body), text.excluded_marker(F.lit("note status=EXCLUDED")), text.marker_version(F.lit("rows=1")))
    assert list(r) == [True, "0123456789ab", False, None]
    log = "x\n" + "\n".join(f"ML_{k}" for k in range(10)) + "\nValueError: no\nother"
    assert one(spark, text.log_tail(F.lit(log)))[0] == [*(f"ML_{k}" for k in range(3, 10)), "ValueError: no"]
    assert len(text.content_version(b"a", b"b")) == 12 and text.content_version(b"ab") != text.content_version(b"a", b"b")
