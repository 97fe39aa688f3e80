"""Column functions against hand-made cases and rule-by-rule Python."""

import datetime as dt
import math
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewake.functions import ais, geo
from tidewake.functions import destinations as dest


def evaluate(spark, values, kind, *columns):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def test_timestamps(spark):
    cases = {
        "2024-01-02 10:00:00.123456789 +0000 UTC": dt.datetime(2024, 1, 2, 10, 0, 0, 123456),
        "2024-01-02 10:00:00.5 +0000 UTC": dt.datetime(2024, 1, 2, 10, 0, 0, 500000),
        "2024-01-02 10:00:00.123456 +0530": dt.datetime(2024, 1, 2, 10, 0, 0, 123456),
        "2024-01-02 10:00:00 +0000 UTC": None,
        "2024-01-02 10:00:00.1 -0100 UTC": None,
        "2024-13-02 10:00:00.1 +0000 UTC": None,
        "2024-02-30 10:00:00.1 +0000 UTC": None,
        "2024-01-02 10:00:00.1 +9900 UTC": None,
        "bad": None,
        "": None,
        None: None,
    }
    out = evaluate(spark, list(cases), "string", ais.parse_ais_timestamp(F.col("v")))
    assert [r[0] for r in out] == list(cases.values())


def test_codes(spark):
    cases = {
        "80.0": 80, " 52 ": 52, "70.9": 70, "-3.7": -3, "1e2": 100, "\t7\n": 7, "abc": None, "nan": None, "inf": None,
        "70d": None, "": None, "  ": None, None: None,
    }
    out = evaluate(spark, list(cases), "string", ais.parse_code(F.col("v")), ais.is_blank(F.col("v")))
    assert [r[0] for r in out] == list(cases.values())
    assert [r[1] for r in out] == [not (v or "").strip() for v in cases]


def test_operation_modes(spark):
    out = evaluate(spark, [*range(-1, 17), None], "int", ais.operation_mode(F.col("v")))
    expected = [None, *[ais.MODE_OF_STATUS[c] for c in range(16)], None, None]
    assert [r[0] for r in out] == expected


def split_by_rules(text):
    primary, secondary = text, None
    if len(text) > 5:
        if "ROTT" in text and "HULL" in text:
            return "ROTTERDAM", "HULL"
        for code, name in dest.PORT_CODES.items():
            if code in text and primary == text:
                primary = name
                rest = text.replace(code, "")
                secondary = next((n for c, n in dest.PORT_CODES.items() if c in rest), secondary)
    return primary, secondary


pieces = st.sampled_from([*dest.PORT_CODES, *dest.PORT_CODES.values(), "ROTT", "HULL", "ANT", "X", "1", "NL", "A"])
texts = st.lists(st.lists(pieces, min_size=1, max_size=4).map("".join), min_size=40, max_size=120)


@settings(max_examples=6, deadline=None)
@given(values=texts)
def test_split(spark, values):
    values = [*values, "CUXHAVEN", "ANTWERP", "CUXHAVENANT", "", "ANT"]
    ports = dest.split_destination(F.col("v"))
    out = evaluate(spark, values, "string", ports["primary"], ports["secondary"])
    assert out == [split_by_rules(v) for v in values]


@settings(max_examples=6, deadline=None)
@given(values=st.lists(st.text(alphabet="ROTEDAM0NLSVIG H>-", max_size=14), min_size=40, max_size=120))
def test_corrections(spark, values):
    values = [*values, " rotteedam", "ROTTTTEDAM", "0", "FISHING GROUNDS", "vlisingen", "DE HAM 12", "ß", "0 ostende"]

    def by_rules(text):
        text = re.sub("[^A-Z0-9]", "", text.upper())
        text = dest.PORT_CODES.get(text, text)
        for pattern, replacement in dest.CORRECTIONS:
            text = re.sub(pattern, replacement, text)
        return text

    fixed = dest.apply_rules(dest.map_codes(dest.clean_destination(F.col("v"))))
    assert [r[0] for r in evaluate(spark, values, "string", fixed)] == [by_rules(v) for v in values]


def test_emission(spark):
    rate, hours = F.col("v"), F.lit(2.0)
    emitted = [
        ais.emission_for_interval(F.lit(True), F.lit("Berth"), hours, rate),
        ais.emission_for_interval(F.lit(False), F.lit("Berth"), hours, rate),
        ais.emission_for_interval(F.lit(True), F.lit(None).cast("string"), hours, rate),
    ]
    assert evaluate(spark, [3.0, None], "double", *emitted) == [(6.0, 0.0, 0.0), (None, 0.0, 0.0)]


def test_boxes_and_validity(spark):
    lat = F.col("v")
    box = geo.Box(50, 61.5, -5, 13)
    out = evaluate(
        spark, ["50", "61.5", "61.6", "91", "x", "NaN", None], "string",
        geo.within_bbox(geo.as_number(lat), F.lit(13.0), box), geo.valid_coordinates(lat, F.lit(180.0)),
    )
    assert out == [(True, True), (True, True), (False, True), (False, False), (None, False), (None, False), (None, False)]


def test_haversine(spark):
    out = evaluate(spark, [0.0, 1.0, 90.0], "double", geo.haversine_nm(F.lit(0.0), F.lit(0.0), F.col("v"), F.lit(0.0)))
    expected = [math.radians(v) * geo.EARTH_RADIUS_NM for v in (0, 1, 90)]
    assert all(abs(r[0] - e) < 1e-9 for r, e in zip(out, expected))


def test_null_comparison(spark):
    assert [r[0] for r in evaluate(spark, ["a", "b", None], "string", ais.ne_null_true(F.col("v"), "a"))] == [False, True, True]
