from datetime import date, datetime

import pytest
from hypothesis import given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterlake.functions import (
    calendar_columns,
    format_timestamp,
    measurement_type,
    measurement_unit,
    minute_bucket,
    parse_as,
    parse_double,
    parse_int,
    parse_timestamp,
)


def evaluate(spark, texts, function):
    rows = [(i, text) for i, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, c string")
    return [row[0] for row in df.orderBy("i").select(function(F.col("c"))).collect()]


def test_numbers(spark):
    texts = ["17", "17.9", "-3.9", "x17", " 17 ", "1e3", "1,5", "", None, "9999999999"]
    assert evaluate(spark, texts, parse_int) == [
        17, 17, -3, None, 17, 1000, None, None, None, None
    ]
    assert evaluate(spark, texts, parse_double) == [
        17.0, 17.9, -3.9, None, 17.0, 1000.0, None, None, None, 9999999999.0
    ]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/Sao_Paulo"])
def test_timestamps_are_wall_clock_times(spark, settings, zone):
    texts = [
        "27.03.2022 02:30:00", "31.12.2022 23:00:00", "29.02.2024 00:00:00",
        "01.01.0001 00:00:00", "29.02.2022 00:00:00", "01.01.2022 24:00:00",
        "1.2.2022 5:00:00", "kaputt", "", None, "2022-01-01 00:00:00",
        "01.01.2022 00:00:00\n", "01.01.2022 00:00:00Z", "x\n01.01.2022 00:00:00",
        "01.01.2022 00:00", "01.01.2022 00:00:00.5",
    ]
    good = [
        datetime(2022, 3, 27, 2, 30), datetime(2022, 12, 31, 23), datetime(2024, 2, 29),
        datetime(1, 1, 1),
    ]
    with settings({"spark.sql.session.timeZone": zone}):
        assert evaluate(spark, texts, parse_timestamp) == good + [None] * (len(texts) - 4)


@hypothesis_settings(deadline=None, max_examples=5)
@given(st.lists(st.text(max_size=25), min_size=200, max_size=400))
def test_any_text_parses_or_is_null(spark, texts):
    for kind in ("int", "double", "timestamp", "string"):
        assert len(evaluate(spark, texts, lambda c, kind=kind: parse_as(c, kind))) == len(texts)


def test_format_is_the_inverse_of_parse(spark):
    texts = ["07.02.2023 04:05:06"]
    assert evaluate(spark, texts, lambda c: format_timestamp(parse_timestamp(c))) == texts


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/New_York"])
def test_format_keeps_times_that_a_zone_skips(spark, settings, zone):
    texts = ["27.03.2022 02:30:00", "13.03.2022 02:15:59", "30.10.2022 02:30:00", "01.01.0999 00:00:00"]
    with settings({"spark.sql.session.timeZone": zone}):
        assert evaluate(spark, texts, lambda c: format_timestamp(parse_timestamp(c))) == texts
        assert evaluate(spark, [None], lambda c: format_timestamp(parse_timestamp(c))) == [None]


def test_measurement_type_and_unit(spark):
    names = ["Strom_GOM_M1", "007", "", "_x", None, "Nutzungsgrad_GOM_M3_el"]
    assert evaluate(spark, names, measurement_type) == [
        "Strom", "007", "", "", None, "Nutzungsgrad"
    ]
    assert evaluate(spark, ["Nutzungsgrad", "Strom", None], measurement_unit) == [
        "%", "kWh", "kWh"
    ]


def test_calendar_columns(spark):
    df = spark.sql("select timestamp_ntz'2022-03-27 02:30:59' as t")
    assert tuple(df.select(*calendar_columns(F.col("t")).values()).first()) == (
        date(2022, 3, 27), 2022, 3, 27, 2, 30
    )


def test_minute_bucket(spark):
    texts = ["0", "59.9", "60", "120.5", "-1", "x"]
    assert evaluate(spark, texts, lambda c: minute_bucket(parse_double(c))) == [
        1, 1, 2, 3, 0, None
    ]
