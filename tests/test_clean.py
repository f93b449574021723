"""Scalar normalisation, case by case."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cofre.functions import clean


def one(spark, value, schema, result):
    return spark.createDataFrame([(value,)], f"v {schema}").select(result(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("  a \t\n b  ", "a b"),
        ("a  b ", "a b"),
        ("\x1fa\x1cb", "a b"),
        (" a　b", "a b"),
        ("", ""),
        ("   ", ""),
        (None, None),
    ],
)
def test_tidy(spark, text, wanted):
    assert one(spark, text, "string", clean.tidy) == wanted


def test_clean_text_takes_every_string_column(spark):
    row = clean.clean_text(spark.createDataFrame([(1, " a  b ", None)], "i int, s string, n string")).first()
    assert tuple(row) == (1, "a b", None)


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("123.456.789-01", "12345678901"),
        ("1234567890", None),
        ("123456789012", None),
        ("", None),
        (None, None),
        ("١٢٣٤٥٦٧٨٩٠١", "١٢٣٤٥٦٧٨٩٠١"),
    ],
)
def test_cpf(spark, text, wanted):
    assert one(spark, text, "string", clean.normalize_cpf) == wanted


def test_card(spark):
    assert one(spark, "4000 1234-5678 9012", "string", clean.normalize_card) == "4000123456789012"
    assert one(spark, "4000 123", "string", clean.normalize_card) is None
    assert one(spark, "4000123456789012", "string", clean.mask_card) == "**** **** **** 9012"


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("1.005", "1.00"),
        ("1.015", "1.02"),
        ("-1.005", "-1.00"),
        ("1.00500000000000000001", "1.01"),
        ("1e3", "1000.00"),
        (" 7 ", "7.00"),
        ("1_000", "1000.00"),
        ("-0.001", "0.00"),
        ("1,50", None),
        ("abc", None),
        ("", None),
        ("Infinity", None),
        ("NaN", None),
        ("1E+40", None),
        ("9999999999999.99", "9999999999999.99"),
        ("99999999999999.99", None),
        (None, None),
    ],
)
def test_money_from_text(spark, text, wanted):
    got = one(spark, text, "string", clean.normalize_money)
    assert (None if got is None else str(got)) == wanted


def test_money_from_numbers(spark):
    assert str(one(spark, 2.675, "double", clean.normalize_money)) == "2.68"
    assert str(one(spark, 0.125, "double", clean.normalize_money)) == "0.12"
    assert str(one(spark, 5, "int", clean.normalize_money)) == "5.00"
    kept = spark.sql("select 1.005bd v").select(clean.normalize_money(F.col("v"), T.DecimalType(4, 3)).alias("r"))
    assert str(kept.first()["r"]) == "1.00"


def test_date(spark):
    assert one(spark, "2024-02-29", "string", clean.normalize_date) == date(2024, 2, 29)
    assert one(spark, "2023-02-29", "string", clean.normalize_date) is None
    assert one(spark, "not-a-date", "string", clean.normalize_date) is None
    assert one(spark, datetime(2024, 1, 2, 23, 59), "timestamp_ntz", clean.normalize_date) == date(2024, 1, 2)


UTC_CASES = [
    (datetime(2024, 5, 1, 10), datetime(2024, 5, 1, 13)),
    (datetime(2018, 11, 4, 0, 30), None),  # gap
    (datetime(2018, 11, 3, 23, 59, 59), datetime(2018, 11, 4, 2, 59, 59)),
    (datetime(2018, 11, 4, 1), datetime(2018, 11, 4, 3)),
    (datetime(2018, 2, 17, 23, 30), None),  # overlap
    (datetime(2018, 2, 17, 22, 59, 59), datetime(2018, 2, 18, 0, 59, 59)),
    (datetime(2018, 2, 18, 0), datetime(2018, 2, 18, 3)),
    (datetime(2018, 11, 5, 0, 30), datetime(2018, 11, 5, 2, 30)),  # a day after a gap
    (datetime(2018, 2, 18, 23, 30), datetime(2018, 2, 19, 2, 30)),  # a day after an overlap
    (datetime(2018, 11, 3, 0, 30), datetime(2018, 11, 3, 3, 30)),  # a day before a gap
    (datetime(2018, 2, 16, 23, 30), datetime(2018, 2, 17, 1, 30)),  # a day before an overlap
]


@pytest.mark.parametrize("local, wanted", UTC_CASES)
def test_local_time_to_utc(spark, local, wanted):
    normalise = lambda c: clean.normalize_timestamp(c, T.TimestampNTZType())
    assert one(spark, local, "timestamp_ntz", normalise) == wanted


def test_local_time_agrees_with_zone_database(spark):
    """Every half hour around all clock changes of ten years, against the standard library."""
    from datetime import timedelta, timezone
    from zoneinfo import ZoneInfo

    zone = ZoneInfo("America/Sao_Paulo")
    moments = [datetime(2010, 1, 1) + timedelta(minutes=30 * i) for i in range(48 * 365 * 10)]
    got = (
        spark.createDataFrame([(m,) for m in moments], "v timestamp_ntz")
        .select("v", clean.local_to_utc(F.col("v")).alias("r"))
        .collect()
    )
    for local, utc in got:
        read = {
            candidate
            for fold in (0, 1)
            for candidate in [local.replace(tzinfo=zone, fold=fold).astimezone(timezone.utc)]
            if candidate.astimezone(zone).replace(tzinfo=None) == local
        }
        wanted = read.pop().replace(tzinfo=None) if len(read) == 1 else None
        assert utc == wanted, local


def test_zoned_input_is_converted(spark):
    text = lambda c: clean.normalize_timestamp(c, T.StringType())
    assert one(spark, "2024-05-01T10:00:00+02:00", "string", text) == datetime(2024, 5, 1, 8)
    assert one(spark, "2024-05-01T10:00:00Z", "string", text) == datetime(2024, 5, 1, 10)
    assert one(spark, "2024-05-01 10:00:00", "string", text) == datetime(2024, 5, 1, 13)
    assert one(spark, "2024-05-01", "string", text) == datetime(2024, 5, 1, 3)
    assert one(spark, "soon", "string", text) is None
    zoned = spark.sql("select timestamp '2024-05-01 10:00:00+02:00' v")
    got = zoned.select(clean.normalize_timestamp(F.col("v"), T.TimestampType()).alias("r")).first()["r"]
    assert got == datetime(2024, 5, 1, 8)


@pytest.mark.parametrize("session_zone", ["Asia/Tokyo", "America/Sao_Paulo"])
def test_session_zone_does_not_matter(spark, session_zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        for local, wanted in UTC_CASES:
            normalise = lambda c: clean.normalize_timestamp(c, T.TimestampNTZType())
            assert one(spark, local, "timestamp_ntz", normalise) == wanted
        zoned = spark.sql("select timestamp '2024-05-01 10:00:00+02:00' v")
        got = zoned.select(clean.normalize_timestamp(F.col("v"), T.TimestampType()).alias("r")).first()["r"]
        assert got == datetime(2024, 5, 1, 8)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_only_full_dates_are_dates(spark):
    texts = ["2024-05-01", "2024-05-01 10:00:00", "2024-05-01T10:00:00", "2024", "2024-05", "2024-5-1", "99999-01-01", "2024-02-30", "", None, "x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r[0] for r in df.select(clean.normalize_date(F.col("t"))).collect()]
    assert [d and d.isoformat() for d in found] == ["2024-05-01"] * 3 + [None] * 8
