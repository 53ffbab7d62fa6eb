"""Column helpers on hand-written rows."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import dates, money, stats, text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("raw", "kept"), [("V-123", "123"), ("j-9", "9"), ("V", ""), ("", ""), (None, None)]
)
def test_document_prefix(spark, raw, kept):
    assert one(spark, text.after_prefix(F.lit(raw).cast("string"))) == kept


@pytest.mark.parametrize(
    ("raw", "clean"), [("  ", None), ("", None), (" a ", "a"), ("\t", "\t"), (None, None)]
)
def test_blank_becomes_null(spark, raw, clean):
    assert one(spark, text.blank_to_null(F.lit(raw).cast("string"))) == clean


@pytest.mark.parametrize(
    ("raw", "shown"),
    [
        ("ajuste manual", "Ajuste Manual"),
        ("ajuste-MANUAL", "Ajuste-Manual"),
        ("3er turno", "3er Turno"),
        ("a--b", "A--B"),
        ("", ""),
    ],
)
def test_capitalize_words(spark, raw, shown):
    assert one(spark, text.capitalize_words(F.lit(raw))) == shown


def test_shorten(spark):
    assert one(spark, text.shorten(F.lit("abcdef"), 6)) == "abcdef"
    assert one(spark, text.shorten(F.lit("abcdefg"), 6)) == "abcde…"


def test_report_text(spark):
    amount = F.lit(Decimal("1234567.50"))
    assert one(spark, text.amount_text(amount)) == "1,234,567.50"
    assert one(spark, text.amount_text(amount, 0)) == "1,234,568"
    assert one(spark, text.percent_text(F.lit(Decimal("12.34")), 1)) == "12.3%"
    assert one(spark, text.percent_text(F.lit(Decimal("44.45")), 1)) == "44.5%"
    assert one(spark, text.percent_text(F.lit(Decimal("44.35")), 1)) == "44.4%"
    assert one(spark, text.integer_text(F.lit(1234))) == "1,234"
    for render in (text.amount_text, text.percent_text, text.integer_text):
        assert one(spark, render(F.lit(None).cast("decimal(18,2)"))) == "-"


@pytest.mark.parametrize(
    ("day", "label", "weekday"),
    [
        ("2024-12-30", "2025-S01", 1),
        ("2021-01-03", "2020-S53", 7),
        ("2024-01-07", "2024-S01", 7),
        ("2024-06-01", "2024-S22", 6),
    ],
)
def test_iso_calendar(spark, day, label, weekday):
    column = F.lit(day).cast("date")
    assert one(spark, dates.iso_week_label(column)) == label
    assert one(spark, dates.iso_weekday(column)) == weekday


def test_stacked_periods(spark):
    periods = one(spark, dates.stacked_periods(F.lit("2024-12-30").cast("date")))
    assert [tuple(p) for p in periods] == [
        ("DIA", date(2024, 12, 30), "2024-12-30"),
        ("SEMANA", date(2024, 12, 30), "2025-S01"),
        ("MES", date(2024, 12, 1), "2024-12"),
        ("ANIO", date(2024, 1, 1), "2024"),
    ]


@pytest.mark.parametrize(
    ("raw", "rounded"),
    [
        (2.675, "2.68"),
        (2.6749999999999994, "2.68"),  # binary noise is dropped first
        (1.005, "1.01"),
        (-1.005, "-1.01"),
        (104997.88 / 3, "34999.29"),
        (0.1 + 0.2, "0.30"),
    ],
)
def test_money_rounds_half_away_from_zero(spark, raw, rounded):
    assert one(spark, money.money(F.lit(raw))) == Decimal(rounded)


def test_money_out_of_range_is_null(spark):
    assert one(spark, money.money(F.lit(1e13))) is None
    assert one(spark, money.money(F.lit(1e11), 12)) is None
    assert one(spark, money.money(F.lit(float("nan")))) is None


@pytest.mark.parametrize(("raw", "n"), [(2.5, 2), (3.5, 4), (2.6, 3), (-2.6, -3), (1e12, None)])
def test_whole_rounds(spark, raw, n):
    assert one(spark, money.whole(F.lit(raw))) == n


def test_ratios(spark):
    hundred, three, zero = F.lit(Decimal("100.00")), F.lit(3), F.lit(0)
    assert one(spark, money.ratio(hundred, three)) == Decimal("33.33")
    assert one(spark, money.ratio(hundred, zero)) is None
    assert one(spark, money.percent(three, hundred)) == Decimal("3.00")
    assert one(spark, money.change(F.lit(Decimal("110.00")), hundred)) == Decimal("10.00")
    assert one(spark, money.change(hundred, F.lit(Decimal("0.00")))) is None


def correlate(spark, pairs):
    df = spark.createDataFrame(pairs, "y double, x double")
    return df.select(stats.correlation(F.col("y"), F.col("x")).alias("r")).first().r


def test_correlation(spark):
    assert correlate(spark, [(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)]) == pytest.approx(1.0)
    assert correlate(spark, [(1.0, 2.0), (2.0, 1.0)]) == pytest.approx(-1.0)
    assert correlate(spark, [(1.0, 5.0), (2.0, 5.0)]) is None
    assert correlate(spark, [(1.0, 5.0)]) is None
    assert correlate(spark, [(1.0, None), (None, 1.0)]) is None
    skipped = [(1.0, 2.0), (9.0, None), (2.0, 4.0), (None, 7.0), (3.0, 6.5)]
    complete = [p for p in skipped if None not in p]
    assert correlate(spark, skipped) == pytest.approx(correlate(spark, complete))
