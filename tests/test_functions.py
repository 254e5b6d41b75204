import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.functions import cells, text


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column).first()[0]


def test_column_numbers():
    assert [cells.column_number(c) for c in ("A", "Z", "AA", "XY")] == [1, 26, 27, 649]
    with pytest.raises(ValueError):
        cells.column_number("a1")


def test_cell_by_letter(spark):
    row = spark.createDataFrame([(100, 100.5, 350, "error")], "p int, q double, r int, s string")
    assert row.select(cells.cell(row, "A"), cells.cell(row, "D")).first() == (100, "error")
    with pytest.raises(ValueError):
        cells.cell(row, "E")


@pytest.mark.parametrize("value,stripped", [("\t a ", "a"), (" x ", "x"), ("a b", "a b"), ("\n", ""), (None, None)])
def test_strip_all(spark, value, stripped):
    assert one(spark, text.strip_all(F.col("v")), v=value) == stripped


@pytest.mark.parametrize(
    "value,number",
    [("12", 12.0), (" -1.5e2 ", -150.0), (".5", 0.5), ("12D", None), ("nan", None), ("", None), ("1,000", None), (None, None)],
)
def test_number_in_text(spark, value, number):
    assert one(spark, cells.number(F.col("v")), v=value) == number


@pytest.mark.parametrize(
    "a,b,percent", [("", "", 100.0), (None, "", 100.0), (None, "abc", 0.0), ("é", "e", 0.0), ("MCH1", "MCH 12345", 4 / 9 * 100)]
)
def test_similarity(spark, a, b, percent):
    assert one(spark, text.similarity_percent(F.col("a"), F.col("b")), a=a, b=b) == pytest.approx(percent)


def test_similar_at_least_agrees_with_percentage(spark):
    words = ["", "a", "ab", "abc", "abd", "abcde", "abxyz", "abcdefghij", "abcdefxxxx", "abcdexxxxx", "zzzzz", "Abcde"]
    pairs = spark.createDataFrame([(a, b) for a in words for b in words], "a string, b string")
    for limit in (50, 60, 90):
        close = text.similar_at_least(F.col("a"), F.col("b"), limit)
        exact = text.similarity_percent(F.col("a"), F.col("b")) >= limit
        assert pairs.where(close != exact).count() == 0


def test_extracts(spark):
    assert one(spark, text.in_parentheses(F.col("v")), v="AF-ID(60017962) x(y)") == "60017962"
    assert one(spark, text.in_parentheses(F.col("v")), v="none") == ""
    assert one(spark, text.after_colon(F.col("v")), v="ID:a:b") == "a:b"
    assert one(spark, text.suffix_from(F.col("v"), 11), v="SCOPUS_ID:123") == "123"


def test_whole_days_and_dates(spark):
    moment = dt.datetime
    rows = [
        (moment(2024, 1, 1, 23), moment(2024, 1, 6, 1), 4),
        (moment(2024, 1, 6, 1), moment(2024, 1, 1, 23), -5),
        (moment(2024, 3, 9, 12), moment(2024, 3, 11, 12), 2),
    ]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz, days bigint")
    assert df.where(cells.whole_days(F.col("a"), F.col("b")) != F.col("days")).count() == 0
    assert one(spark, cells.day_or_null(F.col("v")), v="July 2021") is None
    assert one(spark, cells.day_or_null(F.col("v")), v="2021-07-08") == dt.date(2021, 7, 8)


def test_labels(spark):
    codes = {"MB": "Manitoba", "MA": "Manitoba"}
    df = spark.createDataFrame([("MB",), ("MA",), ("ZZ",), (None,)], "c string")
    assert [r[0] for r in df.select(cells.label(F.col("c"), codes)).collect()] == ["Manitoba", "Manitoba", None, None]
    flags = spark.createDataFrame([(True,), (False,), (None,)], "f boolean")
    labels = [r[0] for r in flags.select(cells.open_access_label(F.col("f"))).collect()]
    assert labels == ["Open Access", "Not Open Access", "Not Open Access"]


def test_registered_functions(spark):
    cells.register_scaled(spark, "converted_value")
    assert spark.sql("SELECT converted_value(2D), converted_value(NULL)").first() == (3.0, None)

    def doubled(values: pd.Series) -> pd.Series:
        return values * 2

    cells.register_python(spark, "doubled", doubled, "double")
    assert spark.sql("SELECT doubled(1.25D)").first()[0] == 2.5
    with pytest.raises(ValueError):
        cells.register_scaled(spark, "a b")
