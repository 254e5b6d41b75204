import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import flagging
from tallyloom.operators.flagging import Cell, all_of, any_of, clause, empty, member, negate
from tallyloom.operators.rules import with_list_flags
from tallyloom.plans import spend_audit as plan

SHEET = "a double, b double, c double, d string"


def answers(spark, condition, *rows, schema=SHEET, loose=False):
    df = spark.createDataFrame(list(rows), schema)
    return [r.Results for r in flagging.flag_rows(df, condition, loose=loose).select("Results").collect()]


def test_numeric_row(spark):
    row = (100.0, 100.5, 350.0, "error")
    assert answers(spark, clause("A", ">=", 100), row) == ["Yes"]
    assert answers(spark, clause("B", ">", 100), row) == ["Yes"]
    assert answers(spark, all_of(clause("A", ">", 50), clause("C", "<", 400)), row) == ["Yes"]
    assert answers(spark, clause("B", "<", 100), row) == ["No"]
    assert answers(spark, clause("D", "<", 100), row) == ["INVALID"]


def test_text_cells(spark):
    one = lambda value: (0.0, 0.0, 0.0, value)
    rows = [one("Sales"), one("5"), one(None)]
    assert answers(spark, clause("D", "==", "Sales"), *rows) == ["Yes", "No", "No"]
    assert answers(spark, clause("D", "!=", "Sales"), *rows) == ["No", "Yes", "Yes"]
    assert answers(spark, clause("D", ">", 4), *rows) == ["INVALID"] * 3
    assert answers(spark, clause("D", "==", 5), *rows) == ["No"] * 3
    assert answers(spark, clause("D", ">", 4), *rows, loose=True) == ["INVALID", "Yes", "INVALID"]
    assert answers(spark, clause("D", "==", 5), *rows, loose=True) == ["No", "Yes", "No"]
    assert answers(spark, clause("A", "==", "Sales"), *rows) == ["No", "No", "No"]
    assert answers(spark, clause("A", "<", "Sales"), *rows) == ["INVALID"] * 3


def test_dates_truth_values_and_terms(spark):
    schema = "a double, b boolean, c date, d string"
    rows = [(2.0, True, dt.date(2022, 3, 1), "x"), (0.0, False, None, None)]
    check = lambda condition: answers(spark, condition, *rows, schema=schema)
    assert check(clause("C", ">", dt.date(2022, 2, 28))) == ["Yes", "INVALID"]
    assert check(clause("C", ">", 3)) == ["INVALID", "INVALID"]
    assert check(clause("B", "==", 1)) == ["Yes", "No"]
    assert check(clause("B", "<", 1)) == ["No", "Yes"]
    assert check(negate(clause("B", "==", True))) == ["No", "Yes"]
    assert check(negate(clause("C", ">", 3))) == ["INVALID", "INVALID"]
    assert check(empty("D")) == ["No", "Yes"]
    assert check(member("D", ["x", 2, Cell("A")])) == ["Yes", "No"]
    assert check(clause(Cell("A") / Cell("A"), "==", 1)) == ["Yes", "INVALID"]
    assert check(clause(Cell("A") + Cell("B") * 3 - 1, "==", 4)) == ["Yes", "No"]
    assert check(clause(Cell("D") + "y", "==", "xy")) == ["Yes", "INVALID"]
    assert check(clause(Cell("D") + 1, "==", "x1")) == ["INVALID", "INVALID"]


def test_order_of_evaluation(spark):
    row = (1.0, None, 3.0, "x")
    broken = clause("B", ">", 0)
    assert answers(spark, all_of(clause("A", ">", 5), broken), row) == ["No"]
    assert answers(spark, all_of(broken, clause("A", ">", 5)), row) == ["INVALID"]
    assert answers(spark, any_of(clause("A", ">", 0), broken), row) == ["Yes"]
    assert answers(spark, any_of(broken, clause("A", ">", 0)), row) == ["INVALID"]
    assert answers(spark, clause("A", "<", Cell("C")), row) == ["Yes"]


def test_bad_conditions_fail_early(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    with pytest.raises(ValueError):
        clause("A", "=>", 1)
    with pytest.raises(ValueError):
        clause("A", ">", None)
    with pytest.raises(ValueError):
        flagging.flag_rows(df, clause("Q", ">", 1))
    with pytest.raises(ValueError):
        flagging.flag_rows(df, clause("missing", ">", 1))


def test_threshold_flag_never_says_invalid(spark):
    df = spark.createDataFrame([("1000.01",), ("1000",), ("text",), (None,)], "g string")
    assert [r.Results for r in flagging.flag_above(df, "g").collect()] == ["Yes", "No", "No", "No"]


MASTER = (
    "row_index bigint, cardholder string, merchant string, description string, date timestamp_ntz, total double, "
    "merchant_category string, gl_code string, criteria string"
)
DAY = dt.datetime(2022, 3, 24)


def audit_rows(spark, *rows, **options):
    def sheet(entries):
        return spark.createDataFrame([("x", e, e) for e in entries], "a string, b string, c string")

    sheets = {
        "Master": spark.createDataFrame(list(rows), MASTER),
        "FPS CHs": sheet([" exempt ", None, ""]),
        "RCM CHs": sheet(["BOSS", "boss"]),
        "DSC": sheet(["\tBig Conference\n", "BIG CONFERENCE"]),
    }
    result = plan.audit_sheets(sheets, **options).select("row_index", "criteria", "highlight").collect()
    return {r.row_index: (r.criteria, r.highlight) for r in result}


def test_rules(spark):
    row = lambda i, who="CH", shop="S", total=1.0, mcc=None, gl=None, old=None: (
        i, who, f"{shop}", None, DAY + dt.timedelta(days=20 * i), total, mcc, gl, old,
    )
    got = audit_rows(
        spark,
        row(1, mcc="9399"),
        row(2, mcc="4111", gl="54208"),
        row(3, gl="54287"),
        row(4, gl="54000", total=10000.0),
        row(5, shop="CHEQUE", total=None),
        row(6, gl="52334", shop="Big conference"),
        row(7, gl="52136", shop="other"),
        row(8, gl="54260", total=800.0),
        row(9, gl="54260", total=800.0, who="EXEMPT"),
        row(10, who="BOSS", mcc="7932", old="before"),
        row(11, who=None, mcc="9399", old="kept"),
        row(12),
        row(13, gl="52204"),
        row(14, gl="52337"),
        (15, "CH", None, None, None, 1.0, None, "52136", ""),
    )
    travel = "Restricted Travel Status Related Expenses"
    assert got[1] == ("Restricted IS/OGD transactions", "Cornsilk")
    assert got[2] == (travel, "NavajoWhite")
    assert got[3] == ("Restricted Motor Vehicles Expenses", "DarkSeaGreen")
    assert got[4] == ("TA Limit exceeded AND Restricted Motor Vehicles Expenses", "DarkSeaGreen")
    assert got[5] == ("Monitoring of Convenience Cheques", "RosyBrown")
    assert got[6] == ("Financial Coding Error - Designated Science Conferences", "Pink")
    assert got[7] == ("Conference fees", "HotPink")
    assert got[8] == (f"{travel} AND Restricted Home Equipment Purchases", "Olive")
    assert got[9] == (travel, "NavajoWhite")
    assert got[10] == ("before AND Event/Hospitality AND SoD - TA and s.34", "Aqua")
    assert got[11] == ("kept", None)
    assert got[12] == (None, None)
    assert got[13] == ("Hospitality", "Gold")
    assert got[14] == ("Restricted Memberships", "Violet")
    assert got[15] == ("Conference fees", "HotPink")


def test_splits_come_last_and_skip_exempt_rows(spark):
    rows = [(i, "CH", "SHOP", None, DAY, 6000.0, "9399", None, None) for i in (2, 3)]
    rows += [(i, "EXEMPT", "SHOP", None, DAY, 6000.0, None, None, None) for i in (4, 5)]
    rows += [(i, "CH2", "SHOP", None, DAY, 6000.0, None, "52008", None) for i in (6, 7)]
    got = audit_rows(spark, *rows)
    assert got[2] == got[3] == ("Restricted IS/OGD transactions AND Potential Splits", "OrangeRed")
    assert [got[i] for i in (4, 5, 6, 7)] == [(None, None)] * 4


def test_missing_sheet_stops_at_once(spark):
    with pytest.raises(ValueError, match="DSC"):
        plan.audit_sheets({"Master": None, "FPS CHs": None, "RCM CHs": None})


def test_master_by_letters(spark):
    values = [f"v{i}" for i in range(34)]
    values[3], values[4] = "2022-03-24", "12.5"
    df = spark.createDataFrame([(7, *values)], ", ".join(["row int", *[f"c{i} string" for i in range(34)]]))
    row = plan.master_rows(df).first()
    assert (row.row_index, row.cardholder, row.merchant_category, row.gl_code) == (7, "v0", "v13", "v30")
    assert (row.date, row.total) == (DAY, 12.5)


def test_hits_include_rules_without_any(spark):
    df = spark.createDataFrame([(1, "CH", "S", None, DAY, 1.0, "9399", None, None)], MASTER)
    empty = spark.createDataFrame([], "entry string")
    hits = plan.hits_per_rule(with_list_flags(df, empty, empty, empty)).orderBy("position").collect()
    assert [h.hits for h in hits] == [1] + [0] * 11
    assert df.select(F.lit(1)).count() == 1
