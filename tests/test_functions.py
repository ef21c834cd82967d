"""Column functions on edge cases."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from silverline.functions import dates, links, numbers, rules, text


def values(spark, column, items, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


def test_money(spark):
    items = ["$1,234.50", "$.00", ".00", "", "abc", "1e3", " 12.5 ", "1.005", "99999999999", "-$5.00", None]
    got = values(spark, lambda c: numbers.money(c, 12), items)
    want = ["1234.50", "0.00", "0.00", None, None, "1000.00", "12.50", "1.01", None, "-5.00", None]
    assert got == [None if w is None else Decimal(w) for w in want]


def test_whole_number_rounds_and_bounds(spark):
    items = ["1", "1.7", "1e2", "abc", "40000", "", None, "-2.5"]
    assert values(spark, numbers.whole_number, items) == [1, 2, 100, None, None, None, None, -3]
    assert values(spark, lambda c: numbers.whole_number(c, "int"), ["40000"]) == [40000]


def test_dates(spark):
    items = ["08/03/2025", "8/3/2025", "02/30/2025", "", "bad", None]
    day = dt.date(2025, 8, 3)
    assert values(spark, dates.parse_date, items) == [day, day, None, None, None, None]
    moments = values(spark, dates.parse_timestamp, ["08/03/2025 07:05:09", "8/3/2025 7:5:9", "08/03/2025", ""])
    assert moments == [dt.datetime(2025, 8, 3, 7, 5, 9)] * 2 + [None, None]


def test_fiscal_calendar_boundaries(spark):
    days = [dt.date(2024, 6, 30), dt.date(2024, 7, 1), dt.date(2024, 12, 31), dt.date(2025, 1, 1), None]
    assert values(spark, dates.fiscal_year, days, "date") == [2024, 2025, 2025, 2025, None]
    assert values(spark, dates.fiscal_quarter, days, "date") == [4, 1, 2, 3, None]


def test_weekdays_and_business_hours(spark):
    items = [dt.datetime(2025, 8, 3, 10), dt.datetime(2025, 8, 4, 7, 59), dt.datetime(2025, 8, 4, 8), dt.datetime(2025, 8, 8, 16, 59), dt.datetime(2025, 8, 8, 17), dt.datetime(2025, 8, 9, 9), None]
    kind = "timestamp_ntz"
    assert values(spark, dates.day_index, items, kind) == [0, 1, 1, 5, 5, 6, None]
    assert values(spark, dates.day_name, items, kind) == ["Sunday", "Monday", "Monday", "Friday", "Friday", "Saturday", None]
    assert values(spark, dates.in_business_hours, items, kind) == [False, False, True, True, False, False, None]


def test_boundary_counts(spark):
    df = spark.sql("select date'2024-01-31' a, date'2024-02-01' b, date'2024-12-31' c, date'2025-01-01' d")
    row = df.select(
        dates.month_boundaries(F.col("a"), F.col("b")), dates.year_boundaries(F.col("c"), F.col("d")), dates.days_between(F.col("b"), F.col("a"))
    ).first()
    assert tuple(row) == (1, 1, -1)


def test_window_kind(spark):
    df = spark.sql("select date'2024-02-01' a, date'2024-02-29' b, date'2024-02-28' c")
    row = df.select(*[dates.window_kind(F.col(x), F.col(y)) for x, y in (("a", "b"), ("a", "a"), ("a", "c"))]).first()
    assert tuple(row) == ("full_month", "single_day", "custom")


def test_requestable_dates(spark):
    items = ["01/31/2018", "01/30/2018", "02/30/2020", "08/25/2025", None, "08/24/2026"]
    asof = dt.date(2025, 8, 24)
    assert values(spark, lambda c: dates.is_requestable(c, asof, "2018-01-31"), items) == [True, False, False, False, False, False]
    assert values(spark, lambda c: dates.is_requestable(c, asof, latest="asof+1y"), items)[3:] == [True, False, True]


def test_id_parts(spark):
    items = ["A-1:2", "A-1.3", "A:1.7", "A-1", "A:abc", None]
    assert values(spark, lambda c: text.base_id(c, ":."), items) == ["A-1", "A-1", "A", "A-1", "A", None]
    revision = lambda c: numbers.whole_number(text.revision_text(c, ":."))
    assert values(spark, revision, items) == [2, 3, 2, 0, None, 0]


def test_blank_policies(spark):
    items = [None, "", "  ", "x"]
    assert values(spark, lambda c: text.is_missing(c), items) == [True, False, False, False]
    assert values(spark, lambda c: text.is_missing(c, "blank"), items) == [True, True, True, False]
    assert values(spark, text.blank_to_null, [" a ", " ", None]) == ["a", None, None]
    with pytest.raises(ValueError):
        text.is_missing(F.col("x"), "odd")


def test_part_count(spark):
    assert values(spark, text.part_count, [None, "", "A", "A,B,C", "A,", " "]) == [0, 0, 1, 3, 2, 1]


def test_digit_extraction(spark):
    items = ["(775) 555-0100", "7755550100", "a1b2", None, "\n12-3"]
    assert values(spark, text.digits, items) == ["7755550100", "7755550100", "12", None, "123"]
    assert values(spark, text.drop_first_non_digit, items) == ["775) 555-0100", "7755550100", "1b2", None, "12-3"]


def test_phone_classes(spark):
    items = ["775-555-0100", "17755550100", "775 555 0100 EXT 5", "555-0100", None, "27755550100"]
    got = values(spark, lambda c: rules.phone_type(c, text.digits(c)), items)
    assert got == ["Standard", "Standard with 1", "With Extension", "Incomplete", "Non-standard", "Non-standard"]


def test_vendor_rules(spark):
    names = ["PRINCE", "Acme, LLC", "X CO.", "A CO B", "HP Inc", "ODP", None, "State of Art", "Dba X", "Coca"]
    kinds = values(spark, lambda c: rules.first_match(c, rules.VENDOR_TYPE), names)
    assert kinds == ["Corporation", "LLC", "Company", "Company", "Corporation", "Other", "Other", "Government", "DBA", "Other"]
    brands = values(spark, lambda c: rules.first_match(c, rules.VENDOR_BRAND), names)
    assert brands[4:6] == ["HP", "Office Depot"]


def test_amount_bands(spark):
    items = [Decimal("0.00"), Decimal("-5.00"), Decimal("999.99"), Decimal("1000.00"), Decimal("1000000.00"), None]
    kind = "decimal(15,2)"
    assert values(spark, rules.amount_band, items, kind) == [
        "Zero", "Micro (<$1K)", "Micro (<$1K)", "Small ($1K-$10K)", "Mega (>$1M)", "Mega (>$1M)",
    ]
    strict = values(spark, lambda c: rules.amount_band(c, strict=True), items, kind)
    assert strict[1] is None and strict[5] is None and strict[0] == "Zero"


def test_row_hash_modes(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    plain = [r[0] for r in df.select(text.row_hash(["x", "y", "z"])).collect()]
    marked = [r[0] for r in df.select(text.row_hash(["x", "y", "z"], null_marker="~")).collect()]
    first = [r[0] for r in df.select(text.row_hash(["x", "y", "z"], mode="first_column")).collect()]
    assert plain[0] == plain[1] and marked[0] != marked[1] and first[0] == first[1] != plain[0]


def test_links_and_ids(spark):
    got = values(spark, lambda c: links.record_link(c, "vendor", "host.example"), [" VEN 1 ", " ", None])
    assert got == ["https://host.example/bso/external/vendor/vendorProfileOrgInfo.sda?external=true&vendorId=VEN+1", None, None]
    valid = {
        "contract": (["80DOT-MC3960", "BRDCOM-NV23-16122", "99SWC-NV26-26028", "x"], [True, True, True, False]),
        "bid_detail": (["30DOE-S3449", "CTYNLV-S3414", "30DOE-3449", None], [True, True, False, False]),
        "vendor": (["VEN1975", "VEN", "ven1", ""], [True, False, False, False]),
        "purchase_order": (["IGOR 535881", "", None, "R59848"], [True, False, False, True]),
    }
    for kind, (items, want) in valid.items():
        assert values(spark, lambda c, kind=kind: links.has_valid_id(c, kind), items) == want
    with pytest.raises(ValueError):
        links.record_link(F.col("x"), "other")


def test_rounded_ratio(spark):
    df = spark.createDataFrame([(Decimal("10.00"), 0), (Decimal("10.00"), 3), (None, 3)], "a decimal(12,2), n int")
    got = [r[0] for r in df.select(numbers.rounded_ratio(F.col("a"), F.col("n"))).collect()]
    assert got == [None, Decimal("3.33"), None]
