"""Cleaning (M3): reference fixtures 1.2 and 1.4, quirks Q10, Q11, Q20, Q23, Q24."""

import datetime as dt

from tillroll.functions import columns as C
from tillroll.operators import clean, validate

DAY = dt.date(2026, 7, 21)


def transform_rows():
    return [
        ("10001", "A", "ITEM A", "2", "01/12/2010 08:26", "3.5", "12345", "United Kingdom"),
        ("10001", "A", "ITEM A", "2", "01/12/2010 08:26", "3.5", "12345", "United Kingdom"),
        ("10002", "B", None, "-1", "01/12/2010 08:26", "2.0", None, "France"),
        ("10003", "C", "ITEM C", "0", "01/12/2010 08:26", "1.0", "12346", "Canada"),
    ]


def cleaned_of(raw_frame, rows):
    # Description may be null here: cleaning fills it (the reference feeds
    # such frames to cleaning directly), so bypass validation's rejection.
    labelled = validate.label_rows(raw_frame(rows), DAY)
    typed = labelled.drop("rejection_reason", *validate.RAW_KEPT.values())
    return clean.clean_transactions(typed, DAY)


def test_removes_duplicates_and_zero_quantity(raw_frame):
    rows = cleaned_of(raw_frame, transform_rows()).orderBy("InvoiceNo").collect()
    assert len(rows) == 2
    assert [r.gross_sales for r in rows] == [7.0, -2.0]
    assert [r.return_amount for r in rows] == [0.0, 2.0]
    assert [r.net_sales for r in rows] == [7.0, 0.0]  # Q10: returns zeroed, not subtracted
    assert all(r.currency_code == "GBP" for r in rows)
    assert rows[1].Description == "Unknown product"
    assert rows[1].is_return


def test_country_mapping(spark):
    df = spark.createDataFrame([("United Kingdom",), ("France",), ("Canada",), (" uk\t",), ("",), ("EIRE",)], "c string")
    got = [r.r for r in df.select(C.country_to_region("c").alias("r")).collect()]
    assert got == ["United Kingdom", "Europe", "Other", "United Kingdom", "Other", "Europe"]


def test_strip_and_blank_codes(raw_frame):
    rows = [("\tc123 ", "\tA1 ", " ITEM ", "2", "01/12/2010 08:26", "1.0", None, " \t")]
    r = cleaned_of(raw_frame, rows).first()
    assert (r.InvoiceNo, r.StockCode, r.Description) == ("c123", "A1", "ITEM")
    assert r.Country == "" and r.region_name == "Other"  # Q23
    assert r.is_return  # Q11: C invoice with positive quantity is a return ...
    assert r.net_sales == 2.0 and r.return_amount == 0.0  # ... but still revenue


def test_rounding_is_half_even_on_binary(raw_frame):
    rows = [("1", "A", "X", "1", "01/12/2010 08:26", "0.125", None, "UK"),
            ("2", "B", "X", "1", "01/12/2010 08:26", "2.675", None, "UK"),
            ("3", "C", "X", "1", "01/12/2010 08:26", "1.005", None, "UK")]
    got = {r.InvoiceNo: r.gross_sales for r in cleaned_of(raw_frame, rows).collect()}
    assert got == {"1": 0.12, "2": 2.68, "3": 1.0}  # Q20


def test_dedup_happens_before_strip(raw_frame):
    rows = [("1", "A", "X", "1", "01/12/2010 08:26", "1.0", "7", "UK"),
            ("1", "A", "X", "1", "01/12/2010 08:26", "1.0", "7", "UK ")]
    assert cleaned_of(raw_frame, rows).count() == 2  # Q24: both survive


def test_cleaning_report_counts(raw_frame):
    rows = transform_rows() + [("10004", "D", "ITEM D", "1", "01/12/2010 08:26", "-1.0", None, "UK")]
    labelled = validate.label_rows(raw_frame(rows), DAY)
    report = clean.cleaning_report(labelled.drop("rejection_reason", *validate.RAW_KEPT.values())).first()
    assert report.rows_in == 5
    assert report.duplicate_rows == 1
    assert report.dropped_negative_price == 1  # Q26
    assert report.dropped_zero_quantity == 1
    assert report.rows_out == 2
