"""Validation (M1): reference fixture 1.1 and the Keep/Fix quirks Q2-Q7, Q21."""

import datetime as dt

import pytest

from tillroll.operators import validate

DAY = dt.date(2026, 7, 21)


def sample_rows():
    return [
        ("10001", "A", "ITEM A", "2", "01/12/2010 08:26", "3.5", "12345", "United Kingdom"),
        ("10002", "B", "ITEM B", "-1", "01/12/2010 08:30", "2.0", None, "United Kingdom"),
    ]


def test_keeps_nullable_customer_id(raw_frame):
    result = validate.validate(raw_frame(sample_rows()), DAY)
    report = result.report.first()
    assert report.source_rows == 2
    assert report.accepted_rows == 2
    assert report.rejected_rows == 0
    assert result.rejected.count() == 0
    assert dict(result.accepted.dtypes)["Quantity"] == "bigint"
    assert result.accepted.where("CustomerID IS NULL").count() == 1
    assert dict(report.rejection_reasons) == {}


def test_missing_required_columns_raise(raw_frame):
    frame = raw_frame([("1", "A")], ["InvoiceNo", "StockCode"])
    with pytest.raises(ValueError, match="Missing required columns: Country, CustomerID, Description"):
        validate.validate(frame, DAY)


def _reasons(raw_frame, rows):
    labelled = validate.label_rows(raw_frame(rows), DAY)
    return [r.rejection_reason for r in labelled.orderBy("InvoiceNo").collect()]


def test_null_tokens_become_missing(raw_frame):
    base = list(sample_rows()[0])
    rows = []
    for i, token in enumerate(["NA", "null", "", "N/A", "None", "nan"]):
        r = list(base)
        r[0] = f"1000{i}"
        r[7] = token
        rows.append(tuple(r))
    assert _reasons(raw_frame, rows) == ["missing_country"] * 6


def test_number_forms(raw_frame):
    base = sample_rows()[0]
    forms = ["2.5", "inf", "1d", " 2 ", "1,000", "abc", "1e2", "-3"]
    rows = [(f"2000{i}",) + base[1:3] + (q,) + base[4:] for i, q in enumerate(forms)]
    reasons = _reasons(raw_frame, rows)
    assert reasons == [
        "invalid_quantity",  # fractional (Q4: a row reject, not a batch failure)
        "invalid_quantity",  # non-finite
        "invalid_quantity",  # Java-only number form
        None,                # blanks around a number are fine
        "invalid_quantity",  # thousands separator
        "invalid_quantity",
        None,
        None,
    ]
    prices = ["inf", "-1.0", "NaN", "1e400"]
    rows = [(f"3000{i}",) + base[1:5] + (p,) + base[6:] for i, p in enumerate(prices)]
    # Q5: non-finite is invalid; negative passes validation (Q26); NaN is a null token
    assert _reasons(raw_frame, rows) == ["invalid_unit_price", None, "missing_unitprice", "invalid_unit_price"]


def test_customer_id_rules(raw_frame):
    base = sample_rows()[0]
    ids = ["guest", "12.5", "12345.0", None]
    rows = [(f"4000{i}",) + base[1:6] + (c,) + base[7:] for i, c in enumerate(ids)]
    assert _reasons(raw_frame, rows) == ["invalid_customer_id", "invalid_customer_id", None, None]


def test_dates_are_day_first_per_row(raw_frame):
    base = sample_rows()[0]
    dates = ["13/12/2010 08:26", "12/31/2010 08:26", "2010-12-01 08:26:00", "2010-01-13 00:00:00", "not a date"]
    rows = [(f"5000{i}",) + base[1:4] + (d,) + base[5:] for i, d in enumerate(dates)]
    labelled = validate.label_rows(raw_frame(rows), DAY).orderBy("InvoiceNo").collect()
    assert labelled[0].InvoiceDate == dt.datetime(2010, 12, 13, 8, 26)
    assert labelled[1].rejection_reason == "invalid_invoice_date"  # month-first is not guessed (Q2)
    assert labelled[2].InvoiceDate == dt.datetime(2010, 12, 1, 8, 26)  # ISO stays ISO (Q1)
    assert labelled[3].InvoiceDate == dt.datetime(2010, 1, 13)
    assert labelled[4].rejection_reason == "invalid_invoice_date"


def test_first_failing_rule_in_fixed_order(raw_frame):
    rows = [("60001", None, None, "abc", None, "x", "guest", None)]
    assert _reasons(raw_frame, rows) == ["missing_stockcode"]  # Q3: fixed order
    rows = [("60002", "A", None, "abc", "bad", "x", "guest", "UK")]
    assert _reasons(raw_frame, rows) == ["missing_description"]  # Q7 before invalid_*


def test_rejected_rows_keep_raw_text(raw_frame):
    base = sample_rows()[0]
    rows = [("70001",) + base[1:3] + ("2.5",) + base[4:]]
    rejected = validate.validate(raw_frame(rows), DAY).rejected.first()
    assert rejected.Quantity is None
    assert rejected.raw_quantity == "2.5"  # Q6
    assert rejected.rejection_reason == "invalid_quantity"


def test_report_counts_reasons(raw_frame):
    base = sample_rows()[0]
    rows = [sample_rows()[0], ("NA",) + base[1:], ("80001",) + base[1:3] + ("x",) + base[4:],
            ("80002",) + base[1:3] + ("y",) + base[4:]]
    report = validate.validate(raw_frame(rows), DAY).report.first()
    assert (report.source_rows, report.accepted_rows, report.rejected_rows) == (4, 1, 3)
    assert dict(report.rejection_reasons) == {"missing_invoiceno": 1, "invalid_quantity": 2}


def test_timestamps_in_other_forms(spark):
    import datetime as dt

    from tillroll.functions import columns as C

    noon = dt.datetime(2010, 12, 1, 8, 26)
    forms = {
        "01/12/2010 08:26": noon, "01-12-2010 08:26": noon, "01.12.2010 8:26": noon, "01/12/10 08:26": noon,
        "2010-12-01T08:26:00Z": noon, "2010-12-01 08:26:00+00:00": noon, "2010-12-01 08:26:00-0530": noon,
        "2010-12-01 08:26:00.123": noon.replace(microsecond=123000), "2010-12-01T08:26:00.123456Z": noon.replace(microsecond=123456),
        "01/12/2010 8:26 AM": noon, "01/12/2010 08:26pm": noon.replace(hour=20), "1 Dec 2010 08:26": noon,
        "1 December 2010": dt.datetime(2010, 12, 1), "01-dec-2010": dt.datetime(2010, 12, 1),
        "2010/12/01 08:26": noon, "01.12.2010": dt.datetime(2010, 12, 1), "01/12/70": dt.datetime(1970, 12, 1),
        "12/31/2010 08:26": None, "not a date": None, "2010-13-01": None, "2010-12-01 08:26:00 nowhere": None,
    }
    df = spark.createDataFrame([(k,) for k in forms], "s string")
    got = {r.s: r.t for r in df.select("s", C.lenient_timestamp("s").alias("t")).collect()}
    assert got == forms


def test_ids_beyond_2_53_stay_apart(raw_frame):
    from tillroll.operators import validate

    rows = [("1", "A", "X", "1", "01/12/2010 08:00", "1.0", c, "UK")
            for c in ("9007199254740993", "9007199254740992", "12345.0", "1e3")]
    got = validate.label_rows(raw_frame(rows), "2026-07-21").collect()
    assert [r.CustomerID for r in got] == [9007199254740993, 9007199254740992, 12345, 1000]


def test_out_of_range_rows_are_rejected_alone(raw_frame):
    from tillroll.operators import clean, star, validate

    rows = [("1", "A", "X", "3000000000", "01/12/2010 08:00", "1.0", "5", "UK"),
            ("2", "A", "X", "1", "01/12/2010 08:00", "1e12", "5", "UK"),
            ("3", "A", "X", "2000000", "01/12/2010 08:00", "900000", "5", "UK"),
            ("4", "A", "X", "2", "01/12/2010 08:00", "1.0", "5", "UK")]
    labelled = validate.label_rows(raw_frame(rows), "2026-07-21")
    assert [r.rejection_reason for r in labelled.collect()] == [
        "out_of_range_quantity", "out_of_range_unit_price", "out_of_range_unit_price", None]
    tables = star.build_star_schema(clean.clean_transactions(validate.accepted_rows(labelled)))
    assert tables["fact_sales"].count() == 1


def test_validated_text_frame_follows_the_same_rules(raw_frame):
    """S3: null tokens in every column, and a fractional quantity is none."""
    from tillroll.operators import clean

    when = "2010-12-01 08:00:00"
    rows = [("NA", "A", "X", "1", when, "1.0", "5", "UK"), ("2", "A", "NA", "2", when, "2.5", "5", "UK"),
            ("3", "A", "X", "2.5", when, "1.0", "5", "UK"), ("4", "A", "X", "-0.5", when, "2.0", "5", "UK"),
            ("5", "A", "X", "-3", when, "2.0", None, "UK")]
    got = {r.InvoiceNo: r for r in clean.clean_transactions(raw_frame(rows), "2026-07-21").collect()}
    assert set(got) == {"2", "5"}
    assert got["2"].Description == "Unknown product" and got["2"].net_sales == 5.0
    assert got["5"].return_amount == 6.0 and got["5"].is_return and got["5"].net_sales == 0.0
