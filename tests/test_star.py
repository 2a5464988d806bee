"""Star schema (M4-M9): reference star test plus key and date details."""

import datetime as dt
import hashlib

from tillroll.operators import clean, star, validate

DAY = dt.date(2026, 7, 21)


def star_of(raw_frame, rows):
    labelled = validate.label_rows(raw_frame(rows), DAY)
    typed = labelled.drop("rejection_reason", *validate.RAW_KEPT.values())
    return star.build_star_schema(clean.clean_transactions(typed, DAY))


ROWS = [
    ("10001", "A", "ITEM A", "2", "01/12/2010 08:26", "3.5", "12345", "United Kingdom"),
    ("10001", "A", "ITEM A", "2", "01/12/2010 08:26", "3.5", "12345", "United Kingdom"),
    ("10002", "B", None, "-1", "01/12/2010 08:26", "2.0", None, "France"),
    ("10003", "C", "ITEM C", "0", "01/12/2010 08:26", "1.0", "12346", "Canada"),
]


def key(prefix, text):
    return f"{prefix}_{hashlib.sha1(text.encode()).hexdigest()[:16]}"


def test_stable_keys_and_tables(raw_frame):
    s = star_of(raw_frame, ROWS)
    assert set(s) == {"fact_sales", "dim_product", "dim_customer", "dim_date", "dim_region"}
    fact = s["fact_sales"]
    assert fact.select("transaction_id").distinct().count() == fact.count()
    assert all(r.product_key.startswith("prod_") for r in s["dim_product"].collect())
    assert fact.join(s["dim_product"], "product_key", "left_anti").count() == 0  # J7
    assert fact.join(s["dim_customer"], "customer_key", "left_anti").count() == 0


def test_keys_equal_sha1_of_natural_keys(raw_frame):
    s = star_of(raw_frame, ROWS)
    products = {r.stock_code: r.product_key for r in s["dim_product"].collect()}
    assert products["A"] == key("prod", "A")
    customers = {r.customer_id: r.customer_key for r in s["dim_customer"].collect()}
    assert customers["UNKNOWN"] == key("cust", "UNKNOWN")
    assert customers["12345"] == key("cust", "12345")
    txn = s["fact_sales"].where("invoice_no = '10001'").first().transaction_id
    assert txn == key("txn", "10001|A|2010-12-01 08:26:00|2|3.5")  # Q8: fixed text forms


def test_date_dimension(raw_frame):
    rows = [("1", "A", "X", "1", "01/01/2011 10:00", "1.0", None, "UK")]
    d = star_of(raw_frame, rows)["dim_date"].first()
    assert (d.date_key, d.year, d.quarter, d.month, d.month_name, d.week_of_year, d.day_of_month) == (
        20110101, 2011, 1, 1, "January", 52, 1)


def test_keep_first_follows_time_then_invoice(raw_frame):
    rows = [("2", "A", "LATER", "1", "02/12/2010 08:00", "1.0", "9", "France"),
            ("1", "A", "EARLIER", "1", "01/12/2010 08:00", "1.0", "9", "Spain")]
    s = star_of(raw_frame, rows)
    assert s["dim_product"].first().description == "EARLIER"  # Q9
    assert s["dim_customer"].first().country == "Spain"


def test_empty_batch_raises(raw_frame):
    rows = [("1", "A", "X", "0", "01/12/2010 08:00", "1.0", None, "UK")]
    try:
        star_of(raw_frame, rows)
    except ValueError as e:
        assert "the batch is empty" in str(e)
    else:
        raise AssertionError("expected ValueError")


def test_codes_stay_text_and_hash_ignores_customer_country_description(raw_frame):
    rows = [("00123", "00042", "ONE", "1", "01/12/2010 08:00", "2.675", "7", "UK"),
            ("00124", "00042", "TWO", "1", "01/12/2010 08:00", "1.0", None, "France")]
    s = star_of(raw_frame, rows)
    fact = {r.invoice_no: r for r in s["fact_sales"].collect()}
    assert set(fact) == {"00123", "00124"}  # Q22: leading zeros kept
    assert s["dim_product"].first().stock_code == "00042"
    # Q27: the key hashes the full price text, the stored price is rounded to cents
    assert fact["00123"].transaction_id == key("txn", "00123|00042|2010-12-01 08:00:00|1|2.675")
    assert str(fact["00123"].unit_price) == "2.68"
    # Q25: customer, country and description do not enter the key
    other = star_of(raw_frame, [("00123", "00042", "ELSE", "1", "01/12/2010 08:00", "2.675", "9", "Spain")])
    assert other["fact_sales"].first().transaction_id == fact["00123"].transaction_id


def test_keep_first_reads_invoices_of_contested_keys_only(spark):
    """A key with one attribute at its earliest moment needs no InvoiceNo; the
    others are listed, and the list gives the same rows as the plain plan."""
    import datetime as dt

    early, late = dt.datetime(2010, 12, 1, 8), dt.datetime(2010, 12, 1, 9)
    rows = [
        ("one", "X", "2", early), ("one", "X", "1", early), ("one", "A", "0", late),
        ("two", "B", "2", early), ("two", "C", "1", early), ("two", "A", "0", late),
        ("half", None, "2", early), ("half", "D", "1", early), ("none", None, "1", early), ("none", "E", "1", late),
        (None, "F", "1", early), (None, "G", "1", early), ("undated", "H", "1", None), ("undated", "A", "0", early),
    ]
    df = spark.createDataFrame(rows, "StockCode string, Description string, InvoiceNo string, InvoiceDate timestamp_ntz")
    kept = {}

    def store(frame, name):
        kept[name] = frame
        return frame

    listed = star._keep_first(df, "StockCode", "Description", "stock_code", "description", store)
    plain = star._keep_first(df, "StockCode", "Description", "stock_code", "description")
    want = {"one": "X", "two": "C", "half": "D", "none": None, None: "F", "undated": "H"}
    assert dict(map(tuple, listed.collect())) == dict(map(tuple, plain.collect())) == want
    assert {r.stock_code for r in kept["contested_description"].collect()} == {"two", "half", None}
    assert "InvoiceNo" not in kept["first_description"]._jdf.queryExecution().optimizedPlan().toString().split("LogicalRDD")[0]


def test_strip_takes_every_kind_of_white_space(spark):
    from pyspark.sql import functions as F

    from tillroll.functions import columns as C

    texts = ["", " ", "a", " a", "a ", "a b", " a", "a　", "\x1fa", "é", "é ", "a\tb\n", "~!", "\x7fa\x7f", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(C.strip_ws(F.col("t"))).collect()] == [None if t is None else t.strip() for t in texts]
