"""Plan properties the design relies on: pruned scans, pushed filters."""

import contextlib
import datetime as dt
import io
import os

import pytest

from tillroll.operators import clean, metrics, star, validate
from tillroll.sources.retail_adapter import raw_transactions

SF = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_adapter_scans_read_only_used_columns(spark):
    text = plan_text(raw_transactions(spark, SF))
    assert ("ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,"
            "l_quantity:double,l_returnflag:string>") in text
    assert "l_extendedprice" not in text and "o_totalprice" not in text


def test_metric_bound_reaches_the_fact_scan(spark, raw_frame, tmp_path):
    rows = [(str(i), "A", "X", "1", f"{1 + i % 20:02d}/12/2010 08:00", "1.0", None, "UK") for i in range(40)]
    labelled = validate.label_rows(raw_frame(rows), dt.date(2026, 7, 21))
    s = star.build_star_schema(clean.clean_transactions(validate.accepted_rows(labelled)))
    for name in ("fact_sales", "dim_date", "dim_region"):
        s[name].write.parquet(str(tmp_path / name))
    fact, dates, regions = (spark.read.parquet(str(tmp_path / n)) for n in ("fact_sales", "dim_date", "dim_region"))
    daily = metrics.daily_metrics(fact, dates, regions, run_date=dt.date(2010, 12, 10))
    text = plan_text(daily)
    assert "LessThanOrEqual(date_key,20101210)" in text  # pushed into the Parquet scan
    fact_scans = [line for line in text.splitlines() if line.startswith("ReadSchema: struct<date_key")]
    assert fact_scans and all("transaction_id" not in line for line in fact_scans)
    assert daily.count() == 10


def test_kpi_day_filter_is_a_broadcast_semi_join(spark, raw_frame):
    from pyspark.sql import functions as F
    from tillroll.operators import views

    rows = [(str(i), "A", "X", "1", f"{1 + i % 20:02d}/12/2010 08:00", "1.0", str(i % 3), "UK") for i in range(40)]
    labelled = validate.label_rows(raw_frame(rows), dt.date(2026, 7, 21))
    s = star.build_star_schema(clean.clean_transactions(validate.accepted_rows(labelled)))
    flags = s["dim_region"].select(F.lit(False).alias("is_anomaly"))
    kpi = views.kpi_summary(s["fact_sales"], s["dim_date"], s["dim_customer"], flags)
    text = plan_text(kpi)
    joins = text.split("BroadcastHashJoin")[1:]
    assert any("Join type: LeftSemi" in j.split("\n\n")[0] for j in joins)  # day keys
    assert kpi.first().order_count == 40


def fact_scans(df) -> int:
    """Reads of the stored fact table in the optimized plan, subqueries included."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sum("Relation [" in line and "transaction_id" in line for line in plan.splitlines())


def test_no_fact_scan_a_day(spark, raw_frame, tmp_path):
    """The KPI view and both models read the loads' summaries and no stored
    fact; a load reads the stored rows of its own days only."""
    from tillroll.operators import warehouse
    from tillroll.operators.warehouse import Warehouse
    from tillroll.plans import daily_run, reporting

    root = str(tmp_path / "lake")
    wh = Warehouse(spark, root + "/warehouse")
    for n, day in enumerate((dt.date(2026, 7, 21), dt.date(2026, 7, 22))):
        rows = [(str(100 * n + i), "A", "X", "1", f"{1 + i % 20:02d}/12/2010 08:00", "1.0", str(i % 3), "UK")
                for i in range(40)]
        labelled = validate.label_rows(raw_frame(rows), day)
        tables = star.build_star_schema(clean.clean_transactions(validate.accepted_rows(labelled)))
        wh.load_star(tables, day)
    kpi = reporting.warehouse_views(spark, root + "/warehouse")["vw_kpi_summary"]
    assert fact_scans(kpi) == 0
    daily = daily_run.warehouse_daily_metrics(spark, root)
    assert fact_scans(daily) == 0
    daily.persist().count()
    flags = daily_run.run_anomaly_detection(spark, root, daily=daily)
    daily_run.run_forecast(spark, root, daily=daily)
    assert flags.count() == 20
    stored = wh.read("fact_sales")
    batch = stored.where("date_key <= 20101205")
    new = warehouse.fact_partition_rows(stored, batch, (20101201, 20101205))
    assert "LessThanOrEqual(date_key,20101205)" in plan_text(new)
    daily.unpersist()


def test_equal_ids_on_different_days_both_survive(spark, raw_frame):
    from pyspark.sql import functions as F
    from tillroll.operators import warehouse

    rows = [("1", "A", "X", "1", "01/12/2010 08:00", "1.0", "5", "UK"), ("2", "A", "X", "1", "02/12/2010 08:00", "1.0", "5", "UK")]
    labelled = validate.label_rows(raw_frame(rows), dt.date(2026, 7, 21))
    fact = star.fact_sales(clean.clean_transactions(validate.accepted_rows(labelled)))
    same = fact.withColumn("transaction_id", F.lit("txn_0"))
    assert warehouse.fact_partition_rows(None, same).count() == 2
    first, second = same.where("date_key = 20101201"), same.where("date_key = 20101202")
    assert warehouse.fact_partition_rows(first, second, (20101202, 20101202)).count() == 1
    assert warehouse.fact_partition_rows(same, second).count() == 0


def test_keep_one_aggregates_are_hash_aggregates(spark, raw_frame):
    """The batch meets hash aggregates over fixed-width buffers; rows are
    sorted only where they share a minimum or a key."""
    from pyspark.sql import functions as F
    from tillroll.operators import warehouse

    rows = [(str(i % 9), f"S{i % 4}", f"D{i % 3}", "1", f"{1 + i % 3:02d}/12/2010 08:00", "1.0", str(i % 5), "UK")
            for i in range(60)]
    labelled = validate.label_rows(raw_frame(rows), dt.date(2026, 7, 21))
    cleaned = clean.clean_transactions(validate.accepted_rows(labelled)).checkpoint()
    tables = star.build_star_schema(cleaned)
    for name in ("dim_product", "dim_customer"):
        text = plan_text(tables[name])
        first = text[text.index("min(_at"):] if "min(_at" in text else ""
        assert "HashAggregate" in text and first
    fact = tables["fact_sales"].unionByName(tables["fact_sales"].limit(5)).checkpoint()
    new = warehouse.fact_partition_rows(fact.where("date_key = 20101201"), fact)
    assert "partial_count(1)" in plan_text(new) and "HashAggregate" in plan_text(new)
    got = [tuple(r) for r in new.collect()]
    want = fact.where("date_key <> 20101201").groupBy("transaction_id", "date_key").agg(
        F.min(F.struct(*[c for c in fact.columns if c not in ("transaction_id", "date_key")])).alias("r"))
    want = [tuple(r) for r in want.select(*[F.col(c) if c in ("transaction_id", "date_key") else F.col(f"r.{c}")
                                            for c in fact.columns]).collect()]
    assert sorted(got) == sorted(want) and len(got) > 5


def test_keep_first_with_ties_and_nulls(spark):
    schema = "StockCode string, Description string, InvoiceNo string, InvoiceDate timestamp_ntz"
    t1, t2 = dt.datetime(2010, 12, 1, 8), dt.datetime(2010, 12, 1, 9)
    rows = [("A", "late", "1", t2), ("A", "b", "2", t1), ("A", "a", "2", t1), ("A", "z", "10", t1),
            ("B", "no date", "9", None), ("B", "dated", "1", t1), (None, "no code", "1", t1), (None, "later", "0", t2)]
    got = star._keep_first(spark.createDataFrame(rows, schema), "StockCode", "Description", "stock_code", "description")
    assert {tuple(r) for r in got.collect()} == {("A", "z"), ("B", "no date"), (None, "no code")}
