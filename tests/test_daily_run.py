"""End to end over files (M2, M11, M14, M16, M22) and the views."""

import datetime as dt
import json
import os

from tillroll.plans import daily_run, reporting


def write_csv(path, rows):
    header = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country"
    with open(path, "w") as f:
        f.write(header + "\n")
        for r in rows:
            f.write(",".join("" if v is None else (f'"{v}"' if "," in v else v) for v in r) + "\n")


def source_rows():
    rows = []
    for day in range(1, 21):
        for i in range(4):
            qty = "-1" if i == 3 else str(i + 1)
            rows.append((f"{day}{i}", f"00{i}", f"LIGHT {i}" if i else "CAKE LIGHT BOX", qty,
                         f"{day:02d}/12/2010 0{i + 8}:00", "2.50", None if i == 1 else str(100 + i),
                         ["United Kingdom", "France", "Canada", "EIRE"][i]))
    rows.append(("999", "X", "BAD", "abc", "01/12/2010 08:00", "1.0", "1", "UK"))
    return rows


def test_run_daily_end_to_end(spark, tmp_path):
    src = tmp_path / "transactions.csv"
    write_csv(src, source_rows())
    root = str(tmp_path / "lake")
    day = dt.date(2026, 7, 21)
    out = daily_run.run_daily(spark, str(src), root, day)
    assert out["validation"]["source_rows"] == 81
    assert out["validation"]["accepted_rows"] == 80
    assert out["validation"]["rejection_reasons"] == {"invalid_quantity": 1}
    assert out["batch_fact_rows"] == 80
    for part in daily_run.LANDING_PARTS:
        assert os.path.isdir(os.path.join(root, "landing", part, "ingestion_date=2026-07-21"))
    manifest_dir = os.path.join(root, "landing", "manifest", "ingestion_date=2026-07-21")
    record = json.loads(open(next(os.path.join(manifest_dir, f) for f in os.listdir(manifest_dir)
                                  if f.endswith(".json"))).readline())
    assert record["validation"]["rejected_rows"] == 1 and len(record["objects"]) == 4

    views = reporting.warehouse_views(spark, os.path.join(root, "warehouse"))
    kpi = views["vw_kpi_summary"].first()
    assert kpi.order_count == 80 and kpi.customer_count == 3 and kpi.product_count == 4
    assert kpi.return_line_count == 20
    cats = {r.category for r in views["vw_region_category_breakdown"].collect()}
    assert "Lighting & Decor" in cats  # 'CAKE LIGHT BOX': first matching rule wins
    assert views["vw_revenue_forecast"].count() == 3 * 37
    assert views["vw_sales_trend"].count() == 60

    # The metrics query as SQL text with a named parameter
    lines_sql = """
        SELECT region_name, count(*) AS lines, sum(quantity) AS pieces
        FROM fact_sales NATURAL JOIN (SELECT region_key, region_name FROM dim_region)
        WHERE date_key <= :last_key GROUP BY region_name"""
    by_sql = reporting.query(spark, os.path.join(root, "warehouse"), lines_sql, last_key=20101210)
    # ten days; UK has EIRE's share apart: quantities 1, 2, 3 and a return of 1 a day
    assert {r.region_name: (r.lines, r.pieces) for r in by_sql.collect()} == {
        "United Kingdom": (10, 10), "Europe": (20, 10), "Other": (10, 30)}
    assert spark.sql("SELECT order_count FROM vw_kpi_summary").first()[0] == 80

    # rerun of the same day changes nothing
    daily_run.run_daily(spark, str(src), root, day)
    views = reporting.warehouse_views(spark, os.path.join(root, "warehouse"))
    assert views["vw_kpi_summary"].first().order_count == 80
    assert views["vw_revenue_forecast"].count() == 3 * 37


def test_source_suffix_is_checked(spark, tmp_path):
    import pytest
    with pytest.raises(ValueError, match="files are not read"):
        daily_run.read_source(spark, str(tmp_path / "x.xlsx"))


def test_command_line_steps(spark, tmp_path, capsys):
    from tillroll.__main__ import main
    src = tmp_path / "t.csv"
    write_csv(src, source_rows())
    root = str(tmp_path / "lake")
    assert main(["ingest", "--source", str(src), "--root", root, "--ingestion-date", "2026-07-21"]) == 0
    assert '"accepted_rows": 80' in capsys.readouterr().out
    assert main(["transform", "--root", root, "--ingestion-date", "2026-07-21"]) == 0
    assert main(["anomalies", "--root", root, "--run-date", "2026-07-21"]) == 0
    assert main(["forecast", "--root", root]) == 0
    assert '"rows": 111' in capsys.readouterr().out.splitlines()[-1]


def test_file_run_equals_registered_queries(spark, tmp_path):
    """The file-based day over the adapter's rows gives the same tables as
    the oracle-checked registered queries (sf0.001)."""
    import pytest
    from tillroll.plans.queries import comparable, registered
    from tillroll.sources.retail_adapter import raw_transactions

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("test tables not present")
    src = str(tmp_path / "source")
    (raw_transactions(spark, sf).write.option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(src))
    root = str(tmp_path / "lake")
    daily_run.run_daily(spark, src, root, "2026-07-21")
    wh = os.path.join(root, "warehouse")
    views = reporting.warehouse_views(spark, wh)
    q = registered()

    def rows(df):
        return sorted(map(tuple, comparable(df).collect()), key=repr)

    def cols(df):
        return comparable(df).columns

    by_file = daily_run.warehouse_daily_metrics(spark, root)
    assert rows(by_file) == rows(q["daily_metrics"](spark, sf).select(*cols(by_file)))
    flags = spark.read.parquet(wh + "/anomaly_flags").drop("detected_at", "metric_year")
    assert rows(flags) == rows(q["anomaly_flags"](spark, sf).select(*cols(flags)))
    for name in ("vw_kpi_summary", "vw_sales_trend", "vw_region_category_breakdown"):
        mine = views[name]
        assert rows(mine) == rows(q[name](spark, sf).select(*cols(mine))), name


def test_no_source_record_is_lost(spark, tmp_path):
    """Quoted breaks are one row; records with other numbers of fields are
    rejected with their text: rows in = accepted + rejected."""
    header = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
    good = '1,A,LAMP,1,01/12/2010 08:00,1.0,5,UK\n'
    broken = '2,B,"two\nlines, ""quoted""",2,01/12/2010 08:00,1.0,5,UK\n'
    surplus, short = "3,C,X,1,01/12/2010 08:00,1.0,5,UK,extra\n", "4,D,X,1\n"
    for name, text, rows, reasons in (
        ("breaks", header + good + broken + surplus + short, 4, {"malformed_row": 2}),
        ("plain", header + good + surplus + short, 3, {"malformed_row": 2}),
    ):
        src = tmp_path / f"{name}.csv"
        src.write_text(text)
        root = str(tmp_path / name)
        report = daily_run.run_daily(spark, str(src), root, "2026-07-21")["validation"]
        assert report["source_rows"] == rows == report["accepted_rows"] + report["rejected_rows"]
        assert report["rejection_reasons"] == reasons
        rejected = daily_run.read_landing(spark, root, "rejected", "2026-07-21").collect()
        assert {r.raw_record.strip() for r in rejected} == {surplus.strip(), short.strip()}
        kept = daily_run.read_landing(spark, root, "validated", "2026-07-21").collect()
        assert "raw_record" not in kept[0].asDict()
        if name == "breaks":
            assert 'two\nlines, "quoted"' in {r.Description for r in kept}
    assert not [f for f in os.listdir(_checkpoints(spark)) if f.startswith("staged-")]


def _checkpoints(spark):
    from tillroll.session import checkpoint_dir

    return checkpoint_dir(spark).removeprefix("file:")


def test_a_horizon_given_twice_is_one_run(spark, tmp_path):
    src = tmp_path / "t.csv"
    write_csv(src, source_rows())
    root = str(tmp_path / "lake")
    daily_run.run_daily(spark, str(src), root, "2026-07-21")
    out = daily_run.run_forecast(spark, root, run_date=dt.date(2026, 7, 21), horizons=(7, 7))
    assert out.count() == 3 * 7


def test_unreadable_table_is_not_an_absent_one(spark, tmp_path):
    import pytest

    from tillroll.operators.warehouse import read_parquet_or_none

    assert read_parquet_or_none(spark, str(tmp_path / "nowhere")) is None
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        read_parquet_or_none(spark, str(bad)).count()
