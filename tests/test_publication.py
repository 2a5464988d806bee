"""A load's checks, its all-or-nothing publication and the summaries it leaves."""

import contextlib
import datetime as dt
import io
import json

import pytest
from pyspark.sql import functions as F
from test_warehouse import D1, D2, fact_ids, rows, star_of

from tillroll.operators import metrics, partials, publish, views
from tillroll.operators.warehouse import PUBLISH_ORDER, Warehouse
from tillroll.plans import daily_run, reporting


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def collected(df):
    return sorted(map(tuple, df.collect()), key=repr)


def many(n, start=0):
    """Invoices that share days, products and customers in different ways."""
    return [(str(20000 + i // 2), f"S{i % 5}", ["LIGHT", "BAG", "CUP", "X", "HEART"][i % 5], str((i % 4) - 1 or 3),
             f"{1 + i % 9:02d}/12/2010 08:{i % 60:02d}", "2.5", None if i % 7 == 0 else str(i % 3),
             ["UK", "France", "Japan"][i % 3]) for i in range(start, start + n)]


def test_a_stopped_load_changes_nothing(spark, raw_frame, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.load_star(star_of(raw_frame, rows(6), D1), D1)
    before = {t: collected(wh.read(t)) for t in ("fact_sales", "dim_product", "fact_daily", "ids_invoice")}
    new = star_of(raw_frame, rows(3, start=50), D1)
    with monkeypatch.context() as m:  # stops with the fact staged, the summaries not
        m.setattr(Warehouse, "_stage_summaries", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            wh.load_star(new, D1)
    assert {t: collected(wh.read(t)) for t in before} == before
    assert publish.Files(spark, wh.root).names(f"{wh.root}/{publish.LOADS}") == []

    # The process dies while moving: the load is decided, the next open ends it.
    moved = publish.Files.move
    calls = []

    def dies(self, source, target):
        if len(calls) == 2:
            raise KeyboardInterrupt
        calls.append(target)
        moved(self, source, target)

    with monkeypatch.context() as m:
        m.setattr(publish.Files, "move", dies)
        with pytest.raises(KeyboardInterrupt):
            wh.load_star(new, D1)
    assert wh.recover() == 1 and wh.recover() == 0
    assert len(fact_ids(wh)) == 3 and wh.read("ids_invoice").count() == 9
    assert wh.read("fact_daily").agg(F.sum("revenue")).first()[0] == 6

    # A folder without the marker is dropped.
    files = publish.Files(spark, wh.root)
    wh.read("fact_sales").drop("ingestion_date").write.parquet(
        publish.Load(files, "left").path("fact_sales", f"ingestion_date={D2}"))
    assert publish.recover(files, PUBLISH_ORDER) == 0 and wh.dates("fact_sales") == {str(D1)}


def test_rows_that_break_constraints_are_refused(spark, raw_frame, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    s = star_of(raw_frame, rows(6), D1)
    fact = s["fact_sales"]
    n = F.col("invoice_no")
    s["fact_sales"] = fact.withColumn("product_key", F.when(n == "10000", "prod_gone").otherwise(F.col("product_key"))) \
        .withColumn("region_key", F.when(n == "10001", None).otherwise(F.col("region_key"))) \
        .withColumn("currency_code", F.when(n == "10002", "POUNDS").otherwise(F.col("currency_code"))) \
        .withColumn("quantity", F.when(n == "10003", "many").otherwise(F.col("quantity").cast("string"))) \
        .withColumn("note", F.lit("an extra column"))
    twin = s["dim_product"].where("stock_code = 'S1'").withColumn("product_key", F.lit("prod_other"))
    s["dim_product"] = s["dim_product"].unionByName(twin)
    assert wh.load_star(s, D1) == {"fact_sales": 5, "dim_product": 2}
    found = {(r.table_name, tuple(r.violations), json.loads(r.record).get("invoice_no"))
             for r in wh.read("load_quarantine").collect()}
    orphan = "product_key:no_parent"  # S1's rows were refused, so its facts have no product
    assert found == {
        ("dim_product", ("stock_code:unique",), None),
        ("fact_sales", (orphan,), "10000"), ("fact_sales", ("region_key:not_null", orphan), "10001"),
        ("fact_sales", ("currency_code:max_length_3",), "10002"), ("fact_sales", ("quantity:type",), "10003"),
        ("fact_sales", (orphan,), "10004")}
    assert wh.read("fact_sales").count() == 1 and wh.read("dim_product").count() == 2
    wh.load_star(star_of(raw_frame, rows(6), D1), D1)  # the mended batch
    assert wh.read("load_quarantine").count() == 0 and wh.read("fact_sales").count() == 6


def test_summaries_equal_the_fact(spark, raw_frame, tmp_path):
    """After overlapping loads, a shrinking rerun and an empty one, merged
    metrics and views equal those of the fact; no plan reads it."""
    root = str(tmp_path / "lake")
    wh = Warehouse(spark, root + "/warehouse")
    for data, day in ((many(60), D1), (many(60, start=30), D2), (many(20), D1)):
        wh.load_star(star_of(raw_frame, data, day), day)
    flags = wh.read_or_empty("anomaly_flags")
    t = {n: wh.read_or_empty(n) for n in reporting.TABLES}
    want = {
        "vw_kpi_summary": views.kpi_summary(t["fact_sales"], t["dim_date"], t["dim_customer"], flags),
        "vw_sales_trend": views.sales_trend(t["fact_sales"], t["dim_date"], t["dim_region"]),
        "vw_region_category_breakdown": views.region_category_breakdown(
            t["fact_sales"], t["dim_region"], t["dim_product"])}
    got = reporting.warehouse_views(spark, root + "/warehouse")
    for name, df in want.items():
        assert got[name].columns == df.columns and collected(got[name]) == collected(df), name
        text = plan_text(got[name])
        assert "Expand" not in text and "transaction_id" not in text and "fact_sales" not in text
    for bound in (None, dt.date(2010, 12, 4)):
        daily = daily_run.warehouse_daily_metrics(spark, root, bound)
        assert "fact_sales" not in plan_text(daily)
        assert collected(daily) == collected(metrics.daily_metrics(
            t["fact_sales"], t["dim_date"], t["dim_region"], bound))
    ids = wh.read("ids_invoice").collect()
    assert sorted(r.id for r in ids) == list(range(1, len(ids) + 1)) and len({r.member for r in ids}) == len(ids)

    # A warehouse from before summaries is read whole, and gets them at its next load.
    files = publish.Files(spark, wh.root)
    for name in ("fact_daily", "fact_category", "fact_bitmaps"):
        files.delete(wh.path(name))
    assert not wh.summarised()
    assert collected(reporting.warehouse_views(spark, root + "/warehouse")["vw_kpi_summary"]) == collected(
        want["vw_kpi_summary"])
    wh.load_star(star_of(raw_frame, many(20), D1), D1)
    assert wh.summarised()
    assert collected(reporting.warehouse_views(spark, root + "/warehouse")["vw_kpi_summary"]) == collected(
        want["vw_kpi_summary"])


def test_dense_ids_and_bitmaps_over_buckets(spark):
    """More keys than a bitmap bucket holds, added in two steps."""
    def keys(a, b):
        return spark.range(a, b).select(F.concat(F.lit("k"), F.col("id")).alias("member"),
                                        (F.col("id") % 50).cast("int").alias("first_day"))
    first = partials.add_ids(None, keys(0, 40000).unionByName(keys(0, 100)))
    both = partials.add_ids(first, keys(39000, 70000)).persist()
    assert both.agg(F.count("*"), F.count_distinct("id"), F.min("id"), F.max("id")).first() == (70000, 70000, 1, 70000)
    assert both.join(first, ["member", "id"]).count() == 40000  # ids never change
    bits = both.groupBy((F.col("id") % 3).alias("part"), F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bitmap")).withColumn("kind", F.lit("x"))
    twice = bits.unionByName(bits)
    assert partials.merged_distinct(twice, "x").first().distinct == 70000
    assert {r.distinct for r in partials.merged_distinct(twice, "x", "part").collect()} == {23333, 23334}
