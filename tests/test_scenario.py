"""What the scenario stores, and what its plans hold."""

import os

import pytest
from pyspark.sql import functions as F

from tillroll.operators import validate
from tillroll.plans import scenario
from tillroll.plans.queries import registered
from tillroll.session import checkpoint_dir
from tillroll.sources.retail_adapter import _padded

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_filters_on_the_reason_stay_above_the_parsing(spark, raw_frame):
    rows = [("1", "A", "X", "1", "01/12/2010 08:00", "1.0", "5", "UK"), ("2", "A", "X", "no", "01/12/2010 08:00", "1.0", "5", "UK")]
    labelled = validate.label_rows(raw_frame(rows), "2026-07-21")
    for df, kept in ((validate.accepted_rows(labelled), "1"), (validate.rejected_rows(labelled), "2")):
        filters = [line for line in plan_of(df).splitlines() if "Filter" in line]
        assert filters and not any("RLIKE" in line.upper() or "gettimestamp" in line for line in filters)
        assert [r.InvoiceNo for r in df.collect()] == [kept]


def test_padded_numbers_are_those_of_format_string(spark):
    df = spark.createDataFrame([(0,), (7,), (59,), (1234567,), (-1,), (None,)], "n bigint")
    for width in (2, 6):
        got = df.select(_padded(F.col("n"), width).alias("a"), F.format_string(f"%0{width}d", "n").alias("b")).collect()
        assert [r.a for r in got] == [r.b for r in got]


def test_a_load_deals_out_its_rows_once(spark):
    """Rows of sales that repeat or are held, and all others, come from one
    shuffle; rows without a key are kept as they are."""
    from tillroll.operators import warehouse
    from tillroll.operators.star import FACT_COLUMNS

    def fact(keys, quantity=1):
        rows = spark.createDataFrame(keys, "transaction_id string, date_key int")
        for c in FACT_COLUMNS:
            if c not in rows.columns:
                rows = rows.withColumn(c, F.lit(quantity))
        return rows.select(*FACT_COLUMNS).checkpoint()

    batch = fact([("a", 1), ("a", 1), ("b", 1), ("c", 2), (None, 1), (None, 1), ("d", None), ("d", None)])
    stored = fact([("c", 2), ("b", 2), (None, 1)], 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        new = warehouse.fact_partition_rows(stored, batch)
        assert new.count() == 6  # runs, so that the final plan names reused exchanges
        got = sorted(((r.transaction_id, r.date_key) for r in new.collect()), key=repr)
        plan = new._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == sorted([("a", 1), ("b", 1), (None, 1), (None, 1), ("d", None), ("d", None)], key=repr)
    whole = [line for line in plan.splitlines() if "coalesce(transaction_id" in line and "Exchange hashpartitioning" in line]
    assert any("ReusedExchange" in line and "currency_code" in line for line in whole), plan


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_plans_rest_on_stored_tables_and_reset_drops_them(spark):
    scenario.reset(spark)
    folder = scenario.scenario(spark, SF).folder
    assert folder.startswith(checkpoint_dir(spark))
    for name in ("vw_kpi_summary_merged", "vw_region_category_merged", "forecast_run_replace", "load_fact_rerun"):
        plan = plan_of(registered()[name](spark, SF))
        assert "lineitem" not in plan and "InMemoryRelation" not in plan and len(plan) < 60_000
    local = folder.removeprefix("file:")
    assert os.path.isdir(local)
    scenario.reset(spark)
    assert not os.path.exists(local)


def test_a_written_list_of_odd_sales_is_broadcast(spark):
    """A short list of repeated and held sales keeps all other rows of a load
    out of any shuffle; the rows are those of a load without the list."""
    from tillroll.operators import warehouse
    from tillroll.operators.star import FACT_COLUMNS
    from tillroll.session import checkpoint_dir, drop_folder, written

    keys = [("a", 1), ("a", 1), ("b", 1), ("c", 2), (None, 1), (None, 1), ("d", None), ("d", None)]

    def fact(keys, quantity, day):
        rows = spark.createDataFrame(keys, "transaction_id string, date_key int")
        for c in FACT_COLUMNS:
            if c not in rows.columns:
                rows = rows.withColumn(c, F.to_date(F.lit(day)) if c == "ingestion_date" else F.lit(quantity))
        return rows.select(*FACT_COLUMNS)

    folder = f"{checkpoint_dir(spark)}/odd-sales-test"
    batch, stored = fact(keys, 1, "2026-07-22"), fact([("c", 2), ("b", 2), (None, 1)], 2, "2026-07-21")
    plain = warehouse.load_fact(stored, batch, "2026-07-22")
    listed = warehouse.load_fact(stored, batch, "2026-07-22", lambda df, name: written(df, f"{folder}/{name}"))
    assert sorted(map(repr, listed.collect())) == sorted(map(repr, plain.collect())) and listed.count() == 9
    plan = listed._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan, plan
    drop_folder(spark, folder)


def test_known_regions_have_the_keys_of_all_others(spark):
    from tillroll.functions import columns as C
    from tillroll.operators.star import region_key

    df = spark.createDataFrame([(r,) for r in [*C.REGIONS, "Mars", "", None]], "r string")
    for row in df.select(region_key("r").alias("a"), C.stable_key(C.REGION_PREFIX, "r").alias("b")).collect():
        assert row.a == row.b


def test_each_kind_of_bitmaps_is_stored_by_its_own_job(spark, tmp_path):
    """The summaries of a load sequence rest on stored parts: the plan that
    merges them holds no fact, no dictionary and no exchange."""
    scenario.reset(spark)
    s = scenario.Scenario(spark, SF)
    kept = []
    store = s.store_all
    s.store_all = lambda parts, name: kept.append((name, len(parts))) or store(parts, name)
    bitmaps = s.summaries["fact_bitmaps"]
    assert kept == [("fact_bitmaps", 4)] * 2  # the last load of either date
    plan = plan_of(bitmaps)
    assert "Join" not in plan and "Aggregate" not in plan and plan.count("Relation [") == 2, plan
    assert {r.kind for r in bitmaps.select("kind").distinct().collect()} == {
        "invoice_day", "invoice_category", "customer", "product"}
    s.drop(spark)


@pytest.mark.parametrize("words", [1, 2**19])
def test_a_long_list_of_odd_sales_leaves_other_rows_in_place(spark, monkeypatch, words):
    """With a written list too long to broadcast, rows still pass by the bits
    of its sales; sales that share a bit by chance stay as they are."""
    from tillroll.operators import warehouse
    from tillroll.operators.star import FACT_COLUMNS
    from tillroll.session import checkpoint_dir, drop_folder, written

    monkeypatch.setattr(warehouse, "MARK_WORDS", words)

    def fact(keys, quantity, day):
        rows = spark.createDataFrame(keys, "transaction_id string, date_key int")
        for c in FACT_COLUMNS:
            if c not in rows.columns:
                rows = rows.withColumn(c, F.to_date(F.lit(day)) if c == "ingestion_date" else F.lit(quantity))
        return rows.select(*FACT_COLUMNS)

    batch = fact([(f"t{i % 150}", 1) for i in range(200)] + [(None, 1), (None, 1), ("d", None)], 1, "2026-07-22")
    stored = fact([(f"t{i}", 1) for i in range(40, 60)] + [("t70", 2), (None, 1)], 2, "2026-07-21")
    folder = f"{checkpoint_dir(spark)}/odd-sales-long-test"
    store = lambda df, name: written(df, f"{folder}/{name}-{len(os.listdir(folder)) if os.path.isdir(folder) else 0}")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        alone = warehouse.load_fact(None, batch, "2026-07-22", store)
        plan = alone._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan, plan
        assert alone.count() == 153
        both = warehouse.load_fact(stored, batch, "2026-07-22", store)
        assert sorted(map(repr, both.collect())) == sorted(map(repr, warehouse.load_fact(stored, batch, "2026-07-22").collect()))
        assert both.count() == 22 + 130 + 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        drop_folder(spark, folder)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_a_load_stores_its_own_date_only(spark):
    s = scenario.Scenario(spark, SF)
    first = set(s.fact_a.inputFiles())
    second = set(s.fact_ab.inputFiles())
    assert first < second
    assert {str(r[0]) for r in spark.read.parquet(*(second - first)).select("ingestion_date").distinct().collect()} == {
        str(scenario.SECOND_DATE)}
    s.drop(spark)


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    """The shuffles of a finished write go at once, not when the driver
    happens to collect garbage; the session's setting is restored."""
    import glob

    from tillroll import session

    dirs = [d.getPath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def shuffles():
        return {f for d in dirs for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}

    before, setting = shuffles(), spark.conf.get(session.DROP_SHUFFLES, None)
    counted = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert session.written(counted, str(tmp_path / "t")).count() == 7
    with session.staged(counted) as rows:
        assert sorted(rows.toPandas()["k"]) == list(range(7))
    session.cut_lineage(counted)
    session.run_concurrently([lambda k=k: session.written(counted, str(tmp_path / f"t{k}")) for k in range(3)])
    assert spark.conf.get(session.DROP_SHUFFLES, None) == setting
    spark.conf.set(session.DROP_SHUFFLES, "true")  # the reads above, which are not the library's
    try:
        left = shuffles() - before
    finally:
        spark.conf.set(session.DROP_SHUFFLES, setting) if setting else spark.conf.unset(session.DROP_SHUFFLES)
    assert len(left) <= 2 * 4, left  # of toPandas and count alone


def test_packed_keys_are_told_apart_and_come_back(spark):
    from tillroll.functions import columns as C

    hexed = "0123456789abcdef"
    keys = [f"txn_{hexed}", f"txn_{hexed.upper()}", f"txn_{hexed}0", f"txn_{hexed[:15]}", f"txn_{hexed[:14]}", "txn_", "",
            f"prod_{hexed}", f"txn {hexed}", "txn_0123456789abcdeg", f"txn_{'0' * 16}", None, "a"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    code, text = C.packed_key("k", "txn")
    parts = df.select("k", code.alias("code"), text.alias("text"))
    got = parts.select("k", "code", "text", C.unpacked_key("code", "text", "txn").alias("again")).collect()
    assert all(r.k == r.again for r in got) and len({(bytes(r.code), r.text) for r in got}) == len(keys)
    assert {r.k for r in got if len(r.code) == 8} == {f"txn_{hexed}", f"txn_{'0' * 16}"}


def test_a_load_moves_hashed_keys_as_bytes(spark):
    """Sales are counted, and suspects dealt out, without their keys' text;
    odd keys load as before."""
    from tillroll.operators import checks, warehouse
    from tillroll.operators.star import FACT_COLUMNS
    from tillroll.session import checkpoint_dir, drop_folder, written

    keys = [f"txn_{i % 60:016x}" for i in range(80)] + ["txn_", "", "", "txn_00000000000000AB", None, None]

    def fact(keys, day, spread):
        rows = spark.createDataFrame([(k, 1, f"prod_{i * spread:016x}") for i, k in enumerate(keys)],
                                     "transaction_id string, date_key int, product_key string")
        for c in FACT_COLUMNS:
            if c not in rows.columns:
                rows = rows.withColumn(c, F.to_date(F.lit(day)) if c == "ingestion_date" else F.lit(1))
        return rows.select(*FACT_COLUMNS)

    batch, stored = fact(keys, "2026-07-22", 7), fact(keys[50:55] + [""], "2026-07-21", 3)
    folder = f"{checkpoint_dir(spark)}/packed-sales-test"
    got = warehouse.load_fact(stored, batch, "2026-07-22", lambda df, name: written(df, f"{folder}/{name}"))
    want = warehouse.load_fact(stored, batch, "2026-07-22")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count() == 6 + 55 + 2 + 2
    for df in (warehouse.odd_sales(stored, batch), got, checks.duplicate_keys(batch, ["transaction_id"])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(" in plan and "hashpartitioning(transaction_id#" not in plan, plan
    dups = {r.transaction_id: r.row_count for r in checks.duplicate_keys(batch, ["transaction_id"]).collect()}
    assert dups == {f"txn_{i:016x}": 2 for i in range(20)} | {"": 2, None: 2}
    drop_folder(spark, folder)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_dimensions_after_a_load_are_stored(spark):
    s = scenario.Scenario(spark, SF)
    plan = plan_of(s.dims_rerun["dim_product"])
    assert "Join" not in plan and plan.count("Relation [") == 3, plan
    s.drop(spark)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_a_batch_reads_its_own_files_only(spark):
    """Rows of a remainder are stored apart: no batch parses the invoice
    numbers of all rows again in each of its passes."""
    s = scenario.Scenario(spark, SF)
    for whole, part in ((s.batch.cleaned, s.batch_a_rerun.cleaned),
                        (s.batch.star["fact_sales"], s.batch_a_rerun.star["fact_sales"])):
        name = "InvoiceNo" if "InvoiceNo" in whole.columns else "invoice_no"
        want = whole.where(F.coalesce(scenario.invoice_digits(name), F.lit(0)) % 3 == 0).drop("ingestion_date")
        assert part.columns == whole.columns and 0 < part.count() < whole.count()
        assert part.drop("ingestion_date").exceptAll(want).isEmpty() and want.exceptAll(part.drop("ingestion_date")).isEmpty()
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(invoice_remainder" in plan or "PartitionFilters: [(invoice_remainder" in plan, plan
        assert "regexp_replace" not in plan
    s.drop(spark)


def test_invoices_meet_their_ids_once_for_both_kinds(spark):
    """Bitmaps of stored invoice ids are those of the fact, also of lines
    without a product, a day or an invoice."""
    from tillroll.operators import partials

    fact = spark.createDataFrame(
        [("i1", "p1", "c", 1, "r"), ("i1", "p2", "c", 1, "r"), ("i1", "p1", "c", 2, "r"), ("i2", "p9", "c", 1, "q"),
         ("i3", None, "c", 1, "q"), (None, "p1", "c", 1, "q"), ("i4", "p2", "c", None, None), ("i4", "p2", "c", None, None)],
        "invoice_no string, product_key string, customer_key string, date_key int, region_key string").withColumn(
        "ingestion_date", F.to_date(F.lit("2026-07-21")))
    products = spark.createDataFrame([("p1", "RED LAMP"), ("p2", None), ("p2", "BAG")], "product_key string, description string")
    ids = {k: spark.createDataFrame([(m, i) for i, m in enumerate(members, 1)], "member string, id bigint")
           for k, members in (("invoice", ["i1", "i2", "i3", "i4"]), ("customer", ["c"]), ("product", ["p1", "p2", "p9"]))}
    kept = []
    parts = partials.bitmap_parts(fact, products, ids, lambda df, name: kept.append(name) or df.localCheckpoint())
    assert kept == ["invoice_ids"]
    for got, want in zip(parts, partials.bitmap_parts(fact, products, ids)):
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert "Join" not in plan_of(parts[0]) and "Join" not in plan_of(parts[1])
