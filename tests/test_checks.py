"""Table checks (C1-C3) find the violations the database used to refuse."""

import datetime as dt

from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.operators import checks, clean, star, validate

DAY = dt.date(2026, 7, 21)


def star_of(raw_frame):
    rows = [("1", "A", "X", "1", "01/12/2010 08:00", "1.0", "5", "UK"),
            ("2", "B", "Y", "2", "02/12/2010 08:00", "1.0", None, "France")]
    labelled = validate.label_rows(raw_frame(rows), DAY)
    return star.build_star_schema(clean.clean_transactions(validate.accepted_rows(labelled)))


def test_clean_star_passes_every_check(spark, raw_frame):
    tables = {k: schemas.conform(v, k) for k, v in star_of(raw_frame).items()}
    assert all(r.duplicate_keys == 0 for r in checks.unique_report(tables).collect())
    assert all(r.violations == 0 for r in checks.foreign_key_report(tables).collect())
    assert all(r.violations == 0 for r in checks.not_null_report(tables).collect())


def test_checks_report_violations(spark, raw_frame):
    tables = {k: schemas.conform(v, k) for k, v in star_of(raw_frame).items()}
    fact = tables["fact_sales"]
    broken = fact.unionByName(fact.limit(1)).unionByName(
        fact.limit(1).withColumn("transaction_id", F.lit("txn_new"))
        .withColumn("product_key", F.lit("prod_missing"))
        .withColumn("currency_code", F.lit("EURO"))
    )
    tables["fact_sales"] = broken
    unique = {(r.table_name, r.key_columns): (r.duplicate_keys, r.extra_rows)
              for r in checks.unique_report(tables).collect()}
    assert unique[("fact_sales", "transaction_id")] == (1, 1)
    fks = {r.column_name: r.violations for r in checks.foreign_key_report(tables).collect()
           if r.table_name == "fact_sales"}
    assert fks == {"product_key": 1, "customer_key": 0, "date_key": 0, "region_key": 0}
    rules = {(r.column_name, r.rule): r.violations for r in checks.not_null_report(tables).collect()
             if r.table_name == "fact_sales"}
    assert rules[("currency_code", "max_length_3")] == 1
    assert rules[("transaction_id", "not_null")] == 0
