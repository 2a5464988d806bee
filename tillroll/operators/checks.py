"""The constraints the database enforced, as Spark jobs over the
Parquet tables. Each ``*_violations`` function returns offending rows; each
``*_report`` returns one row per constraint with its violation count."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.functions import columns as C

# Primary and unique keys of the warehouse.
UNIQUE_KEYS = [
    ("dim_product", ["product_key"]),
    ("dim_product", ["stock_code"]),
    ("dim_customer", ["customer_key"]),
    ("dim_customer", ["customer_id"]),
    ("dim_date", ["date_key"]),
    ("dim_date", ["full_date"]),
    ("dim_region", ["region_key"]),
    ("dim_region", ["region_name"]),
    ("fact_sales", ["transaction_id"]),
    ("anomaly_flags", ["metric_date", "region_key"]),
    ("revenue_forecasts", ["forecast_run_date", "forecast_date", "region_key", "horizon_days"]),
]
# After a load, sales are told by id and day (see ``warehouse.SALE_KEY``).
LOADED_KEYS = [(t, ["transaction_id", "date_key"] if t == "fact_sales" else k) for t, k in UNIQUE_KEYS]
# Foreign keys (C2): (table, column, referenced table, referenced column).
FOREIGN_KEYS = [
    ("fact_sales", "product_key", "dim_product", "product_key"),
    ("fact_sales", "customer_key", "dim_customer", "customer_key"),
    ("fact_sales", "date_key", "dim_date", "date_key"),
    ("fact_sales", "region_key", "dim_region", "region_key"),
    ("anomaly_flags", "region_key", "dim_region", "region_key"),
    ("revenue_forecasts", "region_key", "dim_region", "region_key"),
]


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values held by more than one row, with their row count.
    Map-side partial counting keeps a hot key to one row per task; hashed keys
    are counted as their bytes."""
    types, parts, whole = dict(df.dtypes), [], []
    for c in key:
        if c in C.KEY_PREFIXES and types[c] == "string":
            code, text = C.packed_key(c, C.KEY_PREFIXES[c])
            parts += [code.alias(f"{c}_code"), text.alias(f"{c}_text")]
            whole.append(C.unpacked_key(f"{c}_code", f"{c}_text", C.KEY_PREFIXES[c]).alias(c))
        else:
            parts.append(F.col(c))
            whole.append(F.col(c))
    counted = df.groupBy(*parts).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)
    return counted.select(*whole, "row_count")


def unique_report(tables: dict[str, DataFrame], keys: list | None = None) -> DataFrame:
    parts = []
    for table, key in keys or UNIQUE_KEYS:
        if table not in tables:
            continue
        dups = duplicate_keys(tables[table], key)
        parts.append(dups.agg(
            F.lit(table).alias("table_name"),
            F.lit(",".join(key)).alias("key_columns"),
            F.count(F.lit(1)).alias("duplicate_keys"),
            F.coalesce(F.sum(F.col("row_count") - 1), F.lit(0)).cast("bigint").alias("extra_rows"),
        ))
    return reduce(DataFrame.unionByName, parts)


def foreign_key_report(tables: dict[str, DataFrame]) -> DataFrame:
    """C2 per constraint: rows whose reference is absent.

    Child rows are first counted per distinct reference (map-side partial
    counting folds a hot key such as the UNKNOWN customer into one row per
    task), so only distinct keys meet the parent keys in the anti-join.
    """
    parts = []
    for table, column, parent, parent_column in FOREIGN_KEYS:
        if table not in tables or parent not in tables:
            continue
        per_key = tables[table].groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        parent_keys = tables[parent].select(F.col(parent_column).alias(column)).distinct()
        orphans = per_key.join(parent_keys, column, "left_anti")
        parts.append(orphans.agg(
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(f"{parent}.{parent_column}").alias("references"),
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("violations"),
        ))
    return reduce(DataFrame.unionByName, parts)


def column_rules(table: str) -> list[tuple[str, str, F.Column]]:
    """C3 rules of one table: (column, rule, violation predicate)."""
    rules = []
    limits = schemas.LENGTH_LIMITS.get(table, {})
    for field in schemas.TABLES[table].fields:
        c = F.col(field.name)
        if not field.nullable:
            rules.append((field.name, "not_null", c.isNull()))
        if field.name in limits:
            rules.append((field.name, f"max_length_{limits[field.name]}", F.length(c) > limits[field.name]))
        if field.dataType.typeName() == "decimal":
            dt = field.dataType.simpleString()
            rules.append((field.name, f"fits_{dt}", c.isNotNull() & c.cast("double").try_cast(dt).isNull()))
    return rules


def not_null_report(tables: dict[str, DataFrame]) -> DataFrame:
    """C3 in one pass per table: every rule is a ``count_if`` of the same scan."""
    parts = []
    for table, df in tables.items():
        rules = column_rules(table)
        if not rules:
            continue
        counts = df.agg(*[F.count_if(pred).alias(f"r{i}") for i, (_, _, pred) in enumerate(rules)])
        stacked = F.explode(F.array(*[
            F.struct(F.lit(col).alias("column_name"), F.lit(rule).alias("rule"), F.col(f"r{i}").alias("violations"))
            for i, (col, rule, _) in enumerate(rules)
        ])).alias("r")
        parts.append(counts.select(stacked).select(
            F.lit(table).alias("table_name"), "r.column_name", "r.rule", "r.violations"
        ))
    return reduce(DataFrame.unionByName, parts)


# -- constraints while loading ---------------------------------------------------

VIOLATIONS = "_violations"


def row_violations(table: str) -> F.Column:
    """C3 for rows of any column types: every rule a row breaks, as
    ``column:rule`` (``type`` if the value is none of the table's type)."""
    limits = schemas.LENGTH_LIMITS.get(table, {})
    rules = []
    for field in schemas.TABLES[table].fields:
        c = F.col(field.name)
        if not field.nullable:
            rules.append((f"{field.name}:not_null", c.isNull()))
        if field.name in limits:
            rules.append((f"{field.name}:max_length_{limits[field.name]}", F.length(c) > limits[field.name]))
        rules.append((f"{field.name}:type", c.isNotNull() & c.try_cast(field.dataType).isNull()))
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules]))


def with_orphans(rows: DataFrame, table: str, parents: dict[str, DataFrame]) -> DataFrame:
    """Adds ``column:no_parent`` to ``_violations`` of rows whose reference
    is in none of ``parents``. Only distinct references meet the parents; the
    rows meet the (normally empty) list of references without one."""
    for child, column, parent, parent_column in FOREIGN_KEYS:
        if child != table or parent not in parents:
            continue
        known = parents[parent].select(F.col(parent_column).alias(column))
        orphans = rows.select(column).where(F.col(column).isNotNull()).distinct().join(known, column, "left_anti")
        rows = rows.join(orphans.withColumn("_orphan", F.lit(f"{column}:no_parent")), column, "left")
        rows = rows.withColumn(VIOLATIONS, F.when(F.col("_orphan").isNull(), F.col(VIOLATIONS)).otherwise(
            F.array_append(VIOLATIONS, F.col("_orphan")))).drop("_orphan")
    return rows


def with_repeats(rows: DataFrame, table: str, stored: DataFrame | None, primary: str) -> DataFrame:
    """C1 for a dimension batch without repeated rows: adds ``columns:unique``
    to rows whose key another row has, or whose natural key the table holds under another primary key. (A primary key that the table
    holds is no violation: such a row is not added.)"""
    for name, key in UNIQUE_KEYS:
        if name != table:
            continue
        label = F.lit(f"{','.join(key)}:unique")
        taken = duplicate_keys(rows.where(F.col(key[0]).isNotNull()), key).select(*key)
        if stored is not None and key != [primary]:
            held = stored.select(*key, F.col(primary).alias("_held"))
            taken = taken.union(rows.join(held, key).where(F.col(primary) != F.col("_held")).select(*key)).distinct()
        rows = rows.join(taken.withColumn("_taken", label), key, "left")
        rows = rows.withColumn(VIOLATIONS, F.when(F.col("_taken").isNull(), F.col(VIOLATIONS)).otherwise(
            F.array_append(VIOLATIONS, F.col("_taken")))).drop("_taken")
    return rows


def quarantined(rows: DataFrame, table: str, ingestion_date) -> DataFrame:
    """Rows with violations in the form of ``load_quarantine``."""
    own = [c for c in rows.columns if c != VIOLATIONS]
    return rows.where(F.size(VIOLATIONS) > 0).select(
        F.lit(ingestion_date).cast("date").alias("ingestion_date"), F.lit(table).alias("table_name"),
        F.col(VIOLATIONS).alias("violations"), F.to_json(F.struct(*own)).alias("record"))


def admitted(rows: DataFrame, table: str) -> DataFrame:
    """Rows without violations, in the table's types."""
    return schemas.conform(rows.where(F.size(VIOLATIONS) == 0), table)
