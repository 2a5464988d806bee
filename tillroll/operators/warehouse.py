"""Idempotent loads on plain Parquet tables.

The merge rules are pure ``(existing, batch) -> DataFrame`` functions so they
can be tested and compared with SQL; ``Warehouse`` is the thin file layer
that applies them:

* dimensions: insert-if-absent (append the anti-joined rows);
* fact_sales: partitioned by ``ingestion_date``; a load replaces its own
  partition and never re-adds a transaction that another date already holds
  (first write wins, Q12);
* a load's dimensions, facts, summaries and refused rows are staged and then
  published together;
* anomaly_flags: range replace + upsert; the table is one row per region-day,
  bounded by the calendar, and is rewritten from a reliable checkpoint;
* revenue_forecasts: partitioned by ``forecast_run_date``; only the run
  partitions a batch touches are rewritten, from a reliable checkpoint.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tillroll import schemas
from tillroll.functions import columns as C
from tillroll.operators import checks, partials
from tillroll.operators.publish import Files, Load, publication, recover
from tillroll.operators.star import FACT_COLUMNS
from tillroll.session import run_concurrently, staged

DIMENSION_KEYS = {
    "dim_product": "product_key",
    "dim_customer": "customer_key",
    "dim_date": "date_key",
    "dim_region": "region_key",
}
# A load's tables in the order in which they become visible.
PUBLISH_ORDER = [*DIMENSION_KEYS, "ids_invoice", "ids_customer", "ids_product", "fact_sales", "fact_daily",
                 "fact_category", "fact_bitmaps", "load_quarantine"]
ANOMALY_KEY = ["metric_date", "region_key"]
ANOMALY_PARTITION = "metric_year"
ANOMALY_NOTE = "_anomaly_run"  # a folder beside the tables
SALE_KEY = ["transaction_id", "date_key"]
PACKED_SALE = ["transaction_id_code", "transaction_id_text", "date_key"]  # the same, as shuffles move it
# Hashed sales are marked in this many words of 64 bits at most.
MARK_WORDS = 2**19
FORECAST_KEY = ["forecast_run_date", "forecast_date", "region_key", "horizon_days"]


def _date(value) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


# ---------------------------------------------------------------------------
# Pure merge rules
# ---------------------------------------------------------------------------

def dimension_rows_to_add(existing: DataFrame | None, batch: DataFrame, key: str) -> DataFrame:
    """W1 + J6: batch rows whose key the table does not hold yet.

    Existing attributes never change (``ON CONFLICT DO NOTHING``); a batch
    carries one row per key already (M4-M7 group by key).
    """
    if existing is None:
        return batch
    return batch.join(existing.select(key), key, "left_anti")


def insert_if_absent(existing: DataFrame | None, batch: DataFrame, key: str) -> DataFrame:
    """W1 as a table state: existing rows plus the new keys."""
    added = dimension_rows_to_add(existing, batch, key)
    return added if existing is None else existing.unionByName(added)


def fold_repeats(repeats: DataFrame) -> DataFrame:
    """One row per sale of rows that share theirs: the smallest by the
    other fact columns in table order, so the choice is deterministic under
    any partitioning. Tasks fold repeats before the shuffle."""
    rest = [c for c in FACT_COLUMNS if c not in SALE_KEY]
    return (
        repeats.groupBy(*SALE_KEY)
        .agg(F.min(F.struct(*[F.col(c) for c in rest])).alias("_row"))
        .select(*[F.col(c) if c in SALE_KEY else F.col(f"_row.{c}").alias(c) for c in FACT_COLUMNS])
    )


def _of_sales(rows: DataFrame, sales: DataFrame, how: str) -> DataFrame:
    """``rows`` whose sale is (``left_semi``) or is not (``left_anti``) among
    ``sales``, which hold no null. Null-safe equality adds no filter to
    ``rows``, so both kinds of join over the same rows share one shuffle."""
    same = [F.col(f"_rows.{k}").eqNullSafe(F.col(f"_sales.{k}")) for k in SALE_KEY]
    return rows.alias("_rows").join(sales.alias("_sales"), reduce(Column.__and__, same), how)


def packed_keys(rows: DataFrame) -> DataFrame:
    """``rows`` with every hashed key as ``<key>_code`` and ``<key>_text`` in
    place of its text (see ``columns.packed_key``)."""
    columns = []
    for c in rows.columns:
        if c in C.KEY_PREFIXES:
            code, text = C.packed_key(F.col(c).cast("string"), C.KEY_PREFIXES[c])
            columns += [code.alias(f"{c}_code"), text.alias(f"{c}_text")]
        else:
            columns.append(F.col(c))
    return rows.select(*columns)


def unpacked(name: str) -> Column:
    """A column of rows behind ``packed_keys``."""
    if name not in C.KEY_PREFIXES:
        return F.col(name)
    return C.unpacked_key(f"{name}_code", f"{name}_text", C.KEY_PREFIXES[name]).alias(name)


def fold_suspects(suspects: DataFrame, held: DataFrame | None) -> DataFrame:
    """``fold_repeats`` of the rows whose sale is not among ``held``. Rows and
    list meet in one shuffle, with the hashed keys packed; sales are known."""
    dealt = packed_keys(suspects).repartition(*PACKED_SALE)
    if held is not None:
        # Not an anti-join: one would be moved below the packing.
        listed = packed_keys(held.select(*SALE_KEY)).withColumn("_listed", F.lit(True))
        dealt = dealt.join(listed, PACKED_SALE, "left").where(F.col("_listed").isNull())
    rest = [c for c in FACT_COLUMNS if c not in SALE_KEY]
    folded = dealt.groupBy(*PACKED_SALE).agg(F.min(F.struct(*[unpacked(c) for c in rest])).alias("_row"))
    return folded.select(*[unpacked(c) if c in SALE_KEY else F.col(f"_row.{c}").alias(c) for c in FACT_COLUMNS])


def odd_sales(other_dates: DataFrame | None, batch: DataFrame, days: tuple[int, int] | None = None) -> DataFrame:
    """The sales of a batch that repeat in it (``_n`` > 1) or that another
    date holds (``_held``), by keys alone; see ``fact_partition_rows``."""
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in SALE_KEY])
    sales = packed_keys(batch.where(known).select(*SALE_KEY))
    if other_dates is None:
        met = sales.groupBy(*PACKED_SALE).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        return met.select(*map(unpacked, SALE_KEY), "_n", F.lit(False).alias("_held"))
    stored = other_dates.where(known).select(*SALE_KEY)
    if days is not None:
        stored = stored.where(F.col("date_key").between(*days))
    # One grouping of both sides' keys: each side is read and shuffled once.
    both = sales.withColumn("_own", F.lit(1)).unionByName(packed_keys(stored).withColumn("_own", F.lit(0)))
    met = both.groupBy(*PACKED_SALE).agg(F.count(F.lit(1)).alias("_all"), F.sum("_own").alias("_n"))
    held = F.col("_all") > F.col("_n")
    met = met.where((F.col("_n") > 1) | ((F.col("_n") == 1) & held))
    return met.select(*map(unpacked, SALE_KEY), "_n", held.alias("_held"))


def _mark(place: str) -> Column:
    """A hashed sale's word (``div``) or its bit in it (``%``), whatever
    integer type the day has."""
    slot = f"pmod(xxhash64(cast(transaction_id as string), cast(date_key as bigint)), {MARK_WORDS * 64}L)"
    return F.expr(f"{slot} div 64" if place == "word" else f"shiftleft(1L, cast({slot} % 64 as int))")


def marked_by(rows: DataFrame, odd: DataFrame) -> DataFrame:
    """``rows`` with ``_odd``: true for every sale of ``odd``, and for the few
    others whose hash shares a bit with one. The bits are broadcast: at most
    ``MARK_WORDS`` rows of two longs, however long the list is."""
    words = odd.groupBy(_mark("word").alias("_word")).agg(F.bit_or(_mark("bit")).alias("_bits"))
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in SALE_KEY])
    marked = rows.withColumns({"_word": _mark("word"), "_bit": _mark("bit")}).join(F.broadcast(words), "_word", "left")
    bit = F.col("_bits").bitwiseAND(F.col("_bit")) != 0
    return marked.select(*rows.columns, (known & F.coalesce(bit, F.lit(False))).alias("_odd"))


def fact_partition_rows(
    other_dates: DataFrame | None,
    batch: DataFrame,
    days: tuple[int, int] | None = None,
    watched: DataFrame | None = None,
    odd: DataFrame | None = None,
) -> DataFrame:
    """The rows a load writes into its own ``ingestion_date`` partition.

    ``batch`` holds one ingestion date. ``other_dates`` is the fact table
    without it (its own old partition is deleted first). A sale is told by
    its id and day: the id is a hash of 64 bits, so two sales may share one,
    and equal transaction text implies an equal day. Only stored rows of the
    batch's ``days`` (smallest and largest ``date_key``) can collide: given,
    the range is pushed into the stored scan, whose files are sorted by day.

    Keys travel first: a hash aggregate counts each sale of the batch, and
    the counts meet the stored keys. What comes out, sales that repeat or
    that another date holds, is normally a short list; all other rows pass
    it without being sorted or shuffled. Only repeats are folded over whole
    rows. ``watched`` are the same rows as ``batch``, read for the bulk.
    ``odd`` is that list (``odd_sales``) where the caller has written it: rows
    then pass by the bits of its hashed sales (``marked_by``), also a list too
    long to broadcast, and only rows that share a bit with it are shuffled.
    A sale that shares a bit by chance folds to its own row.
    """
    batch = batch.select(*FACT_COLUMNS)
    watched = batch if watched is None else watched.select(*FACT_COLUMNS)
    if odd is not None:
        bulk = marked_by(watched, odd).where(~F.col("_odd")).select(*FACT_COLUMNS)
        suspects = marked_by(batch, odd).where("_odd").select(*FACT_COLUMNS)
        return bulk.unionByName(fold_suspects(suspects, None if other_dates is None else odd.where("_held")))
    odd = odd_sales(other_dates, batch, days)
    bulk = _of_sales(watched, odd.select(*SALE_KEY), "left_anti")
    repeated = odd.where((F.col("_n") > 1) & ~F.coalesce(F.col("_held"), F.lit(False))).select(*SALE_KEY)
    repeats = fold_repeats(_of_sales(batch, repeated, "left_semi"))
    return bulk.select(*FACT_COLUMNS).unionByName(repeats)


def load_fact(existing: DataFrame | None, batch: DataFrame, ingestion_date,
              store: Callable[[DataFrame, str], DataFrame] | None = None,
              keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """W2 as a table state: other dates unchanged, own date replaced.
    ``store`` writes the list of odd sales and reads it back, ``keep`` the
    date's rows: other dates' files stay as they are."""
    d = _date(ingestion_date)
    batch = batch.where(F.col("ingestion_date") == F.lit(d))
    others = None if existing is None else existing.where(F.col("ingestion_date") != F.lit(d))
    odd = None if store is None else store(odd_sales(others, batch), "odd_sales")
    new_rows = fact_partition_rows(others, batch, odd=odd)
    if keep is not None:
        new_rows = keep(new_rows)
    return new_rows if others is None else others.unionByName(new_rows)


def replace_anomaly_range(existing: DataFrame | None, new: DataFrame, bounds: tuple | None = None) -> DataFrame:
    """Drop stored rows with metric_date inside the batch's [min, max],
    then upsert the batch on (metric_date, region_key). An empty batch is a
    no-op (the range is null, so nothing is dropped). ``bounds`` is that
    range where the caller knows it."""
    if existing is None:
        return new
    if bounds is None:
        lo, hi = new.select(F.min("metric_date")).scalar(), new.select(F.max("metric_date")).scalar()
    else:
        lo, hi = (F.lit(b) for b in bounds)
    # Rows of the batch all fall inside [lo, hi], so after this delete the
    # upsert on (metric_date, region_key) has nothing left to update.
    kept = existing.where(~F.coalesce(F.col("metric_date").between(lo, hi), F.lit(False)))
    return kept.unionByName(new)


def replace_forecast_run(existing: DataFrame | None, new: DataFrame, run_date) -> DataFrame:
    """Drop stored rows of ``run_date``, then upsert the batch on the
    four-column key (Q18: batch rows may carry other run dates). Rows of the
    batch that share the key are one row (a horizon given twice)."""
    rest = [c for c in new.columns if c not in FORECAST_KEY]
    new = new.groupBy(*FORECAST_KEY).agg(F.max(F.struct(*rest)).alias("_row")).select(
        *[F.col(c) if c in FORECAST_KEY else F.col(f"_row.{c}").alias(c) for c in new.columns])
    if existing is None:
        return new
    run = run_date if isinstance(run_date, Column) else F.lit(_date(run_date))
    kept = (
        existing.where(F.col("forecast_run_date") != run)
        .join(new.select(*FORECAST_KEY), FORECAST_KEY, "left_anti")
    )
    return kept.unionByName(new)


# ---------------------------------------------------------------------------
# File layer
# ---------------------------------------------------------------------------

def read_parquet_or_none(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """A Parquet folder, or None when it does not exist. Any other failure is
    raised: a table that cannot be read is not an absent one."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def empty_partition(spark: SparkSession, table: str, partition_column: str, path: str) -> None:
    """Replace one partition folder with a schema-only file: the partition
    then holds no rows. (A dynamic overwrite with no rows would leave the old
    folder in place.)"""
    schema = StructType([f for f in schemas.TABLES[table].fields if f.name != partition_column])
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


class Warehouse:
    """Parquet tables under one root folder (local path or any Hadoop URI)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def exists(self, table: str) -> bool:
        return self.read(table) is not None

    def read(self, table: str) -> DataFrame | None:
        """The table in its warehouse types, or None before its first write;
        partition folders (and helper partition columns such as
        ``metric_year``) are resolved here."""
        schema = schemas.TABLES[table]
        if table == "anomaly_flags":
            schema = StructType([*schema.fields, StructField(ANOMALY_PARTITION, IntegerType())])
        if not Files(self.spark, self.root).exists(self.path(table)):
            return None
        df = read_parquet_or_none(self.spark, self.path(table), schema)
        return None if df is None else schemas.conform(df, table)

    def read_or_empty(self, table: str) -> DataFrame:
        df = self.read(table)
        return df if df is not None else self.spark.createDataFrame([], schemas.TABLES[table])

    # -- W1 + W2 ---------------------------------------------------------
    def load_star(self, star: dict[str, DataFrame], ingestion_date) -> dict[str, int]:
        """New dimension rows, the date's fact partition and its
        summaries, published together (see ``publish``); a load that stops
        before that leaves every table as it was. Rows that break C1-C3 go to
        ``load_quarantine``. Returns how many, per table. Rerunning the same
        load gives the same tables."""
        d = _date(ingestion_date)
        with publication(self.spark, self.root, PUBLISH_ORDER) as load:
            dims, refused = self._stage_dimensions(load, star, d)
            fact, fact_refused = self._stage_fact(load, star["fact_sales"], dims, d)
            refused.update(fact_refused)
            self._stage_summaries(load, fact, dims["dim_product"], d)
            for other in sorted(self.dates("fact_sales") - self.dates("fact_daily") - {d.isoformat()}):
                self._stage_stored_summaries(load, other, dims["dim_product"])
            self._stage_quarantine(load, [rows for rows, _ in refused.values()], d)
        return {table: n for table, (_, n) in refused.items()}

    def recover(self) -> int:
        """Finish or drop what a stopped load left (done before every load)."""
        return recover(Files(self.spark, self.root), PUBLISH_ORDER)

    def dates(self, table: str) -> set[str]:
        """Ingestion dates that have a partition."""
        names = Files(self.spark, self.root).names(self.path(table))
        return {n.split("=", 1)[1] for n in names if n.startswith("ingestion_date=")}

    def summarised(self) -> bool:
        """Whether every stored fact partition has its summaries (those
        written before summaries existed get them at the next load)."""
        return self.dates("fact_sales") <= self.dates("fact_daily")

    def _admit(self, checked: DataFrame, table: str, write) -> int:
        """Writes the rows without violations; the same pass counts the
        others. ``write`` gets the rows to write, and the same rows unwatched
        for what it has to look up."""
        seen = Observation()
        watched = checked.observe(seen, F.count_if(F.size(checks.VIOLATIONS) > 0).alias("refused"))
        write(checks.admitted(watched, table), checks.admitted(checked, table))
        return int(seen.get.get("refused") or 0)

    def _stage_dimensions(self, load: Load, star: dict[str, DataFrame], d: dt.date):
        """The dimensions as they will be, and what was refused."""
        after, refused, jobs = {}, {}, []

        def stage(table: str, key: str) -> None:
            stored = self.read(table)
            batch = star[table].select(*schemas.TABLES[table].names).distinct()
            batch = batch.withColumn(checks.VIOLATIONS, checks.row_violations(table))
            batch = checks.with_repeats(batch, table, stored, key)
            n = self._admit(batch, table, lambda rows, _: dimension_rows_to_add(stored, rows, key).write.parquet(
                load.path(table)))
            added = self.spark.read.schema(schemas.TABLES[table]).parquet(load.path(table))
            after[table] = added if stored is None else stored.unionByName(added)
            if n:
                refused[table] = (checks.quarantined(batch, table, d), n)

        for table, key in DIMENSION_KEYS.items():
            jobs.append(lambda table=table, key=key: stage(table, key))
        run_concurrently(jobs)  # the four dimensions are independent of each other
        return after, refused

    def _stage_fact(self, load: Load, batch: DataFrame, dims: dict[str, DataFrame], d: dt.date):
        """The date's new partition (W2). The load reads other dates only;
        an empty batch leaves an empty partition."""
        names = schemas.TABLES["fact_sales"].names
        batch = batch.select(*names).where(F.col("ingestion_date").try_cast("date") == F.lit(d))
        checked = batch.withColumn(checks.VIOLATIONS, checks.row_violations("fact_sales"))
        checked = checks.with_orphans(checked, "fact_sales", dims)
        day = F.col("date_key").try_cast("int")
        days = batch.agg(F.min(day), F.max(day)).first()
        existing = self.read("fact_sales")
        others = None if existing is None else existing.where(F.col("ingestion_date") != F.lit(d))
        path = load.path("fact_sales", f"ingestion_date={d.isoformat()}")

        def write(watched: DataFrame, rows: DataFrame) -> None:
            # Sorting inside each task keeps date_key ranges tight in the
            # row-group statistics.
            with staged(odd_sales(others, rows, (days[0], days[1]))) as odd:
                rows = fact_partition_rows(others, rows, watched=watched, odd=odd).drop("ingestion_date")
                rows.sortWithinPartitions("date_key", "region_key").write.parquet(path)

        refused = {}
        if days[0] is None:
            empty_partition(self.spark, "fact_sales", "ingestion_date", path)
        n = self._admit(checked, "fact_sales", write) if days[0] is not None else checked.count()
        if n:
            refused["fact_sales"] = (checks.quarantined(checked, "fact_sales", d), n)
        return self._partition("fact_sales", path, d), refused

    def _partition(self, table: str, path: str, d) -> DataFrame:
        """One partition's files as rows of the table."""
        schema = StructType([f for f in schemas.TABLES[table].fields if f.name != "ingestion_date"])
        rows = self.spark.read.schema(schema).parquet(path).withColumn("ingestion_date", F.lit(d).cast("date"))
        return rows.select(*schemas.TABLES[table].names)

    def _stage_summaries(self, load: Load, fact: DataFrame, dim_product: DataFrame, d) -> None:
        """The summaries of one date's fact rows, and ids for its new keys."""
        ids = {}

        def number(kind: str) -> None:
            table = f"ids_{kind}"
            stored, staged_before = self.read(table), load.files.exists(load.path(table))
            if staged_before:  # another date of this load has numbered keys
                before = self.spark.read.schema(schemas.KEY_IDS).parquet(load.path(table))
                stored = before if stored is None else stored.unionByName(before)
            partials.dense_ids(stored, partials.keys_of(fact, kind)).write.mode("append").parquet(load.path(table))
            added = self.spark.read.schema(schemas.KEY_IDS).parquet(load.path(table))
            ids[kind] = added if self.read(table) is None else self.read(table).unionByName(added)

        run_concurrently([lambda kind=kind: number(kind) for kind in partials.DISTINCT_KEYS])
        rows = {
            "fact_daily": partials.daily_rows(fact),
            "fact_category": partials.category_rows(fact, dim_product),
            "fact_bitmaps": partials.bitmap_rows(fact, dim_product, ids),
        }
        partition = f"ingestion_date={d if isinstance(d, str) else d.isoformat()}"
        run_concurrently([
            lambda table=table, df=df: schemas.conform(df, table).drop("ingestion_date").write.parquet(
                load.path(table, partition))
            for table, df in rows.items()])

    def _stage_stored_summaries(self, load: Load, date: str, dim_product: DataFrame) -> None:
        fact = self._partition("fact_sales", f"{self.path('fact_sales')}/ingestion_date={date}", date)
        self._stage_summaries(load, fact, dim_product, date)

    def _stage_quarantine(self, load: Load, refused: list[DataFrame], d: dt.date) -> None:
        """Refused rows replace those of an earlier load of the date."""
        path = load.path("load_quarantine", f"ingestion_date={d.isoformat()}")
        if not refused:
            if d.isoformat() in self.dates("load_quarantine"):
                empty_partition(self.spark, "load_quarantine", "ingestion_date", path)
            return
        rows = reduce(DataFrame.unionByName, refused)
        schemas.conform(rows, "load_quarantine").drop("ingestion_date").write.parquet(path)

    # -- W3 ----------------------------------------------------------------
    def anomaly_note(self) -> str | None:
        """What the last finished detection noted; None if there is none or a
        later one did not finish."""
        names = Files(self.spark, self.root).names(f"{self.root}/{ANOMALY_NOTE}")
        return names[0] if len(names) == 1 else None

    def note_anomalies(self, note: str | None) -> None:
        """Replaces the note, the name of an empty file; None removes it."""
        files, folder = Files(self.spark, self.root), f"{self.root}/{ANOMALY_NOTE}"
        files.delete(folder)
        if note is not None:
            files.create(f"{folder}/{note}")

    def persist_anomalies(self, flags: DataFrame, detected_at=None, since: dt.date | None = None) -> None:
        """W3 with a stamp. The table is partitioned by year of metric_date;
        only the years inside the batch's range are rewritten (dynamic
        partition overwrite from a reliable checkpoint), so a failed write
        never leaves the table without its history and a rerun repairs it.
        Years, not days or months: the table holds a few rows per day.
        ``since`` is the first day of the range that ``flags`` replace where
        that day may have no rows any more."""
        stamp = F.current_timestamp() if detected_at is None else F.lit(detected_at).cast("timestamp")
        year = F.year("metric_date")
        # One row per day and region: worked out once, read several times.
        new = schemas.conform(flags.withColumn("detected_at", stamp), "anomaly_flags").persist()
        try:
            lo, hi = new.agg(F.min("metric_date"), F.max("metric_date")).first()
            if lo is None:
                return
            lo = lo if since is None else min(lo, since)
            existing = self.read("anomaly_flags")
            if existing is not None:
                existing = existing.where(year.between(lo.year, hi.year))
            with staged(replace_anomaly_range(existing, new, (lo, hi)).withColumn(ANOMALY_PARTITION, year)) as merged:
                written = {r[0] for r in merged.select(ANOMALY_PARTITION).distinct().collect()}  # calendar-bounded
                if existing is not None:
                    stale = {r[0] for r in existing.select(year).distinct().collect()} - written
                    for y in stale:  # years left with no rows would keep their old folder
                        empty_partition(self.spark, "anomaly_flags", ANOMALY_PARTITION,
                                        f"{self.path('anomaly_flags')}/{ANOMALY_PARTITION}={y}")
                (
                    merged.repartition(ANOMALY_PARTITION)
                    .write.mode("overwrite")
                    .option("partitionOverwriteMode", "dynamic")
                    .partitionBy(ANOMALY_PARTITION)
                    .parquet(self.path("anomaly_flags"))
                )
        finally:
            new.unpersist()

    # -- W4 ----------------------------------------------------------------
    def persist_forecasts(self, forecasts: DataFrame, run_date, created_at=None) -> None:
        if forecasts.isEmpty():
            return
        stamp = F.current_timestamp() if created_at is None else F.lit(created_at).cast("timestamp")
        new = schemas.conform(forecasts.withColumn("created_at", stamp), "revenue_forecasts")
        d = _date(run_date)
        existing = self.read("revenue_forecasts")
        if existing is not None:
            touched = new.select("forecast_run_date").union(
                self.spark.createDataFrame([(d,)], "forecast_run_date date")
            ).distinct()
            existing = existing.join(touched, "forecast_run_date", "left_semi")
        with staged(replace_forecast_run(existing, new, d)) as merged:
            if existing is not None and merged.where(F.col("forecast_run_date") == F.lit(d)).isEmpty():
                empty_partition(self.spark, "revenue_forecasts", "forecast_run_date",
                                f"{self.path('revenue_forecasts')}/forecast_run_date={d.isoformat()}")
            (
                merged.repartition("forecast_run_date")
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("forecast_run_date")
                .parquet(self.path("revenue_forecasts"))
            )
