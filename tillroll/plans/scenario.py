"""The batch scenarios the registered queries run over the test tables.

* one batch: every raw row, ingestion date 2026-07-21, loaded into an empty
  warehouse;
* a load sequence (first write wins, partition rerun): with k the digits of
  InvoiceNo, batch A holds k % 3 in (0, 1) dated 2026-07-21 and batch B
  holds k % 3 in (1, 2) dated 2026-07-22, so the two overlap on k % 3 = 1;
  then A is rerun with k % 3 = 0 only. Together the batches cover every
  row; the split defines overlapping loads, it does not sample.

A table state that the daily run would store (cleaned rows, dimensions, a
fact after a load, key ids, summaries, daily metrics) is written once, when it
is first asked for, as Parquet in a folder of the scenario below the shared
checkpoint folder. What follows plans over those files: no plan holds the
loads before it, and nothing wide stays in executor memory. Everything else
is lazy.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Callable, Iterator, Mapping
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import anomaly, clean, forecast, metrics, partials, star, validate, warehouse
from tillroll.session import checkpoint_dir, drop_folder, run_concurrently, written
from tillroll.sources.retail_adapter import raw_transactions

BATCH_DATE = dt.date(2026, 7, 21)
SECOND_DATE = dt.date(2026, 7, 22)
# The remainder that deals a row to the batches of the load sequence: rows of
# one are stored in a folder of their own, so a batch reads only its files.
SPLIT, SPLITS = "invoice_remainder", 3
# Upper bound given to the bounded metric / backfill runs.
RUN_DATE = dt.date(2000, 1, 1)


class Tables(Mapping):
    """Tables by name, each made when it is first read."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        self._makers = makers
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def invoice_digits(column: str = "InvoiceNo") -> F.Column:
    return F.regexp_replace(F.col(column), "[^0-9]", "").try_cast("bigint")


def remainder(column: str) -> F.Column:
    return (F.coalesce(invoice_digits(column), F.lit(0)) % SPLITS).cast("int")


class Batch:
    """One batch's steps, each built once. ``store`` writes a table;
    ``cleaned`` and ``fact`` read those the scenario stores."""

    def __init__(self, labelled: DataFrame, ingestion_date: dt.date, store: Callable[[DataFrame, str], DataFrame],
                 cleaned: Callable[[], DataFrame], fact: Callable[[], DataFrame], whole: bool = False):
        self.labelled = labelled
        self.ingestion_date = ingestion_date
        self._store = store
        self._cleaned = cleaned
        self._fact = fact
        self._whole = whole

    @cached_property
    def accepted(self) -> DataFrame:
        return validate.accepted_rows(self.labelled)

    @cached_property
    def rejected(self) -> DataFrame:
        return validate.rejected_rows(self.labelled)

    @cached_property
    def cleaned(self) -> DataFrame:
        """Stored: it feeds the five star tables (the curated tables of the
        daily run)."""
        return self._cleaned()

    @cached_property
    def star(self) -> Tables:
        """The five curated tables, each stored when it is first read."""
        def table(name: str) -> DataFrame:
            if name == "fact_sales":
                return self._fact()
            return self._store(star.star_table(name, self.cleaned, self._store), f"curated_{name}")

        return Tables({name: partial(table, name) for name in star.STAR_TABLES})

    @property
    def fact_rows(self) -> DataFrame:
        """The curated fact's rows for what reads them in passes of few
        columns: a map of the stored cleaned rows, not stored once more."""
        return star.star_table("fact_sales", self.cleaned) if self._whole else self._fact()


_SCENARIOS: dict = {}


def scenario(spark: SparkSession, sf_dir: str) -> "Scenario":
    """The session's scenario over ``sf_dir``, built once: every registered
    query then composes its result over the same stored tables instead of
    rebuilding the upstream plans. A new Spark application gets a new
    scenario."""
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # sessions without a SparkContext handle
        app = id(spark)
    key = (app, os.path.abspath(sf_dir))
    if key not in _SCENARIOS:
        _SCENARIOS[key] = Scenario(spark, sf_dir)
    return _SCENARIOS[key]


def reset(spark: SparkSession) -> None:
    """Drops every scenario and the tables it stored."""
    spark.catalog.clearCache()
    for dropped in _SCENARIOS.values():
        dropped.drop(spark)
    _SCENARIOS.clear()


class Scenario:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._daily: dict = {}

    @cached_property
    def folder(self) -> str:
        return f"{checkpoint_dir(self.spark).rstrip('/')}/scenario-{uuid.uuid4().hex}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """A table state as the daily run would have written it."""
        return written(df, f"{self.folder}/{name}-{uuid.uuid4().hex}")

    def store_all(self, parts: list[DataFrame], name: str) -> DataFrame:
        """One table state written part by part."""
        path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
        return [written(part, path) for part in parts][-1]

    @cached_property
    def cleaned(self) -> DataFrame:
        """The batch's cleaned rows and their remainder, stored."""
        rows = clean.clean_transactions(self.batch.accepted)
        return written(rows.withColumn(SPLIT, remainder("InvoiceNo")), f"{self.folder}/cleaned-{uuid.uuid4().hex}", SPLIT)

    @cached_property
    def curated_fact(self) -> DataFrame:
        """The batch's curated fact, stored folder by folder as its cleaned
        rows are, so that no row is sorted for it."""
        path = f"{self.folder}/curated_fact_sales-{uuid.uuid4().hex}"
        parts = [star.star_table("fact_sales", self.cleaned.where(F.col(SPLIT) == k)) for k in range(SPLITS)]
        run_concurrently([partial(written, part, f"{path}/{SPLIT}={k}") for k, part in enumerate(parts)])
        schema = parts[0].withColumn(SPLIT, F.lit(0)).schema
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, spark: SparkSession) -> None:
        """Deletes what the scenario stored."""
        if "folder" in self.__dict__:
            drop_folder(spark, self.folder)

    @cached_property
    def raw(self) -> DataFrame:
        return raw_transactions(self.spark, self.sf_dir)

    @cached_property
    def labelled(self) -> DataFrame:
        """Every raw row, typed and labelled. Not kept: a query reads it once,
        and keeping it would hold every row with its raw text."""
        return validate.label_rows(self.raw, BATCH_DATE)

    # -- one batch ---------------------------------------------------------
    @cached_property
    def batch(self) -> Batch:
        return Batch(self.labelled, BATCH_DATE, self.store, cleaned=lambda: self.cleaned.drop(SPLIT),
                     fact=lambda: self.curated_fact.drop(SPLIT), whole=True)

    @cached_property
    def fact(self) -> DataFrame:
        """fact_sales after loading the batch into an empty table."""
        return self._load(None, self.batch.fact_rows, BATCH_DATE, "fact_sales")

    def _load(self, existing: DataFrame | None, rows: DataFrame, date: dt.date, name: str) -> DataFrame:
        """The fact after a load, which writes its own date's rows only."""
        return warehouse.load_fact(existing, rows, date, self.store, lambda new: self.store(new, name))

    def dims(self) -> Mapping[str, DataFrame]:
        return Tables({t: partial(self.batch.star.__getitem__, t) for t in star.STAR_TABLES if t != "fact_sales"})

    def daily(self, run_date=None) -> DataFrame:
        return self.daily_of(self.fact, self.batch.star, run_date)

    @cached_property
    def flags(self) -> DataFrame:
        return anomaly.detect_anomalies(self.daily())

    @cached_property
    def forecasts(self) -> DataFrame:
        return forecast.forecast_revenue(self.daily())

    # -- load sequence -----------------------------------------------------
    def _split(self, remainders, date) -> Batch:
        """A batch of the rows whose InvoiceNo digits fall in ``remainders``.

        Cleaning is per row except the whole-row dedup, and copies of a row
        share their InvoiceNo, so they land in the same batch: cleaning the
        batch equals taking its rows of the cleaned whole with the batch's
        own date. The batch reuses that one stored table, and likewise the
        stored fact, which is a map of the cleaned rows.
        """
        def rows(whole: DataFrame, part: F.Column) -> DataFrame:
            return whole.where(part.isin(list(remainders))).withColumn("ingestion_date", F.lit(date))

        return Batch(
            rows(self.labelled, remainder("InvoiceNo")),
            date,
            self.store,
            cleaned=lambda: rows(self.cleaned, F.col(SPLIT)).drop(SPLIT),
            fact=lambda: rows(self.curated_fact, F.col(SPLIT)).drop(SPLIT),
        )

    @cached_property
    def batch_a(self) -> Batch:
        return self._split((0, 1), BATCH_DATE)

    @cached_property
    def batch_b(self) -> Batch:
        return self._split((1, 2), SECOND_DATE)

    @cached_property
    def batch_a_rerun(self) -> Batch:
        return self._split((0,), BATCH_DATE)

    @cached_property
    def fact_a(self) -> DataFrame:
        return self._load(None, self.batch_a.star["fact_sales"], BATCH_DATE, "fact_a")

    @cached_property
    def fact_ab(self) -> DataFrame:
        return self._load(self.fact_a, self.batch_b.star["fact_sales"], SECOND_DATE, "fact_ab")

    @cached_property
    def fact_rerun(self) -> DataFrame:
        return self._load(self.fact_ab, self.batch_a_rerun.star["fact_sales"], BATCH_DATE, "fact_rerun")

    def _after(self, before: Mapping[str, DataFrame], batch: Batch) -> Tables:
        """The dimensions after a load, which stores the rows it adds."""
        def table(name: str, key: str) -> DataFrame:
            added = warehouse.dimension_rows_to_add(before[name], batch.star[name], key)
            return before[name].unionByName(self.store(added, f"added_{name}"))

        return Tables({t: partial(table, t, key) for t, key in warehouse.DIMENSION_KEYS.items()})

    @cached_property
    def dims_ab(self) -> Tables:
        return self._after(self.batch_a.star, self.batch_b)

    @cached_property
    def dims_rerun(self) -> Tables:
        return self._after(self.dims_ab, self.batch_a_rerun)

    # -- summaries the loads leave -------------------------------------------
    @cached_property
    def key_ids(self) -> dict[str, DataFrame]:
        """The key dictionaries after both loads and the rerun: each load
        stores the ids it added."""
        found = {}
        for kind in partials.DISTINCT_KEYS:
            ids = None
            for _, rows in self._load_rows():
                added = self.store(partials.dense_ids(ids, partials.keys_of(rows, kind)), f"ids_{kind}")
                ids = added if ids is None else ids.unionByName(added)
            found[kind] = ids
        return found

    def _load_rows(self) -> list[tuple[dt.date, DataFrame]]:
        """The fact rows each load of the sequence wrote."""
        return [(d, fact.where(F.col("ingestion_date") == F.lit(d))) for d, fact in (
            (BATCH_DATE, self.fact_ab), (SECOND_DATE, self.fact_ab), (BATCH_DATE, self.fact_rerun))]

    @cached_property
    def summaries(self) -> Tables:
        """The summary tables after the sequence: each load replaced its own
        date's rows, so only those of a date's last load are worked out. A
        load's rows are stored by themselves, each kind of bitmaps in a job of
        its own, so that no plan holds them all."""
        made = {
            "fact_daily": lambda rows: [partials.daily_rows(rows)],
            "fact_category": lambda rows: [partials.category_rows(rows, self.dims_rerun["dim_product"])],
            "fact_bitmaps": lambda rows: partials.bitmap_parts(
                rows, self.dims_rerun["dim_product"], self.key_ids, self.store),
        }

        def table(name: str) -> DataFrame:
            state = None
            for d, rows in dict(self._load_rows()).items():
                state = partials.replace_date(state, self.store_all(made[name](rows), name), d)
            return state

        return Tables({name: partial(table, name) for name in made})

    def daily_of(self, fact: DataFrame, dims: Mapping[str, DataFrame], run_date=None) -> DataFrame:
        """Daily metrics of a fact state; stored (one row per day and region)
        because both models and the run-date lookups read them."""
        key = (id(fact), id(dims["dim_date"]), run_date)
        if key not in self._daily:
            daily = metrics.daily_metrics(fact, dims["dim_date"], dims["dim_region"], run_date)
            self._daily[key] = self.store(daily, "daily")
        return self._daily[key]
