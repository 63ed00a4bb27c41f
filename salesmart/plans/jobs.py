"""The two load jobs: full refresh and incremental load."""

from __future__ import annotations

import contextlib
import datetime as dt
import functools
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from salesmart.contracts import CONTRACTS, DIMENSIONS, conform, guarded
from salesmart.functions.numbers import to_int64
from salesmart.operators import quality as Q
from salesmart.operators.filters import above_mark, complete, complete_computed, computed
from salesmart.operators.grouping import row_counts
from salesmart.plans import dimensions as B
from salesmart.plans import incremental as I
from salesmart.plans import segmentation as S
from salesmart.plans.feature_state import FeatureState, dimension_products
from salesmart.plans.facts import FACT_INPUT, MONTH, keyed_facts, typed_sales, with_month
from salesmart.plans.measures import Mart
from salesmart.sources import generators as G
from salesmart.sources import tables as T
from salesmart.sources.generators import literal
from salesmart.workspace import scratch, settle

SCHEMAS = {
    **{name: "dwh" for name in (*DIMENSIONS, "FactSales", "DateSlicer", "PharmacySegmentation")},
    "FactSales_IncrementalBatch": "stg",
    "Watermark": "etl",
    "LoadLog": "etl",
}


@dataclass(frozen=True)
class Feeds:
    """Raw sources as text columns, and the districts settled by hand."""

    sales: DataFrame
    products: DataFrame
    pharmacies: DataFrame
    locations: DataFrame
    district_map: DataFrame
    operators: DataFrame
    pos: DataFrame
    manual: dict[str, str] | None = None
    manual_by_key: dict[str, str] | None = None


@dataclass
class Warehouse:
    """Where each table lives, and the log of one run.

    Tables lie in the current version of the folder ``root``; a ``draft`` is a
    version that nobody reads until it is published; that fails if another job
    published since the draft was begun.  The log stands outside.
    """

    spark: SparkSession
    root: str
    run: str = field(default_factory=lambda: uuid.uuid4().hex)
    draft: str | None = None
    expected: int = 0
    lines: list[tuple] | None = None

    def __post_init__(self) -> None:
        self.expected = T.latest_number(self.spark, self.root)

    def path(self, table: str) -> str:
        if table == "LoadLog":
            return f"{self.root}/{SCHEMAS[table]}/{table}"
        home = f"{self.root}/{self.draft}" if self.draft else T.current(self.spark, self.root)
        return f"{home}/{SCHEMAS[table]}/{table}"

    def exists(self, table: str) -> bool:
        return T.exists(self.spark, self.path(table))

    def read(self, table: str) -> DataFrame:
        schema = CONTRACTS[table]
        if table == "FactSales":
            schema = StructType([*schema, StructField(MONTH, IntegerType())])
        return T.scan(self.spark, self.path(table), schema)

    def clear(self, table: str) -> None:
        if table == "FactSales":
            T.replace(with_month(literal(self.spark, [], CONTRACTS[table])), self.path(table), [MONTH])
        else:
            T.create(self.spark, table, self.path(table))

    def publish(self) -> None:
        """Make the draft the mart that everybody reads, all tables at once."""
        T.publish(self.spark, self.root, self.draft, self.expected)
        self.draft = None

    @contextlib.contextmanager
    def step(self, job: str, name: str, table: str | None = None) -> Iterator[dict]:
        """Log a step, with the rows it puts into what it is given, whether it ends well or not."""
        started, done = dt.datetime.now(), {}
        try:
            yield done
        except Exception as problem:
            self.log(job, name, table, None, started, "Failed", str(problem))
            raise
        self.log(job, name, table, done.get("rows"), started)

    def write(self, table: str, df: DataFrame, job: str, append: bool = False) -> int:
        """Write a table and log its rows, which are counted from the files just written.

        Rows to append are settled first: they are computed once, against the
        table as it was, and the append itself only copies them.
        """
        rows = guarded(df, table)
        parts = [MONTH] if table == "FactSales" else None
        rows = with_month(rows) if parts else rows
        with self.step(job, f"write {table}", table) as done:
            if append:
                rows = settle(rows, f"append-{table}")
                T.append(rows, self.path(table), parts)
            else:
                rows = T.replace(rows, self.path(table), parts)
            done["rows"] = rows.count()
        return done["rows"]

    def log(self, job, step, table, rows, started, status="Succeeded", error=None) -> None:
        line = I.log_line(self.run, job, step, table, rows, started, status, error)
        if self.lines is None:
            self._append_log([line])
        else:
            self.lines.append(line)

    def _append_log(self, lines: list[tuple]) -> None:
        T.append(literal(self.spark, lines, CONTRACTS["LoadLog"]).coalesce(1), self.path("LoadLog"))

    @contextlib.contextmanager
    def logged(self) -> Iterator[None]:
        """Write the log's lines of a job together when it ends, well or not, instead of a file for each."""
        self.lines = []
        try:
            yield
        finally:
            lines, self.lines = self.lines, None
            if lines:
                self._append_log(lines)

    def counts(self, tables: tuple[str, ...]) -> DataFrame:
        return row_counts({t: self.read(t) for t in tables})

    def mart(self) -> Mart:
        names = (*DIMENSIONS, "DateSlicer", "PharmacySegmentation")
        return Mart(self.read("FactSales"), {n: self.read(n) for n in names if self.exists(n)})

    def advance_mark(self, loaded: DataFrame, job: str = "load") -> None:
        """Move the mark to the later of itself and the last of the rows just loaded."""
        with self.step(job, "advance mark", "Watermark"):
            expected = T.latest_number(self.spark, self.path("Watermark"))
            control = self.read("Watermark")
            moved = T.update_control(control, I.PROCESS, I.next_mark(loaded, I.mark_row(control)))
            T.replace(conform(moved, "Watermark").coalesce(1), self.path("Watermark"), expected=expected)


def write_dimensions(house: Warehouse, feeds: Feeds, job: str, bounds: DataFrame) -> None:
    """All dimensions anew, but for what stored facts rely on: product keys stay and the calendar only grows."""
    products, days = (house.read(t) if house.exists(t) else None for t in ("DimProduct", "DimDate"))
    known = products is not None and not products.isEmpty()
    if days is not None and not days.isEmpty():
        bounds = B.wider_bounds(bounds, days)
    # None of these reads another, and each is far too small to keep a cluster busy: they are written side by side.
    side_by_side(
        house.spark,
        lambda: house.write("DimProduct", B.refresh_product(products, feeds.products) if known else B.build_product(feeds.products), job),
        lambda: house.write("DimLocation", B.build_location(feeds.locations, feeds.district_map, feeds.manual), job),
        lambda: house.write("DimPOS", B.build_pos(feeds.pos), job),
        lambda: house.write("DimOperator", B.build_operator(feeds.operators), job),
        lambda: house.write("DimPharmacy", B.build_pharmacy(feeds.pharmacies), job),
        lambda: house.write("DimTime", B.build_time(house.spark), job),
        lambda: (
            house.write("DimDate", B.build_date(bounds), job),
            house.write("DateSlicer", B.build_slicer(house.read("DimDate")), job),
        ),
    )


def side_by_side(spark: SparkSession, *steps: Callable[[], object]) -> None:
    """Run steps in threads of their own; all end before the first failure is raised."""
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    for step in running:
        step.result()


ANALYSIS = "analysis"


def parsed_sales(feed: DataFrame, analysis: bool = True) -> DataFrame:
    """The raw feed read once: typed columns for the facts and, as a struct, the segmentation's own reading if it is needed.

    The two readings are computed one after the other: generated as one, the code is too long to be compiled.
    """
    if not analysis:
        return settle(typed_sales(feed).select(*FACT_INPUT), "sales")
    both = computed(feed.withColumn(ANALYSIS, F.struct(*S.sale_columns("Sale ID", "Pharmacy"))))
    return settle(typed_sales(both).select(*FACT_INPUT, ANALYSIS), "sales")


def prepared_stores(feeds: Feeds) -> DataFrame:
    """Stores with corrected places, as the segmentation reads them; an unknown district is an error."""
    places = Q.require_known_districts(
        B.corrected_locations(feeds.locations, feeds.district_map, feeds.manual_by_key)
    )
    return S.prepare_pharmacies(feeds.pharmacies.withColumnsRenamed(B.PHARMACY_COLUMNS), places)


def segment_stores(feeds: Feeds, parsed: DataFrame | None = None) -> S.Segmentation:
    """Segmentation from the raw feeds, with its own cleaning rules."""
    parsed = parsed_sales(feeds.sales) if parsed is None else parsed
    sales = S.valid_sales(parsed.select(f"{ANALYSIS}.*"))
    return S.segment(S.store_features(sales, S.prepare_products(feeds.products), prepared_stores(feeds)))


def final_report(house: Warehouse) -> dict[str, DataFrame]:
    tables = (*DIMENSIONS, "FactSales", "PharmacySegmentation")
    return {
        "rows": Q.row_count_report({t: house.read(t) for t in tables}),
        "nulls": Q.null_report(house.read("FactSales")),
        "segmentation": Q.segmentation_report(house.read("PharmacySegmentation")),
    }


def full_refresh(
    spark: SparkSession, feeds: Feeds, root: str, bounds: DataFrame | None = None,
    segmented: Callable[[Feeds, DataFrame], S.Segmentation] | None = segment_stores,
) -> Warehouse:
    """Build a new mart beside the live one, check every step, and publish it at the end.

    Empty tables, check, dimensions, check, facts, check, segments, check, mark,
    publish.  If a step fails the old mart stays as it was.  ``segmented=None``
    leaves the segments out.
    """
    job, house = "full_refresh", Warehouse(spark, root, draft=T.new_version())
    with house.logged(), scratch(spark):
        with house.step(job, "clear"):
            side_by_side(spark, *(functools.partial(house.clear, table) for table in ("FactSales", *DIMENSIONS)))
        with house.step(job, "check empty"):
            Q.require_empty(house.counts(("FactSales", *DIMENSIONS)))
        parsed = parsed_sales(feeds.sales, analysis=segmented is not None)
        sales = complete(parsed.drop(ANALYSIS))
        write_dimensions(house, feeds, job, G.date_bounds(sales, F.col("SourceSaleDateTime")) if bounds is None else bounds)
        with house.step(job, "check dimensions"):
            Q.require_loaded(house.counts(DIMENSIONS))
        house.write("FactSales", keyed_facts(sales, house.read("DimProduct")), job)
        with house.step(job, "check facts"):
            Q.require_loaded(Q.control_totals(house.read("FactSales")).select("FactSalesRows"))
        if segmented:
            segments = segmented(feeds, parsed).segments
            with house.step(job, "check segments"):
                Q.require_checks(Q.output_checks(segments))
            house.write("PharmacySegmentation", S.for_warehouse(segments), job)
        T.replace(conform(G.first_watermark(spark, I.PROCESS), "Watermark"), house.path("Watermark"))
        house.advance_mark(sales.withColumnRenamed("SaleID", "PK_SaleID"), job)
        with house.step(job, "publish"):
            house.publish()
    return house


def incremental_load(
    spark: SparkSession, feeds: Feeds, root: str, *, refresh: bool = True, composite: bool = False,
    bounds: DataFrame | None = None,
) -> int:
    """Refresh dimensions, stage what lies above the mark, insert what is new, move the mark.

    A re-run inserts nothing.  ``refresh=False`` leaves the dimensions as they
    are.  ``composite`` holds rows against the mark's timestamp and id instead
    of its id alone; rows at or below it that are not stored yet stay out.
    """
    job, house = "incremental_load", Warehouse(spark, root)
    with house.logged(), scratch(spark):
        mark = I.read_mark(house.read("Watermark"), composite)
        house.clear("FactSales_IncrementalBatch")
        later = feeds.sales
        if not composite:
            # Rows below the mark are left out on their id alone, before anything else is parsed.
            later = later.filter(above_mark(to_int64(F.col("Sale ID")), mark.last_id))
        sales = settle(complete_computed(typed_sales(later)).select(*FACT_INPUT), "sales")
        if refresh:
            write_dimensions(house, feeds, job, G.date_bounds(sales, F.col("SourceSaleDateTime")) if bounds is None else bounds)
            with house.step(job, "check dimensions"):
                Q.require_loaded(house.counts(DIMENSIONS))
        house.write("FactSales_IncrementalBatch", I.stage(keyed_facts(sales, house.read("DimProduct")), mark), job)
        staged = house.read("FactSales_IncrementalBatch")
        known = I.within_batch(staged, house.read("FactSales"))
        inserted = house.write("FactSales", I.rows_to_insert(staged, known, mark), job, append=True)
        house.advance_mark(staged.withColumnRenamed("SaleID", "PK_SaleID"), job)
    return inserted


def current_features(house: Warehouse, feeds: Feeds) -> tuple[DataFrame, list[int]]:
    """Store features of the stored facts, and the months of facts that were read to bring their state up to date."""
    state, facts = FeatureState(house.spark, f"{house.root}/state/StoreFeatures"), house.read("FactSales")
    months = state.refresh(T.current(house.spark, house.path("FactSales")), facts)
    stores = prepared_stores(feeds).withColumn("PharmacyID", to_int64(F.col("PharmacyID")))
    return state.features(facts, dimension_products(house.read("DimProduct")), stores), months


def refresh_segments(spark: SparkSession, feeds: Feeds, root: str) -> list[int]:
    """Segments anew from the stored facts, after any number of increments.

    Of the facts only months that changed since the last call are read; the raw
    sales are not.  Gives these months.
    """
    job, house = "refresh_segments", Warehouse(spark, root)
    with house.logged(), scratch(spark):
        with house.step(job, "refresh features", "FactSales"):
            features, months = current_features(house, feeds)
        segments = S.segment(features).segments
        with house.step(job, "check segments"):
            Q.require_checks(Q.output_checks(segments))
        house.write("PharmacySegmentation", S.for_warehouse(segments), job)
    return months
