"""The daily run: dimensions, ingest, warehouse, reports."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tillmark.operators import alerts, bronze, dimensions, outliers
from tillmark.operators.flaws import broken_limits
from tillmark.operators.reference_check import missing_reference
from tillmark.plans.incremental import refresh_star
from tillmark.plans.warehouse import load_measured, load_warehouse, star_schema
from tillmark.sinks import transactions
from tillmark.sinks.layers import write_layer
from tillmark.sinks.metrics import ROW_COUNT, record
from tillmark.sinks.reports import write_invalid_country_report, write_outlier_report
from tillmark.sources import files
from tillmark.sources.layers import read_layer, read_quantity_histogram, read_valid_transactions
from tillmark.streaming.ingest import compact_transactions, ingest_new_files, replay_countries


Load = Callable[[dict[str, DataFrame]], dict[str, int]]

#: How much raw data one batch of the ingest takes at most, so that a failure repeats no more than that.
BATCH_BYTES = 1 << 40


@dataclass(frozen=True)
class DailyRun:
    """Folders of a run. All but the raw files are written; ``lake`` must be shared by all executors.

    ``source_options`` are those of Spark's file source; for a folder that keeps growing, ``cleanSource`` moves files
    away once they are stored, which keeps listing it cheap. ``limits`` says of which share of a bronze table's rows a
    flaw may be found, by table and flaw (see ``flaws``); what exceeds one is among the reports as ``broken_limits``.
    """

    raw_transactions: str
    raw_countries: str
    raw_products: str
    lake: str
    source_options: dict[str, str | int] = field(default_factory=lambda: {"maxBytesPerTrigger": BATCH_BYTES})
    limits: dict[tuple[str, str], float] = field(default_factory=dict)

    @property
    def transactions(self) -> str:
        return f"{self.lake}/transactions"

    @property
    def checkpoint(self) -> str:
        return f"{self.lake}/checkpoints/transactions"

    @property
    def gold(self) -> str:
        return f"{self.lake}/gold"

    @property
    def reports(self) -> str:
        return f"{self.lake}/reports"

    @property
    def metrics(self) -> str:
        return f"{self.lake}/metrics"


def refresh_dimensions(spark: SparkSession, run: DailyRun) -> dict[str, int]:
    """Write the country and the product layer anew. Prices lie in order of day, so that readers of some months skip
    the rest."""
    frames = {
        "countries": bronze.countries(files.read_countries(spark, run.raw_countries)),
        "products": bronze.products(files.read_products(spark, run.raw_products)),
    }
    order = {"countries": (), "products": ("Date",)}
    measured = load_measured(frames, lambda df, name: write_layer(df, name, run.lake, sort_by=order[name]))
    record(spark, run.metrics, measured)
    return {name: counts[ROW_COUNT] for name, counts in measured.items()}


def ingest_transactions(spark: SparkSession, run: DailyRun) -> dict[str, int]:
    """Store the raw files that came since the last call and merge the folders of small batches; also the job to run
    between daily runs."""
    raw = files.stream_transactions(spark, run.raw_transactions, **run.source_options)
    counts = ingest_new_files(raw, read_layer(spark, "countries", run.lake), run.transactions, run.checkpoint)
    compact_transactions(spark, run.transactions)
    # Counts of all that is stored, as the batches' writes have left them: no row is read for them.
    record(spark, run.metrics, {"transactions": transactions.measured(spark, run.transactions)})
    return {f"ingest_{name}": count for name, count in counts.items()}


def replay_quarantine(spark: SparkSession, run: DailyRun) -> dict[str, int]:
    """Judge the stored transactions by the stored countries as they are now, and bring nothing else up to date.

    Not part of a daily run: there, rows keep the verdict of the day they came, and the invalid-country report lists
    those whose country has gone since.
    """
    moved = replay_countries(read_layer(spark, "countries", run.lake), run.transactions)
    return {f"moved_to_{quality}": count for quality, count in moved.items()}


def stored_star(spark: SparkSession, run: DailyRun) -> dict[str, DataFrame]:
    """The star schema over the bronze layers."""
    return star_schema(
        read_valid_transactions(spark, run.transactions),
        read_layer(spark, "products", run.lake),
        read_layer(spark, "countries", run.lake),
    )


def refresh_gold(spark: SparkSession, run: DailyRun, load: Load | None = None) -> dict[str, int]:
    """Bring the star schema up to date: in Parquet the months that changed, or with ``load`` all of it to wherever that
    puts it. Returns the rows that each table has."""
    return load(stored_star(spark, run)) if load else refresh_star(spark, run.lake, run.gold)


def write_reports(spark: SparkSession, run: DailyRun) -> dict[str, int]:
    """Write both reports, the digest and its lines. The outliers are computed once and read back for the text report; medians and
    deviations come from the histogram that the ingest keeps."""
    valid = read_valid_transactions(spark, run.transactions)
    geography = dimensions.dim_geography(read_layer(spark, "countries", run.lake))
    histogram = read_quantity_histogram(spark, run.transactions)
    found = outliers.quantity_outliers(valid, histogram=histogram)
    invalid = missing_reference(valid, geography, "CountryID", "geo_id")
    counts = load_warehouse(
        {"outliers": found, "invalid_countries": invalid.select(*alerts.INVALID_COUNTRY_COLUMNS)},
        lambda df, name: write_layer(df, name, run.reports),
    )
    found, invalid = (read_layer(spark, name, run.reports) for name in ("outliers", "invalid_countries"))
    write_outlier_report(found, f"{run.reports}/outliers.txt")
    write_invalid_country_report(invalid, f"{run.reports}/invalid_country.csv")
    write_layer(alerts.alert_digest(found, invalid), "digest", run.reports)
    write_layer(alerts.alert_lines(found, invalid), "alert_lines", run.reports)
    if run.limits:
        metrics = read_layer(spark, "metrics", run.lake)
        write_layer(broken_limits(metrics, run.limits), "broken_limits", run.reports)
    return counts


def run_daily(spark: SparkSession, run: DailyRun, load: Load | None = None) -> dict[str, int]:
    """All steps in order; returns the rows written per table."""
    return {
        **refresh_dimensions(spark, run),
        **ingest_transactions(spark, run),
        **refresh_gold(spark, run, load),
        **write_reports(spark, run),
    }
