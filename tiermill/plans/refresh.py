"""The full run: extracts to bronze, bronze to silver, silver to gold, then the quality checks.

Every table is named with its inputs and builder, and each layer is written before the next one reads it, so
a lost executor is repaired from stored tables. Dimensions are written before the fact that looks them up. The run is
published when all tables are written, all at once, so readers see tables of one run only.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator, Mapping
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tiermill.operators.conform import AUDIT_COLUMN, conform, stamp
from tiermill.operators.dedup import keep_first, require_key
from tiermill.operators.quality import dq_report, enforce
from tiermill.plans import gold, silver
from tiermill.plans.checks import store_checks
from tiermill.plans.schemas import GOLD, MEASURE, SILVER, with_measures
from tiermill.plans.together import together
from tiermill.settings import settings
from tiermill.sources.extracts import INGEST_ORDER, SOURCES, Source, read_all
from tiermill.sources.scratch import materialize, scratch_scope
from tiermill.sources.warehouse import RunReport, Warehouse


@dataclass(frozen=True)
class TableSpec:
    """A derived table: where it is stored, what it reads, how it is built, which run options it takes."""

    layer: str
    name: str
    inputs: tuple[tuple[str, str], ...]
    builder: Callable[..., DataFrame]
    options: tuple[str, ...] = ()

    @property
    def columns(self) -> Mapping[str, str]:
        return {"silver": SILVER, "gold": GOLD}[self.layer][self.name]


TABLES = (
    TableSpec("silver", "crm_cust_info", (("bronze", "crm_cust_info"),), silver.silver_customers, ("on_invalid",)),
    TableSpec("silver", "crm_prd_info", (("bronze", "crm_prd_info"),), silver.silver_products, ("measure",)),
    TableSpec(
        "silver",
        "crm_sales_details",
        (("bronze", "crm_sales_details"),),
        silver.silver_sales,
        ("measure", "on_invalid"),
    ),
    TableSpec(
        "silver",
        "erp_cust_az12",
        (("bronze", "erp_cust_az12"),),
        silver.silver_erp_customers,
        ("as_of", "only_if_prefix", "on_invalid"),
    ),
    TableSpec("silver", "erp_loc_a101", (("bronze", "erp_loc_a101"),), silver.silver_locations),
    TableSpec("silver", "erp_px_cat_g1v2", (("bronze", "erp_px_cat_g1v2"),), silver.silver_categories),
    TableSpec(
        "gold",
        "dim_customers",
        (("silver", "crm_cust_info"), ("silver", "erp_cust_az12"), ("silver", "erp_loc_a101")),
        gold.dim_customers,
    ),
    TableSpec(
        "gold",
        "dim_products",
        (("silver", "crm_prd_info"), ("silver", "erp_px_cat_g1v2")),
        gold.dim_products,
        ("measure",),
    ),
    TableSpec(
        "gold",
        "fact_sales",
        (("silver", "crm_sales_details"), ("gold", "dim_products"), ("gold", "dim_customers")),
        gold.fact_sales,
        ("measure",),
    ),
    TableSpec(
        "gold",
        "flat_sales",
        (("gold", "fact_sales"), ("gold", "dim_products"), ("gold", "dim_customers")),
        gold.flat_sales,
    ),
    TableSpec(
        "gold", "sales_by_category", (("gold", "fact_sales"), ("gold", "dim_products")), gold.sales_by_category
    ),
    TableSpec(
        "gold",
        "sales_by_country_month",
        (("gold", "fact_sales"), ("gold", "dim_customers")),
        gold.sales_by_country_month,
    ),
)


def _waves(wanted: Collection[tuple[str, str]] | None = None) -> Iterator[list[TableSpec]]:
    """Derived tables in groups that read only from earlier groups; with ``wanted``, only these and what they read."""
    needed = set(wanted or ())
    for spec in reversed(TABLES):
        if (spec.layer, spec.name) in needed:
            needed.update(spec.inputs)
    waiting = [t for t in TABLES if wanted is None or (t.layer, t.name) in needed]
    while waiting:
        pending = {(t.layer, t.name) for t in waiting}
        wave = [t for t in waiting if not pending.intersection(t.inputs)]
        yield wave
        waiting = [t for t in waiting if t not in wave]


def bronze_rows(
    source: Source, extract: DataFrame, on_null_key: str = "drop", measure: str = MEASURE
) -> DataFrame:
    """Rows as landed: of a keyed source only the first row of every key in file order.

    Rows of a keyed source without a key are left out, or fail the job with ``on_null_key="fail"``.
    """
    if source.key is not None:
        present = require_key(extract, source.key, on_null=on_null_key)
        extract = keep_first(present, source.key, INGEST_ORDER, tiebreak=())
    return conform(extract, with_measures(source.columns, measure))


def run_named(warehouse: Warehouse, layer: str, name: str, **options) -> DataFrame:
    """Build one derived table from the stored tables it reads, without writing it.

    ``options`` are those of a run: ``as_of``, ``measure``, ``only_if_prefix`` and ``on_invalid``.
    """
    spec = next((t for t in TABLES if (t.layer, t.name) == (layer, name)), None)
    if spec is None:
        raise KeyError(f"{layer}.{name}")
    return _build(spec, warehouse.read, options)


def _build(
    spec: TableSpec, read: Callable[[str, str], DataFrame], options: Mapping[str, object]
) -> DataFrame:
    tables = [read(layer, table).drop(AUDIT_COLUMN) for layer, table in spec.inputs]
    return spec.builder(*tables, **{name: options[name] for name in spec.options if name in options})


def build_layers(
    bronze: Mapping[str, DataFrame], as_of: date | str | None = None, wanted: Collection[tuple[str, str]] | None = None
) -> dict[tuple[str, str], DataFrame]:
    """All tables, or those ``wanted`` and what they read, from bronze frames, each derived one kept in scratch, without a warehouse."""
    tables = {("bronze", name): df for name, df in bronze.items()}
    spark = next(iter(bronze.values())).sparkSession

    def store(spec: TableSpec) -> None:
        built = _build(spec, lambda layer, table: tables[layer, table], {"as_of": as_of})
        tables[spec.layer, spec.name] = materialize(built, spec.name).df

    for wave in _waves(wanted):
        together(spark, store, wave)
    return tables


@dataclass(frozen=True)
class RunResult:
    """Row counts per written table and the outcome of the checks."""

    report: RunReport
    quality: DataFrame


def _keyless(source: Source, extract: DataFrame, rows: Observation) -> DataFrame:
    """The extract, with a count of its rows that have no key as it passes."""
    return extract.observe(rows, F.count_if(F.col(source.key).isNull()).alias("keyless"))


def run_refresh(
    spark: SparkSession,
    folder: str,
    warehouse: Warehouse,
    as_of: date | str | None = None,
    run_ts: datetime | str | None = None,
    sources: Mapping[str, Source] = SOURCES,
    on_missing: str = "error",
    on_null_key: str = "drop",
    measure: str = MEASURE,
    enforce_quality: bool = False,
    on_invalid: str = "null",
    only_if_prefix: str | None = None,
    keep_versions: int = 1,
    hold_back: bool = False,
) -> RunResult:
    """Run everything. An empty derived table, or any other failure, stops the run and leaves the run before in place.

    With ``enforce_quality`` a failed check raises after all checks have run, and before earlier runs are deleted; the
    last ``keep_versions`` of these stay anyway. ``hold_back`` also keeps a run that fails its checks from being published. A missing extract raises here (``on_missing="empty"`` lands an
    empty table instead). ``measure`` is the type of costs, amounts, quantities and prices: ``decimal(18,4)``, say,
    keeps them exact. Dates that are none become NULL and are reported; ``on_invalid`` is passed on to the builders.
    Rows of a keyed extract without a key are left out and reported (``on_null_key="fail"`` stops the run instead).
    """
    run_ts = run_ts or datetime.now()
    report = RunReport()
    options = {"as_of": as_of, "measure": measure, "on_invalid": on_invalid, "only_if_prefix": only_if_prefix}
    without_key: dict[str, int] = {}

    def land(item: tuple[str, DataFrame]) -> None:
        source, extract = sources[item[0]], item[1]
        seen = Observation()
        if source.key is not None:
            extract = _keyless(source, extract, seen)
        rows = bronze_rows(source, extract, on_null_key, measure)
        staged.write(rows, "bronze", source.table, report=report)
        if source.key is not None:
            without_key[source.table] = seen.get["keyless"]

    def derive(spec: TableSpec) -> None:
        rows = _build(spec, staged.read, options)
        if spec.layer == "silver":
            rows = stamp(rows, run_ts)
        staged.write(rows, spec.layer, spec.name, require_rows=True, report=report)

    with settings(spark):
        staged = warehouse.init().begin()
        with scratch_scope(spark):
            extracts = read_all(spark, folder, sources, measure, on_missing=on_missing)
            together(spark, land, extracts.items())
            for wave in _waves():
                together(spark, derive, wave)
            found = dq_report(store_checks(staged.read))
            verdicts = [tuple(row) for row in found.collect()]  # one row per check
        verdicts += [("rows_have_keys", f"bronze.{t}", n, n == 0) for t, n in sorted(without_key.items())]
        quality = spark.createDataFrame(verdicts, found.schema)
        if hold_back and enforce_quality:
            enforce(quality)
        staged.publish()
        if enforce_quality:
            enforce(quality)
        warehouse.drop_old_runs(keep_versions)
    return RunResult(report, quality)
