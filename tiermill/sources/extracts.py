"""CSV extracts: positional columns, a fixed set of missing-value texts, and file order."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.operators.conform import conform
from tiermill.plans.schemas import BRONZE, MEASURE, with_measures

log = logging.getLogger(__name__)

# Cells that mean "missing", compared as a whole and without trimming.
MISSING_TEXTS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Columns that put rows back into file order; see ``read_source``.
INGEST_ORDER = ("__file", "__block", "__line")

# Takes the first cell beyond the last column.
_SURPLUS = "__surplus"


@dataclass(frozen=True)
class Source:
    """An extract: where it lies under the data folder, its bronze table, and its key if it has one."""

    path: str
    table: str
    key: str | None = None

    @property
    def columns(self) -> Mapping[str, str]:
        return BRONZE[self.table]


SOURCES = {
    "cust_info": Source("source_crm/cust_info.csv", "crm_cust_info"),
    "prd_info": Source("source_crm/prd_info.csv", "crm_prd_info"),
    "sales_in": Source("source_crm/sales_details.csv", "crm_sales_details"),
    "cust_az1": Source("source_erp/CUST_AZ12.csv", "erp_cust_az12", key="cid"),
    "loc_a1": Source("source_erp/LOC_A101.csv", "erp_loc_a101", key="cid"),
    "px_cat": Source("source_erp/PX_CAT_G1V2.csv", "erp_px_cat_g1v2", key="id"),
}


def read_source(
    spark: SparkSession,
    path: str,
    columns: Mapping[str, str],
    missing: Sequence[str] = MISSING_TEXTS,
    on_missing: str = "empty",
    strict: bool = True,
    multiline: bool = False,
    with_order: bool = False,
) -> DataFrame:
    """Read one CSV file, or a folder of CSV parts, whose name ends in ``.csv``.

    Columns bind by position; the header line is skipped whatever it says. Cells equal to one of ``missing``
    become NULL before the conversion to the column types. Short lines are filled up with NULL; a line with more
    cells than columns, or a cell that does not convert, fails the job unless ``strict`` is off. A wrong
    extension or an absent path gives an empty table and a warning, or raises with ``on_missing="error"``.

    ``with_order`` adds ``INGEST_ORDER``: file (by the number of the part), start of the block within it, and a number that grows within
    the block. Together they sort rows as they stand in the files. ``multiline`` allows line breaks inside
    quotes, at the price of one task per file.
    """
    if on_missing not in ("empty", "error"):
        raise ValueError(f"on_missing must be empty or error, not {on_missing!r}")
    log.info("reading %s", path)
    raw = _scan(spark, path, [*columns, _SURPLUS], multiline)
    if raw is None:
        if on_missing == "error":
            raise FileNotFoundError(path)
        log.warning("no CSV data at %s, using an empty table", path)
        order = ", __file string, __block bigint, __line bigint" if with_order else ""
        return spark.createDataFrame([], ", ".join(f"`{n}` {t}" for n, t in columns.items()) + order)
    if strict:
        too_long = F.raise_error(F.lit(f"line with more than {len(columns)} cells in {path}")).cast("boolean")
        raw = raw.filter(F.when(F.col(_SURPLUS).isNotNull(), too_long).otherwise(True))
    cells = {n: F.when(~F.col(n).isin(list(missing)), F.col(n)) for n in columns}
    kept = dict(columns)
    if with_order:
        raw = raw.select(
            "*",
            _file_rank().alias("__file"),
            F.col("_metadata.file_block_start").alias("__block"),
            F.monotonically_increasing_id().alias("__line"),
        )
        kept |= {"__file": "string", "__block": "bigint", "__line": "bigint"}
    return conform(raw.withColumns(cells), kept, strict)


def _file_rank() -> Column:
    """Text that sorts files by the number of the part, as a number, and then by their path."""
    number = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1)
    return F.concat(F.lpad(number, 20, "0"), F.lit(" "), F.col("_metadata.file_path"))


def _scan(
    spark: SparkSession, path: str, columns: Sequence[str], multiline: bool
) -> DataFrame | None:
    if not path.rstrip("/").endswith(".csv"):
        return None
    reader = (
        spark.read.schema(", ".join(f"`{name}` string" for name in columns))
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", multiline)
    )
    try:
        return reader.csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_all(
    spark: SparkSession,
    folder: str,
    sources: Mapping[str, Source] = SOURCES,
    measure: str = MEASURE,
    **options,
) -> dict[str, DataFrame]:
    """Read every source under ``folder``; keyed sources carry their ingest order."""
    return {
        name: read_source(
            spark,
            f"{folder.rstrip('/')}/{s.path}",
            with_measures(s.columns, measure),
            with_order=s.key is not None,
            **options,
        )
        for name, s in sources.items()
    }
