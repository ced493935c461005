"""The full refresh as one Spark application: ``python -m tiermill EXTRACTS STORE``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tiermill.operators.quality import enforce
from tiermill.plans.refresh import run_refresh
from tiermill.plans.schemas import MEASURE
from tiermill.sources.warehouse import Warehouse


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tiermill", description=__doc__)
    parser.add_argument("extracts", help="folder with the CSV extracts")
    parser.add_argument("store", help="folder for the stored layers")
    parser.add_argument("--prefix", default="", help="put before the database names")
    parser.add_argument("--as-of", help="date that counts as today, YYYY-MM-DD")
    parser.add_argument("--measure", default=MEASURE, help="type of amounts, such as decimal(18,4)")
    parser.add_argument("--on-missing", choices=("error", "empty"), default="error")
    parser.add_argument("--on-null-key", choices=("drop", "fail"), default="drop")
    parser.add_argument("--on-invalid", choices=("null", "default", "error"), default="null", help="dates that are none")
    parser.add_argument("--only-if-prefix", help="cut the prefix of ERP customer ids only if it is this text")
    parser.add_argument("--run-ts", help="load time, YYYY-MM-DD HH:MM:SS")
    parser.add_argument("--enforce", action="store_true", help="fail when a quality check fails")
    chosen = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("tiermill refresh").getOrCreate()
    result = run_refresh(
        spark,
        chosen.extracts,
        Warehouse(spark, chosen.store, chosen.prefix),
        as_of=chosen.as_of,
        on_missing=chosen.on_missing,
        measure=chosen.measure,
        on_null_key=chosen.on_null_key,
        on_invalid=chosen.on_invalid,
        only_if_prefix=chosen.only_if_prefix,
        run_ts=chosen.run_ts,
    )
    result.report.to_df(spark).show(truncate=False)
    result.quality.show(truncate=False)
    if chosen.enforce:
        enforce(result.quality)


if __name__ == "__main__":
    main()
