"""What a refresh leaves on disk is packed, and reads back as it was."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from tiermill.plans.schemas import BRONZE
from tiermill.sources.extracts import read_source
from tiermill.sources.scratch import materialize
from tiermill.sources.warehouse import CODEC, Warehouse
from validation.queries import _write_csv


def test_stored_tables_and_kept_copies_are_packed(spark, tmp_path):
    df = spark.range(5000).select("id", F.concat(F.lit("text "), "id").alias("text"))
    store = Warehouse(spark, str(tmp_path / "store"), prefix="packed_")
    content = store.write(df, "gold", "things")
    kept = materialize(df, "things", CODEC)
    for folder, read in ((content.folder, spark.read.parquet(content.folder)), (kept.path, kept.df)):
        names = [f.name for f in Path(folder.removeprefix("file:")).glob("part-*")]
        assert names and all(name.endswith(".zstd.parquet") for name in names)
        assert read.exceptAll(df).count() == 0 and read.count() == 5000


def test_packed_extracts_keep_the_order_of_their_lines(spark, tmp_path):
    path = str(tmp_path / "loc.csv")
    lines = spark.range(0, 3000, 1, 3).select(F.concat(F.lit("AW-"), "id").alias("cid"), F.col("id").cast("string").alias("cntry"))
    _write_csv(lines, path)
    parts = [f.name for f in Path(path).glob("part-*")]
    assert len(parts) == 3 and all(name.endswith(".csv.gz") for name in parts)
    read = read_source(spark, path, BRONZE["erp_loc_a101"], on_missing="error", with_order=True)
    found = [int(r["cntry"]) for r in read.orderBy("__file", "__block", "__line").collect()]
    assert found == list(range(3000))
