from __future__ import annotations

import logging
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tiermill.operators import keep_first
from tiermill.plans.refresh import bronze_rows
from tiermill.plans.together import together
from tiermill.sources.extracts import INGEST_ORDER, MISSING_TEXTS, SOURCES, Source, read_all, read_source
from tiermill.sources.scratch import materialize, release, scratch_path, scratch_root, scratch_scope
from tiermill.sources.warehouse import RunReport, Warehouse

CATEGORY = {"id": "string", "cat": "string", "subcat": "string", "maintenance": "string"}


def write(path, text, newline="\n"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.replace("\n", newline).encode())
    return str(path)


def test_carriage_returns_and_missing_last_newline(spark, tmp_path):
    path = write(tmp_path / "c.csv", "ID,CAT,SUBCAT,MAINTENANCE\nAC_BR,Accessories,Bike Racks,Yes\nBI_RB,Bikes,Road,No", "\r\n")
    got = [tuple(r) for r in read_source(spark, path, CATEGORY).collect()]
    assert got == [("AC_BR", "Accessories", "Bike Racks", "Yes"), ("BI_RB", "Bikes", "Road", "No")]


def test_reading_is_logged(spark, tmp_path, caplog):
    path = write(tmp_path / "c.csv", "a\n1\n")
    with caplog.at_level(logging.INFO):
        read_source(spark, path, {"a": "bigint"})
    assert f"reading {path}" in caplog.text and "no CSV data" not in caplog.text


def test_columns_bind_by_position(spark, tmp_path):
    path = write(tmp_path / "c.csv", "b,a\n1,x\n")
    df = read_source(spark, path, {"a": "bigint", "b": "string"})
    assert df.columns == ["a", "b"] and tuple(df.first()) == (1, "x")


def test_every_missing_text_becomes_null(spark, tmp_path):
    cells = [*MISSING_TEXTS, '""', " NA", "na", "NaT", "0"]
    path = write(tmp_path / "m.csv", "n,v\n" + "".join(f"{i},{c}\n" for i, c in enumerate(cells)))
    got = [r["v"] for r in read_source(spark, path, {"n": "int", "v": "string"}).orderBy("n").collect()]
    assert got == [None] * (len(MISSING_TEXTS) + 1) + [" NA", "na", "NaT", "0"]


def test_numbers_with_trailing_point_zero(spark, tmp_path):
    path = write(tmp_path / "n.csv", "a,b\n20101229.0,NaN\n,2.50\n")
    got = [tuple(r) for r in read_source(spark, path, {"a": "bigint", "b": "double"}).collect()]
    assert got == [(20101229, None), (None, 2.5)]


def test_bad_number_fails_unless_lenient(spark, tmp_path):
    path = write(tmp_path / "n.csv", "a\nx\n")
    with pytest.raises(Exception, match="not a whole number: x"):
        read_source(spark, path, {"a": "bigint"}).collect()
    assert read_source(spark, path, {"a": "bigint"}, strict=False).first()[0] is None


def test_line_lengths(spark, tmp_path):
    columns = {"a": "string", "b": "string"}
    short = write(tmp_path / "s.csv", "a,b\n1\n2,x\n3,y,\n")
    assert [tuple(r) for r in read_source(spark, short, columns).collect()] == [("1", None), ("2", "x"), ("3", "y")]
    long = write(tmp_path / "l.csv", "a,b\n1,x,surplus\n")
    with pytest.raises(Exception, match="line with more than 2 cells"):
        read_source(spark, long, columns).select("a").collect()
    assert tuple(read_source(spark, long, columns, strict=False).first()) == ("1", "x")


def test_quotes_and_line_breaks(spark, tmp_path):
    path = write(tmp_path / "q.csv", 'a,b\n"x, ""y""",1\n"two\nlines",2\n')
    got = [tuple(r) for r in read_source(spark, path, {"a": "string", "b": "int"}, multiline=True).collect()]
    assert got == [('x, "y"', 1), ("two\nlines", 2)]


@pytest.mark.parametrize("name", ["c.c", "missing.csv"])
def test_unusable_path_gives_an_empty_table(spark, tmp_path, caplog, name):
    write(tmp_path / "c.c", "a\n1\n")
    with caplog.at_level(logging.WARNING):
        df = read_source(spark, str(tmp_path / name), {"a": "bigint"}, with_order=True)
    assert df.dtypes[0] == ("a", "bigint") and df.count() == 0
    assert df.columns == ["a", *INGEST_ORDER]
    assert "no CSV data" in caplog.text
    with pytest.raises(FileNotFoundError):
        read_source(spark, str(tmp_path / name), {"a": "bigint"}, on_missing="error")


def test_first_row_wins_across_files_and_blocks(spark, tmp_path):
    folder = tmp_path / "big.csv"
    for part in range(2):
        lines = "".join(f"{(i * 7919) % 1000},{part}-{i}\n" for i in range(5000))
        write(folder / f"part-{part}.csv", "k,v\n" + lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = read_source(spark, str(folder), {"k": "bigint", "v": "string"}, with_order=True)
        assert df.rdd.getNumPartitions() > 10
        firsts = keep_first(df, "k", INGEST_ORDER, tiebreak=()).select("k", "v").collect()
        ordered = [r["v"] for r in df.orderBy(*INGEST_ORDER).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    expected = {}
    for i in range(5000):
        expected.setdefault((i * 7919) % 1000, f"0-{i}")
    assert dict(map(tuple, firsts)) == expected
    assert ordered == [f"{part}-{i}" for part in range(2) for i in range(5000)]


def test_keyed_source_drops_null_keys(spark, tmp_path):
    path = write(tmp_path / "k.csv", "cid,cntry\nA,DE\nNULL,FR\nA,US\nB,\n")
    source = Source(path, "erp_loc_a101", key="cid")
    landed = bronze_rows(source, read_source(spark, path, source.columns, with_order=True))
    assert sorted(map(tuple, landed.collect())) == [("A", "DE"), ("B", None)]
    with pytest.raises(Exception, match="NULL in key column cid"):
        bronze_rows(source, read_source(spark, path, source.columns, with_order=True), "fail").collect()


def test_read_all_reads_the_named_sources(spark, tmp_path):
    for source in SOURCES.values():
        write(tmp_path / source.path, ",".join(source.columns) + "\n" + ",".join("1" for _ in source.columns) + "\n")
    frames = read_all(spark, str(tmp_path))
    assert list(frames) == ["cust_info", "prd_info", "sales_in", "cust_az1", "loc_a1", "px_cat"]
    assert all(df.count() == 1 for df in frames.values())
    assert "__line" in frames["px_cat"].columns and "__line" not in frames["sales_in"].columns


def test_scratch_needs_a_shared_folder_on_a_cluster():
    def session(master, folder):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: folder), sparkContext=context)

    assert scratch_root(session("yarn", "hdfs://shared/ck/")) == "hdfs://shared/ck"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(session("yarn", None))


def test_materialize_counts_and_release_deletes(spark):
    stored = materialize(spark.range(10).filter("id > 3"), "t")
    assert stored.rows == 6 and stored.df.count() == 6
    assert stored.path.startswith(scratch_root(spark))
    assert materialize(spark.range(0), "t").rows == 0
    assert release(spark) and not release(spark)
    with pytest.raises(Exception, match="does not exist|PATH_NOT_FOUND"):
        stored.df.collect()


def test_scope_deletes_its_own_tables_only(spark):
    outside = materialize(spark.range(3), "outside")
    with pytest.raises(RuntimeError):
        with scratch_scope(spark):
            inside = together(spark, lambda n: materialize(spark.range(n), "inside"), [4, 5])
            assert [s.df.count() for s in inside] == [4, 5]
            assert scratch_path(spark, "x").rsplit("/", 1)[0] == inside[0].path.rsplit("/", 1)[0]
            raise RuntimeError
    assert outside.df.count() == 3
    assert outside.path.rsplit("/", 1)[0] == scratch_path(spark, "x").rsplit("/", 1)[0]
    with pytest.raises(Exception, match="does not exist|PATH_NOT_FOUND"):
        inside[0].df.collect()


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "store"), prefix=f"w{abs(hash(str(tmp_path))) % 10**8}_").init()


def test_full_refresh_replaces_and_reports(spark, warehouse):
    report = RunReport()
    assert not warehouse.exists("bronze", "t")
    warehouse.full_refresh(spark.range(3), "bronze", "t", report=report)
    warehouse.init()
    stored = warehouse.full_refresh(spark.range(5).withColumn("x", F.lit("a")), "bronze", "t", report=report)
    assert warehouse.exists("bronze", "t")
    assert stored.columns == ["id", "x"] and stored.count() == 5
    assert warehouse.preview("bronze", "t", 2).count() == 2
    assert [tuple(r) for r in report.to_df(spark).collect()] == [("bronze.t", 3), ("bronze.t", 5)]
    assert warehouse.drop_superseded("bronze", "t") == 0
    assert warehouse.drop_superseded("bronze", "t", keep=0) == 1
    assert warehouse.read("bronze", "t").count() == 5
    name = warehouse.table_name("bronze", "t")
    assert warehouse.query(f"SELECT max(id) AS m FROM {name}").first()["m"] == 4


def test_failed_or_empty_refresh_keeps_the_old_content(spark, warehouse):
    warehouse.full_refresh(spark.range(3), "gold", "t")
    with pytest.raises(ValueError, match="no rows"):
        warehouse.full_refresh(spark.range(0), "gold", "t", require_rows=True)
    with pytest.raises(Exception, match="boom"):
        warehouse.full_refresh(spark.range(3).filter(F.raise_error(F.lit("boom")).cast("boolean")), "gold", "t")
    assert warehouse.read("gold", "t").count() == 3
    assert warehouse.full_refresh(spark.range(0), "gold", "t").count() == 0
    # a table may be rebuilt from itself
    warehouse.full_refresh(spark.range(2), "gold", "t")
    assert warehouse.full_refresh(warehouse.read("gold", "t"), "gold", "t").count() == 2


def test_parts_count_as_numbers(spark, tmp_path):
    folder = tmp_path / "many.csv"
    folder.mkdir()
    for name, value in (("part-100000-x.csv", "late"), ("part-99999-x.csv", "early"), ("part-00002-x.csv", "first")):
        (folder / name).write_text(f"k,v\n1,{value}\n")
    df = read_source(spark, str(folder), {"k": "bigint", "v": "string"}, with_order=True)
    assert [r["v"] for r in df.orderBy(*INGEST_ORDER).collect()] == ["first", "early", "late"]
    assert keep_first(df.filter("v <> 'first'"), "k", INGEST_ORDER, tiebreak=()).first()["v"] == "early"
