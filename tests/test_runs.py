"""A run is published at once, or not at all."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.test_refresh import write_extracts
from tiermill.plans.refresh import run_refresh
from tiermill.sources.warehouse import MANIFEST, Staged, Warehouse
from validation.bronze_views import BronzeViews
from validation.oracles import AS_OF, RUN_TS

SMALL = "/root/testdata/sf0.001"
STATEMENT = """
    SELECT count(*) AS lines, count(c.customer_key) AS known, max(c.create_date) AS latest
    FROM {gold_fact_sales} f LEFT JOIN {gold_dim_customers} c ON c.customer_key = f.customer_key"""


@pytest.fixture
def store(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "store"), prefix=f"runs{abs(hash(str(tmp_path))) % 10**8}_").init()


def two(staged, size):
    """A dimension and a fact that fit together only if they are of one run."""
    spark = staged.spark
    staged.write(spark.range(size).select(F.col("id").alias("key"), F.lit(size).alias("of")), "gold", "dim")
    staged.write(spark.range(size * 3).select((F.col("id") % size).alias("key"), F.lit(size).alias("of")), "gold", "fact")
    return staged


def seen(store):
    """(Size of the dimension, size of the fact, sizes that both were made for) as one reader sees them."""
    run = store.run()
    dim, fact = run.read("gold", "dim"), run.read("gold", "fact")
    return dim.count(), fact.count(), {r["of"] for r in dim.select("of").union(fact.select("of")).distinct().collect()}


def test_readers_see_one_run_only(store):
    two(store.begin(), 4).publish()
    staged, found = store.begin(), []
    write = staged.write

    def watched(*args, **kwargs):
        found.append(seen(store))
        written = write(*args, **kwargs)
        found.append(seen(store))
        return written

    staged.write = watched
    two(staged, 7)
    assert found == [(4, 12, {4})] * 4
    assert staged.read("gold", "dim").count() == 7
    early = store.run()
    staged.publish()
    assert seen(store) == (7, 21, {7})
    assert early.read("gold", "dim").count() == 4  # a reader that began before goes on with its run
    assert store.run(1).read("gold", "fact").count() == 12 and store.run(2) is None
    joined = store.query("SELECT count(*) AS n FROM {gold_fact} f JOIN {gold_dim} d ON d.key = f.key AND d.of = f.of")
    assert joined.first()["n"] == 21


STEPS = ("_prepare", "_write_manifest", "_follow", "_keeps_columns")


@pytest.mark.parametrize("wider", [False, True])
@pytest.mark.parametrize("step", STEPS)
def test_a_crash_at_any_step_leaves_one_run(spark, store, monkeypatch, step, wider):
    two(store.begin(), 4).publish()
    staged = two(store.begin(), 7)
    if wider:
        staged.write(staged.read("gold", "dim").withColumn("more", F.lit("x")), "gold", "dim")

    def die(*args, **kwargs):
        raise RuntimeError("out of memory")

    with monkeypatch.context() as broken:
        broken.setattr(Warehouse, step, die)
        with pytest.raises(RuntimeError, match="out of memory"):
            staged.publish()
    published = step == "_follow"  # the manifest was written before
    assert seen(store) == ((7, 21, {7}) if published else (4, 12, {4}))
    # a new process on the same store lets plain SQL catch up
    again = Warehouse(spark, store.root, store.prefix).init()
    for table in ("dim", "fact"):
        by_name = spark.table(again.table_name("gold", table))
        assert by_name.count() == again.read("gold", table).count() and by_name.dtypes == again.read("gold", table).dtypes
    two(again.begin(), 9).publish()
    assert seen(again) == (9, 27, {9})


def test_a_run_that_is_cut_off_while_writing_leaves_nothing(store):
    two(store.begin(), 4).publish()
    staged = store.begin()
    staged.write(store.spark.range(3).select(F.col("id").alias("key"), F.lit(3).alias("of")), "gold", "dim")
    with pytest.raises(Exception, match="boom"):
        staged.write(store.spark.range(3).filter(F.raise_error(F.lit("boom")).cast("boolean")), "gold", "fact")
    assert seen(store) == (4, 12, {4})


def test_a_run_from_replaced_inputs_is_refused(store):
    two(store.begin(), 4).publish()
    staged = store.begin()
    staged.write(staged.read("gold", "dim").groupBy("of").count(), "gold", "sizes")
    store.full_refresh(store.spark.range(2).select(F.col("id").alias("key"), F.lit(2).alias("of")), "gold", "dim")
    with pytest.raises(RuntimeError, match="dim.* replaced"):
        staged.publish()
    assert not store.exists("gold", "sizes")


def test_old_runs_go_with_their_folders(store):
    for size in (2, 3, 4, 5):
        two(store.begin(), size).publish()
    gone = store.run(2).tables["gold", "dim"].folder
    store.full_refresh(store.read("gold", "dim"), "silver", "only")
    kept = store.run(1)
    assert store.drop_old_runs(keep=1) == 6
    assert store.run(2) is None and kept.read("gold", "fact").count() == 15 and seen(store) == (5, 15, {5})
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        store.spark.read.parquet(gone)
    assert store.drop_old_runs(keep=1) == 0


def test_the_manifest_can_be_queried(store):
    two(store.begin(), 4).publish()
    rows = store.spark.table(store.table_name("gold", MANIFEST)).filter("age = 0").orderBy("name").collect()
    assert [(r["layer"], r["name"], r["rows"]) for r in rows] == [("gold", "dim", 4), ("gold", "fact", 12)]


def test_nothing_published(store):
    assert store.run() is None and not store.exists("gold", "dim")
    with pytest.raises(KeyError, match="gold.dim"):
        store.read("gold", "dim")
    assert store.query("SELECT 1 AS one").first()["one"] == 1


def test_refresh_is_published_at_once_and_can_be_held_back(spark, tmp_path, store, monkeypatch):
    folder = str(tmp_path / "extracts")
    write_extracts(BronzeViews(spark, SMALL), folder)
    run_refresh(spark, folder, store, as_of=AS_OF, run_ts=RUN_TS)
    first = store.query(STATEMENT).first()
    write, found = Staged.write, set()

    def watched(self, df, layer, table, **kwargs):
        written = write(self, df, layer, table, **kwargs)
        found.add((store.run().run, store.query(STATEMENT).first()))
        return written

    with monkeypatch.context() as patched:
        patched.setattr(Staged, "write", watched)
        before = store.run().run
        with pytest.raises(ValueError, match="sales_orphans"):
            run_refresh(spark, folder, store, as_of=AS_OF, run_ts=RUN_TS, enforce_quality=True, hold_back=True)
    assert found == {(before, first)} and store.run().run == before
    run_refresh(spark, folder, store, as_of=AS_OF, run_ts=RUN_TS)
    assert store.run().run != before and store.query(STATEMENT).first() == first
