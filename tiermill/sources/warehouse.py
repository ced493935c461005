"""Stored layers: one database per layer, one Parquet table per name, and a manifest that names the contents of a run.

Tables of a run are written to folders of their own. When all are complete, a manifest with every table's folder, columns and
rows is written, and the manifest table of the catalog is pointed at it: one catalog operation, and the only one that
changes what ``read``, ``run`` and ``query`` by placeholder return. Before it they return the earlier run, after it the new
one, also if the process dies at any step. A reader that keeps a ``run`` keeps its folders, whatever is published later.

The tables in the databases follow for plain SQL, one by one, after the manifest; ``init`` lets those catch up that a
run which was cut off left behind.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tiermill.sources.scratch import delete_folder

LAYERS = ("bronze", "silver", "gold")

# Stored tables are written once and read by every later layer: a codec that packs denser than Spark's default (snappy).
CODEC = "zstd"

# The table that names the contents of the runs, in the database of the last layer.
MANIFEST = "run_manifest"
_MANIFEST_COLUMNS = "age int, run string, layer string, name string, folder string, columns string, rows bigint"

# Table property with the folder that the table of the catalog shows.
_FOLDER = "tiermill.folder"


@dataclass
class RunReport:
    """Rows written per step, taken from the writes themselves."""

    steps: list[tuple[str, int]] = field(default_factory=list)

    def add(self, table: str, rows: int) -> None:
        self.steps.append((table, rows))

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.steps, "step string, rows bigint")


@dataclass(frozen=True)
class Content:
    """A table's content: its folder, its columns as JSON and its number of rows."""

    folder: str
    columns: str
    rows: int


Tables = dict[tuple[str, str], Content]


class Run:
    """The tables of one run. What it reads stays the same when other runs are published."""

    def __init__(self, spark: SparkSession, run: str, tables: Mapping[tuple[str, str], Content]) -> None:
        self.spark = spark
        self.run = run
        self.tables: Tables = dict(tables)

    def read(self, layer: str, table: str) -> DataFrame:
        content = self.tables[layer, table]
        return self.spark.read.schema(StructType.fromJson(json.loads(content.columns))).parquet(content.folder)

    def query(self, text: str) -> DataFrame:
        """Run a SQL statement in which ``{layer_table}``, such as ``{gold_fact_sales}``, stands for a table of this run."""
        named = {f"{layer}_{table}": (layer, table) for layer, table in self.tables}
        return self.spark.sql(text, **{name: self.read(*key) for name, key in named.items() if f"{{{name}}}" in text})


class Staged(Run):
    """A run that is being written: it reads its own tables, and those it has not written from the run before."""

    def __init__(self, warehouse: Warehouse) -> None:
        before = warehouse.run()
        super().__init__(warehouse.spark, uuid.uuid4().hex, before.tables if before else {})
        self._warehouse = warehouse
        self.written: Tables = {}
        self.inherited: Tables = {}  # what it read of the run before

    def read(self, layer: str, table: str) -> DataFrame:
        if (layer, table) not in self.written:
            self.inherited[layer, table] = self.tables[layer, table]
        return super().read(layer, table)

    def write(self, df: DataFrame, layer: str, table: str, require_rows: bool = False, report: RunReport | None = None) -> DataFrame:
        """Write a table of this run; nobody else sees it before ``publish``."""
        content = self._warehouse.write(df, layer, table, require_rows)
        self.written[layer, table] = self.tables[layer, table] = content
        if report is not None:
            report.add(f"{layer}.{table}", content.rows)
        return self.read(layer, table)

    def publish(self) -> Run:
        """Make this run the current one, at once with all its tables."""
        return self._warehouse.publish(self)


class Warehouse:
    """Tables of the three layers under ``root``; ``prefix`` is put before the database names.

    One process at a time may publish; its threads may write and publish side by side.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = "") -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix
        self._publishing = threading.RLock()

    def init(self) -> Warehouse:
        """Create the layer databases that do not exist yet, and let the catalog's tables catch up with the manifest."""
        for layer in LAYERS:
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS `{self.prefix}{layer}` LOCATION '{self.root}/{layer}'"
            )
        current = self.run()
        if current is not None:
            behind = {key: content for key, content in current.tables.items() if self._shown(*key) != content.folder}
            self._prepare(behind)
            self._follow(behind)
        return self

    def table_name(self, layer: str, table: str) -> str:
        return f"`{self.prefix}{layer}`.`{table}`"

    def run(self, age: int = 0) -> Run | None:
        """The published run (``age`` 0) or an earlier one that is still kept, oldest last; None if there is none."""
        runs = self._runs()
        return runs[age] if age < len(runs) else None

    def begin(self) -> Staged:
        """Begin a run of several tables."""
        return Staged(self)

    def exists(self, layer: str, table: str) -> bool:
        current = self.run()
        return current is not None and (layer, table) in current.tables

    def read(self, layer: str, table: str) -> DataFrame:
        current = self.run()
        if current is None or (layer, table) not in current.tables:
            raise KeyError(f"no {layer}.{table} has been published")
        return current.read(layer, table)

    def location(self, layer: str, table: str) -> str:
        """The folder with the table's content."""
        return self.run().tables[layer, table].folder

    def preview(self, layer: str, table: str, rows: int = 3) -> DataFrame:
        return self.read(layer, table).limit(rows)

    def query(self, text: str) -> DataFrame:
        """Run a SQL statement. ``{layer_table}`` stands for a table of the published run, all from the same one."""
        current = self.run()
        return current.query(text) if current is not None else self.spark.sql(text)

    def write(self, df: DataFrame, layer: str, table: str, require_rows: bool = False) -> Content:
        """Write ``df`` to a new folder, which nothing shows yet; an empty result raises with ``require_rows``."""
        folder = f"{self.root}/{layer}/{table}/{uuid.uuid4().hex}"
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.option("compression", CODEC).parquet(folder)
        rows = seen.get["rows"]
        if require_rows and rows == 0:
            raise ValueError(f"{layer}.{table} would have no rows")
        return Content(folder, df.schema.json(), rows)

    def full_refresh(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        require_rows: bool = False,
        report: RunReport | None = None,
    ) -> DataFrame:
        """Replace the content of one table by ``df``, publish that, and return the stored table.

        Only a complete write is published, so a failed or (with ``require_rows``) empty result leaves the previous
        content in place, and readers always find a table.
        """
        content = self.write(df, layer, table, require_rows)
        current = self._publish(uuid.uuid4().hex, {(layer, table): content}, {})
        if report is not None:
            report.add(f"{layer}.{table}", content.rows)
        return current.read(layer, table)

    def publish(self, staged: Staged) -> Run:
        """Write the manifest of a complete run and switch to it; tables it has not written stay those of the run before.

        Raises when a table that the run read but did not write has been replaced since it began.
        """
        return self._publish(staged.run, staged.written, staged.inherited)

    def _publish(self, run: str, written: Tables, inherited: Tables) -> Run:
        with self._publishing:
            runs = self._runs()
            current = runs[0].tables if runs else {}
            stale = [key for key, content in inherited.items() if current.get(key) != content]
            if stale:
                raise RuntimeError(f"{sorted(stale)} were replaced while the run was being written")
            new = Run(self.spark, run, current | written)
            self._prepare(written)
            self._write_manifest([new, *runs])
            self._follow(written)
            return new

    def drop_old_runs(self, keep: int = 1) -> int:
        """Forget all but the current and the last ``keep`` runs before it and delete the folders that only they show."""
        with self._publishing:
            runs = self._runs()
            return self._forget(runs, runs[: 1 + keep])

    def drop_superseded(self, layer: str, table: str, keep: int = 1) -> int:
        """Delete the folders of earlier contents of one table, but for the last ``keep`` of them; readers of those can finish.

        Only folders that were this table's content are deleted, never one that another run is writing.
        """
        with self._publishing:
            runs = self._runs()
            folders = list(dict.fromkeys(run.tables[layer, table].folder for run in runs if (layer, table) in run.tables))
            old = set(folders[1 + keep :])
            left = [
                Run(self.spark, run.run, {key: content for key, content in run.tables.items() if content.folder not in old}) for run in runs
            ]
            return self._forget(runs, left) if old else 0

    def _forget(self, runs: list[Run], left: list[Run]) -> int:
        """Keep the runs ``left``: first in the manifest, then on disk, so that no manifest names a folder that is gone."""
        folders = [{content.folder for run in kept for content in run.tables.values()} for kept in (runs, left)]
        old = folders[0] - folders[1]
        if old:
            self._write_manifest(left)
        return sum(delete_folder(self.spark, folder) for folder in old)

    def _manifest_name(self) -> str:
        return self.table_name(LAYERS[-1], MANIFEST)

    def _runs(self) -> list[Run]:
        """The runs of the manifest, the current one first."""
        name = self._manifest_name()
        if not self.spark.catalog.tableExists(name):
            return []
        self.spark.catalog.refreshTable(name)
        runs: dict[int, tuple[str, Tables]] = {}
        for row in self.spark.table(name).collect():  # a row per table and kept run
            runs.setdefault(row["age"], (row["run"], {}))[1][row["layer"], row["name"]] = Content(row["folder"], row["columns"], row["rows"])
        return [Run(self.spark, *runs[age]) for age in sorted(runs)]

    def _write_manifest(self, runs: list[Run]) -> None:
        """Write the manifest and point the catalog at it. This is the moment at which a run is published."""
        rows = [
            (age, run.run, *key, content.folder, content.columns, content.rows)
            for age, run in enumerate(runs)
            for key, content in sorted(run.tables.items())
        ]
        path = f"{self.root}/{MANIFEST}/{uuid.uuid4().hex}"
        manifest = self.spark.createDataFrame(rows, _MANIFEST_COLUMNS)
        manifest.coalesce(1).write.parquet(path)  # a row per table and kept run
        name = self._manifest_name()
        if self.spark.catalog.tableExists(name):
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            self.spark.catalog.refreshTable(name)
        else:
            self.spark.catalog.createTable(name, path=path, source="parquet", schema=manifest.schema)

    def _shown(self, layer: str, table: str) -> str | None:
        """The folder that the table of the catalog shows."""
        name = self.table_name(layer, table)
        if not self.spark.catalog.tableExists(name):
            return None
        row = self.spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key") == _FOLDER).first()
        return row["value"] if row else None

    def _keeps_columns(self, layer: str, table: str, content: Content) -> bool:
        name = self.table_name(layer, table)
        wanted = [(f.name, f.dataType.simpleString()) for f in StructType.fromJson(json.loads(content.columns))]
        return self.spark.catalog.tableExists(name) and self.spark.table(name).dtypes == wanted

    def _prepare(self, tables: Tables) -> None:
        """Make the catalog's tables that ``_follow`` cannot just move: those that are new or have other columns."""
        for (layer, table), content in tables.items():
            if not self._keeps_columns(layer, table, content):
                following = self.table_name(layer, f"{table}__next")
                self.spark.sql(f"DROP TABLE IF EXISTS {following}")  # of a run that was cut off
                schema = StructType.fromJson(json.loads(content.columns))
                self.spark.catalog.createTable(following, path=content.folder, source="parquet", schema=schema)

    def _follow(self, tables: Tables) -> None:
        """Let the catalog's tables show what the manifest names."""
        for (layer, table), content in tables.items():
            name, following = self.table_name(layer, table), self.table_name(layer, f"{table}__next")
            if self._keeps_columns(layer, table, content):
                self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{content.folder}'")
                self.spark.catalog.refreshTable(name)
            else:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
                self.spark.sql(f"ALTER TABLE {following} RENAME TO {name}")
            self.spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_FOLDER}' = '{content.folder}')")
