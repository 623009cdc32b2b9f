"""The tables of one deployment and how loads are added to them.

Every table is external Parquet with a partition per load. A load is written
to a folder of its own, so a batch run and a stream can write to one table at
the same time, and repeating a load replaces its rows instead of doubling them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from obslake.plans.store import Store
from obslake.schema import (
    ANSWER_LOG_SCHEMA,
    BATCH,
    EVENT_DRIVEN,
    FOLDER_SCHEMA,
    LEDGER_SCHEMA,
    OBSERVATION_SCHEMA,
    QUARANTINE_SCHEMA,
)

_TABLES = {
    "observation": OBSERVATION_SCHEMA,
    "quarantine": QUARANTINE_SCHEMA,
    "ingest_ledger": LEDGER_SCHEMA,
    "incoming_folders": FOLDER_SCHEMA,
    "answer_log": ANSWER_LOG_SCHEMA,
}

_KEYS = ["load_type", "load_dt"]


@dataclass(frozen=True)
class Lake:
    """A database and the folder its tables live in."""

    root: str
    database: str = "weather"

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def path(self, name: str) -> str:
        folder = "refined" if name == "observation" else name
        return f"{self.root.rstrip('/')}/{folder}"


class Load(NamedTuple):
    """What names a load."""

    load_type: str
    load_dt: str

    @property
    def batch_id(self) -> str:
        return f"{self.load_type}-{self.load_dt}"

    @classmethod
    def of(cls, batch_id: str) -> Load:
        load_type = EVENT_DRIVEN if batch_id.startswith(EVENT_DRIVEN) else BATCH
        return cls(load_type, batch_id[len(load_type) + 1 :])

    @classmethod
    def of_folder(cls, load_type: str, load_dt: str) -> Load:
        return cls(load_type.split("=", 1)[1], load_dt.split("=", 1)[1].replace("%3A", ":"))

    @property
    def folder(self) -> str:
        if not re.fullmatch(r"[\w.:+-]+", self.load_dt):
            raise ValueError(f"not usable as a load time: {self.load_dt!r}")
        return f"load_type={self.load_type}/load_dt={self.load_dt.replace(':', '%3A')}"


def ensure_database(spark: SparkSession, lake: Lake) -> None:
    """Create the database and its tables where they are missing.

    If an earlier session, or a catalog since dropped, left loads in the
    tables' folders, they are found again.
    """
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS {lake.database} LOCATION '{lake.path('database')}'"
    )
    for name, schema in _TABLES.items():
        table = lake.table(name)
        if spark.catalog.tableExists(table):
            continue
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING parquet "
            f"PARTITIONED BY ({', '.join(_KEYS)}) LOCATION '{lake.path(name)}'"
        )
        if _exists(spark, lake.path(name)):
            spark.catalog.recoverPartitions(table)
        if name == "observation":
            add_columns(spark, lake, added_columns(spark, lake))
            for load in loads_of(spark, lake, "merged"):
                if copy := merged_copy(spark, lake, load):
                    point_to(spark, lake, load, copy)


def drop_refined(spark: SparkSession, lake: Lake, database: bool = False) -> None:
    """Drop the observation table, or with ``database`` all there is in the catalog.

    The Parquet files stay; removing them is left to whoever owns the folder.
    """
    spark.sql(f"DROP TABLE IF EXISTS {lake.table('observation')}")
    if database:
        spark.sql(f"DROP DATABASE IF EXISTS {lake.database} CASCADE")


def append_refined(
    spark: SparkSession,
    lake: Lake,
    rows: DataFrame,
    load_type: str,
    load_dt: str,
    *,
    register: bool = True,
) -> None:
    """Add one load to the observation table, next to all earlier ones.

    ``rows`` holds the canonical columns and ``filename``. With ``register=False`` the rows are
    written, but the catalog does not show them until ``register_load`` is called.
    """
    load = Load(load_type, load_dt)
    write_load(spark, lake, "observation", rows, load, register=register)


def write_load(
    spark: SparkSession,
    lake: Lake,
    name: str,
    rows: DataFrame,
    load: Load,
    mode: str = "overwrite",
    register: bool = True,
) -> None:
    """Write a load's rows to a table and make them known to the catalog.

    The partition is named, not found from the rows, so tasks write as they
    scan, without the sort that partitions found at run time would need.
    """
    columns = [
        (F.col(f"`{field.name}`") if field.name in rows.columns else F.lit(None))
        .cast(field.dataType)
        .alias(field.name)
        for field in _schema(spark, lake, name)
        if field.name not in _KEYS
    ]
    folder = f"{lake.path(name)}/{load.folder}"
    known = mode == "append" and _exists(spark, folder)
    rows.select(*columns).write.mode(mode).parquet(folder)
    if name == "observation" and merged_copy(spark, lake, load):
        point_to(spark, lake, load, folder)
        Store(spark, lake.path("merged")).remove(load.folder)
    if known:
        spark.catalog.refreshTable(lake.table(name))
    elif register:
        register_load(spark, lake, name, load)


def register_load(spark: SparkSession, lake: Lake, name: str, load: Load) -> None:
    spark.sql(
        f"ALTER TABLE {lake.table(name)} ADD IF NOT EXISTS "
        f"PARTITION (load_type = '{load.load_type}', load_dt = '{load.load_dt}')"
    )
    spark.catalog.refreshTable(lake.table(name))


def remove_load(spark: SparkSession, lake: Lake, name: str, load: Load) -> None:
    """Take a load out of a table, with its files."""
    spark.sql(
        f"ALTER TABLE {lake.table(name)} DROP IF EXISTS "
        f"PARTITION (load_type = '{load.load_type}', load_dt = '{load.load_dt}')"
    )
    Store(spark, lake.path(name)).remove(load.folder)
    spark.catalog.refreshTable(lake.table(name))


def _schema(spark: SparkSession, lake: Lake, name: str) -> StructType:
    fields = list(StructType.fromDDL(_TABLES[name]))
    if name == "observation":
        fields += [StructField(more, StringType()) for more in added_columns(spark, lake)]
    return StructType(fields)


def added_columns(spark: SparkSession, lake: Lake) -> list[str]:
    """Columns that feeds have added to the refined table, the first ones first."""
    added = Store(spark, lake.path("columns")).listed()
    return sorted((name for name in added if name[0] not in "._"), key=lambda n: (added[n], n))


def add_columns(spark: SparkSession, lake: Lake, names: list[str]) -> None:
    """Give the refined table further text columns; loads that do not have them read as null."""
    store, table = Store(spark, lake.path("columns")), lake.table("observation")
    for name in dict.fromkeys(names):
        store.write_new(name, "")
        if name not in spark.table(table).columns:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS (`{name}` string)")


def remove_files(spark: SparkSession, lake: Lake, name: str, load: Load) -> None:
    """Delete a load's own folder, to which its partition no longer points."""
    Store(spark, lake.path(name)).remove(load.folder)


def point_to(spark: SparkSession, lake: Lake, load: Load, folder: str) -> None:
    """Have the refined table read a load from this folder, from now on."""
    key = f"PARTITION (load_type = '{load.load_type}', load_dt = '{load.load_dt}')"
    table = lake.table("observation")
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {key} LOCATION '{folder}'")
    spark.sql(f"ALTER TABLE {table} {key} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)


def merged_copy(spark: SparkSession, lake: Lake, load: Load) -> str | None:
    """Where the merged files of a load are; only a complete copy counts, of two of them either."""
    store = Store(spark, f"{lake.path('merged')}/{load.folder}")
    copies = [copy for copy in sorted(store.listed()) if "_SUCCESS" in store.listed(copy)]
    return f"{store.folder}/{copies[0]}" if copies else None


def loads_of(spark: SparkSession, lake: Lake, name: str) -> list[Load]:
    """The loads that a table has folders for."""
    store = Store(spark, lake.path(name))
    found = []
    for kind in sorted(store.listed()):
        if kind.startswith("load_type="):
            names = sorted(store.listed(kind))
            found += [Load.of_folder(kind, n) for n in names if n.startswith("load_dt=")]
    return found


def read_table(
    spark: SparkSession, lake: Lake, name: str, load: Load | None = None
) -> DataFrame:
    """A table's rows, or those of one load, as they are in its folder now.

    Other than the catalog, the folder shows at once what other applications
    have added. Of one load, only its own folder is listed.
    """
    root = lake.path(name)
    folder = f"{root}/{load.folder}" if load else root
    if load and name == "observation" and (copy := merged_copy(spark, lake, load)):
        rows = spark.read.schema(_schema(spark, lake, name)).parquet(copy)
        return rows.withColumns({k: F.lit(v) for k, v in zip(_KEYS, load)})
    if not _exists(spark, folder):
        return spark.table(lake.table(name)).where("false")
    return spark.read.schema(_schema(spark, lake, name)).option("basePath", root).parquet(folder)


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
