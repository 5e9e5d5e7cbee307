"""Tables stored by day, and how days change places.

A ``FolderTable`` is a folder with a directory per day. New days are written beside it; once all are there, a list of
them is, and from then on the swap is carried out whatever happens: by this load, or by the next one after a stop.
Readers of the folder may miss a day while its directories change places.

A ``CatalogTable`` has no such moment. Each load writes into a folder of its own that never changes afterwards, and a
day is published by pointing its partition of the catalog table there: one change of the catalog per day, so a reader
sees all old rows of a day or all new ones. What the catalog no longer points to stays for readers that began before,
and is removed after a time of grace; so is what a load left that stopped before publishing.

With ``buckets`` a catalog table lies in files by hash of its dist key, in its order. Tables in equally many buckets are joined
and grouped by that key where they lie, without a shuffle. All rows of a key are in one bucket, so this is for keys none of
which holds a large share of a day; without buckets a hot key is split over files.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.operators import evolve, zones
from logweir.operators.evolve import DAY, partition_columns, read_stored, reconcile, remember
from logweir.operators.sinks import finish_swaps, laid_out, write_table
from logweir.operators.zones import Zone, day_folder, day_of, read_zone, write_zones
from logweir.plans.spec import SchemaSpec, TableSpec, qualified_name
from logweir.sources import files

LOADS = "_loads"  # Spark passes over names that start with an underscore
GRACE_SECONDS = 2 * 24 * 3600
BUCKET_BYTES = 4 * 1024 * 1024  # of compressed input for each bucket, which one task sorts


def buckets_for(spark: SparkSession, path: str, least: int = 8) -> int:
    """As many buckets as keep what is in one of them the same, however large the input at ``path`` is."""
    return max(least, -(-files.size(spark, path) // BUCKET_BYTES))


@dataclass(frozen=True)
class FolderTable:
    spark: SparkSession
    name: str
    folder: str
    table: TableSpec

    def check(self) -> None:
        """An error if the stored table can't become the spec's by adding columns; swaps that were stopped are carried out."""
        reconcile(self.spark, self.name, self.folder, self.table, remembering=False)
        finish_swaps(self.spark, self.folder)

    def by_day(self) -> bool:
        return DAY in partition_columns(self.spark, self.folder)

    def locations(self) -> dict[date | None, str]:
        return {day_of(path): path for path in files.glob(self.spark, f"{self.folder}/{DAY}=*")}

    def rows(self) -> DataFrame:
        return read_stored(self.spark, self.folder, self.table)

    def replace(self, rows: DataFrame, days: list[date | None] | None = None) -> None:
        """Exactly the days of ``rows`` and those in ``days`` are replaced; the spec is remembered once they are."""
        write_table(rows, self.folder, self.table, days)
        remember(self.spark, self.folder, self.table)

    def drop(self, days: list[date | None]) -> None:
        for day in days:
            files.remove(self.spark, f"{self.folder}/{day_folder(day)}")

    def zones(self) -> dict[date | None, Zone | None]:
        """The zone of each stored day; None where none is kept, or a stream may have added to it."""
        column = zones.retention_column(self.table)
        if column is None or partition_columns(self.spark, self.folder) != [DAY]:
            return dict.fromkeys(self.locations())
        return {day: read_zone(self.spark, path, column) for day, path in self.locations().items()}


@dataclass(frozen=True)
class CatalogTable:
    spark: SparkSession
    name: str  # as in the catalog
    folder: str
    table: TableSpec
    buckets: int | None = None

    def check(self) -> None:
        """The catalog table made, or extended by the spec's new columns."""
        namespace, _, name = self.name.rpartition(".")
        evolve.evolve_tables(self.spark, SchemaSpec({name: self.table}), namespace or "public", DAY, self.folder.rsplit("/", 1)[0],
                             with_errors=False, buckets=self.buckets)

    def by_day(self) -> bool:
        return True

    def _partition(self, day: date | None) -> str:
        return f"PARTITION ({DAY} = {'NULL' if day is None else f'{chr(39)}{day.isoformat()}{chr(39)}'})"

    def days(self) -> list[date | None]:
        return [day_of(r[0]) for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()]

    def location(self, day: date | None) -> str:
        """The folder that a day's partition points to."""
        about = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name} {self._partition(day)}")
        return about.where("col_name = 'Location'").first()["data_type"].rstrip("/")

    def locations(self) -> dict[date | None, str]:
        return {day: self.location(day) for day in self.days()}

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def write(self, rows: DataFrame) -> str:
        """The rows in a new folder, with their zones; no reader sees them yet."""
        folder = f"{self.folder}/{LOADS}/{uuid.uuid4().hex}"
        rows = rows.select(*[F.col(f"`{c.out_name}`") for c in self.table.columns], DAY)
        keys = self.table.distkeys
        if self.buckets and keys:
            # Only a catalog table is written in buckets; this one is gone again once its files are there.
            made = f"{self.name}_{uuid.uuid4().hex}"
            writer = rows.repartition(self.buckets, *keys).write.partitionBy(DAY).bucketBy(self.buckets, *keys).sortBy(*keys)
            writer.format("parquet").option("path", folder).saveAsTable(made)
            self.spark.sql(f"DROP TABLE {made}")
        else:
            if keys or self.table.sortkey_attr:
                rows = laid_out(rows, self.table, [DAY])
            rows.write.partitionBy(DAY).parquet(folder)
        write_zones(self.spark, folder, self.table)
        return folder

    def publish(self, folder: str, days: list[date | None] | None = None) -> None:
        """Point the days that ``write`` left in ``folder`` there; those in ``days`` that it lacks have no rows any more."""
        made = {day_of(path): path for path in files.glob(self.spark, f"{folder}/{DAY}=*")}
        there = set(self.days())
        for day, path in made.items():
            if day in there:
                self.spark.sql(f"ALTER TABLE {self.name} {self._partition(day)} SET LOCATION '{path}'")
            else:
                self.spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS {self._partition(day)} LOCATION '{path}'")
        self.drop([day for day in dict.fromkeys(days or []) if day in there and day not in made])
        self.spark.catalog.refreshTable(self.name)

    def replace(self, rows: DataFrame, days: list[date | None] | None = None) -> None:
        """Exactly the days of ``rows`` and those in ``days`` are replaced, each in one change of the catalog."""
        self.publish(self.write(rows), days)

    def drop(self, days: list[date | None]) -> None:
        """The catalog forgets the days; their files go with ``sweep``."""
        for day in days:
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {self._partition(day)}")
        self.spark.catalog.refreshTable(self.name)

    def zones(self) -> dict[date | None, Zone | None]:
        column = zones.retention_column(self.table)
        return {day: read_zone(self.spark, path, column) if column else None for day, path in self.locations().items()}

    def sweep(self, grace_seconds: float = GRACE_SECONDS, now: float | None = None) -> list[str]:
        """Remove what no partition points to and was written longer ago than ``grace_seconds``; returns the folders.

        The time of grace must be longer than the longest load and the longest reader.
        """
        limit = (time.time() if now is None else now) - grace_seconds
        loads = [path for path in files.glob(self.spark, f"{self.folder}/{LOADS}/*") if files.modified(self.spark, path) < limit]
        of_load = {load: files.glob(self.spark, f"{load}/{DAY}=*") for load in loads}
        known, days = set(self.days()), {day_of(path) for paths in of_load.values() for path in paths}
        used = {_plain(self.location(day)) for day in days & known}
        removed = []
        for load, paths in of_load.items():
            unused = [path for path in paths if _plain(path) not in used]
            for path in [load] if len(unused) == len(paths) else unused:
                files.remove(self.spark, path)
                removed.append(path)
        return removed


def _plain(path: str) -> str:
    """A path without the ways of writing a local scheme."""
    return path.replace("file:///", "/").replace("file:/", "/")


DayTable = FolderTable | CatalogTable


def table_of(spark: SparkSession, name: str, table: TableSpec, root: str, namespace: str | None = None, buckets: int | None = None) -> DayTable:
    """A spec's table below ``root``: in the catalog's ``namespace``, or a folder without one; there in ``buckets`` by its dist key."""
    if namespace is None:
        return FolderTable(spark, name, f"{root}/{name}", table)
    return CatalogTable(spark, qualified_name(name, namespace), f"{root}/{name}", table, buckets)
