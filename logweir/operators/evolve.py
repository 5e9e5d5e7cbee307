"""Additive schema evolution, and checks of stored tables against their spec."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.plans.spec import ColumnSpec, SchemaSpec, SpecError, TableSpec, create_table_sql, default_sql, qualified_name
from logweir.session import small_frame
from logweir.sources import files

DAY = "data_date"
BATCH = "batch_id"  # second partition column of tables that a stream fills
SPEC_FILE = "_spec/table.json"  # Spark passes over names that start with an underscore


def added_columns(name: str, stored: TableSpec, wanted: TableSpec) -> list[ColumnSpec]:
    """The columns that ``wanted`` has after those of ``stored``.

    The stored columns must be a prefix of the wanted ones with equal types and constraints, and a new column
    can be neither sort nor dist key.
    """
    if len(wanted.columns) < len(stored.columns):
        raise SpecError(f"{name}: columns are missing from the new spec")
    for old, new in zip(stored.columns, wanted.columns):
        same = (
            old.out_name == new.out_name and old.data_type == new.data_type and old.char_width == new.char_width
            and old.not_null == new.not_null and old.is_distkey == new.is_distkey
            and (old.out_name in stored.sortkey_attr) == (new.out_name in wanted.sortkey_attr)
        )
        if not same:
            raise SpecError(f"{name}: column {old.out_name} differs from the stored one")
    return _checked_new(name, wanted, wanted.columns[len(stored.columns):])


def _checked_new(name: str, wanted: TableSpec, new) -> list[ColumnSpec]:
    for column in new:
        if column.is_distkey or column.out_name in wanted.sortkey_attr:
            raise SpecError(f"{name}: an added column cannot be a sort or dist key: {column.out_name}")
    return list(new)


def conform(rows: DataFrame, table: TableSpec, keep: tuple[str, ...] = ("data_date",)) -> DataFrame:
    """Rows with exactly the spec's columns, in order; a column the rows lack is filled with its default."""
    have = {c.lower() for c in rows.columns}
    out = []
    for c in table.columns:
        if c.out_name.lower() in have:
            out.append(F.col(f"`{c.out_name}`").cast(c.data_type).alias(c.out_name))
        else:
            out.append(F.expr(default_sql(c)).cast(c.data_type).alias(c.out_name))
    return rows.select(*out, *[F.col(k) for k in keep if k.lower() in have])


def stored_schema(table: TableSpec) -> T.StructType:
    """The spec's columns as a reader's schema: a column that a file does not have reads as its default there.

    A NULL that was stored stays NULL.
    """
    def described(c: ColumnSpec) -> dict:
        return {"EXISTS_DEFAULT": default_sql(c), "CURRENT_DEFAULT": default_sql(c)} if c.default is not None else {}

    return T.StructType([T.StructField(c.out_name, c.data_type, True, described(c)) for c in table.columns])


def partition_columns(spark: SparkSession, folder: str) -> list[str]:
    """How a stored table is partitioned: by day, and by batch where a stream filled it."""
    for pattern, columns in ((f"{DAY}=*/{BATCH}=*", [DAY, BATCH]), (f"{DAY}=*", [DAY]), (f"{BATCH}=*", [BATCH])):
        if files.glob(spark, f"{folder}/{pattern}"):
            return columns
    return []


def read_stored(spark: SparkSession, folder: str, table: TableSpec) -> DataFrame:
    """A stored table as the spec sees it, whichever versions its files were written under, with its partition columns.

    One scan, never by the schema of one footer. A folder without files is an empty table by day.
    """
    schema = stored_schema(table)
    types = {DAY: T.DateType(), BATCH: T.LongType()}
    found = partition_columns(spark, folder)
    if not found and not files.glob(spark, f"{folder}/*.parquet"):
        return spark.createDataFrame([], T.StructType([*schema, T.StructField(DAY, types[DAY])]))
    keys = [k for k in found if k not in schema.names]
    return spark.read.schema(T.StructType([*schema, *[T.StructField(k, types[k]) for k in keys]])).parquet(folder)


def remembered_spec(spark: SparkSession, folder: str) -> TableSpec | None:
    """The spec under which a table was last written."""
    text = files.read_text(spark, f"{folder}/{SPEC_FILE}")
    return None if text is None else TableSpec.from_dict(json.loads(text))


def reconcile(spark: SparkSession, name: str, folder: str, table: TableSpec, remembering: bool = True) -> list[ColumnSpec]:
    """Compare a stored table's spec with the wanted one before a load; returns the added columns.

    Anything but added columns is an error, and nothing is written then. The wanted spec is remembered, unless that is
    left to ``remember`` after the load: a load that fails must not leave a table that claims a version it has no rows of.
    """
    stored = remembered_spec(spark, folder)
    added = list(table.columns) if stored is None else added_columns(name, stored, table)
    if remembering:
        remember(spark, folder, table)
    return added


def remember(spark: SparkSession, folder: str, table: TableSpec) -> None:
    """Note the spec under which a table's newest rows were written."""
    if remembered_spec(spark, folder) != table:
        files.write_text(spark, f"{folder}/{SPEC_FILE}", json.dumps(table.to_dict()))


def read_evolved(spark: SparkSession, folders: list[str], table: TableSpec) -> DataFrame:
    """Parquet written under older versions of the spec, read as the current version.

    Each folder is conformed on its own footer schema, so an old row gets the default of a column that did
    not exist yet, while a NULL written later stays NULL.
    """
    parts = [conform(spark.read.parquet(folder), table) for folder in folders]
    return reduce(DataFrame.unionByName, parts)


def evolve_tables(spark: SparkSession, spec: SchemaSpec, namespace: str = "public",
                  partition_column: str | None = "data_date", root: str | None = None, with_errors: bool = True,
                  buckets: int | None = None) -> dict[str, list[str]]:
    """Create missing catalog tables, extend existing ones; returns the added columns per table.

    Includes the error table, unless told not to. A new column's default applies to rows that are already stored. With ``root`` the
    tables lie over the folders that ``load_tables`` and ``load_days`` write; call ``publish_days`` after a load.
    """
    done = {}
    for name, table in sorted((spec.with_error_table() if with_errors else spec).tables.items()):
        target = qualified_name(name, namespace)
        if not spark.catalog.tableExists(target):
            spark.sql(create_table_sql(target, table, partition_column, f"{root}/{name}" if root else None, buckets))
            done[name] = [c.out_name for c in table.columns]
            continue
        stored = [f for f in spark.table(target).schema.fields if f.name != partition_column]
        if len(table.columns) < len(stored):
            raise SpecError(f"{name}: columns are missing from the new spec")
        for old, new in zip(stored, table.columns):
            if old.name.lower() != new.out_name.lower() or old.dataType != new.data_type:
                raise SpecError(f"{name}: column {old.name} differs from the stored one")
        new = _checked_new(name, table, table.columns[len(stored):])
        if new:
            added = ", ".join(
                f"`{c.out_name}` {c.data_type.simpleString()}"
                + (f" DEFAULT {default_sql(c)}" if c.default is not None else "")
                for c in new
            )
            spark.sql(f"ALTER TABLE {target} ADD COLUMNS ({added})")
        done[name] = [c.out_name for c in new]
    return done


def publish_days(spark: SparkSession, spec: SchemaSpec, namespace: str = "public", with_errors: bool = True) -> None:
    """Make newly written day partitions known to the catalog tables of a spec."""
    for name in (spec.with_error_table() if with_errors else spec).tables:
        spark.catalog.recoverPartitions(qualified_name(name, namespace))
        spark.catalog.refreshTable(qualified_name(name, namespace))


def column_diff(stored: dict[str, DataFrame], spec: SchemaSpec, spark: SparkSession) -> DataFrame:
    """(table_name, column_name, side) for every column that only the spec or only the store has."""
    schema = "table_name string, column_name string"
    wanted = [(t, c.out_name.lower()) for t, table in spec.tables.items() for c in table.columns]
    actual = [(t, c.lower()) for t, rows in stored.items() for c in rows.columns]
    want, have = small_frame(spark, wanted, schema), small_frame(spark, actual, schema)
    return want.exceptAll(have).withColumn("side", F.lit("spec")).unionByName(
        have.exceptAll(want).withColumn("side", F.lit("store"))
    )


def row_presence(stored: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows, has_rows) per table."""
    counts = [
        rows.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, rows in stored.items()
    ]
    return reduce(DataFrame.unionByName, counts).withColumn("has_rows", F.col("n_rows") > 0)


def require_rows(stored: dict[str, DataFrame]) -> None:
    """Fail when a table is empty; looks at one row per table only."""
    empty = [name for name, rows in stored.items() if rows.isEmpty()]
    if empty:
        raise ValueError(f"tables without rows: {', '.join(sorted(empty))}")


def require_columns(stored: dict[str, DataFrame], spec: SchemaSpec, spark: SparkSession) -> None:
    """Fail when columns of store and spec differ."""
    differing = column_diff(stored, spec, spark).collect()  # names only
    if differing:
        raise ValueError("columns differ: " + ", ".join(f"{r.table_name}.{r.column_name} ({r.side})" for r in differing))
