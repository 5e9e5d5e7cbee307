"""Session settings the engine relies on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Settings that change results, applied at run time to any session.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # A repeated key keeps its last value instead of making the whole line unreadable.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # A rerun of one day replaces that day only.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}
WRITER_SETTINGS = {
    # A task keeps a file per partition value open instead of sorting its rows by that value; past this many it sorts.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
    # Whole numbers: as INT96, Spark's default, times are a large part of what writing costs, and files don't know their span.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that the results depend on."""
    for key, value in {**RESULT_SETTINGS, **WRITER_SETTINGS}.items():
        spark.conf.set(key, value)
    return spark


def scale_settings(shuffle_bytes: int, cores: int, partition_bytes: int = 128 * 1024 * 1024) -> dict[str, str]:
    """Settings for a job that shuffles about ``shuffle_bytes``: pass them to the session builder.

    Shuffle partitions start at about ``partition_bytes`` each, so that one fits a task's memory; adaptive
    execution merges the small ones and splits skewed ones from there.
    """
    partitions = max(2 * cores, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        **RESULT_SETTINGS,
        **WRITER_SETTINGS,
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, settings: dict[str, str] | None = None) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("logweir")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary directory of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="logweir-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, not yet existing sub-folder of the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back: computed once, and the same for everything that reads it."""
    folder = fresh_folder(frame.sparkSession, label)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def small_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows held by the driver (days, prefixes, names) as a frame whose size Spark knows.

    From a plain list Spark would assume an unbounded size and shuffle whatever it is joined with.
    """
    struct = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [()] * len(struct)
    arrow = to_arrow_schema(struct)
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), struct)
