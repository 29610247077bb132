"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

_used: dict[str, list[str]] = {}


def local_session(cpus: int | str = "*", app: str = "tidemark", scratch: str | None = None) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    cores = 8 if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
    )
    if scratch:
        builder = builder.config("spark.checkpoint.dir", scratch)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str = "work") -> str:
    """A fresh path below the folder that every executor can reach.

    The cluster names that folder in `spark.checkpoint.dir`; without it the warehouse folder is used, unless that lies
    on one machine's disk and the executors do not.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        if base.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{base.rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"
    _used.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete the scratch folders this application has made so far; returns their number.

    For the caller to take once results are written: a DataFrame that was returned still reads these folders.
    """
    paths = _used.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    return len(paths)


def local_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows that the driver knows (metadata, verdicts) as a local relation, whose size the planner sees."""
    fields = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    arrow = pa.Table.from_arrays(
        [pa.array(list(c), type=f.type) for c, f in zip(columns, to_arrow_schema(fields))], schema=to_arrow_schema(fields)
    )
    return spark.createDataFrame(arrow, fields)


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write `df` to the shared scratch folder and read it back: a short plan that outlives executors."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
