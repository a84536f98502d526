"""Session settings and the shared folder that outlives executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dir: list[str] = []


def local_session(cores: int | str = "*", name: str = "tabmill", **conf: str) -> SparkSession:
    """Session for tests and benches; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    if not _local_dir:
        _local_dir.append(tempfile.mkdtemp(prefix="tabmill-"))
    return _local_dir[0]


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written rows.

    What follows no longer depends on executors that may be lost, and the planner knows the
    size of what was written. Files carry no row order: number rows first if it matters.
    """
    path = fresh_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder nobody has used yet."""
    return f"{shared_dir(spark)}/tabmill/{label}-{uuid.uuid4().hex}"
