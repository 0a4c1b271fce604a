"""Session builder with the settings every plan in this package assumes."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "stemma", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, ANSI, adaptive execution; extra settings as keyword arguments (dots as ``__``)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings |= {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables below ``sf_dir``; read through Spark only, so any store works."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_written: list[tuple[SparkSession, str]] = []


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path in the folder that the cluster names in ``spark.checkpoint.dir``; it goes when the interpreter ends.

    Only a local master may do without that setting, and gets a folder of its own.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='stemma-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        if spark.sparkContext._jsc is not None:  # the session may have ended
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
