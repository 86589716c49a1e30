"""Session settings the jobs rely on, and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the results or the plans rely on: instants are read as UTC, an overflow
# is an error, and adaptive execution splits skewed joins.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; extra ones are given with ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in RUNTIME_SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("_", "."), value)
    return pin_runtime(builder.getOrCreate())


def pin_runtime(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else made."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder for cut lineage; a temporary one only in local mode.

    A folder on one machine cannot be read again after that executor is lost, so a
    cluster without ``spark.checkpoint.dir`` is an error rather than a guess.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="barweave-"))
        folder = context.getCheckpointDir()
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage by writing ``df`` as a table in the shared folder.

    Columnar, unlike a checkpointed RDD: later steps read only the columns they need, and
    their join strategies see the real size. The tables may be removed once the job that
    made them is over.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
