"""Session settings the operators count on, and where intermediate data may live."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings. All can be set on a running session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Game ids are zero-padded text; inference would read them as integers.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # HotSpot never compiles longer methods, and a stage with one is interpreted. Above this
    # Spark falls back to operators whose code it cuts into short methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, once for each application: they need not
    have it installed or on their path."""
    sc = spark.sparkContext
    if getattr(sc, "_tracklane_shipped", False):
        return
    top = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tracklane-")) / "tracklane.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(top.rglob("*.py")):
            out.write(file, file.relative_to(top.parent))
    sc.addPyFile(str(archive))
    sc._tracklane_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and scratch tables.

    A cluster names it in ``spark.checkpoint.dir``; without it this fails there, as
    executors do not see each other's folders. A local master gets a temporary one.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if sc.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tracklane-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep the rows in reliable storage.

    Used for small derived frames whose values steer later stages: after this,
    a lost executor cannot lead to a second, different evaluation.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
