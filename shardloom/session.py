"""Session helpers: a sane local session, shipping of this package, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = Path(__file__).resolve().parent
_shipped: set[str] = set()

#: Bytes of an Arrow batch to a Python worker, so that batches of long texts stay small.
BATCH_BYTES = 8 << 20


def local_session(cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benches; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Give Python workers this package, once per application, wherever the driver was started from; and bound their
    batches, unless the application has set that bound itself."""
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(bound):
        spark.conf.set(bound, str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    target = Path(tempfile.mkdtemp()) / "shardloom.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(_PACKAGE.rglob("*.py")):
            archive.write(source, str(Path("shardloom") / source.relative_to(_PACKAGE)))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)


def scratch_root(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a private one for local sessions without it."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = f"/tmp/checkpoints/shardloom-{context.applicationId}"
    os.makedirs(root, exist_ok=True)
    return f"file://{root}"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/shardloom/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write a table into the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def discard(df: DataFrame | None) -> None:
    """Delete a table that materialize() wrote, once nothing reads it any more."""
    path = getattr(df, "_scratch", None)
    if path is not None:
        discard_path(df.sparkSession, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
