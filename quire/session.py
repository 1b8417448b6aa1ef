"""Session, tables and the shared folder: the few things every operator needs."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Rows and bytes up to which a side may be broadcast once both have been measured.
BROADCAST_ROWS, BROADCAST_BYTES = 300_000, 128 << 20
#: Bytes of a batch that goes to a Python worker; without a bound, 10,000 long texts are one batch.
BATCH_BYTES = 32 << 20


def build_session(app: str = "quire", cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings that tests and the benchmark share."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """From now on batches to Python workers are bounded by bytes, unless the session has a bound of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a local session gets a temporary folder; on a cluster that would lose rows, so it is an error.
    """
    if found := spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = tempfile.mkdtemp(prefix="quire-shared-", dir=os.environ.get("QUIRE_SHARED_PARENT"))
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(f"file://{own}")
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def _own_dir(spark: SparkSession) -> str:
    """The application's part of the shared folder; it is deleted when the driver ends."""
    path = f"{shared_dir(spark)}/quire-{spark.sparkContext.applicationId}"
    if path not in _own:
        _own.add(path)
        atexit.register(_delete, spark, path)
    return path


_own: set[str] = set()


def _delete(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone by then; the folder then stays until spark.checkpoint.dir is cleaned
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jvm.org.apache.hadoop.conf.Configuration()).delete(at, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the application's part of the shared folder."""
    return f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "t", path: str | None = None, group_rows: int | None = None) -> DataFrame:
    """Write df to the shared folder and read it again: cuts lineage, survives lost executors, has a known size.

    Tables of steps that are over are deleted by removed(), all others when the driver ends. Rows that hold long arrays need `group_rows`, the
    rows of a row group: a reader decodes 4,096 rows at once otherwise, whatever their size, but never more than a row group.
    """
    path = path or scratch(df.sparkSession, name)
    written = df.write.mode("overwrite")
    (written.option("parquet.block.row.count.limit", group_rows) if group_rows else written).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete tables of stored() that nothing reads any more."""
    for df in frames:
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _wide(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind in ("string", "binary") or kind.startswith(("array", "struct", "map"))]


def bytes_of(df: DataFrame) -> int:
    """Bytes of a stored table's rows, about, as they are in memory: eight for a number, all of a string or an array."""
    each = sum((F.octet_length(c) if kind in ("string", "binary") else F.length(F.to_json(F.struct(c))) for c, kind in df.dtypes if c in _wide(df)), F.lit(0))
    return int(df.agg(F.sum(F.coalesce(each, F.lit(0)).cast("long") + 8 * len(df.columns))).first()[0] or 0)


def small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """df for the smaller side of a join: broadcast only if its measured rows and bytes allow it, else left to a shuffled join.

    Call it on stored tables: their rows are counted from Parquet footers, and bytes are summed only where rows are few.
    """
    fits = df.count() <= rows and (not _wide(df) or bytes_of(df) <= size)
    return F.broadcast(df) if fits else df
