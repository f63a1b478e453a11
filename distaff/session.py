"""Session settings and the shared folder for cut points."""

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Rows a head slice or top-k may ask for: what the rank limit before the shuffle cuts to.
MAX_SLICE = 1_000_000
_HOMES: set[str] = set()
_SCOPE = threading.local()


def configure(spark: SparkSession) -> SparkSession:
    """Set the SQL options the operators rely on.

    Python's JSON reader lets the last duplicate key win; Spark's variant
    parser does the same only with ``allowDuplicateKeys``. The rank limits of
    head slices and top-k keep more than Spark's default of 1000 rows, and
    must still cut each group before it is shuffled.
    """
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", str(MAX_SLICE))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for cut points: ``spark.checkpoint.dir``, else a folder of the warehouse.

    Neither is a temporary folder of one machine. A warehouse in the file
    system of one machine is taken only where driver and executors are one
    process; on a cluster it is refused, as each executor would write to its
    own disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    local = spark.sparkContext.master.split("[")[0] == "local"
    if not local and warehouse.startswith(("file:", "/")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return warehouse + "/checkpoints"


def scratch_path(spark: SparkSession, label: str) -> str:
    """Unused path below the shared folder, in a folder of this application.

    That folder is deleted when the driver ends in good order.
    """
    home = f"{checkpoint_dir(spark)}/distaff/{spark.sparkContext.applicationId}"
    if home not in _HOMES:
        path = spark._jvm.org.apache.hadoop.fs.Path(home)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _HOMES.add(home)
    used = f"{home}/{label}-{uuid.uuid4().hex}"
    for scope in getattr(_SCOPE, "open", []):
        scope.append(used)
    return used


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch tables that this thread writes inside, as for each batch of a stream that never ends."""
    mine: list[str] = []
    _SCOPE.open = [*getattr(_SCOPE, "open", []), mine]
    try:
        yield
    finally:
        _SCOPE.open = _SCOPE.open[:-1]
        for used in mine:
            path = spark._jvm.org.apache.hadoop.fs.Path(used)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Values that depend on how one execution happened to partition its rows
    are fixed from here on, whatever is retried or lost later, and readers
    of the copy still prune columns.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
