"""What depends on the session: settings, cutting lineage, checked broadcasts, hot keys."""

from __future__ import annotations

import hashlib
import io
import pathlib
import tempfile
import uuid
import zipfile
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

# A group with more rows than this is never held whole by one task.
HOT_GROUP_ROWS = 100_000
# At most so many hot groups are sent to every executor; beyond it they are joined by shuffle.
MAX_HOT_KEYS = 10_000
# Where a local session without spark.checkpoint.dir keeps its checkpoints, if it asks for that.
OWN_CHECKPOINTS = "/tmp/scarmap-checkpoints"
# Rows of a task that sorts or groups them, so that more rows mean more tasks and not larger ones.
TASK_ROWS = 500_000
# Upper bound of a broadcast table, in bytes of its encoded rows.
MAX_BROADCAST_BYTES = 64 << 20
# Upper bound of an Arrow batch of rows with texts; an executor holds some per running task, on both sides of the pipe.
MAX_BATCH_BYTES = 4 << 20


def session(name: str = "scarmap", **conf) -> SparkSession:
    """Session with the settings the jobs expect; values given by the cluster are kept."""
    b = (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, whose functions name its modules; for sessions of clusters without it."""
    package = pathlib.Path(__file__).resolve().parent
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.writestr(zipfile.ZipInfo(str(f.relative_to(package.parent))), f.read_bytes())
    path = pathlib.Path(tempfile.gettempdir()) / f"scarmap-{hashlib.sha256(held.getvalue()).hexdigest()[:16]}.zip"
    if not path.exists():
        path.write_bytes(held.getvalue())
    spark.sparkContext.addPyFile(str(path))


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder for tables that cut lineage, which driver and executors share."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return folder


def own_checkpoint_folder(spark: SparkSession, folder: str = OWN_CHECKPOINTS) -> None:
    """For tests and trials on one machine: a checkpoint folder where the session names none."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None and spark.conf.get("spark.checkpoint.dir", None) is None:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder)


def bounded_batches(spark: SparkSession, limit: int = MAX_BATCH_BYTES) -> None:
    """Sets how many bytes an Arrow batch has at most, or one row; a value that the session has is kept.

    By default a batch ends at 10,000 rows or 64 MB, so what a task holds would grow with the length of texts up to that.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(limit))


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage by a checkpoint in the folder the session names; without one, raise."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_folder(spark))
    return df.checkpoint(eager=True)


def written(df: DataFrame, by: list[str] = []) -> DataFrame:
    """``df`` written as Parquet to the folder for checkpoints, in a subfolder per value of ``by``, and read again."""
    path = f"{checkpoint_folder(df.sparkSession)}/rows-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(StructType([*[f for f in df.schema if f.name not in by], *[df.schema[c] for c in by]])).parquet(path)


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row as Spark encodes it: eight per field, more for what has no fixed width."""

    def of(value: Column, kind: DataType) -> Column:
        if isinstance(kind, (StringType, BinaryType)):
            return F.coalesce(F.octet_length(value), F.lit(0)) + 8
        if isinstance(kind, StructType):
            return reduce(lambda a, b: a + b, [of(value[f.name], f.dataType) for f in kind], F.lit(16))
        if isinstance(kind, ArrayType):
            if not _varies(kind.elementType):
                return F.greatest(F.coalesce(F.size(value), F.lit(0)), F.lit(0)) * of(F.lit(None), kind.elementType) + 16
            sizes = F.aggregate(value, F.lit(0), lambda s, x: s + of(x, kind.elementType).cast("int"))
            return F.coalesce(sizes, F.lit(0)) + 16
        if isinstance(kind, MapType):
            return of(F.map_keys(value), ArrayType(kind.keyType)) + of(F.map_values(value), ArrayType(kind.valueType))
        return F.lit(8)

    return reduce(lambda a, b: a + b, [of(F.col(f"`{f.name}`"), f.dataType) for f in df.schema], F.lit(8)).cast("long")


def _varies(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return True
    return isinstance(kind, (StringType, BinaryType, ArrayType, MapType))


def checked_broadcast(df: DataFrame, limit: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df``, marked for broadcast if its measured bytes are within ``limit``, else for a join by shuffle.

    The rows are settled first, so what they come from is evaluated once, not for the measure and again for the join. Beyond the
    limit the mark keeps Spark from a broadcast of its own: its estimate does not see rows that ranges or Python make.
    """
    df = settle(df)
    size = df.agg(F.sum(row_bytes(df))).first()[0] or 0
    return F.broadcast(df) if size <= limit else df.hint("merge")


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Rows over all cores. For few rows with much work each, which would be merged into one task by size."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, 2), *by)


def tasks_of(spark: SparkSession, rows: int | None) -> int:
    """How many tasks share so many rows; one per core at least."""
    return max(-(-(rows or 0) // TASK_ROWS), spark.sparkContext.defaultParallelism, 2)


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which null meets null; the keys appear once."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_right_{k}" for k in keys])


def hot_keys(df: DataFrame, keys: list[str], limit: int = HOT_GROUP_ROWS) -> DataFrame | None:
    """Keys with more than ``limit`` rows, or None if there are none.

    Costs one scan of the key columns with map-side counting.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    hot = counts.select(*keys)
    found = hot.limit(MAX_HOT_KEYS + 1).collect()
    if not found:
        return None
    if len(found) > MAX_HOT_KEYS:
        return settle(hot)
    return F.broadcast(df.sparkSession.createDataFrame(found, hot.schema))


def split_hot(df: DataFrame, keys: list[str], limit: int = HOT_GROUP_ROWS):
    """(rows of ordinary groups, rows of hot groups or None).

    ``df`` is evaluated once for the keys' counts. If there are hot groups, it is evaluated once more and written, hot rows
    apart; however often the two tables are read then, nothing before them runs again.
    """
    hot = hot_keys(df, keys, limit)
    if hot is None:
        return df, None
    rows = written(join_null_safe(df, hot.withColumn("_is_hot", F.lit(True)), keys, "left").withColumn("_is_hot", F.coalesce("_is_hot", F.lit(False))), ["_is_hot"])
    return rows.where("not _is_hot").drop("_is_hot"), rows.where("_is_hot").drop("_is_hot")
