"""Session-level helpers: size limits, lineage cuts and size-checked tables."""

from __future__ import annotations

import gc
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

# Session settings and their defaults. A group, window or sort inside one task is split
# once it may exceed cellRows; a table is broadcast only after it was counted to be
# at most broadcastRows, and its texts and arrays at most broadcastBytes (as text).
CELL_ROWS = ("spark.loomframe.cellRows", 1_000_000)
BROADCAST_ROWS = ("spark.loomframe.broadcastRows", 100_000)
BROADCAST_BYTES = ("spark.loomframe.broadcastBytes", 64 << 20)
BLOCK_ROWS = ("spark.loomframe.blockRows", 20_000)


def limit_of(spark: SparkSession, setting: tuple[str, int]) -> int:
    return int(spark.conf.get(setting[0], str(setting[1])))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by the cluster; a temporary one only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="loomframe-checkpoint-")
    context.setCheckpointDir(folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialize to the shared checkpoint folder, so a lost executor costs no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The table as Parquet in the checkpoint folder: later filters read the row groups they need only."""
    return stored_in(df)[0]


def stored_in(df: DataFrame) -> tuple[DataFrame, str]:
    """The stored table and its folder, for tables that are discarded."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder), folder


def discard(spark: SparkSession, *folders: str) -> None:
    """Delete stored tables that nothing reads any more. Spark removes the shuffle files behind them once the driver's garbage is collected."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
    gc.collect()
    jvm.System.gc()


@dataclass
class Settled:
    """A computed table together with what is known about its size."""

    df: DataFrame
    small: bool

    def hinted(self) -> DataFrame:
        return F.broadcast(self.df) if self.small else self.df


def settle(df: DataFrame) -> Settled:
    """Compute a parameter table once.

    Up to broadcastRows rows, with texts and arrays of up to broadcastBytes, it becomes a local relation that joins
    by broadcast; above that it is written to the checkpoint folder and joins by shuffle. Columns of varying length are
    measured before anything is fetched. A table that the caller caches stays cached.
    """
    spark = df.sparkSession
    limit = limit_of(spark, BROADCAST_ROWS)
    level = df.storageLevel
    cached = level.useMemory or level.useDisk
    held = df if cached else df.persist()  # what the size check computes is not computed again by the write
    try:
        if _bytes_within(held, limit):
            head = held.limit(limit + 1).toArrow()
            if head.num_rows <= limit:
                return Settled(spark.createDataFrame(head, df.schema), True)
        return Settled(cut_lineage(held), False)
    finally:
        if not cached:
            held.unpersist()


def _bytes_within(df: DataFrame, rows: int) -> bool:
    """Whether the first rows + 1 rows' texts, arrays and the like are within broadcastBytes."""
    varying = [f.name for f in df.schema if isinstance(f.dataType, (StringType, BinaryType, ArrayType, MapType, StructType))]
    if not varying:
        return True
    columns = [F.col("`" + name.replace("`", "``") + "`").cast("string") for name in varying]
    length = sum((F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in columns), F.lit(0).cast("long"))
    total = df.limit(rows + 1).agg(F.sum(length).alias("n")).first()["n"]
    return (total or 0) <= limit_of(df.sparkSession, BROADCAST_BYTES)


def widen(df: DataFrame, n_rows: int) -> DataFrame:
    """Spread a table of at most cellRows rows over all cores, for work that is heavy per row.

    A small file is one scan task; a table that already comes in as many tasks as there are cores is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if n_rows > limit_of(df.sparkSession, CELL_ROWS) or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def require_columns(df: DataFrame, columns) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join on keys where NULL matches NULL; right keys are dropped."""
    if not keys:
        raise ValueError("a join needs keys")
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_r_{k}")
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])
