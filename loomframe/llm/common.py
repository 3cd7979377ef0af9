"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.plans.runtime import ensure_checkpoint_dir

# Words of the near-duplicate operators: runs of anything but ASCII white space.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def col(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def columns(names) -> list[Column]:
    return [col(n) for n in names]


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that clash with none of the table's own (case is ignored)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_of(name: str) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def crc_bucket(doc_id: str, buckets: int) -> Column:
    """crc32 of the id as text, modulo buckets; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(col(doc_id).cast("string"), F.lit("")).cast("binary")) % buckets).cast("int")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the checkpoint folder, which the driver and all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The table as Parquet in the shared folder: lineage is cut, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def batches_of(schema: pa.Schema, columns: list, rows: int = 8192):
    """Record batches of bounded size from whole columns."""
    arrays = [pa.array(c, t) for c, t in zip(columns, schema.types)]
    for i in range(0, len(arrays[0]), rows):
        yield pa.RecordBatch.from_arrays([a.slice(i, rows) for a in arrays], schema=schema)


def released(run):
    """The same function over batches; at the end of a task, memory that Arrow and the allocator keep goes back to the system. Idle Python
    workers stay beside the executor's heap, through all stages that follow."""
    def work(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return work
