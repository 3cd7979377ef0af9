"""A fitted transform keeps no state, so it applies to a streaming DataFrame as it is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def transform_stream(fitted, stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the transformed stream to parquet (append), processing what is available and then stopping.

    Encoders join the stream with their static table; scalers, imputers and scores are projections.
    """
    return (fitted.transform(stream).writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path))
