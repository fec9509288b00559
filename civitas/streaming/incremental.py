"""Incremental runs of the indicator jobs with Structured Streaming.

The reference has no stream processing: every job is a one-shot batch
over a folder of raw files. The only streaming use here is *incremental*
batch: new raw files dropped into a folder are parsed and joined with the
(static) commune register, and their rows appended to the indicator table,
with exactly-once bookkeeping in a checkpoint under the cluster's shared
``spark.checkpoint.dir``. Everything applied to the stream is stateless
(parsing X*, projections P*, filters F*, stream-static join J1), so no
state store grows with the data; per-commune means are computed by the
batch job over the appended table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir


def incremental_indicator(spark: SparkSession, input_dir: str, schema: StructType,
                          transform: Callable[[DataFrame], DataFrame], output_dir: str,
                          name: str, sep: str = ";", partition_by: str | None = "annee",
                          checkpoint: str | None = None) -> None:
    """Process every not-yet-seen raw file of ``input_dir`` once
    (``availableNow`` trigger) and append the transformed rows as parquet."""
    stream = (spark.readStream.schema(schema).option("header", True).option("sep", sep)
              .csv(input_dir))
    out = transform(stream)
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/civitas-streams/{name}"
    writer = (out.writeStream.format("parquet").option("path", output_dir)
              .option("checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.start().awaitTermination()
