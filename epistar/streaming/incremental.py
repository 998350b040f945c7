"""Chunked transform then keyed upsert, as a Structured Streaming job.

Landed chunk files (JSON lines or Parquet) are read by the file source with
``maxFilesPerTrigger``; every micro-batch is transformed and upserted by key
into the versioned warehouse tables. A table's manifest records the last epoch of each stream, so a batch whose table was
committed but whose checkpoint was not is recognised when it is replayed, and skipped. An upsert replaces: a transform hands over
rows under their own unique key and leaves totals to the reader; totals of one
batch would overwrite those of the batch before. Order columns come from the
data (file, split, position in the split), never from arrival time.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from epistar.operators.warehouse import load_table
from epistar.session import checkpoint_dir
from epistar.spec import TableSpec

# A batch's row order: file, start of the split in it, position in the split.
ORDER_COLUMNS = ("_file", "_split", "_pos")
BatchTransform = Callable[[DataFrame], Mapping[str, DataFrame]]


def stream_source(
    spark: SparkSession,
    folder: str,
    schema,
    fmt: str = "json",
    max_files_per_trigger: int = 1,
    pattern: str | None = None,
) -> DataFrame:
    """File-source stream with the ``_file`` order column (``_pos`` is added per micro-batch)."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    df = reader.format(fmt).load(folder)
    return df.withColumns({"_file": F.col("_metadata.file_path"), "_split": F.col("_metadata.file_block_start")})


def upsert_batches(
    stream: DataFrame,
    transform: BatchTransform,
    specs: Mapping[str, TableSpec],
    warehouse_root: str,
    query_name: str,
    batch_time: Callable[[int], _dt.datetime] | None = None,
    checkpoint_location: str | None = None,
) -> StreamingQuery:
    """Start the incremental load; every micro-batch upserts each output data set.

    ``batch_time(epoch_id)`` fixes the audit timestamps so a replayed epoch
    writes the same values. The checkpoint lives in the shared checkpoint
    folder unless one is given.
    """
    spark = stream.sparkSession
    location = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/streams/{query_name}"
    clock = batch_time or (lambda epoch: _dt.datetime(1970, 1, 1) + _dt.timedelta(seconds=epoch))

    def _apply(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        if "_pos" not in batch.columns:
            # row order inside a split; the split's place in its file comes before it
            batch = batch.withColumn("_pos", F.monotonically_increasing_id())
        outputs = transform(batch)
        ts = clock(epoch_id)
        for name, df in outputs.items():
            spec = specs.get(name)
            if spec is None:
                continue
            order = [c for c in ORDER_COLUMNS if c in df.columns] or None
            load_table(batch.sparkSession, spec, df, f"{warehouse_root.rstrip('/')}/{name}", ts, order, commit=(query_name, epoch_id))

    return (
        stream.writeStream.queryName(query_name)
        .option("checkpointLocation", location)
        .foreachBatch(_apply)
        .trigger(availableNow=True)
        .start()
    )
