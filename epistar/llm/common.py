"""Shared pieces of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

BATCH_ROWS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (names differ beyond case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small (rows; a smaller setting stays)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def sketch_rows(counts: np.ndarray, blocks: int) -> pa.RecordBatch:
    """A partition's sketch, cut into ``blocks`` rows (block, cells) for the merge."""
    return pa.RecordBatch.from_pydict(
        {"block": np.arange(blocks, dtype=np.int32), "cells": [part.tobytes() for part in np.split(counts, blocks)]},
        schema=pa.schema([("block", pa.int32()), ("cells", pa.binary())]),
    )


def merge_sketches(
    rows: DataFrame,
    blocks: int,
    dtype: str,
    combine: Callable[[np.ndarray, np.ndarray], np.ndarray],
    finish: Callable[[np.ndarray], np.ndarray],
) -> np.ndarray:
    """Merge partition sketches block by block and return the finished array.

    Each merging task streams over the rows of its blocks and holds one array
    per block, so memory does not depend on the number of partitions. The
    result's size is fixed by the sketch's parameters, not by the data.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, cells in zip(batch.column("block").to_pylist(), batch.column("cells")):
                part = np.frombuffer(cells.as_buffer(), dtype=dtype)
                held[block] = combine(held[block], part) if block in held else part.copy()
        for block, part in held.items():
            yield sketch_block(block, finish(part))

    merged = rows.select("block", "cells").repartition(blocks, "block").mapInArrow(merge, "block int, cells binary")
    found = sorted(merged.collect(), key=lambda r: r["block"])
    return np.concatenate([np.frombuffer(r["cells"], dtype=np.uint8) for r in found]) if found else np.zeros(0, np.uint8)


def sketch_block(block: int, cells: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"block": [block], "cells": [cells.tobytes()]}, schema=pa.schema([("block", pa.int32()), ("cells", pa.binary())])
    )


def key_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys of a sorted stream, each as one table (for groups of bounded size)."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [np.asarray(batch.column(k)) for k in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        cuts = np.flatnonzero(change)
        first = tuple(c[0] for c in cols)
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        lo = 0
        for hi in cuts.tolist():
            held.append(batch.slice(lo, hi - lo))
            yield pa.Table.from_batches(held)
            held, lo = [], hi
        held.append(batch.slice(lo))
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)

