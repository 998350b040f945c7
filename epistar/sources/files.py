"""Readers and writers.

Source documents arrive either as ``{"records": [...]}`` or as a top-level
JSON array. Both are read with Spark's JSON reader; every row carries its
file (``_file``) and its position inside that file (``_pos``) so that
"first row" rules stay deterministic. A multi-line JSON document is parsed
by one task, so large documents should be landed once as Parquet
(``land_parquet``) and everything downstream reads the Parquet copy.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ROW_BITS = 33


def _with_order(df: DataFrame) -> DataFrame:
    """Add ``_file`` and ``_pos`` (row position inside its file).

    A multi-line JSON file is a single partition, so the partition-local
    row index of ``monotonically_increasing_id`` is the row's position.
    """
    mid = F.monotonically_increasing_id()
    return df.withColumns(
        {
            "_file": F.col("_metadata.file_path"),
            "_pos": mid - F.shiftleft(F.spark_partition_id().cast("long"), _ROW_BITS),
        }
    )


def find_files(spark: SparkSession, folder: str, pattern: str) -> list[str] | None:
    """Files under ``folder`` matching a glob ``pattern``; ``None`` when there are none."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder.rstrip("/") + "/" + pattern.lstrip("/"))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    statuses = fs.globStatus(path)
    files = sorted(str(s.getPath().toString()) for s in (statuses or []) if s.isFile())
    return files or None


def json_shape(spark: SparkSession, path: str) -> str:
    """``"object"`` or ``"array"``: the first character of a JSON file that is no blank.

    Reads up to that character on the driver, however many blanks lead to it;
    a UTF-8 byte-order mark is skipped.
    """
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = jvm.java.io.BufferedInputStream(fs.open(hpath))
    try:
        while True:
            b = stream.read()
            if b in (0xEF, 0xBB, 0xBF) or (b >= 0 and chr(b).isspace()):
                continue
            return {"{": "object", "[": "array"}.get(chr(b), "other") if b >= 0 else "other"
    finally:
        stream.close()


def _records_schema(schema) -> T.StructType | str:
    if isinstance(schema, T.StructType):
        return T.StructType([T.StructField("records", T.ArrayType(schema))])
    return f"records ARRAY<STRUCT<{schema}>>"


def _explode_records(raw: DataFrame) -> DataFrame:
    base = raw.select(F.col("_metadata.file_path").alias("_file"), F.posexplode("records").alias("_pos", "_rec"))
    return base.select("_rec.*", "_file", F.col("_pos").cast("long").alias("_pos"))


def read_json_records(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """Read ``{"records": [...]}`` documents or top-level arrays as rows.

    ``schema`` is the schema of one record. Each file's shape is told from its
    first character, so objects and arrays mix; without a schema Spark infers
    one by shape (an extra pass). Anything that is neither shape raises
    ``ValueError``, and a document that breaks off fails the read.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    shapes: dict[str, list[str]] = {}
    for path in paths:
        shapes.setdefault(json_shape(spark, path), []).append(path)
    if "other" in shapes:
        raise ValueError(f"neither an object nor an array at the start of {', '.join(shapes['other'])}")
    # a document that breaks off must not lose its rows silently
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    frames = []
    if "object" in shapes:
        raw = (reader.schema(_records_schema(schema)) if schema is not None else reader).json(shapes["object"])
        if "records" not in raw.columns or not isinstance(raw.schema["records"].dataType, T.ArrayType):
            raise ValueError(f"no array of records in {', '.join(shapes['object'])}")
        frames.append(_explode_records(raw))
    if "array" in shapes:
        reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
        frames.append(_with_order((reader.schema(schema) if schema is not None else reader).json(shapes["array"])))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def read_json_table(spark: SparkSession, paths: str | Sequence[str], schema=None) -> DataFrame:
    """A plain JSON document (array of rows) as a table, with order columns; one that breaks off fails the read."""
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    return _with_order(reader.json(paths if isinstance(paths, str) else list(paths)))


def read_json_lines(spark: SparkSession, paths: str | Sequence[str], schema=None) -> DataFrame:
    """JSON-lines input (splittable: many tasks per file); a broken line fails the read."""
    reader = spark.read.option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(paths if isinstance(paths, str) else list(paths))


# Fixed value: the lookup file's header.
LOOKUP_SCHEMA = "Name string, Code string"


def read_lookup_csv(spark: SparkSession, path: str) -> DataFrame:
    """The ``Name,Code`` country list; ``NA`` (Namibia) stays text.

    Adds ``_pos`` (file order) for first-row tie breaks.
    """
    df = spark.read.option("header", True).option("nullValue", None).schema(LOOKUP_SCHEMA).csv(path)
    return df.withColumn("_pos", F.monotonically_increasing_id())


def read_cleansed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read an intermediate data set (column pruning reaches the scan)."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "jsonl":
        return spark.read.option("mode", "FAILFAST").json(path)
    raise ValueError(f"unknown intermediate format {fmt!r}")


def write_datasets(datasets: Mapping[str, DataFrame], folder: str, mode: str = "overwrite") -> dict[str, str]:
    """Write several data sets as Parquet folders (``overwrite`` or ``append``)."""
    out = {}
    for name, df in datasets.items():
        path = f"{folder.rstrip('/')}/{name}"
        df.write.mode(mode).parquet(path)
        out[name] = path
    return out


def land_parquet(df: DataFrame, path: str, partitions: int | None = None) -> str:
    """Land a parsed source once as Parquet, spread over ``partitions`` tasks."""
    if partitions:
        df = df.repartition(partitions)
    df.write.mode("overwrite").parquet(path)
    return path


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None, batch_size: int = 10_000) -> None:
    """Bulk append to a JDBC table in ``batch_size``-row batches (one connection per task)."""
    writer = df.write.mode("append").option("batchsize", batch_size)
    writer.jdbc(url, table, properties=dict(properties or {}))


def list_files(spark: SparkSession, glob: str) -> DataFrame:
    """Listing of files matching ``glob`` as a DataFrame (content is never read)."""
    return (
        spark.read.format("binaryFile")
        .load(glob)
        .select(F.col("path"), F.col("length"), F.col("modificationTime").alias("modified"))
    )


def unseen_files(listing: DataFrame, manifest: DataFrame, on: Iterable[str] = ("path",)) -> DataFrame:
    """Files in ``listing`` not yet recorded in ``manifest`` (anti join)."""
    return listing.join(manifest.select(*on).distinct(), list(on), "left_anti")
