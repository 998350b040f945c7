"""Exact centroid clustering with norm-of-sum (ns) bounds.

Lloyd's rounds over integer vectors. A vector keeps its nearest centroid and, for
every centroid, the distance of its last evaluation and the round of that. The history of all centroids
is kept too, so at a later round a bound loosens by the norm of the centroid's
*total* displacement since that evaluation (never more than the sum of its
drifts round by round, and less where a centroid turns back). If the nearest
centroid's upper bound is below every other one's lower bound, the assignment
stands without a distance. A vector that fails is scanned again, exactly: its
nearest centroid first, then all whose lower bounds are not above that.

Each round is one pass over the state table, whose tasks send a sum a
cluster and component to Spark's own aggregation; 8 x 64 sums reach the driver. As
bounds start from the last evaluation whichever round that was, a round needs no new state:
the table is written again (to the shared folder, the superseded one is removed) only when a round took more than
``REFRESH`` of the distances of a full scan. History and centroids are rounds x clusters x components numbers.

All arithmetic that decides is on integers. Bounds are doubles, and count as
apart only by more than ``SLACK`` of their size, far above their rounding.

Defined cases: rows whose vector is null, of another length, or holds a null or a non-finite component are left
out; a null id is hashed as the empty text; repeated rows count as often as they
occur; components beyond ``+-2^27`` after scaling are set to that, so that distances fit a long;
with fewer vectors than clusters there are as many centroids as vectors; ties go to the
smaller number, in the start to the smaller vector; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epistar.llm.common import bounded_batches, table
from epistar.session import cut_lineage

DIMS = 64
CLUSTERS = 8
ROUNDS = 10
SEED = 3
SCALE = 1024
LIMIT = 1 << 27
REFRESH = 0.3
SLACK = 1e-9
STATE = "vec_id {id}, v array<int>, seen array<int>, nearest int, d array<long>"


def integer_vectors(rows: DataFrame, id_col: str, vec_col: str, dims: int = DIMS) -> DataFrame:
    """Kept rows as (vec_id, v): floor(SCALE * x) of every component."""
    vec = F.col(f"`{vec_col}`")
    whole = F.size(vec) == dims
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != F.lit(float("inf"))))
    kept = rows.select(F.col(f"`{id_col}`").alias("vec_id"), vec.alias("x"), F.coalesce(whole & fine, F.lit(False)).alias("ok")).where("ok")
    clip = lambda x: F.greatest(F.lit(-1.0 * LIMIT), F.least(F.lit(1.0 * LIMIT), F.floor(x).cast("double")))
    near = lambda x: F.greatest(F.lit(-2.0 * LIMIT), F.least(F.lit(2.0 * LIMIT), x))
    scaled = F.transform("x", lambda x: clip(near(x.cast("double") * SCALE)).cast("int"))
    return kept.select("vec_id", scaled.alias("v"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors with the smallest hash of ``seed:id``, in its order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("h"), "v").orderBy("h", "v").limit(clusters).collect()
    return np.array([r["v"] for r in rows], dtype=np.int64)


def distance(x: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors from one centroid."""
    diff = x - centroid
    return np.einsum("ij,ij->i", diff, diff)


def assign(x: np.ndarray, seen: np.ndarray, nearest: np.ndarray, d: np.ndarray, history: np.ndarray) -> int:
    """Brings ``nearest``, ``seen`` and ``d`` up to the last round of ``history``, in place; returns the distances it took.

    ``seen`` and ``d`` are (rows, centroids): the round of each distance's last evaluation (-1: none) and the distance then.
    A row whose bounds stay apart is not touched. Otherwise its nearest centroid is measured, and then those whose
    lower bounds are not above that distance; the others cannot be nearer.
    """
    now, k = len(history) - 1, history.shape[1]
    moved = np.sqrt(((history[now][None].astype(np.float64) - history.astype(np.float64)) ** 2).sum(axis=2))  # (round, centroid)
    at = np.arange(len(x))
    away = moved[np.maximum(seen, 0), np.arange(k)]
    root = np.sqrt(d.astype(np.float64))
    lower = np.where(seen >= 0, (root - away) * (1 - SLACK), -np.inf)
    upper = np.where(seen[at, nearest] >= 0, (root + away)[at, nearest] * (1 + SLACK), np.inf)
    others = np.arange(k) != nearest[:, None]
    failed = np.flatnonzero((others & (lower <= upper[:, None])).any(axis=1))
    taken = 0

    def measure(rows: np.ndarray, j: int) -> None:
        nonlocal taken
        rows = rows[seen[rows, j] != now]
        d[rows, j] = distance(x[rows], history[now][j])
        seen[rows, j] = now
        taken += len(rows)

    for j in range(k):
        measure(failed[nearest[failed] == j], j)
    upper = np.sqrt(d[failed, nearest[failed]].astype(np.float64)) * (1 + SLACK)
    for j in range(k):
        measure(failed[others[failed, j] & (lower[failed, j] <= upper)], j)
    exact = np.where(seen[failed] == now, d[failed], np.iinfo(np.int64).max)
    nearest[failed] = exact.argmin(axis=1)
    return taken


def _columns(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, ...]:
    """(v, seen, nearest, d) of a batch as arrays that may be written to; without state nothing is known."""
    n = batch.num_rows
    x = np.asarray(batch.column("v").flatten(), dtype=np.int64).reshape(n, -1)
    if "seen" not in batch.schema.names:
        return x, np.full((n, k), -1, dtype=np.int32), np.zeros(n, dtype=np.int32), np.zeros((n, k), dtype=np.int64)
    lists = [np.array(batch.column(c).flatten(), dtype=t).reshape(n, k) for c, t in (("seen", np.int32), ("d", np.int64))]
    return x, lists[0], np.array(batch.column("nearest"), dtype=np.int32), lists[1]


def _lists(values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32), pa.array(values.ravel()))


def round_sums(state: DataFrame, history: np.ndarray) -> tuple[np.ndarray, list, int]:
    """(counts, sums by cluster, distances taken) of one assignment round, the sums as Python integers."""
    k, dims = history.shape[1:]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, taken = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64), 0
        for batch in batches:
            if batch.num_rows:
                x, seen, nearest, d = _columns(batch, k)
                taken += assign(x, seen, nearest, d, history)
                for j in range(k):
                    rows = nearest == j
                    counts[j] += rows.sum()
                    sums[j] += x[rows].sum(axis=0)
        cells = np.concatenate([sums.ravel(), counts, [taken]])
        yield pa.RecordBatch.from_pydict({"cell": np.arange(len(cells), dtype=np.int32), "n": cells})

    cells = state.mapInArrow(part, "cell int, n long").groupBy("cell").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect()
    flat = [0] * (k * dims + k + 1)
    for r in cells:
        flat[r["cell"]] = int(r["n"] or 0)
    sums = [flat[j * dims : (j + 1) * dims] for j in range(k)]
    return np.array(flat[k * dims : -1], dtype=object), sums, flat[-1]


def next_centroids(centroids: np.ndarray, counts, sums) -> np.ndarray:
    """Componentwise floor of the means; an empty cluster keeps its centroid."""
    out = centroids.copy()
    for j, n in enumerate(counts):
        if n:
            out[j] = [s // int(n) for s in sums[j]]
    return out


def refreshed(state: DataFrame, history: np.ndarray) -> DataFrame:
    """The state as of the last round of ``history``, written to the shared folder."""
    k = history.shape[1]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, seen, nearest, d = _columns(batch, k)
                assign(x, seen, nearest, d, history)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("v"), _lists(seen), pa.array(nearest), _lists(d)], names=["vec_id", "v", "seen", "nearest", "d"])

    return cut_lineage(state.mapInArrow(part, STATE.format(id=state.schema["vec_id"].dataType.simpleString())))


def drop_table(spark: SparkSession, frame: DataFrame) -> None:
    """Remove the files of a written table that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for name in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cluster(
    rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = DIMS, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED,
    refresh: float = REFRESH, report: list | None = None,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every kept vector, and the final centroids.

    ``report`` receives (round, distances taken, distances of a full scan) of each round.
    """
    spark = rows.sparkSession
    bounded_batches(spark)
    state = cut_lineage(integer_vectors(rows, id_col, vec_col, dims))
    start = first_centroids(state, clusters, seed)
    if not len(start):
        id_type = state.schema["vec_id"].dataType.simpleString()
        return spark.createDataFrame([], f"vec_id {id_type}, cluster int, distance long"), start
    history = [start]
    for k in range(rounds + 1):
        seen = np.stack(history)
        if k == rounds:
            break
        counts, sums, taken = round_sums(state, seen)
        full = int(counts.sum()) * len(start)
        if report is not None:
            report.append((k, taken, full))
        if taken > refresh * full:
            old, state = state, refreshed(state, seen)
            drop_table(spark, old)
        history.append(next_centroids(history[-1], counts, sums))
    final = np.stack(history)
    k_final = len(start)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, seen, nearest, d = _columns(batch, k_final)
                assign(x, seen, nearest, d, final)
                diff = x - final[-1][nearest]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(nearest), pa.array(np.einsum("ij,ij->i", diff, diff))], names=["vec_id", "cluster", "distance"])

    id_type = state.schema["vec_id"].dataType.simpleString()
    return cut_lineage(state.mapInArrow(part, f"vec_id {id_type}, cluster int, distance long")), history[-1]


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all kept ``embeddings`` with their inertia and a digest of each final centroid; no vectors, no rows."""
    found, centroids = cluster(table(spark, sf_dir, "embeddings"))
    digests = [hashlib.sha256(",".join(str(int(c)) for c in row).encode()).hexdigest() for row in centroids]
    # one row a cluster
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    by_cluster = {r["cluster"]: int(r["s"]) for r in sums}
    sides = [(j, by_cluster.get(j, 0), sum(by_cluster.values()), h) for j, h in enumerate(digests)]
    side = spark.createDataFrame(sides, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(side), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
