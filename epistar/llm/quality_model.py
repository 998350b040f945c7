"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

Tokens are words and runs of punctuation. Features are the hashed tokens, pairs
of neighbouring tokens (a repeated token pairs as "again") and triples of token
shapes (lower, title, capitals, digits, marks), counted and divided by the root
of the token count. A score is the sparse dot product of these with the weights,
through the logistic function.

Training reads a sample of at most ``TRAIN_DOCS`` labelled rows (a documented
bound; taken in hash order of the id, the two labels alike as far as they go)
and makes ``EPOCHS`` passes of per-coordinate FTRL-proximal updates. Scoring covers
every text whole, in one pass without a shuffle; the model is a fixed-size array.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epistar.llm.common import bounded_batches, table
from epistar.llm.tokens import BLANK, P_WORD, chunks, hash_runs, mix, runs

DIM = 1 << 18
TRAIN_DOCS = 6000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.02
SEED = 5
# ASCII classes of bytes; bytes above 127 belong to letters.
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
WORDY = DIGIT.copy()
WORDY[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
AGAIN = np.uint64(0xA5A5A5A5A5A5A5A5)


def token_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature numbers, their document, tokens by document) for a chunk of texts."""
    word, mark = WORDY[data], ~WORDY[data] & ~BLANK[data]
    ws, we, _ = runs(word, offsets)
    ms, me, _ = runs(mark, offsets)
    starts, ends = np.concatenate([ws, ms]), np.concatenate([we, me])
    by = np.argsort(starts, kind="stable")
    starts, ends = starts[by], ends[by]
    is_mark = by >= len(ws)
    by_doc = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.diff(by_doc)
    h = hash_runs(data, starts, ends)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(by_doc))
    caps = np.concatenate([[0], np.cumsum(UPPER[data])])
    nums = np.concatenate([[0], np.cumsum(DIGIT[data])])
    size = ends - starts
    n_caps, n_nums = caps[ends] - caps[starts], nums[ends] - nums[starts]
    shape = np.where(is_mark, 4, np.where(n_nums > 0, 3, np.where((n_caps == size) & (size > 1), 2, np.where(n_caps > 0, 1, 0))))
    shape = np.where(is_mark, 4 + data[starts].astype(np.int64), shape).astype(np.uint64)
    two = doc[1:] == doc[:-1]
    pair = np.where(h[1:] == h[:-1], AGAIN, h[:-1] * P_WORD + h[1:])
    three = doc[2:] == doc[:-2]
    triple = (shape[:-2] * np.uint64(300) + shape[1:-1]) * np.uint64(300) + shape[2:]
    keys = np.concatenate([h, mix(pair[two] + np.uint64(1)), mix(triple[three] + np.uint64(2))])
    return (keys % np.uint64(DIM)).astype(np.int64), np.concatenate([doc, doc[1:][two], doc[2:][three]]), np.diff(by_doc)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, seed: int = SEED) -> tuple[np.ndarray, float]:
    """(weights, bias) from rows (feature numbers, values, label)."""
    z, n, w = np.zeros(DIM), np.zeros(DIM), np.zeros(DIM)
    bias, bias_n = 0.0, 1.0
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, x, y = rows[i]
            zi = z[at]
            wi = np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))
            p = 1 / (1 + np.exp(-np.clip(wi @ x + bias, -35, 35)))
            g = (p - y) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * wi
            n[at] += g * g
            bias -= ALPHA * (p - y) / np.sqrt(bias_n)
            bias_n += (p - y) ** 2
    w = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    return w.astype(np.float32), float(bias)


def fold(id_col: Column, k: int) -> Column:
    """crc32 of the id as text, modulo k (a null id: 0)."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string")), F.lit(k)), F.lit(0))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Feature rows of the bounded training sample, one an id: ``TRAIN_DOCS`` at most, however often an id occurs."""
    known = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & (fold(F.col(id_col), 3) != 1))
        .groupBy(F.col(id_col).alias("l_id")).agg(F.min(label_col).cast("int").alias("y"))
    )
    of_label = lambda y: known.where(F.col("y") == y).orderBy(F.xxhash64("l_id"), "l_id").limit(TRAIN_DOCS // 2)
    picked = of_label(0).unionByName(of_label(1))
    # at most TRAIN_DOCS ids
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), F.col("id") == F.col("l_id"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            y = batch.column("y").to_pylist()
            for lo, hi, data, offsets in chunks(batch.column("text")):
                keys, doc, tokens = token_features(data, offsets)
                for d in range(hi - lo):
                    at, count = np.unique(keys[doc == d], return_counts=True)
                    x = (count / np.sqrt(max(1, tokens[d]))).astype(np.float32)
                    out.append((at.astype(np.int32).tobytes(), x.tobytes(), y[lo + d], batch.column("id")[lo + d].as_py()))
            if out:
                a, x, y_, i = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(x), pa.array(y_, pa.int32()), pa.array(i, pa.int64())], names=["a", "x", "y", "id"])

    found = sample.select(F.col("id").cast("long").alias("id"), "text", "y").mapInArrow(scan, "a binary, x binary, y int, id long")
    # of rows that share an id one is learned, so what reaches the driver has the bound of the ids
    rows = [r["r"] for r in found.groupBy("id").agg(F.min(F.struct("id", "a", "x", "y")).alias("r")).collect()]
    rows.sort(key=lambda r: r["id"])  # reruns see one order
    return [(np.frombuffer(r["a"], np.int32).astype(np.int64), np.frombuffer(r["x"], np.float32).astype(float), r["y"]) for r in rows]


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """One row per document: id, held_out, score, predicted.

    Null and empty texts get the model's bias. Labels other than 0 and 1 and
    null ids teach nothing; of several labels of an id the smallest counts.
    Without any label the score is 0.5.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(fit_ftrl(training_rows(docs, labels, id_col, text_col, label_col)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        for batch in batches:
            total = np.zeros(batch.num_rows)
            for lo, hi, data, offsets in chunks(batch.column("text")):
                keys, doc, tokens = token_features(data, offsets)
                total[lo:hi] = np.bincount(doc, weights[keys], hi - lo) / np.sqrt(np.maximum(1, tokens))
            score = 1 / (1 + np.exp(-np.clip(total + bias, -35, 35)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["id", "score", "predicted"]
            )

    scored = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        scan, "id long, score double, predicted int"
    )
    return scored.select(F.col("id").alias(id_col), (fold(F.col("id"), 3) == 1).alias("held_out"), "score", "predicted")


def op7_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
