"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased and what is no letter becomes one blank. Features are the
hashed one- to three-letter grams, as term frequency times inverse document
frequency. Document frequencies are counted over all learning documents, whole.

The regression learns by per-coordinate FTRL-proximal updates with elastic-net
penalties from at most ``PER_LANGUAGE`` documents of each language and
``TRAIN_DOCS`` in all (documented bounds of the sample, in hash order of the id; with very
many languages ``LEAST_DOCS`` of each instead). Every language is learned. A fifth of the sample is kept from the updates
and sets the temperature that calibrates the probabilities.

Prediction is one pass over whole texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epistar.llm.common import bounded_batches, merge_sketches, sketch_rows, table
from epistar.llm.quality_model import fold
from epistar.llm.tokens import mix

DIM = 1 << 16
PER_LANGUAGE = 800
CELLS = 64  # hash cells of a language, each cut to the sample before they meet
TRAIN_DOCS = 6000
LEAST_DOCS = 10
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.01, 0.01
SCALE = 20.0  # of a text's term frequencies, which sum to one
CHUNK_CHARS = 400_000
NO_LETTER = "und"


def letter_table(codes: np.ndarray) -> np.ndarray:
    """Code points with everything but letters set to a blank."""
    values, back = np.unique(codes, return_inverse=True)
    keep = np.array([chr(v).isalpha() for v in values.tolist()], dtype=bool)
    return np.where(keep, values, 32).astype(np.uint64)[back]


def gram_features(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first, end, feature numbers, their document, letters by document) for consecutive texts."""
    lo = 0
    while lo < len(texts):
        hi, held = lo, 0
        while hi < len(texts) and (hi == lo or held + len(texts[hi] or "") <= CHUNK_CHARS):
            held += len(texts[hi] or "")
            hi += 1
        lower = [(t or "").lower() for t in texts[lo:hi]]
        codes = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        doc = np.repeat(np.arange(hi - lo), [len(t) for t in lower])
        c = letter_table(codes) if len(codes) else np.zeros(0, np.uint64)
        blank = c == 32
        keep = ~blank
        keep[1:] |= blank[1:] & ~blank[:-1]  # the first blank of a run
        c, doc = c[keep], doc[keep]
        letters = np.bincount(doc[c != 32], minlength=hi - lo)
        two, three = doc[1:] == doc[:-1], doc[2:] == doc[:-2]
        a = c * np.uint64(0x1000003)
        b = a[:-1] * np.uint64(0x1000193) + c[1:]
        t = b[:-1] * np.uint64(0x1000193) + c[2:]
        keys = np.concatenate([mix(a[c != 32]), mix(b[two] + np.uint64(1)), mix(t[three] + np.uint64(2))])
        yield lo, hi, (keys >> np.uint64(48)).astype(np.int64), np.concatenate([doc[c != 32], doc[1:][two], doc[2:][three]]), letters
        lo = hi


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """(documents by feature, documents), over all rows of ``docs`` (text)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(DIM, np.int64)
        for batch in batches:
            for lo, hi, keys, doc, _ in gram_features(batch.column("text").to_pylist()):
                ends = np.cumsum(np.bincount(doc, minlength=hi - lo))
                keys = keys[np.argsort(doc, kind="stable")]
                for part in np.split(keys, ends[:-1]):
                    seen = np.zeros(DIM, bool)
                    seen[part] = True
                    df += seen
        yield sketch_rows(df, 8)

    flat = merge_sketches(docs.select("text").mapInArrow(scan, "block int, cells binary"), 8, "int64", np.add, lambda x: x.view(np.uint8))
    return (flat.view(np.int64) if len(flat) else np.zeros(DIM, np.int64)), docs.count()


def fit_multinomial(rows: list[tuple[np.ndarray, np.ndarray, int]], k: int, epochs: int = EPOCHS, seed: int = 3) -> np.ndarray:
    """Weights (DIM + 1, k) by FTRL; the last row is the bias."""
    z, n = np.zeros((DIM + 1, k)), np.zeros((DIM + 1, k))

    def solve(zi, ni):
        return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, x, y = rows[i]
            at, x = np.append(at, DIM), np.append(x, 1.0)
            w = solve(z[at], n[at])
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1
            g = x[:, None] * p
            root = np.sqrt(n[at])
            n[at] += g * g
            z[at] += g - (np.sqrt(n[at]) - root) / ALPHA * w
    return solve(z, n)


def temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the scores with the least held-back log loss."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        s = scores / t
        s = s - s.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]))

    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 81))
    return float(grid[int(np.argmin([loss(t) for t in grid]))])


def train(learn: DataFrame) -> tuple[list[str], np.ndarray, float]:
    """(languages, weights with idf and calibration folded in, none if there is no language)."""
    langs = sorted(r["lang"] for r in learn.select("lang").distinct().collect())
    if not langs:
        return [], np.zeros((DIM + 1, 0), np.float32), 1.0
    df, n_docs = document_frequencies(learn)
    idf = np.log((1 + n_docs) / (1 + df)) + 1
    slim = learn.select("id", "lang", F.xxhash64("id", "text").alias("h"))
    # a language may hold most rows: cells of it are cut first, so at most CELLS * PER_LANGUAGE rows of one meet
    by_cell = Window.partitionBy("lang", F.pmod("h", F.lit(CELLS))).orderBy("h", "id")
    slim = slim.withColumn("r", F.row_number().over(by_cell)).where(F.col("r") <= PER_LANGUAGE).drop("r")
    by_hash = Window.partitionBy("lang").orderBy("h", "id")
    picked = slim.withColumn("r", F.row_number().over(by_hash)).where(F.col("r") <= PER_LANGUAGE)
    picked = picked.orderBy("r", "lang", "h", "id").limit(max(TRAIN_DOCS, LEAST_DOCS * len(langs))).select(F.col("h").alias("p_h"), F.col("lang").alias("p_lang")).distinct()
    # at most TRAIN_DOCS hashes, or LEAST_DOCS a language
    sample = learn.join(F.broadcast(picked), (F.xxhash64("id", "text") == F.col("p_h")) & (F.col("lang") == F.col("p_lang")))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            lang, ids = batch.column("lang").to_pylist(), batch.column("id").to_pylist()
            for lo, hi, keys, doc, letters in gram_features(batch.column("text").to_pylist()):
                for d in np.flatnonzero(letters).tolist():
                    at, count = np.unique(keys[doc == d], return_counts=True)
                    out.append((at.astype(np.int32).tobytes(), (count / count.sum()).astype(np.float32).tobytes(), lang[lo + d], ids[lo + d]))
            if out:
                a, x, y, i = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(x), pa.array(y), pa.array(i, pa.int64())], names=["a", "x", "lang", "id"])

    # repeated rows are learned once, so what reaches the driver has the bound of the picked hashes
    found = sample.select("id", "text", "lang").mapInArrow(scan, "a binary, x binary, lang string, id long").distinct().collect()
    found.sort(key=lambda r: (r["id"] is None, r["id"] or 0, r["lang"], bytes(r["a"]), bytes(r["x"])))
    number = {x: i for i, x in enumerate(langs)}
    rows = []
    for r in found:
        at = np.frombuffer(r["a"], np.int32).astype(np.int64)
        rows.append((at, np.frombuffer(r["x"], np.float32) * idf[at] * SCALE, number[r["lang"]]))
    # a language with few documents needs them all to be learned
    size = np.bincount([y for *_, y in rows], minlength=len(langs))
    apart = [i % 5 == 4 and size[y] >= 5 for i, (*_, y) in enumerate(rows)]
    held = [r for r, x in zip(rows, apart) if x]
    weights = fit_multinomial([r for r, x in zip(rows, apart) if not x], len(langs))
    scores = np.array([x @ weights[at] + weights[DIM] for at, x, _ in held]).reshape(len(held), len(langs))
    t = temperature(scores, np.array([y for _, _, y in held], dtype=int))
    weights[:DIM] *= (idf * SCALE)[:, None]
    return langs, (weights / t).astype(np.float32), t


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: id, held_out, lang_pred, score (the calibrated probability).

    Texts that are null or without a letter are ``und`` with score 0. Rows with
    a null language teach nothing; a null id belongs to the learning fold. If
    nothing can be learned, all are ``und``.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    learn = slim.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("id"), 4) != 2))
    shared = spark.sparkContext.broadcast(train(learn))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, weights, _ = shared.value
        names = np.array([*langs, NO_LETTER], dtype=object)
        for batch in batches:
            best, score = np.full(batch.num_rows, len(langs)), np.zeros(batch.num_rows)
            if langs:
                for lo, hi, keys, doc, letters in gram_features(batch.column("text").to_pylist()):
                    total = np.maximum(1, np.bincount(doc, minlength=hi - lo))
                    s = np.stack([np.bincount(doc, weights[:, j][keys], hi - lo) for j in range(len(langs))], axis=1) / total[:, None] + weights[DIM]
                    p = np.exp(s - s.max(axis=1, keepdims=True))
                    p /= p.sum(axis=1, keepdims=True)
                    has = letters > 0
                    best[lo:hi] = np.where(has, p.argmax(axis=1), len(langs))
                    score[lo:hi] = np.where(has, p.max(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(names[best].tolist(), pa.string()), pa.array(score)], names=["id", "lang_pred", "score"]
            )

    scored = slim.select("id", "text").mapInArrow(scan, "id long, lang_pred string, score double")
    return scored.select(F.col("id").alias(id_col), (fold(F.col("id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
