"""Substring deduplication: a count-min prefilter, then exact grouping of the windows it leaves.

A window is ``WINDOW`` consecutive words of one document. Every word covered by
a window whose words also start earlier (at a smaller id, or earlier in the same
document) is removed; windows are judged on the input.

1. *Sketch.* Equal windows have equal smallest five-word grams at equal places,
   so a window repeats only if its smallest gram does. Each partition counts
   its chosen grams (about one in eight words) in a count-min sketch of
   ``ROWS`` rows; the partitions' sketches are merged block by block into bits
   "counted twice or more". Collisions only overestimate: no repeat is lost. The
   sketch has a fixed size; when a corpus outgrows it, more windows pass to the
   exact step and the result stays the same.
2. *Exact grouping.* Windows whose gram is estimated repeated are grouped by a
   96-bit hash of their words. Inside a batch of documents a window that
   already started earlier is settled at once, so a window with very many
   copies meets the others once per batch only. The groups are sorted runs that
   a task streams over, holding one row.
3. *Removal.* The settled starts go back to their documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epistar.llm.common import bounded_batches, sketch_block, table
from epistar.llm.tokens import chunks, gram_starts, grams, mix, words

WINDOW = 20
GRAM = 5
ROWS = 2
SLOTS = 1 << 26  # per row of the sketch; its bits are broadcast (8 MB a row)
BLOCKS = 64  # per row
FLUSH = 2_000_000
LOW = np.uint64((1 << 24) - 1)
LAST_ID = (1 << 63) - 1  # stands for a null id, after all others
SALTS = (np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9FB21C651E98DF25))


def slots_of(gram: np.ndarray, row: int) -> np.ndarray:
    return (mix(gram ^ SALTS[row]) >> np.uint64(38)).astype(np.int64)  # 26 bits


def smallest_grams(h: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """For each window start, its smallest gram (high 40 bits) and that gram's place (low 24 bits)."""
    g = grams(h, GRAM)
    key = (g & ~LOW) | (np.arange(len(g), dtype=np.uint64) & LOW)
    span, width = window - GRAM + 1, 1
    while width < span:
        step = min(width, span - width)
        key = np.minimum(key[: len(key) - step], key[step:])
        width += step
    return key[at]


def _sketch(docs: DataFrame, window: int) -> DataFrame:
    """Rows (block, cells): the partition's counted slots, each at most twice."""

    def rows_of(chosen: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        every = np.concatenate(chosen)
        per_block = SLOTS // BLOCKS
        for row in range(ROWS):
            s = np.sort(slots_of(every, row))
            s = s[np.concatenate([[True, True], s[2:] != s[:-2]])[: len(s)].astype(bool)]
            cuts = np.searchsorted(s, np.arange(BLOCKS + 1) * per_block)
            for b in range(BLOCKS):
                if cuts[b + 1] > cuts[b]:
                    yield sketch_block(row * BLOCKS + b, (s[cuts[b] : cuts[b + 1]] - b * per_block).astype(np.uint32))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, held = [], 0
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column("text")):
                h, by_doc = words(data, offsets)
                at, _ = gram_starts(by_doc, window)
                if not len(at):
                    continue
                key = smallest_grams(h, at, window)
                key = key[np.concatenate([[True], key[1:] != key[:-1]])]
                chosen.append(key >> np.uint64(24))
                held += len(key)
            if held > FLUSH:
                yield from rows_of(chosen)
                chosen, held = [], 0
        if chosen:
            yield from rows_of(chosen)

    return docs.select("text").mapInArrow(scan, "block int, cells binary")


def repeated_slots(docs: DataFrame, window: int) -> np.ndarray:
    """The merged sketch: one bit per slot, set when counted twice or more (ROWS * SLOTS bits)."""
    per_block = SLOTS // BLOCKS

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, cells in zip(batch.column("block").to_pylist(), batch.column("cells")):
                count = held.setdefault(block, np.zeros(per_block, np.uint8))
                slots, times = np.unique(np.frombuffer(cells.as_buffer(), np.uint32), return_counts=True)
                count[slots] = np.minimum(2, count[slots] + times)
        for block, count in held.items():
            yield sketch_block(block, np.packbits(count > 1))

    bits = np.zeros(ROWS * SLOTS // 8, np.uint8)
    size = per_block // 8
    merged = _sketch(docs, window).repartition(BLOCKS, "block").mapInArrow(merge, "block int, cells binary")
    for row in merged.collect():  # ROWS * SLOTS bits in all
        bits[row["block"] * size : (row["block"] + 1) * size] = np.frombuffer(row["cells"], np.uint8)
    return bits


def _rows(k, c, doc, at, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(k.view(np.int64)), pa.array(c, pa.int32()), pa.array(doc), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))],
        names=["k", "c", "doc", "at", "n"],
    )


ROW = "k long, c int, doc long, at int, n int"
SETTLED = -1  # in c: these n starts from ``at`` are removed already


def spans(doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, first, length) of runs of neighbouring starts; sorted input."""
    if not len(doc):
        return doc, at, at
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + 1)])
    first = np.flatnonzero(new)
    return doc[first], at[first], np.diff(np.concatenate([first, [len(doc)]]))


def _candidates(docs: DataFrame, shared, window: int) -> DataFrame:
    def estimated_repeated(key: np.ndarray, bits: np.ndarray) -> np.ndarray:
        gram = key >> np.uint64(24)
        ok = np.ones(len(gram), dtype=bool)
        for row in range(ROWS):
            s = slots_of(gram, row) + row * SLOTS
            ok &= (bits[s >> 3] >> (7 - (s & 7)).astype(np.uint8) & 1).astype(bool)
        return ok

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            ids = batch.column("id").fill_null(LAST_ID).to_numpy(zero_copy_only=False)
            ks, cs, docs_, ats = [], [], [], []
            for lo, hi, data, offsets in chunks(batch.column("text")):
                h, by_doc = words(data, offsets)
                at, of_doc = gram_starts(by_doc, window)
                if not len(at):
                    continue
                doc = np.repeat(np.arange(lo, hi), np.diff(of_doc))
                keep = np.flatnonzero(estimated_repeated(smallest_grams(h, at, window), bits))
                at, doc = at[keep], doc[keep]
                ks.append(grams(h, window)[at])
                cs.append((grams(mix(h ^ SALTS[1]), window)[at] >> np.uint64(34)).astype(np.int32))
                docs_.append(ids[doc])
                ats.append(at - by_doc[doc - lo])
            if not ks:
                continue
            k, c, doc, at = (np.concatenate(x) for x in (ks, cs, docs_, ats))
            by = np.lexsort((at, doc, c, k))
            k, c, doc, at = k[by], c[by], doc[by], at[by]
            again = _later(k, c, doc, at)
            yield _rows(k[~again], c[~again], doc[~again], at[~again], np.ones(int((~again).sum()), np.int64))
            if again.any():
                d, a = doc[again], at[again]
                by = np.lexsort((a, d))
                d, a, n = spans(d[by], a[by])
                yield _rows(mix(d.view(np.uint64)), np.full(len(d), SETTLED, np.int32), d, a, n)

    return docs.mapInArrow(scan, ROW)


def _later(k: np.ndarray, c: np.ndarray, doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of a sorted run whose window starts earlier too (equal ids and places are the same start)."""
    same = np.concatenate([[False], (k[1:] == k[:-1]) & (c[1:] == c[:-1])]) if len(k) else np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(k))))
    return same & ((doc != doc[first]) | (at != at[first]))


def _removed(candidates: DataFrame) -> DataFrame:
    """(doc, at, n): runs of window starts that are repeats."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = None
        for batch in batches:
            k, c, doc, at, n = (np.asarray(x) for x in batch.columns)
            if head is not None:  # the first row of the group that the last batch ended in
                k, c, doc, at, n = (np.concatenate([[h], x]) for h, x in zip(head, (k, c, doc, at, n)))
            settled = c == SETTLED
            later = _later(k, c, doc, at) & ~settled
            gone = settled | later
            if head is not None:
                gone[0] = False
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[gone]), pa.array(at[gone].astype(np.int32)), pa.array(n[gone].astype(np.int32))], names=["doc", "at", "n"]
            )
            same = np.concatenate([[False], (k[1:] == k[:-1]) & (c[1:] == c[:-1]) & ~settled[1:]])
            i = int(np.maximum.accumulate(np.where(same, 0, np.arange(len(k))))[-1])
            head = None if settled[i] else tuple(x[i] for x in (k, c, doc, at, n))

    return candidates.repartition("k").sortWithinPartitions("k", "c", "doc", "at").mapInArrow(stream, "doc long, at int, n int")


def dedupe_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: id, n_words, n_removed, text (the kept words, joined by one space).

    Null texts have no words. A null id comes after all others. Rows with equal
    ids count as one document: the same start in both is no repeat, and what
    is removed from one is removed from the other at the same places.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    shared = spark.sparkContext.broadcast(repeated_slots(slim, window))
    gone = _removed(_candidates(slim, shared, window))
    # a document's removed starts are at most its words
    covers = gone.groupBy("doc").agg(F.collect_list(F.struct("at", "n")).alias("gone"))
    joined = slim.withColumn("doc", F.coalesce("id", F.lit(LAST_ID))).join(covers, "doc", "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, texts = [], [], []
            for text, gone_ in zip(batch.column("text").to_pylist(), batch.column("gone")):
                w = (text or "").encode().split()
                n_words.append(len(w))
                if gone_.is_valid:
                    at, n = (gone_.values.field(k).to_numpy() for k in range(2))
                    change = np.zeros(len(w) + 1, np.int64)
                    ok = at < len(w)
                    np.add.at(change, at[ok], 1)
                    np.add.at(change, np.minimum(at + n + window - 1, len(w))[ok], -1)
                    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()
                    n_removed.append(len(w) - len(kept))
                    texts.append(b" ".join([w[i] for i in kept]))
                else:
                    n_removed.append(0)
                    texts.append(b" ".join(w))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())],
                names=["id", "n_words", "n_removed", "text"],
            )

    out = joined.select("id", "text", "gone").mapInArrow(cut, "id long, n_words long, n_removed long, text string")
    return out.withColumnRenamed("id", id_col)


def op4_substring_dedup(spark, sf_dir: str) -> DataFrame:
    kept = dedupe_substrings(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
