"""Benchmark decontamination: BM25 over test items, searched with block-max bounds.

The test items are the indexed side; every passage of every training text is a
query against them. A text's passages are windows of two neighbouring strides
of ``STRIDE`` words, so any run of up to ``STRIDE`` words lies whole in one.

An item of more than ``STRIDE`` words is indexed whole and as overlapping
sections of ``STRIDE`` words, as one passage may not hold enough of it; an item
is retrieved by any of its units and scores as its best one. A unit's BM25 score
for a passage is divided by the score the unit gets for its own text, so one
threshold fits short and long ones: 1 means that all the unit's words are
there. Search skips as block-max WAND does and never loses an
item above the threshold. Frequent terms, as long as they give no item more
than ``COMMON_SHARE`` of the threshold, are not followed: an item's sum over them is
known beforehand and bounds what they can add. (In the search, ``item`` stands
for such a unit.)

1. The other terms of a passage add up their largest weight in each block of
   ``BLOCK_ITEMS`` items; with the block's bound for frequent terms, most blocks
   stay below the threshold and are skipped.
2. The items of the remaining blocks are scored over all terms.

Retrieved items are verified on the whole text: an item's question is its text
up to the last sentence and its answer the last sentence (an item of one
sentence is halved). Both must be found, in ``MATCH_WORDS``-word runs: at least
``MIN_QUESTION`` of the question's and ``MIN_ANSWER`` of the answer's runs.

Words are runs of letters and digits in lower case. The index is broadcast in
slices of about ``INDEX_ITEMS`` units, each of which reads the texts once; an
index of a test suite is one slice. Document frequencies and the mean length
are those of all items, whatever their slice.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epistar.llm.common import bounded_batches, free_name, table
from epistar.llm.tokens import chunks, grams, hash_runs, ranges, runs

STRIDE = 64
BLOCK_ITEMS = 8
THRESHOLD = 0.5
COMMON_SHARE = 0.6
MATCH_WORDS = 4
MIN_QUESTION = 0.6
MIN_ANSWER = 0.5
INDEX_ITEMS = 20_000
K1, B = 1.2, 0.75
# ASCII letters and digits; all bytes of longer UTF-8 sequences count as letters.
WORD_BYTE = np.zeros(256, dtype=bool)
WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, by_doc = runs(WORD_BYTE[data], offsets)
    return hash_runs(data, starts, ends), by_doc


def lowered(column: pa.Array) -> pa.Array:
    return pa.array([x.lower() if x else "" for x in column.to_pylist()], pa.large_string())


def split_item(text: str) -> tuple[str, str]:
    """(question, answer): all but the last sentence, and the last sentence."""
    parts = [x for x in re.split(r"(?<=[.!?])\s+|\n+", text.strip()) if re.search(r"\w", x)]
    if len(parts) > 1:
        return " ".join(parts[:-1]), parts[-1]
    words = text.split()
    return " ".join(words[: (len(words) + 1) // 2]), " ".join(words[(len(words) + 1) // 2 :])


def match_runs(h: np.ndarray) -> np.ndarray:
    """Hashes of a part's word runs (one of all its words if it is shorter)."""
    return np.unique(grams(h, min(MATCH_WORDS, len(h)))) if len(h) else np.zeros(0, np.uint64)


class Index(NamedTuple):
    """BM25 weights of one slice of items, sorted by term."""

    ids: np.ndarray  # item ids
    unit_of: np.ndarray  # by unit: item number
    terms: np.ndarray  # sorted term hashes
    slots: np.ndarray  # bit per slot: some term falls there
    followed: np.ndarray  # by term: not one of the frequent terms
    common: np.ndarray  # by block: most that the frequent terms give one of its items
    block_first: np.ndarray  # by term: offsets into its blocks
    blocks: np.ndarray
    block_best: np.ndarray  # largest weight of the term in the block
    keys: np.ndarray  # postings by term * blocks + block
    items: np.ndarray
    weights: np.ndarray
    parts: list  # by item: (question runs, answer runs, their lengths in words)


SLOTS = 1 << 20


class Counts(NamedTuple):
    """What all items together give to the weights of each."""

    n: int
    words: int
    terms: np.ndarray  # sorted
    df: np.ndarray


def item_words(text: str) -> np.ndarray:
    _, _, data, offsets = next(chunks(pa.array([text.lower()], pa.large_string())))
    return word_hashes(data, offsets)[0]


def count_items(rows: list[tuple[int, str]], before: Counts | None = None) -> Counts:
    """The counts of items (id, text), added to those of the slices before."""
    held = [h for h in (item_words(text) for _, text in rows) if len(h)]
    n, words, terms, df = before or Counts(0, 0, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    every = np.concatenate([terms, *[np.unique(h) for h in held]])
    added = np.concatenate([df, np.ones(len(every) - len(df), np.int64)])
    terms, at = np.unique(every, return_inverse=True)
    return Counts(n + len(held), words + sum(map(len, held)), terms, np.bincount(at, added, len(terms)).astype(np.int64))


def units(h: np.ndarray) -> list[np.ndarray]:
    """A whole item and, if it is longer than a stride, its sections of one stride, half a stride apart."""
    if len(h) <= STRIDE:
        return [h]
    starts = [*range(0, len(h) - STRIDE, STRIDE // 2), len(h) - STRIDE]
    return [h, *[h[a : a + STRIDE] for a in starts]]


def build_index(rows: list[tuple[int, str]], counts: Counts | None = None) -> Index | None:
    """Index items (id, text), weighted by ``counts`` (of these items if None); items without a word are left out."""
    counts = counts or count_items(rows)
    ids, tfs, unit_of, parts = [], [], [], []
    for item, text in rows:
        h = item_words(text)
        if not len(h):
            continue
        found = []
        for part in split_item(text.lower()):
            raw = np.frombuffer(part.encode(), dtype=np.uint8)
            ph, _ = word_hashes(raw, np.array([0, len(raw)]))
            found += [match_runs(ph), min(MATCH_WORDS, len(ph))]
        for unit in units(h):
            tfs.append(np.unique(unit, return_counts=True))
            unit_of.append(len(ids))
        ids.append(item)
        parts.append(tuple(found))
    if not ids:
        return None
    lengths = np.array([c.sum() for _, c in tfs], dtype=float)
    owner = np.repeat(np.arange(len(tfs)), [len(t) for t, _ in tfs])
    every, tf = np.concatenate([t for t, _ in tfs]), np.concatenate([c for _, c in tfs]).astype(float)
    terms, at, held = np.unique(every, return_inverse=True, return_counts=True)
    df = counts.df[np.searchsorted(counts.terms, terms)]
    idf = np.log(1 + (counts.n - df + 0.5) / (df + 0.5))
    weight = idf[at] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[owner] * counts.n / counts.words))
    weight /= np.bincount(owner, weight, len(tfs))[owner]  # a unit scores 1 for its own text
    by = np.lexsort((owner, at))
    at, owner, weight = at[by], owner[by], weight[by]
    n_blocks = (len(tfs) + BLOCK_ITEMS - 1) // BLOCK_ITEMS
    followed = np.ones(len(terms), dtype=bool)
    common = np.zeros(len(tfs))
    begin = np.concatenate([[0], np.cumsum(held)])
    for t in np.argsort(-held, kind="stable").tolist():
        more = common.copy()
        more[owner[begin[t] : begin[t + 1]]] += weight[begin[t] : begin[t + 1]]
        if held[t] < 2 or more.max() > COMMON_SHARE * THRESHOLD:
            break
        common, followed[t] = more, False
    keys = at * n_blocks + owner // BLOCK_ITEMS
    cells, cell_of = np.unique(keys, return_inverse=True)
    block_best = np.zeros(len(cells))
    np.maximum.at(block_best, cell_of, weight)
    common_by_block = np.zeros(n_blocks)
    np.maximum.at(common_by_block, np.arange(len(tfs)) // BLOCK_ITEMS, common)
    slots = np.zeros(SLOTS, dtype=bool)
    slots[(terms % np.uint64(SLOTS)).astype(np.int64)] = True
    return Index(
        np.array(ids, dtype=np.int64), np.array(unit_of, dtype=np.int64), terms, slots, followed, common_by_block,
        np.searchsorted(cells // n_blocks, np.arange(len(terms) + 1)), cells % n_blocks, block_best, keys, owner, weight, parts,
    )


def term_of(index: Index, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions of indexed words, their term numbers)."""
    at = np.flatnonzero(index.slots[(h % np.uint64(SLOTS)).astype(np.int64)])
    t = np.searchsorted(index.terms, h[at])
    ok = index.terms[np.minimum(t, len(index.terms) - 1)] == h[at]
    return at[ok], t[ok]


def passage_terms(index: Index, h: np.ndarray, by_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, term) pairs without repeats, sorted, and the document of each passage.

    Passage s holds the strides s and s + 1 of its document; a document's last
    stride is in the passage before it, unless it is the only one.
    """
    at, term = term_of(index, h)
    doc = np.searchsorted(by_doc, at, "right") - 1
    strides = np.maximum(1, -(-np.diff(by_doc) // STRIDE))
    base = np.concatenate([[0], np.cumsum(strides)])
    stride = base[doc] + (at - by_doc[doc]) // STRIDE
    doc_of = np.repeat(np.arange(len(strides)), strides)
    opens = stride < base[doc + 1] - 1  # a passage starts here
    opens |= strides[doc] == 1
    follows = stride > base[doc]
    n = len(index.terms)
    key = np.unique(np.concatenate([stride[opens] * n + term[opens], (stride[follows] - 1) * n + term[follows]]))
    return key // n, key % n, doc_of


def retrieve(index: Index, h: np.ndarray, by_doc: np.ndarray, threshold: float = THRESHOLD) -> list[tuple[int, int, float]]:
    """(document, item number, best passage score) of all passages that reach the threshold."""
    passage, term, doc_of = passage_terms(index, h, by_doc)
    if not len(passage):
        return []
    n_blocks = len(index.common)
    # bound of each (passage, block) from the followed terms and the block's frequent ones
    use = index.followed[term]
    p, t = passage[use], term[use]
    count = index.block_first[t + 1] - index.block_first[t]
    at = ranges(index.block_first[t], count)
    bound = np.bincount(np.repeat(p, count) * n_blocks + index.blocks[at], index.block_best[at], len(doc_of) * n_blocks)
    cell = np.flatnonzero(bound + np.tile(index.common, len(doc_of)) >= threshold - 1e-9)
    if not len(cell):
        return []
    # exact scores of the items in the remaining blocks, over all terms of the passage
    begin = np.searchsorted(passage, np.arange(len(doc_of) + 1))
    p, block = cell // n_blocks, cell % n_blocks
    held = begin[p + 1] - begin[p]
    mine = np.repeat(np.arange(len(cell)), held)
    key = term[ranges(begin[p], held)] * n_blocks + block[mine]
    lo, hi = np.searchsorted(index.keys, key), np.searchsorted(index.keys, key, "right")
    post = ranges(lo, hi - lo)
    mine = np.repeat(mine, hi - lo)
    score = np.bincount(mine * BLOCK_ITEMS + index.items[post] % BLOCK_ITEMS, index.weights[post], len(cell) * BLOCK_ITEMS)
    out: dict[tuple[int, int], float] = {}
    for k in np.flatnonzero(score >= threshold).tolist():
        found = int(doc_of[p[k // BLOCK_ITEMS]]), int(index.unit_of[block[k // BLOCK_ITEMS] * BLOCK_ITEMS + k % BLOCK_ITEMS])
        out[found] = max(out.get(found, 0.0), float(score[k]))
    return [(d, i, x) for (d, i), x in out.items()]


def overlap(part: np.ndarray, width: int, h: np.ndarray) -> float:
    """Share of a part's word runs that the text has (1 for a part without words)."""
    return float(np.isin(part, grams(h, width)).mean()) if len(part) else 1.0


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD,
) -> DataFrame:
    """(id, item_id, score, question_overlap, answer_overlap) for each text that holds a test item.

    Null and blank texts and items match nothing; rows with equal ids are
    judged each on its own text and may repeat in the result. Ids must be
    integers; a null document id is carried as null.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    schema = "id long, item_id long, score double, question_overlap double, answer_overlap double"
    found = spark.createDataFrame([], schema)
    items = benchmark.where(F.col(item_text).isNotNull()).select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t"))
    # about as many units as the index will have: sections are half a stride apart
    words = F.size(F.split("t", r"[^\p{L}\p{N}]+"))
    n = items.agg(F.sum(F.when(words > STRIDE, F.ceil(words * 2 / STRIDE)).otherwise(1))).first()[0] or 0
    n = n if n > INDEX_ITEMS else 1
    slices = -(-n // INDEX_ITEMS)
    parts = [items if slices == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(slices)) == k) for k in range(slices)]
    rows_of = lambda part: sorted((r["i"], r["t"]) for r in part.collect())
    counts = None
    if slices > 1:
        for part in parts:
            counts = count_items(rows_of(part), counts)
    for part in parts:
        index = build_index(rows_of(part), counts)
        if index is None:
            continue
        found = found.unionByName(_search(docs, id_col, text_col, spark.sparkContext.broadcast(tuple(index)), threshold, schema))
    return found.select(F.col("id").alias(id_col), F.col("item_id").alias(item_id), "score", "question_overlap", "answer_overlap")


def _search(docs: DataFrame, id_col: str, text_col: str, shared, threshold: float, schema: str) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(*shared.value)
        for batch in batches:
            rows = []
            for lo, hi, data, offsets in chunks(lowered(batch.column("text"))):
                h, by_doc = word_hashes(data, offsets)
                for d, item, score in retrieve(index, h, by_doc, threshold):
                    mine = h[by_doc[d] : by_doc[d + 1]]
                    q, q_width, a, a_width = index.parts[item]
                    q_found, a_found = overlap(q, q_width, mine), overlap(a, a_width, mine)
                    if q_found >= MIN_QUESTION and a_found >= MIN_ANSWER:
                        rows.append((lo + d, int(index.ids[item]), score, q_found, a_found))
            if rows:
                at, *cols = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(at)), pa.array(cols[0], pa.int64()), *[pa.array(c, pa.float64()) for c in cols[1:]]],
                    names=["id", "item_id", "score", "question_overlap", "answer_overlap"],
                )

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(scan, schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no test item (all columns; a null id can't be told apart and stays).

    Null and empty texts stay; an empty table stays empty, and no test items remove nothing; other columns may have any names.
    """
    leak = free_name(docs, "_leak")
    leaks = contaminated(docs, benchmark).select(F.col("doc_id").alias(leak)).where(F.col(leak).isNotNull()).distinct()
    return docs.join(leaks, F.col("doc_id") == F.col(leak), "left_anti")


def op5_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """Documents that hold a test item, with the item and its overlaps; empty tables on either side give no rows."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
