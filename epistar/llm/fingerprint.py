"""Document fingerprints: invertible Bloom lookup sketches of paragraphs, compared by subtraction.

A text is cut into paragraphs: its lines, these after sentence marks, and pieces
without such marks after a word whose hash says so, so a cut depends only on
the words around it and an edit leaves the paragraphs elsewhere alike. The k-th occurrence of a
paragraph has a digest of its own, so the digests of a text are a set.

The sketch has three parts of ``m`` cells. A digest goes into one cell of each
part, adding to the cell's count, the XOR of its digests and the XOR of their
checks. Subtracting two sketches leaves only the digests in which they differ.
A cell that holds a single one (count 1 or -1, and the check fits) gives it
away and its side; it is taken out of its other cells, which may free more
(peeling). When all cells are empty, every differing digest is known with its side, and

    likeness = common digests / all digests of both texts        (1 for two empty texts)

is exact. Where peeling stops early both sketches are made anew with twice the
cells, until it succeeds. The written fingerprint is the sketch of ``CELLS`` cells a part.

For versions of consecutive documents, whole texts move once, compressed, into
ranges of ids; a task then streams through its sorted range and holds two
texts. The first text of a range is also sent to the range before it (of the first to the
last), so each meets its successor and no task sees more than its range.

Defined cases: null texts are empty; null ids come first; equal ids are ordered by the hash of the text; a
single document is its own successor; an empty table gives no rows; ids are numbers; only id and text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epistar.llm.common import bounded_batches, table

CELLS = 8
PARTS = 3
LONG_PIECE = 400  # characters; longer pieces are cut after words
WORD_CUT = 8  # one word in so many ends a piece
SPLIT = re.compile(r"\n+|(?<=[.!?。！？])\s+")
WORD = re.compile(r"\S+\s*")

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_CHECK = np.uint64(0xD6E8FEB86659FD93)


def paragraphs(text: str) -> list[str]:
    """The pieces of a text, in order; blank ones are left out."""
    out = []
    for piece in SPLIT.split(text):
        if len(piece) <= LONG_PIECE:
            out.append(piece)
            continue
        start = 0
        for word in WORD.finditer(piece):
            if hashlib.blake2b(word.group().strip().encode("utf8", "surrogatepass"), digest_size=1).digest()[0] % WORD_CUT == 0:
                out.append(piece[start : word.end()])
                start = word.end()
        out.append(piece[start:])
    return [p for p in map(str.strip, out) if p]


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def digests(text: str) -> np.ndarray:
    """Sorted distinct 64-bit digests of a text's paragraphs and their occurrence numbers."""
    raw = b"".join(hashlib.blake2b(p.encode("utf8", "surrogatepass"), digest_size=8).digest() for p in paragraphs(text))
    found = np.sort(np.frombuffer(raw, dtype="<u8"))
    if not len(found):
        return found
    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    occurrence = np.arange(len(found)) - np.repeat(first, np.diff(np.append(first, len(found))))
    return np.unique(scramble(found + occurrence.astype(np.uint64) * _MIX[0]))


def cells_of(keys: np.ndarray, m: np.ndarray | int) -> np.ndarray:
    """The cell of each key in each part, (PARTS, keys)."""
    return np.stack([((scramble(keys ^ mix) >> np.uint64(11)) % np.asarray(m, dtype=np.uint64)).astype(np.int64) for mix in _MIX])


def checks_of(keys: np.ndarray) -> np.ndarray:
    return scramble(keys * _CHECK + np.uint64(1))


def sketch(keys: np.ndarray, m: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(counts, XOR of keys, XOR of checks) of PARTS * m cells."""
    at = (cells_of(keys, m) + (np.arange(PARTS) * m)[:, None]).ravel()
    counts, xors, checks = np.bincount(at, minlength=PARTS * m), np.zeros(PARTS * m, np.uint64), np.zeros(PARTS * m, np.uint64)
    np.bitwise_xor.at(xors, at, np.tile(keys, PARTS))
    np.bitwise_xor.at(checks, at, np.tile(checks_of(keys), PARTS))
    return counts, xors, checks


def written(keys: np.ndarray, m: int = CELLS) -> str:
    """A fingerprint as text: cells a part, then every cell's count, key XOR and the upper half of its check XOR, in hex."""
    counts, xors, checks = sketch(keys, m)
    cells = np.zeros(PARTS * m, dtype=[("n", ">u4"), ("key", ">u8"), ("check", ">u4")])
    cells["n"], cells["key"], cells["check"] = counts, xors, checks >> np.uint64(32)
    return f"{m}:{cells.tobytes().hex()}"


def peel(pairs: list[tuple[np.ndarray, np.ndarray]], m: int) -> list[tuple[np.ndarray, np.ndarray] | None]:
    """For each pair of key sets the keys only in the first and only in the second, read off their
    subtracted sketches of m cells a part; None where peeling stops early. All pairs are peeled together.
    """
    n, width = len(pairs), PARTS * m
    counts, xors, checks = np.zeros(n * width, np.int64), np.zeros(n * width, np.uint64), np.zeros(n * width, np.uint64)

    def add(owner: np.ndarray, keys: np.ndarray, sign: np.ndarray) -> np.ndarray:
        at = (cells_of(keys, m) + (np.arange(PARTS) * m)[:, None] + (owner * width)[None]).ravel()
        np.add.at(counts, at, np.tile(sign, PARTS))
        np.bitwise_xor.at(xors, at, np.tile(keys, PARTS))
        np.bitwise_xor.at(checks, at, np.tile(checks_of(keys), PARTS))
        return at

    for side, sign in ((0, 1), (1, -1)):
        keys = np.concatenate([p[side] for p in pairs]) if n else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(n), [len(p[side]) for p in pairs])
        add(owner, keys, np.full(len(keys), sign, dtype=np.int64))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    look, left = np.arange(n * width), n * width
    while len(look):
        pure = look[(np.abs(counts[look]) == 1) & (checks_of(xors[look]) == checks[look])]
        if not len(pure):
            break
        owner, keys, sign = pure // width, xors[pure].copy(), counts[pure].copy()
        # a key may show in several of its cells
        order = np.lexsort((keys, owner))
        new = np.concatenate([[True], (keys[order][1:] != keys[order][:-1]) | (owner[order][1:] != owner[order][:-1])])
        once = order[new]
        owner, keys, sign = owner[once], keys[once], sign[once]
        found.append((owner, keys, sign))
        look = np.unique(add(owner, keys, -sign))
        left -= len(keys)
        if left < 0:  # more keys than cells: not a sketch that can be read
            break
    rest = (counts.reshape(n, width) != 0).any(axis=1) | (xors.reshape(n, width) != 0).any(axis=1)
    owner = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
    keys = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.uint64)
    sign = np.concatenate([f[2] for f in found]) if found else np.zeros(0, np.int64)
    order = np.argsort(owner, kind="stable")
    owner, keys, sign = owner[order], keys[order], sign[order]
    cut = np.searchsorted(owner, np.arange(n + 1))
    out: list[tuple[np.ndarray, np.ndarray] | None] = []
    for k in range(n):
        ks, sg = keys[cut[k] : cut[k + 1]], sign[cut[k] : cut[k + 1]]
        out.append(None if rest[k] else (ks[sg > 0], ks[sg < 0]))
    return out


def likenesses(pairs: list[tuple[np.ndarray, np.ndarray]], m: int = CELLS, retried: list | None = None) -> list[float]:
    """Share of common digests among all of each pair, with larger sketches where peeling fails.

    ``retried`` receives (cells a part, pairs) of each attempt.
    """
    out = [0.0] * len(pairs)
    open_ = list(range(len(pairs)))
    while open_:
        if retried is not None:
            retried.append((m, len(open_)))
        failed = []
        for k, differing in zip(open_, peel([pairs[k] for k in open_], m)):
            if differing is None:
                failed.append(k)
                continue
            n_a, n_b = len(pairs[k][0]), len(pairs[k][1])
            union = n_b + len(differing[0])
            out[k] = (n_a - len(differing[0])) / union if union else 1.0
        open_, m = failed, 2 * m
    return out


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as many first code points of ``following``, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


# A text of this many characters or more is a group of its own when likenesses are worked out.
GROUP_CHARS = 4_000_000
OUT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _pack(texts: pa.Array) -> pa.Array:
    codec = pa.Codec("zstd")
    plain = [t.encode("utf8", "surrogatepass") for t in texts.to_pylist()]
    return pa.array([len(p).to_bytes(8, "little") + codec.compress(p, asbytes=True) for p in plain], pa.binary())


def _unpack(blob: bytes) -> str:
    return pa.Codec("zstd").decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True).decode("utf8", "surrogatepass")


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("packed")
        yield batch.set_column(at, "packed", _pack(batch.column("packed")))


def _range_of(ids: DataFrame, parts: int) -> Column:
    """The range of each ``id`` of ``ids``; equal ids share a range, null ids have the first."""
    bounds = ids.select(F.percentile_approx("id", [k / parts for k in range(1, parts)], 100 * parts).alias("b")).first()["b"] if parts > 1 else None
    bounds = sorted(set(bounds or []))
    above = F.array_size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < F.col("id"))) if bounds else F.lit(0)
    return F.coalesce(above, F.lit(0)).cast("int")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every text and of its edited version, with their likeness and that to the next document's.

    Columns: the id, then n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("tie"), text.alias("packed"))
    part = _range_of(rows.select("id", "tie"), parts)
    # the first row of every range that has rows (one each): it also goes to the range before
    heads = rows.groupBy(part.alias("part")).agg(F.min(F.struct(F.col("id").isNotNull().alias("has"), "id", "tie")).alias("head")).collect()
    heads = sorted((r["part"], r["head"]["id"], r["head"]["tie"]) for r in heads)
    send = [(heads[k - 1][0], i, t, p) for k, (p, i, t) in enumerate(heads)]
    id_type = rows.schema["id"].dataType.simpleString()
    send = spark.createDataFrame(send, f"before int, head_id {id_type}, head_tie long, head_part int")
    met = rows.withColumn("part", part)
    met = met.join(F.broadcast(send), (F.col("part") == F.col("head_part")) & F.col("id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie")), "left")
    shape = f"id {id_type}, tie long, packed binary, part int, before int"
    met = met.select("id", "tie", "packed", "part", "before").mapInArrow(_compress, shape)
    own = F.struct(F.col("part").alias("to"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("before").alias("to"), F.lit(True).alias("guest"))
    dealt = met.withColumn("place", F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, guest))))
    dealt = dealt.select("place.to", "place.guest", "id", "tie", "packed").repartition(parts, "to")
    dealt = dealt.sortWithinPartitions("to", "guest", F.col("id").asc_nulls_first(), "tie")
    return dealt.mapInArrow(_walk, f"id {id_type}, {OUT}").withColumnRenamed("id", id_col)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of sorted ranges in, results out: every own row once its successor is known."""
    held = None  # (to, id, text, digests) that waits for its successor
    waiting, chars, id_type = [], 0, None
    for batch in batches:
        id_type = batch.schema.field("id").type
        for to, guest, id_, blob in zip(*(batch.column(c).to_pylist() for c in ("to", "guest", "id", "packed"))):
            if guest and (held is None or held[0] != to):
                continue  # another copy of the guest
            text = _unpack(blob)
            keys = digests(text)
            if held is not None:
                waiting.append((*held[1:], text, keys))
                chars += len(held[2]) + len(text)
            held = None if guest else (to, id_, text, keys)
            if chars > GROUP_CHARS:
                yield _results(waiting, id_type)
                waiting, chars = [], 0
    if waiting:
        yield _results(waiting, id_type)


def _results(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    versions = [edited(text, following) for _, text, _, following, _ in rows]
    keys = [digests(v) for v in versions]
    near_edited = likenesses([(r[2], k) for r, k in zip(rows, keys)])
    near_next = likenesses([(r[2], r[4]) for r in rows])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], id_type), pa.array([len(r[1]) for r in rows], pa.int64()),
            pa.array([hashlib.sha256(v.encode("utf8", "surrogatepass")).hexdigest() for v in versions]),
            pa.array([written(r[2]) for r in rows]), pa.array([written(k) for k in keys]),
            pa.array(near_edited, pa.float64()), pa.array(near_next, pa.float64()),
        ],
        names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of ``documents`` and of their versions edited with the next document; an empty table gives no rows."""
    return fingerprints(table(spark, sf_dir, "documents"))
