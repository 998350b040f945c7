"""One large records document, read by many tasks.

A ``{"records": [...]}`` document or a top-level array often is a single line, so
Spark's JSON reader parses it in one task and one row. Here Spark's text source
splits it by byte ranges instead: with ``}`` as line separator every range reads
the pieces that begin in it. A brace may stand inside a string or a nested
object, so a range cannot know by itself where records begin. Hence two passes:

1. Every range computes its *transition*, once for each state that it may start in
   (inside or outside a string): the state it ends in, how much deeper the nesting is
   then and how far it falls meanwhile. Composing these few rows in file order on
   the driver gives every range its true start state, and says whether the
   document is whole.
2. Every range then emits the records that begin and end in it. Of a record that reaches
   into later ranges each emits its fragment, and the fragments of one
   record (never more than one a range) are put together by a small grouping.

Quotes, escapes and nesting are found by whole-array
steps over the bytes of a batch. The records are landed as text in the shared
folder, then parsed by ``from_json`` with the declared schema in FAILFAST mode.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epistar.session import cut_lineage
from epistar.sources.files import json_shape

# functions that run in tasks travel by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_QUOTE, _ESCAPE, _COMMA = ord('"'), ord("\\"), ord(",")
_KEY = re.compile(rb'"((?:[^"\\]|\\.)*)"\s*:\s*$', re.S)
_BLANKS = np.frombuffer(b" \t\r\n", dtype=np.uint8)

# Kinds of emitted rows.
RECORD, FRAGMENT, OPENED, CLOSED, STRAY = range(5)
EMITTED = "file string, start long, seq long, nth long, kind int, owner long, body binary"


@dataclass
class Scan:
    """Bytes of a range, read on from a start state."""

    inside: bool  # in a string
    depth: int

    def step(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(depth after each byte, whether each byte stands in a string or delimits one) of the next bytes."""
        idx = np.arange(len(data))
        is_escape = data == _ESCAPE
        last_other = np.maximum.accumulate(np.where(is_escape, -1, idx))
        # a quote is escaped by an odd run of backslashes before it; pieces end in a brace, so no run crosses batches
        run = np.concatenate([[0], idx[:-1] - last_other[:-1]])
        quote = (data == _QUOTE) & (run % 2 == 0)
        turns = np.cumsum(quote)
        within = ((turns + self.inside) % 2 == 1) | quote
        opens = ((data == ord("{")) | (data == ord("["))) & ~within
        closes = ((data == ord("}")) | (data == ord("]"))) & ~within
        depth = self.depth + np.cumsum(opens.astype(np.int64) - closes)
        if len(data):
            self.inside = bool((turns[-1] + self.inside) % 2)
            self.depth = int(depth[-1])
        return depth, within


def _joined(pieces: pa.Array) -> np.ndarray:
    """The bytes of text pieces, each with the brace that ended it."""
    return np.frombuffer(b"".join(p + b"}" for p in pieces.cast(pa.binary()).to_pylist()), dtype=np.uint8)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array]]:
    """(file, start of the range, pieces) of the runs of one range in a batch."""
    files, starts = batch.column("file").to_pylist(), np.asarray(batch.column("start"))
    lo = 0
    for hi in range(1, batch.num_rows + 1):
        if hi == batch.num_rows or starts[hi] != starts[lo] or files[hi] != files[lo]:
            yield files[lo], int(starts[lo]), batch.column("piece").slice(lo, hi - lo)
            lo = hi


def _transitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range: bytes with separators, and for both start states the end state, the change of depth and its lowest value."""
    held: dict[tuple[str, int], list] = {}
    size: dict[str, int] = {}
    for batch in batches:
        for file, start, pieces in _runs(batch):
            size[file] = size[file] if file in size else batch.column("size")[batch.column("file").index(file).as_py()].as_py()
            state = held.setdefault((file, start), [0, Scan(False, 0), 0, Scan(True, 0), 0])
            data = _joined(pieces)
            state[0] += len(data)
            for k in (1, 3):
                depth, _ = state[k].step(data)
                state[k + 1] = min(state[k + 1], int(depth.min(initial=0)))
    rows = [(f, s, size[f], n, a.inside, a.depth, a_low, b.inside, b.depth, b_low) for (f, s), (n, a, a_low, b, b_low) in held.items()]
    names = ["file", "start", "size", "bytes", "in0", "delta0", "low0", "in1", "delta1", "low1"]
    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=_TRANSITION)


_TRANSITION = pa.schema([
    ("file", pa.string()), ("start", pa.int64()), ("size", pa.int64()), ("bytes", pa.int64()), ("in0", pa.bool_()), ("delta0", pa.int64()), ("low0", pa.int64()),
    ("in1", pa.bool_()), ("delta1", pa.int64()), ("low1", pa.int64()),
])


@dataclass
class Plan:
    """Start states of a file's ranges: {start: (inside, depth, owner of the record that is open there)}, and its record depth."""

    level: int
    ranges: dict[int, tuple[bool, int, int]] = field(default_factory=dict)


# Fixed value: length of a UTF-8 byte-order mark, which the text source leaves out.
_MARK = 3


def compose(rows: Sequence, level: int, name: str) -> Plan:
    """The true start state of every range, from the transitions of one file in order.

    Raises ``ValueError`` if the document breaks off or closes more than it opens.
    """
    plan, inside, depth, owner = Plan(level), False, 0, -1
    rows = sorted(rows, key=lambda r: r["start"])
    # every piece was counted with a brace; the last may have none in the file
    unended = sum(r["bytes"] for r in rows) - rows[0]["size"] in (1, 1 - _MARK)
    for k, r in enumerate(rows):
        plan.ranges[r["start"]] = (inside, depth, owner)
        low = depth + (r["low1"] if inside else r["low0"])
        ended = depth + (r["delta1"] if inside else r["delta0"])
        if low < 0 and not (unended and k == len(rows) - 1):
            raise ValueError(f"{name} closes more than it opens")
        if low <= level or owner < 0:
            owner = r["start"] if ended > level else -1
        inside, depth = (r["in1"] if inside else r["in0"]), ended
    if inside or depth + unended != 0:
        raise ValueError(f"{name} breaks off")
    return plan


def _emitter(plans: dict[str, Plan]):
    """The second pass: records, fragments, and what opens, closes or strays at the level of the records."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, scan, seq, nth, owner, open_part = None, None, 0, 0, -1, []
        rows: list[tuple] = []

        def put(kind: int, body: bytes | None, of: int = -1) -> None:
            nonlocal seq
            # nth: records begun in this range before this row, and before the record itself for one
            rows.append((key[0], key[1], seq, nth - (kind in (RECORD, FRAGMENT)), kind, of, body))
            seq += 1

        def flush() -> Iterator[pa.RecordBatch]:
            if rows:
                names = ["file", "start", "seq", "nth", "kind", "owner", "body"]
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=_EMITTED)
                rows.clear()

        def end_range() -> None:
            if key is not None and open_part:
                put(FRAGMENT, b"".join(open_part), owner if owner >= 0 else key[1])
                open_part.clear()

        for batch in batches:
            for file, start, pieces in _runs(batch):
                plan = plans[file]
                if key != (file, start):
                    end_range()
                    inside, depth, owner = plan.ranges[start]
                    key, scan, seq, nth = (file, start), Scan(inside, depth), 0, 0
                before = scan.depth
                data = _joined(pieces)
                depth, within = scan.step(data)
                was = np.concatenate([[before], depth[:-1]])
                level = plan.level
                begins = np.flatnonzero((data == ord("{")) & ~within & (was == level) & (depth == level + 1))
                ends = np.flatnonzero((depth == level) & (was == level + 1))
                raw = data.tobytes()
                events = [(int(k), "end") for k in ends] + [(int(k), "begin") for k in begins]
                # other values at the level of the records, and the containers around them
                outer = (was == level) & (depth == level) | (was == level) & (depth == level + 1) & (data != ord("{"))
                stray = np.flatnonzero(outer & ~np.isin(data, _BLANKS) & (data != _COMMA))
                closed = np.flatnonzero((was == level) & (depth == level - 1))
                # the first of each container says enough
                firsts = np.unique(np.searchsorted(closed, stray), return_index=True)[1]
                events += [(int(stray[k]), "stray") for k in firsts]
                events += [(int(k), "opened") for k in np.flatnonzero((was == level - 1) & (depth == level))]
                events += [(int(k), "closed") for k in closed]
                at = 0
                running = before > level
                for k, what in sorted(events):
                    if what == "begin":
                        at, running, nth = k, True, nth + 1
                    elif what == "end":
                        if running:
                            open_part.append(raw[at : k + 1])
                            if owner >= 0:
                                put(FRAGMENT, b"".join(open_part), owner)
                                owner = -1
                            else:
                                put(RECORD, b"".join(open_part))
                            open_part.clear()
                            running = False
                    elif what == "opened":
                        m = _KEY.search(raw[max(0, raw.rfind(b"}", 0, k)) : k])
                        put(OPENED, (m.group(1) if m else b"") + raw[k : k + 1])
                    elif what == "closed":
                        put(CLOSED, None)
                    else:
                        put(STRAY, raw[k : k + 1])
                if running:
                    open_part.append(raw[at:])
                yield from flush()
        end_range()
        yield from flush()

    return emit


_EMITTED = pa.schema([("file", pa.string()), ("start", pa.int64()), ("seq", pa.int64()), ("nth", pa.int64()), ("kind", pa.int32()), ("owner", pa.int64()), ("body", pa.binary())])


def _region(events: Sequence, shape: str, name: str) -> tuple[int, int, int, int, int]:
    """Places (start, seq) at which the array of records opens, with the records begun before it in its range, and closes."""
    events = sorted(events, key=lambda e: (e["start"], e["seq"]))
    want = b"[" if shape == "array" else b"records["
    for k, e in enumerate(events):
        if e["kind"] == OPENED and bytes(e["body"]) == want:
            end = next((c for c in events[k + 1 :] if c["kind"] == CLOSED), None)
            if end is None:
                raise ValueError(f"{name} breaks off")
            lo, hi = (e["start"], e["seq"]), (end["start"], end["seq"])
            stray = next((s for s in events if s["kind"] == STRAY and lo < (s["start"], s["seq"]) < hi), None)
            if stray is not None:
                raise ValueError(f"a record of {name} is not an object")
            return (*lo, e["nth"], *hi)
    raise ValueError(f"no array of records in {name}")


def split_records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``_file``, ``_pos`` and the JSON ``text`` of every record, each document read by as many tasks as it has splits.

    ``_pos`` is the place in the document's array, as one task would number it. A
    document that breaks off, has no array of records, or holds anything but objects
    in it raises ``ValueError``; an empty array gives no rows.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    pieces = spark.read.option("lineSep", "}").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_size").alias("size"), F.col("value").alias("piece"),
    )
    # one row a range
    shape_of = ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'boolean' if f.type == pa.bool_() else 'long'}" for f in _TRANSITION)
    found = pieces.mapInArrow(_transitions, shape_of).collect()
    plans, shapes = {}, {}
    for file in sorted({r["file"] for r in found}):
        shapes[file] = json_shape(spark, file)
        if shapes[file] == "other":
            raise ValueError(f"neither an object nor an array at the start of {file}")
        plans[file] = compose([r for r in found if r["file"] == file], 2 if shapes[file] == "object" else 1, file)
    if len(plans) < len(set(paths)):
        raise ValueError(f"an empty document among {', '.join(paths)}")
    # the records are landed once: counted, stitched and parsed from there
    rows = cut_lineage(pieces.mapInArrow(_emitter(plans), EMITTED))
    events = rows.where(F.col("kind") >= OPENED).collect()
    bounds = [(file, *_region([e for e in events if e["file"] == file], shape, file)) for file, shape in shapes.items()]
    bounds = F.broadcast(spark.createDataFrame(bounds, "b_file string, s0 long, q0 long, n0 long, s1 long, q1 long"))  # a row a file
    # a record counts where it begins: its fragments have that range as owner
    whole = rows.where(F.col("kind") == RECORD).select("file", "start", "seq", "nth", "body")
    parts = rows.where(F.col("kind") == FRAGMENT).groupBy("file", F.col("owner").alias("start")).agg(
        F.array_sort(F.collect_list(F.struct("start", "seq", "nth", "body"))).alias("parts"))
    parts = parts.where(F.col("parts")[0]["start"] == F.col("start"))
    joined = F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["body"])), ""))
    parts = parts.select("file", "start", F.col("parts")[0]["seq"].alias("seq"), F.col("parts")[0]["nth"].alias("nth"), joined.alias("body"))
    records = whole.unionByName(parts).join(bounds, F.col("file") == F.col("b_file"))
    records = records.where(
        ((F.col("start") > F.col("s0")) | ((F.col("start") == F.col("s0")) & (F.col("seq") > F.col("q0"))))
        & ((F.col("start") < F.col("s1")) | ((F.col("start") == F.col("s1")) & (F.col("seq") < F.col("q1"))))
    )
    records = records.withColumn("nth", F.col("nth") - F.when(F.col("start") == F.col("s0"), F.col("n0")).otherwise(0))
    # one number a range turns the order in it into the place in the document
    offsets, last, running = [], None, 0
    for r in records.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n")).orderBy("file", "start").collect():
        running = running if r["file"] == last else 0
        offsets.append((r["file"], r["start"], running))
        last, running = r["file"], running + r["n"]
    offsets = F.broadcast(spark.createDataFrame(offsets, "o_file string, o_start long, offset long"))
    placed = records.join(offsets, (F.col("file") == F.col("o_file")) & (F.col("start") == F.col("o_start")))
    return placed.select(F.col("file").alias("_file"), (F.col("offset") + F.col("nth")).alias("_pos"), F.col("body").cast("string").alias("text"))


def read_records_split(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str) -> DataFrame:
    """The records as rows of ``schema`` with ``_file`` and ``_pos``; a record that does not fit the schema fails the read."""
    text = split_records(spark, paths)
    ddl = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    rec = F.from_json("text", ddl, {"mode": "FAILFAST"})
    return text.select(rec.alias("_rec"), "_file", "_pos").select("_rec.*", "_file", "_pos")
