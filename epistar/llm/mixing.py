"""Mixing sources to target weights: capped water-filling and seeded repetitions.

Sources, by code point with null last, weigh 5, 2, 1, 5, 2, 1, ... and share a
budget of ``BUDGET`` times all words. A source's target stops at ``MAX_EPOCHS``
times its size; what it leaves is shared out again by weight until no target is
above its stop. The budget is below the sum of the stops, so all of it is
placed.

Each source takes whole repetitions of all its documents, then a fractional one:
its documents in a seeded order, up to the word at which the target is met.
Only the document at that word is cut, so a source takes its target rounded
down. The order comes from a hash of the seed and the document, so reruns agree.

A source may hold most rows: its order is dealt over ``BUCKETS`` hash ranges,
whose sums are added up in a small table, so the running count inside a range is
all that a task sees. Only one row per source (at most ``MAX_SOURCES``, else an
error) reaches the driver, to fill the targets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epistar.llm.common import table

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"
BUCKET_DIGITS = 2  # hash ranges of a source: 16 ** 2
MAX_SOURCES = 1_000_000
GAP = r"[\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text (null: 0)."""
    return F.coalesce(F.size(F.filter(F.split(text, GAP), lambda w: w != "")), F.lit(0)).cast("long")


def water_fill(sizes: list[int], weights: list[float], budget: float, cap: float) -> list[float]:
    """Shares of ``budget`` by weight, none above ``cap`` times its size."""
    out = [0.0] * len(sizes)
    open_ = [i for i, s in enumerate(sizes) if s > 0]
    left = min(budget, cap * sum(sizes))
    while open_:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / total >= cap * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = float(cap * sizes[i])
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return out


def _targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, target), one row per source."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["n"] for r in rows]
    weights = [float(WEIGHTS[i % len(WEIGHTS)]) for i in range(len(rows))]
    filled = water_fill(sizes, weights, BUDGET * sum(sizes), MAX_EPOCHS)
    return sized.sparkSession.createDataFrame(
        [(r["source"], r["n"], t) for r, t in zip(rows, filled)], "m_source string, source_size long, target double"
    )


def _hash(id_col: Column, size: Column) -> Column:
    return F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(id_col.cast("string"), F.lit("")), F.lit(":"), size.cast("string")))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: id, size, source_size, target, whole, part, taken.

    ``whole`` repetitions and then the first ``part`` words; ``taken`` is their
    sum in words. Null texts and sources without a word take 0. Rows with equal
    ids take part one by one; where their sizes agree too they stand side by
    side in the order, and which of them is cut does not change the counts.
    """
    sized = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"), word_count(F.col(f"`{text_col}`")).alias("size")
    )
    targets = _targets(sized)
    keyed = sized.withColumn("h", _hash(F.col("id"), F.col("size"))).withColumn("bucket", F.substring("h", 1, BUCKET_DIGITS))
    # words of a source in the hash ranges before each range
    ranges = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("in_range"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        F.col("source").alias("r_source"), F.col("bucket").alias("r_bucket"), F.coalesce(F.sum("in_range").over(before), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("source", "bucket").orderBy("h", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    ordered = keyed.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    ordered = ordered.join(ranges, F.col("source").eqNullSafe(F.col("r_source")) & (F.col("bucket") == F.col("r_bucket")))
    ordered = ordered.join(targets, F.col("source").eqNullSafe(F.col("m_source")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    ordered = ordered.withColumn("whole", whole)
    rest = F.floor(F.col("target")).cast("long") - F.col("whole") * F.col("source_size")
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - F.col("start") - F.col("within")))
    ordered = ordered.withColumn("part", part)
    return ordered.select(
        F.col("id").alias(id_col), "source", "size", "source_size", "target", "whole", "part",
        (F.col("whole") * F.col("size") + F.col("part")).alias("taken"),
    )


def mix(docs: DataFrame) -> DataFrame:
    """The mix itself: the columns of ``docs``, ``repetition`` (from 1) and ``taken`` words, a row per repetition.

    A cut repetition holds its first words, joined by one space, and ``n_chars``
    (if there) counts them. Documents that take no word leave the mix. Rows that
    agree in id, source and size share a cut between them evenly. Input columns
    named ``repetition`` or ``taken`` give way to the mix's own. An empty table stays empty.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("repetition", "taken")])
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id"), F.col("text"), F.col("source"))
    plans = plan(docs).where("taken > 0").groupBy(F.col("doc_id").alias("p_id"), F.col("source").alias("p_source"), F.col("size").alias("p_size")).agg(
        F.max("whole").alias("whole"), F.floor(F.sum("part") / F.count("*")).cast("long").alias("part")
    )
    size = word_count(F.col("text"))
    joined = packed.withColumn("size", size).join(
        plans, F.col("doc_id").eqNullSafe(F.col("p_id")) & F.col("source").cast("string").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size"))
    )
    copies = F.col("whole") + F.when(F.col("part") > 0, 1).otherwise(0)
    each = joined.withColumn("repetition", F.explode(F.sequence(F.lit(1).cast("long"), copies)))
    taken = F.when(F.col("repetition") <= F.col("whole"), F.col("size")).otherwise(F.col("part"))
    each = each.withColumn("taken", taken)
    words = F.filter(F.split("text", GAP), lambda w: w != "")
    text = F.when(F.col("taken") == F.col("size"), F.col("text")).otherwise(F.array_join(F.slice(words, F.lit(1), F.col("taken").cast("int")), " "))
    each = each.withColumn("cut", text)
    out = {"text": F.col("cut"), "n_chars": F.char_length("cut").cast("long")}
    return each.select(*[out.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns], "repetition", "taken")


def op8_mix_to_weights(spark, sf_dir: str) -> DataFrame:
    """Size, target and taken words of every document; null texts have size 0 and take nothing, an empty table gives no rows."""
    return plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
